"""Document fingerprints by content-defined chunking.

A gear hash over the last bytes places chunk borders, with a harder test before
the normal chunk size and an easier one after it (normalised chunking). The
fingerprint is the set of chunk digests with the bytes each stands for, so a
shifted passage keeps its chunks; containment weighs shared chunks by their bytes:
the share of a fingerprint's bytes that stand in chunks of the other, too.

Texts of up to ``SHORT`` bytes have a second set, of finer chunks, by which two
short texts are compared; a short and a long text meet by the normal chunks. As
text, a chunk takes 8 bytes in base64, about a fifth of the bytes that it stands for.

``with_next`` gives every document the next one in descending id order: ranges of
ids, cut at quantiles, are sorted within their tasks, and the first document of a
range is sent to the range before as well. Whole texts are shuffled once.

Cases: null text counts as empty; an empty text has an empty fingerprint, equal to
another empty one (1.0) and unlike any other (0.0); equal ids follow each other by
text; null ids come last, by text; the only document is its own next; an empty table gives
an empty result, which has no columns of the input but the key, so nothing can clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import random_words, segment_hashes, slices, tidy

class Scale(NamedTuple):
    """Bytes of a chunk (least, normal and most), bits that the gear hash must have at zero before
    and after the normal size, and bytes that it sees."""

    least: int
    normal: int
    most: int
    hard: int
    easy: int
    seen: int


COARSE, FINE = Scale(16, 48, 192, 6, 4, 16), Scale(4, 8, 32, 4, 2, 4)
#: Bytes up to which a text has finer chunks as well.
SHORT = 1024
#: Bits of a digest; the other bits of a chunk's 64 hold bytes (a chunk of more has several entries).
DIGEST = 40
BLOCK = 2_000_000
#: Ranges per task, so that tasks get about as many rows each.
RANGES = 4
#: Distances in the id quantiles that cut the ranges.
ACCURACY = 100_000


def gear(raw: np.ndarray, seen: int) -> np.ndarray:
    """Gear hash of the last ``seen`` bytes at every place: each byte's number, doubled per byte since."""
    now = (random_words(41, 256) >> np.uint64(32)).astype(np.uint32)[raw]
    span = 1
    while span < seen:
        now[span:] = now[span:] + (now[:-span] << np.uint32(span))
        span *= 2
    return now


def borders(raw: np.ndarray, offsets: np.ndarray, scale: Scale = COARSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all texts, and chunks per text."""
    high = gear(raw, scale.seen) >> np.uint32(32 - scale.hard)
    soft = np.flatnonzero(high >> np.uint32(scale.hard - scale.easy) == 0) + 1  # a border stands behind the byte
    hard = soft[high[soft - 1] == 0].tolist()
    soft = soft.tolist()
    starts, counts = [], []
    i = j = 0
    n_hard, n_soft = len(hard), len(soft)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        before = len(starts)
        while a < b:
            starts.append(a)
            if b - a <= scale.least:
                break
            least, normal, most = a + scale.least, a + scale.normal, a + scale.most
            while i < n_hard and hard[i] < least:
                i += 1
            if i < n_hard and hard[i] <= normal:
                a = hard[i]
                if a > b:
                    break
                continue
            while j < n_soft and soft[j] <= normal:
                j += 1
            a = soft[j] if j < n_soft and soft[j] < most else most
        counts.append(len(starts) - before)
    starts = np.array(starts, np.int64)
    counts = np.array(counts, np.int64)
    ends = np.append(starts[1:], len(raw))
    last = np.cumsum(counts)[counts > 0] - 1
    ends[last] = offsets[1:][counts > 0]
    return starts, ends, counts


def chunk_sets(texts: list[bytes], scale: Scale) -> list[dict[int, int]]:
    """Chunk digests of each text with the bytes they stand for."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    if not len(raw):
        return [{} for _ in texts]
    starts, ends, counts = borders(raw, offsets, scale)
    digests = (segment_hashes(raw, starts, ends, 43) >> np.uint64(64 - DIGEST)).tolist()
    lengths, out, at = (ends - starts).tolist(), [], 0
    for n in counts.tolist():
        chunks: dict[int, int] = {}
        for d, length in zip(digests[at : at + n], lengths[at : at + n]):
            chunks[d] = chunks.get(d, 0) + length
        out.append(chunks)
        at += n
    return out


class Fingerprint(NamedTuple):
    """Bytes by chunk digest: of normal chunks, and of finer ones where the text is short."""

    coarse: dict[int, int]
    fine: dict[int, int] | None


def fingerprints(texts: list[bytes]) -> list[Fingerprint]:
    """The fingerprint of every text."""
    out: list[Fingerprint] = []
    for x, y in slices(np.array([len(t) for t in texts], np.int64), BLOCK):
        part = texts[x:y]
        short = [i for i, t in enumerate(part) if len(t) <= SHORT]
        fine = dict(zip(short, chunk_sets([part[i] for i in short], FINE)))
        out += [Fingerprint(chunks, fine.get(i)) for i, chunks in enumerate(chunk_sets(part, COARSE))]
    return out


def containment(a: Fingerprint, b: Fingerprint) -> float:
    """The share of ``a``'s bytes that stand in chunks of ``b`` as well."""
    own, other = (a.coarse, b.coarse) if a.fine is None or b.fine is None else (a.fine, b.fine)
    if not own or not other:
        return float(not own and not other)
    return sum(min(n, other[d]) for d, n in own.items() if d in other) / sum(own.values())


def _written(chunks: dict[int, int]) -> str:
    most = (1 << 64 - DIGEST) - 1
    entries = [d << 64 - DIGEST | part for d, n in sorted(chunks.items()) for part in [most] * (n // most) + [n % most] if part]
    return base64.b64encode(np.array(entries, "<u8").tobytes()).decode()


def written(mark: Fingerprint) -> str:
    """A fingerprint as text: base64 of digest and bytes of each chunk, ascending; finer chunks behind a dot."""
    return _written(mark.coarse) + ("" if mark.fine is None else "." + _written(mark.fine))


def read(text: str) -> Fingerprint:
    """The fingerprint that ``written`` gave."""

    def chunks(part: str) -> dict[int, int]:
        out: dict[int, int] = {}
        for x in np.frombuffer(base64.b64decode(part), "<u8").tolist():
            d = x >> 64 - DIGEST
            out[d] = out.get(d, 0) + (x & (1 << 64 - DIGEST) - 1)
        return out

    coarse, dot, fine = text.partition(".")
    return Fingerprint(chunks(coarse), chunks(fine) if dot else None)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and place; a row of the next range closes each range."""
    held: tuple | None = None
    for batch in batches:
        part, keys, texts, extra = (batch.column(i).to_pylist() for i in range(4))
        encoded = [(x or "").encode() for x in texts]
        for x, y in slices(np.array([len(t) for t in encoded], np.int64), BLOCK):
            rows = [] if held is None else [held]
            own = fingerprints(encoded[x:y])
            rows += list(zip(part[x:y], keys[x:y], [t or "" for t in texts[x:y]], extra[x:y], own))
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[3] and a[0] == b[0]]
            held = rows[-1]
            if not pairs:
                continue
            changed = [edited(a[2], b[2]).encode() for a, b in pairs]
            marks = fingerprints(changed)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([a[1] for a, _ in pairs], pa.int64()),
                    "n_chars": pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
                    "fingerprint": pa.array([written(a[4]) for a, _ in pairs]),
                    "edited_fingerprint": pa.array([written(m) for m in marks]),
                    "near_edited": pa.array([containment(a[4], m) for (a, _), m in zip(pairs, marks)]),
                    "near_next": pa.array([containment(a[4], b[4]) for a, b in pairs]),
                }
            )


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """(range, key, text, extra): rows in descending key order within a range, the first row
    of the next range, marked ``extra``, at its end; the last range ends with the very first row."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES * tasks
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    steps = [i / ranges for i in range(1, ranges)] or [0.5]
    found = docs.agg(F.percentile_approx("key", steps, ACCURACY).alias("cuts"), F.max("key").alias("first"), F.count("*").alias("rows"), F.count("key").alias("known")).first()
    # A cut is the largest key of its range; their number is bounded by the shuffle partitions.
    cuts = sorted({c for c in found["cuts"] or [] if c != found["first"]}, reverse=True)
    borders = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    last = len(cuts)
    # Keys above the first cut are range 0. Whole runs of cuts are counted first, then the cuts of one run.
    run = max(1, int(len(cuts) ** 0.5))
    heads = F.array(*[F.lit(c).cast("long") for c in cuts[run - 1 :: run]]) if cuts else borders
    whole = F.size(F.filter(heads, lambda c: c >= F.col("key"))) * run
    some = F.size(F.filter(F.slice(borders, whole + 1, run), lambda c: c >= F.col("key")))
    place = F.when(F.col("key").isNull(), last).otherwise(whole + some).cast("int")
    own = F.struct(place.alias("range"), F.lit(False).alias("extra"))
    before = F.struct((place - 1).alias("range"), F.lit(True).alias("extra"))
    ahead = F.struct(F.lit(last).alias("range"), F.lit(True).alias("extra"))
    nothing = F.lit(None).cast("struct<range:int,extra:boolean>")
    opens = (place > 0) & (F.get(borders, place - 1) == F.col("key"))
    very_first = F.col("key") == found["first"] if found["known"] else F.lit(True)
    copies = F.filter(F.array(own, F.when(opens, before).otherwise(nothing), F.when(very_first, ahead).otherwise(nothing)), lambda x: x.isNotNull())
    rows = docs.withColumn("to", F.explode(copies)).select("to.range", "key", "text", "to.extra")
    return rows.repartition(tasks, "range").sortWithinPartitions("range", "extra", F.desc_nulls_last("key"), "text")


def fingerprint_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near the edited and the next text are."""
    kinds = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(df, key, text).mapInArrow(tidy(_compare), kinds).withColumnRenamed("key", key)
