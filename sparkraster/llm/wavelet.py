"""Token files as wavelet matrices.

A shard holds the ids of documents in ascending id order, each document closed by
an end id. Its file keeps one bit plane per bit of an id; on every plane zeros move
stably before ones. With a rank directory beside the planes the one compressed
file answers which id stands at a place, how often an id occurs before a place and
where its k-th occurrence is, and gives all ids back.

Documents are dealt to shards by ranges of their ids, so shards are as even as the
shuffle makes them; a long range is cut into several files, so that a task holds
``SHARD`` ids at once (and the text being encoded). Files are rows of a Parquet
table in the shared folder: Spark's commit makes a retried task's files replace,
not repeat, a lost task's.

Added tokens that a text spells out get their own id, as the library gives them.

Cases: null and empty texts have the end id only; null ids come first, by text; repeated
rows are written each, in the order of their texts; an empty table has no files and an
empty result. The result has no columns of the input but the key, so nothing can clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored, text_bytes, tidy
from .pretokens import Distinct

MAGIC = b"WVLT0001"
#: Ids in a file, but for a last document that goes beyond.
SHARD = 8_000_000
#: Bytes of text that are encoded together.
BLOCK = 4_000_000
#: Bits between two entries of the rank directory.
STEP = 512
#: Words whose ids a worker remembers.
REMEMBERED = 2_000_000


class Sections(Sequence):
    """Compressed sections of a file, each decompressed when it is first asked for."""

    def __init__(self, data: memoryview, places: list[tuple[int, int]], kind: str):
        self.data, self.places, self.kind, self.open = data, places, kind, {}

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.open:
            at, length = self.places[i]
            self.open[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.data[at : at + length]), self.kind)
        return self.open[i]


class WaveletMatrix:
    """Bit planes of a sequence of ids, highest bit first."""

    def __init__(self, planes: Sequence[np.ndarray], ranks: Sequence[np.ndarray], zeros: list[int], n: int):
        self.planes, self.ranks, self.zeros, self.n, self.bits = planes, ranks, zeros, n, len(planes)

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, ranks, zeros = [], [], []
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for b in range(bits - 1, -1, -1):
            ones = (ids >> b & 1).astype(bool)
            plane = np.packbits(ones, bitorder="little")
            planes.append(plane)
            ranks.append(_directory(plane))
            ids = np.concatenate([ids[~ones], ids[ones]])
            zeros.append(len(ones) - int(ones.sum()))
        return cls(planes, ranks, zeros, len(ids))

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        block, rest = divmod(i, STEP)
        first = block * STEP // 8
        bits = np.unpackbits(self.planes[level][first : first + (rest + 7) // 8], bitorder="little")[:rest]
        return int(self.ranks[level][block]) + int(bits.sum())

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            one = self.planes[level][i >> 3] >> (i & 7) & 1
            value = value << 1 | int(one)
            i = self.zeros[level] + self._ones(level, i) if one else i - self._ones(level, i)
        return value

    def _descend(self, token: int, i: int) -> tuple[int, int]:
        """Where the ids equal to ``token`` begin on the last plane, and where those before place ``i`` end."""
        a, b = 0, i
        for level in range(self.bits):
            one = token >> (self.bits - 1 - level) & 1
            left, right = self._ones(level, a), self._ones(level, b)
            a, b = (self.zeros[level] + left, self.zeros[level] + right) if one else (a - left, b - right)
        return a, b

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before place ``i``."""
        if token >> self.bits:
            return 0
        a, b = self._descend(token, i)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0)."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._descend(token, 0)[0] + k
        for level in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - level) & 1
            at = self._place(level, one, at - self.zeros[level] if one else at)
        return at

    def _place(self, level: int, one: int, k: int) -> int:
        """Where the k-th (from 0) one or zero of a plane stands: its block by the rank directory, then its bit."""
        ranks = self.ranks[level]
        before = ranks if one else np.arange(len(ranks), dtype=np.int64) * STEP - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        first = block * STEP // 8
        bits = np.unpackbits(self.planes[level][first : first + STEP // 8], bitorder="little")
        return block * STEP + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def tokens(self) -> np.ndarray:
        """All ids, by undoing the planes from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            before = np.empty(self.n, kind)
            before[~ones] = now[: self.zeros[level]]
            before[ones] = now[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            now = before
        return now


def _directory(plane: np.ndarray) -> np.ndarray:
    step = STEP // 8
    padded = np.zeros(-(-len(plane) // step) * step, np.uint8)
    padded[: len(plane)] = plane
    return np.concatenate([[0], np.cumsum(np.bitwise_count(padded).reshape(-1, step).sum(axis=1, dtype=np.int64))]).astype(np.uint32)


def to_file(ids: np.ndarray, keys: np.ndarray, counts: np.ndarray, bits: int, known: np.ndarray | None = None) -> bytes:
    """One shard: header, then compressed sections with their lengths: document ids, whether each is known
    (all of them by default), their numbers of ids, zeros of the planes, and planes with their rank directories."""
    matrix = WaveletMatrix.of(ids, bits)
    known = np.ones(len(keys), np.uint8) if known is None else known.astype(np.uint8)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    parts = [keys.astype("<i8").tobytes(), known.tobytes(), counts.astype("<i8").tobytes(), np.array(matrix.zeros, "<i8").tobytes()]
    parts += [x.tobytes() for pair in zip(matrix.planes, matrix.ranks) for x in pair]
    parts = [squeeze(x) for x in parts]
    head = np.array([bits, matrix.n, len(keys), *map(len, parts)], "<i8")
    return MAGIC + head.tobytes() + b"".join(parts)


def from_file(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """The matrix, the document ids, whether each is known, and their numbers of ids. Planes stay compressed until they are asked for."""
    if data[:8] != MAGIC:
        raise ValueError("not a wavelet file")
    bits, n, _ = np.frombuffer(data, "<i8", 3, 8).tolist()
    lengths = np.frombuffer(data, "<i8", 4 + 2 * bits, 32)
    starts = 32 + 8 * len(lengths) + np.cumsum(lengths) - lengths
    places, whole = list(zip(starts.tolist(), lengths.tolist())), memoryview(data)
    keys, known, counts, zeros = (Sections(whole, [place], kind)[0] for place, kind in zip(places, ("<i8", "u1", "<i8", "<i8")))
    matrix = WaveletMatrix(Sections(whole, places[4::2], "u1"), Sections(whole, places[5::2], "<u4"), zeros.tolist(), n)
    return matrix, keys, known.astype(bool), counts


class _Encoder:
    """Ids of words by the tokenizers library; words met before are found by their hashes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # Added tokens are cut out of texts before words are looked for, as the library does.
        self.added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        if any(t.lstrip or t.rstrip or t.single_word or (t.normalized and self.library.normalizer) for t in self.library.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that take their surroundings along")
        self.literals = re.compile("|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        # A token's text has one sign per byte.
        self.sizes = np.array([len(self.library.id_to_token(i) or "") for i in range(self.library.get_vocab_size(with_added_tokens=True))])
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.starts, self.lengths, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has."""
        found: list = [None] * len(words)
        # A space and letters: such words stay apart when they are written one after another.
        plain = [i for i, w in enumerate(words) if w[0] == " " and w[1:].isalpha()]
        for a in range(0, len(plain), 1000):
            part = plain[a : a + 1000]
            ids = np.array(self._encode(["".join([words[i] for i in part])])[0], np.uint32)
            stops = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(words[i].encode()) for i in part])) + 1
            for i, x, y in zip(part, [0, *stops.tolist()], stops.tolist()):
                found[i] = ids[x:y]
        rest = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(rest, self._encode([words[i] for i in rest])):
            found[i] = np.array(ids, np.uint32)
        return np.concatenate(found), np.array([len(x) for x in found], np.int32)

    def look_up(self, block: Distinct) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of the block's distinct words begin in ``pool``, and how many there are."""
        at = np.minimum(np.searchsorted(self.hashes, block.hashes), max(0, len(self.hashes) - 1))
        known = (self.hashes[at] == block.hashes) & (self.checks[at] == block.checks) if len(self.hashes) else np.zeros(len(block.hashes), bool)
        missing = np.flatnonzero(~known)
        if len(missing):
            if len(self.hashes) + len(missing) > REMEMBERED:
                self._forget()
                missing = np.arange(len(block.hashes))
            ids, lengths = self._new(block.words(missing))
            starts = len(self.pool) + np.cumsum(lengths) - lengths
            self.pool = np.concatenate([self.pool, ids])
            hashes = np.concatenate([self.hashes, block.hashes[missing]])
            order = np.argsort(hashes, kind="stable")
            self.hashes, self.checks = hashes[order], np.concatenate([self.checks, block.checks[missing]])[order]
            self.starts, self.lengths = np.concatenate([self.starts, starts])[order], np.concatenate([self.lengths, lengths])[order]
            at = np.searchsorted(self.hashes, block.hashes)
            if not np.array_equal(self.checks[at], block.checks):
                raise ValueError("two words share a hash")
        return self.starts[at], self.lengths[at]


@cache
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _pieces(texts: list[str], encoder: _Encoder, end: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The texts cut at added tokens, the id that closes each piece, and the place after each text's last piece."""
    pieces, closing, stops = [], [], []
    for text in texts:
        at = 0
        for found in encoder.literals.finditer(text):
            pieces.append(text[at : found.start()])
            closing.append(encoder.added[found.group()])
            at = found.end()
        pieces.append(text[at:] if at else text)
        closing.append(end)
        stops.append(len(pieces))
    return pieces, np.array(closing, np.uint32), np.array(stops, np.int64)


def encode_block(texts: list[str], encoder: _Encoder, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts one after another, each closed by ``end``, and the number of ids of each."""
    pieces, closing, ends = _pieces(texts, encoder, end)
    block = Distinct(pieces)
    starts, lengths = encoder.look_up(block)
    last = np.cumsum(block.counts)
    # The id that closes a piece is one more word, after the piece's last.
    closers, which = np.unique(closing, return_inverse=True)
    index = np.insert(block.index, last, len(starts) + which)
    starts, lengths = np.append(starts, len(encoder.pool) + np.arange(len(closers))), np.append(lengths, np.ones(len(closers), lengths.dtype))
    per = lengths[index]
    stops = np.cumsum(per, dtype=np.int64)
    places = np.repeat(starts[index] - (stops - per), per)
    places += np.arange(len(places))
    ids = np.append(encoder.pool, closers)[places]
    return ids, np.diff(np.concatenate([[0], stops[(last + np.arange(len(last)))[ends - 1]]]))


def _writer(path: str, bits: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, turn, have = _encoder(path), TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []

        def file() -> pa.RecordBatch:
            ids, keys, known, counts = (np.concatenate(x) for x in zip(*held))
            first = pa.array([int(keys[0]) if known[0] else None], pa.int64())
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "turn": pa.array([turn], pa.int32()), "first_key": first, "n_ids": pa.array([len(ids)], pa.int64()), "file": pa.array([to_file(ids, keys, counts, bits, known)], pa.binary())}
            )

        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in slices(np.diff(offsets), BLOCK):
                keys = batch.column(0).slice(a, b - a)
                ids, counts = encode_block([x or "" for x in batch.column(1).slice(a, b - a).to_pylist()], encoder, end)
                known = np.asarray(keys.is_valid().to_numpy(zero_copy_only=False), bool)
                held.append((ids.astype(np.uint16 if bits <= 16 else np.uint32), np.asarray(keys.fill_null(0)), known, counts))
                have += len(ids)
                if have >= SHARD:
                    yield file()
                    held, have, turn = [], 0, turn + 1
        if held:
            yield file()

    return run


def write_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = 0, bits: int = 16) -> DataFrame:
    """Encode and write; the files as a table (part, turn, first_key, n_ids, file) in the shared folder."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    docs = docs.repartitionByRange(ranges, "key").sortWithinPartitions("key", "text")
    files = docs.mapInArrow(tidy(_writer(path, bits, end)), "part int, turn int, first_key long, n_ids long, file binary")
    return stored(files, "tokens")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, turn, data in zip(*(batch.column(i) for i in range(3))):
            matrix, keys, known, counts = from_file(data.as_py())
            ids = matrix.tokens().astype("<u4")
            ends = np.cumsum(counts)
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
            n = len(keys)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part.as_py()] * n, pa.int32()), "turn": pa.array([turn.as_py()] * n, pa.int32()), "key": pa.array(keys, mask=~known), "inside": pa.array(ends - counts), "n_tokens": pa.array(counts), "ids_crc32": pa.array(crc, pa.int64())}
            )


def read_tokens(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files."""
    # A row per file of millions of ids, so one task numbers them.
    order = Window.orderBy(F.col("first_key").asc_nulls_first(), "part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("part", "turn", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    docs = files.select("part", "turn", "file").mapInArrow(tidy(_reader), "part int, turn int, key long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(before, ["part", "turn"]).select(F.col("key").alias(key), (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
