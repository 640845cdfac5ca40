"""Byte-level BPE by a global shuffle of distinct words.

*Encoding.* Texts are cut into pre-tokens with their positions, once. Occurrences of
a word in a block of neighbouring rows are one request, so what is shuffled is every
block's distinct words: all requests for a word meet in one task, which encodes it
once and answers every block. A block's positions (an index into its own distinct
words) join their answers on the block, and documents are reassembled by position.

*Decoding.* An encoded block is its documents' ids and a row per distinct id in it.
Those rows join the token-byte table (id, bytes); documents are the bytes of their
ids in order. Nothing but ids and that table takes part.

Requests are shuffled as compressed blobs, one per block and word range, since a row
per occurrence would shuffle several times the input. A word range is a part of
the 64-bit word hash; there are as many as shuffle partitions, so a task's
dictionary shrinks as the cluster's setting grows with the data. Word ranges are
even whatever the words' frequencies: a frequent word is one entry per block.

Requests and positions come from one pass over the texts and travel in one shuffle,
which both sides of the join read; a block is named by its place and a digest of its
content, so a lost task's blocks come back under their names.

Cases: null text counts as empty; an empty text has no ids; repeated rows and null
ids are encoded each for itself; an empty table gives an empty result. The result has
no other columns than the key and those named below, so nothing can clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, text_bytes, tidy
from .pretokens import Distinct

#: Bytes of text in a block (a longer text is a block of its own).
BLOCK = 2_000_000
LEVEL = 3
#: A row of the shuffle: a request (range and payload: words) or a block's positions (payload: index).
TOKENISED = "part binary, block binary, range int, payload binary, keys array<long>, counts binary, order binary"
#: A row per block (place -1: keys, counts and ids) and a row per distinct id in it.
ENCODED = "block binary, place int, id int, keys array<long>, counts binary, ids binary"


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids, from a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}


@cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table: (id, bytes), a row per entry of the vocabulary."""
    names = pa.table({"id": pa.array(list(ranks(path).values()), pa.int32()), "bytes": pa.array(list(ranks(path)), pa.binary())})
    return spark.createDataFrame(names)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _pack_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(x) for x in words], "<u4")
    return zstandard.ZstdCompressor(level=LEVEL).compress(np.uint32(len(words)).tobytes() + lengths.tobytes() + b"".join(words))


def _unpack_words(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = (np.cumsum(np.frombuffer(data, "<u4", n, 4)) + 4 + 4 * n).tolist()
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def by_frequency(index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``index`` into ``n`` things numbered anew, the most frequent first, and each number's old one."""
    order = np.argsort(-np.bincount(index, minlength=n), kind="stable").astype(np.uint32)
    place = np.empty(n, np.uint32)
    place[order] = np.arange(n, dtype=np.uint32)
    return place[index], order


def _tokenised(ranges: int):
    """(key, text) to requests and positions, ``TOKENISED``."""

    def requests(name: bytes, found: Distinct) -> list[dict]:
        words = [x.encode() for x in found.words()]
        part = (found.hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        edges = np.searchsorted(part, np.arange(ranges + 1)).tolist()
        return [{"part": r.to_bytes(4), "block": name, "range": r, "payload": _pack_words(words[a:b])} for r, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in slices(np.diff(offsets), BLOCK):
                keys = batch.column(0).slice(a, b - a).to_pylist()
                digest = hashlib.blake2b(raw[offsets[a] : offsets[b]].tobytes(), digest_size=16)
                digest.update(repr((place, turn, keys, np.diff(offsets[a : b + 1]).tolist())).encode())
                name, turn = digest.digest(), turn + 1
                found = Distinct([x or "" for x in batch.column(1).slice(a, b - a).to_pylist()])
                index, order = by_frequency(found.index, len(found.hashes))
                rows = requests(name, found)
                rows.append({"part": name, "block": name, "payload": pack(index), "keys": keys, "counts": pack(found.counts), "order": pack(order)})
                del found, index, order
                yield pa.RecordBatch.from_pylist(rows, _schema("part binary, block binary, range int, payload binary, keys longs, counts binary, order binary"))

    return run


def _schema(columns: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "longs": pa.list_(pa.int64()), "ints": pa.list_(pa.int32()), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, columns.split(", "))])


def _answers(path: str, pattern: str):
    """Requests to ids: (block, range, lengths, ids). Positions are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[int]] = {}
        encode = encoding(path, pattern).encode_ordinary
        for batch in batches:
            rows = []
            for block, part, blob in zip(*(batch.column(i) for i in (1, 2, 3))):
                if not part.is_valid:
                    continue
                found = []
                for word in _unpack_words(blob.as_py()):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encode(word.decode())
                    found.append(ids)
                flat = np.array([i for ids in found for i in ids], np.uint32)
                rows.append({"block": block.as_py(), "range": part.as_py(), "lengths": pack(np.array([len(x) for x in found])), "ids": pack(flat)})
            yield pa.RecordBatch.from_pylist(rows, _schema("block binary, range int, lengths binary, ids binary"))

    return run


def _concatenated(blobs: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint32), *map(unpack, blobs)])


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions with their answers to ``ENCODED``."""
    for batch in batches:
        for name, keys, counts, order, index, answers in zip(*(batch.column(i) for i in range(6))):
            if not order.is_valid:  # a request
                continue
            answers = sorted(answers.as_py() or [], key=lambda x: x["range"])
            lengths, flat = _concatenated([x["lengths"] for x in answers]).astype(np.int64), _concatenated([x["ids"] for x in answers])
            order = unpack(order.as_py())
            if len(lengths) != len(order):
                raise ValueError("a block lacks answers")
            starts = (np.cumsum(lengths) - lengths)[order]
            per = lengths[order]
            index, counts = unpack(index.as_py()), unpack(counts.as_py()).astype(np.int64)
            stops = np.cumsum(per[index])
            ids = flat[np.repeat(starts[index] - (stops - per[index]), per[index]) + np.arange(stops[-1] if len(stops) else 0)]
            ends = np.concatenate([[0], stops])[np.cumsum(counts)]  # ids before the end of each document
            used, place = np.unique(ids, return_inverse=True)
            place, by = by_frequency(place, len(used))
            used = used[by]
            first = {"block": name.as_py(), "place": -1, "keys": keys.as_py(), "counts": pack(np.diff(ends, prepend=0)), "ids": pack(place)}
            yield pa.RecordBatch.from_pylist([first], _schema("block binary, place int, id int, keys longs, counts binary, ids binary"))
            n = len(used)
            others = [pa.array([name.as_py()] * n, pa.binary()), pa.array(np.arange(n, dtype=np.int32)), pa.array(used.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*others, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], ["block", "place", "id", "keys", "counts", "ids"])


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's ids, as blocks of documents (``ENCODED``).

    ``path`` names a rank file that every executor can open.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    both = docs.mapInArrow(tidy(_tokenised(ranges)), TOKENISED).repartition(ranges, "part")
    answers = both.mapInArrow(tidy(_answers(path, pattern)), "block binary, range int, lengths binary, ids binary")
    answers = answers.groupBy(F.col("block").alias("part")).agg(F.collect_list(F.struct("range", "lengths", "ids")).alias("answers"))
    # Requests find no answers. The test needs both sides, so it stays above the shuffle that they share.
    placed = both.join(answers, "part", "left").where("range is null or answers is not null")
    return placed.select("block", "keys", "counts", "order", "payload", "answers").mapInArrow(tidy(_encoded), ENCODED)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, list]]:
    """Rows of blocks to (keys, counts, places, table of id and bytes) of each block, as soon as all of its rows are there."""
    pending: dict[bytes, dict] = {}
    for batch in batches:
        keys, counts, places = (batch.column(c) for c in ("keys", "counts", "ids"))
        for i, (name, place, number, piece) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "place", "id", "bytes")))):
            block = pending.setdefault(name, {"table": {}})
            if place < 0:
                used = unpack(places[i].as_py())
                block |= {"head": (keys[i].as_py(), unpack(counts[i].as_py()).astype(np.int64), used), "size": int(used.max()) + 1 if len(used) else 0}
            else:
                block["table"][place] = (number, piece)
            if len(block["table"]) == block.get("size"):
                yield *block["head"], [block["table"][k] for k in range(block["size"])]
                del pending[name]
    if pending:
        raise ValueError("rows of a block lie in several partitions")


def _decoded(with_ids: bool, with_bytes: bool):
    """(block, place, id, bytes, keys, counts, ids) to a row per document."""
    names = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids ints" * with_ids + ", decoded binary" * with_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts, place, table in _blocks(batches):
            raw, text, numbers = [x[1] for x in table], [str(x[0]) for x in table], np.array([x[0] for x in table], np.int32)
            ends = np.cumsum(counts)
            hashes, back, sums = [], [], []
            for a, b in zip((ends - counts).tolist(), ends.tolist()):
                own = place[a:b].tolist()
                hashes.append(hashlib.sha256(" ".join([text[i] for i in own]).encode()).hexdigest())
                whole = b"".join([raw[i] for i in own])
                sums.append(hashlib.sha256(whole).hexdigest())
                if with_bytes:
                    back.append(whole)
            columns = [pa.array(keys, pa.int64()), pa.array(counts), pa.array(hashes, pa.string()), pa.array(sums, pa.string())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(numbers[place])))
            if with_bytes:
                columns.append(pa.array(back, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=_schema(names))

    return run


def decode(encoded: DataFrame, table: DataFrame, with_ids: bool = False, with_bytes: bool = False, together: bool = False) -> DataFrame:
    """Encoded blocks and the token-byte table to a row per document: key, n_tokens, digests of the ids
    (decimal, joined by a space) and of the decoded bytes, and on demand the ids and the bytes themselves.

    ``together`` says that all rows of a block lie in one partition, as ``encode`` leaves them: the broadcast join doesn't
    move them, so they aren't shuffled. Rows that lie apart all the same stop the job."""
    rows = encoded if together else encoded.repartition("block")
    known = rows.join(F.broadcast(table), "id", "left")  # a row per entry of the vocabulary, whatever the data
    kinds = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded binary" * with_bytes
    return known.select("block", "place", "id", "bytes", "keys", "counts", "ids").mapInArrow(tidy(_decoded(with_ids, with_bytes)), kinds)


def encode_decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False, with_bytes: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row; on demand also the ids and the decoded bytes."""
    encoded = encode(df, path, pattern, key, text)
    return decode(encoded, token_table(df.sparkSession, path), with_ids, with_bytes, together=True).withColumnRenamed("key", key)
