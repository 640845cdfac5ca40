"""WARC archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole WARC records,
and a seek table in a skippable frame at its end, so that any Zstandard reader can
decompress it and a seeking one can open a single frame. Records are found by
(bundle, frame, offset in the frame).

Equal payloads of at least ``SMALLEST`` bytes are written once, by the smallest
page id; the others are revisit records that name it. Only digests are compared to
find them, in salted groups; pages are shuffled once, by id, to meet the result.
Bundles are rows of a Parquet table in the shared folder: Spark's commit makes a
retried task's bundles replace, not repeat, a lost task's.

``find_records`` seeks single records by page id: the index gives bundle, frame and
offset, and only those frames are opened.

Cases: null html is an empty payload; null urls write no target; null ids are never
revisits and refer to nothing; rows with the same id are written each, and are
revisits only of a smaller id; an empty table has no bundles and an empty result,
which has no columns of the input, so nothing can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_first, stored, tidy

#: Payloads below this many bytes are always written.
SMALLEST = 100
#: Uncompressed bytes of a frame and of a bundle, but for a last record that goes beyond.
FRAME, BUNDLE = 256_000, 32_000_000
#: Magic numbers of skippable frames and of the seek table's footer, and the revisit profile.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of the records: part of the input, so that writing again gives the same bytes.
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record with its closing blank lines."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record begins here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    end = stop + 4 + int(headers["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record isn't closed")
    return headers, data[stop + 4 : end], end + 4


class Bundle:
    """Collects records into frames."""

    def __init__(self, level: int = 3):
        self.frames: list[tuple[bytes, int]] = []
        self.open: list[bytes] = []
        self.filled = self.total = 0
        self.squeeze = zstandard.ZstdCompressor(level=level, write_checksum=True).compress

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset that the record gets."""
        place = len(self.frames), self.filled
        self.open.append(data)
        self.filled += len(data)
        self.total += len(data)
        if self.filled >= FRAME:
            self._close()
        return place

    def _close(self) -> None:
        if self.open:
            self.frames.append((self.squeeze(b"".join(self.open)), self.filled))
            self.open, self.filled = [], 0

    def finish(self) -> bytes:
        """Frames, then the seek table: compressed and plain length of each, their number, and the closing mark."""
        self._close()
        table = np.array([(len(data), n) for data, n in self.frames], "<u4").tobytes()
        footer = np.uint32(len(self.frames)).tobytes() + b"\0" + np.uint32(SEEKABLE).tobytes()
        head = np.array([SKIPPABLE, len(table) + len(footer)], "<u4").tobytes()
        return b"".join(data for data, _ in self.frames) + head + table + footer


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed length, plain length) of every frame, from the bundle's end."""
    n = int(np.frombuffer(data, "<u4", 1, len(data) - 9)[0])
    if int(np.frombuffer(data, "<u4", 1, len(data) - 4)[0]) != SEEKABLE:
        raise ValueError("no seek table")
    entries = np.frombuffer(data, "<u4", 2 * n, len(data) - 9 - 8 * n).reshape(-1, 2).astype(np.int64)
    starts = np.cumsum(entries[:, 0]) - entries[:, 0]
    return list(zip(starts.tolist(), entries[:, 0].tolist(), entries[:, 1].tolist()))


def read_frame(data: bytes, frame: int) -> bytes:
    start, length, plain = seek_table(data)[frame]
    return zstandard.ZstdDecompressor().decompress(data[start : start + length], max_output_size=plain)


def read_record(data: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record, by its frame and its offset in the frame."""
    return parse(read_frame(data, frame), offset)[:2]


def _writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, turn, bundle, index = TaskContext.get().partitionId(), 0, Bundle(), []

    def row() -> pa.RecordBatch:
        data = bundle.finish()
        places = pa.array([{"page_id": p, "frame": f, "offset": o} for p, f, o in index], pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int32())])).value_type)
        lists = pa.ListArray.from_arrays(pa.array([0, len(index)], pa.int32()), places)
        return pa.RecordBatch.from_arrays([pa.array([f"part-{part:05d}-{turn:03d}.warc.zst"]), pa.array([data], pa.binary()), lists], ["name", "data", "records"])

    for batch in batches:
        for page_id, url, payload, digest, refers in zip(*(batch.column(i) for i in range(5))):
            page_id = page_id.as_py()
            index.append((page_id, *bundle.add(record(page_id, url.as_py(), payload.as_py() or b"", digest.as_py(), refers.as_py()))))
            if bundle.total >= BUNDLE:
                yield row()
                turn, bundle, index = turn + 1, Bundle(), []
    if index:
        yield row()


def write_warc(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row; the bundles as a table (name, data, records) in the shared folder,
    ``records`` mapping page ids to frames and offsets."""
    pages = df.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("digest", F.sha2("payload", 256))
    large = pages.where((F.length("payload") >= SMALLEST) & F.col("page_id").isNotNull()).select("page_id", "digest")
    first = group_first(large, ["digest"], "page_id", "first").where("first_rows > 1 and page_id > first")
    refers = first.groupBy("page_id", "digest").agg(F.min("first").alias("refers_to"))
    rows = pages.join(refers, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")
    return stored(rows.mapInArrow(tidy(_writer), "name string, data binary, records array<struct<page_id: long, frame: int, offset: int>>"), "warc")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, data, records in zip(*(batch.column(i) for i in range(3))):
            data, name, places = data.as_py(), name.as_py(), iter(records.as_py())
            out: dict[str, list] = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "bundle", "frame", "offset")}
            for frame in range(len(seek_table(data))):
                plain, at = read_frame(data, frame), 0
                while at < len(plain):
                    place = next(places)
                    if (place["frame"], place["offset"]) != (frame, at):
                        raise ValueError("the index doesn't fit the bundle")
                    headers, block, end = parse(plain, at)
                    head, payload = block.split(b"\r\n\r\n", 1)
                    size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    refers = headers.get("WARC-Refers-To")
                    if refers is None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError("a payload differs from its digest")
                    own = headers["WARC-Record-ID"][10:-1]
                    for k, v in zip(out, (int(own) if own else None, size, digest, headers["WARC-Type"], int(refers[10:-1]) if refers else None, headers.get("WARC-Target-URI"), name, frame, at)):
                        out[k].append(v)
                    at = end
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def read_warc(bundles: DataFrame) -> DataFrame:
    """A row per record, read back from the bundles and held against its digest and the index."""
    return bundles.select("name", "data", "records").mapInArrow(
        tidy(_reader), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, bundle string, frame int, offset int"
    )


def record_index(bundles: DataFrame) -> DataFrame:
    """(page_id, name, frame, offset): where every record stands. Bundles' data aren't read."""
    return bundles.select("name", F.explode("records").alias("at")).select("at.page_id", "name", "at.frame", "at.offset")


def _picker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for data, places in zip(batch.column(0), batch.column(1)):
            data, open_ = data.as_py(), {}
            for place in places.as_py():
                if place["frame"] not in open_:
                    open_ = {place["frame"]: read_frame(data, place["frame"])}
                headers, block, _ = parse(open_[place["frame"]], place["offset"])
                refers = headers.get("WARC-Refers-To")
                rows.append({"page_id": place["page_id"], "record_type": headers["WARC-Type"], "refers_to": int(refers[10:-1]) if refers else None, "payload": None if refers else block.split(b"\r\n\r\n", 1)[1]})
        kinds = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        yield pa.RecordBatch.from_pylist(rows, kinds)


def find_records(bundles: DataFrame, ids: DataFrame, key: str = "page_id") -> DataFrame:
    """(page_id, record_type, refers_to, payload) of the wanted ids: only their frames are decompressed; a revisit has no payload."""
    wanted = record_index(bundles).join(ids.select(F.col(key).cast("long").alias("page_id")).distinct(), "page_id", "left_semi")
    places = F.array_sort(F.collect_list(F.struct("frame", "offset", "page_id"))).alias("places")  # of one bundle: bounded by its bytes
    found = bundles.select("name", "data").join(wanted.groupBy("name").agg(places), "name")
    return found.select("data", "places").mapInArrow(tidy(_picker), "page_id long, record_type string, refers_to long, payload binary")
