"""Bytes that repeat: every 100-byte string of a corpus that also starts earlier, found by suffix arrays.

*Anchors.* Of the 53 strings of 48 bytes inside a window of 100 bytes, the one with the least hash
is the window's anchor. Equal windows have equal anchors at equal offsets, so only windows with one
anchor are ever compared, and windows that share an anchor's occurrence lie in one segment: the
bytes from the first window's start to the last one's end. Every window is in exactly one segment.

*Candidates.* Blocks of documents send their anchors' hashes to hash ranges, which answer where an
anchor has a second occurrence anywhere. Only those segments travel.

*Order.* Segments with one anchor meet in a lane. Equal ones count once, at their earliest place;
the suffix array of a lane (``suffix``) puts equal windows side by side, and all but the earliest of
them are repeats. A lane holds about 64 occurrences: an anchor with more has several lanes, dealt by
block, whose earliest windows are then compared by digest, up to 64 lanes at a time and the earliest of those again. So no lane, and
no comparison, grows with a passage's number of copies. A lane of one segment has nothing to order: its windows differ, since
each has the anchor at another offset.

*Removal.* Repeats go back to their blocks as ranges of bytes, whose union is removed.

Texts are read and shuffled once, compressed; the three steps that need them share that shuffle.

Cases: null text is empty; texts under 100 bytes lose nothing. "Earlier" is a smaller key or, in
one document, an earlier start; null keys come last, and rows with equal keys are documents of
their own in an arbitrary but fixed order. An empty table gives an empty result. Other columns
take no part, so nothing can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import pack, unpack
from .common import group_first, mix64, random_words, slices, text_bytes, tidy
from .suffix import _ranges, _turns, suffix_arrays

#: Bytes of a repeat, and of an anchor.
WINDOW, ANCHOR = 100, 48
#: Bytes of text in a block (a longer text is a block of its own); occurrences of an anchor in a lane; symbols sorted at once.
BLOCK, LANE, BATCH = 4_000_000, 64, 500_000
LEVEL = 3
#: Lanes whose earliest windows are compared at once.
TOGETHER = 64
#: Kinds of rows: a block's text, its request to a hash range, segments for a lane range, ranges of bytes to remove, an earliest window of a lane.
TEXT, REQUEST, SEGMENTS, REMOVED, EARLIEST = range(5)

_SHUFFLED = "part binary, kind int, block binary, place int, payload binary, keys array<long>"
_FIELDS = [("part", pa.binary()), ("kind", pa.int32()), ("block", pa.binary()), ("place", pa.int32()), ("payload", pa.binary()), ("keys", pa.list_(pa.int64()))]
_FOUND = "part binary, kind int, block binary, payload binary, at int, absent boolean, key long, doc int, again boolean"
_FOUND_FIELDS = [*[f for f in _FIELDS if f[0] in ("part", "kind", "block", "payload")], ("at", pa.int32()), ("absent", pa.bool_()), ("key", pa.int64()), ("doc", pa.int32()), ("again", pa.bool_())]


def _batch(rows: list[dict], fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(data)


def _loosen(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _split(values: np.ndarray) -> list[bytes]:
    """64-bit numbers as packed halves."""
    return [pack(values >> np.uint64(32)), pack(values & np.uint64(0xFFFFFFFF))]


def _merge(high: bytes, low: bytes) -> np.ndarray:
    return (unpack(high).astype(np.uint64) << np.uint64(32)) | unpack(low)


def _bundle(parts: list[bytes]) -> bytes:
    return np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _unbundle(blob: bytes) -> list[bytes]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(blob, "<u4", n, 4)) + 4 + 4 * n
    return [blob[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist())]


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``ANCHOR`` bytes from each position on: polynomials over doubled lengths."""
    base, length = random_words(17, 2)[1], 1
    powers = {1: int(base)}
    whole = {1: random_words(11, 256)[raw]}
    while 2 * length <= ANCHOR:
        h = whole[length]
        whole[2 * length] = h[:-length] * np.uint64(powers[length]) + h[length:]
        powers[2 * length] = powers[length] ** 2 % 2**64
        length *= 2
    out, done, n = np.zeros(len(raw) - ANCHOR + 1, np.uint64), 0, len(raw) - ANCHOR + 1
    for length in sorted(whole, reverse=True):
        if ANCHOR & length:
            out = out * np.uint64(powers[length]) + whole[length][done : done + n]
            done += length
    return mix64(out)


def segments(raw: np.ndarray, offsets: np.ndarray, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts, one after another, the first and the last window of each segment, and its anchor's hash.

    A chunk's windows carry their anchor's place in the low bits of its hash, so a running minimum finds both, the
    first of equal ones.
    """
    n, width = max(len(raw) - WINDOW + 1, 0), WINDOW - ANCHOR + 1
    anchor, hashes = np.zeros(n, np.int64), np.zeros(len(raw), np.uint64)
    bits = np.uint64((chunk + WINDOW).bit_length())
    places = np.uint64((1 << int(bits)) - 1)
    for a in range(0, n, chunk):
        b = min(a + chunk, n)
        own = _hashes(raw[a : b + WINDOW - 1])
        hashes[a : a + len(own)] = own
        least, reach = (own & ~places) | np.arange(len(own), dtype=np.uint64), 1
        while 2 * reach <= width:
            least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        anchor[a:b] = (least & places).astype(np.int64) + a
    long = np.diff(offsets) >= WINDOW
    windows = _ranges(offsets[:-1][long], offsets[1:][long] - WINDOW + 1)
    anchor = anchor[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    at = np.flatnonzero(new)
    return windows[at], windows[np.append(at[1:], len(windows))[: len(at)] - 1], hashes[anchor[at]]


def _ranged(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _blocks(ranges: int, most: int):
    """(key, text) to blocks and their requests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in slices(np.diff(offsets), most):
                keys, own, at = batch.column(0).slice(a, b - a).to_pylist(), raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                digest = hashlib.blake2b(own.tobytes(), digest_size=16)
                digest.update(repr((task, turn, keys, at.tolist())).encode())
                name, turn = digest.digest(), turn + 1
                text = _bundle([pack(np.diff(at)), _squeeze(own.tobytes())])
                rows = [{"part": name, "kind": TEXT, "block": name, "payload": text, "keys": keys}]
                found, counts = np.unique(segments(own, at)[2], return_counts=True)
                edges = np.searchsorted(_ranged(found, ranges), np.arange(ranges + 1)).tolist()
                for r, (x, y) in enumerate(zip(edges, edges[1:])):
                    if y > x:
                        steps = np.diff(found[x:y], prepend=np.uint64(0))
                        rows.append({"part": r.to_bytes(4), "kind": REQUEST, "block": name, "place": r, "payload": _bundle([*_split(steps), pack(counts[x:y])])})
                yield _batch(rows, _FIELDS)

    return run


def _repeated(lane: int):
    """Requests to answers: which of a block's anchors occur twice somewhere, and on how many lanes each."""
    return lambda batches: _answers(batches, lane)


def _answers(batches: Iterator[pa.RecordBatch], lane: int) -> Iterator[pa.RecordBatch]:
    names, places, hashes, counts = [], [], [], []
    for batch in batches:
        for kind, block, place, payload in zip(*(batch.column(i) for i in (1, 2, 3, 4))):
            if kind.as_py() == REQUEST:
                high, low, n = _unbundle(payload.as_py())
                names.append(block.as_py())
                places.append(place.as_py())
                hashes.append(np.cumsum(_merge(high, low), dtype=np.uint64))
                counts.append(unpack(n))
    if not names:
        return
    sizes = np.array([len(x) for x in hashes])
    flat, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts).astype(float), len(flat)).astype(np.int64)
    lanes = np.where(total > 1, -(-total // lane), 0)[inverse]
    for name, place, a, b in zip(names, places, (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()):
        at = np.flatnonzero(lanes[a:b])
        if len(at):
            yield pa.RecordBatch.from_pylist([{"part": name, "place": place, "payload": _bundle([pack(at), pack(lanes[a:b][at])])}], pa.schema([_FIELDS[0], _FIELDS[3], _FIELDS[4]]))


def _opened(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    lengths, text = _unbundle(payload)
    return np.frombuffer(_loosen(text), np.uint8), np.concatenate([[0], np.cumsum(unpack(lengths), dtype=np.int64)])


def _removed(name: bytes, starts: np.ndarray, ends: np.ndarray) -> dict:
    return {"part": name, "kind": REMOVED, "block": name, "payload": _bundle([pack(starts), pack(ends - starts)])}


def _sent(ranges: int, together: int):
    """Blocks with their answers to segments of repeated anchors, a bundle per lane range; of equal ones in a block the earliest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, name, payload, keys, answers in zip(*(batch.column(c) for c in ("kind", "block", "payload", "keys", "answers"))):
                if kind.as_py() != TEXT or not answers.is_valid:
                    continue
                name, keys = name.as_py(), keys.as_py()
                raw, offsets = _opened(payload.as_py())
                first, last, hashes = segments(raw, offsets)
                found, which = np.unique(hashes, return_inverse=True)
                lanes = np.zeros(len(found), np.int64)
                edges = np.searchsorted(_ranged(found, ranges), np.arange(ranges))
                for x in answers.as_py():
                    at, many = map(unpack, _unbundle(x["payload"]))
                    lanes[edges[x["place"]] + at] = many
                doc = np.searchsorted(offsets, first, "right") - 1
                rank = np.empty(len(keys), np.int64)
                rank[sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0, i))] = np.arange(len(keys))
                wanted = np.flatnonzero(lanes[which])
                wanted = wanted[np.lexsort((first[wanted], rank[doc[wanted]]))]
                text, seen, kept, copies = raw.tobytes(), set(), [], []
                for i, a, b in zip(wanted.tolist(), first[wanted].tolist(), (last[wanted] + WINDOW).tolist()):
                    piece = text[a:b]
                    if piece in seen:
                        copies.append(i)
                    else:
                        seen.add(piece)
                        kept.append(i)
                rows = []
                if copies:
                    copies = np.sort(np.array(copies))
                    rows.append(_removed(name, first[copies], last[copies] + WINDOW))
                kept = np.array(kept, np.int64)
                many = lanes[which[kept]].astype(np.uint64)
                salt = np.uint64(int.from_bytes(name[:8])) % many
                lane = mix64(hashes[kept] + salt * random_words(23, 1)[0])
                # 0 for an anchor of one lane; else 1 + twice the lanes that are compared with this one, and 1 more if there are others.
                split = np.where(many > 1, np.uint64(1) + np.uint64(2) * (salt // np.uint64(together)) + (many > together), 0).astype(np.int64)
                order = np.argsort(lane, kind="stable")
                kept, lane, split = kept[order], lane[order], split[order]
                cuts = np.searchsorted(_ranged(lane, ranges), np.arange(ranges + 1)).tolist()
                for r, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    if y > x:
                        own = kept[x:y]
                        a, b, d = first[own], last[own] + WINDOW, doc[own]
                        data = np.concatenate([raw[i:j] for i, j in zip(a.tolist(), b.tolist())])
                        parts = [*_split(lane[x:y]), pack(split[x:y]), pack(a), pack(b - a), pack(d), _squeeze(data.tobytes())]
                        rows.append({"part": r.to_bytes(4), "kind": SEGMENTS, "block": name, "payload": _bundle(parts), "keys": [keys[i] for i in d.tolist()]})
                if rows:
                    yield _batch(rows, _FIELDS)

    return run


def _earliest(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lane: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of distinct segments, given lane by lane and in order of place, as (segment, offset, whether an earlier one is equal).

    Lanes of like length are sorted together.
    """
    heads, many = _turns(lane)
    weight = np.add.reduceat(lengths + 1, heads) if len(heads) else heads
    by = np.argsort(weight, kind="stable")
    for x, y in slices(weight[by], BATCH):
        chosen = by[x:y]
        own = _ranges(heads[chosen], heads[chosen] + many[chosen])
        # A segment ends with a symbol below all bytes.
        size = lengths[own]
        ends = np.cumsum(size + 1)
        symbols = np.zeros(int(ends[-1]), np.int64)
        into = np.repeat(ends - size - 1, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        symbols[into] = data[_ranges(starts[own], starts[own] + size)].astype(np.int64) + 1
        order = suffix_arrays(symbols, np.concatenate([[0], np.cumsum(weight[chosen])]))
        segment = np.repeat(np.arange(len(own)), size + 1)[order]
        offset = order - (ends - size - 1)[segment]
        full = offset <= size[segment] - WINDOW
        segment, offset = segment[full], offset[full]
        at = starts[own[segment]] + offset
        # Neighbours in the order are equal if all their bytes are, eight at a time.
        same = np.flatnonzero(lane[own[segment[1:]]] == lane[own[segment[:-1]]]) + 1
        words = np.lib.stride_tricks.as_strided(data[: max(len(data) - 7, 0)], (max(len(data) - 7, 0), 8), (1, 1))
        for step in [*range(0, WINDOW - 8, 8), WINDOW - 8]:
            left, right = (np.ascontiguousarray(words[at[i] + step]).view("<u8").ravel() for i in (same - 1, same))
            same = same[left == right]
        opens = np.ones(len(at), bool)
        opens[same] = False
        group = np.cumsum(opens) - 1
        least = np.full(int(group[-1]) + 1 if len(group) else 0, len(lengths))
        np.minimum.at(least, group, own[segment])
        yield own[segment], offset, own[segment] != least[group]


def _lanes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments to ranges of repeated bytes by block, and the earliest windows of anchors with several lanes. Ranges pass."""
    blocks, bundles, keys = [], [], []
    for batch in batches:
        passing = []
        for kind, name, payload, own in zip(*(batch.column(c) for c in ("kind", "block", "payload", "keys"))):
            if kind.as_py() == SEGMENTS:
                blocks.append(name.as_py())
                bundles.append(_unbundle(payload.as_py()))
                keys += own.as_py()
            else:
                passing.append({"part": name.as_py(), "kind": REMOVED, "block": name.as_py(), "payload": payload.as_py()})
        if passing:
            yield _batch(passing, _FOUND_FIELDS)
    if not blocks:
        return
    lane, split, at, length, doc = (np.concatenate(x) for x in ([_merge(x[0], x[1]) for x in bundles], *[[unpack(x[i]) for x in bundles] for i in (2, 3, 4, 5)]))
    at, length, doc = at.astype(np.int64), length.astype(np.int64), doc.astype(np.int64)
    text = b"".join(_loosen(x[6]) for x in bundles)
    data = np.frombuffer(text, np.uint8)
    sizes = [len(unpack(x[2])) for x in bundles]
    del bundles
    block = np.repeat(np.arange(len(blocks)), sizes)
    absent = np.array([k is None for k in keys])
    key = np.array([k or 0 for k in keys], np.int64)
    name = np.argsort(np.argsort(np.array([int.from_bytes(x[:8]) for x in blocks], np.uint64), kind="stable"))[block]
    begin = np.cumsum(length) - length
    # Lane by lane, in order of place; a number is an order from here on.
    order = np.lexsort((at, doc, name, key, absent, lane))
    lane, split, at, length, doc, block, absent, key, begin = (x[order] for x in (lane, split, at, length, doc, block, absent, key, begin))
    first, seen = np.ones(len(lane), bool), set()
    new = np.append(True, lane[1:] != lane[:-1])
    for i, (opens, a, n) in enumerate(zip(new.tolist(), begin.tolist(), length.tolist())):
        if opens:
            seen.clear()
        piece = text[a : a + n]
        first[i] = piece not in seen
        seen.add(piece)
    segment = np.flatnonzero(first)
    alone = np.bincount(np.cumsum(new)[segment])[np.cumsum(new)[segment]] == 1
    held, starts, ends = [np.flatnonzero(~first)], [at[~first]], [(at + length)[~first]]
    several = segment[~alone]
    single = segment[alone & (split[segment] > 0)]
    windows = length[single] - WINDOW + 1
    found = [(np.repeat(single, windows), _ranges(0 * windows, windows), np.zeros(int(windows.sum()), bool))]
    for own, offset, repeats in chain(found, ((several[x], y, z) for x, y, z in _earliest(data, begin[several], length[several], lane[several]))):
        by = np.lexsort((offset, own))
        own, offset, repeats = own[by], offset[by], repeats[by]
        hit, shift = own[repeats], offset[repeats]
        x, n = _turns(shift - np.arange(len(shift)) + hit * (1 << 32))  # neighbouring windows of a segment
        held.append(hit[x])
        starts.append(at[hit[x]] + shift[x])
        ends.append(at[hit[x]] + shift[x] + n - 1 + WINDOW)
        open_ = np.flatnonzero(~repeats & (split[own] > 0))
        for some in range(0, len(open_), 10_000):
            rows = []
            for i, o in zip(own[open_[some : some + 10_000]].tolist(), offset[open_[some : some + 10_000]].tolist()):
                digest = hashlib.blake2b(text[begin[i] + o : begin[i] + o + WINDOW], digest_size=16).digest()
                row = {"part": digest + int(split[i] // 2).to_bytes(4), "kind": EARLIEST, "block": blocks[block[i]], "at": int(at[i]) + o}
                rows.append(row | {"absent": bool(absent[i]), "key": int(key[i]), "doc": int(doc[i]), "again": split[i] % 2 == 0})
            yield _batch(rows, _FOUND_FIELDS)
    held, starts, ends = np.concatenate(held), np.concatenate(starts), np.concatenate(ends)
    owner = block[held]
    by = np.lexsort((starts, owner))
    owner, starts, ends = owner[by], starts[by], ends[by]
    x, n = _turns(owner)
    for a, m in zip(x.tolist(), n.tolist()):
        yield _batch([_removed(blocks[owner[a]], starts[a : a + m], ends[a : a + m])], _FOUND_FIELDS)


def _of_kind(kind: int, names: list[str]):
    """Rows of one kind; in Python, so that the shuffle below is one for all kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.compute.equal(batch.column("kind"), kind)).select(names)

    return run


def _compared(again: bool):
    """Earliest windows of up to ``TOGETHER`` lanes, all in one partition: those that aren't the earliest of them or, with ``again``, the
    earliest of those that are to be compared with other lanes."""
    names = [("window", pa.binary()), ("block", pa.binary()), ("at", pa.int32()), ("absent", pa.bool_()), ("key", pa.int64()), ("doc", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.filter(pa.compute.equal(b.column("kind"), EARLIEST)) for b in batches]
        table = pa.Table.from_batches([b.drop_columns(["kind", "payload"]) for b in held if b.num_rows])
        table = table.sort_by([(c, "ascending") for c in ("part", "absent", "key", "block", "doc", "at")])
        code = table.column("part").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.ones(len(code), bool)
        first[1:] = code[1:] != code[:-1]
        chosen = table.filter(pa.array(first & table.column("again").to_numpy() if again else ~first))
        chosen = chosen.append_column("window", pa.compute.binary_slice(chosen.column("part").combine_chunks(), 0, 16)).select([n for n, _ in names])
        yield from chosen.cast(pa.schema(names)).to_batches()

    def guarded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [b for b in batches if pa.compute.any(pa.compute.equal(b.column("kind"), EARLIEST)).as_py()]
        return run(iter(some)) if some else iter(())

    return guarded


def _left(with_kept: bool):
    """Blocks with what is removed of them to a row per document."""
    names = [("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    names += [("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int64())))] if with_kept else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, payload, keys, ranges, windows in zip(*(batch.column(c) for c in ("kind", "payload", "keys", "ranges", "windows"))):
                if kind.as_py() != TEXT:
                    continue
                raw, offsets = _opened(payload.as_py())
                depth = np.zeros(len(raw) + 1, np.int32)
                found = [[unpack(y) for y in _unbundle(x)] for x in ranges.as_py() or []]
                single = np.array(windows.as_py() or [], np.int64)
                for starts, lengths in [*found, (single, np.full(len(single), WINDOW))]:
                    starts = starts.astype(np.int64)
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, starts + lengths, -1)
                gone = np.cumsum(depth[:-1]) > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                heads = offsets[:-1][np.diff(offsets) > 0]
                opens[heads] = gone[heads]
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (gone, opens)]
                removed, spans = (x[offsets[1:]] - x[offsets[:-1]] for x in sums)
                left = [raw[a:b][~gone[a:b]].tobytes() if n else raw[a:b].tobytes() for a, b, n in zip(offsets.tolist(), offsets[1:].tolist(), removed.tolist())]
                columns = [pa.array(keys.as_py(), pa.int64()), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), pa.array([hashlib.sha256(x).hexdigest() for x in left])]
                if with_kept:
                    closes = gone.copy()
                    closes[:-1] &= ~gone[1:]
                    tails = offsets[1:][np.diff(offsets) > 0] - 1
                    closes[tails] = gone[tails]
                    pairs = np.stack([np.flatnonzero(opens), np.flatnonzero(closes) + 1], 1)
                    places = np.searchsorted(offsets, pairs[:, 0], "right") - 1
                    cuts = np.searchsorted(places, np.arange(len(offsets)))
                    columns += [pa.array(left, pa.binary()), pa.array([(pairs[a:b] - o).tolist() for a, b, o in zip(cuts, cuts[1:], offsets)], names[-1][1])]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(names))

    return run


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", with_kept: bool = False, block: int = BLOCK, lane: int = LANE, together: int = TOGETHER) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row: what is left of a text without the bytes that a
    100-byte string covers which also starts earlier; on demand also the bytes left and the removed ranges [start, end). ``block``, ``lane`` and ``together`` are the sizes of blocks, lanes, and lanes compared at once."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    blocks = docs.mapInArrow(tidy(_blocks(ranges, block)), _SHUFFLED).repartition(ranges, "part")
    answers = blocks.mapInArrow(tidy(_repeated(lane)), "part binary, place int, payload binary")
    answers = answers.groupBy("part").agg(F.collect_list(F.struct("place", "payload")).alias("answers"))
    sent = blocks.join(answers, "part", "left").mapInArrow(tidy(_sent(ranges, together)), _SHUFFLED).repartition(ranges, "part")
    found = sent.mapInArrow(tidy(_lanes), _FOUND).repartition(ranges, "part")
    whole = found.mapInArrow(_of_kind(REMOVED, ["part", "payload"]), "part binary, payload binary").groupBy("part").agg(F.collect_list("payload").alias("ranges"))
    names = "window binary, block binary, at int, absent boolean, key long, doc int"
    later = found.mapInArrow(tidy(_compared(False)), names).select("block", "at")
    again = found.mapInArrow(tidy(_compared(True)), names).select("window", F.struct("absent", "key", "block", "doc", "at").alias("place"))
    again = group_first(again, ["window"], "place", "first").where("place != first").select("place.block", "place.at")
    single = later.unionByName(again).groupBy(F.col("block").alias("part")).agg(F.collect_list("at").alias("windows"))
    kinds = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<array<long>>" * with_kept
    return blocks.join(whole, "part", "left").join(single, "part", "left").mapInArrow(tidy(_left(with_kept)), kinds).withColumnRenamed("key", key)
