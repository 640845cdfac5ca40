"""Periodic runs of words, found with a dictionary of basic factors.

The words of a text are numbered, and so are, for every power of two, its factors of that many
words: equal factors have equal numbers. A period q with 2^k <= q < 2^(k+1) shows in the
factors of 2^k words: the one at a run's start occurs again q words on. Occurrences that far
away, from 2^k to 2^(k+1) - 1 words on, form one arithmetic progression. Up to two of them
are all proposed as periods. Of three or more, whose step d is a period of the factor, only two can be
the period of a run that starts here: the first, or the one whose stretch of period d ends as far from
it as the stretch at the start does. What is proposed is extended by comparing factors, and dropped if it
could start earlier, so every run is found once, by its first word; the least period stays.

A factor that occurs once in its text is never numbered, nor are those that begin with it, so
ordinary prose leaves the dictionary after a few lengths.

Texts are independent, so no row is shuffled; a task works on blocks of neighbouring texts.

Cases: null and empty texts have no words and no runs; a very long text is a block of its own;
repeated rows and null keys count each for themselves; an empty table gives an empty result. Other
columns take no part, so nothing can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, tidy

#: Bytes of text in a block.
BLOCK = 2_000_000
#: Shortest run, in words.
LEAST = 12


class Factors:
    """Numbers of the factors of 1, 2, 4, .. words of some texts: equal numbers, equal factors of one text.

    ``words`` are numbers of words, ``ends`` the end of each position's text. A number below 0 stands for a factor that occurs once.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        self.n = len(words)
        self.levels: list[np.ndarray] = []
        #: Per level: positions with a number, by number and position, as one sorted key.
        self.places: list[np.ndarray] = []
        keys, at = words.astype(np.int64) * (self.n + 1) + ends, np.arange(self.n)
        while len(at):
            level, places = self._numbered(keys, at)
            self.levels.append(level)
            self.places.append(places)
            size = 1 << (len(self.levels) - 1)
            at = np.sort(places % (self.n + 1))
            at = at[at + 2 * size <= ends[at]]
            at = at[level[at + size] >= 0]
            keys = level[at] * (self.n + 1) + level[at + size]

    def _numbered(self, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        number = np.cumsum(new) - 1
        several = (np.bincount(number) > 1)[number]
        at, number = at[several], number[several]
        level = -1 - np.arange(self.n)
        level[at] = number
        return level, number * (self.n + 1) + at

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from each of ``a`` and ``b`` (different positions of one text) on."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = np.append(self.levels[k], -self.n - 2)
            # A longest factor may fit more than once.
            while True:
                same = (a < self.n) & (b < self.n)
                same &= level[np.minimum(a, self.n)] == level[np.minimum(b, self.n)]
                if not same.any():
                    break
                step = same.astype(np.int64) << k
                a, b, out = a + step, b + step, out + step
                if k < len(self.levels) - 1:
                    break
        return out


def proposals(factors: Factors) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods that a run may start with."""
    starts, periods = [], []
    for k, places in enumerate(factors.places):
        size, base = 1 << k, factors.n + 1
        at = places % base
        low = np.searchsorted(places, places + size)
        # Numbers are apart by n + 1, so a key beyond a number's own positions never reaches the next number's.
        high = np.searchsorted(places, places - at + np.minimum(at + 2 * size, factors.n))
        count = np.maximum(high - low, 0)
        one = count > 0
        at, low, count = at[one], low[one], count[one]
        first = places[low] % base
        starts.append(at)
        periods.append(first - at)
        two = count == 2
        starts.append(at[two])
        periods.append(places[low[two] + 1] % base - at[two])
        many = count > 2
        at, first, low = at[many], first[many], low[many]
        step = places[low + 1] % base - first
        q = first + factors.common(first, first + step) - at - factors.common(at, at + step)
        fits = (q >= size) & (q < 2 * size)
        starts.append(at[fits])
        periods.append(q[fits])
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, periods))


def find(words: np.ndarray, counts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and least period of every run of the texts, by start and then period. Texts have ``counts`` words each, one after another."""
    stops = np.cumsum(counts)
    ends, begins = np.repeat(stops, counts), np.repeat(stops - counts, counts)
    factors = Factors(words, ends)
    start, q = proposals(factors)
    inside = start + q < ends[start]
    start, q = start[inside], q[inside]
    opens = (start == begins[start]) | (words[start - 1] != words[start - 1 + q])
    start, q = start[opens], q[opens]
    length = q + factors.common(start, start + q)
    long = length >= np.maximum(least, 2 * q)
    start, q, length = start[long], q[long], length[long]
    order = np.lexsort((q, length, start))
    start, q, length = start[order], q[order], length[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, q, length = start[keep], q[keep], length[keep]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of the texts, one after another, and their number in each."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)  # white space at a text's ends leaves empty pieces
    owner = np.repeat(np.arange(len(sizes)), sizes)[full.to_numpy(zero_copy_only=False)]
    return flat.filter(full), np.bincount(owner, minlength=len(sizes))


def _joined(words: pa.Array, counts: np.ndarray) -> list[bytes]:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return [x.encode() for x in pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ").to_pylist()]


def _described(keys: pa.Array, texts: pa.Array, least: int, with_all: bool, schema: pa.Schema) -> pa.RecordBatch:
    words, counts = _split(texts)
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int32)
    start, length, period = find(numbers, counts, least)
    stops = np.cumsum(counts)
    owner = np.searchsorted(stops, start, "right")
    depth = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    kept = np.cumsum(depth[:-1]) == 0
    left = np.bincount(np.repeat(np.arange(len(counts)), counts)[kept], minlength=len(counts))
    collapsed = _joined(words.filter(pa.array(kept)), left)
    start = start - (stops - counts)[owner]
    cuts = np.searchsorted(owner, np.arange(len(counts) + 1)).tolist()
    rows = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        runs = list(zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist()))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        row = {"n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2], "exponent_milli": 1000 * best[1] // best[2] if runs else None}
        row["runs_sha256"] = hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest()
        row["collapsed_sha256"] = hashlib.sha256(collapsed[i]).hexdigest()
        rows.append(row | ({"runs": [list(r) for r in runs], "collapsed": collapsed[i].decode()} if with_all else {}))
    columns = [keys, *[pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[1:]]]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _schema(with_all: bool) -> pa.Schema:
    names = [("key", pa.int64()), *[(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
    return pa.schema(names + ([("runs", pa.list_(pa.list_(pa.int64()))), ("collapsed", pa.string())] if with_all else []))


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, with_all: bool = False) -> DataFrame:
    """(key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row; on demand also
    all runs [start, length, period] and the text without the words that a run repeats.

    A run is a stretch of ``least`` words or more that holds its smallest period twice and can't be extended. The run
    shown is the longest, of equal ones that of the smallest start, then period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, BLOCK):
                yield _described(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), least, with_all, _schema(with_all))

    kinds = "key long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return docs.mapInArrow(tidy(run), kinds + ", runs array<array<long>>, collapsed string" * with_all).withColumnRenamed("key", key)
