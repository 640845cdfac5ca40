"""Near-duplicate components: banded MinHash, odd sketches, exact confirmation.

1. One pass over the texts gives per document the number of distinct word
   shingles, a 128-bit digest of the set, 128 MinHash values folded into 32 band
   keys, and an odd sketch: a 512-bit parity bitmap of the MinHash samples.
2. Documents with equal sets form classes; only a class's smallest id goes on.
3. In every band bucket all members are held against the bucket's smallest id.
   Such a pair survives if the sizes allow the similarity and the sketches'
   XOR population count doesn't exclude it, and is then confirmed on full sets.
   A text that is held against many is sent once to each of the tasks that share them.
4. Links give components. Two members of one smallest id that still stand in
   different components, one of them not linked to it, are held against each
   other too, so that no link is lost. What keeps this from pairing up a whole
   hot group is a bound: two members share at most those of the smallest id's
   shingles that both have, and of their others those that occur in several
   members; what a member has alone also limits the sizes of its partners.

A pair at the threshold shares no bucket with probability (1 - t^4)^32: 6e-11 at
0.85, 5e-8 at 0.8. The sketch test leaves out a pair at the threshold only when
the samples disagree by seven standard deviations more than expected.

Cases: null or blank text has an empty set and stands alone; with fewer words than
a shingle has, the whole sequence is the one shingle; repeated rows and equal sets
share a class; where an id comes with several texts, the one with the least hash
stands for the id, whose component all its rows get, each with its own number of
shingles; null ids can't be linked and stand alone; an empty table gives an empty
result; input columns named like an output column are replaced, others never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, group_first, mix64, random_words, segment_hashes, slices, stored, text_bytes, tidy
from .components import components

SAMPLES, BANDS, SKETCH_BITS = 128, 32, 512
#: Bytes of text that are hashed together.
BLOCK = 2_000_000
#: Texts that a task holds against one; salts of a band bucket, one bit each in a long.
HELD, SALTS = 500, 64
#: Growth of shingle counts from one size class to the next.
CLASS_STEP = 1.05

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and the n + 1 offsets."""
    texts = len(offsets) - 1
    inside = ~_SPACE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~first[:-1] if len(raw) else inside
    after = np.concatenate([inside[1:], [False]]) & ~first[1:] if len(raw) else inside
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = segment_hashes(_LOWER[raw], starts, ends, 11)
    doc = np.searchsorted(offsets, starts, "right") - 1
    count = np.bincount(doc, minlength=texts)
    begin = np.cumsum(count) - count
    weights = random_words(12, words)
    n = max(0, len(hashes) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(words):
        rolled += hashes[i : i + n] * weights[i]
    rolled = mix64(rolled)
    whole = doc[:n] == doc[words - 1 : words - 1 + n]
    per = np.maximum(count - words + 1, 0)
    short = np.flatnonzero((count > 0) & (count < words))
    sizes = per.copy()
    sizes[short] = 1
    at = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint64)
    full = np.flatnonzero(per)
    if len(full):
        lengths = per[full]
        out[np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(at[full], lengths)] = rolled[whole]
    for i in short.tolist():
        few = hashes[begin[i] : begin[i] + count[i]]
        out[at[i]] = mix64((few * weights[: len(few)]).sum(keepdims=True) + np.uint64(len(few)))[0]
    for a, b in zip(at.tolist(), (at + sizes).tolist()):
        out[a:b].sort()
    owner = np.repeat(np.arange(texts), sizes)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[keep], minlength=texts)
    return out[keep], np.concatenate([[0], np.cumsum(sizes)])


def _signatures(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Digests, band keys and sketches of the non-empty sets."""
    starts = at[:-1][at[1:] > at[:-1]]
    digest = [np.add.reduceat(mix64(sets ^ np.uint64(salt)), starts) for salt in (0x1F, 0x2E00000000)]
    low = (sets >> np.uint64(20)).astype(np.uint32)
    factors, shifts = random_words(13, SAMPLES).astype(np.uint32), (random_words(14, SAMPLES) >> np.uint64(32)).astype(np.uint32)
    least = np.empty((SAMPLES, len(starts)), np.uint32)
    for i in range(SAMPLES):
        least[i] = np.minimum.reduceat(low * factors[i] + shifts[i], starts)
    each = SAMPLES // BANDS
    keys = np.zeros((BANDS, len(starts)), np.uint64)
    for j in range(each):
        keys = mix64(keys + least[j::each].astype(np.uint64) + random_words(15, BANDS)[:, None])
    bit = mix64(least.astype(np.uint64) + random_words(16, SAMPLES)[:, None]) % np.uint64(SKETCH_BITS)
    parity = np.bincount((bit.astype(np.int64) + np.arange(len(starts)) * SKETCH_BITS).ravel(), minlength=len(starts) * SKETCH_BITS) & 1
    sketch = np.packbits(parity.astype(np.uint8).reshape(-1, SKETCH_BITS), axis=1).view(np.int64)
    return digest[0].view(np.int64), digest[1].view(np.int64), np.ascontiguousarray(keys.T).view(np.int64), sketch


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))


def signatures(texts: DataFrame, words: int) -> DataFrame:
    """(id, text, mark) to (id, mark, n, set_a, set_b, bands, sketch); bands and sketch are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in slices(np.diff(offsets), BLOCK):
                sets, at = shingle_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                some = np.flatnonzero(np.diff(at))
                to = pa.array(np.where(np.diff(at) > 0, np.cumsum(np.diff(at) > 0) - 1, 0), mask=np.diff(at) == 0)
                if len(some):
                    first, second, bands, sketch = _signatures(sets, at)
                    parts = [pa.array(first).take(to), pa.array(second).take(to), _lists(bands).take(to), _lists(sketch).take(to)]
                else:
                    parts = [pa.nulls(b - a, t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
                names = [batch.column(i).slice(a, b - a) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays([*names, pa.array(np.diff(at)), *parts], ["id", "mark", "n", "set_a", "set_b", "bands", "sketch"])

    return texts.select("id", "text", "mark").mapInArrow(tidy(run), "id long, mark long, n long, set_a long, set_b long, bands array<long>, sketch array<long>")


def _confirmed(words: int):
    """Rows (a, b, text), each ``a``'s own (b null) before those held against it, to a row per pair."""

    def pair(own: np.ndarray, other: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        place = np.searchsorted(own, other)
        same = own[np.minimum(place, len(own) - 1)] == other if len(own) else np.zeros(len(other), bool)
        bits = np.zeros(-(-len(own) // 64) * 64, np.uint8)
        bits[place[same]] = 1
        return int(same.sum()), (other[~same] >> np.uint64(32)).astype(np.uint32).view(np.int32), np.packbits(bits).view(np.int64)

    def lists(parts: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32), pa.array(np.concatenate(parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = np.zeros(0, np.uint64), None
        for batch in batches:
            ids, others = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            raw, offsets = text_bytes(batch.column(2))
            for x, y in slices(np.diff(offsets), BLOCK):
                sets, at = shingle_sets(raw[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x], words)
                rows = []
                for i in range(x, y):
                    one = sets[at[i - x] : at[i - x + 1]]
                    if others[i] is None:
                        own = one.copy()
                    elif (ids[i], others[i]) != last:  # a repeated row
                        rows.append((ids[i], others[i], len(own), len(one), *pair(own, one)))
                    last = ids[i], others[i]
                if rows:
                    a, b, n_a, n_b, common, extra, present = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(v, pa.int64()) for v in (a, b, n_a, n_b, common)), lists(extra), lists(present)],
                        ["a", "b", "n_a", "n_b", "common", "extra", "present"],
                    )

    return run


def counted(pairs: DataFrame, name: str) -> DataFrame:
    """``pairs`` (a, b), written, with ``members``, the number of pairs of each ``a``.

    Pairs and counts are both read from files when they meet, so that Spark can split a hot ``a``.
    """
    pairs = stored(pairs, name)
    return pairs.join(stored(pairs.groupBy("a").agg(F.count("*").alias("members")), f"{name}-counts"), "a")


def confirmed(pairs: DataFrame, texts: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """(a, b, members) to (a, b, n_a, n_b, common, extra, present): sizes of the full sets and of their
    intersection, short hashes of b's shingles that a lacks, and a bit for each of a's that b has.

    ``chosen`` has the mark of the text that stands for each id. Texts are shuffled once to find their
    pairs; an ``a`` with many of them is dealt to as many tasks as keep ``HELD`` pairs in each.
    """
    pairs = pairs.select("a", "b", F.ceil(F.col("members") / HELD).cast("int").alias("tasks"))
    held = pairs.select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("task"), "b")
    own = pairs.select("a", "tasks").distinct().select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(None).cast("long").alias("b"))
    wanted = held.unionByName(own).join(chosen, "id")
    rows = texts.join(wanted, ["id", "mark"]).select("a", "task", "b", "text")
    rows = rows.repartition("a", "task").sortWithinPartitions("a", "task", F.asc_nulls_first("b"))
    return rows.select("a", "b", "text").mapInArrow(tidy(_confirmed(words)), "a long, b long, n_a long, n_b long, common long, extra array<int>, present array<long>")


def bucket_pairs(heads: DataFrame) -> DataFrame:
    """(id, bands) to (a, b): every member of a band bucket with the bucket's smallest id.

    Least ids are found per salt and then among salts, and come back to members by band and salt, so that a
    bucket of any size is spread.
    """
    bands = heads.select("id", F.explode("bands").alias("band")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    bands = bands.repartition("band", "salt")
    parts = bands.groupBy("band", "salt").agg(F.min("id").alias("a"), F.count("*").alias("members"))
    buckets = parts.groupBy("band").agg(F.min("a").alias("a"), F.sum("members").alias("members"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")).where("members > 1")
    used = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.col("salts").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s)) != 0)
    buckets = buckets.select("band", "a", F.explode(used).alias("salt"))
    return bands.join(buckets, ["band", "salt"]).where("id != a").select("a", F.col("id").alias("b")).distinct()


def _near(common: str, a: str, b: str, percent: int) -> Column:
    """100 x intersection >= percent x union, in whole numbers."""
    return F.expr(f"(100 + {percent}) * {common} >= {percent} * ({a} + {b})")


def _possible(a: str, b: str, percent: int) -> Column:
    """Sizes and sketches don't exclude the pair; columns n_ and sketch_ of both."""
    t = percent / 100
    limit = int(2 * (SAMPLES * (1 - t) + 7 * (SAMPLES * t * (1 - t)) ** 0.5))
    differ = " + ".join(f"bit_count(sketch_{a}[{i}] ^ sketch_{b}[{i}])" for i in range(SKETCH_BITS // 64))
    return F.expr(f"100 * least(n_{a}, n_{b}) >= {percent} * greatest(n_{a}, n_{b}) and {differ} <= {limit}")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with n_shingles, component_id and kept: documents linked, directly or through
    others, by a Jaccard similarity of ``percent`` hundredths or more over ``words``-word shingles."""
    rows, names, given = aside(df, ("n_shingles", "component_id", "kept"))
    rows = rows.withColumns({"id": F.col(names[key]).cast("long"), "mark": F.xxhash64(names[text])})
    texts = rows.select("id", F.col(names[text]).cast("string").alias("text"), "mark")
    signed = stored(signatures(texts, words), "signatures")
    # The text that stands for an id, and the classes of equal sets.
    chosen = signed.where("id is not null").groupBy("id").agg(F.min(F.struct("mark", "n", "set_a", "set_b")).alias("s")).select("id", "s.*")
    classes = group_first(chosen.where("n > 0"), ["n", "set_a", "set_b"], "id", "class").select("id", "mark", "class")
    classes = stored(classes, "classes")
    chosen = classes.select("id", "mark")
    heads = signed.join(classes.where("id = class").select("id", "mark"), ["id", "mark"], "left_semi").dropDuplicates(["id"])
    pairs = counted(bucket_pairs(heads), "buckets")
    sides = stored(heads.select("id", "n", "sketch"), "sides")

    def side(name: str) -> DataFrame:
        return sides.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    pairs = pairs.join(side("b"), "b").join(side("a"), "a")
    # What these tests exclude can't be a link. Where ``a`` has other members its overlap is still wanted below.
    several = F.col("members") > 1
    pairs = pairs.where(_possible("a", "b", percent) | several).select("a", "b", "members", "n_b", "sketch_b", several.alias("several"))
    pairs = stored(pairs, "pairs")
    held = stored(confirmed(pairs, texts, chosen, words), "held")
    links = held.where(_near("common", "n_a", "n_b", percent)).select("a", "b")
    found = stored(components(links), "components")

    label = found.select(F.col("node"), F.col("component"))

    def labelled(rows: DataFrame, node: str, name: str) -> DataFrame:
        return rows.join(label.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))

    # Shingles of a member that neither ``a`` nor another of its members has.
    lone = held.select("a", "b", F.explode("extra").alias("s")).groupBy("a", "s").agg(F.count("*").alias("times"), F.min("b").alias("b")).where("times = 1").groupBy("a", "b").agg(F.count("*").alias("lone"))
    members = pairs.where("several").select("a", "b", F.col("n_b").alias("n"), F.col("sketch_b").alias("sketch")).join(lone, ["a", "b"], "left").na.fill(0, ["lone"])
    members = members.join(held.select("a", "b", (F.col("n_b") - F.col("common")).alias("other"), "present"), ["a", "b"])
    members = stored(labelled(labelled(members, "b", "label"), "a", "label_a"), "members")
    step = F.lit(float(np.log(CLASS_STEP)))
    outer = members.where("label != label_a").withColumn("most", F.expr(f"least(floor(n * 100 / {percent}), floor((100 + {percent}) * (n - lone) / {percent}) - n)"))
    outer = outer.withColumn("fewest", F.expr(f"ceil(n * {percent} / 100)")).where("most >= fewest and most > 0")
    low, high = F.floor(F.log(F.greatest("fewest", F.lit(1))) / step), F.floor(F.log("most") / step)

    def part(rows: DataFrame, name: str, classes: Column) -> DataFrame:
        kept = [F.col(c).alias(f"{c}_{name}") for c in ("n", "sketch", "lone", "label", "other", "present")]
        return rows.select("a", F.col("b").alias(name), *kept, classes.alias("class"))

    outer = part(outer, "x", F.explode(F.sequence(low, high)))
    inner = part(members, "y", F.floor(F.log("n") / step))
    shared = "aggregate(zip_with(present_x, present_y, (p, q) -> bit_count(p & q)), 0, (s, v) -> s + v)"
    overlap = F.expr(f"(100 + {percent}) * ({shared} + least(other_x - lone_x, other_y - lone_y)) >= {percent} * (n_x + n_y)")
    bound = F.expr(f"(100 + {percent}) * least(n_x - lone_x, n_y - lone_y) >= {percent} * (n_x + n_y)")
    test = F.expr("label_x != label_y") & bound & _possible("x", "y", percent) & overlap
    rest = outer.join(inner, (outer["a"] == inner["a"]) & (outer["class"] == inner["class"]) & test)
    rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    more = confirmed(counted(rest, "rest"), texts, chosen, words).where(_near("common", "n_a", "n_b", percent)).select("a", "b")
    more = labelled(labelled(more, "a", "la"), "b", "lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = components(more).select(F.col("node").alias("component"), F.col("component").alias("joined"))

    out = classes.join(label.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    out = out.join(joined, "component", "left").select("id", F.coalesce("joined", "component").alias("component"))
    sizes = signed.groupBy("id", "mark").agg(F.max("n").alias("n_shingles"))
    found = sizes.join(out, "id", "left").select(F.col("id").alias("id_"), F.col("mark").alias("mark_"), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_")), "left")
    return rows.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).select(*given, "n_shingles", "component_id", "kept")
