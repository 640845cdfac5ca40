"""Mixing sources to target weights by systematic sampling.

Within a source every document expects ``target / source_size`` copies (2 at
most). The running sum of the expected copies, shifted by one offset in [0, 1), emits a
copy each time it crosses an integer. Documents stand in the order largest, smallest,
next largest, next smallest .., so that what large ones take is made up for at once.

Which of a source's documents an offset takes is chance, and in a small source so is the number of
words. So the offset is one of 256 that the seed stands for: the one whose words come nearest
to the source's target (of equally near ones the smallest). A document's copies change at two of
them at most, so what each would take is a sum of changes, a few hundred rows per source.

The running sum needs each row's rank in its source. No window sees a whole
source: ranks are added up over the digits of the size (words div 256, words div
4, words with id mod 64), each window holding a bounded number of counts, and
only rows of one (source, size, id mod 64) are numbered together.

Cases: null text has size 0; the null source is a source, last in order; a source
without words has target 0 and takes nothing; of equal ids each row counts for
itself, and null ids are dealt by their texts; an empty table gives an empty result;
input columns named like an output column are replaced, others never clash. Windows over
all sources have a row per source: sources are taken to be few (thousands).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, aside, stored, text_or_empty

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix takes this share of all words, and of a source at most ``MOST`` times its words.
SHARE, MOST = 1.5, 2.0
OUTPUTS = ("size", "source_size", "target", "copies", "taken")
#: Offsets that a source may have.
OFFSETS = 256
#: Parts that rows of one size are dealt to.
PARTS = 64


def offset(seed: int) -> float:
    """The random offset in [0, 1) that a seed stands for."""
    return int.from_bytes(hashlib.sha256(str(seed).encode()).digest()[:4], "big") / 2**32


def place(rank: Column, rows: Column) -> Column:
    """Place of the ``rank``-th smallest of a source's documents in the order largest, smallest, next largest, .."""
    return F.when(2 * rank > rows, 2 * (rows - rank) + 1).otherwise(2 * rank)


def offsets(cells: DataFrame, seed: int) -> DataFrame:
    """(name, none, u): each source's offset. ``cells`` has name, none, size, rows of that size, those ahead of them, all_rows, each and target."""
    shift = offset(seed)
    at = lambda k: (k + F.lit(shift)) / OFFSETS
    held = cells.where("size > 0").select("name", "none", "size", "all_rows", "each", "target", F.explode(F.sequence(F.col("ahead") + 1, F.col("ahead") + F.col("rows"))).alias("rank"))
    held = held.withColumn("b", place(F.col("rank"), F.col("all_rows")) * F.col("each")).withColumn("a", (place(F.col("rank"), F.col("all_rows")) - 1) * F.col("each"))

    def crossing(x: Column) -> Column:
        """The first offset that lifts x over an integer."""
        over = lambda k: F.floor(x + at(k)) > F.floor(x)
        guess = F.ceil((1 - (x - F.floor(x))) * OFFSETS - shift)
        return F.when(over(guess - 1), guess - 1).when(over(guess), guess).otherwise(guess + 1)

    changes = F.array(
        F.struct(F.lit(0).cast("long").alias("k"), ((F.floor("b") - F.floor("a")) * F.col("size")).alias("words")),
        F.struct(crossing(F.col("b")).alias("k"), F.col("size").alias("words")), F.struct(crossing(F.col("a")).alias("k"), (-F.col("size")).alias("words")),
    )
    sums = held.select("name", "none", "target", F.explode(changes).alias("c")).where(F.col("c.k") < OFFSETS)
    sums = sums.groupBy("name", "none", F.greatest(F.col("c.k"), F.lit(0)).alias("k")).agg(F.sum("c.words").alias("words"), F.max("target").alias("target"))
    taken = F.sum("words").over(Window.partitionBy("name", "none").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    near = sums.withColumn("taken", taken).groupBy("name", "none").agg(F.min_by("k", F.struct(F.abs(F.col("taken") - F.col("target")), F.col("k"))).alias("k"))
    return near.select("name", "none", at(F.col("k")).alias("u"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target): one row per source.

    Resharing what stopped sources leave until none is above its limit gives each
    source the lesser of its limit and weight x level. Sources sorted by limit /
    weight stop one after another, so the level follows from prefix sums.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("turn", F.row_number().over(order) - 1).withColumn("weight", weight)
    rows = rows.withColumn("most", F.col("source_size") * F.lit(most))
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), "turn")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    rows = rows.withColumn("level", level).withColumn("free", F.col("weight") * F.col("level") <= F.col("most"))
    final = F.min(F.when(F.col("free"), F.struct((F.col("most") / F.col("weight")).alias("at"), "turn", "level"))).over(everything)["level"]
    return rows.withColumn("final", final).select(
        "source", "source_size", F.least("most", F.coalesce(F.col("weight") * F.col("final"), F.col("most"))).alias("target")
    )


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``df`` with size, source_size, target, copies and taken (copies x size)."""
    rows, names, given = aside(df, OUTPUTS)
    key, text, source = names[key], names[text], names[source]
    # A null id's part follows from its text.
    part = F.pmod(F.coalesce(F.col(key), F.xxhash64(text)), F.lit(PARTS)).cast("int")
    rows = rows.withColumns({"size": F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long"), "name": F.coalesce(F.col(source), F.lit("")), "none": F.col(source).isNull(), "part": part, "mark": F.xxhash64(text)})

    one, high, top = ["name", "none", "size", "part"], ["name", "none", "high"], ["name", "none", "top"]
    # Written, since totals, targets and each digit's sums are read from it: words are counted here, and once more for the rows themselves.
    cells = stored(rows.groupBy(*one).agg(F.count("*").alias("rows")), "cells")
    cells = cells.withColumns({"high": F.floor(F.col("size") / 4), "top": F.floor(F.col("size") / 256)})
    highs = cells.groupBy(*high, "top").agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("size")).alias("words"))
    tops = highs.groupBy(*top).agg(F.sum("rows").alias("rows"), F.sum("words").alias("words"))
    totals = tops.groupBy("name", "none").agg(F.sum("words").alias("source_size"), F.sum("rows").alias("all_rows"))
    targets = source_targets(totals.select(F.when(~F.col("none"), F.col("name")).alias("source"), "source_size"), weights, share, most)
    targets = targets.select(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"), "source_size", "target")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.join(totals.drop("source_size"), ["name", "none"]).withColumn("each", each)

    def earlier(order: list[str], within: list[str]):
        window = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("rows").over(window), F.lit(0))

    tops = tops.withColumn("ahead", earlier(["top"], ["name", "none"])).drop("rows", "words").join(targets, ["name", "none"])
    highs = highs.withColumn("more", earlier(["high"], top)).drop("rows", "words").join(tops, top)
    highs = highs.withColumn("ahead", F.col("ahead") + F.col("more")).drop("more", "top")
    cells = cells.withColumn("more", earlier(["size", "part"], high)).drop("top").join(highs, high)
    cells = stored(cells.withColumn("ahead", F.col("ahead") + F.col("more")).drop("more", "high"), "ranks")
    # Offsets go to every part, so that a hot source isn't joined in one task; a source without words has none.
    each_part = offsets(cells, seed).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    cells = cells.join(each_part, ["name", "none", "part"], "left").drop("rows").na.fill(0.0, ["u"])

    numbered = rows.withColumn("at", F.row_number().over(Window.partitionBy(*one).orderBy(key, "mark")))
    out = numbered.join(cells, one).withColumn("rank", F.col("ahead") + F.col("at"))
    at = place(F.col("rank"), F.col("all_rows"))
    copies = F.floor(at * F.col("each") + F.col("u")) - F.floor((at - 1) * F.col("each") + F.col("u"))
    out = out.withColumn("copies", F.least(copies, F.lit(int(most))).cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*given, *OUTPUTS)
