"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots (thousands, however large the
table). Bytes are aggregated per slot, and a small versioned map sends slots to
shards: version 1 deals whole slots, later versions are edits of the one before, so
a rebalance moves whole slots and never rehashes records.

Everything that grows with the data is a DataFrame aggregate keyed by slot; the
map has ``slots`` rows whatever the input, which bounds its broadcast.
Rebalancing (``rebalanced_map``) and growth (``grown_map``) write the next version.

Cases: null text has no bytes and still takes ``overhead``; null keys share one
slot; repeated rows are placed each for itself; an empty table gives an empty
placement; input columns named like an output column (size, virtual_slot, shard, slot,
version) are replaced, others never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import aside, shared_dir, stored, text_or_empty

#: Virtual slots; fixed for the life of a data set.
SLOTS = 8192
#: Bytes that a record takes besides its text.
OVERHEAD = 16


def with_slot(df: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS, overhead: int = OVERHEAD) -> DataFrame:
    """``df`` with ``size`` (UTF-8 bytes plus ``overhead``) and ``virtual_slot``."""
    return df.withColumn("size", (F.octet_length(text_or_empty(text)) + overhead).cast("long")).withColumn(
        "virtual_slot", F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")
    )


def slot_bytes(sized: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows per virtual slot, empty slots included: (virtual_slot, slot_bytes, slot_rows)."""
    used = sized.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))
    every = sized.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(used), "virtual_slot", "left").na.fill(0)  # used has ``slots`` rows at most


def _by_weight(stats: DataFrame, weight: str) -> Column:
    """All slots as one array, the heaviest first: ``slots`` entries, a size that does not depend on the data."""
    own = [F.col("own")] if "own" in stats.columns else []
    return F.array_sort(F.collect_list(F.struct((-F.col(weight)).alias("less"), "virtual_slot", *own)))


def _exploded(placed: DataFrame, version: Column) -> DataFrame:
    pairs = placed.select(version.alias("version"), F.explode(F.arrays_zip(F.col("slots.virtual_slot").alias("virtual_slot"), F.col("to"))).alias("p"))
    return pairs.select("version", F.col("p.virtual_slot").alias("virtual_slot"), F.col("p.to").alias("shard"))


def first_map(stats: DataFrame, shards: int, weight: str = "slot_bytes") -> DataFrame:
    """Version 1: the heaviest slot first, each to the shard with the least so far."""
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"), F.array().cast("array<int>").alias("to"))

    def place(state, slot):
        least = F.array_position(state["load"], F.array_min(state["load"])).cast("int") - 1
        load = F.transform(state["load"], lambda x, i: F.when(i == least, x - slot["less"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(state["to"], F.array(least)).alias("to"))

    placed = stats.agg(_by_weight(stats, weight).alias("slots")).withColumn("to", F.aggregate("slots", start, place)["to"])
    return _exploded(placed, F.lit(1))


def rebalanced_map(current: DataFrame, stats: DataFrame, shards: int) -> DataFrame:
    """The next version, edited for even bytes: a slot stays where it is, the heaviest first, for as long as its shard has not more than the
    mean; the others move to the shard with the least so far."""
    sized = stats.join(F.broadcast(current.select("virtual_slot", "version", F.col("shard").alias("own"))), "virtual_slot")  # ``slots`` rows
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"), F.array().cast("array<int>").alias("to"))
    whole = sized.agg(_by_weight(sized, "slot_bytes").alias("slots"), F.sum("slot_bytes").alias("all"), F.max("version").alias("version"))

    def place(state, slot):
        least = F.array_position(state["load"], F.array_min(state["load"])).cast("int") - 1
        stays = (F.get(state["load"], slot["own"]) - slot["less"]) * shards <= F.col("all")
        to = F.when(stays, slot["own"]).otherwise(least)
        load = F.transform(state["load"], lambda x, i: F.when(i == to, x - slot["less"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(state["to"], F.array(to)).alias("to"))

    placed = whole.withColumn("to", F.aggregate("slots", start, place)["to"])
    return _exploded(placed, F.col("version") + 1)


def grown_map(current: DataFrame, stats: DataFrame) -> DataFrame:
    """The next version with one more shard, which alone receives slots.

    Every old shard gives slots, in slot order, for as long as they fit into the
    share of bytes that it has too many among shards + 1.
    """
    sized = current.join(F.broadcast(stats.select("virtual_slot", "slot_bytes")), "virtual_slot")
    everything = Window.partitionBy()
    by_shard = Window.partitionBy("shard")
    sized = sized.withColumn("shards", F.max("shard").over(everything) + 1).withColumn(
        "given", F.sum("slot_bytes").over(by_shard.orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, 0))
    )
    moves = F.col("given") * (F.col("shards") + 1) <= F.sum("slot_bytes").over(by_shard)
    return sized.select(
        (F.col("version") + 1).alias("version"), "virtual_slot", F.when(moves, F.col("shards")).otherwise(F.col("shard")).cast("int").alias("shard")
    )


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add the version(s) in ``slot_map`` to the map table at ``path``."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest by default."""
    table = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version).select("version", "virtual_slot", "shard")


def placed(sized: DataFrame, slot_map: DataFrame, stats: DataFrame, key: str = "doc_id") -> DataFrame:
    """``sized`` with ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Places are counted within a virtual slot and shifted by the rows of the
    shard's earlier slots, so that no task sees a whole shard.
    """
    rows, names, given = aside(sized, ("shard", "slot", "version"))
    rows = rows.withColumnsRenamed({names["size"]: "size", names["virtual_slot"]: "virtual_slot"})
    given = [column for name, column in zip(names, given) if name not in ("size", "virtual_slot")]
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    mapped = slot_map.join(F.broadcast(stats), "virtual_slot").withColumn("ahead", F.coalesce(F.sum("slot_rows").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(names[key], "size"))
    numbered = rows.withColumn("within", within.cast("long") - 1)
    out = numbered.join(F.broadcast(mapped.select("virtual_slot", "shard", "version", "ahead")), "virtual_slot")  # ``slots`` rows
    return out.select(*given, "size", "virtual_slot", "shard", (F.col("within") + F.col("ahead")).alias("slot"), "version")


def shard_by_bytes(df: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Place every row of ``df`` so that shards have nearly equal bytes; sums and both versions of the map are stored, then used as stored.

    Version 1 deals the slots by rows, as one does before sizes are known; version 2 is its edit for even bytes, which places the rows.
    """
    sized = with_slot(df.drop("shard", "slot", "version"), key, text, slots)
    stats = stored(slot_bytes(sized, slots), "slot-bytes")
    path = shared_dir(df.sparkSession, "slot-map")
    save_map(first_map(stats, shards, "slot_rows"), path)
    save_map(rebalanced_map(load_map(df.sparkSession, path, 1), stats, shards), path)
    return placed(sized, load_map(df.sparkSession, path), stats, key)
