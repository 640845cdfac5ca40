"""Exact deduplication by salted, content-checked combining.

Copies are combined in three steps, each of which groups on the digest *and* the
whole normalised text, so that different texts never merge: within a map task
(the partial aggregate), within a salted digest group, and among the winners of
the salts. A group of copies therefore reaches one task only as one row per salt.
Rows find their group again by (digest, salt), which splits hot groups likewise.

Cases: null text counts as empty, and empty texts are copies of each other; ties
go to the smallest id, null ids last; of rows that repeat an id within a group one
is kept; an empty table gives an empty result; input columns named like an output
column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, aside, text_or_empty

#: Salts of a digest group; one bit each in a long.
SALTS = 32
#: What separates the length from the id in the ranking number, and the ids' offset: a null id's place is 0.
SHIFT, LARGEST = "36893488147419103232", "9223372036854775807"


def normalised(text: str) -> Column:
    """The text without U+0020 and U+0009 to U+000D."""
    return F.translate(text_or_empty(text), SPACES, "")


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """``df`` with keep_id, group_size, kept and text_sha256; the longest original text of a group stays."""
    rows, names, given = aside(df, ("keep_id", "group_size", "kept", "text_sha256"))
    key, text = names[key], names[text]
    rows = rows.withColumns({"norm": normalised(text), "length": F.char_length(text_or_empty(text))})
    # Copies of one id, and null ids, are told apart by their original texts.
    salt = F.pmod(F.xxhash64(key, F.when(F.col(key).isNull(), F.col(text))), F.lit(salts)).cast("int")
    rows = rows.withColumns({"text_sha256": F.sha2("norm", 256), "tag": F.xxhash64("norm"), "salt": salt, "mark": F.xxhash64(text)})
    # One number that orders by length, then by smaller id, and that a hash aggregate can keep in place.
    before = F.coalesce(F.lit(LARGEST).cast("decimal(20,0)") - F.col(key).cast("decimal(19,0)") + 1, F.lit(0)).cast("decimal(20,0)")
    rank = (F.col("length").cast("decimal(17,0)") * F.lit(SHIFT).cast("decimal(20,0)") + before).cast("decimal(38,0)")
    salted = rows.groupBy("text_sha256", "salt", "norm").agg(F.max(rank).alias("rank"), F.count("*").alias("members"))
    whole = salted.groupBy("text_sha256", "norm").agg(
        F.max("rank").alias("rank"), F.sum("members").alias("group_size"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")
    )
    used = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.col("salts").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s)) != 0)
    spread = whole.select("text_sha256", F.xxhash64("norm").alias("tag"), "rank", "group_size", F.explode(used).alias("salt"))
    winners = spread.groupBy("text_sha256", "tag", "salt").agg(F.max("rank").alias("rank"), F.max("group_size").alias("group_size"), F.count("*").alias("texts"))
    # Two texts with one digest and one tag could not be told apart below: stop rather than merge them.
    sure = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a digest")).cast("long")).otherwise(F.col("group_size"))
    keep = F.expr(f"cast({LARGEST}BD + 1 - nullif(rank % {SHIFT}BD, 0BD) as long)")
    winners = winners.select("text_sha256", "tag", "salt", sure.alias("group_size"), F.expr(f"rank div {SHIFT}BD").alias("longest"), keep.alias("keep_id"))
    found = rows.drop("norm").join(winners, ["text_sha256", "tag", "salt"])
    again = F.row_number().over(Window.partitionBy("text_sha256", "tag", "salt", key).orderBy(F.desc("length"), "mark"))
    kept = F.col(key).eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("longest")) & (again == 1)
    return found.withColumn("kept", kept).select(*given, "keep_id", "group_size", "kept", "text_sha256")
