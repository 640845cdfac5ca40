"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: One word of the text contracts.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` in the folder that driver and executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset, a single
    machine (tests) gets a temporary one, and a cluster an error: its executors share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='sparkraster-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage,
    survives lost executors, and fixes rows that a retry could reorder."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def aside(df: DataFrame, outputs: tuple[str, ...]) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``df`` under names of our own, so that none of its columns can clash with those that an operator works with.

    Columns named like an output are left out. Also returned: our name by the caller's, and what gives the caller's names back.
    """
    names = {name: f"in_{i}" for i, name in enumerate(c for c in df.columns if c not in outputs)}
    quoted = ["`" + name.replace("`", "``") + "`" for name in names]
    return df.select(*[F.col(q).alias(own) for q, own in zip(quoted, names.values())]), names, [F.col(own).alias(name) for name, own in names.items()]


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one after another, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def tidy(run):
    """``run`` over batches, giving memory back at the end: workers stay alive between stages."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass

    return tidied


def slices(lengths: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs [a, b) of neighbouring items whose lengths add up to ``most`` at most (an item above it stands alone)."""
    out, a, total = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > a and total + n > most:
            out.append((a, i))
            a, total = i, 0
        total += n
    if len(lengths):
        out.append((a, len(lengths)))
    return out


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over [start, end) with wrap-around; empty segments give 0."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[ends] - total[starts]


_TABLES: dict[tuple, np.ndarray] = {}


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers drawn from ``seed``; a longer draw starts with the shorter one."""
    have = _TABLES.get((seed,))
    if have is None or len(have) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        have = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        _TABLES[(seed,)] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def segment_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of units[start:end] per segment: units times a random number of their offset, summed.

    Segments are neither empty nor overlapping, and stand in ascending order.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = inside + np.repeat(starts, lengths)
    terms = (units[at].astype(np.uint64) + np.uint64(1)) * random_words(seed, int(lengths.max()))[inside]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return mix64(sums + lengths.astype(np.uint64) * random_words(seed + 1, 1)[0])


def group_first(rows: DataFrame, keys: list[str], key: str, name: str, salts: int = 32) -> DataFrame:
    """``rows`` with ``name``, the smallest ``key`` among rows with equal ``keys``, and ``name``_rows, their number.

    Minima are taken per salt and then among salts; rows find theirs by keys and
    salt, so that a hot group never meets in one task.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    parts = salted.groupBy(*keys, "_salt").agg(F.min(key).alias(name), F.count("*").alias(f"{name}_rows"))
    whole = parts.groupBy(*keys).agg(
        F.min(name).alias(name), F.sum(f"{name}_rows").alias(f"{name}_rows"), F.bit_or(F.expr("shiftleft(1L, _salt)")).alias("_salts")
    )
    bits = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.col("_salts").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s)) != 0)
    spread = whole.withColumn("_salt", F.explode(bits)).drop("_salts")
    return salted.join(spread, [*keys, "_salt"]).drop("_salt")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_sparkraster_shipped", False):
        return
    import shutil
    from pathlib import Path

    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="sparkraster-")
    shutil.copytree(package, Path(folder, "in", package.name), ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", f"{folder}/in"))
    context._sparkraster_shipped = True
