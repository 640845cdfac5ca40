"""Folders that driver and executors share, and the package on executors."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the one that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a single machine gets a temporary one, and a cluster an error: its executors share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='sparkraster-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would: called before anything that runs Python workers."""
    context = spark.sparkContext
    if getattr(context, "_sparkraster_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="sparkraster-")
    shutil.copytree(package, Path(folder, "in", package.name), ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", f"{folder}/in"))
    context._sparkraster_shipped = True
