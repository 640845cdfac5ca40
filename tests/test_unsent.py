"""Tables of cells are never broadcast, however few bytes their files have; facts that are few are."""

import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkraster.operators import components, morph, refine
from sparkraster.plans import catalogue

DATA = "/root/testdata/sf0.001"


def joins(df) -> str:
    """The physical plan of ``df`` before it runs: what the sizes of files suggest."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lines(spark):
    """Full lines of 1,000 cells: written, they take next to nothing."""
    return lambda n: spark.range(n * 1000).select(F.expr("cast(id div 1000 as int)").alias("row"), F.expr("cast(id % 1000 as int)").alias("col"))


@pytest.fixture
def sent(monkeypatch):
    """Broadcasts of more rows than this are too many in these tests."""
    monkeypatch.setattr(morph, "SENT", 5000)


def test_kept_cells_are_not_broadcast(spark, lines, sent):
    many, few = morph.kept(lines(20), "many"), morph.kept(lines(2), "few")
    plan = joins(lines(20).join(many.select("row", "col").distinct(), ["row", "col"], "left_semi"))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "BroadcastHashJoin" in joins(lines(20).join(few, ["row", "col"], "left_semi"))
    assert "BroadcastHashJoin" in joins(many.join(morph.facts(lines(2), "facts"), ["row", "col"], "left_anti"))
    assert "Broadcast" not in joins(many.join(morph.facts(lines(20), "facts"), ["row", "col"], "left_anti"))
    assert morph.kept(lines(1).limit(0), "none").count() == 0


def test_labels_growth_and_dilation_are_not_broadcast(spark, lines, sent):
    cells, small = lines(20), lines(1)
    labels = components.label(small)  # a written run of a line
    for table in (labels, morph.dilate(small, 1), morph.erode(lines(3), 1), components.larger_than(labels, 2), components.grow_masks(small.limit(5), small, []), components.rings(labels, lines(3).where("row > 0"))):
        plan = joins(cells.join(table.select("row", "col").withColumn("there", F.lit(1)), ["row", "col"], "left"))
        assert re.search(r"\w+Join", plan).group() == "SortMergeJoin"


def eroded(cells: dict, spread: float = 2.5) -> set:
    """``refine.terrain_eroded`` of one component, cell by cell."""
    four = lambda c: [(c[0] + i, c[1] + j) for i, j in morph.FOUR]
    edge = [c for c in cells if any(n not in cells for n in four(c))]
    heights = np.array([cells[c] for c in edge])
    limit, left = round(np.median(heights) + heights.std(), 9), set(cells)
    while heights.std() > spread and (gone := {c for c in left if cells[c] > limit and any(n not in left for n in four(c))}):
        left -= gone
    return left


def test_erosion_with_and_without_broadcasts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    cells = {(r, c): float(rng.integers(0, 40)) for r in range(40) for c in range(30)}
    height = spark.createDataFrame([(*k, v) for k, v in cells.items()], "row int, col int, hand double")
    for many in (0, 50_000):
        monkeypatch.setattr(morph, "SENT", many)
        got = {tuple(r) for r in refine.terrain_eroded(height.select("row", "col"), height).collect()}
        assert got == eroded(cells) and len(got) < len(cells)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_boundary_terrain_broadcasts_no_cells(spark):
    plan = joins(catalogue.QUERIES["boundary_terrain"](spark, DATA))
    assert plan.count("SortMergeJoin") >= 3 and "Broadcast" not in plan


@pytest.mark.parametrize("mode", ["v1", "v2"])
def test_masking_joins_no_cells_by_broadcast(spark, monkeypatch, mode):
    """Of cells in memory, whose size is not known, nothing but the size of written files could suggest a broadcast."""
    monkeypatch.setattr(morph, "SENT", 0)
    plans, written = [], morph._written
    monkeypatch.setattr(morph, "_written", lambda df, name: (plans.append(joins(df)), written(df, name))[1])
    rng = np.random.default_rng(5)
    rows = [(r, c, int(rng.choice([30, 60, 80])), float(rng.normal(-9 if c < 20 else -20, 2)), float(rng.integers(0, 40))) for r in range(40) for c in range(40)]
    cells = spark.createDataFrame(rows, "row int, col int, landcover int, co_db double, hand double")
    cells = cells.selectExpr("*", "co_db - 8 as cross_db", "0.0D as occurrence", "co_db < -19 as dark", "landcover = 80 as water", "10 as glad")
    water = morph.kept(cells.where("co_db < -7").select("row", "col"), "water")
    out = refine.mask_stage(cells, water, "co_db", large=20, mode=mode, vegetation="glad" if mode == "v2" else None)
    assert out.count()
    by_cell = [j for p in [*plans, joins(out)] for j in re.findall(r"(\w+Join) \[(?:\w+#\d+L?, )*row#\d+, col#\d+", p)]
    assert len(by_cell) > 10 and set(by_cell) == {"SortMergeJoin"}


def test_windows_are_shuffled_once(spark):
    """A grown threshold sends no pair of a bin and a level anywhere, and whole groups stay where they were written."""
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(w, r, c, float(rng.normal(-20 if c < 5 else -8, 1.5))) for w in range(8) for r in range(10) for c in range(10)], "w int, row int, col int, v double")
    start = morph.kept(spark.createDataFrame([(w, -16.0, -20.0, 1.5, 0.06) for w in range(8)], "w int, threshold double, mean1 double, std1 double, amp1 double"), "start")
    rows = morph.grouped(rows, ["w"], "cells")
    grown = refine.grown_threshold(rows, ["w"], "v", morph.unsent(start), -35.0, 10.0, 90)
    assert joins(grown).count("Exchange hashpartitioning") <= 1  # of the starts
    assert "Exchange" not in joins(rows.groupBy("w").count())
    assert grown.count() == 8
