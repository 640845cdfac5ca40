"""Surroundings of components against a search, across tile borders."""

import numpy as np
from pyspark.sql import functions as F

from sparkraster.operators import components


def searched(labels, allowed, margins):
    """Cells within each component's margin by steps over allowed cells."""
    out = set()
    for comp, cells in labels.items():
        seen, front = set(cells), set(cells)
        for _ in range(margins[comp]):
            front = {(r + y, c + x) for r, c in front for y, x in ((0, 1), (0, -1), (1, 0), (-1, 0))} & allowed - seen
            seen |= front
            out |= {(*comp, *cell) for cell in front}
    return out


def test_rings_equal_a_search(spark):
    rng = np.random.default_rng(3)
    low = components.TILE - 22
    for turn in range(3):
        mask = rng.random((44, 44)) < 0.12
        mask[5:18, 10:40] |= turn > 0  # a large one across the corner of four tiles
        open_ = ~mask & (rng.random((44, 44)) < (0.95, 0.75, 0.6)[turn])
        number = spark.createDataFrame([(int(r) + low, int(c) + low) for r, c in zip(*np.nonzero(mask))], "row int, col int")
        labels = components.label(number).select("comp_row", "comp_col", "row", "col")
        labels = components.kept(labels, "labels")
        held = {}
        for r in labels.collect():
            held.setdefault((r["comp_row"], r["comp_col"]), []).append((r["row"], r["col"]))
        least = (1, 5, 30)[turn]
        margins = {k: max(least, 1, int((2**0.5 - 1.2) * len(v) ** 0.5)) for k, v in held.items()}
        allowed = {(int(r) + low, int(c) + low) for r, c in zip(*np.nonzero(open_))}
        got = components.rings(labels, spark.createDataFrame(sorted(allowed), "row int, col int"), least).drop("part").collect()
        assert len(got) == len(set(map(tuple, got)))
        assert {(r["comp_row"], r["comp_col"], r["row"], r["col"]) for r in got} == searched(held, allowed, margins)


def test_a_path_that_leaves_a_tile_and_comes_back(spark):
    at = components.TILE
    # The only way from the component to its far end crosses the border of two tiles four times.
    path = [(0, at - 2), (0, at - 1), (0, at), (1, at), (2, at), (2, at - 1), (3, at - 1), (4, at - 1), (4, at), (5, at), (6, at), (6, at - 1), (6, at - 2)]
    labels = spark.createDataFrame([(0, at - 3, 0, at - 3)], "comp_row int, comp_col int, row int, col int")
    allowed = spark.createDataFrame(path, "row int, col int")
    for least in (1, 4, 9, 12, 13, 40):
        got = {(r["row"], r["col"]) for r in components.rings(labels, allowed, least).collect()}
        assert got == set(path[:least])


def test_few_rounds_for_a_large_component(spark, monkeypatch):
    rounds = []
    real = components.kept
    monkeypatch.setattr(components, "kept", lambda df, name: (rounds.append(name), real(df, name))[1])
    n = 1000
    labels = spark.range(n * n).select(F.lit(0).alias("comp_row"), F.lit(0).alias("comp_col"), F.expr(f"cast(id div {n} as int)").alias("row"), F.expr(f"cast(id % {n} as int)").alias("col"))
    allowed = spark.range(1300 * n).select(F.expr(f"cast(id div {n} + {n} as int)").alias("row"), F.expr(f"cast(id % {n} as int)").alias("col"))
    got = components.rings(labels, allowed)
    margin = int((2**0.5 - 1.2) * n)
    assert got.count() == margin * n and got.agg(F.max("row")).first()[0] == n + margin - 1
    assert rounds.count("ring") <= 10


def test_no_components_no_rings(spark):
    none = spark.createDataFrame([], "comp_row int, comp_col int, row int, col int")
    some = spark.createDataFrame([(1, 1)], "row int, col int")
    assert components.rings(none, some).count() == 0
    assert components.rings(spark.createDataFrame([(1, 1, 1, 1)], none.schema), some.limit(0)).count() == 0


def test_parts_may_enter_their_own_component(spark):
    low = components.TILE - 6
    # Two bodies of three parts each, a lane of land between them.
    labels = {}
    for body, left in ((0, 0), (1, 9)):
        for r in range(12):
            for c in range(8):
                labels[low + r, low + left + c] = (low, low + left, 0 if c < 3 else 1 if c < 6 else 2)
    land = {(low + r, low + 8) for r in range(12)}
    rows = [(cr, cc, part, r, c) for (r, c), (cr, cc, part) in labels.items()]
    df = spark.createDataFrame(rows, "comp_row int, comp_col int, part int, row int, col int")
    ground = spark.createDataFrame(sorted(land), "row int, col int")
    for least in (1, 2, 5, 20):
        for private in (None, df):
            got = {tuple(r) for r in components.rings(df, ground, least, private).collect()}
            want = set()
            for key in set(labels.values()):
                own = {cell for cell, k in labels.items() if k == key}
                allowed = land | ({cell for cell, k in labels.items() if k[:2] == key[:2]} if private is not None else set())
                margin = max(least, 1, int((2**0.5 - 1.2) * len(own) ** 0.5))
                want |= {(*key, r, c) for _, _, r, c in searched({key[:2]: own}, allowed - own, {key[:2]: margin})}
            assert got == want
