"""Labels by one task and by rounds, over tiles and many scenes."""

import numpy as np
import pytest

from sparkraster.operators import components


def searched(cells, eight):
    """The first cell in line order of each cell's component."""
    left, out = set(cells), {}
    steps = [(0, 1), (0, -1), (1, 0), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if eight else [])
    for cell in sorted(cells):
        if cell in left:
            todo = [cell]
            left.discard(cell)
            while todo:
                r, c = todo.pop()
                out[r, c] = cell
                for y, x in steps:
                    if (r + y, c + x) in left:
                        left.discard((r + y, c + x))
                        todo.append((r + y, c + x))
    return out


@pytest.mark.parametrize("at_once", [200_000, 0])
@pytest.mark.parametrize("connect", [8, 4])
def test_labels_equal_a_search(spark, monkeypatch, at_once, connect):
    monkeypatch.setattr(components, "AT_ONCE", at_once)
    rng = np.random.default_rng(2)
    low = components.TILE - 20
    rows = []
    for scene in (None, "a", "b", "é"):
        mask = rng.random((40, 40)) < 0.5
        rows += [(scene, int(r) + low, int(c) + low) for r, c in zip(*np.nonzero(mask))]
    df = spark.createDataFrame(rows + rows[:50], "scene string, row int, col int")
    got = components.label(df.na.fill("none"), ["scene"], connect).distinct().collect()
    for scene in ("none", "a", "b", "é"):
        want = searched([(r, c) for s, r, c in rows if (s or "none") == scene], connect == 8)
        assert {(r["row"], r["col"]): (r["comp_row"], r["comp_col"]) for r in got if r["scene"] == scene} == want


def test_many_small_scenes(spark):
    rng = np.random.default_rng(5)
    rows = [(s, int(r), int(c)) for s in range(300) for r, c in zip(*np.nonzero(rng.random((8, 8)) < 0.4))]
    got = components.label(spark.createDataFrame(rows, "scene long, row int, col int"), ["scene"]).collect()
    assert len(got) == len(rows)
    for s in range(0, 300, 17):
        want = searched([(r, c) for k, r, c in rows if k == s], True)
        assert {(r["row"], r["col"]): (r["comp_row"], r["comp_col"]) for r in got if r["scene"] == s} == want
