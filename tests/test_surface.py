"""Linear surfaces between scattered points against all triangles."""

from itertools import combinations

import numpy as np

from sparkraster.operators import thresholds


def lowest(q, points, weights, values):
    """The value over q of the lowest of all lifted triangles around it; None if there is none."""
    best = None
    for t in combinations(range(len(points)), 3):
        m = np.column_stack([points[list(t)], np.ones(3)]).T
        if abs(np.linalg.det(m)) < 1e-9:
            continue
        shares = np.linalg.solve(m, [*q, 1.0])
        if (shares >= -1e-9).all():
            height = shares @ weights[list(t)]
            if best is None or height < best[0] - 1e-12:
                best = (height, float(shares @ values[list(t)]))
    return None if best is None else best[1]


def test_triangles_equal_the_lowest_of_all():
    rng = np.random.default_rng(0)
    for _ in range(60):
        points = rng.normal(size=(int(rng.integers(1, 12)), 2)) * 10
        weights, values = (points**2).sum(1), rng.normal(size=len(points))
        for q in rng.normal(size=(8, 2)) * 10:
            found = thresholds.triangle_of(q, points, weights)
            want = lowest(q, points, weights, values)
            assert (found is None) == (want is None)
            if found is not None:
                assert abs(found[1] @ values[found[0]] - want) < 1e-6


def test_surfaces(spark):
    rng = np.random.default_rng(1)
    plane = lambda r, c: 2.0 * r - 0.5 * c + 3
    places = sorted({(int(r), int(c)) for r, c in rng.integers(0, 60, (90, 2))} | {(0, 0), (0, 59), (59, 0), (59, 59)})
    points = spark.createDataFrame([(r, c, plane(r, c)) for r, c in places], "pr int, pc int, value double")
    blocks = spark.createDataFrame([(r, c) for r in range(-3, 63, 2) for c in range(-3, 63, 3)], "row int, col int")
    got = {(r["row"], r["col"]): r["value"] for r in thresholds.filled_points(blocks, points, 4).collect()}
    assert len(got) == blocks.count()
    for (r, c), v in got.items():
        if 0 <= r <= 59 and 0 <= c <= 59:
            assert abs(v - plane(r, c)) < 1e-4  # a plane is met exactly inside
        else:
            near = min(places, key=lambda p: ((p[0] - r) ** 2 + (p[1] - c) ** 2, p))
            assert abs(v - plane(*near)) < 1e-9


def test_reach_doesnt_show(spark):
    rng = np.random.default_rng(2)
    places = sorted({(int(r), int(c)) for r, c in rng.integers(0, 40, (60, 2))})
    points = spark.createDataFrame([(r, c, float(rng.normal())) for r, c in places], "pr int, pc int, value double")
    blocks = spark.createDataFrame([(r, c) for r in range(0, 40, 3) for c in range(0, 40, 3)], "row int, col int")
    one, two = ({(r["row"], r["col"]): r["value"] for r in thresholds.filled_points(blocks, points, reach).collect()} for reach in (3, 64))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)
    few = points.limit(2)
    assert thresholds.filled_points(blocks, few, 4).count() == blocks.count()
