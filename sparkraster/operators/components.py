"""Connected components of masks, and what is known of each.

Square tiles are labelled first, each within one task, from the runs of its lines. What
is left is a graph with a node per tile's component and an edge per touching pair at a
tile's border. Smallest labels spread over it with pointer jumping; every round is
written to the shared folder. Components that touch no border take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folders import ship
from ..sources.tiles import groups, sorted_apply, whole
from .morph import facts, kept, line_runs, unsent

#: Lines and columns of a tile.
TILE = 512
#: Edges between tiles' components, both ways, that one task joins; more are joined in rounds.
AT_ONCE = 200_000


def _joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least number that each of ``n`` nodes is linked with by the edges (a, b)."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            return label
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label, label[label]):
            label = label[label]


def label_runs(row: np.ndarray, col: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Line, first and last column of the runs of some cells, in line order, and the first run of each one's component."""
    order = np.lexsort((col, row))
    row, col = row[order].astype(np.int64), col[order].astype(np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (col[1:] > col[:-1] + 1)
    starts = np.flatnonzero(new)
    line, first, last = row[starts], col[starts], col[np.append(starts[1:], len(row)) - 1]
    low = int(col.min()) - 2 if len(col) else 0
    width = int(col.max()) - low + 3 if len(col) else 1
    # Runs of the line before that begin before this one ends, and end after it begins.
    begin = np.searchsorted(line * width + last - low, (line - 1) * width + first - low - pad, "left")
    end = np.searchsorted(line * width + first - low, (line - 1) * width + last - low + pad, "right")
    many = np.maximum(end - begin, 0)
    a = np.repeat(np.arange(len(line)), many)
    b = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
    return line, first, last, _joined(a, b, len(line))


def _tile_runs(mask: DataFrame, group: list[str], pad: int) -> DataFrame:
    """(group, row, first, last, comp_row, comp_col): runs inside tiles, with their tile's component. Many small scenes are labelled in one call."""
    kinds, gap = dict(mask.dtypes), TILE + 2
    names = ", ".join([f"{g} {kinds[g]}" for g in group] + [f"{c} int" for c in ("row", "first", "last", "comp_row", "comp_col")])
    keys = [*group, "_row", "_col"]

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        spans = groups(table, keys)
        starts = np.array([a for a, _ in spans])
        which = np.repeat(np.arange(len(spans)), [b - a for a, b in spans])
        row, col, tile = (whole(table.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("row", "col", "_row"))
        # Groups stand below each other, two lines apart.
        line, first, last, root = label_runs(row - tile * TILE + which * gap, col, pad)
        own = line // gap
        line = line % gap + tile[starts[own]] * TILE
        parts = [whole(table.column(g)).take(pa.array(starts[own])) for g in group]
        parts += [pa.array(x.astype(np.int32)) for x in (line, first, last, line[root], first[root])]
        yield pa.RecordBatch.from_arrays(parts, [*group, "row", "first", "last", "comp_row", "comp_col"])

    tiles = [F.floor(F.col(c) / TILE).cast("int").alias(f"_{c}") for c in ("row", "col")]
    cells = mask.select(*group, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *tiles)
    return sorted_apply(cells, keys, run, names)


def label(mask: DataFrame, group: list[str] | None = None, connect: int = 8) -> DataFrame:
    """(group, row, col, comp_row, comp_col): the component's first cell in line order, for every cell."""
    group = group or []
    pad = 1 if connect == 8 else 0
    every = kept(_tile_runs(mask, group, pad), "runs")
    node = F.struct(*group, "comp_row", "comp_col")
    last = TILE - 1
    border = F.pmod("row", F.lit(TILE)).isin(0, last) | (F.pmod("first", F.lit(TILE)) == 0) | (F.pmod("last", F.lit(TILE)) == last)
    here = every.where(border).select(*group, "row", "first", "last", node.alias("a"))
    # Runs meet those of their own line and of the line before, on blocks of columns, not on whole lines.
    span = lambda p: F.explode(F.sequence(F.floor((F.col("first") - p) / 64), F.floor((F.col("last") + p) / 64)))
    down = F.explode(F.array(F.lit(0), F.lit(1)))
    there = here.withColumn("_down", down).select(*group, (F.col("row") + F.col("_down")).alias("row"), "_down", F.col("first").alias("f2"), F.col("last").alias("l2"), F.col("a").alias("b"), span(0).alias("_b"))
    beside = (F.col("_down") == 0) & (F.col("first") == F.col("l2") + 1)
    below = (F.col("_down") == 1) & (F.col("first") <= F.col("l2") + pad) & (F.col("f2") <= F.col("last") + pad)
    edges = here.withColumn("_b", span(1)).join(there, [*group, "row", "_b"]).where((beside | below) & (F.col("a") != F.col("b")))
    edges = edges.select("a", "b").distinct()
    edges = kept(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    many = edges.count()
    if many:
        spread = _spread_at_once(edges) if many <= AT_ONCE else _spread(edges)
        found = spread.select(F.col("node.comp_row").alias("comp_row"), F.col("node.comp_col").alias("comp_col"), *[F.col(f"node.{g}").alias(g) for g in group], "label")
        every = every.join(found, [*group, "comp_row", "comp_col"], "left")
        every = every.withColumns({c: F.coalesce(F.col(f"label.{c}"), F.col(c)) for c in ("comp_row", "comp_col")})
    return unsent(every.select(*group, "row", F.explode(F.sequence("first", "last")).alias("col"), "comp_row", "comp_col"))


def _spread_at_once(edges: DataFrame) -> DataFrame:
    """``_spread`` in one task, for a number of edges that was checked."""
    ship(edges.sparkSession)
    kind = dict(edges.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        pairs = [[tuple(x.values()) for b in held for x in b.column(c).to_pylist()] for c in ("a", "b")]
        nodes = sorted(set(pairs[0]), key=lambda node: tuple((v is not None, v) for v in node))
        place = {node: i for i, node in enumerate(nodes)}
        least = _joined(*(np.array([place[x] for x in p]) for p in pairs), len(nodes))
        structs = [dict(zip(held[0].column("a").type.names, node)) for node in nodes]
        for a in range(0, len(nodes), 10_000):
            some = range(a, min(a + 10_000, len(nodes)))
            columns = [pa.array([structs[i] for i in order], held[0].column("a").type) for order in (some, [int(least[i]) for i in some])]
            yield pa.RecordBatch.from_arrays(columns, ["node", "label"])

    return edges.coalesce(1).mapInArrow(run, f"node {kind}, label {kind}")


def _spread(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each one is linked with, over edges given in both directions."""
    labels = kept(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = kept(labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")), "labels")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = kept(step.join(jump, "label").select("node", F.least("label", "root").alias("label"), "old"), "labels")
        labels = jumped.select("node", "label")
        if not jumped.where("label != old").limit(1).count():
            return labels


def stats(labels: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Size and bounding box per component, and the margin of its surroundings."""
    keys = [*(group or []), "comp_row", "comp_col"]
    out = labels.groupBy(*keys).agg(
        F.count("*").alias("size"), F.min("row").alias("min_row"), F.max("row").alias("max_row"), F.min("col").alias("min_col"), F.max("col").alias("max_col")
    )
    return out.withColumn("margin", F.greatest(F.lit(1), F.floor((2**0.5 - 1.2) * F.sqrt("size")).cast("int")))


def with_attributes(labels: DataFrame, attributes: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Component attributes back on the cells."""
    return labels.join(attributes, [*(group or []), "comp_row", "comp_col"], "left")


def larger_than(labels: DataFrame, least: int, group: list[str] | None = None) -> DataFrame:
    """Cells of components with more than ``least`` cells."""
    large = stats(labels, group).where(F.col("size") > least)
    return unsent(labels.join(large, [*(group or []), "comp_row", "comp_col"], "left_semi"))


def portion(labels: DataFrame, mask: DataFrame, group: list[str] | None = None, share: float = 0.5) -> DataFrame:
    """Share of each component that lies in the mask, and whether it is more than ``share``."""
    keys = group or []
    hit = labels.join(mask.select(*keys, "row", "col").distinct().withColumn("_in", F.lit(1)), [*keys, "row", "col"], "left")
    out = hit.groupBy(*keys, "comp_row", "comp_col").agg(F.avg(F.coalesce("_in", F.lit(0))).alias("portion"))
    return out.withColumn("flag", (F.col("portion") > share).cast("int"))


def component_apply(labels: DataFrame, layers: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, group: list[str] | None = None) -> DataFrame:
    """``fn`` over the cells of each component with their layers; for fits that need a component's values together."""
    ship(labels.sparkSession)
    keys = group or []
    return labels.join(layers, [*keys, "row", "col"]).groupBy(*keys, "comp_row", "comp_col").applyInPandas(fn, schema)


def grow(layer: DataFrame, value: str, seed: float, relaxed: float, group: list[str] | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """Cells reached from seeds (value > seed) over 4-neighbours with value > relaxed and outside ``excluded``.

    Growing until nothing changes equals the components, over relaxed cells and seeds, that hold a seed;
    seeds inside the exclusion stay and pass growth on.
    """
    keys = group or []
    # Written before any filter, since seeds and allowed cells are both read from it: two tests of a value that is still
    # a whole expression would double the generated code.
    layer = kept(layer.select(*keys, "row", "col", value), "layer")
    seeds = layer.where(F.col(value) > seed).select(*keys, "row", "col")
    allowed = layer.where(F.col(value) > relaxed).select(*keys, "row", "col")
    return grow_masks(seeds, allowed, keys, excluded)


def grow_masks(seeds: DataFrame, allowed: DataFrame, keys: list[str], excluded: DataFrame | None = None) -> DataFrame:
    """Growth from given seeds over given cells."""
    if excluded is not None:
        allowed = allowed.join(excluded.select(*keys, "row", "col"), [*keys, "row", "col"], "left_anti")
    labels = kept(label(allowed.unionByName(seeds).distinct(), keys, 4), "grown")
    found = facts(labels.join(seeds, [*keys, "row", "col"], "left_semi").select(*keys, "comp_row", "comp_col").distinct(), "found")
    return unsent(labels.join(found, [*keys, "comp_row", "comp_col"], "left_semi").select(*keys, "row", "col"))


#: Cells that a part of a component reaches (kind 0), and what its neighbour tiles get (kind 1).
_SPREAD = "kind int, comp_row int, comp_col int, part int, row int, col int, d int, margin int"


def _spread_in_tiles(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Tiles of entries (runs at a distance, kind 0), of allowed runs (1) and of runs allowed to their own component (2) to ``_SPREAD``."""
    kinds = pa.schema([(c, pa.int32()) for c in ("kind", "comp_row", "comp_col", "part", "row", "col", "d", "margin")])
    column = {c: whole(table.column(c)).to_numpy(zero_copy_only=False) for c in ("tile_row", "tile_col", "kind", "comp_row", "comp_col", "part", "row", "first", "last", "d", "margin")}
    for a, b in groups(table, ["tile_row", "tile_col"]):
        own = {c: v[a:b] for c, v in column.items()}
        top, left = int(own["tile_row"][0]) * TILE, int(own["tile_col"][0]) * TILE
        # A frame of cells that are never allowed saves all tests of bounds.
        allowed = np.zeros((TILE + 2, TILE + 2), bool)
        for i in np.flatnonzero(own["kind"] == 1):
            allowed[own["row"][i] - top + 1, own["first"][i] - left + 1 : own["last"][i] - left + 2] = True
        wide, flat = TILE + 2, allowed.ravel()
        entry = np.flatnonzero(own["kind"] == 0)
        entry = entry[np.lexsort((own["part"][entry], own["comp_col"][entry], own["comp_row"][entry]))]
        number = np.stack([own[c][entry] for c in ("comp_row", "comp_col", "part")], 1)
        cuts = np.flatnonzero(np.append(True, (number[1:] != number[:-1]).any(1))) if len(entry) else np.zeros(0, int)
        private: dict[tuple[int, int], list[int]] = {}
        for i in np.flatnonzero(own["kind"] == 2).tolist():
            private.setdefault((int(own["comp_row"][i]), int(own["comp_col"][i])), []).append(i)
        distance = np.full(wide * wide, np.iinfo(np.int32).max, np.int32)
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(entry)]):
            some = entry[x:y]
            margin = int(own["margin"][some[0]])
            n = own["last"][some] - own["first"][some] + 1
            at = np.repeat((own["row"][some] - top + 1) * wide + own["first"][some] - left + 1 - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            d = np.repeat(own["d"][some], n)
            mine = np.array(private.get((int(own["comp_row"][some[0]]), int(own["comp_col"][some[0]])), []), int)
            m = own["last"][mine] - own["first"][mine] + 1
            opened = np.repeat((own["row"][mine] - top + 1) * wide + own["first"][mine] - left + 1 - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            flat[opened] = True
            known = (d == 0) | flat[at]
            at, d = at[known], d[known]
            order = np.argsort(-d, kind="stable")
            distance[at[order]] = d[order]  # the least is written last
            seen = [np.unique(at)]
            waiting = seen[0]
            levels = distance[waiting]
            front = waiting[levels == levels.min()] if len(waiting) else waiting
            level = int(levels.min()) if len(waiting) else margin
            while level < margin and (len(front) or (levels > level).any()):
                around = np.unique((front[:, None] + np.array([1, -1, wide, -wide])).ravel())
                new = around[flat[around] & (distance[around] > level + 1)]
                distance[new] = level + 1
                seen.append(new)
                level += 1
                front = np.union1d(new, waiting[(levels == level) & (distance[waiting] == level)])
            cells = np.unique(np.concatenate(seen))
            found = distance[cells]
            distance[cells] = np.iinfo(np.int32).max
            flat[opened] = False
            row, col = cells // wide - 1, cells % wide - 1
            ring = found > 0
            out = [(0, row[ring], col[ring], found[ring])]
            for dr, dc, edge in ((-1, 0, row == 0), (1, 0, row == TILE - 1), (0, -1, col == 0), (0, 1, col == TILE - 1)):
                goes = edge & (found < margin)
                out.append((1, row[goes] + dr, col[goes] + dc, found[goes] + 1))
            for kind, r, c, k in out:
                if len(r):
                    m = len(r)
                    values = (np.full(m, kind), np.full(m, own["comp_row"][some[0]]), np.full(m, own["comp_col"][some[0]]), np.full(m, own["part"][some[0]]), r + top, c + left, k, np.full(m, margin))
                    yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int32)) for v in values], schema=kinds)


def rings(labels: DataFrame, allowed: DataFrame, least: int = 1, private: DataFrame | None = None) -> DataFrame:
    """(comp_row, comp_col, part, row, col): each component's surroundings inside ``allowed``, as wide as its margin, ``least`` cells at least.

    Distances from a component, by steps to 4-neighbours over allowed cells, are found within tiles at once; what reaches a tile's border
    goes on in the next tile, in rounds, until nothing comes nearer. So the rounds are the tiles that a path crosses, not its cells.
    ``allowed`` holds no cell of a component. With a column ``part``, parts of a component have surroundings of their own, which may
    take in the cells of ``private`` (comp_row, comp_col, row, col) that belong to their component.
    """
    comp, tile = ["comp_row", "comp_col", "part"], ["tile_row", "tile_col"]
    labels = labels if "part" in labels.columns else labels.withColumn("part", F.lit(0))
    inner = lambda df: df.withColumns({f"tile_{c}": F.expr(f"cast(floor({c} / {TILE}) as int)") for c in ("row", "col")})
    margin = F.greatest(F.lit(least), F.lit(1), F.floor((2**0.5 - 1.2) * F.sqrt(F.count("*"))))
    margins = facts(labels.groupBy(*comp).agg(margin.cast("int").alias("margin")), "margins")
    runs = lambda df, keys: line_runs(inner(df), [*tile, *keys])
    number = lambda v: F.lit(v).cast("int")
    names = [*tile, "kind", *comp, "row", "first", "last", "d", "margin"]
    entries = runs(labels.select(*comp, "row", "col"), comp).join(margins, comp).withColumns({"kind": number(0), "d": number(0)})
    ground = runs(allowed.select("row", "col"), []).withColumns({"kind": number(1), **{c: number(0) for c in (*comp, "d", "margin")}}).select(names)
    if private is not None:
        own = runs(private.select("comp_row", "comp_col", "row", "col"), ["comp_row", "comp_col"])
        ground = ground.unionByName(own.withColumns({"kind": number(2), **{c: number(0) for c in ("part", "d", "margin")}}).select(names))
    entries, ground = kept(entries.select(names), "entries"), kept(ground, "ground")
    found, turn = None, entries
    while True:
        touched = ground.join(turn.select(*tile).distinct(), tile, "left_semi")
        out = kept(sorted_apply(touched.unionByName(turn), tile, _spread_in_tiles, _SPREAD), "ring")
        cells = out.where("kind = 0").select(*comp, "row", "col", "d")
        found = cells if found is None else found.unionByName(cells)
        # What comes nearer than all that is known there.
        known = found.unionByName(entries.where("d > 0").select(*comp, "row", F.col("first").alias("col"), "d")).groupBy(*comp, "row", "col").agg(F.min("d").alias("before"))
        news = out.where("kind = 1").groupBy(*comp, "row", "col").agg(F.min("d").alias("d"), F.max("margin").alias("margin"))
        news = news.join(unsent(known), [*comp, "row", "col"], "left").where("before is null or d < before")
        news = kept(inner(news).withColumns({"kind": number(0), "first": F.col("col"), "last": F.col("col")}).select(names), "news")
        if not news.limit(1).count():
            return unsent(found.select(*comp, "row", "col").distinct())
        entries = kept(entries.unionByName(news), "entries")
        turn = entries.join(news.select(*tile, *comp).distinct(), [*tile, *comp], "left_semi")


def grow_steps(layer: DataFrame, value: str, seed: float, relaxed: float, steps: int) -> DataFrame:
    """Growth that stops after ``steps`` rounds."""
    from .morph import dilate

    seeds = layer.where(F.col(value) > seed).select("row", "col")
    return dilate(seeds, steps, layer.where(F.col(value) > relaxed).select("row", "col"))
