"""Nearest region for points (planar distance in the input units), exact at any size.

A region is a list of vertex rings: one polygon, several parts, holes. A point is inside
where it crosses an odd number of edges of all rings; else its distance is that to the
nearest edge. Regions come as ``rings``, as one ring of ``vertices``, or as ``geometry`` in
well-known binary.

Regions form a tree of nodes of at most 16 entries, packed by sort and tile: boxes are
ranked by the x of their centres and cut into slabs of equal numbers, each slab is ranked by
y and cut into nodes; the nodes' boxes are packed in the same way, up to a root. Ranks, not
coordinates, decide, so neither far-away regions nor equal ones can fill a node. A point
descends from the root to nodes of NODE ** 3 regions, or of NODE ** 4 where there are many. Regions touch every side of their
node's box, so the nearest one is no farther than the farther end of a box's nearer side; nodes
beyond that are dropped, so a point meets a few nodes per level wherever it lies. The upper levels
(at most ``INLINE`` nodes each) are part of the expression: a point passes them in its own row,
without a join; levels below are equi-joins on node numbers with a minimum per point.

Points then meet the regions of their nodes, dealt by node and, where a node has many points, in
parts. Pairs of points and regions exist inside a task only, a block of points at a time: a first
pass returns the least distance per point and node, a second one the regions at the least distance
of all nodes. A region with no edge near a block holds all of its points or none, which one point
tells; such regions go with the block as a whole, so only regions with an edge there are measured
point by point. What is stored and shuffled are points (once per node met) and regions (once per
part), however many regions a point lies in.

Equally near regions (within ``tie_tolerance``) all come back, one row each. A point
with a null, NaN or infinite coordinate keeps one row with a null region, and so do all
points when there are no regions. A region without (finite) vertices is near to nothing.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from lakehold.sources import wkb

_BOX = ("__x0", "__y0", "__x1", "__y1")
VERTICES = "array<struct<x:double,y:double>>"
NODE = 16  # entries of a node
GROUP = NODE ** 3  # regions that a task holds at a time, or
GROUPS = 512  # NODE times as many where there are more than so many such nodes
PART = 262144  # points, about, that meet a node's regions in one go
BLOCK, TILE = 64, 512  # points that are measured at a time, and for which regions are looked up together
CHUNK, EDGES = 128, 4096  # regions and edges that are measured at a time
RUN = 64  # regions near each other, looked up together
NAMES = 500_000  # of a batch, about
HUGE = 1e100 * 1e-12
INLINE = NODE ** 3  # nodes of a level that every task may hold
ONE_TASK = NODE ** 4  # boxes that one task may rank


def _edges(verts: Column) -> Column:
    """Array of (x1, y1, x2, y2) for the closed ring of ``verts``."""
    n = F.size(verts)
    return F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            F.element_at(verts, i).getField("x").alias("x1"),
            F.element_at(verts, i).getField("y").alias("y1"),
            F.element_at(verts, F.when(i == n, F.lit(1)).otherwise(i + 1)).getField("x").alias("x2"),
            F.element_at(verts, F.when(i == n, F.lit(1)).otherwise(i + 1)).getField("y").alias("y2"),
        ),
    )


def _segment_distance(px: Column, py: Column, e: Column) -> Column:
    dx = e["x2"] - e["x1"]
    dy = e["y2"] - e["y1"]
    len2 = dx * dx + dy * dy
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(((px - e["x1"]) * dx + (py - e["y1"]) * dy) / len2)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    cx = e["x1"] + t * dx
    cy = e["y1"] + t * dy
    return F.sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy))


def polygon_distance(px: Column, py: Column, verts: Column) -> Column:
    """0 inside (odd crossing count), else the distance to the nearest edge."""
    return edge_distance(px, py, _edges(verts))


def edge_distance(px: Column, py: Column, edges: Column) -> Column:
    """As ``polygon_distance``, for the edges of any number of rings."""
    crossings = F.size(F.filter(
        edges,
        lambda e: ((e["y1"] > py) != (e["y2"] > py))
        & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]),
    ))
    edge_d = F.array_min(F.transform(edges, lambda e: _segment_distance(px, py, e)))
    return F.when(crossings % 2 == 1, F.lit(0.0)).otherwise(edge_d)


def boxes(spark, rows) -> DataFrame:
    """Regions from ``(name, xmin, ymin, xmax, ymax)`` boxes."""
    df = spark.createDataFrame(rows, "name string, xmin double, ymin double, xmax double, ymax double")
    pt = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
    return df.select("name", F.array(pt("xmin", "ymin"), pt("xmax", "ymin"),
                                      pt("xmax", "ymax"), pt("xmin", "ymax")).alias("vertices"))


def read_regions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Regions ``(name, vertices)`` from files with a name and an array of ``x, y`` vertices."""
    return spark.read.format(fmt).schema(f"name string, vertices {VERTICES}").load(path)


def regions_from_vertices(df: DataFrame, name: str = "name", seq: str = "seq", x: str = "x", y: str = "y") -> DataFrame:
    """Regions from one row per vertex, in the order of ``seq``."""
    vertex = F.struct(F.col(seq).alias("seq"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    ordered = F.transform(F.array_sort(F.collect_list(vertex)), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    return df.groupBy(F.col(name).alias("name")).agg(ordered.alias("vertices"))


def read_geometries(spark: SparkSession, path: str, name: str = "name", geometry: str = "geometry", fmt: str = "parquet") -> DataFrame:
    """Regions ``(name, rings)`` from files with a well-known binary column (as GeoParquet has it)."""
    df = spark.read.format(fmt).load(path).select(F.col(name).alias("name"), F.col(geometry).cast("binary").alias("geometry"))
    return wkb.read_rings(df)


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _with_rings(regions: DataFrame) -> DataFrame:
    """Regions with their non-empty ``rings``, whatever form they came in."""
    if "rings" not in regions.columns:
        if "vertices" in regions.columns:
            regions = regions.withColumn("rings", F.array("vertices"))
        else:
            regions = wkb.read_rings(regions)
    return regions.withColumn("rings", F.filter("rings", lambda r: r.isNotNull() & (F.size(r) > 0)))


def _boxes_of(points: Column) -> list[Column]:
    xs, ys = F.transform(points, lambda v: v["x"]), F.transform(points, lambda v: v["y"])
    return [F.array_min(xs).alias("__x0"), F.array_min(ys).alias("__y0"), F.array_max(xs).alias("__x1"), F.array_max(ys).alias("__y1")]


def _ranked(df: DataFrame, n: int, by: list[Column], root: str) -> DataFrame:
    """``__rank`` (0 to n - 1) in the order of ``by``: by one task where ``n`` is small, else by range."""
    if n <= ONE_TASK:
        return df.withColumn("__rank", F.row_number().over(Window.orderBy(*by)).cast("long") - 1)
    spark = df.sparkSession
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    placed.write.parquet(root)
    placed = spark.read.schema(placed.schema).parquet(root)
    part = F.shiftright("__at", 33)
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per partition
    starts, total = [], 0
    for p in range(max(sizes) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    start = F.element_at(F.from_json(F.lit(json.dumps(starts)), "array<long>"), (part + 1).cast("int"))
    return placed.withColumn("__rank", start + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at")


def _packed(df: DataFrame, n: int, root: str) -> DataFrame:
    """``n`` boxes with ``__id``, and the node ``__up`` that each goes into: ``ceil(n / NODE)`` nodes."""
    slabs = math.ceil(math.sqrt(math.ceil(n / NODE)))
    cx, cy = F.col("__x0") + F.col("__x1"), F.col("__y0") + F.col("__y1")
    ranked = _ranked(df, n, [cx, cy, F.col("__id")], root).withColumn("__slab", F.floor(F.col("__rank") / (NODE * slabs)))
    in_slab = F.row_number().over(Window.partitionBy("__slab").orderBy(cy, cx, "__id")) - 1  # a slab has 16 times as many rows as there are slabs
    return ranked.withColumn("__up", (F.col("__slab") * slabs + F.floor(in_slab / NODE)).cast("long")).drop("__slab", "__rank")


def _region_tree(regions: DataFrame, name_col: str, root: str) -> tuple[DataFrame, list[DataFrame], list[int]] | None:
    """Stored boxes of the regions and their nodes, the nodes of every level from the root's down, and their numbers.
    The regions themselves, with their edges as flat numbers, are stored in ``root``."""
    spark = regions.sparkSession
    flat = _with_rings(regions).withColumn("__points", F.flatten("rings"))
    good = flat.where((F.size("__points") > 0) & ~F.exists("__points", lambda v: ~_finite(v["x"]) | ~_finite(v["y"])))
    flat_edges = F.flatten(F.transform(F.flatten(F.transform("rings", _edges)), lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])))
    reg = good.select(F.col(name_col).alias("__name"), flat_edges.alias("__edges"), *_boxes_of(F.col("__points")),
                      F.monotonically_increasing_id().alias("__id"))
    obs = Observation()
    reg.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/regions")
    n = obs.get["n"]
    if not n:
        return None
    tree, counts, at = [], [n], None
    while at is None or counts[0] > NODE:
        level = spark.read.schema(reg.schema if at is None else at.schema).parquet(f"{root}/{'regions' if at is None else f'level-{len(tree)}'}")
        level = level.select("__id", *_BOX)  # edges are not sorted
        packed = _packed(level, counts[0], f"{root}/ranked-{len(tree)}")
        path = f"{root}/packed-{len(tree)}"
        packed.write.parquet(path)
        tree.insert(0, spark.read.schema(packed.schema).parquet(path))  # stored: the ranks stay what they are
        at = tree[0].groupBy(F.col("__up").alias("__id")).agg(F.min("__x0").alias("__x0"), F.min("__y0").alias("__y0"), F.max("__x1").alias("__x1"), F.max("__y1").alias("__y1"))
        counts.insert(0, math.ceil(counts[0] / NODE))
        at.write.parquet(f"{root}/level-{len(tree)}")
        at = spark.read.schema(at.schema).parquet(f"{root}/level-{len(tree)}")
    top = at.withColumn("__up", F.lit(0).cast("long"))
    return tree[-1], [top, *tree[:-1]], counts[:-1]


def _inlined(nodes: list[DataFrame]) -> list[str]:
    """The given levels as JSON: for each node of the level above (one root at first) its entries; ``i`` is an
    entry's place in its level, in the last level its number."""
    out, places = [], {0: 0}
    for k, level in enumerate(nodes):
        rows = level.select("__id", "__up", "__x0", "__y0", "__x1", "__y1").collect()  # at most INLINE
        below = [[] for _ in places]
        mine = {}
        for r in rows:
            mine[r["__id"]] = len(mine)
            below[places[r["__up"]]].append({"i": r["__id"] if k + 1 == len(nodes) else mine[r["__id"]],
                                             "__x0": r["__x0"], "__y0": r["__y0"], "__x1": r["__x1"], "__y1": r["__y1"]})
        out.append(json.dumps(below))
        places = mine
    return out


def _near_and_far(px: Column, py: Column, box: dict[str, Column]) -> tuple[Column, Column]:
    """Least distance of a point to a box, and one that the nearest of its contents cannot exceed: the
    farther end of the nearer side, as every side is touched."""
    x0, y0, x1, y1 = (box[c] for c in _BOX)
    dx, dy = F.greatest(x0 - px, F.lit(0.0), px - x1), F.greatest(y0 - py, F.lit(0.0), py - y1)
    ax, bx, ay, by = F.abs(px - x0), F.abs(px - x1), F.abs(py - y0), F.abs(py - y1)
    nx, fx, ny, fy = F.least(ax, bx), F.greatest(ax, bx), F.least(ay, by), F.greatest(ay, by)
    return F.sqrt(dx * dx + dy * dy), F.sqrt(F.least(nx * nx + fy * fy, fx * fx + ny * ny))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _alive(nodes: Column, entries: str, px: Column, py: Column, slack) -> Column:
    """Entries of the given nodes (places in a level) that may hold the nearest region, and how near they are."""
    below = F.from_json(F.lit(entries), "array<array<struct<i:long,__x0:double,__y0:double,__x1:double,__y1:double>>>")

    def measured(e: Column) -> Column:
        near, far = _near_and_far(px, py, {b: e[b] for b in _BOX})
        return F.struct(e["i"].alias("i"), near.alias("near"), far.alias("far"))

    met = F.transform(F.flatten(F.transform(nodes, lambda n: F.element_at(below, (n["i"] + 1).cast("int")))), measured)
    return _let(met, lambda m: _let(F.array_min(F.transform(m, lambda e: e["far"])), lambda bound: F.transform(
        F.filter(m, lambda e: e["near"] <= bound + slack(bound)), lambda e: F.struct(e["i"].alias("i"), e["near"].alias("near")))))


# ---------------------------------------------------------------- pairs, inside a task


@dataclass(frozen=True)
class _Held:
    """Regions of a node: boxes, and the edges of all regions of the node in a row."""

    names: pa.Array
    box: np.ndarray  # x0, y0, x1, y1
    edges: np.ndarray  # x1, y1, x2, y2
    span: np.ndarray  # x0, y0, x1, y1 of each edge, with a margin for rounding
    first: np.ndarray
    count: np.ndarray
    name: np.ndarray  # places in names

    @staticmethod
    def of(rows: list[pa.RecordBatch]) -> _Held:
        t = pa.Table.from_batches(rows).combine_chunks()
        lists = t["__edges"].combine_chunks()
        count = lists.value_lengths().to_numpy(zero_copy_only=False) // 4
        edges = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4).T)
        x1, y1, x2, y2 = edges
        margin = np.abs(edges).max(axis=0) * 1e-12
        margin[margin > HUGE] = np.inf  # sums and products may overflow: such an edge is near to all
        span = np.stack([np.minimum(x1, x2) - margin, np.minimum(y1, y2) - margin, np.maximum(x1, x2) + margin, np.maximum(y1, y2) + margin])
        box = np.stack([t[b].to_numpy() for b in _BOX])
        # regions near each other in runs: slabs by x, each by y
        slab = np.empty(len(count), np.int64)
        slab[np.argsort(box[0] + box[2], kind="stable")] = np.arange(len(count)) // (RUN * math.ceil(math.sqrt(len(count) / RUN)))
        order = np.lexsort((box[1] + box[3], slab))
        return _Held(t["__name"].combine_chunks(), box, edges, span, np.cumsum(count) - count, count, np.arange(len(count))).part(order)

    def runs(self) -> np.ndarray:
        """Boxes of the runs of ``RUN`` regions."""
        start = np.arange(0, len(self.first), RUN)
        return np.stack([*(np.minimum.reduceat(b, start) for b in self.box[:2]), *(np.maximum.reduceat(b, start) for b in self.box[2:])])

    def of_runs(self, which: np.ndarray) -> _Held:
        keep = (which[:, None] * RUN + np.arange(RUN)).ravel()
        return self.part(keep[keep < len(self.first)])

    def part(self, keep: np.ndarray | slice) -> _Held:
        return _Held(self.names, self.box[:, keep], self.edges, self.span, self.first[keep], self.count[keep], self.name[keep])

    def around(self, x: np.ndarray, y: np.ndarray, bound: float) -> _Held:
        """Regions that may be within ``bound`` of some of the points."""
        return self.part(np.flatnonzero(_gap(self.box, x, y) <= bound))

    def meet(self, x: np.ndarray, y: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """Regions that all points are inside of, and regions with an edge within ``margin`` of the points' box.
        Where no edge is, all points cross as often, odd or even, as the rings are closed; so one point tells for all."""
        if not len(self.first):
            return np.zeros(0, bool), np.zeros(0, bool)
        at, _, start = self._edges_of()
        x0, y0, x1, y1 = self.span[:, at]
        margin += max(abs(x.min()), abs(x.max()), abs(y.min()), abs(y.max())) * 1e-12
        near = (x1 >= x.min() - margin) & (x0 <= x.max() + margin) & (y1 >= y.min() - margin) & (y0 <= y.max() + margin)
        mixed = np.logical_or.reduceat(near, start)
        odd = np.add.reduceat(self._crosses(x[:1], y[:1], at), start, axis=1, dtype=np.int64)[0] % 2 == 1
        return odd & ~mixed, mixed

    def _edges_of(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the regions' edges, the region of each, and where each region's begin."""
        start = np.cumsum(self.count) - self.count
        of = np.repeat(np.arange(len(self.count)), self.count)
        return np.repeat(self.first - start, self.count) + np.arange(len(of)), of, start

    def _crosses(self, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which edges each point's ray crosses."""
        x1, y1, x2, y2 = self.edges[:, at]
        qx, qy = x[:, None], y[:, None]
        return ((y1 > qy) != (y2 > qy)) & (qx < (x2 - x1) * (qy - y1) / (y2 - y1) + x1)

    def inside(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which points (rows) are inside which regions."""
        out = np.zeros((len(x), len(self.first)), bool)
        at, of, _ = self._edges_of()
        _, y0, x1, y1 = self.span[:, at]
        some = np.flatnonzero((x1 >= x.min()) & (y1 >= y.min()) & (y0 <= y.max()))  # no ray crosses others
        at, of = at[some], of[some]
        ends = np.flatnonzero(np.append(of[1:] != of[:-1], True)) + 1 if len(of) else np.zeros(0, int)
        i = 0
        while i < len(ends):  # regions at a time, by their edges
            lo = ends[i - 1] if i else 0
            j = max(int(np.searchsorted(ends, lo + EDGES, side="right")), i + 1)
            starts = np.concatenate([[0], ends[i:j - 1] - lo])
            crosses = self._crosses(x, y, at[lo:ends[j - 1]])
            out[:, of[lo + starts]] = np.add.reduceat(crosses, starts, axis=1, dtype=np.int64) % 2 == 1
            i = j
        return out

    def edge_distances(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Points, regions and the distances of points to edges of those, of all that may be at most ``most`` (by point)."""
        at, of, _ = self._edges_of()
        x0, y0, x1, y1 = self.span[:, at]
        reach = most.max()
        some = np.flatnonzero((x1 >= x.min() - reach) & (x0 <= x.max() + reach) & (y1 >= y.min() - reach) & (y0 <= y.max() + reach))
        for i in range(0, len(some), EDGES):
            e = some[i:i + EDGES]
            dx = np.maximum(np.maximum(x0[e] - x[:, None], x[:, None] - x1[e]), 0.0)
            dy = np.maximum(np.maximum(y0[e] - y[:, None], y[:, None] - y1[e]), 0.0)
            p, k = np.nonzero(np.sqrt(dx * dx + dy * dy) <= most[:, None])
            if len(p):
                yield p, of[e[k]], _distance(x[p], y[p], self.edges[:, at[e[k]]])


def _near(box: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of points (rows) to boxes."""
    x0, y0, x1, y1 = box
    dx, dy = np.maximum(np.maximum(x0 - x[:, None], 0.0), x[:, None] - x1), np.maximum(np.maximum(y0 - y[:, None], 0.0), y[:, None] - y1)
    return np.sqrt(dx * dx + dy * dy)


def _far(box: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """As in ``_near_and_far``."""
    ax, ay, bx, by = (np.abs(v[:, None] - b) for v, b in zip((x, y, x, y), box, strict=True))
    nx, fx, ny, fy = np.minimum(ax, bx), np.maximum(ax, bx), np.minimum(ay, by), np.maximum(ay, by)
    return np.sqrt(np.minimum(nx * nx + fy * fy, fx * fx + ny * ny))


def _gap(box: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of each box to the points' box."""
    x0, y0, x1, y1 = box
    dx, dy = np.maximum(np.maximum(x0 - x.max(), 0.0), x.min() - x1), np.maximum(np.maximum(y0 - y.max(), 0.0), y.min() - y1)
    return np.sqrt(dx * dx + dy * dy)


def _distance(x: np.ndarray, y: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """As ``_segment_distance``."""
    x1, y1, x2, y2 = edges
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    t = np.where(len2 == 0, 0.0, ((x - x1) * dx + (y - y1) * dy) / len2)
    t = np.minimum(np.maximum(t, 0.0), 1.0)
    cx, cy = x1 + t * dx, y1 + t * dy
    d = np.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))
    return np.where(np.isnan(d), np.inf, d)


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[_Held, pa.RecordBatch]]:
    """Of rows in the order of node and part, regions before points: tiles of points near each other, with their
    regions; each run of ``BLOCK`` points of a tile are nearer still."""
    key, rows, held = None, [], None
    for b in batches:
        keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("__node", "__part", "__is_point")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i == j:
                continue
            if key != (k := tuple(keys[i][:2])):
                key, rows, held = k, [], None
            if not keys[i][2]:
                rows.append(b.slice(i, j - i).select(["__name", "__edges", *_BOX]))
                continue
            held = held or _Held.of(rows)
            # points come by x: strips of them, each by y, as many as make blocks about as wide as high
            points = b.slice(i, j - i)
            x, y = _at(points)
            blocks = (j - i) / BLOCK
            wide = (x.max() - x.min()) / max(y.max() - y.min(), 1e-300)
            strips = min(max(math.sqrt(min(blocks * wide, blocks * blocks)), 1.0), blocks) if blocks > 1 else 1.0
            strip = np.arange(j - i) // (BLOCK * math.ceil(blocks / strips))
            points = points.take(pa.array(np.lexsort((y, strip))))
            for at in range(0, j - i, TILE):
                yield held, points.slice(at, TILE)


def _at(points: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return points.column("__px").to_numpy(), points.column("__py").to_numpy()


def _bound(box: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
    """What the nearest contents of any of the boxes cannot exceed, for any of the points: what is near to one is near to all."""
    return _far(box, x[:1], y[:1]).min() + np.hypot(x.max() - x.min(), y.max() - y.min())


def _held_by_one(held: _Held, x: np.ndarray, y: np.ndarray) -> bool:
    """Whether all points are inside of a region."""
    x0, y0, x1, y1 = held.box
    holding = np.flatnonzero((x0 <= x.min()) & (x1 >= x.max()) & (y0 <= y.min()) & (y1 >= y.max()))
    return any(held.part(holding[at:at + CHUNK]).meet(x, y, 0.0)[0].any() for at in range(0, len(holding), CHUNK))


def _least(slack: Callable) -> Callable:
    """Least distance of each point to the regions of its node."""

    def of_block(held: _Held, runs: np.ndarray, box: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        bound = _bound(box, x, y)
        some = np.flatnonzero(_gap(box, x, y) <= bound + slack(bound))
        runs, box = runs[some], box[:, some]
        most = _far(box, x, y).min(axis=1)  # of each point: a block of far points may be wide
        held = held.of_runs(runs[(_near(box, x, y) <= (most + slack(most))[:, None]).any(axis=0)])
        gap = _gap(held.box, x, y)
        if _held_by_one(held, x, y):
            return np.zeros(len(x))
        best = np.full(len(x), np.inf)
        order = np.argsort(gap, kind="stable")
        held, gap = held.part(order), gap[order]
        for at in range(0, len(gap), CHUNK):
            left = np.flatnonzero((best > 0) & (gap[at] <= most + slack(most)))
            if not len(left):
                break
            some, px, py = held.part(slice(at, at + CHUNK)), x[left], y[left]
            in_one = some.inside(px, py).any(axis=1)
            best[left[in_one]] = most[left[in_one]] = 0.0
            left, px, py = left[~in_one], px[~in_one], py[~in_one]
            if len(left):
                most[left] = np.minimum(most[left], _far(some.box, px, py).min(axis=1))
                for p, _, d in some.edge_distances(px, py, most[left] + slack(most[left])):
                    np.minimum.at(best, left[p], d)
                most[left] = np.minimum(most[left], best[left])
        return best

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, box = None, np.zeros((4, 0))
        with np.errstate(all="ignore"):
            for held, points in _tiles(batches):
                if held is not of:
                    of, box = held, held.runs()
                x, y = _at(points)
                bound = _bound(box, x, y)
                runs = np.flatnonzero(_gap(box, x, y) <= bound + slack(bound))
                best = [of_block(held, runs, box[:, runs], x[at:at + BLOCK], y[at:at + BLOCK]) for at in range(0, len(x), BLOCK)]
                yield pa.record_batch({"__pid": points.column("__pid"), "__d": pa.array(np.concatenate(best))})

    return run


def _at_least_distance(slack: Callable, tie_tolerance: float) -> Callable:
    """Points and names of regions that belong to each other, each with each: the regions within ``tie_tolerance``
    of the points' least distance. Regions that hold a whole block of points come once for the block."""

    def of_block(held: _Held, runs: np.ndarray, box: np.ndarray, x: np.ndarray, y: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Points and how many of them make a row, names and how many of them."""
        most = least + slack(least)
        some = np.flatnonzero(_gap(box, x, y) <= most.max())
        # by point, as a block of far points may be wide
        held = held.of_runs(runs[some[(_near(box[:, some], x, y) <= most[:, None]).any(axis=0)]]).around(x, y, most.max())
        whole, mixed = held.meet(x, y, most.max())
        if whole.any():
            yield np.arange(len(x)), np.array([len(x)]), held.name[whole], np.array([whole.sum()])
        some = held.part(np.flatnonzero(mixed))
        if not len(some.first):
            return
        fits = some.inside(x, y)
        for p, r, d in some.edge_distances(x, y, most):
            ok = d <= least[p] + tie_tolerance
            fits[p[ok], r[ok]] = True
        n = fits.sum(axis=1)
        who = np.flatnonzero(n)
        yield who, np.ones(len(who), np.int64), some.name[np.nonzero(fits)[1]], n[who]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, box = None, np.zeros((4, 0))
        with np.errstate(all="ignore"):
            for held, points in _tiles(batches):
                if held is not of:
                    of, box = held, held.runs()
                x, y = _at(points)
                least = points.column("__min").to_numpy()
                runs = np.flatnonzero(_gap(box, x, y) <= (least + slack(least)).max())
                found, n = [], 0
                for at in range(0, len(x), BLOCK):
                    to = at + BLOCK
                    for who, many, names, count in of_block(held, runs, box[:, runs], x[at:to], y[at:to], least[at:to]):
                        found.append((who + at, many, names, count))
                        n += len(names)
                    if found and (n > NAMES or to >= len(x)):
                        who, many, names, count = (np.concatenate(v) for v in zip(*found, strict=True))
                        lists = lambda n, v: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), v)
                        yield pa.record_batch({"__rows": lists(many, points.column("__row").take(pa.array(who))),
                                               "__names": lists(count, held.names.take(pa.array(names)))})
                        found, n = [], 0

    return run


def nearest_region(points: DataFrame, regions: DataFrame, x: str = "longitude", y: str = "latitude",
                   name_col: str = "name", out: str = "region", tie_tolerance: float = 1e-9) -> DataFrame:
    """Left nearest join: every point keeps a row; ties give one row per region."""
    from lakehold.session import shared_dir

    spark = points.sparkSession
    root = shared_dir(spark, "nearest")
    built = _region_tree(regions, name_col, root)
    kind = regions.schema[name_col].dataType
    if built is None:
        return points.withColumn(out, F.lit(None).cast(kind))
    reg, levels, counts = built
    with_id = points.withColumn("__pid", F.monotonically_increasing_id())
    with_id.write.parquet(f"{root}/points")
    pts = spark.read.schema(with_id.schema).parquet(f"{root}/points")

    px, py = F.col("__px"), F.col("__py")
    # distances of far points carry rounding errors in proportion to their size
    slack = lambda bound: tie_tolerance + bound * 1e-12
    placed = _finite(F.col(x)) & _finite(F.col(y))
    open_ = pts.where(placed).select("__pid", F.col(x).cast("double").alias("__px"), F.col(y).cast("double").alias("__py"))

    # the upper levels, in the point's own row: much work for few bytes, so few files are dealt over all cores
    cores = spark.sparkContext.defaultParallelism
    if pts.rdd.getNumPartitions() < cores:
        open_ = open_.repartition(cores, "__pid")
    above, below = [], []  # levels down to that of the groups, and those between it and the regions
    last = max(len(levels) - round(math.log(GROUP, NODE)), 0)
    last -= last > 0 and counts[last] > GROUPS  # the fewer nodes, the fewer of them a point meets
    for k, level in enumerate(levels):
        (above if k <= last else below).append(level)
    small = sum(c <= INLINE for c in counts[:len(above)])
    alive = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0.0).alias("near")))
    for entries in _inlined(above[:small]):
        alive = _alive(alive, entries, px, py, slack)
    # never empty; the outer form keeps the optimizer from copying the expression into a filter
    open_ = open_.select("__pid", "__px", "__py", F.explode_outer(alive).alias("__at")).select(
        "__pid", "__px", "__py", F.col("__at.i").alias("__node"), F.col("__at.near").alias("__near"))

    # the others, by joins
    per_point = Window.partitionBy("__pid")
    for nodes in above[small:]:
        cand = open_.select("__pid", "__px", "__py", "__node").join(nodes, F.col("__node") == F.col("__up"))
        near, far = _near_and_far(px, py, {b: F.col(b) for b in _BOX})
        cand = cand.withColumns({"__near": near, "__far": far}).withColumn("__bound", F.min("__far").over(per_point))
        open_ = cand.where(F.col("__near") <= F.col("__bound") + slack(F.col("__bound"))).select(
            "__pid", "__px", "__py", F.col("__id").alias("__node"), "__near")
    open_.write.parquet(f"{root}/met")
    met = spark.read.schema(open_.schema).parquet(f"{root}/met")

    # points meet the regions of their nodes, those of a node with many points in parts
    node_of = reg.select(F.col("__id").alias("__region"), F.col("__up").alias("__node"))
    for nodes in reversed(below):
        node_of = node_of.join(nodes.select(F.col("__id").alias("__node"), "__up"), "__node").select("__region", F.col("__up").alias("__node"))
    n_met = met.count()
    part = max(min(PART, n_met // (4 * cores)), BLOCK)
    parts = met.groupBy("__node").agg(F.ceil(F.count(F.lit(1)) / part).alias("__parts"))
    held = spark.read.parquet(f"{root}/regions").join(node_of, F.col("__id") == F.col("__region")).join(parts, "__node").select(
        "__node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1)).alias("__part"), "__name", "__edges", *_BOX)
    tasks = max(cores, min(n_met // part + counts[len(above) - 1], 10000))

    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.join(parts, "__node").withColumn("__part", F.pmod(F.xxhash64("__pid"), F.col("__parts"))).drop("__parts")
        both = held.withColumn("__is_point", F.lit(0).cast("long")).unionByName(rows.withColumn("__is_point", F.lit(1).cast("long")), allowMissingColumns=True)
        return both.repartition(tasks, "__node", "__part").sortWithinPartitions("__node", "__part", "__is_point", "__px")

    least = dealt(met.drop("__near")).mapInArrow(_least(slack), "__pid long, __d double").groupBy("__pid").agg(F.min("__d").alias("__min"))
    near_enough = met.join(least, "__pid").where(F.col("__near") <= F.col("__min") + slack(F.col("__min"))).drop("__near")
    rows = near_enough.join(pts.select("__pid", F.struct(*points.columns).alias("__row")), "__pid")
    found = StructType([StructField("__rows", ArrayType(points.schema)), StructField("__names", ArrayType(kind))])
    best = dealt(rows).mapInArrow(_at_least_distance(slack, tie_tolerance), found).select(F.explode("__rows").alias("__row"), "__names")
    best = best.select("__row.*", F.explode("__names").alias(out))
    return best.unionByName(pts.where(~placed).select(*points.columns, F.lit(None).cast(kind).alias(out)))
