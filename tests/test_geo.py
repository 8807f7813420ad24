import math
import random
import struct

from pyspark.sql import functions as F

from lakehold.operators import geo
from lakehold.sources import wkb

# Five borough-like boxes (x = longitude, y = latitude).
BOXES = [("Manhattan", -74.02, 40.70, -73.93, 40.88), ("Brooklyn", -74.05, 40.57, -73.85, 40.69),
         ("Queens", -73.96, 40.54, -73.70, 40.80), ("Bronx", -73.93, 40.79, -73.76, 40.92),
         ("Staten Island", -74.26, 40.49, -74.05, 40.65)]


def test_nearest_borough(spark):
    pts = spark.createDataFrame([(1, 40.77, -74.00), (2, 40.60, -74.00)], "id int, latitude double, longitude double")
    out = {r.id: r.region for r in geo.nearest_region(pts, geo.boxes(spark, BOXES)).collect()}
    assert out == {1: "Manhattan", 2: "Brooklyn"}


def test_outside_point_and_ties(spark):
    regions = geo.boxes(spark, [("A", 0.0, 0.0, 1.0, 1.0), ("B", 3.0, 0.0, 4.0, 1.0)])
    pts = spark.createDataFrame([(1, 0.5, 2.0), (2, 0.5, 5.0)], "id int, latitude double, longitude double")
    out = sorted((r.id, r.region) for r in geo.nearest_region(pts, regions).collect())
    assert out == [(1, "A"), (1, "B"), (2, "B")]


def test_edge_point_is_inside(spark):
    regions = geo.boxes(spark, [("A", 0.0, 0.0, 1.0, 1.0), ("B", 1.0, 0.0, 2.0, 1.0)])
    pts = spark.createDataFrame([(1, 0.5, 1.0)], "id int, latitude double, longitude double")
    assert sorted(r.region for r in geo.nearest_region(pts, regions).collect()) == ["A", "B"]


def test_polygon_distance_triangle(spark):
    df = spark.createDataFrame([(0.2, 0.2), (2.0, 0.0)], "x double, y double")
    tri = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]])
    d = [round(r[0], 9) for r in df.select(geo.polygon_distance(F.col("x"), F.col("y"), tri)).collect()]
    assert d == [0.0, 1.0]


def brute(points, boxes_, tol=1e-9):
    out = set()
    for i, lat, lon in points:
        d = {n: math.hypot(max(x0 - lon, 0, lon - x1), max(y0 - lat, 0, lat - y1)) for n, x0, y0, x1, y1 in boxes_}
        best = min(d.values())
        out |= {(i, n) for n, v in d.items() if v <= best + tol}
    return out


def test_equals_brute_force_for_near_and_far_points(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(400):  # tiny regions, some large ones, clusters and repeats
        x0, y0 = (rnd.uniform(-50, 50), rnd.uniform(-50, 50)) if i % 3 else (rnd.gauss(20, 0.5), rnd.gauss(20, 0.5))
        w = rnd.uniform(0.01, 0.3) if i % 40 else rnd.uniform(20, 60)
        rows.append((f"r{i}", x0, y0, x0 + w, y0 + w / 2))
    rows += [("twin-a", 1.0, 1.0, 2.0, 2.0), ("twin-b", 1.0, 1.0, 2.0, 2.0)]
    pts = [(i, rnd.uniform(-80, 80), rnd.uniform(-80, 80)) for i in range(300)]
    pts += [(300 + i, rnd.uniform(-1e6, 1e6), rnd.uniform(-1e6, 1e6)) for i in range(50)]  # far away
    df = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    got = {(r.id, r.region) for r in geo.nearest_region(df, geo.boxes(spark, rows)).collect()}
    want = brute(pts, rows)
    near = {(i, n) for i, n in want if i < 300}
    assert {(i, n) for i, n in got if i < 300} == near
    # so far away, several regions may differ by rounding only
    assert {i for i, _ in got} == set(range(350)) and len(got & want) >= 345


def test_bad_points_and_regions(spark):
    nan, inf = float("nan"), float("inf")
    pts = spark.createDataFrame([(1, nan, 0.0), (2, None, 0.0), (3, 0.0, inf), (4, 0.5, 0.5), (4, 0.5, 0.5)], "id int, latitude double, longitude double")
    regions = geo.boxes(spark, [("A", 0.0, 0.0, 1.0, 1.0), ("B", 0.0, 0.0, nan, 1.0)]).unionByName(
        spark.createDataFrame([("C", None), ("D", [])], f"name string, vertices {geo.VERTICES}"))
    got = sorted((r.id, r.region or "") for r in geo.nearest_region(pts, regions).collect())
    assert got == [(1, ""), (2, ""), (3, ""), (4, "A"), (4, "A")]
    none = geo.nearest_region(pts, regions.where("name > 'B'"))
    assert none.count() == 5 and none.where("region is not null").count() == 0
    assert geo.nearest_region(pts.limit(0), regions).count() == 0


def test_regions_from_files_and_vertex_rows(spark, tmp_path):
    boxes_ = geo.boxes(spark, BOXES)
    boxes_.write.parquet(str(tmp_path / "p"))
    boxes_.write.json(str(tmp_path / "j"))
    want = sorted(map(repr, boxes_.collect()))
    assert sorted(map(repr, geo.read_regions(spark, str(tmp_path / "p")).collect())) == want
    assert sorted(map(repr, geo.read_regions(spark, str(tmp_path / "j"), "json").collect())) == want
    rows = boxes_.select("name", F.posexplode("vertices").alias("seq", "v")).select("name", "seq", "v.x", "v.y").orderBy(F.rand(1))
    assert sorted(map(repr, geo.regions_from_vertices(rows).collect())) == want


def test_an_outlier_does_not_fill_a_node(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"r{i}", x := rnd.gauss(0, 1), y := rnd.gauss(0, 1), x + 0.01, y + 0.01) for i in range(1500)] + [("far", 1e6, 1e6, 1e6 + 1, 1e6 + 1)]
    rows += [(f"same{i}", 5.0, 5.0, 6.0, 6.0) for i in range(100)]  # equal boxes, too
    reg, levels, counts = geo._region_tree(geo.boxes(spark, rows), "name", str(tmp_path / "t"))
    for level in (reg, *levels):
        assert level.groupBy("__up").count().agg(F.max("count")).first()[0] <= geo.NODE
    assert counts == [level.count() for level in levels] == [1, 7, 101][-len(counts):]
    pts = [(i, rnd.gauss(0, 2), rnd.gauss(0, 2)) for i in range(200)] + [(200, 9e5, 9e5)]
    df = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    got = {(r.id, r.region) for r in geo.nearest_region(df, geo.boxes(spark, rows)).collect()}
    assert got == brute(pts, rows)


def test_levels_by_joins_equal_levels_in_the_row(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(f"r{i}", x := rnd.uniform(-9, 9), y := rnd.uniform(-9, 9), x + rnd.uniform(0, 2), y + rnd.uniform(0, 2)) for i in range(700)]
    pts = [(i, rnd.uniform(-12, 12), rnd.uniform(-12, 12)) for i in range(150)] + [(150, None, 1.0)]
    df = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    want = brute(pts[:150], rows)
    for inline, one_task in ((geo.INLINE, 10), (0, geo.ONE_TASK), (16, 0)):
        monkeypatch.setattr(geo, "INLINE", inline)
        monkeypatch.setattr(geo, "ONE_TASK", one_task)
        got = {(r.id, r.region) for r in geo.nearest_region(df, geo.boxes(spark, rows)).collect()}
        assert got == want | {(150, None)}


def ring_distance(x, y, rings):
    """Odd parity over all rings, else the least distance to an edge."""
    inside, best = False, math.inf
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
            dx, dy = x2 - x1, y2 - y1
            t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
            best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return 0.0 if inside else best


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def test_holes_and_parts(spark):
    shapes = {"holed": [box(0, 0, 10, 10), box(2, 2, 8, 8)], "two": [box(20, 0, 22, 2), box(30, 0, 34, 4)], "in-hole": [box(4, 4, 5, 5)],
              "triangles": [[(0.0, 20.0), (4.0, 20.0), (0.0, 24.0)], [(10.0, 20.0), (14.0, 20.0), (12.0, 26.0)]]}
    rings = [(n, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rs]) for n, rs in shapes.items()] + [("none", None), ("empty", [[], None])]
    regions = spark.createDataFrame(rings, f"name string, rings {wkb.RINGS}")
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-5, 40), rnd.uniform(-5, 30)) for i in range(400)] + [(400, 4.5, 4.5), (401, 2.5, 5.0), (402, 3.9, 4.5)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    want = set()
    for i, x, y in pts:
        d = {n: ring_distance(x, y, rs) for n, rs in shapes.items()}
        want |= {(i, n) for n, v in d.items() if v <= min(d.values()) + 1e-9}
    for form in (regions, wkb.write_rings(regions)):
        got = {(r.id, r.region) for r in geo.nearest_region(df, form, x="x", y="y").collect()}
        assert got == want
    assert {r for i, r in want if i == 400} == {"in-hole"} and {r for i, r in want if i == 401} == {"holed"}


def test_geometry_files(spark, tmp_path):
    regions = geo.boxes(spark, BOXES).select(F.col("name").alias("boro"), F.array("vertices").alias("rings"))
    wkb.write_rings(regions, out="shape").write.parquet(str(tmp_path / "g"))
    pts = spark.createDataFrame([(1, 40.77, -74.00), (2, 40.60, -74.00)], "id int, latitude double, longitude double")
    read = geo.read_geometries(spark, str(tmp_path / "g"), "boro", "shape")
    assert {r.id: r.region for r in geo.nearest_region(pts, read).collect()} == {1: "Manhattan", 2: "Brooklyn"}


def test_well_known_binary_forms():
    ring = struct.pack("<I8d", 4, 0, 0, 1, 0, 1, 1, 0, 0)
    plain = struct.pack("<BII", 1, 3, 1) + ring
    want = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    big = struct.pack(">BII", 0, 3, 1) + struct.pack(">I8d", 4, 0, 0, 1, 0, 1, 1, 0, 0)
    z = struct.pack("<I12d", 4, 0, 0, 9, 1, 0, 9, 1, 1, 9, 0, 0, 9)
    forms = [plain, big, struct.pack("<BII", 1, 1003, 1) + z, struct.pack("<BII", 1, 3 | wkb.FLAG_Z, 1) + z,
             struct.pack("<BIII", 1, 3 | wkb.FLAG_SRID, 4326, 1) + ring, struct.pack("<BII", 1, 6, 1) + plain, struct.pack(">BII", 0, 7, 1) + plain]
    for f in forms:
        assert [r.tolist() for r in wkb.decode(f)] == [want]
    assert [r.tolist() for r in wkb.decode(struct.pack("<BII", 1, 6, 2) + plain + big)] == [want, want]
    point, nested = struct.pack("<BIdd", 1, 1, 0, 0), b"".join([struct.pack("<BII", 1, 7, 1)] * 40) + plain
    for bad in (None, b"", b"\x01", plain[:-1], b"\x02" + plain[1:], point, struct.pack("<BII", 1, 6, 9) + plain, nested, struct.pack("<BII", 1, 3, 0)):
        assert wkb.decode(bad) is None
    assert wkb.encode(None) is None and wkb.encode([]) is None
    assert [r.tolist() for r in wkb.decode(wkb.encode([[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]]))] == [want]


def test_pairs_stay_inside_a_task(spark):
    regions = geo.boxes(spark, [(f"r{i}", -float(i), -1.0, 10.0 + i, 11.0) for i in range(300)])
    pts = spark.range(300).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") / 30).alias("y"))
    df = geo.nearest_region(pts, regions, x="x", y="y")
    plan = df._jdf.queryExecution().executedPlan().toString()
    after_pairs = plan.split("MapInArrow")[0]  # nothing deals, sorts or joins the pairs again
    assert "MapInArrow" in plan and not any(s in after_pairs for s in ("Exchange", "Window", "Join", "Sort"))
    assert df.count() == df.distinct().count() == 300 * 300


def test_groups_and_parts_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(f"r{i}", x := rnd.uniform(-9, 9), y := rnd.uniform(-9, 9), x + rnd.uniform(0, 4), y + rnd.uniform(0, 4)) for i in range(500)]
    pts = [(i, rnd.uniform(-15, 15), rnd.uniform(-15, 15)) for i in range(200)] + [(200 + i, 1.0, 2.0) for i in range(600)] + [(800, 1e5, -3.0)]
    df = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    want = brute(pts, rows)
    for inline in (geo.INLINE, 0):
        monkeypatch.setattr(geo, "INLINE", inline)
        for name, value in (("GROUP", geo.NODE), ("PART", 50), ("BLOCK", 20)):
            monkeypatch.setattr(geo, name, value)
        assert {(r.id, r.region) for r in geo.nearest_region(df, geo.boxes(spark, rows)).collect()} == want


def test_columns_of_points_and_names_of_any_type_come_back(spark):
    pts = spark.sql("""SELECT * FROM VALUES
        (1, timestamp '2024-03-31 01:30:00', timestamp_ntz '1900-01-01 00:00:00', date '0001-01-01', 1.50BD, map('a', array(1, null)), cast('x' AS binary), 0.5D, 0.5D),
        (2, null, null, null, null, null, null, 1.0D, 1.0D), (null, null, null, null, null, null, null, null, 1.0D) AS t(id, ts, ntz, d, n, m, b, x, y)""")
    regions = geo.boxes(spark, [("7", 0.0, 0.0, 1.0, 1.0), ("8", 1.0, 1.0, 2.0, 2.0), (None, 0.0, 0.0, 1.0, 1.0)]).withColumn("name", F.col("name").cast("int"))
    got = geo.nearest_region(pts, regions, x="x", y="y")
    want = pts.withColumn("region", F.explode(F.expr("CASE id WHEN 1 THEN array(7, null) WHEN 2 THEN array(7, 8, null) ELSE array(cast(null AS int)) END")))
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def _pair_batches(regions, points, least=None):
    import numpy as np
    import pyarrow as pa

    flat = lambda rings: [v for ring in rings for a, b in zip(ring, ring[1:] + ring[:1]) for v in (*a, *b)]
    xs, ys = [[[v[k] for ring in r for v in ring] for r in regions] for k in (0, 1)]
    key = lambda n, point: {"__node": pa.array([0] * n, pa.int64()), "__part": pa.array([0] * n, pa.int64()), "__is_point": pa.array([point] * n, pa.int64())}
    box = {"__x0": [min(v) for v in xs], "__y0": [min(v) for v in ys], "__x1": [max(v) for v in xs], "__y1": [max(v) for v in ys]}
    yield pa.record_batch({**key(len(regions), 0), "__name": [f"r{i}" for i in range(len(regions))], "__edges": pa.array([flat(r) for r in regions], pa.list_(pa.float64())), **box})
    order = sorted(range(len(points)), key=lambda i: points[i][0])
    more = {} if least is None else {"__min": pa.array(np.array(least)[order]), "__row": pa.array([{"k": i} for i in order])}
    yield pa.record_batch({**key(len(points), 1), "__pid": pa.array(order, pa.int64()), "__px": [points[i][0] for i in order], "__py": [points[i][1] for i in order], **more})


def test_blocks_of_points_meet_regions_as_each_point_does(monkeypatch):
    import math

    rnd = random.Random(3)
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    regions = [[square(rnd.uniform(-1, 1), rnd.uniform(-1, 1), rnd.uniform(0.1, 2))] for _ in range(60)]
    regions += [[square(-3, -3, w), square(-1, -1, w / 3)] for w in (4.0, 5.0, 6.0)]  # a hole
    regions += [[square(-5, -5, 1.0), square(5, 5, 1.0)], [[(-9.0, 0.0), (9.0, 1.0), (0.0, 9.0)]], [[(0.25, 0.25)]], [[(0.0, 7.0), (1.0, 7.0)]]]
    points = [(rnd.uniform(-1, 1), rnd.uniform(-1, 1)) for _ in range(400)] + [(rnd.uniform(-9, 9), rnd.uniform(-9, 9)) for _ in range(60)]
    points += [(rnd.uniform(-9e4, 9e4), rnd.uniform(-9e4, 9e4)) for _ in range(40)] + [(-3.0, -3.0), (0.25, 0.25), (-1.0, 0.0)]

    def distance(p, rings):
        edges = [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]
        if sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0] for a, b in edges) % 2:
            return 0.0
        out = []
        for a, b in edges:
            dx, dy = b[0] - a[0], b[1] - a[1]
            t = min(max(((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy), 0.0), 1.0) if dx or dy else 0.0
            out.append(math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy))
        return min(out)

    all_ = [[distance(p, r) for r in regions] for p in points]
    want = {(i, f"r{j}") for i, ds in enumerate(all_) for j, d in enumerate(ds) if d <= min(ds) + 1e-9}
    slack = lambda bound: 1e-9 + bound * 1e-12
    for small in ({}, {"BLOCK": 8, "TILE": 32, "CHUNK": 5, "EDGES": 7, "RUN": 4, "NAMES": 10}):
        for name, value in small.items():
            monkeypatch.setattr(geo, name, value)
        least = {p: d for b in geo._least(slack)(_pair_batches(regions, points)) for p, d in zip(b["__pid"].to_pylist(), b["__d"].to_pylist(), strict=True)}
        assert all(math.isclose(least[i], min(ds), rel_tol=1e-12, abs_tol=1e-12) for i, ds in enumerate(all_))
        found = [r for b in geo._at_least_distance(slack, 1e-9)(_pair_batches(regions, points, [least[i] for i in range(len(points))])) for r in b.to_pylist()]
        pairs = [(row["k"], name) for r in found for row in r["__rows"] for name in r["__names"]]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
        # a region around a block comes once for all of its points
        assert sum(len(r["__rows"]) > 1 for r in found)


def test_many_nodes_make_larger_ones(spark, tmp_path, monkeypatch):
    rnd = random.Random(5)
    rows = [(f"r{i}", x := rnd.uniform(0, 9), y := rnd.uniform(0, 9), x + rnd.random(), y + rnd.random()) for i in range(700)]
    regions = geo.boxes(spark, rows)
    pts = spark.createDataFrame([(i, rnd.uniform(-1, 11), rnd.uniform(-1, 11)) for i in range(300)], "id int, x double, y double")
    run = lambda: sorted(map(tuple, geo.nearest_region(pts, regions, x="x", y="y").select("id", "region").collect()))
    want = run()
    monkeypatch.setattr(geo, "GROUP", geo.NODE)
    few = run()
    monkeypatch.setattr(geo, "GROUPS", 3)
    assert run() == few == want
