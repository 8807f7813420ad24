"""Registered queries: every operator applied to the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose work grows with
the tables. Hash-valued columns (no SQL twin) are dropped from the compared output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakehold.functions.columns import ts_ntz
from lakehold.operators import control, geo, layout, quality, scd2, transform, upsert
from lakehold.plans import health, marts, roles
from lakehold.plans.roles import AS_OF, EVENT_CUTOFF, WEATHER_BY_EVENT, table
from lakehold.sources import grid, observations

# Hot-key splits for per-key neighbour windows: a station's versions are windowed per
# (station, month) and a user's change log per (user, day); bucket edges are joined
# from a small edge set (see operators/windows.py). Buckets come from the data, so
# every branch and every retry computes the same bucket for a row.
def VERSION_SPLIT():  # noqa: N802 - columns need a live session, so built on call
    return F.date_trunc("month", F.col("valid_from"))


def MART_SPLIT():  # noqa: N802
    return F.date_trunc("month", F.col("date_last_status_update"))


def LOG_SPLIT():  # noqa: N802
    return F.date_trunc("day", F.col("ts"))

# ---------------------------------------------------------------- marts


def station_facts(spark, sf):
    v, c, w = roles.mart_inputs(spark, sf, VERSION_SPLIT())
    return marts.station_facts(v, c, w, AS_OF, mode="parity", split=MART_SPLIT(), **roles.FACT_KW)


def station_facts_corrected(spark, sf):
    v, c, w = roles.mart_inputs(spark, sf, VERSION_SPLIT())
    return marts.station_facts(v, c, w, AS_OF, mode="corrected", split=MART_SPLIT(), **roles.FACT_KW)


def station_dim(spark, sf):
    v, c, w = roles.mart_inputs(spark, sf)
    return marts.station_dim(v, c, w, AS_OF, **roles.MART_KW)


def station_dim_corrected(spark, sf):
    v, c, w = roles.mart_inputs(spark, sf)
    return marts.station_dim(v, c, w, AS_OF, mode="corrected", **roles.MART_KW)


def weather_dim(spark, sf):
    v, c, w = roles.mart_inputs(spark, sf)
    return marts.weather_dim(v, c, w, AS_OF, **roles.MART_KW)


# ---------------------------------------------------------------- JSON documents


def json_path_project(spark, sf):
    e = table(spark, sf, "events")
    out = transform.extract_json(e, "props", {"k": "k", "missing.x": "missing_x"}, keep=["event_id"])
    return out.withColumn("k_int", F.col("k").try_cast("int"))


LINE = StructType([
    StructField("LineNumber", IntegerType()), StructField("PartKey", LongType()),
    StructField("Quantity", DoubleType()),
    StructField("Flags", StructType([StructField("Return", StringType()), StructField("Status", StringType())])),
])


def order_documents(spark, sf) -> DataFrame:
    """Landing documents ``(o_orderkey, raw)``: one JSON array with all lines of the order;
    orders without lines get an empty or malformed array."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    elem = F.struct(F.col("l_linenumber").alias("LineNumber"), F.col("l_partkey").alias("PartKey"),
                    F.col("l_quantity").alias("Quantity"),
                    F.struct(F.col("l_returnflag").alias("Return"), F.col("l_linestatus").alias("Status")).alias("Flags"))
    # an order has a handful of lines, so the array of a key is small
    docs = (li.join(o.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
            .groupBy("l_orderkey").agg(F.to_json(F.collect_list(elem)).alias("raw")))
    docs = docs.select(F.col("l_orderkey").alias("o_orderkey"), "raw")
    empty = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("[{\"LineNumber\": ")).otherwise(F.lit("[]")).alias("raw"))
    return docs.unionByName(empty)


def json_array_explode(spark, sf):
    docs = order_documents(spark, sf)
    ex = transform.explode_json_array(docs, "raw", LINE, keep=["o_orderkey"], alias="line")
    return transform.flatten(ex, {
        "l_linenumber": "line.LineNumber", "l_partkey": "line.PartKey", "l_quantity": "line.Quantity",
        "l_returnflag": "line.Flags.Return", "l_linestatus": "line.Flags.Status",
    }, keep=["o_orderkey"])


def _epoch_seconds(c):
    return F.timestamp_diff("SECOND", ts_ntz("1970-01-01 00:00:00"), c)


def observation_documents(spark, sf) -> DataFrame:
    """Nested weather documents from events; 'error' events lack ``main``, 'view'
    events have an empty ``weather`` array (both must be rejected)."""
    e = table(spark, sf, "events")
    wmap = F.create_map(*[F.lit(x) for kv in WEATHER_BY_EVENT.items() for x in kv])
    pressure = (F.lit(1000) + F.pmod("user_id", F.lit(50))).cast("int")
    humidity = F.pmod("event_id", F.lit(101)).cast("int")
    wtype = "array<struct<main:string,description:string>>"
    doc = F.struct(
        F.struct(F.col("value").alias("lat"), (-F.col("value")).alias("lon")).alias("coord"),
        F.when(F.col("event_type") == "view", F.array().cast(wtype)).otherwise(
            F.array(F.struct(F.coalesce(F.try_element_at(wmap, F.col("event_type")), F.col("event_type")).alias("main"),
                             F.col("event_type").alias("description")))).alias("weather"),
        F.when(F.col("event_type") != "error",
               F.struct(F.col("value").alias("temp"), pressure.alias("pressure"), humidity.alias("humidity"))).alias("main"),
        F.lit(10000).alias("visibility"),
        F.when(F.col("event_type") == "purchase", F.struct(F.col("value").alias("1h"))).alias("rain"),
        F.when(F.col("event_type") == "signup", F.struct(F.col("value").alias("1h"))).alias("snow"),
        F.struct((F.col("value") / F.lit(10.0)).alias("speed")).alias("wind"),
        F.struct(humidity.alias("all")).alias("clouds"),
        _epoch_seconds(F.col("ts")).alias("dt"),
    )
    return e.select("event_id", F.to_json(doc).alias("raw"))


def observation_flatten(spark, sf):
    ok, _ = observations.split_observations(observation_documents(spark, sf), "raw", keep=["event_id"])
    return ok


def observation_rejects(spark, sf):
    _, bad = observations.split_observations(observation_documents(spark, sf), "raw", keep=["event_id"])
    return bad.select("event_id", F.array_join("missing_fields", ",").alias("missing_fields"))


def weather_standardize(spark, sf):
    ok, _ = observations.split_observations(observation_documents(spark, sf), "raw", keep=["event_id"])
    ok = transform.add_ingest_timestamp(ok, AS_OF)
    return transform.standardize_weather(ok, AS_OF).drop("weather_sk", "weather_zone_id", "ingest_timestamp")


# ---------------------------------------------------------------- cleaning


def _customer_points(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", (F.col("c_acctbal") / F.lit(100.0)).alias("latitude"),
                    (F.col("c_nationkey").cast("double") / F.lit(10.0) - F.lit(74.0)).alias("longitude"))


def request_grid(spark, sf):
    return grid.grid_over(_customer_points(spark, sf), "latitude", "longitude", 0.1)


def standardize_values(spark, sf):
    c = table(spark, sf, "customer")
    code = (F.when(F.pmod("c_nationkey", F.lit(3)) == 0, "NJ")
            .when(F.pmod("c_nationkey", F.lit(3)) == 1, "NY").otherwise("PA"))
    raw = c.select("c_custkey", code.alias("state_or_province"),
                   F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("n/a"))
                   .otherwise(F.col("c_acctbal").cast("string")).alias("latitude"))
    return transform.cast_columns(transform.standardize_values(raw, "state_or_province"), {"latitude": "double"})


def zone_assign(spark, sf):
    return transform.assign_zone(_customer_points(spark, sf))


def zone_distinct(spark, sf):
    return transform.distinct_zones(zone_assign(spark, sf))


def incremental_filter(spark, sf):
    e = table(spark, sf, "events")
    return transform.incremental_filter(e, EVENT_CUTOFF, "ts").select("event_id", "ts", "user_id")


def watermark_buffer(spark, sf):
    e = table(spark, sf, "events")
    wm = e.groupBy("user_id").agg(F.max("ts").alias("watermark"))
    return wm.withColumn("buffered_watermark", transform.buffered("watermark", 15))


def _redelivered(spark, sf):
    """Events plus the re-delivered last 15 minutes of every daily batch."""
    e = table(spark, sf, "events")
    overlap = e.where((F.hour("ts") == 23) & (F.minute("ts") >= 45))
    return e.unionByName(overlap)


def dedup_rows(spark, sf):
    return transform.dedup(_redelivered(spark, sf))


def dedup_latest(spark, sf):
    return transform.latest_per_key(_redelivered(spark, sf), ["user_id"], ["ts", "event_id"])


# ---------------------------------------------------------------- quality


def column_gate(spark, sf):
    o = table(spark, sf, "orders")
    o = o.withColumn("o_refund_priority", F.when(F.col("o_totalprice") < 0, F.col("o_orderpriority")))
    return quality.column_counts(o)


def quarantine_split(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_nationkey") != 0, F.col("c_acctbal")).alias("c_acctbal"))
    marked = quality.with_validity(c, ["c_custkey", "c_mktsegment"], ["c_acctbal"])
    return marked.select("c_custkey", "is_valid", F.array_join("reject_reasons", ",").alias("reject_reasons"))


# ---------------------------------------------------------------- SCD-2

SCD_KEYS, SCD_ATTRS, SCD_TRACKED = ["user_id"], ["status", "value"], ["status"]
SCD_OUT = ["user_id", "status", "value", "valid_from", "valid_to", "is_current"]


def _change_log(spark, sf):
    e = table(spark, sf, "events")
    return e.select("user_id", F.col("event_type").alias("status"), "value", "ts", "event_id")


def _scd_state(spark, sf):
    """History of most users before the cut-off, and a dirty batch: users that the history
    lacks (INSERT), users of the history without a row, late rows of the day before, and
    rows without a time."""
    log = _change_log(spark, sf)
    cut = ts_ntz(EVENT_CUTOFF)
    target = scd2.history(log.where((F.col("ts") < cut) & (F.col("user_id") % 7 != 0)), SCD_KEYS, SCD_ATTRS, SCD_TRACKED,
                          ts="ts", order=["event_id"], split=LOG_SPLIT())
    new = (F.col("ts") >= cut) & (F.col("user_id") % 5 != 0)
    late = (F.col("ts") >= cut - F.expr("INTERVAL 1 DAY")) & (F.col("ts") < cut) & (F.col("user_id") % 3 == 0)
    staged = log.where(new | late).withColumn("ts", F.when(F.col("event_id") % 97 != 0, F.col("ts")))
    return target, staged


def _scd_split(spark, sf):
    """All events, as the history before the cut-off and the batch after it."""
    log = _change_log(spark, sf)
    cut = ts_ntz(EVENT_CUTOFF)
    target = scd2.history(log.where(F.col("ts") < cut), SCD_KEYS, SCD_ATTRS, SCD_TRACKED,
                          ts="ts", order=["event_id"], split=LOG_SPLIT())
    return target, log.where(F.col("ts") >= cut)


def scd2_untimed(spark, sf):
    """Staged rows without a time, which belong in the quarantine."""
    _, s = _scd_state(spark, sf)
    return scd2.untimed(s, "ts").select("user_id", "status", "event_id")


def scd2_classify(spark, sf):
    t, s = _scd_state(spark, sf)
    return scd2.classify(s, t, SCD_KEYS, SCD_TRACKED, ts="ts", order=["event_id"]).select("user_id", "scd_action")


def scd2_new_versions(spark, sf):
    t, s = _scd_state(spark, sf)
    cl = scd2.classify(s, t, SCD_KEYS, SCD_TRACKED, ts="ts", order=["event_id"])
    return scd2.new_versions(cl, SCD_KEYS, SCD_ATTRS, SCD_TRACKED, ts="ts").drop("sk")


def scd2_expire(spark, sf):
    t, s = _scd_state(spark, sf)
    cl = scd2.classify(s, t, SCD_KEYS, SCD_TRACKED, ts="ts", order=["event_id"])
    return scd2.rows_to_expire(cl, SCD_KEYS, ts="ts").drop("sk")


def scd2_apply(spark, sf):
    t, s = _scd_state(spark, sf)
    return scd2.apply_changes(t, s, SCD_KEYS, SCD_ATTRS, SCD_TRACKED, ts="ts", order=["event_id"]).select(*SCD_OUT)


def scd2_replay(spark, sf):
    t, s = _scd_state(spark, sf)
    once = scd2.apply_changes(t, s, SCD_KEYS, SCD_ATTRS, SCD_TRACKED, ts="ts", order=["event_id"])
    twice = scd2.apply_changes(once, s, SCD_KEYS, SCD_ATTRS, SCD_TRACKED, ts="ts", order=["event_id"])
    return twice.select(*SCD_OUT)


def scd2_apply_all_versions(spark, sf):
    """Every later event applied as versions (not only the latest per user): must equal
    the history of all events."""
    t, s = _scd_split(spark, sf)
    return scd2.apply_all_versions(t, s, SCD_KEYS, SCD_ATTRS, SCD_TRACKED, ts="ts", order=["event_id"],
                                   split=LOG_SPLIT()).select(*SCD_OUT)


def scd2_history(spark, sf):
    return scd2.history(_change_log(spark, sf), SCD_KEYS, SCD_ATTRS, SCD_TRACKED,
                        ts="ts", order=["event_id"], split=LOG_SPLIT()).select(*SCD_OUT)


# ---------------------------------------------------------------- upsert


def _upsert_inputs(spark, sf):
    """Target before the cut-off; a source that overlaps it, repeats some keys with other
    values, and has null keys on both sides."""
    e = table(spark, sf, "events").withColumn("event_id", F.when(F.col("event_id") % 101 != 0, F.col("event_id")))
    cut = ts_ntz(EVENT_CUTOFF)
    target = e.where((F.col("ts") < cut) & F.col("event_id").isNotNull()).unionByName(
        e.where(F.col("event_id").isNull()).agg(*[F.max(c).alias(c) for c in e.columns]))
    source = (e.where(F.col("ts") >= cut - F.expr("INTERVAL 1 DAY"))
              .withColumn("value", F.col("value") + F.lit(1.0)))
    repeated = source.where(F.col("user_id") % 4 == 0).withColumn("value", F.col("value") + F.lit(1.0))
    return target, source.unionByName(repeated)


UPSERT_ORDER = ["ts", "value", "user_id", "event_type", "props"]


def upsert_rows(spark, sf):
    t, s = _upsert_inputs(spark, sf)
    return upsert.upsert(t, s, ["event_id"], UPSERT_ORDER)


def insert_count(spark, sf):
    t, s = _upsert_inputs(spark, sf)
    return upsert.inserted_rows(t, s, ["event_id"], UPSERT_ORDER).agg(F.count(F.lit(1)).alias("inserted"))


# ---------------------------------------------------------------- geo

# The four test regions as (name, xmin, ymin, xmax, ymax).
REGION_BOXES = [("North", 0.0, 6.0, 3.0, 9.0), ("East", 5.0, 4.0, 9.0, 8.0),
                ("South", 1.0, 0.0, 4.0, 3.0), ("West", -1.0, 3.0, 0.5, 5.0)]


def _region_points(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", (F.col("c_acctbal") / F.lit(1000.0)).alias("x"),
                    (F.pmod("c_custkey", F.lit(97)).cast("double") / F.lit(10.0)).alias("y"))


def nearest_region(spark, sf):
    out = geo.nearest_region(_region_points(spark, sf), geo.boxes(spark, REGION_BOXES), x="x", y="y")
    return out.select("c_custkey", "region")


def part_regions(spark, sf) -> DataFrame:
    """A region per part, as vertex rows put together: small boxes, a few very large ones."""
    p = table(spark, sf, "part")
    x0 = F.pmod(F.col("p_partkey") * 7919, F.lit(10007)).cast("double") / 100.0
    y0 = F.pmod(F.col("p_partkey") * 104729, F.lit(10007)).cast("double") / 100.0
    w = F.when(F.col("p_partkey") % 97 == 0, F.lit(20.0)).otherwise(F.col("p_size").cast("double") / 50.0)
    corners = F.array(*[F.struct(F.lit(i).alias("seq"), (x0 + dx * w).alias("x"), (y0 + dy * w).alias("y"))
                        for i, (dx, dy) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)])])
    rows = p.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("name"), F.explode(corners).alias("v")).select("name", "v.*")
    return geo.regions_from_vertices(rows)


def nearest_region_parts(spark, sf):
    """As many regions as parts, read from files; points inside, between and far away from
    them, and points without a proper coordinate."""
    from lakehold.session import shared_dir

    path = shared_dir(spark, "regions")
    part_regions(spark, sf).write.parquet(path)
    c = table(spark, sf, "customer")
    far = F.when(F.col("c_custkey") % 10 == 0, F.lit(1000.0)).otherwise(F.lit(1.0))
    x = F.when(F.col("c_custkey") % 50 == 7, F.lit(float("nan"))).when(F.col("c_custkey") % 50 != 9, F.col("c_acctbal") / 70.0 * far)
    y = F.pmod(F.col("c_custkey") * 31, F.lit(1009)).cast("double") / 8.0 * far
    pts = c.select("c_custkey", x.alias("x"), y.alias("y"))
    out = geo.nearest_region(pts, geo.read_regions(spark, path), x="x", y="y")
    return out.select("c_custkey", "region")


def shape_regions(spark, sf) -> DataFrame:
    """A region per part, as rings: boxes, boxes with a hole, regions of two boxes, and one
    region far away from all others."""
    p = table(spark, sf, "part").select(
        "p_partkey", (F.pmod(F.col("p_partkey") * 7919, F.lit(10007)).cast("double") / 100.0).alias("x0"),
        (F.pmod(F.col("p_partkey") * 104729, F.lit(10007)).cast("double") / 100.0).alias("y0"), (F.col("p_size").cast("double") / 8.0).alias("w"))
    part = p.where("p_partkey <> 5").unionByName(p.where("p_partkey = 5").withColumns({"x0": F.lit(1e6), "y0": F.lit(1e6)}))
    at = lambda c, k: F.col(c) + F.col("w") * k
    ring = lambda a, b: F.array(*[F.struct(at("x0", x).alias("x"), at("y0", y).alias("y")) for x, y in ((a, a), (b, a), (b, b), (a, b))])
    second = F.array(*[F.struct(at("x0", x).alias("x"), at("y0", y).alias("y")) for x, y in ((2, 0), (2.5, 0), (2.5, 0.5), (2, 0.5))])
    rings = (F.when(F.col("p_partkey") % 3 == 0, F.array(ring(0, 1), ring(0.25, 0.75))).when(F.col("p_partkey") % 3 == 1, F.array(ring(0, 1), second))
             .otherwise(F.array(ring(0, 1))))
    return part.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("name"), rings.alias("rings"))


def nearest_region_shapes(spark, sf):
    """Regions with holes and of several parts, in files of binary geometries; one of them far away."""
    from lakehold.session import shared_dir
    from lakehold.sources import wkb

    path = shared_dir(spark, "shapes")
    wkb.write_rings(shape_regions(spark, sf)).write.parquet(path)
    pts = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 70.0).alias("x"),
                                              (F.pmod(F.col("c_custkey") * 31, F.lit(1009)).cast("double") / 8.0).alias("y"))
    return geo.nearest_region(pts, geo.read_geometries(spark, path), x="x", y="y").select("c_custkey", "region")


def neighbor_hot_key(spark, sf):
    """Previous time and next value of the same event type: a few keys that hold all rows,
    and a null one, spread by ranges of a stored, sorted frame."""
    from lakehold.operators.windows import with_neighbor_ranged

    e = table(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"), "event_id", "ts", "value")
    d = with_neighbor_ranged(e, ["kind"], ["ts", "event_id"], ["ts"], "prev")
    return with_neighbor_ranged(d, ["kind"], ["ts", "event_id"], ["value"], "next")


# ---------------------------------------------------------------- control table


def _runs(spark, sf):
    e = table(spark, sf, "events")
    layer = (F.when(F.pmod("user_id", F.lit(3)) == 0, "bronze")
             .when(F.pmod("user_id", F.lit(3)) == 1, "silver").otherwise("gold"))
    return e.select(
        F.col("event_type").alias("pipeline_name"), layer.alias("layer"),
        F.when(F.col("value") >= 5, F.col("ts")).alias("last_processed_timestamp"),
        F.col("event_id").cast("string").alias("batch_id"),
        F.when(F.col("value") <= 450, F.col("ts")).alias("end_time"))


def watermark_top1(spark, sf):
    return control.watermarks(_runs(spark, sf))


def run_log(spark, sf):
    e = table(spark, sf, "events")
    return control.batch_records(e, F.to_date("ts"), "ts", F.col("value") < 1, "events", "bronze")


# ---------------------------------------------------------------- health, layout

HEALTH_RULES = {
    "orders": health.TableRules(critical=["o_orderkey", "o_custkey", "o_orderdate"],
                                ranges={"o_totalprice": (0, 500000)}, unique_key="o_orderkey",
                                ts_column="o_orderdate"),
    "customer": health.TableRules(critical=["c_custkey", "c_name", "c_mktsegment"],
                                  ranges={"c_acctbal": (-1000, 10000)}, unique_key="c_custkey"),
}


def health_report(spark, sf):
    tables = {"orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer")}
    return health.health_report(spark, tables, HEALTH_RULES, AS_OF)


def zorder_layout(spark, sf):
    """All of lineitem, clustered on a 64-bit hash key and a string."""
    li = table(spark, sf, "lineitem")
    keyed = li.withColumn("line_sk", F.xxhash64("l_orderkey", "l_linenumber"))
    return layout.zorder(keyed, ["line_sk", "l_returnflag"]).drop("z", "line_sk")


QUERIES = {
    "station_facts": station_facts,
    "station_facts_corrected": station_facts_corrected,
    "station_dim": station_dim,
    "station_dim_corrected": station_dim_corrected,
    "weather_dim": weather_dim,
    "json_path_project": json_path_project,
    "json_array_explode": json_array_explode,
    "observation_flatten": observation_flatten,
    "observation_rejects": observation_rejects,
    "weather_standardize": weather_standardize,
    "request_grid": request_grid,
    "standardize_values": standardize_values,
    "zone_assign": zone_assign,
    "zone_distinct": zone_distinct,
    "incremental_filter": incremental_filter,
    "watermark_buffer": watermark_buffer,
    "dedup_rows": dedup_rows,
    "dedup_latest": dedup_latest,
    "column_gate": column_gate,
    "quarantine_split": quarantine_split,
    "scd2_classify": scd2_classify,
    "scd2_new_versions": scd2_new_versions,
    "scd2_expire": scd2_expire,
    "scd2_untimed": scd2_untimed,
    "scd2_apply": scd2_apply,
    "scd2_replay": scd2_replay,
    "scd2_history": scd2_history,
    "scd2_apply_all_versions": scd2_apply_all_versions,
    "upsert": upsert_rows,
    "insert_count": insert_count,
    "nearest_region": nearest_region,
    "nearest_region_parts": nearest_region_parts,
    "nearest_region_shapes": nearest_region_shapes,
    "neighbor_hot_key": neighbor_hot_key,
    "watermark_top1": watermark_top1,
    "run_log": run_log,
    "health_report": health_report,
    "zorder_layout": zorder_layout,
}


# ---------------------------------------------------------------- streaming


def _events_stream(spark, sf, max_files=None):
    """The events table as a file stream, whether it is one parquet file in ``sf`` or a
    folder of part files."""
    from lakehold.streaming import ingest

    path = f"{sf.rstrip('/')}/events.parquet"
    if any(f.rstrip("/").endswith("/events.parquet") for f in spark.read.parquet(path).inputFiles()):
        return ingest.read_table_stream(spark, sf, "events.parquet", max_files)
    return ingest.read_table_stream(spark, path, "*.parquet", max_files)


def stream_dedup(spark, sf):
    """Events delivered in two landings, each taken as a stream: the first without a part of
    the events, the second with that part, the day's last quarter of an hour again, and
    repetitions days after and days before the first delivery. One row per event, the
    earliest; the table is read back."""
    from lakehold.operators.keyed_table import KeyedTable
    from lakehold.session import shared_dir
    from lakehold.streaming import ingest

    e = table(spark, sf, "events")
    days = lambda n: F.col("ts") + F.expr(f"INTERVAL {n} DAYS")
    again = e.where((F.hour("ts") == 23) & (F.minute("ts") >= 45))
    later, earlier = e.where("event_id % 10 = 3").withColumn("ts", days(4)), e.where("event_id % 10 = 7").withColumn("ts", days(-3))
    landings = [e.where("event_id % 6 <> 1").unionByName(later),
                e.where("event_id % 6 = 1").unionByName(again).unionByName(earlier).unionByName(later)]
    root = shared_dir(spark, "stream-dedup")
    kept = KeyedTable(f"{root}/table", ("event_id",), "ts")
    for landing in landings:
        landing.write.mode("append").parquet(f"{root}/in")
        ingest.dedup_into(ingest.read_table_stream(spark, f"{root}/in", "*.parquet"), kept, f"{root}/checkpoint")
    return kept.rows(spark)


def scd_store(root: str):
    from lakehold.operators.history_store import HistoryStore

    return HistoryStore(root, tuple(SCD_KEYS), tuple(SCD_ATTRS), tuple(SCD_TRACKED), "ts", ("event_id",))


def stream_scd2(spark, sf):
    """History before the cut-off as the initial state, later events as a stream applied per
    micro-batch; the state is read back and equals the history of all events."""
    from lakehold.session import shared_dir
    from lakehold.streaming import scd2_stream

    root = shared_dir(spark, "stream-scd2")
    target, staged = _scd_split(spark, sf)
    store = scd_store(f"{root}/state")
    store.init(target, staged.schema)
    events = _events_stream(spark, sf)
    rows = events.where(F.col("ts") >= ts_ntz(EVENT_CUTOFF)).select(
        "user_id", F.col("event_type").alias("status"), "value", "ts", "event_id")
    scd2_stream.run_scd2_stream(rows, store, f"{root}/checkpoint")
    return store.state(spark).select(*SCD_OUT)


STORE_CUTOFF = "1998-06-01 00:00:00"


def station_facts_store(spark, sf):
    """Facts from a store that takes the tables in three batches: versions up to a cut-off, of which the
    last were still running, part of the connectors and observations; versions that came or ended since and
    the other connectors; all other observations, among them the first of a zone."""
    from lakehold.functions.columns import open_end
    from lakehold.plans.fact_store import FactStore
    from lakehold.session import shared_dir

    v, c, w = roles.mart_inputs(spark, sf, VERSION_SPLIT())
    path = shared_dir(spark, "fact-versions")  # two batches take theirs from it
    v.select("station_id", "station_sk", "status_id", "date_last_status_update", "valid_from", "valid_to", "date_created", "weather_zone").write.parquet(path)
    v = spark.read.parquet(path)
    cut = ts_ntz(STORE_CUTOFF)
    before, ended = F.col("valid_from") < cut, F.col("valid_to") >= cut
    known = v.where(before).withColumn("valid_to", F.when(ended, open_end()).otherwise(F.col("valid_to")))
    since = v.where(~before | (ended & (F.col("valid_to") < open_end())))
    early_c = F.pmod("l_orderkey", F.lit(3)) != 0
    early_w = (F.col("dt_utc") < ts_ntz(EVENT_CUTOFF)) & (F.col("zone") != 7)
    store = FactStore(shared_dir(spark, "fact-store"), "parity", buckets=16, connector_order=("l_orderkey", "l_linenumber"),
                      station_zone=("weather_zone",), weather_zone=("zone",))
    store.create(spark, v, c, w)
    none = F.lit(False)
    store.apply(known, c.where(early_c), w.where(early_w), 0, STORE_CUTOFF, MART_SPLIT())
    store.apply(since, c.where(~early_c), w.where(none), 1, AS_OF, MART_SPLIT())
    store.apply(v.where(none), c.where(none), w.where(~early_w), 2, AS_OF, MART_SPLIT())
    return store.facts(spark, AS_OF)


QUERIES["station_facts_store"] = station_facts_store
QUERIES["stream_dedup"] = stream_dedup
QUERIES["stream_scd2"] = stream_scd2


# ---------------------------------------------------------------- bronze -> silver flow


def station_documents(spark, sf, keep: dict | None = None) -> DataFrame:
    """Station landing documents: one per order line (a station version with one or two
    connectors), or one per order without lines (no connector list). Re-delivered urgent
    orders give duplicate UUIDs; some documents have no UUID, a missing, malformed or NaN
    latitude or a malformed date (rejected); some connectors have negative power (rejected).
    ``keep`` adds columns made from the orders."""
    from lakehold.plans.roles import STATUS_BY_ORDERSTATUS, STATUS_TITLE, _case

    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus")
    base = (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .join(li, o.o_orderkey == li.l_orderkey, "left"))
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    conn = F.struct(
        F.col("l_linenumber").alias("ConnectionTypeID"),
        F.struct(F.col("l_linestatus").alias("Title")).alias("ConnectionType"),
        F.when(F.col("l_quantity") > 45, 3).when(F.col("l_quantity") > 20, 2).otherwise(1).alias("LevelID"),
        F.pmod("l_partkey", F.lit(100)).cast("int").alias("Amps"),
        F.col("l_extendedprice").alias("Voltage"),
        (F.col("l_quantity") - F.lit(5.0)).alias("PowerKW"),
        (F.lit(1) + F.col("l_linenumber") % 2).alias("Quantity"),
        F.struct(F.col("l_returnflag").alias("Title")).alias("CurrentType"),
    )
    doc = F.struct(
        F.col("o_custkey").alias("ID"),
        F.when(F.col("o_orderkey") % 17 != 0, F.concat_ws("-", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.round(F.col("l_quantity") * 100).cast("long"),  # cents: exact, no double text
                    F.round(F.col("l_extendedprice") * 100).cast("long"),
                    "l_returnflag", "l_linestatus")).alias("UUID"),
        F.struct(
            F.col("c_name").alias("Title"), F.col("o_orderpriority").alias("AddressLine1"),
            F.col("c_mktsegment").alias("Town"),
            F.when(F.col("c_nationkey") % 2 == 0, "NJ").otherwise("NY").alias("StateOrProvince"),
            F.when(F.pmod("o_custkey", F.lit(11)) == 3, "abc").when(F.pmod("o_custkey", F.lit(11)) == 5, "NaN")
            .when(F.col("c_mktsegment") != "AUTOMOBILE", (F.col("c_acctbal") / F.lit(100.0)).cast("string")).alias("Latitude"),
            (F.col("c_nationkey").cast("double") / F.lit(10.0) - F.lit(74.0)).alias("Longitude"),
        ).alias("AddressInfo"),
        F.when(F.col("l_quantity") > 40, F.array(conn, conn.withField("ConnectionTypeID", F.col("l_linenumber") + 100)))
        .when(F.col("l_orderkey").isNotNull(), F.array(conn)).alias("Connections"),
        F.struct(_case("o_orderstatus", STATUS_TITLE).alias("Title"),
                 _case("o_orderstatus", STATUS_BY_ORDERSTATUS).alias("ID")).alias("StatusType"),
        F.when(F.pmod("o_custkey", F.lit(13)) == 1, "not a date").otherwise(F.date_format("o_orderdate", iso)).alias("DateLastStatusUpdate"),
        F.date_format(F.col("o_orderdate") - F.expr("INTERVAL 30 DAYS"), iso).alias("DateCreated"),
        F.struct(F.concat(F.lit("https://example.org/"), F.col("c_mktsegment")).alias("WebsiteURL")).alias("DataProvider"),
    )
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    # serialise first: a generator in the same projection strips the struct's field names
    more = [c.alias(n) for n, c in (keep or {}).items()]
    docs = base.select(F.to_json(doc).alias("raw_text"), copies.alias("__copies"), *more)
    return docs.select("raw_text", *(keep or {}), F.explode("__copies").alias("__copy")).drop("__copy")


STATION_OUT = ["station_id", "title", "address", "town", "state_or_province", "latitude", "longitude",
               "status", "status_id", "date_last_status_update", "date_created", "weather_zone_lat",
               "weather_zone_lon"]
CONNECTOR_OUT = ["station_id", "connection_type_id", "connection_type", "level_id", "amps", "voltage",
                 "power_kw", "quantity", "current_type", "date_last_status_update"]


def _silver_rows(spark, sf):
    from lakehold.plans import flows
    from lakehold.session import INITIAL_WATERMARK

    bronze = flows.bronze_stations(station_documents(spark, sf), "2024-01-31 00:00:00", parsed=True)
    # the all-null gate runs on the publishing write (sources.tables.publish_gated) and
    # as its own query (column_gate); here it would only re-run the whole plan
    return flows.silver_station_rows(bronze, INITIAL_WATERMARK, AS_OF, gate=False)


def silver_stations(spark, sf):
    ok, _ = _silver_rows(spark, sf)
    return ok.select(*STATION_OUT)


def silver_station_rejects(spark, sf):
    _, bad = _silver_rows(spark, sf)
    return bad.select("station_id", F.array_join("reject_reasons", ",").alias("reject_reasons"))


def _connector_rows(spark, sf):
    from lakehold.plans import flows

    ok, _ = _silver_rows(spark, sf)
    return flows.connector_rows(ok, AS_OF)


def silver_connectors(spark, sf):
    ok, _ = _connector_rows(spark, sf)
    return ok.select(*CONNECTOR_OUT)


def silver_connector_rejects(spark, sf):
    _, bad = _connector_rows(spark, sf)
    return bad.select("station_id", "date_last_status_update",
                      F.array_join("reject_reasons", ",").alias("reject_reasons"))


QUERIES.update({
    "silver_stations": silver_stations,
    "silver_station_rejects": silver_station_rejects,
    "silver_connectors": silver_connectors,
    "silver_connector_rejects": silver_connector_rejects,
})


def maintenance_report(spark, sf):
    """Z-order rewrite of three tables into the shared folder, on numbers, dates and strings,
    and a table that does not exist: the report with its totals, less what varies between
    runs (seconds, error text)."""
    from lakehold.session import shared_dir

    base = sf.rstrip("/")
    tables = {f"{base}/lineitem.parquet": ["l_orderkey", "l_returnflag"],
              f"{base}/orders.parquet": ["o_custkey", "o_orderdate", "o_orderpriority"],
              f"{base}/customer.parquet": ["c_name", "c_nationkey"],
              f"{base}/missing.parquet": ["x"]}
    rep = layout.optimize_tables(spark, tables, shared_dir(spark, "maintenance"))
    return rep.select("table", "operation", "status", "rows_in", "rows_out", "errors")


QUERIES["maintenance_report"] = maintenance_report


def landing_ingest(spark, sf):
    """Station documents landed as gzipped JSON-lines files (one folder per run) and read
    back with the text source: bronze rows with UUID and source, one per UUID."""
    from lakehold.session import shared_dir, shuffles_freed
    from lakehold.sources import landing

    root = shared_dir(spark, "landing")
    with shuffles_freed(spark):
        landing.write_landing(station_documents(spark, sf), f"{root}/run=0")
    # a flag of each document goes with it, so that the texts themselves need not be shuffled
    raw = landing.read_landing(spark, f"{root}/run=0").withColumn("has_text", F.length("raw_text") > 0)
    bronze = landing.add_bronze_metadata(raw, "2024-01-31 00:00:00")
    return bronze.select("UUID", "source_file", "ingest_timestamp", "has_text")


def silver_row_balance(spark, sf):
    """Bronze documents, valid and rejected station rows: every document is one or the other."""
    from lakehold.plans import flows
    from lakehold.session import INITIAL_WATERMARK

    bronze = flows.bronze_stations(station_documents(spark, sf), "2024-01-31 00:00:00", parsed=True)
    ok, bad = flows.silver_station_rows(bronze, INITIAL_WATERMARK, AS_OF, gate=False)
    count = lambda df, n, c=F.lit(1): df.agg(F.lit(n).alias("part"), F.count(c).alias("n"))
    # every bronze row is stamped; counting stamps needs the columns that the others need, so all three share one shuffle
    return count(bronze, "bronze", "ingest_timestamp").unionByName(count(ok, "valid")).unionByName(count(bad, "rejected"))


QUERIES["silver_row_balance"] = silver_row_balance


QUERIES["landing_ingest"] = landing_ingest


def _scd_state_nullable(spark, sf):
    """Same split as ``_scd_state`` but 'error' events carry a NULL status."""
    e = table(spark, sf, "events")
    log = e.select("user_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("status"),
                   "value", "ts", "event_id")
    cut = ts_ntz(EVENT_CUTOFF)
    target = scd2.history(log.where(F.col("ts") < cut), SCD_KEYS, SCD_ATTRS, SCD_TRACKED,
                          ts="ts", order=["event_id"], split=LOG_SPLIT())
    return target, log.where(F.col("ts") >= cut)


def scd2_classify_nullsafe(spark, sf):
    t, s = _scd_state_nullable(spark, sf)
    return scd2.classify(s, t, SCD_KEYS, SCD_TRACKED, ts="ts", order=["event_id"]).select("user_id", "scd_action")


def scd2_classify_parity(spark, sf):
    """The reference's ``!=`` comparison: a change from or to NULL is not an update."""
    t, s = _scd_state_nullable(spark, sf)
    return scd2.classify(s, t, SCD_KEYS, SCD_TRACKED, ts="ts", order=["event_id"],
                         null_safe=False).select("user_id", "scd_action")


QUERIES["scd2_classify_nullsafe"] = scd2_classify_nullsafe
QUERIES["scd2_classify_parity"] = scd2_classify_parity


# ---------------------------------------------------------------- composite zones, keys, sinks, verdicts


def station_facts_zones(spark, sf):
    """Facts with versions and weather joined on a composite (lat, lon) cell, not one id."""
    v, c, w = roles.mart_inputs(spark, sf)
    cell = lambda df, z: df.withColumns({"cell_lat": F.pmod(F.col(z), F.lit(5)), "cell_lon": F.floor(F.col(z) / 5)})
    zone = ("cell_lat", "cell_lon")
    return marts.station_facts(cell(v, "weather_zone"), c, cell(w, "zone"), AS_OF, mode="parity", station_zone=zone,
                               weather_zone=zone, connector_order=("l_orderkey", "l_linenumber"))


def null_removal(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 4 != 0, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"))
    return transform.remove_nulls(c, ["c_name", "c_acctbal"])


def surrogate_keys(spark, sf):
    """Surrogate keys of events with null parts: one key per distinct combination, and the
    same key for an equal combination."""
    from lakehold.functions.columns import surrogate_key

    e = table(spark, sf, "events")
    parts = e.select(F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("a"),
                     F.when(F.col("event_type") != "error", F.col("event_type")).alias("b"), F.to_date("ts").alias("c"))
    keyed = parts.withColumn("sk", surrogate_key("a", "b", "c"))
    per = keyed.groupBy("a", "b", "c").agg(F.count_distinct("sk").alias("keys"), F.first("sk").alias("sk"))
    return per.agg(F.count(F.lit(1)).alias("combinations"), F.count_distinct("sk").alias("keys"), F.max("keys").alias("keys_per_combination"))


def counted_sinks(spark, sf):
    """Create-if-absent, counted write, and publishing a new state twice: the counts that the
    writes report beside what is read back."""
    import uuid

    from lakehold.session import shared_dir
    from lakehold.sources import tables

    root, name = shared_dir(spark, "sinks"), f"lakehold_sink_{uuid.uuid4().hex[:8]}"
    o = table(spark, sf, "orders")
    reported = {"created": tables.create_if_absent(spark, name, o.schema, f"{root}/v0").count(),
                "created_again": tables.create_if_absent(spark, name, o.schema).count(),
                "written": tables.write_counted(o, f"{root}/w"),
                "appended": tables.write_counted(o.where("o_orderstatus = 'F'"), f"{root}/w"),
                "published": tables.publish(spark, name, o, f"{root}/v1")}
    reported["published_later"] = tables.publish_gated(spark, name, o.where("o_orderstatus = 'O'"), f"{root}/v2")
    read = {"written": spark.read.parquet(f"{root}/w"), "published_later": spark.table(name)}
    out = None
    for step, n in reported.items():
        back = read[step].agg(F.count(F.lit(1))).first()[0] if step in read else n
        row = spark.range(1).select(F.lit(step).alias("step"), F.lit(n).cast("long").alias("reported"), F.lit(back).cast("long").alias("read_back"))
        out = row if out is None else out.unionByName(row)
    spark.sql(f"DROP TABLE {name}")
    return out


def _ailing_orders(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice", "o_orderdate")
    return o.unionByName(o.where("o_orderkey % 4 = 0"))


AILING_ORDERS = health.TableRules(critical=["o_orderkey", "o_orderdate"], ranges={"o_totalprice": (0, 100000)},
                                  unique_key="o_orderkey", ts_column="o_orderdate")


def _ailing_report(spark, sf):
    """Health of tables with every kind of finding: nulls, repeated keys, values out of range,
    old rows, an empty table and a missing one."""
    c = table(spark, sf, "customer")
    tables = {"orders": _ailing_orders(spark, sf), "customer": c.where("c_custkey < 0"), "gone": None}
    rules = {"orders": AILING_ORDERS,
             "customer": health.TableRules(critical=["c_custkey"], ranges={"c_acctbal": (0, 1)}, unique_key="c_custkey")}
    return health.health_report(spark, tables, rules, "2034-02-01 00:00:00")


def health_merged(spark, sf):
    """The report of a table that grew by three runs, one of them repeated, merged from the
    runs' states; and of one without any run."""
    from lakehold.session import shared_dir

    log = health.HealthLog(shared_dir(spark, "health"), {"orders": AILING_ORDERS})
    o = _ailing_orders(spark, sf)
    deal = F.pmod(F.datediff("o_orderdate", F.lit("2020-01-01")), F.lit(3))
    for run in (0, 1, 2, 2):
        log.add("orders", o.where(deal == run), run)
    return log.report(spark, ["orders", "gone"], "2034-02-01 00:00:00")


def health_findings(spark, sf):
    return _ailing_report(spark, sf)


def health_verdict(spark, sf):
    """Counts of findings and the verdict, of an ailing set of tables and of a sound one."""
    ill = health.health_summary(_ailing_report(spark, sf)).withColumn("tables", F.lit("ailing"))
    sound = health.health_summary(health_report(spark, sf)).withColumn("tables", F.lit("sound"))
    return ill.unionByName(sound)


# ---------------------------------------------------------------- scheduled runs

RUN_STAMPS = ["2024-01-10 00:00:00", "2024-01-20 00:00:00"]
RUN_CONNECTORS = ("station_id string, connection_type_id int, level_id int, connection_type string, amps int, voltage double, power_kw double, "
                  "quantity int, current_type string, date_last_status_update timestamp_ntz, ingest_timestamp timestamp_ntz, "
                  "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean, sk long")
WEATHER_OUT = ["lat", "lon", "weather", "description", "temp", "pressure", "humidity", "visibility", "rain", "snow", "wind_speed", "clouds", "dt_utc"]
_RUNS: dict[tuple[str, str], str] = {}  # (application, data) -> folder of its finished runs


def run_weather(spark, sf) -> DataFrame:
    """Typed bronze observations at the customers' places, four events a customer; ``ts`` is their time."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    # hours apart, as the events of a customer follow each other within seconds
    e = table(spark, sf, "events").withColumn("ts", F.timestamp_add("HOUR", F.col("event_id") % 4, F.col("ts")))
    e = e.withColumn("k", F.expr("event_id div 4")).join(c, F.col("k") == F.col("c_custkey"))
    return e.select(
        "event_id", "ts", (F.col("c_acctbal") / F.lit(100.0) + F.col("event_id") % 4 * F.lit(0.00001)).alias("lat"),
        (F.col("c_nationkey").cast("double") / F.lit(10.0) - F.lit(74.0)).alias("lon"),
        F.coalesce(roles._case("event_type", WEATHER_BY_EVENT, None), F.col("event_type")).alias("weather"), F.col("event_type").alias("description"),
        F.col("value").alias("temp"), (F.lit(1000) + F.col("user_id") % 50).cast("int").alias("pressure"), (F.col("event_id") % 101).cast("int").alias("humidity"),
        F.lit(10000).alias("visibility"), F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("rain"),
        F.when(F.col("event_type") == "signup", F.col("value")).otherwise(F.lit(0.0)).alias("snow"), (F.col("value") / 10.0).alias("wind_speed"),
        (F.col("event_id") % 101).cast("int").alias("clouds"), F.timestamp_diff("SECOND", ts_ntz("1970-01-01 00:00:00"), F.col("ts")).alias("dt"))


def _scheduled_runs(spark, sf) -> str:
    """The folder of three scheduled runs of all five pipelines, made once per session and data.

    Documents land as files: first those of even customers, then those of odd ones with some
    of the first again; weather rows likewise, with an overlap of 15 minutes and repeated rows.
    The third run finds nothing new. Control records, stores and tables stay in the folder.
    """
    import uuid

    from pyspark.errors import AnalysisException

    from lakehold.plans import flows
    from lakehold.session import shared_dir, shuffles_freed
    from lakehold.sources import landing, tables
    from lakehold.sources.schemas import STATIONS_TABLE

    at = (spark.sparkContext.applicationId, sf)
    if at in _RUNS:
        try:
            spark.read.text(f"{_RUNS[at]}/control").limit(0)
            return _RUNS[at]
        except AnalysisException:  # the folder was cleared
            del _RUNS[at]
    root, name = shared_dir(spark, "runs"), f"lakehold_control_{uuid.uuid4().hex[:8]}"
    control.create_control_table(spark, name, f"{root}/control")
    even = F.col("o_custkey") % 2 == 0
    landings = F.when(~even, F.array(F.lit(1))).when(F.col("o_custkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    documents = station_documents(spark, sf, keep={"landings": landings})
    w = run_weather(spark, sf)
    cut = ts_ntz(RUN_STAMPS[0])
    parts = [w.where(F.col("ts") < cut).unionByName(w.where((F.col("ts") < cut) & (F.col("event_id") % 9 == 0))),
             w.where(F.col("ts") >= cut - F.expr("INTERVAL 15 MINUTES"))]
    store = flows.station_store(f"{root}/stations", buckets=8)
    store.init(spark.createDataFrame([], STATIONS_TABLE).withColumnRenamed("station_sk", "sk"))
    conns = flows.connector_store(f"{root}/connectors", buckets=8)
    conns.init(spark.createDataFrame([], RUN_CONNECTORS))
    weather = None
    for k, stamp in enumerate([*RUN_STAMPS, RUN_STAMPS[1]]):
        if k < len(parts):  # new files
            with shuffles_freed(spark):
                landing.write_landing(documents.where(F.array_contains("landings", k)).select("raw_text"), f"{root}/landing")
            transform.add_ingest_timestamp(parts[k].drop("event_id", "ts"), stamp).write.mode("append").parquet(f"{root}/bronze-weather")
        bronze = flows.run_bronze_files(spark, name, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", stamp)
        if bronze is None:
            bronze = spark.read.parquet(f"{root}/bronze").drop("batch")
        valid = flows.run_station_batch(spark, name, bronze, store, f"{root}/quarantine", stamp, staging_location=f"{root}/staging-{k}")
        if valid is not None:
            flows.run_connector_batch(spark, name, valid, conns, f"{root}/connector-quarantine", stamp, staging_location=f"{root}/conn-staging-{k}")
        tables.drop_folder(spark, f"{root}/staging-{k}")  # applied to both histories
        bronze_weather = spark.read.parquet(f"{root}/bronze-weather")
        weather = transform.standardize_weather(bronze_weather.limit(0), stamp) if weather is None else weather
        weather, _ = flows.run_weather_batch(spark, name, bronze_weather, weather, f"{root}/weather", stamp)
        if k < len(parts):
            flows.run_gold(spark, name, store.state(spark).withColumnRenamed("sk", "station_sk"), conns.state(spark).withColumnRenamed("sk", "connection_sk"), weather, f"{root}/gold", stamp, mode="corrected")
    spark.sql(f"DROP TABLE {name}")  # its files stay
    _RUNS[at] = root
    return root


def run_control_rows(spark, sf):
    """Control records of all runs of the five pipelines."""
    rows = spark.read.schema(control.CONTROL_SCHEMA).parquet(f"{_scheduled_runs(spark, sf)}/control")
    return rows.select("pipeline_name", "layer", "status", "records_processed", "records_failed", "last_processed_timestamp")


def run_station_history(spark, sf):
    """Station history after the runs: the status changes of each station."""
    from lakehold.plans import flows

    store = flows.station_store(f"{_scheduled_runs(spark, sf)}/stations", buckets=8)
    return store.state(spark).select("station_id", "status_id", "valid_from", "valid_to", "is_current")


def run_connector_history(spark, sf):
    """Connector history after the runs."""
    from lakehold.plans import flows

    store = flows.connector_store(f"{_scheduled_runs(spark, sf)}/connectors", buckets=8)
    return store.state(spark).select(*flows.CONNECTOR_KEYS, "power_kw", "quantity", "valid_from", "valid_to", "is_current")


def run_weather_rows(spark, sf):
    """The weather table after the runs: one row per place and run."""
    return spark.read.parquet(f"{_scheduled_runs(spark, sf)}/weather").select(*WEATHER_OUT, "ingest_timestamp")


def run_gold_facts(spark, sf):
    """Facts that the runs appended: what does not hang on surrogate keys."""
    return spark.read.parquet(f"{_scheduled_runs(spark, sf)}/gold/station_facts").select(
        "station_id", "ingest_timestamp", "total_duration", "risk_score", "risk_severity_level", "avg_energy_cost_per_hour")


def run_gold_dims(spark, sf):
    """Rows of both dimensions in each run."""
    root = _scheduled_runs(spark, sf)
    count = lambda name: spark.read.parquet(f"{root}/gold/{name}").groupBy("ingest_timestamp").agg(F.count(F.lit(1)).alias("n")).withColumn("dim", F.lit(name))
    return count("station_dim").unionByName(count("weather_dim"))


QUERIES.update({
    "station_facts_zones": station_facts_zones,
    "null_removal": null_removal,
    "surrogate_keys": surrogate_keys,
    "counted_sinks": counted_sinks,
    "health_findings": health_findings,
    "health_verdict": health_verdict,
    "health_merged": health_merged,
    "run_control_rows": run_control_rows,
    "run_station_history": run_station_history,
    "run_connector_history": run_connector_history,
    "run_weather_rows": run_weather_rows,
    "run_gold_facts": run_gold_facts,
    "run_gold_dims": run_gold_dims,
})
