"""The layer-to-layer flows, composed from the operators (one function per step).

bronze stations -> silver station rows (+ quarantine) -> station history (SCD-2)
                -> connector rows (+ quarantine)      -> connector history (SCD-2)
bronze weather  -> silver weather (standardised)      -> weather table (upsert)
silver tables   -> gold facts, station dim, weather dim

Each step returns DataFrames; the caller decides where to publish them
(``sources.tables.publish``) and records the run (``operators.control.run_step``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakehold.functions.columns import grid_cell_id, ts_ntz
from lakehold.operators import geo, quality, scd2, transform, upsert
from lakehold.operators.history_store import HistoryStore
from lakehold.plans import marts
from lakehold.sources import landing, tables
from lakehold.sources.schemas import CONNECTION, CONNECTION_FIELDS, STATION_FIELDS

# Validation rules and tracked attributes of the two histories.
STATION_REQUIRED = ["station_id", "latitude", "longitude", "status_id", "date_last_status_update"]
STATION_TRACKED = ["status", "status_id"]
STATION_ATTRS = ["title", "address", "town", "state_or_province", "latitude", "longitude",
                 "weather_zone_lat", "weather_zone_lon", "status", "status_id",
                 "date_last_status_update", "date_created", "ingest_timestamp"]
CONNECTOR_REQUIRED = ["station_id", "connection_type_id", "level_id", "quantity", "power_kw"]
CONNECTOR_NON_NEGATIVE = ["quantity", "power_kw"]
CONNECTOR_KEYS = ["station_id", "connection_type_id", "level_id"]
CONNECTOR_TRACKED = ["amps", "voltage", "power_kw", "quantity", "current_type"]
CONNECTOR_ATTRS = ["connection_type", "amps", "voltage", "power_kw", "quantity", "current_type",
                   "date_last_status_update", "ingest_timestamp"]


BRONZE_BYTES = 16 << 30  # of documents whose texts are shuffled at a time
BRONZE_PARTS = 8  # at most, as each part reads the documents again


def bronze_stations(landing_docs: DataFrame, as_of: str, parsed: bool = False, part: tuple[int, int] | None = None) -> DataFrame:
    """Raw documents (``raw_text``) with UUID, source and ingest stamp; one per UUID.
    ``parsed`` adds the station fields as texts, so that silver need not parse again;
    ``part`` (k, n) takes the k-th of n parts of the UUIDs."""
    return landing.add_bronze_metadata(landing_docs, as_of, part=part, **({"fields": STATION_FIELDS, "apart": ["connections"]} if parsed else {}))


def _write_bronze(docs: DataFrame, as_of: str, path: str) -> tuple[StructType, dict]:
    """Write the bronze rows of documents, in parts where the shuffle of all texts would take much disk.
    Returns their schema, number and greatest stamp."""
    from pyspark.sql import Observation

    size = docs.agg(F.sum(F.octet_length("raw_text"))).first()[0] or 0
    parts = min(max(math.ceil(size / BRONZE_BYTES), 1), BRONZE_PARTS)
    n, wm = 0, None
    for k in range(parts):
        rows = bronze_stations(docs, as_of, part=(k, parts))
        obs = Observation()
        (rows.observe(obs, F.count(F.lit(1)).alias("n"), F.max("ingest_timestamp").alias("wm"))
         .write.mode("append" if k else "overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "9").parquet(path))
        n, wm = n + obs.get["n"], obs.get["wm"] or wm  # one stamp for all
    return rows.schema, {"n": n, "wm": wm}


def _to_ts(c: str):
    """ISO text (``...Z`` or with an offset) -> UTC wall time as ``timestamp_ntz``,
    independent of the session time zone."""
    instant = F.col(c).try_cast("timestamp")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), ts_ntz("1970-01-01 00:00:00"))


RAW = "raw"  # struct of the texts before their cast, kept for the quarantine


def _marked_station_rows(bronze: DataFrame, watermark: str) -> DataFrame:
    """New bronze rows, typed and marked: what does not parse is null and rejected as
    malformed, with its text in ``raw``."""
    df = transform.incremental_filter(bronze, watermark)
    fields = list(STATION_FIELDS.values())
    if set(fields) <= set(df.columns):
        df = df.select("ingest_timestamp", *fields)
    else:
        df = transform.extract_json(df, "raw_text", STATION_FIELDS, keep=["ingest_timestamp"])
    df = df.withColumnRenamed("ingest_timestamp", "source_ingest_timestamp")
    df = df.withColumn(RAW, F.struct(*STATION_REQUIRED))
    df = transform.cast_columns(df, {"latitude": "double", "longitude": "double", "status_id": "int"})
    df = df.withColumns({"date_last_status_update": _to_ts("date_last_status_update"), "date_created": _to_ts("date_created")})
    return quality.with_validity(df, STATION_REQUIRED, raw=RAW)


def _finished_station_rows(valid: DataFrame, as_of: str, regions=None) -> DataFrame:
    valid = transform.standardize_values(valid.drop(RAW), "state_or_province")
    if regions is not None:
        valid = geo.nearest_region(valid.drop("town"), regions, x="longitude", y="latitude", out="town")
    valid = transform.assign_zone(valid)
    return transform.add_ingest_timestamp(valid, as_of)


def silver_station_rows(bronze: DataFrame, watermark: str, as_of: str,
                        regions: DataFrame | None = None, gate: bool = True) -> tuple[DataFrame, DataFrame]:
    """New bronze rows -> (typed, standardised station rows, quarantined rows).

    ``source_ingest_timestamp`` keeps the bronze stamp, so the next watermark is taken
    from the source (not from this run's processing time)."""
    marked = _marked_station_rows(bronze, watermark)
    if gate:
        quality.assert_columns_populated(marked.drop("is_valid", "reject_reasons", RAW))
    valid = marked.where(F.col("is_valid")).drop("is_valid", "reject_reasons")
    rejected = marked.where(~F.col("is_valid")).drop("is_valid")
    return _finished_station_rows(valid, as_of, regions), rejected


def apply_station_history(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Station SCD-2 batch -> new table state (``station_sk`` surrogate key)."""
    t = target.withColumnRenamed("station_sk", "sk")
    out = scd2.apply_changes(t, rows.withColumn("ts", F.col("date_last_status_update")), ["station_id"],
                             STATION_ATTRS, STATION_TRACKED, ts="ts")
    return out.withColumnRenamed("sk", "station_sk")


def flat_connectors(station_rows: DataFrame, as_of: str) -> DataFrame:
    """Station rows -> one row per connector; a station without any keeps one null row."""
    ex = transform.explode_json_array(station_rows, "connections", CONNECTION,
                                      keep=["station_id", "date_last_status_update"], alias="conn")
    flat = transform.flatten(ex, CONNECTION_FIELDS, keep=["station_id", "date_last_status_update"])
    return transform.add_ingest_timestamp(flat, as_of)


def connector_rows(station_rows: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(valid connector rows, quarantined rows)."""
    return quality.split_valid(flat_connectors(station_rows, as_of), CONNECTOR_REQUIRED, CONNECTOR_NON_NEGATIVE)


def apply_connector_history(target: DataFrame, rows: DataFrame) -> DataFrame:
    t = target.withColumnRenamed("connection_sk", "sk")
    out = scd2.apply_changes(t, rows.withColumn("ts", F.col("date_last_status_update")), CONNECTOR_KEYS,
                             CONNECTOR_ATTRS, CONNECTOR_TRACKED, ts="ts")
    return out.withColumnRenamed("sk", "connection_sk")


def silver_weather(bronze_weather: DataFrame, watermark: str, as_of: str) -> DataFrame:
    return transform.standardize_weather(transform.incremental_filter(bronze_weather, watermark), as_of)


def upsert_weather(target: DataFrame, new_rows: DataFrame) -> DataFrame:
    return upsert.upsert(target, new_rows, ["weather_sk"])


def gold(stations: DataFrame, connectors: DataFrame, weather: DataFrame, as_of: str,
         mode: str = "parity", split_unit: str | None = "month") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(station facts, station dim, weather dim). Zones are joined on integer cell ids;
    a station's versions are windowed per (station, ``split_unit``) (hot-key safe)."""
    zs = ("zone_lat_cell", "zone_lon_cell")
    s = stations.withColumns({zs[0]: grid_cell_id("weather_zone_lat"), zs[1]: grid_cell_id("weather_zone_lon")})
    w = weather.withColumns({zs[0]: grid_cell_id("lat"), zs[1]: grid_cell_id("lon")})
    kw = dict(station_zone=zs, weather_zone=zs)
    split = F.date_trunc(split_unit, F.col("date_last_status_update")) if split_unit else None
    facts = marts.station_facts(s, connectors, w, as_of, mode=mode, connector_order=("connection_sk",),
                                split=split, **kw)
    return (facts, marts.station_dim(s, connectors, w, as_of, mode=mode, **kw),
            marts.weather_dim(s, connectors, w, as_of, **kw))


def station_store(root: str, buckets: int = 64) -> HistoryStore:
    """Station history; rows of one station with an equal time are ordered by status."""
    return HistoryStore(root, ("station_id",), tuple(STATION_ATTRS), tuple(STATION_TRACKED), "date_last_status_update", ("status_id",), buckets)


def connector_store(root: str, buckets: int = 64) -> HistoryStore:
    return HistoryStore(root, tuple(CONNECTOR_KEYS), tuple(CONNECTOR_ATTRS), tuple(CONNECTOR_TRACKED), "date_last_status_update",
                        ("amps", "voltage", "power_kw", "quantity"), buckets)


def _stamp(t) -> str:
    return t.strftime("%Y%m%dT%H%M%S%f")


def _staged(marked: DataFrame, path: str, taken: str | None, gate: list[str]) -> dict:
    """Write marked rows once, partitioned by validity. The counts, the greatest stamp of
    ALL rows taken (so that rejected rows are not taken again) and the gate's non-null
    counts are observed on that write; a gate column without any value stops the run."""
    from pyspark.sql import Observation

    obs = Observation("stage")
    (marked.observe(obs, F.count_if("is_valid").alias("ok"), F.count_if(~F.col("is_valid")).alias("bad"),
                    F.max(taken if taken else F.lit(None).cast("timestamp_ntz")).alias("wm"),
                    *[F.count(F.col(c)).alias(f"n_{c}") for c in gate])
     .write.mode("overwrite").option("compression", "zstd").partitionBy("is_valid").parquet(path))
    m = dict(obs.get)
    empty = [c for c in gate if m["ok"] + m["bad"] and not m[f"n_{c}"]]
    if empty:
        raise quality.ColumnGateError(f"Pipeline stopped: column(s) {empty} are all NULL")
    return m


def _part(spark, marked: DataFrame, path: str, valid: bool) -> DataFrame:
    schema = marked.drop("is_valid").schema  # known: no schema-inference jobs
    return spark.read.schema(schema).parquet(f"{path}/is_valid={'true' if valid else 'false'}")


def run_bronze_batch(spark, control_table: str, documents: DataFrame, bronze_location: str, as_of: str,
                     pipeline: str = "stations", modified: str = "DateLastStatusUpdate") -> DataFrame | None:
    """Bronze run: documents modified after the last run's watermark less the re-delivery
    buffer -> one row per UUID, written as this run's folder (a repeated run overwrites
    it). Without any such document the run is recorded as skipped and None returned."""
    from lakehold.functions.columns import evaluate_once, get_path, parse_strings
    from lakehold.operators import control

    holder = {"rows": None}

    def step():
        wm = control.last_watermark(spark.table(control_table), pipeline, "bronze")
        since = transform.buffered(ts_ntz(wm.strftime("%Y-%m-%d %H:%M:%S.%f")))
        docs = evaluate_once(documents.select("raw_text"), parse_strings("raw_text", [modified]), "__m")
        docs = docs.withColumn("__t", get_path(F.col("__m"), modified))
        # a document without a readable time is taken: the silver run rejects it with its reason
        new = docs.where((_to_ts("__t") > since) | _to_ts("__t").isNull()).select("raw_text")
        path = f"{bronze_location}/run={as_of.replace(' ', 'T').replace(':', '')}"
        schema, m = _write_bronze(new, as_of, path)
        if not m["n"]:
            return wm, 0, 0, "skipped"
        holder["rows"] = spark.read.schema(schema).parquet(path)
        return m["wm"], int(m["n"]), 0

    control.run_step(spark, control_table, pipeline, "bronze", step)
    return holder["rows"]


def run_bronze_files(spark, control_table: str, landing_path: str, bronze_location: str, checkpoint: str, as_of: str,
                     pipeline: str = "stations") -> DataFrame | None:
    """Bronze run over landed JSON-lines files: a file stream with a checkpoint takes each
    file once, whenever it lands and however old its documents are, and stops when all there
    are have been taken. A micro-batch becomes one row per UUID in a folder of its own, which
    a repeated micro-batch overwrites. Returns this run's rows; without a new file the run is
    recorded as skipped and None returned."""
    from lakehold.operators import control

    done: dict[int, dict] = {}
    schemas = []

    def write(docs: DataFrame, batch_id: int) -> None:
        schema, done[batch_id] = _write_bronze(docs, as_of, f"{bronze_location}/batch={batch_id}")
        schemas.append(schema)

    def step():
        stream = landing.read_landing(spark, landing_path, stream=True)
        q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        n = sum(m["n"] for m in done.values())
        if not n:
            return control.last_watermark(spark.table(control_table), pipeline, "bronze"), 0, 0, "skipped"
        return max(m["wm"] for m in done.values() if m["wm"]), n, 0

    control.run_step(spark, control_table, pipeline, "bronze", step)
    taken = [f"{bronze_location}/batch={b}" for b, m in sorted(done.items()) if m["n"]]
    return spark.read.schema(schemas[0]).parquet(*taken) if taken else None


def run_station_batch(spark, control_table: str, bronze: DataFrame, store: HistoryStore, quarantine_location: str,
                      as_of: str, regions: DataFrame | None = None, pipeline: str = "stations",
                      staging_location: str | None = None) -> DataFrame | None:
    """One scheduled silver run for stations, recorded in the control table.

    The parsed rows are written once, partitioned by validity; the gate, the counts and
    the next watermark come from that write. Rejected rows go to a quarantine folder named
    after the watermark that the run started from, so a repeated run overwrites it; valid
    rows are applied to the history store. Returns the valid rows (with ``connections``,
    for the connector run; they read the staging folder, which is the caller's to clear), or
    None when there was nothing new.
    """
    from lakehold.operators import control
    from lakehold.session import shared_dir

    holder = {"rows": None}
    staging = staging_location or shared_dir(spark, f"staging-{pipeline}")

    def step():
        wm = control.last_watermark(spark.table(control_table), pipeline, "silver")
        marked = _marked_station_rows(bronze, wm.strftime("%Y-%m-%d %H:%M:%S.%f"))
        m = _staged(marked, staging, "source_ingest_timestamp", list(STATION_FIELDS.values()))
        if m["bad"]:
            _part(spark, marked, staging, False).write.mode("overwrite").option("compression", "zstd").parquet(f"{quarantine_location}/after={_stamp(wm)}")
        tables.drop_folder(spark, f"{staging}/is_valid=false")
        if m["ok"]:
            rows = _finished_station_rows(_part(spark, marked, staging, True).drop("reject_reasons"), as_of, regions)
            store.apply(rows, store.last_batch(spark) + 1)
            holder["rows"] = rows
        return (m["wm"] or wm), int(m["ok"]), int(m["bad"])

    control.run_step(spark, control_table, pipeline, "silver", step)
    return holder["rows"]


def run_connector_batch(spark, control_table: str, valid_stations: DataFrame, store: HistoryStore, quarantine_location: str,
                        as_of: str, pipeline: str = "connectors", staging_location: str | None = None) -> DataFrame:
    """Silver run for connectors over the valid rows of a station run: explode, gate,
    quarantine (a folder per run stamp) and history, recorded in the control table.
    Returns the connector table."""
    from lakehold.operators import control
    from lakehold.session import shared_dir

    staging = staging_location or shared_dir(spark, f"staging-{pipeline}")

    def step():
        flat = flat_connectors(valid_stations, as_of)
        marked = quality.with_validity(flat, CONNECTOR_REQUIRED, CONNECTOR_NON_NEGATIVE)
        m = _staged(marked, staging, "ingest_timestamp", [c for c in flat.columns])
        if m["bad"]:
            _part(spark, marked, staging, False).write.mode("overwrite").option("compression", "zstd").parquet(f"{quarantine_location}/run={as_of.replace(' ', 'T').replace(':', '')}")
        tables.drop_folder(spark, f"{staging}/is_valid=false")
        if m["ok"]:
            store.apply(_part(spark, marked, staging, True).drop("reject_reasons"), store.last_batch(spark) + 1)
        tables.drop_folder(spark, staging)
        return m["wm"], int(m["ok"]), int(m["bad"])

    control.run_step(spark, control_table, pipeline, "silver", step)
    return store.state(spark)


def run_weather_batch(spark, control_table: str, bronze_weather: DataFrame, target: DataFrame,
                      target_location: str, as_of: str, pipeline: str = "weather") -> tuple[DataFrame, int]:
    """Silver weather run: new bronze rows -> standardised -> upserted by weather_sk, one
    row per key, into the table at ``target_location``, which is partitioned by the day of
    observation: only days that the batch touches are written. ``target`` is that table, or
    one whose rows it starts with. The new watermark is the max bronze stamp of the rows
    taken. Returns the new table and the number of rows inserted (not updated); without new
    rows the table stays as it is."""
    from pyspark.sql import Observation

    from lakehold.operators import control
    from lakehold.session import shared_dir

    columns = target.columns
    holder = {"t": target, "inserted": 0}
    day = F.to_date("dt_utc")

    def step():
        wm = control.last_watermark(spark.table(control_table), pipeline, "silver")
        new = transform.incremental_filter(bronze_weather, wm.strftime("%Y-%m-%d %H:%M:%S.%f"))
        obs = Observation("weather")
        new = new.observe(obs, F.count(F.lit(1)).alias("n"), F.max("ingest_timestamp").alias("wm"))
        staging = shared_dir(spark, f"staging-{pipeline}")
        rows = transform.standardize_weather(new, as_of).select(*columns)
        rows.write.parquet(f"{staging}/rows")
        rows = spark.read.schema(rows.schema).parquet(f"{staging}/rows")
        m = obs.get
        if m["n"]:
            if not any(_is_under(f, target_location) for f in target.inputFiles()):
                upsert.upsert_partitions(target_location, target, ["weather_sk"], day, f"{staging}/first")
            holder["inserted"] = upsert.upsert_partitions(target_location, rows, ["weather_sk"], day, f"{staging}/new")
            holder["t"] = spark.read.schema(target.schema).parquet(target_location).select(*columns)
        tables.drop_folder(spark, staging)
        return (m["wm"] or wm), int(m["n"]), 0

    control.run_step(spark, control_table, pipeline, "silver", step)
    return holder["t"], holder["inserted"]


def _is_under(file: str, folder: str) -> bool:
    plain = lambda x: x.split(":", 1)[1] if ":" in x.split("/", 1)[0] else x  # noqa: E731 - without scheme
    return plain(file).lstrip("/").startswith(plain(folder).strip("/") + "/")


def run_gold(spark, control_table: str, stations: DataFrame, connectors: DataFrame, weather: DataFrame,
             out_root: str, as_of: str, mode: str = "parity", pipeline: str = "marts"):
    """Gold run: facts are appended (a folder per run stamp, which a repeated run
    overwrites), both dimensions are written anew for the run, and the facts' stamp is
    the recorded watermark. Returns the tables (facts of all runs) and the health report."""
    from pyspark.sql import Observation

    from lakehold.operators import control
    from lakehold.plans import health

    holder = {}
    run = f"run={as_of.replace(' ', 'T').replace(':', '')}"

    def step():
        outs = dict(zip(("station_facts", "station_dim", "weather_dim"),
                        gold(stations, connectors, weather, as_of, mode), strict=True))
        counts, written = {}, {}
        for name, df in outs.items():
            obs = Observation(name)
            path = f"{out_root}/{name}/{run}"
            stamped = transform.add_ingest_timestamp(df, as_of) if "ingest_timestamp" not in df.columns else df
            (stamped.observe(obs, F.count(F.lit(1)).alias("n"), F.max("ingest_timestamp").alias("wm"))
             .write.mode("overwrite").parquet(path))
            counts[name] = dict(obs.get)
            written[name] = spark.read.schema(stamped.schema).parquet(f"{out_root}/{name}" if name == "station_facts" else path)
        holder["tables"] = {n: t.drop("run") for n, t in written.items()}
        holder["health"] = health.health_report(spark, holder["tables"], health.MART_RULES, as_of)
        return counts["station_facts"]["wm"], counts["station_facts"]["n"], 0

    control.run_step(spark, control_table, pipeline, "gold", step)
    return holder["tables"], holder["health"]
