"""Station facts kept up to date from batches of changed rows.

``marts.station_facts`` reads all versions, connectors and observations. ``FactStore``
keeps what the facts are made of in station buckets (``operators.buckets``) and computes
anew only stations with changed versions or connectors, and those that waited for a first
observation of their zone. A newer observation of a known zone touches no station: facts
meet the zones when they are read. Layout under ``root``::

    versions/batch=<id>/bucket=<k>/    rows as they came; of a key those of the last batch count
    connectors/batch=<id>/bucket=<k>/
    zones/batch=<id>/                  latest observation per zone of the batch; these are merged
    touched/, current/, marked/batch=<id>/  stations to compute anew, their versions, these with neighbours
    state/batch=<id>/bucket=<k>/       per (station, zone): sums over versions; zones not seen yet
    running/batch=<id>/bucket=<k>/     offline versions that had not ended at the batch's time
    power/batch=<id>/bucket=<k>/       per station: its connectors
    commits/batch=<id>/                per bucket: rows, rebuilt or split; bucket 0 stands for the zones

A batch opens the buckets of its stations only, and writes their ``state``, ``running`` and
``power`` whole. No state depends on the time that facts are asked for: ended versions are
summed, running ones are kept as rows. So ``facts`` may be read for any time not before the
latest batch, without any change. A bucket that grows over ``max_rows`` splits, and its rows are
compacted to those that count.

Cases: rows without a station count nowhere; a null zone never meets an observation; a
version is one (station_id, station_sk), a connector one (station_id, order columns), an
observation one (dt_utc, weather_sk): what comes again replaces the rows of former batches, and
repeated rows of one batch all count, as in one pass; empty
batches change nothing; a batch that fails or is repeated overwrites its own folders.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, TimestampNTZType
from pyspark.errors import AnalysisException

from lakehold.functions.columns import minutes_between, ts_ntz
from lakehold.operators.buckets import INIT_BATCH, MAX_ROWS, BucketFiles, Directory
from lakehold.plans import marts
from lakehold.session import STATUS_OPERATIONAL, STATUS_TEMP_UNAVAILABLE

ZONES = 0  # bucket of the commit that stands for the zones
LOGS, PARTS = ("versions", "connectors"), ("state", "running", "power")


@dataclass(frozen=True)
class FactStore(BucketFiles):
    root: str
    mode: str = "parity"
    station_zone: tuple[str, ...] = ("weather_zone_lat", "weather_zone_lon")
    weather_zone: tuple[str, ...] = ("lat", "lon")
    connector_order: tuple[str, ...] = ("connection_sk",)
    buckets: int = 64  # at first
    max_rows: int = MAX_ROWS
    keys: tuple[str, ...] = ("station_id",)
    _schemas: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        if self.mode not in ("parity", "corrected"):
            raise ValueError("mode must be 'parity' or 'corrected'")

    def _time_type(self, spark: SparkSession) -> DataType:
        return TimestampNTZType()  # commits keep the time that their batch was computed for

    # ------------------------------------------------------------ inputs

    def _versions(self, df: DataFrame) -> DataFrame:
        cols = ["station_id", "station_sk", "status_id", "date_last_status_update", "valid_from", "valid_to", "date_created", *self.station_zone]
        return df.where("station_id is not null").select(*cols)

    def _connectors(self, df: DataFrame) -> DataFrame:
        current = [F.col("is_current")] if "is_current" in df.columns else [F.lit(True).alias("is_current")]
        return df.where("station_id is not null").select("station_id", "level_id", "power_kw", "quantity", *self.connector_order, *current)

    def _log_key(self, part: str) -> list[str]:
        return ["station_id", "station_sk"] if part == "versions" else ["station_id", *self.connector_order]

    def _zones(self, weather: DataFrame, batch_id: int) -> DataFrame:
        """Per zone: the latest observation, that of the later batch first among equal ones."""
        seen = F.struct("dt_utc", "weather_sk", F.lit(batch_id).cast("long").alias("batch_id"), "weather", "temp")
        zones = [F.col(w).alias(s) for s, w in zip(self.station_zone, self.weather_zone, strict=True)]
        return weather.groupBy(*zones).agg(F.max(seen).alias("latest"), F.max("weather_zone_id").alias("max_zone_id")).dropna(subset=list(self.station_zone))

    # ------------------------------------------------------------ what is kept

    def _marked(self, versions: DataFrame, known: DataFrame, split: Column | None) -> DataFrame:
        """Versions in a seen zone with offline marks, and (``qualified`` false) those whose zone is still unseen."""
        v = versions.where(F.col("status_id").isin(STATUS_OPERATIONAL, STATUS_TEMP_UNAVAILABLE)).dropna(subset=list(self.station_zone))
        v = v.withColumn("is_operational", F.col("status_id") == STATUS_OPERATIONAL)
        seen = known.select(*self.station_zone).distinct().withColumn("__seen", F.lit(True))
        v = v.join(seen, list(self.station_zone), "left").withColumn("qualified", F.col("__seen").isNotNull())
        # only versions in a seen zone are neighbours of each other; one pass over both kinds
        marked = marts.with_offline_marks(v, self.mode, split, ("station_id", "qualified"))
        marks = {c: F.col("qualified") & F.col(c) for c in ("offline_start", "offline_timed")}
        return marked.withColumns(marks).select(*self._versions(versions).columns, "is_operational", *marks, "qualified")

    def _state(self, marked: DataFrame, as_of: str) -> DataFrame:
        ended = F.col("valid_to") <= ts_ntz(as_of)
        minutes = marts.offline_minutes(F.col("valid_to"), self.mode)
        # minutes of running versions are added when facts are read; a sum of nulls alone stays null, as in one pass
        done = F.when(~F.col("offline_timed"), 0).when(ended, minutes)
        return marked.groupBy("station_id", *self.station_zone, "qualified").agg(
            F.max(F.struct(*marts.VERSION_ORDER, "is_operational")).alias("top"),
            F.sum(F.when(F.col("offline_start"), 1).otherwise(0)).alias("offline_count"),
            F.sum(done).alias("ended_minutes"), F.max("date_created").alias("date_created"))

    def _running(self, marked: DataFrame, as_of: str) -> DataFrame:
        ended = F.coalesce(F.col("valid_to") <= ts_ntz(as_of), F.lit(False))
        return marked.where(F.col("qualified") & F.col("offline_timed") & ~ended).select("station_id", "valid_from", "valid_to")

    # ------------------------------------------------------------ files

    def create(self, spark: SparkSession, versions: DataFrame, connectors: DataFrame, weather: DataFrame) -> None:
        """Create an empty store for inputs of these columns and types, if there is none."""
        try:
            spark.read.parquet(f"{self.root}/commits/batch={INIT_BATCH}")
            return
        except AnalysisException:
            pass
        v, c, z = self._versions(versions), self._connectors(connectors), self._zones(weather, 0)
        marked = self._marked(v, z, None)
        frames = {"versions": v, "connectors": c, "zones": z, "state": self._state(marked, "2000-01-01"),
                  "running": self._running(marked, "2000-01-01"), "power": marts.connectors_per_station(c, self.connector_order, self.mode)}
        for name, df in frames.items():
            empty = spark.createDataFrame([], df.schema)
            empty.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/schema_{name}")
            self._write(empty.withColumn("bucket", F.lit(ZONES).cast("long")), name, INIT_BATCH)
        self._commit(spark, [], INIT_BATCH)

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        return self._files(spark, part, f"schema_{part}")

    def _log(self, spark: SparkSession, part: str, d: Directory, buckets: Iterable[int], batch_id: int, stations: DataFrame | None = None) -> DataFrame:
        """Of each key of the buckets (and of ``stations``) the rows of the last batch that has it; files of other
        buckets are not opened."""
        by_base: dict[int, list[int]] = {}
        for b in buckets:
            by_base.setdefault(d.base.get(b, INIT_BATCH), []).append(b)
        wanted = F.lit(False)
        for base, bs in by_base.items():
            wanted = wanted | ((F.col("batch") >= base) & F.col("bucket").isin(bs))
        batches = [*d.batches, batch_id]
        rows = self._read(spark, part).where(wanted & F.col("batch").isin(batches))
        if stations is not None:
            rows = rows.join(stations, ["station_id"], "left_semi")
        if len({b for b in batches if b != INIT_BATCH and b >= min(by_base, default=INIT_BATCH)}) > 1:  # of one batch all rows count
            newest = F.max("batch").over(Window.partitionBy(*self._log_key(part)))  # a key has a row or two per batch
            rows = rows.withColumn("__newest", newest).where("batch = __newest").drop("__newest")
        return rows.drop("bucket", "batch")

    def _rows(self, spark: SparkSession, part: str, d: Directory, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of a part that buckets are written whole in: those of each bucket's last batch."""
        by_batch: dict[int, list[int]] = {}
        for b, last in d.last.items():
            if b != ZONES and (buckets is None or b in buckets):
                by_batch.setdefault(last, []).append(b)
        wanted = F.lit(False)
        for batch, bs in by_batch.items():
            wanted = wanted | ((F.col("batch") == batch) & F.col("bucket").isin(bs))
        return self._read(spark, part).where(wanted).drop("bucket", "batch")

    def _known_zones(self, spark: SparkSession, batches: Iterable[int]) -> DataFrame:
        z = self._read(spark, "zones").where(F.col("batch").isin(list(batches)))
        return z.groupBy(*self.station_zone).agg(F.max("latest").alias("latest"), F.max("max_zone_id").alias("max_zone_id"))

    def _put(self, df: DataFrame, part: str, batch_id: int) -> DataFrame:
        path = f"{self.root}/{part}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def computed_for(self, spark: SparkSession) -> datetime | None:
        """The latest time that a batch was computed for."""
        return self._commits(spark).agg(F.max("max_ts")).first()[0]

    # ------------------------------------------------------------ writing

    def apply(self, versions: DataFrame, connectors: DataFrame, weather: DataFrame, batch_id: int, as_of: str,
              split: Column | None = None) -> list[int]:
        """Take changed versions (closed ones too), connectors and observations, and commit them.
        ``split`` deals a hot station's versions over tasks. Returns the buckets computed anew."""
        spark = versions.sparkSession
        d = self.directory(spark, batch_id)
        at = datetime.fromisoformat(as_of)
        self._write(self._zones(weather, batch_id).withColumn("bucket", F.lit(ZONES).cast("long")), "zones", batch_id)
        new = {"versions": self._versions(versions), "connectors": self._connectors(connectors)}
        for part, df in new.items():
            self._write(df.withColumn("bucket", self._bucket(d)), part, batch_id)
        mine = {p: self._read(spark, p).where(F.col("batch") == batch_id) for p in LOGS}

        batches = [*d.batches, batch_id]
        first_seen = self._read(spark, "zones").where(F.col("batch") == batch_id).join(
            self._known_zones(spark, d.batches), list(self.station_zone), "left_anti")
        woken = self._rows(spark, "state", d).where(~F.col("qualified")).join(first_seen, list(self.station_zone), "left_semi")
        cols = ["station_id", "bucket"]
        touched = mine["versions"].select(*cols).unionByName(mine["connectors"].select(*cols)).unionByName(
            woken.withColumn("bucket", self._bucket(d)).select(*cols))
        touched = self._put(touched.groupBy(*cols).count().select(*cols), "touched", batch_id)
        open_buckets = sorted(r[0] for r in touched.select("bucket").distinct().collect())
        if not open_buckets:
            self._commit(spark, [(ZONES, False, False, 0, 0, at, at)], batch_id)
            return []

        added = {b: 0 for b in open_buckets}
        for df in mine.values():
            for r in df.groupBy("bucket").count().collect():
                added[r["bucket"]] += r["count"]
        large = [b for b in open_buckets if (n := d.rows.get(b, 0) + added[b]) > self.max_rows and n >= 2 * d.checked.get(b, 0)]
        split_buckets, leaves, checked = [], {}, {}
        if large:
            logs = [self._log(spark, p, d, large, batch_id).select("station_id") for p in LOGS]
            by_key = logs[0].unionByName(logs[1]).withColumn("bucket", self._bucket(d)).groupBy("bucket", self._hash().alias("h")).agg(F.count(F.lit(1)).alias("n"))
            sizes = {r["bucket"]: (r["n"], r["top"]) for r in by_key.groupBy("bucket").agg(F.sum("n").alias("n"), F.max("n").alias("top")).collect()}
            split_buckets, leaves = self._plan(sizes)
            checked = {b: d.rows.get(b, 0) + added[b] for b in large if b not in leaves}
        after = Directory(d.depth, d.split | set(split_buckets))

        stations = touched.select("station_id")
        v, c = (self._log(spark, p, d, open_buckets, batch_id, stations) for p in LOGS)
        v = self._put(v, "current", batch_id)  # marks take it twice, rows and edges of their splits
        marked = self._put(self._marked(v, self._known_zones(spark, batches), split), "marked", batch_id)
        power = marts.connectors_per_station(c, self.connector_order, self.mode)
        fresh = {"state": self._state(marked, as_of), "running": self._running(marked, as_of), "power": power}
        for part in PARTS:
            kept = self._rows(spark, part, d, open_buckets).join(stations, ["station_id"], "left_anti")
            self._write(kept.unionByName(fresh[part]).withColumn("bucket", self._bucket(after)), part, batch_id)

        commit = [(ZONES, False, False, 0, 0, at, at)]
        commit += [(b, False, False, added[b], checked.get(b, 0), at, at) for b in open_buckets if b not in leaves]
        if leaves:
            below = [x for b in leaves for x in leaves[b]]
            count = dict.fromkeys(below, 0)
            for part in LOGS:
                dealt = self._log(spark, part, d, list(leaves), batch_id).withColumn("bucket", self._bucket(after))
                self._write(dealt, part, batch_id, mode="append")
                got = self._read(spark, part).where((F.col("batch") == batch_id) & F.col("bucket").isin(below))
                for r in got.groupBy("bucket").count().collect():
                    count[r["bucket"]] += r["count"]
            commit += [(b, True, False, n, 0, at, at) for b, n in count.items()]
            commit += [(b, False, True, 0, 0, None, None) for b in split_buckets]
        self._commit(spark, commit, batch_id)
        return open_buckets

    # ------------------------------------------------------------ reading

    def facts(self, spark: SparkSession, as_of: str) -> DataFrame:
        """The rows of ``marts.station_facts`` over all rows taken, for a time not before that of the latest batch."""
        latest = self.computed_for(spark)
        if latest is not None and datetime.fromisoformat(as_of) < latest:
            raise ValueError(f"facts for {as_of} need versions that ended since; the store was computed for {latest}")
        now, d = ts_ntz(as_of), self.directory(spark)
        zones = self._known_zones(spark, d.batches)
        state = self._rows(spark, "state", d).where("qualified").join(zones, list(self.station_zone))
        per = state.groupBy("station_id").agg(
            F.max("max_zone_id").alias("weather_zone_id"), F.max("latest").alias("lw"), F.max("top").getField("is_operational").alias("is_operational"),
            F.sum("offline_count").alias("offline_count"), F.sum("ended_minutes").alias("ended_minutes"), F.max("date_created").alias("date_created"))
        running = self._rows(spark, "running", d).groupBy("station_id").agg(F.sum(marts.offline_minutes(now, self.mode)).alias("running_minutes"))
        agg = per.join(running, ["station_id"], "left").join(self._rows(spark, "power", d), ["station_id"])
        both = F.coalesce(F.col("ended_minutes") + F.col("running_minutes"), "ended_minutes", "running_minutes").cast(LongType())
        agg = agg.withColumns({"offline_duration": both, "total_duration": minutes_between(F.col("date_created"), now)})
        return marts.fact_rows(agg, as_of, self.mode)
