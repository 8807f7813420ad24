"""Gold marts: station facts and the two dimensions.

The facts are computed without the station x connector x weather fan-out of the
naive plan ("G-fast"): connectors are reduced to one row per station and weather to
one row per zone *before* the join, so the join and the window run on version rows
only. Because all copies of a version are adjacent in the fan-out's window order,
only the first copy can count as a transition, which makes the reduced plan equal
to the fan-out (a unit test checks this on small frames).

Two variants:
* ``parity``    - the reference's semantics, with deterministic tie-breakers: the
                  window runs newest-first, so an offline version is counted when its
                  *newer* neighbour is operational (or it is the newest); weather match
                  is case-sensitive; cost uses the first connector of the station.
* ``corrected`` - oldest-first: counts offline periods (runs) and sums every offline
                  version's duration; case-insensitive weather match; cost over all
                  current connectors; only current connectors are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.functions.columns import minutes_between, ts_ntz
from lakehold.operators.windows import with_neighbor
from lakehold.session import STATUS_OPERATIONAL, STATUS_TEMP_UNAVAILABLE

# Fixed values of the risk model.
RISK_BASE = 15
RISK_WEATHER = 30  # latest weather matches '%storm%' or '%snow%'
RISK_TEMP = 30  # latest temp > 95 or < 20 (Fahrenheit)
RISK_LEVEL = 25  # highest connector level is 3
RISK_HIGH_AT = 60
TEMP_HIGH, TEMP_LOW = 95, 20
COST_FACTOR = 0.35
WEATHER_PATTERNS = ("%storm%", "%snow%")



def connectors_per_station(connectors: DataFrame, order: Sequence[str], mode: str) -> DataFrame:
    """One row per station: highest level, first connector's power, total power."""
    c = connectors
    if mode == "corrected" and "is_current" in c.columns:
        c = c.where(F.col("is_current"))
    c = c.withColumn("total_power", F.col("power_kw") * F.col("quantity"))
    from pyspark.sql.types import IntegralType

    if len(order) == 1 and isinstance(c.schema[order[0]].dataType, IntegralType):
        # one integral surrogate key: fixed-width buffers, so a hash aggregate
        first = F.min_by("total_power", F.col(order[0]))
    else:  # several order columns: struct buffer (sort-based aggregate)
        first = F.min(F.struct(*[F.col(o) for o in order], F.col("total_power"))).getField("total_power")
    return c.groupBy("station_id").agg(
        F.max("level_id").alias("max_level"),
        first.alias("first_power"),
        F.sum("total_power").alias("sum_power"),
    )


def latest_weather_per_zone(weather: DataFrame, zone_cols: Sequence[str]) -> DataFrame:
    """One row per zone: the latest observation by (dt_utc, weather_sk).

    The greatest time per zone is a hash aggregate over fixed-width columns; only the few
    observations of that time are then compared as structs (which would sort)."""
    top = weather.groupBy(*zone_cols).agg(F.max("dt_utc").alias("__top"), F.max("weather_zone_id").alias("max_zone_id"))
    same = F.col("w.dt_utc").eqNullSafe(F.col("t.__top"))
    for z in zone_cols:
        same = same & (F.col(f"w.{z}") == F.col(f"t.{z}"))
    last = weather.alias("w").join(top.alias("t"), same).select("w.*", "t.max_zone_id")
    latest = F.max(F.struct("dt_utc", "weather_sk", "weather", "temp"))
    return last.groupBy(*zone_cols).agg(latest.alias("latest"), F.max("max_zone_id").alias("max_zone_id"))


def _qualified_versions(versions, connectors, weather, station_zone, weather_zone,
                        connector_order, mode):
    c1 = connectors_per_station(connectors, connector_order, mode)
    w1 = latest_weather_per_zone(weather, weather_zone)
    w1 = w1.select(*[F.col(w).alias(s) for s, w in zip(station_zone, weather_zone)],
                   "latest", "max_zone_id")
    v = versions.where(F.col("status_id").isin(STATUS_OPERATIONAL, STATUS_TEMP_UNAVAILABLE))
    v = v.withColumn("is_operational", F.col("status_id") == STATUS_OPERATIONAL)
    # zone side first: one row per zone (small; AQE broadcasts it by measured size),
    # then the station-keyed join, whose partitioning the window and aggregate reuse
    v = v.join(w1, on=list(station_zone), how="inner")
    return v.join(c1, on="station_id", how="inner")


def station_facts(versions: DataFrame, connectors: DataFrame, weather: DataFrame,
                  as_of: str, *, mode: str = "parity",
                  station_zone: Sequence[str] = ("weather_zone_lat", "weather_zone_lon"),
                  weather_zone: Sequence[str] = ("lat", "lon"),
                  connector_order: Sequence[str] = ("connection_sk",),
                  split: Column | None = None) -> DataFrame:
    """Fact row per station: status, offline count/minutes, risk, cost, availability.

    ``versions``: station_id, station_sk, status_id, date_last_status_update,
    valid_from, valid_to, date_created + zone columns. ``connectors``: station_id,
    level_id, power_kw, quantity + ``connector_order`` columns. ``weather``:
    weather_sk, weather_zone_id, dt_utc, weather, temp + zone columns.
    ``split`` optionally splits hot stations for the neighbour window.
    """
    if mode not in ("parity", "corrected"):
        raise ValueError("mode must be 'parity' or 'corrected'")
    now = ts_ntz(as_of)
    j = _qualified_versions(versions, connectors, weather, station_zone, weather_zone,
                            connector_order, mode)
    order = list(VERSION_ORDER)
    j = with_offline_marks(j, mode, split)
    agg = j.groupBy("station_id").agg(
        F.max("max_zone_id").alias("weather_zone_id"),
        F.max("latest").alias("lw"),
        F.max_by("is_operational", F.struct(*order)).alias("is_operational"),
        F.sum(F.when(F.col("offline_start"), 1).otherwise(0)).alias("offline_count"),
        F.sum(F.when(F.col("offline_timed"), offline_minutes(now, mode)).otherwise(0)).alias("offline_duration"),
        minutes_between(F.max("date_created"), now).alias("total_duration"),
        F.max("max_level").alias("max_level"),
        F.max("first_power").alias("first_power"),
        F.max("sum_power").alias("sum_power"),
    )
    return fact_rows(agg, as_of, mode)


VERSION_ORDER = ("date_last_status_update", "station_sk")


def with_offline_marks(versions: DataFrame, mode: str, split: Column | None = None, keys: Sequence[str] = ("station_id",)) -> DataFrame:
    """Qualified versions with ``offline_start`` (counts as a transition) and ``offline_timed``
    (its minutes count), from the neighbour version of the station (or of equal ``keys``)."""
    # newest-first lag == the next-newer version in ascending order
    direction = "next" if mode == "parity" else "prev"
    j = with_neighbor(versions, list(keys), list(VERSION_ORDER), ["is_operational"], direction, "nb_", split)
    starts = ~F.col("is_operational") & F.coalesce(F.col("nb_is_operational"), F.lit(True))
    return j.withColumns({"offline_start": starts, "offline_timed": starts if mode == "parity" else ~F.col("is_operational")})


def offline_minutes(now: Column, mode: str) -> Column:
    """Minutes that a version counts with, up to ``now``."""
    minutes = minutes_between(F.col("valid_from"), F.least(now, F.col("valid_to")))
    return minutes if mode == "parity" else F.greatest(minutes, F.lit(0))


def fact_rows(agg: DataFrame, as_of: str, mode: str) -> DataFrame:
    """Fact rows from one aggregate row per station (``lw``: its latest weather)."""
    like = F.col("lw.weather").like if mode == "parity" else F.col("lw.weather").ilike
    weather_hit = like(WEATHER_PATTERNS[0]) | like(WEATHER_PATTERNS[1])
    temp = F.col("lw.temp")
    risk = (
        F.lit(RISK_BASE)
        + F.when(weather_hit, RISK_WEATHER).otherwise(0)
        + F.when((temp > TEMP_HIGH) | (temp < TEMP_LOW), RISK_TEMP).otherwise(0)
        + F.when(F.col("max_level") == 3, RISK_LEVEL).otherwise(0)
    )
    power = F.col("first_power") if mode == "parity" else F.col("sum_power")
    out = agg.select(
        "station_id",
        "weather_zone_id",
        F.col("lw.weather_sk").alias("weather_sk"),
        "is_operational",
        "offline_count",
        "offline_duration",
        "total_duration",
        risk.alias("risk_score"),
        F.round(F.lit(COST_FACTOR) * power).alias("avg_energy_cost_per_hour"),
    )
    out = out.withColumn(
        "risk_severity_level",
        F.when(F.col("risk_score") < RISK_HIGH_AT, "low_risk").when(F.col("risk_score") >= RISK_HIGH_AT, "high_risk"),
    )
    return add_fact_metrics(out, as_of).select(
        "station_id", "weather_zone_id", "weather_sk", "is_operational", "offline_count",
        "offline_duration", "total_duration", "risk_score", "risk_severity_level",
        "avg_energy_cost_per_hour", "est_downtime_cost", "availability", "ingest_timestamp",
    )


def add_fact_metrics(df: DataFrame, as_of: str) -> DataFrame:
    """est_downtime_cost = cost/h * offline minutes / 60; availability = 1 - offline/total."""
    return df.withColumns({
        "est_downtime_cost": F.col("avg_energy_cost_per_hour") * F.col("offline_duration") / 60,
        "availability": F.round(
            F.lit(1) - F.try_divide(F.col("offline_duration").cast("double"),
                                    F.col("total_duration").cast("double")), 2),
        "ingest_timestamp": ts_ntz(as_of),
    })


STATION_DIM_COLS = ("title", "address", "town", "state_or_province", "latitude", "longitude")
WEATHER_DIM_COLS = ("weather_zone_id", "weather", "description", "temp", "pressure",
                    "humidity", "visibility", "rain", "snow")


def station_dim(versions: DataFrame, connectors: DataFrame, weather: DataFrame, as_of: str,
                *, mode: str = "parity",
                station_zone: Sequence[str] = ("weather_zone_lat", "weather_zone_lon"),
                weather_zone: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Station dimension over the stations that reach the fact join.

    ``parity``: max of every attribute (may mix versions); ``corrected``: the
    attributes of the latest version. ``max_power_kw`` is the highest connector power.
    """
    zones = weather.select(*[F.col(w).alias(s) for s, w in zip(station_zone, weather_zone)]).distinct()
    c = connectors
    if mode == "corrected" and "is_current" in c.columns:
        c = c.where(F.col("is_current"))
    power = c.groupBy("station_id").agg(F.max("power_kw").alias("max_power_kw"))
    v = versions.where(F.col("status_id").isin(STATUS_OPERATIONAL, STATUS_TEMP_UNAVAILABLE))
    v = v.join(zones, on=list(station_zone), how="left_semi")
    if mode == "parity":
        attrs = [F.max(a).alias(a) for a in STATION_DIM_COLS]
    else:
        last = F.max_by(F.struct(*STATION_DIM_COLS), F.struct("date_last_status_update", "station_sk"))
        attrs = [last.alias("__last")]
    d = v.groupBy("station_id").agg(*attrs)
    if mode != "parity":
        d = d.select("station_id", *[F.col("__last").getField(a).alias(a) for a in STATION_DIM_COLS])
    return (d.join(power, on="station_id", how="inner")
            .withColumn("ingest_timestamp", ts_ntz(as_of))
            .select("station_id", *STATION_DIM_COLS, "max_power_kw", "ingest_timestamp"))


def weather_dim(versions: DataFrame, connectors: DataFrame, weather: DataFrame, as_of: str,
                *, station_zone: Sequence[str] = ("weather_zone_lat", "weather_zone_lon"),
                weather_zone: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Weather dimension: per ``weather_sk`` the max of each attribute, over the
    observations of zones that hold at least one qualifying station."""
    v = versions.where(F.col("status_id").isin(STATUS_OPERATIONAL, STATUS_TEMP_UNAVAILABLE))
    v = v.join(connectors.select("station_id"), on="station_id", how="left_semi")
    zones = v.select(*[F.col(s).alias(w) for s, w in zip(station_zone, weather_zone)]).distinct()
    w = weather.join(zones, on=list(weather_zone), how="left_semi")
    return (w.groupBy("weather_sk")
            .agg(*[F.max(a).alias(a) for a in WEATHER_DIM_COLS])
            .withColumn("ingest_timestamp", ts_ntz(as_of)))
