"""Role mapping of the driver's TPC-H-style tables onto the pipeline's tables.

* station versions  <- orders (one version per order) joined with customer
* connectors        <- lineitem joined with orders (a station's order lines)
* weather           <- events (zone = user_id mod 25)

Every mapping is a plain projection/join of the given tables, so the work of every
query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.functions.columns import open_end
from lakehold.operators.windows import with_neighbor

# Fixed values of the role mapping.
AS_OF = "2024-02-01 00:00:00"
EVENT_CUTOFF = "2024-01-16 00:00:00"
N_ZONES = 25
STATUS_BY_ORDERSTATUS = {"F": 50, "O": 30, "P": 20}
STATUS_TITLE = {"F": "Operational", "O": "Temporarily Unavailable", "P": "Planned"}
WEATHER_BY_EVENT = {"click": "Clear", "view": "light snow", "purchase": "Rain",
                    "error": "Thunderstorm", "signup": "Snow"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: str, mapping: dict, other=None):
    e = None
    for k, v in mapping.items():
        e = (F.when(F.col(col) == k, F.lit(v)) if e is None
             else e.when(F.col(col) == k, F.lit(v)))
    return e.otherwise(F.lit(other))


def station_versions(spark: SparkSession, sf_dir: str, split=None) -> DataFrame:
    """Silver-like station history: one version per order of a customer."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("date_created"))
    v = (
        o.join(c, o.o_custkey == c.c_custkey, "inner")
        .join(first, on="o_custkey", how="inner")
        .select(
            F.col("o_custkey").alias("station_id"),
            F.col("o_orderkey").alias("station_sk"),
            F.col("c_name").alias("title"),
            F.col("o_orderpriority").alias("address"),
            F.col("c_mktsegment").alias("town"),
            F.when(F.col("c_nationkey") % 2 == 0, "NY").otherwise("NJ").alias("state_or_province"),
            (F.col("c_acctbal") / F.lit(100.0)).alias("latitude"),
            (F.col("c_nationkey").cast("double") / F.lit(10.0) - F.lit(74.0)).alias("longitude"),
            F.col("c_nationkey").alias("weather_zone"),
            _case("o_orderstatus", STATUS_TITLE).alias("status"),
            _case("o_orderstatus", STATUS_BY_ORDERSTATUS).cast("int").alias("status_id"),
            F.col("o_orderdate").alias("date_last_status_update"),
            "date_created",
            F.col("o_orderdate").alias("valid_from"),
        )
    )
    v = with_neighbor(v, ["station_id"], ["valid_from", "station_sk"], ["valid_from"],
                      "next", "next_", split)
    return v.withColumn("valid_to", F.coalesce(F.col("next_valid_from"), open_end())).drop("next_valid_from")


def connectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connector rows: the order lines of a station's orders."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").alias("station_id"),
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") > 45, 3).when(F.col("l_quantity") > 20, 2).otherwise(1).alias("level_id"),
        F.col("l_quantity").alias("power_kw"),
        (F.lit(1) + F.col("l_linenumber") % 2).alias("quantity"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather observations: one per event, zone = user_id mod 25."""
    e = table(spark, sf_dir, "events")
    zone = F.pmod(F.col("user_id"), F.lit(N_ZONES)).cast("int")
    return e.select(
        F.col("event_id").alias("weather_sk"),
        zone.alias("zone"),
        zone.alias("weather_zone_id"),
        F.col("ts").alias("dt_utc"),
        _case("event_type", WEATHER_BY_EVENT, None).alias("weather_m"),
        F.col("event_type").alias("description"),
        F.col("value").alias("temp"),
        (F.lit(1000) + F.pmod(F.col("user_id"), F.lit(50))).cast("int").alias("pressure"),
        F.pmod(F.col("event_id"), F.lit(101)).cast("int").alias("humidity"),
        F.lit(10000).alias("visibility"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("rain"),
        F.when(F.col("event_type") == "signup", F.col("value")).otherwise(F.lit(0.0)).alias("snow"),
    ).withColumn("weather", F.coalesce(F.col("weather_m"), F.col("description"))).drop("weather_m")


def mart_inputs(spark: SparkSession, sf_dir: str, split=None):
    return station_versions(spark, sf_dir, split), connectors(spark, sf_dir), weather(spark, sf_dir)


MART_KW = dict(station_zone=("weather_zone",), weather_zone=("zone",))
FACT_KW = dict(MART_KW, connector_order=("l_orderkey", "l_linenumber"))
