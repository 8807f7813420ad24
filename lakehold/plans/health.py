"""Table health report: existence, emptiness, nulls in critical columns, freshness,
range rules and key uniqueness - ONE aggregate per table, long-form result.

Result columns: ``table_name, check_name, status, observed`` with status in
pass / fail / warning / skipped (later checks are skipped for a missing or empty
table, as the reference stops early).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.functions.columns import ts_ntz
from lakehold.operators.keyed_table import KeyedTable

FRESHNESS_HOURS = 48  # fixed value: freshness SLA of the marts


@dataclass
class TableRules:
    critical: list[str] = field(default_factory=list)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    unique_key: str | None = None
    ts_column: str = "ingest_timestamp"
    max_age_hours: float = FRESHNESS_HOURS


# The reference's rules for the three marts.
MART_RULES = {
    "station_facts": TableRules(critical=["is_operational", "risk_score", "avg_energy_cost_per_hour"],
                                ranges={"risk_score": (0, 100), "availability": (0, 1)}),
    "station_dim": TableRules(critical=["station_id", "latitude", "longitude"], unique_key="station_id"),
    "weather_dim": TableRules(critical=["weather_sk", "weather", "temp"], ranges={"temp": (-50, 150)}),
}

RESULT_SCHEMA = "table_name string, check_name string, status string, observed double"


def _measures(rules: TableRules, cols: set[str]) -> tuple[list[str], dict[str, tuple[float, float]], bool]:
    """The rules' critical columns and ranges that the table has, and whether it has the time column."""
    return [c for c in rules.critical if c in cols], {c: b for c, b in rules.ranges.items() if c in cols}, rules.ts_column in cols


def _table_report(name: str, df: DataFrame, rules: TableRules, as_of: str) -> DataFrame:
    cols = set(df.columns)
    crit, rng, has_ts = _measures(rules, cols)
    aggs = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in crit],
            *[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"range__{c}") for c, (lo, hi) in rng.items()]]
    if has_ts:
        aggs.append(F.max(rules.ts_column).cast("timestamp_ntz").alias("max_ts"))
    if rules.unique_key and rules.unique_key in cols:
        aggs.append((F.count(F.lit(1)) - F.count_distinct(rules.unique_key)).alias("dups"))
    return _entries(name, df.agg(*aggs), rules, cols, as_of)


def _entries(name: str, a: DataFrame, rules: TableRules, cols: set[str], as_of: str) -> DataFrame:
    """The report's rows from one row of counts."""
    crit, rng, has_ts = _measures(rules, cols)

    def entry(check: str, status, observed) -> F.Column:
        return F.struct(F.lit(check).alias("check_name"), status.alias("status"),
                        observed.cast("double").alias("observed"))

    empty = F.col("n") == 0
    gated = lambda s: F.when(empty, F.lit("skipped")).otherwise(s)
    rows = [entry("table_exists", F.lit("pass"), F.lit(None)),
            entry("not_empty", F.when(empty, "fail").otherwise("pass"), F.col("n"))]
    for c in crit:
        rows.append(entry(f"nulls:{c}", gated(F.when(F.col(f"null__{c}") > 0, "fail").otherwise("pass")),
                          F.col(f"null__{c}")))
        share = F.col(f"null__{c}") * 100.0 / F.when(~empty, F.col("n"))
        rows.append(entry(f"null_percent:{c}", gated(F.lit("info")), F.round(share, 2)))
    if has_ts:
        a = a.withColumn("age_h", F.timestamp_diff("SECOND", F.col("max_ts"), ts_ntz(as_of)) / F.lit(3600.0))
        age = F.col("age_h")
        st = F.when(age.isNull(), "fail").when(age > rules.max_age_hours, "warning").otherwise("pass")
        rows.append(entry("freshness", gated(st), F.round(age, 2)))
    else:
        rows.append(entry("freshness", gated(F.lit("warning")), F.lit(None)))
    for c in rng:
        rows.append(entry(f"range:{c}", gated(F.when(F.col(f"range__{c}") > 0, "warning").otherwise("pass")),
                          F.col(f"range__{c}")))
    if rules.unique_key and rules.unique_key in cols:
        rows.append(entry(f"unique:{rules.unique_key}",
                          gated(F.when(F.col("dups") > 0, "fail").otherwise("pass")), F.col("dups")))
    return a.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))).select(
        "table_name", "check_name", "status", "observed")


STATE_SCHEMA = "n long, max_ts timestamp_ntz, nulls map<string,long>, ranges map<string,long>, columns array<string>, run long"


@dataclass(frozen=True)
class HealthLog:
    """Health of tables that grow by runs, from each run's rows alone.

    A run adds one row of mergeable state per table (counts and the greatest time) under
    ``root/state/<table>/run=<id>``, and its keys to a table of one row per key, whose
    commits count the distinct keys exactly. A report merges one row per run; it reads no
    rows of the tables. A run that is repeated overwrites its state.
    """

    root: str
    rules: dict[str, TableRules]

    def _keys(self, name: str) -> KeyedTable:
        return KeyedTable(f"{self.root}/keys/{name}", ("key",), "at")

    def add(self, name: str, rows: DataFrame, run: int) -> None:
        """Add the rows of a run (numbered 0, 1, ... in their order)."""
        rules, cols = self.rules.get(name, TableRules()), set(rows.columns)
        crit, rng, has_ts = _measures(rules, cols)
        pairs = lambda d: F.create_map(*[x for c, n in d.items() for x in (F.lit(c), n)]) if d else F.lit(None).cast("map<string,long>")
        state = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in crit],
                         *[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"range__{c}") for c, (lo, hi) in rng.items()],
                         (F.max(rules.ts_column) if has_ts else F.lit(None)).cast("timestamp_ntz").alias("max_ts"))
        state = state.select("n", "max_ts", pairs({c: F.col(f"null__{c}") for c in crit}).alias("nulls"),
                             pairs({c: F.col(f"range__{c}") for c in rng}).alias("ranges"), F.array(*[F.lit(c) for c in sorted(cols)]).alias("columns"))
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state/{name}/run={run}")
        if rules.unique_key in cols:
            keys = rows.select(F.col(rules.unique_key).alias("key"), F.lit(0).alias("at")).where(F.col("key").isNotNull())
            table = self._keys(name)
            table.create(rows.sparkSession, keys.schema)
            table.apply(keys, run)

    def report(self, spark: SparkSession, names: list[str], as_of: str) -> DataFrame:
        """As ``health_report`` over all rows added; a table without any run does not exist."""
        out = None
        for name in names:
            rules = self.rules.get(name, TableRules())
            try:
                s = spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/state/{name}")
                cols = set(s.orderBy(F.col("run").desc()).first()["columns"])
            except AnalysisException:
                part = spark.createDataFrame([(name, "table_exists", "fail", None)], RESULT_SCHEMA)
            else:
                crit, rng, _ = _measures(rules, cols)
                aggs = [F.sum("n").alias("n"), F.max("max_ts").alias("max_ts"), *[F.sum(F.col("nulls")[c]).alias(f"null__{c}") for c in crit],
                        *[F.sum(F.col("ranges")[c]).alias(f"range__{c}") for c in rng]]
                if rules.unique_key in cols:
                    distinct = sum(self._keys(name).directory(spark).rows.values())
                    aggs.append((F.sum("n") - F.lit(distinct)).alias("dups"))
                part = _entries(name, s.agg(*aggs), rules, cols, as_of)
            out = part if out is None else out.unionByName(part)
        return out


def health_report(spark: SparkSession, tables: dict[str, DataFrame | None],
                  rules: dict[str, TableRules], as_of: str) -> DataFrame:
    """``tables`` maps a name to its DataFrame, or to None when it does not exist."""
    out = None
    for name, df in tables.items():
        if df is None:
            part = spark.createDataFrame([(name, "table_exists", "fail", None)], RESULT_SCHEMA)
        else:
            part = _table_report(name, df, rules.get(name, TableRules()), as_of)
        out = part if out is None else out.unionByName(part)
    return out


def health_summary(report: DataFrame) -> DataFrame:
    """passed / failed / warnings counts and the verdict (healthy = no fail)."""
    return report.agg(
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "fail").alias("failed"),
        F.count_if(F.col("status") == "warning").alias("warnings"),
    ).withColumn("healthy", F.col("failed") == 0)


def tables_from_catalog(spark: SparkSession, names: list[str]) -> dict[str, DataFrame | None]:
    return {n: (spark.table(n) if spark.catalog.tableExists(n) else None) for n in names}
