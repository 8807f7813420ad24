"""Neighbour values (lag / lead) per key that survive a hot key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. With
``split`` (an expression of the row's own values that is monotone in the row order,
e.g. a time bucket), rows are windowed per ``(key, split)`` instead; the first/last row of every split gets its
neighbour from a per-split summary (one row per split), which is windowed per key.
The edge rows come from the windowed rows themselves (first/last flags of the same
window), so the input is evaluated once; the edge set is small (#keys x #splits) and
the big side keeps its (key, split) partitioning for the join back, so only the edge
set is shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def with_neighbor(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  values: Sequence[str], direction: str = "prev",
                  prefix: str | None = None, split: Column | None = None) -> DataFrame:
    """Add ``{prefix}{v}`` = value of the previous (``prev``) or next (``next``) row of
    the same key in ascending ``order`` (which must be unique within a key)."""
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    prefix = prefix if prefix is not None else f"{direction}_"
    shift = F.lag if direction == "prev" else F.lead
    keys = list(keys)
    order_c = _cols(order)
    if split is None:
        w = Window.partitionBy(*keys).orderBy(*order_c)
        return df.withColumns({f"{prefix}{v}": shift(F.col(v)).over(w) for v in values})

    b = "__split"
    # Explicit exchange on (keys, split): an input already partitioned by the keys alone
    # would otherwise satisfy the window's distribution and keep a hot key in one task.
    d = df.withColumn(b, split).repartition(*[F.col(k) for k in keys], F.col(b))
    w_in = Window.partitionBy(*keys, b).orderBy(*order_c)
    d = d.withColumns({
        **{f"__in_{v}": shift(F.col(v)).over(w_in) for v in values},
        "__first": F.lag(F.lit(1)).over(w_in).isNull(),
        "__last": F.lead(F.lit(1)).over(w_in).isNull(),
    })
    # the row that a neighbouring split needs: its last row (prev) or first row (next);
    # taken from the windowed rows themselves, so the input is evaluated once
    source = "__last" if direction == "prev" else "__first"
    edge = "__first" if direction == "prev" else "__last"
    summary = d.where(F.col(source)).select(*keys, b, F.struct(*[F.col(v) for v in values]).alias("__edge"))
    w_s = Window.partitionBy(*keys).orderBy(F.col(b))
    jk = [*keys, b]
    summary = summary.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(jk)],
                             shift(F.col("__edge")).over(w_s).alias("__nb")).where(F.col("__nb").isNotNull())
    # null-safe equality: null keys are a group too, and no not-null filter is inferred
    # into the summary branch, so both branches share (reuse) the exchange above
    cond = [F.col(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(jk)]
    out = d.join(summary, on=cond, how="left").drop(*[f"__s{i}" for i in range(len(jk))])
    out = out.withColumns({
        f"{prefix}{v}": F.when(F.col(edge), F.col("__nb").getField(v)).otherwise(F.col(f"__in_{v}"))
        for v in values
    })
    return out.drop(b, "__first", "__last", "__nb", *[f"__in_{v}" for v in values])


def with_neighbor_ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                         direction: str = "prev", prefix: str | None = None) -> DataFrame:
    """As ``with_neighbor``, for keys that are hot within any bucket of their own values.

    Rows are dealt by range over (keys, order), sorted and stored with their place in the
    file. The file, not a value, is the boundary: a key is spread over as many ranges as it
    has rows for, a range ends where it ends for every later reader and every retry, and
    only keys that cross into another range need an edge row from it (at most one a range).
    """
    from lakehold.session import shared_dir

    spark, cols = df.sparkSession, [*keys, *order]
    placed = df.repartitionByRange(*_cols(cols)).sortWithinPartitions(*_cols(cols)).withColumn("__at", F.monotonically_increasing_id())
    path = shared_dir(spark, "ranges")
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    return with_neighbor(stored, keys, ["__at"], values, direction, prefix, F.shiftright("__at", 33)).drop("__at")
