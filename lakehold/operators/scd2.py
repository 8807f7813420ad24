"""Type-2 history: classify staged changes, build new versions, expire old ones,
apply a batch as one new table state, and build history from a change log.

Target table columns: keys, attributes, ``valid_from``, ``valid_to``,
``is_current``, ``sk``. Intervals are half-open: an expired version ends where its
successor starts; the current version ends at ``2999-12-31``.

Guards (decided, unlike the naive MERGE): several staged rows of one key are reduced
to the latest; a staged row that is not newer than the current version (late or
replayed) changes nothing; change detection is null-safe unless ``null_safe=False``.
A staged row without a time can start no version: it is left out here, and belongs in
the quarantine (``untimed`` returns these rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.functions.columns import open_end, surrogate_key
from lakehold.operators.transform import latest_per_key
from lakehold.operators.windows import with_neighbor

INSERT, UPDATE = "INSERT", "UPDATE"


def _columns(*parts: Sequence[str]) -> list[str]:
    """All names once, in order: the time or an ordering column may be an attribute too."""
    return list(dict.fromkeys(c for p in parts for c in p))


def timed(staged: DataFrame, ts: str) -> DataFrame:
    return staged.where(F.col(ts).isNotNull())


def untimed(staged: DataFrame, ts: str) -> DataFrame:
    """Staged rows that no version can be made of, because they have no time."""
    return staged.where(F.col(ts).isNull())


def _changed(tracked: Sequence[str], null_safe: bool, left: str = "stg", right: str = "cur") -> Column:
    conds = []
    for a in tracked:
        l, r = F.col(f"{left}.{a}"), F.col(f"{right}.{a}")
        conds.append(~l.eqNullSafe(r) if null_safe else (l != r))
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return F.coalesce(out, F.lit(False))


def _key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, left_alias: str) -> DataFrame:
    """Join on the keys with null-safe equality (a null key is one group, as in the
    per-key reduction), exposing each key once as a plain column."""
    la, ra = left_alias, ("cur" if left_alias == "stg" else "stg")
    cond = None
    for k in keys:
        c = F.col(f"{la}.{k}").eqNullSafe(F.col(f"{ra}.{k}"))
        cond = c if cond is None else cond & c
    j = left.join(right, on=cond, how=how)
    merged = {k: F.coalesce(F.col(f"{la}.{k}"), F.col(f"{ra}.{k}")) for k in keys}
    rest = [F.col(f"{a}.{c}").alias(f"__{a}__{c}") for a, df in ((la, left), (ra, right))
            for c in df.columns if c not in keys]
    out = j.select(*[e.alias(k) for k, e in merged.items()], *rest)
    # re-expose the sides under their aliases for the callers' ``stg.x`` / ``cur.x``
    side = lambda a, df: F.struct(*[F.col(f"__{a}__{c}").alias(c) for c in df.columns if c not in keys])
    return out.select(*keys, side(la, left).alias(la), side(ra, right).alias(ra))


def current_rows(target: DataFrame) -> DataFrame:
    return target.where(F.col("is_current"))


def classify(staged: DataFrame, target: DataFrame, keys: Sequence[str], tracked: Sequence[str],
             ts: str = "ts", order: Sequence[str] = (), null_safe: bool = True) -> DataFrame:
    """Latest staged row per key joined with the current version, plus ``scd_action``:
    INSERT (no current row), UPDATE (newer and a tracked attribute differs), NULL."""
    s = latest_per_key(timed(staged, ts), keys, [ts, *order]).alias("stg")
    cur = current_rows(target).alias("cur")
    j = _key_join(s, cur, keys, "left", "stg")
    action = (
        F.when(F.col("cur.valid_from").isNull(), F.lit(INSERT))
        .when((F.col(f"stg.{ts}") > F.col("cur.valid_from")) & _changed(tracked, null_safe), F.lit(UPDATE))
    )
    return j.withColumn("scd_action", action)


def new_versions(classified: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                 tracked: Sequence[str], ts: str = "ts") -> DataFrame:
    """Versions to insert for INSERT/UPDATE actions."""
    return classified.where(F.col("scd_action").isin(INSERT, UPDATE)).select(
        *[F.col(k) for k in keys],
        *[F.col(f"stg.{a}").alias(a) for a in attrs],
        F.col(f"stg.{ts}").alias("valid_from"),
        open_end().alias("valid_to"),
        F.lit(True).alias("is_current"),
        surrogate_key(*[F.col(k) for k in keys], F.col(f"stg.{ts}"),
                      *[F.col(f"stg.{a}") for a in tracked]).alias("sk"),
    )


def rows_to_expire(classified: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Current versions closed by an UPDATE: their sk and the successor's start."""
    return classified.where(F.col("scd_action") == UPDATE).select(
        *[F.col(k) for k in keys],
        F.col("cur.sk").alias("sk"),
        F.col("cur.valid_from").alias("valid_from"),
        F.col(f"stg.{ts}").alias("valid_to"),
    )


def apply_changes(target: DataFrame, staged: DataFrame, keys: Sequence[str],
                  attrs: Sequence[str], tracked: Sequence[str] | None = None,
                  ts: str = "ts", order: Sequence[str] = (), null_safe: bool = True) -> DataFrame:
    """The new target state after one staged batch, as ONE DataFrame:
    closed history (untouched, no shuffle) + current versions (kept or expired) + new
    versions. Publishing it once replaces the two MERGE transactions."""
    tracked = list(tracked or attrs)
    keys = list(keys)
    s = latest_per_key(timed(staged, ts).select(*_columns(keys, attrs, [ts], order)), keys, [ts, *order]).alias("stg")
    cur = current_rows(target).alias("cur")
    j = _key_join(cur, s, keys, "full_outer", "cur")
    has_cur = F.col("cur.valid_from").isNotNull()
    has_stg = F.col(f"stg.{ts}").isNotNull()
    is_update = has_cur & has_stg & (F.col(f"stg.{ts}") > F.col("cur.valid_from")) & _changed(tracked, null_safe)
    is_insert = ~has_cur & has_stg

    def row(src: str, valid_from, valid_to, current, sk):
        return F.struct(*[F.col(f"{src}.{a}").alias(a) for a in attrs],
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"),
                        current.alias("is_current"), sk.alias("sk"))

    new_sk = surrogate_key(*[F.col(k) for k in keys], F.col(f"stg.{ts}"),
                           *[F.col(f"stg.{a}") for a in tracked])
    kept = row("cur", F.col("cur.valid_from"), F.col("cur.valid_to"), F.col("cur.is_current"), F.col("cur.sk"))
    closed = row("cur", F.col("cur.valid_from"), F.col(f"stg.{ts}"), F.lit(False), F.col("cur.sk"))
    fresh = row("stg", F.col(f"stg.{ts}"), open_end(), F.lit(True), new_sk)
    out_rows = (F.when(is_update, F.array(closed, fresh))
                .when(is_insert, F.array(fresh))
                .when(has_cur, F.array(kept)))  # neither side: no row
    changed = j.select(*keys, F.inline(out_rows))
    cols = [*keys, *attrs, "valid_from", "valid_to", "is_current", "sk"]
    history = target.where(~F.col("is_current")).select(*cols)
    return history.unionByName(changed.select(*cols))


def history(log: DataFrame, keys: Sequence[str], attrs: Sequence[str],
            tracked: Sequence[str] | None = None, ts: str = "ts", order: Sequence[str] = (),
            split: Column | None = None) -> DataFrame:
    """Versions from a change log: drop rows equal to their predecessor (tracked
    attributes, null-safe), then each version ends where the next begins."""
    tracked = list(tracked or attrs)
    keys = list(keys)
    o = [ts, *order]
    d = timed(log, ts).select(*_columns(keys, attrs, o)).withColumn("__exists", F.lit(True))
    d = with_neighbor(d, keys, o, [*tracked, "__exists"], "prev", "__p_", split)
    same = F.lit(True)
    for a in tracked:
        same = same & F.col(a).eqNullSafe(F.col(f"__p_{a}"))
    d = d.where(F.col("__p___exists").isNull() | ~same)
    d = d.select(*_columns(keys, attrs, o))
    d = with_neighbor(d, keys, o, [ts], "next", "__n_", split)
    return d.select(
        *keys, *attrs,
        F.col(ts).alias("valid_from"),
        F.coalesce(F.col(f"__n_{ts}"), open_end()).alias("valid_to"),
        F.col(f"__n_{ts}").isNull().alias("is_current"),
        surrogate_key(*[F.col(k) for k in keys], F.col(ts), *[F.col(a) for a in tracked]).alias("sk"),
    )


def apply_all_versions(target: DataFrame, staged: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                       tracked: Sequence[str] | None = None, ts: str = "ts", order: Sequence[str] = (),
                       split: Column | None = None) -> DataFrame:
    """History-keeping apply: every staged version newer than the key's current start
    becomes a version (repeats of the previous version are dropped), instead of only
    the latest. Closed history passes through; only current rows and the batch are
    windowed, per key (and per ``split`` bucket for hot keys)."""
    tracked = list(tracked or attrs)
    keys = list(keys)
    cur = current_rows(target).alias("cur")
    s = timed(staged, ts).select(*_columns(keys, attrs, [ts], order)).alias("stg")
    j = _key_join(s, cur.select(*keys, "valid_from"), keys, "left", "stg")
    newer = j.where(F.col("cur.valid_from").isNull() | (F.col(f"stg.{ts}") > F.col("cur.valid_from")))
    rest = _columns(attrs, [ts], order)
    newer = newer.select(*keys, *[F.col(f"stg.{c}").alias(c) for c in rest])
    seed = cur.select(*keys, *[F.col("valid_from").alias(c) if c == ts else F.col(c) if c in attrs
                               else F.lit(None).cast(staged.schema[c].dataType).alias(c) for c in rest])
    versions = history(seed.unionByName(newer), keys, attrs, tracked, ts=ts, order=order, split=split)
    cols = [*keys, *attrs, "valid_from", "valid_to", "is_current", "sk"]
    return target.where(~F.col("is_current")).select(*cols).unionByName(versions.select(*cols))
