"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakehold.session import OPEN_END

NULL_MARKER = "\u0000null"


def ts_ntz(value: str) -> Column:
    """A timestamp literal without time zone (the test tables are ``timestamp_ntz``)."""
    return F.lit(value).cast("timestamp_ntz")


def open_end() -> Column:
    return ts_ntz(OPEN_END)


def minus_minutes(c: Column | str, minutes: int) -> Column:
    """Watermark buffer: ``ts - INTERVAL n MINUTES``."""
    c = F.col(c) if isinstance(c, str) else c
    return c - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end`` (truncating, like ``timestampdiff``)."""
    return F.timestamp_diff("MINUTE", start, end)


def surrogate_key(*cols: Column | str, null_safe: bool = True) -> Column:
    """64-bit surrogate key.

    ``xxhash64`` skips null inputs, so ``(NULL, 'x')`` and ``('x')`` collide; with
    ``null_safe`` every input is rendered to a string with a null marker first.
    """
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    if null_safe:
        cs = [F.coalesce(c.cast("string"), F.lit(NULL_MARKER)) for c in cs]
    return F.xxhash64(*cs)


def map_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace values found in ``mapping``; others (and null) stay unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, c), c)


def grid_round(c: Column | str, decimals: int = 1) -> Column:
    """Grid-cell coordinate: HALF_UP rounding (40.75 -> 40.8, -74.25 -> -74.3)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, decimals)


def grid_cell_id(c: Column | str, decimals: int = 1) -> Column:
    """Integer cell index of a coordinate, for equi-joins that must not rest on doubles."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(float(10 ** decimals)), 0).cast("long")


def string_schema(paths: Sequence[str]) -> StructType:
    """All-string struct schema covering dotted JSON paths (``A.B`` -> struct A{B})."""
    tree: dict = {}
    for p in paths:
        node = tree
        parts = p.split(".")
        for part in parts[:-1]:
            node = node.setdefault(part, {})
        node.setdefault(parts[-1], None)

    def build(node: dict) -> StructType:
        return StructType([
            StructField(k, StringType() if v is None else build(v), True)
            for k, v in node.items()
        ])

    return build(tree)


def parse_strings(json_col: Column | str, paths: Sequence[str]) -> Column:
    """One ``from_json`` of the document into an all-string struct covering ``paths``."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    return F.from_json(c, string_schema(list(paths)), {"mode": "PERMISSIVE"})


def evaluate_once(df, expr: Column, alias: str):
    """Add ``expr`` as column ``alias`` behind a one-row generator.

    A filter on columns derived from an expensive expression (a JSON parse) is
    otherwise pushed below the projection, and Catalyst copies the expression into
    every reference of the filter; a generator output cannot be pushed through.
    """
    return df.select("*", F.inline(F.array(F.struct(expr.alias(alias)))))


def get_path(struct_col: Column, path: str) -> Column:
    e = struct_col
    for part in path.split("."):
        e = e.getField(part)
    return e
