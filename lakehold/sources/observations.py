"""Nested weather observation documents -> flat typed rows, with a rejection split.

``rain.1h`` / ``snow.1h`` default to 0; every other field is required. An empty
``weather`` array is a missing field (``get`` is used, since ``arr[0]`` on an empty
array fails the whole job under ANSI mode).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.functions.columns import evaluate_once
from lakehold.sources.schemas import BRONZE_WEATHER, OBSERVATION


class NoUpdatesError(Exception):
    """No observation at all in a run."""


def _fields():
    o = F.col("__obs")
    w0 = F.get(o.getField("weather"), 0)
    return {
        "lat": o["coord"]["lat"], "lon": o["coord"]["lon"],
        "weather": w0["main"], "description": w0["description"],
        "temp": o["main"]["temp"], "pressure": o["main"]["pressure"],
        "humidity": o["main"]["humidity"], "visibility": o["visibility"],
        "rain": F.coalesce(o["rain"]["1h"], F.lit(0.0)),
        "snow": F.coalesce(o["snow"]["1h"], F.lit(0.0)),
        "wind_speed": o["wind"]["speed"], "clouds": o["clouds"]["all"], "dt": o["dt"],
    }


def flatten_observations(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """All rows, flattened, with ``missing_fields`` (array of required field names
    that are absent)."""
    parsed = F.from_json(F.col(json_col), OBSERVATION, {"mode": "PERMISSIVE"})
    d = evaluate_once(df, parsed, "__obs")  # one parse per row, whatever filters follow
    f = _fields()
    required = [c for c in f if c not in ("rain", "snow")]
    missing = F.filter(F.array(*[F.when(f[c].isNull(), F.lit(c)) for c in required]),
                       lambda x: x.isNotNull())
    cols = [f[fld.name].cast(fld.dataType).alias(fld.name) for fld in BRONZE_WEATHER.fields]
    return d.select(*keep, *cols, missing.alias("missing_fields"))


def split_observations(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted flat rows, rejected rows with their raw text and missing fields)."""
    flat = flatten_observations(df, json_col, [*keep, json_col])
    ok = F.size("missing_fields") == 0
    return (flat.where(ok).drop("missing_fields", json_col),
            flat.where(~ok).select(*keep, json_col, "missing_fields"))


def require_observations(df: DataFrame) -> DataFrame:
    """Raise ``NoUpdatesError`` when the frame is empty (one small job)."""
    if df.limit(1).count() == 0:
        raise NoUpdatesError("No observations found")
    return df
