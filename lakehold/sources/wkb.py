"""Well-known binary geometries to vertex rings and back, in Arrow batches.

Read are polygons, multi-polygons and collections of them, in either byte order, with or
without Z, M and SRID (both ways of marking them). All rings of a geometry come out as one
list, outer rings and holes alike: a point is inside where it crosses an odd number of
edges. Null, malformed and cut-off values, and geometries without an area, give a null list.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RINGS = "array<array<struct<x:double,y:double>>>"
# Geometry types of the format.
POLYGON, MULTI_POLYGON, COLLECTION = 3, 6, 7
FLAG_Z, FLAG_M, FLAG_SRID = 0x80000000, 0x40000000, 0x20000000
MAX_NESTING = 16


def decode(value: bytes | None) -> list[np.ndarray] | None:
    """Rings as arrays of (x, y); None where there are none to be read."""
    if value is None:
        return None
    rings: list[np.ndarray] = []
    try:
        _geometry(memoryview(value), 0, rings, MAX_NESTING)
    except (struct.error, ValueError):
        return None
    return rings or None


def _geometry(v: memoryview, at: int, rings: list[np.ndarray], nesting: int) -> int:
    if not nesting or v[at:at + 1].tobytes() not in (b"\x00", b"\x01"):
        raise ValueError("not a geometry")
    end = "<" if v[at] else ">"
    kind, = struct.unpack_from(f"{end}I", v, at + 1)
    at += 5
    dims = 2 + bool(kind & FLAG_Z) + bool(kind & FLAG_M)
    at += 4 * bool(kind & FLAG_SRID)
    kind &= 0x1FFFFFFF
    dims += {0: 0, 1: 1, 2: 1, 3: 2}.get(kind // 1000, 0)
    kind %= 1000
    if kind not in (POLYGON, MULTI_POLYGON, COLLECTION):
        raise ValueError("no area")
    n, = struct.unpack_from(f"{end}I", v, at)
    at += 4
    for _ in range(n):
        if kind != POLYGON:
            at = _geometry(v, at, rings, nesting - 1)
            continue
        points, = struct.unpack_from(f"{end}I", v, at)
        at += 4
        size = 8 * dims * points
        if at + size > len(v):
            raise ValueError("cut off")
        rings.append(np.frombuffer(v[at:at + size], f"{end}f8").reshape(points, dims)[:, :2].astype("f8"))
        at += size
    return at


def encode(rings: list[list[tuple[float, float]]] | None) -> bytes | None:
    """One polygon of all rings, closed, in little-endian order."""
    if not rings:
        return None
    out = [struct.pack("<BII", 1, POLYGON, len(rings))]
    for ring in rings:
        closed = ring if ring and ring[0] == ring[-1] else [*ring, *ring[:1]]
        out.append(struct.pack(f"<I{2 * len(closed)}d", len(closed), *(c for p in closed for c in p)))
    return b"".join(out)


def _lists(counts: list[int | None], values: pa.Array) -> pa.ListArray:
    offsets = np.cumsum([0, *(c or 0 for c in counts)]).astype(np.int32)
    mask = pa.array([c is None for c in counts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def read_rings(df: DataFrame, geometry: str = "geometry", out: str = "rings") -> DataFrame:
    """``df`` with the rings of a binary column in its place."""
    keep = [c for c in df.columns if c != geometry]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [decode(g.as_py()) for g in b.column(len(keep))]
            flat = [r for g in got for r in g or ()]
            xy = np.concatenate([np.empty((0, 2)), *flat])
            points = pa.StructArray.from_arrays([pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy())], names=["x", "y"])
            rings = _lists([len(r) for r in flat], points)
            yield pa.record_batch([*b.columns[:-1], _lists([None if g is None else len(g) for g in got], rings)], names=[*keep, out])

    return df.select(*keep, geometry).mapInArrow(run, ", ".join(filter(None, [schema, f"`{out}` {RINGS}"])))


def write_rings(df: DataFrame, rings: str = "rings", out: str = "geometry") -> DataFrame:
    """``df`` with a binary polygon column in the place of its rings."""
    keep = [c for c in df.columns if c != rings]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [encode(None if g is None else [[(p["x"], p["y"]) for p in r] for r in g if r]) for g in b.column(len(keep)).to_pylist()]
            yield pa.record_batch([*b.columns[:-1], pa.array(made, pa.binary())], names=[*keep, out])

    return df.select(*keep, rings).mapInArrow(run, ", ".join(filter(None, [schema, f"`{out}` binary"])))
