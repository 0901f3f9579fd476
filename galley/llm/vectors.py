"""Vectors as rows of doubles in binary columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import schema_of


def usable(column: pa.Array) -> list[np.ndarray | None]:
    """The vectors of a list column; None for null, empty, zero, and those with nulls or non-finite parts."""
    flat = column.values
    numbers = flat.cast(pa.float64())
    holes = pc.is_null(numbers).to_numpy(zero_copy_only=False)
    values = pc.fill_null(numbers, 0.0).to_numpy(zero_copy_only=False)
    bad = holes | ~np.isfinite(values)
    offsets, there = column.offsets.to_numpy(), column.is_valid().to_pylist()
    out: list[np.ndarray | None] = []
    for ok, a, b in zip(there, offsets[:-1], offsets[1:], strict=True):
        good = ok and b > a and not bad[a:b].any() and values[a:b].any()
        out.append(values[a:b] if good else None)
    return out


def _prepared(as_bytes: Callable[[np.ndarray], bytes]):
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = usable(batch.column("__llm_vector"))
            kept = [n for n in batch.schema.names if n != "__llm_vector"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in kept),
                    pa.array([None if v is None else len(v) for v in vectors], pa.int32()),
                    pa.array([None if v is None else as_bytes(v) for v in vectors], pa.binary()),
                ],
                names=[*kept, "dims", "vector"],
            )

    return prepare


def prepared(rows: DataFrame, keep: list[str], vector: str, as_bytes: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> DataFrame:
    """``keep`` with dims and vector (doubles as bytes), both null where a vector takes no part."""
    source = rows.select(*keep, F.col(f"`{vector}`").alias("__llm_vector"))
    return source.mapInArrow(_prepared(as_bytes), f"{schema_of(source, keep)}, dims int, vector binary")


def packed(vector: np.ndarray) -> bytes:
    """A vector of doubles, in half the bytes if its numbers are floats. Equal vectors stay equal."""
    with np.errstate(over="ignore"):
        short = vector.astype(np.float32)
    return (short if (short == vector).all() else vector).tobytes()


def unpacked(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of doubles of a column of `packed` vectors."""
    parts = column.to_pylist()
    out = np.empty((len(parts), dims))
    short = np.array([len(p) == 4 * dims for p in parts], bool)
    for chosen, kind in ((short, np.float32), (~short, np.float64)):
        at = np.flatnonzero(chosen)
        out[at] = np.frombuffer(b"".join([parts[k] for k in at]), kind).reshape(-1, dims)
    return out


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims)
