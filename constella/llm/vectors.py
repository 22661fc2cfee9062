"""Integer vectors for the vector operators: components scaled and floored, blocks packed as bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256
#: Integer components are held within this, so that squared distances and products of up to 1,024
#: components fit 64 bits; a component of 262,144 or more (before scaling) counts as this.
LARGEST = 1 << 26


def finite(vector: Column) -> Column:
    """Neither the vector nor a component is null, infinite or no number."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def integers(vector: Column) -> Column:
    """``floor(256 * x)`` of each component."""
    return F.transform(vector, lambda x: F.greatest(F.least(
        F.floor(x.cast("double") * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("long"))


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows are filled with zeros."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == width * len(lists):
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        if (sizes == width).all():
            return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    for i, row in enumerate(lists.to_pylist()):
        out[i, :len(row)] = row
    return out


def packed(values: np.ndarray) -> tuple[str, bytes]:
    """The narrowest integer type that holds all values, and their bytes."""
    most = max(int(values.max(initial=0)), -int(values.min(initial=0)) - 1)
    kind = next(k for k in ("i1", "i2", "i4", "i8") if most < 1 << (8 * int(k[1]) - 1))
    return kind, np.ascontiguousarray(values, kind).tobytes()


def unpacked(kind: str, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width).astype(np.int64)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of integers, exactly: in doubles where no sum can leave their 53 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T
