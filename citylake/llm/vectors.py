"""Embeddings as whole numbers, for the operators that compute on them exactly."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import ship

ship(__name__)

WHOLE = "vec_id bigint, v array<double>, norm double"


def flat(column):
    """Components of a batch's vectors one after another, and the length of each vector (0 for null)."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype("i8")
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def padded(values, lengths, most: int | None = None):
    """The vectors as rows of one matrix, filled up with zeros on the right; with ``most``, so many components of each."""
    import numpy as np

    if most is not None and (lengths > most).any():
        place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        values, lengths = values[place < most], np.minimum(lengths, most)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def whole_numbers(vectors: DataFrame, scale: int, dims: int | None = None) -> DataFrame:
    """``vec_id``, ``v`` (floor(scale * x) of every component, as doubles that are whole) and the length ``norm``.

    Vectors that are null, or hold a null, NaN or infinite component, are left out, and with ``dims`` those of another
    number of components. Rows that repeat an id, or have none, stay.
    """

    def convert(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        most = np.finfo("f8").max
        for batch in batches:
            x, lengths = flat(batch.column("v"))
            row = np.repeat(np.arange(batch.num_rows), lengths)
            good = batch.column("v").is_valid().to_numpy(zero_copy_only=False)
            good &= np.bincount(row[~np.isfinite(x)], minlength=batch.num_rows) == 0
            if dims is not None:
                good &= lengths == dims
            kept = good[row]
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(x[kept] * float(scale)), -most, most)
                norm = np.sqrt(np.bincount(row[kept], weights=whole * whole, minlength=batch.num_rows)[good])
            ends = np.concatenate([[0], np.cumsum(lengths[good])]).astype("i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").filter(pa.array(good)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(whole)),
                    pa.array(norm),
                ],
                ["vec_id", "v", "norm"],
            )

    typed = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("v"))
    return typed.mapInArrow(convert, WHOLE)
