"""Applying a caller's model to a table, in batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def batch_infer(
    df: DataFrame,
    loader: Callable[[], Callable],
    *,
    inputs: Sequence[str],
    output: str,
    return_type: T.DataType,
    batch_size: int = 32,
    tensor_shapes: Sequence[Sequence[int] | None] | None = None,
) -> DataFrame:
    """Add ``output``, the model's result for the input columns.

    ``loader`` runs once per Python worker and returns a function from NumPy batches
    (one array per input) to an array of results.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    infer = predict_batch_udf(
        loader,
        return_type=return_type,
        batch_size=batch_size,
        input_tensor_shapes=[list(s) if s else None for s in tensor_shapes] if tensor_shapes else None,
    )
    return df.withColumn(output, infer(*inputs))
