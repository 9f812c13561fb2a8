"""Fitted models next to the rows they apply to.

A small table of models (its size is checked in bytes) travels in the tasks'
closure, and each row only carries its model's number; a larger one is joined,
so that each row carries its model's arrays. Either way a task applies the
models of a whole Arrow batch with one matrix expression.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from demandlab.operators.gram import matrix
from demandlab.session import scratch_table

MODEL_BYTES = 32 << 20


def with_models(rows: DataFrame, models: DataFrame, on: Callable[[Sequence[str]], Column], keys: Sequence[str], sizes: dict[str, int],
                most_bytes: int = MODEL_BYTES) -> tuple[DataFrame, Callable[[pa.RecordBatch, str], np.ndarray]]:
    """Rows left joined with their model, and a function for use in a task: (batch, name) -> one array for each row.

    ``models`` has the columns ``keys`` and the array columns of ``sizes`` (lengths);
    ``on`` makes the join condition from the names the keys have in the joined
    frame. Rows without a model, or with a NULL array, get NaN.
    """
    spark = rows.sparkSession
    path = scratch_table(spark, "models")
    names = [f"_mk{i}" for i in range(len(keys))]
    models.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *sizes).write.parquet(path)
    table = spark.read.parquet(path)
    width = sum(sizes.values())
    if table.count() * 8 * width <= most_bytes:
        held = table.collect()
        stacks = {s: np.array([r[s] if r[s] is not None else [np.nan] * k for r in held], float).reshape(len(held), k) for s, k in sizes.items()}
        index = spark.createDataFrame([(*[r[n] for n in names], i) for i, r in enumerate(held)], StructType([*table.select(*names).schema.fields, StructField("_m", IntegerType())]))
        joined = rows.join(F.broadcast(index), on(names), "left").drop(*names)

        def by_number(batch: pa.RecordBatch, name: str) -> np.ndarray:
            none = batch.column("_m").is_null().to_numpy(zero_copy_only=False)
            out = np.full((batch.num_rows, sizes[name]), np.nan)
            out[~none] = stacks[name][batch.column("_m").drop_null().to_numpy()]
            return out
        return joined, by_number

    carried = [F.coalesce(F.col(s), F.array_repeat(F.lit(float("nan")), k)).alias(f"_a_{s}") for s, k in sizes.items()]
    joined = rows.join(table.select(*names, *carried), on(names), "left").drop(*names)
    filled = joined.withColumns({f"_a_{s}": F.coalesce(F.col(f"_a_{s}"), F.array_repeat(F.lit(float("nan")), k)) for s, k in sizes.items()})

    def by_array(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return matrix(batch.column(f"_a_{name}"), sizes[name])
    return filled, by_array
