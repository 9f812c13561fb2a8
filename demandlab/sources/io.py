"""Sources and sinks (S2-S8): parquet scans, CSV panels, materialisation, profile."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, StructType)

from demandlab.session import ensure_checkpoint_dir


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Scan one table: a catalog table if registered, else ``<dir>/<name>.parquet``."""
    path = os.path.join(directory, f"{name}.parquet")
    if directory:
        return spark.read.parquet(path)
    return spark.table(name)


@dataclass
class Tables:
    """Lazy, memoised table handles for one data folder."""
    spark: SparkSession
    directory: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "directory"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = load(self.spark, self.directory, name)
        return self._cache[name]


MISSING = ("", "nan", "inf", "-inf", "+inf", "infinity", "-infinity", "null", "none", "na")


MISSING = ("", "nan", "inf", "-inf", "+inf", "infinity", "-infinity", "null", "none", "na")


def read_panel_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV panel with a header (S5). Empty, NaN and infinite entries are missing.

    Columns are read as text and cast, so one ``inf`` does not turn a number
    column into text. With a schema the casts are its types; without one, a pass
    over the file finds the columns whose known entries are all whole numbers
    (long), numbers (double) or ISO dates (date); others stay text.
    """
    raw = spark.read.option("header", True).csv(path)
    known = {c: F.when(~F.lower(F.trim(F.col(f"`{c}`"))).isin(*MISSING), F.trim(F.col(f"`{c}`"))) for c in raw.columns}
    if schema is not None:
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema

        def typed(c, kind):
            own = F.col(f"`{c}`")
            if isinstance(kind, StringType):
                return own
            if isinstance(kind, (ByteType, ShortType, IntegerType, LongType, DateType)):
                return own.try_cast(kind)       # no missing entry is one of these
            if isinstance(kind, (FloatType, DoubleType)):   # nor a finite number
                v = own.try_cast(kind)
                return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), known[c].try_cast(kind)).otherwise(v)
            return known[c].try_cast(kind)
        return raw.select(*[typed(c, f.dataType).alias(f.name) for c, f in zip(raw.columns, wanted.fields, strict=True)])
    kinds = (("long", r"^[+-]?[0-9]{1,18}$"), ("double", None), ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))
    bad = raw.agg(*[F.count_if(v.isNotNull() & ((v.try_cast(k).isNull()) | (~v.rlike(p) if p else F.lit(False)))).alias(f"{k}|{i}")
                    for i, v in enumerate(known.values()) for k, p in kinds],
                  *[F.count(v).alias(f"n|{i}") for i, v in enumerate(known.values())]).first()
    out = []
    for i, (c, v) in enumerate(known.items()):
        kind = next((k for k, _ in kinds if bad[f"n|{i}"] and bad[f"{k}|{i}"] == 0), None)
        out.append((v.try_cast(kind) if kind else F.col(f"`{c}`")).alias(c))
    return raw.select(*out)


def write_panel(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, order_by: list[str] | None = None,
                files: int | None = None, compression: str | None = None, file_rows: int | None = None) -> None:
    """Write a panel (S6). Parquet by default; ``fmt='csv'`` writes a header.

    A compressed CSV file is read by one task: ``file_rows`` bounds the rows of each.

    ``order_by`` gives the files a total order (L1) the distributed way: range
    partitioning on the keys (sampled bounds) plus a sort inside each file, never
    a single-task sort.
    """
    if order_by:
        n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if file_rows:
        w = w.option("maxRecordsPerFile", file_rows)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a named table by a query result (S3) and read it back.

    The result is written under ``path`` or under the session's shared
    checkpoint folder, so lineage is cut and a lost executor re-reads the
    written files instead of recomputing the plan.
    """
    spark = df.sparkSession
    if path is None:
        path = os.path.join(ensure_checkpoint_dir(spark), "tables", name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def profile(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> dict:
    """Row count, shape, columns and the first ``n`` rows in key order."""
    head_df = df.orderBy(*order_by) if order_by else df
    rows = df.count()
    return {
        "rows": rows,
        "shape": (rows, len(df.columns)),
        "columns": list(df.columns),
        "head": [r.asDict() for r in head_df.limit(n).collect()],
    }
