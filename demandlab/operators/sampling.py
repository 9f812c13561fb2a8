"""Splits and folds from a hash of the row key, never from row order.

``bucket`` must be a deterministic expression of the row's key columns; the
default is ``pmod(xxhash64(keys..., salt), 100)``. Any arithmetic key hash
(e.g. for a cross-engine oracle) can be passed instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bucket(keys: Sequence[str], salt: int = 44, modulus: int = 100) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(salt)), F.lit(modulus)).cast("int")


def split(df: DataFrame, keys: Sequence[str] = (), test_pct: int = 25, salt: int = 44,
          bucket: Column | None = None, name: str = "is_test") -> DataFrame:
    """Tag rows as test (1) / train (0); the same key always lands on the same side."""
    b = bucket if bucket is not None else key_bucket(keys, salt)
    return df.withColumn(name, (b < F.lit(test_pct)).cast("int"))


def with_fold(df: DataFrame, keys: Sequence[str] = (), k: int = 5, salt: int = 7,
              fold: Column | None = None, name: str = "fold") -> DataFrame:
    """Fold id in [0, k) for cross-fitting / cross-validation (R2)."""
    f = fold if fold is not None else key_bucket(keys, salt, k)
    return df.withColumn(name, f.cast("int"))


def train_test(df: DataFrame, name: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """The two sides of a tagged split."""
    return df.where(F.col(name) == 0), df.where(F.col(name) == 1)


def holdout(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Rows of a later period, scored with models fitted earlier."""
    return df.where(F.col(date_col).between(F.lit(start), F.lit(end)))
