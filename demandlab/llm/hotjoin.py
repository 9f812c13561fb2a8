"""Left join of rows with a table that has one row per key and knows how often each key occurs.

A key may hold a third of all rows. Keys with ``hot`` rows or more are few (at
most rows / ``hot``): their entries are broadcast when their checked number
allows it, and their rows never move. All other rows meet their entry by an
ordinary join in which no key has more than ``hot`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm.textcols import small

HOT_ROWS = 10_000
HOT_KEYS = 100_000


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], n: str = "n", hot: int = HOT_ROWS) -> DataFrame:
    """``rows`` left joined with the other columns of ``table`` (written, unique on the non-null ``keys``, ``n`` rows each).

    ``rows`` is read twice.
    """
    keys = list(keys)
    most = small(table.where(F.col(n) >= hot).drop(n), HOT_KEYS)
    few = table.where(F.col(n) < hot).drop(n)
    of_hot = rows.join(most, keys)
    others = rows.join(most.select(*keys), keys, "left_anti").join(few, keys, "left")
    return of_hot.unionByName(others)
