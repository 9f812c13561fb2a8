"""Entry A: warehouse tables -> daily feature table -> weekly panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandlab.config import PanelConfig
from demandlab.operators import panel as P
from demandlab.sources.fixtures import Warehouse
from demandlab.sources.io import Tables


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(Tables(spark, sf_dir))


def build_daily(wh: Warehouse, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    return P.daily_features(wh, cfg)


def build_weekly(wh: Warehouse, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    return P.weekly(P.daily_features(wh, cfg, packed=True), cfg)
