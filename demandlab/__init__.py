"""demandlab: demand and price-elasticity analytics on Spark.

Layers
------
sources    table loading, CSV/parquet sinks, the driver-table stand-ins
functions  column -> column expressions (NULL-safe division, logs, flags)
operators  panel building, features, sampling, statistics and estimators
plans      end-to-end pipelines (daily panel, design matrix, estimation)
streaming  intentionally empty: the modelled workload is batch only
"""

from demandlab.config import PanelConfig, PrepConfig

__all__ = ["PanelConfig", "PrepConfig"]
