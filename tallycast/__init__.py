"""tallycast: roll up event/attack counts per series and period, forecast the
next period from recent growth ratios, and refresh prediction tables, all as
Spark DataFrame plans."""

from .plans.jobs import (GRAINS, backfill, forecast, predict, predict_all, prediction_table, refresh,
                         refresh_all)
from .plans.views import register_views
from .sources.tables import STAT_SCHEMA, normalize, read_stat_parquet, read_stat_table, restrict_days

__all__ = [
    "GRAINS", "STAT_SCHEMA", "backfill", "forecast", "normalize", "predict", "predict_all",
    "prediction_table", "read_stat_parquet", "read_stat_table", "refresh", "refresh_all",
    "register_views", "restrict_days",
]
