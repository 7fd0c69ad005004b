"""Spark SQL access: register the statistics table, its rollups and the
prediction tables as temporary views, so they can be queried with
``spark.sql`` like any table (the views are lazy plans, nothing is computed
when they are registered)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import rollup as R
from .jobs import GRAINS, options_for, predict


def register_views(stat: DataFrame, prefix: str = "", grains=GRAINS, **options) -> list[str]:
    """Create or replace ``{prefix}stat`` and, per grain, ``{prefix}rollup_<grain>``
    and ``{prefix}prediction_<grain>`` views; returns their names."""
    rollups = {
        "hour": lambda: R.rollup_hour(stat),
        "day": lambda: R.rollup_day(stat),
        "week": lambda: R.rollup_week(stat, iso_year=options.get("iso_year", False)).drop("week_start"),
        "month": lambda: R.rollup_month(stat),
        "legacy_day": lambda: R.rollup_day_count(stat),
    }
    views = {"stat": stat}
    for g in grains:
        views[f"rollup_{g}"] = rollups[g]()
        opts = options_for(g, options)
        views[f"prediction_{g}"] = predict(stat, g, **opts)
    names = []
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
