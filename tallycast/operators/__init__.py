"""Rollup, forecast and backfill operators over DataFrames."""
