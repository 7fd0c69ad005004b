"""The command-line job, run in-process against the test session."""

import os

import pytest

from tallycast.__main__ import main, targets_of
from tallycast.plans import jobs
from tallycast.sources import fixtures as fx
from tallycast.sources.tables import read_stat_parquet
from tests.conftest import SF_SMALL


def test_cli_refreshes_parquet_targets(spark, scratch):
    src = os.path.join(scratch, "cli_source")
    fx.stat_events(spark, SF_SMALL).write.mode("overwrite").parquet(src)
    out = os.path.join(scratch, "cli_out")
    main(["--source", src, "--source-format", "parquet", "--grain", f"hour={out}/hour",
          "--grain", f"week={out}/week", "--iso-year", "--parallel", "2"])
    stat = read_stat_parquet(spark, src)
    for g, opts in (("hour", {}), ("week", {"iso_year": True})):
        got = sorted(map(tuple, spark.read.parquet(f"{out}/{g}").collect()))
        assert got == sorted(map(tuple, jobs.predict(stat, g, **opts).collect())), g


def test_cli_rejects_bad_grain_spec():
    with pytest.raises(SystemExit):
        targets_of(["hourly=x"])
    with pytest.raises(SystemExit):
        targets_of(["hour"])


def test_cli_explain_runs_no_job(spark, scratch, capsys):
    src = os.path.join(scratch, "cli_source_explain")
    fx.stat_orders(spark, SF_SMALL).write.mode("overwrite").parquet(src)
    out = os.path.join(scratch, "cli_explain_out")
    main(["--source", src, "--source-format", "parquet", "--grain", f"day={out}/day", "--explain"])
    printed = capsys.readouterr().out
    assert "== day" in printed and "Window" in printed
    assert not os.path.exists(out)
