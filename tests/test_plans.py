"""Plan-shape regressions: the flagship plan must keep its shuffle budget."""

from __future__ import annotations

from ratelens.plans.correlation import correlation_batch
from ratelens.plans.star import Star
from tests.conftest import SF_SMALL


def _plan_lines(df) -> list[str]:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString().splitlines()


def test_q01_scans_lineitem_twice_and_sweep_reuses_panel_partitioning(spark):
    lines = _plan_lines(correlation_batch(Star(spark, SF_SMALL)))
    scans = [ln for ln in lines if "FileScan parquet" in ln and "lineitem.parquet" in ln]
    # once grouped by order (macro series), once joined to part (market series)
    assert len(scans) == 2, scans
    agg = next(i for i, ln in enumerate(lines)
               if "HashAggregate" in ln and "control_pos" in ln and "partial_" in ln)
    window = next(i for i in range(agg, len(lines)) if "Window [" in lines[i] and "lead(" in lines[i])
    between = lines[agg:window]
    assert not any("Exchange" in ln for ln in between), between


def test_scans_are_pruned(spark):
    lines = _plan_lines(correlation_batch(Star(spark, SF_SMALL)))
    schemas = [ln[ln.index("ReadSchema"):] for ln in lines if "lineitem.parquet" in ln and "ReadSchema" in ln]
    for s in schemas:
        assert "l_comment" not in s and "l_linenumber" not in s
