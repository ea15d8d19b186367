"""Plan shape guards for every registered query: no cartesian products or
nested-loop joins, no exchange into a single partition (one task holding
everything), and no read of the text column where only paths are needed."""

import re

import pytest

import __spark_entry__ as ENTRY
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition", "CollectLimit")
PATH_ONLY = ("python_files", "non_test_files", "rel_paths", "quarantine", "run_report")


# the training-data queries have their own tests, next to their subpackage
NAMES = sorted(n for n in ENTRY.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    df = ENTRY.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, node
    if name in PATH_ONLY:
        for cols in re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*documents\.parquet", plan):
            assert "text" not in re.sub(r"#\d+L?", "", cols).split(","), cols
