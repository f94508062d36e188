"""Results do not depend on how Spark is set up to run them."""

import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["split_intervals", "child_count_by_hour", "hourly_rollup", "coverage", "report_view"]
SETTINGS = [
    {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
     "spark.sql.shuffle.partitions": "37"},
    {"spark.sql.ansi.enabled": "false"},
    {"spark.sql.codegen.wholeStage": "false"},
    {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"},
]


def results(spark):
    return {
        name: sorted(map(str, contract.queries()[name](spark, SF_DIR).collect())) for name in NAMES
    }


@pytest.fixture(scope="module")
def usual(spark):
    return results(spark)


@pytest.mark.parametrize("settings", SETTINGS, ids=lambda settings: ",".join(settings))
def test_same_results(spark, usual, settings):
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        assert results(spark) == usual
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
