"""One key holds a third of the rows: the join is split or not shuffled."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ridelens.operators.clean import drop_all_duplicates
from ridelens.operators.conform import canonical_id

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture()
def trips(spark, tmpdir_path):
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("S"), F.col("id") % 5000)).alias("start_station_name"),
        F.concat(F.lit("I"), F.col("id") % 7).alias("start_station_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("ride"),
    )
    path = tmpdir_path + "/trips"
    rows.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(params=["shuffle", "broadcast"])
def joins(spark, request):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    if request.param == "shuffle":
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def check(df, joins):
    rows = df.collect()
    plan = plan_of(df).split("Initial Plan")[0]
    if joins == "shuffle":
        assert "skew=true" in plan
    else:
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    return rows


def test_a_hot_name_is_split(trips, joins):
    got = check(canonical_id(trips), joins)
    assert len(got) == 120_000
    assert {r.start_station_id for r in got if r.start_station_name == ""} == {"I6"}


def test_a_hot_duplicated_key_is_split(trips, joins):
    got = check(drop_all_duplicates(trips, ["start_station_name"]), joins)
    assert got == []
