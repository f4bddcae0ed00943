"""Splittable key sides, promotion ranges, indexes by range, snapshots and observed writes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stayledger.operators import features, scale, trips
from stayledger.sources import tables
from tests.helpers import bag, d, promotions, table, trips as trip_rows
from tests.test_daily_run import partitions_read

SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def skewed(spark):
    """A session in which small partitions count as skewed, and rows of which half have one key."""
    scale.tune(spark)
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield scale.materialize(spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left_anti", "left_semi"])
def test_hot_key_is_split_against_keys_of_a_frame(spark, skewed, how):
    keys = scale.materialize(spark.range(0, 60_000, 3).select(F.col("id").alias("k")))
    repeated = keys.union(keys).union(spark.range(5000).select(F.lit(7).cast("long").alias("k")))
    got = skewed.join(scale.keys_of(repeated, "k"), "k", how)
    assert "skew=true" in final_plan(got)
    aggregated = skewed.join(repeated.distinct(), "k", how)
    assert "skew=true" not in final_plan(aggregated)  # why the helper is there
    assert got.count() == aggregated.count() == skewed.where(
        F.col("k").isin(7) | (F.col("k") % 3 == 0) if how == "left_semi" else (F.col("k") != 7) & (F.col("k") % 3 != 0)).count()


def test_promotion_ranges_say_what_the_pairs_say(spark):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    when = [start + timedelta(hours=rng.randrange(366 * 24)) for _ in range(40)] + [datetime(2024, 3, 1)] * 2
    promoted = promotions(spark, *((str(rng.randrange(5)), 1, 2, t.isoformat()) for t in when))
    given = trip_rows(spark, *((g % 7, str(g % 7), (start + timedelta(days=rng.randrange(360))).date().isoformat(),
                                "2024-12-31", "10") for g in range(60)), (1, "1", "2024-03-01", "2024-03-02", "1"),
                      (1, "1", "2024-03-01", "2024-03-02", "1"), (3, None, "2024-02-01", "2024-02-02", "1"),
                      (1, "1", "2023-12-31", "2024-01-02", "1"))
    pairs = trips.with_later_promotions(given.dropDuplicates(["trip_id", "guest_id"]), promoted, 2024)
    want = pairs.groupBy("guest_id", "trip_id").agg(
        F.min("changed_at").alias("first"), F.max("changed_at").alias("last"), F.count("changed_at").alias("n"))
    got = trips.with_promotion_ranges(given.dropDuplicates(["trip_id", "guest_id"]), promoted, 2024)
    assert bag(got, "guest_id", "trip_id", "first_promoted_at", "last_promoted_at", "later_promotions") == bag(
        want, "guest_id", "trip_id", "first", "last", "n")
    twice = trips.with_promotion_ranges(given, promoted, 2024)
    assert twice.count() == given.count()  # copies of a trip stay copies


def test_index_over_many_ranges(spark):
    rng = random.Random(3)
    values = [f"v{rng.randrange(60)}" for _ in range(400)] + [None, "z", "z"]
    df = table(spark, "c string", *((v,) for v in values))
    known = [v for v in values if v is not None]
    ranked = sorted(set(known), key=lambda v: (-known.count(v), v))
    for size in (50_000, 7, 1):
        assert sorted(map(tuple, features.category_index(df, "c", size).select("idx", "c", "rows").collect())) == [
            (i, v, known.count(v)) for i, v in enumerate(ranked)]
    assert features.category_index(df.limit(0), "c").count() == 0


def test_newest_partition_reads_one(spark, tmp_path):
    path = str(tmp_path / "t")
    for snapshot, n in (("2024-01-05", 2), ("2024-02-01", 3), ("2024-01-20", 4)):
        tables.write_snapshot(spark.range(n).withColumn("snapshot", F.lit(d(snapshot))), path, "snapshot")
    newest = tables.newest_partition(spark, path, "snapshot")
    assert newest.count() == 3 and partitions_read(newest) == 1
    tables.write_snapshot(spark.range(9).withColumn("snapshot", F.lit(d("2024-02-01"))), path, "snapshot")
    assert tables.newest_partition(spark, path, "snapshot").count() == 9
    assert spark.read.parquet(path).count() == 15
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        tables.newest_partition(spark, str(tmp_path / "empty"), "snapshot")


def test_a_year_is_replaced_in_place(spark, tmp_path):
    path = str(tmp_path / "l")
    rows = table(spark, "ts timestamp_ntz, v int", *((datetime(y, 5, 1), y) for y in (2022, 2023, 2023, 2024)))
    tables.write_by_year(rows, path, "ts")
    tables.write_by_year(rows.where("v = 2023").limit(1), path, "ts")
    assert bag(spark.read.parquet(path), "v", "calendar_year") == [(2022, 2022), (2023, 2023), (2024, 2024)]


def test_write_counts_what_it_writes_in_its_own_job(spark, tmp_path):
    rows = table(spark, "ts timestamp_ntz, v int", (datetime(2024, 5, 1, 3), 1), (datetime(2024, 5, 2), 2), (None, 3))
    group = "observed-write"
    spark.sparkContext.setJobGroup(group, "")
    got = tables.write_observed(rows, str(tmp_path / "t"), "step", "ts")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1
    assert bag(got, "step", "latest", "row_count") == [("step", datetime(2024, 5, 2), 3)]
    none = tables.write_observed(rows.limit(0), str(tmp_path / "u"), "step", "ts")
    assert bag(none, "latest", "row_count") == [(None, 0)]
