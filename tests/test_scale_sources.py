import os
import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayledger import schemas
from stayledger.operators import scale
from stayledger.sources import tables
from tests.helpers import bag, d, table, ts


def hot_rows(n=600):
    """A third of all rows under one key, many of them at one instant."""
    rng = random.Random(9)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        at = ts("2024-01-01 00:00:00") + timedelta(
            minutes=0 if rng.random() < .2 else rng.randrange(6000))
        rows.append((i, key, at, rng.randrange(100)))
    return rows


def test_running_total_of_a_hot_key(spark):
    rows = hot_rows()
    df = table(spark, "id int, k string, t timestamp_ntz, v int", *rows)
    got = {r.id: r.total for r in scale.running_total(df, "k", "t", "v", "total").collect()}
    assert got == {i: sum(v for _, k2, t2, v in rows if k2 == k and t2 <= t)
                   for i, k, t, _ in rows}


def test_running_total_in_one_window_equals_levels(spark):
    rows = [(i, k, t, v if i % 5 else None) for i, k, t, v in hot_rows()] + [
        (600, None, ts("2024-01-01 00:00:00"), 1), (601, "hot", None, 7)]
    df = table(spark, "id int, k string, t timestamp_ntz, v int", *rows)
    one, some, all_ = (scale.running_total(df, "k", "t", "v", "total", crowd) for crowd in (1000, 100, 0))
    assert one.columns == ["k", "t", "id", "v", "total"]
    assert bag(one, *one.columns) == bag(some, *one.columns) == bag(all_, *one.columns) and one.count() == 600
    one.collect()
    assert "SortMergeJoin" not in one._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_previous_instant_of_a_hot_key(spark):
    rows = hot_rows()
    first = ts("2000-01-01 00:00:00")
    df = table(spark, "id int, k string, t timestamp_ntz, v int", *rows)
    got = bag(scale.previous_instant(df, "k", "t", "prev", F.lit(first).cast("timestamp_ntz"),
                                     ["id"]), "k", "t", "prev")
    expected, last = [], {}
    for i, k, t, _ in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        expected.append((k, t, last.get(k, first)))
        last[k] = t
    assert got == sorted(expected, key=repr)


def test_materialize_keeps_rows_and_types(spark):
    df = table(spark, "a bigint, t timestamp_ntz, c decimal(18,4)", (1, ts("2024-01-01 00:00:00"),
                                                                    Decimal("1.5")))
    kept = scale.materialize(df)
    assert kept.schema == df.schema and kept.collect() == df.collect()
    assert "Location: InMemoryFileIndex" in kept._jdf.queryExecution().toString()


class Session:
    """Stands in for a session on a cluster."""

    def __init__(self, named):
        self.conf = self.sparkContext = self
        self.named, self.master, self.own = named, "spark://cluster:7077", None

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.own


def test_shared_folder_is_the_one_the_session_names(spark):
    assert scale.work_path(Session("s3a://shared/x/"), "t").startswith("s3a://shared/x/t-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scale.shared_folder(Session(None))
    assert scale.shared_folder(spark)


def test_newest_snapshot(spark, tmp_path):
    for name in ("2024-12-31", "2025-01-02", "2025-01-01", "_tmp"):
        spark.range(1).write.parquet(str(tmp_path / name))
    assert tables.newest_snapshot(spark, str(tmp_path)).endswith("2025-01-02")
    with pytest.raises(FileNotFoundError):
        tables.newest_snapshot(spark, str(tmp_path / "_tmp"))


def test_latest_rows(spark):
    df = table(spark, "snapshot date, v int", (d("2024-01-01"), 1), (d("2024-01-02"), 2),
               (d("2024-01-02"), 3))
    assert bag(tables.latest_rows(df, "snapshot"), "v") == [(2,), (3,)]


def test_write_by_year_prunes(spark, tmp_path):
    df = table(spark, "t timestamp_ntz, v int", (ts("2023-06-01 00:00:00"), 1),
               (ts("2024-06-01 00:00:00"), 2))
    tables.write_by_year(df, str(tmp_path / "l"), "t")
    tables.write_by_year(df, str(tmp_path / "l"), "t")
    back = spark.read.parquet(str(tmp_path / "l")).where("calendar_year = 2024")
    assert bag(back, "v") == [(2,)]
    assert "PartitionFilters: [isnotnull(calendar_year" in back._jdf.queryExecution().toString()


def test_table_csv_and_log(spark, tmp_path):
    df = table(spark, "t timestamp_ntz, v int", (ts("2024-06-01 00:00:00"), 2))
    tables.save_table(df, "saved_rows", path=str(tmp_path / "tbl"))
    assert tables.read(spark, "saved_rows", fmt="table").collect() == df.collect()
    tables.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1
    for step in ("one", "two"):
        tables.log_run(tables.freshness(df, step, "t"), str(tmp_path / "log"))
    assert bag(spark.read.parquet(str(tmp_path / "log")), "step", "latest", "row_count") == [
        ("one", ts("2024-06-01 00:00:00"), 1), ("two", ts("2024-06-01 00:00:00"), 1)]


def test_conform(spark):
    df = table(spark, "Guest_ID int, PLAYER_ID bigint, extra int", (1, 2, 3))
    got = schemas.conform(df, schemas.MEMBER_XREF)
    assert got.schema == schemas.MEMBER_XREF and tuple(got.first()) == ("2", 1)
    with pytest.raises(ValueError, match="guest_id"):
        schemas.conform(df.drop("Guest_ID"), schemas.MEMBER_XREF)


def test_milestones_go_with_their_block(spark):
    with scale.milestones():
        kept = scale.materialize(spark.range(3), "short")
        files = kept.inputFiles()
        assert kept.count() == 3 and os.path.exists(files[0].removeprefix("file://"))
    assert not os.path.exists(files[0].removeprefix("file://"))
