"""Whole plans on the stand-in tables, and the shape of physical plans."""

import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from stayledger.operators import days, features, ledger, scoring, sequences, trips, visits
from stayledger.plans import evaluation, inference, refresh, training
from stayledger.schemas import NEW_GUEST_FEATURES
from verification.queries import COHORT, SYSTEM, Flow, runnable

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def flow(spark):
    return Flow(spark, SF_DIR)


def plan_of(df):
    conf = df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "10000")
    conf.set("spark.sql.debug.maxToStringFields", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_refresh_writes_tables_and_log(spark, flow, tmp_path):
    x = flow.x
    src = {"activity": x.activity, "accrual_item": x.items, "location": x.locations,
           "member_id_map": x.id_map, "purse_policy": x.policies, "member": x.members,
           "member_tier": x.member_tiers, "member_tier_history": x.member_tier_history,
           "merged_member": x.merged}
    for year in (2023, 2024, 2024):
        refresh.refresh(spark, src, str(tmp_path), year, system_user_prefix=SYSTEM)
    written = spark.read.parquet(f"{tmp_path}/ledger")
    direct = ledger.build_ledger(x.activity, x.items, x.locations, x.id_map, x.policies, 2024,
                                 system_user_prefix=SYSTEM)
    assert written.where("calendar_year = 2024").count() == direct.count()
    log = spark.read.parquet(f"{tmp_path}/run_log")
    assert log.groupBy("step").count().count() == 2 and log.count() == 6
    latest = direct.agg(F.max("ts")).first()[0]
    assert log.where(F.col("step") == "ledger").agg(F.max("latest")).first()[0] == latest


def test_training_of_new_guests_to_scores(spark, flow):
    chosen = training.new_trips(flow.x.tables, COHORT)
    rows = training.new_guest_rows(flow.x.tables, chosen, COHORT.year)
    scaler, padded = training.training_sequences(rows, returning=False)
    got = padded.collect()
    assert got and all(len(r.sequence) == 6 and len(r.sequence[0]) == 10 for r in got)
    assert all(0.0 <= v <= 1.0 for r in got for step in r.sequence[:r.length] for v in step)
    scorer = scoring.LinearScorer([0.1] * 10)
    scores = evaluation.simulate(rows, scaler, scorer, NEW_GUEST_FEATURES)
    report = evaluation.report(scores, [0.5])
    assert report["thresholds"].count() == 1 and report["roc"].count() >= 2
    as_of = rows.agg(F.date_add(F.max("day"), 1)).first()[0]
    flagged = inference.score_active(rows, as_of, scaler, scorer, 0.5, returning=False)
    expected = rows.where(F.col("day") == F.date_sub(F.lit(as_of), 1)).select("guest_id").distinct()
    assert {r.guest_id for r in flagged.collect()} == {r.guest_id for r in expected.collect()}


def test_number_of_sequences_is_the_number_of_active_days(flow):
    windows = sequences.trailing_windows(flow.scored_rows, ("credits",))
    assert windows.count() == flow.running.where("days_left between 1 and 365").count()


def test_semi_and_anti_part_the_trips(flow):
    returning = visits.returning_guests(flow.here, COHORT.year)
    inside = visits.trips_of(flow.rolled, returning).count()
    outside = flow.rolled.join(returning, "guest_id", "left_anti").count()
    assert inside + outside == flow.rolled.count()


def test_one_open_interval_per_promoted_guest(flow):
    spans = days.promotion_intervals(flow.natural_days, 2024)
    tails = spans.where(F.col("changed_on") == date(2025, 1, 1)).groupBy("guest_id").count()
    assert tails.count() == flow.natural_days.select("guest_id").distinct().count()
    assert tails.where("count <> 1").count() == 0


def test_visit_filters_and_columns_reach_the_scan(spark, tmp_path):
    v = Flow(spark, SF_DIR).x.visits
    v.write.parquet(str(tmp_path / "visits"))
    read = spark.read.parquet(str(tmp_path / "visits"))
    plan = plan_of(visits.roll_up_trips(visits.visit_base(read), online_brand="X",
                                        until=date(2024, 12, 31)))
    assert "GreaterThanOrEqual(month" in plan and "LessThan(trip_start" in plan
    assert "net_gaming_revenue" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_ledger_year_reaches_the_scan(spark, flow, tmp_path):
    flow.x.activity.write.parquet(str(tmp_path / "activity"))
    activity = spark.read.parquet(str(tmp_path / "activity"))
    x = flow.x
    df = ledger.build_ledger(activity, x.items, x.locations, x.id_map, x.policies, 2024,
                             system_user_prefix=SYSTEM)
    assert "GreaterThanOrEqual(activity_at" in plan_of(df)


@pytest.mark.parametrize("name", [
    "ledger_build", "tier_history_build", "trip_credits", "trip_promo_fanout",
    "trip_promo_disjoint", "customer_history", "day_in_trip", "day_labels", "day_features",
    "seq_trailing6", "roc_points", "auc", "fp_winloss", "class_balance", "latest_snapshot"])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(runnable()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan and "MapInPandas" not in plan


def test_windows_follow_the_grouping_without_another_shuffle(flow):
    """Day number and running credits come out of one sort of the guest's days."""
    plan = plan_of(days.number_days(flow.daily))
    assert plan.count("Exchange hashpartitioning(guest_id") == 1
    assert len(re.findall(r"\bSort \[guest_id", plan)) == 1


def test_interval_join_gets_days_not_items(flow):
    plan = plan_of(trips.trip_credits(flow.rolled, flow.x.ledger, flow.x.xref, 2023))
    join = plan.index("day#")
    assert "HashAggregate" in plan[join:]


def test_scaler_covers_every_feature(flow):
    model = features.fit_scaler(flow.running, ("credits", "day_no"))
    assert len(model.originalMin) == 2
