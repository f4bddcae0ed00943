"""Stored player days, the daily run over them, and the plan from a cohort to its sequences."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stayledger.operators import days, features, ledger, scale, scoring, sequences, visits
from stayledger.plans import inference, training
from stayledger.schemas import NEW_GUEST_FEATURES
from stayledger.sources import day_store, tables
from tests.helpers import bag, d, ledger as items, table
from verification.queries import AS_OF, MODEL_BIAS, WIDE, Flow, model_weights, runnable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flow(spark):
    return Flow(spark, SF_DIR)


def partitions_read(df) -> int:
    """Partitions that the one scan of a frame has chosen."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaf = plan.collectLeaves().head()
    return leaf.selectedPartitions().partitionCount()


def folders(spark) -> set[str]:
    return set(os.listdir(scale.shared_folder(spark)))


ROWS = [("1", "2024-05-31T23:59:59", "1", "Here", "Gaming"), ("1", "2024-06-01T00:00:00", "2", "There", "Other"),
        ("1", "2024-06-01T12:00:00", "3", "Here Too", "Gaming"), ("2", "2024-06-01T10:00:00", "4", None, "Non-Gaming"),
        ("2", "2024-06-02T10:00:00", "5", "Here", "Gaming")]


def test_days_are_added_replaced_and_pruned(spark, tmp_path):
    path, given = str(tmp_path / "days"), items(spark, *ROWS)
    for first, last in ((d("2024-05-01"), d("2024-05-31")), (d("2024-06-01"), d("2024-06-01")),
                        (d("2024-06-02"), d("2024-06-02")), (d("2024-06-01"), d("2024-06-01"))):
        day_store.put_days(given, path, first, last, "Here")
    kept = day_store.read_days(spark, path)
    columns = ("player_id", "day", "credits", "gaming_credits", "non_gaming_credits", "property_credits")
    assert bag(kept, *columns) == bag(ledger.player_days(given, "Here"), *columns)
    fewer = items(spark, *ROWS[:2])
    day_store.put_days(fewer, path, d("2024-06-01"), d("2024-06-01"), "Here")
    kept = day_store.read_days(spark, path)
    assert kept.where("day = DATE '2024-06-01'").agg(F.sum("credits")).first()[0] == 2
    assert kept.where("day <> DATE '2024-06-01'").count() == 2
    assert partitions_read(kept.where(F.col("day").isin(d("2024-06-02")))) == 1
    assert {r.month for r in kept.select("month").distinct().collect()} == {"2024-05", "2024-06"}


def test_store_serves_as_ledger(flow):
    same = ("player_id", "day", "credits", "property_credits")
    want = ledger.player_days(ledger.of_years(flow.x.ledger, 2023, 2024), WIDE.property)
    assert bag(flow.x.player_days, *same) == bag(want, *same)


def daily(flow, src, as_of, tmp_path, guests_seen=None):
    scaler = str(tmp_path / "scaler")
    every = training.new_guest_rows(flow.days, training.new_trips(flow.days, WIDE), WIDE.year)
    tables.save_scaler(features.fit_scaler(every, NEW_GUEST_FEATURES), scaler)
    return inference.daily_run(src, WIDE, as_of, scaler, scoring.LinearScorer(
        model_weights(NEW_GUEST_FEATURES), MODEL_BIAS), 0.4, False, str(tmp_path / "log"))


def test_daily_run_touches_active_guests_only(spark, flow, tmp_path, monkeypatch):
    src = {**flow.x.tables, "ledger": flow.x.player_days}
    as_of = list(AS_OF[:-1])
    active = {r.guest_id for r in inference.active_guests(src, as_of).collect()}
    yesterday = [t - timedelta(days=1) for t in as_of]
    want = ledger.with_guest(flow.x.player_days.where(F.col("day").isin(yesterday)), flow.x.xref)
    assert active == {r.guest_id for r in want.collect()} and active
    seen, plain = {}, scale.materialize

    def watched(df, name="frame"):
        out = plain(df, name)
        if "guest_id" in out.columns:
            seen.setdefault(name, set()).update(r.guest_id for r in out.select("guest_id").distinct().collect())
        elif "player_id" in out.columns:
            seen.setdefault(name, set()).update(int(r.player_id) - 700000 for r in out.select("player_id").distinct().collect())
        return out

    for module in (training, inference, scale):
        monkeypatch.setattr(module, "materialize", watched)
    scores = daily(flow, src, as_of, tmp_path)
    for module in (training, inference, scale):
        monkeypatch.setattr(module, "materialize", plain)
    inner = {name: guests for name, guests in seen.items() if name not in ("rolled", "natural", "trips", "new_days")}
    assert {"active", "bridge", "player_days", "chosen", "scores"} <= set(inner)
    assert all(inner[name] <= active for name in ("active", "bridge", "scores"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == len(as_of) and log.agg(F.sum("row_count")).first()[0] == scores.count()


def test_days_of_other_guests_are_left_out(flow):
    some = flow.x.xref.where("guest_id % 10 = 0").select("guest_id")
    src = training.of_guests({**flow.x.tables, "ledger": flow.x.player_days}, some)
    assert src["ledger"].count() and src["visit"].count()
    assert src["ledger"].where("CAST(player_id AS long) % 10 <> 0").count() == 0
    for name in ("visit", "trip_demo", "member_xref"):
        assert src[name].where("guest_id % 10 <> 0").count() == 0
    assert src["activity"].where("CAST(loyalty_id AS long) % 10 <> 0").count() == 0


def test_all_dates_in_one_pass_equal_one_date_each(spark, flow):
    rows = scale.materialize(inference.new_guest_rows({**flow.x.tables, "ledger": flow.x.player_days}, WIDE), "rows")
    scaler = features.fit_scaler(rows, NEW_GUEST_FEATURES)
    scorer = scoring.LinearScorer(model_weights(NEW_GUEST_FEATURES), MODEL_BIAS)
    dates = [r.day + timedelta(days=1) for r in rows.select("day").distinct().orderBy("day").limit(4).collect()]
    active = rows.select("guest_id", F.date_add("day", 1).alias("as_of")).where(F.col("as_of").isin(dates))
    together = inference.score_dates(rows, active, scaler, scorer, 0.4, False)
    columns = ("guest_id", "day", "days_left", "length", F.round("score", 9), "flag")
    apart = [bag(inference.score_active(rows, t, scaler, scorer, 0.4, False), *columns) for t in dates]
    assert [bag(together.where(F.col("as_of") == t), *columns) for t in dates] == apart and all(apart)


def test_cohort_plan_equals_its_steps_and_leaves_nothing_behind(spark, flow):
    before = folders(spark)
    _, got = training.cohort_sequences(flow.x.tables, WIDE, returning=False)
    left = folders(spark) - before
    assert len(left) == 1 and all(name.startswith("sequences") for name in left)
    chosen = training.new_trips(flow.days, WIDE)
    _, want = training.training_sequences(training.new_guest_rows(flow.days, chosen, WIDE.year), returning=False)
    columns = ("guest_id", "day", "label", "length", "sequence")
    assert bag(got, *columns) == bag(want, *columns) and got.count() > 10


def test_daily_run_leaves_scores_only(spark, flow, tmp_path):
    src = {**flow.x.tables, "ledger": flow.x.player_days}
    daily(flow, src, AS_OF[:1], tmp_path)  # what the flow itself keeps is there now
    before = folders(spark)
    scaler = str(tmp_path / "scaler")
    inference.daily_run(src, WIDE, AS_OF[:2], scaler, scoring.LinearScorer(
        model_weights(NEW_GUEST_FEATURES), MODEL_BIAS), 0.4, False, str(tmp_path / "log"))
    left = folders(spark) - before
    assert len(left) == 1 and all(name.startswith("scores") for name in left)


def test_result_of_an_inner_block_goes_with_the_outer_one(spark):
    before = folders(spark)
    with scale.milestones() as outer:
        with scale.milestones() as inner:
            scale.materialize(spark.range(3), "gone")
            kept = inner(spark.range(4), "inner")
        assert kept.count() == 4 and {n.split("-")[0] for n in folders(spark) - before} == {"inner"}
        last = outer(kept, "outer")
    assert last.count() == 4 and {n.split("-")[0] for n in folders(spark) - before} == {"outer"}


def test_kept_trips_stand_in_for_visits(spark, flow, monkeypatch):
    given, day = training.conforming(flow.x.tables), date(WIDE.year - 1, 1, 1)
    want = inference._rolled(given, WIDE)
    src = training.with_trips(given, WIDE)

    def again(*_, **__):
        raise AssertionError("visits are rolled up again")

    monkeypatch.setattr(visits, "roll_up_trips", again)
    assert training.with_trips(src, WIDE) is src and training.conforming(src)["visit"] is src["visit"]
    got = inference._rolled(src, WIDE)
    assert bag(got, *want.columns) == bag(want, *want.columns) and got.count() > 10
    cut = training.rolled_trips(src, WIDE, since=day)
    assert bag(cut, *want.columns) == bag(want.where(F.col("trip_start") < date(WIDE.year, 12, 31)), *want.columns)
    for returning in (True, False):
        training.visitors(src, WIDE, returning)


def test_missing_columns_of_a_source_fail_at_once(flow):
    with pytest.raises(ValueError, match="lacks columns"):
        training.cohort_sequences({**flow.x.tables, "visit": flow.x.visits.drop("segment")}, WIDE, True)


def test_latest_before_needs_a_row_on_the_day_before(spark):
    rows = table(spark, "guest_id bigint, day date, days_left int", *((1, d(f"2024-03-0{k}"), 100 - k) for k in range(1, 9)))
    active = table(spark, "guest_id bigint, as_of date", (1, d("2024-03-04")), (1, d("2024-03-04")), (1, d("2024-03-20")), (2, d("2024-03-04")))
    got = days.latest_before(rows, active, keep=2)
    assert bag(got, "as_of", "day", "recency") == [(date(2024, 3, 4), date(2024, 3, 2), 2), (date(2024, 3, 4), date(2024, 3, 3), 1)]


def test_windows_by_date_are_apart(spark):
    rows = table(spark, "guest_id bigint, as_of date, day date, days_left int, x double",
                 *((1, d(a), d(f"2024-03-0{k}"), 9, float(k)) for a in ("2024-03-05", "2024-03-06") for k in range(1, 4)))
    got = sequences.trailing_windows(rows, ["x"], by=("guest_id", "as_of"))
    assert got.where("length = 3").count() == 2 and got.count() == 6


@pytest.mark.parametrize("name", ["score_active_returning", "score_active_new"])
def test_whole_runs_score_more_than_twenty(spark, name):
    assert runnable()[name](spark, "/root/testdata/sf0.01").count() > 20


