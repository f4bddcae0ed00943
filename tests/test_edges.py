"""Inputs at the edge: empty and null scores, hot hours, years without an end, missing shares."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayledger.operators import evaluation, features, history, scale, sequences, trips
from tests.helpers import d, table

SCORES = "guest_id bigint, score double, label int"


def test_curve_and_area_without_scores(spark):
    none = table(spark, SCORES)
    assert [tuple(r) for r in evaluation.roc_points(none).collect()] == [(0, float("inf"), 0, 0, 0.0, 0.0)]
    assert [r.auc for r in evaluation.auc(none).collect()] == [None]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_scores_without_rank_are_refused(spark, bad):
    scores = table(spark, SCORES, (1, 0.5, 1), (2, bad, 0))
    with pytest.raises(Exception, match="null or NaN"):
        evaluation.roc_points(scores).collect()
    with pytest.raises(Exception, match="null or NaN"):
        evaluation.auc(scores).collect()


@pytest.mark.parametrize("sparse", [True, False])
def test_number_of_ranges_does_not_matter(spark, sparse):
    rng = random.Random(3)
    scores = table(spark, SCORES, *((i, round(rng.random(), 2), rng.randint(0, 1)) for i in range(300)))
    one, many = (sorted(map(tuple, evaluation.roc_points(scores, sparse, n).collect())) for n in (10**6, 3))
    assert one == many and len(one) > 20
    assert evaluation.auc(scores, 3).first() == evaluation.auc(scores).first()


def test_running_total_of_a_guest_within_one_hour(spark):
    start, rng = datetime(2024, 5, 1, 10), random.Random(4)
    rows = [("hot", start + timedelta(microseconds=rng.randrange(3_000_000_000)), Decimal(rng.randrange(99)))
            for _ in range(400)]
    rows += rows[:50] + [("hot", start + timedelta(hours=3), Decimal(5)), ("cold", start, Decimal(7))]
    got = scale.running_total(table(spark, "k string, ts timestamp_ntz, v decimal(18,4)", *rows), "k", "ts", "v", "t")
    want = sorted((k, ts, v, sum(w for j, u, w in rows if j == k and u <= ts)) for k, ts, v in rows)
    assert sorted((r.k, r.ts, r.v, r.t) for r in got.collect()) == want


def test_demographics_have_no_end(spark):
    trip = table(spark, "guest_id bigint, trip_start date, trip_end date", (1, d("2026-03-01"), d("2026-03-04")))
    demo = table(spark, "guest_id bigint, trip_start date, trip_end date, gender string, age int, "
                 "location string, lodging string, tenure int",
                 (1, d("2026-03-01"), d("2026-03-04"), "F", 40, "X", "01 - In House", 3))
    assert trips.with_demographics(trip, demo).count() == 1
    assert trips.with_demographics(trip, demo, since=date(2026, 1, 1), until=date(2026, 12, 31)).count() == 1
    assert trips.with_demographics(trip, demo, until=date(2025, 12, 31)).count() == 0


def test_last_day_of_the_year_is_an_anchor_unless_cut(spark):
    rows = table(spark, "guest_id bigint, day date, days_left int, x double", (1, d("2024-12-31"), 0, 1.0))
    assert sequences.trailing_windows(rows, ["x"]).count() == 1
    assert sequences.trailing_windows(rows, ["x"], anchors=sequences.BEFORE_YEAR_END).count() == 0


def test_guest_without_credits_has_share_zero(spark):
    ddl = ("guest_id bigint, top_tier int, gaming_credits decimal(18,4), non_gaming_credits decimal(18,4), "
           "credits decimal(18,4), trips bigint, trip_days bigint, first_trip_age int, lodger_trips bigint, "
           "local_trips bigint")
    zero = Decimal(0)
    part = table(spark, ddl, (1, 1, zero, zero, zero, 2, 3, 10, 1, 0))
    row = history.combined_history(part, table(spark, ddl)).first()
    assert (row.gaming_share, row.non_gaming_share, row.lodger_share) == (0.0, 0.0, 0.5)
    features.fit_scaler(history.combined_history(part, table(spark, ddl)), ["gaming_share", "hist_trips"])


def test_false_positives_need_one_high_score_and_no_promotion(spark):
    rows = table(spark, "guest_id bigint, day date, days_left int, label int",
                 *((g, d("2024-01-01") + timedelta(n), 365 - n, int(g == 2 and n == 2)) for g in (1, 2, 3) for n in range(3)))
    scores = rows.where("not (guest_id = 2 and label = 1)").withColumn(
        "score", F.when((F.col("guest_id") < 3) & (F.col("days_left") == 365), 0.9).otherwise(0.1))
    got = evaluation.false_positive_rows(rows, scores)
    assert sorted((r.guest_id, r.days_left) for r in got.collect()) == [(1, 363), (1, 364), (1, 365)]


def test_player_days_stand_in_for_the_ledger(spark):
    from stayledger.operators import visits
    from stayledger.operators.days import daily_credits
    from stayledger.operators.ledger import of_years, player_days
    from tests.helpers import bag, ledger, xref

    raw = ledger(spark, ("p", "2023-12-31 23:59:59", "5", "Here", "Gaming"), ("p", "2024-01-01 00:00:00", "7", "There", "Gaming"),
                 ("p", "2024-12-31 12:00:00", "2", "Here", "Other"), ("q", "2024-05-01 10:00:00", "3", None, "Non-Gaming"))
    bridge = xref(spark, ("p", 1), ("q", 2), ("q", 3))
    kept = player_days(of_years(raw, 2023, 2024), "Here")
    assert player_days(kept) is kept
    for year in (2023, 2024):
        assert bag(daily_credits(of_years(raw, year), bridge, year), "guest_id", "day", "credits") == bag(
            daily_credits(kept, bridge, year), "guest_id", "day", "credits")
        assert bag(visits.property_credits(of_years(raw, year), bridge, "Here"), "guest_id", "total_credits", "property_credits") == bag(
            visits.property_credits(of_years(kept, year), bridge, "Here"), "guest_id", "total_credits", "property_credits")
