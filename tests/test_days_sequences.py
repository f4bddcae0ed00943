import random
from datetime import date, timedelta
from decimal import Decimal

import pytest

from stayledger.operators import days, sequences
from tests.helpers import bag, d, ledger, table, ts, xref


def natural(spark, *rows):
    return table(spark, "guest_id bigint, changed_at timestamp_ntz, promo_tier int, tier_after int",
                 *((g, ts(c), a, b) for g, c, a, b in rows))


def day_rows(spark, *rows):
    """(guest, day, length, day in trip, tier)"""
    return table(spark, "guest_id bigint, day date, credits decimal(18,4), days_left int, "
                 "day_no int, running_credits decimal(18,4), trip_length int, trip_day int, "
                 "trip_tier int, lodging string",
                 *((g, d(t), Decimal(1), 1, 1, Decimal(1), n, k, tier, "02 - Local")
                   for g, t, n, k, tier in rows))


def test_daily_credits_and_running(spark):
    rows = ledger(spark, ("1", "2024-01-02 00:00:00", "5", "S", "G"),
                  ("2", "2024-01-02 23:59:59", "7", "S", "G"),
                  ("1", "2024-12-31 10:00:00", "1", "S", "G"),
                  ("1", "2025-01-01 00:00:00", "9", "S", "G"))
    got = days.number_days(days.daily_credits(rows, xref(spark, ("1", 4), ("2", 4)), 2024))
    assert bag(got, "day", "credits", "days_left", "day_no", "running_credits") == [
        (d("2024-01-02"), Decimal(12), 364, 1, Decimal(12)),
        (d("2024-12-31"), Decimal(1), 0, 2, Decimal(13))]


def test_running_credits_never_fall(spark):
    rng = random.Random(3)
    rows = [(str(rng.randrange(4)), f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d} "
             f"{rng.randrange(24):02d}:00:00", str(rng.randrange(500)), "S", "G") for _ in range(300)]
    got = days.number_days(days.daily_credits(
        ledger(spark, *rows), xref(spark, *((str(i), i) for i in range(4))), 2024)).collect()
    by_guest = {}
    for r in sorted(got, key=lambda r: (r.guest_id, r.day)):
        by_guest.setdefault(r.guest_id, []).append((r.day_no, r.running_credits))
    for seen in by_guest.values():
        assert [n for n, _ in seen] == list(range(1, len(seen) + 1))
        assert all(a[1] <= b[1] for a, b in zip(seen, seen[1:]))


def test_overlapping_trips_multiply_a_day(spark):
    frame = table(spark, "guest_id bigint, day date", (1, d("2024-01-05")), (1, d("2024-01-20")))
    t = table(spark, "guest_id bigint, trip_start date, trip_end date, tier string, lodging string",
              (1, d("2024-01-01"), d("2024-01-05"), "02 - Pearl", "x"),
              (1, d("2024-01-05"), d("2024-01-09"), "03 - Gold", "y"))
    assert bag(days.within_trips(frame, t), "day", "trip_length", "trip_day", "trip_tier",
               "lodging") == [(d("2024-01-05"), 5, 1, 3, "y"), (d("2024-01-05"), 5, 5, 2, "x")]


def test_promotion_intervals(spark):
    n = natural(spark, (1, "2024-03-01 10:00:00", 1, 2), (1, "2024-06-01 10:00:00", 2, 3),
                (2, "2024-03-01 00:00:00", 1, 3))
    assert bag(days.promotion_intervals(n, 2024), "guest_id", "prev_changed_on", "changed_on",
               "promo_tier") == [
        (1, d("2023-12-31"), d("2024-03-01"), 1), (1, d("2024-03-01"), d("2024-06-01"), 2),
        (1, d("2024-06-01"), d("2025-01-01"), 3), (2, d("2023-12-31"), d("2024-03-01"), 1),
        (2, d("2024-03-01"), d("2025-01-01"), 3)]


def test_label_is_the_week_up_to_the_promotion(spark):
    dates = [d("2024-03-01") + timedelta(days=n) for n in range(-9, 3)]
    rows = day_rows(spark, *((1, str(x), 3, 1, 1) for x in dates), (2, "2024-03-01", 3, 1, 4))
    got = days.with_labels(rows, days.promotion_intervals(
        natural(spark, (1, "2024-03-01 10:00:00", 1, 2)), 2024), 2024)
    labels = {(r.day, r.changed_on): r.label for r in got.where("guest_id = 1").collect()}
    assert {day for (day, _), v in labels.items() if v} == set(dates[3:10])
    # The promotion day lies in both intervals; from it on the tier is lifted.
    assert labels[(d("2024-03-01"), d("2024-03-01"))] == 1
    assert labels[(d("2024-03-01"), d("2025-01-01"))] == 0
    tail = got.where("changed_on = date'2025-01-01'")
    assert {(r.trip_tier, r.target_credits) for r in tail.collect()} == {(2, 75000)}
    # The fourth tier has no target, so guest 2 is left out.
    assert got.where("guest_id = 2").count() == 0
    kept = days.without_promotion_day(got)
    assert bag(kept.where("day = date'2024-03-01'"), "label") == [(0,)]


def test_inconsistent_guests(spark):
    rows = table(spark, "guest_id bigint, day date, changed_on date, running_credits int, "
                 "target_credits int",
                 (1, d("2024-03-01"), d("2024-03-01"), 30000, 20000),
                 (2, d("2024-03-01"), None, 30000, 20000),
                 (3, d("2024-03-01"), d("2024-04-01"), 20000, 20000))
    assert bag(days.drop_inconsistent(rows), "guest_id") == [(1,), (3,)]


def test_lodging_shares(spark):
    rows = table(spark, "guest_id bigint, day date, lodging_code int",
                 *((1, d(f"2024-03-0{n}"), code) for n, code in enumerate((1, 2, 1, 3), start=1)))
    assert [tuple(r) for r in days.lodging_shares(rows).orderBy("day").select(
        "lodger_share", "local_share").collect()] == [
        (1.0, 0.0), (0.5, 0.5), (2 / 3, 1 / 3), (0.5, 0.25)]


def test_latest_of_active(spark):
    rows = table(spark, "guest_id bigint, day date, days_left int",
                 *((1, d("2024-03-01") + timedelta(days=n), 300 - n) for n in range(9)),
                 *((2, d("2024-03-01") + timedelta(days=n), 300 - n) for n in range(8)))
    got = days.latest_of_active(rows, date(2024, 3, 10))
    assert bag(got, "guest_id", "day") == [(1, d(f"2024-03-0{n}")) for n in range(4, 10)]


def numbered(spark, counts, first="2024-12-20"):
    rows = []
    for guest, n in counts.items():
        for k in range(n):
            day = d(first) + timedelta(days=k)
            rows.append((guest, day, (d("2024-12-31") - day).days, float(k + 1), k % 2))
    return table(spark, "guest_id bigint, day date, days_left int, x double, label int", *rows)


def loop_windows(rows, steps=6):
    """The definition: for each day of the year, the latest rows of guests active on it."""
    out = []
    for left in range(365, 0, -1):
        for guest in {r.guest_id for r in rows if r.days_left == left}:
            mine = sorted((r for r in rows if r.guest_id == guest and r.days_left >= left),
                          key=lambda r: r.days_left)[:steps][::-1]
            out.append((guest, left, tuple(r.x for r in mine), len(mine), mine[-1].label))
    return sorted(out)


@pytest.mark.parametrize("first", ["2024-03-01", "2024-12-20"])
def test_trailing_windows_equal_the_loop(spark, first):
    frame = numbered(spark, {1: 1, 2: 5, 3: 6, 4: 7, 5: 12}, first)
    got = sorted((r.guest_id, r.days_left, tuple(s[0] for s in r.sequence), r.length, r.label)
                 for r in sequences.trailing_windows(
                     frame, ["x"], anchors=sequences.BEFORE_YEAR_END).collect())
    assert got == loop_windows(frame.collect())
    assert all(left > 0 for _, left, *_ in got)


def test_trailing_windows_with_overlapping_trips(spark):
    rows = table(spark, "guest_id bigint, day date, days_left int, trip_day int, trip_length int, "
                 "x double, label int",
                 (1, d("2024-03-01"), 305, 5, 5, 1.0, 0), (1, d("2024-03-01"), 305, 1, 9, 2.0, 1))
    got = sequences.trailing_windows(rows, ["x"]).collect()
    assert [(r.sequence, r.label) for r in got] == [([[1.0], [2.0]], 1)]


def test_chunks_and_padding(spark):
    frame = numbered(spark, {1: 1, 2: 5, 3: 6, 4: 7, 5: 13}, "2024-03-01")
    runs = sequences.chunks(frame, ["x", "days_left"])
    got = {(r.guest_id, r.chunk): ([s[0] for s in r.sequence], r.length, r.label)
           for r in runs.collect()}
    assert got[(1, 0)] == ([1.0], 1, 0)
    assert got[(3, 0)] == ([1.0, 2, 3, 4, 5, 6], 6, 1)
    assert got[(4, 1)] == ([7.0], 1, 0)
    assert got[(5, 2)] == ([13.0], 1, 0) and len(got) == 1 + 1 + 1 + 2 + 3
    full = sequences.padded(runs, 2, pad=-1.0).collect()
    assert all(len(r.sequence) == 6 for r in full)
    assert all(s == [-1.0, -1.0] for r in full for s in r.sequence[r.length:])
