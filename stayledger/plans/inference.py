"""Daily scoring of the guests who were active the day before."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.operators import days, features, scoring, sequences, trips, visits
from stayledger.operators.ledger import of_years, player_days, with_guest
from stayledger.operators.scale import materialize, milestones
from stayledger.plans import training
from stayledger.plans.training import Cohort, Tables
from stayledger.schemas import NEW_GUEST_FEATURES, RETURNING_FEATURES
from stayledger.sources import tables


def _rolled(src: Tables, cohort: Cohort) -> DataFrame:
    return training.rolled_trips(src, cohort, since=date(cohort.year - 1, 1, 1), include_until=True)


def _lodged(src: Tables, cohort_trips: DataFrame, year: int) -> DataFrame:
    running = cohort_trips.where(cohort_trips.trip_start >= date(year, 1, 1))
    return trips.with_demographics(
        trips.credits_within(running, of_years(src["ledger"], year), src["member_xref"]), src["trip_demo"],
        since=date(year, 1, 1), columns=("lodging",))


def returning_rows(src: Tables, cohort: Cohort) -> DataFrame:
    """Day rows of this year for guests of both years, with last year's history."""
    src = training.with_player_days(src, cohort)
    rolled = materialize(_rolled(src, cohort), "rolled")
    chosen = materialize(visits.trips_of(
        rolled,
        visits.returning_guests(visits.at_property(rolled, cohort.property), cohort.year),
        visits.dominant_guests(of_years(src["ledger"], cohort.year - 1, cohort.year),
                               src["member_xref"], cohort.property, cohort.share)), "chosen")
    combined, _ = training.prior_year(src, chosen, cohort.year)
    return days.inference_features(src["ledger"], src["member_xref"],
                                   _lodged(src, chosen, cohort.year), cohort.year, combined)


def new_guest_rows(src: Tables, cohort: Cohort) -> DataFrame:
    """Day rows of this year for guests without a trip last year."""
    src = training.with_player_days(src, cohort)
    chosen = materialize(training.new_trips(src, cohort), "chosen")
    return days.lodging_shares(days.inference_features(
        src["ledger"], src["member_xref"], _lodged(src, chosen, cohort.year), cohort.year))


def active_guests(src: Tables, as_of: Sequence[date]) -> DataFrame:
    """(guest_id, as_of): guests with credits on the day before each date, from those days of the
    player days alone."""
    before = F.col("day").isin([d - timedelta(days=1) for d in as_of])
    return (with_guest(player_days(src["ledger"]).where(before).select("player_id", "day"), src["member_xref"])
            .select("guest_id", F.date_add("day", 1).alias("as_of")).distinct())


def log_scored(scores: DataFrame, as_of: Sequence[date], path: str) -> None:
    """Append the number of scored guests and their latest day, for each date, to the run log."""
    dates = scores.sparkSession.createDataFrame([(d,) for d in as_of], "as_of date")
    per_date = scores.groupBy("as_of").agg(F.max("day").cast("timestamp_ntz").alias("latest"), F.count("*").alias("row_count"))
    tables.log_run(dates.join(per_date, "as_of", "left").select(
        F.lit("scores").alias("step"), "latest", F.coalesce("row_count", F.lit(0)).alias("row_count")), path)


def daily_run(src: Tables, cohort: Cohort, as_of: Sequence[date], scaler_path: str, scorer: scoring.Scorer,
              threshold: float, returning: bool, log_path: str) -> DataFrame:
    """From source tables to scored guests: day rows, stored scaler, scores and flags of the
    guests who were active the day before each date; counts go to the run log.

    ``src["ledger"]`` is the table of player days (``sources.day_store``), or a ledger, ``src["visit"]``
    holds visits, or trips that ``training.with_trips`` has made of them. Guests are
    chosen first, from the days before the dates; only their rows go any further. All dates
    share one pass, and nothing but the scores stays behind.
    """
    src = training.conforming(src)
    with milestones() as result:
        active = materialize(active_guests(src, as_of), "active")
        chosen = training.kept_days(training.of_guests(src, active), cohort)
        rows = (returning_rows if returning else new_guest_rows)(chosen, cohort)
        scores = result(score_dates(rows, active, tables.load_scaler(scaler_path), scorer, threshold, returning), "scores")
    log_scored(scores, as_of, log_path)
    return scores


def score_dates(rows: DataFrame, active: DataFrame, scaler, scorer: scoring.Scorer, threshold: float,
                returning: bool) -> DataFrame:
    """Score and flag of the guests of ``active`` (guest_id, as_of) who have a row on the day before
    the date, from their latest rows before it."""
    names = RETURNING_FEATURES if returning else NEW_GUEST_FEATURES
    scaled = features.apply_scaler(scaler, days.latest_before(rows, active, sequences.STEPS), names)
    windows = sequences.padded(sequences.trailing_windows(
        scaled, features.scaled_names(names), by=("guest_id", "as_of")), len(names))
    yesterday = windows.where(F.col("day") == F.date_sub("as_of", 1))
    return scoring.flag(scoring.score_sequences(yesterday, scorer, sequences.STEPS, len(names)), threshold)


def score_active(rows: DataFrame, as_of: date, scaler, scorer: scoring.Scorer, threshold: float,
                 returning: bool) -> DataFrame:
    """``score_dates`` for all guests of ``rows`` and one date."""
    active = rows.where(F.col("day") == as_of - timedelta(days=1)).select("guest_id", F.lit(as_of).alias("as_of"))
    return score_dates(rows, active, scaler, scorer, threshold, returning).drop("as_of")
