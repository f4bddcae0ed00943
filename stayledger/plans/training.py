"""Training data of returning and of new guests, from source tables to sequences."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.operators import days, features, history, sequences, tiers, trips, visits
from stayledger.operators.ledger import of_years, player_days
from stayledger.operators.scale import keys_of, materialize, milestones
from stayledger.schemas import NEW_GUEST_FEATURES, PLAN_SOURCES, RETURNING_FEATURES, conform

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Cohort:
    """Who is modelled: a property, a model year, and how much of the credits it must hold."""

    property: str
    year: int
    online_brand: str
    share: float = 0.8
    min_credits: float = 0


def with_player_days(src: Tables, cohort: Cohort) -> Tables:
    """Tables with the player days of both years, kept, in place of the ledger.

    The one pass over the ledger: cohorts, trips and day rows all read its result. Player days
    that are there already are read where they lie.
    """
    both = of_years(src["ledger"], cohort.year - 1, cohort.year)
    if "day" in both.columns:
        return {**src, "ledger": both}
    return {**src, "ledger": materialize(player_days(both, cohort.property), "player_days")}


def rolled_trips(src: Tables, cohort: Cohort, since: date | None = None, include_until: bool = False) -> DataFrame:
    """Trips of the visits; trips that stand there already, rolled up, are only cut to the dates."""
    until, start = date(cohort.year, 12, 31), F.col("trip_start")
    if "trip_id" in src["visit"].columns:
        before = start <= F.lit(until) if include_until else start < F.lit(until)
        return src["visit"].where(before if since is None else before & (start >= F.lit(since)))
    return visits.roll_up_trips(visits.visit_base(src["visit"]), online_brand=cohort.online_brand,
                                until=until, include_until=include_until, since=since)


def with_trips(src: Tables, cohort: Cohort) -> Tables:
    """Tables with the trips of both years, kept, in place of the visits: the one pass over them.

    Nothing in a run of the cohort's year looks at trips that start earlier. Trips that are there
    already are read where they lie.
    """
    if "trip_id" in src["visit"].columns:
        return src
    return {**src, "visit": materialize(rolled_trips(
        src, cohort, since=date(cohort.year - 1, 1, 1), include_until=True), "rolled")}


def _kept_trips(src: Tables, rolled: DataFrame) -> DataFrame:
    """``rolled``, written unless its trips stand in ``src`` already."""
    return rolled if "trip_id" in src["visit"].columns else materialize(rolled, "rolled")


def returning_trips(src: Tables, cohort: Cohort) -> DataFrame:
    """All trips of guests who came in both years and earn mostly at the property."""
    rolled = _kept_trips(src, rolled_trips(src, cohort))
    returning = visits.returning_guests(visits.at_property(rolled, cohort.property), cohort.year)
    dominant = visits.dominant_guests(of_years(src["ledger"], cohort.year - 1, cohort.year),
                                      src["member_xref"], cohort.property, cohort.share)
    return visits.trips_of(rolled, returning, dominant)


def new_trips(src: Tables, cohort: Cohort) -> DataFrame:
    """Trips at the property by guests who did not come the year before."""
    both_years = rolled_trips(src, cohort, since=date(cohort.year - 1, 1, 1))
    at = visits.at_property(_kept_trips(src, both_years), cohort.property)
    earning = visits.guests_with_credits(of_years(src["ledger"], cohort.year),
                                         src["member_xref"], cohort.property, cohort.min_credits)
    return visits.trips_of(visits.new_guest_trips(at, cohort.year), earning)


def described_trips(src: Tables, cohort_trips: DataFrame, year: int) -> DataFrame:
    return trips.with_demographics(
        trips.trip_credits(cohort_trips, src["ledger"], src["member_xref"], year),
        src["trip_demo"], since=date(year, 1, 1), until=date(year, 12, 31))


def prior_year(src: Tables, cohort_trips: DataFrame, year: int,
               share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(combined history, guests with special promotions only) of the year before."""
    described = described_trips(src, cohort_trips, year - 1)
    periods = materialize(history.customer_history(
        described, tiers.promotions(src["tier_history"], year - 1), year - 1), "prior_periods")
    combined, special = history.guest_history(
        periods, src["reason_enum"], src["member_xref"], src["activity"], year - 1, share)
    return materialize(combined, "history"), special


def model_year(src: Tables, cohort_trips: DataFrame, year: int):
    """(trips with their next promotion, natural promotions, special-only guests).

    The frames of one row per promotion or guest are small next to the ledger and used more
    than once, so they are kept.
    """
    with_next = materialize(trips.with_next_promotion(
        described_trips(src, cohort_trips, year), tiers.promotions(src["tier_history"], year),
        year), "trips")
    natural, special = history.year_promotions(
        history.trip_rollup_by_promotion(with_next), src["reason_enum"], src["member_xref"],
        src["activity"], year)
    return with_next, natural, special


def returning_rows(src: Tables, cohort_trips: DataFrame, year: int,
                   share: float = 0.8) -> DataFrame:
    combined, hist_special = prior_year(src, cohort_trips, year, share)
    with_next, natural, special = model_year(src, cohort_trips, year)
    return days.drop_inconsistent(materialize(days.day_features(
        src["ledger"], src["member_xref"], with_next, natural, special, year, combined,
        hist_special), "returning_days"))


def new_guest_rows(src: Tables, cohort_trips: DataFrame, year: int) -> DataFrame:
    with_next, natural, special = model_year(src, cohort_trips, year)
    rows = days.day_features(src["ledger"], src["member_xref"], with_next, natural, special, year)
    return days.drop_inconsistent(materialize(rows, "new_days"))


def conforming(src: Tables) -> Tables:
    """The tables of ``PLAN_SOURCES`` by their contracts; player days in place of a ledger and trips
    in place of visits stay."""
    return {name: df if "day" in df.columns or "trip_id" in df.columns else conform(df, PLAN_SOURCES[name]) for name, df in src.items()}


def visitors(src: Tables, cohort: Cohort, returning: bool) -> DataFrame:
    """Guests who can be in the cohort, by their visits alone."""
    at = visits.at_property(rolled_trips(src, cohort, since=date(cohort.year - 1, 1, 1)), cohort.property)
    return (visits.returning_guests(at, cohort.year) if returning
            else visits.starting_in(at, cohort.year).select("guest_id"))


def of_guests(src: Tables, guests: DataFrame) -> Tables:
    """Tables with the rows of some guests and of their players only, so that nothing else is
    aggregated or placed afterwards. The bridge is kept, as every table of players reads it."""
    guests = keys_of(guests, "guest_id")
    bridge = materialize(src["member_xref"].join(guests, "guest_id", "left_semi"), "bridge")
    players = keys_of(bridge, "player_id")

    def mine(name: str, keys: DataFrame, key: str) -> DataFrame:
        return src[name].join(keys, key, "left_semi")

    return {**src, "member_xref": bridge, "ledger": mine("ledger", players, "player_id"),
            "tier_history": mine("tier_history", players, "player_id"),
            "activity": mine("activity", players.withColumnRenamed("player_id", "loyalty_id"), "loyalty_id"),
            "visit": mine("visit", guests, "guest_id"), "trip_demo": mine("trip_demo", guests, "guest_id")}


def kept_days(src: Tables, cohort: Cohort) -> Tables:
    """``with_player_days``, and player days that were there already are kept as well."""
    kept = with_player_days(src, cohort)
    return {**kept, "ledger": materialize(kept["ledger"], "player_days")} if "day" in src["ledger"].columns else kept


def cohort_sequences(src: Tables, cohort: Cohort, returning: bool):
    """(scaler, padded sequences) from source tables.

    Visits are rolled up once; their trips tell who can be in the cohort, and these guests are kept,
    as every table is cut down to them, the ledger before its one pass. What is written on the way is deleted; the sequences stay.
    """
    src = conforming(src)
    with milestones() as result:
        src = with_trips(src, cohort)
        guests = materialize(visitors(src, cohort, returning).distinct(), "visitors")
        src = kept_days(of_guests(src, guests), cohort)
        chosen = materialize((returning_trips if returning else new_trips)(src, cohort), "chosen")
        rows = (returning_rows if returning else new_guest_rows)(of_guests(src, chosen), chosen, cohort.year)
        scaler, padded = training_sequences(materialize(rows, "rows"), returning)
        return scaler, result(padded, "sequences")


def training_sequences(rows: DataFrame, returning: bool, scaler=None):
    """(scaler, padded sequences) of labelled day rows.

    Seven tenths of the never-promoted returning guests are left out, half of the new ones.
    """
    names = RETURNING_FEATURES if returning else NEW_GUEST_FEATURES
    scaler = scaler or features.fit_scaler(rows, names)
    scaled = features.apply_scaler(scaler, rows, names)
    kept = days.without_promotion_day(
        features.thin_out_negatives(scaled, 0.7 if returning else 0.5))
    windows = sequences.trailing_windows(kept, features.scaled_names(names), anchors=sequences.BEFORE_YEAR_END)
    return scaler, sequences.padded(windows, len(names))
