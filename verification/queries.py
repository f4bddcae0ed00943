"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import cached_property

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions import codes
from stayledger.operators import (
    days, evaluation, features, history, ledger, scale, scoring, sequences, tiers, trip_models,
    trips, visits)
from stayledger.plans import evaluation as back_test
from stayledger.plans import inference, training
from stayledger.schemas import NEW_GUEST_FEATURES, RETURNING_FEATURES
from stayledger.sources import tables
from verification.shape import shape
from verification.standins import ONLINE, PROPERTY, SHARE, SYSTEM, StandIns

HIST, YEAR = 2023, 2024
EVENT_FEATURES = ("credits", "days_left", "day_no", "running_credits")
WEIGHTS, BIAS = (1.5, -2.0, 0.5, 3.0), -1.0
#: Dates of the daily run: four weeks of the year, and the first day of the next one.
AS_OF = (*(date(2024, 6, 3) + timedelta(days=k) for k in range(28)), date(2025, 1, 1))
MODEL_BIAS = -0.5


def model_weights(names):
    return tuple((i % 5 - 2) / 2 for i in range(len(names)))


COHORT = training.Cohort(PROPERTY, YEAR, ONLINE, SHARE)
#: Whom whole runs train on and score: those with a tenth of their credits at the property.
WIDE = training.Cohort(PROPERTY, YEAR, ONLINE, 0.1)

SPECS: dict[str, str] = {}
BODIES: dict[str, Callable[["Flow"], DataFrame]] = {}


def query(spec: str):
    def register(body):
        SPECS[body.__name__] = spec
        BODIES[body.__name__] = body
        return body
    return register


class Flow:
    """Intermediate frames of the stand-in tables; all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: StandIns | None = None):
        self.spark = scale.tune(spark)
        self.x = tables or StandIns(spark, sf_dir)

    @cached_property
    def base(self):
        return visits.visit_base(self.x.visits)

    @cached_property
    def rolled(self):
        return visits.roll_up_trips(self.base, online_brand=ONLINE, until=date(YEAR, 12, 31))

    @cached_property
    def days(self):
        """The stand-in tables with player days in place of the ledger."""
        return training.with_player_days(self.x.tables, COHORT)

    @cached_property
    def kept_rolled(self):
        return scale.materialize(self.rolled, "rolled")

    @cached_property
    def here(self):
        return visits.at_property(self.rolled, PROPERTY)

    @cached_property
    def kept_hist_trips(self):
        return scale.materialize(
            training.described_trips(self.days, self.kept_rolled, HIST), "trips")

    def described(self, year):
        return training.described_trips(self.days, self.rolled, year)

    def promotions(self, year):
        return tiers.promotions(self.x.tier_history, year)

    @cached_property
    def periods(self):
        return scale.materialize(history.customer_history(
            self.kept_hist_trips, self.promotions(HIST), HIST), "periods")

    @cached_property
    def labelled_hist(self):
        return history.with_reason_labels(self.periods, self.x.enum)

    @cached_property
    def natural_hist(self):
        return history.natural_promotions_of_history(
            self.periods, self.x.enum, self.x.xref, self.x.activity, HIST)

    @cached_property
    def hist(self):
        return tuple(scale.materialize(part, "hist") for part in history.guest_history(
            self.periods, self.x.enum, self.x.xref, self.x.activity, HIST))

    @cached_property
    def next_promotions(self):
        described = training.described_trips(self.days, self.kept_rolled, YEAR)
        return scale.materialize(trips.with_next_promotion(
            described, self.promotions(YEAR), YEAR), "next")

    @cached_property
    def rollup(self):
        return history.trip_rollup_by_promotion(self.next_promotions)

    @cached_property
    def model(self):
        return history.year_promotions(
            self.rollup, self.x.enum, self.x.xref, self.x.activity, YEAR)

    @cached_property
    def numbered(self):
        return trips.number_trips(self.next_promotions)

    @cached_property
    def first_features(self):
        return trip_models.first_trip_features(
            self.numbered, self.hist[0], self.model[1], self.hist[1], YEAR)

    @cached_property
    def first_labelled(self):
        return trip_models.label_by_promotion(self.first_features, self.model[0], 1)

    @cached_property
    def kept_first(self):
        return scale.materialize(self.first_labelled, "first")

    @cached_property
    def day_rows(self):
        natural, special = self.model
        combined, hist_special = self.hist
        return days.day_features(self.days["ledger"], self.x.xref, self.next_promotions, natural,
                                 special, YEAR, combined, hist_special)

    @cached_property
    def new_rows(self):
        natural, special = self.model
        return days.day_features(
            self.days["ledger"], self.x.xref, self.next_promotions, natural, special, YEAR)

    @cached_property
    def returning_model_rows(self):
        return scale.materialize(
            training.returning_rows(self.days, self.kept_rolled, YEAR), "returning")

    @cached_property
    def new_model_rows(self):
        return scale.materialize(
            training.new_guest_rows(self.days, self.kept_rolled, YEAR), "new")

    @property
    def stored(self):
        """The stand-in tables with the stored player days and trips, which daily runs and the
        trainings before them share."""
        if self.x.stored_trips is None:
            self.x.stored_trips = training.with_trips(training.conforming(self.x.tables), WIDE)["visit"]
        return {**self.x.tables, "ledger": self.x.player_days, "visit": self.x.stored_trips}

    def trained_on_cohort(self, returning, stored=False):
        """(path of the stored scaler, sequences) of the training plan, from the tables or from
        those with stored player days and trips; kept with the tables."""
        if (returning, stored) not in self.x.trained:
            scaler, windows = training.cohort_sequences(self.stored if stored else self.x.tables, WIDE, returning)
            path = scale.work_path(self.spark, "scaler")
            tables.save_scaler(scaler, path)
            self.x.trained[returning, stored] = path, windows
        return self.x.trained[returning, stored]

    def daily_run(self, returning):
        """Scores of the daily run over the stored player days, and the path of its log."""
        names = RETURNING_FEATURES if returning else NEW_GUEST_FEATURES
        log = scale.work_path(self.spark, "run_log")
        return inference.daily_run(
            self.stored, WIDE, AS_OF, self.trained_on_cohort(returning, stored=True)[0],
            scoring.LinearScorer(model_weights(names), MODEL_BIAS), 0.4, returning, log), log

    def simulated(self, returning):
        """Back-test scores in whole millionths, kept."""
        rows = self.returning_model_rows if returning else self.new_model_rows
        names = RETURNING_FEATURES if returning else NEW_GUEST_FEATURES
        scores = back_test.simulate(rows, features.fit_scaler(rows, names),
                                    scoring.LinearScorer(model_weights(names), MODEL_BIAS), names)
        return scale.materialize(scores.withColumn("score", F.round("score", 6)), "simulated")

    @cached_property
    def simulated_new(self):
        return self.simulated(False)

    # the event stream as active days

    @cached_property
    def daily(self):
        return days.daily_credits(self.x.event_ledger, self.x.event_xref, YEAR)

    @cached_property
    def running(self):
        return scale.materialize(days.number_days(self.daily), "running")

    @cached_property
    def in_trips(self):
        return days.within_trips(self.running, self.x.day_trips)

    @cached_property
    def natural_days(self):
        return self.x.day_promotions.where(~F.col("is_special"))

    @cached_property
    def labelled_days(self):
        return days.with_labels(
            self.in_trips, days.promotion_intervals(self.natural_days, YEAR), YEAR)

    @cached_property
    def scores(self):
        """Score of every active day from credits so far and days left."""
        near = F.col("day").between(F.date_add(F.to_date("changed_at"), -6),
                                    F.to_date("changed_at"))
        logit = (F.col("running_credits").cast("double") / 20000.0
                 - F.col("days_left") / F.lit(365.0))
        return (self.running.join(
            self.x.day_promotions.select("guest_id", "changed_at"), "guest_id", "left")
            .select("guest_id", "day", "days_left",
                    F.round(codes.sigmoid(logit), 6).alias("score"),
                    F.when(near, 1).otherwise(0).alias("label")))

    @cached_property
    def scored_rows(self):
        return self.running.join(self.scores.select("guest_id", "day", "label"),
                                 ["guest_id", "day"])

    @cached_property
    def fp(self):
        return evaluation.false_positive_rows(self.scored_rows, self.scores)

    @cached_property
    def fp_profiles(self):
        return evaluation.false_positive_profile(self.fp, self.x.profiles, self.x.regional)

    @cached_property
    def trained(self):
        names = features.scaled_names(EVENT_FEATURES)
        rows = self.scaled.join(self.scores.select("guest_id", "day", "label"), ["guest_id", "day"])
        windows = scale.materialize(features.guest_split(
            sequences.padded(sequences.trailing_windows(rows, names), len(names))))
        return windows, scoring.train_classifier(windows.where(F.col("side") == "train"))

    @cached_property
    def scaled(self):
        model = features.fit_scaler(self.running, EVENT_FEATURES)
        return features.apply_scaler(model, self.running, EVENT_FEATURES)


# codes ----------------------------------------------------------------------------------

@query("activity_id:b activity_at:c local_at:c"
       " member_id:b location_id:b created_at:c activity_status:s activity_type:s lob:s"
       " user_id:s loyalty_id:s delete_flag:s")
def utc_to_pacific(f):
    return f.x.activity.withColumn("local_at", codes.to_pacific("activity_at"))


@query("activity_id:b lob:s lob_group:s"
       " member_id:b location_id:b activity_at:c created_at:c activity_status:s"
       " activity_type:s user_id:s loyalty_id:s delete_flag:s")
def lob_rollup(f):
    return f.x.activity.withColumn("lob_group", codes.lob_group("lob", "user_id", SYSTEM))


@query("player_id:s changed_at:c tier_before:b tier_after:b"
       " tier_from:s tier_to:s tier_reason:s tier_sub_reason:s change_reason:s"
       " change_sub_reason:s")
def tier_ordinal(f):
    return tiers.ranked_changes(f.x.tier_history)


@query("guest_id:b trip_id:s trip_tier:b target:b strict_target:b"
       " trip_start:t trip_end:t departments:b property:s gaming_days:b start_tier:s")
def target_ladder(f):
    return f.rolled.withColumn("trip_tier", codes.coded_number("start_tier")).withColumns({
        "target": codes.target_credits("trip_tier"),
        "strict_target": codes.target_credits("trip_tier", otherwise=0)})


@query("guest_id:b success_trips:b bucket:b")
def promo_trip_buckets(f):
    counts = f.rolled.groupBy("guest_id").agg(F.count("*").alias("success_trips"))
    return counts.withColumn("bucket", codes.promo_trip_bucket("success_trips"))


# ledger and tier history ------------------------------------------------------------------

@query("player_id:s ts:c credits:d site_name:s lob_group:s")
def ledger_build(f):
    x = f.x
    return ledger.build_ledger(x.activity, x.items, x.locations, x.id_map, x.policies, YEAR,
                               system_user_prefix=SYSTEM)


_CHANGE = ("member_id:b player_id:s enrolled_at:c tier_from:s tier_to:s changed_at:c "
           "current_tier:s current_tier_at:c tier_reason:s tier_sub_reason:s change_reason:s "
           "change_sub_reason:s")


@query(_CHANGE)
def tiers_without_history(f):
    x = f.x
    return tiers.members_without_history(x.members, x.member_tiers, x.member_tier_history,
                                         x.id_map)


@query(_CHANGE)
def tiers_with_history(f):
    x = f.x
    return tiers.members_with_history(x.members, x.member_tiers, x.member_tier_history, x.id_map)


@query("member_id:b changed_at:c survivor_id:b"
       " player_id:s enrolled_at:c tier_from:s tier_to:s current_tier:s current_tier_at:c"
       " tier_reason:s tier_sub_reason:s change_reason:s change_sub_reason:s")
def survivor_lookup(f):
    return tiers.with_survivor(tiers_with_history(f), f.x.merged)


_HISTORY = ("player_id:s enrolled_at:c tier_from:s tier_to:s changed_at:c current_tier:s "
            "current_tier_at:c survivor_player_id:b tier_reason:s tier_sub_reason:s "
            "change_reason:s change_sub_reason:s")


@query(_HISTORY)
def tier_history_build(f):
    x = f.x
    return tiers.build_tier_history(x.members, x.member_tiers, x.member_tier_history, x.id_map,
                                    x.merged)


@query("step:s latest:c row_count:b")
def freshness(f):
    return tables.freshness(f.x.ledger, "ledger", "ts").unionByName(
        tables.freshness(f.x.tier_history, "tier_history", "changed_at"))


@query("player_id:s ts:c credits:d calendar_year:b"
       " site_name:s lob_group:s")
def ledger_sink_roundtrip(f):
    path = scale.work_path(f.spark, "ledger")
    tables.write_by_year(f.x.ledger, path, "ts")
    return f.spark.read.parquet(path).where(F.col("calendar_year") == YEAR)


@query("guest_id:b ts:c credits:d running_credits:d"
       " player_id:s site_name:s lob_group:s")
def ledger_running(f):
    return ledger.ledger_running(f.x.ledger, f.x.xref)


@query("player_id:s guest_id:b credits:d rows:b")
def member_xref(f):
    per_player = f.x.ledger.groupBy("player_id").agg(
        F.sum("credits").alias("credits"), F.count("*").alias("rows"))
    return ledger.with_guest(per_player, f.x.xref)


# visits and cohorts -----------------------------------------------------------------------

@query("guest_id:b property:s department:s trip_start:t trip_end:t start_tier:s gaming_days:b "
       "segment:s site:s month:t"
       " site_group:s net_gaming_revenue:d")
def visit_base(f):
    return f.base


_TRIP = ("guest_id:b trip_start:t trip_end:t trip_id:s departments:b property:s gaming_days:b "
         "start_tier:s")


@query(_TRIP)
def trip_rollup(f):
    return f.rolled


@query(_TRIP)
def property_trips(f):
    return f.here


@query("guest_id:b")
def returning_cohort(f):
    return visits.returning_guests(f.here, YEAR)


@query(_TRIP)
def new_cohort(f):
    return visits.new_guest_trips(f.here, YEAR)


@query("guest_id:b")
def dominant_players(f):
    return visits.dominant_guests(ledger.of_years(f.x.ledger, HIST, YEAR), f.x.xref, PROPERTY, SHARE)


@query("guest_id:b")
def any_property_players(f):
    return visits.guests_with_credits(ledger.of_years(f.x.ledger, YEAR), f.x.xref, PROPERTY)


@query(_TRIP)
def cohort_trips(f):
    return training.returning_trips(f.days, COHORT)


@query(_TRIP)
def new_cohort_trips(f):
    return training.new_trips(f.days, COHORT)


@query(_TRIP)
def in_house_on(f):
    return visits.in_house_on(f.here, date(2024, 1, 26))


@query("guests:b")
def distinct_guests(f):
    return evaluation.distinct_guests(f.rolled)


@query("guest_id:b changed_at:c tier_from:s tier_to:s tier_before:b tier_after:b")
def cohort_tier_changes(f):
    return tiers.changes_of_guests(f.x.tier_history, f.x.xref,
                                   training.new_trips(f.x.tables, COHORT), YEAR)


@query("event_id:b user_id:b event_type:s ts:c value:d props:s")
def newest_folder(f):
    """Two dated folders, of which the newest alone is read."""
    root, day = scale.work_path(f.spark, "snapshots"), F.to_date("ts")
    events = f.x.t("events")
    for name in ("2024-01-10", "2024-01-20"):
        tables.write(events.where(day <= name), f"{root}/{name}")
    return tables.read(f.spark, tables.newest_snapshot(f.spark, root))


@query("event_id:b snapshot:t user_id:b event_type:s"
       " ts:c value:d props:s")
def latest_snapshot(f):
    """A table with a snapshot for each day of events, of which the newest one is read."""
    path = scale.work_path(f.spark, "snapshots")
    tables.write_snapshot(f.x.t("events").withColumn("snapshot", F.to_date("ts")).repartition("snapshot"), path, "snapshot")
    return tables.newest_partition(f.spark, path, "snapshot")


@query("player_id:s ts:c credits:d calendar_year:b site_name:s lob_group:s")
def ledger_rewritten_year(f):
    """Two years, of which the second one is written again with its non-gaming items alone."""
    path = scale.work_path(f.spark, "ledger")
    tables.write_by_year(ledger.of_years(f.x.ledger, HIST, YEAR), path, "ts")
    tables.write_by_year(ledger.of_years(f.x.ledger, YEAR).where("lob_group = 'Non-Gaming'"), path, "ts")
    return f.spark.read.parquet(path)


@query("step:s latest:c row_count:b")
def observed_write(f):
    """What the write of a table has counted for the run log."""
    return tables.write_observed(f.x.ledger, scale.work_path(f.spark, "ledger"), "ledger", "ts")


@query(_TRIP)
def table_roundtrip(f):
    name = "trips_" + scale.work_path(f.spark, "t").rsplit("-", 1)[1]
    tables.save_table(f.rolled, name, path=scale.work_path(f.spark, name))
    return tables.read(f.spark, name, fmt="table")


# trips, credits, promotions ------------------------------------------------------------------

_CREDITS = ("guest_id:b player_id:s trip_id:s trip_start:t trip_end:t property:s credits:d "
            "tier:s gaming_credits:d non_gaming_credits:d")


@query(_CREDITS)
def trip_credits(f):
    return trips.trip_credits(f.rolled, f.x.ledger, f.x.xref, HIST)


_DEMO = _CREDITS + " gender:s age:b location:s lodging:s tenure:b"


@query(_DEMO)
def trip_demo_join(f):
    return f.described(HIST)


@query("player_id:s tier_before:b tier_after:b changed_at:c tier_reason:s tier_sub_reason:s "
       "change_reason:s change_sub_reason:s")
def promotions_year(f):
    return f.promotions(HIST)


_PROMO = (_DEMO + " tier_before:b tier_after:b changed_at:c prev_changed_at:c tier_reason:s "
          "tier_sub_reason:s change_reason:s change_sub_reason:s calendar_year:b")


@query(_PROMO)
def trip_promo_fanout(f):
    return trips.with_later_promotions(f.described(HIST), f.promotions(HIST), HIST)


@query("guest_id:b player_id:s trip_id:s trip_start:t trip_end:t credits:d lodging:s "
       "first_promoted_at:c last_promoted_at:c later_promotions:b calendar_year:b")
def trip_promo_ranges(f):
    return trips.with_promotion_ranges(f.described(HIST), f.promotions(HIST), HIST)


@query(_PROMO)
def trip_promo_disjoint(f):
    return trips.with_next_promotion(f.described(YEAR), f.promotions(YEAR), YEAR)


# history ----------------------------------------------------------------------------------

_PERIOD = ("guest_id:b calendar_year:b changed_at:c trips:b credits:d gaming_credits:d "
           "non_gaming_credits:d tier:s promo_tier:b tier_reason:s tier_sub_reason:s "
           "change_reason:s change_sub_reason:s trip_tier:b target_credits:b")


@query(_PERIOD + " first_trip_age:b trip_days:b lodger_trips:b local_trips:b drop_in_trips:b")
def customer_history(f):
    return history.customer_history(f.kept_hist_trips, f.promotions(HIST), HIST)


@query(_PERIOD + " tier_after:b")
def train_rollup(f):
    return f.rollup


_LABELS = "tier_label:s tier_sub_label:s change_label:s change_sub_label:s"


@query("guest_id:b changed_at:c " + _LABELS
       + " change_sub_reason:s change_reason:s tier_sub_reason:s tier_reason:s trips:b"
       " trip_days:b credits:d gaming_credits:d non_gaming_credits:d lodger_trips:b"
       " local_trips:b drop_in_trips:b tier:s promo_tier:b calendar_year:b"
       " first_trip_age:b trip_tier:b target_credits:b")
def reason_labels(f):
    return f.labelled_hist


@query("player_id:s created_at:c")
def set_tier(f):
    return history.set_tier_activity(f.x.activity, HIST)


@query("guest_id:b player_id:s changed_at:c trips:b credits:d promo_tier:b tier_after:b "
       + _LABELS
       + " change_sub_reason:s change_reason:s tier_sub_reason:s tier_reason:s"
       " calendar_year:b gaming_credits:d non_gaming_credits:d tier:s trip_tier:b"
       " target_credits:b")
def natural_promotions(f):
    return f.model[0]


@query("guest_id:b player_id:s changed_at:c trips:b credits:d earned_share:r " + _LABELS
       + " change_sub_reason:s change_reason:s tier_sub_reason:s tier_reason:s trip_days:b"
       " gaming_credits:d non_gaming_credits:d lodger_trips:b local_trips:b"
       " drop_in_trips:b tier:s promo_tier:b calendar_year:b first_trip_age:b trip_tier:b"
       " target_credits:b")
def natural_promotions_hist(f):
    return f.natural_hist


_BEST = ("guest_id:b top_tier:b gaming_credits:d non_gaming_credits:d credits:d trips:b "
         "trip_days:b first_trip_age:b lodger_trips:b local_trips:b")


@query(_BEST)
def hist_success(f):
    return history.promoted_history(f.natural_hist)


@query(_BEST)
def hist_unsuccess(f):
    return history.unpromoted_history(f.periods)


_COMBINED = ("top_tier:b gaming_share:r non_gaming_share:r hist_credits:d hist_trips:b "
             "hist_trip_days:b hist_first_trip_age:b lodger_share:r local_share:r")


@query("guest_id:b " + _COMBINED)
def hist_combined(f):
    return f.hist[0]


@query("guest_id:b")
def special_only_guests(f):
    return f.hist[1]


# trip models --------------------------------------------------------------------------------

@query("guest_id:b trip_id:s trip_start:t changed_at:c credits:d trip_no:b running_credits:d"
       " trip_end:t player_id:s property:s tier:s gaming_credits:d non_gaming_credits:d"
       " gender:s age:b location:s lodging:s tenure:b tier_before:b tier_after:b"
       " tier_reason:s tier_sub_reason:s change_reason:s change_sub_reason:s"
       " prev_changed_at:c calendar_year:b")
def trip_sequence(f):
    return f.numbered


_TRIP_FEATURES = ("guest_id:b days_left:b credits:d gaming_credits:d non_gaming_credits:d "
                  "gender:s age:b location:s target_credits:b " + _COMBINED)


@query(_TRIP_FEATURES)
def first_trip_features(f):
    return f.first_features


@query(_TRIP_FEATURES)
def second_trip_features(f):
    return trip_models.second_trip_features(f.numbered, f.hist[0], YEAR)


@query(_TRIP_FEATURES + " success_trips:b label:b")
def first_trip_label(f):
    return f.first_labelled


@query(_TRIP_FEATURES + " success_trips:b label:b")
def second_trip_label(f):
    return trip_models.label_by_promotion(second_trip_features(f), f.model[0], 2)


@query("guest_id:b trip_no:b trip_start:t running_credits:d days_left:b changed_at:c "
       "prev_changed_at:c tier:b target_credits:b label:b"
       " trip_end:t hist_credits:d age:b gender:s gaming_share:r non_gaming_share:r"
       " hist_trips:b hist_trip_days:b hist_first_trip_age:b lodger_share:r local_share:r")
def trip_labels(f):
    combined, hist_special = f.hist
    natural, special = f.model
    return trip_models.trips_to_promotion(f.numbered, natural, combined, special, hist_special,
                                          YEAR)


# days ---------------------------------------------------------------------------------------

@query("guest_id:b day:t credits:d days_left:b")
def daily_credits(f):
    return f.daily


@query("guest_id:b day:t credits:d days_left:b day_no:b running_credits:d")
def daily_running(f):
    return f.running


@query("guest_id:b day:t credits:d days_left:b")
def day_population(f):
    combined, hist_special = f.hist
    return days.keep_population(days.daily_credits(f.x.ledger, f.x.xref, YEAR), combined,
                                f.model[1], hist_special)


_DAY = "guest_id:b day:t credits:d days_left:b day_no:b running_credits:d trip_length:b trip_day:b"


@query(_DAY + " trip_tier:b lodging:s")
def day_in_trip(f):
    return f.in_trips


@query("guest_id:b prev_changed_on:t changed_on:t promo_tier:b")
def promo_intervals(f):
    return days.promotion_intervals(f.natural_days, YEAR)


_LABELLED = (_DAY + " trip_tier:b promo_tier:b prev_changed_on:t changed_on:t target_credits:b "
             "lodging_code:b label:b")


@query(_LABELLED)
def day_labels(f):
    return f.labelled_days


@query(_LABELLED + " " + _COMBINED)
def day_features(f):
    return f.day_rows


@query(_LABELLED + " lodger_share:r local_share:r")
def day_features_new(f):
    return f.new_rows


@query(_DAY + " lodging_code:b lodger_share:r local_share:r"
       " trip_tier:b prev_changed_on:t changed_on:t promo_tier:b target_credits:b label:b")
def lodging_running_share(f):
    return days.lodging_shares(f.labelled_days)


@query(_LABELLED + " " + _COMBINED)
def drop_inconsistent(f):
    return days.drop_inconsistent(scale.materialize(f.day_rows, "days"))


@query(_LABELLED)
def train_rows(f):
    return days.without_promotion_day(f.labelled_days)


@query("guest_id:b day:t days_left:b credits:d running_credits:d recency:b"
       " day_no:b")
def active_recent6(f):
    return days.latest_of_active(f.running, date(2024, 1, 20))


@query("day:t rows:b")
def active_by_date(f):
    return evaluation.count_by(f.running, "day")


@query("lodging_code:b rows:b")
def active_by_lodging(f):
    return evaluation.count_by(f.labelled_days, "lodging_code")


_INFERENCE = _DAY + " trip_tier:b target_credits:b lodging_code:b"


@query(_INFERENCE + " " + _COMBINED)
def inference_returning(f):
    return inference.returning_rows(f.x.tables, COHORT)


@query(_INFERENCE + " lodger_share:r local_share:r")
def inference_new(f):
    return inference.new_guest_rows(f.x.tables, COHORT)


# sequences ----------------------------------------------------------------------------------

def as_text(df, keys, unit=100):
    """Sequences as text, values in whole parts of a unit, so that arrays compare exactly."""
    row = F.transform("sequence", lambda r: F.array_join(
        F.transform(r, lambda v: F.round(v * unit).cast("long").cast("string")), ","))
    return df.select(*keys, F.array_join(row, ";").alias("steps"), "length")


@query("guest_id:b day:t days_left:b label:b steps:s length:b")
def seq_trailing6(f):
    windows = sequences.trailing_windows(f.scored_rows, EVENT_FEATURES, anchors=sequences.BEFORE_YEAR_END)
    return as_text(windows, ["guest_id", "day", "days_left", "label"])


@query("guest_id:b chunk:b label:b steps:s length:b")
def seq_chunks6(f):
    runs = sequences.chunks(f.scored_rows, EVENT_FEATURES)
    return as_text(runs, ["guest_id", "chunk", "label"])


@query("guest_id:b chunk:b label:b steps:s length:b")
def seq_padded(f):
    runs = sequences.chunks(f.scored_rows, EVENT_FEATURES)
    return as_text(sequences.padded(runs, len(EVENT_FEATURES), pad=-1.0),
                   ["guest_id", "chunk", "label"])


@query("guest_id:b day:t days_left:b label:b steps:s length:b")
def seq_trailing6_overlap(f):
    """Trailing windows where trips overlap and days have several rows."""
    windows = sequences.trailing_windows(
        days.without_promotion_day(f.labelled_days),
        ("credits", "day_no", "trip_length", "trip_day"), anchors=sequences.BEFORE_YEAR_END)
    return as_text(windows, ["guest_id", "day", "days_left", "label"])


# features -----------------------------------------------------------------------------------

_SCALED = "guest_id:b day:t " + " ".join(f"{c}_scaled:r" for c in EVENT_FEATURES)


@query(_SCALED
       + " credits:d days_left:b day_no:b running_credits:d")
def minmax_scale(f):
    return f.scaled


@query(_SCALED
       + " credits:d days_left:b day_no:b running_credits:d")
def scaler_apply_other(f):
    """Scaler of the first half of January applied to the second half."""
    early, late = F.col("day") < date(2024, 1, 16), F.col("day") >= date(2024, 1, 16)
    model = features.fit_scaler(f.running.where(early), EVENT_FEATURES)
    return features.apply_scaler(model, f.running.where(late), EVENT_FEATURES)


@query(_SCALED
       + " credits:d days_left:b day_no:b running_credits:d")
def scaler_reload(f):
    path = scale.work_path(f.spark, "scaler")
    tables.save_scaler(features.fit_scaler(f.running, EVENT_FEATURES), path)
    return features.apply_scaler(tables.load_scaler(path), f.running, EVENT_FEATURES)


@query("guest_id:b day:t label:b"
       " credits:d days_left:b day_no:b running_credits:d")
def negative_downsample(f):
    return features.thin_out_negatives(f.scored_rows, 0.7)


@query("guest_id:b label:b target_credits:b"
       " days_left:b credits:d gaming_credits:d non_gaming_credits:d gender:s age:b"
       " location:s top_tier:b gaming_share:r non_gaming_share:r hist_credits:d"
       " hist_trips:b hist_trip_days:b hist_first_trip_age:b lodger_share:r local_share:r"
       " success_trips:b")
def class_balance(f):
    return features.balance(features.trainable(f.kept_first))


@query("location:s idx:b rows:b")
def category_index(f):
    return features.category_index(f.x.trip_demo, "location")


@query("guest_id:b side:s")
def guest_split(f):
    return features.guest_split(f.running.select("guest_id").distinct())


@query("feature:s n:b mean:r stddev:r lowest:d highest:d")
def feature_profile(f):
    return features.profile(f.running, EVENT_FEATURES)


@query("guest_id:b vector:s label:b")
def location_onehot(f):
    """Feature vectors as text, values in ten-thousandths."""
    rows = features.trip_training_set(f.first_labelled, balanced=False)
    return rows.withColumn("vector", F.array_join(F.transform(
        vector_to_array("features"),
        lambda v: F.round(v * 10000).cast("long").cast("string")), ","))


# scores -------------------------------------------------------------------------------------

@query("guest_id:b day:t score:r"
       " days_left:b length:b")
def score_sequences(f):
    names = features.scaled_names(EVENT_FEATURES)
    windows = sequences.padded(sequences.trailing_windows(f.scaled, names), len(names))
    return scoring.score_sequences(windows, scoring.LinearScorer(WEIGHTS, BIAS),
                                   sequences.STEPS, len(names))


@query("guest_id:b day:t score:d flag:b"
       " days_left:b label:b")
def score_flag(f):
    return scoring.flag(f.scores, 0.5)


@query("guest_id:b day:t days_left:b label:b weight:r side:s steps:s length:b probability:b")
def train_score(f):
    """Training matrix, and whether the classifier trained on four fifths of the guests gives
    each row a probability."""
    windows, model = f.trained
    scores = scoring.classify(model, windows).select(
        "guest_id", "day", F.col("score").between(0, 1).cast("int").alias("probability"))
    weighted = scoring.with_class_weight(windows).join(scores, ["guest_id", "day"])
    return as_text(weighted, ["guest_id", "day", "days_left", "label", "weight", "side", "probability"], 1_000_000)


@query("coefficient:b optimal:b")
def train_optimality(f):
    """Whether the gradient of the training loss vanishes at the fitted coefficients."""
    windows, model = f.trained
    return scoring.loss_gradient(model, windows.where(F.col("side") == "train")).withColumn(
        "optimal", (F.abs("gradient") < 1e-5).cast("int"))


@query("point:b threshold:d tp:b fp:b tpr:r fpr:r")
def roc_points(f):
    return evaluation.roc_points(f.scores, drop_collinear=False)


@query("point:b threshold:d tp:b fp:b tpr:r fpr:r")
def roc_points_sparse(f):
    return evaluation.roc_points(f.scores)


@query("point:b fpr:r tpr:r")
def roc_first_below_half(f):
    return evaluation.first_point_below(evaluation.roc_points(f.scores), 0.5)


@query("positives:b negatives:b auc:d")
def auc(f):
    return evaluation.auc(f.scores)


@query("threshold:d tpr:r fpr:r alerts_per_day:r")
def threshold_metrics(f):
    return evaluation.threshold_metrics(f.scores, [0.15, 0.3, 0.35, 0.5])


@query("guest_id:b day:t score:d guest_scores:b"
       " days_left:b label:b")
def score_counts(f):
    return evaluation.with_score_counts(f.scores)


@query("guest_id:b day:t days_left:b credits:d running_credits:d score:d"
       " day_no:b label:b")
def fp_rows(f):
    return f.fp


@query("guest_id:b day:t score:d game_type:s worth_18m:d enrolled_on:t"
       " days_left:b credits:d day_no:b running_credits:d label:b")
def fp_profile(f):
    return f.fp_profiles


@query("guest_id:b day:t score:d trip_start:t trip_end:t win_loss:d"
       " days_left:b credits:d day_no:b running_credits:d label:b game_type:s"
       " enrolled_on:t worth_18m:r")
def fp_winloss(f):
    return evaluation.with_win_loss(f.fp_profiles, visits.win_loss(f.x.visits))


@query("game:s guests:b")
def fp_by_game(f):
    return evaluation.guests_by_game(f.fp_profiles)


@query("account_id:s guests:b")
def linked_accounts(f):
    return evaluation.linked_account_guests(f.x.linked, f.x.xref, f.running)


# whole runs -----------------------------------------------------------------------------------

_SCORED = "guest_id:b day:t days_left:b length:b score:r flag:b as_of:t"


@query(_SCORED)
def score_active_returning(f):
    return f.daily_run(True)[0]


@query(_SCORED)
def score_active_new(f):
    return f.daily_run(False)[0]


@query("step:s latest:c row_count:b")
def scored_run_log(f):
    """The run log of both kinds of guests, as the daily run has appended it."""
    logs = [f.daily_run(returning)[1] for returning in (True, False)]
    return f.spark.read.parquet(*logs)


_STEPS = "guest_id:b day:t days_left:b label:b steps:s length:b"


@query(_STEPS)
def cohort_sequences_returning(f):
    return as_text(f.trained_on_cohort(True)[1], ["guest_id", "day", "days_left", "label"], 1_000_000)


@query(_STEPS)
def cohort_sequences_new(f):
    return as_text(f.trained_on_cohort(False)[1], ["guest_id", "day", "days_left", "label"], 1_000_000)


def _training_sequences(f, rows, returning):
    _, windows = training.training_sequences(rows, returning)
    path = scale.work_path(f.spark, "sequences")
    tables.write(windows, path)
    return as_text(f.spark.read.parquet(path), ["guest_id", "day", "days_left", "label"], 1_000_000)


@query(_STEPS)
def train_sequences_returning(f):
    return _training_sequences(f, f.returning_model_rows, True)


@query(_STEPS)
def train_sequences_new(f):
    return _training_sequences(f, f.new_model_rows, False)


_SIMULATED = "guest_id:b day:t days_left:b label:b length:b score:r guest_scores:b"


@query(_SIMULATED)
def simulate_scores(f):
    return f.simulated(True)


@query(_SIMULATED)
def simulate_scores_new(f):
    return f.simulated_new


@query("point:b threshold:d tp:b fp:b tpr:r fpr:r")
def simulate_roc(f):
    return back_test.report(f.simulated_new, [0.3])["roc"]


@query("positives:b negatives:b auc:d")
def simulate_auc(f):
    return back_test.report(f.simulated_new, [0.3])["auc"]


@query("threshold:d tpr:r fpr:r alerts_per_day:r")
def simulate_thresholds(f):
    return back_test.report(f.simulated_new, [0.3, 0.35, 0.4])["thresholds"]


@query("guest_id:b day:t days_left:b label:b trip_length:b trip_day:b lodging_code:b target_credits:b "
       "credits:d running_credits:d lodger_share:r local_share:r score:r length:b guest_scores:b")
def fp_model_rows(f):
    """Day rows of never-promoted guests whom the back-test has flagged, with their profile."""
    return evaluation.false_positive_rows(
        days.without_promotion_day(f.new_model_rows), f.simulated_new, 0.4)


@query("lodging_code:b rows:b")
def fp_model_by_lodging(f):
    return evaluation.count_by(fp_model_rows(f), "lodging_code")


def prepare(spark: SparkSession, tables: StandIns) -> None:
    """What a daily run finds in place: stored player days, trips and the scalers of earlier trainings."""
    tables.player_days.count()
    for returning in (True, False):
        Flow(spark, tables.sf_dir, tables).trained_on_cohort(returning, stored=True)


def runnable(tables: StandIns | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries, over the stand-ins of a folder or over ``tables``."""
    def bind(name):
        return lambda spark, sf_dir: shape(BODIES[name](Flow(spark, sf_dir, tables)), SPECS[name])
    return {name: bind(name) for name in BODIES}
