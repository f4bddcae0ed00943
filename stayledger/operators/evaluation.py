"""Quality of scores, and who the false positives are."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.operators.scale import materialize

#: Distinct scores of a range, about.
RANGE_SCORES = 50_000


def _score_groups(scores: DataFrame, range_scores: int = RANGE_SCORES) -> DataFrame:
    """Positives and negatives per distinct score, with the score range they belong to.

    There are as many ranges as there are ``range_scores`` distinct scores; their bounds only
    spread the work and do not touch the result. Null and NaN scores have no rank: they fail
    the job.
    """
    ranked = F.when(F.col("score").isNull() | F.isnan("score"), F.raise_error(
        F.lit("scores to rank must be numbers, found null or NaN")).cast("double")).otherwise(
            F.col("score").cast("double"))
    groups = materialize(scores.groupBy(ranked.alias("score")).agg(
        F.sum(F.col("label").cast("long")).alias("pos"),
        F.sum((1 - F.col("label")).cast("long")).alias("neg")))
    parts = -(-groups.count() // range_scores)
    cuts = sorted(set(groups.approxQuantile(
        "score", [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else [0.0]
    return Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="score",
                      outputCol="part").transform(groups)


def _part_totals(groups: DataFrame) -> DataFrame:
    """Totals per range, with those of all higher ranges; a row for each range."""
    per_part = groups.groupBy("part").agg(
        F.sum("pos").alias("part_pos"), F.sum("neg").alias("part_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("head"))
    falling = Window.partitionBy(F.lit(0)).orderBy(F.desc("part"))
    above = falling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    return per_part.select(
        "part",
        F.coalesce(F.sum("part_pos").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("part_neg").over(above), F.lit(0)).alias("neg_above"),
        F.sum("part_pos").over(everything).alias("positives"),
        F.sum("part_neg").over(everything).alias("negatives"),
        F.lead("head").over(falling).alias("next_head"))


def roc_points(scores: DataFrame, drop_collinear: bool = True,
               range_scores: int = RANGE_SCORES) -> DataFrame:
    """Rates at every distinct score, taken as the lowest score called positive.

    Point 0 is the origin, at an infinite threshold, and all there is without scores. Points
    inside a straight run can be dropped; the indexes count the points that are left.
    """
    groups = _score_groups(scores, range_scores)
    totals = _part_totals(groups)
    falling = Window.partitionBy("part").orderBy(F.desc("score"))
    so_far = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nxt = F.coalesce(F.lead(F.struct("pos", "neg")).over(falling), F.col("next_head"))
    points = (groups.join(F.broadcast(totals), "part")
              .withColumn("tp", F.col("pos_above") + F.sum("pos").over(so_far))
              .withColumn("fp", F.col("neg_above") + F.sum("neg").over(so_far))
              .withColumn("next", nxt))
    if drop_collinear:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        last = F.col("next").isNull()
        bend = (F.col("next.pos") != F.col("pos")) | (F.col("next.neg") != F.col("neg"))
        points = points.where(first | last | bend)
    kept = points.groupBy("part").agg(F.count("*").alias("_kept"))
    before = kept.select("part", F.coalesce(F.sum("_kept").over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("part")).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    curve = points.join(F.broadcast(before), "part").select(
        (F.col("_before") + F.row_number().over(falling)).alias("point"),
        F.col("score").alias("threshold"), "tp", "fp",
        F.try_divide(F.col("tp"), F.col("positives")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("negatives")).alias("fpr"))
    origin = scores.sparkSession.range(1).select(
        F.col("id").alias("point"), F.lit(float("inf")).alias("threshold"),
        F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
        F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return origin.unionByName(curve)


def first_point_below(points: DataFrame, threshold: float) -> DataFrame:
    """First point of a curve whose threshold is below a value."""
    below = points.where(F.col("threshold") < threshold)
    return below.groupBy().agg(F.min("point").alias("point"),
                               F.min_by("fpr", "point").alias("fpr"),
                               F.min_by("tpr", "point").alias("tpr"))


def auc(scores: DataFrame, range_scores: int = RANGE_SCORES) -> DataFrame:
    """Area under the ROC curve: chance that a positive outranks a negative, ties half.

    The pairs are counted in whole numbers, so that the value does not depend on the
    order of the work. Without scores, or with one class only, the area is null.
    """
    groups = _score_groups(scores, range_scores)
    falling = Window.partitionBy("part").orderBy(F.desc("score"))
    so_far = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    neg_from = F.col("neg_above") + F.sum("neg").over(so_far)
    below = (F.col("negatives") - F.col("_neg_from")).cast("decimal(19,0)")
    won = F.col("pos").cast("decimal(18,0)") * (2 * below + F.col("neg")).cast("decimal(19,0)")
    return (groups.join(F.broadcast(_part_totals(groups)), "part")
            .withColumn("_neg_from", neg_from)
            .groupBy().agg(F.sum(won).alias("_won"), F.max("positives").alias("positives"),
                           F.max("negatives").alias("negatives"))
            .select("positives", "negatives", F.try_divide(
                F.col("_won").cast("double"),
                2.0 * F.col("positives") * F.col("negatives")).alias("auc")))


def threshold_metrics(scores: DataFrame, thresholds: list[float], days: int = 364) -> DataFrame:
    """Hit rate, false-alarm rate and alerts per day above each threshold, in one pass."""
    rows = []
    for t in thresholds:
        above = F.col("score") > t

        def n(condition):
            return F.sum(F.when(condition, 1).otherwise(0))

        rows.append(F.struct(
            F.lit(float(t)).alias("threshold"),
            F.try_divide(n(above & (F.col("label") == 1)), n(F.col("label") == 1)).alias("tpr"),
            F.try_divide(n(above & (F.col("label") == 0)), n(F.col("label") == 0)).alias("fpr"),
            (n(above) / days).alias("alerts_per_day")))
    return scores.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def with_score_counts(scores: DataFrame) -> DataFrame:
    """Scores with the number of scores of their guest; at most one per guest and day."""
    return scores.withColumn("guest_scores", F.count("*").over(Window.partitionBy("guest_id")))


def false_positive_rows(rows: DataFrame, scores: DataFrame, above: float = 0.5) -> DataFrame:
    """Scored day rows of never-promoted guests who exceed a score at least once.

    The scored rows are kept once; one aggregation tells both about a guest.
    """
    known = scores.drop("label", "day").withColumn("_scored", F.lit(True))
    scored = materialize(rows.join(known, ["guest_id", "days_left"], "left"), "scored")
    chosen = scored.groupBy("guest_id").agg(
        F.max("label").alias("_positive"), F.max("score").alias("_top")).where(
        (F.coalesce("_positive", F.lit(0)) == 0) & (F.col("_top") > above))
    return scored.where("_scored").drop("_scored").join(
        chosen.select("guest_id"), "guest_id", "left_semi")


def false_positive_profile(fp_rows: DataFrame, profiles: DataFrame,
                           regional: DataFrame) -> DataFrame:
    return fp_rows.join(profiles, "guest_id").join(regional, "guest_id")


def with_win_loss(rows: DataFrame, trip_results: DataFrame) -> DataFrame:
    """Rows with the result of every trip that covers their day."""
    t = trip_results.withColumnRenamed("guest_id", "_guest")
    inside = (F.col("guest_id") == F.col("_guest")) & F.col("day").between(
        F.col("trip_start"), F.col("trip_end"))
    return rows.join(t, inside).drop("_guest")


def guests_by_game(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("guest_id").agg(F.max("game_type").alias("game"))
            .groupBy("game").agg(F.count("*").alias("guests")))


def count_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("rows"))


def distinct_guests(rows: DataFrame) -> DataFrame:
    return rows.agg(F.countDistinct("guest_id").alias("guests"))


def linked_account_guests(linked: DataFrame, xref: DataFrame, rows: DataFrame) -> DataFrame:
    """Number of distinct guest entries per account that links guests of a cohort."""
    cohort = rows.select("guest_id").distinct()
    return (linked.join(xref.select("player_id", "guest_id"), "player_id")
            .join(cohort, "guest_id", "left_semi")
            .select("account_id", "guest_id", "credits_earned").distinct()
            .groupBy("account_id").agg(F.count("*").alias("guests")))
