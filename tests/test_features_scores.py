import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger import schemas
from stayledger.operators import evaluation, features, scoring, sequences
from stayledger.sources import tables
from tests.helpers import bag, d, table


def scored(spark, *rows):
    return table(spark, "guest_id bigint, score double, label int",
                 *((i, s, y) for i, (s, y) in enumerate(rows)))


def random_scores(seed, n=400, digits=2):
    rng = random.Random(seed)
    return [(round(rng.random() ** 3, digits), int(rng.random() < .3)) for _ in range(n)]


def curve(rows, drop):
    """Cumulative counts by falling score; straight runs dropped by second differences."""
    steps, tp, fp = [], 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp += sum(y for x, y in rows if x == s)
        fp += sum(1 - y for x, y in rows if x == s)
        steps.append((s, tp, fp))
    if drop:
        bends = [i for i in range(1, len(steps) - 1) if any(
            steps[i + 1][k] - 2 * steps[i][k] + steps[i - 1][k] != 0 for k in (1, 2))]
        steps = [steps[i] for i in sorted({0, len(steps) - 1, *bends})]
    return [(0, math.inf, 0, 0)] + [(i, *step) for i, step in enumerate(steps, start=1)]


@pytest.mark.parametrize("drop", [False, True])
@pytest.mark.parametrize("seed,digits", [(1, 2), (2, 6), (3, 1)])
def test_roc_points(spark, seed, digits, drop):
    rows = random_scores(seed, digits=digits)
    got = evaluation.roc_points(scored(spark, *rows), drop)
    assert sorted(map(tuple, got.select("point", "threshold", "tp", "fp").collect())) == \
        curve(rows, drop)
    last = max(got.collect(), key=lambda r: r.point)
    assert (last.tpr, last.fpr) == (1.0, 1.0)


@pytest.mark.parametrize("seed,digits", [(4, 1), (5, 6)])
def test_auc_counts_pairs(spark, seed, digits):
    rows = random_scores(seed, 150, digits)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    got = evaluation.auc(scored(spark, *rows)).first()
    assert (got.positives, got.negatives) == (len(pos), len(neg))
    assert got.auc == pytest.approx(won / len(pos) / len(neg), abs=1e-12)


def test_auc_agrees_with_the_ml_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = scored(spark, *random_scores(6, 500, 3)).withColumn("label", F.col("label").cast("double"))
    other = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert evaluation.auc(df).first().auc == pytest.approx(other, abs=1e-9)


def test_one_class_only(spark):
    df = scored(spark, (.1, 1), (.2, 1), (.2, 1))
    assert evaluation.auc(df).first().auc is None
    assert [r.fpr for r in evaluation.roc_points(df).where("point > 0").collect()] == [None, None]


def test_all_scores_tied(spark):
    df = scored(spark, *((.5, i % 2) for i in range(10)))
    assert evaluation.auc(df).first().auc == 0.5


def test_first_point_below(spark):
    points = evaluation.roc_points(scored(spark, (.9, 1), (.5, 0), (.4, 1), (.1, 0)), False)
    assert evaluation.first_point_below(points, 0.5).first().point == 3


def test_threshold_is_strict_for_metrics_and_not_for_the_flag(spark):
    df = scored(spark, (.5, 1), (.6, 1), (.5, 0), (.7, 0), (.1, 0))
    m = evaluation.threshold_metrics(df, [0.5]).first()
    assert (m.tpr, m.fpr, m.alerts_per_day) == (0.5, 1 / 3, 2 / 364)
    assert bag(scoring.flag(df, 0.5).where("flag = 1"), "guest_id") == [(0,), (1,), (2,), (3,)]


def test_scaler(spark, tmp_path):
    df = table(spark, "a double, b int", (1.0, 7), (3.0, 7), (2.0, 7))
    model = features.fit_scaler(df, ["a", "b"])
    assert bag(features.apply_scaler(model, df, ["a", "b"]), "a_scaled", "b_scaled") == [
        (0.0, 0.5), (0.5, 0.5), (1.0, 0.5)]
    tables.save_scaler(model, str(tmp_path / "scaler"))
    beyond = features.apply_scaler(tables.load_scaler(str(tmp_path / "scaler")),
                                   table(spark, "a double, b int", (5.0, 9)), ["a", "b"]).first()
    assert (beyond.a_scaled, beyond.b_scaled) == (2.0, 0.5)


def test_thinning_keeps_every_guest_with_a_positive_row(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 2000).alias("guest_id"),
        F.when(F.col("id") < 100, 1).otherwise(0).alias("label"))
    kept = features.thin_out_negatives(rows, 0.7)
    assert kept.where("guest_id < 100").count() == 200
    left = kept.where("guest_id >= 100").select("guest_id").distinct().count()
    assert abs(left / 1900 - 0.3) < 0.05


def test_balance(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("guest_id"), F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("label"))
    n = {r.label: r["count"] for r in features.balance(rows).groupBy("label").count().collect()}
    assert n[1] == 1000 and abs(n[0] - 1000) < 120


def test_split_never_divides_a_guest(spark):
    rows = spark.range(3000).select((F.col("id") % 500).alias("guest_id"))
    sides = features.guest_split(rows).groupBy("guest_id").agg(F.countDistinct("side").alias("n"))
    assert sides.where("n <> 1").count() == 0


def test_category_index_breaks_ties_by_name(spark):
    df = table(spark, "c string", *((x,) for x in ("b", "b", "a", "a", "z", None, "c", "c", "c")))
    assert bag(features.category_index(df, "c"), "c", "idx", "rows") == [
        ("a", 1, 2), ("b", 2, 2), ("c", 0, 3), ("z", 3, 1)]


def test_trip_training_set(spark):
    rows = spark.range(200).select(
        F.col("id").alias("guest_id"), (F.col("id") % 2).cast("int").alias("label"),
        F.concat(F.lit("L"), F.col("id") % 4).alias("location"),
        F.when(F.col("id") % 3 == 0, "F").otherwise("M").alias("gender"),
        F.when(F.col("id") % 2 == 1, 4).alias("success_trips"),
        F.lit(20000).alias("target_credits"),
        *(F.lit(1.0).alias(c) for c in features.ENCODED_FEATURES if c not in (
            "gender_index", "location_vector", "target_credits")))
    got = features.trip_training_set(rows)
    assert {r.label for r in got.select("label").distinct().collect()} == {0, 1}
    assert got.first().features.size == len(features.ENCODED_FEATURES) - 1 + 3


def test_profile(spark):
    got = {r.feature: r for r in features.profile(
        table(spark, "a int, b double", (1, 2.0), (3, None)), ["a", "b"]).collect()}
    assert (got["a"].n, got["a"].mean, got["a"].lowest, got["a"].highest) == (2, 2.0, 1.0, 3.0)
    assert got["a"].stddev == pytest.approx(math.sqrt(2)) and got["b"].n == 1


def sequences_of(spark, *rows):
    return table(spark, "guest_id bigint, length int, sequence array<array<double>>",
                 *((i, n, s) for i, (n, s) in enumerate(rows)))


def test_linear_scorer_ignores_the_padding(spark):
    df = sequences_of(spark, (1, [[1.0, 2.0], [9.0, 9.0]]), (2, [[1.0, 0.0], [3.0, 0.0]]))
    got = scoring.score_sequences(df, scoring.LinearScorer((1.0, -1.0), 0.5), 2, 2)
    assert [r.score for r in got.orderBy("guest_id").collect()] == pytest.approx(
        [1 / (1 + math.exp(0.5)), 1 / (1 + math.exp(-2.5))])


def test_score_of_one_literal_row(spark, tmp_path):
    """A single guest through a stored scaler, a padded window and a scorer."""
    names = list(schemas.RETURNING_FEATURES)
    fitted = table(spark, ", ".join(f"{n} double" for n in names),
                   tuple(0.0 for _ in names), tuple(10.0 for _ in names))
    tables.save_scaler(features.fit_scaler(fitted, names), str(tmp_path / "s"))
    row = table(spark, "guest_id bigint, day date, " + ", ".join(f"{n} double" for n in names),
                (123, d("2024-11-11"), *(50.0 if n == "days_left" else 5.0 for n in names)))
    scaled = features.apply_scaler(tables.load_scaler(str(tmp_path / "s")), row, names)
    window = sequences.padded(sequences.trailing_windows(
        scaled, features.scaled_names(names)), len(names))
    assert window.first().length == 1 and len(window.first().sequence) == 6
    scorer = scoring.LinearScorer([0.1] * len(names), -1.0)
    got = scoring.score_sequences(window, scorer, 6, len(names)).first()
    logit = 0.1 * (0.5 * (len(names) - 1) + 5.0) - 1.0
    assert got.guest_id == 123 and got.score == pytest.approx(1 / (1 + math.exp(-logit)))


def test_recurrent_scorer_equals_step_by_step(spark):
    rng = np.random.default_rng(0)
    w, h, steps = 3, 4, 6
    net = scoring.RecurrentScorer(rng.normal(size=(4 * h, w)), rng.normal(size=(4 * h, h)),
                                  rng.normal(size=4 * h), rng.normal(size=h), 0.1)
    rows = [(n, rng.normal(size=(steps, w)).tolist()) for n in (1, 3, 6)]
    got = [r.score for r in scoring.score_sequences(
        sequences_of(spark, *rows), net, steps, w).orderBy("guest_id").collect()]

    def one(length, x):
        hidden, cell = np.zeros(h), np.zeros(h)
        for t in range(length):
            z = net.w_input @ np.array(x[t]) + net.w_hidden @ hidden + net.bias
            i, f, g, o = z[:h], z[h:2 * h], z[2 * h:3 * h], z[3 * h:]
            sig = lambda v: 1 / (1 + np.exp(-v))
            cell = sig(f) * cell + sig(i) * np.tanh(g)
            hidden = sig(o) * np.tanh(cell)
        return 1 / (1 + math.exp(-(net.w_out @ hidden + net.b_out)))

    assert got == pytest.approx([one(n, x) for n, x in rows])


def test_classifier_learns_a_separable_label(spark):
    rng = np.random.default_rng(1)
    rows = [(i, 1, int(v > 0), [[float(v)], [0.0]]) for i, v in enumerate(rng.normal(size=200))]
    df = table(spark, "guest_id bigint, length int, label int, sequence array<array<double>>", *rows)
    got = scoring.classify(scoring.train_classifier(df), df)
    assert evaluation.auc(got).first().auc > 0.99


def test_false_positives(spark):
    rows = table(spark, "guest_id bigint, day date, days_left int, label int",
                 (1, d("2024-01-01"), 365, 0), (1, d("2024-01-02"), 364, 0),
                 (2, d("2024-01-01"), 365, 1), (3, d("2024-01-01"), 365, 0))
    scores = table(spark, "guest_id bigint, days_left int, label int, score double",
                   (1, 365, 0, .2), (1, 364, 0, .6), (2, 365, 1, .9), (3, 365, 0, .5))
    got = evaluation.false_positive_rows(rows, scores)
    assert bag(got, "guest_id", "score") == [(1, .2), (1, .6)]
    results = table(spark, "guest_id bigint, trip_start date, trip_end date, win_loss double",
                    (1, d("2024-01-01"), d("2024-01-01"), 5.0),
                    (1, d("2024-01-01"), d("2024-01-09"), 7.0))
    assert bag(evaluation.with_win_loss(got, results), "score", "win_loss") == [
        (.2, 5.0), (.2, 7.0), (.6, 7.0)]


def test_linked_accounts_count_guests_once(spark):
    linked = table(spark, "player_id string, account_id string, credits_earned decimal(18,4)",
                   *((p, a, Decimal(1)) for p, a in (("1", "A"), ("2", "A"), ("3", "B"))))
    x = table(spark, "player_id string, guest_id bigint", ("1", 1), ("2", 2), ("3", 3))
    rows = table(spark, "guest_id bigint", (1,), (1,), (2,))
    assert bag(evaluation.linked_account_guests(linked, x, rows), "account_id", "guests") == [("A", 2)]
