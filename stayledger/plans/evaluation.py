"""Back-test of a scorer over a year of day rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayledger.operators import days, evaluation, features, scoring, sequences
from stayledger.operators.scale import materialize


def simulate(rows: DataFrame, scaler, scorer: scoring.Scorer, names) -> DataFrame:
    """Score of every guest on every active day, as if scored that day."""
    scaled = features.apply_scaler(scaler, days.without_promotion_day(rows), names)
    windows = sequences.padded(
        sequences.trailing_windows(scaled, features.scaled_names(names), anchors=sequences.BEFORE_YEAR_END),
        len(names))
    return evaluation.with_score_counts(
        scoring.score_sequences(windows, scorer, sequences.STEPS, len(names)))


def report(scores: DataFrame, thresholds: list[float]) -> dict[str, DataFrame]:
    """Curve, area and threshold figures; the scores are computed once."""
    scores = materialize(scores)
    return {"roc": evaluation.roc_points(scores), "auc": evaluation.auc(scores),
            "thresholds": evaluation.threshold_metrics(scores, thresholds)}


def false_positives(rows: DataFrame, scores: DataFrame, profiles: DataFrame, regional: DataFrame,
                    trip_results: DataFrame, above: float = 0.5) -> DataFrame:
    """Never-promoted guests who were flagged, with profile and win or loss per trip."""
    flagged = evaluation.false_positive_rows(days.without_promotion_day(rows), scores, above)
    return evaluation.with_win_loss(
        evaluation.false_positive_profile(flagged, profiles, regional), trip_results)
