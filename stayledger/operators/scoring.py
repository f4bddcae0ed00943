"""Scores of sequences: batches of them pass through a scorer inside the tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.functions.codes import sigmoid
from stayledger.operators.scale import work_path

# The scorers travel with the task, so the workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: (n, steps, width) padded values and (n,) real lengths to (n,) logits.
Scorer = Callable[[np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class LinearScorer:
    """Weighted mean row of the real steps."""

    weights: Sequence[float]
    bias: float = 0.0

    def __call__(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        real = np.arange(x.shape[1])[None, :] < lengths[:, None]
        mean = (x * real[:, :, None]).sum(axis=1) / lengths[:, None]
        return mean @ np.asarray(self.weights) + self.bias


@dataclass(frozen=True)
class RecurrentScorer:
    """Forward pass of a one-layer LSTM with a linear head, given trained weights.

    Gate blocks are stacked in the order input, forget, cell, output.
    """

    w_input: np.ndarray
    w_hidden: np.ndarray
    bias: np.ndarray
    w_out: np.ndarray
    b_out: float

    def __call__(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        hidden = np.zeros((len(x), self.w_hidden.shape[1]))
        cell = np.zeros_like(hidden)
        for step in range(x.shape[1]):
            gates = x[:, step] @ self.w_input.T + hidden @ self.w_hidden.T + self.bias
            i, f, g, o = np.split(gates, 4, axis=1)
            new_cell = _logistic(f) * cell + _logistic(i) * np.tanh(g)
            real = (step < lengths)[:, None]
            cell = np.where(real, new_cell, cell)
            hidden = np.where(real, _logistic(o) * np.tanh(new_cell), hidden)
        return hidden @ self.w_out + self.b_out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def score_sequences(sequences: DataFrame, scorer: Scorer, steps: int, width: int) -> DataFrame:
    """Adds ``score``, the probability of a scorer; takes padded sequences.

    Only flat numeric arrays cross to Python, an Arrow batch at a time.
    """
    kept = [c for c in sequences.columns if c != "sequence"]
    flat = sequences.select(*kept, F.flatten("sequence").alias("_flat"))
    schema = sequences.select(*kept).withColumn("score", F.lit(0.0)).schema

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["_flat"].to_numpy()).reshape(len(batch), steps, width)
                logits = scorer(x, batch["length"].to_numpy())
                yield batch[kept].assign(score=_logistic(logits))

    return flat.mapInPandas(score, schema)


def flag(scores: DataFrame, threshold: float) -> DataFrame:
    """1 from the threshold on."""
    return scores.withColumn("flag", F.when(F.col("score") >= threshold, 1).otherwise(0))


def _flat_vector(sequences: DataFrame) -> DataFrame:
    return sequences.withColumn("_x", array_to_vector(F.flatten("sequence")))


#: Fixed value: weight of a positive row.
POSITIVE_WEIGHT = 40.0
PENALTY = 0.01


def with_class_weight(sequences: DataFrame, positive_weight: float = POSITIVE_WEIGHT) -> DataFrame:
    return sequences.withColumn("weight", F.when(F.col("label") == 1, positive_weight).otherwise(1.0))


def train_classifier(sequences: DataFrame, positive_weight: float = POSITIVE_WEIGHT,
                     iterations: int = 200) -> LogisticRegressionModel:
    """Weighted binary classifier on flattened padded sequences of scaled values.

    The model is stored and read back, which leaves its training summary behind: that holds the
    session, and no task can take a session in which a write has been observed.
    """
    weighted = _flat_vector(with_class_weight(sequences, positive_weight)).select(
        "_x", F.col("label").cast("double").alias("label"), "weight")
    model = LogisticRegression(featuresCol="_x", labelCol="label", weightCol="weight", tol=1e-10,
                               maxIter=iterations, regParam=PENALTY, standardization=False).fit(weighted)
    path = work_path(sequences.sparkSession, "classifier")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def loss_gradient(model: LogisticRegressionModel, sequences: DataFrame,
                  positive_weight: float = POSITIVE_WEIGHT) -> DataFrame:
    """(coefficient, gradient) of the weighted mean loss with its penalty at the fitted values;
    coefficient -1 is the intercept, which has no penalty. Zero everywhere at the optimum."""
    beta = [float(b) for b in model.coefficients]
    x = F.concat(F.array(F.lit(1.0)), F.flatten("sequence"))
    dot = F.aggregate(F.zip_with(x, F.array(*map(F.lit, [float(model.intercept), *beta])), lambda a, b: a * b),
                      F.lit(0.0), lambda total, v: total + v)
    rows = with_class_weight(sequences, positive_weight).select(
        "weight", (F.col("weight") * (sigmoid(dot) - F.col("label"))).alias("_r"), x.alias("_x"))
    sums = rows.select("weight", "_r", F.posexplode("_x").alias("_k", "_v")).groupBy("_k").agg(
        (F.sum(F.col("_r") * F.col("_v")) / F.sum("weight")).alias("_g"))
    penalty = F.element_at(F.array(F.lit(0.0), *(F.lit(PENALTY * b) for b in beta)), F.col("_k") + 1)
    return sums.select((F.col("_k") - 1).alias("coefficient"), (F.col("_g") + penalty).alias("gradient"))


def classify(model: LogisticRegressionModel, sequences: DataFrame) -> DataFrame:
    scored = model.setProbabilityCol("_p").transform(_flat_vector(sequences))
    kept = [c for c in sequences.columns if c != "sequence"]
    return scored.select(*kept, vector_to_array("_p")[1].alias("score"))
