"""Boosting that stops after a number of rounds without gain and goes back to the best one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.operators import training

PATIENCE = 50


@dataclass(frozen=True)
class Stopped:
    """The model cut after its best round, the mean squared error on the marked rows after every round looked at, and that round."""

    model: PipelineModel
    losses: list[float]
    best: int

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per round: number from 1, loss, and whether it is part of the model."""
        rows = [(i, loss, i <= self.best) for i, loss in enumerate(self.losses, 1)]
        return spark.createDataFrame(rows, "boosting_round int, loss double, used boolean")


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) with the smallest loss before ``patience`` rounds without a smaller one, and whether those were seen.

    Of equal losses the first counts; a loss that is not a number is no gain.
    """
    best, least = 1, float("inf")
    for at, loss in enumerate(losses, 1):
        if loss < least:
            best, least = at, loss
        elif at - best >= patience:
            return best, True
    return best, False


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model that the first ``rounds`` rounds of boosting had given."""
    if not 1 <= rounds <= model.getNumTrees:
        raise ValueError(f"a model of {model.getNumTrees} rounds has no first {rounds}")
    java, jvm, gateway = model._java_obj, SparkSession.active()._jvm, SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees()[:rounds], model.treeWeights)):
        trees[i], weights[i] = tree, float(weight)
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(model.uid, trees, weights, model.numFeatures)
    return model._copyValues(GBTRegressionModel(cut))


def fit_with_patience(marked: DataFrame, rounds: int = 1500, patience: int = PATIENCE, **sizes) -> Stopped:
    """Boosted trees on the rows of ``marked`` without ``is_test``, as many rounds as the rows with it ask for, at most ``rounds``.

    Rounds do not depend on later ones, so the losses of all rounds come from one pass over the marked rows. How many will be needed is
    not known, and boosting cannot be continued: it starts with twice the patience and is repeated with twice as many rounds until the
    rule applies, which is less than twice the work of the last run. ``marked`` is read several times and should be stored.
    """
    train, held_out = marked.where("NOT is_test").drop("is_test"), marked.where("is_test")
    scored = training.with_vector(held_out).select("features", F.col(training.LABEL).cast("double").alias("label"))
    trees = min(rounds, 2 * patience)
    while True:
        model = training.fit(train, training.boosted_trees(trees=trees, **sizes)).stages[-1]
        # Without a marked row there is nothing to go by, and all rounds count.
        losses = [] if scored.isEmpty() else list(model.evaluateEachIteration(scored, "squared"))
        best, stopped = best_round(losses, patience) if losses else (trees, False)
        if stopped or trees == rounds:
            seen = losses[: best + patience] if stopped else losses
            return Stopped(PipelineModel([first_rounds(model, best)]), seen, best)
        trees = min(rounds, 2 * trees)
