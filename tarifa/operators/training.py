"""Training table, regressors, scoring and model storage."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.fixed_values import FEATURES
from tarifa.functions.fare_codes import training_features
from tarifa.operators.cleaning import clean_training_rows, trim_outliers
from tarifa.operators.encoding import encode, feature_columns, fit_codes
from tarifa.operators.pricing import request_features
from tarifa.session import shared_folder

LABEL = "total_fare"
# Features whose text needs a code before scoring, and the request columns they come from.
REQUEST_CATEGORIES = {
    "airline_code": "carrier",
    "origin_city": "startingAirport",
    "dest_city": "destinationAirport",
}


def with_fare_features(ml: DataFrame) -> DataFrame:
    """Add the fare-code features and drop the date key."""
    return ml.drop("flight_date_key").withColumns(training_features(F.col("fare_basis_code")))


def with_vector(df: DataFrame, renamed: dict[str, str] | None = None) -> DataFrame:
    """Add the feature vector and, where present, the label as a double."""
    vector = array_to_vector(F.array(feature_columns(renamed)))
    return df.withColumn("features", vector)


def boosted_trees(
    trees: int = 1500,
    depth: int = 10,
    rate: float = 0.1,
    share: float = 0.8,
    seed: int = 42,
    stop_on: str | None = None,
    tolerance: float = 0.01,
) -> GBTRegressor:
    """Boosted trees with row and column subsampling.

    ``stop_on`` names a boolean column that marks validation rows for Spark's own early stopping: the first round that gains less than
    ``tolerance`` ends it. ``stopping.fit_with_patience`` waits for later gains. Residuals are checkpointed, which keeps the lineage
    of a long run short. Rows find their node in a tree by walking down: lists of nodes would be stored again for every level.
    """
    regressor = GBTRegressor(
        featuresCol="features",
        labelCol="label",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=share,
        featureSubsetStrategy=str(share),
        seed=seed,
        checkpointInterval=10,
        validationTol=tolerance,
    )
    return regressor.setValidationIndicatorCol(stop_on) if stop_on else regressor


def random_forest(trees: int = 100, depth: int = 10, share: float = 0.8, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features",
        labelCol="label",
        numTrees=trees,
        maxDepth=depth,
        subsamplingRate=share,
        seed=seed,
    )


def fit(encoded: DataFrame, regressor) -> PipelineModel:
    """Train on a table with encoded features and ``total_fare``."""
    shared_folder(encoded.sparkSession)  # names the checkpoint folder where none is set
    labelled = with_vector(encoded).withColumn("label", F.col(LABEL).cast("double"))
    extra = ["is_test"] if "is_test" in encoded.columns else []
    return Pipeline(stages=[regressor]).fit(labelled.select("features", "label", *extra))


def score(
    model: PipelineModel,
    df: DataFrame,
    renamed: dict[str, str] | None = None,
    output: str = "prediction",
) -> DataFrame:
    """Add the model's prediction for each row."""
    scored = model.transform(with_vector(df, renamed)).drop("features")
    return scored if output == "prediction" else scored.withColumnRenamed("prediction", output)


def score_requests(model: PipelineModel, codes: DataFrame, requests: DataFrame) -> DataFrame:
    """Add the features and ``ml_prediction`` to requests with defaults.

    Categories unknown to ``codes`` count as 0. The codes are joined before the features are derived,
    while the plan below the joins is small.
    """
    coded = request_features(encode(requests, codes, REQUEST_CATEGORIES, suffix="_encoded"))
    renamed = {feature: f"{name}_encoded" for feature, name in REQUEST_CATEGORIES.items()}
    return score(model, coded, renamed, "ml_prediction").drop(*renamed.values())


def feature_importance(spark: SparkSession, model: PipelineModel, top: int = 10) -> DataFrame:
    """The most important features, greatest first. A model has 23 of them, so the list is small."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(FEATURES, values)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)


def save_model(model: PipelineModel, codes: DataFrame, path: str) -> None:
    """Store the model and its code table under one folder."""
    model.write().overwrite().save(f"{path}/model")
    codes.write.mode("overwrite").parquet(f"{path}/codes")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/codes")


def prepare(ml: DataFrame, save, **options) -> tuple[DataFrame, DataFrame]:
    """The encoded training table and its code table.

    The cleaned rows and the codes are stored through ``save(df, name)``: the feature table is computed
    once, and the outlier bounds are then found and applied on single stored columns.
    """
    clean = save(clean_training_rows(with_fare_features(ml)).drop("fare_basis_code"), "clean")
    table = trim_outliers(clean, **options)
    codes = save(fit_codes(table), "codes")
    return encode(table, codes), codes
