"""The Spark ML side: feature pipelines and the model that ridge is compared with."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame

from ridgeway.operators.columns import FeatureSpec
from ridgeway.operators.metrics import r2


def feature_pipeline(
    spec: FeatureSpec,
    pca_k: int | None = None,
    centre: bool = True,
) -> Pipeline:
    """Unfitted pipeline from raw columns to a ``features`` vector.

    One indexer for all coded columns and one scaler for all features: Spark
    fits each in a single aggregation, and scaling is column by column anyway.
    Centring makes one-hot vectors dense; a model with an intercept is the same
    without it.
    """
    coded = [*spec.ordinals, *spec.categoricals]
    parts = [*spec.numericals, *(f"{c}_index" for c in spec.ordinals)]
    stages: list = []
    if coded:
        indices = [f"{c}_index" for c in coded]
        stages.append(StringIndexer(inputCols=coded, outputCols=indices, handleInvalid="keep"))
    if spec.categoricals:
        indices = [f"{c}_index" for c in spec.categoricals]
        slots = [f"{c}_onehot" for c in spec.categoricals]
        stages.append(OneHotEncoder(inputCols=indices, outputCols=slots, dropLast=True))
        parts += slots
    scaled = "features" if pca_k is None else "features_scaled"
    stages += [
        VectorAssembler(inputCols=parts, outputCol="features_raw", handleInvalid="keep"),
        StandardScaler(inputCol="features_raw", outputCol=scaled, withMean=centre, withStd=True),
    ]
    if pca_k is not None:
        stages.append(PCA(k=pca_k, inputCol=scaled, outputCol="features"))
    return Pipeline(stages=stages)


# Spark's normal equations take no more features
NORMAL_WIDTH = 4096


def solver_for(width: int) -> str:
    """Normal equations where Spark has them, else iterations until they converge."""
    return "normal" if width <= NORMAL_WIDTH else "l-bfgs"


def linear_regression(
    train: DataFrame, label: str, reg_param: float, features: str = "features", solver: str = "normal"
) -> LinearRegressionModel:
    """Spark's ridge on features that are scaled already.

    ``reg_param`` is in Spark's own units, see ``alpha_to_regparam``.
    """
    return LinearRegression(
        featuresCol=features,
        labelCol=label,
        regParam=reg_param,
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        maxIter=300,
        tol=1e-9,
        solver=solver,
    ).fit(train)


def r2_on(model: LinearRegressionModel, test: DataFrame, label: str) -> float | None:
    """R² of a fitted model on a table, from one aggregation."""
    return model.transform(test).agg(r2(label, "prediction").alias("r2")).first()["r2"]
