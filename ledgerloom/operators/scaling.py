"""Feature vector of a profile and its standardised form."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

# The features in vector order.
FEATURES = [
    "credit_score",
    "credit_utilization",
    "debt_to_income_ratio",
    "total_spent",
    "annual_income",
    "days_since_last_transaction",
    "transaction_amount_stddev",
    "total_transactions",
]


@dataclass(frozen=True)
class Scaling:
    """Mean and sample standard deviation per feature."""

    mean: dict[str, float | None]
    deviation: dict[str, float | None]

    def scaled(self, feature: str) -> Column:
        """Distance from the mean in standard deviations; 0 for a feature that does not vary."""
        mean, deviation = self.mean[feature], self.deviation[feature]
        value = F.col(feature).cast("double")
        if mean is None or not deviation:
            return F.when(value.isNotNull(), F.lit(0.0))
        return (value - F.lit(mean)) / F.lit(deviation)


def fit_scaling(profile: DataFrame, features: Sequence[str] = FEATURES) -> Scaling:
    """Statistics of all rows in one aggregate; unknown values are left out of their feature's statistics."""
    means = [F.avg(F.col(name).cast("double")).alias(f"mean_{name}") for name in features]
    deviations = [F.stddev_samp(F.col(name).cast("double")).alias(f"dev_{name}") for name in features]
    row = profile.agg(*means, *deviations).first()
    return Scaling({n: row[f"mean_{n}"] for n in features}, {n: row[f"dev_{n}"] for n in features})


def add_scaled_features(profile: DataFrame, scaling: Scaling, features: Sequence[str] = FEATURES) -> DataFrame:
    """Arrays ``features`` and ``scaled_features``; an unknown value is null in both and harms no other row."""
    return profile.withColumns(
        {
            "features": F.array(*[F.col(name).cast("double") for name in features]),
            "scaled_features": F.array(*[scaling.scaled(name) for name in features]),
        }
    )


def fit_ml_scaling(profile: DataFrame, features: Sequence[str] = FEATURES) -> PipelineModel:
    """The same with Spark ML, where an unknown value makes its feature NaN in every row."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler]).fit(profile)


def add_ml_scaled_features(profile: DataFrame, model: PipelineModel) -> DataFrame:
    """Vector columns turned into arrays, which every sink can store."""
    vectors = ["features", "scaled_features"]
    return model.transform(profile).withColumns({name: vector_to_array(name) for name in vectors})
