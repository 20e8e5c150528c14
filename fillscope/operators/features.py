"""Feature vectors for clustering and their two-dimensional projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillscope.functions.categories import one_hot
from fillscope.functions.numeric import finite_or_zero, signed_log
from fillscope.schemas import FLAG_COLUMNS

# The numeric features, in matrix order, and those taken as logs.
NUMERIC_FEATURES = (
    "win_rate_ignore_sales",
    "avg_odds_ignore_sales",
    "profit_per_trade_ignore_sales",
    "total_trade_number",
    "frequency",
    "avg_trade_size",
    "total_trade_volume",
)
LOG_FEATURES = ("total_trade_volume", "avg_trade_size", "total_trade_number", "frequency")


def raw_features(stats: DataFrame) -> DataFrame:
    """Numeric features, finite and log-scaled, plus one flag column per category."""
    numeric = []
    for name in NUMERIC_FEATURES:
        value = finite_or_zero(F.col(name))
        numeric.append((signed_log(value) if name in LOG_FEATURES else value).alias(name))
    flags = [
        F.coalesce(flag.cast("double"), F.lit(0.0)).alias(name)
        for flag, name in zip(one_hot(F.col("primary_category")), FLAG_COLUMNS)
    ]
    return stats.select("trader", *numeric, *flags)


@dataclass(frozen=True)
class Scaler:
    """Column means and population standard deviations."""

    means: dict[str, float]
    deviations: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Standardize; a constant column only loses its mean."""
        return df.withColumns(
            {
                name: (F.col(name) - self.means[name]) / (self.deviations[name] or 1.0)
                for name in self.means
            }
        )


def fit_scaler(df: DataFrame, names: tuple[str, ...] = NUMERIC_FEATURES) -> Scaler:
    """One aggregate over ``df``; only its single result row reaches the driver."""
    row = df.agg(
        *[F.avg(name).alias(f"mean_{name}") for name in names],
        *[F.stddev_pop(name).alias(f"dev_{name}") for name in names],
    ).first()
    return Scaler(
        {name: row[f"mean_{name}"] or 0.0 for name in names},
        {name: row[f"dev_{name}"] or 0.0 for name in names},
    )


def scaled_features(stats: DataFrame) -> DataFrame:
    """Standardized numeric features and unscaled flags.

    ``stats`` is read twice (fit, transform); store it first if it is costly.
    """
    raw = raw_features(stats)
    return fit_scaler(raw).transform(raw)


def feature_vectors(scaled: DataFrame) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=[*NUMERIC_FEATURES, *FLAG_COLUMNS], outputCol="features", handleInvalid="error"
    )
    return assembler.transform(scaled).select("trader", "features")


def project(vectors: DataFrame) -> DataFrame:
    """Coordinates on the first two principal components, larger variance first."""
    model = PCA(k=2, inputCol="features", outputCol="projected").fit(vectors)
    axes = vector_to_array("projected")
    return model.transform(vectors).select(
        "trader", axes[0].alias("proj_1"), axes[1].alias("proj_2")
    )
