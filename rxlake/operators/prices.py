"""Price history per drug, and drugs whose latest price stands out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.functions.columns import exact_avg, guarded_ratio

# Names of the features.
ANOMALY_FEATURES = [
    "mean_price",
    "price_stddev",
    "coefficient_of_variation",
    "range_to_mean_ratio",
    "latest_deviation",
]


def _features(pricing: DataFrame, min_obs: int, accuracy: int, *more: Column) -> DataFrame:
    price = F.col("nadac_per_unit")
    level = F.when(price > 0, price)
    return (
        pricing.groupBy("ndc")
        .agg(
            F.count(level).alias("price_observations"),
            exact_avg(level).alias("mean_price"),
            F.stddev_samp(level).alias("price_stddev"),
            F.min(level).alias("min_price"),
            F.max(level).alias("max_price"),
            F.percentile_approx(level, 0.5, accuracy).alias("median_price"),
            *more,
        )
        .filter(F.col("price_observations") >= min_obs)
        .withColumn("price_range", F.col("max_price") - F.col("min_price"))
        .withColumns(
            {
                "coefficient_of_variation": guarded_ratio("price_stddev", "mean_price"),
                "range_to_mean_ratio": guarded_ratio("price_range", "mean_price"),
            }
        )
    )


def price_features(pricing: DataFrame, min_obs: int = 4, accuracy: int = 10000) -> DataFrame:
    """Level and spread of a drug's positive prices, for drugs with enough of them."""
    return _features(pricing.filter("nadac_per_unit > 0"), min_obs, accuracy)


def price_anomaly_features(pricing: DataFrame, min_obs: int = 4, accuracy: int = 10000) -> DataFrame:
    """Price features with the latest known price and how far it is from the mean.

    The latest price is the least of structs that sort as wanted, so one aggregation does both.
    """
    price, day = F.col("nadac_per_unit"), F.col("effective_date")
    latest = F.struct(
        day.isNull().alias("undated"),
        (-F.unix_date(day)).alias("age"),
        price.alias("price"),
        F.col("rate_classification").alias("rate"),
        day.alias("day"),
    )
    found = _features(
        pricing.filter(price.isNotNull()), min_obs, accuracy, F.min(latest).alias("_latest")
    )
    away = F.col("latest_price") - F.col("mean_price")
    return (
        found.withColumns(
            {
                "latest_price": F.col("_latest.price"),
                "latest_date": F.col("_latest.day"),
                "rate_classification": F.col("_latest.rate"),
            }
        )
        .drop("_latest")
        .withColumns(
            {
                "latest_deviation": away / F.nullif("mean_price", F.lit(0.0)),
                "latest_z_score": away / F.nullif("price_stddev", F.lit(0.0)),
            }
        )
    )


def complete(features: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every feature column."""
    return features.na.drop(subset=columns)


def display_name(width: int) -> Column:
    return F.substring(F.coalesce("generic_name", "brand_name", F.lit("Unknown")), 1, width)


def with_drug_names(features: DataFrame, dim_drug: DataFrame) -> DataFrame:
    names = dim_drug.select("ndc", "brand_name", "generic_name", "labeler_name")
    return features.join(names, "ndc", "left")


def z_score_anomalies(
    features: DataFrame,
    dim_drug: DataFrame,
    z: float = 2.0,
    min_obs: int = 8,
    k: int | None = None,
) -> DataFrame:
    """Drugs whose latest price is more than ``z`` deviations off; the ``k`` farthest or all."""
    score = F.col("latest_z_score")
    far = complete(features, ANOMALY_FEATURES).filter(
        (F.abs(score) > z) & (F.col("price_observations") >= min_obs)
    )
    named = with_drug_names(far, dim_drug).select(
        "ndc",
        display_name(28).alias("drug_name"),
        "latest_z_score",
        F.when(score > 0, "PRICE UP").otherwise("PRICE DOWN").alias("direction"),
        "price_observations",
    )
    ordered = named.orderBy(F.abs("latest_z_score").desc(), "ndc")
    return ordered if k is None else ordered.limit(k)
