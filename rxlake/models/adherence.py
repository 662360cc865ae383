"""Refill-adherence model: training set, reproducible split, fits and scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.operators.keyed import ensure_checkpoint_dir
from rxlake.sources.scratch import stored

LABEL = "low_adherence"
FEATURES = [
    "chronic_condition_count",
    "cc_diabetes",
    "cc_heart_failure",
    "cc_copd",
    "cc_depression",
    "cc_cancer",
    "unique_drugs",
    "total_rx_fills",
    "total_rx_spend",
    "total_patient_pay",
    "avg_days_supply",
    "refill_avg_days_supply",
    "total_medical_spend",
    "rx_share_of_total_spend",
]


def adherence_training_set(
    utilization: DataFrame, refill_stats: DataFrame, threshold: float = 0.6
) -> DataFrame:
    """Patients with refills and complete features, labelled by their on-time rate.

    Features and label cover the same period, so scores tell who refills late, not who will.
    """
    stats = refill_stats.select(
        "beneficiary_id",
        F.col("avg_days_supply").alias("refill_avg_days_supply"),
        "historical_refill_rate",
    )
    return (
        utilization.join(stats, "beneficiary_id", "inner")
        .withColumn(LABEL, (F.col("historical_refill_rate") < threshold).cast("int"))
        .select("beneficiary_id", *FEATURES, LABEL)
        .na.drop(subset=FEATURES)
    )


def target_rate(training: DataFrame, label: str = LABEL) -> DataFrame:
    return training.agg(
        F.count("*").alias("n"), F.round(F.avg(label), 6).alias("low_adherence_rate")
    )


MOST_LABELS = 200


def _key_hash(seed: int, key: str) -> Column:
    """The first 60 bits of an MD5 of seed and key, as other engines can take them too."""
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(text, 1, 15), 16, 10).cast("long")


def split_points(df: DataFrame, label: str, frac: float, seed: int, key: str) -> DataFrame:
    """Per label, the hash and key of the last training row.

    Rows are ordered by a hash of their key. Hash ranges are counted first; only the keys of
    the one range in which a label's cut falls, a small even slice, are then put in order.
    Rows with the same key stay on one side.
    """
    hashed = df.select(label, key, _key_hash(seed, key).alias("_hash")).withColumn(
        "_slice", F.shiftright("_hash", 44)
    )
    upto = Window.partitionBy(label).orderBy("_slice")
    whole = Window.partitionBy(label)
    # At most 65536 slices per label.
    slices = (
        hashed.groupBy(label, "_slice")
        .agg(F.count("*").alias("_n"))
        .withColumns(
            {
                "_end": F.sum("_n").over(upto),
                "_take": F.floor(F.sum("_n").over(whole) * frac + 0.5),
            }
        )
        .filter((F.col("_end") >= F.col("_take")) & (F.col("_end") - F.col("_n") < F.col("_take")))
        .select(label, "_slice", (F.col("_take") - F.col("_end") + F.col("_n")).alias("_row"))
    )
    inside = Window.partitionBy(label).orderBy("_hash", key)
    return (
        hashed.join(F.broadcast(slices), [label, "_slice"], "inner")
        .groupBy(label, "_hash", key, "_row")
        .agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(inside))
        .filter((F.col("_upto") >= F.col("_row")) & (F.col("_upto") - F.col("_n") < F.col("_row")))
        .select(label, F.col("_hash").alias("_cut"), F.col(key).alias("_cut_key"))
    )


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    frac: float = 0.75,
    seed: int = 42,
    key: str = "beneficiary_id",
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, each label's share exact to the row when keys are unique.

    Depends on the keys and the seed only, never on partitioning.
    """
    marked = stored(with_part(df, label, frac, seed, key), "split")
    return (
        marked.filter("_part = 'train'").drop("_part"),
        marked.filter("_part = 'test'").drop("_part"),
    )


def with_part(
    df: DataFrame,
    label: str = LABEL,
    frac: float = 0.75,
    seed: int = 42,
    key: str = "beneficiary_id",
) -> DataFrame:
    """Add ``_part``, train or test."""
    if df.select(label).distinct().limit(MOST_LABELS + 1).count() > MOST_LABELS:
        raise ValueError(f"{label} has more than {MOST_LABELS} values; is it a class?")
    cuts = split_points(df, label, frac, seed, key)  # one row per label
    hashed = _key_hash(seed, key)
    train = (hashed < F.col("_cut")) | (
        (hashed == F.col("_cut")) & (F.col(key) <= F.col("_cut_key"))
    )
    return (
        df.join(F.broadcast(cuts), label, "left")
        .withColumn("_part", F.when(train, "train").otherwise("test"))
        .drop("_cut", "_cut_key")
    )


def _scaled(features: list[str]) -> list:
    return [
        VectorAssembler(inputCols=features, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
    ]


def balanced_weight(train: DataFrame, label: str = LABEL) -> tuple[Column, int]:
    """Weight n / (classes * class size) per row, and n."""
    sizes = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).collect()}
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for value, size in sizes.items():
        weight = F.when(F.col(label) == value, n / (len(sizes) * size)).otherwise(weight)
    return weight, n


def fit_adherence_lr(
    train: DataFrame,
    features: list[str] | None = None,
    label: str = LABEL,
    max_iter: int = 1000,
) -> PipelineModel:
    """Balanced logistic regression on standardized features.

    The ridge weight 1/n equals a unit inverse penalty on the summed loss.
    """
    weight, n = balanced_weight(train, label)
    model = LogisticRegression(
        labelCol=label,
        weightCol="_weight",
        maxIter=max_iter,
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
    )
    stages = [*_scaled(features or FEATURES), model]
    return Pipeline(stages=stages).fit(train.withColumn("_weight", weight))


def fit_adherence_gbt(
    train: DataFrame,
    features: list[str] | None = None,
    label: str = LABEL,
    trees: int = 100,
    depth: int = 4,
    rate: float = 0.1,
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees on standardized features."""
    ensure_checkpoint_dir(train.sparkSession)  # the trees' own checkpoints
    model = GBTClassifier(
        labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[*_scaled(features or FEATURES), model]).fit(train)


def score_adherence(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predicted class and probability of low adherence; other columns are kept."""
    return (
        model.transform(df)
        .withColumn("probability", vector_to_array("probability")[1])
        .withColumn("prediction", F.col("prediction").cast("int"))
        .drop("_raw", "features", "rawPrediction")
    )


def risk_tiers(scored: DataFrame, high: float = 0.7, medium: float = 0.4) -> DataFrame:
    """Sort scored patients into risk tiers by probability."""
    p = F.col("probability")
    tier = F.when(p >= high, "high").when(p >= medium, "medium").otherwise("low")
    return scored.withColumn("risk_tier", tier)


def feature_importance(model: PipelineModel, features: list[str] | None = None) -> DataFrame:
    """Features of a tree model by importance."""
    trees = model.stages[-1]
    rows = list(zip(features or FEATURES, map(float, trees.featureImportances.toArray())))
    return _frame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def lr_coefficients(model: PipelineModel, features: list[str] | None = None) -> DataFrame:
    """Signed coefficients by size; positive raises the odds of low adherence."""
    rows = list(zip(features or FEATURES, map(float, model.stages[-1].coefficients.toArray())))
    return (
        _frame(rows, "feature string, coefficient double")
        .withColumn("abs_coef", F.abs("coefficient"))
        .orderBy(F.col("abs_coef").desc(), "feature")
    )


def lr_gradient(
    model: PipelineModel, train: DataFrame, features: list[str] | None = None, label: str = LABEL
) -> DataFrame:
    """Slope of the fitted loss per feature, rounded: 0 everywhere at the optimum."""
    weight, n = balanced_weight(train, label)
    fitted = model.stages[-1]
    x = vector_to_array("features")
    error = (vector_to_array("probability")[1] - F.col(label)) * weight
    scored = model.transform(train).select(x.alias("x"), error.alias("e"), weight.alias("w"))
    names = features or FEATURES
    sums = scored.agg(
        *[F.sum(F.col("e") * F.col("x")[i]).alias(f"g{i}") for i in range(len(names))],
        F.sum("w").alias("w"),
    ).first()
    pull = fitted.coefficients.toArray() * fitted.getRegParam()
    slopes = [round(float(sums[f"g{i}"] / sums["w"] + pull[i]), 3) + 0.0 for i in range(len(names))]
    return _frame(list(zip(names, slopes)), "feature string, slope double")


def _frame(rows: list, schema: str) -> DataFrame:
    from pyspark.sql import SparkSession

    return SparkSession.active().createDataFrame(rows, schema)
