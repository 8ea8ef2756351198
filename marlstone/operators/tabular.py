"""Classic supervised learning on numeric columns, by Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators import metrics
from marlstone.operators.prep import split
from marlstone.operators.profile import numeric_columns
from marlstone.plans.durable import durable
from marlstone.plans.positions import with_position

SEED = 42
ALGORITHMS = {
    "classification": ("random_forest", "logistic", "gradient_boosting"),
    "regression": ("random_forest", "linear", "gradient_boosting"),
}


@dataclass
class TabularModel:
    """A fitted pipeline with the columns it was trained on."""

    pipeline: PipelineModel
    features: list[str]
    target: str
    task: str
    algorithm: str


def feature_names(df: DataFrame, *, target: str, features: Sequence[str] | None = None) -> list[str]:
    """The numeric ones among ``features``, or among all columns but the target."""
    numeric = set(numeric_columns(df))
    wanted = features or [c for c in df.columns if c != target]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    kept = [c for c in wanted if c in numeric]
    if not kept:
        raise ValueError("no numeric feature columns")
    return kept


def prepare(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Features as doubles with NULL and NaN replaced by 0."""
    return df.withColumns({c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in names})


def feature_matrix(df: DataFrame, *, key: str, target: str, features: Sequence[str] | None = None):
    """The prepared features in long form: (key, feature, value)."""
    names = [c for c in feature_names(df, target=target, features=features) if c != key]
    return prepare(df, names).select(key, *names).unpivot([key], names, "feature", "value")


def _estimator(task: str, algorithm: str, rows: int, classes: int, trees: int, depth: int):
    label = {"labelCol": "label", "featuresCol": "features"}
    forest = {"numTrees": trees, "maxDepth": depth, "seed": SEED}
    boosted = {"maxIter": trees, "maxDepth": 3, "stepSize": 0.1, "seed": SEED}
    if task == "classification":
        if algorithm == "logistic":
            # An L2 weight of one per row: the penalty is spread over the mean loss.
            return LogisticRegression(
                **label, maxIter=1000, tol=1e-4, regParam=1.0 / max(rows, 1), standardization=False
            )
        if algorithm == "gradient_boosting":
            binary = GBTClassifier(**label, **boosted)
            return binary if classes <= 2 else OneVsRest(classifier=binary, labelCol="label")
        return RandomForestClassifier(**label, **forest)
    if algorithm == "linear":
        return LinearRegression(**label, solver="normal", regParam=0.0)
    if algorithm == "gradient_boosting":
        return GBTRegressor(**label, **boosted)
    return RandomForestRegressor(**label, **forest)


def fit(
    rows: DataFrame,
    *,
    target: str,
    task: str,
    algorithm: str,
    features: Sequence[str],
    trees: int = 100,
    depth: int = 10,
) -> TabularModel:
    """Fit on all given rows. Unknown algorithms mean ``random_forest``."""
    if task not in ALGORITHMS:
        raise ValueError(f"unknown task {task!r}")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    prepared = prepare(rows, features)
    if task == "classification":
        given = F.col(target).cast("string")
        refused = F.raise_error(F.lit(f"target {target} is null")).cast("string")
        named = prepared.withColumn("__target", F.coalesce(given, refused))
        indexer = StringIndexer(inputCol="__target", outputCol="label", handleInvalid="error").fit(named)
        classes = indexer.labels
        count = rows.count() if algorithm == "logistic" else 0
        model = _estimator(task, algorithm, count, len(classes), trees, depth)
        back = IndexToString(inputCol="prediction", outputCol="predicted", labels=classes)
        # Scoring needs no target, so only the stages after the indexer are kept.
        known = indexer.transform(named)
        pipeline = Pipeline(stages=[assembler, model, back]).fit(known)
    else:
        labelled = prepared.withColumn("label", F.col(target).cast("double"))
        model = _estimator(task, algorithm, 0, 0, trees, depth)
        pipeline = Pipeline(stages=[assembler, model]).fit(labelled)
    return TabularModel(pipeline, list(features), target, task, algorithm)


def train(
    df: DataFrame,
    *,
    target: str,
    task: str,
    key: str,
    algorithm: str = "random_forest",
    features: Sequence[str] | None = None,
    train_ratio: float = 0.8,
    **sizes,
) -> tuple[TabularModel, DataFrame]:
    """Fit on the hash-split training rows; also the predictions on the held-out ones."""
    names = [c for c in feature_names(df, target=target, features=features) if c != key or features]
    # Fitting passes over its input many times; the narrow table is computed once.
    narrow = df.select(*dict.fromkeys([key, target, *names]))
    parts = durable(split(narrow, key=key, train_ratio=train_ratio, seed=SEED))
    model = fit(
        parts.where("split = 'train'"),
        target=target,
        task=task,
        algorithm=algorithm,
        features=names,
        **sizes,
    )
    held_out = predict(model, parts.where("split = 'test'"))
    return model, held_out.select(key, F.col(target).alias("truth"), "predicted")


def predict(model: TabularModel, df: DataFrame) -> DataFrame:
    """Add ``predicted``; a missing feature column raises, NULLs count as 0."""
    missing = [c for c in model.features if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {', '.join(missing)}")
    inputs = {f"__in_{c}": F.col(c) for c in df.columns}
    scored = model.pipeline.transform(prepare(df.withColumns(inputs), model.features))
    out = F.col("predicted") if model.task == "classification" else F.col("prediction")
    return scored.select(*[F.col(f"__in_{c}").alias(c) for c in df.columns], out.alias("predicted"))


def scores(model: TabularModel, held_out: DataFrame) -> DataFrame:
    """Accuracy and averages, or RMSE and R², of held-out predictions."""
    if model.task == "regression":
        return metrics.regression(held_out, truth="truth", prediction="predicted")
    pairs = held_out.withColumn("truth", F.col("truth").cast("string"))
    return metrics.report_averages(pairs, truth="truth", prediction="predicted")


def importance(model: TabularModel, spark) -> DataFrame:
    """Features by falling importance; only tree models have them."""
    fitted = model.pipeline.stages[1]
    if not hasattr(fitted, "featureImportances"):
        raise ValueError(f"{model.algorithm} has no feature importances")
    values = fitted.featureImportances.toArray()
    rows = sorted(
        ((name, float(v)) for name, v in zip(model.features, values)), key=lambda r: (-r[1], r[0])
    )
    return spark.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(rows)], "rank int, feature string, importance double"
    )


def folds(df: DataFrame, *, key: str, k: int = 5, stratify: str | None = None) -> DataFrame:
    """Fold numbers of equal size, per class when stratified, in hash order of the key."""
    if k < 2:
        raise ValueError("k must be at least 2")
    hashed = df.withColumn("__h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{SEED}"))))
    keys = [stratify] if stratify else []
    placed = with_position(hashed, keys=keys, order_by=["__h", key], name="__at")
    return placed.withColumn("fold", (F.col("__at") % k).cast("int")).drop("__h", "__at")


def cross_validate(
    df: DataFrame,
    *,
    target: str,
    task: str,
    key: str,
    k: int = 5,
    features: Sequence[str] | None = None,
    trees: int = 50,
    depth: int = 10,
) -> DataFrame:
    """Accuracy or R² of a 50-tree forest per fold, with mean and population deviation.

    The loop runs over folds, not over data; every fit is distributed.
    """
    names = [c for c in feature_names(df, target=target, features=features) if c != key or features]
    stratify = target if task == "classification" else None
    assigned = durable(folds(df, key=key, k=k, stratify=stratify))
    results = []
    for fold in range(k):
        model = fit(
            assigned.where(F.col("fold") != fold),
            target=target,
            task=task,
            algorithm="random_forest",
            features=names,
            trees=trees,
            depth=depth,
        )
        held = predict(model, assigned.where(F.col("fold") == fold)).select(
            F.col(target).alias("truth"), "predicted"
        )
        if task == "classification":
            hit = F.col("truth").cast("string") == F.col("predicted")
            results.append((fold, held.agg(F.avg(hit.cast("double"))).first()[0]))
        else:
            results.append((fold, scores(model, held).first()["r2"]))
    table = df.sparkSession.createDataFrame(results, "fold int, score double")
    spread = table.agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std")).first()
    return table.withColumns({"mean": F.lit(spread["mean"]), "std": F.lit(spread["std"])})
