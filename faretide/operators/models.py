"""Split, fit and evaluate a fare model with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.operators.rows import hash_percent
from faretide.session import shared_folder, stage

LABEL = "fare_amount"
#: The defaults of a training job.
DEFAULT_PARAMS = {"num_leaves": 32, "objective": "regression", "metric": "rmse"}
DEFAULT_ROUNDS = 100
#: Parameters that Spark's trees have under another name. More bins than Spark's 32 follow
#: fares more closely; a leaf of one row keeps small training sets usable.
_TREE_PARAMS = {
    "learning_rate": ("stepSize", float, 0.1),
    "max_bin": ("maxBins", int, 64),
    "min_data_in_leaf": ("minInstancesPerNode", int, 1),
    "bagging_fraction": ("subsamplingRate", float, 1.0),
    "feature_fraction": ("featureSubsetStrategy", str, "all"),
    "seed": ("seed", int, 123),
}
_FEATURES = "model_features"
_WEIGHT = "model_weight"


def split_by_hash(
    df: DataFrame, keys: Sequence[str] | None = None, train_percent: int = 75
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows, fixed by ``keys`` (default: all columns).

    A random split would be redone from scratch, with other rows, for every
    task that is retried over input in another order.
    """
    percent = hash_percent(keys or df.columns)
    return df.filter(percent < train_percent), df.filter(percent >= train_percent)


def missing_sentinel(df: DataFrame, columns: Sequence[str]) -> float:
    """A number below every value of ``columns``, and at most -1."""
    # least() skips the NULL minimum of a column without values.
    lowest = F.least(F.lit(0.0), *[F.min(F.col(name).cast("double")) for name in columns])
    return float(math.floor(df.agg(lowest.alias("lowest")).first()["lowest"]) - 1)


def bin_edges(df: DataFrame, columns: Sequence[str], max_bin: int, missing: float) -> list:
    """For each column of doubles, where its bins begin and end; at most ``max_bin`` bins.

    A column of no more values has a bin for each, with edges halfway between; another has bins of
    about as many rows each, and one for ``missing`` alone.
    """
    shares = [i / (max_bin - 1) for i in range(1, max_bin - 1)] or [0.5]
    asked = []
    for i, name in enumerate(columns):
        value = F.col(name)
        asked += [
            F.percentile_approx(value, shares, 10_000).alias(f"shares_{i}"),
            F.min(value).alias(f"lowest_{i}"),
            F.min(F.when(value > missing, value)).alias(f"next_{i}"),
            F.approx_count_distinct(value).alias(f"values_{i}"),
        ]
    found = df.agg(*asked).first()
    edges = []
    for i, name in enumerate(columns):
        inner = {e for e in found[f"shares_{i}"] or () if e > found[f"lowest_{i}"]}
        if found[f"lowest_{i}"] == missing and found[f"next_{i}"] is not None:
            inner.add(found[f"next_{i}"])
        inner = sorted(inner)[: max_bin - 1]
        # The count is off by some percent: only a column of far more values is not looked at.
        few = found[f"values_{i}"] <= 2 * max_bin
        values = sorted(r[0] for r in df.select(name).distinct().take(max_bin + 1)) if few else ()
        if 0 < len(values) <= max_bin:
            halves = [(low, low + (high - low) / 2, high) for low, high in zip(values, values[1:])]
            inner = [half if low < half else high for low, half, high in halves]
        inner = [e for e in inner if math.isfinite(e)]
        # One bin for all is not allowed.
        edges.append([-math.inf, *(inner or [0.0]), math.inf])
    return edges


def assemble(columns: Sequence[str], missing: float) -> tuple[SQLTransformer, list[str]]:
    """A pipeline stage that makes doubles of feature columns, and the doubles' names.

    Spark's trees take no missing values; ``missing`` stands in for NULL.
    """
    filled = [f"_filled_{i}" for i in range(len(columns))]
    fills = ", ".join(
        f"coalesce(cast(`{column}` as double), {missing}D) AS {name}"
        for column, name in zip(columns, filled, strict=True)
    )
    return SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__"), filled


def tree_settings(params: Mapping[str, object] | None = None) -> dict[str, object]:
    """What ``params`` mean to Spark's trees; names and values they cannot honour raise.

    The depth is the smallest that allows ``num_leaves`` leaves.
    """
    params = DEFAULT_PARAMS | dict(params or {})
    unknown = set(params) - set(DEFAULT_PARAMS) - set(_TREE_PARAMS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    for name in ("objective", "metric"):
        if params[name] != DEFAULT_PARAMS[name]:
            raise ValueError(f"unknown {name}: {params[name]}")
    settings = {
        name: kind(params.get(key, default)) for key, (name, kind, default) in _TREE_PARAMS.items()
    }
    leaves = int(params["num_leaves"])
    if leaves < 2:
        raise ValueError("num_leaves must be at least 2")
    return settings | {"maxDepth": math.ceil(math.log2(leaves))}


def weighed_rows(train: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """One row for all of ``train`` that are alike in ``columns``: their mean label, their weight.

    For squared loss these are all that trees see of such rows: the spread of their labels adds
    the same to both sides of every split, and the mean of their residuals is the mean's residual.
    """
    value = F.col(label).cast("double")
    return train.groupBy(*columns).agg(
        F.avg(value).alias(label), F.count(value).cast("double").alias(_WEIGHT)
    )


def spread(df: DataFrame) -> DataFrame:
    """``df``, stored as one file for each core.

    A task reads whole row groups, so a training set that came from one large file has few tasks.
    Boosting matches rows by their place: after a lost executor these must come back in the same
    order, which files give and a shuffle does not.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return stage(df.repartition(cores), "bins")


def train_fare_model(
    train: DataFrame,
    params: Mapping[str, object] | None = None,
    num_rounds: int = DEFAULT_ROUNDS,
    label: str = LABEL,
    missing: float | None = None,
) -> PipelineModel:
    """Fit boosted regression trees on all columns but the label.

    ``params`` are those of ``tree_settings``. Rows without a label are left out. ``train`` is read
    once and stored; every round then scans stored rows of bin numbers, those of ``weighed_rows``
    where a leaf may be of one row and every round takes all rows.
    """
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        # Boosting cuts its lineage every ten rounds, if it has a folder for it.
        context.setCheckpointDir(shared_folder(train.sparkSession))
    settings = tree_settings(params)
    columns = [name for name in train.columns if name != label]
    train = stage(train.filter(F.col(label).isNotNull()), "training")
    if missing is None:
        missing = missing_sentinel(train, columns)
    fill, filled = assemble(columns, missing)
    rows = fill.transform(train).select(label, *filled)
    binned = [f"_bin_{i}" for i in range(len(columns))]
    bins = Bucketizer(
        inputCols=filled,
        outputCols=binned,
        splitsArray=bin_edges(rows, filled, settings["maxBins"], missing),
    )
    rows, weights = bins.transform(rows).select(label, *binned), {}
    if settings["minInstancesPerNode"] == 1 and settings["subsamplingRate"] == 1.0:
        rows, weights = weighed_rows(rows, binned, label), {"weightCol": _WEIGHT}
    vector = VectorAssembler(inputCols=binned, outputCol=_FEATURES, handleInvalid="error")
    trees = GBTRegressor(
        featuresCol=_FEATURES,
        labelCol=label,
        predictionCol="prediction",
        maxIter=num_rounds,
        lossType="squared",
        **weights,
        **settings,
    )
    trees = trees.fit(vector.transform(spread(rows)))
    return PipelineModel([fill, bins, vector, trees])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with a ``prediction`` column."""
    return model.transform(df).select(*df.columns, "prediction")


def regression_metrics(
    df: DataFrame, prediction: str = "prediction", label: str = LABEL
) -> DataFrame:
    """One row: mean squared error, its root, and the rows they cover."""
    error = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(error).alias("row_count"),
    )
