"""Training and scoring of the boosted-tree regressor on log units."""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.coerce import add_target
from shelfcast.functions.scalars import finite, units_from_log
from shelfcast.operators.metrics import regression_metrics
from shelfcast.operators.rolling import KEY
from shelfcast.operators.split import fit_sizes_to, label_split, split_info, time_split
from shelfcast.plans.features import FEATURES, FeatureEstimator
from shelfcast.session import shared_dir, written
from shelfcast.sources.artifacts import write_json

# Numeric columns that are never model inputs.
NOT_FEATURES = {"date", "unit_sales", "unit_sales_clean", "unit_sales_log", "onpromotion"}
KEY_FEATURES = ["store_nbr", "item_nbr"]
MODEL_FEATURES = sorted([*KEY_FEATURES, *FEATURES])

# Values of the train matrix aimed at per file and task; boosting holds about 20 bytes for each.
MATRIX_VALUES = 12_000_000
# Fewer rows than this are not worth a task of their own.
MATRIX_ROWS = 50_000

# How many rows of the train part a row of the trees' matrix stands for.
WEIGHT = "_rows_alike"

MODEL_TYPE = "GBTRegressor (log1p target)"


@dataclass(frozen=True)
class TrainConfig:
    weeks_window: int = 10
    total_days: int = 84
    test_days: int = 14
    gap_days: int = 3
    feature_gap_days: int = 3
    sales_history_days: int = 120
    seed: int = 42
    n_trees: int = 1000
    learning_rate: float = 0.05
    # Depth 5 gives at most 32 leaves per tree.
    max_depth: int = 5
    max_bins: int = 255


def numeric_features(df):
    """Every numeric column except dates, targets and the raw promotion flag, sorted."""
    return sorted(
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in NOT_FEATURES
    )


def align(df, feature_cols, keep=()):
    """The model matrix: the listed columns in order, as doubles; absent columns, nulls and
    infinities are 0."""
    have = set(df.columns)
    return df.select(
        *[F.col(k).alias(f"row_{k}") if k in feature_cols else F.col(k) for k in keep],
        *[(finite(F.col(c)) if c in have else F.lit(0.0)).alias(c) for c in feature_cols],
    )


def regressor(feature_cols, config, label="unit_sales_log", weight=None):
    trees = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="y_pred_log",
        maxIter=config.n_trees,
        stepSize=config.learning_rate,
        maxDepth=config.max_depth,
        maxBins=config.max_bins,
        seed=config.seed,
    )
    if weight is not None:
        trees.setWeightCol(weight)
    return Pipeline(
        stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="features"), trees]
    )


def score(enriched, model, feature_cols, keep=()):
    """``keep`` columns plus the prediction in log space and in units (not floored at 0)."""
    keep = list(keep)
    scored = model.transform(align(enriched, feature_cols, keep))
    kept = [F.col(f"row_{k}").alias(k) if k in feature_cols else F.col(k) for k in keep]
    return scored.select(
        *kept, "y_pred_log", units_from_log(F.col("y_pred_log")).alias("y_pred")
    )


def holdout_metrics(scored, log_col="unit_sales_log"):
    """Metrics of scored rows against their log target."""
    pairs = scored.withColumns(
        {"y_log": F.col(log_col).cast("double"), "y": units_from_log(F.col(log_col))}
    )
    return regression_metrics(pairs)


def alike(rows, feature_cols, label="unit_sales_log"):
    """One row for all ``rows`` of the same features, with their mean ``label`` and their number (``WEIGHT``).

    Features follow from the key, the promotion flag and those columns of the sales that are
    features themselves, so rows are added up before any feature is looked up. Trees of the squared
    error grow from sums of labels and counts, and residuals are linear in the label: grown on weighted
    means they are those of all rows. A missing label stays missing, for the learner to refuse.
    """
    same = [c for c in rows.columns if c in {*KEY, "onpromotion", *feature_cols}]
    n = F.count(F.lit(1))
    sums = {} if label in same else {label: F.when(F.count(label) == n, F.avg(label))}
    return rows.groupBy(*same).agg(n.alias(WEIGHT), *[value.alias(name) for name, value in sums.items()])


def write_matrix(matrix, path, n_rows=None):
    """Writes a model matrix in files of at most ``MATRIX_VALUES`` values and reads it back, a task for each.
    With ``n_rows``, its size, there are no fewer files than cores, unless these had less than ``MATRIX_ROWS`` rows.

    A learner keeps what a task reads, and values that repeat take hardly a byte in Parquet: tasks
    dealt out by bytes can be hundreds of times larger in memory. Files that cost as much to open as
    a task may read are not put together; the setting holds in a session of its own.
    """
    rows = max(1, MATRIX_VALUES // len(matrix.columns))
    if n_rows is not None:
        each = -(-n_rows // matrix.sparkSession.sparkContext.defaultParallelism)
        rows = min(rows, max(each, MATRIX_ROWS))
    matrix.write.option("maxRecordsPerFile", rows).parquet(path)
    own = matrix.sparkSession.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    return own.read.parquet(path)


def _day(value):
    return None if value is None else value.isoformat()


def _split_report(labelled, sizes, latest):
    parts = {r["split"]: r for r in split_info(labelled).collect()}
    report = {
        "total_days": sizes.total,
        "test_days": sizes.test,
        "gap_days": sizes.gap,
    }
    for part, counter in (("train", "n_train_fit"), ("gap", "n_gap"), ("test", "n_test")):
        row = parts.get(part)
        report[f"{part}_min_date"] = _day(row["min_date"]) if row else None
        report[f"{part}_max_date"] = _day(row["max_date"]) if row else None
        report[counter] = row["n_rows"] if row else 0
    report["max_date"] = _day(latest)
    report["start_total"] = _day(latest - dt.timedelta(days=sizes.total - 1))
    return report


def _kind(learner):
    """What the metadata call a learner: the class of its last stage."""
    stages = learner.getStages() if hasattr(learner, "getStages") else [learner]
    return type(stages[-1]).__name__


def train(sales, tables, run_dir, config=TrainConfig(), order=(), data_signature=None,
          feature_cols=None, learner=None, daily=None):
    """Fits features and model on the train part, measures on the test part, and writes model,
    feature state, feature list and metadata under ``run_dir``. Returns the metadata.

    ``learner`` is an estimator over the model matrix that predicts ``y_pred_log`` from the
    feature columns by name and fits a stage which can be saved in a pipeline (by default,
    boosted trees). With ``daily`` (a ``DailyState`` that holds the days of the train part) the
    features are fitted from its sums instead of the rows.

    The train matrix is written to the shared folder before boosting: each boosting round
    reads it again, and a written table survives the loss of executors without redoing the
    joins. The trees' matrix has one weighted row for all rows of the same features (``alike``);
    another learner gets a row for each.
    """
    spark = sales.sparkSession
    data = add_target(sales.filter(F.col("date").isNotNull()))
    sizes, latest = fit_sizes_to(data, config.total_days, config.test_days, config.gap_days)
    report = _split_report(label_split(data, sizes, latest=latest), sizes, latest)
    if not report["n_train_fit"] or not report["n_test"]:
        counts = {part: report[f"n_{part}"] for part in ("train_fit", "gap", "test")}
        raise ValueError(f"a part has no rows: {counts} of the days up to {report['max_date']}")
    train_rows, _, test_rows = time_split(data, sizes, latest=latest)

    estimator = FeatureEstimator(
        tables=tables,
        sales_history_days=config.sales_history_days,
        feature_gap_days=config.feature_gap_days,
        order=order,
        state_dir=f"{run_dir}/state",
        cluster_history=True,
    )
    if daily is None:
        features = estimator.fit(train_rows)
    else:
        days = [dt.date.fromisoformat(report[f"train_{end}_date"]) for end in ("min", "max")]
        features = estimator.fit_daily(daily, *days)
    cols = list(feature_cols or MODEL_FEATURES)
    keep, n_rows = ["unit_sales_log"], None
    if learner is None:
        # Written, because the transform reads them twice, as rows and as keys.
        train_rows = written(alike(train_rows, cols), shared_dir(spark, "train-rows"))
        keep, n_rows = [*keep, WEIGHT], train_rows.count()
        learner, kind = regressor(cols, config, weight=WEIGHT), MODEL_TYPE
    else:
        kind = _kind(learner)

    train_x = features.transform(train_rows)
    matrix = write_matrix(align(train_x, cols, keep), shared_dir(spark, "train-matrix"), n_rows)
    fitted = learner.fit(matrix)
    model = fitted if isinstance(fitted, PipelineModel) else PipelineModel(stages=[fitted])

    scored = score(features.transform(test_rows), model, cols, ["unit_sales_log"])
    metrics = holdout_metrics(scored).drop("n_rows").first().asDict()
    metadata = {
        "trained_at": dt.datetime.now().isoformat(timespec="seconds"),
        "model_type": kind,
        "weeks_window": config.weeks_window,
        **report,
        "n_features": len(cols),
        **metrics,
        "config": asdict(config),
    }
    if data_signature is not None:
        metadata["data_signature"] = data_signature

    model.write().overwrite().save(f"{run_dir}/model")
    write_json(spark, f"{run_dir}/features.json", cols)
    write_json(spark, f"{run_dir}/metadata.json", metadata)
    return metadata
