"""Risk model on Spark ML (ML-03..11, MRT-09).

Reference pipeline: standardise (population variance) -> L2 logistic
regression (C=1, 1000 iterations). Spark's scaler uses the sample variance,
so the regularisation is rescaled to the same optimum:
``regParam = (n - 1) / (n^2 * C)`` with ``standardization=False``.

The model is fitted **once** on all patients and persisted; scoring is a
batch ``transform`` of every patient (the reference refits per request).
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark import codes
from carespark.functions.columns import mask_value


class NoTrainingData(Exception):
    """Raised when there is no patient to train on (the reference answers 503)."""


def training_frame(features: DataFrame, labels: DataFrame, key_col: str = "patient_key") -> tuple[DataFrame, int]:
    """Join features and labels; apply the single-class fallback (ML-04).

    n = 1: the row is duplicated with labels 1 and 0. n >= 2 always has both
    classes with the rank label (top max(1, floor(n/4)) < n).
    """
    cols = [c for c in codes.RISK_FEATURES if c in features.columns]
    df = features.join(labels.select(key_col, "label"), key_col).select(
        key_col, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols], "label"
    )
    n = df.count()
    if n == 0:
        raise NoTrainingData("no patient data loaded")
    if n == 1:
        df = df.withColumn("label", F.lit(1)).unionByName(df.withColumn("label", F.lit(0)))
        n = 2
    return df, n


def fit(
    train: DataFrame,
    n: int,
    *,
    C: float = 1.0,
    max_iter: int = 1000,
    model: str = "logistic",
    features: list[str] | None = None,
) -> PipelineModel:
    """ML-05/06 (logistic) or ML-10 (``model='gbt'``) behind one interface."""
    feats = features or [c for c in codes.RISK_FEATURES if c in train.columns]
    assembler = VectorAssembler(inputCols=feats, outputCol="raw_features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    if model == "gbt":
        clf = GBTClassifier(featuresCol="features", labelCol="label", maxIter=50, seed=42)
    else:
        reg = (n - 1) / (float(n) ** 2 * C)
        clf = LogisticRegression(
            featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg,
            elasticNetParam=0.0, standardization=False, fitIntercept=True, tol=1e-10,
        )
    return Pipeline(stages=[assembler, scaler, clf]).fit(train.withColumn("label", F.col("label").cast("double")))


def score(
    model: PipelineModel,
    features: DataFrame,
    *,
    id_col: str = "patient_id",
    phi_read: bool = False,
) -> DataFrame:
    """ML-07 / MRT-09: probability of class 1 for every patient; id masked."""
    cols = [c for c in codes.RISK_FEATURES if c in features.columns]
    f = features.select(
        id_col, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols]
    )
    out = model.transform(f)
    pid = F.col(id_col) if phi_read else mask_value(F.col(id_col))
    return out.select(
        pid.alias(id_col),
        vector_to_array(F.col("probability"))[1].alias("risk_score"),
        F.lit(codes.MODEL_VERSION).alias("model_version"),
    )


def optimality(model: PipelineModel, train: DataFrame, n: int, *, C: float = 1.0) -> DataFrame:
    """A certificate of the logistic fit: (feature, gradient) of the penalised loss at the fitted
    coefficients, in standardised features, the intercept's unpenalised. All are 0 at the optimum
    and only there, as the loss is strictly convex. One aggregate, whose sums are one number per feature."""
    fitted = model.stages[-1]
    names = [*model.stages[0].getInputCols(), "intercept"]
    x = vector_to_array("features")
    rows = model.transform(train).select(x.alias("x"), (vector_to_array("probability")[1] - F.col("label").cast("double")).alias("e"))
    sums = [F.sum(F.col("x")[i] * F.col("e")) for i in range(len(names) - 1)] + [F.sum("e")]
    w = [float(v) for v in fitted.coefficients] + [0.0]
    reg = (n - 1) / (float(n) ** 2 * C)
    grads = [(s / F.lit(float(n)) + F.lit(reg * b)).alias("g") for s, b in zip(sums, w)]
    both = F.arrays_zip(F.array(*map(F.lit, names)).alias("feature"), F.array(*grads).alias("gradient"))
    return rows.agg(both.alias("z")).select(F.inline("z").alias("feature", "gradient"))


def save(model: PipelineModel, path: str, feature_cols: list[str], training_size: int) -> None:
    """ML-08/09: persist the pipeline plus a metadata record beside it."""
    model.write().overwrite().save(path)
    meta = json.dumps({"feature_cols": feature_cols, "training_size": training_size,
                       "model_version": codes.MODEL_VERSION})
    from pyspark.sql import SparkSession

    SparkSession.getActiveSession().createDataFrame([(meta,)], "meta string").coalesce(1).write.mode(
        "overwrite"
    ).text(path.rstrip("/") + "_meta")


def load(path: str) -> tuple[PipelineModel, dict]:
    from pyspark.sql import SparkSession

    model = PipelineModel.load(path)
    meta = SparkSession.getActiveSession().read.text(path.rstrip("/") + "_meta").first()[0]
    return model, json.loads(meta)


def _place(key_col: str, seed: int):
    """A uniform number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def stratified_split(df: DataFrame, fraction: float = 0.8, seed: int = 42, key_col: str = "patient_key") -> tuple[DataFrame, DataFrame]:
    """ML-11: a row's half depends on a hash of its key, so the halves are the same
    however often and in whatever order the frame is evaluated; as the hash knows
    nothing of the label, each class keeps its share."""
    place = _place(key_col, seed)
    return df.where(place < fraction), df.where(place >= fraction)


def cross_validate(df: DataFrame, folds: int = 5, seed: int = 42, key_col: str = "patient_key", **fit_args) -> DataFrame:
    """ML-11: (fold, rows, positives, auc, log_loss) of models fitted on the other folds.

    Folds are a hash of the key. Each fold is scored once on its own rows."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    fold = F.floor(_place(key_col, seed) * folds).cast("int")
    out = []
    for k in range(folds):
        train, test = df.where(fold != k), df.where(fold == k)
        n = train.count()
        model = fit(train, n, **fit_args)
        scored = model.transform(test.withColumn("label", F.col("label").cast("double"))) \
            .withColumn("_p", vector_to_array(F.col("probability"))[1])
        p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("_p")))
        loss = -F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p))
        rows, positives, log_loss = scored.agg(F.count(F.lit(1)), F.sum("label"), F.avg(loss)).first()
        auc = BinaryClassificationEvaluator(labelCol="label").evaluate(scored) if 0 < (positives or 0) < rows else None
        out.append((k, rows, int(positives or 0), auc, log_loss))
    return df.sparkSession.createDataFrame(out, "fold int, rows long, positives long, auc double, log_loss double")
