"""Model sweeps, metrics, importances, persisted scoring (FEA-07/09/10,
MOD-01..19; entropy trees with missing values are in :mod:`tree`).

Fitting is Spark ML (distributed); the driver loop only iterates over a
handful of configurations and keeps one metric per configuration.  Metrics
are SQL aggregates over the scored rows; the rank-sum AUC is exact and never
sorts the whole table in one partition.
"""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ranking import negatives_below, ranged
from tessera.session import concurrently


def assemble(cols: list[str], out: str = "features") -> VectorAssembler:
    """FEA-07."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def dummies(df: DataFrame, levels: dict[str, list]) -> tuple[DataFrame, list[str]]:
    """FEA-09: one 0/1 column per level of each nominal input but the last, which
    is the reference (SAS ``param=glm``).  A NULL or a level not in the list
    has zeros throughout, like the reference."""
    names = {f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0))
             for c, own in levels.items() for v in own[:-1]}
    return df.withColumns(names), list(names)


def levels_of(df: DataFrame, cols: list[str], most: int = 1000) -> dict[str, list]:
    """The sorted levels of nominal inputs; raises beyond ``most`` of them."""
    out = {}
    for c in cols:
        out[c] = sorted(r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().limit(most + 1).collect())
        if len(out[c]) > most:
            raise ValueError(f"{c} has over {most} levels; it is not a nominal input")
    return out


def standardize(inp: str = "features", out: str = "scaled") -> StandardScaler:
    """FEA-10."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def make_estimator(kind: str, label: str, features: str = "features", seed: int = 0, **params):
    """MOD-01/03/07/08/16 estimators by name."""
    if kind == "glm":
        return GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label,
                                           featuresCol=features, **params)
    if kind == "logistic":
        return LogisticRegression(labelCol=label, featuresCol=features, **params)
    if kind == "dt":
        return DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=seed, **params)
    if kind == "rf":
        return RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, **params)
    if kind == "gbt":
        return GBTClassifier(labelCol=label, featuresCol=features, seed=seed, **params)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, seed=seed, **params)
    raise ValueError(kind)


def positive_score(pred: DataFrame, kind: str) -> DataFrame:
    """MOD-12 / MTH-04: one score column: GLM's fitted mean, else P(class 1)."""
    if kind == "glm":
        return pred.withColumn("score", F.col("prediction"))
    return pred.withColumn("score", vector_to_array("probability")[1])


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """MOD-10: exact area under the ROC curve (ties count half), one row.

    Rows are collapsed to distinct scores (partial aggregation) and dealt by
    ``ranking.ranged``: neither an outlier nor NaN (above all numbers, as in
    Spark's ordering) crowds a range.  Negatives below a score are those of
    lower ranges (a window over one row per range) plus lower scores of its own.
    """
    c = df.groupBy(F.col(score).cast("double").alias("__s")).agg(
        F.sum(F.col(label).cast("long")).alias("__p"), F.sum((1 - F.col(label)).cast("long")).alias("__n"))
    c = negatives_below(ranged(c, ["__s"]), [], "__s")
    credit = F.col("__p") * (F.col("__below") + 0.5 * F.col("__n"))
    # NULL where a class has no row
    return c.agg(F.try_divide(F.sum(credit), (F.sum("__p") * F.sum("__n")).cast("double")).alias("auc"))


def _log_loss(y, p, eps: float = 1e-15):
    """MOD-19, as an aggregate."""
    pc = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return -F.avg(y * F.log(pc) + (1 - y) * F.log(1 - pc))


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5,
                   eps: float = 1e-15) -> DataFrame:
    """MOD-14 / MOD-19: confusion counts at ``threshold`` (a probability in
    [0, 1], Q23), misclassification, sensitivity, specificity, precision,
    Brier score, log-loss and AUC — one row."""
    y = F.col(label).cast("double")
    p = F.col(score).cast("double")
    hit = p >= F.lit(threshold)
    m = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(hit & (y == 1)).alias("tp"), F.count_if(hit & (y == 0)).alias("fp"),
        F.count_if(~hit & (y == 0)).alias("tn"), F.count_if(~hit & (y == 1)).alias("fn"),
        F.avg((p - y) * (p - y)).alias("brier"),
        _log_loss(y, p, eps).alias("log_loss"))
    m = m.withColumns({
        "misclassification": (F.col("fp") + F.col("fn")) / F.col("n"),
        "sensitivity": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
        "specificity": F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")),
        "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))})
    return m.crossJoin(auc(df, label, score))


def fit_score(estimator, stages: list, train: DataFrame, data: DataFrame, kind: str):
    model = Pipeline(stages=stages + [estimator]).fit(train)
    return model, positive_score(model.transform(data), kind)


def sweep(train: DataFrame, valid: DataFrame, configs: dict, stages: list, label: str,
          features: str = "features", at_once: int = 4) -> tuple[DataFrame, dict]:
    """MOD-05/10/11 sweep: fit every configuration, ``at_once`` side by side, AUC on ``valid``.
    Returns (results DF: config, kind, auc) and the fitted models."""
    def one(name, kind, params):
        model, scored = fit_score(make_estimator(kind, label, features, **params), stages, train, valid, kind)
        a = auc(scored, label, "score").first()["auc"]
        return (name, kind, float(a) if a is not None else float("nan")), model

    done = concurrently([partial(one, name, *c) for name, c in configs.items()], at_once)
    return (train.sparkSession.createDataFrame([r for r, _ in done], "config STRING, kind STRING, auc DOUBLE"),
            {r[0]: m for r, m in done})


def fit_epochs(train: DataFrame, valid: DataFrame, label: str, layers: list[int], most: int = 30, patience: int = 3,
               features: str = "features", seed: int = 0, block: int = 128):
    """MOD-16/17: a multilayer perceptron trained epoch by epoch on prepared rows, each from the weights of the
    one before; stops once the validation log-loss has not improved for ``patience`` epochs.
    Returns the model of the best epoch, as it was then, and the history: (epoch, loss)."""
    best, history, weights = None, [], None
    for epoch in range(1, most + 1):
        more = {} if weights is None else {"initialWeights": weights}
        model = make_estimator("mlp", label, features, seed, layers=layers, maxIter=1, blockSize=block, **more).fit(train)
        weights = model.weights
        scored = positive_score(model.transform(valid), "mlp")
        loss = scored.agg(_log_loss(F.col(label).cast("double"), F.col("score")).alias("loss")).first().loss
        if best is None or loss < min(x for _, x in history):
            best = model
        history.append((epoch, float(loss)))
        if epoch - best_epoch(history)[0] >= patience:
            break
    return best, history


def best_epoch(history: list[tuple[int, float]]) -> tuple[int, float]:
    """The epoch of least loss, the first of equal ones."""
    return min(history, key=lambda h: (h[1], h[0]))


def best_config(results: DataFrame, order: list[str]) -> str:
    """SRT-06 / Q13: arg-max AUC over all candidates; ties go to the earliest
    configuration in ``order`` (deterministic)."""
    pos = {n: i for i, n in enumerate(order)}
    rows = results.collect()          # one row per configuration
    rows.sort(key=lambda r: (-(r["auc"] if r["auc"] == r["auc"] else -1), pos[r["config"]]))
    return rows[0]["config"]


def importance(model, names: list[str]) -> DataFrame:
    """MOD-09 / SRT-03: feature importances of a tree ensemble as a table."""
    est = model.stages[-1] if isinstance(model, PipelineModel) else model
    vals = est.featureImportances.toArray().tolist()
    s = SparkSession.getActiveSession()
    df = s.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "feature STRING, importance DOUBLE")
    return df.orderBy(F.col("importance").desc(), "feature")


def glm_estimates(model, names: list[str]) -> DataFrame:
    """MOD-02: parameter-estimate table of a binomial GLM (coef, SE, z, p)."""
    est = model.stages[-1] if isinstance(model, PipelineModel) else model
    sm = est.summary
    coefs = list(est.coefficients.toArray()) + [est.intercept]
    terms = list(names) + ["(intercept)"]
    se, tv, pv = sm.coefficientStandardErrors, sm.tValues, sm.pValues     # raises on a singular design
    s = SparkSession.getActiveSession()
    return s.createDataFrame([(t, float(c), float(a), float(b), float(d))
                              for t, c, a, b, d in zip(terms, coefs, se, tv, pv, strict=True)],
                             "term STRING, estimate DOUBLE, std_error DOUBLE, z DOUBLE, p_value DOUBLE")


def save_model(model: PipelineModel, path: str) -> None:
    """MOD-13: persist the whole fitted pipeline (score code)."""
    model.write().overwrite().save(path)


def load_and_score(path: str, df: DataFrame, kind: str, id_col: str) -> DataFrame:
    """MOD-13 / MOD-18 / SNK-05: load a saved pipeline and score rows, keeping
    the id in the row (no positional column bind)."""
    return positive_score(PipelineModel.load(path).transform(df), kind).select(id_col, "score")
