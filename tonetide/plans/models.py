"""spark.ml models of the reference.

Each function fits on a train frame and returns the scored test frame; the
fit is the only action. Evaluation goes through :mod:`tonetide.plans.metrics`
(grouped aggregates) rather than per-group evaluator loops.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion, RFormula, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rformula(label: str, drop=("Date",), features_col="features") -> RFormula:
    """``label ~ . - Date``: strings are indexed and one-hot encoded; rows with
    invalid (null) values are skipped. The label name must exist in the frame."""
    minus = "".join(f" - {d}" for d in drop)
    return RFormula(formula=f"{label} ~ .{minus}", featuresCol=features_col, labelCol=label,
                    handleInvalid="skip")


def _check_label(df: DataFrame, label: str):
    if label not in df.columns:
        raise ValueError(f"label {label!r} not in {df.columns}")


def labelled(train: DataFrame, label: str) -> DataFrame:
    """The rows a model can be fitted on: a null label is no label."""
    _check_label(train, label)
    return train.where(F.col(label).isNotNull())


def linear(train: DataFrame, test: DataFrame, features, label: str) -> DataFrame:
    """VectorAssembler + LinearRegression (normal equations for small k)."""
    train = labelled(train, label)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    lr = LinearRegression(featuresCol="features", labelCol=label)
    model = Pipeline(stages=[asm, lr]).fit(train)
    return model.transform(test).drop("features")


def linear_probability(train: DataFrame, test: DataFrame, label="buySell") -> DataFrame:
    """RFormula + LinearRegression on the 0/1 label (linear probability model)."""
    train = labelled(train, label)
    model = Pipeline(stages=[rformula(label), LinearRegression(featuresCol="features", labelCol=label)]).fit(train)
    return model.transform(test).drop("features")


def _with_score(pred: DataFrame) -> DataFrame:
    """P(class 1) as a plain double column ``score``."""
    return pred.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "polyFeatures", "rawPrediction", "probability")


def logistic(train: DataFrame, test: DataFrame, label="buySell", max_iter=10, reg=0.3,
             elastic=0.8) -> DataFrame:
    train = labelled(train, label)
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, regParam=reg,
                            elasticNetParam=elastic)
    return _with_score(Pipeline(stages=[rformula(label), lr]).fit(train).transform(test))


def feature_names(scored: DataFrame, col: str = "features") -> list[str]:
    """Names of the entries of a feature vector, by position (Spark keeps them in the column's metadata)."""
    groups = scored.schema[col].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for g in groups for a in g), key=lambda a: a["idx"])]


def score_equations(train: DataFrame, label="buySell", max_iter: int = 100, reg: float = 1e-3) -> DataFrame:
    """What is left of the penalised score equations of a fitted logistic model (ridge penalty).

    Rows (coefficient, n, sum_x, residual). At the optimum mean((p - y) * x) + reg * var(x) * b is 0 for each
    coefficient (the penalty is on standardised features), and mean(p - y) is for the intercept. One grouped sum
    over the training rows; the fitted coefficients, one for each feature, are literals in it.
    """
    train = labelled(train, label)
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, regParam=reg, elasticNetParam=0.0, tol=1e-9)
    model = Pipeline(stages=[rformula(label), lr]).fit(train)
    scored = model.transform(train)
    names = ["intercept", *feature_names(scored)]
    coefs = [0.0, *[float(b) for b in model.stages[-1].coefficients]]
    x = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    rows = scored.select((vector_to_array("probability")[1] - F.col(label)).alias("e"), F.posexplode(x).alias("j", "x"))
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("j") + 1)
    sums = rows.groupBy("j").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sum_x"), F.avg(F.col("e") * F.col("x")).alias("g"),
                                 F.var_samp("x").alias("v"))
    return sums.select(pick(names).alias("coefficient"), "n", "sum_x", (F.col("g") + reg * F.coalesce("v", F.lit(0.0)) * pick(coefs)).alias("residual"))


def stump(train: DataFrame, label="buySell", max_bins: int = 4096, seed: int = 42) -> DataFrame:
    """A forest of one tree of depth 1 that sees all rows and features, by its two leaves.

    Rows (feature, threshold, side, n, rate): up to ``max_bins`` distinct values of a feature every split is tried.
    The classifier merges leaves that predict one class, so this is the regression forest: it searches splits the
    same way, and the variance of a 0/1 label is half its Gini index.
    """
    train = labelled(train, label)
    rf = RandomForestRegressor(labelCol=label, featuresCol="features", seed=seed, numTrees=1, maxDepth=1, maxBins=max_bins,
                               subsamplingRate=1.0, featureSubsetStrategy="all", bootstrap=False)
    model = Pipeline(stages=[rformula(label), rf]).fit(train)
    scored = model.transform(train)
    root = model.stages[-1].trees[0]._call_java("rootNode")
    if root.subtreeDepth() == 0:  # no split gains
        feature, threshold, side = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit("all")
    else:
        at, cut = root.split().featureIndex(), float(root.split().threshold())
        feature, threshold = F.lit(feature_names(scored)[at]), F.lit(cut)
        side = F.when(vector_to_array("features")[at] <= cut, "left").otherwise("right")
    leaves = scored.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"), F.max("prediction").alias("rate"))
    return leaves.select(feature.alias("feature"), threshold.alias("threshold"), "side", "n", "rate")


def random_forest(train: DataFrame, test: DataFrame, label="buySell", seed: int = 42) -> DataFrame:
    train = labelled(train, label)
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed)
    return _with_score(Pipeline(stages=[rformula(label), rf]).fit(train).transform(test))


def poly_logistic(train: DataFrame, test: DataFrame, label="buySell", degree: int = 2, max_iter=10,
                  reg=0.3, elastic=0.8) -> DataFrame:
    """Degree-2 expansion of the formula features, then logistic regression
    (the pipeline that is actually fitted here is the polynomial one)."""
    train = labelled(train, label)
    poly = PolynomialExpansion(inputCol="features", outputCol="polyFeatures", degree=degree)
    lr = LogisticRegression(labelCol=label, featuresCol="polyFeatures", maxIter=max_iter, regParam=reg,
                            elasticNetParam=elastic)
    return _with_score(Pipeline(stages=[rformula(label), poly, lr]).fit(train).transform(test))


def drop_null_scores(pred: DataFrame, label="buySell") -> DataFrame:
    return pred.where(F.col(label).isNotNull() & F.col("score").isNotNull())
