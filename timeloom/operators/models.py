"""Features in long form and the logistic-CV score of representation vectors
(Spark ML). The baseline models per outcome and site are in ``cell_models``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["counts_long"]


def counts_long(tokens: DataFrame, keys=("site", "subject_id"), token: str = "token_id",
                binary: bool = False) -> DataFrame:
    """(keys…, token_id, n): occurrences of each token in the rows given
    (e.g. the past half); ``binary`` gives presence (n = 1)."""
    g = tokens.groupBy(*keys, token)
    return g.agg(F.lit(1).alias("n")) if binary else g.agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- Spark ML
from pyspark.ml.classification import LogisticRegression  # noqa: E402
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: E402

__all__ += ["score_model", "rep_score"]


def score_model(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability as a double column."""
    return model.transform(df).withColumn(out, vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction")


def rep_score(train: DataFrame, test: DataFrame, vec: str = "embedding", label: str = "label",
              folds: int = 3, seed: int = 0) -> DataFrame:
    """Logistic regression on representation vectors, regularization chosen
    by cross-validation ('logistic-CV')."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    tr = train.withColumn("features", array_to_vector(vec))
    te = test.withColumn("features", array_to_vector(vec))
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.001, 0.01, 0.1, 1.0]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, numFolds=folds, seed=seed,
                        evaluator=BinaryClassificationEvaluator(labelCol=label))
    return score_model(cv.fit(tr).bestModel, te)
