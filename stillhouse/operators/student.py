"""A small text classifier standing in for the fine-tuned student."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import DataFrame


def fit_student(train: DataFrame, text: str, label: str, features: int = 1 << 14, iterations: int = 20,
                regularisation: float = 0.01) -> PipelineModel:
    """Hashed bag of words with logistic regression. Its size depends on ``features`` and the number
    of labels only, not on the data; each iteration is one tree-aggregated pass."""
    indexer = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="frequencyDesc").fit(train)
    stages = [
        indexer,
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[^\p{L}]+"),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=features),
        IDF(inputCol="__tf", outputCol="__x"),
        LogisticRegression(featuresCol="__x", labelCol="__y", maxIter=iterations, regParam=regularisation,
                           predictionCol="__p", probabilityCol="__prob", rawPredictionCol="__raw"),
        IndexToString(inputCol="__p", outputCol="response", labels=indexer.labels),
    ]
    return Pipeline(stages=stages).fit(train)


def answer(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``response``: the predicted label. The label indexer is only needed for fitting."""
    internal = ["__words", "__tf", "__x", "__p", "__prob", "__raw"]
    return PipelineModel(model.stages[1:]).transform(df).drop(*internal)
