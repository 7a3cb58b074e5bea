"""Occupations predicted from texts, with codes attached."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions.text import whole_number

#: Characters of a text that the classifier reads: its input length, not a saving.
INPUT = 256
#: Classes of the occupation head.
CLASSES = 447


def classifier_input(column: str):
    return F.substring(F.coalesce(F.col(column).cast("string"), F.lit("")), 1, INPUT)


class Classifier(Protocol):
    """A model that is loaded in the worker: load() once, predict() per batch."""

    def load(self) -> object: ...

    def predict(self, model: object, texts: list[str]) -> list[int]: ...


def same_shaped(own: dict, stored: dict) -> dict:
    """Of a checkpoint the entries that the model has with the same shape."""
    return {k: v for k, v in stored.items() if k in own and getattr(own[k], "shape", None) == getattr(v, "shape", None)}


def predict_with(rows: DataFrame, classifier: Classifier, text: str = "job_desc", key: str = "pst_id", batch: int = 32) -> DataFrame:
    """(key, predicted_occupation) of a pluggable classifier, in batches."""
    missing = {key, text} - set(rows.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = classifier.load()
        for part in parts:
            out = []
            for i in range(0, len(part), batch):
                out += classifier.predict(model, part["text"].iloc[i : i + batch].tolist())
            yield pd.DataFrame({key: part[key], "predicted_occupation": out})

    kinds = dict(rows.dtypes)
    return rows.select(key, classifier_input(text).alias("text")).mapInPandas(run, f"{key} {kinds[key]}, predicted_occupation int")


class HashedLogistic:
    """The stand-in without stored weights: hashed words and logistic regression."""

    def __init__(self, features: int = 1 << 14, rounds: int = 20) -> None:
        words = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}\p{N}_]+")
        hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=features)
        self.pipeline = Pipeline(stages=[words, hashed, LogisticRegression(maxIter=rounds, labelCol="label")])

    def fit(self, rows: DataFrame, text: str, label: str):
        self.model = self.pipeline.fit(rows.select(classifier_input(text).alias("text"), F.col(label).cast("double").alias("label")))
        return self

    def predict(self, rows: DataFrame, key: str, text: str) -> DataFrame:
        out = self.model.transform(rows.select(key, classifier_input(text).alias("text")))
        return out.select(key, F.col("prediction").cast("int").alias("predicted_occupation"))


def with_codes(predictions: DataFrame, occupations: DataFrame, column: str = "predicted_occupation") -> DataFrame:
    """target as a whole number (-1 of what is none) and its codes. A target that the
    map has several times fans out."""
    rows = predictions.withColumn("target", whole_number(column))
    return rows.join(occupations.select("target", "keco_4", "keco_t"), "target", "left")
