"""An occupation classifier with stored weights.

The weights are named arrays in a Parquet folder, one row of an array a row:
(name, row, values). Spark counts the words of each class to make them; workers
hold them once, and predict by matrix product, some texts at a time.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.operators.classify import CLASSES, classifier_input, same_shaped
from jobloom.operators.lexical import tokens

log = logging.getLogger(__name__)
#: Columns of the weights, and texts in a product of matrices.
FEATURES, BATCH = 1 << 14, 32
#: Numbers that a stored model may have: 512 MB, which each worker holds.
MOST = 1 << 26
WEIGHT, BIAS = "head.weight", "head.bias"


def features_of(text: str, features: int = FEATURES) -> Column:
    """The feature of each word that the classifier reads of a text: the first 32
    bits of the word's MD5, so that other engines number alike. Repeated words repeat."""
    number = lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % features).cast("int")
    return F.transform(tokens(classifier_input(text), stop=False), number)


def train(rows: DataFrame, text: str, label: str, classes: int = CLASSES, features: int = FEATURES) -> DataFrame:
    """(name, row, values): log-probabilities of words by class and of classes, all
    counts one more than found. Rows whose label is null or none of 0 to classes - 1
    teach nothing; a class without rows has a row of the weights too."""
    known = rows.select(F.col(label).cast("int").alias("row"), features_of(text, features).alias("f")).filter(F.col("row").between(0, classes - 1))
    counts = known.select("row", F.explode("f").alias("at")).groupBy("row", "at").agg(F.count(F.lit(1)).alias("n"))
    own = counts.groupBy("row").agg(F.sum("n").alias("words"))
    spark = rows.sparkSession
    grid = spark.range(classes * features).select(F.floor(F.col("id") / features).cast("int").alias("row"), (F.col("id") % features).cast("int").alias("at"))
    full = grid.join(counts, ["row", "at"], "left").join(F.broadcast(own), "row", "left")  # a row a class
    value = F.log((F.coalesce("n", F.lit(0)) + 1) / (F.coalesce("words", F.lit(0)) + features))
    listed = lambda at: F.transform(F.array_sort(F.collect_list(F.struct(at, "value"))), lambda x: x["value"]).alias("values")
    weight = full.select("row", "at", value.alias("value")).groupBy("row").agg(listed("at")).select(F.lit(WEIGHT).alias("name"), "row", "values")  # `features` numbers a row
    docs = spark.range(classes).select(F.col("id").cast("int").alias("row")).join(known.groupBy("row").agg(F.count(F.lit(1)).alias("n")), "row", "left").fillna(0, "n")
    total = docs.agg(F.sum("n").alias("total"))
    bias = docs.crossJoin(F.broadcast(total)).select("row", F.log((F.col("n") + 1) / (F.col("total") + classes)).alias("value"))  # one row
    return weight.unionByName(bias.agg(listed("row")).select(F.lit(BIAS).alias("name"), F.lit(0).alias("row"), "values"))


def save(weights: DataFrame, path: str) -> None:
    weights.repartition("name", "row").write.mode("overwrite").parquet(path)


class Model(NamedTuple):
    """arrays by name; kept: names that the stored model has not, or in another shape."""

    arrays: dict[str, np.ndarray]
    kept: list[str]


def initial(classes: int = CLASSES, features: int = FEATURES) -> dict[str, np.ndarray]:
    return {WEIGHT: np.zeros((classes, features)), BIAS: np.zeros((1, classes))}


def load(spark: SparkSession, path: str, own: dict[str, np.ndarray]) -> Model:
    """own with the stored arrays of the same name and shape in place of its own. Arrays that
    own has not are left out. A model of more than MOST numbers is refused, before it is read."""
    rows = spark.read.schema("name string, row int, values array<double>").parquet(path).filter(F.col("name").isin(list(own)))
    size = rows.agg(F.coalesce(F.sum(F.size("values")), F.lit(0)).alias("n")).first()["n"]
    if size > MOST:
        raise ValueError(f"a model of {size} numbers")
    found: dict[str, dict[int, list[float]]] = {}
    for r in rows.collect():  # MOST numbers at most
        found.setdefault(r["name"], {})[r["row"]] = r["values"]
    even = {name: [part[k] for k in sorted(part)] for name, part in found.items() if len({len(v) for v in part.values()}) == 1}
    fitting = same_shaped(own, {name: np.array(part, float) for name, part in even.items()})
    kept = sorted(set(own) - set(fitting))
    log.info("model %s: %d arrays read, kept as they were: %s", path, len(fitting), kept)
    return Model(own | fitting, kept)


def predict(rows: DataFrame, model: Model, key: str, text: str, batch: int = BATCH) -> DataFrame:
    """(key, predicted_occupation, score): the class whose words, in logarithms, are
    likeliest, rounded to 6 places; ties go to the smaller class. A null or empty text
    has the class that is likeliest by itself. Other columns are ignored."""
    weight, bias = model.arrays[WEIGHT], model.arrays[BIAS]
    features = weight.shape[1]
    held = rows.sparkSession.sparkContext.broadcast((np.ascontiguousarray(weight.T), bias.reshape(-1)))  # MOST numbers at most

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word, alone = held.value
        for part in (p.slice(at, batch) for p in parts for at in range(0, len(p), batch)):
            lists = part["f"]
            word, at = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            times = np.zeros((len(part), len(word)))
            np.add.at(times, (np.repeat(np.arange(len(part)), pc.list_value_length(lists).to_numpy(zero_copy_only=False)), at), 1)
            scores = np.round(times @ by_word[word] + alone, 6)
            best = scores.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([part[key], pa.array(best, pa.int32()), pa.array(scores[np.arange(len(best)), best])], [key, "predicted_occupation", "score"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, features_of(text, features).alias("f")).mapInArrow(run, f"`{key}` {kind}, predicted_occupation int, score double")
