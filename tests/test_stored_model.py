"""The classifier with stored weights against a plain version."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.operators import stored_model

CLASSES, FEATURES = 447, 64
TEXTS = [(0, "개발 서버 코드 개발", 3), (1, "간호 병원 환자", 446), (2, "", 3), (3, None, 7), (4, "Server CODE x_1", 3), (5, "none of it", None), (6, "too far", 447), (7, "below", -1), (8, "가 " * 300, 12)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(TEXTS, "id int, t string, y int").withColumn("predicted_occupation", F.lit("clash"))


def features(text):
    return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % FEATURES for w in re.findall(r"\w+", (text or "")[:256].lower())]


def plain():
    weight, bias = np.zeros((CLASSES, FEATURES)), np.zeros(CLASSES)
    for _, text, label in TEXTS:
        if label is not None and 0 <= label < CLASSES:
            bias[label] += 1
            for f in features(text):
                weight[label, f] += 1
    weight = np.log((weight + 1) / (weight.sum(axis=1, keepdims=True) + FEATURES))
    return weight, np.log((bias + 1) / (bias.sum() + CLASSES))


def wanted(weight, bias):
    found = []
    for i, text, _ in TEXTS:
        scores = [round(bias[c] + math.fsum(weight[c, f] for f in features(text)), 6) for c in range(CLASSES)]
        found.append((i, scores.index(max(scores)), max(scores)))
    return found


def predicted(rows, model, batch=stored_model.BATCH):
    return sorted(tuple(r) for r in stored_model.predict(rows, model, "id", "t", batch).collect())


def agree(got, want):
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want], atol=2e-6, rtol=0)


def test_stored_weights(spark, rows, tmp_path):
    path, (weight, bias) = str(tmp_path / "model"), plain()
    learnt = stored_model.train(rows, "t", "y", CLASSES, FEATURES)
    stored_model.save(learnt, path)
    stored_model.save(learnt, path)  # again: the same
    own = stored_model.initial(CLASSES, FEATURES)
    model = stored_model.load(spark, path, own)
    assert model.kept == [] and np.allclose(model.arrays[stored_model.WEIGHT], weight) and np.allclose(model.arrays[stored_model.BIAS], bias)
    assert not own[stored_model.WEIGHT].any()
    agree(predicted(rows, model), wanted(weight, bias))
    assert predicted(rows, model, 2) == predicted(rows, model)
    assert predicted(rows.limit(0), model) == []


def test_missing_and_misfit_arrays_stay(spark, rows, tmp_path):
    weight, _ = plain()
    learnt = stored_model.train(rows, "t", "y", CLASSES, FEATURES)
    dropped, other = str(tmp_path / "dropped"), str(tmp_path / "other")
    extra = spark.createDataFrame([("encoder", 0, [1.0])], "name string, row int, values array<double>")
    stored_model.save(learnt.filter(F.col("name") != stored_model.BIAS).unionByName(extra), dropped)
    model = stored_model.load(spark, dropped, stored_model.initial(CLASSES, FEATURES))
    assert model.kept == [stored_model.BIAS] and set(model.arrays) == {stored_model.WEIGHT, stored_model.BIAS}
    agree(predicted(rows, model), wanted(weight, np.zeros(CLASSES)))
    stored_model.save(learnt, other)
    model = stored_model.load(spark, other, stored_model.initial(CLASSES, 2 * FEATURES))
    assert model.kept == [stored_model.WEIGHT]


def test_large_models_are_refused(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    stored_model.save(stored_model.train(rows, "t", "y", 8, FEATURES), path)
    monkeypatch.setattr(stored_model, "MOST", 8 * FEATURES)
    with pytest.raises(ValueError):
        stored_model.load(spark, path, stored_model.initial(8, FEATURES))


def test_no_rows_teach_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "model")
    stored_model.save(stored_model.train(rows.limit(0), "t", "y", 8, FEATURES), path)
    model = stored_model.load(spark, path, stored_model.initial(8, FEATURES))
    assert {x[1] for x in predicted(rows, model)} == {0}
