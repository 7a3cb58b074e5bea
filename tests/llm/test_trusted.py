from jobloom.llm import quality


def test_all_labelled_good_documents_count(spark):
    docs = spark.createDataFrame([(i, "en") for i in range(12_000)], "doc_id long, lang string")
    marks = spark.createDataFrame([(i, 1, 0) for i in range(12_000)], "doc_id long, quality int, toxic int")
    got = quality.trusted_sample(docs, marks).collect()
    assert sorted(r.doc_id for r in got) == list(range(12_000))
    assert 5500 <= sum(not r.held for r in got) <= 6500


def test_scores_do_not_depend_on_shards(spark, monkeypatch):
    texts = ["tari onta ri men taon", "ri ri mena", "", None, "onta onta 42 men", "zz tari"]
    docs = spark.createDataFrame([(i, x, "en") for i, x in enumerate(texts)], "doc_id long, text string, lang string")
    model = quality.train(docs.select("text"))
    want = {r.doc_id: (r.symbols, round(r.log10, 9)) for r in quality.score(docs, model).collect()}
    monkeypatch.setattr(quality, "SHARD_GRAMS", 3)
    assert {r.doc_id: (r.symbols, round(r.log10, 9)) for r in quality.score(docs, model).collect()} == want
