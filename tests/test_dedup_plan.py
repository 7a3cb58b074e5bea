import re

from jobloom.operators import dedup


def test_no_source_is_gathered_whole(spark):
    columns = "pst_id string, pst_detail string, source string, month int"
    rows = spark.createDataFrame([("1", "a", "srm", 1), ("2", "a", "srm", 2), ("3", "a", "jk", 2), ("4", None, "jk", 3), ("5", "a", None, 1)], columns)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dedup.exact_dedup_source(rows)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"SortMergeJoin \[source#\d+\], \[source#\d+\]", plan)
        assert sorted(r.pst_id for r in out.collect()) == ["1", "3", "4", "5"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_shingles_are_not_built_as_strings(spark):
    """Nor sorted by a comparator that is interpreted; they agree as those of strings do."""
    texts = ["a b c d e f", "b c d e f", "a  b c d\ne", "abcdef", "bcdef", "ab", "a b c", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = rows.select("i", dedup.shingles("t").alias("s"))
    assert "array_join" not in out._jdf.queryExecution().optimizedPlan().toString()
    found = {r.i: set(r.s) for r in out.collect()}

    def plain(text):
        text = " ".join((text or "").lower().split())
        word = text.split(" ")
        if len(word) >= 5:
            return {" ".join(word[i : i + 5]) for i in range(len(word) - 4)}
        return {text[i : i + 5] for i in range(len(text) - 4)} if len(text) >= 5 else {text}

    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(found[i] & found[j]) == len(plain(a) & plain(b))
