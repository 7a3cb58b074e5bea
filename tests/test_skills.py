"""Texts are tagged in small slices, none is held as a whole frame."""

from jobloom.operators import skills


def test_tagging_in_slices(spark, monkeypatch):
    known = spark.createDataFrame([("A1", "python", "(?i)python"), ("B2", "pythn", "python"), ("C3", "zzzz", "java")], "skill_code string, skill_name string, ext_key string")
    rows = [(f"{i:04d}", [f"Python python {i}", "nothing", None, "", "java"][i % 5]) for i in range(2 * skills.TEXTS + 7)]
    tagged = skills.match_skills(spark.createDataFrame(rows, "pst_id string, pst_detail string").coalesce(1), known)
    assert "MapInArrow" in tagged._jdf.queryExecution().executedPlan().toString()
    got = {r.pst_id: [(s.skill_code, round(s.similarity, 3)) for s in r.skills] for r in tagged.collect()}
    assert got == {f"{i:04d}": [("A1", 100.0), ("B2", 88.889)] for i in range(0, len(rows), 5)}
