import glob
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.plans import fixtures as fx
from jobloom.sources import keyed
from jobs import ingest_postings, match_companies
from jobs.common import configuration

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


TABLE = "id string, v int, w string"


def table_at(spark, path, buckets=16):
    return keyed.KeyedTable(str(path), spark.createDataFrame([], TABLE).schema, "id", buckets)


def stored(spark, table):
    return {r.id: (r.v, r.w) for r in keyed.rows_of(spark, table).collect()}


def test_keyed_table_takes_changes(spark, tmp_path):
    table, make = table_at(spark, tmp_path), (lambda rows: spark.createDataFrame(rows, TABLE))
    assert stored(spark, table) == {}
    keyed.replace(spark, table, keyed.absent(spark, table, make([(f"k{i}", i, "a") for i in range(200)] + [(None, 0, None)])))
    model = {f"k{i}": (i, "a") for i in range(200)} | {None: (0, None)}
    assert stored(spark, table) == model
    before = files_of(tmp_path / "rows")
    # an insert skips what is there, an update changes what it has values for
    done = keyed.replace(spark, table, keyed.absent(spark, table, make([("k1", 9, "b"), ("new", 1, "b")])))
    model["new"] = (1, "b")
    assert done == keyed.Written(1, 1) and stored(spark, table) == model
    after = files_of(tmp_path / "rows")
    assert len({f.split("/rows/")[1].split("/")[0] for f in set(before) ^ set(after)}) == 1 and sum(after.get(f) == t for f, t in before.items()) >= 10
    done = keyed.replace(spark, table, keyed.updated(spark, table, make([("k1", 10, None), ("k2", 2, "a"), ("unknown", 1, "x"), (None, 7, None)]), ["v", "w"]))
    model["k1"], model[None] = (10, "a"), (7, None)
    assert done.rows == 2 and stored(spark, table) == model
    # an upsert replaces; a row that is there already is no change
    done = keyed.replace(spark, table, keyed.unlike(spark, table, make([("k3", 3, "a"), ("k4", None, None), ("k5", 6, "z")])))
    model["k4"], model["k5"] = (None, None), (6, "z")
    assert done.rows == 2 and stored(spark, table) == model
    # deletes, of a whole folder too, and back again
    keyed.replace(spark, table, make([(k, None, None) for k in model]), deleted=True)
    assert stored(spark, table) == {}
    keyed.replace(spark, table, keyed.absent(spark, table, make([("k1", 1, "again")])))
    assert stored(spark, table) == {"k1": (1, "again")}
    assert keyed.replace(spark, table, keyed.absent(spark, table, make([]))) == keyed.Written(0, 0)


def test_keyed_table_is_the_same_in_any_order(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([f"k{i}" for i in range(30)] + [None]), rng.randrange(50), rng.choice("abc")) for _ in range(300)]
    order = lambda c: F.struct(c("v").alias("v"), c("w").alias("w"))
    want = {}
    for k, v, w in rows:
        want[k] = min(want.get(k, (v, w)), (v, w))
    for turn in range(2):
        table = table_at(spark, tmp_path / str(turn), 4)
        rng.shuffle(rows)
        for at in range(0, 300, 100):
            keyed.replace(spark, table, keyed.better(spark, table, spark.createDataFrame(rows[at : at + 100], TABLE), order))
        assert stored(spark, table) == want
        assert keyed.replace(spark, table, keyed.better(spark, table, spark.createDataFrame(rows, TABLE), order)).rows == 0


def test_keyed_table_recovers(spark, tmp_path, monkeypatch):
    table, make = table_at(spark, tmp_path, 4), (lambda rows: spark.createDataFrame(rows, TABLE))
    keyed.replace(spark, table, make([(f"k{i}", i, "a") for i in range(40)]))
    keyed.stage(spark, table, make([("k1", 100, "b"), ("k2", 100, "b")]))
    # killed while folders are replaced: one of them is gone
    gone = sorted(glob.glob(f"{tmp_path}/staged/_bucket=*"))[0].rsplit("/", 1)[1]
    for f in glob.glob(f"{tmp_path}/rows/{gone}/*"):
        os.remove(f)
    keyed.replace(spark, table, make([("k3", 300, "c")]))
    want = {f"k{i}": (i, "a") for i in range(40)} | {"k1": (100, "b"), "k2": (100, "b"), "k3": (300, "c")}
    assert stored(spark, table) == want
    assert keyed.recover(spark, table) == keyed.Written(0, 0)


@pytest.fixture(scope="module")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


def plain_merge(documents):
    """The winner of each posting, walked row by row."""
    best = {}
    for r in documents.select("doc_id", "text").collect():
        source = ("srm", "jk", "jkhd")[r.doc_id % 3]
        if r.text is None or len(r.text) <= 10:
            continue
        rank, key = {"jk": 1, "jkhd": 2, "srm": 3}[source], str(r.doc_id // 2).zfill(8)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, source, r.text)
    return {k: v[1:] for k, v in best.items()}


def test_ingest_takes_what_is_new(spark, documents, tmp_path):
    config = configuration(None, "ingest_postings.toml") | {"files_per_batch": 1}
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    state = lambda df: {r.pst_id: (r.source, r.pst_detail) for r in df.collect()}
    late = documents.filter("doc_id % 3 = 1 or doc_id >= 150")  # many of the first source come last
    documents.join(late.select("doc_id"), "doc_id", "left_anti").repartition(2).write.parquet(folder)
    first = state(ingest_postings.run(spark, folder, out, mark, config))
    assert first == plain_merge(documents.join(late.select("doc_id"), "doc_id", "left_anti"))
    before = files_of(f"{out}/postings/rows")
    assert state(ingest_postings.run(spark, folder, out, mark, config)) == first and files_of(f"{out}/postings/rows") == before
    late.repartition(2).write.mode("append").parquet(folder)
    assert state(ingest_postings.run(spark, folder, out, mark, config)) == plain_merge(documents)
    log = {r.batch: r for r in spark.read.parquet(f"{out}/log").collect()}
    assert sorted(log) == [0, 1, 2, 3] and sum(r.n_read for r in log.values()) == documents.count() and all(r.n_changed <= r.n_read for r in log.values())
    # a lost checkpoint: all is read again and nothing changes
    before = files_of(f"{out}/postings/rows")
    ingest_postings.run(spark, folder, out, str(tmp_path / "other"), config)
    assert files_of(f"{out}/postings/rows") == before
    assert set(spark.read.parquet(f"{out}/postings/rows").columns) == {*schemas.MERGED, "_deleted", "_bucket"}


def test_ingest_goes_on_after_a_failure(spark, documents, tmp_path, monkeypatch):
    config = configuration(None, "ingest_postings.toml") | {"files_per_batch": 1}
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    documents.repartition(3).write.parquet(folder)
    publish, calls = keyed.publish, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        return publish(*args)

    monkeypatch.setattr(keyed, "publish", failing)
    with pytest.raises(Exception, match="lost"):
        ingest_postings.run(spark, folder, out, mark, config)
    monkeypatch.setattr(keyed, "publish", publish)
    got = {r.pst_id: (r.source, r.pst_detail) for r in ingest_postings.run(spark, folder, out, mark, config).collect()}
    assert got == plain_merge(documents)


@pytest.fixture(scope="module")
def register(spark, small_dir, tmp_path_factory):
    """Tables of a few orders and customers, in a folder that tests may add to."""

    def make(orders, name):
        folder = str(tmp_path_factory.mktemp(name))
        fx.table(spark, small_dir, "customer").write.parquet(f"{folder}/customer.parquet")
        orders.write.parquet(f"{folder}/orders.parquet")
        return folder

    return make


def test_matching_goes_on_where_it_stopped(spark, small_dir, register, tmp_path, monkeypatch):
    orders = fx.table(spark, small_dir, "orders").filter("o_orderkey < 1200")
    early, every = register(orders.filter("o_orderkey < 800"), "early"), register(orders, "every")
    config = configuration(None, "match_companies.toml")
    rows = lambda df: sorted(df.select("pst_id", "bzno", "confidence", "match_type", "matching_policy", "matching_attempt", "ksic").collect())
    want = rows(match_companies.run(spark, every, str(tmp_path / "plain"), config))
    assert len({r.matching_attempt for r in want}) > 1
    append, calls = match_companies._append, []

    def failing(taken, path):
        if len(calls) == 1:
            raise OSError("killed")
        calls.append(append(taken, path))

    out = str(tmp_path / "resumed")
    monkeypatch.setattr(match_companies, "_append", failing)
    with pytest.raises(OSError, match="killed"):
        match_companies.run(spark, every, out, config)
    monkeypatch.setattr(match_companies, "_append", append)
    first = files_of(f"{out}/outcomes")
    assert rows(match_companies.run(spark, every, out, config)) == want
    after = files_of(f"{out}/outcomes")
    assert all(after[f] == t for f, t in first.items()), "the first attempt is not tried again"
    assert rows(match_companies.run(spark, every, out, config)) == want and files_of(f"{out}/outcomes") == after
    # growing input: what was tried stays, what is new is taken
    out = str(tmp_path / "grown")
    match_companies.run(spark, early, out, config)
    assert rows(match_companies.run(spark, every, out, config)) == want
    # a higher generation tries again what is unmatched, with the same result
    before = spark.read.parquet(f"{out}/outcomes").count()
    assert rows(match_companies.run(spark, every, out, config | {"generation": 2})) == want
    assert spark.read.parquet(f"{out}/outcomes").count() > before


@pytest.mark.parametrize("job", ["match_companies", "ingest_postings"])
def test_command_lines(spark, small_dir, documents, register, tmp_path, job):
    if job == "match_companies":
        source, more = register(fx.table(spark, small_dir, "orders").limit(50), "cli"), []
    else:
        source, more = str(tmp_path / "docs"), ["--checkpoint", str(tmp_path / "mark")]
        documents.write.parquet(source)
    command = [sys.executable, "-m", f"jobs.{job}", "--input", source, "--output", str(tmp_path / "out"), *more]
    done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=300, env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=4 --conf spark.ui.enabled=false pyspark-shell"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert "jobs." + job in done.stderr and glob.glob(f"{tmp_path}/out/**/*.parquet", recursive=True)


def test_jobs_know_nothing_of_llm():
    for name in glob.glob(f"{ROOT}/jobs/*.py") + glob.glob(f"{ROOT}/jobloom/sources/*.py"):
        with open(name, encoding="utf-8") as f:
            assert "jobloom.llm" not in f.read()
