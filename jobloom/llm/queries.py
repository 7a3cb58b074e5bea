"""The contracts' queries: each calls its operator on the whole table and derives
digest columns from what the operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from jobloom.llm import bpe, exact, kneser_ney, lines, mixing, neardup, packing, quality, substring, tokenfile, vector_search, whitening
from jobloom.llm.common import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(pieces, numbers=packing.NUMBERS)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tokens = tokenfile.write(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "tokenfile"))
    back = tokenfile.read(spark, tokens, tokens.keys)
    return back.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "symbols", "mean_log10", "perplexity", "threshold", "kept")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").filter(vector_search.usable())
    vectors = rows.select("vec_id", vector_search.quantised().alias("v"))
    queries = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    return vector_search.top_k(vectors, queries, 5)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", (kneser_ney.fold() == 2).alias("held_out"))
    model = kneser_ney.train(docs.filter("not held_out"))
    scored = kneser_ney.score(docs, model, ("held_out",))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.repeated_spans(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(*whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_token_file, op3_minhash_near_dedup, op4_quality_classifier, op5_exact_top_k, op6_lm_scoring, op7_substring_dedup, op8_mix_sources, op9_line_dedup, op10_exact_dedup, op11_embedding_whitening, op12_bpe_round_trip)}

ORACLE_SQL = {
    "op5_exact_top_k": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(l) >= 5 THEN list_transform(range(1, len(l) - 3), lambda i: array_to_string(list_slice(l, i, i + 4), ' '))
                                        WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS k FROM w),
u AS (SELECT doc_id, len(k) AS n, unnest(k) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
e AS (SELECT a, b FROM c UNION ALL SELECT b, a FROM c),
r AS (SELECT doc_id AS id, doc_id AS reach FROM w UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT s.doc_id, len(k) AS n_shingles, min(reach) AS component_id, s.doc_id = min(reach) AS kept
FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, len(k)
""",
    "op7_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, unnest(i) AS pos, unnest(list_transform(i, lambda k: array_to_string(list_slice(l, k, k + 12), ' '))) AS g
      FROM (SELECT doc_id, l, range(1, len(l) - 11) AS i FROM w WHERE len(l) >= 13)),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY g) AS first FROM s),
d AS (SELECT DISTINCT doc_id, pos + k AS pos FROM (SELECT doc_id, pos, unnest(range(0, 13)) AS k FROM f WHERE doc_id > first)),
a AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM w)
SELECT w.doc_id, len(l) AS n_words, count(d.pos) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY a.pos) FILTER (d.pos IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN a ON a.doc_id = w.doc_id LEFT JOIN d ON d.doc_id = a.doc_id AND d.pos = a.pos GROUP BY w.doc_id, len(l)
""",
    "op9_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY key) AS first FROM k),
g AS (SELECT *, length(key) >= 10 AND doc_id > first AS gone FROM f)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
""",
    "op10_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id,
             count(*) OVER (PARTITION BY body) AS group_size, sha256(body) AS text_sha256 FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""",
}
