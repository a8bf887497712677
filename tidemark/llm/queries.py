"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, quality, secret_scan
from tidemark.llm.bm25 import top_k
from tidemark.llm.centroids import cluster
from tidemark.llm.common import few_broadcast, load
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.spelling import spelling_variants, vocabulary
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.token_counts import count_tokens


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(load(spark, sf_dir, "documents"), "word_bpe_49k.json", limit=2048)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP2_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
found AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM doc_windows d JOIN windows w ON d.win = w.win AND d.n = w.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), shingle=4, similarity=80)


OP3_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION
  SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.root) AS component_id, d.doc_id = min(r.root) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.id = d.doc_id GROUP BY d.doc_id, s.n
"""


def remainder(mod: int) -> F.Column:
    """crc32 of the doc_id as text, modulo mod."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(remainder(4) != 2))
    return language_id.identify(docs, model).withColumn("held_out", F.coalesce(remainder(4) == 2, F.lit(False)))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(load(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(load(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *(secret_scan.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secret_scan.digest(base), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans")).alias("spans"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    rows = few_broadcast(labels.select("doc_id", "quality").filter(remainder(5) != 0))
    train = docs.select("doc_id", "text").join(rows, "doc_id")
    out = quality.score(docs, quality.fit(train))
    return out.withColumns({"held_out": F.coalesce(remainder(5) == 0, F.lit(False)), "predicted": F.when(F.col("score") >= 0.3, 1).otherwise(0)})


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return top_k(docs, docs.filter("doc_id % 20 = 0"), k=10)


OP5_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT doc_id, unnest(w) AS term, len(w) AS dl FROM words) GROUP BY 1, 2),
stats AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM words WHERE len(w) > 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
scores AS (
  SELECT q.doc_id AS query_id, d.doc_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * d.dl / mean))), 6) AS score
  FROM tf q JOIN tf d ON q.term = d.term JOIN df ON df.term = q.term, stats WHERE q.doc_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 10
"""


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents"))


OP6_SQL = """
WITH RECURSIVE rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || CAST(doc_id AS VARCHAR)) AS key FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
         CAST(2 * source_size AS DOUBLE) AS cap, sum(source_size) OVER () AS all_words FROM sizes),
rounds AS (
  SELECT source, source_size, weight, cap, all_words, false AS capped, 0 AS round, true AS more FROM weighed
  UNION ALL
  SELECT source, source_size, weight, cap, all_words, capped OR level * weight > cap, round + 1, bool_or(NOT capped AND level * weight > cap) OVER ()
  FROM (SELECT *, (CAST(1.5 AS DOUBLE) * all_words - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / sum(weight) FILTER (NOT capped) OVER () AS level FROM rounds WHERE more)),
settled AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * all_words - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / sum(weight) FILTER (NOT capped) OVER () AS level
  FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
targets AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE level * weight END AS target FROM settled),
budgets AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS budget,
         coalesce(CAST(floor(target) AS BIGINT) // nullif(source_size, 0), 0) AS epochs FROM targets),
ordered AS (
  SELECT r.doc_id, r.source, r.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id, r.size ROWS UNBOUNDED PRECEDING) - r.size AS before
  FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM ordered
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)),
shared AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING min(doc_id) < max(doc_id)),
marked AS (
  SELECT l.doc_id, l.i, l.line, coalesce(l.doc_id > s.first_doc, false) AS gone
  FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(load(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64)


def _assign_sql(k: int) -> str:
    """CTEs: a{k}, the nearest of centroids c{k} for each vector, and c{k+1}, the means of its vectors."""
    return f"""a{k} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := d, no := no)) AS best
  FROM (SELECT rid, no, CAST(list_sum(list_transform(range(1, 65), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) AS BIGINT) AS d FROM v, c{k})
  GROUP BY rid),
c{k + 1} AS MATERIALIZED (
  SELECT no, coalesce(m, c) AS c FROM c{k} LEFT JOIN (
    SELECT no, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m
    FROM (SELECT a.best.no AS no, i, sum(q[i]) AS s, count(*) AS n FROM a{k} a JOIN v USING (rid), range(1, 65) r(i) GROUP BY 1, 2) GROUP BY no) USING (no))"""


OP11_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, q) - 1 AS INTEGER) AS no, q AS c
  FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, q FROM v ORDER BY h NULLS LAST, q LIMIT 16)),
{", ".join(map(_assign_sql, range(4)))},
own AS (SELECT best.no AS no, CAST(sum(best.d) AS BIGINT) AS inertia FROM a3 GROUP BY 1)
SELECT vec_id, best.no AS cluster, best.d AS distance, own.inertia AS cluster_inertia, CAST((SELECT sum(inertia) FROM own) AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN v USING (rid) JOIN own ON own.no = best.no JOIN c3 ON c3.no = best.no
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(load(spark, sf_dir, "documents"), min_length=6, min_count=5, drop_every=199)
    return spelling_variants(words, ratio=5).select("word", "form", "root", "n", "n_near", "form_n")


OP12_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{00C0}-\\x{00FF}]+')) AS run
        FROM documents) GROUP BY ALL),
crc_table AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, (a & 1) * 3988292384)) AS v FROM range(256) r(i))),
digits AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, c, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
                                 lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM digits, crc_table),
typed AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
shorter AS MATERIALIZED (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(minus := -near_n, near := near)) AS b FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.minus >= 5 * n THEN b.near END AS form, CASE WHEN -b.minus >= 5 * n THEN -b.minus END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS here, form AS ahead FROM forms
  UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON f.word = k.ahead)
SELECT word, form, here AS root, n, n_near, form_n FROM forms JOIN (SELECT word, here FROM walk WHERE ahead IS NULL) USING (word)
"""


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), "word_bpe_49k.json", length=2048, end_id=1)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_decontaminate": op2_decontaminate,
        "op3_near_dedup": op3_near_dedup,
        "op4_language_id": op4_language_id,
        "op5_topk_search": op5_topk_search,
        "op6_mix_sources": op6_mix_sources,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_secret_scan": op8_secret_scan,
        "op9_quality": op9_quality,
        "op10_line_dedup": op10_line_dedup,
        "op11_centroid_clusters": op11_centroid_clusters,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_packing": op13_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": OP2_SQL, "op3_near_dedup": OP3_SQL, "op5_topk_search": OP5_SQL, "op6_mix_sources": OP6_SQL, "op10_line_dedup": OP10_SQL, "op11_centroid_clusters": OP11_SQL, "op12_spelling_variants": OP12_SQL}
