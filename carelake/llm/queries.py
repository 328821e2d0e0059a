"""One registered query per operator, with production parameters, over whole
tables; and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import sharding, token_count, url_filter
from carelake.llm.decontaminate import contamination
from carelake.llm.merkle import document_proofs
from carelake.llm.near_dup import near_duplicates
from carelake.llm.pii import pseudonymise
from carelake.llm.quality import quality_scores
from carelake.llm.ranked_search import ranked_search
from carelake.llm.reply_trees import conversation_digest
from carelake.llm.sentencepiece_codec import encoding_digest
from carelake.llm.token_count import sentencepiece_vocabulary, token_counts
from carelake.llm.topk import scaled_integers, top_k
from carelake.llm.toxicity import toxicity_scores

#: Where the tokenizers' files are, and the secret of the pseudonyms.
TOKENIZERS = os.environ.get("CARELAKE_TOKENIZERS", "/opt/tokenizers")
PII_KEY = os.environ.get("CARELAKE_PII_KEY", "set CARELAKE_PII_KEY in production")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentencepiece_model(folder: str = TOKENIZERS) -> bytes:
    with open(f"{folder}/piece_bpe_32k.model", "rb") as f:
        return f.read()


def held_out(modulus: int, remainder: int, id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents").select("doc_id"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _table(spark, sf_dir, "embeddings").select("vec_id", scaled_integers(F.col("embedding")).alias("v"))
    return top_k(v, v.where("vec_id % 50 = 0"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), sentencepiece_vocabulary(sentencepiece_model()), longest=None)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out(3, 1))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out(4, 2))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).withColumn(
        "contaminated", F.lit(True))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digest(_table(spark, sf_dir, "documents"), sentencepiece_model())


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return conversation_digest(_table(spark, sf_dir, "conversations").select(*probe.columns).unionByName(probe))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return document_proofs(docs, held_out(3, 0)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
g AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, top) AS (SELECT doc_id, doc_id FROM w UNION SELECT g.b, r.top FROM r JOIN g ON g.a = r.id AND r.top < g.b),
c AS (SELECT id, min(top) AS top FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.top AS component_id, w.doc_id = c.top AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.id = w.doc_id"""

OP9_SQL = r"""
WITH t AS (
  SELECT doc_id AS id, 0 AS kind, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+'), lambda x: x <> '') AS h
  FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT item_id, 1, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+'), lambda x: x <> '')
  FROM benchmark WHERE item_id IS NOT NULL),
w AS MATERIALIZED (SELECT kind, id, unnest(range(len(h))) AS pos, unnest(h) AS x FROM t),
l AS (
  SELECT kind, id, pos, x, lead(x, 1) OVER p AS x1, lead(x, 2) OVER p AS x2, lead(x, 3) OVER p AS x3, lead(x, 4) OVER p AS x4,
    lead(x, 5) OVER p AS x5, lead(x, 6) OVER p AS x6, lead(x, 8) OVER p AS x8
  FROM w WINDOW p AS (PARTITION BY kind, id ORDER BY pos)),
s AS MATERIALIZED (
  SELECT kind, id, pos, '0 ' || x || ' ' || x1 || ' ' || x2 || ' ' || x3 || ' ' || x4 AS seed FROM l WHERE x4 IS NOT NULL
  UNION ALL SELECT kind, id, pos, '1 ' || x || ' ' || x1 || ' ' || x3 || ' ' || x4 || ' ' || x6 FROM l WHERE x6 IS NOT NULL
  UNION ALL SELECT kind, id, pos, '2 ' || x || ' ' || x2 || ' ' || x3 || ' ' || x5 || ' ' || x8 FROM l WHERE x8 IS NOT NULL),
hit AS (
  SELECT DISTINCT d.id AS doc_id, i.id AS item_id, d.pos - i.pos AS start
  FROM (SELECT * FROM s WHERE kind = 0) d JOIN (SELECT * FROM s WHERE kind = 1) i ON d.seed = i.seed),
z AS (SELECT id, count(*) AS item_words, least(13, count(*)) AS width FROM w WHERE kind = 1 GROUP BY 1),
a AS (
  SELECT hit.doc_id, hit.item_id, hit.start, i.pos, z.item_words, z.width, CASE WHEN d.x = i.x THEN 1 ELSE 0 END AS same
  FROM hit JOIN z ON z.id = hit.item_id JOIN w i ON i.kind = 1 AND i.id = hit.item_id
  LEFT JOIN w d ON d.kind = 0 AND d.id = hit.doc_id AND d.pos = hit.start + i.pos),
b AS (
  SELECT *, sum(same) OVER (PARTITION BY doc_id, item_id, start ORDER BY pos) AS upto FROM a),
f AS (
  SELECT *, upto - coalesce(lag(upto, 13) OVER (PARTITION BY doc_id, item_id, start ORDER BY pos), 0) AS run,
    sum(same) OVER (PARTITION BY doc_id, item_id, start) AS matched FROM b)
SELECT doc_id, item_id, CAST(max(matched) AS INTEGER) AS matched_words, CAST(max(item_words) AS INTEGER) AS item_words,
  TRUE AS contaminated
FROM f WHERE pos + 1 >= width AND 100 * run >= 80 * width GROUP BY 1, 2"""

OP11_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 19 + length(regexp_replace(
      regexp_replace(regexp_replace(role, '\[(~*/?INST\])', '[~\1', 'g'), '<(~*(?:/?s>|a>|</?SYS>>|/turn>|\|))', '<~\1', 'g'),
      '\|(~*>)', '|~\1', 'g')) END
    + length(regexp_replace(
      regexp_replace(regexp_replace(text, '\[(~*/?INST\])', '[~\1', 'g'), '<(~*(?:/?s>|a>|</?SYS>>|/turn>|\|))', '<~\1', 'g'),
      '\|(~*>)', '|~\1', 'g')) AS width FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(width) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

OP12_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
d AS MATERIALIZED (SELECT r, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM w WHERE len(t) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
f AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY 1, 2),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
g AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM f, s GROUP BY term),
c AS (
  SELECT i.item_id, d.doc_id, f.r,
    CAST(sum(g.weight * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (50 + (50 * d.n * s.docs) // s.terms)))) AS BIGINT) AS score
  FROM i JOIN f ON f.term = i.term JOIN g ON g.term = i.term JOIN d ON d.r = f.r, s GROUP BY 1, 2, 3),
k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM c WHERE score > 0)
SELECT * FROM k WHERE rank <= 50"""

OP13_SQL = """
WITH RECURSIVE x AS (
  SELECT *, crc32 = 0 AS tampered, row_number() OVER () AS r FROM (
    SELECT *, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, i: xor(v >> 1, (v & 1) * 3988292384))) AS crc FROM documents)
    d, LATERAL (SELECT coalesce(xor(d.crc, 4294967295) % 3, 1) AS crc32)),
f AS (
  SELECT r, doc_id, lang, tampered, head || coalesce(strlen(text) || ':' || text, '-') AS whole,
    head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM x)),
leaf AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM (
    SELECT r, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, sha256(whole) AS h,
      sha256(CASE WHEN tampered THEN low ELSE whole END) AS claimed FROM f)),
t(g, n, lvl, idx, h) AS (
  SELECT g, n, 0, pos, h FROM leaf
  UNION ALL
  SELECT g, (n + 7) // 8, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM t WHERE n > 1 GROUP BY g, n, lvl, idx // 8),
sub AS MATERIALIZED (SELECT g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(n, lvl, idx, h) AS (
  SELECT n, 0, pos, h FROM sub
  UNION ALL
  SELECT (n + 7) // 8, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM u WHERE n > 1 GROUP BY n, lvl, idx // 8),
ln AS MATERIALIZED (SELECT * FROM t), un AS MATERIALIZED (SELECT * FROM u),
side AS (
  SELECT leaf.r, a.lvl, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rt
  FROM leaf JOIN ln a ON a.g = leaf.g AND a.n > 1 AND a.idx = leaf.pos // CAST(pow(8, a.lvl) AS BIGINT)
  JOIN ln b ON b.g = a.g AND b.lvl = a.lvl AND b.idx // 8 = a.idx // 8 GROUP BY leaf.r, a.lvl
  UNION ALL
  SELECT leaf.r, 100 + a.lvl, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), ''),
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '')
  FROM leaf JOIN sub ON sub.g = leaf.g JOIN un a ON a.n > 1 AND a.idx = sub.pos // CAST(pow(8, a.lvl) AS BIGINT)
  JOIN un b ON b.lvl = a.lvl AND b.idx // 8 = a.idx // 8 GROUP BY leaf.r, a.lvl),
step AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lvl) AS k FROM side),
fold(r, k, h) AS (
  SELECT r, 1, claimed FROM leaf
  UNION ALL
  SELECT fold.r, fold.k + 1, sha256(l || fold.h || rt) FROM fold JOIN step ON step.r = fold.r AND step.k = fold.k)
SELECT leaf.doc_id, leaf.h AS leaf, sub.h AS subroot, top.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
  z.h AS folded_root, z.h = top.h AS verified
FROM leaf JOIN sub ON sub.g = leaf.g CROSS JOIN (SELECT h FROM un WHERE n = 1) top
LEFT JOIN (SELECT r, string_agg(l || rt, '' ORDER BY lvl) AS proof FROM side GROUP BY r) p ON p.r = leaf.r
JOIN (SELECT r, arg_max(h, k) AS h FROM fold GROUP BY r) z ON z.r = leaf.r"""

QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_url_filter, op3_topk_search, op4_token_counts, op5_pii, op6_quality, op7_near_duplicates,
    op8_toxicity, op9_decontamination, op10_sentencepiece, op11_reply_trees, op12_ranked_search, op13_merkle_manifest)}
ORACLE = {"op1_sharding": sharding.oracle_sql(), "op3_topk_search": OP3_SQL, "op7_near_duplicates": OP7_SQL,
          "op9_decontamination": OP9_SQL, "op11_reply_trees": OP11_SQL, "op12_ranked_search": OP12_SQL,
          "op13_merkle_manifest": OP13_SQL}


def oracle() -> dict[str, str]:
    """ORACLE, and the SQL that holds the vocabulary of a file, if that file is there."""
    if not os.path.exists(f"{TOKENIZERS}/piece_bpe_32k.model"):
        return ORACLE
    return ORACLE | {"op4_token_counts": token_count.oracle_sql(sentencepiece_vocabulary(sentencepiece_model()))}
