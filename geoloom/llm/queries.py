"""The registered queries of the operators, each over its whole table, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.bestfit import pack_best_fit
from geoloom.llm.chat import format_conversations
from geoloom.llm.decontaminate import find_contamination
from geoloom.llm.near_dedup import near_duplicates
from geoloom.llm.packing import pack_documents
from geoloom.llm.pii import BASE, find_personal_data
from geoloom.llm.quantise import compress
from geoloom.llm.secret_scan import BASE_RULES, RULES, scan_secrets
from geoloom.llm.sharding import SHARDS, shard_documents
from geoloom.llm.substring import repeated_words
from geoloom.llm.topk import top_k
from geoloom.llm.toxicity import fit_toxicity, score_toxicity
from geoloom.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
#: Files of the tokenizers in the public package, as every executor finds them.
TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def listed(spans: Column, kind: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s[kind], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, kind: str, base: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s[kind].isin(*kinds))

    counts = [F.size(of(b)).cast("long").alias(f"n_{b}") for b in base]
    return found.select("doc_id", *counts, F.sha2(listed(of(*base), kind).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans"), kind).alias("spans"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_secrets(read(spark, sf_dir, "documents")), "rule", tuple(r.name for r in BASE_RULES))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_conversations(read(spark, sf_dir, "conversations"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_personal_data(read(spark, sf_dir, "documents")), "kind", BASE)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(read(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), shards=SHARDS) \
        .withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(read(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER)).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _found(i: int, name: str, pattern: str, group: int, least: int) -> str:
    """Spans of a rule: the pieces between matches and the matches, added up."""
    pattern = pattern.replace("'", "''")
    return f"""
SELECT doc_id, {i} AS place, '{name}' AS rule, e - n AS s, e FROM (
  SELECT doc_id, n, ok, sum(gap + n) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
    SELECT doc_id, unnest(generate_series(1, len(ms))) AS i, unnest(list_transform(gaps[1:len(ms)], lambda g: length(g))) AS gap,
           unnest(list_transform(ms, lambda m: length(m))) AS n, unnest(list_transform(gs, lambda g: length(g) >= {least})) AS ok
    FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS ms,
                 regexp_extract_all(text, '{pattern}', {group}) AS gs FROM documents WHERE regexp_matches(text, '{pattern}')))) WHERE ok"""


SECRETS_SQL = "WITH found AS (" + " UNION ALL ".join(
    _found(i, r.name, r.pattern.replace('\\"', '"'), r.group, r.least) for i, r in enumerate(RULES)) + """),
listed AS (
  SELECT doc_id, string_agg(rule || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, place) AS spans,
         string_agg(rule || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, place) FILTER (WHERE place < 3) AS base,
         count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access, count(*) FILTER (WHERE place = 2) AS n_hex
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed USING (doc_id)"""

CHAT_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER o AS n, md5(string_agg(md5(role || chr(31) || text), ',') OVER o) AS so_far
           FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
marked AS (SELECT *, max(n) OVER (PARTITION BY conv_id) AS length FROM placed),
wholes AS (SELECT n, so_far, min(conv_id) AS conv_id FROM marked WHERE n = length GROUP BY n, so_far),
kept AS (SELECT conv_id FROM wholes ANTI JOIN (SELECT DISTINCT n, so_far FROM marked WHERE n < length) USING (n, so_far))
SELECT conv_id, CAST((n - 1) // 256 AS BIGINT) AS part, count(*) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY n) AS text
FROM placed SEMI JOIN kept USING (conv_id) GROUP BY conv_id, part"""

NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)"""

REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS j FROM w),
k AS (SELECT doc_id, j, CASE WHEN count(*) OVER f = 13 THEN string_agg(word, ' ') OVER f END AS key FROM t
      WINDOW f AS (PARTITION BY doc_id ORDER BY j ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
first AS (SELECT key, min(doc_id) AS least FROM k WHERE key IS NOT NULL GROUP BY key),
gone AS (SELECT DISTINCT k.doc_id, unnest(generate_series(k.j, k.j + 12)) AS j FROM k JOIN first USING (key) WHERE k.doc_id > first.least),
kept AS (SELECT t.doc_id, count(*) AS n, string_agg(t.word, ' ' ORDER BY t.j) AS rest FROM t ANTI JOIN gone ON t.doc_id = gone.doc_id AND t.j = gone.j GROUP BY t.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5"""



def _assigned(n: int, books: str) -> str:
    """Nearest entry of each part, of equal ones the first, as table a<n>."""
    return f"""
a{n} AS (SELECT p.vec_id, p.label, p.part, p.x, arg_min(struct_pack(i := b.entry, d := list_sum(list_transform(range(1, len(p.x) + 1), lambda k: (p.x[k] - b.x[k]) * (p.x[k] - b.x[k])))),
           struct_pack(d := list_sum(list_transform(range(1, len(p.x) + 1), lambda k: (p.x[k] - b.x[k]) * (p.x[k] - b.x[k]))), i := b.entry)) AS near
         FROM p JOIN {books} b USING (part) GROUP BY p.row, p.vec_id, p.label, p.part, p.x)"""


def _refined(n: int, books: str) -> str:
    """The codebook after round n, as table b<n>."""
    return f"""
m{n} AS (SELECT part, near.i AS entry, k, CAST(floor(sum(x[k]) / count(*)) AS BIGINT) AS x FROM a{n}, range(1, 5) r(k) GROUP BY ALL),
b{n} AS (SELECT b.part, b.entry, coalesce(x2, b.x) AS x FROM {books} b LEFT JOIN (SELECT part, entry, list(x ORDER BY k) AS x2 FROM m{n} GROUP BY ALL) USING (part, entry))"""


CODES_SQL = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (SELECT row, vec_id, label, part, x[4 * part + 1:4 * part + 4] AS x FROM v, range(16) t(part)),
b0 AS (SELECT part, row - 1 AS entry, x FROM p WHERE row <= 64),{_assigned(1, "b0")},{_refined(1, "b0")},{_assigned(2, "b1")},{_refined(2, "b1")},{_assigned(3, "b2")},
c AS (SELECT vec_id, label, string_agg(printf('%02x', near.i), '' ORDER BY part) AS code, CAST(sum(near.d) AS BIGINT) AS error FROM a3 GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c, h"""

QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity, "op2_secret_scan": op2_secret_scan, "op3_chat": op3_chat, "op4_decontamination": op4_decontamination,
    "op5_personal_data": op5_personal_data, "op6_packing": op6_packing, "op7_near_duplicates": op7_near_duplicates,
    "op8_substring_dedup": op8_substring_dedup, "op9_sharding": op9_sharding, "op10_top_k": op10_top_k,
    "op11_whitening": op11_whitening, "op12_vector_codes": op12_vector_codes, "op13_best_fit": op13_best_fit,
}
ORACLES: dict[str, str] = {
    "op2_secret_scan": SECRETS_SQL, "op3_chat": CHAT_SQL, "op7_near_duplicates": NEAR_SQL, "op8_substring_dedup": REPEATS_SQL, "op10_top_k": TOP_K_SQL,
    "op12_vector_codes": CODES_SQL,
}
