"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, chat, decontam, exactdedup, htmldiff, langid, lexical, merkle, neardup, packing, toxicity, urlfilter, warc
from .common import table
from .manifest_sql import MERKLE


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the pattern grammar."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by Kneser-Ney character models."""
    return langid.identified(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, against itself with the next one's last answer, as a
    preference record."""
    return chat.format_pairs(chat.answered_pairs(table(spark, sf_dir, "conversations")))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near-duplicates."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url judged by the rules, else by the cascade's host list."""
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by differencing with its nearest URL."""
    return htmldiff.extract(table(spark, sf_dir, "pages"))


def packed_digests(docs: DataFrame) -> DataFrame:
    """Packed pieces with the checksum of their ids."""
    pieces = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens, one row per piece."""
    return packed_digests(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts."""
    rows = exactdedup.duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to a WARC archive and read back."""
    pages = table(spark, sf_dir, "pages")
    at = warc.write_archives(pages, warc.archive_path(spark))
    return warc.read_archives(spark, at, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it leaks."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, climbed by a recursive query, with some tampered."""
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth vector by inner product."""
    return balltree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, by an automaton's scan."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_language_id, op3_chat_formatting, op4_minhash_near_dedup, op5_url_filter, op6_html_extraction, op7_packing,
    op8_exact_dedup, op9_warc, op10_decontamination, op11_merkle_manifest, op12_exact_topk, op13_ranked_search)}

_LOWER_HOST = r"lower(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1))"

ORACLES = {
    "op5_url_filter": r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches('.' || host || '.', '[.](adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)[.]')
      THEN 'block' ELSE 'allow' END AS verdict
FROM r""",
    "op8_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
h AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM t)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f""",
}

ORACLES["op3_chat_formatting"] = """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, max(pos) AS pos, arg_max(text, pos) AS text FROM o WHERE role = 'assistant' GROUP BY conv_id),
x AS (SELECT conv_id, pos, coalesce(lead(text) OVER w, first(text) OVER w) AS other FROM a WINDOW w AS (ORDER BY conv_id)),
t AS (
  SELECT conv_id AS pair_id, true AS chosen, role, text, pos FROM o
  UNION ALL SELECT conv_id, false, role, coalesce(other, text), pos FROM o LEFT JOIN x USING (conv_id, pos)),
p AS (SELECT pair_id FROM t GROUP BY 1 HAVING count(DISTINCT chosen) = 2),
c AS (
  SELECT a.pair_id, a.pos FROM t a JOIN t b ON a.pair_id = b.pair_id AND a.pos = b.pos AND a.chosen AND NOT b.chosen
   AND a.role = b.role AND a.text = b.text),
n AS (
  SELECT pair_id, min(pos) AS ends FROM (
    SELECT t.pair_id, t.pos FROM t LEFT JOIN c USING (pair_id, pos) WHERE c.pos IS NULL
    UNION ALL SELECT pair_id, max(pos) + 1 FROM t GROUP BY 1) GROUP BY 1),
r AS (
  SELECT t.*, ends, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS body,
         length('<|im_start|>' || role || chr(10)) AS head
  FROM t JOIN p USING (pair_id) JOIN n USING (pair_id)),
s AS (
  SELECT *, coalesce(sum(length(body)) OVER (PARTITION BY pair_id, chosen, pos >= ends ORDER BY pos
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM r)
SELECT pair_id, min(ends) - 1 AS prompt_turns,
  coalesce(string_agg(body, '' ORDER BY pos) FILTER (pos < ends AND chosen), '') AS prompt,
  coalesce(string_agg(body, '' ORDER BY pos) FILTER (pos >= ends AND chosen), '') AS chosen,
  coalesce(string_agg(body, '' ORDER BY pos) FILTER (pos >= ends AND NOT chosen), '') AS rejected,
  coalesce(string_agg((before + head) || '-' || (before + length(body) - 1), ',' ORDER BY pos)
    FILTER (pos >= ends AND chosen AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((before + head) || '-' || (before + length(body) - 1), ',' ORDER BY pos)
    FILTER (pos >= ends AND NOT chosen AND role = 'assistant'), '') AS rejected_mask
FROM s GROUP BY pair_id"""

ORACLES["op11_merkle_manifest"] = MERKLE

ORACLES["op12_exact_topk"] = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.row <> c.row AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
ORACLES["op13_ranked_search"] = f"""
WITH t AS (SELECT row, doc_id, {_TERMS} AS term FROM (SELECT *, row_number() OVER () AS row FROM documents)),
f AS (SELECT row, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT row, sum(tf)::BIGINT AS n FROM f GROUP BY row),
c AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM d),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term),
i AS (
  SELECT item, item_id, term, count(*) AS reps
  FROM (SELECT item, item_id, {_TERMS} AS term FROM (SELECT *, row_number() OVER () AS item FROM benchmark)) GROUP BY ALL),
s AS (
  SELECT item, item_id, row, doc_id,
         sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * nd) // nt)))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN w USING (term) JOIN d USING (row), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
