"""The registered queries of this package and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rigstream.llm import bpe, fingerprints, jaccard, language, lengths, licenses, merkle, mixing, negatives, topk, toxicity, urls, warc
from rigstream.llm.common import held_out, table
from rigstream.session import ensure_checkpoint_dir, materialised

#: Fixed values of the contract.
URL_RULES = [
    urls.Rule("org", "/", True),
    urls.Rule("example.org", "/es/", False),
    urls.Rule("example.org", "/en/1", False),
    urls.Rule("com", "/fr/", True),
    urls.Rule("com", "/de/", False),
]


def _ranks() -> bytes:
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), _ranks(), public_tokenizers.PATTERN, ["doc_id"])


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")
    found = language.identify(docs.select("doc_id", "text"), language.fit(known))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    counted = lengths.token_counts(docs, _ranks(), public_tokenizers.PATTERN).select("n_tokens")
    return lengths.limits(lengths.histogram(counted))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialised(topk.scaled(table(spark, sf_dir, "embeddings")))
    found = topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))
    return found.select("query_id", "rank", "vec_id", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(warc.mark_revisits(table(spark, sf_dir, "pages")), folder)
    return warc.read_archives(spark, folder).select(
        warc.page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), warc.page_id(F.col("refers_to")).alias("refers_to"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: made for name, made in globals().items() if name.startswith("op") and callable(made)}


ORACLES = {
    "op10_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to FROM g""",
    "op2_url_filter": r"""
WITH parts AS (
  SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS pos FROM pages
), cut AS (
  SELECT page_id, CASE WHEN pos = 0 THEN '' ELSE regexp_extract(substr(url, pos + 3), '^[^/?#]*') END AS raw,
         CASE WHEN pos = 0 THEN '' ELSE substr(url, pos + 3) END AS rest FROM parts
), placed AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM cut
), rules(h, p, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM placed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL
)
SELECT placed.page_id, placed.host, placed.path, fits.rule, coalesce(fits.verdict, 'allow') AS verdict
FROM placed LEFT JOIN fits USING (page_id)""",
    "op11_merkle_manifest": """
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS r, doc_id, source AS g, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: unicode(d)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, bit: xor(x >> 1, (x & 1) * 3988292384)))) % 2 = 0 AS hit
  FROM documents
), leaves AS (
  SELECT r, doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS shown
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM leaves
), tree AS (
  SELECT 0 AS level, g, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT level + 1, g, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM tree WHERE n > 1 GROUP BY level, g, idx // 3
), subroots AS (
  SELECT g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1
), tops AS (
  SELECT 0 AS level, idx, h, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, idx // 3
), steps AS (
  SELECT p.r, t.level, coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx < p.idx // pow(3, t.level)::BIGINT), '') AS lhs,
    coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx > p.idx // pow(3, t.level)::BIGINT), '') AS rhs
  FROM placed p JOIN tree t ON p.g IS NOT DISTINCT FROM t.g AND t.idx // 3 = p.idx // pow(3, t.level + 1)::BIGINT WHERE t.n > 1 GROUP BY p.r, t.level
), top_steps AS (
  SELECT s.g, t.level, coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx < s.idx // pow(3, t.level)::BIGINT), '') AS lhs,
    coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx > s.idx // pow(3, t.level)::BIGINT), '') AS rhs
  FROM subroots s JOIN tops t ON t.idx // 3 = s.idx // pow(3, t.level + 1)::BIGINT WHERE t.n > 1 GROUP BY s.g, t.level
), ways AS (
  SELECT r, list(lhs || '|' || rhs ORDER BY level) AS way FROM (
    SELECT r, level, lhs, rhs FROM steps UNION ALL
    SELECT p.r, 1000 + level, lhs, rhs FROM placed p JOIN top_steps t ON p.g IS NOT DISTINCT FROM t.g
  ) GROUP BY r
), proofs AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, coalesce(way, []) AS way, coalesce(shown, leaf) AS start
  FROM placed p JOIN subroots s ON p.g IS NOT DISTINCT FROM s.g LEFT JOIN ways USING (r)
), folded AS (
  SELECT *, sha256(replace(array_to_string(way, ''), '|', '')) AS proof_sha256,
    list_reduce(list_prepend(start, way), lambda node, step: sha256(split_part(step, '|', 1) || node || split_part(step, '|', 2))) AS folded_root FROM proofs
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor_id, p.r ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10""",
    "op6_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(len(w) - 3), lambda i: array_to_string(w[i + 1 : i + 4], ' '))) END AS s FROM d
), shingles AS (
  SELECT doc_id, len(s) AS n, hash(unnest(s)) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT DISTINCT a AS node, a AS label FROM links
  UNION
  SELECT l.b, r.label FROM reach r JOIN links l ON l.a = r.node WHERE r.label < l.b
)
SELECT doc_id, len(s) AS n_shingles, coalesce(label, doc_id) AS component_id
FROM sets LEFT JOIN (SELECT node AS doc_id, min(label) AS label FROM reach GROUP BY node) USING (doc_id)""",
    "op9_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (
  SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
}


def _license_sql() -> str:
    """Every block against every template, counted without filters."""
    rows = ", ".join(
        f"({n}, '{t.label}', {str(t.phrase).lower()}, {len(set(t.pairs))}, {t.needed}, '{pair.decode()}')"
        for n, t in enumerate(licenses.TEMPLATES) for pair in sorted(set(t.pairs))
    )
    step = licenses.BLOCK
    return rf"""
WITH templates(template, label, phrase, size, needed, pair) AS (VALUES {rows}
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents
), places AS (
  SELECT r, pos, w[pos + 1] || ' ' || w[pos + 2] AS pair, w FROM (SELECT r, w, unnest(range(len(w) - 1)) AS pos FROM d)
), near AS (
  SELECT r, pos // {step} AS block, pair FROM places UNION ALL
  SELECT r, pos // {step} - 1, pair FROM places WHERE pos >= {step}
), notices AS (
  SELECT r, label, count(DISTINCT pair) / any_value(size) AS share, NULL::BIGINT AS pos FROM near JOIN templates USING (pair)
  WHERE NOT phrase GROUP BY r, block, template, label HAVING count(DISTINCT pair) >= any_value(needed)
), phrases AS (
  SELECT r, label, 1.0::DOUBLE AS share, pos FROM places,
    (VALUES ('cc-by', ['cc', 'by']), ('gpl', ['general', 'public', 'license']), ('reserved', ['all', 'rights', 'reserved'])) AS p(label, words)
  WHERE w[pos + 1 : pos + len(words)] = words
), hits AS (
  SELECT r, count(pos) AS n_base, min(pos) AS first_word, max(pos) AS last_word, max(share) AS score,
    coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (pos IS NOT NULL)), ','), '') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
  FROM (SELECT * FROM notices UNION ALL SELECT * FROM phrases) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN hits USING (r)"""


def oracle_sql() -> dict[str, str]:
    return ORACLES | {"op12_license_scan": _license_sql()}
