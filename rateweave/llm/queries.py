"""The operators as queries over whole tables, and SQL to check them by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateweave.llm import (
    hmm, kdtree, mixing, negatives, packing, phrases, pii, quality, secrets, simhash, toxicity, urls, warc,
)
from rateweave.llm.tables import table
from rateweave.session import new_scratch


def op1_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every text under the trained model, and the base score."""
    return hmm.score(table(spark, sf_dir, "documents"))


def op2_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select(
        "doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id"
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_kd_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best inner products of every hundredth row of ``embeddings``."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"))


def op5_link_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text of ``documents``."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        secrets.span_text().alias("spans"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every text; the trusted ones are labelled good."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.judge(table(spark, sf_dir, "documents"), trusted)


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of each category and verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model)


def op8_write_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``pages`` as it is read back from the archives written."""
    folder = new_scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(warc.committed(spark, folder), folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text of ``documents``."""
    return pii.digests(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document of ``documents``."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row of ``embeddings``, for each of its positives."""
    return negatives.mine(table(spark, sf_dir, "embeddings"))


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every url of ``pages``."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.judge(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scoring phrases of each language of ``documents``."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


QUERIES = {
    "op1_hidden_markov_scores": op1_hidden_markov_scores,
    "op2_simhash_near_duplicates": op2_simhash_near_duplicates,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_kd_tree_search": op4_kd_tree_search,
    "op5_link_secrets": op5_link_secrets,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity_chain": op7_toxicity_chain,
    "op8_write_archives": op8_write_archives,
    "op9_personal_data": op9_personal_data,
    "op10_mix_sources": op10_mix_sources,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_url_filter": op12_url_filter,
    "op13_phrase_collocations": op13_phrase_collocations,
}

# The others need a hash, tokenizer or trained model that SQL lacks.
ORACLES = {
    "op4_kd_tree_search": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (
  SELECT vec_id, list_transform(v, lambda x: x::BIGINT) AS v FROM usable
  WHERE list_sum(list_transform(v, lambda x: x * x)) < 4611686018427387904),
queries AS (
  SELECT * FROM whole WHERE vec_id % 100 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v) = 1),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM queries q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored) WHERE rank <= 10""",
    "op8_write_archives": """
WITH payloads AS (
  SELECT page_id, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes
  FROM pages),
placed AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first,
         row_number() OVER (PARTITION BY digest ORDER BY page_id NULLS LAST) AS place
  FROM payloads)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN bytes >= 100 AND first IS NOT NULL AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND first IS NOT NULL AND place > 1 THEN first END AS refers_to
FROM placed""",
    "op11_hard_negatives": """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (
  SELECT * FROM whole WHERE vec_id % 50 = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM anchors a JOIN whole c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same QUALIFY place <= 5),
fitting AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM fitting WHERE rank <= 3""",
    "op13_phrase_collocations": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
cut AS (
  SELECT lang, w[i : i + size - 1] AS phrase
  FROM places, range(1, 6) t(size) WHERE i + size - 1 <= len(w)),
counts AS (SELECT lang, phrase, count(*) AS a FROM cut GROUP BY ALL HAVING a >= 100),
candidates AS (SELECT * FROM counts WHERE len(phrase) > 1),
inside AS (
  SELECT lang, phrase[i : i + size - 1] AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, len(phrase))) AS i FROM candidates WHERE len(phrase) > 2), range(2, 5) t(size)
  WHERE size < len(phrase) AND i + size - 1 <= len(phrase) GROUP BY ALL),
kept AS (
  SELECT c.lang, c.phrase, c.a FROM candidates c LEFT JOIN inside i
    ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a),
cuts AS (SELECT *, unnest(range(1, len(phrase))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN totals t ON c.lang = t.lang
  JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[: c.k]
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[c.k + 1 :]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank
  FROM scored) WHERE rank <= 2000""",
    "op12_url_filter": rf"""
WITH rules(host, path, verdict) AS (VALUES {_values(URL_RULES)}),
words(word) AS (VALUES {_values((w,) for w in urls.WORDS)}),
parts AS (
  SELECT row_number() OVER () AS i, page_id,
         translate(coalesce(regexp_extract(url, '{urls.PARTS}', 1), ''), '{urls.CAPITALS}',
                   '{urls.CAPITALS.lower()}') AS host,
         coalesce(regexp_extract(url, '{urls.PARTS}', 2), '') AS path
  FROM pages),
fitting AS (
  SELECT i, r.host || r.path AS rule, verdict FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) = 1)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN list_has_any(regexp_split_to_array(host, '[.\-_]'),
                                                (SELECT list(word) FROM words))
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fitting USING (i)""",
}
