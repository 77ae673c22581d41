"""The corpus queries by name over the test tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import bpe, chat, html, language, leaks, mixing, neardup, neighbours, phrases, quality, rtree, secrets, toxicity
from basketlens.llm.arrow import word_count
from basketlens.session import configure, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base features and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.assessed(docs, keep=["doc_id"]).drop("class_distance", "word_distance")


SQL["op1_distribution_divergence"] = r"""
WITH d AS (
  SELECT doc_id, lang, text, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
windows AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS win,
    count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS width FROM words),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS times FROM windows WHERE width = 8) WHERE times > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) r(k) GROUP BY doc_id),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, d.lang, d.text, d.t, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(w) < 20 OR 100 * coalesce(covered.n, 0) > 30 * len(w) AS base_failed
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)),
sized AS (
  SELECT doc_id, lang, text, base_failed, length(t) AS n, length(regexp_replace(t, '[^\p{Ll}]', '', 'g')) AS c0,
    length(regexp_replace(t, '[^\p{Lu}\p{Lt}]', '', 'g')) AS c1, length(regexp_replace(t, '[^\p{Lm}\p{Lo}\p{M}]', '', 'g')) AS c2,
    length(regexp_replace(t, '[^\p{N}]', '', 'g')) AS c3,
    length(regexp_replace(regexp_replace(t, '[#*$%&|<>@+=~^`\/_]', '', 'g'), '[^\p{P}]', '', 'g')) AS c4,
    length(regexp_replace(t, '[^\p{S}#*$%&|<>@+=~^`\/_]', '', 'g')) AS c5,
    length(regexp_replace(t, '[^\p{Z}\x09-\x0D]', '', 'g')) AS c6 FROM base),
classes AS (SELECT doc_id, lang, text, base_failed, n, unnest([c0, c1, c2, c3, c4, c5, c6, n - c0 - c1 - c2 - c3 - c4 - c5 - c6]) AS c,
  unnest(range(8)) AS k FROM sized),
class_refs AS (
  SELECT lang, k, sum(c) / (sum(sum(c)) OVER (PARTITION BY lang)) AS q FROM classes
  WHERE lang IS NOT NULL AND NOT base_failed GROUP BY lang, k),
lowered AS (
  SELECT doc_id, lang, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word
  FROM words JOIN d USING (doc_id)),
ranked AS (
  SELECT lang, word, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS total,
    row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place
  FROM lowered JOIN (SELECT doc_id FROM base WHERE NOT base_failed) USING (doc_id) WHERE lang IS NOT NULL GROUP BY lang, word),
common AS (SELECT lang, word, total, n / total AS q FROM ranked WHERE place <= 100),
langs AS (SELECT lang, sum(q) AS q, greatest(0, 1 - sum(q)) AS rest, any_value(total) AS total FROM common GROUP BY lang),
by_class AS (
  SELECT doc_id, r.lang, any_value(n) AS n, sqrt(greatest(0, sum(CASE WHEN c > 0 THEN c / n * log2(c / n / ((c / n + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((c / n + q) / 2)) ELSE 0 END) / 2)) AS far
  FROM classes c JOIN class_refs r USING (k) WHERE n > 0 GROUP BY doc_id, r.lang),
counts AS (SELECT doc_id, word, count(*) AS c FROM lowered GROUP BY doc_id, word),
hits AS (
  SELECT doc_id, m.lang, sum(c) AS c, sum(q) AS q, sum(p * log2(p / ((p + q) / 2)) + q * log2(q / ((p + q) / 2))) AS s
  FROM (SELECT doc_id, word, c, c / n_words AS p FROM counts JOIN base USING (doc_id)) JOIN common m USING (word) GROUP BY doc_id, m.lang),
by_word AS (
  SELECT doc_id, lang, n_words, total, sqrt(greatest(0, (s + absent
    + CASE WHEN other > 0 THEN other * log2(other / ((other + rest) / 2)) ELSE 0 END
    + CASE WHEN rest > 0 THEN rest * log2(rest / ((other + rest) / 2)) ELSE 0 END) / 2)) AS far
  FROM (SELECT b.doc_id, l.lang, b.n_words, l.total, l.rest, coalesce(h.s, 0) AS s, l.q - coalesce(h.q, 0) AS absent,
          1 - coalesce(h.c, 0) / b.n_words AS other
        FROM base b CROSS JOIN langs l LEFT JOIN hits h ON h.doc_id = b.doc_id AND h.lang = l.lang WHERE b.n_words > 0)),
fits AS (
  SELECT doc_id, bool_or((c.n < 200 OR c.far <= 0.33) AND (w.n_words < 50
    OR w.far <= 0.24 + 2.2 * (1 / sqrt(w.n_words) + CASE WHEN lang = own.lang THEN 1 / sqrt(w.total) ELSE 0 END))) AS good
  FROM by_word w JOIN by_class c USING (doc_id, lang) JOIN (SELECT doc_id, lang FROM d) own USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(good, true) AS kept
FROM base LEFT JOIN fits USING (doc_id)
"""


@query
def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return neardup.clustered(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL["op2_minhash_neardup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct([w[i] || chr(10) || w[i + 1] for i in range(1, len(w))]) END AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""


@query
def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return neighbours.clustered(table(spark, sf_dir, "embeddings"))


SQL["op3_nn_descent"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(b) AS component_id, vec_id = min(b) AS kept
FROM embeddings JOIN reach ON reach.a = vec_id LEFT JOIN counts ON counts.a = vec_id GROUP BY vec_id
"""


@query
def op4_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.graded(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), keep=["doc_id"])


@query
def op5_tree_scoring_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extracted(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


@query
def op6_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


@query
def op7_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when the sources are mixed."""
    docs = table(spark, sf_dir, "documents")
    sizes = stored(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    return mixing.with_copies(sizes).select("doc_id", "size", "source_size", "target", "taken")


SQL["op7_systematic_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM sized GROUP BY source),
total AS (SELECT sum(source_size)::BIGINT AS everything FROM per_source),
walked AS (
  SELECT source, source_size, weight, everything,
    everything - coalesce(sum(3 * source_size) OVER before, 0) AS money,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM per_source, total
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (
  SELECT *, (3 * source_size)::DOUBLE * weight_left::DOUBLE <= money::DOUBLE * weight::DOUBLE AS at_cap FROM walked),
aims AS (
  SELECT source, source_size,
    CASE WHEN at_cap THEN (3 * source_size)::DOUBLE
    ELSE ((everything - coalesce(sum(3 * source_size) FILTER (at_cap) OVER (), 0)) * weight)::DOUBLE
         / (sum(weight) FILTER (NOT at_cap) OVER ())::DOUBLE END AS target
  FROM judged),
ranked AS (
  SELECT doc_id, size, a.source_size, a.target,
    CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix' || coalesce('=' || s.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS start,
    row_number() OVER (PARTITION BY s.source ORDER BY size, coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 4096, -1),
                       doc_id NULLS FIRST)::DOUBLE AS place
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
  ((floor(place * rate + start) - floor((place - 1) * rate + start)) * size)::BIGINT AS taken
FROM ranked
"""


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.with_ids(docs, ranks, public_tokenizers.PATTERN, digest=True, keep=["doc_id"])


@query
def op9_output_codes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the two thirds that are not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    known = docs.where(~F.col("held_out"))
    return language.identified(docs, known, keep=["doc_id", "held_out"])


@query
def op10_template_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn int, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.formatted(rows.unionByName(extra), digest=True)


SQL["op10_template_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(3 + 7 + 8 + 5 + length(role) + length(text)
      + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""


@query
def op11_aho_corasick_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks.scanned(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"]).drop("hits")


SQL["op11_aho_corasick_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
parts AS (
  SELECT item_id, w, least(10, len(w)) AS width, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS win FROM parts),
widths AS (SELECT DISTINCT width FROM wins),
places AS (SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM d, widths WHERE len(w) >= width),
met AS (
  SELECT p.r, p.i, p.width, s.item_id FROM (SELECT r, i, width, array_to_string(w[i:i + width - 1], ' ') AS win FROM places) p
  JOIN wins s ON p.width = s.width AND p.win = s.win),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT DISTINCT r, i, width FROM met), range(10) t(k) WHERE k < width GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.listed, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@query
def op12_rtree_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), "embedding")
    return rtree.mined(rows, F.col("id") % 100 == 0)


SQL["op12_rtree_hard_negatives"] = """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor, e.id, e.label = a.label AS same, list_dot_product(a.v::DOUBLE[], e.v::DOUBLE[])::BIGINT AS score
  FROM e a JOIN e ON a.id <> e.id WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.anchor AS anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id)::INT AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


@query
def op13_tiled_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


SQL["op13_tiled_collocations"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (
  SELECT r, lang, string_split(trim(regexp_replace(piece, '[\x20\x09]+', ' ', 'g')), ' ') AS w
  FROM (SELECT r, lang, unnest(string_split(translate(t, '.,;:!?' || chr(11) || chr(12) || chr(13), repeat(chr(10), 9)), chr(10))) AS piece FROM d)
  WHERE regexp_matches(piece, '[^\x20\x09]')),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 5) t(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS n FROM grams GROUP BY lang, k, phrase),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT * FROM f WHERE n >= 30),
candidates AS (SELECT * FROM frequent WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.n AS a, s AS cut, x.n AS l, y.n AS r, ((2000000::HUGEINT * c.n) // (x.n + y.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS s FROM candidates) c
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:s], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[s + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, n, array_to_string(w[b:b + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, n, m, unnest(range(1, k - m + 2)) AS b FROM candidates, range(2, 4) t(m) WHERE m < k)),
around AS (SELECT lang, phrase, max(n) AS n FROM inner_parts GROUP BY lang, phrase),
kept AS (
  SELECT c.* FROM lowest c LEFT JOIN around o ON o.lang = c.lang AND o.phrase = c.phrase
  WHERE o.n IS NULL OR 100::HUGEINT * o.n < 80::HUGEINT * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n, score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
