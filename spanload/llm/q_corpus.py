"""Queries on ``documents`` and ``labels``: op5, op7, op9, op12 and op13."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from spanload.llm import lm, mixing, phrases, quality, toxicity
from spanload.llm.common import read_table
from spanload.llm.q_text import VOCABULARY
from spanload.llm.queries import register

#: Shares of tokens that op5 and the pipeline mix to.
TARGETS = {"good": 0.9, "junk": 0.04, "toxic": 0.06}


def domains(spark, sf_dir):
    """The labelled table's domains: junk, or else toxic, or else good."""
    return read_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").otherwise("good")
        .alias("domain"))


@register("op5_mixing")
def op5(spark, sf_dir):
    """A rate for every document."""
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"), domains(spark, sf_dir), TARGETS)
    return mixed.select("doc_id", "n_tokens", *[F.coalesce(F.col("posteriors")[d], F.lit(0.0)).alias(f"p_{d}")
                                                for d in sorted(TARGETS)], "rate", "copies")


@register("op7_quality")
def op7(spark, sf_dir):
    """Every document's probability of being good; a source is the host, a language its path."""
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("row_key")


@register("op9_lm")
def op9(spark, sf_dir):
    """Every document's log10 probability, by the attention model and by the unigram base."""
    return lm.score_documents(read_table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


OP12_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang HAVING sum(len(w)) > 0),
f AS (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM (SELECT *, unnest(range(1, least(4, len(w)) + 1)) AS k FROM w))
  GROUP BY lang, phrase, k HAVING count(*) >= 30
), c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.j, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS one, array_to_string(w[j + 1:k], ' ') AS two
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c)) c
  JOIN f l ON l.lang = c.lang AND l.phrase = c.one JOIN f r ON r.lang = c.lang AND r.phrase = c.two
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@register("op12_phrases", OP12_SQL)
def op12(spark, sf_dir):
    """The collocations of each language, from all documents."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


@register("op13_toxicity")
def op13(spark, sf_dir):
    """Every document's toxicity; labels are learned from four of five documents."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), held)
