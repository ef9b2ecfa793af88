"""Queries on ``documents`` and ``conversations``: op2, op6 and op11."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from spanload.llm import bpe, chat, repair
from spanload.llm.common import read_table
from spanload.llm.queries import register

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@register("op2_bpe")
def op2(spark, sf_dir):
    """Every whole text to ids and back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN).drop("text")
    both = bpe.decode(ids, VOCABULARY, public_tokenizers.PATTERN)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


OP6_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role IS NOT NULL AND role <> 'system'),
p AS (
  SELECT t.conv_id, coalesce(CAST(floor(turn / 256) AS BIGINT), -1) AS segment, speaker, turn, role, text,
    coalesce(role = speaker, false) AS own,
    CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
         ELSE '<|user:' || coalesce(role, 'unknown') || '|>' END || chr(10) AS head,
    coalesce(text, '') || '<|end|>' AS body
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), o AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, segment, speaker ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
      ROWS UNBOUNDED PRECEDING) AS upto
  FROM p
)
SELECT conv_id, segment, speaker, count(*) AS n_turns,
  string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS chat,
  coalesce(string_agg(CASE WHEN own THEN CAST(upto - 1 - length(body) AS VARCHAR) || '-' || CAST(upto - 1 AS VARCHAR) END,
           ',' ORDER BY upto), '') AS mask,
  CAST(sum(CASE WHEN own THEN length(body) ELSE 0 END) AS BIGINT) AS n_masked,
  CAST(max(upto) AS BIGINT) AS n_chars
FROM o GROUP BY conv_id, segment, speaker
"""


@register("op6_chat", OP6_SQL)
def op6(spark, sf_dir):
    """Every conversation, from the side of each of its participants."""
    return chat.rotate(read_table(spark, sf_dir, "conversations"))


def _op11_sql() -> str:
    """The states' best ways, row after row: struct of cost, audit and lines, which compare in that order."""
    def go(x, cost, letter, line=None):
        return f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 't': " + (f"list_append({x}.t, {line})" if line else f"{x}.t") + "}"

    def least(*xs):
        return f"list_sort([{', '.join(xs)}])[1]"

    none = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"
    written = {"u": "'user:'", "a": "'assistant:'"}

    def take(x, letter):  # the row, kept or given the role
        kept = f"CASE WHEN left(role, 1) = '{letter}' THEN {go(x, 'cut', 'K', "role || ':' || text")} ELSE {none} END"
        return f"CASE WHEN gone THEN {none} ELSE {least(kept, go(x, '2 + cut', 'R', written[letter] + ' || text'))} END"

    crc = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: unicode(c)::BIGINT)), "
           "lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))")
    return f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), hit AS (SELECT *, xor({crc}, 4294967295) % 20 AS f FROM src),
d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) WHERE f <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS i,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS z FROM d
), g AS (
  SELECT *, CASE WHEN z = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN z NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o
), r AS (SELECT conv_id, i, role, text, fault IN ('b', 'd') AS gone, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS cut FROM g),
w AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS e, {none} AS s, {none} AS u, {none} AS v
  FROM (SELECT DISTINCT conv_id FROM d)
  UNION ALL
  SELECT conv_id, i, {go('e', 3, 'D')},
    {least(go('s', 3, 'D'), f"CASE WHEN NOT gone AND left(role, 1) = 's' THEN {go('e', 'cut', 'K', "role || ':' || text")} ELSE {none} END")},
    {least(go('u', 3, 'D'), take('e', 'u'), take('s', 'u'), take('v2', 'u'))},
    {least(go('v', 3, 'D'), take('u2', 'a'))}
  FROM (
    SELECT *, {least('v', go('u2', 2, 'I', written['a']))} AS v2 FROM (
      SELECT w.conv_id, r.i, w.e, w.s, w.u, w.v, r.role, r.text, r.gone, r.cut,
        {least('w.u', go('w.e', 2, 'I', written['u']), go('w.s', 2, 'I', written['u']), go('w.v', 2, 'I', written['u']))} AS u2
      FROM w JOIN r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1))
), f AS (
  SELECT conv_id, {least('e', 'v', go('u', 2, 'I', written['a']), go('(' + go('s', 2, 'I', written['u']) + ')', 2, 'I', written['a']))} AS b
  FROM w QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN n ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
"""


@register("op11_conversation_repair", _op11_sql())
def op11(spark, sf_dir):
    """Every conversation, damaged and repaired at the least cost."""
    rows = read_table(spark, sf_dir, "conversations")
    found = repair.report(repair.repair(repair.damage(rows))).withColumnRenamed("conv_id", "found_id")
    ids = rows.select("conv_id").distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(found, ids["conv_id"].eqNullSafe(found["found_id"]), "left")
            .select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
