"""The registered queries of the operators, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.durable import scratch_path
from vigia.llm import (
    bench_wand, group_matrix, lang_ecoc, line_bloom, line_crf, orchard_codes, order_minhash, pack_dp, secret_index, source_audit,
    token_orc, toxic_mil, unit_dedup,
)
from vigia.llm.textkit import crc_of_id


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-orc")
    token_orc.write_tokens(_table(spark, folder, "documents"), path, token_orc.TokenFile(public_tokenizers.path("byte_bpe_50k.json")))
    return token_orc.token_digest(token_orc.read_tokens(spark, path))


def op2_line_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs, rule = _table(spark, folder, "documents"), line_crf.LineCrfRule()
    return line_crf.judge(docs, line_crf.train(docs, _table(spark, folder, "labels"), rule), rule)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, rule = _table(spark, folder, "documents"), toxic_mil.ToxicRule()
    model = toxic_mil.train(docs, _table(spark, folder, "labels"), rule, crc_of_id(F.col("doc_id")) % 5 != 0)
    return toxic_mil.score(docs, model).select(
        "doc_id", (crc_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending"
    )


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_bloom.line_digest(_table(spark, folder, "documents"), line_bloom.LineRule(min_docs=10, min_key_chars=1))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    spec = pack_dp.Packing(public_tokenizers.path("word_bpe_49k.json"))
    return pack_dp.piece_digest(pack_dp.pack_documents(_table(spark, folder, "documents"), spec))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_index.secret_digest(secret_index.find_secrets(_table(spark, folder, "documents")))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs, rule = _table(spark, folder, "documents"), lang_ecoc.LanguageRule()
    model = lang_ecoc.train(docs, rule, crc_of_id(F.col("doc_id")) % 4 != 2)
    return lang_ecoc.predict(docs, model, rule).select(
        "doc_id", (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op8_unit_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return unit_dedup.repeats(_table(spark, folder, "documents"), unit_dedup.UnitRule())


def op9_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return bench_wand.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), bench_wand.BenchRule())


def op10_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    found = order_minhash.near_duplicates(_table(spark, folder, "documents"), order_minhash.OrderRule())
    return found.select("doc_id", "class_id", F.lower(F.hex("same")).alias("same_words"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return orchard_codes.code_digest(_table(spark, folder, "embeddings"), orchard_codes.CodeRule())


def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return group_matrix.linked_documents(_table(spark, folder, "documents"), group_matrix.JaccardRule()).select("doc_id", "n_shingles", "component_id")


def op13_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(_table(spark, folder, "documents"), source_audit.AuditRule())


QUERIES = {
    "op1_token_orc": op1_token_orc,
    "op2_line_crf": op2_line_crf,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_packing": op5_packing,
    "op6_secrets": op6_secrets,
    "op7_language": op7_language,
    "op8_unit_dedup": op8_unit_dedup,
    "op9_benchmark": op9_benchmark,
    "op10_near_dup": op10_near_dup,
    "op11_vector_codes": op11_vector_codes,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_source_audit": op13_source_audit,
}



def _secrets_sql() -> str:
    """Every rule searched in every text; places from the lengths of the matches and of what lies between them."""
    parts = []
    for order, rule in enumerate(secret_index.RULES):
        regex = "'" + rule.regex.replace("'", "''") + "'"
        measured = f"length(regexp_extract(m, {regex}, {rule.measured}))"
        parts.append(f"""
  SELECT doc_id, {order} AS place, '{rule.kind}' AS kind, start, start + length(m) AS stop
  FROM (SELECT doc_id, matches[i] AS m,
               list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:i-1], lambda x: length(x))), 0) AS start
        FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, {regex}, 0) AS matches, string_split_regex(text, {regex}) AS gaps FROM texts)))
  WHERE {measured} >= {rule.min_length}""")
    base = len(secret_index.BASE_RULES)
    joined = "coalesce(string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, place){}, '')"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), found AS ({" UNION ALL ".join(parts)})
SELECT t.doc_id,
       count(*) FILTER (WHERE kind = 'assign')::BIGINT AS n_assign,
       count(*) FILTER (WHERE kind = 'access')::BIGINT AS n_access,
       count(*) FILTER (WHERE kind = 'hex')::BIGINT AS n_hex,
       sha256({joined.format(f" FILTER (WHERE place < {base})")}) AS base_sha256,
       {joined.format(" FILTER (WHERE kind IS NOT NULL)")} AS spans
FROM texts t LEFT JOIN found f ON t.doc_id = f.doc_id
GROUP BY t.doc_id
"""


def _codes_sql(rounds: int = 2) -> str:
    """Every part measured against every entry of its codebook, in each round; all figures are integers."""
    steps = []
    for step in range(rounds + 1):
        steps.append(f"""
near{step} AS (
  SELECT vec_id, part, arg_min(entry, (gap, entry)) AS entry, min(gap) AS gap
  FROM (SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS gap
        FROM parts p JOIN book{step} b ON p.part = b.part)
  GROUP BY vec_id, part
)""")
        if step < rounds:
            steps.append(f"""
mean{step} AS (
  SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v
  FROM (SELECT n.part, n.entry, g.i, sum(p.v[g.i])::HUGEINT AS total, count(*) AS n
        FROM near{step} n JOIN parts p ON p.vec_id = n.vec_id AND p.part = n.part, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) g
        GROUP BY n.part, n.entry, g.i)
  GROUP BY part, entry
),
book{step + 1} AS (SELECT b.part, b.entry, coalesce(m.v::BIGINT[], b.v) AS v FROM book{step} b LEFT JOIN mean{step} m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v FROM kept, (SELECT unnest(range(16)) AS part)
), first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p.part, f.entry, p.v FROM first f JOIN parts p ON p.vec_id = f.vec_id), {",".join(steps)},
coded AS (
  SELECT k.vec_id, k.label, string_agg(lpad(lower(to_hex(n.entry)), 2, '0'), '' ORDER BY n.part) AS code, sum(n.gap)::BIGINT AS error
  FROM kept k JOIN near{rounds} n ON n.vec_id = k.vec_id GROUP BY k.vec_id, k.label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


#: The lines and their keys in plain SQL; chr(9) to chr(13) and the blank are what a key is stripped of.
ORACLES = {
    "op6_secrets": _secrets_sql(),
    "op4_line_dedup": """
WITH lines AS (
  SELECT doc_id, i, part AS line,
         regexp_replace(regexp_replace(part, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '') AS bare
  FROM (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), keyed AS (
  SELECT doc_id, i, line, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines
), often AS (
  SELECT line_key FROM keyed WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE o.line_key IS NOT NULL)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.line_key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN often o ON k.line_key = o.line_key
GROUP BY doc_id
""",
    "op11_vector_codes": _codes_sql(),
    "op12_jaccard_join": """
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                               ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM texts
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, len(any_value(s.s))::BIGINT AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id
""",
    "op13_source_audit": """
WITH texts AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM texts
), kept AS (SELECT lang, term, count(*) AS lang_uses FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
langs AS (
  SELECT g.lang, count(k.term) AS v, coalesce(sum(k.lang_uses), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang FROM texts) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang
), pairs AS (SELECT DISTINCT lang, source FROM texts),
uses AS (SELECT w.lang, w.source, w.term, count(*) AS uses FROM words w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
totals AS (SELECT p.lang, p.source, coalesce(sum(u.uses), 0)::HUGEINT AS total FROM pairs p LEFT JOIN uses u ON u.lang = p.lang AND u.source = p.source GROUP BY ALL),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(u.uses, 0) AS uses,
         1 + (1000000000 * (coalesce(u.uses, 0) + 5)::HUGEINT) // (t.total + 5 * l.v) AS p,
         1 + (1000000000 * (k.lang_uses + 5)::HUGEINT) // (l.total + 5 * l.v) AS q
  FROM totals t JOIN langs l ON l.lang = t.lang JOIN kept k ON k.lang = t.lang
  LEFT JOIN uses u ON u.lang = t.lang AND u.source = t.source AND u.term = k.term
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE uses > 0 AND p > q
)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
""",
}
