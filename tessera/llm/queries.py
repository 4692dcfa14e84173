"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import (bpe_automaton, chat_format, collocations, fingerprints, jaccard_join, licenses, line_dedup,
                         mixing, secrets, token_counts, topk, toxicity, whitening)
from tessera.session import ensure_checkpoint_dir, read_table

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return read_table(spark, sf_dir, name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text of documents."""
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of documents."""
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["name"].isin([r.kind for r in secrets.RULES if r.base]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
                        secrets.as_text(F.col("spans")).alias("spans"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated to tempered source weights and shuffled."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.source", "row.text", "copies", "copy", "mix_key")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document when lines repeated over documents go."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.kept(docs, line_dedup.keep_bitmaps(docs))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of documents, learnt from the labels that are not held out."""
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), weighting=toxicity.MARKED)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    return fingerprints.with_next(_table(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best vectors for every vector whose id is divisible by 100."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of documents and the text they decode to."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_automaton.encode(docs, public_tokenizers.path(TOKENIZER), carry=["doc_id"])
    return coded.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard_join.near_groups(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every whole text of documents."""
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("blocks")


#: The conversation that op11 formats beside the table: both turns try to end themselves early.
HOSTILE = r"\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, read back from the formatted text."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(HOSTILE).alias("text"))
    chats = chat_format.format_chats(turns.unionByName(own), chat_format.text_parts(F.col("text")))
    read = F.transform(chat_format.turns_of(F.col("formatted")), chat_format.read_turn)
    told = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), chat_format.unescaped(t["body"]), F.lit("\n")))
    return chats.withColumns({
        "read": read, "trained": F.array_join(chat_format.read_loss(F.col("formatted"), F.col("loss")), "")}).select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return collocations.best(collocations.mine(_table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitening components of every embedding; a deviation beyond 64 bits is null."""
    white = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_secret_scan, op3_mix_sources, op4_line_dedup, op5_toxicity, op6_fingerprints,
    op7_exact_topk, op8_bpe_round_trip, op9_ngram_jaccard_join, op10_license_scan, op11_chat_format,
    op12_collocations, op13_whitening)}


def _span_sql(rule: secrets.Rule, n: int) -> str:
    pattern = rf"(?s)(.*?)(?:({rule.pattern})|\z)".replace("'", "''")
    return f"""
  SELECT doc_id, {n} AS kind, '{rule.kind}' AS name, z[1] AS gap, z[2] AS m, z[3] AS s, i FROM (
    SELECT doc_id, unnest(list_zip(regexp_extract_all(t, '{pattern}', 1), regexp_extract_all(t, '{pattern}', 2),
      regexp_extract_all(t, '{pattern}', {2 + rule.group}))) AS z,
      generate_subscripts(regexp_extract_all(t, '{pattern}', 1), 1) AS i FROM d)"""


def _secret_sql() -> str:
    least = " ".join(f"WHEN {n} THEN {r.least}" for n, r in enumerate(secrets.RULES))
    base = ", ".join(str(n) for n, r in enumerate(secrets.RULES) if r.base)
    each = " UNION ALL ".join(_span_sql(r, n) for n, r in enumerate(secrets.RULES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), pieces AS ({each}),
placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM pieces),
found AS (SELECT doc_id, kind, name, CAST(e - length(m) AS BIGINT) AS b, CAST(e AS BIGINT) AS e FROM placed
  WHERE length(m) > 0 AND length(s) >= CASE kind {least} END),
told AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
  string_agg(name || ':' || b || ':' || e, ',' ORDER BY b, kind) FILTER (kind IN ({base})) AS base,
  string_agg(name || ':' || b || ':' || e, ',' ORDER BY b, kind) AS spans FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN told USING (doc_id)"""


_LINE_SQL = """
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40 GROUP BY key
  HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, pos, line, owner IS NOT NULL AND doc_id < owner AS dropped
  FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_MIX_SQL = f"""
WITH sizes AS (SELECT coalesce('s' || source, 'n') AS key, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS size
  FROM documents GROUP BY 1),
rates AS (SELECT key, pow(size, {mixing.TEMPER}) / (SELECT sum(pow(size, {mixing.TEMPER})) FROM sizes)
  * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes WHERE size > 0),
cdf AS (SELECT key, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY key ORDER BY k) AS c
  FROM rates, generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT)) AS g(k)),
steps AS (SELECT key, list(c ORDER BY k) AS cdf FROM cdf GROUP BY key),
drawn AS (SELECT doc_id, source, text, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS own, cdf
  FROM documents JOIN steps ON key = coalesce('s' || source, 'n')),
counted AS (SELECT *, CAST(len(list_filter(cdf, lambda c: c < (CAST(('0x' ||
  substr(md5('{mixing.SEED}:' || own), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0)) AS INTEGER) AS copies FROM drawn)
SELECT doc_id, source, text, copies, CAST(copy AS INTEGER) AS copy,
  md5('{mixing.SEED}:deal:' || own || ':' || copy) AS mix_key
FROM counted, generate_series(1, copies) AS g(copy)"""

_TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
  CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

_CHAT_SQL = r"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
hidden AS (SELECT *,
  CASE WHEN starts_with(role, '|') THEN '\' ELSE '' END || replace(replace(role, '\', '\\'), '<|', '<\|') AS r,
  CASE WHEN starts_with(text, '|') THEN '\' ELSE '' END || replace(replace(text, '\', '\\'), '<|', '<\|') AS t
  FROM given)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>' || r || '<|body|>' || t || '<|end|>') + 1) AS BIGINT) AS formatted_chars
FROM hidden GROUP BY conv_id"""

_COLLOCATION_SQL = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1),
  lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM split, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL
  HAVING count(*) >= 10),
words AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
parts AS MATERIALIZED (SELECT lang, k, phrase, f, cut, lang || ' ' || array_to_string(w[1:cut], ' ') AS pl,
  lang || ' ' || array_to_string(w[cut + 1:k], ' ') AS pr FROM counts, (VALUES (1), (2)) AS p(cut) WHERE cut < k),
known AS MATERIALIZED (SELECT lang || ' ' || phrase AS p, f FROM counts),
lefts AS MATERIALIZED (SELECT parts.*, known.f AS l FROM parts JOIN known ON pl = p),
cuts AS (SELECT lefts.*, known.f AS r, (1000000::HUGEINT * lefts.f * lefts.f) // (l::HUGEINT * known.f) AS score
  FROM lefts JOIN known ON pr = p),
low AS (SELECT lang, k, phrase, f AS a, l, r, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (SELECT lang, part, max(f) AS longer FROM (
  SELECT lang, f, array_to_string(w[1:2], ' ') AS part FROM counts WHERE k = 3
  UNION ALL SELECT lang, f, array_to_string(w[2:3], ' ') FROM counts WHERE k = 3) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN around ON around.lang = low.lang AND part = phrase AND k = 2
  WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score FROM kept JOIN words USING (lang) QUALIFY rank <= 2000"""

ORACLE_SQL = {
    "op2_secret_scan": _secret_sql(),
    "op3_mix_sources": _MIX_SQL,
    "op4_line_dedup": _LINE_SQL,
    "op7_exact_topk": _TOPK_SQL,
    "op11_chat_format": _CHAT_SQL,
    "op12_collocations": _COLLOCATION_SQL,
}
