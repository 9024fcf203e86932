"""The registered queries of the operators, with production parameters, and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (bin_slack, chat, dimension_scan, fertility, html_layout, line_dedup, order_minhash, pairwise_quality, pieces, spelling, toxicity,
                           url_filter, whitening)
from eventloom.llm.common import table

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.verdicts(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
seen AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
fits AS (
  SELECT page_id, host, path,
         host = 'org' OR ends_with(host, '.org') AS in_org, host = 'com' OR ends_with(host, '.com') AS in_com,
         host = 'example.org' OR ends_with(host, '.example.org') AS in_example FROM seen),
ruled AS (
  SELECT page_id, host, path,
         CASE WHEN in_example AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN in_example AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN in_com AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN in_com AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN in_org AND starts_with(path, '/') THEN 'org/' END AS rule FROM fits)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return pairwise_quality.quality_scores(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op3_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return toxicity.toxicity_scores(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return order_minhash.near_duplicates(docs).select("doc_id", "class_id", "class_texts", "keep")


def op5_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bin_slack.pieces(docs, WORD_TOKENIZER, END_ID, with_ids=False).drop("ids")


def op6_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fertility.quality_rules(docs, PIECE_MODEL).drop("text")


def op7_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return dimension_scan.neighbours(vectors, vectors.filter("vec_id % 50 = 0"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_chars=1, max_repeated=None).select("doc_id", "n_lines", "n_repeats", "n_links", "dropped")


def op9_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.visible_text(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


def op10_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, PIECE_MODEL).select("doc_id", "ids")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(pieces.decoded("ids", PIECE_MODEL).cast("binary"), 256).alias("decoded_sha256"))


def op11_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(spelling.word_counts(docs, spelling.one_letter_lost(), keep=("doc_id",)))


def _crc_byte(crc: str) -> str:
    """Eight steps of the reflected CRC-32 polynomial."""
    for _ in range(8):
        crc = f"list_transform([{crc}], lambda v: xor(v >> 1, 3988292384 * (v & 1)))[1]"
    return crc


# Words one edit apart: one is the other without a letter, or both are the same without the letter at one place.
OP12_SQL = f"""
WITH RECURSIVE found AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS own,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
long AS (SELECT own, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY ALL),
coded AS (
  SELECT run, n, flatten(list_transform(string_split(own || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
         ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)]::BIGINT[] END)) AS bytes FROM long),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, byte: {_crc_byte("xor(crc, byte)")}), 4294967295) AS h FROM coded),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY ALL HAVING length(word) >= 7 AND sum(n) >= 2),
lost AS (
  SELECT word, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS k FROM words)),
near AS (
  SELECT lost.word, rest AS near FROM lost JOIN words w ON w.word = lost.rest
  UNION SELECT rest, lost.word FROM lost JOIN words w ON w.word = lost.rest
  UNION SELECT a.word, b.word FROM lost a JOIN lost b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word),
ranked AS (
  SELECT near.word, near, b.n AS near_n, a.n, row_number() OVER (PARTITION BY near.word ORDER BY b.n DESC, near) AS place, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN words a ON a.word = near.word JOIN words b ON b.word = near.near),
best AS (SELECT *, near_n >= 10 * n AS fits FROM ranked WHERE place = 1),
chain AS (
  SELECT word, word AS root, 0 AS depth FROM words
  UNION ALL SELECT chain.word, best.near, depth + 1 FROM chain JOIN best ON best.word = chain.root AND best.fits),
ends AS (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word)
SELECT w.word, CASE WHEN fits THEN near END AS form, root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN fits THEN near_n END AS form_n
FROM words w JOIN ends ON ends.word = w.word LEFT JOIN best ON best.word = w.word
"""


def op13_relational_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    marks = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    made = chat.format_conversations(turns.unionByName(marks))
    read = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       F.array_join(chat.read_learnt(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


# A block costs its three marks and its role, a further turn in it one mark; an escaped control string is one character longer.
OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\2~\3', 'g')) AS chars,
         length(regexp_replace(role, '([<\[])(\\*)(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\2~\3', 'g')) AS role_chars,
         role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE WHEN opens THEN length('<|im_start|><|im_mid|><|im_end|>') + role_chars ELSE length('<|im_next|>') END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_pairwise_quality, op3_counterfactual_toxicity, op4_order_minhash, op5_min_bin_slack, op6_fertility_rules,
                                 op7_dimension_scan, op8_line_dedup, op9_layout_text, op10_piece_spans, op11_jacobi_davidson, op12_spelling_variants,
                                 op13_relational_chat)}
ORACLES = {"op1_url_filter": OP1_SQL, "op12_spelling_variants": OP12_SQL, "op13_relational_chat": OP13_SQL}
