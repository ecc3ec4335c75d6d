"""Registered queries of the corpus operators, ``opN_<name>`` -> (spark, sf_dir) -> DataFrame.

Each applies its operator with production parameters to whole tables; ``LLM_ORACLE`` has DuckDB SQL
for those that SQL can express."""

from __future__ import annotations

from ratewise.llm import (
    bag_minhash, chat, decontaminate, license_scan, line_dedup, mixing, order_minhash, quality, repair, sharding, turn_repair,
    vector_codes, window_dedup)
from ratewise.llm.common import table
from ratewise.session import apply_conf, checkpoint_dir
from pyspark.sql import functions as F

LLM_QUERIES = {}
LLM_ORACLE = {}


def query(fn):
    def run(spark, sf_dir):
        apply_conf(spark)
        checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    LLM_QUERIES[fn.__name__] = run
    return fn


@query
def op1_repair_tokens(spark, sf_dir):
    """Place, length and CRC of every document's ids, read back from Re-Pair shard files."""
    import public_tokenizers

    files = repair.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), by_word=True)
    return repair.read_documents(files)


@query
def op2_decontaminate(spark, sf_dir):
    """The benchmark items that each document leaks."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_bag_minhash(spark, sf_dir):
    """The near-duplicate class of every document."""
    return bag_minhash.near_classes(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark, sf_dir):
    """Every document without the lines that repeated three-line windows cover."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_license_scan(spark, sf_dir):
    """Lines and whole texts that match a licence template."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op6_chat_format(spark, sf_dir):
    """All conversations and one that holds control strings, formatted, and read back."""
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(1).select(F.explode(F.array(*[F.struct(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
        F.lit(probe).alias("text")) for i, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.chat_digest(chat.format_chat(rows))


@query
def op7_order_minhash(spark, sf_dir):
    """Order MinHash of every text, of its edited form and likeness to that and to the next text."""
    return order_minhash.fingerprint_digest(table(spark, sf_dir, "documents"))


@query
def op8_quality(spark, sf_dir):
    """Quality score of every document, learned from the labelled rows that are not held out."""
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_label_shards(spark, sf_dir):
    """The shard and slot of every document, equal texts together where the sizes allow."""
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@query
def op10_mix_sources(spark, sf_dir):
    """What the mix takes of each document."""
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


@query
def op11_vector_codes(spark, sf_dir):
    """Code and error of every kept vector after four Lloyd rounds over cover trees."""
    return vector_codes.code_digest(table(spark, sf_dir, "embeddings"))


@query
def op12_turn_repair(spark, sf_dir):
    """Faults and cheapest repair of every conversation, its rows damaged first."""
    return turn_repair.repair_digest(table(spark, sf_dir, "conversations"))


@query
def op13_window_dedup(spark, sf_dir):
    """Every document without the words that windows of smaller documents cover."""
    return window_dedup.window_digest(table(spark, sf_dir, "documents"))


LLM_ORACLE["op4_line_dedup"] = line_dedup.ORACLE
LLM_ORACLE["op5_license_scan"] = license_scan.oracle()
LLM_ORACLE["op6_chat_format"] = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS erole, replace(replace(text, '\', '\\'), '<|', '<\|') AS etext,
    coalesce(lag(role) OVER w = role, false) AS joined
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(length(etext) + CASE WHEN joined THEN length('<|im_next|>')
       ELSE length('<|im_start|><|im_sep|><|im_end|>') + 1 + length(erole) END))::BIGINT AS formatted_chars,
  (count(*) FILTER (WHERE NOT joined))::BIGINT AS n_blocks
FROM e GROUP BY conv_id
"""
