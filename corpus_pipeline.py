"""A training corpus from ``documents``: reject poor texts, keep one of each near-duplicate class, drop
benchmark leaks, mix the sources to their target weights and lay the result out in shards.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
``run`` writes as Parquet under the shared scratch root and reads again as the next stage's documents.
The last stage returns the placement (doc_id, lang, source, n_chars, size, text_crc32, shard, slot) of
each row of the mix; a document that the mix takes twice has two rows.

Defined results: rows are documents whatever their doc_id, repeated or null. A null text scores as the empty
text; empty and null texts are copies of each other (near_dedup keeps one), leak nothing and are not
taken by the mix, which goes by words. Ties go to the least doc_id. An empty table passes through every stage
and gives no rows. Other columns stay up to the last stage, whatever their names; that one sets size,
text_crc32, shard and slot.
"""

from __future__ import annotations

from ratewise.llm.bag_minhash import keep_one
from ratewise.llm.common import stored, table
from ratewise.llm.decontaminate import drop_leaks
from ratewise.llm.mixing import mix_documents
from ratewise.llm.quality import keep_good
from ratewise.llm.sharding import place_documents
from ratewise.session import apply_conf


def quality(spark, docs, sf_dir):
    """Documents that the compression classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate class."""
    return keep_one(docs)


def decontaminate(spark, docs, sf_dir):
    """Documents that leak no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark, docs, sf_dir):
    """The documents of the mix, as often as it takes them."""
    return mix_documents(docs)


def shard(spark, docs, sf_dir):
    """The shard and slot of each row."""
    return place_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: SQL expresses neither the classifier, the signatures nor the latent space: tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    apply_conf(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
