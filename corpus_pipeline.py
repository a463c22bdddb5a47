"""The corpus pipeline: quality, exact copies, near copies, personal data, packing.

Every stage takes (spark, docs, sf_dir), where docs is a stored table, and returns a DataFrame.
An empty table passes through all stages; null texts are kept as empty documents where the quality
stage keeps them.
"""

import public_tokenizers

from boardtide.llm import block_naming, crf, packing, pii, prob_minhash
from boardtide.llm.common import Stage, table


def quality(spark, docs, sf_dir):
    return crf.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    return block_naming.drop_copies(spark, docs)


def near(spark, docs, sf_dir):
    return prob_minhash.drop_near(spark, docs)


def private(spark, docs, sf_dir):
    return pii.redact(spark, docs)


def pack(spark, docs, sf_dir):
    return packing.pack_documents(
        spark, docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True
    ).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("private", private), ("pack", pack)]
ORACLE_SQL = None


def run(spark, sf_dir):
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage.keep(fn(spark, docs, sf_dir), name)
    return docs
