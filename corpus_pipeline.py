"""From raw documents to packed training windows in five stages.

Each stage works on all rows its predecessor wrote. The order: drop documents of poor quality,
then all but one of equal texts, then all but one of near copies, repeat what is left to even
shares of its sources, and pack it.
"""

from fleetpulse.llm import exact_dedup, mixing, near_dedup, packing, quality
from fleetpulse.llm.common import table, written


def quality_classifier(spark, docs, sf_dir):
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark, docs, sf_dir):
    return exact_dedup.drop_exact_copies(docs)


def near_dedup_stage(spark, docs, sf_dir):
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark, docs, sf_dir):
    return mixing.replicated(docs)


def packing_stage(spark, docs, sf_dir):
    return packing.packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither a trained classifier nor the packing; tests/llm/test_pipeline.py compares run()
#: with plain Python, given the trained model.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The pieces of all packed windows; every stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
