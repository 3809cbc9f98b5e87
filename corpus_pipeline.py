"""The corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return rows with the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigilo.llm.common import stored, table  # noqa: E402
from vigilo.llm.exact_dedup import drop_duplicates  # noqa: E402
from vigilo.llm.mixing import mix  # noqa: E402
from vigilo.llm.near_dedup import drop_near_duplicates  # noqa: E402
from vigilo.llm.packing import pack_documents  # noqa: E402
from vigilo.llm.queries import word_tokenizer  # noqa: E402
from vigilo.llm.toxicity import drop_toxic  # noqa: E402


def toxicity_stage(spark, docs, sf_dir):
    """Documents that the labelled neighbours call toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark, docs, sf_dir):
    """Of equal texts (white space aside) the smallest doc_id stays."""
    return drop_duplicates(docs)


def near_dedup_stage(spark, docs, sf_dir):
    """One document of each class of near-duplicates stays."""
    return drop_near_duplicates(docs)


def mixing_stage(spark, docs, sf_dir):
    """Each document as often as the mix draws it (0 to 3 times), in shard order."""
    return mix(docs)


def packing_stage(spark, docs, sf_dir):
    """Pieces of documents in sequences of at most 4096 tokens."""
    return pack_documents(docs, word_tokenizer())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The toxicity model, the streamed state and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
