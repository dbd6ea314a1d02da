"""The document pipeline: stages as (name, function) in ``STAGES``.

Each function takes (spark, docs, sf_dir) and returns a DataFrame.  ``run``
chains them over the documents table and writes every stage's rows as Parquet
in the shared folder before the next stage reads them, so a lost executor
costs one stage's tasks at most.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from reelhouse.llm.common import keep, table
from reelhouse.llm.decontaminate import drop_contaminated
from reelhouse.llm.neardup import drop_near_duplicates
from reelhouse.llm.secretscan import redact
from reelhouse.llm.toxicity import drop_toxic, fit
from reelhouse.llm.wordbpe import token_ids


def toxicity(spark, docs, sf_dir):
    """Documents that the classifier chain finds toxic go."""
    return drop_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def minhash_neardup(spark, docs, sf_dir):
    """One document of each near-duplicate group (five words, 0.8) stays."""
    return drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark window go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark, docs, sf_dir):
    """Secrets in the texts are masked; every document stays."""
    return redact(docs)


def word_bpe(spark, docs, sf_dir):
    """Token ids of every document, with digests of ids and decoded text."""
    return token_ids(docs)


STAGES = [("toxicity", toxicity), ("minhash_neardup", minhash_neardup), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("word_bpe", word_bpe)]

#: SQL has no form for the first stage (a fitted classifier) or the last (a tokenizer).
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = keep(docs, f"pipeline-{name}")
    return docs
