"""Registered queries of the text operators (production parameters, whole tables)."""

from __future__ import annotations

from reelhouse.llm.common import table
from reelhouse.llm.decontaminate import contamination
from reelhouse.llm.htmltext import BLOCK_SEPARATOR, main_texts
from reelhouse.llm.licenses import license_labels
from reelhouse.llm.merkle import verified_manifest
from reelhouse.llm.neardup import near_duplicates
from reelhouse.llm.periodic import periodic_runs
from reelhouse.llm.secretscan import secret_spans
from reelhouse.llm.substrings import remove_repeats
from reelhouse.llm.tokencount import token_counts
from reelhouse.llm.tokenfiles import written_and_read
from reelhouse.llm.topk import top_k
from reelhouse.llm.toxicity import fit, scores
from reelhouse.llm.wordbpe import encoded


def op1_html_extraction(spark, sf_dir):
    return main_texts(table(spark, sf_dir, "pages"), separator=BLOCK_SEPARATOR)


def op2_topk_search(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return scores(docs, fit(docs, table(spark, sf_dir, "labels")))


def op5_secret_scan(spark, sf_dir):
    return secret_spans(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_word_bpe(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_minhash_neardup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op10_token_files(spark, sf_dir):
    return written_and_read(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return verified_manifest(table(spark, sf_dir, "documents"))


def op12_license_scan(spark, sf_dir):
    return license_labels(table(spark, sf_dir, "documents"))


def license_phrases(spark, sf_dir):
    """What SQL can say about op12: the base phrases (no template)."""
    return op12_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_topk_search, op3_token_counts, op4_toxicity, op5_secret_scan, op6_substring_dedup,
    op7_word_bpe, op8_decontamination, op9_minhash_neardup, op10_token_files, op11_merkle_manifest, op12_license_scan,
    op13_periodic_runs, license_phrases)}
