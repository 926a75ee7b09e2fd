"""Corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

The stages are the text operators of ``scholarium.llm``: the quality filter, near-duplicates, redaction of
personal data, mixing to target weights, SentencePiece ids. All but the last return the columns of
``documents``. SQL can't express them, so ``ORACLE_SQL`` is None and the tests use brute force.

Null and empty texts, and those without words, go in the first stage. Rows without a doc_id are nobody's copies and stay. Rows that share
a doc_id are one document: all of them stay or go, so an exactly repeated row stays as often as it stands there; of different ids the smallest
is kept, which also decides ties. Whole texts count at any length. Columns beyond those of ``documents``, whatever their names, are carried up
to the last stage, which returns its own columns alone. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarium.llm import identifiers, mixing, near_duplicates, quality, sentencepieces
from scholarium.llm.common import discard, settled_alone, table

#: The stage follows op9's contract of two-word shingles; see README.
SHINGLE_WORDS = 2


def keep_quality(spark, docs, sf_dir):
    """Documents whose perplexity is within their language's bound; the others go."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    found = near_duplicates.near_duplicates(docs, words=SHINGLE_WORDS)
    gone = found.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def redact_identifiers(spark, docs, sf_dir):
    """The documents with personal data replaced by the kind's name; ``n_chars`` counts the new text."""
    redacted = identifiers.redact_column(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def mix_sources(spark, docs, sf_dir):
    """The documents repeated or left out so that each source's words meet its target."""
    return mixing.repeat_documents(docs)


def encode_pieces(spark, docs, sf_dir):
    """doc_id, lang, source, ids and n_pieces of every document of the mix."""
    coded = sentencepieces.encode_documents(docs.select("doc_id", "lang", "source", "text"))
    return coded.withColumn("n_pieces", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("identifiers", redact_identifiers),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for the documents in ``sf_dir``."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        # what a stage writes on the way, and the stage before it, are read no more once it is written
        docs = settled_alone(spark, lambda docs=docs, stage=stage: stage(spark, docs, sf_dir), name)
        discard(*before)
        before = [docs]
    return docs
