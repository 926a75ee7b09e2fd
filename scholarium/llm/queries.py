"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

import corpus_pipeline

from . import ball_tree, centroids, identifiers, licenses, mixing, near_duplicates, quality, repeated_spans, sentencepieces, token_alignment, token_codes, toxicity, transport_stream
from .common import spread, table


def _documents(spark, sf_dir):
    """The documents, over all cores where they lie in few row groups."""
    return spread(table(spark, sf_dir, "documents"))


def op1_transport_stream(spark, sf_dir):
    """Every document's text as an MPEG transport stream, read back and digested."""
    return transport_stream.stream_digests(_documents(spark, sf_dir))


def op8_mix_sources(spark, sf_dir):
    """All documents mixed to the sources' target weights."""
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op10_license_scan(spark, sf_dir):
    """Licence notices and expressions in every document."""
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op3_identifiers(spark, sf_dir):
    """Personal data in every document, disguised or not."""
    return identifiers.find_identifiers(_documents(spark, sf_dir))


def op2_sentencepiece(spark, sf_dir):
    """Every document encoded by the transducer and decoded again."""
    return sentencepieces.encode_round_trip(_documents(spark, sf_dir))


def op4_toxicity(spark, sf_dir):
    """Every document's toxicity by the convolutional classifier."""
    return toxicity.score_toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_near_duplicates(spark, sf_dir):
    """Near-duplicate components of all documents by min-max hashing."""
    return near_duplicates.near_duplicates(_documents(spark, sf_dir))


def op7_quality(spark, sf_dir):
    """Every document's perplexity under the trusted model, and whether it stays."""
    return quality.quality(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op6_top_k(spark, sf_dir):
    """The twenty best inner products of every twentieth vector by ball trees."""
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"))


def op5_repeated_spans(spark, sf_dir):
    """Every document without the strings of 200 bytes that repeat."""
    return repeated_spans.repeat_digests(_documents(spark, sf_dir))


def op11_token_alignment(spark, sf_dir):
    """Every document's tokens of two vocabularies, aligned in groups."""
    return token_alignment.align_documents(_documents(spark, sf_dir))


def op12_centroid_clusters(spark, sf_dir):
    """Every vector's nearest of forty centroids after five rounds by Orchard's search."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_token_codes(spark, sf_dir):
    """Every document's token ids from files of directly addressable codes."""
    return token_codes.token_digests(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    """The stages of ``corpus_pipeline`` over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_transport_stream,
    op2_sentencepiece,
    op3_identifiers,
    op4_toxicity,
    op5_repeated_spans,
    op6_top_k,
    op7_quality,
    op8_mix_sources,
    op9_near_duplicates,
    op10_license_scan,
    op11_token_alignment,
    op12_centroid_clusters,
    op13_token_codes,
    pipeline,
)

_ORACLES = {
    "op8_mix_sources": mixing.ORACLE,
    "op6_top_k": ball_tree.ORACLE,
    "op12_centroid_clusters": centroids.ORACLE,
}


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
