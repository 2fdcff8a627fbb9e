"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.llm import (
    exact_dedup,
    merkle,
    mixing,
    piece_codec,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filters,
)
from relocate.llm.common import documents, sample_class, table, whole
from relocate.session import configure, settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(work: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return work(configure(spark), sf_dir)

    QUERIES[work.__name__] = run
    return run


@query
def op1_secret_scan(spark, sf):
    """Every candidate of every document and whether it is a secret; the text only as a hash."""
    found = secrets.scan(documents(spark, sf, "doc_id", "text", "source"))
    return found.select(
        "doc_id",
        "position",
        "part",
        F.sha2(F.col("finding").cast("binary"), 256).alias("finding_sha256"),
        F.length("finding").alias("n_chars"),
        (sample_class(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        "secret",
    )


@query
def op2_source_mix(spark, sf):
    """Documents of the mix, once per epoch."""
    found = mixing.mix_documents(documents(spark, sf, "doc_id", "text", "lang", "source"))
    return found.select(
        "doc_id",
        "domain",
        whole("lang").alias("language"),
        whole("source").alias("leaf"),
        "n_tokens",
        "leaf_target",
        "epoch",
    )


@query
def op3_toxicity(spark, sf):
    """Score of every document; the held-out fold never meets training."""
    return toxicity.toxicity(documents(spark, sf, "doc_id", "text"), table(spark, sf, "labels"))


@query
def op4_suffix_dedup(spark, sf):
    """What is left of every document without passages that occur elsewhere."""
    found = suffix_dedup.remove_repeats(documents(spark, sf, "doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )


@query
def op5_simhash_near_dedup(spark, sf):
    """Fingerprint and component of every document."""
    found = simhash.near_groups(documents(spark, sf, "doc_id", "text"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op6_quality_rules(spark, sf):
    """Numbers and verdict of every document."""
    found = quality_rules.judge(documents(spark, sf, "doc_id", "text", "source"))
    return found.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


@query
def op7_token_counts(spark, sf):
    """Tokens of every document."""
    return token_counts.token_counts(documents(spark, sf, "doc_id", "text"))


@query
def op8_piece_codec(spark, sf):
    """Every document encoded with merge-dropout and decoded again: digests of both."""
    rows = piece_codec.decode(piece_codec.encode(documents(spark, sf, "doc_id", "text")))
    return piece_codec.digests(rows).select(
        "doc_id",
        "n_tokens",
        "ids_sha256",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == whole("text")).alias("lossless"),
    )


@query
def op9_exact_dedup(spark, sf):
    """The group of equal texts of every document. Texts that no step had to read are hashed here.

    What is known of each row is written before the groups are formed, so texts move once.
    """
    rows = exact_dedup.identified(documents(spark, sf, "doc_id", "text"))
    digest = F.sha2(exact_dedup.same_text(F.col("text")).cast("binary"), 256)
    told = rows.withColumn("text_sha256", F.coalesce("full_hash", digest)).drop("text")
    found = exact_dedup.grouped(settle(told, "identified"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op10_quality_classifier(spark, sf):
    """Score and verdict of every document from both views."""
    found = quality_classifier.score_quality(
        documents(spark, sf), table(spark, sf, "labels"), table(spark, sf, "pages")
    )
    held_out = sample_class(F.col("doc_id")) == 1
    return found.select("doc_id", held_out.alias("held_out"), "score", "text_score", "meta_score", "kept")


@query
def op11_merkle_manifest(spark, sf):
    """Leaf, proof and verdict of every document; a third of them are tampered with."""
    found = merkle.proofs(merkle.manifest(documents(spark, sf)))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_url_filters(spark, sf):
    """Host, path, rule and verdict of every page."""
    found = url_filters.judge(table(spark, sf, "pages"), table(spark, sf, "labels"))
    return found.select("page_id", "host", "path", "rule", "verdict", "template")


@query
def op13_prefix_trie(spark, sf):
    """The trie of all conversations, rebuilt on the openings they share."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))
