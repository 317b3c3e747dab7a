"""Registered queries of this package, with their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe, embedding_dedup, fingerprint, language, lexical_search, minhash, mixing, packing, quality, spelling, substring_dedup,
    suffix_dedup, twins, url_filter,
)
from clickloom.llm.common import fold_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TWINS = {
    "op1_embedding_dedup": twins.EMBEDDINGS,
    "op8_substring_dedup": twins.WORD_WINDOWS,
    "op9_minhash_dedup": twins.MINHASH,
    "op10_suffix_array_dedup": twins.BYTE_WINDOWS,
    "op11_lexical_search": twins.LEXICAL_SEARCH,
}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query; its twin, if SQL has one, stands in TWINS."""
    QUERIES[run.__name__] = run
    if run.__name__ in TWINS:
        ORACLES[run.__name__] = TWINS[run.__name__]
    return run


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and hashes of the token ids, and hash of the decoded text, of every whole text."""
    digests = bpe.Bpe(vocabulary()).digests("text")
    return table(spark, sf_dir, "documents").select("doc_id", digests.alias("d")).select("doc_id", "d.*")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the rows of folds 1 to 4 of 5."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of("doc_id", 5) == 0)
    model = language.fit(docs.where("NOT held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score", "language.rejected")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learned from the labels of folds 0, 1 and 3 of 4."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of("doc_id", 4) == 2)
    model = quality.fit(docs.where("NOT held_out"), table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", "held_out", model.column("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)
    kept = F.col("id") == F.col("component")
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    rows = mixed.withColumn("_", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))))
    taken = (F.col("size") * F.col("copies")).cast("long")
    return rows.select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "rate", "copies", taken.alias("taken")
    )


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query
def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness."""
    pairs = fingerprint.edited_pairs(table(spark, sf_dir, "documents"))
    prints = pairs.withColumn("edited_fingerprint", fingerprint.fingerprint(F.col("edited")))
    return prints.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        fingerprint.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprint.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every whole text once windows of 20 words that start earlier too are gone."""
    kept = substring_dedup.kept_words(table(spark, sf_dir, "documents"), 20, hashed=True)
    return kept.withColumnsRenamed({"id": "doc_id", "kept": "kept_sha256"})


@query
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, component and verdict of every whole text."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
    kept = F.col("id") == F.col("component")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


@query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every whole text once strings of 100 bytes that start earlier too are gone."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"), 100).withColumnRenamed("id", "doc_id")


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.withColumnRenamed("id", "doc_id")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and number of near words of every word of the documents."""
    return spelling.variant_groups(table(spark, sf_dir, "documents"), least=7, occurrences=2, factor=10, noise=31)


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2,048 tokens."""
    pieces = packing.Packer(byte_vocabulary(), 2048).pieces(table(spark, sf_dir, "documents"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
