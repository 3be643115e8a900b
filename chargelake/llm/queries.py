"""The registered queries of this subpackage; SQL for them is in oracles.py."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake.llm import (
    chunks, infill, itq, merkle, mixing, packing, ppm, qda, resample, simhash, substring, urllists,
    warc)
from chargelake.llm.common import doc_id, table

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left outside of 35-word windows that occur again."""
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95 or more."""
    return itq.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048, 1024, 512 or 256 tokens."""
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document; fingerprints link at 4 or fewer bits."""
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels not held out."""
    return qda.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages, taken as responses."""
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and its edited text."""
    return merkle.fingerprinted(table(spark, sf_dir, "documents")).withColumn(
        "edited_sha256", F.sha2("edited", 256)).drop("edited")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    sizes = mixing.sized(docs)
    taken = mixing.mix(docs, sizes=sizes).groupBy("id", "key", "copy").agg(
        F.sum(F.col("stop") - F.col("start")).alias("taken"))
    shares = mixing.targets(sizes).withColumnRenamed("source", "name")
    return (
        sizes.join(taken, ["id", "key", "copy"], "left")
        .join(shares, F.col("source").eqNullSafe(F.col("name")))
        .select(doc_id(), "source", "size", F.col("total").alias("source_size"), "target",
                F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by context trees of the documents not held out."""
    return ppm.language_of(table(spark, sf_dir, "documents")).select(
        "row.doc_id", ppm.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def _digit(text: str, place: int) -> Column:
    return F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(text), place, 1)) - 1


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists over the hosts, sections and domains of the pages.

    The tables hold no lists; digits of each pattern's MD5 say whether and when it is
    listed, taken off and listed again, so the lists grow with the pages.
    """
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")

    def dated(days: Column) -> Column:
        return start + F.make_dt_interval(days)

    asked = pages.select(F.explode(urllists.patterns(F.col("url"))).alias("pattern")).distinct()
    host = F.substring_index("pattern", "/", 1)
    slashes = F.regexp_count("pattern", F.lit("/"))
    labels = F.regexp_count(host, F.lit(r"\."))
    first = _digit("pattern", 2) * 2
    off = first + 1 + _digit("pattern", 3)
    hosts = asked.filter((slashes == 0) & (labels > 1) & (_digit("pattern", 1) < 8))
    sections = asked.filter((slashes == 1) & (_digit("pattern", 1) < 4))
    domains = asked.filter((slashes == 0) & (labels == 1) & (_digit("pattern", 1) < 12))

    def listed(rows: DataFrame, name: str, action: str, days: Column) -> DataFrame:
        return rows.select(F.lit(name).alias("list"), "pattern", F.lit(action).alias("action"),
                           dated(days.cast("int")).alias("dated"))

    removed = hosts.filter(_digit("pattern", 4) < 8)
    return (
        listed(hosts, "hosts", "block", first)
        .unionByName(listed(removed, "hosts", urllists.REMOVED, off))
        .unionByName(listed(removed.filter(_digit("pattern", 5) < 8), "hosts", "block", off + 3))
        .unionByName(listed(sections, "sections", "allow", first))
        .unionByName(listed(domains, "domains", "review", first))
    )


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched within 30 days, judged by the list entries active at that time."""
    pages = table(spark, sf_dir, "pages")
    fetched = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.pmod(F.col("page_id") * 7919, F.lit(2_592_000)))
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", fetched.alias("fetched"))
    return urllists.as_of(captures, list_entries(pages)).withColumnRenamed("capture_id", "page_id")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, a tenth drawn towards the benchmark texts."""
    return resample.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded from its ids."""
    path = public_tokenizers.path(BYTE_TOKENIZER)
    encoded = chunks.encode(table(spark, sf_dir, "documents"), path)
    return chunks.decode(encoded, path).select(
        "row.doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed for filling in the middle, and restored."""
    text = infill.restored(F.col("output"), F.col("form"))
    return infill.fill_in_middle(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_packing": op3_packing,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_fingerprints": op7_fingerprints,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_url_lists": op10_url_lists,
    "op11_resampling": op11_resampling,
    "op12_bpe": op12_bpe,
    "op13_infill": op13_infill,
}
