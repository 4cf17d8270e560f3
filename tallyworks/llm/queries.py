"""The queries of this subpackage: thin bindings of its operators to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    centroids, chat, decontaminate, infill, langid, lines, mixing, neighbours, packing, quality, simhash, substrings, urls,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    trees = chat.conversations_as_trees(_table(spark, folder, "conversations"), extra)
    return chat.read_back(chat.format_paths(trees)).drop("path_rank").withColumnRenamed("tree_id", "conv_id")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.flag(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), width=10)


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"), width=3, radius=2)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, folder, "documents"), width=13)
    digest = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", digest)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.deduplicate_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_removed", digest)


#: The rules of the page query: host, path, what to do.
PAGE_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(PAGE_RULES, "host string, path string, action string")
    judged = urls.filter_pages(_table(spark, folder, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.in_order(mixing.plan(_table(spark, folder, "documents"), mixing.cycling_schedule))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut into token pieces, and where each lies in the packed sequences."""
    import public_tokenizers

    pieces = packing.cut(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.place(digests, capacity=2048)


def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(_table(spark, folder, "embeddings"), k=40, rounds=5, seed=2, width=64).drop("scans")


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut and reordered; its text is rebuilt from what was written."""
    made = infill.fill_in_middle(_table(spark, folder, "documents"), seed=1, rate=90, spm_rate=20)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(infill.restored()).alias("restored_sha256"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The five stages of ``corpus_pipeline.py`` one after another."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_decontamination, op3_language_id, op4_simhash, op5_substring_dedup, op6_line_dedup,
        op7_url_filters, op8_nearest_neighbours, op9_quality_classifier, op10_mixing,
        op11_best_fit_packing, op12_centroid_clustering, op13_fill_in_middle, pipeline,
    )
}
