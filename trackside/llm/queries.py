"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.llm import (
    chat, decontaminate, exact_dedup, hard_negatives, importance, jaccard_join, kd_shards, line_dedup,
    packing, secrets, token_counts, toxicity, warc,
)
from trackside.llm.store import small_batches
from trackside.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more whose texts hold marks, read back from the formatted text."""
    extra = spark.sql(
        "select -7L as conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' as text"
        " from values (0L, 'user'), (1L, 'assistant') as t(turn, role)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.conversations(rows.unionByName(extra))

    def said(text: Column, spans: Column) -> Column:
        parts = F.transform(spans, lambda s: chat.unescaped(
            F.substring(text, s["start"] + 1, s["end"] - s["start"])
        ))
        return F.array_join(parts, "")

    turns = chat.read_back(F.col("formatted"))
    back = made.select(
        "conv_id", turns.alias("turns"), said(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    found = jaccard_join.near_duplicates(docs, size=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.verdicts(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model that saw none of the held-out labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    score = toxicity.scores(docs, toxicity.train(docs, labels))
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0)
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat token files, and every document's tokens by scanning them."""
    path = scratch_path(spark, "token_files")
    token_counts.write_token_files(table(spark, sf_dir, "documents"), path)
    part = token_counts.part_number()
    found = token_counts.scan_token_files(spark, f"{path}/kind=tokens").withColumn("part", part)
    ids = token_counts.document_ids(spark, f"{path}/kind=ids").withColumn("part", part).drop("file")
    return found.drop("file").join(ids, ["part", "ordinal"]).select(
        F.col("id").alias("doc_id"), "n_tokens", "part", "ordinal", "start"
    )


def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = kd_shards.kd_shards(table(spark, sf_dir, "documents"), shards=16)
    return made.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = packing.pack_documents(table(spark, sf_dir, "documents"))
    return made.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                       "sequence_id", "offset")


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One increment of an empty ledger: every blob is new, and scanned once."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan_versions(docs, ledger=scratch_path(spark, "ledger"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
        )), ",")

    names = [rule.name for rule in secrets.RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(names))
    counts = [F.size(F.filter("spans", _of_kind(n))).cast("bigint").alias(f"n_{n}") for n in names]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _of_kind(name: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == name


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as records of archives, and what a reader finds in these."""
    pages = table(spark, sf_dir, "pages")
    records = warc.read_archives(warc.write_archives(pages, scratch_path(spark, "archives")))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    made = importance.resample(docs, target, percent=10, seed=2024, longest=1, least_words=20)
    return made.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row's label is wrong on purpose."""
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    wanted = hard_negatives.Wanted(positives=5, negatives=10, low=30, high=90)
    return hard_negatives.mine(
        table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, wanted, label
    )


def queries() -> dict[str, Query]:
    every = (
        op1_line_dedup, op2_chat_formatting, op3_ngram_jaccard_join, op4_exact_dedup,
        op5_decontamination, op6_toxicity, op7_token_counts, op8_kd_sharding, op9_packing, op10_secret_scans,
        op11_warc, op12_importance_resampling, op13_hard_negatives,
    )
    return {f.__name__: f for f in every}
