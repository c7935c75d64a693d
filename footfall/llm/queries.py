"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    chat,
    compression,
    decontamination,
    exact_search,
    hard_negatives,
    language_model,
    license_scan,
    mixing,
    near_dedup,
    quality,
    substring_dedup,
    vector_codes,
    warc,
)
from footfall.llm.tables import batches_of, kept, read

ODD_CHAT = -7
ODD_TEXT = r"\### Assistant: </turn> ok"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents"))


def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = kept(warc.write_bundles(read(spark, sf_dir, "pages")))
    return warc.read_bundles(bundles).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    documents = read(spark, sf_dir, "documents").withColumn("learn", ~held_out)
    scored = language_model.score_texts(documents)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op6_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    learned = read(spark, sf_dir, "labels").where(~held_out)
    labels = learned.select("doc_id", F.col("quality").alias("label"))
    scored = compression.score(documents, compression.train(documents, labels))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "difference",
    )


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_strings(read(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), size=2)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = spark.range(2).select(
        F.lit(ODD_CHAT).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ODD_TEXT).alias("text"),
    )
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ranks = chat.vocabulary(spark)
    with batches_of(spark, "8m"):
        chunks = kept(chat.format_chats(conversations.unionByName(odd), ranks))
        turns = chat.decoded(chunks, ranks)
        # A digest takes a conversation's turns one after the other, so one task sees them
        # all, but holds none of them.
        order = ["conv_id", "chunk", "at"]
        turns = turns.repartition("conv_id").sortWithinPartitions(*order)
        return kept(
            turns.mapInArrow(
                _digests,
                "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                "loss_sha256 string, formatted_chars long",
            )
        )


DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from turns sorted by conversation and place."""
    current: list | None = None

    def row() -> pa.RecordBatch:
        owner, n, turns, n_loss, loss, chars = current
        values = (owner, n, turns.hexdigest(), n_loss, loss.hexdigest(), chars)
        return pa.RecordBatch.from_pydict(
            {f.name: pa.array([v], f.type) for f, v in zip(DIGESTS, values, strict=True)}
        )

    done: list[pa.RecordBatch] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "chars")]
        for owner, role, text, chars, learned in zip(
            *columns, batch.column("learned").to_pylist(), strict=True
        ):
            if current is None or current[0] != owner:
                if current is not None:
                    done.append(row())
                current = [owner, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            current[1] += 1
            current[2].update(f"{role}\n{text}\n".encode())
            current[3] += len(learned)
            current[4].update(learned.encode())
            current[5] += chars
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            done = []
    if current is not None:
        yield row()


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size")
    )
    mixed = mixing.mix(documents, mixing.cycled_weights(documents))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("repeats")).alias("taken"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = read(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    labelled = embeddings.withColumn("label", F.coalesce(shifted, "label"))
    return hard_negatives.mine(labelled, F.col("vec_id") % 100 == 0)


QUERIES = {
    function.__name__: function
    for function in (
        op1_quality_rules,
        op2_warc_bundles,
        op3_decontamination,
        op4_license_scan,
        op5_language_model,
        op6_compression_classifier,
        op7_repeated_strings,
        op8_near_duplicates,
        op9_chat_formatting,
        op10_mixing,
        op11_vector_codes,
        op12_exact_search,
        op13_hard_negatives,
    )
}
