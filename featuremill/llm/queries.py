"""The registered queries of this folder: each applies one operator to its whole table and
derives the digest columns of its contract from the operator's output."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.llm import (chat, cross_alignment, order_minhash, packing, piece_codec, quality_rules, secrets,
                             simhash, site_quality, token_counts, toxicity, turn_repair, vector_passes)
from featuremill.llm import sql
from featuremill.llm.common import file_bytes, id_and_text, map_batches, public_path, read

SIMHASH_WORDS, SIMHASH_BITS = 3, 3
PACK_WINDOW, PACK_END_ID = 2048, 1
TOKEN_LIMIT = 1024


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.neighbour_likeness(read(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *map(count, base), F.sha2(secrets.spans_text(of_base), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


def op3_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.repetition_coverage(read(spark, sf_dir, "documents"))


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no URL: the source is the host, the source's language part the path."""
    return site_quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                 F.col("source"), F.col("lang"))


def conversations_with_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` and conversation -7, whose texts look like control strings."""
    told = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(told).alias("text"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_conversations(chat.format_turns(conversations_with_probe(spark, sf_dir)))


def op6_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), PACK_WINDOW, end_id=PACK_END_ID)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_prefix_counts(read(spark, sf_dir, "documents"), budget=TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
                          "fit_chars")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scorer = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return (toxicity.score_documents(docs, scorer)
            .select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), SIMHASH_WORDS, SIMHASH_BITS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes, decodes the ids again, and keeps the digests of both."""
    docs = read(spark, sf_dir, "documents")
    model = spark.sparkContext.broadcast(file_bytes(public_path("piece_bpe_32k.model")))

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = piece_codec.codec(model.value)
        rows = []
        for text in batch.column("text").to_pylist():
            ids = own.encode(text)
            rows.append((len(ids), hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest(),
                         hashlib.sha256(own.decode(ids).encode()).hexdigest()))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(id_and_text(docs), digest,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def damaged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` with the faults that the checksum of a row's conversation and turn asks for."""
    def or_space(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    return (read(spark, sf_dir, "conversations").withColumn("fault", fault).where("fault <> 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(or_space("role")).alias("role"),
                    F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", ""))
                    .otherwise(text).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(damaged_conversations(spark, sf_dir), read(spark, sf_dir, "conversations"))


def op12_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cross_alignment.alignment_quality(read(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.col("groups").alias("groups_sha256"))


def op13_vector_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_passes.near_vectors(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_order_minhash, op2_secret_scan, op3_repetition_coverage, op4_site_quality, op5_chat_format,
    op6_pack_windows, op7_token_counts, op8_toxicity, op9_simhash, op10_piece_codec, op11_turn_repair,
    op12_cross_alignment, op13_vector_passes)}

#: DuckDB SQL for the queries that SQL can express; the others are tested against brute force.
ORACLES = {"op2_secret_scan": sql.secret_scan, "op3_repetition_coverage": sql.repetition_coverage,
           "op5_chat_format": sql.chat_format, "op11_turn_repair": sql.turn_repair}
