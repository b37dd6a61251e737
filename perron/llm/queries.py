"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.llm import bpe, chat, decontaminate, language, minhash, prefix_trie, quality, secret_scan, spelling, substrings, token_files, url_rules, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"))


# A conversation whose texts hold the template's own marks.
MARKED = "\\### Assistant: </turn> ok"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(rows.union(extra))
    out = out.withColumns({"read": chat.read_turns(F.col("formatted")), "loss": F.array_join(chat.loss_texts(F.col("segments")), "")})
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = substrings.mark_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_files.write_documents(_table(spark, sf_dir, "documents"), tokenizer, end_id=2)
    read = token_files.read_documents(manifest)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("ids").to_pylist()
            sizes = pa.array([len(b) // 4 for b in blobs], pa.int64())
            checks = pa.array([zlib.crc32(b) for b in blobs], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), sizes, checks], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read.mapInArrow(digested, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


RANKS = "byte_bpe_multi_50k.tiktoken"


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    out = bpe.decode(encoded, ranks)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    records = read.filter("gap_bytes is null")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = docs.select("doc_id", "text", "lang", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.coalesce(fold != 0, F.lit(False)).alias("learns"))
    return language.identify(docs, F.col("learns"), carry=("doc_id", "held_out"))


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    base = [p.kind for p in secret_scan.PATTERNS]

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.joined(of(*base)), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = prefix_trie.conversation_paths(_table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.prefix_nodes(prefix_trie.with_borrowed_heads(paths, F.col("conv_id") - F.col("conv_id") % 5, head, 8))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.word_counts(_table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_quality_rules, op3_url_filters, op4_chat_formatting, op5_substring_dedup,
        op6_token_files, op7_benchmark_decontamination, op8_byte_bpe, op9_warc, op10_language_id, op11_secret_scans,
        op12_prefix_trie, op13_spelling_variants, pipeline,
    )
}
