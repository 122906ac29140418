"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import centroids, exact_dedup, language, merkle, mixing, pieces, pii, quality_model, quality_rules, resharding, simhash, topk, warc
from quern.llm.common import map_rows
from quern.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digest_documents(docs, tokenizer_path()).drop("text")


DIGEST = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


@query("op4_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    def make():
        def row(spans):
            kinds = [s["kind"] for s in spans]
            text = [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans]
            base = ",".join(t for t, k in zip(text, kinds, strict=True) if k in pii.KINDS[:4])
            return *(kinds.count(k) for k in pii.KINDS[:4]), hashlib.sha256(base.encode()).hexdigest(), ",".join(text)

        return row

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs).drop("text")
    return map_rows(found, ["pii_spans"], DIGEST, make).drop("pii_spans")


@query("op5_mix", mixing.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    printed = simhash.simhash_groups(docs, keep_text=False)
    return printed.select("doc_id", "fingerprint", "component_id")


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = quality_rules.quality_rules(docs)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


@query("op2_warc", warc.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    read = warc.read_pages(*warc.archive_pages(pages))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_reshard")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = resharding.reshard_files(spark, f"{sf_dir}/documents.parquet", 40)
    crc = F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")))
    return moved.select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


@query("op9_topk", topk.ORACLE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.EVERY == 0)


@query("op6_quality_model")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_model.score_quality(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op11_exact_dedup", exact_dedup.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", digest)
    return exact_dedup.group_copies(docs, keep_text=False).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op12_merkle", merkle.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = [F.expr("try_add(n_chars, 1)") if i == 3 else c for i, c in enumerate(own)]
    touched = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0) & F.col("n_chars").isNotNull()
    leaves = docs.select(
        "doc_id", "lang", merkle.leaf_of(*own).alias("leaf"), F.when(touched, merkle.leaf_of(*tampered)).alias("tampered")
    )
    proven = merkle.manifest(leaves, "lang", "doc_id", "leaf")
    folded = proven.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings_of(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op13_centroids", centroids.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
