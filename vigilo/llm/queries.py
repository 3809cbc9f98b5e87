"""Registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilo.llm.common import table
from vigilo.session import scratch_dir


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_order_minhash(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.near_dedup import near_groups

    return near_groups(table(spark, d, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op2_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, d, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_tiled_topk(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.topk import top_k, whole_numbers

    vectors = table(spark, d, "embeddings").select("vec_id", whole_numbers("embedding").alias("v"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


def op4_token_files(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm import token_files as t

    out = scratch_dir(spark, "tokens")
    t.write_tokens(table(spark, d, "documents"), out, word_tokenizer())
    found = t.token_checksums(spark, out).join(t.token_index(spark, out), ["file", "row"])
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_line_chunks(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.line_dedup import line_report

    return line_report(table(spark, d, "documents"))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.toxicity import toxicity

    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_license_scan(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.license_scan import scan

    return scan(table(spark, d, "documents"))


def op8_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.mixing import mix_counts

    return mix_counts(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "shards")


def op9_pack_sequences(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.packing import pack_documents

    return pack_documents(table(spark, d, "documents"), word_tokenizer())


def op10_prefix_targets(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.chat import digests, expand

    rows = table(spark, d, "conversations").selectExpr("cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    out = scratch_dir(spark, "chat")
    expand(rows.unionByName(more)).write.parquet(out)
    return digests(spark.read.parquet(out))


def op11_grouping_genetic(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.grouping import pack_groups

    return pack_groups(table(spark, d, "documents"), byte_tokenizer())


def op12_ball_tree_search(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.ball_search import ranked_search

    return ranked_search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op13_fragment_alignment(spark: SparkSession, d: str) -> DataFrame:
    from vigilo.llm.alignment import align_documents

    return align_documents(table(spark, d, "documents"), byte_tokenizer(), piece_tokenizer())


def queries() -> dict:
    return {
        "op1_order_minhash": op1_order_minhash,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_tiled_topk": op3_tiled_topk,
        "op4_token_files": op4_token_files,
        "op5_line_chunks": op5_line_chunks,
        "op6_toxicity": op6_toxicity,
        "op7_license_scan": op7_license_scan,
        "op8_mix_sources": op8_mix_sources,
        "op9_pack_sequences": op9_pack_sequences,
        "op10_prefix_targets": op10_prefix_targets,
        "op11_grouping_genetic": op11_grouping_genetic,
        "op12_ball_tree_search": op12_ball_tree_search,
        "op13_fragment_alignment": op13_fragment_alignment,
    }
