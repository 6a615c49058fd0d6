"""The operators as registered queries over whole tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm.bag_minhash import near_duplicates
from wattframe.llm.conversation_repair import REPAIR_SQL, conversation_repair, damaged
from wattframe.llm.embed_dedup import embedding_dedup
from wattframe.llm.main_text import main_text
from wattframe.llm.mixing import MIX_SQL, mix_sources
from wattframe.llm.packing import pack_documents
from wattframe.llm.prefix_trie import TRIE_SQL, prefix_trie
from wattframe.llm.substring_dedup import substring_dedup
from wattframe.llm.suffix_dedup import suffix_dedup
from wattframe.llm.token_store import token_store
from wattframe.llm.topk import TOPK_SQL, topk_search
from wattframe.llm.toxicity import score_toxicity
from wattframe.llm.warc import WARC_SQL, archived_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories the labels table knows, the deciding one last."""
    return _table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk_search(vectors, vectors.where("vec_id % 100 = 0"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), toxicity_labels(spark, sf_dir), ["low_quality", "toxic"])


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair(damaged(_table(spark, sf_dir, "conversations")))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_topk_search, op2_suffix_dedup, op3_substring_dedup, op4_warc_archives, op5_toxicity, op6_near_duplicates, op7_packing,
        op8_embedding_dedup, op9_main_text, op10_mixing, op11_conversation_repair, op12_token_store, op13_prefix_trie,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk_search": TOPK_SQL, "op4_warc_archives": WARC_SQL, "op10_mixing": MIX_SQL.replace("{docs}", "documents"), "op11_conversation_repair": REPAIR_SQL,
        "op13_prefix_trie": TRIE_SQL,
    }
