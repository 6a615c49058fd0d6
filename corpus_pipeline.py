"""From raw documents to packed sequences: the stages of a training corpus.

Every stage takes all its predecessor kept and returns the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm.bag_minhash import near_duplicates
from wattframe.llm.mixing import mix_sources
from wattframe.llm.packing import pack_documents
from wattframe.llm.queries import toxicity_labels
from wattframe.llm.suffix_dedup import suffix_dedup
from wattframe.llm.toxicity import without_toxic
from wattframe.session import drop_folder, shared_folder, written

#: Folders of keyed rows. A stage's rows are written before the next stage begins, which then deletes these.
_scratch: list[str] = []


def _cleared(spark: SparkSession) -> None:
    while _scratch:
        folder = _scratch.pop()
        if folder.startswith(shared_folder(spark) + "/"):
            drop_folder(spark, folder)


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a number for each row, written so that every later read sees the same ones."""
    spark = docs.sparkSession
    _scratch.append(f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}")
    keyed = docs.withColumn(key, F.monotonically_increasing_id())
    keyed.write.parquet(_scratch[-1])
    return spark.read.schema(keyed.schema).parquet(_scratch[-1])


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the chain does not reject; each row is judged by its own text."""
    _cleared(spark)
    return without_toxic(docs, toxicity_labels(spark, sf_dir), ["low_quality", "toxic"])


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: the one with the smallest doc_id, null last; of equal ones the smallest hash of the text.

    Rows get keys of their own first, written so that every later read sees the same ones. Texts without words are
    classes of their own, so all of their rows stay.
    """
    _cleared(spark)
    key = _free(docs, "_row")
    docs = _keyed(docs, key)
    classes = near_duplicates(docs, id_col=key).select(F.col("doc_id").alias("_id"), F.col("component_id").alias("_class"))
    ordered = docs.select(F.col(key).alias("_id"), F.col("doc_id").cast("bigint").alias("_doc"), F.xxhash64("text").alias("_hash"))
    order = F.struct(F.col("_doc").isNull(), "_doc", "_hash", "_id")
    # The key and its class decide; a class is summed up by each task before its rows meet.
    first = classes.join(ordered, "_id").groupBy("_class").agg(F.min(order).alias("_first")).select(F.col("_first._id").alias("_id"))
    return docs.join(first, docs[key] == first["_id"], "left_semi").drop(key)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier text says too; a character that a cut leaves in part is dropped.

    What is cut follows from doc_id and text alone, so these two are the key by which rows get their new texts.
    """
    _cleared(spark)
    kept = suffix_dedup(docs, keep_text=True).where("n_removed > 0")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.expr("try_validate_utf8(cast(kept AS string))").alias("_whole"), "kept")
    text = F.coalesce("_whole", F.regexp_replace(F.expr("make_valid_utf8(cast(kept AS string))"), "�", ""))
    kept = kept.select("_id", "_sha", text.alias("_text")).dropDuplicates(["_id", "_sha"])
    own = F.sha2(docs["text"].cast("string").cast("binary"), 256)
    joined = docs.join(kept, docs["doc_id"].cast("bigint").eqNullSafe(kept["_id"]) & (own == kept["_sha"]), "left")
    new = F.when(kept["_text"].isNotNull(), kept["_text"]).otherwise(docs["text"])
    cells = {"text": new}
    if "n_chars" in docs.columns:
        cells["n_chars"] = F.when(kept["_text"].isNotNull(), F.char_length(kept["_text"]).cast("bigint")).otherwise(docs["n_chars"])
    return joined.select(*[cells[c].alias(c) if c in cells else docs[c] for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it does not take go.

    Rows get keys of their own first, written so that every later read sees the same ones: of equal rows some may be
    taken once more than others. Null and empty texts have no words and go; an empty table stays one.
    """
    _cleared(spark)
    key, count = _free(docs, "_row"), _free(docs, "_copies")
    docs = _keyed(docs, key)
    copies = mix_sources(docs, key_col=key).where("copies > 0").select(F.col("key").alias("_key"), F.col("copies").cast("int").alias("_n"))
    taken = docs.join(copies, docs[key] == copies["_key"]).select(*[docs[c] for c in docs.columns if c != key], copies["_n"].alias(count))
    columns = [c for c in docs.columns if c != key]
    return taken.select(*columns, F.explode(F.sequence(F.lit(1), F.col(count))).alias(_free(docs, "_copy"))).select(*columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of every row; a null or empty text is the end id alone; an empty table gives no pieces."""
    _cleared(spark)
    return pack_documents(docs)


#: (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_duplicate),
    ("suffix_array_dedup", repeated_text),
    ("mixing", mixing),
    ("best_fit_packing", packing),
]
#: Learned scores, signatures and evolved packings are not SQL; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each but the last returns is written as Parquet to a folder of its own and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if k < len(STAGES) else docs
    return docs
