"""Documents to encoded training text: the stages, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.edit_join import without_later_copies
from tallyforge.llm.embedding_lsh import contained_items
from tallyforge.llm.hyper_minhash import near_duplicates
from tallyforge.llm.line_frequency import judged
from tallyforge.llm.trie_bpe import encode_and_decode
from tallyforge.session import stage_table
from tallyforge.sources.tables import Tables

#: SQL cannot express the sketches, the edit join and the encoding; tests/llm compares with brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in order; ``n_chars`` is that of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


#: Documents that Spark hands to Python at a time. With its 10,000 a batch of 2 KB texts takes 20 MB in every task and
#: more than twice that in the executor's own memory while it is filled, beside a heap that earlier stages have filled.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _in_small_batches(stage: Callable) -> Callable:
    """The stage in a session whose batches have ``BATCH_ROWS`` rows at most; as its rows are made later, the setting stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # Zero and less stand for no limit.
        if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
            spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


@_in_small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines over the limit of their source.

    Null and short texts fail; null and repeated keys are judged by their text.
    """
    found = judged(docs, carry=[c for c in docs.columns if c != "text"]).filter("kept")
    columns = [F.col("cleaned").alias("text") if c == "text" else F.col("carried").getField(c).alias(c) for c in docs.columns]
    return _counted(found.select(*columns), docs.columns)


@_in_small_batches
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are near-equal to an earlier one; those left without a line go."""
    return _counted(without_later_copies(docs), docs.columns)


@_in_small_batches
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each group of near-duplicates, five-word shingles at 0.8.

    Rows without a key stay; rows that repeat the key of a document that stays do as well.
    """
    found = near_duplicates(docs, words=5, percent=80).filter("doc_id <> component_id")
    # Dealt out at every size, so that what is moved stays in proportion to the input.
    return docs.repartition("doc_id").join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


@_in_small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Rows without a key are judged by their text as well."""
    told = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64("doc_id", "text").alias("row"), "text")
    hits = contained_items(told, Tables(spark, sf_dir).benchmark, key="row").select("row").distinct()
    return told.join(stage_table(hits, "contaminated"), "row", "left_anti").select("doc.*")


@_in_small_batches
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens`` of every document that is left; ids are little-endian 32-bit numbers."""
    coded = encode_and_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_copies),
    ("benchmark decontamination", decontaminated),
    ("bpe encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents`` of ``sf_dir``."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
