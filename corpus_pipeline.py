"""The corpus pipeline: stages that each take all rows that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, with rows of any number under
one doc_id. run() writes each stage's rows to the shared folder, reads them again as the next one's docs, and deletes them when the one after is written.
Line dedup stands before near-dedup, as the order of the stages is given: of copies that share passages the later ones reach near-dedup as
what line dedup has left of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, line_dedup, near_dup, packing, toxicity
from sparkloom.llm.store import dropped, spread, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go. Null and empty texts have a score like all others; repeated rows and a null doc_id
    are judged by their text."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur before, here or in another document, are cut out of text. A document of which nothing but white space is left goes, as all its
    words stand elsewhere. Null and empty texts stay as they are; repeated rows are changed alike."""
    count = "removed"
    while count in docs.columns:
        count += "_"
    found = line_dedup.without_repeats(docs, count=count)
    empty = (F.col(count) > 0) & ~F.col("text").rlike(r"\S")
    return found.where(F.coalesce(~empty, F.lit(True))).drop(count)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row with the smallest doc_id stays. Null texts, texts without words and rows without doc_id are in no group and stay;
    of repeated rows one stays."""
    return near_dup.one_of_each_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts hold none and stay; an empty benchmark drops nothing."""
    return decontaminate.without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences. A null or empty text is its end id; repeated rows are packed one by one."""
    return packing.packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: Learned scores, signatures and packing are beyond SQL. tests/llm/test_pipeline.py holds the rows of each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spread(_table(spark, sf_dir, "documents")), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
            if before is not None:
                dropped(before)
            before = docs
    return docs
