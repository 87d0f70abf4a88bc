"""A corpus pipeline of five operators, each stage judged on what the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folia.llm import common, lines, neardup, packing, quality_rules


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null or empty texts have too few words and go; null language or source is a
    value like others; repeated rows stay or go together; texts are read whole;
    columns pass as they are; an empty table stays empty.
    """
    return quality_rules.keep_good(docs)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many documents share; ``n_chars`` follows the new text.

    Null text becomes the empty text; a row with a null id keeps no shared line;
    rows that share an id count as one holder of a line; of equal lines the
    largest id keeps its own; texts are read whole; an empty table stays empty.
    """
    from pyspark.sql import functions as F

    return lines.dedup_lines(docs).select(*docs.columns).withColumn("n_chars", F.char_length("text").cast("long"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every group of near-duplicates, at similarity 0.8; 0.85 is the contract of op7 alone.

    Texts without words are near to nothing and stay, as do rows with a null id;
    a row that repeats an id and its text stays as often as it comes, and rows
    that share an id but not their text are judged each by its own; texts are
    compared whole; an empty table stays empty.
    """
    return neardup.drop_near_duplicates(docs, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null or empty texts hold none and stay, whatever their id; null and very
    short items match nothing; texts are read whole; an empty table of either
    kind is no error.
    """
    from folia.llm import decontam

    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's place in the training sequences.

    Null or empty text is its end id alone; null ids and repeated rows are
    packed like others; very long texts are cut into pieces; other columns are
    left out, so none can clash; an empty table gives no sequences.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_shared_lines),
    ("near dedup", one_of_each),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: Robust fits, minima and token ids are beyond SQL; tests hold the pipeline to plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again.

    What a stage wrote is removed once the next has been written; what the last
    one reads goes when the process ends.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
        if k:
            common.remove(spark, f"{place}/{k - 1}")
    common.remove_at_end(spark, place)
    return STAGES[-1][1](spark, docs, sf_dir)
