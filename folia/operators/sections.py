"""Splitting documents into sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import DEFAULT_SECTION
from ..functions.patterns import is_section_title, law_name, section_type
from ..functions.text import strip


def with_sequence(blocks: DataFrame) -> DataFrame:
    """``seq``: place of a block in its document, by the name of its page file (by page where blocks have none) and place on the page."""
    name = [c for c in ("file_name", "file_stem") if c in blocks.columns][:1]
    w = Window.partitionBy("doc_id").orderBy(*name, "page_index", "block_idx")
    return blocks.withColumn("seq", F.row_number().over(w) - 1)


def split_sections(blocks: DataFrame) -> DataFrame:
    """Blocks with ``content`` (stripped), ``section_idx`` from 1 and ``section_name``.

    A section runs from its title block to the next one.  Blocks before the
    first title are dropped; a document without any title is one section.
    """
    df = blocks.withColumn("content", strip(F.col("block_content")))
    return in_sections(df.withColumn("heads", F.when(is_section_title(F.col("content")), F.col("content"))))


def in_sections(df: DataFrame, outside: Column | None = None) -> DataFrame:
    """The same for blocks whose titles are told already: ``heads`` is a title's text.  Dropped blocks that ``outside`` holds for stay, as section 0."""
    w = Window.partitionBy("doc_id").orderBy("seq")
    titled = F.col("heads").isNotNull()
    df = df.withColumns({"section_idx": F.sum(titled.cast("int")).over(w).cast("int"), "section_name": F.last("heads", ignorenulls=True).over(w), "__some": F.max(titled).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    inside = F.col("section_name").isNotNull() | ~F.col("__some")
    df = df.where(inside if outside is None else inside | outside)
    return df.withColumns({"section_idx": F.when(inside, F.greatest("section_idx", F.lit(1))).otherwise(0), "section_name": F.coalesce("section_name", F.lit(DEFAULT_SECTION))}).drop("heads", "__some")


def sections(blocks: DataFrame) -> DataFrame:
    """One row a section: name, type and its first and next block."""
    got = split_sections(blocks).groupBy("doc_id", "section_idx").agg(F.first("section_name").alias("section_name"), F.min("seq").alias("first_seq"), (F.max("seq") + 1).alias("end_seq"))
    return got.withColumn("section_type", section_type(F.col("section_name")))


def external_laws(blocks: DataFrame) -> DataFrame:
    """Distinct ``law`` names that a document's blocks name."""
    return blocks.select("doc_id", law_name(strip(F.col("block_content"))).alias("law")).where("law is not null").distinct()
