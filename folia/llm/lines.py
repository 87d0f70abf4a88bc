"""Line deduplication across documents, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, salted_join

_ENDS = "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.regexp_replace(line, _ENDS, ""), _UPPER, _LOWER)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Drops lines whose key stands in ``min_docs`` or more documents.

    A text splits at ``\\n``.  Keys of at least ``min_chars`` code points that
    ``min_docs`` distinct ids hold lose all their lines, except in the largest
    id that holds them.  The other lines stay, joined by ``\\n``.

    Returns the columns of ``docs`` with the new text, and ``n_lines`` (before
    dropping) and ``n_dropped``, which replace columns of these names.

    Null or empty text is one empty line and comes back as the empty text.
    Rows with a null id count for no key and keep no hot line.  Rows that share
    an id count once; repeated rows come back as often as they came in.  An
    empty table gives an empty table.

    Plan: lines are exploded to 128-bit hashes; distinct ids a hash are counted
    with map-side combining; hot hashes are joined back under a salt, since one
    line may stand in most documents; the positions to drop, at most one list
    a document, meet the texts in one shuffle.
    """
    rest = [c for c in docs.columns if c != text_col]
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    base = base.withColumn("stamp", F.xxhash64("text"))
    lines = base.select("id", "stamp", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).select("id", "stamp", "pos", line_key(F.col("line")).alias("key"))
    lines = lines.where(F.char_length("key") >= min_chars).select("id", "stamp", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    lines = Stored(lines).df  # used twice, and far smaller than the texts it takes to make it
    hot = lines.groupBy("h1", "h2").agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs).select("h1", "h2", "keeper")
    gone = salted_join(lines, hot, ["h1", "h2"], F.struct("id", "pos")).where(~F.col("id").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy(F.col("id").alias("gone_id"), F.col("stamp").alias("gone_stamp")).agg(F.collect_set("pos").alias("gone"))
    met = base.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("stamp") == F.col("gone_stamp")), "left")
    split = F.split("text", "\n", -1)
    # array_except hashes, so a document costs time in proportion to its lines;
    # the outer lambda binds the split lines once
    stay = lambda lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: F.get(lines, i)), "\n")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.get(F.transform(F.array(split), stay), F.lit(0)))
    n_lines = (F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long")
    n_dropped = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    own = {text_col: kept, "n_lines": n_lines, "n_dropped": n_dropped}
    names = [*docs.columns, *(c for c in own if c not in docs.columns)]
    return met.select(*((own[c] if c in own else F.col("row").getField(c)).alias(c) for c in names))
