"""Repeated passages by sparse suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored
from .kernels import Words, mix, slices

#: Least words of a repeated passage; words of a minimiser and minimisers' window.
#: GRAM + WINDOW - 1 <= MIN_WORDS, so equal passages keep suffixes at equal places.
MIN_WORDS, GRAM, WINDOW = 50, 8, 40
#: Words to the right and left by which suffixes are sorted, in steps.
CONTEXT = (16, 32)


def _minimisers(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words at which a window of WINDOW grams has its smallest hash, and these hashes."""
    gram, inside = w.grams(GRAM)
    if not len(gram):
        return np.zeros(0, np.int64), gram
    value = np.where(inside, gram, np.uint64(2**64 - 1))
    # least value of WINDOW successive grams, by doubling
    low, width = value, 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        if len(low) <= step:
            break
        low = np.minimum(low[:-step], low[step:])
        width += step
    n_grams = np.maximum(0, np.diff(w.first) - GRAM + 1)
    picked = []
    # windows inside one row; rows with fewer grams than a window hold too short a text
    starts = w.first[:-1][n_grams >= WINDOW]
    ends = starts + n_grams[n_grams >= WINDOW] - WINDOW + 1
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        part, least = value[a : b + WINDOW - 1], low[a:b]
        change = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        for i in change.tolist():
            picked.append(a + i + int(np.argmin(part[i : i + WINDOW])))
    at = np.unique(np.array(picked, np.int64))
    return at, gram[at]


def _context(w: Words, at: np.ndarray, n: int, back: bool) -> np.ndarray:
    """Hash of ``n`` words from ``at`` on, or of the ``n`` before it; the row's end counts as a mark."""
    row = w.row[at]
    lo, hi = w.first[row], w.first[row + 1]
    out = np.zeros(len(at), np.uint64)
    for j in range(n):
        i = at - 1 - j if back else at + j
        ok = (i >= lo) & (i < hi)
        out = out * np.uint64(0xD6E8FEB86659FD93) + np.where(ok, w.hash[np.clip(i, 0, len(w.hash) - 1)], np.uint64(1))
    return mix(out)


def sparse_suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Kept suffixes: ``key`` (their first GRAM words), ``doc_id``, ``pos`` and hashed contexts to sort by."""
    names = [f"{side}{n}" for side in "rl" for n in CONTEXT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                w = Words(batch.column(1).slice(lo, hi - lo), lower=False)
                at, key = _minimisers(w)
                if len(at):
                    row = w.row[at]
                    ctx = [pa.array(_context(w, at, n, side == "l").view(np.int64)) for side in "rl" for n in CONTEXT]
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array((at - w.first[row]).astype(np.int32)), *ctx], ["key", "doc_id", "pos", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).where("doc_id is not null").mapInArrow(run, "key long, doc_id long, pos int, " + ", ".join(f"{n} long" for n in names))


def _neighbours(suffixes: DataFrame) -> DataFrame:
    """Pairs of suffixes of different documents that stand next to each other in sorted order.

    Suffixes are range-partitioned by their words and then by document, so a
    passage in any number of documents spreads over tasks.  A suffix is paired
    with the nearest one before it, of another document and with the same
    first words; where there is none, with the nearest after it.  The last
    suffixes of a partition and the first of the next meet by way of ``edge``
    rows, two documents' worth a partition.
    """
    order = ["view", "key", "c1", "c2", "doc_id", "pos"]
    views = suffixes.select("key", "doc_id", "pos", F.explode(F.array(*(F.struct(F.lit(v).alias("view"), F.col(f"{s}{CONTEXT[0]}").alias("c1"), F.col(f"{s}{CONTEXT[1]}").alias("c2")) for v, s in enumerate("rl")))).alias("x"))
    parts = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = views.select("x.view", "key", "x.c1", "x.c2", "doc_id", "pos").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = "kind int, part int, view int, key long, a long, pa int, b long, pb int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        group, before, waiting, last, head_open = None, None, [], None, True
        first_rows: list[tuple] = []
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in (0, 1, 4, 5)]
            for view, key, doc, pos in zip(*cols, strict=True):
                if (view, key) != group:
                    if last is not None:
                        head_open = False
                    group, before, waiting, last = (view, key), None, [], None
                if head_open and (not first_rows or len({r[2] for r in first_rows} | {doc}) <= 1):
                    first_rows.append((view, key, doc, pos))
                if last is not None and last[0] != doc:
                    before = last
                    for d, p in waiting:
                        out.append((0, part, view, key, d, p, doc, pos))
                    waiting = []
                if before is not None:
                    out.append((0, part, view, key, before[0], before[1], doc, pos))
                else:
                    waiting.append((doc, pos))
                last = (doc, pos)
            if out:
                yield _rows(out, schema)
                out = []
        if last is not None:
            # what the next partition needs: the last suffix, those that wait, and this one's first
            out += [(1, part, *group, d, p, None, None) for d, p in (waiting or [last])]
            out += [(2, part, v, k, d, p, None, None) for v, k, d, p in first_rows]
            yield _rows(out, schema)

    return ranged.mapInArrow(run, schema)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64()}
    names = [x.split(" ") for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), names, strict=True)], [n for n, _ in names])


def _across(pairs: DataFrame) -> DataFrame:
    """Pairs over the borders of partitions: one end's suffixes with the first of the next that has rows."""
    parts = pairs.where("kind > 0")
    order = parts.select("part").distinct().withColumn("next", F.lead("part").over(Window.orderBy("part")))
    ends = parts.where("kind = 1").join(F.broadcast(order), "part").select("view", "key", "next", "a", "pa")
    heads = parts.where("kind = 2").select("view", "key", F.col("part").alias("next"), F.col("a").alias("b"), F.col("pa").alias("pb"))
    tail = ends.groupBy("view", "key", "next").agg(F.max(F.struct("a", "pa")).alias("last"))
    head = heads.groupBy("view", "key", "next").agg(F.min(F.struct("b", "pb")).alias("first"))
    one = tail.join(heads, ["view", "key", "next"]).select(F.col("last.a").alias("a"), F.col("last.pa").alias("pa"), "b", "pb")
    two = ends.join(head, ["view", "key", "next"]).select("a", "pa", F.col("first.b").alias("b"), F.col("first.pb").alias("pb"))
    return one.union(two).where("a <> b")


def _extended(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Every maximal equal run of ``min_words`` words along a diagonal of a pair, as one span in either document."""
    sides = pairs.select("a", "b", "diagonals", F.explode(F.array("a", "b")).alias("doc"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    met = sides.join(texts, "doc")
    both = met.groupBy("a", "b").agg(F.first("diagonals").alias("diagonals"), F.max(F.when(F.col("doc") == F.col("a"), F.col("text"))).alias("x"), F.max(F.when(F.col("doc") == F.col("b"), F.col("text"))).alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(3)):
                rows: list[tuple] = []
                part = batch.slice(lo, hi - lo)
                u, v = Words(part.column(3), False), Words(part.column(4), False)
                for i, (a, b, diagonals) in enumerate(zip(*(part.column(k).to_pylist() for k in range(3)), strict=True)):
                    x, y = u.hash[u.first[i] : u.first[i + 1]], v.hash[v.first[i] : v.first[i + 1]]
                    for d in diagonals:  # x[p] stands against y[p - d]
                        p0 = max(0, d)
                        n = min(len(x) - p0, len(y) - (p0 - d))
                        differ = np.flatnonzero(x[p0 : p0 + n] != y[p0 - d : p0 - d + n])
                        edge = np.concatenate([[-1], differ, [n]])
                        for k in np.flatnonzero(np.diff(edge) - 1 >= min_words).tolist():
                            s, e = p0 + int(edge[k]) + 1, p0 + int(edge[k + 1])
                            rows.append((a, s, e, b, *_code_points(u, i, s, e)))
                            rows.append((b, s - d, e - d, a, *_code_points(v, i, s - d, e - d)))
                if rows:
                    yield _rows(rows, spans)

    spans = "doc_id long, first_word int, end_word int, other long, start int, end int"
    return both.select("a", "b", "diagonals", "x", "y").mapInArrow(run, spans)


def _code_points(w: Words, row: int, s: int, e: int) -> tuple[int, int]:
    at, base = w.off[row], w.first[row]
    a, b = w.start[base + s], w.end[base + e - 1]
    head = len(w.data[at:a].tobytes().decode())
    return head, head + len(w.data[a:b].tobytes().decode())


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``min_words`` words or more that another document holds as well.

    Columns: ``doc_id``, ``first_word``, ``end_word`` (exclusive), ``start`` and
    ``end`` in code points, ``n_words``, ``smallest_other`` (the smallest of the
    documents it was compared with) and ``is_copy`` (that one is smaller than
    this document, so that dropping copies leaves the passage in place).
    Passages of a document that overlap or touch are one.

    Words are runs without ASCII white space, compared as they are.  Null, empty
    and shorter texts hold no passages; rows with a null id are left out; rows
    that repeat an id count as one document, with the larger text.  An empty
    table gives an empty table.

    Suffixes are kept at minimisers (a twentieth of all words), those whose
    first words occur once are dropped, the others are sorted by what follows
    and once more by what precedes them, and neighbours are extended both ways
    on the texts.  A document meets few others, however common its passages.
    """
    if min_words < GRAM + WINDOW - 1:
        raise ValueError(f"min_words must be at least {GRAM + WINDOW - 1}")
    kept = Stored(sparse_suffixes(docs, id_col, text_col)).df
    shared = kept.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key")
    several = Stored(kept.join(shared, "key", "left_semi")).df
    pairs = Stored(_neighbours(several)).df
    found = pairs.where("kind = 0").select("a", "pa", "b", "pb").union(_across(pairs))
    flipped = F.col("a") > F.col("b")
    found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(flipped, F.col("pb") - F.col("pa")).otherwise(F.col("pa") - F.col("pb")).alias("d"))
    found = found.groupBy("a", "b").agg(F.collect_set("d").alias("diagonals"))
    spans = Stored(_extended(found, docs, id_col, text_col, min_words)).df
    w = Window.partitionBy("doc_id").orderBy("first_word", "end_word")
    marked = spans.withColumn("reach", F.max("end_word").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    marked = marked.withColumn("island", F.sum(F.when(F.col("reach") >= F.col("first_word"), 0).otherwise(1)).over(w))
    merged = marked.groupBy("doc_id", "island").agg(F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("smallest_other"))
    return merged.select("doc_id", "first_word", "end_word", "start", "end", (F.col("end_word") - F.col("first_word")).alias("n_words"), "smallest_other", (F.col("smallest_other") < F.col("doc_id")).alias("is_copy"))
