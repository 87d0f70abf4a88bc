"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import SLICE, Blocks
from .common import Stored, salted_join
from .kernels import mix, slices, text_buffers

#: Symbols in a gram.
ORDER = 5
#: Characters up to U+07FF are one symbol each, all others two: their leading and
#: their last eleven bits.  MARK stands before a text; no symbol is 0, so the
#: number of a gram tells its order.
_DIRECT, _LEAD, _TAIL = 2048, 544, 2048
MARK = 1 + _DIRECT + _LEAD + _TAIL
BASE = MARK + 1
#: Symbols of median perplexity that are added to each text for its score, and
#: trusted documents that all languages together count for in the bounds of one.
PRIOR, WEIGHT = 300, 20.0
#: One of so many trusted documents, by a hash of its id, sets bounds and trains nothing.
HELD_OUT = 5
#: Grams held in a task before they are counted.
_HELD = 2_000_000


def symbols(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts of a column, one after another, and where rows begin; null is empty."""
    data, off = text_buffers(col)
    code = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[off]
    two = code >= _DIRECT
    if not two.any():
        return code + 1, starts
    at = np.concatenate([[0], np.cumsum(1 + two)])
    out = np.empty(at[-1], np.int64)
    out[at[:-1]] = np.where(two, 1 + _DIRECT + (code >> 11), code + 1)
    out[at[1:][two] - 1] = 1 + _DIRECT + _LEAD + (code[two] & (_TAIL - 1))
    return out, at[starts]


def grams(col: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram that ends at each symbol, as a number to BASE, and where rows begin; marks stand before a text."""
    s, off = symbols(col)
    gram = s.copy()
    for j in range(1, order):
        back = np.full(len(s), MARK, np.int64)
        back[j:] = s[:-j] if j < len(s) else s[:0]
        # what stands before the row's first symbol is a mark
        for k in range(j):
            head = off[:-1] + k
            back[head[head < off[1:]]] = MARK
        gram += back * BASE**j
    return gram, off


def _summed(held: list[np.ndarray]) -> pa.RecordBatch:
    at, counts = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.astype(np.int64))], ["g", "c"])


def _counted(parts: Iterator[pa.Array], order: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for part in parts:
        for lo, hi in slices(part, SLICE):
            held.append(grams(part.slice(lo, hi - lo), order)[0])
            n += len(held[-1])
            if n > _HELD:
                yield _summed(held)
                held, n = [], 0
    if held:
        yield _summed(held)


def _added(counts: DataFrame) -> DataFrame:
    return counts.groupBy("g").agg(F.sum("c").alias("c"))


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``g`` and ``c`` of all grams of ``order`` in column ``text``."""
    return _added(texts.select("text").mapInArrow(lambda batches: _counted((b.column(0) for b in batches), order), "g long, c long"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """Interpolated modified Kneser-Ney estimates from counts of the highest order.

    Rows: ``g`` with ``p`` (probability of its last symbol after the ones
    before it; null for a gram that is a context only) and ``gamma`` (weight of
    the order below after the symbols of ``g``; null for one that is no
    context).  The empty gram is 0.  Each order below counts distinct symbols
    to the left (continuations).  Discounts come from counts of counts.

    All steps are joins and sums keyed by gram, so they spread by hash over any
    number of shards; only four counts of an order come to the driver.
    """
    levels = {order: Stored(counts.select("g", "c")).df}
    for k in range(order - 1, 0, -1):
        levels[k] = levels[k + 1].select((F.col("g") % BASE**k).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    below, out = None, None
    for k in range(1, order + 1):
        n = levels[k].agg(*(F.count_if(F.col("c") == i) for i in (1, 2, 3, 4))).first()
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
        cut = [max(0.1, min(i - 0.05, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] and n[0] else 0.5 for i in (1, 2, 3)]
        c = levels[k].withColumn("ctx", F.expr(f"g div {BASE}"))
        c = c.withColumn("d", F.when(F.col("c") == 1, cut[0]).when(F.col("c") == 2, cut[1]).otherwise(cut[2]))
        totals = c.groupBy("ctx").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        c = c.join(totals, "ctx").select("g", "ctx", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"), "gamma")
        if below is None:
            level = c.select("g", "ctx", (F.col("own") + F.col("gamma") / BASE).alias("p"), "gamma")
        else:
            low = below.select(F.col("g").alias("low"), F.col("p").alias("q"))
            level = c.withColumn("low", F.col("g") % BASE ** (k - 1)).join(low, "low").select("g", "ctx", (F.col("own") + F.col("gamma") * F.col("q")).alias("p"), "gamma")
        below = Stored(level).df
        rows = below.select("g", "p", F.lit(None).cast("double").alias("gamma")).union(below.select("ctx", F.lit(None).cast("double"), "gamma").distinct())
        out = rows if out is None else out.union(rows)
    return out.groupBy("g").agg(F.max("p").alias("p"), F.max("gamma").alias("gamma"))


class Table:
    """Logarithms of ``p`` and ``gamma`` of some grams, found by hash; what is not there is NaN."""

    def __init__(self, g: np.ndarray, p: np.ndarray, gamma: np.ndarray):
        self.p, self.gamma = np.append(p, np.nan).astype(np.float32), np.append(gamma, np.nan).astype(np.float32)
        self.keys = np.append(g, -1)
        self.bits = max(4, (2 * len(g)).bit_length())
        self.slots = np.full(1 << self.bits, len(g), np.int64)
        who, at = np.arange(len(g)), self._slot(g)
        while len(who):
            free = self.slots[at] == len(g)
            self.slots[at[free]] = who[free]
            lost = self.slots[at] != who
            who, at = who[lost], at[lost] + 1 & len(self.slots) - 1

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return (mix(g.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, g: np.ndarray) -> np.ndarray:
        """Place of each gram, or the place of what is not there."""
        at = self._slot(g)
        out = self.slots[at]
        todo = np.flatnonzero((self.keys[out] != g) & (self.keys[out] >= 0))
        while len(todo):
            at[todo] = at[todo] + 1 & len(self.slots) - 1
            out[todo] = self.slots[at[todo]]
            todo = todo[(self.keys[out[todo]] != g[todo]) & (self.keys[out[todo]] >= 0)]
        return out

    def log_p(self, gram: np.ndarray, order: int, off: np.ndarray | None = None) -> np.ndarray:
        """Log probability of the last symbol of every gram of the highest order.

        Where ``off`` says that grams follow one another in rows, the context of
        one is the shorter gram before it, found already; only those at starts
        of rows are looked up.
        """
        first = self.gamma[self.find(np.zeros(1, np.int64))][0]
        at = self.find(gram % BASE)
        known = self.p[at]
        p = np.where(np.isnan(known), (0 if np.isnan(first) else first) - np.log(BASE), known)
        heads = None if off is None else off[:-1][off[:-1] < off[1:]]
        for k in range(2, order + 1):
            short = gram % BASE**k
            if heads is None:
                before = self.find(short // BASE)
            else:
                before = np.empty_like(at)
                before[1:] = at[:-1]
                before[heads] = self.find(short[heads] // BASE)
            at = self.find(short)
            known, gamma = self.p[at], self.gamma[before]
            p = np.where(np.isnan(known), np.where(np.isnan(gamma), p, p + gamma), known)
        return p


def _sum(gram: np.ndarray) -> int:
    return int(np.add.reduce(gram.view(np.uint64))) + len(gram)


def _asked(block: int, batches: Iterator[pa.RecordBatch], at: int, order: int) -> Iterator[pa.RecordBatch]:
    """The distinct grams of all orders in a block, the contexts of its texts' first symbols, and its sum as a number below 0."""
    held, n, every, total = [], 0, np.zeros(0, np.int64), 0
    for gram in (grams(batch.column(at).slice(lo, hi - lo), order)[0] for batch in batches for lo, hi in slices(batch.column(at), SLICE)):
        total += _sum(gram)
        held.append(np.unique(gram))
        n += len(held[-1])
        if n > _HELD:
            held, n = [np.unique(np.concatenate(held))], 0
    every = np.unique(np.concatenate(held)) if held else every
    marks = sum(MARK * BASE**j for j in range(order - 1))
    keys = [every, *(np.unique(every % BASE**k) for k in range(1, order)), np.array([marks % BASE**k for k in range(order)])]
    found = np.append(np.unique(np.concatenate(keys)), -1 - total % 2**62)
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block, np.int32)), pa.array(found)], ["block", "g"])


def _log_sums(blocks: Blocks, schema: T.StructType, text: str, model: DataFrame, order: int) -> DataFrame:
    """The blocks' rows without their text, with ``n`` (symbols) and ``log_p`` (sum over the text)."""
    at = schema.names.index(text)
    asked = blocks.ask(lambda block, batches: _asked(block, batches, at, order), "block int, g long")
    logs = model.select("g", F.log("p").cast("float").alias("p"), F.log("gamma").cast("float").alias("gamma"))
    told = asked.join(logs, "g", "left").where("p is not null or gamma is not null or g < 0").select("block", "g", "p", "gamma")

    def score(tables: Iterator[pa.RecordBatch], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(tables)
        g, p, gamma = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in tables]) if tables else np.zeros(0) for k in range(3))
        rest, total = g[g < 0], 0
        table = Table(*(x[g >= 0].astype(kind) for x, kind in ((g, np.int64), (p, np.float32), (gamma, np.float32))))
        for batch in batches:
            gram, off = grams(batch.column(at), order)
            total += _sum(gram)
            upto = np.concatenate([[0.0], np.cumsum(table.log_p(gram, order, off), dtype=np.float64)])
            cols = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(off)), pa.array(np.diff(upto[off]))], [*(x for x in batch.schema.names if x != text), "n", "log_p"])
        if total and rest.tolist() != [-1 - total % 2**62]:
            raise RuntimeError("the partitions of the documents have changed since their grams were asked for")

    out = T.StructType([*(f for f in schema.fields if f.name != text), T.StructField("n", T.LongType()), T.StructField("log_p", T.DoubleType())])
    return blocks.meet(told, score, out)


def perplexities(texts: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """Columns of ``texts`` but ``text``, with ``n`` (symbols) and ``perplexity`` of each whole text; null without symbols.

    A block of texts asks for its distinct grams; these are joined with the
    model's by gram, and what is found goes back to the block.
    """
    blocks = Blocks(texts, "text")
    summed = _log_sums(blocks, texts.schema, "text", model, order)
    return summed.withColumn("perplexity", F.when(F.col("n") > 0, F.exp(-F.col("log_p") / F.col("n")))).drop("log_p")


def _trusted_counts(blocks: Blocks, trusted: DataFrame, kind: str, order: int) -> DataFrame:
    """Counts of the grams of trusted documents; only ids are shuffled, never texts."""

    def ids(block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(n, block, np.int32)), pa.array(np.arange(first, first + n))], ["doc_id", "block", "pos"])
            first += n

    def count(tables: Iterator[pa.RecordBatch], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {p: d for t in tables for p, d in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True)}
        picked = np.array(sorted(asked), np.int64)

        def texts() -> Iterator[pa.Array]:
            first = 0
            for batch in batches:
                lo, hi = np.searchsorted(picked, [first, first + batch.num_rows])
                at = pa.array(picked[lo:hi] - first)
                if batch.column(0).take(at).to_pylist() != [asked[p] for p in picked[lo:hi].tolist()]:
                    raise RuntimeError("the partitions of the documents have changed since their ids were read")
                yield batch.column(2).take(at)
                first += batch.num_rows

        yield from _counted(texts(), order)

    # ids are stored, so that texts are not read anew for them when a task of the join is lost
    held = Stored(blocks.ask(ids, f"doc_id {kind}, block int, pos long")).df
    # a sort-merge join at every size: trusted ids grow with the corpus
    met = held.join(trusted.hint("merge"), "doc_id", "left_semi").select("block", "pos", "doc_id")
    return _added(blocks.meet(met, count, "g long, c long"))


def classify_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER, quantile: float = 0.998) -> DataFrame:
    """``doc_id``, ``lang``, ``perplexity``, ``score``, ``low``, ``high`` and ``kept`` of every document.

    ``trusted`` holds ids (column ``doc_id``) of trusted documents.  One of
    HELD_OUT of them is held out; all others train the model, so their number
    and the counts grow with the corpus.  The score is the perplexity, steadied
    for short texts.  What is kept in a language lies between two quantiles of
    its trusted scores: ``quantile`` of the held-out ones, which the model has
    not seen, and the share 1 - ``quantile`` of all of them from below.

    Medians and quantiles of a language are means, on a logarithmic scale, of
    its own and those of all languages, which count as WEIGHT documents more; a
    language with few trusted documents leans on all of them, one with none has
    their bounds.  Null and the empty string are one language.  Where no
    trusted document is held out, as there are so few, all set the bounds.

    Text without symbols has no perplexity and is not kept.  Texts of any
    length are read whole.  Rows with a null id are judged but never trusted;
    repeated rows get a row each; only the three named columns are read, so
    others cannot clash.  Without any trusted text nothing is judged and all
    else is kept; an empty table gives an empty table.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    blocks = Blocks(base, "text")
    good = trusted.select("doc_id").where("doc_id is not null").distinct()
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    trains = good if good.where(held).isEmpty() or good.where(~held).isEmpty() else good.where(~held)
    counts = Stored(_trusted_counts(blocks, trains, base.schema["doc_id"].dataType.simpleString(), order))
    model = Stored(kneser_ney(counts.df, order)).df
    scored = Stored(_log_sums(blocks, base.schema, "text", model, order).withColumn("z", -F.col("log_p") / F.nullif("n", F.lit(0))).withColumn("key", F.coalesce("lang", F.lit("")))).df
    known = scored.where("n > 0").join(good.hint("merge"), "doc_id", "left_semi")
    steadied = (F.col("n") * F.col("z") + PRIOR * F.col("median")) / (F.col("n") + PRIOR)

    def shrunk(rows: DataFrame, **at: tuple[str, float]) -> tuple[DataFrame, dict]:
        """Quantiles of each language, drawn to those of all, and the latter."""
        cuts = [F.percentile_approx(c, q, 10000).alias(name) for name, (c, q) in at.items()]
        every = rows.agg(F.count(F.lit(1)).alias("m"), *cuts).first()
        own = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), *cuts)
        to = {name: F.lit(every[name]).cast("double") for name in at}
        mixed = own.select("key", *(((F.col("m") * F.col(n) + WEIGHT * v) / (F.col("m") + WEIGHT)).alias(n) for n, v in to.items()))
        return mixed, to

    def judged(rows: DataFrame, table: DataFrame, default: dict) -> DataFrame:
        met = salted_join(rows, table.withColumnsRenamed({n: f"own_{n}" for n in default}), ["key"], F.struct("doc_id", "n", "z"), "left")
        return met.select(*rows.columns, *(F.coalesce(f"own_{n}", v).alias(n) for n, v in default.items()))

    fresh = known.where(held)
    fresh = known if fresh.isEmpty() else fresh
    middle = shrunk(fresh, median=("z", 0.5))
    score = lambda rows: judged(rows, *middle).withColumn("score", steadied)
    out = judged(judged(score(scored), *shrunk(score(known), low=("score", 1 - quantile))), *shrunk(score(fresh), high=("score", quantile)))
    kept = (F.col("n") > 0) & F.coalesce(F.col("score").between(F.col("low"), F.col("high")), F.lit(True))
    seen = lambda c: F.when(F.col("n") > 0, F.exp(c))
    return out.select("doc_id", "lang", seen("z").alias("perplexity"), seen("score").alias("score"), F.exp("low").alias("low"), F.exp("high").alias("high"), kept.alias("kept"))
