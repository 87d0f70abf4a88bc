"""Near-duplicate documents: MinHash banding, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored
from .components import connected_components
from .kernels import Words, mix, slices

#: Minima in a band and words in a shingle.
ROWS, SHINGLE = 8, 5
#: Two sets just at the similarity asked for share no band with this probability at most.
MISS = 1.2e-5
#: Most sets and shingles of a block; a task compares two blocks at most.
BLOCK_SETS, BLOCK_SHINGLES = 256, 500_000


def _bands(percent: int) -> int:
    """Bands for a similarity: 36 at 85 of 100, 62 at 80."""
    return max(1, math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))) if percent < 100 else 1


def _factors(bands: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, bands * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, one after another, and each row's number of them."""
    gram, inside = w.grams(SHINGLE)
    sizes = np.zeros(len(w.off) - 1, np.int64)
    parts = []
    for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        if a == b:
            continue
        part = np.unique(gram[a : b - SHINGLE + 1]) if b - a >= SHINGLE else np.array([w.whole(i)], np.uint64)
        sizes[i] = len(part)
        parts.append(part)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), sizes


def _band_keys(shingles: np.ndarray, sizes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """For rows with shingles, a key for every ROWS ``factors``, made of as many minima of universal hashes."""
    bands = len(factors) // ROWS
    keys = np.empty((len(sizes), bands), np.uint64)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        start = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, start + 32768, "right")))
        part = shingles[start : int(ends[hi - 1])]
        cuts = np.concatenate([[0], ends[lo : hi - 1] - start])
        for band in range(bands):
            key = np.full(hi - lo, band, np.uint64)
            for k in range(band * ROWS, band * ROWS + ROWS):
                key *= np.uint64(0x9E3779B97F4A7C15)
                key += np.minimum.reduceat(part * factors[k], cuts) >> np.uint64(24)
            keys[lo:hi, band] = mix(key)
        lo = hi
    return keys


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, 128 bits of the shingle set (``s1``, ``s2``) and its band keys for ``percent`` similarity."""
    kind = docs.schema[id_col].dataType.simpleString()
    factors = _factors(_bands(percent))
    bands_each = len(factors) // ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                w = Words(batch.column(2).slice(lo, hi - lo), lower=True)
                shingles, sizes = _sets(w)
                full = np.flatnonzero(sizes)
                s = np.zeros((2, hi - lo), np.uint64)
                keys = np.zeros((0, bands_each), np.uint64)
                if len(full):
                    cuts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    s[0, full] = np.add.reduceat(mix(shingles), cuts)
                    s[1, full] = np.add.reduceat(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), cuts)
                    keys = _band_keys(shingles, sizes[full], factors)
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands_each, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:2]), pa.array(sizes), pa.array(s[0].view(np.int64)), pa.array(s[1].view(np.int64)), bands], ["doc_id", "text_hash", "n_shingles", "s1", "s2", "bands"])

    return docs.select(F.col(id_col), F.xxhash64(text_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, s1 long, s2 long, bands array<long>")


def _links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sets, each found on the full sets."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    common = np.zeros((n, n), np.float64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    fresh = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    for lo in range(0, int(shared.sum()), 4096):
        part = slice(*np.searchsorted(column, [lo, lo + 4096]))
        block = np.zeros((n, min(4096, int(shared.sum()) - lo)), np.float32)
        block[owner[part], column[part] - lo] = 1
        common += block @ block.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    todo = np.ones(n, bool)
    out = []
    for i in range(n):
        if not todo[i]:
            continue
        reach = np.zeros(n, bool)
        reach[i] = True
        front = reach
        while front.any():
            front = linked[front].any(axis=0) & ~reach
            reach |= front
        todo &= ~reach
        nodes = np.unique(ids[reach])
        out += [(int(x), int(nodes[0])) for x in nodes[1:]]
    return out


def verified_links(docs: DataFrame, clusters: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links ``u``-``v`` that span all pairs of a cluster at ``percent`` similarity or more.

    ``clusters``: ``node``, ``cid``, ``n`` (its shingles), and the id and hash
    of a text that it stands for (``doc_id``, ``text_hash``).  A cluster is
    dealt into blocks of bounded size, and each pair of blocks is one unit of
    work, so a cluster of any size spreads over tasks.  Inside a unit,
    intersections are counted by matrix products over shared shingles; only a
    spanning forest leaves it, never pairs.
    """
    sums = clusters.groupBy("cid").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    blocks = sums.select("cid", F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = clusters.join(blocks, "cid").select("doc_id", "text_hash", "node", "cid", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("b"))
    # a sort-merge join at every size: the texts are the large side, and what they meet grows with them
    met = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).join(dealt.hint("merge"), ["doc_id", "text_hash"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(4)):
                shingles, sizes = _sets(Words(batch.column(4).slice(lo, hi - lo), lower=True))
                at = np.concatenate([[0], np.cumsum(sizes)])
                packed = pa.array([shingles[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:4]), packed], ["node", "cid", "blocks", "b", "shingles"])

    sets = met.select("node", "cid", "blocks", "b", "text").mapInArrow(shingled, "node long, cid long, blocks int, b int, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    units = sets.select("node", "cid", "b", "shingles", other).select("cid", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "node", "shingles")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(parts, "cid", "i", "j").sortWithinPartitions("cid", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []

        def done() -> list[tuple[int, int]]:
            return _links(np.array(ids), sets, percent) if len(ids) > 1 else []

        for batch in batches:
            out: list[tuple[int, int]] = []
            cols = [c.to_pylist() for c in batch.columns]
            for cid, i, j, node, raw in zip(*cols, strict=True):
                if (cid, i, j) != key:
                    out += done()
                    key, ids, sets = (cid, i, j), [], []
                ids.append(node)
                sets.append(np.frombuffer(raw, np.uint64))
            if out:
                yield _pairs(out)
        if out := done():
            yield _pairs(out)

    return units.mapInArrow(compare, "u long, v long").distinct()


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["u", "v"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased.  A document's
    set holds its distinct five-word shingles, or all its words as one if they
    are fewer.  Documents link at 100 * intersection >= percent * union; a
    component's id is its smallest document, which is the one kept.

    Null text, or text without words, has the empty set and links with
    nothing.  A row with a null id takes its text's component and is kept only
    if nothing with an id shares it.  Rows that repeat an id get the component
    of their own text.  An empty table gives an empty table.

    Equal sets are one class from the start, so large groups of exact copies
    cost one row.  Classes that share a band of minima form clusters
    (components over a star a bucket), and :func:`verified_links` finds their
    true links; components of these are the result.
    """
    return _judged(docs, id_col, text_col, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """As :func:`near_duplicates`, with ``text_hash``, which tells rows of one id apart."""
    sigs = Stored(signatures(docs, id_col, text_col, percent)).df
    # a class is named by half the bits of its set, as ids need not be numbers, nor be one to a text
    own = F.min(F.struct("doc_id", "text_hash")).alias("own")
    classes = Stored(sigs.where("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(own, F.first("n_shingles").alias("n"), F.first("bands").alias("bands")).withColumnRenamed("s1", "node")).df
    keys = classes.select("node", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi")
    held = Stored(buckets)
    buckets = held.df
    two = buckets.where("c = 2").select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    more = keys.join(buckets.where("c > 2").select("key", "lo"), "key").where("node > lo").select(F.col("node").alias("u"), F.col("lo").alias("v"))
    clusters = connected_components(two.union(more))
    held.drop()
    sized = clusters.join(classes.select("node", "n", "own.doc_id", "own.text_hash"), "node").select("node", F.col("component").alias("cid"), "n", "doc_id", "text_hash")
    links = verified_links(docs, Stored(sized).df, percent, id_col, text_col)
    parts = connected_components(links)
    heads = parts.join(classes.select("node", "own.doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("first"))
    first = parts.join(heads, "component").select("node", "first")
    named = classes.select("node", "s2", "own.doc_id").join(first, "node", "left").select(F.col("node").alias("s1"), "s2", F.coalesce("first", "doc_id").alias("component"))
    out = sigs.select("doc_id", "text_hash", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
    part = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    kept = F.when(part.isNull(), True).otherwise(F.coalesce(F.col("doc_id") == part, F.lit(False)))
    return out.select("doc_id", "text_hash", "n_shingles", part.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with their columns.

    Rows are judged, not ids: of rows that share an id but not their text each
    stays or goes with its own text.  Rows that agree in both stay or go
    together, and a row with a null id stays.
    """
    name = "gone"
    while name in map(str.lower, docs.columns):
        name += "_"
    gone = _judged(docs, id_col, text_col, percent).where(~F.col("kept") & F.col("doc_id").isNotNull()).select(F.struct("doc_id", "text_hash").alias(name)).distinct()
    return docs.join(gone, F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")) == F.col(name), "left_anti")
