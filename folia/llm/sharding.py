"""Sharding by a minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, gapless_rank

#: Bits of the key by which groups are ordered; bits of the rows that a round brings back, and ranges that it refines.
KEY_BITS, ROUND_BITS, MOST_RANGES = 60, 13, 1024


@dataclass
class Span:
    """The 2^bits keys from ``lo`` on with their summed size; atomic if they are one group.

    A settled span stands for a run of spans in which no cut can lie.
    """

    lo: int
    bits: int
    size: int
    groups: int
    settled: bool = False

    @property
    def atomic(self) -> bool:
        return self.groups == 1 or self.bits == 0


def greedy_cuts(prefix: list[int], capacity: int, shards: int) -> list[int] | None:
    """Numbers of spans before each cut if every shard takes all it can, or None if too few shards."""
    cuts, at = [], 0
    for _ in range(shards):
        at = bisect_right(prefix, prefix[at] + capacity, at) - 1
        if at == len(prefix) - 1:
            return cuts
        if cuts and cuts[-1] == at or not cuts and at == 0:
            return None
        cuts.append(at)
    return None


def smallest_capacity(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """Binary search for the smallest capacity that is feasible, with its cuts."""
    prefix = [0, *accumulate(sizes)]
    capacity = _least(lambda c: greedy_cuts(prefix, c, shards) is not None, max([0, *sizes, -(-prefix[-1] // shards)]), prefix[-1])
    return capacity, greedy_cuts(prefix, capacity, shards) or []


def _least(feasible: Callable[[int], bool], lo: int, hi: int) -> int:
    """Smallest number from ``lo`` to ``hi`` that is feasible, as all after it are."""
    while lo < hi:
        mid = (lo + hi) // 2
        if feasible(mid):
            hi = mid
        else:
            lo = mid + 1
    return lo


def _fluid_cuts(spans: list[Span], prefix: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cut places, in bytes, if spans that are not atomic could be cut anywhere.

    No true cut of this capacity lies behind its fluid one: both go by the same
    steps, and the fluid step may end at more places.
    """
    at, cuts = 0, []
    for _ in range(shards):
        at += capacity
        if at >= prefix[-1]:
            return cuts
        i = bisect_right(prefix, at) - 1
        if spans[i].atomic:
            at = prefix[i]
        if at <= (cuts[-1] if cuts else 0):
            return None
        cuts.append(at)
    return None


def _settle(spans: list[Span], open_at: set[int]) -> list[Span]:
    """Runs of spans in which no cut can lie any more are kept as their sum only."""
    out: list[Span] = []
    for k, s in enumerate(spans):
        if k in open_at:
            out.append(s)
        elif out and out[-1].settled:
            out[-1].size += s.size
        else:
            out.append(Span(s.lo, 0, s.size, 0, True))
    return out


def _sums(groups: DataFrame, ranges: list[tuple[int, int]], fine: int) -> list[Span]:
    """Sums of ``groups`` in each range ``(first key, bits)``, cut into 2^fine parts.

    The ranges are disjoint, in order and at most MOST_RANGES; a key finds its
    own by binary search, and a batch is summed before it is shuffled.
    """
    first = np.array([lo for lo, _ in ranges], np.int64)
    bits = np.array([b for _, b in ranges], np.int64)
    cut = np.maximum(0, bits - fine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            i = np.searchsorted(first, key, "right") - 1
            inside = (i >= 0) & (key - first[i] >> bits[i] == 0)
            key, size, i = key[inside], size[inside], i[inside]
            parts, back = np.unique(key >> cut[i] << cut[i], return_inverse=True)
            total = np.zeros(len(parts), np.int64)
            np.add.at(total, back, size)
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(total), pa.array(np.bincount(back, minlength=len(parts)))], ["part", "size", "groups"])

    rows = groups.select("key", "size").mapInArrow(run, "part long, size long, groups long").groupBy("part").agg(F.sum("size").alias("size"), F.sum("groups").alias("groups")).collect()
    return [Span(r["part"], int(cut[np.searchsorted(first, r["part"], "right") - 1]), r["size"], r["groups"]) for r in sorted(rows)]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity and the first key of each shard but the first.

    ``groups`` has one row a group: ``key`` (KEY_BITS bits) and ``size``.  The
    driver never sees the groups: keys are summed into ranges, and only ranges
    in which a cut can still lie are summed again at a finer grain.

    A round knows two bounds: the smallest capacity that would do if ranges
    could be cut anywhere (``low``), and the smallest that does with cuts at
    starts of ranges only (``capacity``).  If they meet, the optimum is proven.
    Else the cuts of all capacities between lie in bands between the coarse
    cuts of ``low`` and the fluid cuts of ``capacity``; all outside is kept as
    sums.  A round refines the largest MOST_RANGES ranges of the bands and
    brings back 2^ROUND_BITS rows at most.  Rounds go on until the bounds meet
    or all ranges in the bands are single groups, so the result is the optimum
    over the full order, as exact as if all sizes were at hand.
    """
    spans = _sums(groups, [(0, KEY_BITS)], ROUND_BITS)
    low, capacity = 0, sum(s.size for s in spans)
    while True:
        prefix = [0, *accumulate(s.size for s in spans)]
        low = max([low, -(-prefix[-1] // shards), *(s.size for s in spans if s.atomic and not s.settled)])
        capacity = _least(lambda c: greedy_cuts(prefix, c, shards) is not None, low, capacity)
        cuts = greedy_cuts(prefix, capacity, shards) or []
        low = _least(lambda c: _fluid_cuts(spans, prefix, c, shards) is not None, low, capacity)
        if low == capacity:
            break
        reach = _fluid_cuts(spans, prefix, capacity, shards) or []
        band: set[int] = set()
        at = 0
        for j in range(shards - 1):
            i = min(bisect_right(prefix, at + low) - 1, len(spans) - 1)
            at = prefix[i]
            end = reach[j] if j < len(reach) else prefix[-1]
            band.update(range(i, min(bisect_right(prefix, end) - 1, len(spans) - 1) + 1))
        wide = sorted((k for k in band if not spans[k].atomic), key=lambda k: -spans[k].size)[:MOST_RANGES]
        if not wide:
            break
        ranges = sorted((spans[k].lo, spans[k].bits) for k in wide)
        finer = _sums(groups, ranges, max(1, ROUND_BITS - len(ranges).bit_length()))
        gone = set(wide)
        left = [s for s in _settle(spans, band) if s.settled] + [spans[k] for k in band - gone]
        spans = sorted(left + finer, key=lambda s: s.lo)
    return capacity, [spans[i].lo for i in cuts]


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """Puts every document into one of ``shards`` shards of nearly equal bytes.

    Size: UTF-8 bytes of the text (null: none) plus 1.  Equal texts form an
    atomic group and stay together; groups are ordered by a 60-bit hash of the
    text (texts of one hash count as one group), and the ordered groups are cut
    into contiguous shards whose largest is as small as it can be.  A group
    larger than the mean sets the capacity; later shards may then stay empty.
    Slots go by the hash and the id, and a group of any share of the rows is
    cut into buckets for that; only rows with equal text and equal id stay in
    one bucket.

    Returns the columns of ``docs`` with ``size``, ``shard`` and ``slot``
    (gapless from 0 in a shard), which replace columns of these names.
    Null ids are placed like others; repeated rows get a slot each; an empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS)
    size = (F.octet_length(text) + 1).cast("long")
    sums = Stored(docs.select(key.alias("key"), size.alias("size")).groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
    _, firsts = minimax_cuts(sums.df, shards)
    shard_of = lambda k: sum(((k >= F.lit(f)).cast("int") for f in firsts), F.lit(0)).cast("int")
    named = docs.drop("size", "shard", "slot").withColumns({"__key": key, "size": size}).withColumn("shard", shard_of(F.col("__key")))
    named = named.withColumn("__id", F.col(id_col).cast("string"))
    counts = {r["shard"]: r["n"] for r in sums.df.groupBy(shard_of(F.col("key")).alias("shard")).agg(F.sum("n").alias("n")).collect()}
    sums.drop()
    return gapless_rank(named, "shard", ["__key", "__id"], "slot", counts).drop("__key", "__id")
