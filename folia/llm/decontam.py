"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit distance."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import PUNCTUATION, Words, mix, slices

#: An item matches a passage at an edit distance of at most this share of its characters.
MAX_EDITS = 0.2
#: Repetitions, sampled coordinates in each, and starts inside an item.  A try
#: (repetition and start) that agrees with probability p finds the passage, so
#: REPEATS * STARTS tries miss it with (1 - p) ** (REPEATS * STARTS): below 1 %
#: at p = 0.033.  tests/llm/test_wide_text.py measures what edits leave of that.
REPEATS, SAMPLES, STARTS = 28, 2, 5
#: Items with fewer words are too common to tell and match nothing.
MIN_WORDS = 5
#: Bytes of items that one pass over the documents looks for.
PASS_BYTES = 4 << 20
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def _window(n: int) -> int:
    """Largest of the window sizes 4, 6, 9, 13 ... that ``n`` words fill."""
    size = 4
    while size * 3 // 2 <= n:
        size = size * 3 // 2
    return size


def _plan(size: int, rep: int) -> tuple[list[int], np.ndarray]:
    """Sampled coordinates, one in each part of the walk, and the factors whose products' top bits move it."""
    rng = np.random.default_rng([size, rep])
    steps = max(SAMPLES + 1, size * 3 // 2)
    edges = np.linspace(1, steps, SAMPLES + 1).astype(int)
    picks = [int(rng.integers(a, max(a + 1, b))) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return picks, rng.integers(0, 2**63, picks[-1] + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _walk(h: np.ndarray, at: np.ndarray, stop: np.ndarray, size: int, rep: int, known: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """CGK walk from words ``at``: which of them come through, and their keys.

    The walk shows the word under its pointer and moves on by a random bit of
    that word and the step, so texts a few edits apart fall into step again and
    show the same words in most coordinates.  A key is made of the words at the
    sampled coordinates.  ``known`` has, for each of these, a table of the keys
    so far that occur in items; other walks end there.
    """
    picks, factors = _plan(size, rep)
    who, i, key, level = np.arange(len(at)), at.copy(), mix(h[at]), 0
    for j in range(picks[-1] + 1):
        w = np.where(i < stop, h[np.minimum(i, len(h) - 1)], np.uint64(0))
        if j == picks[level]:
            key = mix(key * _GRAM + w)
            if known is not None:
                table = known[level]
                ok = table[key >> np.uint64(65 - len(table).bit_length())]
                who, i, key, stop, w = who[ok], i[ok], key[ok], stop[ok], w[ok]
            level += 1
        i = i + (w * factors[j] >> np.uint64(63)).astype(np.int64)
    return who, key


def _table(keys: np.ndarray, bits: int) -> np.ndarray:
    """Which leading ``bits`` occur among keys."""
    table = np.zeros(1 << bits, bool)
    table[keys >> np.uint64(64 - bits)] = True
    return table


class Items:
    """Items as they travel to the tasks; a worker makes the index of them once."""

    def __init__(self, items: list[tuple[object, str]], max_edits: float):
        self.items, self.max_edits, self._index = items, max_edits, None

    def __getstate__(self) -> dict:
        return {"items": self.items, "max_edits": self.max_edits, "_index": None}

    @property
    def index(self) -> ItemIndex:
        if self._index is None:
            self._index = ItemIndex(self.items, self.max_edits)
        return self._index


class ItemIndex:
    """LSH tables of a bounded set of items."""

    def __init__(self, items: list[tuple[object, str]], max_edits: float = MAX_EDITS):
        self.max_edits = max_edits
        self.ids, self.texts = [], []
        hashes = []
        for item, text in items:
            w = Words(pa.array([text], pa.string()), lower=True, space=PUNCTUATION, split_wide=True)
            if len(w.start) >= MIN_WORDS:
                self.ids.append(item)
                self.texts.append(_plain(w, 0, len(w.start)))
                hashes.append(w.hash)
        seen = Counter(x for h in hashes for x in set(h.tolist()))
        #: size -> [(item, start)], with the items' words and stops
        self.windows: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.words = [len(h) for h in hashes]
        for k, h in enumerate(hashes):
            first_half = range(max(1, (len(h) + 1) // 2))
            for a in sorted(first_half, key=lambda i: (seen[int(h[i])], i))[:STARTS]:
                self.windows[_window(len(h) - a)].append((k, a))
        base = np.concatenate([[0], np.cumsum(self.words)]).astype(np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first_words: dict[int, np.ndarray] = {}
        self.tables: dict[tuple[int, int], tuple[list[np.ndarray], dict[int, list[int]]]] = {}
        for size, wins in self.windows.items():
            at = np.array([base[k] + a for k, a in wins])
            stop = np.array([base[k + 1] for k, _ in wins])
            self.first_words[size] = _table(flat[at], 18)
            # some sixteen places a key: what passes by chance ends at the next level or at the last look-up
            bits = max(12, (16 * len(wins)).bit_length())
            for rep in range(REPEATS):
                picks, _ = _plan(size, rep)
                levels = []
                for n in range(len(picks)):
                    levels.append(_table(self._prefix(flat, at, stop, size, rep, n + 1), bits))
                found: dict[int, list[int]] = defaultdict(list)
                for x, key in enumerate(self._prefix(flat, at, stop, size, rep, len(picks)).tolist()):
                    found[key].append(x)
                self.tables[size, rep] = levels, dict(found)

    @staticmethod
    def _prefix(h, at, stop, size, rep, n) -> np.ndarray:
        picks, factors = _plan(size, rep)
        i, key, level = at.copy(), mix(h[at]), 0
        for j in range(picks[n - 1] + 1):
            w = np.where(i < stop, h[np.minimum(i, len(h) - 1)], np.uint64(0))
            if j == picks[level]:
                key = mix(key * _GRAM + w)
                level += 1
            i = i + (w * factors[j] >> np.uint64(63)).astype(np.int64)
        return key

    def candidates(self, w: Words) -> set[tuple[int, int, int]]:
        """(row, item, first word of the passage) that share a key."""
        out: set[tuple[int, int, int]] = set()
        if not len(w.start):
            return out
        for size, wins in self.windows.items():
            at = np.flatnonzero(self.first_words[size][w.hash >> np.uint64(46)])
            stop = w.first[w.row[at] + 1]
            for rep in range(REPEATS):
                levels, found = self.tables[size, rep]
                who, keys = _walk(w.hash, at, stop, size, rep, levels)
                for p, key in zip(at[who].tolist(), keys.tolist(), strict=True):
                    for x in found.get(key, ()):
                        k, a = wins[x]
                        out.add((int(w.row[p]), k, p - a))
        return out

    def matches(self, col: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item, edits, start, end) of each row's best passage for each item; places in code points."""
        w = Words(col, lower=True, space=PUNCTUATION, split_wide=True)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], list[int]] = defaultdict(list)
        for row, k, first in sorted(self.candidates(w)):
            slack = math.ceil(self.max_edits * self.words[k]) + 2
            if any(abs(first - x) <= slack // 2 for x in done[row, k]):
                continue
            lo = max(int(w.first[row]), first - 2 * slack)
            hi = min(int(w.first[row + 1]), first + self.words[k] + 2 * slack)
            text, item = _plain(w, lo, hi), self.texts[k]
            edits, end = nearest(item, text)
            if edits > self.max_edits * len(item):
                continue
            done[row, k].append(first)
            _, back = nearest(item[::-1], text[:end][::-1])
            start = end - back
            if (row, k) not in best or (edits, lo) < best[row, k][:2]:
                ends = np.cumsum([len(x) + 1 for x in text.split(" ")]) - 1
                a, b = lo + int(np.searchsorted(ends, start, "right")), lo + int(np.searchsorted(ends, max(start, end - 1), "right"))
                best[row, k] = (edits, w.start[a], w.end[min(b, hi - 1)])
        out = []
        for (row, k), (edits, a, b) in sorted(best.items()):
            at = w.off[row]
            head = len(w.data[at:a].tobytes().decode())
            out.append((row, k, edits, head, head + len(w.data[a:b].tobytes().decode())))
        return out


def _plain(w: Words, lo: int, hi: int) -> str:
    """Words joined by one space, A-Z lower-cased."""
    raw = w.data
    return b" ".join(raw[a:b].tobytes().lower() for a, b in zip(w.start[lo:hi].tolist(), w.end[lo:hi].tolist(), strict=True)).decode()


def nearest(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text`` and that part's end.

    Columns of the dynamic-programming table are held as bits of vertical
    differences, so a character of the text costs a few operations on integers
    as long as the item.
    """
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        rise = minus | (full & ~(diagonal | plus))
        fall = plus & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        plus = fall | (full & ~(diagonal | rise))
        minus = rise & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


def _passes(benchmark: DataFrame, item_col: str, item_text: str, max_edits: float) -> Iterator[Items]:
    """All items; more than PASS_BYTES of text are dealt over several, each for a pass of its own."""
    few = benchmark.select(F.col(item_col).alias("item"), F.coalesce(item_text, F.lit("")).alias("text"))
    total = few.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(total / PASS_BYTES))
    for k in range(passes):
        part = few.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
        yield Items([(r["item"], r["text"]) for r in part.collect()], max_edits)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", max_edits: float = MAX_EDITS) -> DataFrame:
    """Documents that hold a benchmark item, one row a document and item.

    Both sides are read as words of letters and digits, A-Z lower-cased;
    characters from U+0800 on, of scripts that set no spaces, are words each.
    Columns: ``doc_id``, ``item_id``, ``edits`` (least edit distance of the item
    to a passage, in characters of these words), ``item_chars``, ``start`` and
    ``end`` (of the passage in the text, in code points).

    Null or empty text holds nothing; items of fewer than MIN_WORDS words, null
    ones among them, match nothing.  Texts of any length are read whole.  Of
    passages equally near the first counts.  Null ids and repeated rows give
    rows of their own; only the named columns are read, so others cannot clash;
    if either table is empty, so is the result.

    Documents are not shuffled; the items, bounded by PASS_BYTES a pass, travel
    to the tasks.
    """
    out = None
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, edits int, item_chars int, start int, end int"
    item_type = pa.schema(benchmark.select(item_col).limit(0).toArrow().schema).field(0).type
    for items in _passes(benchmark, item_col, item_text, max_edits):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value.index
            for batch in batches:
                for lo, hi in slices(batch.column(1)):
                    if found := index.matches(batch.column(1).slice(lo, hi - lo)):
                        row, item, *rest = zip(*found, strict=True)
                        cols = [batch.column(0).take(pa.array([lo + r for r in row])), pa.array([index.ids[k] for k in item], item_type), pa.array(rest[0], pa.int32()), pa.array([len(index.texts[k]) for k in item], pa.int32()), *(pa.array(x, pa.int32()) for x in rest[1:])]
                        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "edits", "item_chars", "start", "end"])

        found = docs.select(id_col, text_col).mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", max_edits: float = MAX_EDITS) -> DataFrame:
    """The rows of ``docs`` whose text holds no item of ``benchmark``, with their columns.

    Nulls, short items, empty and very long texts, ties and repeated rows are as
    in :func:`contaminated`; an empty benchmark keeps all rows, and columns of
    any name pass.
    """
    at, schema = docs.columns.index(text_col), T.StructType(list(docs.schema.fields))
    for items in _passes(benchmark, item_col, item_text, max_edits):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in slices(batch.column(at)):
                    clean = np.ones(hi - lo, bool)
                    clean[[m[0] for m in sent.value.index.matches(batch.column(at).slice(lo, hi - lo))]] = False
                    yield batch.slice(lo, hi - lo).filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
