"""Language-model scores by context-tree weighting over the bytes of whole texts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import Blocks
from .common import Stored
from .kernels import _LOWER, _SPACE, Words, slices

#: Bytes of context, and the nearest bytes of it by which trees are dealt to tasks.
DEPTH, SHARD = 5, 3
#: The end of a text, which also stands before it; no word holds it.
END = 10
#: Number of the end among tokens.  Words are below, grams of bytes at 0 and above.
END_KEY = -1
#: One of so many documents, by the checksum of its id, is held out.
FOLDS, HELD_OUT = 5, 1
#: Rows that are summed or estimated at once.
_ROWS = 1_000_000
_CHUNK = 200_000


def byte_grams(col: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    """A number for every byte of each text with its context, where rows begin, and the words.

    A text reads as its words in lower case with one space between and END
    after the last; before it stand ENDs.  The nearest byte of the context is
    the highest of the number, the byte itself the lowest, so that in sorted
    numbers all contexts that end alike follow one another.
    """
    w = Words(col, lower=True)
    n = np.diff(w.first)
    lens = w.end - w.start
    upto = np.concatenate([[0], np.cumsum(lens)])
    sizes = upto[w.first[1:]] - upto[w.first[:-1]] + np.maximum(n, 1)
    first = np.concatenate([[0], np.cumsum(sizes + DEPTH)])
    out = np.full(first[-1], 32, np.uint8)
    at = first[w.row] + DEPTH - upto[w.first[w.row]] + np.arange(len(lens)) - w.first[w.row]
    out[np.repeat(at, lens) + np.arange(upto[-1])] = _LOWER[w.data[~_SPACE[w.data]]]
    real = np.ones(len(out), bool)
    for k in range(DEPTH):
        out[first[:-1] + k] = END
        real[first[:-1] + k] = False
    out[first[1:] - 1] = END
    wide = out.astype(np.int64)
    gram = wide.copy()
    for j in range(1, DEPTH + 1):
        gram[j:] |= wide[:-j] << 8 * (DEPTH + 1 - j)
    return gram[real], np.concatenate([[0], np.cumsum(sizes)]), w


def _tokens(w: Words) -> np.ndarray:
    """Keys of all words."""
    return -2 - (w.hash >> np.uint64(1)).astype(np.int64)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count[order], first)


def _asked(block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct grams and tokens of a block with their counts in its training texts."""
    keys, counts, n = [np.array([END_KEY])], [np.zeros(1, np.int64)], 0
    for batch in batches:
        for lo, hi in slices(batch.column(2)):
            gram, off, w = byte_grams(batch.column(2).slice(lo, hi - lo))
            train = ~np.array(batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False), bool)
            token = _tokens(w)
            for every, mine in ((gram, gram[np.repeat(train, np.diff(off))]), (token, token[train[w.row]])):
                keys.append(np.unique(every))
                counts.append(np.zeros(len(keys[-1]), np.int64))
                key, count = np.unique(mine, return_counts=True)
                keys.append(key)
                counts.append(count)
                n += len(counts[-2]) + len(count)
            counts[0][keys[0] == END_KEY] += train.sum()
            if n > _ROWS:
                key, count = _summed(keys, counts)
                keys, counts, n = [key], [count], 0
    key, count = _summed(keys, counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block, np.int32)), pa.array(key), pa.array(count)], ["block", "key", "c"])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of 0.5 and more, by Stirling's series eight steps up."""
    x = np.asarray(x, np.float64)
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    down = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return series - down


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - math.log(math.pi)


class Trees:
    """The context trees of some contexts of SHARD bytes, complete from there to DEPTH.

    ``key`` are all their grams in order, ``c`` the counts, 0 for one that only
    held-out texts have.  A byte is eight decisions; each has a node that is
    named by the bits before it, and a tree over contexts of its own.  In a
    tree, what a context weighs against its longer ones follows from its own
    estimate and the product of theirs, from the deepest up.

    ``q`` has for each gram and decision the probability of its bit under the
    mixture from SHARD on; ``nodes`` the decisions at depth SHARD with their
    counts and weighted probability, ``place`` where among these a gram's are.
    """

    def __init__(self, key: np.ndarray, c: np.ndarray):
        rows = len(key)
        self.q, self.place = np.empty((8, rows)), np.empty((8, rows), np.int64)
        context, node, zeros, ones, weight = [], [], [], [], []
        orders = {DEPTH: np.arange(rows)}
        byte = key & 255
        for d in range(SHARD, DEPTH):
            orders[d] = np.argsort((key >> 8 * (DEPTH + 1 - d) << 8) | byte, kind="stable")
        total = 0
        for k in range(8):
            bit = (byte >> 7 - k) & 1
            for d in range(DEPTH, SHARD - 1, -1):
                order = orders[d]
                run = ((key >> 8 * (DEPTH + 1 - d) << k) | (byte >> 8 - k))[order]
                new = np.concatenate([[True], run[1:] != run[:-1]])
                first, which = np.flatnonzero(new), np.cumsum(new) - 1
                n, n1 = np.add.reduceat(c[order], first), np.add.reduceat((c * bit)[order], first)
                own = log_kt(n - n1, n1)
                one = (n1 + 0.5) / (n + 1)
                mine = np.empty(rows, np.int64)
                mine[order] = which
                if d == DEPTH:
                    log_w = own
                    q = np.where(bit == 1, one[mine], 1 - one[mine])
                else:
                    deeper = np.add.reduceat(np.where(fresh, below, 0)[order], first)
                    log_w = np.logaddexp(own, deeper) - math.log(2)
                    stop = np.exp(own - math.log(2) - log_w)[mine]
                    q = stop * np.where(bit == 1, one[mine], 1 - one[mine]) + (1 - stop) * q
                # the first row of each run stands for its node in the sum above
                fresh, below = np.zeros(rows, bool), log_w[mine]
                fresh[order[first]] = True
            self.q[k], self.place[k] = q, mine + total
            total += len(first)
            at = order[first]
            context.append(key[at] >> 8 * (DEPTH + 1 - SHARD))
            node.append((1 << k) | (byte[at] >> 8 - k))
            zeros.append(n - n1)
            ones.append(n1)
            weight.append(log_w)
        self.context, self.node, self.zeros, self.ones, self.weight = map(np.concatenate, (context, node, zeros, ones, weight))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut only where the first column changes."""
    held: list[list[np.ndarray]] = []
    n = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        n += batch.num_rows
        if n < _CHUNK:
            continue
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        if cut:
            yield [c[:cut] for c in cols]
        held, n = [[c[cut:] for c in cols]], len(cols[0]) - cut
    if n:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _shard_nodes(grams: DataFrame) -> DataFrame:
    """All decisions at depth SHARD: ``context``, ``node``, counts and the log of the weighted probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, key, c in _whole_groups(batches):
            t = Trees(key, c)
            yield pa.RecordBatch.from_arrays([pa.array(t.context), pa.array(t.node.astype(np.int32)), pa.array(t.zeros), pa.array(t.ones), pa.array(t.weight)], ["context", "node", "n0", "n1", "w"])

    return _dealt(grams.select(_shard_of(F.col("key")).alias("context"), "key", "c"), "key").mapInArrow(run, "context long, node int, n0 long, n1 long, w double")


def _shard_of(key: Column) -> Column:
    return F.shiftright(key, 8 * (DEPTH + 1 - SHARD))


def _dealt(df: DataFrame, *order: str) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "context").sortWithinPartitions("context", *order)


def _weighed(nodes: DataFrame) -> DataFrame:
    """Nodes of one depth above SHARD with ``w``, ``stop`` (the weight of their own estimate) and ``one`` (that estimate of a 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0, n1, s = (batch.column(k).to_numpy() for k in (2, 3, 4))
            own = log_kt(n0, n1)
            w = np.logaddexp(own, s) - math.log(2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *batch.columns[2:4], pa.array(w), pa.array(np.exp(own - math.log(2) - w)), pa.array((n1 + 0.5) / (n0 + n1 + 1))], ["context", "node", "n0", "n1", "w", "stop", "one"])

    return nodes.mapInArrow(run, "context long, node int, n0 long, n1 long, w double, stop double, one double")


def _above(nodes: DataFrame) -> DataFrame:
    """For each decision at depth SHARD what shallower contexts give: the probability of its bit is ``a`` (of a 1; 1 - a - b of a 0) and ``b`` times that from SHARD on."""
    levels, below = [], nodes
    for _ in range(SHARD):
        summed = below.groupBy(F.shiftright("context", 8).alias("context"), "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("w").alias("s"))
        below = Stored(_weighed(summed)).df
        levels.append(below)
    a, b = F.lit(0.0), F.lit(1.0)
    out = nodes.select("context", "node")
    for k in reversed(range(SHARD)):
        own = levels[k].select(F.col("context").alias(f"c{k}"), F.col("node").alias(f"n{k}"), F.col("stop").alias(f"stop{k}"), F.col("one").alias(f"one{k}"))
        out = out.join(own, (F.shiftright("context", 8 * (k + 1)) == F.col(f"c{k}")) & (F.col("node") == F.col(f"n{k}")))
        a, b = a + b * F.col(f"stop{k}") * F.col(f"one{k}"), b * (1 - F.col(f"stop{k}"))
    return out.select("context", "node", a.alias("a"), b.alias("b"))


def gram_scores(grams: DataFrame) -> DataFrame:
    """``key`` and ``value``, the natural log of the probability of the last byte of each gram (``key``, ``c``) after its context.

    Grams are dealt by the nearest SHARD bytes of their contexts, so a task has
    whole trees from there on; no such tree has more than 256^(DEPTH - SHARD +
    1) grams.  Sums over trees give the depths above, whose part in the
    mixture comes back to the trees by a join.
    """
    nodes = Stored(_shard_nodes(grams)).df
    above = _above(nodes)
    both = above.select("context", F.lit(0).alias("kind"), F.col("node").cast("long").alias("x"), "a", "b").unionByName(grams.select(_shard_of(F.col("key")).alias("context"), F.lit(1).alias("kind"), F.col("key").alias("x"), F.col("c").cast("double").alias("a"), F.lit(0.0).alias("b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for context, kind, x, a, b in _whole_groups(batches):
            top = kind == 0
            t = Trees(x[~top], a[~top].astype(np.int64))
            # rows from above are in order of context and node; a search finds the place of each decision
            found = np.searchsorted(context[top] << 8 | x[top], t.context << 8 | t.node)
            a1, b1 = a[top][found], b[top][found]
            log_p = np.zeros(len(x) - int(top.sum()))
            byte = x[~top] & 255
            for k in range(8):
                at = t.place[k]
                bit = (byte >> 7 - k) & 1
                log_p += np.log(np.where(bit == 1, a1[at], 1 - a1[at] - b1[at]) + b1[at] * t.q[k])
            yield pa.RecordBatch.from_arrays([pa.array(x[~top]), pa.array(log_p)], ["key", "value"])

    return _dealt(both, "kind", "x").mapInArrow(run, "key long, value double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text under models learnt from four fifths of the documents.

    A document is held out if the CRC-32 of its id as text leaves HELD_OUT
    divided by FOLDS.  Its tokens are its words (runs without ASCII white
    space, A-Z lower-cased) and one end.  Columns: ``doc_id``, ``held_out``,
    ``n_tokens``, ``n_known`` (tokens that training has), ``train_tokens``,
    ``base_score`` (log10 probability by frequency, half a count added to each
    and for all unknown), ``score`` (log10 probability of the bytes of the
    words, single spaces and the end by context-tree weighting) and
    ``bits_per_byte``, its code length for each of these bytes.

    Context-tree weighting mixes Krichevsky-Trofimov estimates of all contexts
    of no to DEPTH bytes, for each bit of a byte after those before it; weights
    follow from the training texts.  Rows of the model are the distinct grams
    of the corpus, so they grow with it, and none of them comes to the driver.

    Null text is the empty text: one end.  A null id counts as the empty
    string, which trains.  Repeated rows count and are scored each.  Texts are
    read whole, whatever their length.  Columns other than id and text are left
    out, so none can clash.  Where all are held out every byte has the same
    probability; an empty table gives an empty table.  Words are told apart by
    63-bit hashes.

    Texts never move: a block of them asks for its distinct grams and tokens
    once, which is a stored table, and gets their values back.
    """
    spark = docs.sparkSession
    shown = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), (F.crc32(shown.cast("binary")) % FOLDS == HELD_OUT).alias("held_out"), F.col(text_col).alias("text"))
    blocks = Blocks(base, "text")
    asked = Stored(blocks.ask(_asked, "block int, key long, c long")).df
    counts = Stored(asked.groupBy("key").agg(F.sum("c").alias("c"))).df
    tokens = counts.where("key < 0")
    n, v = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    values = gram_scores(counts.where("key >= 0")).unionByName(tokens.select("key", F.col("c").cast("double").alias("value")))
    # a sort-merge join at every size, as both sides grow with the corpus
    told = asked.select("block", "key").join(values.hint("merge"), "key").select("block", "key", "value")

    def score(tables: Iterator[pa.RecordBatch], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(k).to_numpy() for k in (0, 1)] for b in tables]
        key, value = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in (0, 1))
        del parts
        order = np.argsort(key)
        key, value = key[order], value[order]

        def looked_up(x: np.ndarray) -> np.ndarray:
            every, at = np.unique(x, return_inverse=True)
            place = np.searchsorted(key, every)
            if len(every) and (place[-1] == len(key) or (key[place] != every).any()):
                raise RuntimeError("the partitions of the documents have changed since their grams were asked for")
            return value[place][at]

        end = looked_up(np.array([END_KEY]))[0]
        by_count = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                gram, off, w = byte_grams(batch.column(2).slice(lo, hi - lo))
                log_p = np.add.reduceat(looked_up(gram), off[:-1]) / math.log(10)
                c = looked_up(_tokens(w))
                rows = hi - lo
                known = np.bincount(w.row, c > 0, rows) + (end > 0)
                plain = np.bincount(w.row, by_count(c), rows) + by_count(end)
                cols = [np.diff(w.first) + 1, known.astype(np.int64), plain, log_p, -log_p * math.log2(10) / np.diff(off)]
                yield pa.RecordBatch.from_arrays([*(x.slice(lo, rows) for x in batch.columns[:2]), *map(pa.array, cols)], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"])

    kinds = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()), ("bits_per_byte", T.DoubleType())]
    schema = T.StructType([*base.schema.fields[:2], *(T.StructField(name, kind) for name, kind in kinds)])
    if not blocks.n:
        return spark.createDataFrame([], schema).withColumn("train_tokens", F.lit(0).cast("long"))
    return blocks.meet(told, score, schema).withColumn("train_tokens", F.lit(n).cast("long"))
