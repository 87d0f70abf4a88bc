"""Text statistics and robust multivariate outliers (minimum covariance determinant)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stored, release, salted_join
from .kernels import Words, slices

WINDOW = 8
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Fewest groups for which their estimates are no longer broadcast (5 means and 15 covariances each).
MAX_BROADCAST_GROUPS = 20_000
#: Name of the group of all documents, which no language or pair has.
_ALL = "*"
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def _repeated(w: Words) -> np.ndarray:
    """For each row, words that lie in a WINDOW-word window found twice or more in the row."""
    n_rows = len(w.off) - 1
    gram, inside = w.grams(WINDOW)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(n_rows, np.int64)
    row, h = w.row[at], gram[at]
    order = np.lexsort((h, row))
    r, g = row[order], h[order]
    same = (r[1:] == r[:-1]) & (g[1:] == g[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(w.start) + 1, np.int64)
    hit = at[order[twice]]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    return np.bincount(w.row, np.cumsum(edge[:-1]) > 0, n_rows).astype(np.int64)


def _line_repeats(w: Words) -> np.ndarray:
    """For each row, lines with a word that equal an earlier line of the row."""
    n_rows = len(w.off) - 1
    data = w.data
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([w.off[:-1], breaks + 1]))
    # a row's own end is a start as well, so a line ends at the next start, less its \n
    starts = starts[starts < len(data)]
    row = np.searchsorted(w.off, starts, "right") - 1
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[ends - 1] == 10))
    words = np.searchsorted(w.start, ends) - np.searchsorted(w.start, starts)
    keep = words > 0
    starts, ends, row = starts[keep], ends[keep], row[keep]
    seen: set[tuple[int, bytes]] = set()
    out = np.zeros(n_rows, np.int64)
    raw = data.tobytes()
    last = -1
    for s, e, r in zip(starts.tolist(), ends.tolist(), row.tolist(), strict=True):
        if r != last:
            seen, last = set(), r
        line = raw[s:e]
        if line in seen:
            out[r] += 1
        seen.add(line)
    return out


def _statistics(col: pa.Array) -> list[np.ndarray]:
    w = Words(col, lower=False)
    n_rows = len(w.off) - 1
    n_words = np.diff(w.first)
    is_char = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    chars = np.bincount(w.row, is_char[w.end] - is_char[w.start], n_rows).astype(np.int64) if len(w.start) else np.zeros(n_rows, np.int64)
    symbol = np.concatenate([[0], np.cumsum(_SYMBOLS[w.data])])
    return [n_words, chars, np.diff(symbol[w.off]), _line_repeats(w), _repeated(w)]


def with_statistics(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``__stats`` of STATS over every whole text, as longs; without the text if not asked for."""
    names = docs.columns
    at = names.index(text_col)
    out = [n for n in names if keep_text or n != text_col]
    schema = T.StructType([f for f in docs.schema if f.name in out] + [T.StructField("__stats", T.StructType([T.StructField(s, T.LongType()) for s in STATS]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                stats = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in _statistics(part.column(at))], STATS)
                yield pa.RecordBatch.from_arrays([*(c for n, c in zip(names, part.columns, strict=True) if n in out), stats], [*out, "__stats"])

    return docs.mapInArrow(run, schema)


#: Transformed statistics, each with the least standard deviation that is told from noise.
def _features() -> list[tuple[Column, float]]:
    s = F.col("__stats")
    words = F.greatest(s["n_words"], F.lit(1))
    return [
        (F.log1p(s["n_words"]), 0.5),
        (F.log(F.greatest(s["word_chars"] / words, F.lit(0.5))), 0.12),
        (F.log1p(20 * s["n_symbols"] / words), 0.25),
        (F.sqrt(s["n_dup_lines"] / words), 0.06),
        (F.sqrt(s["n_repeat_words"] / words), 0.12),
    ]


def chi_square_cdf(x: float, d: int) -> float:
    """Share of a chi-square distribution with ``d`` degrees up to ``x``."""
    share = math.erf(math.sqrt(x / 2)) if d % 2 else 1 - math.exp(-x / 2)
    for k in range(2 - d % 2, d, 2):
        share -= math.exp(k / 2 * math.log(x / 2) - x / 2 - math.lgamma(k / 2 + 1)) if x > 0 else 0
    return share


def chi_square_quantile(share: float, d: int) -> float:
    """Where a chi-square distribution with ``d`` degrees reaches ``share``."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, d) < share else (lo, mid)
    return hi


def consistency(h: float, d: int) -> float:
    """Factor that makes the covariance of the nearest share ``h`` of normal vectors that of all."""
    return h / chi_square_cdf(chi_square_quantile(h, d), d + 2) if h < 1 else 1.0


_GROUP = "__grp string, start int, was double, n double, logdet double, mean array<double>, cov array<double>, inv array<double>"


def _combined(sums: DataFrame, floors: list[float], weight: float) -> DataFrame:
    """Estimates of each group and start from its near documents and the pseudo-documents of its parent.

    ``sums`` has ``m`` near documents (or as many as a start stands for) with
    ``mean`` and ``cov``, and the parent's ``up_mean`` and ``up_cov``, which
    count as ``weight`` documents more.  ``inv`` is the inverse of the joint
    covariance with the floors added, ``logdet`` the logarithm of its determinant.
    """
    d = len(floors)

    def run(frames):
        for pdf in frames:
            grid = lambda c, pdf=pdf: np.array(pdf[c].to_list(), float).reshape(len(pdf), d, -1)
            if not len(pdf):
                continue
            m = pdf["m"].to_numpy(float)[:, None, None]
            near, up = grid("mean"), grid("up_mean")
            mean = (m * near + weight * up) / (m + weight)
            off = lambda x, mean=mean: (x - mean) @ (x - mean).transpose(0, 2, 1)
            cov = (m * (grid("cov") + off(near)) + weight * (grid("up_cov") + off(up))) / (m + weight)
            full = cov + np.diag(np.square(floors))
            flat = lambda x: [*x.reshape(len(pdf), -1)]  # noqa: B023, E731
            yield pdf[["__grp", "start", "was", "n"]].assign(logdet=np.linalg.slogdet(full)[1], mean=flat(mean), cov=flat(cov), inv=flat(np.linalg.inv(full)))

    return sums.select("__grp", "start", "was", "n", "m", "mean", "cov", "up_mean", "up_cov").mapInPandas(run, _GROUP)


def _sum_names(d: int) -> list[str]:
    return [*(f"s{i}" for i in range(d)), *(f"s{i}_{j}" for i in range(d) for j in range(i, d))]


def _from_sums(got: DataFrame, d: int) -> DataFrame:
    mean = F.array(*(F.col(f"s{i}") / F.col("m") for i in range(d)))
    cov = F.array(*(F.col(f"s{min(i, j)}_{max(i, j)}") / F.col("m") - F.col(f"s{i}") / F.col("m") * F.col(f"s{j}") / F.col("m") for i in range(d) for j in range(d)))
    return got.withColumns({"mean": mean, "cov": cov}).drop(*_sum_names(d))


def _moments(rows: DataFrame, keys: list[str], d: int, *more: Column) -> DataFrame:
    """Number ``m``, ``mean`` and ``cov`` of the vectors of each key, from sums that combine before the shuffle."""
    sums = [F.count(F.lit(1)).cast("double").alias("m"), *(F.sum(f"__x{i}").alias(f"s{i}") for i in range(d)), *(F.sum(F.col(f"__x{i}") * F.col(f"__x{j}")).alias(f"s{i}_{j}") for i in range(d) for j in range(i, d))]
    return _from_sums(rows.groupBy(*keys).agg(*sums, *more), d)


#: Bins of squared distances in a factor of e, and the least that is told from none.
BINS, LEAST = 500, 1e-9


def _bin(distance: Column) -> Column:
    return F.floor(F.log(F.greatest(distance, F.lit(LEAST))) * BINS).cast("int")


def _edges(bins: DataFrame, keys: list[str], h: float) -> DataFrame:
    """The bin of each key that completes a share ``h`` of its rows; a key has some ten thousand bins at most."""
    order = Window.partitionBy(*keys).orderBy("bin")
    run = bins.withColumns({"upto": F.sum("c").over(order), "all": F.sum("c").over(Window.partitionBy(*keys))})
    return run.where(F.col("upto") >= F.ceil(F.col("all") * h)).groupBy(*keys).agg(F.min("bin").alias("edge"))


class _Estimates:
    """Estimates of all groups and starts as arrays; what tasks count and sum of their rows by them."""

    def __init__(self, rows: list, d: int):
        rows = sorted(rows, key=lambda r: (r["__grp"], r["start"]))
        self.d, self.rows = d, [(r["__grp"], r["start"], r["logdet"]) for r in rows]
        self.mean = np.array([r["mean"] for r in rows], float).reshape(len(rows), d)
        self.inv = np.array([r["inv"] for r in rows], float).reshape(len(rows), d, d)
        self.of: dict[str, list[int]] = {}
        for i, (group, _, _) in enumerate(self.rows):
            self.of.setdefault(group, []).append(i)

    def _met(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Vectors of each group in a batch with their bins, for each of the group's estimates."""
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            order = np.argsort(names.indices.to_numpy(), kind="stable")
            x = np.stack([batch.column(1 + k).to_numpy() for k in range(self.d)], axis=1)[order]
            cuts = np.concatenate([[0], np.cumsum(np.bincount(names.indices.to_numpy(), minlength=len(names.dictionary)))])
            for name, a, b in zip(names.dictionary.to_pylist(), cuts[:-1], cuts[1:], strict=True):
                for i in self.of[name]:
                    off = x[a:b] - self.mean[i]
                    yield i, x[a:b], np.floor(np.log(np.maximum(((off @ self.inv[i]) * off).sum(axis=1), LEAST)) * BINS).astype(np.int64)

    def bins(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for i, _, found in self._met(batches):
            held.setdefault(i, []).append(found)
        for i, found in held.items():
            at, c = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(c.astype(np.int64))], ["i", "bin", "c"])

    def sums(self, batches: Iterator[pa.RecordBatch], cut: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = _sum_names(self.d)
        pairs = np.triu_indices(self.d)
        held: dict[int, np.ndarray] = {}
        for i, x, found in self._met(batches):
            x = x[found <= cut[i]]
            held[i] = held.get(i, 0) + np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x)[pairs]])
        if held:
            made = np.array(list(held.values()))
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), *(pa.array(c) for c in made.T)], ["i", "m", *names])


def _distance(d: int) -> Column:
    off = [F.col(f"__x{i}") - F.get("mean", F.lit(i)) for i in range(d)]
    return sum((off[i] * off[j] * F.get("inv", F.lit(i * d + j)) for i in range(d) for j in range(d)), F.lit(0.0))


@dataclass
class Fit:
    """Robust estimates of each pair of language and source: ``__grp``, ``mean``, ``inv`` (with the consistency factor)."""

    estimates: DataFrame
    n_groups: int
    pair: Column

    def near_moments(self, data: DataFrame, now: DataFrame, h: float, d: int) -> DataFrame:
        """Moments of the share ``h`` of each group that lies nearest to each of its estimates ``now``.

        Distances are told apart by bins of a fixed ratio; the bins of a group
        and start are counted, and all up to the one that completes the share
        are near.  Up to MAX_BROADCAST_GROUPS the estimates travel to the tasks,
        which sum whole batches; beyond, rows are joined with them under a salt.
        """
        few = now.select("__grp", "start", "logdet", "mean", "inv")
        if self.n_groups <= MAX_BROADCAST_GROUPS:
            sent = data.sparkSession.sparkContext.broadcast(_Estimates(few.collect(), d))
            kind = "i int, bin int, c long"
            bins = data.mapInArrow(lambda batches: sent.value.bins(batches), kind).groupBy("i", "bin").agg(F.sum("c").alias("c"))
            edge = {r["i"]: r["edge"] for r in _edges(bins, ["i"], h).collect()}
            cut = np.array([edge.get(i, -(2**31)) for i in range(len(sent.value.rows))])
            kind = "i int, m double, " + ", ".join(f"{c} double" for c in _sum_names(d))
            sums = data.mapInArrow(lambda batches: sent.value.sums(batches, cut), kind).groupBy("i").agg(*(F.sum(c).alias(c) for c in ("m", *_sum_names(d))))
            names = data.sparkSession.createDataFrame([(i, g, s, w) for i, (g, s, w) in enumerate(sent.value.rows)], "i int, __grp string, start int, was double")
            return _from_sums(sums.join(F.broadcast(names), "i").drop("i"), d)
        vector = F.struct(*(f"__x{i}" for i in range(d)))
        met = salted_join(data, few, ["__grp"], vector).withColumn("bin", _bin(_distance(d))).drop("mean", "inv")
        edge = _edges(met.groupBy("__grp", "start", "bin").agg(F.count(F.lit(1)).alias("c")), ["__grp", "start"], h)
        inside = salted_join(met, edge, ["__grp", "start"], vector).where(F.col("bin") <= F.col("edge"))
        return _moments(inside, ["__grp", "start"], d, F.first("logdet").alias("was"))

    def judge(self, stats: DataFrame, cutoff: float) -> DataFrame:
        """``stats`` with ``__distance`` (squared, robust) and ``__outlier``."""
        feats = _features()
        rows = stats.withColumns({"__grp": self.pair, **{f"__x{i}": f for i, (f, _) in enumerate(feats)}})
        few = self.n_groups <= MAX_BROADCAST_GROUPS
        out = (rows.join(F.broadcast(self.estimates), "__grp") if few else salted_join(rows, self.estimates, ["__grp"], F.col("__stats"))).withColumn("__distance", _distance(len(feats)))
        return out.withColumn("__outlier", F.col("__distance") > cutoff).drop("mean", "inv", "__grp", *(f"__x{i}" for i in range(len(feats))))


def _names(lang_col: str, source_col: str) -> tuple[Column, Column]:
    """Group names of a row's language and of its pair; null is a value like others."""
    lang, source = (F.coalesce(F.to_json(F.struct(F.col(c).alias(n))), F.lit("")) for n, c in (("l", lang_col), ("s", source_col)))
    return lang, F.concat(lang, source)


def _starts(data: DataFrame, groups: DataFrame, d: int, h: float, starts: int) -> DataFrame:
    """First estimates: the coordinate-wise medians with the parent's covariance, and small subsets of each group.

    A subset has a document of each of d + 1 hash buckets, the first in another
    hash's order; it stands for as many documents as the near ones will be.
    """
    middle = data.groupBy("__grp").agg(*(F.percentile_approx(f"__x{i}", 0.5, 1000).cast("double").alias(f"m{i}") for i in range(d)))
    middle = middle.select("__grp", F.lit(0).alias("start"), F.array(*(F.col(f"m{i}") for i in range(d))).alias("mean"), F.lit(None).cast("array<double>").alias("cov"))
    cols = [f"__x{i}" for i in range(d)]
    spread = data.withColumn("start", F.explode(F.sequence(F.lit(1), F.lit(max(1, starts - 1)))))
    spread = spread.withColumn("__b", F.pmod(F.xxhash64("start", *cols), F.lit(d + 1)))
    picked = spread.groupBy("__grp", "start", "__b").agg(F.min_by(F.struct(*cols), F.xxhash64(F.lit("order"), "start", *cols)).alias("x")).select("__grp", "start", "x.*")
    small = _moments(picked, ["__grp", "start"], d).select("__grp", "start", "mean", "cov")
    both = middle.unionByName(small) if starts > 1 else middle
    return both.join(groups, "__grp").withColumns({"cov": F.coalesce("cov", "up_cov"), "m": F.ceil(F.col("n") * h).cast("double"), "was": F.lit(None).cast("double")})


#: Tail of a chi-square distribution from which on a vector is an outlier, and the
#: documents that a group's parent counts for in it.
TAIL, WEIGHT = 1e-4, 50.0


def fit_groups(stats: DataFrame, lang_col: str = "lang", source_col: str = "source", h: float = 0.75, starts: int = 5, steps: int = 12, weight: float = WEIGHT) -> Fit:
    """Minimum-covariance-determinant estimates for each language and source.

    Of all sets with a share ``h`` of a group's documents, the one sought has
    the smallest covariance determinant.  Concentration steps lead there from
    ``starts`` first estimates: each takes the mean and covariance of the share
    ``h`` that lies nearest, which lowers the determinant.  After two steps the
    best two go on until no determinant falls by more than a ten-thousandth, and the
    smallest counts.  Every document takes part in every step: quantiles and
    sums combine before the shuffle, so a source with most documents is no
    task's burden.

    Groups of any size are fitted alike.  A group's covariance and mean include
    those of its parent as ``weight`` pseudo-documents that are always near:
    all documents are the parent of a language, a language that of its pairs.
    So a pair with few documents has the estimates of its language, one with
    many its own, and all between go over smoothly.  The floors of the
    statistics are added to every covariance, which keeps a constant statistic
    from a determinant of zero; steps lower the determinant all the same, as
    both additions are fixed while a group is fitted.

    The covariance is widened by the consistency factor of ``h`` for normal
    vectors.  Null language or source is a value like others.
    """
    feats = _features()
    d, floors = len(feats), [f for _, f in feats]
    lang, pair = _names(lang_col, source_col)
    rows = Stored(stats.select(lang.alias("__lang"), pair.alias("__pair"), *(f.cast("double").alias(f"__x{i}") for i, (f, _) in enumerate(feats))))
    found = rows.df.agg(F.count_distinct("__lang"), F.count_distinct("__pair")).first()
    fit = Fit(rows.df, sum(found) + 1, pair)
    middle = rows.df.agg(*(F.percentile_approx(f"__x{i}", 0.5, 1000).cast("double").alias(f"m{i}") for i in range(d)))
    wide = [(3 * f) ** 2 if i == j else 0.0 for j, f in enumerate(floors) for i in range(d)]
    best = middle.select(F.lit("").alias("__up"), F.array(*(F.col(f"m{i}") for i in range(d))).alias("up_mean"), F.array(*map(F.lit, wide)).alias("up_cov"))
    kept: list[Stored] = []
    for group, parent in ((F.lit(_ALL), F.lit("")), (F.col("__lang"), F.lit(_ALL)), (F.col("__pair"), F.col("__lang"))):
        data = rows.df.select(group.alias("__grp"), parent.alias("__up"), *(f"__x{i}" for i in range(d)))
        sizes = data.groupBy("__grp").agg(F.count(F.lit(1)).cast("double").alias("n"), F.first("__up").alias("__up"))
        groups = Stored(sizes.join(best, "__up"))
        kept.append(groups)
        data = data.select("__grp", *(f"__x{i}" for i in range(d)))
        now = Stored(_combined(_starts(data, groups.df, d, h, starts), floors, weight))
        for step in range(steps):
            sums = fit.near_moments(data, now.df, h, d).join(groups.df, "__grp")
            new = _combined(sums, floors, weight)
            if step == 1:
                order = Window.partitionBy("__grp").orderBy("logdet", "start")
                new = new.withColumn("r", F.row_number().over(order)).where("r <= 2").drop("r")
            old, now = now, Stored(new)
            old.drop()
            release(now.spark)
            # no documents, or a set that any start ends at
            if step > 1 and (now.df.agg(F.max(F.col("was") - F.col("logdet"))).first()[0] or 0.0) < 1e-4:
                break
        kept.append(now)
        one = now.df.groupBy("__grp").agg(F.min_by(F.struct("mean", "cov", "n"), F.struct("logdet", "start")).alias("e"))
        best = one.select(F.col("__grp").alias("__up"), F.col("e.mean").alias("up_mean"), F.col("e.cov").alias("up_cov"))
    factor = consistency(h, d)

    def widened(frames):
        for pdf in frames:
            if len(pdf):
                cov = factor * np.array(pdf["cov"].to_list(), float).reshape(-1, d, d) + np.diag(np.square(floors))
                pdf = pdf.assign(inv=[x.ravel() for x in np.linalg.inv(cov)])
                yield pdf[["__grp", "mean", "inv"]]

    fit.estimates = Stored(best.select(F.col("__up").alias("__grp"), F.col("up_mean").alias("mean"), F.col("up_cov").alias("cov")).mapInPandas(widened, "__grp string, mean array<double>, inv array<double>")).df
    for one in (rows, *kept):
        one.drop()
    return fit


def _verdict(judged: DataFrame) -> DataFrame:
    s = F.col("__stats")
    failed = (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])
    return judged.withColumn("__failed", failed).withColumn("__kept", ~F.col("__failed") & ~F.col("__outlier"))


#: Squared distance that five normal statistics exceed with probability TAIL.
CUTOFF = chi_square_quantile(1 - TAIL, 5)


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF, **how) -> DataFrame:
    """``doc_id``, STATS, ``base_failed``, ``distance`` and ``kept`` of every document.

    Base rule: fewer than 20 words, or more than 30 of 100 words in repeated
    windows.  A document is kept if it passes that and its transformed
    statistics are no outlier (squared Mahalanobis distance over ``cutoff``, a
    chi-square quantile) among those of its language and source, as
    :func:`fit_groups` estimates them.  Every document has a distance.

    Null text has no words.  Null language or source is a value like others.
    Texts of any length are read whole.  Null ids and repeated rows get a row
    each; only the four named columns are read, so others cannot clash; an
    empty table gives an empty table.
    """
    few = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    stats = Stored(with_statistics(few, keep_text=False)).df
    judged = _verdict(fit_groups(stats, **how).judge(stats, cutoff))
    return judged.select("doc_id", "__stats.*", F.col("__failed").alias("base_failed"), F.col("__distance").alias("distance"), F.col("__kept").alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF, **how) -> DataFrame:
    """The rows of ``docs`` that :func:`judge_documents` keeps, with their columns.

    The texts are read a second time for the verdict and never shuffled.
    Columns of any name pass, but for names that begin with two underscores.
    Nulls, empty and very long texts, ties, repeated rows and an empty table
    are as there.
    """
    few = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    stats = Stored(with_statistics(few, keep_text=False)).df
    fit = fit_groups(stats, **how)
    fit.pair = _names(lang_col, source_col)[1]
    return _verdict(fit.judge(with_statistics(docs, text_col), cutoff)).where("__kept").select(*docs.columns)
