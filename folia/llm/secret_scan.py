"""Secret scanning with patterns and sliding-window entropy, in DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns: kind, pattern, group whose length counts, least length.
BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
#: Strings in which the method looks, and its window in characters.
CANDIDATE, WINDOW = r"[A-Za-z0-9+/_=-]{20,}", 20
#: Character classes with the entropy, in bits a character, that a full window of a secret reaches.
CLASSES = [("entropy_hex", r"^[0-9a-fA-F-]+$", 3.0), ("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", 3.6)]
#: A word as people write it: lower case, capitals or capitalised parts.  The
#: repeats are possessive, so that a long string costs no stack.
_PART = r"(?:[A-Z]{0,6}[a-z]+(?:[A-Z][a-z]{2,})*+|[A-Z]{1,12})"
_WORD = rf"_*{_PART}(?:_+{_PART})*+_*"
#: Folders of a path, of which each is a word.
_FOLDERS = rf"^(?:/?{_WORD}/)++"
#: Paths whose last segment, if long, is looked at by itself.
PATH = rf"{_FOLDERS}[A-Za-z0-9_-]*$"
#: Candidates that are no secrets, however mixed their characters: identifiers
#: of the 8-4-4-4-12 form and paths of words and numbers.  Candidates without a
#: digit or without a letter (words, joined words, dates, rules of one
#: character) are none in any case.
ALLOWED = [
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    rf"{_FOLDERS}(?:(?:{_WORD}|[0-9]{{1,8}})-+)*+(?:{_WORD}[0-9]{{0,4}}|[0-9]{{1,8}})?-*$",
]


def _running(values: Column, first: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums, maxima or minima of an array of integers; ``first`` changes nothing that it is combined with.

    By doubling: each pass combines every element with the one 1, 2, 4 ...
    places before it, so n elements take log n passes over plain numbers, and
    no state grows from element to element.
    """

    def whole(bound: Column) -> Column:
        n = F.size(bound)

        def step(acc: Column, k: Column) -> Column:
            shift = F.call_function("shiftleft", F.lit(1), k)
            back = F.concat(F.array_repeat(F.lit(first), shift), F.slice(acc, F.lit(1), n - shift))
            return F.zip_with(back, acc, combine)

        passes = F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int") - 1)
        return F.when(n > 1, F.aggregate(passes, bound, step)).otherwise(bound)

    return F.get(F.transform(F.array(values), whole), F.lit(0))


def _places(text: Column, pattern: str) -> Column:
    """Array of (start, end, match): every leftmost non-overlapping match, in code points.

    The text between matches is what ``split`` by the pattern leaves, so places
    follow from running sums of lengths, and each text is gone through once or
    twice.
    """
    kind = "struct<start:int,end:int,match:string>"
    parts = F.array(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")))

    def whole(p: Column) -> Column:
        lengths = F.zip_with(F.transform(p["found"], F.char_length), p["gaps"], lambda m, g: F.char_length(g) + F.coalesce(m, F.lit(0)))
        ends = _running(lengths, 0, lambda at, n: at + n)
        # the last gap has no match
        rows = F.zip_with(ends, p["found"], lambda end, m: F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("match")))
        return F.filter(rows, lambda m: m["match"].isNotNull())

    # the outer lambda binds the two arrays, which are then computed once a text
    return F.when(F.rlike(text, F.lit(pattern)), F.get(F.transform(parts, whole), F.lit(0))).otherwise(F.array().cast(f"array<{kind}>"))


def _apart(spans: Column, others: Column) -> Column:
    """The ``spans`` (start, end, match) that overlap none of ``others`` (start, end).

    Both are put in one order of starts.  Running sums over it give the
    furthest end of the others before a span, and backwards the nearest start
    of the others after it, so the work grows with the number of spans only.
    """
    mine = F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(1).alias("own"), m["end"].alias("end"), m["match"].alias("match")))
    theirs = F.transform(others, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("own"), b["end"].alias("end"), F.lit("").alias("match")))

    def clear(rows: Column) -> Column:
        end = F.transform(rows, lambda r: F.when(r["own"] == 0, r["end"]).otherwise(0))
        start = F.transform(rows, lambda r: F.when(r["own"] == 0, r["start"]).otherwise(2**31 - 1))
        before = _running(end, 0, lambda a, b: F.greatest(a, b))
        after = F.reverse(_running(F.reverse(start), 2**31 - 1, lambda a, b: F.least(a, b)))
        met = F.filter(F.arrays_zip(rows.alias("row"), before.alias("before"), after.alias("after")), lambda z: (z["row"]["own"] == 1) & (z["before"] <= z["row"]["start"]) & (z["after"] >= z["row"]["end"]))
        return F.transform(met, lambda z: F.struct(z["row"]["start"].alias("start"), z["row"]["end"].alias("end"), z["row"]["match"].alias("match")))

    both = F.array(F.sort_array(F.concat(mine, theirs)))
    return F.when((F.size(others) == 0) | (F.size(spans) == 0), spans).otherwise(F.get(F.transform(both, clear), F.lit(0)))


def _peak_entropy(value: Column) -> Column:
    """Highest Shannon entropy of a window of WINDOW characters, by incremental counts.

    The state holds a count for each distinct character and the sum of
    c log2 c; a step changes that sum by the one character that enters and the
    one that leaves.
    """
    gain = F.array(*(F.lit(0.0 if c < 1 else (c * math.log2(c) - (0 if c == 1 else (c - 1) * math.log2(c - 1)))) for c in range(WINDOW + 2)))

    def bump(counts: Column, k: Column, by: int) -> Column:
        return F.transform(counts, lambda c, j: F.when(j + 1 == k, c + by).otherwise(c))

    def step(acc: Column, i: Column, ids: Column, gains: Column) -> Column:
        enters, leaves = F.get(ids, i), F.get(ids, i - WINDOW)
        up = bump(acc["counts"], enters, 1)
        plus = acc["sum"] + F.get(gains, F.get(up, enters - 1))
        down = F.when(i >= WINDOW, bump(up, leaves, -1)).otherwise(up)
        minus = F.when(i >= WINDOW, plus - F.get(gains, F.get(up, leaves - 1))).otherwise(plus)
        return F.struct(down.alias("counts"), minus.alias("sum"), F.when(i >= WINDOW - 1, F.least(acc["low"], minus)).otherwise(acc["low"]).alias("low"))

    def whole(p: Column) -> Column:
        zero = F.struct(F.transform(p["kinds"], lambda _: F.lit(0)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("low"))
        low = F.aggregate(F.sequence(F.lit(0), F.size(p["ids"]) - 1), zero, lambda acc, i: step(acc, i, p["ids"], p["gains"]))["low"]
        return F.lit(math.log2(WINDOW)) - low / WINDOW

    chars = F.split(value, "")
    parts = F.array(F.struct(chars.alias("chars"), F.array_distinct(chars).alias("kinds")))
    coded = F.transform(parts, lambda p: F.struct(p["kinds"].alias("kinds"), F.transform(p["chars"], lambda c: F.array_position(p["kinds"], c).cast("int")).alias("ids"), gain.alias("gains")))
    return F.get(F.transform(coded, whole), F.lit(0))


def _base_spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    if not group:  # a run of one class is maximal, so shorter ones need not be listed to be dropped
        pattern = f"{pattern[:-1]}{{{least - (4 if kind == 'access' else 0)},}}"
    places = _places(text, pattern)
    if group:
        places = F.filter(places, lambda m: F.char_length(F.regexp_extract(m["match"], pattern, group)) >= least)
    return F.transform(places, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Finds secrets in every whole text.

    Base kinds are patterns (BASE).  The method adds candidate strings one of
    whose windows reaches the entropy of its character class, unless the
    string is on the allow-list or overlaps a base span.  Of a path whose
    folders are words, the last segment is the candidate, if it fills a window.

    Returns the columns of ``docs`` with ``secrets``, which replaces a column
    of that name: an array of (start, rank, end, kind) in code points with an
    exclusive end, in order of start and then of kind as listed.  Null or empty
    text has none; null ids, repeated rows and an empty table pass as they are.
    Texts of any length are read whole, in time that grows with their length
    and, but for a logarithm, with their number of matches.  Nothing is
    shuffled.
    """
    # the user's row is one column, so none of its names can clash
    docs = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    kinds = [*(k for k, *_ in BASE), *(k for k, *_ in CLASSES)]
    base = reduce(F.concat, (_base_spans(text, rank, *spec) for rank, spec in enumerate(BASE)))
    once = docs.withColumn("base", base)
    plain = lambda m: reduce(lambda a, b: a | b, (F.rlike(m["match"], F.lit(p)) for p in ALLOWED))
    mixed = lambda m: (F.char_length(m["match"]) >= WINDOW) & F.rlike(m["match"], F.lit("[0-9]")) & F.rlike(m["match"], F.lit("[A-Za-z]"))
    last = lambda m: F.when(F.rlike(m["match"], F.lit(PATH)), F.substring_index(m["match"], "/", -1)).otherwise(m["match"])
    found = F.filter(_places(text, CANDIDATE), lambda m: mixed(m) & ~plain(m))
    found = F.transform(found, lambda m: F.struct((m["end"] - F.char_length(last(m))).alias("start"), m["end"].alias("end"), last(m).alias("match")))
    candidates = F.filter(found, lambda m: mixed(m) & ~plain(m))
    once = once.withColumn("found", candidates)
    once = once.withColumn("found", _apart(F.col("found"), F.col("base")))
    candidates = F.col("found")
    scored = F.transform(candidates, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["match"].alias("match"), _peak_entropy(m["match"]).alias("bits")))
    first, second = CLASSES
    kind = lambda m: F.when(F.rlike(m["match"], F.lit(first[1])), F.lit(first[0])).otherwise(F.lit(second[0]))
    high = lambda m: m["bits"] >= F.when(F.rlike(m["match"], F.lit(first[1])), F.lit(first[2])).otherwise(F.lit(second[2]))
    rank = lambda m: F.when(F.rlike(m["match"], F.lit(first[1])), F.lit(kinds.index(first[0]))).otherwise(F.lit(kinds.index(second[0])))
    more = F.transform(F.filter(scored, high), lambda m: F.struct(m["start"].alias("start"), rank(m).alias("rank"), m["end"].alias("end"), kind(m).alias("kind")))
    own = [F.col("row")[f.name].alias(f.name) for f in docs.schema["row"].dataType.fields if f.name.lower() != "secrets"]
    return once.select(*own, F.sort_array(F.concat("base", more)).alias("secrets"))


def written_spans(spans: Column) -> Column:
    """kind:start:end of spans that are in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced; overlapping spans give one mark.

    The text is cut into characters once and the spans' running ends tell which
    pieces stay, so the work grows with its length, however many spans it has.
    """

    def cut(p: Column) -> Column:
        ends = _running(F.transform(p["spans"], lambda s: s["end"]), 0, lambda a, b: F.greatest(a, b))
        before = F.concat(F.array(F.lit(0)), ends)
        starts = F.concat(F.transform(p["spans"], lambda s: s["start"]), F.array(F.size(p["chars"])))
        gaps = F.arrays_zip(before.alias("lo"), starts.alias("hi"))
        # a span that starts inside the ones before it leaves no gap and gives no mark of its own
        pieces = F.transform(gaps, lambda g, i: F.concat(F.when((i > 0) & ((g["hi"] >= g["lo"]) | (i == F.size(p["spans"]))), F.lit(mark)).otherwise(""), F.array_join(F.slice(p["chars"], g["lo"] + 1, F.greatest(g["hi"] - g["lo"], F.lit(0))), "")))
        return F.array_join(pieces, "")

    parts = F.array(F.struct(F.split(text, "").alias("chars"), spans.alias("spans")))
    return F.when(F.size(spans) > 0, F.get(F.transform(parts, cut), F.lit(0))).otherwise(text)
