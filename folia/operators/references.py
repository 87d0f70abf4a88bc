"""References inside texts, and the articles that they mean."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.patterns import cites
from ..functions.text import circled
from .hierarchy import SECTION

_KINDS = "ref_type string, target_law string, target_jo int, target_jo_branch int, target_hang int, target_ho int, target_mok string, raw_text string"
_INTERNAL, _PARAGRAPH, _NEAR = re.compile(X.ARTICLE_REFERENCE), re.compile(X.PARAGRAPH_REFERENCE), re.compile(X.ARTICLE_NEAR)
_TAIL, _ANY = re.compile(X.LAW_TAIL), re.compile(f"({X.ANY_LAW}){X.LAW_TAIL}")
#: Tasks over which the texts of a document spread, and blocks of it that stay together.
SPREAD, TOGETHER = 8, 1024


class LawFinder:
    """Citations of laws with an article: those of given names, or of anything named like a law if none are given.

    Names are found all at once by an automaton (a trie with failure links),
    so a text takes one pass, however many names there are.  Of names that
    begin at one place the longest with an article counts, so that a name does
    not hide one that it begins.
    """

    def __init__(self, names: Iterable[str] = ()):
        self.automaton = None
        known = {n for n in names if n}
        if known:
            self.automaton = ahocorasick.Automaton()
            for n in known:
                self.automaton.add_word(n, len(n))
            self.automaton.make_automaton()

    def cites(self, text: str) -> list[tuple[int, int, str, tuple]]:
        """Start, end, name and numbers (article, branch, paragraph, item) of each citation, none within another."""
        if self.automaton is None:
            return [(m.start(), m.end(), m[1], m.groups()[1:]) for m in _ANY.finditer(text)]
        ends: dict[int, list[int]] = {}
        for last, n in self.automaton.iter(text):
            ends.setdefault(last - n + 1, []).append(last + 1)
        out, free = [], 0
        for start in sorted(ends):
            if start >= free:
                tails = ((stop, _TAIL.match(text, stop)) for stop in sorted(ends[start], reverse=True))
                found = next(((stop, m) for stop, m in tails if m), None)
                if found:
                    stop, m = found
                    free = m.end()
                    out.append((start, free, text[start:stop], m.groups()))
        return out


def _int(s: str | None) -> int | None:
    return int(s) if s else None


def find_references(text: str, article: int | None, laws: LawFinder | Iterable[str] = ()) -> list[tuple]:
    """External, internal and paragraph-only references of one text, in this order."""
    cites = (laws if isinstance(laws, LawFinder) else LawFinder(laws)).cites(text)
    out = [("external", law, *map(_int, numbers), None, text[a:b]) for a, b, law, numbers in cites if "약관" not in law]
    k = 0
    for m in _INTERNAL.finditer(text):
        while k < len(cites) and cites[k][1] <= m.start():
            k += 1
        if k == len(cites) or m.start() < cites[k][0]:
            out.append(("internal", None, int(m[1]), _int(m[2]), _int(m[4]), _int(m[5]), m[6] or None, m[0]))
    if article:
        known = {r[4] for r in out if r[2]}
        for m in _PARAGRAPH.finditer(text):
            n = int(m[1])
            if n in known or _NEAR.search(text[max(0, m.start() - X.NEAR) : m.start()]):
                continue
            known.add(n)
            out.append(("internal", None, article, None, n, None, None, m[0]))
    return out


def extract_references(texts: DataFrame, laws: DataFrame) -> DataFrame:
    """The ``refs`` relation, not yet resolved, with ``ordinal`` in order of extraction within a document's texts.

    Spark has no function that gives all matches with their places, so texts
    go through Python in Arrow batches.  A document's texts are dealt to SPREAD
    tasks at most, a short document's to one, and each task gets the document's
    names of laws once, before its texts, and makes one automaton of them.
    """
    keys = [*SECTION, "seq", "part", "owner_uid", "source_id"]
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    none = {c: F.lit(None).cast(kinds[c]).alias(c) for c in [*keys, "text", "article_no"] if c != "doc_id"}
    salt = F.pmod(F.floor(F.col("seq") / TOGETHER), F.lit(SPREAD)).cast("int").alias("salt")
    own = texts.where(cites(F.col("text"))).select(salt, F.lit(None).cast("string").alias("law"), *keys, "text", "article_no")
    # a document without texts needs no names, and one with few gets them few times; no text is read for this
    asked = texts.select("doc_id", salt).distinct()
    names = laws.where("law is not null").select("doc_id", "law").distinct().join(asked, "doc_id").select("salt", "law", "doc_id", *(none[c] for c in [*keys, "text", "article_no"] if c != "doc_id"))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.unionByName(names).repartition(parts, "doc_id", "salt").sortWithinPartitions("doc_id", "salt", F.col("law").isNull())
    made = [c.split(" ") for c in _KINDS.split(", ")]
    types = [pa.int32(), *(pa.int32() if kind == "int" else pa.string() for _, kind in made)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, finder = None, [], None
        for batch in batches:
            source, rows = [], []
            facts = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "salt", "law", "text", "article_no")), strict=True)
            for i, (doc, salt, law, text, no) in enumerate(facts):
                if (doc, salt) != now:
                    now, known, finder = (doc, salt), [], None
                if law is not None:
                    known.append(law)
                    continue
                finder = finder or LawFinder(known)
                for j, r in enumerate(find_references(text, no, finder)):
                    source.append(i)
                    rows.append((j, *r))
            if rows:
                at = pa.array(source)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), *columns], [*keys, "ordinal", *(n for n, _ in made)])

    return dealt.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", ordinal int, " + _KINDS)


def resolve_references(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``resolved_id`` of internal references whose article stands in the section that their id begins with.

    Of articles that repeat a number the last one counts.  The id joins the
    article's with the paragraph, item and subitem named, whether or not these
    exist.
    """
    index = nodes.where("type = '조'").groupBy("doc_id", F.col("section_name").alias("at"), F.col("number").alias("no"), F.coalesce("branch", F.lit(-1)).alias("br")).agg(F.max_by("id", "path" if "path" in nodes.columns else "preorder").alias("article_id"))
    want = F.when((F.col("ref_type") == "internal") & (F.col("target_jo") != 0), F.substring_index("source_id", ".", 1))
    met = refs.withColumns({"at": want, "br": F.coalesce("target_jo_branch", F.lit(-1))}).withColumn("no", F.col("target_jo")).join(index, ["doc_id", "at", "no", "br"], "left")
    part = lambda c, shown: F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != "0"), shown)
    full = F.concat_ws(".", "article_id", part("target_hang", circled(F.col("target_hang"))), part("target_ho", F.concat("target_ho", F.lit("."))), part("target_mok", F.concat("target_mok", F.lit("."))))
    return met.withColumn("resolved_id", F.when(F.col("article_id").isNotNull(), full)).drop("at", "no", "br", "article_id")


def reference_statistics(refs: DataFrame) -> DataFrame:
    return refs.groupBy("ref_type").agg(F.count(F.lit(1)).alias("n"), F.count("resolved_id").alias("resolved"))
