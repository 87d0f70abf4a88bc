"""What a block of text is: section title, heading, special block or law name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X
from .text import circled_number, group, mok_number, roman_number, strip, whole_number


def _matches(c: Column, pattern: str) -> Column:
    return F.rlike(c, F.lit(pattern))


def _led(c: Column, leads: str, pattern: str) -> Column:
    """A pattern for what begins with one of some characters; a whole text that does not is not searched from all its places."""
    begins = reduce(lambda a, b: a | b, (F.startswith(c, F.lit(x)) for x in leads))
    return begins & _matches(c, pattern)


def is_section_title(content: Column) -> Column:
    """``content`` is stripped already."""
    any_of = lambda patterns: reduce(lambda a, b: a | b, (_matches(content, p) for p in patterns))
    named = reduce(lambda a, b: a | b, (content.contains(w) for w in X.SECTION_TITLE_WORDS))
    return (content != "") & (F.char_length(content) <= X.SECTION_TITLE_MOST) & named & any_of(X.SECTION_TITLES) & ~any_of(X.NO_SECTION_TITLES)


def heading(content: Column) -> Column:
    """Struct ``type, level, number, branch, marker, title, body`` of a heading, or null.

    The first rule of the grammar that fits decides; sentences that only refer
    to an article fit none.  ``content`` may be an expression: it is bound once,
    as all rules ask for it, and a whole text is long.
    """
    # each step is bound by a transform of its own: an item taken inside one has its type worked out for every row
    ruled = F.transform(F.array(content), lambda c: F.struct(c.alias("content"), _rule(c).alias("rule")))
    return F.get(F.transform(ruled, lambda x: _heading(x["content"], x["rule"])), F.lit(0))


def _rule(content: Column) -> Column:
    """The place in the grammar of the first rule that fits, or -1."""
    led, others = F.when(_matches(content, X.REFERENCE_SENTENCE), F.lit(-1)), F.when(content == "", F.lit(-1))
    for i, (_, _, pattern) in enumerate(X.GRAMMAR):
        if "^" + X.LEAD in pattern:
            led = led.when(_matches(content, pattern), F.lit(i))
        else:
            others = others.when(_matches(content, pattern), F.lit(i))
    # rules that ask for the lead are for what begins with it, the others for what begins as one of them does
    return F.when(F.startswith(content, F.lit(X.LEAD)), led.otherwise(F.lit(-1))).when(_matches(F.substring(content, 1, 1), X.OTHER_LEADS), others.otherwise(F.lit(-1))).otherwise(F.lit(-1))


def _heading(content: Column, rule: Column) -> Column:
    n_rules = len(X.GRAMMAR)

    def one(i: int) -> Column:
        name, kind, pattern = X.GRAMMAR[i]
        g = lambda n: group(content, pattern, n)
        none, empty = F.lit(None).cast("int"), F.lit("")
        number, branch, body = whole_number(g(1)), none, empty
        if name == "special":
            number = none
            title = F.when(g(1) != "", g(1)).otherwise(g(2))
            marker = F.when(g(1) != "", F.concat(F.lit("【"), g(1), F.lit("】"))).otherwise(F.concat(F.lit("<"), g(2), F.lit(">")))
        elif name in ("편", "장", "절", "관"):
            marker = F.concat(F.lit("제"), g(1), F.lit(kind))
            title = F.coalesce(F.nullif(strip(g(2)), empty), content)
        elif name == "장의":
            branch, marker = whole_number(g(2)), F.concat(F.lit("제"), g(1), F.lit("장의"), g(2))
            title = F.coalesce(F.nullif(strip(g(3)), empty), content)
        elif name == "조의":
            branch, marker = whole_number(g(2)), F.concat(F.lit("제"), g(1), F.lit("조의"), g(2))
            title, body = strip(g(3)), strip(g(4))
        elif name == "조":
            marker, title, body = F.concat(F.lit("제"), g(1), F.lit("조")), strip(g(2)), strip(g(3))
        elif name == "조 only":
            marker, title = F.concat(F.lit("제"), g(1), F.lit("조")), F.substring(strip(g(2)), 1, 20)
        elif name == "항":
            number, marker, title = circled_number(g(1)), g(1), F.substring(g(2), 1, 50)
        elif name == "호":
            marker, title = F.concat(g(1), F.lit(".")), F.substring(g(2), 1, 50)
        elif name == "목":
            number, marker, title = mok_number(g(1)), F.concat(g(1), F.lit(".")), F.substring(g(2), 1, 50)
        elif name == "세목":
            number, marker, title = roman_number(g(1)), F.concat(F.lit("("), g(1), F.lit(")")), F.substring(g(2), 1, 50)
        else:
            number, marker, title = none, F.lit("-"), F.substring(g(1), 1, 50)
        return F.struct(
            F.lit(kind).alias("type"),
            F.lit(X.LEVELS[kind]).alias("level"),
            number.cast("int").alias("number"),
            branch.alias("branch"),
            marker.alias("marker"),
            title.alias("title"),
            body.alias("body"),
        )

    # only the rule's own branch is worked out
    return reduce(lambda c, i: c.when(rule == i, one(i)), range(1, n_rules), F.when(rule == 0, one(0)))


def global_special(content: Column) -> Column:
    """Struct ``type, marker, title`` of a block that stands outside the hierarchy, or null."""
    return F.get(F.transform(F.array(content), _global_special), F.lit(0))


def _global_special(content: Column) -> Column:
    title = F.substring(content, 1, 50).alias("title")
    made = lambda kind, marker: F.struct(F.lit(kind).alias("type"), marker.alias("marker"), title)
    return (
        F.when(_led(content, "[【", X.APPENDIX), made("appendix", F.concat(F.lit("[별표"), group(content, X.APPENDIX, 1), F.lit("]"))))
        .when(_led(content, "※", X.GLOSSARY), made("glossary", F.lit("※용어정의")))
        .when(_led(content, "비", X.NOTE), made("note", F.lit("비고")))
        .when(content.contains(X.LAW_WORDS) | _led(content, "[【", X.LAW_BLOCK), made("law_reference", F.lit("법규정")))
    )


def forced_article(content: Column) -> Column:
    """Struct ``number, title, body`` of one line that begins as an article but fits no rule, or null."""
    return F.get(F.transform(F.array(content), _forced_article), F.lit(0))


def _forced_article(content: Column) -> Column:
    rest = strip(group(content, X.FORCED_ARTICLE, 2))
    titled = _matches(rest, X.FORCED_TITLE)
    return F.when(
        _matches(content, X.FORCED_ARTICLE),
        F.struct(
            whole_number(group(content, X.FORCED_ARTICLE, 1)).alias("number"),
            F.when(titled, strip(group(rest, X.FORCED_TITLE, 1))).otherwise(F.substring(rest, 1, 50)).alias("title"),
            F.when(titled, strip(group(rest, X.FORCED_TITLE, 2))).otherwise(rest).alias("body"),
        ),
    )


def block_facts(content: Column) -> Column:
    """Struct of all that the parser's rules say of a block, with its ``content``: ``titled``, ``law``, ``g`` (global special), ``m`` (heading), ``f`` (forced article), ``h`` and ``jp`` (begins as a structure, as an article).

    All rules are asked where ``content`` is bound, before anything is shuffled or sorted.
    """
    asked = lambda c: F.struct(c.alias("content"), is_section_title(c).alias("titled"), _law_name(c).alias("law"), _global_special(c).alias("g"), _rule(c).alias("rule"), _led(c, X.LEAD, X.STRUCTURE_PREFIX).alias("h"), _led(c, X.LEAD, X.ARTICLE_PREFIX).alias("jp"))

    def answered(x: Column) -> Column:
        forced = F.when((x["rule"] < 0) & x["g"].isNull() & x["jp"], _forced_article(x["content"]))
        return F.struct(*(x[k].alias(k) for k in ("content", "titled", "law", "g", "h", "jp")), _heading(x["content"], x["rule"]).alias("m"), forced.alias("f"))

    return F.get(F.transform(F.transform(F.array(content), asked), answered), F.lit(0))


def law_name(content: Column) -> Column:
    """The law that a block names, or null."""
    return F.get(F.transform(F.array(content), _law_name), F.lit(0))


def _law_name(content: Column) -> Column:
    lone = _matches(F.substring(content, 1, 1), X.LAW_LEAD) & _matches(content, X.LONE_LAW)
    return F.when(_led(content, "【", X.NAMED_LAW), strip(group(content, X.NAMED_LAW, 1))).when(lone, content)


def cites(text: Column) -> Column:
    """Whether a text can hold a reference: all of them name an article or a paragraph."""
    return text.contains("제") & (text.contains("조") | text.contains("항"))


def section_type(name: Column) -> Column:
    return (
        F.when(name.contains("보통약관"), "base")
        .when(name.contains("특별약관"), "special")
        .when(name.contains("추가약관"), "additional")
        .when(name.contains("법규") | _matches(name, "^[가-힣]+법"), "law_reference")
        .when(name.contains("민원") | name.contains("분쟁") | name.contains("유의"), "dispute")
        .otherwise("other")
    )
