"""Scalar text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import ASCII_ROMAN, CIRCLED, MOK, SMALL_ROMAN


#: What ``(?U)\\s`` matches.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends; null is empty.  A pattern would look at every character of a whole text."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITE))


def group(c: Column, pattern: str, n: int) -> Column:
    """A group of a pattern, empty if it takes no part."""
    return F.regexp_extract(c, pattern, n)


def whole_number(c: Column) -> Column:
    """Digits of any width as an integer; null if there are none or too many."""
    return F.translate(c, "０１２３４５６７８９", "0123456789").try_cast("int")


def token_count(c: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")).cast("int")


def safe_filename(c: Column) -> Column:
    """Without characters that file systems refuse, white space as one underscore, at most 50 long."""
    bare = F.regexp_replace(c, r'[\\/*?:"<>|]', "")
    return F.substring(F.regexp_replace(bare, r"(?U)\s+", "_"), 1, 50)


def safe_id(c: Column) -> Column:
    return F.regexp_replace(c, "[^가-힣a-zA-Z0-9_]", "_")


def escape_html(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for raw, named in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(named))
    return out


def punctuation(c: Column) -> Column:
    """No space before an opening bracket, comma or stop, none after a closing bracket."""
    c = F.regexp_replace(c, r"(?U)\s+\(", "(")
    c = F.regexp_replace(c, r"(?U)\)\s+", ")")
    return F.regexp_replace(c, r"(?U)\s+([,.])", "$1")


def normalised(c: Column) -> Column:
    """Line feeds as spaces, stripped, no escaped quotes, single spaces."""
    flat = strip(F.replace(punctuation(c), F.lit("\n"), F.lit(" ")))
    return F.regexp_replace(F.replace(flat, F.lit('\\"'), F.lit("")), r"(?U)\s+", " ")


def has_private_glyphs(c: Column) -> Column:
    return F.coalesce(F.rlike(c, F.lit(r"[\x{E000}-\x{F8FF}]")), F.lit(False))


def circled_number(c: Column) -> Column:
    return F.when(c != "", F.nullif(F.instr(F.lit(CIRCLED), c), F.lit(0)))


def circled(n: Column) -> Column:
    """Marker of a paragraph; beyond twenty it is spelled out."""
    return F.when(n <= len(CIRCLED), F.substring(F.lit(CIRCLED), n, F.lit(1))).otherwise(F.concat(F.lit("제"), n, F.lit("항")))


def mok_number(c: Column) -> Column:
    return F.when(c != "", F.nullif(F.instr(F.lit(MOK), c), F.lit(0)))


def roman_number(c: Column) -> Column:
    """Value of a roman numeral up to ten, of one small sign or of letters; 1 if it is none."""
    small = F.translate(c, "IVXⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ", "ivx" + SMALL_ROMAN)
    place = F.array_position(F.array(*map(F.lit, ASCII_ROMAN)), small).cast("int")
    return F.coalesce(F.nullif(F.instr(F.lit(SMALL_ROMAN), small), F.lit(0)), F.nullif(place, F.lit(0)), F.lit(1))


def glyph_type(c: Column) -> Column:
    return (
        F.when(F.rlike(c, F.lit("^[가-힣]")), "korean")
        .when(F.rlike(c, F.lit(r"^[\x{4E00}-\x{9FFF}]")), "hanja")
        .when(F.rlike(c, F.lit(r"^[\p{Nd}\p{No}&&[^½¼¾]]+$")), "number")
        .when(F.rlike(c, F.lit(r"^\p{L}+$")), "english")
        .when(F.instr(F.lit("(),.，。"), c) > 0, "punctuation")
        .otherwise("other")
    )
