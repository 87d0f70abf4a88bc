"""All spans against a plain Python scan, and texts with very many of them."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folia.llm import secret_scan
from tests.llm.test_contracts import secret_reference

PART = r"(?:[A-Z]{0,6}[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]{1,12})"
WORD = rf"_*{PART}(?:_+{PART})*_*"
FOLDERS = rf"(?:/?{WORD}/)+"


def bits(s):
    return max(-sum(n / 20 * math.log2(n / 20) for n in Counter(s[i : i + 20]).values()) for i in range(len(s) - 19))


def added(text, base):
    """What the method adds: kind and place of every candidate that is mixed, not allowed and rich enough."""

    def wanted(x):
        plain = re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", x) or re.fullmatch(rf"{FOLDERS}(?:(?:{WORD}|[0-9]{{1,8}})-+)*(?:{WORD}[0-9]{{0,4}}|[0-9]{{1,8}})?-*", x)
        return len(x) >= 20 and re.search("[0-9]", x) and re.search("[A-Za-z]", x) and not plain

    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        start, x = m.start(), m[0]
        if wanted(x) and re.fullmatch(rf"{FOLDERS}[A-Za-z0-9_-]*", x):
            x = x.rsplit("/", 1)[-1]
            start = m.end() - len(x)
        if not wanted(x) or any(b[0] < m.end() and start < b[2] for b in base):
            continue
        hexed = re.fullmatch("[0-9a-fA-F-]+", x)
        if bits(x) >= (3.0 if hexed else 3.6) - 1e-12:
            out.append((start, 3 if hexed else 4, m.end(), "entropy_hex" if hexed else "entropy_base64"))
    return out


def made(rng):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda n, of=letters: "".join(rng.choice(of) for _ in range(n))
    kinds = [
        lambda: some(rng.randrange(15, 50)),
        lambda: some(rng.randrange(15, 50), letters + "+/_=-"),
        lambda: f"{rng.choice(['token', 'API_KEY', 'passwd', 'Secret'])}{rng.choice(['=', ': ', '\":\"', ' '])}{some(rng.randrange(3, 30))}",
        lambda: f"{some(12)}password={some(9)}.{some(24)}",
        lambda: some(rng.randrange(20, 40), "0123456789abcdef"),
        lambda: some(rng.randrange(20, 40), "0123456789ABCDEF-"),
        lambda: "AKIA" + some(rng.randrange(10, 30), letters[:26] + "0123456789"),
        lambda: f"com/{rng.choice(['hook', 'myPath', 'a1'])}/{some(rng.randrange(10, 30))}",
        lambda: "read-the-news-of-2024-and-more",
        lambda: "".join(rng.choice("ab01") for _ in range(30)),
        lambda: rng.choice(["été", "中文", "𝒳", "word", "\n", "x" * 25, "3f2504e0-4f89-11d3-9a0c-0305e82c3301"]),
    ]
    return rng.choice([" ", " ", ", ", ""]).join(rng.choice(kinds)() for _ in range(rng.randrange(0, 14)))


def test_all_spans_equal_a_plain_scan(spark, rows):
    rng = random.Random(12)
    texts = [made(rng) for _ in range(600)] + [r["text"] or "" for r in rows]
    got = secret_scan.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    extra = 0
    for r in got:
        base = secret_reference(r.text)
        more = added(r.text, base)
        assert [tuple(s) for s in r.secrets] == sorted(base + more), r.text
        extra += len(more)
    assert extra > 300


@pytest.mark.parametrize("kind", ["hex", "mixed"])
def test_very_many_matches(spark, kind):
    rng = random.Random(3)
    of = "0123456789abcdef" if kind == "hex" else "ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789"
    words = ["".join(rng.choice(of) for _ in range(24)) for _ in range(100_000)]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id int, text string")
    began = time.time()
    (r,) = secret_scan.scan_secrets(df).select(F.size("secrets").alias("n"), F.element_at("secrets", -1)["end"].alias("end")).collect()
    assert r.n > 0.9 * len(words) and r.end == 25 * len(words) - 1
    assert time.time() - began < (10 if kind == "hex" else 60)


def test_very_long_candidates(spark):
    texts = ["a/" * 200_000 + "x1", "aBbb" * 100_000 + "1", "word-" * 100_000 + "2", "_a" * 200_000 + "/9", "A" * 300_000 + "1", "-" * 500_000 + "a1"]
    got = secret_scan.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert len(got) == len(texts)


def test_redaction(spark):
    text = "é secret=abcdef12 password: token=abcdefgh x 𝒳 tail"
    df = spark.createDataFrame([(1, text, [(9, 17), (10, 12), (17, 18), (45, 48)]), (2, text, []), (3, "", [])], "id int, text string, spans array<struct<start:int,end:int>>")
    got = {r.id: r.t for r in df.select("id", secret_scan.redacted(F.col("text"), F.col("spans"), "*").alias("t")).collect()}
    assert got == {1: text[:9] + "**" + text[18:45] + "*" + text[48:], 2: text, 3: ""}


def test_time_follows_the_number_of_matches(spark):
    """Four times the matches take far less than sixteen times the time."""
    rng = random.Random(7)
    took = {}
    for n in (1_000, 100_000, 400_000):
        text = " ".join("".join(rng.choices("0123456789abcdef", k=24)) for _ in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id int, text string").cache()
        df.count()
        began = time.time()
        (r,) = secret_scan.scan_secrets(df).select(F.size("secrets").alias("n"), F.element_at("secrets", -1)["end"].alias("end")).collect()
        took[n] = time.time() - began
        df.unpersist()
        assert r.n == n and r.end == 25 * n - 1
    assert took[400_000] < 8 * took[100_000] + 2


def test_own_columns_stay(spark):
    df = spark.createDataFrame([(1, "secret=abcdef12", "a", "b", "c", "d", "e")], "doc_id int, text string, __base string, __found string, `row` string, base string, `a.b` string")
    r = secret_scan.scan_secrets(df).first()
    assert (r["__base"], r["__found"], r["row"], r["base"], r["a.b"], r["text"]) == ("a", "b", "c", "d", "e", "secret=abcdef12")
    assert [tuple(x) for x in r.secrets] == [(0, 0, 15, "assign")]
