"""Digest queries against plain Python on whole texts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folia.llm import lines, neardup, packing, quality_rules, secret_scan, sharding, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_packing_is_whole_and_tight(docs, rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for r in rows:
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 or 1024
        cuts = [0, len(ids)] if len(ids) <= 1024 else [0, *range(head, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r["doc_id"], k] = (a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b])))
    packed = packing.pack_documents(docs, with_ids=True).cache()
    got = packed.drop("ids").collect()
    assert {(g.doc_id, g.piece): (g.start, g.length, g.ids_crc32) for g in got} == want
    bins = defaultdict(list)
    for g in got:
        bins[g.sequence_id].append((g.offset, g.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(v[1] for v in want.values())
    assert len(bins) <= -(-total // 1024) * 1.01 + 1
    whole = packing.sequences(packed).collect()
    assert sum(len(s.ids) for s in whole) == total and max(len(s.ids) for s in whole) <= 1024


def test_byte_ranks_match_the_other_file():
    import base64

    ours = packing._Encoder.of(public_tokenizers.path("byte_bpe_50k.json")).fast._mergeable_ranks
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        assert ours == {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_subset_sum_fills_bins():
    assert packing.fullest({700: 1, 400: 1, 300: 1, 24: 1}, 1024) == {700: 1, 300: 1, 24: 1}
    patterns = packing.bin_patterns({512: 10, 500: 3, 12: 5}, 1024)
    assert sum(k * n * t for u, t in patterns for k, n in u.items()) == 512 * 10 + 500 * 3 + 12 * 5
    assert sum(t for _, t in patterns) == 7


def line_reference(rows):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    held = defaultdict(set)
    for r in rows:
        for x in (r["text"] or "").split("\n"):
            if len(key(x)) >= 40:
                held[key(x)].add(r["doc_id"])
    out = {}
    for r in rows:
        all_lines = (r["text"] or "").split("\n")
        stay = [x for x in all_lines if not (len(held[key(x)]) >= 5 and max(held[key(x)]) != r["doc_id"])]
        out[r["doc_id"]] = (len(all_lines), len(all_lines) - len(stay), "\n".join(stay))
    return out


def test_lines(docs, rows):
    want = line_reference(rows)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in lines.dedup_lines(docs).collect()}
    assert got == want and any(v[1] for v in want.values())


def near_reference(rows, percent=85):
    sets = {}
    for r in rows:
        w = WORD.findall((r["text"] or "").translate(LOWER))
        sets[r["doc_id"]] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def test_near_duplicates(docs, rows):
    want = near_reference(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()}
    assert got == want and sum(not v[2] for v in want.values()) > 5


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SETS", 8)
    base = [f"t{i}" for i in range(120)]
    texts = []
    for i in range(60):
        w = list(base)
        for j in range(i % 9):
            w[(i * 7 + j * 13) % 120] = f"x{i}_{j}"
        texts.append((i, " ".join(w)))
    want = near_reference([{"doc_id": i, "text": t} for i, t in texts])
    got = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_components(spark):
    from folia.llm.components import connected_components

    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (60, 61), (61, 60), (5, 5), (70, 71), (72, 71)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 60: 60, 61: 60, 70: 70, 71: 70, 72: 70}


def secret_reference(text):
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end(), "assign"))
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_secrets(docs, rows):
    got = {r.doc_id: r.secrets for r in secret_scan.scan_secrets(docs).collect()}
    extra = 0
    for r in rows:
        want = secret_reference(r["text"] or "")
        mine = [tuple(s) for s in got[r["doc_id"]]]
        assert [s for s in mine if s[3] in ("assign", "access", "hex")] == want
        extra += len(mine) - len(want)
    by = {r["doc_id"]: r["text"] for r in rows}
    found = [by[10_017][s.start : s.end] for s in got[10_017] if s.kind.startswith("entropy")]
    assert found == ["Zx8Qp2Lm9Rt4Vb7Nc1Ks"] and extra < 20


def test_entropy_allow_list_and_redaction(spark):
    texts = ["3f2504e0-4f89-11d3-9a0c-0305e82c3301", "2024-01-01/2024-01-02=12345", "zzzzzzzzzzzzzzzzzzzz1111111111", "qX7f/9LmPz3+Kd81WvTgYb0Rs2 end", "usr/local/share/dictionaries/words2024"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = secret_scan.scan_secrets(df).withColumn("clean", secret_scan.redacted(F.col("text"), F.col("secrets"))).orderBy("doc_id").collect()
    assert [len(r.secrets) for r in got] == [0, 0, 0, 1, 0]
    assert got[3].clean == "[secret] end"


@pytest.mark.parametrize("value", ["abcdefghijklmnopqrst", "aaaaaaaaaaaaaaaaaaaabcdefghij", "0123456789abcdef0123456789abcdef01"])
def test_peak_entropy(spark, value):
    import math

    def bits(s):
        return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())

    got = spark.range(1).select(secret_scan._peak_entropy(F.lit(value))).first()[0]
    assert got == pytest.approx(max(bits(value[i : i + 20]) for i in range(len(value) - 19)))


def test_shards(docs, rows):
    got = sharding.shard_documents(docs).collect()
    assert len(got) == len(rows)
    by_text, slots, load, size = defaultdict(set), defaultdict(list), Counter(), Counter()
    for g in got:
        assert g["size"] == len((g.text or "").encode()) + 1
        by_text[g.text or ""].add(g.shard)
        slots[g.shard].append(g.slot)
        load[g.shard] += g["size"]
        size[g.text or ""] += g["size"]
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    keys = {r.t: r.k for r in docs.select(F.coalesce("text", F.lit("")).alias("t"), F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 4).alias("k")).distinct().collect()}
    ordered = [size[t] for t in sorted(size, key=keys.get)]
    assert max(load.values()) == sharding.smallest_capacity(ordered, 16)[0]


def test_smallest_capacity_against_all_cuts():
    import random
    from itertools import combinations

    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 9))]
        best = min(max(sum(sizes[a:b]) for a, b in zip((0, *c), (*c, len(sizes)))) for k in range(3) for c in combinations(range(1, len(sizes)), k))
        assert sharding.smallest_capacity(sizes, 3)[0] == best


def quality_reference(text):
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    in_twice = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            in_twice.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    n = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(in_twice))
    return (*n, n[0] < 20 or 100 * n[4] > 30 * n[0])


def test_quality_statistics(docs, rows):
    got = {r.doc_id: r for r in quality_rules.judge_documents(docs).collect()}
    for r in rows:
        g = got[r["doc_id"]]
        assert (*(g[s] for s in quality_rules.STATS), g.base_failed) == quality_reference(r["text"] or "")
        assert not (g.base_failed and g.kept)


def test_outliers_are_told_from_labels(spark):
    d = "/root/testdata/sf0.01"
    judged = quality_rules.judge_documents(spark.read.parquet(f"{d}/documents.parquet"))
    both = judged.where("not base_failed").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    share = {r.quality: r.k for r in both.collect()}
    assert share[1] > 0.99 and share[0] < 0.3


RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def test_url_rules(spark, sf_dir):
    odd = [(9001, None), (9002, "no scheme"), (9003, "HTTP://Www.EXAMPLE.com?x"), (9004, "https://a.example.com/en/7#x"), (9005, "x://com/en/"), (9006, "http://example.net/de/81?a=://b"), (9007, "http://notexample.com/en/7"), (9008, "http://spam-pills.example.org/win")]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").union(spark.createDataFrame(odd, "page_id long, url string"))
    got = urls.filter_urls(pages, RULES).collect()
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fit = max((k for k, _ in RULES if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith("/" + k.split("/", 1)[1])), key=len, default=None)
        assert (r.host, r.path, r.rule) == (host, path, fit)
        if fit:
            assert r.verdict == dict(RULES)[fit]
    by = {r.page_id: r for r in got}
    assert by[9001].verdict == "allow" and by[9008].verdict == "block" and by[9004].rule == "example.com/en/7"


def test_url_model_on_held_out_words():
    block = ["http://best-casino-games.example.com/en/1", "https://online-pills-shop.example.org/", "http://ads-network.example.net/x", "https://www.free-poker.example.com/de/3"]
    allow = ["http://town-library.example.com/en/1", "https://river-history.example.org/", "http://tionerth.example.net/x", "https://m.theron.example.com/de/3"]
    model = urls.train_url_model()
    assert all(model.score(*urls.host_and_path(u)) >= 0.5 for u in block)
    assert all(model.score(*urls.host_and_path(u)) < 0.5 for u in allow)


def test_clashing_columns_nulls_and_repeats(clashing):
    n = clashing.count()
    assert lines.dedup_lines(clashing).columns == clashing.columns + ["n_dropped"]
    assert lines.dedup_lines(clashing).count() == n
    assert neardup.near_duplicates(clashing).count() == n
    assert sharding.shard_documents(clashing).count() == n
    assert secret_scan.scan_secrets(clashing).count() == n
    assert quality_rules.judge_documents(clashing).count() == n
    assert set(quality_rules.keep_good(clashing).columns) == set(clashing.columns)
    assert packing.pack_documents(clashing).where("piece = 0").count() == n
    gone = neardup.drop_near_duplicates(clashing)
    assert gone.columns == clashing.columns and gone.where("doc_id is null").count() == 1


def test_empty_tables(empty):
    for f in (lines.dedup_lines, neardup.near_duplicates, neardup.drop_near_duplicates, sharding.shard_documents, secret_scan.scan_secrets, quality_rules.judge_documents, quality_rules.keep_good, packing.pack_documents):
        assert f(empty).count() == 0
    assert urls.filter_urls(empty.selectExpr("doc_id page_id", "text url"), RULES).count() == 0
