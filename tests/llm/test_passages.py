"""Decontamination and repeated passages against brute force."""

import random
import re

import pyarrow as pa

from folia.llm import decontam, repeats


def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_nearest_is_exact():
    rng = random.Random(2)
    for _ in range(60):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 80)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        got, end = decontam.nearest(item, text)
        assert got == edit_distance_in(item, text) == edit_distance_in(item, text[:end])


def edited(text, rate, rng):
    out = []
    for x in text.split():
        u = rng.random()
        if u < rate / 3:
            continue
        out.append(f"zq{rng.randrange(999)}" if u < 2 * rate / 3 else x)
        if 2 * rate / 3 <= u < rate:
            out.append("vv")
    return " ".join(out)


def test_recall_with_edits(spark, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    filler = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]
    rng, index = random.Random(8), decontam.ItemIndex(items)
    for rate, least in ((0.0, 1.0), (0.05, 0.97), (0.1, 0.9)):
        texts = [f"{filler[k]} {edited(t, rate, rng)} {filler[-k - 1]}" for k, (_, t) in enumerate(items)]
        found = {(m[0], index.ids[m[1]]) for m in index.matches(pa.array(texts))}
        assert sum((k, i) in found for k, (i, _) in enumerate(items)) >= least * len(items)


def plain(text):
    return " ".join(re.findall(r"[^\W_]+|[^\x00-\x7f]+", text)).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_contaminated_against_brute_force(spark, docs, rows, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = decontam.contaminated(docs, bench).collect()
    pairs = {(g.doc_id, g.item_id): g for g in got}
    ids = {r["doc_id"]: r["text"] or "" for r in rows}
    squeezed = {d: " ".join(re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", t).lower().split()) for d, t in ids.items()}
    whole = {(d, i) for d, t in squeezed.items() for i, text in items if " ".join(re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", text).lower().split()) in t}
    assert whole <= set(pairs) and whole
    for (d, _), g in pairs.items():
        passage = ids[d][g.start : g.end]
        assert g.edits <= 0.2 * g.item_chars and passage and abs(len(passage) - g.item_chars) < 0.5 * g.item_chars
    stay = {r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()}
    assert stay == set(ids) - {d for d, _ in pairs}


def test_decontamination_edge_cases(spark, clashing, empty, sf_dir):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, "the same eight words stand here again and the same eight words stand")], "item_id int, text string")
    got = decontam.contaminated(clashing, bench).collect()
    assert {(g.doc_id, g.item_id) for g in got} == {(10_018, 4)}
    assert decontam.contaminated(empty, bench).count() == 0
    assert decontam.contaminated(clashing, bench.limit(0)).count() == 0
    kept = decontam.drop_contaminated(clashing, bench)
    assert kept.columns == clashing.columns and kept.count() == clashing.count() - 1


def test_several_passes_agree(spark, docs, sf_dir, monkeypatch):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    once = sorted(decontam.contaminated(docs, bench).collect())
    monkeypatch.setattr(decontam, "PASS_BYTES", 3000)
    assert sorted(decontam.contaminated(docs, bench).collect()) == once


def covered(texts, n):
    """Words of each document that lie in an n-word window another document holds as well."""
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in texts.items()}
    where = {}
    for d, w in words.items():
        for i in range(len(w) - n + 1):
            where.setdefault(tuple(w[i : i + n]), set()).add(d)
    out = {}
    for d, w in words.items():
        out[d] = {j for i in range(len(w) - n + 1) if len(where[tuple(w[i : i + n])]) > 1 for j in range(i, i + n)}
    return out


def test_repeated_passages(docs, rows):
    want = covered({r["doc_id"]: r["text"] for r in rows}, 50)
    got = {d: set() for d in want}
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in repeats.repeated_passages(docs).collect():
        got[r.doc_id] |= set(range(r.first_word, r.end_word))
        passage = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id][r.start : r.end])
        assert passage == re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])[r.first_word : r.end_word]
        assert r.n_words >= 50 and r.is_copy == (r.smallest_other < r.doc_id)
    assert sum(map(len, want.values())) > 5000
    assert all(got[d] <= want[d] for d in want)
    assert sum(map(len, got.values())) >= 0.999 * sum(map(len, want.values()))


def test_common_passage_over_many_partitions(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [(i, " ".join(f"a{rng.randrange(10**6)}" for _ in range(40)) + f" {passage} " + " ".join(f"b{rng.randrange(10**6)}" for _ in range(40))) for i in range(300)]
    texts += [(1000 + i, " ".join(f"c{rng.randrange(10**6)}" for _ in range(120))) for i in range(50)]
    got = repeats.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(9)).collect()
    assert sorted(r.doc_id for r in got) == list(range(300))
    assert all((r.first_word, r.end_word) == (40, 100) for r in got)


def test_repeats_edge_cases(clashing, empty):
    assert repeats.repeated_passages(empty).count() == 0
    got = repeats.repeated_passages(clashing).collect()
    assert {r.doc_id for r in got} >= {10_006, 10_007} and all(r.doc_id for r in got)
