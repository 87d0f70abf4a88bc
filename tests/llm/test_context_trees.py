"""Context-tree scores against a plain recursive model, and base scores against counts."""

import math
import random
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from folia.llm import context_trees, queries
from tests.llm.test_contracts import LOWER, WORD


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def read(text):
    return (" ".join(words(text)) + "\n").encode()


class Plain:
    """Weighted trees by dictionaries and recursion, one node at a time."""

    def __init__(self, texts, depth=context_trees.DEPTH):
        self.depth, self.counts, self.children = depth, Counter(), {}
        for text in texts:
            for context, byte in self.places(text):
                for k in range(8):
                    node, bit = (1 << k) | (byte >> (8 - k)), byte >> (7 - k) & 1
                    for d in range(depth + 1):
                        here = context[depth - d :]
                        self.counts[here, node, bit] += 1
                        if d < depth:
                            self.children.setdefault((here, node), set()).add(context[depth - d - 1 :])
        self.known = {}

    def places(self, text):
        data = b"\n" * self.depth + read(text)
        return [(data[i - self.depth : i], data[i]) for i in range(self.depth, len(data))]

    def kt(self, context, node):
        a, b = self.counts[context, node, 0], self.counts[context, node, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, context, node):
        at = (context, node)
        if at not in self.known:
            own = self.kt(context, node)
            if len(context) < self.depth:
                deep = sum(self.weighted(c, node) for c in self.children.get(at, ()))
                top = max(own, deep)
                own = top + math.log(math.exp(own - top) + math.exp(deep - top)) - math.log(2)
            self.known[at] = own
        return self.known[at]

    def p(self, context, d, node, bit):
        here = context[self.depth - d :]
        a, b = self.counts[here, node, 0], self.counts[here, node, 1]
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == self.depth:
            return own
        stop = math.exp(self.kt(here, node) - math.log(2) - self.weighted(here, node))
        return stop * own + (1 - stop) * self.p(context, d + 1, node, bit)

    def score(self, text):
        total = 0.0
        for context, byte in self.places(text):
            for k in range(8):
                total += math.log10(self.p(context, 0, (1 << k) | (byte >> (8 - k)), byte >> (7 - k) & 1))
        return total


def check(got, rows, model=None):
    train = Counter(t for i, text in rows if not held_out(i) for t in [*words(text), "\n"])
    n, v = sum(train.values()), len(train)
    assert len(got) == len(rows)
    texts = {}
    for i, text in rows:
        texts.setdefault(i, []).append(text)
    for r in got:
        options = []
        for text in texts[r.doc_id]:
            tokens = [*words(text), "\n"]
            base = sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
            options.append((len(tokens), sum(train[t] > 0 for t in tokens), base, text))
        m = [o for o in options if o[:2] == (r.n_tokens, r.n_known) and math.isclose(o[2], r.base_score, rel_tol=1e-9, abs_tol=1e-9)]
        assert m and r.held_out == held_out(r.doc_id) and r.train_tokens == n
        if model:
            assert any(math.isclose(model.score(o[3]), r.score, rel_tol=1e-8) for o in m), r
            assert any(math.isclose(-r.score * math.log2(10) / len(read(o[3])), r.bits_per_byte, rel_tol=1e-9) for o in m)


def test_scores_equal_a_plain_model(spark):
    rng = random.Random(6)
    vocab = ["the", "cat", "sat", "ONE", "état", "中文字", "x", "aaaaaaaa", "\x85", "1234567890"]
    rows = [(i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(rng.choices(vocab, k=rng.randrange(0, 14)))) for i in range(60)]
    rows += [(None, "a row without an id"), (None, None), (3, "the id of another"), (3, "the id of another"), (100, ""), (101, " \t\n"), (102, "never seen before 𝒳𝒴")]
    rng.shuffle(rows)
    got = context_trees.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    check(got, rows, Plain([t for i, t in rows if not held_out(i)]))


def test_query_on_whole_table(spark, sf_dir):
    """All documents are checked by count; what is held out is told better than by frequency from some megabytes on."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(queries.op11_score(spark, sf_dir).collect(), rows)
    fresh = queries.op11_score(spark, sf_dir.replace("0.001", "0.1")).where("held_out").collect()
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)


def test_edge_tables(spark, clashing, empty):
    assert context_trees.score_documents(empty).collect() == []
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    check(context_trees.score_documents(clashing).collect(), rows)
    names = [str(i) for i in range(200) if held_out(str(i))][:3]
    only = context_trees.score_documents(spark.createDataFrame([(n, "ab") for n in names], "doc_id string, text string")).collect()
    # nothing is learnt, so each of the 3 bytes has probability 1/256
    assert {(r.n_known, r.train_tokens, r.base_score) for r in only} == {(0, 0, 0.0)}
    assert all(math.isclose(r.score, -3 * math.log10(256)) for r in only)


def test_grams_cover_every_byte():
    texts = ["Ab  c", "", None, " x ", "é"]
    gram, off, _ = context_trees.byte_grams(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        n = context_trees.DEPTH
        data = b"\n" * n + read(text)
        want = [sum(data[j - k] << 8 * (n + 1 - k) for k in range(1, n + 1)) | data[j] for j in range(n, len(data))]
        assert gram[off[i] : off[i + 1]].tolist() == want


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_groups_are_never_cut(chunk, monkeypatch):
    monkeypatch.setattr(context_trees, "_CHUNK", chunk)
    key = sorted(random.Random(1).choices(range(40), k=300))
    batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + 11])], ["k"]) for i in range(0, 300, 11)]
    parts = [p[0].tolist() for p in context_trees._whole_groups(iter(batches))]
    assert sum(parts, []) == key and not any(a[-1] == b[0] for a, b in zip(parts, parts[1:]))
