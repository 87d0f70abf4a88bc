"""Repairs of conversations against plain Python that keeps whole edit strings."""

import hashlib
import random
import re
import zlib

import pytest

from folia.llm import conversations, queries

SPACE = re.compile(r"[^\x20\x09-\x0D]")


def best_edits(rows, faults):
    """(cost, letters) by relaxing (cost, letters) pairs until none changes, from the last row back."""
    grammar = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    asked = {"": "u", "s": "u", "u": "a", "a": "u"}

    def closed(best):
        changed = True
        while changed:
            changed = False
            for s in asked:
                after = best.get(asked[s])
                if after and (s not in best or (after[0] + 2, "I" + after[1]) < best[s]):
                    best[s], changed = (after[0] + 2, "I" + after[1]), True
        return best

    best = closed({"": (0, ""), "a": (0, "")})
    for (role, _), fault in reversed(list(zip(rows, faults))):
        now = {}
        for s in asked:
            options = [(best[s][0] + 3, "D" + best[s][1])]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                to = grammar.get((s, role[:1]))
                if to:
                    options.append((best[to][0] + more, "K" + best[to][1]))
                options.append((best[asked[s]][0] + 2 + more, "R" + best[asked[s]][1]))
            now[s] = min(options)
        best = closed(now)
    return best[""]


def repaired(rows, letters):
    asked = {"": "u", "s": "u", "u": "a", "a": "u"}
    state, out, at = "", [], 0
    for x in letters:
        if x == "D":
            at += 1
            continue
        role = rows[at][0] if x == "K" else {"u": "user", "a": "assistant"}[asked[state]]
        state = role[0]
        out.append((role, "" if x == "I" else rows[at][1]))
        at += x != "I"
    assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in out))
    return out


def report(turns):
    """turns: (turn, role, text) of one conversation."""
    space = lambda x: " " if x is None else x
    rows = [(t, space(r), space(x)) for t, r, x in turns]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    known = {t for t, *_ in rows if t is not None}
    rows = [(r, x) for _, r, x in rows]
    faults, seen = [], set()
    for role, text in rows:
        last = SPACE.findall(text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None)
        seen.add((role, text))
    cost, letters = best_edits(rows, faults)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{x}" for r, x in repaired(rows, letters))
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def by_conv(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(rest)
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def made(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "u", "User"]
    texts = ["ok.", "fine!", "cut off", " \t", "", "why?", "end. \n", "été", "x.\x85", "long text " * 40 + "."]
    return [(rng.choice([None, *range(n)]), rng.choices(roles, [9, 9, 2, 1, 1, 1, 1])[0], rng.choice([*texts, f"text {rng.random()}.", f"text {rng.random()}", None])) for _ in range(n)]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = by_conv(damaged(rows))
    assert got(queries.op12_repair(spark, sf_dir)) == {c: report(after.get(c, [])) for c in by_conv(rows)}


def test_random_conversations(spark):
    rng = random.Random(4)
    convs = {c: made(rng, rng.randrange(1, 12)) for c in [None, *range(400)]}
    rows = [(c, *r) for c, turns in convs.items() for r in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(conversations.repair_conversations(df).report) == {c: report(t) for c, t in convs.items()}
    again = by_conv(damaged(rows))
    assert got(conversations.repaired_digest(df)) == {c: report(again.get(c, [])) for c in convs}


def test_one_conversation_over_all_tasks(spark):
    """A third of all rows in one conversation, a part of them equal in all columns, and its segments meet."""
    rng = random.Random(5)
    hot = [(k // 2, "user" if k % 2 else "assistant", f"text {rng.random()}{rng.choice('.!?x')}") for k in range(1500)] + [(7, "user", "same.")] * 800 + [(t, "user", "often.") for t in range(300)]
    rows = [(-1, *r) for r in hot] + [(c, *r) for c in range(300) for r in made(rng, 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert conversations.coded_turns(df).where("key = '=-1'").select("seg").distinct().count() > 1
    result = conversations.repair_conversations(df)
    want = {c: report(t) for c, t in by_conv(rows).items()}
    assert got(result.report) == want
    edits = result.edits.where("conv_id = -1").orderBy("seg", "step").collect()
    assert "".join(e.edit for e in edits) == want[-1][-2]
    text = "\n".join(f"{e.role}:{e.text}" for e in edits if e.edit != "D")
    assert hashlib.sha256(text.encode()).hexdigest() == want[-1][-1]


def test_edge_tables(spark):
    assert got(conversations.repaired_digest(spark.createDataFrame([], SCHEMA))) == {}
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    zeros = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    more = spark.createDataFrame([(5, gone, "user", "a", "x", "y"), (None, None, None, None, None, None)], SCHEMA + ", seg string, audit string")
    kept = damaged([(None, None, None, None)])
    assert got(conversations.repaired_digest(more)) == {5: zeros, None: report([r[1:] for r in kept])}
    named = spark.createDataFrame([("a=b", 1, "user", "x" * 2_000_000 + "."), ("", 1, "user", "hi.")], "conv_id string, turn int, role string, text string")
    assert got(conversations.repair_conversations(named).report) == {"a=b": report([(1, "user", "x" * 2_000_000 + ".")]), "": report([(1, "user", "hi.")])}


@pytest.mark.parametrize("seed", range(3))
def test_distances_and_walks(seed):
    """Bucket queues give the least cost and letters for any seeds, also where a state can't be left."""
    rng = random.Random(seed)
    for _ in range(200):
        codes = bytes(rng.randrange(12) for _ in range(rng.randrange(1, 9)))
        seeds = [rng.randrange(6) for _ in range(4)]
        dist = conversations.distances(codes, seeds)
        for s in range(4):
            letters, end = conversations.walk(codes, dist, s)
            cost = seeds[end] + sum({"D": 3, "I": 2, "R": 2, "K": 0}[x] for x in letters) + sum(c // 4 == 2 for c, x in zip(codes, letters.replace("I", "")) if x != "D")
            assert cost == dist[0][s]
