"""Repair of the structure of conversations by cheapest edits, found with bucket queues."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, salted_join

#: White space of ASCII, and marks that end a whole text.
SPACE, ENDS = " \t\n\x0b\x0c\r", [".", "!", "?"]
#: Costs of edits; a truncated text that is kept in any way costs one more.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: Initials of roles as numbers, and faults of a row: none, must go, truncated.
#: A row's code is its initial plus four times its fault.
INITIALS, OTHER = "sua", 3
SOUND, MUST_GO, TRUNCATED = 0, 1, 2
#: States of the grammar (s?(ua)+)?: start, after s, after u, after a; NEXT is
#: the state after an initial, ASKED the role that a new or changed row takes.
NEXT = [{0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2}]
ASKED = [1, 1, 2, 1]
ROLES = {1: "user", 2: "assistant"}
AFTER = [NEXT[s][ASKED[s]] for s in range(4)]
#: Inserted rows that end a conversation from each state.
CLOSE = ["", "II", "I", ""]
FAR = 1 << 40


def _steps(code: int) -> list[tuple[str, int, int, int]]:
    """Edits of a row with a code: letter, state before, state after, cost; letters of a state in order."""
    initial, fault = code % 4, code // 4
    out = []
    for s in range(4):
        out.append(("D", s, s, DELETE))
        if fault != MUST_GO:
            more = CUT if fault == TRUNCATED else 0
            if initial in NEXT[s]:
                out.append(("K", s, NEXT[s][initial], KEEP + more))
            out.append(("R", s, AFTER[s], REROLE + more))
    return out


_STEPS = [_steps(code) for code in range(12)]
#: For a row's code and the state after it, the states before it with costs; and those before an insertion.
_BEFORE = [[[(p, cost) for _, p, q, cost in steps if q == s] for s in range(4)] for steps in _STEPS]
_INSERTED = [[p for p in range(4) if AFTER[p] == s] for s in range(4)]
_OF = [[[(letter, q, cost) for letter, p, q, cost in steps if p == s] for s in range(4)] for steps in _STEPS]


def distances(codes: bytes, seeds: list[int]) -> list[list[int]]:
    """Cost from each place and state to the end of the rows, where a state costs its seed.

    The costs of edits are small whole numbers, so a queue is a row of buckets,
    one for each distance (Dial), which is gone through once; a state is in it
    as often as its distance was lowered.
    """
    n = len(codes)
    dist = [[FAR] * 4 for _ in range(n + 1)]
    base = min(seeds)
    buckets: list[list[tuple[int, int]]] = []

    def put(i: int, s: int, d: int) -> None:
        if d < dist[i][s]:
            dist[i][s] = d
            while len(buckets) <= d - base:
                buckets.append([])
            buckets[d - base].append((i, s))

    for s, d in enumerate(seeds):
        if d < FAR:
            put(n, s, d)
    at = 0
    while at < len(buckets):
        d = base + at
        # a bucket grows while it is read, as keeping a row costs nothing
        for i, s in buckets[at]:
            if dist[i][s] == d:
                if i < n:
                    for p in _INSERTED[s]:
                        put(i, p, d + INSERT)
                if i:
                    for p, cost in _BEFORE[codes[i - 1]][s]:
                        put(i - 1, p, d + cost)
        buckets[at] = []
        at += 1
    return dist


def walk(codes: bytes, dist: list[list[int]], state: int) -> tuple[str, int]:
    """The least of the cheapest edit strings from a state, by tight arcs, and the state that it ends in."""
    out = []
    for i, code in enumerate(codes):
        while True:
            here = dist[i][state]
            (_, _, cost), *others = _OF[code][state]
            if here == cost + dist[i + 1][state]:
                out.append("D")
                break
            if here == INSERT + dist[i][AFTER[state]]:
                out.append("I")
                state = AFTER[state]
                continue
            letter, state = next((x, q) for x, q, cost in others if here == cost + dist[i + 1][q])
            out.append(letter)
            break
    return "".join(out), state


def damage_turns(turns: DataFrame) -> DataFrame:
    """``conversations`` with every fifth row or so damaged, by a checksum of its place.

    Nulls read as one space.  Of 20 remainders, 0 drops the row, 1 empties its
    text, 2 takes its end marks, 3 repeats it and 4 gives it to the user.
    """
    space = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(place.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    rows = turns.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _key(conv: Column) -> Column:
    return F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string")))


def coded_turns(turns: DataFrame) -> DataFrame:
    """Rows of ``turns`` in order and in segments, with the code of each.

    Columns: ``key`` (of a conversation), ``conv_id``, ``turn``, ``role``,
    ``text`` (null for one that repeats a row of its turn), ``fault``, ``code``,
    ``seg`` and ``pos``.  Rows of a conversation go by turn, nulls first, then
    role, then a hash of the text.  Segments are the parts of one range
    partitioning, so a conversation of any size is spread over tasks, and a
    segment holds no more than a partition.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    base = turns.select(_key(F.col("conv_id")).alias("key"), "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.sha2(text.cast("binary"), 256).alias("hash"), text.alias("text"))
    # rows that agree in all are counted, so copies of one row, however many, meet in no task
    held = base.groupBy("key", "conv_id", "turn", "role", "hash", "text").agg(F.count(F.lit(1)).alias("copies"))
    same = ["key", "role", "hash"]
    again = held.groupBy(*same).agg(F.count(F.lit(1)).alias("places"), F.min(F.struct("turn")).alias("first")).where("places > 1").select(*same, "first")
    met = salted_join(held, again, same, F.col("turn"), "left")
    late = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    rows = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rest = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(rest == "", "blank").when(late | (F.col("copy") > 1), "duplicate").when(~F.right(rest, F.lit(1)).isin(ENDS), "truncated")
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.col("role") == "") | (initial == 0), OTHER).otherwise(initial - 1)
    weight = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", TRUNCATED).otherwise(SOUND)
    rows = rows.withColumn("fault", fault).withColumn("code", (initial + 4 * weight).cast("int"))
    order = ["key", "turn", "role", "hash", "copy"]
    rows = rows.select("conv_id", *order, F.when(F.col("copy") == 1, F.col("text")).alias("text"), "fault", "code")
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return placed.select("key", "conv_id", "turn", "role", "text", "fault", "code", F.spark_partition_id().alias("seg"), F.monotonically_increasing_id().alias("pos"))


def _segments(rows: DataFrame) -> DataFrame:
    codes = F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda r: r["code"])
    return rows.groupBy("key", "seg").agg(codes.alias("codes"))


def _crossings(segments: DataFrame) -> DataFrame:
    """Costs from each state before a segment to each after it, and what counts of wrong neighbours need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fine = {(0, 1), (1, 2), (2, 1)}
        for batch in batches:
            costs, illegal, ends = [], [], []
            for codes in map(bytes, batch.column(2).to_pylist()):
                to = [distances(codes, [0 if s == end else FAR for s in range(4)])[0] for end in range(4)]
                costs.append([to[end][s] for s in range(4) for end in range(4)])
                kinds = [c % 4 for c in codes]
                illegal.append(sum(x not in fine for x in zip(kinds, kinds[1:], strict=False)))
                ends.append([kinds[0], kinds[-1]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(costs, pa.list_(pa.int64())), pa.array(illegal, pa.int64()), pa.array(ends, pa.list_(pa.int32()))], ["key", "seg", "costs", "illegal", "ends"])

    return segments.mapInArrow(run, "key string, seg int, costs array<long>, illegal long, ends array<int>")


def _costs_after(crossings: DataFrame) -> DataFrame:
    """Per conversation: ``cost``, ``illegal`` and ``ahead``, the costs from each state after each segment to the end.

    A conversation has no more segments than there are partitions, and each is
    16 numbers, so they are folded in one row.
    """
    close = F.array(*(F.lit(INSERT * len(x)).cast("long") for x in CLOSE))
    start = F.struct(close.alias("now"), F.array().cast("array<struct<seg:int,ahead:array<bigint>>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.array_min(F.zip_with(F.slice(x["costs"], s * 4 + 1, 4), acc["now"], lambda c, t: c + t)))
        return F.struct(before.alias("now"), F.array_append(acc["out"], F.struct(x["seg"].alias("seg"), acc["now"].alias("ahead"))).alias("out"))

    held = crossings.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("seg", "costs", "illegal", "ends"))).alias("segs"))
    done = held.select("key", "segs", F.aggregate(F.reverse("segs"), start, step).alias("done"))
    pair = lambda a, b: F.concat_ws("", F.element_at(a["ends"], 2), F.element_at(b["ends"], 1))
    joints = F.zip_with("segs", F.slice("segs", 2, F.size("segs")), lambda a, b: b.isNotNull() & ~pair(a, b).isin("01", "12", "21"))
    illegal = F.aggregate("segs", F.lit(0).cast("long"), lambda n, x: n + x["illegal"]) + F.size(F.filter(joints, lambda x: x))
    return done.select("key", F.get("done.now", F.lit(0)).alias("cost"), illegal.alias("illegal"), F.col("done.out").alias("ahead"))


def _walked(segments: DataFrame) -> DataFrame:
    """Edit strings of a segment for each state before it, with the state after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for codes, ahead in zip(map(bytes, batch.column(2).to_pylist()), batch.column(3).to_pylist(), strict=True):
                dist = distances(codes, ahead)
                made.append([walk(codes, dist, s) for s in range(4)])
            audits = pa.array([[a for a, _ in row] for row in made], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), audits, pa.array([[s for _, s in row] for row in made], pa.list_(pa.int32()))], ["key", "seg", "audits", "exits"])

    return segments.mapInArrow(run, "key string, seg int, audits array<string>, exits array<int>")


def _chosen(walked: DataFrame) -> DataFrame:
    """The edits of each segment from the state that the segments before it lead to."""
    start = F.struct(F.lit(0).alias("state"), F.array().cast("array<struct<seg:int,state:int>>").alias("out"))
    step = lambda acc, x: F.struct(F.get(x["exits"], acc["state"]).alias("state"), F.array_append(acc["out"], F.struct(x["seg"].alias("seg"), acc["state"].alias("state"))).alias("out"))
    held = walked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("seg", "exits"))).alias("segs"))
    done = held.select("key", F.aggregate("segs", start, step).alias("done"), F.element_at("segs", -1)["seg"].alias("last"))
    states = done.select("key", "last", F.col("done.state").alias("end"), F.explode("done.out").alias("x")).select("key", "last", "end", "x.seg", "x.state")
    close = F.when(F.col("seg") == F.col("last"), F.get(F.array(*map(F.lit, CLOSE)), F.col("end"))).otherwise("")
    return walked.join(states, ["key", "seg"]).select("key", "seg", "state", F.concat(F.get("audits", F.col("state")), close).alias("audit"))


def _applied(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Every edit as a row: ``key``, ``conv_id``, ``seg``, ``step``, ``edit``, ``role`` and ``text``, the last two after it (a deleted row's own)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None)
    heads = chosen.select("key", "seg", F.lit(-1).cast("long").alias("pos"), none.cast(kind).alias("conv_id"), F.col("state").cast("string").alias("role"), F.col("audit").alias("text"))
    both = heads.unionByName(rows.select("key", "seg", "pos", "conv_id", "role", "text"))
    dealt = both.repartition(parts, "key", "seg").sortWithinPartitions("key", "seg", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, step = "", 0, 0, 0
        for batch in batches:
            cols = [batch.column(i) for i in (0, 1, 2, 4, 5)]
            source: list[int] = []
            made: list[tuple] = []
            for i, (key, seg, pos, role, text) in enumerate(zip(*(c.to_pylist() for c in cols), strict=True)):
                if pos < 0:
                    audit, at, state, step = text, 0, int(role), 0
                    continue
                done = False
                # insertions after a conversation's last row belong to that row
                while at < len(audit) and (not done or audit[at:].strip("I") == ""):
                    edit = audit[at]
                    done |= edit != "I"
                    if edit == "D":
                        row = (role, text)
                    elif edit == "K":
                        row = (role, text)
                        state = NEXT[state][INITIALS.index(role[0])]
                    else:
                        row = (ROLES[ASKED[state]], text if edit == "R" else "")
                        state = AFTER[state]
                    source.append(i)
                    made.append((key, seg, step, edit, *row))
                    at, step = at + 1, step + 1
            if made:
                out = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([out[0], batch.column(3).take(pa.array(source)), *out[1:]], ["key", "conv_id", "seg", "step", "edit", "role", "text"])

    return dealt.select("key", "seg", "pos", "conv_id", "role", "text").mapInArrow(run, f"key string, conv_id {kind}, seg int, step long, edit string, role string, text string")


def _hashes(edits: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired rows; it is sequential by nature, so a conversation streams through one task."""
    parts = int(edits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = F.concat_ws(":", "role", "text").alias("line")
    kept = edits.where("edit <> 'D'").select("key", "seg", "step", line).repartition(parts, "key").sortWithinPartitions("key", "seg", "step")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key == now:
                    digest.update(b"\n")
                else:
                    if digest:
                        out.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                digest.update(line.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], ["key", "hash"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["key", "hash"])

    return kept.select("key", "line").mapInArrow(run, "key string, hash string")


@dataclass
class Repair:
    """``edits``: a row an edit; ``report``: a row a conversation."""

    edits: DataFrame
    report: DataFrame


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repair:
    """Makes every conversation follow the pattern of an optional system turn and pairs of user and assistant.

    A row's first fault counts: ``blank`` (white space only), ``duplicate``
    (role and text came before in the conversation) or ``truncated`` (the last
    character that is no white space ends no sentence).  Edits: keep a row (0),
    give it to the user or the assistant (2), delete it (3; blank rows and
    duplicates must go), insert an empty row (2); a truncated row that stays
    costs 1 more.  The cheapest edits are found, of equals the least by their
    letters (D, I, K, R).

    ``report``: ``conv_id``, ``gaps`` (missing numbers of turns), ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` (neighbours out of pattern),
    ``cost``, ``audit`` (letters of the edits) and ``repaired_sha256`` (of
    ``role:text`` of the repaired rows, joined by newlines).  ``edits``:
    ``conv_id``, ``seg`` and ``step`` (their order), ``edit``, ``role`` and
    ``text``.

    A null role or text reads as one space; a null id is a conversation of its
    own; turns are whole numbers, null ones come first and are left out of
    gaps; rows of one turn go by role and then by a hash of their text.
    Repeated rows are duplicates.  Texts are taken whole, whatever their
    length.  Other columns are left out, so none can clash.  An empty table
    gives empty tables.

    A conversation may have any number of rows: its ordered rows are cut into
    segments, each a bucket-queue search over its own rows with the costs that
    lie ahead of it; only 16 numbers of a segment meet those of others.  What
    one row of the report holds grows with its conversation by one letter a row.
    """
    own = turns.select(*(F.col(c).alias(name) for c, name in ((conv_col, "conv_id"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))))
    rows = Stored(coded_turns(own)).df
    segments = Stored(_segments(rows.select("key", "seg", "pos", "code"))).df
    costs = Stored(_costs_after(_crossings(segments))).df
    ahead = costs.select("key", F.explode("ahead").alias("x")).select("key", "x.seg", "x.ahead")
    walked = Stored(_walked(segments.join(ahead, ["key", "seg"]))).df
    chosen = Stored(_chosen(walked)).df
    edits = _applied(rows, chosen)
    audits = chosen.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    count = lambda f: F.count_if(F.col("fault") == f).alias(f)
    found = rows.groupBy("key").agg(F.first("conv_id").alias("conv_id"), *map(count, ("blank", "duplicate", "truncated")))
    # distinct turns first, so that a large conversation is counted in parts
    turns_of = rows.where("turn is not null").select("key", "turn").distinct().groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    report = found.join(costs.select("key", "cost", "illegal"), "key").join(audits, "key").join(turns_of, "key", "left").join(_hashes(edits), "key", "left")
    empty = hashlib.sha256(b"").hexdigest()
    report = report.select("conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("hash", F.lit(empty)).alias("repaired_sha256"))
    return Repair(edits.drop("key"), report)


def repaired_digest(turns: DataFrame) -> DataFrame:
    """The report of every conversation in ``turns`` after :func:`damage_turns`; one that lost all its rows has zeros."""
    report = repair_conversations(damage_turns(turns)).report
    ids = turns.select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    met = ids.join(report.withColumn("key", _key(F.col("conv_id"))).drop("conv_id"), "key", "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return met.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers), *(F.coalesce(c, F.lit(v)).alias(c) for c, v in empty.items()))
