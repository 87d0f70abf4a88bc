"""Fill-in-the-middle rearrangement of whole texts, by SQL of an embedded engine over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import slices

#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 documents so many are rearranged, and of these so many with the suffix first.
MOVED, SUFFIX_FIRST = 90, 20
#: Code points of a piece.  Texts are cut into pieces, and only the two pieces
#: in which a cut lies into single code points.
PIECE = 64


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def restored_sql(output: str, form: str, marks: tuple[str, str, str] = MARKS) -> str:
    """SQL that rebuilds a text from nothing but its output and form.

    The marks stand once each in a rearranged output, as texts that hold one
    are left plain.
    """
    p, s, m = map(_quoted, marks)
    part = lambda x, mark, k: f"split_part({x}, {mark}, {k})"
    after_p, after_s = part(output, p, 2), part(output, s, 2)
    psm = f"{part(after_p, s, 1)} || {part(output, m, 2)} || {part(after_s, m, 1)}"
    spm = f"{part(after_p, m, 1)} || {part(output, m, 2)} || {part(after_s, p, 1)}"
    return f"CASE {form} WHEN 'plain' THEN {output} WHEN 'psm' THEN {psm} ELSE {spm} END"


def _sql(seed: int, marks: tuple[str, str, str], moved: int, suffix_first: int) -> str:
    p, s, m = map(_quoted, marks)
    held = " OR ".join(f"contains(t, {x})" for x in (p, s, m))
    word = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS UBIGINT)"
    chars = lambda at: f"coalesce(regexp_extract_all(pieces[{at} // {PIECE} + 1], '(?s).'), [])"
    joined = lambda x: f"array_to_string({x}, '')"
    return f"""
        WITH texts AS (SELECT i, coalesce(t, '') AS t, sha256('{seed}:' || coalesce(id, '')) AS h FROM batch),
        drawn AS (SELECT i, t, length(t) AS n, {", ".join(f"{word(k)} AS h{k + 1}" for k in range(4))} FROM texts),
        formed AS (SELECT *, h1 % (n + 1) AS one, h2 % (n + 1) AS other,
                CASE WHEN n = 0 OR {held} OR h3 % 100 >= {moved} THEN 'plain' WHEN h4 % 100 < {suffix_first} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        cuts AS (SELECT i, t, n, form, CAST(least(one, other) AS BIGINT) AS a, CAST(greatest(one, other) AS BIGINT) AS b FROM formed),
        cut AS (SELECT *, CASE WHEN form = 'plain' THEN [] ELSE regexp_extract_all(t, '(?s).{{1,{PIECE}}}') END AS pieces FROM cuts),
        edges AS (SELECT *, {chars("a")} AS at_a, {chars("b")} AS at_b FROM cut),
        parts AS (SELECT i, t, n, form, a, b,
                {joined(f"list_slice(pieces, 1, a // {PIECE})")} || {joined(f"list_slice(at_a, 1, a % {PIECE})")} AS prefix,
                CASE WHEN a // {PIECE} = b // {PIECE} THEN {joined(f"list_slice(at_a, a % {PIECE} + 1, b % {PIECE})")}
                    ELSE {joined(f"list_slice(at_a, a % {PIECE} + 1, {PIECE})")} || {joined(f"list_slice(pieces, a // {PIECE} + 2, b // {PIECE})")} || {joined(f"list_slice(at_b, 1, b % {PIECE})")} END AS middle,
                {joined(f"list_slice(at_b, b % {PIECE} + 1, {PIECE})")} || {joined(f"list_slice(pieces, b // {PIECE} + 2, len(pieces))")} AS suffix FROM edges),
        put AS (SELECT i, n, form, a, b, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN {p} || prefix || {s} || suffix || {m} || middle ELSE {s} || suffix || {p} || prefix || {m} || middle END AS output FROM parts)
        SELECT i, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            output, sha256(output) AS output_sha256, sha256({restored_sql("output", "form", marks)}) AS restored_sha256 FROM put"""


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, marks: tuple[str, str, str] = MARKS, moved: int = MOVED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Every document's ``output`` for training on infilling.

    Returns ``doc_id``, ``n`` (code points), ``form``, ``prefix_chars`` and
    ``middle_chars`` (null if plain), ``output``, ``output_sha256`` and
    ``restored_sha256``, which is of the text rebuilt from output and form.
    Two cuts, the form and the order are drawn from a hash of ``seed`` and id,
    so a row has the same output wherever and whenever it is made.

    Null text is the empty text, which stays plain, as does a text that holds a
    mark.  A null id draws as the empty string; rows that repeat an id draw the
    same numbers, each for its own text.  Columns other than id and text are
    left out, so none can clash.  An empty table gives an empty table.

    Each batch of a couple of megabytes of text is registered in an embedded
    SQL engine of one thread; texts are taken whole, one at least at a time,
    and need a few times their own size.  Nothing is shuffled, and a task that
    is lost is made again from its rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sql = _sql(seed, marks, moved, suffix_first)
    columns = {"doc_id": kind, "n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string", "output_sha256": "string", "restored_sha256": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        # no files of its own, no extensions from elsewhere
        with duckdb.connect(config={"threads": 1, "temp_directory": "", "autoinstall_known_extensions": False, "autoload_known_extensions": False}) as con:
            for batch in batches:
                for lo, hi in slices(batch.column(2)):
                    ids, shown, texts = (c.slice(lo, hi - lo) for c in batch.columns)
                    con.register("batch", pa.table({"i": pa.array(range(hi - lo), pa.int64()), "id": shown, "t": texts}))
                    made = con.execute(sql).to_arrow_table().combine_chunks()
                    con.unregister("batch")
                    for part in made.to_batches():
                        yield pa.RecordBatch.from_arrays([ids.take(part.column(0)), *(part.column(k).cast(pa.string() if columns[name] == "string" else pa.int64()) for k, name in enumerate(columns) if k)], list(columns))

    return docs.select(F.col(id_col), F.col(id_col).cast("string").alias("shown"), F.col(text_col)).mapInArrow(run, ", ".join(f"`{k}` {v}" for k, v in columns.items()))
