"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, gapless_rank
from .kernels import slices

#: GPT-style pre-tokenisation that the byte-level vocabulary was made with; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters of one run of white space from which on a text goes through the
#: slower library; the faster one fails at some 500,000.
LONG_SPACE = 50_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Copies of each available length that fill one bin best.

    The longest length is placed once, as every piece has to go somewhere; the
    rest of the bin is a bounded subset-sum problem.  ``reach`` is a bitset of
    sums; each length is added in copies of 1, 2, 4 ... as far as counted, and
    the bitsets before each addition lead back to the combination.
    """
    top = max(counts)
    room = capacity - top
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == top), room // length)
        copies = 1
        while left > 0:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left -= take
            copies *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {top: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= take * length
            used[length] = used.get(length, 0) + take
    return used


def bin_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins for all pieces: combinations of lengths, each with the number of bins that repeat it.

    A combination repeats until one of its lengths runs short, so the list is
    about as long as the number of distinct lengths, however many pieces there are.
    """
    left = dict(counts)
    out = []
    while left:
        used = fullest(left, capacity)
        times = min(left[k] // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((used, times))
    return out


def _layout(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies a bin, first bin, offset in the bin) of every use of a length."""
    rank: dict[int, int] = {}
    rows, first_bin = [], 0
    for used, times in patterns:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            lo = rank.get(length, 0)
            rows.append((length, lo, lo + n * times, n, first_bin, offset))
            rank[length] = lo + n * times
            offset += n * length
        first_bin += times
    return rows


class _Encoder:
    """Ids of the byte-level vocabulary in a tokenizers file, made once in a worker."""

    _made: dict[str, _Encoder] = {}

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(shown[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        # the same merges as in the file, run by the faster of the two libraries
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain = Tokenizer.from_file(path)

    @classmethod
    def of(cls, path: str) -> _Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def ids(self, text: str) -> list[int]:
        # the faster library's pattern engine has no stack for white space without end
        if any(s in text for s in self.special) or len(text) >= LONG_SPACE and _LONG_SPACE.search(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def token_pieces(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row a piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A document is its text's ids and ``end_id``; null text is the empty text.
    A document longer than ``capacity`` is cut into pieces of just that length,
    with what is over in the first piece.  Texts are taken whole, whatever their
    length and whatever runs of white space, letters or digits they hold; one
    document's ids are in memory at a time.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = _Encoder.of(tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                rows: list[list] = [[] for _ in range(6)]
                for i, text in enumerate(batch.column(1)[lo:hi].to_pylist()):
                    ids = np.array([*encoder.ids(text or ""), end_id], "<u4")
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        for col, v in zip(rows, (lo + i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].astype("i4") if with_ids else None), strict=True):
                            col.append(v)
                made = [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:5])]
                if with_ids:
                    made.append(pa.array(rows[5], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(made)])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(pieces, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Packs all documents into as few sequences of ``capacity`` tokens as minimum bin slack finds.

    Returns one row a piece: ``doc_id``, ``piece`` (from 0), ``start`` (ids of
    the document before it), ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` (its place there, gapless from 0) and, if asked for, ``ids``.

    Null or empty text is packed as its end id alone.  Null ids and repeated
    rows are packed like others, each row by itself.  Very long texts are cut as
    :func:`token_pieces` says.  Columns other than id and text are left out, so
    none can clash.  An empty table gives an empty table.

    Only the histogram of lengths, with at most ``capacity`` rows, comes to the
    driver; there the combinations are chosen, each with its number of bins.
    Pieces get their rank among pieces of one length, hot lengths cut into
    buckets, and from it their bin and offset by arithmetic.
    """
    spark = docs.sparkSession
    pieces = Stored(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids)).df
    # the place of a row in the stored table tells rows apart that agree in all columns
    pieces = pieces.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    layout = spark.createDataFrame(_layout(bin_patterns(counts, capacity)), "use_length long, lo long, hi long, copies long, bin long, at long")
    # the uses of a length are few and ordered by rank: an array of them a length, at most capacity rows
    layout = layout.groupBy("use_length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "copies", "bin", "at"))).alias("uses"))
    ranked = gapless_rank(pieces, "length", ["__file", "__row"], "rank", counts)
    met = ranked.join(F.broadcast(layout), F.col("length") == F.col("use_length"))
    use = F.get(F.filter("uses", lambda u: (F.col("rank") >= u["lo"]) & (F.col("rank") < u["hi"])), F.lit(0))
    met = met.withColumn("use", use)
    within = F.col("rank") - F.col("use.lo")
    out = [F.col(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    out += [(F.col("use.bin") + F.floor(within / F.col("use.copies"))).cast("long").alias("sequence_id"), (F.col("use.at") + within % F.col("use.copies") * F.col("length")).cast("long").alias("offset")]
    return met.select(*out, *([F.col("ids")] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` and the ids of the documents in it.

    ``packed`` comes from :func:`pack_documents` with ``with_ids``; a sequence
    has at most ``capacity`` tokens, so its rows are bounded.
    """
    row = F.struct("offset", "doc_id", "ids")
    got = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return got.select("sequence_id", F.flatten(F.col("rows.ids")).alias("ids"), F.array_distinct("rows.doc_id").alias("doc_ids"))
