"""Harmonic packing of token ids into training sequences.

Classes are the reciprocal capacities capacity / k for k = 1, 2, 4, ...  Documents may be cut
freely, so each is cut into full sequences and then, by the binary digits of the rest, into at
most one piece of every smaller class.  A bin of class k takes exactly k pieces, whichever they
are, and is then full: a class needs only the running number of its pieces, and workers fill
bins without knowing of each other.  The running number is the count of pieces in earlier
lanes of the class plus the place inside the lane, lanes being a hash of document and start.

The last, unfilled bin of a class is split by the binary digits of its number of pieces into
sequences whose length is a power of two, so that no sequence is padded at all.

Sequences may be kept to one group of documents each (a language): every group has classes of its own.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.arrow_map import map_rows
from telemetry_spark.llm.bpe import TreeBpe
from telemetry_spark.llm.common import free_name, materialise, quoted, table


class IdBytes:
    """Texts to ids, as little-endian unsigned 32-bit numbers in bytes.

    The merges are those of the tokenizer file, run by the tree encoder; special strings of the
    file that stand in a text are its special ids, as the file's own library has it by default."""

    def __init__(self, vocabulary: str, pattern: str):
        with open(vocabulary, encoding="utf-8") as text:
            added = json.load(text).get("added_tokens", [])
        self.special = {t["content"]: t["id"].to_bytes(4, "little") for t in added}
        self.splitter = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if added else None
        self.tree = TreeBpe(vocabulary, pattern, leaf_chars=1 << 15)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tree.encode(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        parts, done = [], 0
        for m in self.splitter.finditer(text) if self.splitter else ():
            parts += [self._plain(text[done:m.start()]), self.special[m.group()]]
            done = m.end()
        return b"".join([*parts, self._plain(text[done:])])


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, pattern: str) -> IdBytes:
    return IdBytes(vocabulary, pattern)


def piece_lengths(tokens: int, capacity: int) -> list[int]:
    """Full sequences, then the binary digits of the rest, largest first."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in reversed(range(capacity.bit_length())) if rest >> b & 1]


def cut_documents(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens) for every piece of every document, with the
    piece's ids in ``ids`` (binary, little-endian unsigned 32-bit) if asked for."""
    source = docs.select(quoted(id_col), quoted(text_col).cast("string").alias(free_name(docs, "_text")), *[quoted(c) for c in carry])
    kinds = [source.schema[0], *source.schema[2:]]
    fields = [T.StructField(id_col, kinds[0].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType())]
    fields += [T.StructField("ids", T.BinaryType())] if with_ids else []
    fields += [T.StructField(f.name, f.dataType) for f in kinds[1:]]
    end = end_id.to_bytes(4, "little")

    def rows(encoder, keys, texts, *rest):
        for key, text, *more in zip(keys, texts, *rest):
            ids = memoryview(encoder.encode(text or "") + end)
            start, tokens = 0, len(ids) // 4
            for length in piece_lengths(tokens, capacity):
                piece = ids[4 * start:4 * (start + length)]
                yield (key, start, length, zlib.crc32(piece), tokens, *([bytes(piece)] if with_ids else []), *more)
                start += length

    return map_rows(source, rows, T.StructType(fields), setup=lambda: _encoder(vocabulary, pattern))


def bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, first piece, first sequence, pieces a sequence) of every run of equal
    sequences, from the number of pieces of each length."""
    runs, sequence = [], 0
    for length in sorted(counts, reverse=True):
        per, first = capacity // length, 0
        while counts[length] - first:
            while per > counts[length] - first:
                per //= 2
            many = (counts[length] - first) // per
            runs.append((length, first, sequence, per))
            first, sequence = first + many * per, sequence + many
    return runs


def grouped_bins(counts: dict[tuple[int, int], int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(group, length, first piece, first sequence, pieces a sequence) of the runs of every group, one
    group's sequences after another's, from the number of pieces of each group and length."""
    found, sequence = [], 0
    for group in sorted({g for g, _ in counts}):
        own = {length: n for (g, length), n in counts.items() if g == group}
        runs = bins(own, capacity)
        found += [(group, length, first, sequence + at, per) for length, first, at, per in runs]
        length, first, at, per = runs[-1]
        sequence += at + (own[length] - first) // per
    return found


def _with_group(pieces: DataFrame, by: str | None, groups: int) -> DataFrame:
    """``pieces`` with ``_group``: the place of its value among the ``groups`` that have most ids."""
    if by is None:
        return pieces.withColumn("_group", F.lit(0))
    named = pieces.withColumn("_name", quoted(by).cast("string"))
    sizes = named.where("_name is not null").groupBy("_name").agg(F.sum("length").alias("ids"))
    largest = [r["_name"] for r in sizes.orderBy(F.desc("ids"), "_name").limit(groups).collect()]
    places = pieces.sparkSession.createDataFrame([(n, i) for i, n in enumerate(largest)], "_name string, _group int")
    return named.join(F.broadcast(places), "_name", "left").withColumn("_group", F.coalesce("_group", F.lit(groups))).drop("_name")


def pack_pieces(pieces: DataFrame, capacity: int = 1024, lanes: int = 64, id_col: str = "doc_id", by: str | None = None,
                groups: int = 200) -> DataFrame:
    """``pieces`` (a stored table) with sequence_id and offset.  A sequence holds pieces of one value of
    ``by`` only; pieces without a value, and those of further values than the ``groups`` largest, share theirs."""
    dealt = _with_group(pieces, by, groups).withColumn("_lane", F.pmod(F.xxhash64(quoted(id_col), "start"), F.lit(lanes)).cast("int"))
    kind = ["_group", "length"]
    counts = dealt.groupBy(*kind, "_lane").agg(F.count(F.lit(1)).alias("_n"))  # groups x classes x lanes rows
    found = counts.groupBy(*kind).agg(F.sum("_n").alias("n")).collect()        # groups x classes
    runs = pieces.sparkSession.createDataFrame(
        grouped_bins({(r["_group"], r["length"]): r["n"] for r in found}, capacity),
        "_group int, length long, _first long, _sequence long, _per long")
    before = Window.partitionBy(*kind).orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*kind, "_lane", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*kind, "_lane").orderBy(quoted(id_col), "start", "ids_crc32")
    after = Window.partitionBy(*kind).orderBy("_first")
    placed = (
        dealt.withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), [*kind, "_lane"])
        .withColumn("_piece", F.col("_start") + F.col("_place"))
    )
    ranged = runs.withColumn("_next", F.coalesce(F.lead("_first").over(after), F.lit(2**62)))
    joined = placed.join(F.broadcast(ranged), kind).where("_piece >= _first AND _piece < _next")
    return joined.select(
        *[quoted(c) for c in pieces.columns],
        F.expr("_sequence + (_piece - _first) div _per").alias("sequence_id"),
        F.expr("(_piece - _first) % _per * length").alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False, by: str | None = None) -> DataFrame:
    """Every piece of every document with its place: (id, start, length, ids_crc32, doc_tokens,
    [ids,] [``by``,] sequence_id, offset).  With ``by`` a sequence holds documents of one value of that
    column only (see :func:`pack_pieces`).

    A null or empty text is the end id alone; repeated rows are packed as often as they come; a
    null id is packed like any other; other columns are not read; an empty table gives no rows.
    ``capacity`` is a power of two."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    carry = () if by is None else (by,)
    pieces, _ = materialise(cut_documents(docs, vocabulary, pattern, capacity, end_id, id_col, text_col, with_ids, carry), "pieces")
    return pack_pieces(pieces, capacity, id_col=id_col, by=by)


def op10_harmonic_packing(spark, sf_dir):
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.PATTERN)
