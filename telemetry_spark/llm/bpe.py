"""Byte-level BPE by monoid tree reduction.

A text is halved until a piece has at most ``leaf_chars`` characters; leaves are encoded by
themselves and neighbours are joined on the way up.  A join re-encodes a window around the
seam, which grows until both its ends are *stable* positions, at which every scan of the
splitting pattern has a boundary whatever stands further left or right:

* between a character that is not white space and an ASCII white-space character: every
  alternative of the pattern that can hold the first one ends before white space;
* between a letter and ASCII or ideographic punctuation: letters are only followed by
  letters inside a match.

The merges run inside single matches, so tokens left of the window's start and right of its
end are those of the whole text.  If a half has no stable position the window takes it
whole, which is right at any length (then a level of the tree encodes that half again).

Decoding concatenates byte strings up the same kind of tree.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.arrow_map import map_rows
from telemetry_spark.llm.common import quoted, table

# Fixed sets: letters and marks whose classes no Unicode version has changed.
LETTER = "A-Za-zÀ-ÖØ-öø-ʯЀ-ҁぁ-ゖァ-ヺ一-龥가-힣"
MARK = "!-&(-/:-@\\[-`{-~、。！，？"
STABLE = re.compile(rf"\S(?=[ \t-\r])|[{LETTER}](?=[{MARK}])")
WINDOW = 32


def file_ranks(vocabulary: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: base64 pieces with ranks, or a tokenizer in JSON."""
    if not vocabulary.endswith(".json"):
        with open(vocabulary, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(vocabulary, encoding="utf-8") as text:
        pieces = json.load(text)["model"]["vocab"]
    # these files write bytes as letters: printable ones of Latin-1 as themselves, the others
    # in order from U+0100
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
    return {bytes(map(letters.__getitem__, piece)): rank for piece, rank in pieces.items()}


class TreeBpe:
    def __init__(self, vocabulary: str, pattern: str, leaf_chars: int = 4096):
        import tiktoken

        ranks = file_ranks(vocabulary)
        self.leaf_chars = leaf_chars
        self.leaf = tiktoken.Encoding("leaf", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf_chars:
            return self.leaf(text)
        left, right = text[:len(text) // 2], text[len(text) // 2:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The ids of ``left + right`` from the ids of both."""
        width, start, end = WINDOW, 0, len(right)
        while width < len(left):
            found = [m.end() for m in STABLE.finditer(left, len(left) - width)]
            if found:
                start = found[-1]
                break
            width *= 2
        width = WINDOW
        while width < len(right):
            if first := STABLE.search(right[:width]):
                end = first.end()
                break
            width *= 2
        window = self.leaf(left[start:] + right[:end])
        keep = len(left_ids) - self._covering(reversed(left_ids), left[start:])
        skip = self._covering(right_ids, right[:end])
        return left_ids[:keep] + window + right_ids[skip:]

    def _covering(self, ids, text: str) -> int:
        """How many of ``ids``, from the seam outwards, make up ``text``."""
        want, n = len(text.encode()), 0
        if not want:
            return 0
        for n, i in enumerate(ids, 1):
            want -= len(self.bytes_of[i])
            if want <= 0:
                break
        assert want == 0, "a window ends inside a token"
        return n

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf_chars:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def _codec(vocabulary: str, pattern: str, leaf_chars: int) -> TreeBpe:
    return TreeBpe(vocabulary, pattern, leaf_chars)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     decode: bool = False, leaf_chars: int = 4096) -> DataFrame:
    """(id, ids array<int>) for every row, with ``decoded`` binary if asked for.

    ``vocabulary`` is a file of base64 pieces and ranks that every executor can open.  A null
    text counts as empty and has no ids; repeated rows stay repeated; other columns are not
    read; an empty table gives no rows."""
    kind = docs.select(quoted(id_col)).schema[0].dataType
    fields = [T.StructField(id_col, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decode:
        fields.append(T.StructField("decoded", T.BinaryType()))

    def rows(codec, keys, texts):
        for key, text in zip(keys, texts):
            ids = codec.encode(text or "")
            yield (key, ids, codec.decode(ids)) if decode else (key, ids)

    return map_rows(docs.select(quoted(id_col), quoted(text_col).cast("string")), rows, T.StructType(fields),
                    setup=lambda: _codec(vocabulary, pattern, leaf_chars))


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) for every row of ids; null ids decode to no bytes."""
    kind = encoded.select(quoted(id_col)).schema[0].dataType

    def rows(codec, keys, lists):
        for key, ids in zip(keys, lists):
            yield key, codec.decode(ids or [])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("decoded", T.BinaryType())])
    return map_rows(encoded.select(quoted(id_col), quoted(ids_col)), rows, schema, setup=lambda: _codec(vocabulary, pattern, 4096))


def op1_bpe(spark, sf_dir):
    import public_tokenizers

    coded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                             public_tokenizers.PATTERN, decode=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
