"""Token counts of documents by overlap resynchronisation.

A document longer than a chunk is encoded by the library in overlapping chunks, each giving the ids
of its tokens and their offsets in the document.  Two neighbouring chunks are spliced at the first
place of their overlap that is a proven stable boundary of both:

* a token starts there in either encoding, and white space stands before it: the vocabulary's
  splitter drops white space and never matches across it, and its normaliser maps white space to
  white space and composes nothing with it, so the tokens on either side are those of the whole text;
* from there on, the next ``agree`` tokens have the same offsets and ids in both, so neither the cut
  at the end of the one chunk nor the one at the start of the other has reached it.

Tokens before the place are counted from the first chunk, the others from the second.  Where an
overlap holds no such place (a very long word), it is widened, and where it fills the chunk the
chunk is made longer, up to the whole text.  A document that fits a chunk needs no splice: its words
are counted from a bounded memory of what the library made of them.

Special strings inside texts are handled as the library does by default.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.arrow_map import map_rows
from telemetry_spark.llm.common import quoted, table
from telemetry_spark.llm.units import WORDS, Units


SPACE = " \t\n\x0b\x0c\r"


class TokenCounter:
    def __init__(self, vocabulary: str, chunk: int = 16_384, overlap: int = 128, agree: int = 8):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.units = Units(lambda new: [len(e.ids) for e in self.library.encode_batch_fast(new, add_special_tokens=False)])
        self.chunk, self.overlap, self.agree = chunk, overlap, agree
        self.widened = self.lengthened = 0      # how often an alignment failed

    def encode_chunk(self, text: str, start: int, end: int) -> np.ndarray:
        """(start, end, id) of the tokens of text[start:end], offsets in the whole text."""
        found = self.library.encode(text[start:end], add_special_tokens=False)
        out = np.empty((len(found.ids), 3), np.int64)
        if len(out):
            out[:, :2] = found.offsets
            out[:, :2] += start
            out[:, 2] = found.ids
        return out

    def splice(self, text: str, first: np.ndarray, second: np.ndarray, since: int) -> int | None:
        """The first stable boundary of both encodings after ``since``."""
        common = np.intersect1d(first[:, 0], second[:, 0])
        for place in common[common > since].tolist():
            if text[place - 1] not in SPACE:
                continue
            a, b = np.searchsorted(first[:, 0], place), np.searchsorted(second[:, 0], place)
            run = min(self.agree, len(first) - a, len(second) - b)
            if (first[a:a + run] == second[b:b + run]).all():
                return place
        return None

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return sum(self.units.values_of(WORDS.findall(text)))
        total, begin, end = 0, 0, self.chunk     # tokens that start before ``begin`` are counted
        tokens = self.encode_chunk(text, begin, end)
        while end < len(text):
            overlap, place = self.overlap, None
            while place is None and end - overlap > begin:
                since, until = end - overlap, min(len(text), end + self.chunk)
                later = self.encode_chunk(text, since, until)
                place = self.splice(text, tokens, later, since)
                overlap *= 2
                self.widened += place is None
            if place is None:
                self.lengthened += 1
                end = min(len(text), 2 * end - begin)
                tokens = self.encode_chunk(text, begin, end)
                continue
            total += int((tokens[:, 0] < place).sum())
            tokens, begin, end = later[later[:, 0] >= place], place, until
        return total + len(tokens)


@lru_cache(maxsize=2)
def _counter(vocabulary: str, chunk: int, overlap: int) -> TokenCounter:
    return TokenCounter(vocabulary, chunk, overlap)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = 16_384, overlap: int = 128) -> DataFrame:
    """(id, n_bytes, n_tokens) for every row.

    ``vocabulary`` is a tokenizer file that every executor can open.  A null or empty text has
    no tokens; texts may be of any length; a null id stays null; repeated rows stay repeated; other
    columns are not read; an empty table gives no rows.  Memory is bounded by one batch of texts,
    what the library makes of a chunk (of a longer stretch only where white space is that rare) and
    the remembered units."""
    kind = docs.select(quoted(id_col)).schema[0].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def rows(counter, keys, texts):
        for key, text in zip(keys, texts):
            text = text or ""
            yield key, len(text.encode()), counter.count(text)

    return map_rows(docs.select(quoted(id_col), quoted(text_col).cast("string")), rows, schema,
                    setup=lambda: _counter(vocabulary, chunk, overlap))


def op5_token_counts(spark, sf_dir, limit=2048):
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
