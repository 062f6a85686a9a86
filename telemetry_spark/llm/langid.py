"""Language identification by word-first backoff.

A known word scores the log of its relative frequency in each language.  An unseen word falls
back to character n-grams, from the longest to the shortest: at each place of the padded word the
longest known n-gram counts, each step down costing a fixed penalty, and a character no language
has seen counts alike for all.  The language with the highest sum wins; the score is its share
of the probability when the mean evidence a word, not the sum, is compared, so that a long text
does not turn a slight lead into certainty.

The model is fitted on a documented, bounded sample of each language: the rows whose hash is
smallest, all of a language with at most ``lang_docs`` rows and about as many or more of any
other; as long as ``train_docs`` rows in all allow it, smaller languages come whole and the
others share what is left evenly.  So a language is learned however large the table is.  Counting
runs in Spark; what is kept, and broadcast, is at most ``words`` words and ``ngrams`` n-grams a
language and ``keys`` of both in all, the most frequent ones, of equally frequent ones those whose
hash is smallest.  Of more than ``languages`` labels the most frequent are learned.  The model holds
(key, language, log frequency) only where a language has the key, and one floor a language for all
others, so it grows with what was seen and not with languages times keys.  Every word of every text
is scored.

A word is a letter and the letters and marks that follow it, in the fit and in the prediction;
numerals are no letters.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.arrow_map import map_rows
from telemetry_spark.llm.common import free_name, materialise, quoted, table



def _ranges(*kinds: str) -> str:
    """A character class body of the code points whose general category starts with a kind."""
    marked = [unicodedata.category(chr(c))[0] in kinds for c in range(sys.maxunicode + 1)] + [False]
    edges = [c for c in range(sys.maxunicode + 2) if marked[c] != (c > 0 and marked[c - 1])]
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


WORD = re.compile(f"[{_ranges('L')}][{_ranges('L', 'M')}]*")
WORD_SQL = r"\p{L}[\p{L}\p{M}]*"
ORDERS = (5, 4, 3, 2, 1)
BACKOFF = math.log(0.4)
UNKNOWN = "und"
REMEMBERED = 30_000
BUCKETS = 4096
PIECE = 64      # letters of a word whose n-grams are cut out at once
PLACES = 2**40
LANG, SCORE = "lang_pred", "score"


class Model:
    """Log frequencies by row and language: first the known words, then the n-grams with the penalty
    of their length.  ``words`` and ``ngrams`` are (key, language, count), sorted.  A row holds what
    its languages have above the floor of their kind (word or n-gram)."""

    def __init__(self, words: Iterable[tuple[str, str, int]], ngrams: Iterable[tuple[str, str, int]], langs: list[str],
                 smooth: float = 0.1):
        self.langs = langs
        self.floors = np.zeros((2, len(langs)))
        place = {lang: i for i, lang in enumerate(langs)}
        of, counts, ends, rows = array("i"), array("d"), array("q"), []
        for kind, entries in enumerate((words, ngrams)):
            known: dict[str, int] = {}
            begin, first = len(of), len(ends)
            for key, lang, n in entries:
                if key not in known:
                    known[key] = first + len(known)
                    ends.append(len(of))
                of.append(place[lang])
                counts.append(n)
            totals = np.bincount(np.array(of[begin:], int), np.array(counts[begin:]), minlength=len(langs))
            if known:
                self.floors[kind] = math.log(smooth) - np.log(totals + smooth * len(known))
            rows.append(known)
        ends.append(len(of))
        self.word_row, self.gram_row = rows
        self.ends, self.of, self.above = np.array(ends), np.array(of, np.int32), np.log1p(np.array(counts) / smooth)
        self.penalty = np.array([0.0] * len(self.word_row) + [(ORDERS[0] - len(g)) * BACKOFF for g in self.gram_row])
        self.seen: dict[str, tuple[int, ...]] = {}

    def evidence(self, rows: list[int], weights: list[float]) -> np.ndarray:
        """The weighted sum of rows, by language."""
        at, weight = np.array(rows), np.array(weights)
        first, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        entries = np.repeat(first, sizes) + steps
        found = np.bincount(self.of[entries], self.above[entries] * np.repeat(weight, sizes), minlength=len(self.langs))
        of_words = weight[at < len(self.word_row)].sum()
        return found + of_words * self.floors[0] + (weight.sum() - of_words) * self.floors[1] + weight @ self.penalty[at]

    def backed_off(self, word: str) -> tuple[int, ...]:
        """The row of the longest known n-gram at each place of an unseen word."""
        found = self.seen.get(word)
        if found is None:
            padded, rows, get = f"^{word}$", [], self.gram_row.get
            for at in range(len(padded) - 1):
                for n in ORDERS:
                    if (row := get(padded[at:at + n])) is not None:
                        rows.append(row)
                        break
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            found = tuple(rows)
            if len(word) <= 40:
                self.seen[word] = found
        return found

    def predict(self, text: str) -> tuple[str, float]:
        counts = Counter(WORD.findall(text.lower()))
        if not counts or not self.langs:
            return UNKNOWN, 0.0
        rows, weights = [], []
        for word, n in counts.items():
            row = self.word_row.get(word)
            if row is not None:
                rows.append(row)
                weights.append(n)
            elif grams := self.backed_off(word):
                rows += grams
                weights += [n / len(grams)] * len(grams)
        mean = self.evidence(rows, weights) / counts.total() if rows else np.zeros(len(self.langs))
        share = np.exp(mean - mean.max())
        best = int(share.argmax())
        return self.langs[best], float(share[best] / share.sum())


def _frequent(pairs: DataFrame, limit: int) -> list[tuple[str, str, int]]:
    """The most frequent keys of each language, at most ``limit``: those above a least count and,
    of the keys that come just so often, as many as there is room for, by their hash.  Histograms
    of the counts and of the hashes give the bounds, so no language is ever sorted in one task."""
    counted, _ = materialise(pairs.groupBy("lang", "key").agg(F.sum("n").alias("n")), "counted")
    histogram = counted.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("keys")).collect()
    tied: dict[str, tuple[int, int]] = {}       # the count at which the limit is crossed, and the room there
    least: dict[str, int] = {}
    by_lang: dict[str, list[tuple[int, int]]] = {}
    for r in histogram:
        by_lang.setdefault(r["lang"], []).append((r["n"], r["keys"]))
    for lang, counts in by_lang.items():
        room = limit
        for n, keys in sorted(counts, reverse=True):
            if keys > room:
                tied[lang] = n, room
                break
            room -= keys
            least[lang] = n
    spark = counted.sparkSession
    found = _above(counted, least)
    crossing = {lang: n for lang, (n, room) in tied.items() if room}
    if crossing:
        bounds = spark.createDataFrame(list(crossing.items()), "lang string, tie long")
        ties = counted.join(F.broadcast(bounds), "lang").where("n = tie").select(
            "lang", "key", "n", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).alias("bucket"))
        last: dict[str, int] = {}
        room = {lang: tied[lang][1] for lang in crossing}
        for r in sorted(ties.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("keys")).collect()):
            if room[r["lang"]] > 0:
                last[r["lang"]] = r["bucket"]
                room[r["lang"]] -= r["keys"]
        ends = spark.createDataFrame(list(last.items()), "lang string, last long")
        inside: dict[str, list[tuple[int, str, int]]] = {}
        for r in ties.join(F.broadcast(ends), "lang").where("bucket <= last").collect():    # the room and a bucket at most
            inside.setdefault(r["lang"], []).append((r["bucket"], r["key"], r["n"]))
        found += [(key, lang, n) for lang, keys in inside.items() for _, key, n in sorted(keys)[:tied[lang][1]]]
    return sorted(found)


def _above(counted: DataFrame, least: dict[str, int]) -> list[tuple[str, str, int]]:
    if not least:
        return []
    bounds = counted.sparkSession.createDataFrame(list(least.items()), "lang string, least long")
    chosen = counted.join(F.broadcast(bounds), "lang").where("n >= least")
    return [(r["key"], r["lang"], r["n"]) for r in chosen.select("key", "lang", "n").collect()]


def _rows_each(counts: list[int], total: int, least: int) -> int:
    """The largest number of rows a language that leaves about ``total`` rows, but at least ``least``."""
    left = total
    for k, n in enumerate(sorted(counts)):
        if n * (len(counts) - k) > left:
            return max(least, left // (len(counts) - k))
        left -= n
    return max([least, *counts])


def word_grams(by_word: DataFrame) -> DataFrame:
    """(lang, n, key): the n-grams of the padded words, weighted by how often the words come.  Words
    of any length are cut in pieces that overlap by what an n-gram reaches over, so that no row holds
    more than a piece's n-grams."""
    padded = by_word.select("lang", "n", F.concat(F.lit("^"), "key", F.lit("$")).alias("padded"))
    pieces = padded.select("lang", "n", "padded", F.explode(F.expr(f"sequence(1, length(padded), {PIECE})")).alias("at")).select(
        "lang", "n", F.expr(f"substring(padded, at, {PIECE + ORDERS[0] - 1})").alias("piece"))
    cuts = [F.expr(f"transform(if(length(piece) >= {k}, sequence(1, least({PIECE}, length(piece) - {k - 1})), array()),"
                   f" i -> substring(piece, i, {k}))") for k in ORDERS]
    return pieces.select("lang", "n", F.explode(F.concat(*cuts)).alias("key"))


def fit(train: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", train_docs: int = 8_000,
        words: int = 30_000, ngrams: int = 30_000, lang_docs: int = 1_000, languages: int = 1_000, keys: int = 2_000_000) -> Model:
    """A model of the rows of ``train`` with a language and a text.

    Rows without either teach nothing; an empty text none; repeated rows count each; of equally
    frequent labels at the limit the first by name are learned; an empty table gives a model that
    knows no language."""
    rows = train.select(quoted(id_col).alias("id"), quoted(lang_col).cast("string").alias("lang"),
                        quoted(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    labels = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["lang"]: r["n"] for r in labels.orderBy(F.desc("n"), "lang").limit(languages).collect()}
    each = _rows_each(list(counts.values()), train_docs, lang_docs)
    bounds = rows.sparkSession.createDataFrame(
        [(lang, each * PLACES // n if n > each else PLACES) for lang, n in counts.items()], "lang string, bound long")
    # the text tells rows apart whose id is null or repeats
    place = F.pmod(F.xxhash64("id", "text", F.lit(7)), F.lit(PLACES))
    sample = rows.join(F.broadcast(bounds), "lang").where(place <= F.col("bound"))     # ``languages`` rows at most
    spoken = sample.select("lang", F.explode(F.expr(f"regexp_extract_all(lower(text), '{WORD_SQL}', 0)".replace("\\", "\\\\"))).alias("key"))
    by_word, _ = materialise(spoken.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")), "words")
    room = max(1, keys // (2 * max(1, len(counts))))
    kept_words = _frequent(by_word, min(words, room))
    kept_grams = _frequent(word_grams(by_word), min(ngrams, room))
    langs = sorted({lang for _, lang, _ in kept_words})
    return Model(kept_words, kept_grams, langs)


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(columns of ``keep``, lang_pred, score) for every row; ``keep`` must not hold these names.

    ``und`` with score 0 if the text is null or has no letter, or the model knows no language.  Of
    equally likely languages the first by name is taken; texts and words may be of any length; a
    null id stays null; repeated rows stay repeated; other columns are not read; an empty table gives
    no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = text_col not in keep      # else the text comes once, in its place among the kept columns
    source = docs.select(*[quoted(c) for c in keep], *([quoted(text_col).alias(free_name(docs, "_text"))] if own else []))
    at = len(keep) if own else list(keep).index(text_col)
    schema = T.StructType([*source.schema[:len(keep)], T.StructField(LANG, T.StringType()), T.StructField(SCORE, T.DoubleType())])

    def rows(model, *columns):
        for row in zip(*columns):
            yield (*row[:len(keep)], *model.predict(row[at] or ""))

    return map_rows(source, rows, schema, setup=lambda: shared.value)


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 4 == 2


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
