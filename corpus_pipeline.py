"""From documents to packed training sequences, in stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of documents:

1. language_id: drops documents without a letter, and of the unlabelled ones those whose evidence
   favours no language; fills in the language of unlabelled ones, and where the evidence is decisive
   for another of the learned languages it takes the place of the label;
2. exact_dedup: of texts equal but for white space one stays;
3. near_dedup: of linked documents (five-word shingles, 0.8) the one with the smallest id stays;
4. pii: personal data is replaced by its kind;
5. packing: what is left as pieces of full sequences, each of documents of one language (as the
   first stage left it; the 200 largest, the others and rows without one share theirs).

The duplicate stages choose rows, not ids: of rows repeated with their id one stays, rows that share
an id with different texts are documents each by itself, and so is a row without an id (of equal
texts it stays if its original is the longest, of linked ones if none has an id).  A null text has no
letter and goes at the first stage; empty tables pass through every stage; extra columns stay as they
are.  Texts may be of any length and are read whole.  Among equal texts the longest original stays,
then the smallest id.  Of languages that score alike the first in order is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.llm import exact_dedup as exact
from telemetry_spark.llm import langid, near_dedup, packing, pii
from telemetry_spark.llm.common import free_name, materialise, quoted, table

EDGE = 1.05    # times the share that evidence for no language in particular would give
DECISIVE = 0.75    # the share from which it outweighs the label


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = docs.columns
    renamed = {c: free_name(docs, f"_{c}") for c in (langid.LANG, langid.SCORE) if c in columns}
    model = langid.fit(docs.where(~F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False))))
    rows = docs.withColumnsRenamed(renamed)
    found = langid.identify(rows, model, keep=tuple(rows.columns))
    least = min(1.0, EDGE / max(1, len(model.langs)))
    favoured = (F.col(langid.LANG) != langid.UNKNOWN) & (F.col(langid.SCORE) >= least)
    kept = found.where(favoured | F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    decisive = favoured & (F.col(langid.SCORE) >= DECISIVE) & F.col("lang").isin(model.langs)
    filled = kept.withColumn("lang", F.when(F.col("lang").isNull() | decisive, F.col(langid.LANG)).otherwise(F.col("lang")))
    return filled.select(*[quoted(renamed.get(c, c)).alias(c) for c in columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.surviving_rows(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.surviving_rows(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, by="lang")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup_stage),
    ("pii", personal_data),
    ("packing", pack),
]

# Scoring, minima, spans and tokens are beyond SQL; tests/llm checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
