"""Every contract column of registered queries against plain Python, and the pipeline's stages likewise."""

import hashlib
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF_SMALL
from test_codecs import naive_spans
from tokenizers import Tokenizer

from telemetry_spark.llm import pii
from telemetry_spark.llm.bpe import file_ranks
from telemetry_spark.llm.queries import QUERIES

RANKS, WORD_FILE, BYTE_FILE = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
BASE = ("email", "ip", "card", "phone")


@pytest.fixture(scope="module")
def texts(spark):
    """[(doc_id, text or "")] in order."""
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"] or "") for r in rows)


def result(spark, name, *columns):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF_SMALL).select(*columns).collect())


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op1(spark, texts):
    whole = tiktoken.Encoding("w", pat_str=P.PATTERN, mergeable_ranks=file_ranks(RANKS), special_tokens={})
    want = []
    for i, text in texts:
        ids = whole.encode_ordinary(text)
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(text)))
    assert result(spark, "op1_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op3(spark, texts):
    found = result(spark, "op3_personal_data", "doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans")
    want, some = [], 0
    for i, text in texts:
        spans = naive_spans(text)
        some += len(spans)
        want.append((i, *[sum(s[0] == k for s in spans) for k in BASE], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    assert [r[:-1] for r in found] == want and some
    for (i, text), row in zip(texts, found):
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in row[-1].split(",") if s)]
        base = [s for s in spans if s[0] in BASE]
        assert base == naive_spans(text) and spans[:len(base)] == base
        for kind, a, b in spans[len(base):]:
            assert all(b <= start or end <= a for _, start, end in base) and 0 <= a < b <= len(text)


def test_op5(spark, texts):
    library = Tokenizer.from_file(WORD_FILE)
    library.no_truncation(), library.no_padding()
    want = [(i, len(t.encode()), n, n > 2048) for i, t in texts for n in [len(library.encode(t, add_special_tokens=False).ids)]]
    assert result(spark, "op5_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def shards_needed(sizes, capacity):
    """Shards that a greedy walk opens; a group above the capacity stands alone."""
    used, held = 0, None
    for size in sizes:
        if held is None or held + size > capacity:
            used, held = used + 1, 0
        held += size
    return used


def test_op8(spark, texts):
    columns = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    found = result(spark, "op8_minimax_shards", *columns)
    assert [r[:4] for r in found] == [(i, len(t.encode()) + 8, zlib.crc32(t.encode()), "bytes") for i, t in texts]
    slots, held, shard_of, sizes = {}, {}, {}, {}
    for (_, text), (_, size, _, _, shard, slot, grown) in zip(texts, found):
        slots.setdefault(shard, []).append(slot)
        held[shard] = held.get(shard, 0) + size
        assert shard_of.setdefault(text, shard) == shard and grown is None
        sizes[sha(text)] = sizes.get(sha(text), 0) + size
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [sizes[k] for k in sorted(sizes)]
    largest = max(held.values())
    assert shards_needed(order, largest) <= 24
    assert largest == max(order) or shards_needed(order, largest - 1) > 24


def check_packing(pieces, texts, capacity=1024):
    library = Tokenizer.from_file(BYTE_FILE)
    by_doc, by_sequence, padding = {}, {}, 0
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == {i for i, _ in texts}
    for i, text in texts:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding <= 0.02 * sum(r["length"] for r in pieces)


def test_op10(spark, texts):
    check_packing(QUERIES["op10_harmonic_packing"](spark, SF_SMALL).collect(), texts)


def redacted(text, spans):
    """Of overlapping spans the one that starts first (then the longest) names what is replaced."""
    out, at = "", 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out, at = out + text[at:a] + f"<{kind.upper()}>", b
    return out + text[at:]


def test_pii_and_packing_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["pii"](spark, docs, SF_SMALL).cache()
    before, after = ({r["doc_id"]: r for r in d.collect()} for d in (docs, clean))
    assert before.keys() == after.keys()
    plain = changed = 0
    for i, row in before.items():
        assert {k: v for k, v in row.asDict().items() if k != "text"} == {k: v for k, v in after[i].asDict().items() if k != "text"}
        spans = naive_spans(row["text"] or "")
        if row["text"] is None or any(s[0] not in pii.BASE for s in pii.find_spans(row["text"])):
            continue
        if all(a[2] <= b[1] or b[2] <= a[1] for a in spans for b in spans if a is not b):     # apart
            plain, changed = plain + 1, changed + bool(spans)
            assert after[i]["text"] == redacted(row["text"], spans)
    assert plain > 0.8 * len(before) and changed
    check_packing(stages["packing"](spark, clean, SF_SMALL).collect(), [(i, r["text"] or "") for i, r in after.items()])


def test_batches_of_very_long_texts_are_bounded_by_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    long = spark.range(0, 200, 1, 1).selectExpr("id as doc_id", "repeat('ab c', 500000) as text")
    seen = long.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in seen) == 200 and max(r["bytes"] for r in seen) <= 80_000_000
    assert pii.personal_data(long).where("size(spans) = 0").count() == 200
