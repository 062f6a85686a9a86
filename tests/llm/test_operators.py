"""Each operator on documents with every odd case, and on none."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from cases import TEXTS, documents, near_components, no_documents, shingle_set
from tokenizers import Tokenizer

from telemetry_spark.llm import bpe, embedding_dedup, exact_dedup, langid, near_dedup, packing, pii, sharding, token_counts, url_filter
from telemetry_spark.llm.components import connected_components

RANKS, WORD_FILE, BYTE_FILE = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
KEY = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))


def pairs(rows):
    return sorted((tuple(r) for r in rows), key=KEY)


def test_bpe(spark):
    whole = tiktoken.Encoding("w", pat_str=P.PATTERN, mergeable_ranks=bpe.file_ranks(RANKS), special_tokens={})
    got = bpe.encode_documents(documents(spark), RANKS, P.PATTERN, decode=True)
    want = [(i, whole.encode_ordinary(t or ""), bytearray((t or "").encode())) for i, t in TEXTS]
    assert pairs(got.collect()) == pairs(want)
    again = bpe.decode_documents(got.select("doc_id", "ids"), RANKS, P.PATTERN)
    assert pairs(again.collect()) == pairs([(w[0], w[2]) for w in want])
    assert bpe.encode_documents(no_documents(spark), RANKS, P.PATTERN).collect() == []


def test_token_counts(spark):
    library = Tokenizer.from_file(WORD_FILE)
    got = token_counts.token_counts(documents(spark), WORD_FILE, chunk=1000, overlap=8)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS]
    assert pairs(got.collect()) == pairs(want)
    assert token_counts.token_counts(no_documents(spark), WORD_FILE).collect() == []


def test_personal_data(spark):
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(documents(spark)).collect()}
    assert [s["kind"] for s in got[21]] == ["email", "ip", "card", "phone"] and got[1] == [] and got[2] == []
    clean = {r["doc_id"]: r for r in pii.redact(documents(spark)).collect()}
    assert clean[21]["text"] == "write to <EMAIL> or <IP> call <PHONE> card <CARD>"
    assert clean[1]["text"] is None and clean[8]["text"] == dict(TEXTS)[8] and clean[8]["shard"] == "clash"
    assert pii.redact(no_documents(spark)).collect() == []


def test_exact_dedup(spark):
    got = exact_dedup.exact_dedup(documents(spark)).collect()
    strip = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(strip(t), []).append((-len(t or ""), i is None, i))
    want = []
    for i, t in TEXTS:
        ids = [g[2] for g in sorted(groups[strip(t)], key=lambda g: (g[0], g[1], g[2] or 0))]
        want.append((i, ids[0], len(ids), i == ids[0], hashlib.sha256(strip(t).encode()).hexdigest()))
    assert pairs(got) == pairs(want)
    assert exact_dedup.exact_dedup(no_documents(spark)).collect() == []


def test_exact_dedup_of_extreme_ids(spark):
    texts = [(-2**63, "a"), (2**63 - 1, "a"), (0, "a b"), (-1, "ab"), (5, "c"), (-5, "c")]
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(documents(spark, texts)).collect()}
    assert got == {-2**63: -2**63, 2**63 - 1: -2**63, 0: 0, -1: 0, 5: -5, -5: -5}


def test_exact_dedup_of_a_longest_text_without_id(spark):
    texts = [(None, "a b"), (5, "ab"), (None, "c"), (6, "c"), (2**63 - 1, "d"), (None, "d"), (7, "e f"), (None, "ef")]
    got = exact_dedup.exact_dedup(documents(spark, texts)).collect()
    assert pairs((r["doc_id"], r["keep_id"], r["kept"]) for r in got) == pairs([
        (None, None, True), (5, None, False), (None, 6, False), (6, 6, True), (2**63 - 1, 2**63 - 1, True),
        (None, 2**63 - 1, False), (7, 7, True), (None, 7, False)])


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, width, percent):
    got = near_dedup.near_duplicates(documents(spark), width=width, threshold=percent).collect()
    want = near_components(TEXTS, width, percent)
    assert len(got) == len(TEXTS)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"]) and r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = {i: len(shingle_set(t, width)) for i, t in TEXTS if i is not None}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert near_dedup.near_duplicates(no_documents(spark)).collect() == []


def test_near_duplicates_of_a_large_group(spark):
    """A group of many blocks, in which some members are linked only through others."""
    draw = np.random.default_rng(2)
    words = [f"v{k}" for k in range(60)]
    texts = []
    for i in range(160):
        own = list(words)
        for at in draw.choice(60, draw.integers(0, 4), replace=False):
            own[at] = f"n{draw.integers(0, 400)}"
        texts.append((1000 - i, " ".join(own)))
    got = near_dedup.near_duplicates(documents(spark, texts), width=3, threshold=85, block=16).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == near_components(texts, 3, 85)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(i, 500) for i in range(501, 560)] + [(7, 7), (90, 80), (90, 80), (100, 90)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b")
    roots = {r["node"]: r["component"] for r in got.collect()}
    assert roots == {**{i: 0 for i in range(1, 61)}, **{i: 500 for i in range(501, 560)}, 90: 80, 100: 80}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_shards(spark):
    got = sharding.shard_documents(documents(spark), shards=4).collect()
    assert pairs((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == pairs(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    shard_of = {}
    for r in got:
        assert shard_of.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
    assert sharding.shard_documents(no_documents(spark)).collect() == []


def test_slots_are_gapless_in_many_lanes(spark):
    texts = [(i % 700, f"text {i % 90}" if i % 3 else "hot") for i in range(1500)]
    found = sharding.shard_documents(documents(spark, texts), shards=3, lane_rows=2).collect()
    for s in range(3):
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len(found) == 1500


def test_shards_are_the_smallest_possible(spark):
    from telemetry_spark.llm.sharding import Prefix, smallest_capacity

    draw = np.random.default_rng(4)
    texts = [(int(i), "t" * int(n)) for i, n in enumerate(draw.integers(0, 400, 300))] + [(1000 + i, "hot" * 50) for i in range(40)]
    got = sharding.shard_documents(documents(spark, texts), shards=5).collect()
    sizes = {}
    for _, t in texts:
        key = hashlib.sha256(t.encode()).hexdigest()
        sizes[key] = sizes.get(key, 0) + len(t) + 8
    best = smallest_capacity([Prefix(k, n, True) for k, n in sorted(sizes.items())], 5, divisible=False)
    held = {}
    for r in got:
        held[r["shard"]] = held.get(r["shard"], 0) + r["size"]
    assert max(held.values()) == max(best, max(sizes.values()))


@pytest.mark.parametrize("hot", [0, 0.04, 0.3, 0.5, 0.99])
def test_cuts_beside_a_hot_group_take_few_rows(spark, hot, monkeypatch):
    from telemetry_spark.llm.sharding import Prefix, greedy_cuts, smallest_capacity

    n, shards = 60_000, 4
    heavy = int(n * 50 * hot / (1 - hot))
    frame = spark.range(n).selectExpr("sha2(cast(id as string), 256) as digest", "30 + id % 41 as size")
    if hot:
        frame = frame.unionByName(spark.range(100).selectExpr("sha2('hot', 256) as digest", f"cast({heavy // 100} as long) as size"))
    collected, summed = [], sharding._summed
    monkeypatch.setattr(sharding, "_summed", lambda *a: collected.append(summed(*a)) or collected[-1])
    cuts = sharding.find_cuts(frame, shards)
    assert max(map(len, collected)) <= shards * 4096
    groups = [Prefix(r["digest"], r["size"], True) for r in frame.groupBy("digest").agg({"size": "sum"})
              .toDF("digest", "size").orderBy("digest").collect()]
    best = smallest_capacity(groups, shards, divisible=False)
    held = {}
    for g in groups:
        k = sum(c <= g.key for c in cuts)
        held.setdefault(k, []).append(g.size)
    assert len(held) <= shards and len(greedy_cuts(groups, best, False)) < shards
    assert all(sum(h) <= best or len(h) == 1 for h in held.values())


def test_packing(spark):
    library = Tokenizer.from_file(BYTE_FILE)
    got = packing.pack_documents(documents(spark), BYTE_FILE, P.PATTERN, capacity=64, with_ids=True).collect()
    ids = sorted([*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in TEXTS)
    # pieces of documents whose id repeats can't be told apart; the others are put together again
    single = [i for i, _ in TEXTS if [j for j, _ in TEXTS].count(i) == 1]
    for i in single:
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        text = next(t for j, t in TEXTS if j == i)
        whole = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert b"".join(bytes(r["ids"]) for r in own) == whole
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert all(r["doc_tokens"] == len(whole) // 4 and r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) for r in own)
    assert sum(r["length"] for r in got) == sum(map(len, ids))
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0   # nothing is padded
    assert packing.pack_documents(no_documents(spark), BYTE_FILE, P.PATTERN).collect() == []


def test_language_id(spark):
    texts = [(i, t) for i, t in enumerate(["the house and the garden of the king", "der garten und das haus des königs",
                                           "la maison et le jardin du roi"] * 4)]
    train = documents(spark, texts).drop("lang").withColumn("lang", __import__("pyspark.sql.functions", fromlist=["x"]).expr(
        "element_at(array('en', 'de', 'fr'), cast(doc_id % 3 as int) + 1)"))
    model = langid.fit(train)
    assert model.langs == ["de", "en", "fr"]
    odd = documents(spark, [*TEXTS, (50, "THE GARDEN"), (51, "gärten häuser"), (52, "jardins maisons")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd.drop("lang_pred", "score"), model).collect()}
    assert got[1] == got[2] == got[17] == ("und", 0.0)
    assert [got[i][0] for i in (50, 51, 52)] == ["en", "de", "fr"]
    assert all(0 <= s <= 1 for _, s in got.values())
    empty = langid.fit(no_documents(spark))
    assert {r["lang_pred"] for r in langid.identify(documents(spark), empty).collect()} == {"und"}
    assert langid.identify(no_documents(spark), model).collect() == []


def test_rare_languages_of_a_large_table_are_learned(spark):
    en, el = "the house and the garden of the king number", "το σπίτι και ο κήπος του βασιλιά"
    texts = [(i, f"{en} w{i}") for i in range(2_500)] + [(3_000 + i, el) for i in range(3)]
    train = documents(spark, texts).drop("lang").selectExpr("*", "if(doc_id < 3000, 'en', 'el') as lang")
    model = langid.fit(train, train_docs=20)
    assert model.langs == ["el", "en"]
    got = langid.identify(documents(spark, [(1, "ο κήπος"), (2, "the garden")]).drop("lang_pred", "score"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "el", 2: "en"}


def test_languages_share_the_sample():
    assert langid._rows_each([10, 10, 10], 30, 5) == 10 and langid._rows_each([100, 10, 3], 33, 5) == 20
    assert langid._rows_each([100, 100, 3], 33, 5) == 15 and langid._rows_each([100] * 10, 33, 5) == 5
    assert langid._rows_each([], 33, 5) == 5


def test_frequent_keys_fill_the_limit(spark):
    pairs = spark.createDataFrame([("a", "top", 5)] + [("a", f"k{i}", 1) for i in range(50)]
                                  + [("b", f"k{i}", 2) for i in range(4)], "lang string, key string, n long")
    got = langid._frequent(pairs, 10)
    assert sorted(lang for _, lang, _ in got) == ["a"] * 10 + ["b"] * 4 and ("top", "a", 5) in got
    assert got == langid._frequent(pairs.repartition(5), 10)
    assert len(langid._frequent(pairs, 1)) == 2


def brute_links(rows, cosine):
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = {k: [j for j in good if j != k and k in good and rows[j][2] == rows[k][2] and len(good[j]) == len(good[k])
                 and good[j] @ good[k] >= cosine] for k in range(len(rows))}
    return links


def test_embeddings(spark):
    draw = np.random.default_rng(7)
    rows = []
    for g in range(12):
        centre = draw.normal(size=8)
        for _ in range(9):
            rows.append((len(rows), (centre + draw.normal(size=8) * 0.12).astype(np.float32).tolist(), g % 3))
    rows += [(200 + k, rows[0][1], rows[0][2]) for k in range(30)]
    rows += [(300, None, 1), (301, [0.0] * 8, 1), (302, [float("nan")] + [1.0] * 7, 1), (303, [None] + [1.0] * 7, 1),
             (304, rows[0][1], None), (305, [1.0, 2.0], 1), (306, [2.0, 4.0], 1), (307, [float("inf")] * 8, 1), (308, [], 1),
             (309, [1e-38] * 8, 2), (310, [3e38] * 8, 2)]
    schema = "vec_id long, embedding array<float>, label int, id string, vector string, cell string, weight string"
    frame = spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], schema)
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_links(frame, residents=4, block=8).collect()}
    links = brute_links(rows, 0.98)
    assert {i: r["n_links"] for i, r in got.items()} == {rows[k][0]: len(v) for k, v in links.items()}
    from cases import components

    want = components([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, bs in links.items() for b in bs])
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert embedding_dedup.embedding_links(frame.where("false")).collect() == []


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG", "http://a.example.org/", "http://x.example.org/es/1",
            "http://x.example.org/en/12?q=://z", "https://com/fr/x#y", "http://b.com/de/5", "http://b.com/de", "://h/p://q",
            "http://fakeorg/a", "http://b.com/en/5", "http://\nx.org/a\nb"]
    frame = spark.createDataFrame([(i, u, "c", "c", "c") for i, u in enumerate(urls * 2)],
                                  "page_id long, url string, host string, n string, template string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(frame).collect()}
    assert len(got) == 2 * len(urls)
    told = [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))]
    assert told == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.org", "", None, "allow"),
        ("a.example.org", "/", "org/", "allow"), ("x.example.org", "/es/1", "example.org/es/", "block"),
        ("x.example.org", "/en/12", "example.org/en/1", "block"), ("com", "/fr/x", "com/fr/", "allow"),
        ("b.com", "/de/5", "com/de/", "block"), ("b.com", "/de", None, "allow"), ("h", "/p://q", None, "allow"),
        ("fakeorg", "/a", None, "allow"), ("b.com", "/en/5", None, "allow"), ("\nx.org", "/a\nb", "org/", "allow")]
    assert url_filter.judge_urls(frame.where("false")).collect() == []


def test_url_templates(spark):
    """Unlabelled pages of a branch whose labelled ones are blocked go; slugs become wildcards."""
    rules = (("block", "h.net/spam/a"), ("allow", "h.net/news/a"))
    urls = [f"http://h.net/spam/a{c}-{d}" for c in "bcdefghijk" for d in "pqrst"] + [f"http://h.net/spam/z{c}" for c in "bcdefghijk"]
    urls += [u.replace("/spam/", "/news/") for u in urls]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge_urls(frame, rules).collect()
    assert {r["template"] for r in got} == {"/spam/*", "/news/*"}
    assert all(r["verdict"] == ("block" if "/spam/" in r["path"] else "allow") for r in got)


def near(spark, texts, **options):
    got = near_dedup.near_duplicates(documents(spark, texts), width=3, threshold=85, **options).collect()
    assert len(got) == len(texts)
    return got


def test_near_duplicates_of_repeated_ids_with_other_texts(spark):
    words = [f"w{i}" for i in range(60)]
    v = [f"v{i}" for i in range(60)]
    w, w2, u, u2 = " ".join(words), " ".join(words[:-1] + ["end"]), " ".join(v), " ".join(v[:-1] + ["end"])
    got = near(spark, [(1, w), (2, w2), (2, u), (3, u2), (4, "alone " + " ".join(words[::-1]))])
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]
    # without an id: the component of what the text is linked with, which need not have one
    got = near(spark, [(None, w), (5, w2), (None, u), (None, u2), (None, ""), (7, "a b"), (7, "a b"), (7, None)])
    assert pairs((r["doc_id"], r["component_id"], r["kept"]) for r in got) == pairs(
        [(None, 5, False), (5, 5, True), (None, None, True), (None, None, True), (None, None, True), (7, 7, True), (7, 7, True), (7, 7, True)])


@pytest.mark.parametrize("options", [{"block": 4}, {"block_bytes": 2000}, {}])
def test_near_duplicates_in_blocks_of_any_size(spark, options):
    import random

    draw = random.Random(3)
    base = [f"t{i}" for i in range(40)]
    texts = []
    for i in range(150):       # pages of one template, linked and not
        page = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            page[draw.randrange(40)] = f"x{draw.randrange(30)}"
        texts.append((i, " ".join(page)))
    got = {r["doc_id"]: r["component_id"] for r in near(spark, texts, **options)}
    assert got == near_components(texts, 3, 85) and 5 < len(set(got.values())) < 145
