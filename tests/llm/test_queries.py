"""The registered queries on the sf0.001 tables, and the pipeline stage by stage."""

import zlib

import corpus_pipeline
import pytest
from cases import documents, near_components, no_documents
from conftest import SF_SMALL
from oracle_compare import compare

from telemetry_spark.llm import langid, packing
from telemetry_spark.llm.queries import ORACLE_SQL, QUERIES

CONTRACT = {
    "op1_": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op2_": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op3_": "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    "op4_": "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean",
    "op5_": "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean",
    "op6_": "page_id:bigint host:string path:string rule:string verdict:string",
    "op7_": "vec_id:bigint n_links:bigint component_id:bigint kept:boolean",
    "op8_": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op9_": "doc_id:bigint keep_id:bigint group_size:bigint kept:boolean text_sha256:string",
    "op10_": "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
    "op11_": "query_id:bigint rank:int vec_id:bigint score:double",
    "op12_": "vec_id:bigint cluster:int distance:bigint cluster_inertia:bigint inertia:bigint centroid_sha256:string",
    "op13_": "vec_id:bigint component:int n:bigint deviation:bigint whitened:double explained:double identity_error:double",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_the_contract_s_columns(spark, name):
    found = QUERIES[name](spark, SF_SMALL)
    want = dict(c.split(":") for c in CONTRACT[name[:name.index("_") + 1]].split())
    assert want.items() <= dict(found.dtypes).items()
    vectors = ("embeddings", "vec_id")
    source = {"op6": ("pages", "page_id"), "op7": vectors, "op11": vectors, "op12": vectors, "op13": vectors}.get(
        name.split("_")[0], ("documents", "doc_id"))
    ids = spark.read.parquet(f"{SF_SMALL}/{source[0]}.parquet").select(source[1])
    got = found.select(source[1])
    if name.startswith("op11_"):
        got, ids = found.select("query_id"), ids.where("vec_id % 100 = 0")
    if name.startswith(("op10_", "op11_", "op13_")):
        got = got.distinct()
    assert got.exceptAll(ids).count() == 0 and got.count() == ids.count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, duck_small, name):
    problems = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE_SQL[name])
    assert not problems, problems


def test_held_out_languages_are_right(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op2_language_id"](spark, SF_SMALL).where("held_out").join(docs, "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count() > 0


def test_near_duplicates_by_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op4_near_dedup"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == near_components(docs, 3, 85)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == columns
        if name == "language_id":
            assert docs.count() == before.count()     # every document here is in one of the languages
        elif name == "exact_dedup":
            strip = "regexp_replace(text, '[ \\\\t-\\\\r]', '')"
            assert docs.count() == before.selectExpr(strip).distinct().count() == docs.selectExpr(strip).distinct().count()
        elif name == "near_dedup":
            want = near_components([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
            assert {r["doc_id"] for r in docs.collect()} == set(want.values())
        else:
            assert docs.count() == before.count() and docs.where("text like '%@mail%'").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_of_odd_and_no_documents(spark):
    odd, none = documents(spark), no_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        odd, none = stage(spark, odd, SF_SMALL), stage(spark, none, SF_SMALL)
        if name != "packing":
            assert odd.columns == documents(spark).columns
    left = {r["doc_id"] for r in odd.collect()}
    assert {1, 2, 3, 17}.isdisjoint(left)      # no letter
    assert {13, 8, None} <= left and 16 not in left and 9 not in left and none.collect() == []


def test_pipeline_keeps_labelled_documents_without_evidence(spark):
    from pyspark.sql import functions as F

    # held-out ids, so that the model has no Georgian; a word's start says nothing for either language
    rare = [i for i in range(100, 130) if zlib.crc32(str(i).encode()) % 4 == 2]
    texts = [(i, ("the cat sat", "der hut lag")[i % 2]) for i in range(40)] + [(i, "სახლი ბაღი") for i in [*rare, 200]]
    lang = F.expr("case when doc_id < 100 then element_at(array('en', 'de'), cast(doc_id % 2 as int) + 1) when doc_id < 200 then 'ka' end")
    docs = documents(spark, texts).withColumn("lang", lang)
    left = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, SF_SMALL).collect()}
    assert left == {**{i: ("en", "de")[i % 2] for i in range(40)}, **{i: "ka" for i in rare}}


def test_held_out_share(spark):
    from pyspark.sql import functions as F

    assert spark.range(4000).where(langid.held_out(F.col("id"))).count() in range(900, 1100)


def test_pipeline_packs_by_the_languages_found(spark):
    words = {"en": ["the", "house", "with", "every", "window"], "de": ["das", "zimmer", "unter", "jeder", "brücke"]}
    text = lambda lang, i: " ".join(words[lang][(i + k * k) % 5] for k in range(60))
    of = {i: ("en", "de")[i % 2] for i in range(40)}
    label = {**of, 4: "de", 5: None, 6: None, 7: "en"}       # two mislabelled, two without a label
    rows = [(i, text(of[i], i) + f" {i}", label[i]) for i in of] + [(40, "12 34", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = corpus_pipeline.language_id(spark, docs, SF_SMALL)
    assert {r["doc_id"]: r["lang"] for r in found.collect()} == of
    packed = dict(corpus_pipeline.STAGES)["packing"](spark, found, SF_SMALL).collect()
    assert {r["doc_id"]: r["lang"] for r in packed} == of
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], set()).add(r["lang"])
    assert set(sequences) == set(range(len(sequences))) and all(len(langs) == 1 for langs in sequences.values())


def test_a_label_no_model_knows_stays(spark):
    texts = [(i, ("the cat sat", "der hut lag")[i % 2]) for i in range(40)]
    held = [i for i in range(100, 130) if zlib.crc32(str(i).encode()) % 4 == 2]     # its label is not learned
    docs = spark.createDataFrame([(i, t, ("en", "de")[i % 2]) for i, t in texts] + [(i, "der hut lag", "nl") for i in held],
                                 "doc_id long, text string, lang string")
    left = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, SF_SMALL).collect()}
    assert left == {**{i: ("en", "de")[i % 2] for i in range(40)}, **{i: "nl" for i in held}}


def test_groups_beyond_the_largest_share_sequences(spark, tmp_path):
    rows = [(i, 0, 1 << (i % 3), i, g) for i, g in enumerate(["a"] * 9 + ["b"] * 7 + ["c"] * 3 + ["d"] * 2 + [None] * 4)]
    spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, lang string").write.parquet(f"{tmp_path}/pieces")
    pieces = spark.read.parquet(f"{tmp_path}/pieces")
    got = packing.pack_pieces(pieces, 8, lanes=4, by="lang", groups=2).collect()
    assert sorted(r[:5] for r in got) == sorted(rows)
    langs, filled = {}, {}
    for r in got:
        langs.setdefault(r["sequence_id"], set()).add(r["lang"] if r["lang"] in ("a", "b") else "rest")
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(len(s) == 1 for s in langs.values()) and set(langs) == set(range(len(langs)))
    for places in filled.values():
        ends = [a + n for a, n in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 8
