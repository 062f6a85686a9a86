"""Near duplicates by MinHash, verified on full shingle sets.

1. One pass over the texts gives each document's set of word shingles (64-bit hashes), its
   size, a 128-bit digest of the whole set, and universal-hash minima in bands of ``rows``.
   Equal sets are one node from here on, whatever ids they have: copies cost a row of an
   aggregation, never a pair.  An id that comes with several texts links their nodes.
2. Nodes that share a band meet in a bucket.  A bucket gives its members only a link to its
   smallest node, the hub; what shared a bucket is in one hub's group.  A hub's group is dealt
   into blocks of about ``block`` members, fewer where their sets are large (``block_bytes``), the
   hub in each.
3. In a block, pairs whose signatures agree in ``SIGNATURE`` of all places (five standard
   deviations under the threshold) are candidates; only then are full sets fetched, and a pair is
   checked on them unless its documents are already linked through others.  A block returns a
   spanning forest, so the output is linear in its members.
4. Groups of several blocks need pairs between blocks too.  Members already linked to the hub need
   none among themselves, so only the others, in blocks, meet the blocks of all members.
5. Connected components over the spanning edges; a component is named by its smallest id.

The number of bands follows from the threshold: a pair exactly at it shares no band with a
probability of at most ``missed``.  No bucket is capped and no pair that shares a band is lost.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.arrow_map import map_rows
from telemetry_spark.llm.common import free_name, materialise, quoted, ship_package, table
from telemetry_spark.llm.components import connected_components
from telemetry_spark.llm.rows import first_rows, shared_ids, with_id_in

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
REMEMBERED = 100_000
U64 = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


class WordHash(dict):
    """word -> 64-bit hash, remembered within bounds."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 32:
            self[word] = value
        return value


class Shingler:
    def __init__(self, width: int, bands: int, rows: int, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.width, self.bands, self.rows = width, bands, rows
        odd = lambda n: draw.integers(0, 2**63, n, dtype=U64) * U64(2) + U64(1)
        self.place, self.factor, self.band_factor = odd(width), odd(bands * rows)[:, None], odd(rows)
        self.offset, self.band_offset = draw.integers(0, 2**63, bands * rows, dtype=U64)[:, None], odd(bands)
        self.hashes = WordHash()

    def shingles(self, text: str) -> np.ndarray:
        """The sorted distinct shingles; a text of fewer words than the width has one of all."""
        words = WORDS.findall(text.encode().lower())   # bytes.lower() changes A-Z only
        if not words:
            return np.zeros(0, U64)
        hashed = np.fromiter(map(self.hashes.__getitem__, words), U64, len(words))
        if len(words) < self.width:
            whole = (hashed * self.place[:len(words)]).sum(dtype=U64) + U64(len(words))
            return _mixed(np.array([whole], U64))
        places = len(words) - self.width + 1
        mixed = np.zeros(places, U64)
        for i, factor in enumerate(self.place):
            mixed += hashed[i:i + places] * factor
        return np.unique(_mixed(mixed))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), 2**32 - 1, np.uint32)
        for at in range(0, len(shingles), 1024):
            part = shingles[None, at:at + 1024]
            np.minimum(least, ((self.factor * part + self.offset) >> U64(32)).min(axis=1).astype(np.uint32), out=least)
        return least

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        rows = signature.reshape(self.bands, self.rows).astype(U64)
        return _mixed((rows * self.band_factor).sum(axis=1, dtype=U64) + self.band_offset).view(np.int64)


def _signed(docs, id_col, text_col, width, bands, rows) -> DataFrame:
    """(row, id, n_shingles, set_id, signature, bands); an empty text has no set and no signature.
    ``row`` numbers the rows; it holds once this is stored."""
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
        T.StructField("signature", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(shingler, at, keys, texts):
        for row, key, text in zip(at, keys, texts):
            found = shingler.shingles(text or "")
            if len(found):
                least = shingler.signature(found)
                yield row, key, len(found), _digest(found), least.astype(np.uint16).tobytes(), shingler.band_keys(least)
            else:
                yield row, key, 0, None, None, None

    numbered = docs.select(F.monotonically_increasing_id(), quoted(id_col).cast("long"), quoted(text_col).cast("string"))
    return map_rows(numbered, sign, schema, setup=lambda: Shingler(width, bands, rows))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(docs, id_col, text_col, wanted: DataFrame, repeated: bool, width, bands, rows) -> DataFrame:
    """(key, shingles) of the ``wanted`` nodes (id, least, and set_id if repeated), from the texts of their documents.

    Where ids are unique the key is the document's.  Else a document of a wanted id may have any set,
    and the key is the set's digest; a repeated row gives its set more than once, and one is kept."""
    schema = T.StructType([T.StructField("key", T.BinaryType() if repeated else T.LongType()), T.StructField("shingles", T.BinaryType())])
    texts = docs.select(quoted(id_col).cast("long").alias("doc"), quoted(text_col).cast("string").alias("text"))
    ids = wanted.select("least").distinct() if repeated else wanted.select("least")

    def shingle(shingler, keys, texts):
        for key, text in zip(keys, texts):
            found = shingler.shingles(text or "")
            yield _digest(found) if repeated else key, found.tobytes()

    chosen = texts.join(ids, F.col("doc").eqNullSafe(F.col("least")), "left_semi")
    found = map_rows(chosen, shingle, schema, setup=lambda: Shingler(width, bands, rows))
    if not repeated:
        return found
    return found.join(wanted.select(F.col("set_id").alias("key")), "key", "left_semi").dropDuplicates(["key"])


def _candidates(least_share: float):
    """A group's documents -> those with partners whose signatures agree, and the partners."""

    def agreeing(rows: pa.Table) -> pa.Table:
        ids = rows["id"].to_numpy()
        ids, first = np.unique(ids, return_index=True)
        signatures = rows["signature"].to_pylist()
        signed = np.array([np.frombuffer(signatures[i], np.uint16) for i in first])
        partners: list[list[int]] = [[] for _ in ids]
        used = np.zeros(len(ids), bool)
        for i in range(1, len(ids)):
            alike = np.nonzero((signed[:i] == signed[i]).mean(axis=1) >= least_share)[0]
            if len(alike):
                partners[i] = ids[alike].tolist()
                used[i] = True
                used[alike] = True
        keep = np.nonzero(used)[0]
        keys = {k: [rows[k][0].as_py()] * len(keep) for k in GROUP}
        return pa.table({**keys, "id": ids[keep], "partners": [partners[i] for i in keep]}, schema=CANDIDATES)

    return agreeing


def _verified(threshold: int):
    """A group's candidates with their sets -> a spanning forest of the links among them."""

    def linked(rows: pa.Table) -> pa.Table:
        ids, partners = rows["id"].to_pylist(), rows["partners"].to_pylist()
        sets = {i: np.frombuffer(s, U64) for i, s in zip(ids, rows["shingles"].to_pylist())}
        root = {i: i for i in sets}

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for a, others in zip(ids, partners):
            for b in others or ():
                if b not in sets:
                    continue
                x, y = find(a), find(b)
                if x == y:
                    continue
                p, q = sets[a], sets[b]
                if 100 * min(len(p), len(q)) < threshold * max(len(p), len(q)):
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= threshold * (len(p) + len(q) - both):
                    root[max(x, y)] = min(x, y)
        pairs = [(i, r) for i in root if (r := find(i)) != i]
        keys = {k: [rows[k][0].as_py()] * len(pairs) for k in GROUP}
        return pa.table({**keys, "a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}, schema=LINKS)

    return linked


GROUP = ("hub", "left_block", "right_block")
_KEYS = [pa.field("hub", pa.int64()), pa.field("left_block", pa.int64()), pa.field("right_block", pa.int64())]
CANDIDATES = pa.schema([*_KEYS, pa.field("id", pa.int64()), pa.field("partners", pa.list_(pa.int64()))])
LINKS = pa.schema([*_KEYS, pa.field("a", pa.int64()), pa.field("b", pa.int64())])
_DDL = "hub long, left_block long, right_block long, "


class NearDuplicates:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int = 5, threshold: int = 80,
                 rows: int = 7, missed: float = 1e-6, block: int = 256, block_bytes: int = 64 << 20):
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        self.threshold, self.block, self.block_bytes = threshold, block, block_bytes
        share = threshold / 100
        # a pair at the threshold shares no band with at most this probability
        bands = math.ceil(math.log(missed) / math.log1p(-(share ** rows)))
        self.shape = (width, bands, rows)
        self.signature_share = share - 5 * (share * (1 - share) / (bands * rows)) ** 0.5

    def links_within(self, groups: DataFrame, signatures: DataFrame, nodes: DataFrame, repeated: bool) -> DataFrame:
        """Spanning edges (a, b) of every group (hub, left_block, right_block, id of a node)."""
        ship_package(groups.sparkSession)
        signed = groups.join(signatures, "id")
        close = signed.groupBy(*GROUP).applyInArrow(
            _candidates(self.signature_share), _DDL + "id long, partners array<long>")
        close, _ = materialise(close, "close-pairs")
        wanted = nodes.join(close.select("id").distinct(), "id", "left_semi")
        # stored, so that joins with it are planned by its own bytes
        wanted, _ = materialise(wanted.select("id", "least", *(["set_id"] if repeated else [])), "wanted")
        sets = _sets(self.docs, self.id_col, self.text_col, wanted, repeated, *self.shape)
        keyed = close.join(wanted.select("id", F.col("set_id" if repeated else "least").alias("of")), "id")
        full = keyed.join(sets, F.col("of").eqNullSafe(F.col("key"))).drop("of", "key")
        return materialise(full.groupBy(*GROUP).applyInArrow(_verified(self.threshold), _DDL + "a long, b long"), "links")[0]

    def run(self) -> DataFrame:
        """(id, n_shingles, component) for every row of the documents."""
        signed, _ = materialise(_signed(self.docs, self.id_col, self.text_col, *self.shape), "signed")
        # a node is the first row with its set, and carries the smallest id of all of them
        nodes = signed.where("set_id is not null").groupBy("set_id").agg(F.min("row").alias("id"), F.min("id").alias("least"))
        nodes, _ = materialise(nodes, "nodes")
        rows = signed.where("set_id is not null").select(F.col("id").alias("doc"), "n_shingles", "set_id").join(nodes, "set_id")
        rows, _ = materialise(rows.select("doc", "n_shingles", F.col("id").alias("node")), "rows")
        texts_of = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("first"), F.max("node").alias("last"))
        several, found = materialise(texts_of.where("rows > 1"), "repeated-ids", {"n": F.count(F.lit(1))})
        repeated = found["n"] > 0
        first_rows = signed.withColumnRenamed("id", "doc").withColumnRenamed("row", "id").join(nodes.select("id"), "id", "left_semi")
        banded = first_rows.select("id", "n_shingles", F.explode("bands").alias("band"))
        hubs = banded.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub <> last")
        # stored first: a join with a fresh aggregate on its key could not split a hot band
        hubs, _ = materialise(hubs.select("band", "hub"), "bands")
        members = banded.join(hubs, "band").where("id <> hub").select("hub", "id", "n_shingles").distinct()
        members, _ = materialise(members, "members")
        size = F.greatest(F.count(F.lit(1)) / F.lit(self.block), 8 * F.sum("n_shingles") / F.lit(self.block_bytes))
        counts, seen = materialise(members.groupBy("hub").agg(F.ceil(size).alias("blocks")), "hubs", {"most": F.max("blocks")})
        members = members.drop("n_shingles")
        block_of = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col("blocks"))
        dealt = members.join(counts, "hub").withColumn("left_block", block_of(1))
        hub_rows = counts.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("left_block"),
                                 F.col("hub").alias("id"))
        first = dealt.select("hub", "left_block", "id").union(hub_rows).select(
            "hub", "left_block", F.lit(-1).cast("long").alias("right_block"), "id")
        signatures = first_rows.select("id", "signature")
        edges = self.links_within(first, signatures, nodes, repeated)
        if (seen["most"] or 0) > 1:
            # members of several blocks that are not linked to their hub meet all members
            large = dealt.where("blocks > 1")
            with_root = edges.select("hub", "left_block", F.col("a").alias("id"), F.col("b").alias("root"))
            hub_root = edges.where("a = hub").select("hub", "left_block", F.col("b").alias("hub_root"))
            joined = (large.join(with_root, ["hub", "left_block", "id"], "left")
                      .join(hub_root, ["hub", "left_block"], "left")
                      .select("hub", "id", "left_block", "blocks", F.coalesce("root", "id").alias("root"),
                              F.coalesce("hub_root", "hub").alias("hub_root")))
            apart, _ = materialise(joined.where("root <> hub_root"), "apart")
            far = apart.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / F.lit(self.block)).alias("far_blocks"))
            # every outlier to each block of members, every member to each block of outliers
            left = apart.join(far, "hub").select(
                "hub", "id", F.pmod(F.xxhash64("id", F.lit(2)), F.col("far_blocks")).alias("left_block"),
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("right_block"))
            right = large.select("hub", "id", F.col("left_block").alias("right_block")).join(far, "hub").select(
                "hub", "id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("far_blocks") - 1)).alias("left_block"), "right_block")
            crossing = left.select("hub", "left_block", "right_block", "id").union(right.select("hub", "left_block", "right_block", "id"))
            edges = edges.union(self.links_within(crossing, signatures, nodes, repeated))
        edges = edges.select("a", "b")
        if repeated:
            same = rows.join(several.where("doc is not null and first <> last"), "doc").where("node <> first")
            edges = edges.union(same.select(F.col("node").alias("a"), F.col("first").alias("b")))
        component = connected_components(edges, "a", "b")
        of_node = nodes.join(component, nodes["id"] == component["node"], "left").select(
            nodes["id"].alias("at"), "least", F.coalesce("component", nodes["id"]).alias("inside"))
        named, _ = materialise(of_node.groupBy("inside").agg(F.min("least").alias("component")), "components")
        of_node, _ = materialise(of_node.join(named, "inside").select("at", "component"), "node-components")
        in_sets = rows.join(of_node, F.col("node") == F.col("at")).select(F.col("doc").alias("id"), "n_shingles", "component")
        return in_sets.union(signed.where("set_id is null").select("id", "n_shingles", F.col("id").alias("component")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: int = 80,
                    **shape) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when 100 * intersection >= threshold * union of their sets of distinct
    ``width``-word shingles (A-Z lower-cased, words between ASCII white space; a shorter text is
    one shingle).  A null, empty or blank text has an empty set and is linked with nothing.
    Repeated rows share a component, and an id that comes with several texts joins what each of them
    is linked with.  Ids are integers; a row without one is in the component of the ids its text is
    linked with, null if there are none.  Equal similarities are no ties: every link counts.  Other
    columns are not read; an empty table gives no rows.  Texts may be of any length; the largest two
    sets of a block are in one task's memory."""
    found = NearDuplicates(docs, id_col, text_col, width, threshold, **shape).run()
    return found.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def surviving_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **shape) -> DataFrame:
    """One row of ``docs`` of each group of linked texts, with all its columns: the smallest id, none last.

    Unlike in ``near_duplicates``, an id that several rows share links none of them: their texts, and
    those of rows without an id, are documents each by itself.  Of rows of one id and one text the
    first by its columns stays.  Ties of ids go to the smaller SHA-256 of the text; a null text is
    an empty one; an empty or blank text is linked with nothing and stays; no rows give no rows."""
    shared, several = shared_ids(docs, id_col)
    if not several:
        found = near_duplicates(docs, id_col, text_col, **shape)
        return with_id_in(docs, id_col, found.where("kept").select(quoted(id_col)))
    top = docs.agg(F.max(quoted(id_col).cast("long"))).first()[0]
    if top is not None and top >= 2**62:      # no room for numbers above the ids: all rows are numbered
        shared, top = docs.select(quoted(id_col).cast("long").alias("_shared")).distinct(), None
    number, digest, own = (free_name(docs, c) for c in ("_number", "_digest", "_own"))
    rows = with_id_in(docs, id_col, shared).withColumn(digest, F.sha2(F.coalesce(quoted(text_col).cast("string"), F.lit("")), 256))
    rows = first_rows(rows, [quoted(id_col), quoted(digest)], []).withColumn(own, quoted(id_col).cast("long"))
    start = max(top if top is not None else -1, -1) + 1
    numbers, _ = materialise(rows.select(quoted(own), quoted(digest)).distinct().withColumn(
        number, F.monotonically_increasing_id() + F.lit(start).cast("long")), "numbers")
    same = rows[own].eqNullSafe(numbers[own]) & (rows[digest] == numbers[digest])
    columns = [quoted(c) for c in docs.columns]
    numbered = rows.join(numbers.select(own, digest, number), same).select(*columns, quoted(number))
    alone = with_id_in(docs, id_col, shared, "left_anti").select(*columns, quoted(id_col).cast("long").alias(number))
    whole = alone.unionByName(numbered)
    found = near_duplicates(whole.select(quoted(number).alias("number"), quoted(text_col).alias("text")), "number", "text", **shape)
    told = numbers.select(quoted(number).alias("at"), quoted(own).alias("id"), quoted(digest).alias("digest"), F.lit(True).alias("told"))
    named = found.join(told, F.col("number") == F.col("at"), "left").select(
        "number", "component_id", F.when(F.col("told"), F.col("id")).otherwise(F.col("number")).alias("id"), "digest")
    least = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest", "number")).alias("least"))
    least, _ = materialise(least.select(F.col("least.number").alias("number")), "survivors")
    return with_id_in(whole, number, least).drop(number)


def op4_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, threshold=85)
