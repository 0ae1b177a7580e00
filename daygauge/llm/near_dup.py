"""Near-duplicates by MinHash with fast similarity sketching, banding and exact verification.

A sketch has a fixed number of coordinates. In each round every shingle is hashed to one of
them; after as many rounds as there are coordinates, a further round for each coordinate
fills it whatever the shingles are. A coordinate keeps the least (round, hash), so two sets
agree in it with the probability of their similarity, and one or two rounds are enough for a
document of usual length. Bands of coordinates put similar documents into common buckets.

Documents with equal sets are one node from the start. A bucket doesn't compare all its
nodes: a few leaders are compared with the others, links are confirmed on the whole sets, and
linked nodes become one component. Pairs inside a component need no comparison, since they
change no component; so buckets take turns, a share of them at a time, and nodes that one turn
has tied make no pairs in the next. After that, a large bucket of near copies is one component
and some nodes that none of the leaders resembles. Such buckets that share nodes are one group,
and its nodes outside the largest component are compared, as a set of queries in blocks, with all
nodes of the group. Each pair of blocks is a row of its own, so a large group is spread over
tasks. Two blocks are compared by bits that say which of their common shingles each set has; out
comes a link of each query with each component, and no pair of a bucket is left out.

With 32 bands of 4 coordinates a pair of similarity 0.75 has no common bucket with a
probability of 5 in a million, and pairs of more similarity with less. Before whole sets are
fetched, pairs are passed over whose sketches agree in fewer coordinates than such a pair's do
but for 3 in a million.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygauge.llm.workspace import numbered, stored, text_slices

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
# Candidates' keys up to this many are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 4_000_000
# A bucket's leaders, and the turns in which buckets are led, each a share of them.
LEADERS, TURNS = 2, 3
# Bytes of whole sets in a block.
BLOCK_BYTES = 2 << 20
# Standard deviations that a linked pair's agreement may be below its expectation.
DEVIATIONS = 4.5
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of a text's shingles as ascending 64-bit hashes.

    A text of fewer words is one shingle; a null text, or one without words, has none.
    """
    tokens = text.encode().translate(_LOWER).split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    rolled = np.zeros(len(tokens) - width + 1, np.uint64)
    for at in range(width):
        rolled = rolled * BASE + hashes[at : at + len(rolled)]
    return np.unique(_mixed(rolled + np.uint64(width)))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def sketches(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """The sketch of each set that isn't empty, as rows of ``size`` 64-bit numbers."""
    found = np.full((len(sets), size), EMPTY, np.uint64)
    flat, of = found.reshape(-1), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for round_ in range(2 * size):
        if not len(elements):
            break
        seed = np.uint64(int(BASE) * (round_ + 1) & 0xFFFFFFFFFFFFFFFF)
        scattered = _mixed(elements + seed)
        value = (scattered >> np.uint64(9)) | (np.uint64(round_) << np.uint64(55))
        place = (scattered % np.uint64(size)).astype(np.int64) if round_ < size else round_ - size
        np.minimum.at(flat, of * size + place, value)
        more = (found == EMPTY).any(axis=1)[of]
        elements, of = elements[more], of[more]
    return found


def band_keys(sketched: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    cut = sketched.reshape(len(sketched), bands, -1)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2])
    for at in range(cut.shape[2]):
        keys = _mixed(keys * BASE + cut[:, :, at])
    return keys.view(np.int64)


def _described(rows: DataFrame, words: int, bands: int, band_rows: int) -> DataFrame:
    """Of rows (row, id, hash, body): row, id, hash, n (set size), sig (a digest of the set; null for an
    empty one), bands (its keys) and coords (two bytes of each coordinate)."""
    size = bands * band_rows

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch.column("body")):
                sets = [shingles(t, words) for t in texts]
                filled = [s for s in sets if len(s)]
                sketched = sketches(filled, size)
                counts = np.array([len(s) for s in sets], np.int64)
                ends = np.cumsum(np.where(counts > 0, bands, 0))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                short = iter(sketched.astype(np.uint16))
                columns = [
                    *(batch.column(name).slice(start, len(texts)) for name in ("row", "id", "hash")),
                    pa.array(counts),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), band_keys(sketched, bands).ravel()),
                    pa.array([next(short).tobytes() if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "hash", "n", "sig", "bands", "coords"])

    added = "n long, sig binary, bands array<long>, coords binary"
    schema = StructType([*rows.drop("body").schema.fields, *StructType.fromDDL(added).fields])
    return rows.mapInArrow(describe, schema)


def _sets(bodies: DataFrame, words: int) -> DataFrame:
    """Of rows (body): sig, packed (the whole set)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch.column("body")):
                sets = [shingles(t, words).tobytes() for t in texts]
                digests = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
                columns = [pa.array(digests, pa.binary()), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["sig", "packed"])

    return bodies.mapInArrow(packed, "sig binary, packed binary")


def _linked(percent: int) -> Column:
    @F.pandas_udf("boolean")
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            found = []
            for a, b in zip(left, right):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = np.intersect1d(a, b, assume_unique=True).size
                found.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pd.Series(found, dtype="bool")

    return linked("a_set", "b_set")


def _alike(percent: int, size: int) -> Column:
    """Whether sketches agree as much as those of a linked pair must, but for rare chances."""
    share = percent / 100
    least = size * share - DEVIATIONS * (size * share * (1 - share)) ** 0.5

    @F.pandas_udf("boolean")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            a, b = (np.frombuffer(b"".join(x), np.uint16).reshape(len(x), size) for x in (left, right))
            yield pd.Series((a == b).sum(axis=1) >= least, dtype="bool")

    return alike("a_coords", "b_coords")


def _in_order(pairs: DataFrame) -> DataFrame:
    """The different pairs (a, b), a <= b, among pairs (x, y)."""
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Of edges (a, b): node, root, the least node that is reachable.

    Each different edge is followed once. Each round takes the least root among a node's neighbours, then the root's own root, so
    long chains shrink by half each time. The tables are stored between rounds.
    """
    once = _in_order(edges.select(F.col("a").alias("x"), F.col("b").alias("y")))
    once = stored(once, "links")
    both = once.union(once.select("b", "a"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "roots")
    total = labels.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
    while total is not None:
        far = labels.select(F.col("node").alias("b"), F.col("root").alias("far"))
        near = both.join(far, "b").groupBy(F.col("a").alias("node")).agg(F.min("far").alias("far"))
        hooked = labels.join(near, "node").select("node", F.least("root", "far").alias("up"))
        above = labels.select(F.col("node").alias("up"), F.col("root").alias("top"))
        labels = stored(hooked.join(above, "up").select("node", F.col("top").alias("root")), "roots")
        now = labels.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if now == total:
            break
        total = now
    return labels


def _rooted(entries: DataFrame, roots: DataFrame) -> DataFrame:
    known = roots.select(F.col("node").alias("k_node"), F.col("root").alias("k_root"))
    joined = entries.join(known, F.col("node") == F.col("k_node"), "left")
    return joined.withColumn("root", F.coalesce("k_root", "node")).drop("k_node", "k_root")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links (a, b) between nodes: only the roots that links tie are followed."""
    ends = links.select("a").union(links.select("b")).distinct().toDF("node")
    fresh = ends.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
    known = roots.union(fresh)
    tied = _rooted(links.select("b", F.col("a").alias("node")), known).select(F.col("root").alias("a"), F.col("b").alias("node"))
    tied = _rooted(tied, known).select("a", F.col("root").alias("b")).where("a <> b")
    tops = components(tied).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return stored(known.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")


def _led(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of entries (key, node, root): pairs with their bucket's leaders, and the entries that are left to compare.

    Leaders are drawn by lot, one for each of several hashes, so that a bucket sends few rows.
    They are compared with all of their bucket, so they leave it; buckets of one root are done.
    """
    lots = [
        F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("lot"), "node", "root"))
        for i in range(LEADERS)
    ]
    roots = F.min("root").alias("lo"), F.max("root").alias("hi")
    drawn = entries.groupBy("key").agg(*roots, F.array(*lots).alias("led")).where("lo < hi")
    leaders = drawn.select("key", F.explode("led").alias("l"))
    leaders = leaders.select("key", F.col("l.node").alias("x"), F.col("l.root").alias("x_root"))
    leaders = stored(leaders.distinct(), "leaders")
    pairs = entries.join(leaders, "key").where("root <> x_root").withColumnRenamed("node", "y")
    rest = entries.join(leaders.select("key").distinct(), "key", "left_semi")
    rest = rest.join(leaders.select("key", F.col("x").alias("node")), ["key", "node"], "left_anti")
    return _in_order(pairs), stored(rest.select("key", "node"), "buckets")


def _compared(percent: int):
    """A link of each left set with each component that the right sets have, without its own."""

    def packed(sets: list[np.ndarray], universe: np.ndarray) -> np.ndarray:
        bits = np.zeros((len(sets), len(universe) // 64 + 1), np.uint64)
        for row, own in zip(bits, sets):
            at = np.searchsorted(universe, own)
            at = at[universe[np.minimum(at, len(universe) - 1)] == own] if len(universe) else at[:0]
            np.bitwise_or.at(row, at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
        return bits

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("left"), batch.column("right")):
                left, right = left.as_py(), right.as_py()
                a, b = ([np.frombuffer(x["packed"], np.uint64) for x in side] for side in (left, right))
                universe = np.intersect1d(np.concatenate(a), np.concatenate(b))
                a_bits, b_bits = packed(a, universe), packed(b, universe)
                sizes, roots = np.array([len(x) for x in b]), np.array([x["root"] for x in right])
                nodes, found = np.array([x["node"] for x in right], np.int64), []
                for node, own, row in zip(left, a, a_bits):
                    common = np.bitwise_count(b_bits & row).sum(axis=1).astype(np.int64)
                    linked = (100 * common >= percent * (len(own) + sizes - common)) & (roots != node["root"])
                    first = np.unique(roots[linked], return_index=True)[1]
                    found += [(node["node"], other) for other in nodes[linked][first].tolist()]
                columns = [pa.array([pair[i] for pair in found], pa.int64()) for i in range(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return compare


def _left_over(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the entries (key, node, root) of buckets with several roots."""
    mixed = entries.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    entries = stored(entries.join(mixed.select("key"), "key", "left_semi"), "mixed-buckets")
    # Buckets that share a node are tied to the least bucket of that node; a bucket tied to no other is a group.
    least = stored(entries.groupBy("node", "root").agg(F.min("key").alias("a")), "mixed-nodes")
    ties = entries.select("node", F.col("key").alias("b")).join(least, "node").where("a <> b").select("a", "b")
    groups = components(ties).select(F.col("node").alias("a"), F.col("root").alias("k_group"))
    members = least.join(groups, "a", "left").withColumn("group", F.coalesce("k_group", "a"))
    members = stored(members.select("group", "node", "root").join(sets, "node"), "mixed-groups")
    weight = F.sum(F.octet_length("packed")).alias("bytes")
    sizes = members.groupBy("group", "root").agg(F.count("*").alias("n"), weight)
    main = sizes.groupBy("group").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int")
    placed = members.join(main.select("group", "main", blocks.alias("blocks")), "group")
    placed = placed.withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))

    def packed(rows: DataFrame, side: str) -> DataFrame:
        return rows.groupBy("group", "block", "blocks").agg(F.collect_list(F.struct("node", "root", "packed")).alias(side))

    queries = packed(placed.where("root <> main"), "left")
    queries = queries.select("group", F.explode(F.expr("sequence(0L, blocks - 1L)")).alias("block"), "left")
    pairs = queries.join(packed(placed, "right").drop("blocks"), ["group", "block"]).select("left", "right")
    return pairs.mapInArrow(_compared(percent), "a long, b long")


def node_components(
    rows: DataFrame, words: int, percent: int, bands: int, band_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Of rows (row, id, body): the rows as (row, id, n, sig, node), and the components (node, root).

    A node stands for all rows with equal sets; its number is the least of their ``row``.
    Nodes without links have no entry among the components.
    """
    hashed = rows.select("row", "id", F.xxhash64("body").alias("hash"), "body")
    described = stored(_described(hashed, words, bands, band_rows), "sketches")
    first = F.min(F.struct("row", "hash", "bands", "coords")).alias("f")
    nodes = described.where("n > 0").groupBy("sig").agg(first)
    nodes = nodes.select("sig", F.col("f.row").alias("node"), F.col("f.hash").alias("hash"), "f.bands", "f.coords")
    nodes = stored(nodes, "nodes")

    # Entries of the buckets that have two nodes at least.
    entries = nodes.select(F.explode("bands").alias("key"), "node")
    filled = entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    entries = stored(entries.join(filled, "key"), "buckets")

    # The whole sets of these nodes only, made again from their texts.
    wanted = nodes.join(entries.select("node").distinct(), "node", "left_semi")
    wanted = stored(wanted.select("node", "sig", "hash", "coords"), "candidates")
    keys = wanted.select("hash").distinct()
    keys = F.broadcast(keys) if wanted.count() <= BROADCAST_KEYS else keys
    bodies = rows.select(F.xxhash64("body").alias("hash"), "body").join(keys, "hash", "left_semi")
    sets = _sets(bodies.dropDuplicates(["hash", "body"]).select("body"), words).dropDuplicates(["sig"])
    sets = stored(wanted.join(sets, "sig").select("node", "packed"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        for side in ("b", "a"):
            coords = wanted.select(F.col("node").alias(side), F.col("coords").alias(f"{side}_coords"))
            pairs = pairs.join(coords, side)
        likely = stored(pairs.where(_alike(percent, bands * band_rows)).select("a", "b"), "likely-pairs")
        for side in ("b", "a"):
            whole = sets.select(F.col("node").alias(side), F.col("packed").alias(f"{side}_set"))
            likely = likely.join(whole, side)
        return stored(likely.where(_linked(percent)).select("a", "b"), "links")

    roots, rest = None, []
    for turn in range(TURNS):
        share = entries.where(F.pmod(F.xxhash64("key"), F.lit(TURNS)) == turn)
        pairs, left = _led(_rooted(share, roots) if roots else share.withColumn("root", F.col("node")))
        rest.append(left)
        links = confirmed(pairs)
        roots = components(links) if roots is None else _merged(roots, links)
    left = _rooted(functools.reduce(DataFrame.union, rest), roots)
    roots = _merged(roots, stored(_left_over(left, sets, percent), "links"))
    return described.select("row", "id", "n", "sig").join(nodes.select("sig", "node"), "sig", "left"), roots


def _grouped(rows: DataFrame, words: int, percent: int, bands: int, band_rows: int) -> DataFrame:
    """Of rows (row, id, body): row, id, n, first (of the component, as a struct of none, id, row)."""
    placed, roots = node_components(rows, words, percent, bands, band_rows)
    # Rows without shingles are components of their own, with negative numbers.
    placed = placed.withColumn("node", F.coalesce("node", -F.col("row") - 1))
    placed = stored(_rooted(placed.select("row", "id", "n", "node"), roots), "placed")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    firsts = placed.groupBy("root").agg(F.min(order).alias("first"))
    return placed.join(firsts, "root").select("row", "id", "n", "first")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    band_rows: int = ROWS,
) -> DataFrame:
    """One row per document: the key, n_shingles, component_id, kept.

    Documents are linked when their sets of word shingles have a similarity of ``percent``
    hundredths at least; component_id is the smallest key that links reach, its own included
    (null last). The first row by key stays, of repeated rows any one. A null text, or one
    without words, has an empty set and is linked with nothing. An empty table gives no rows.
    Other columns are not read.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    grouped = _grouped(rows, words, percent, bands, band_rows)
    return grouped.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("first.id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    band_rows: int = ROWS,
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns. Texts move once.

    Null texts and those without words are linked with nothing, so all of them stay. Of a component
    the row with the smallest key stays, null last, of repeated rows any one. Texts of any length are
    compared whole. An empty table gives no rows; columns of any name are kept as they are.
    """
    whole = numbered(docs, "near-documents")
    body = F.coalesce(F.col(f"doc.`{text}`"), F.lit("")).alias("body")
    rows = whole.select("row", F.col(f"doc.`{key}`").alias("id"), body)
    grouped = _grouped(rows, words, percent, bands, band_rows)
    first = grouped.where(F.col("row") == F.col("first.row")).select("row")
    return whole.join(first, "row", "left_semi").select("doc.*")
