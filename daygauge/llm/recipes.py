"""Exact deduplication by recipes of content-defined chunks; DataFrame functions only.

A normalised text is cut where its own content says so, between a least and a greatest
length. Each different chunk gets an identifier: its 64-bit hash, and the chunk's rank among
the different chunks of that hash, which is 0 unless hashes collide. The rank makes the
identifier verified: equal identifiers mean equal chunks, since the different chunks were
compared as strings once. Texts are equal when their ordered lists of identifiers are, and
only those lists move: eight bytes for some hundred characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daygauge.llm.workspace import numbered, stored

# A chunk ends behind one of these pairs, which are about one place in a hundred of prose.
ENDS = r"[.,;:!?)\]}>0-9][A-Z0-9]|[bdfkpvyz][aiouwhm]|\P{ASCII}[\p{Ll}&&[^aeiou]]"
LEAST, MOST = 256, 4096


def normalised(text: Column) -> Column:
    """The text without white space; a null text counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The pieces of a text in order; they put together are the text. An empty text has none."""
    shape = rf"(?s).{{{least - 2},{most - 2}}}?(?:{ENDS})|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(shape), F.lit(0))


def _collisions(pieces: DataFrame) -> DataFrame:
    """Chunks whose hash other chunks have too, with their rank among these; usually none."""
    distinct = pieces.select("hash", "chunk").distinct()
    shared = distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    rank = F.row_number().over(W.partitionBy("hash").orderBy("chunk")) - 1
    return distinct.join(shared, "hash").select("hash", "chunk", rank.cast("int").alias("rank"))


def recipes(
    docs: DataFrame,
    text: str = "text",
    hashed: Callable[[Column], Column] = F.xxhash64,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """Add ``recipe`` to rows with a number ``row``: an array of (hash, rank), a struct per chunk.

    An empty or null text has an empty recipe. ``hashed`` gives a chunk's 64-bit hash.
    """
    pieces = docs.select(F.explode(chunks(normalised(F.col(text)), least, most)).alias("chunk"))
    collisions = stored(_collisions(pieces.withColumn("hash", hashed(F.col("chunk")))), "chunk-collisions")
    cut = docs.withColumn("recipe", chunks(normalised(F.col(text)), least, most))
    if collisions.isEmpty():
        identified = F.transform("recipe", lambda c: F.struct(hashed(c).alias("hash"), F.lit(0).alias("rank")))
        return cut.withColumn("recipe", identified)
    each = cut.select("row", F.posexplode("recipe").alias("at", "chunk")).withColumn("hash", hashed(F.col("chunk")))
    known = each.join(collisions, ["hash", "chunk"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    lists = known.groupBy("row").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("at", "hash", "rank"))),
            lambda c: F.struct(c["hash"].alias("hash"), c["rank"].alias("rank")),
        ).alias("recipe")
    )
    empty = F.array().cast("array<struct<hash:bigint,rank:int>>")
    return cut.drop("recipe").join(lists, "row", "left").withColumn("recipe", F.coalesce("recipe", empty))


def _members(rows: DataFrame, hashed, least: int, most: int) -> DataFrame:
    """Of rows (row, id, body): row, id, text_sha256, keep_id, group_size, kept."""
    length = F.char_length("body").alias("length")
    digest = F.sha2(normalised(F.col("body")).cast("binary"), 256).alias("text_sha256")
    cut = recipes(rows, "body", hashed, least, most).select("row", "id", length, "recipe", digest)
    lists = stored(cut, "recipes")
    # Of a group, however large, each task sends one row.
    order = [(-F.col("length")).alias("shorter"), F.col("id").isNull().alias("none"), F.col("id"), F.col("row")]
    groups = lists.groupBy("recipe").agg(F.min(F.struct(*order)).alias("best"), F.count("*").alias("group_size"))
    # Stored, so that the join below reads two plain sides, of which a large group can be split.
    groups = stored(groups, "recipe-groups")
    return lists.join(groups, "recipe").select(
        "row",
        "id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    hashed: Callable[[Column], Column] = F.xxhash64,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """One row per document: the key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty, and all empty
    texts are one group. The row with the most code points in its original text stays, of
    these the one with the smallest key (null last), and of repeated rows any one. An empty
    table gives no rows. Other columns are not read.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    return _members(rows, hashed, least, most).drop("row").withColumnRenamed("id", key)


def without_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    hashed: Callable[[Column], Column] = F.xxhash64,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns. Texts move once.

    A null text counts as empty, and of all texts without letters one row stays. Of equal texts the
    row with the longest original stays, then the smallest key, null last; of rows equal in these any
    one. Long texts are many chunks, of which no task needs more than one text's. An empty table gives
    no rows; columns of any name are kept as they are.
    """
    rows = numbered(docs, "exact-documents")
    body = F.coalesce(F.col(f"doc.`{text}`"), F.lit("")).alias("body")
    members = _members(rows.select("row", F.col(f"doc.`{key}`").alias("id"), body), hashed, least, most)
    return rows.join(members.where("kept").select("row"), "row", "left_semi").select("doc.*")
