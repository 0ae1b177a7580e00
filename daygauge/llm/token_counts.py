"""Token counts without token ids: pieces are counted once per distinct pre-token.

The corpus' distinct pre-tokens with their frequencies are gathered first, and each is
encoded once. The table of the results then meets every document's pre-token frequencies.
Its most frequent pre-tokens, a fixed number of them, go to all tasks, long ones as digests; they
cover nearly all occurrences of text whatever its size. The rest is joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygauge.llm.splitting import byte_pieces, sections, tokenizer
from daygauge.llm.workspace import stored, text_slices

# The most frequent pre-tokens, up to this many, are sent to all tasks: a few MB.
FREQUENT = 200_000
# Longer pre-tokens (in bytes) are sent as their SHA-256: a pre-token is as long as its unsplit run.
LONGEST = 64
# A task's distinct pre-tokens are sent on and forgotten at this number.
HELD = 200_000
RARE = pa.list_(pa.struct([("piece", pa.string()), ("times", pa.int32())]))


def document_pieces(text: str | None, path: str) -> tuple[Counter, int]:
    """Pre-token frequencies of a text, and the number of special strings in it."""
    cut = sections(text or "", path)
    found: Counter = Counter()
    for section in cut[::2]:
        found.update(byte_pieces(section, path))
    return found, len(cut) // 2


def piece_table(docs: DataFrame, path: str, text: str, held: int = HELD) -> DataFrame:
    """The distinct pre-tokens of all documents: piece, n (occurrences), tokens."""

    def sent(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["piece", "n"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(document_pieces(value.as_py(), path)[0])
                if len(counts) >= held:
                    yield sent(counts)
                    counts.clear()
        yield sent(counts)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = tokenizer(path).encode_batch(batch.column(0).to_pylist(), add_special_tokens=False)
            tokens = pa.array([len(e.ids) for e in own], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], names=["piece", "n", "tokens"])

    pieces = docs.select(F.col(text).alias("text")).mapInArrow(gathered, "piece string, n long")
    distinct = pieces.groupBy("piece").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(encoded, "piece string, n long, tokens int")


def _name(piece: str) -> str | bytes:
    """What a pre-token goes by in all tasks: itself, or the digest of a long one."""
    if 4 * len(piece) <= LONGEST:
        return piece
    body = piece.encode()
    return piece if len(body) <= LONGEST else hashlib.sha256(body).digest()


def _frequent(table: DataFrame, most: int) -> DataFrame:
    """The pre-tokens above a frequency that at most ``most`` of them reach: piece, digest, tokens.

    Frequencies are graded by their logarithm, so a few hundred counts tell where to cut.
    A pre-token above ``LONGEST`` has its digest and no piece, so the bytes are bounded too.
    """
    grade = F.floor(20 * F.ln("n")).cast("int")
    held, cut = 0, None
    for at, n in table.groupBy(grade.alias("grade")).count().orderBy(F.desc("grade")).collect():
        held += n
        if held > most:
            break
        cut = at
    long = F.octet_length("piece") > LONGEST
    return table.where(grade >= cut if cut is not None else F.lit(False)).select(
        F.when(~long, F.col("piece")).alias("piece"),
        F.when(long, F.unhex(F.sha2(F.col("piece").cast("binary"), 256))).alias("digest"),
        "tokens",
    )


def token_counts(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
    held: int = HELD,
) -> DataFrame:
    """One row per document: the key, n_bytes, n_tokens.

    ``path`` names a byte-level BPE tokenizer file. Special strings inside a text are one
    token each, as the library has them by default; no others are added. A null text counts
    as empty and has no tokens. Rows are counted one by one, also when keys are repeated or
    null; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    table = stored(piece_table(docs, path, text, held), "pre-tokens")
    sent = _frequent(table, frequent).collect()
    known = spark.sparkContext.broadcast({r.piece if r.digest is None else bytes(r.digest): r.tokens for r in sent})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = known.value
        for batch in batches:
            for start, texts in text_slices(batch.column("body")):
                totals, rare = [], []
                for value in texts:
                    found, total = document_pieces(value, path)
                    own = []
                    for piece, n in found.items():
                        count = tokens.get(_name(piece))
                        if count is None:
                            own.append({"piece": piece, "times": n})
                        else:
                            total += n * count
                    totals.append(total)
                    rare.append(own)
                columns = [batch.column(name).slice(start, len(texts)) for name in ("row", "id", "n_bytes")]
                columns += [pa.array(totals, pa.int64()), pa.array(rare, RARE)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "n_bytes", "known", "rare"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text).alias("body"),
    )
    added = StructType.fromDDL("known long, rare array<struct<piece:string,times:int>>")
    rows = rows.mapInArrow(counted, StructType([*rows.drop("body").schema.fields, *added.fields]))
    each = rows.select("row", "id", "n_bytes", "known", F.explode_outer("rare").alias("p"))
    # A document without rare pre-tokens keeps one row through the join, with a key that no
    # pre-token has (NUL before digits), each its own so that they don't meet in one task.
    piece = F.coalesce("p.piece", F.concat(F.lit("\0"), F.col("row").cast("string"))).alias("piece")
    rare = each.select("row", "id", "n_bytes", "known", piece, F.col("p.times").alias("times"))
    joined = rare.join(table.select("piece", "tokens"), "piece", "left")
    more = F.coalesce(F.col("times") * F.col("tokens"), F.lit(0)).cast("bigint")
    return (
        joined.groupBy("row")
        .agg(*[F.first(name).alias(name) for name in ("id", "n_bytes", "known")], F.sum(more).alias("more"))
        .select(F.col("id").alias(key), "n_bytes", (F.col("known") + F.col("more")).alias("n_tokens"))
    )
