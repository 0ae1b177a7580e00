"""Blocks of documents that ask corpus-wide tables.

An operator that needs, for every piece of a text, a value from a corpus-wide table would
move a row for each piece of each document to join them. Here documents are dealt to blocks
of some MB, once. A block packs its different pieces as numbers in ascending order, one slice
for each part of the table, and gets the values back in the same order. The blocks are a
bucketed table, so the documents themselves are shuffled only once, whatever follows. Blocks
have numbers that Spark hashes to one bucket each, so no bucket is empty or has several.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygauge.llm.workspace import parts_for, text_bytes, work_path

BLOCK_BYTES = 16 << 20
# Text that is worked on at once.
BATCH_BYTES = 2 << 20
BATCH_ROWS = 1 << 14


_BITS_32 = (1 << 32) - 1


def _times(x: Column, factor: int) -> Column:
    """Product of numbers of 32 bits, modulo 2**32; by halves, as 64 bits would overflow."""
    high = (x * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF))
    return (x * F.lit(factor & 0xFFFF) + high * F.lit(1 << 16)).bitwiseAND(F.lit(_BITS_32))


def _turned(x: Column, bits: int) -> Column:
    """Numbers of 32 bits, rotated to the left."""
    low = x.bitwiseAND(F.lit((1 << (32 - bits)) - 1))
    return F.shiftleft(low, bits).bitwiseOR(F.shiftright(x, 32 - bits))


def _unshifted(x: Column, bits: int) -> Column:
    """The y of 32 bits with y ^ (y >> bits) = x."""
    found = x
    for _ in range(31 // bits):
        found = x.bitwiseXOR(F.shiftright(found, bits))
    return found


def hashed_to(number: Column) -> Column:
    """The int whose ``hash`` is ``number``, from 0 on: Spark's Murmur3 of an int, step by step backwards."""
    inverse = {factor: pow(factor, -1, 1 << 32) for factor in (0xC2B2AE35, 0x85EBCA6B, 0x1B873593, 0xCC9E2D51, 5)}
    steps = [
        lambda x: _unshifted(x, 16),
        lambda x: _times(x, inverse[0xC2B2AE35]),
        lambda x: _unshifted(x, 13),
        lambda x: _times(x, inverse[0x85EBCA6B]),
        lambda x: _unshifted(x, 16).bitwiseXOR(F.lit(4)),
        lambda x: (x + F.lit((1 << 32) - 0xE6546B64)).bitwiseAND(F.lit(_BITS_32)),
        lambda x: _times(x, inverse[5]),
        lambda x: _turned(x, 32 - 13).bitwiseXOR(F.lit(42)),
        lambda x: _times(x, inverse[0x1B873593]),
        lambda x: _turned(x, 32 - 15),
        lambda x: _times(x, inverse[0xCC9E2D51]),
        lambda x: F.when(x >= F.lit(1 << 31), x - F.lit(1 << 32)).otherwise(x),
    ]
    # A step reads its number more than once; as an array's element it is computed once.
    found = F.array(number.cast("bigint"))
    for step in steps:
        found = F.transform(found, step)
    return found[0].cast("int")


def in_blocks(rows: DataFrame, body: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Store ``rows``, which have a number ``row``, with a column ``block`` and bucketed by it.

    A block has about ``block_bytes`` of text, more only where a single text is longer.
    Returns the table and the number of blocks. The table's name is dropped at once: its files
    stay in the shared folder, and nothing is left in the catalog.
    """
    blocks = parts_for(text_bytes(rows, body), block_bytes)
    dealt = rows.withColumn("block", hashed_to(F.pmod(F.xxhash64("row"), F.lit(blocks))))
    name = f"blocks_{uuid.uuid4().hex}"
    writer = dealt.repartition(blocks, "block").write.bucketBy(blocks, "block").option("compression", "zstd")
    writer.option("path", work_path(rows.sparkSession, "blocks")).saveAsTable(name)
    table = rows.sparkSession.table(name)
    # The relation is resolved, with its buckets; dropping an external table leaves its files.
    table.schema  # noqa: B018
    rows.sparkSession.sql(f"DROP TABLE {name}")
    return table, blocks


def batches(
    table: pa.Table, body: str, batch_bytes: int = BATCH_BYTES, batch_rows: int = BATCH_ROWS
) -> Iterator[tuple[int, list[str]]]:
    """The texts of a block, a few MB at a time, each time with the number of the first row."""
    start, held, size = 0, [], 0
    for text in (value.as_py() for value in table.column(body)):
        held.append(text)
        size += len(text)
        if size >= batch_bytes or len(held) == batch_rows:
            yield start, held
            start, held, size = start + len(held), [], 0
    if held:
        yield start, held


def planes(values: np.ndarray) -> bytes:
    """Values byte by byte, all first bytes before all second ones: close values compress well so."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(packed: pa.Scalar, dtype) -> np.ndarray:
    flat = np.frombuffer(packed.as_buffer(), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(dtype).ravel()


def ascending(numbers: np.ndarray) -> bytes:
    """64-bit numbers in ascending order, as the steps between them."""
    return planes(np.diff(numbers, prepend=np.int64(0)))


def from_ascending(packed: pa.Scalar) -> np.ndarray:
    return np.cumsum(from_planes(packed, np.int64))
