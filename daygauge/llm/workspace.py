"""Shared folder for intermediate tables, and numbers that follow the size of the input."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that separate words; every other character belongs to a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Text that a Python worker has in hand at once, besides the Arrow batch it came in.
SLICE_CHARS = 1 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share.

    That is the folder of ``spark.checkpoint.dir``; where it is unset, one in the warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/work"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """Store the rows as a struct ``doc`` beside a number ``row``, which holds from then on.

    Under the struct the documents' columns keep clear of any name an operator uses.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return stored(docs.select(whole.alias("doc"), F.monotonically_increasing_id().alias("row")), name)


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of UTF-8 in a column."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def text_slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of an Arrow column, about ``chars`` characters at a time, each time with the place of the first."""
    start, held, size = 0, [], 0
    for value in texts:
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= chars:
            yield start, held
            start, held, size = start + len(held), [], 0
    if held:
        yield start, held


def parts_for(amount: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` hold ``amount``."""
    return max(least, -(-amount // each))


def same(left: Column, right: Column) -> Column:
    """Equal, or both null."""
    return left.eqNullSafe(right)


_shipped: set[str] = set()


# Texts are long: Spark's default of 64 MB for an Arrow batch takes several times that in each task.
BATCH_CONF, DEFAULT_BATCH, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Arrow batches of the session become smaller, unless their size was set to something already.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_CONF) == DEFAULT_BATCH:
        spark.conf.set(BATCH_CONF, BATCH)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
