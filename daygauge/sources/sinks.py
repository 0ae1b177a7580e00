"""Where and how results are written; every writer starts a Spark job."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_path(spark: SparkSession) -> str:
    """A fresh path in the folder that driver and executors share.

    That is the folder of ``spark.checkpoint.dir``; where none is named, one in the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/work"
    return f"{folder}/daygauge-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own, by the file system it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def with_rank_index(top: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add a leading 0-based ``row_index`` in the given order.

    Numbering is global, so it runs in one task: give it a top-k, not a log.
    """
    index = F.row_number().over(W.orderBy(*order)) - 1
    return top.select(index.cast("bigint").alias("row_index"), "*")


def write_csv(table: DataFrame, path: str, order: Sequence[Column | str]) -> None:
    """Write a report table of a few rows as one sorted CSV file with a header."""
    (
        table.coalesce(1)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def export_ranked_csv(
    top: DataFrame, path: str, order: Sequence[Column], headings: dict[str, str] | None = None
) -> None:
    """Write a top-k with its rank index; the index column's heading is blank."""
    names = {**(headings or {}), "row_index": ""}
    ranked = with_rank_index(top, order).withColumnsRenamed(names)
    write_csv(ranked, path, order=[F.col(ranked.columns[0])])


def write_text(lines: DataFrame, path: str) -> None:
    """Write a one-column frame of a few text rows as one text file."""
    lines.coalesce(1).write.mode("overwrite").text(path)


MANIFEST_SCHEMA = "published timestamp, as_of date, folder string"


def publish(spark: SparkSession, out: str, folder: str, as_of: date) -> None:
    """Make ``folder``, which is complete, the report that readers of ``out`` find.

    The manifest only ever gets rows, one file each, which appear at once or not at all.
    """
    row = spark.range(1).select(F.current_timestamp(), F.lit(as_of), F.lit(folder))
    row.toDF("published", "as_of", "folder").coalesce(1).write.mode("append").parquet(f"{out}/manifest")


def published(spark: SparkSession, out: str, as_of: date | None = None) -> str | None:
    """The folder of the report published last, or of the last one for ``as_of``; None without one."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out}/manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if as_of:
        rows = rows.where(F.col("as_of") == F.lit(as_of))
    last = rows.orderBy(F.desc("published"), F.desc("folder")).first()
    return last.folder if last else None


def show_head(df: DataFrame, n: int = 5) -> None:
    """Print the first ``n`` rows."""
    df.show(n, truncate=False)
