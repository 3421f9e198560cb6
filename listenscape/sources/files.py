"""File sources and sinks: CSV with a declared schema (S8, S9), JSON mapping documents.

Writes go under the session's shared checkpoint folder (``spark.checkpoint.dir``) or a path the
caller passes; a failed write raises instead of returning a status string.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenscape.session import ensure_checkpoint_dir

#: What stands for NULL in files of ``write_csv``; a text of just these two characters reads as NULL.
NULL_MARK = "\\N"


def write_csv(df: DataFrame, path: str) -> str:
    """Header row, no index column; overwrite. Raises on failure. NULL is written as ``NULL_MARK``, the empty
    string as two quotes, values with line ends quoted, and blanks at the ends of a value are kept."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", NULL_MARK).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null_values: tuple[str, ...] = ("", "NA"),
             multi_line: bool = False) -> DataFrame:
    """Header row, declared schema (ids stay strings). ``null_values`` read as NULL: by default the empty field
    and ``NA``, as in files of other writers; for files of ``write_csv``, ``(NULL_MARK,)``. ``multi_line``: values may
    hold line ends, and a file is read by one task; without it large files are read in splits."""
    rows = (
        spark.read.option("header", True)
        .option("nullValue", null_values[0])
        .option("escape", '"')
        .option("multiLine", multi_line)
        .schema(schema)
        .csv(path)
    )
    rest = list(null_values[1:])
    if not rest:
        return rows

    def value(f: T.StructField):
        c = F.col(f"`{f.name}`")
        return F.when(~c.isin(rest), c).alias(f.name) if isinstance(f.dataType, T.StringType) else c

    return rows.select(*[value(f) for f in schema.fields])


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def csv_roundtrip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as CSV to shared storage and read it back with its own schema."""
    path = write_csv(df, scratch_path(spark, name))
    return read_csv(spark, path, df.schema, (NULL_MARK,), multi_line=True)


def read_mapping_documents(spark: SparkSession, root: str, max_bytes: int = 64 << 20) -> dict[str, str]:
    """Whole files below ``root`` (or the file ``root``) by path. The documents are configuration and go to the driver:
    more than ``max_bytes`` of them raise."""
    rows = (spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(root)
            .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), "value"))
    size = rows.select("path", "size").distinct().agg(F.sum("size")).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{size} bytes of mapping documents below {root}, more than {max_bytes}")
    return {unquote(r.path): r.value for r in rows.collect()}
