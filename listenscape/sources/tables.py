"""The source bundle every operator reads from.

Production sources are Parquet tables (ideally partitioned by day, so the window filter prunes
partitions) read with the declared schemas; the test suite binds the same shapes to the driver's
generated tables (``listenscape.sources.testdata``).
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenscape.sources import schemas
from listenscape.sources.window import RunWindow


@dataclass
class Sources:
    streams: DataFrame
    on_demand: DataFrame
    consent: DataFrame
    episode_category: DataFrame
    stream_map: DataFrame
    schedule: DataFrame
    demographics: DataFrame
    window: RunWindow
    extra: dict[str, DataFrame] = field(default_factory=dict)


#: The column by whose day a source may be laid out.
DAY_OF = {"streams": "request_start", "on_demand": "p_listen_date", "schedule": "show_start", "demographics": "request_start"}
DAY = "day"


def write_by_day(df: DataFrame, path: str, name: str) -> None:
    """Write the source ``name`` as Parquet in a folder for each day. Days are rebalanced before: small ones fill
    one file, large ones many; a day already there is replaced. Rows without a time lie in a folder that no window reads."""
    rows = df.withColumn(DAY, F.to_date(DAY_OF[name])).hint("rebalance", F.col(DAY))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_sources(spark: SparkSession, paths: dict[str, str], window: RunWindow, by_day: Collection[str] = ()) -> Sources:
    """Read each source from Parquet with its declared schema.

    ``paths`` maps the names in ``schemas.ALL`` (and optionally ``channels``) to Parquet paths. Sources named in
    ``by_day`` lie in day folders (``write_by_day``), of which only those of the window are listed and read.
    """
    def read(name: str, schema: T.StructType) -> DataFrame:
        if name not in by_day:
            return spark.read.schema(schema).parquet(paths[name])
        with_day = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
        return spark.read.schema(with_day).parquet(paths[name]).where(window.days(DAY)).drop(DAY)

    frames = {name: read(name, schema) for name, schema in schemas.ALL.items()}
    extra = {}
    if "channels" in paths:
        extra["channels"] = read("channels", schemas.CHANNELS)
    return Sources(window=window, extra=extra, **frames)
