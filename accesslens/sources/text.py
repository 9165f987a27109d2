"""Log files as lines."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ends of names of compressed files that cannot be split.
WHOLE = (".gz", ".deflate", ".snappy", ".lz4", ".zst")


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = None,
    recursive: bool = False,
    partitions: int | None = None,
    large: int | None = None,
) -> DataFrame:
    """``value``: the lines of plain or compressed text files.

    ``paths`` may hold wildcards; ``glob`` filters file names (``*.gz``) and
    ``recursive`` goes into subfolders. A gzip file cannot be split, so it is
    read by one task; give ``partitions`` to spread the lines of a few large
    ones before they are parsed. Many files need no spreading. For files of uneven
    sizes give ``large``: the lines of compressed files of more bytes than that are
    spread, in parts of the size adaptive execution is set to, and all other files
    are read in place. Which file is which Spark knows when it lists them.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(paths if isinstance(paths, str) else list(paths))
    if large is not None:
        spread, rest = lines.filter(_is_large(large)), lines.filter(~_is_large(large))
        lines = spread.select("value").hint("rebalance").unionByName(rest.select("value"))
    lines = lines.select("value")
    return lines.repartition(partitions) if partitions else lines


def _is_large(size: int) -> Column:
    """Whether a line's file is larger and cannot be split; known for each file before it is read."""
    name = F.col("_metadata.file_name")
    whole = reduce(or_, [name.endswith(end) for end in WHOLE])
    return (F.col("_metadata.file_size") > size) & whole


def write_lines(
    lines: DataFrame, path: str, compression: str = "none", mode: str = "errorifexists"
) -> None:
    """Write column ``value`` as text, one file per partition of the input."""
    lines.select("value").write.mode(mode).option("compression", compression).text(path)
