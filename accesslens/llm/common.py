"""What several operators of this package need."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from accesslens.session import new_folder

#: A word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)


def written(
    df: DataFrame, purpose: str, parent: str | None = None, **options: str
) -> DataFrame:
    """``df``, written to a new folder of the cluster's shared one and read again.

    Cuts the lineage in a way that survives a lost executor: later steps read files
    that all executors see. The folders are named ``llm-*`` and stay until the owner
    of the shared folder clears it; those below a ``parent`` go when its owner deletes it.
    """
    spark = df.sparkSession
    folder = f"{parent}/{purpose}" if parent else new_folder(spark, f"llm-{purpose}")
    df.write.options(**options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def small_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A table of a few rows that the driver has.

    Handed over as Arrow: from Python rows Spark would make it in Python workers of their own
    on the executors, which then stay there with their memory.
    """
    fields = StructType.fromDDL(schema)
    table = [dict(zip(fields.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(table, to_arrow_schema(fields)), fields)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front if ``df`` has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def required(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the columns an operator reads, so that others can't clash with its own."""
    return df.select(*columns)


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text, null as none.

    Where blanks and line ends stand singly, words are counted by them, which takes a
    small part of a pattern's time.
    """
    plain = F.trim(F.replace(text, F.lit("\n"), F.lit(" ")))
    odd = reduce(or_, [plain.contains(c) for c in ("  ", "\t", "\x0b", "\x0c", "\r")])
    blanks = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit("")))
    count = F.when(plain == "", 0).when(odd, F.regexp_count(text, F.lit(WORD)))
    return F.coalesce(count.otherwise(blanks + 1), F.lit(0)).cast("bigint")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def settled(df: DataFrame, purpose: str, *keys: str) -> DataFrame:
    """``df``, written in parts and in an order that its rows decide, not where they were read.

    Spark's trees choose the values they may cut at from rows by their place.
    """
    parts = df.repartition(shuffle_partitions(df.sparkSession), *keys)
    return written(parts.sortWithinPartitions(*keys), purpose)


#: Scores from 0 to 1 are cut into so many cells, whose sums every task gets.
CELLS = 4_096


def cumulated(
    counted: DataFrame, by: Sequence[str], sums: Sequence[str], descending: bool = False
) -> DataFrame:
    """``counted`` with each of ``sums`` up to a row's score, as ``upto_...``, and the next score.

    Rows are stored, and one for each score within ``by``. Each cell of scores is summed by
    itself, so no task has the scores of all.
    """
    ends = F.max if descending else F.min
    cell = F.floor(F.col("score") * (-CELLS if descending else CELLS))
    counted = counted.withColumn("cell", cell)
    order = Window.partitionBy(*by, "cell").orderBy(F.desc("score") if descending else "score")
    cells = counted.groupBy(*by, "cell").agg(
        *[F.sum(c).alias(c) for c in sums], ends("score").alias("start")
    )
    of_cells = Window.partitionBy(*by).orderBy("cell")
    earlier = of_cells.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *by,
        "cell",
        F.lead("start").over(of_cells).alias("later"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums],
    )
    joined = counted.join(F.broadcast(cells), [*by, "cell"])
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumns(
        {f"upto_{c}": F.col(f"before_{c}") + F.sum(c).over(upto) for c in sums}
        | {"next": F.coalesce(F.lead("score").over(order), "later")}
    ).drop("cell", "later", *[f"before_{c}" for c in sums])
