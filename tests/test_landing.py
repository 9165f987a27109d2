"""Logs landed by a column, and files of uneven sizes: what is read, and where rows go."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from accesslens.sources.tables import land_clustered
from accesslens.sources.text import read_lines, write_lines

FILES = 8


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """A third of the rows from one host, the others from 4,000; even numbers only."""
    path = f"{tmp_path_factory.mktemp('landed')}/logs"
    i = F.col("id")
    number = F.format_string("h%05d", (i * 7919 % 4000) * 2)
    host = F.when(i % 3 == 0, "hot").when(i % 1000 == 1, None).otherwise(number)
    logs = spark.range(0, 200_000, 1, 8).select(
        host.alias("host"),
        F.timestamp_seconds(i % 86_400).cast("timestamp_ntz").alias("time"),
        (i % 4).cast("int").alias("status"),
        "id",
    )
    land_clustered(logs, path, files=FILES, distinct=4000)
    return logs, path


def _scan(df):
    """Rows that a query read, after it ran: those of row groups that were not skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        plan = plan.children().head() if plan.children().size() else plan.executedPlan()
    return plan.metrics().apply("numOutputRows").value()


def _rows_read(df):
    df.collect()
    return _scan(df)


def test_nothing_is_lost(spark, landed):
    logs, path = landed
    assert spark.read.parquet(path).exceptAll(logs).count() == 0
    assert spark.read.parquet(path).count() == logs.count()


def test_row_groups_of_other_hosts_are_skipped(spark, landed):
    logs, path = landed
    found = spark.read.parquet(path).filter("host = 'h00100'")
    assert found.count() == logs.filter("host = 'h00100'").count() > 0
    assert _rows_read(spark.read.parquet(path).filter("host = 'h00100'")) < logs.count() / 4


def test_a_host_that_is_not_there_reads_nothing(spark, landed):
    _, path = landed  # an odd number lies between the ends of a row group
    assert _rows_read(spark.read.parquet(path).filter("host = 'h00101'")) == 0


def test_row_groups_have_bloom_filters(spark, landed):
    _, path = landed
    jvm = spark.sparkContext._jvm
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for file in spark.read.parquet(path).inputFiles():
        name = jvm.org.apache.hadoop.fs.Path(file)
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(name, configuration)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        for block in reader.getFooter().getBlocks():
            offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in block.getColumns()}
            stored = offsets.pop("host") >= 0
            values = [c for c in block.getColumns() if c.getPath().toDotString() == "host"]
            # where all values are in a dictionary, the dictionary tells the same
            assert stored or values[0].hasDictionaryPage()
            assert all(offset < 0 for offset in offsets.values())
        reader.close()


def test_a_hot_host_is_spread_over_files(spark, landed):
    _, path = landed
    parts = spark.read.parquet(path).groupBy(F.input_file_name().alias("file"))
    rows = parts.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("host") == "hot").alias("hot"))
    rows = rows.collect()
    assert sum(r["hot"] > 0 for r in rows) >= 2
    assert max(r["n"] for r in rows) < 2 * 200_000 / FILES


def test_no_logs_and_other_columns(spark, tmp_path):
    none = spark.createDataFrame([], "host string, status int")
    land_clustered(none, f"{tmp_path}/none")
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0
    rows = spark.createDataFrame([("a", 2), (None, 1), ("b", None)], none.schema)
    land_clustered(rows, f"{tmp_path}/some", by="status")
    assert Counter(spark.read.parquet(f"{tmp_path}/some").collect()) == Counter(rows.collect())


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    folder = f"{tmp_path_factory.mktemp('uneven')}/logs"
    lines = spark.range(100_000).select(F.sha2(F.col("id").cast("string"), 256).alias("value"))
    write_lines(lines.coalesce(1), folder, compression="gzip")
    write_lines(lines.limit(60).repartition(6), folder, compression="gzip", mode="append")
    write_lines(lines.coalesce(1), folder, mode="append")  # large, but can be split
    expected = Counter({r[0]: 2 for r in lines.collect()})
    return folder, expected + Counter(r[0] for r in lines.limit(60).collect())


def test_only_large_compressed_files_are_shuffled(spark, uneven):
    folder, expected = uneven
    lines = read_lines(spark, folder, large=1 << 20)
    assert Counter(r[0] for r in lines.collect()) == expected
    text = lines._jdf.queryExecution().executedPlan().toString()
    assert text.split("Final Plan")[-1].split("Initial Plan")[0].count("REBALANCE_PARTITIONS") == 1
    size, name = F.col("_metadata.file_size"), F.col("_metadata.file_name")
    large = spark.read.text(folder).filter((size > 1 << 20) & name.endswith(".gz"))
    assert large.select("value").rdd.getNumPartitions() == 1  # only that file is opened


@pytest.mark.parametrize("large", [0, 1 << 40])
def test_all_or_no_files_are_large(spark, uneven, large):
    folder, expected = uneven
    assert Counter(r[0] for r in read_lines(spark, folder, large=large).collect()) == expected


def test_the_large_file_is_parsed_by_several_tasks(spark, uneven):
    folder, _ = uneven
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        lines = read_lines(spark, folder, glob="*.gz", large=1 << 20)
        whole = read_lines(spark, folder, glob="*.gz")
        assert lines.rdd.getNumPartitions() >= whole.rdd.getNumPartitions() + 2
    finally:
        spark.conf.set(key, before)
