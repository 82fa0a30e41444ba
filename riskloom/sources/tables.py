"""Scans, small tables from rows, presence checks and catalogue tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan a folder on any file system Spark can reach (``file:``, ``hdfs:``, ``s3a:``)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred by an extra pass."""
    reader = spark.read.option("header", "true")
    reader = reader.option("inferSchema", "true") if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_dated_files(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """Read files that carry their date in the name, ``transactions_2025-03-01.parquet``, as one table."""
    return read_table(spark, pattern, schema)


def rows_to_table(
    spark: SparkSession, rows: Iterable, schema: T.StructType | str
) -> DataFrame:
    """A small reference table from tuples, rows or dicts, with its types stated."""
    return spark.createDataFrame(list(rows), schema)


def aml_rules(spark: SparkSession) -> DataFrame:
    """The compliance rules table with its single transaction-limit rule."""
    # The one published rule.
    rule = (
        "RULE-001",
        "Transaction Limit Rule",
        {"transaction_limit": "10000"},
        dt.date(2025, 1, 1),
        "v1",
        "ComplianceTeam",
        dt.datetime(2025, 1, 1),
    )
    return rows_to_table(spark, [rule], schemas.AML["aml_compliance_rules"])


def read_aml_feeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The eight partitioned feeds below one root folder."""
    return {
        name: read_table(spark, f"{root.rstrip('/')}/{name}", schema)
        for name, schema in schemas.AML.items()
        if name != "aml_compliance_rules"
    }


def latest_partition(df: DataFrame, column: str = "dt") -> DataFrame:
    """Rows of the newest partition. The maximum is a scalar subquery, so files are pruned at run time."""
    return df.filter(F.col(column) == df.select(F.max(column)).scalar())


def partition_values(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """The values of a partition column, from the names of the table's folders: no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    pairs = [s.getPath().getName().split("=", 1) for s in found if s.isDirectory()]
    own = [names.unescapePathName(p[1]) for p in pairs if len(p) == 2 and names.unescapePathName(p[0]) == column]
    return [None if value == names.DEFAULT_PARTITION_NAME() else value for value in own]


def _newest(spark: SparkSession, values: Sequence[str | None], kind: T.DataType):
    """The largest value, compared as the column's type; the null partition is never the newest."""
    rows = spark.createDataFrame([(value,) for value in values], "value string")
    return rows.select(F.max(F.col("value").cast(kind))).first()[0]


def newest_partition(spark: SparkSession, path: str, column: str = "dt", schema: T.StructType | None = None) -> DataFrame:
    """Rows of the newest partition of a folder, chosen from the folder names, so only its files are opened.

    ``column`` is the first partition column. A table without partitions has no newest one: no rows.
    """
    table = read_table(spark, path, schema)
    newest = _newest(spark, partition_values(spark, path, column), table.schema[column].dataType)
    return table.filter(F.col(column) == F.lit(newest))


def newest_table_partition(spark: SparkSession, table: str, column: str = "dt") -> DataFrame:
    """Rows of the newest partition of a catalogue table, chosen from the catalogue."""
    rows = spark.table(table)
    parts = [dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    values = [p[column] for p in parts if p[column] != names.DEFAULT_PARTITION_NAME()]
    newest = _newest(spark, [names.unescapePathName(x) for x in values], rows.schema[column].dataType)
    return rows.filter(F.col(column) == F.lit(newest))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system the path belongs to, not the driver's local disk."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on the file system it belongs to; one that is gone is no error."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def remove_uri(spark: SparkSession, uri: str) -> None:
    """Remove a file that is named as in the file metadata, where odd characters are escaped."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, False)


def move_folders(spark: SparkSession, source: str, target: str) -> None:
    """Move every folder below ``source`` to the same name below ``target``, over the one that is there.

    A folder is complete in one place or the other at any time, so the call may be repeated after a failure.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target))
    for status in files.listStatus(path(source)):
        if status.isDirectory():
            into = path(target, status.getPath().getName())
            files.delete(into, True)
            if not files.rename(status.getPath(), into):
                raise OSError(f"cannot move {status.getPath()} to {into}")


def move_files(spark: SparkSession, source: str, target: str, leave_out: str, only: str = "") -> None:
    """Move every file below ``source`` to the same folder below ``target``; path parts that begin with ``leave_out`` go into its name.

    With ``only``, those below this folder of ``source``.
    A file is in one place or the other at any time, so the call may be repeated after a failure.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    base = files.makeQualified(path(source)).toString().rstrip("/")
    found = files.listFiles(path(f"{base}/{only}"), True)
    while found.hasNext():
        file = found.next().getPath()
        parts = file.toString().removeprefix(base).strip("/").split("/")
        if parts[-1].startswith(("_", ".")):
            continue
        name = "-".join([*(p.removeprefix(leave_out) for p in parts[:-1] if p.startswith(leave_out)), parts[-1]])
        into = path("/".join([target.rstrip("/"), *(p for p in parts[:-1] if not p.startswith(leave_out)), name]))
        files.mkdirs(into.getParent())
        if not files.rename(file, into):
            raise OSError(f"cannot move {file} to {into}")


def partition_folder(spark: SparkSession, path: str, column: str, value: str | None) -> str:
    """The folder of a partition value as Spark names it."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{path.rstrip('/')}/{names.getPartitionPathString(column, value)}"


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """Raise when an input is absent instead of finishing quietly without work."""
    missing = [path for path in paths if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")


def register_external(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """Declare a Parquet folder as a catalogue table and load its partitions."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS (compression 'snappy') {partitioned} LOCATION '{location}'"
    )
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def register_marketplace(spark: SparkSession, root: str, prefix: str = "") -> dict[str, DataFrame]:
    """Declare the five marketplace folders below ``root`` as catalogue tables."""
    return {
        name: register_external(
            spark, f"{prefix}{table}", schemas.MARKETPLACE[name], f"{root.rstrip('/')}/{name}", schemas.PARTITIONS[name]
        )
        for name, table in schemas.MARKETPLACE_CATALOGUE.items()
    }
