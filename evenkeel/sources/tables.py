"""Reading and writing tables: CSV, columnar files, versioned and catalog tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel import schemas

FORMAT = "parquet"
SNAPSHOT = "snapshot_id"
WIDER = {("int", "bigint"), ("int", "double"), ("bigint", "double"), ("float", "double")}


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = schemas.CREDIT
) -> DataFrame:
    """Header CSV files under a declared schema; several paths are stacked.

    A declared schema saves the inference pass over the data. Columns are taken
    by position, so the header is checked against the schema.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(paths)


def read(spark: SparkSession, path: str, merge_schema: bool = False, fmt: str = FORMAT) -> DataFrame:
    """A columnar table; ``merge_schema`` gives old rows null in newer columns."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def stack(frames: Sequence[DataFrame], same_columns: bool = True) -> DataFrame:
    """Rows of all frames, aligned by name; absent columns may become null."""
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=not same_columns), frames
    )


def read_lineage(spark: SparkSession, source_data: str, fmt: str = FORMAT) -> DataFrame:
    """The table or tables named in a comma-separated lineage tag, stacked."""
    paths = [p.strip() for p in source_data.split(",") if p.strip()]
    if not paths:
        raise ValueError("the lineage tag names no path")
    return stack([read(spark, p, fmt=fmt) for p in paths], same_columns=False)


def spread_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gather rows of one output folder into few files.

    The rebalance hint lets adaptive execution split a folder that holds most
    of the rows over several tasks, where ``repartition`` would not.
    """
    return df.hint("rebalance", *columns)


def overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = FORMAT
) -> None:
    """Replace a table and its schema."""
    if partition_by:
        df = spread_by(df, partition_by)
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
    fmt: str = FORMAT,
) -> None:
    """Add rows to a table.

    With ``schema`` the rows are cast to it, so that files of one table never
    disagree about a type. New columns are allowed; read with ``merge_schema``.
    """
    if schema is not None:
        df = schemas.conform(df, schema)
    if partition_by:
        df = spread_by(df, partition_by)
    writer = df.write.format(fmt).mode("append")
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = FORMAT) -> None:
    """Replace just the partitions present in ``df``: repeating a load is harmless."""
    (
        spread_by(df, partition_by)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def partition_files(spark: SparkSession, path: str, column: str, value: str) -> dict[str, set[str]]:
    """Folders of partitions with ``column = value`` one level below others, and their files."""
    jvm = spark.sparkContext._jvm
    named = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/*/{column}={named}/*")
    files = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found: dict[str, set[str]] = {}
    for status in files.globStatus(pattern) or []:
        file = status.getPath()
        found.setdefault(file.getParent().toString(), set()).add(file.getName())
    return found


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def append_catalog(df: DataFrame, table: str, fmt: str = FORMAT) -> None:
    df.write.format(fmt).mode("append").saveAsTable(table)


def write_snapshot(df: DataFrame, path: str, snapshot_id: int) -> None:
    """Store one numbered version of a table next to the earlier ones."""
    replace_partitions(df.withColumn(SNAPSHOT, F.lit(snapshot_id)), path, [SNAPSHOT])


def latest_snapshot(table: DataFrame) -> DataFrame:
    """One row with the newest version; reads the partition column only."""
    return table.agg(F.max(SNAPSHOT).alias(SNAPSHOT))


def read_snapshot(spark: SparkSession, path: str, snapshot_id: int | None = None) -> DataFrame:
    """A pinned version, or the newest one; other versions' files are pruned."""
    table = read(spark, path)
    wanted: Column = (
        F.lit(snapshot_id) if snapshot_id is not None else latest_snapshot(table).scalar()
    )
    return table.where(F.col(SNAPSHOT) == wanted)


def publish_version(df: DataFrame, path: str, version: int) -> None:
    """Store a numbered version of a table and then make it known by a one-row marker.

    Until the marker is written nobody reads the files, so a writer that fails leaves
    the table as it was. Publishing a number again replaces its marker; files that no
    marker names any longer stay behind for readers that hold them.
    """
    spark = df.sparkSession
    folder = f"{version:012d}-{uuid.uuid4().hex[:12]}"
    df.write.format(FORMAT).save(f"{path}/data/{folder}")
    marker = spark.createDataFrame([(version, folder, df.schema.json())], schemas.MANIFEST)
    replace_partitions(marker, f"{path}/manifest", ["version"])


def published_versions(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, schema, version)`` of all published versions; no data file is touched."""
    return spark.read.schema(schemas.MANIFEST).format(FORMAT).load(f"{path}/manifest")


def newest_version(spark: SparkSession, path: str) -> int | None:
    return published_versions(spark, path).agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A pinned version, or the newest one: only its own files, under its own schema."""
    known = published_versions(spark, path)
    wanted = newest_version(spark, path) if version is None else version
    found = known.where(F.col("version") == F.lit(wanted)).take(1)
    if not found:
        raise ValueError(f"{path} has no published version" + (f" {version}" if version is not None else ""))
    declared = T.StructType.fromJson(json.loads(found[0]["schema"]))
    return spark.read.schema(declared).format(FORMAT).load(f"{path}/data/{found[0].folder}")


def schema_history(spark: SparkSession, path: str) -> DataFrame:
    """``(version, column, change, old_type, new_type)``: what each version changed from the one before.

    ``widened`` is a change that older rows can be read under (int to long or double,
    float to double, anything to string); other changes of type are ``retyped``. Made
    from the markers: a row per version reaches the driver.
    """
    known = sorted(published_versions(spark, path).collect(), key=lambda row: row.version)
    changes = []
    for before, after in zip(known, known[1:]):
        old, new = (
            {f.name: f.dataType.simpleString() for f in T.StructType.fromJson(json.loads(row["schema"]))}
            for row in (before, after)
        )
        changes += [(after.version, c, "added", None, new[c]) for c in new if c not in old]
        changes += [(after.version, c, "missing", old[c], None) for c in old if c not in new]
        for c in old:
            if c in new and old[c] != new[c]:
                kind = "widened" if (old[c], new[c]) in WIDER or new[c] == "string" else "retyped"
                changes.append((after.version, c, kind, old[c], new[c]))
    kind = "version long, column string, change string, old_type string, new_type string"
    return spark.createDataFrame(changes, kind)


def recreate_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    create_database(spark, name, location)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def parse_json(df: DataFrame, column: str, schema: T.StructType | T.DataType) -> DataFrame:
    """Fields of a JSON text column as columns; unparsable text gives nulls."""
    return df.withColumn("_parsed", F.from_json(column, schema)).select("_parsed.*")


def as_json(df: DataFrame, name: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row, next to the ``keep`` columns."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*rest)).alias(name))


def read_json_document(spark: SparkSession, path: str, schema: T.DataType) -> DataFrame:
    """JSON documents that span lines, one row per file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", schema).alias("document"))
