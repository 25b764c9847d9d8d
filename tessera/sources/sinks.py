"""Sinks: base tables, the panel and predictions as Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schemas import PREDICTION, TABLES
from .shared import exists, moved, placed, removed, settings

ROW_GROUP = 500_000
OPEN_FILES = 32  # a task with more years sorts the rest of its rows


def new_rows(df: DataFrame, held: DataFrame | None, keys: list[str] | None) -> DataFrame:
    """Rows to append: all of them, or with keys those whose keys aren't held yet, one of each: the
    one with the smallest hash of its columns."""
    if not keys:
        return df
    one = df.groupBy(*keys).agg(F.min(F.struct(F.xxhash64(*df.columns).alias("__hash"), *df.columns)).alias("__row"))
    df = one.select(*[F.col(f"__row.{c}").alias(c) for c in df.columns])
    if held is None:
        return df
    held = held.select(*[F.col(k).alias(f"__held_{i}") for i, k in enumerate(keys)])
    return df.join(held, [F.col(k).eqNullSafe(F.col(f"__held_{i}")) for i, k in enumerate(keys)], "left_anti")  # a null key is a key


def conforming(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns of a schema in their order, by name. ValueError if it lacks one, has
    others or has other types: nothing is cast, which would hide a file that was read wrongly."""
    got, want = ({f.name: f.dataType.simpleString() for f in x} for x in (df.schema, schema))
    if got != want:
        wrong = sorted({c for c in {*got, *want} if got.get(c) != want.get(c)})
        raise ValueError("other columns than the table's: " + ", ".join(f"{c} ({got.get(c, 'missing')}, not {want.get(c, 'in the table')})" for c in wrong))
    return df.select(*[F.col(f"`{f.name}`") for f in schema])


def append_table(df: DataFrame, name: str, folder: str, dedup_keys: list[str] | None = None) -> str:
    """Appends to a base table, which is made if it isn't there; columns go by name. Other table
    names or types raise ValueError. Without dedup_keys, a second call appends the rows again."""
    if name not in TABLES.values():
        raise ValueError(f"table name must be one of {sorted(TABLES.values())}")
    path, spark = f"{folder}/{name}", df.sparkSession
    held = spark.read.parquet(path) if exists(spark, path) else None
    if held is not None:
        df = conforming(df, held.schema)
    new_rows(df, held, dedup_keys).write.mode("append").parquet(path)
    return path


def staged(df: DataFrame, name: str, folder: str) -> str:
    """Writes rows for a base table beside it, where no reader looks, and returns the path."""
    path = f"{folder}/_staged/{name}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
    except Exception:
        removed(df.sparkSession, path)
        raise
    return path


def load_batch(df: DataFrame, name: str, folder: str, batch: int | str, schema: T.StructType | None = None, dedup_keys: list[str] | None = None) -> bool:
    """Appends df to a base table as a batch that is there as a whole or not at all: it is written
    beside the table and comes to it by one renaming. A batch that the table has already is left
    out (False), so a load that is repeated, or goes on after it was interrupted, gives the table
    once. Columns must be those of `schema` (else of the table), by name and type."""
    if name not in TABLES.values():
        raise ValueError(f"table name must be one of {sorted(TABLES.values())}")
    spark, path = df.sparkSession, f"{folder}/{name}"
    if exists(spark, f"{path}/batch={batch}"):
        return False
    held = base_table(spark, folder, name) if exists(spark, path) else None
    if schema is not None or held is not None:
        df = conforming(df, schema or held.schema)
    return commit_batch(spark, staged(new_rows(df, held, dedup_keys), name, folder), name, folder, batch)


def commit_batch(spark: SparkSession, path: str, name: str, folder: str, batch: int | str) -> bool:
    """Makes staged rows a batch of a base table; False, and they go, if it has that batch."""
    if moved(spark, path, f"{folder}/{name}/batch={batch}"):
        return True
    removed(spark, path)
    return False


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of all batches of a base table that was loaded by batches."""
    return spark.read.parquet(f"{folder}/{name}").drop("batch")


def create_bucketed(spark: SparkSession, table: str, schema: T.StructType, path: str, buckets: int, key: str = "LOAN_SEQUENCE_NUMBER") -> None:
    """A catalog table in `buckets` buckets by loan, made if it isn't there; files that lie at path
    already belong to it. Tables with the same number of buckets join by loan without a shuffle:
    it is paid once, when rows are appended."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")


def append_bucketed(df: DataFrame, table: str, buckets: int, key: str = "LOAN_SEQUENCE_NUMBER") -> None:
    """Appends to a bucketed table, a file for each bucket: rows are dealt to tasks as to buckets."""
    spark = df.sparkSession
    conforming(df, spark.table(table).schema).repartition(buckets, key).write.insertInto(table)


def write_table(df: DataFrame, path: str) -> None:
    """Overwrites a table: exports and the unemployment series."""
    df.write.mode("overwrite").parquet(path)


def write_panel(df: DataFrame, path: str, by_year: bool = True, row_group: int = ROW_GROUP, groups_a_file: int = 8, task_bytes: int = 1 << 29) -> None:
    """The panel: snappy, row groups of row_group rows, by reporting year so that the time split
    prunes. Rows are rebalanced by year before: a year goes to as many tasks as its shuffled size
    needs (task_bytes each), and no task writes a file in every year. A task
    keeps a file open for each of its years (OPEN_FILES at most) and doesn't sort its rows by year,
    so it holds row groups and not all of its rows. Only a file's last row group has fewer rows."""
    spark = df.sparkSession
    if by_year:
        df = df.withColumn("REPORTING_YEAR", F.substring("MONTHLY_REPORTING_PERIOD", 1, 4)).hint("rebalance", "REPORTING_YEAR")
    else:
        df = df.hint("rebalance")
    out = df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", row_group * groups_a_file)
    out = out.option("parquet.block.row.count.limit", row_group).option("parquet.block.size", 1 << 30)
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes), "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}
    if by_year:  # else the joins behind df would be merged to tasks of task_bytes, too
        conf["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    with settings(spark, conf):
        (out.partitionBy("REPORTING_YEAR") if by_year else out).parquet(path)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """The row groups of a Parquet table as its footers tell: file, row_group, n_rows, bytes. No
    column is read; the driver opens one footer after the other."""
    jvm, conf, rows = spark._jvm.org.apache.parquet.hadoop, spark._jsc.hadoopConfiguration(), []
    for file in spark.read.parquet(path).inputFiles():
        reader = jvm.ParquetFileReader.open(jvm.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)), conf))
        try:
            rows += [(file, i, b.getRowCount(), b.getTotalByteSize()) for i, b in enumerate(reader.getRowGroups())]
        finally:
            reader.close()
    return spark.createDataFrame(rows, "file string, row_group int, n_rows long, bytes long")


def stored_rows(spark: SparkSession, path: str, condition: str = "true") -> DataFrame:
    """n_rows of a Parquet table, of the partitions that `condition` (on partition columns) names,
    from the files' footers: the count is pushed into the scan. The query belongs to a session of
    its own, whose scans take aggregates."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).where(condition).agg(F.count("*").alias("n_rows"))


def prediction_ddl(table: str = "prediction", path: str | None = None) -> str:
    """DDL of the prediction table in a catalog, kept at path or in the warehouse."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PREDICTION)
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}, run_id int) USING parquet PARTITIONED BY (run_id)" + (f" LOCATION '{path}'" if path else "")


def create_predictions(spark: SparkSession, table: str = "prediction", path: str | None = None) -> None:
    """Makes the prediction table if it isn't there; runs that lie at path already belong to it."""
    spark.sql(prediction_ddl(table, path))
    if path:
        files, place = placed(spark, path)
        files.mkdirs(place)
        spark.sql(f"MSCK REPAIR TABLE {table}")


def insert_predictions(df: DataFrame, run_id: int, table: str = "prediction") -> None:
    """Predictions of a run into the catalog's table. A run that is inserted again takes the place
    of its earlier rows, so a repeated job adds nothing twice."""
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in PREDICTION])
    df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = {int(run_id)}) SELECT * FROM {{rows}}", rows=rows)


def read_predictions(spark: SparkSession, run_id: int | None = None, table: str = "prediction") -> DataFrame:
    """What evaluation needs of the predictions of one run or all: the scan reads these columns only."""
    rows = spark.table(table)
    return (rows if run_id is None else rows.where(F.col("run_id") == run_id)).select("MONTHLY_REPORTING_PERIOD", "DELINQUENT", "DELINQ_PROB")


def export_table(spark: SparkSession, name: str, folder: str, path: str) -> None:
    """A base table as a Parquet export, taken through a view of its name that goes afterwards."""
    spark.read.parquet(f"{folder}/{name}").createOrReplaceTempView(name)
    try:
        write_table(spark.sql(f"SELECT * FROM {name}"), path)
    finally:
        spark.catalog.dropTempView(name)
