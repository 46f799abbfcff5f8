"""Reading and writing tables.

Stage tables are directories in a columnar format (parquet by default; pass
``fmt="delta"`` where the Delta jar is on the classpath). Writes overwrite the
whole directory, which also replaces its schema; ``evolve=True`` adds
``overwriteSchema`` for formats that keep a schema log.

Never overwrite a path that the DataFrame being written still reads lazily:
write to a new stage path and switch readers to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    """One of the parquet test tables (``{sf_dir}/{name}.parquet``).

    Selecting ``columns`` here keeps the scan's ReadSchema narrow even before
    Catalyst prunes.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over the session's cores if its files are too small to give each of them a full split.

    A file of one row group is read by one task, however many cores wait.
    Dealing costs a shuffle of less than an eighth of a split
    (``spark.sql.files.maxPartitionBytes``) a core; a table above that is left as it is.
    """
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
        split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - Spark Connect shows neither its cores nor its plan's sizes
        return df
    return df.repartition(cores) if size < cores * split // 8 else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer: bool = False, **options) -> DataFrame:
    """CSV scan. An explicit schema is the default; inference is opt-in because
    it runs an extra pass over the files and guesses types per file.

    With a header, the columns of ``schema`` are found by name, in whatever
    order the file has them; columns it does not name are left out, and one
    that the header lacks is an error. The header of every file is checked.
    """
    reader = spark.read.option("header", header)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is None:
        return reader.option("inferSchema", infer).csv(path)
    if not header:
        return reader.schema(schema).csv(path)
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    there = reader.csv(path).columns
    if missing := [f.name for f in wanted.fields if f.name not in there]:
        raise ValueError(f"the header of {path} lacks {missing}")
    types = {f.name: f for f in wanted.fields}
    as_read = StructType([types.get(c, StructField(c, StringType())) for c in there])
    return reader.option("enforceSchema", False).schema(as_read).csv(path).select(*[f.name for f in wanted.fields])


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", evolve: bool = False,
                mode: str = "overwrite", partition_by: Iterable[str] | None = None,
                compression: str | None = None) -> str:
    """Persist a stage table and return its path.

    ``compression`` is the files' codec instead of the session's. Hex keys that
    are mostly distinct stay whole with snappy; zstd halves them.
    """
    writer = df.write.format(fmt).mode(mode)
    if compression is not None:
        writer = writer.option("compression", compression)
    if evolve and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
                mode: str = "overwrite", evolve: bool = False) -> str:
    """Save as a catalog table. With ``path`` the table is external and its
    files live in that (shared) folder rather than the local warehouse."""
    writer = df.write.format(fmt).mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    if evolve and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(name)
    return name


def drop_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Drop a catalog table; with ``path``, the files of an external table, too."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if path is not None:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a flow wrote for itself and no longer reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def register_views(views: Mapping[str, DataFrame]) -> list[str]:
    """Register temp views so the same frames can be queried with ``spark.sql``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
