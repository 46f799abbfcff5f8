"""Ingest that sets malformed rows aside instead of losing or nulling them.

Both readers parse every row once, write the result once with a reason
beside it, and return two views of what was written: the good rows, typed, and
the rejected ones with source file, raw text and reason. Every record of the
input is in exactly one of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.attendance import PUNCH_FORMAT
from tessera.session import scratch_path

_RAW, _FILE, _OK = "__raw", "__file", "__ok"


@dataclass(frozen=True)
class Split:
    """``good`` has the wanted columns; ``rejected`` has ``source_file``, ``raw`` and ``reason``."""
    good: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """``reason`` (null for good rows) and ``n_rows``."""
        good = self.good.select(F.lit(None).cast("string").alias("reason"))
        return good.unionByName(self.rejected.select("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in two folders, by whether the row is good; a reader of one does not scan the other."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(_OK).parquet(path)
    schema = StructType([*df.drop(_OK).schema.fields, StructField(_OK, df.schema[_OK].dataType)])
    return df.sparkSession.read.schema(schema).parquet(path)


def _first_reason(tests: Sequence[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in tests])


def read_csv_split(spark: SparkSession, path: str, schema: StructType | str, header: bool = True, sep: str = ",",
                   quote: str = '"', escape: str = "\\", required: Sequence[str] = (), **options) -> Split:
    """Read CSV files, a record a line; records that do not fit ``schema`` are rejected.

    A record is rejected if it has fewer or more fields than the schema, if a
    field cannot be read as its type, or if a ``required`` column is null. The
    reason is the first of these, and names the column. Fields are taken by
    position; empty ones are null. With ``header`` the files must share one
    header line, and lines equal to it are none of the records, nor are blank
    lines. Lines are read as text and parsed once, so the raw text of every
    rejected record is there as it stood in the file; a quoted field cannot
    hold a line end.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    lines = spark.read.text(path).select(F.col("value").alias(_RAW), F.col("_metadata.file_path").alias(_FILE)).where(F.length(F.trim(_RAW)) > 0)
    if header and (first := lines.select(_RAW).first()):
        lines = lines.where(F.col(_RAW) != F.lit(first[0]))
    form = {"sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE"} | {k: str(v) for k, v in options.items()}
    corrupt = StructField("__corrupt", StringType())
    as_read = StructType([*wanted.fields, corrupt])
    rows = lines.select("*", F.from_csv(_RAW, F.lit(_ddl(as_read)), form | {"columnNameOfCorruptRecord": corrupt.name}).alias("__row"))
    # A malformed record is taken apart again, one text per field, to say what is wrong with it.
    names = [f"f{i}" for i in range(len(wanted.fields))]
    texts = F.from_csv(_RAW, F.lit(", ".join(f"{n} string" for n in names)), form)
    # Fields are counted by the separators outside quotes.
    plain = F.regexp_replace(_RAW, f"{quote}([^{quote}]|{quote}{quote})*{quote}", "q") if quote else F.col(_RAW)
    fields, n = F.size(F.split(plain, f"\\Q{sep}\\E", -1)), len(wanted.fields)
    bad = F.col("__row.__corrupt").isNotNull()
    wrong = [(fields < n, "too few fields"), (fields > n, "too many fields")]
    wrong += [(F.col("__t")[name].isNotNull() & F.col("__row")[f.name].isNull(), f"{f.name} is no {f.dataType.simpleString()}")
              for name, f in zip(names, wanted.fields) if not isinstance(f.dataType, StringType)]
    reason = F.when(bad, F.coalesce(_first_reason(wrong), F.lit("malformed")))
    if required:
        reason = F.coalesce(reason, _first_reason([(F.col("__row")[c].isNull(), f"{c} is missing") for c in required]))
    marked = rows.withColumn("__t", F.when(bad, texts)).withColumn("__reason", reason).select(
        *[F.when(F.col("__reason").isNull(), F.col("__row")[f.name]).alias(f.name) for f in wanted.fields],
        F.when(F.col("__reason").isNotNull(), F.col(_RAW)).alias(_RAW), _FILE, "__reason", F.col("__reason").isNull().cast("int").alias(_OK))
    there = _written(marked, "csv-split")
    return Split(there.where(f"{_OK} = 1").select(*[f.name for f in wanted.fields]),
                 there.where(f"{_OK} = 0").select(F.col(_FILE).alias("source_file"), F.col(_RAW).alias("raw"), F.col("__reason").alias("reason")))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def split_punches(df: DataFrame, time_col: str = "punch_time", fmt: str = PUNCH_FORMAT, date_col: str = "work_date",
                  kind_col: str | None = "punch_type", kinds: Sequence[str] = ("IN", "OUT"), required: Sequence[str] = ("emp_id",),
                  source: Column | None = None) -> Split:
    """Punches whose time can be read, as ``attendance.parse_punches`` gives them, and the others.

    Rejected are rows without a ``required`` column, without a time, with one that
    does not match ``fmt``, and with a kind that is none of ``kinds``; the reason is the
    first of these. ``raw`` is the row as JSON. ``source`` names the file,
    if the frame knows it (``_metadata.file_path`` of a file scan).
    """
    stamp = F.try_to_timestamp(F.col(time_col), F.lit(fmt))
    tests = [(F.col(c).isNull(), f"{c} is missing") for c in required]
    tests += [(F.col(time_col).isNull(), f"{time_col} is missing"), (stamp.isNull(), f"{time_col} is not {fmt}")]
    if kind_col is not None:
        tests.append((~reduce(lambda a, b: a | b, [F.col(kind_col).eqNullSafe(F.lit(k)) for k in kinds]), f"{kind_col} is none of {', '.join(kinds)}"))
    parsed = F.when(stamp.isNotNull(), F.to_timestamp_ntz(F.col(time_col), F.lit(fmt)))
    reason = _first_reason(tests)
    marked = df.select(
        *[parsed.alias(c) if c == time_col else F.col(c) for c in df.columns], F.to_date(parsed).alias(date_col),
        F.when(reason.isNotNull(), F.to_json(F.struct(*df.columns))).alias(_RAW),
        (F.lit(None).cast("string") if source is None else source).alias(_FILE), reason.alias("__reason"), reason.isNull().cast("int").alias(_OK))
    there = _written(marked, "punch-split")
    return Split(there.where(f"{_OK} = 1").select(*df.columns, date_col),
                 there.where(f"{_OK} = 0").select(F.col(_FILE).alias("source_file"), F.col(_RAW).alias("raw"), F.col("__reason").alias("reason")))
