"""Sources, sinks and the incremental runner."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.operators import attendance
from tessera.plans import derived as D
from tessera.session import scratch_path
from tessera.sources import io


def test_stage_overwrite_replaces_schema(spark):
    path = scratch_path(spark, "t-stage")
    nation = io.read_table(spark, SF_SMALL, "nation")
    io.write_stage(nation.select("n_nationkey"), path)
    io.write_stage(nation, path, evolve=True)
    assert io.read_stage(spark, path).columns == nation.columns


def test_csv_explicit_schema_and_inference(spark):
    path = io.write_csv(io.read_table(spark, SF_SMALL, "nation"), scratch_path(spark, "t-csv"))
    typed = io.read_csv(spark, path, schema="n_nationkey INT, n_name STRING, n_regionkey INT")
    inferred = io.read_csv(spark, path, infer=True)
    assert dict(typed.dtypes)["n_nationkey"] == "int" and dict(inferred.dtypes)["n_nationkey"] == "int"
    assert dict(io.read_csv(spark, path).dtypes)["n_nationkey"] == "string"


def test_csv_columns_are_found_by_name(spark):
    path = io.write_csv(spark.createDataFrame([(1, 2, "z")], "b int, a int, c string"), scratch_path(spark, "t-csv"))
    assert rows(io.read_csv(spark, path, schema="a int, b int")) == [(2, 1)]
    with pytest.raises(ValueError):
        io.read_csv(spark, path, schema="a int, d int")


def test_register_views(spark):
    io.register_views({"t_nation": io.read_table(spark, SF_SMALL, "nation")})
    assert spark.sql("SELECT count(*) AS n FROM t_nation").collect()[0].n == 25


def test_incremental_parse_is_exactly_once(spark):
    from tessera.streaming import run_incremental

    src = scratch_path(spark, "punch-src")
    text = D.punch_text(spark, SF_SMALL)
    text.where(F.col("event_id") % 2 == 0).write.parquet(src + "/a")
    sink = scratch_path(spark, "punch-sink")
    schema = text.schema
    ckpt = run_incremental(spark, src + "/a", schema, attendance.parse_punches, sink)
    # Re-running with the same checkpoint finds no new files and writes nothing new.
    run_incremental(spark, src + "/a", schema, attendance.parse_punches, sink, checkpoint_location=ckpt)
    got = spark.read.parquet(sink)
    want = attendance.parse_punches(text.where(F.col("event_id") % 2 == 0))
    assert rows(got.select(*want.columns)) == rows(want)


def test_incremental_picks_up_only_new_files(spark):
    from tessera.streaming import run_incremental

    src = scratch_path(spark, "punch-src2")
    text = D.punch_text(spark, SF_SMALL)
    first, second = text.where(F.col("event_id") % 2 == 0), text.where(F.col("event_id") % 2 == 1)
    first.write.parquet(src + "/part=1")
    sink = scratch_path(spark, "punch-sink2")
    ckpt = run_incremental(spark, src, text.schema, attendance.parse_punches, sink)
    assert spark.read.parquet(sink).count() == first.count()
    second.write.parquet(src + "/part=2")
    run_incremental(spark, src, text.schema, attendance.parse_punches, sink, checkpoint_location=ckpt)
    got = spark.read.parquet(sink)
    want = attendance.parse_punches(text)
    assert rows(got.select(*want.columns)) == rows(want)


def test_stage_of_hex_keys_takes_half_their_length(spark):
    import glob
    import os

    keys = spark.range(0, 50_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    staged = D.stage(keys, "t-keys")
    where = staged.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    size = sum(map(os.path.getsize, glob.glob(where + "/*.parquet")))
    assert staged.count() == 50_000 and size < 50_000 * 45
