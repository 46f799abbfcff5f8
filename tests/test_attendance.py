"""Attendance: small punch logs, edge cases, and lead == self join."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.operators import attendance
from tessera.operators.sequence import large_groups, number_and_neighbours, with_ranges
from tessera.plans import derived as D

EMP = [(7, "Noor"), (8, "Ines"), (9, "Tomas"), (101, "Kim"), (102, "Lou"), (103, "Max")]
LOG = [(7, "2024-03-04 07:15:00", "IN"), (7, "2024-03-04 15:45:00", "OUT"),
       (8, "2024-03-04 06:00:00", "IN"), (8, "2024-03-04 09:00:00", "OUT"),
       (8, "2024-03-04 10:30:00", "IN"), (8, "2024-03-04 16:00:00", "OUT"),
       (9, "2024-03-04 21:00:00", "IN"), (9, "2024-03-04 21:00:36", "OUT")]


def _inputs(spark, log=LOG):
    emps = spark.createDataFrame(EMP, "emp_id int not null, emp_name string not null")
    punches = attendance.parse_punches(
        spark.createDataFrame(log, "emp_id int not null, punch_time string not null, punch_type string not null"))
    return punches, emps


def test_both_methods(spark):
    punches, emps = _inputs(spark)
    for fn in (attendance.hours_by_lag, attendance.hours_by_pairs):
        out = fn(punches, emps).collect()
        assert [r.emp_name for r in out] == ["Ines", "Noor", "Tomas"]   # sorted by date, name
        assert out[1].hours_at_work == 8.5 and out[2].hours_at_work == 0.01
        assert out[0].first_in == dt.datetime(2024, 3, 4, 6, 0) and out[0].last_out == dt.datetime(2024, 3, 4, 16, 0)
        # every OUT adds the time since the punch before it; pairs are the same here
        assert out[0].hours_at_work == 8.5


def test_parse_punches_types(spark):
    punches, _ = _inputs(spark)
    types = dict(punches.dtypes)
    assert types["punch_time"] == "timestamp_ntz" and types["work_date"] == "date"


def test_edge_cases(spark):
    log = [
        (101, "2025-08-08 09:00:00", "IN"), (101, "2025-08-08 12:00:00", "OUT"),
        (101, "2025-08-08 13:00:00", "OUT"),                     # OUT after OUT
        (102, "2025-08-08 09:00:00", "IN"),                      # single punch day
        (103, "2025-08-08 22:00:00", "IN"), (103, "2025-08-09 02:00:00", "OUT"),   # across midnight
    ]
    punches, emps = _inputs(spark, log)
    lag = {(r.emp_id, r.work_date.day): r.hours_at_work for r in attendance.hours_by_lag(punches, emps).collect()}
    assert lag[(101, 8)] == 4.0          # 3h + 1h: OUT after OUT adds time
    assert lag[(102, 8)] == 0.0
    assert lag[(103, 8)] == 0.0 and lag[(103, 9)] == 0.0   # the shift splits at midnight
    pairs = {(r.emp_id, r.work_date.day): r.hours_at_work for r in attendance.hours_by_pairs(punches, emps).collect()}
    assert pairs == {(101, 8): 3.0}      # odd last punch dropped, single-punch days vanish


def test_lead_equals_self_join_on_events(spark):
    p = D.punches(spark, SF_SMALL)
    seq = attendance.punch_sequence(p, tiebreak=["event_id"])
    a, b = seq.alias("a"), seq.alias("b")
    pairs = (a.join(b, (F.col("a.emp_id") == F.col("b.emp_id")) & (F.col("a.work_date") == F.col("b.work_date"))
                    & (F.col("b.punch_seq") == F.col("a.punch_seq") + 1) & (F.col("a.punch_seq") % 2 == 1))
              .select("a.emp_id", "a.work_date", F.col("a.punch_time").alias("pin"), F.col("b.punch_time").alias("pout")))
    joined = pairs.groupBy("emp_id", "work_date").agg(
        F.min("pin").alias("first_in"), F.max("pout").alias("last_out"),
        F.round(F.sum(F.unix_timestamp("pout") - F.unix_timestamp("pin")) / 3600.0, 2).alias("hours_at_work"))
    lead = attendance.hours_by_pairs(p, None, tiebreak=["event_id"], sort=False)
    assert rows(lead) == rows(joined.select(*lead.columns))


def _plain(df, keys, order, value):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", F.row_number().over(w).alias("__seq"), F.lag(value).over(w).alias("__prev"),
                     F.lead(value).over(w).alias("__next"))


def test_split_sequence_equals_single_window(spark):
    """One employee-day floods one hour, another has no valid time: both are split."""
    p = D.punches(spark, SF_SMALL).select("emp_id", "work_date", "punch_time", "event_id")
    flood = spark.range(5000).select(
        F.lit(-1).cast("long").alias("emp_id"), F.lit(dt.date(2024, 1, 5)).alias("work_date"),
        (F.lit(dt.datetime(2024, 1, 5, 9)) + F.make_dt_interval(secs=F.col("id") % 60)).cast("timestamp_ntz").alias("punch_time"),
        (F.col("id") + 10_000_000).alias("event_id"))
    bad = flood.select((F.col("emp_id") - 1).alias("emp_id"), F.lit(None).cast("date").alias("work_date"),
                       F.lit(None).cast("timestamp_ntz").alias("punch_time"), "event_id")
    both = p.unionByName(flood).unionByName(bad)
    keys, order = ["emp_id", "work_date"], ["punch_time", "event_id"]
    want = rows(_plain(both, keys, order, "punch_time"))
    for above, bound in ((1000, None), (1000, 0), (0, None), (10 ** 9, None)):
        split = number_and_neighbours(both, keys, order, "punch_time", max_broadcast_rows=bound, split_above=above)
        assert rows(split) == want
    placed = with_ranges(both, keys, order, large_groups(both, keys, 1000)).groupBy("__gid").count()
    sizes = {}
    for r in placed.collect():
        sizes.setdefault(r["__gid"].grp.emp_id, []).append(r["count"])
    assert len(sizes[-1]) > 20 and max(sizes[-1]) < 1000      # one hour, many ranges
    assert len(sizes[-2]) > 20 and max(sizes[-2]) < 1000      # no time at all, many ranges
    spark.conf.set("tessera.window.splitAbove", "1000")
    try:
        log = both.withColumn("punch_type", F.when(F.col("event_id") % 2 == 0, "IN").otherwise("OUT"))
        split = [rows(fn(log, None, tiebreak=["event_id"], sort=False)) for fn in (attendance.hours_by_lag, attendance.hours_by_pairs)]
    finally:
        spark.conf.unset("tessera.window.splitAbove")
    assert split == [rows(fn(log, None, tiebreak=["event_id"], sort=False)) for fn in (attendance.hours_by_lag, attendance.hours_by_pairs)]


def test_bad_punch_text_is_null_not_an_error(spark):
    df = spark.createDataFrame([(1, "2025-08-08 09:00:00"), (1, "2025-13-40 99:00:00"), (1, "garbage")],
                               "emp_id int, punch_time string")
    out = [r.punch_time for r in attendance.parse_punches(df).collect()]
    assert out == [dt.datetime(2025, 8, 8, 9, 0), None, None]
