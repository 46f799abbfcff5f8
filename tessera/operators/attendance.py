"""Hours at work from punch logs.

Input: one row per punch ``(emp_id, punch_time, punch_type)``; ``work_date`` is
the calendar date of the punch, so a shift across midnight splits in two.

Two methods, as in common attendance reports:

* ``hours_by_lag``   each OUT punch adds the time since the punch before it
                     (whatever that punch's type, so OUT after OUT also adds)
* ``hours_by_pairs`` punches are numbered per day; 1 pairs with 2, 3 with 4,
                     ...; punch types are ignored, an odd last punch is
                     dropped, and a day with a single punch has no row

* ``hours_by_shift`` a shift runs from the first IN after an OUT to the next
                     OUT, across midnight too; OUT after OUT adds nothing, an IN
                     within a shift changes nothing

The first two are those of the calendar day; the third books a shift on the
day it begins.

All sum whole seconds and divide once, so rounding to hundredths of an hour
is a single step. The employee name is joined *after* the per-day aggregate:
the name depends only on ``emp_id``, and the aggregate is far smaller than
the punch log. Windows are partitioned by employee-day; a large employee-day
is further split by ranges of its punch order (``sequence.with_ranges``), so a
runaway clock that floods one employee-day, one hour of it, or punches without
a valid time, cannot put a third of the log into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.values import seconds_between
from tessera.operators.recipes import running_total
from tessera.operators.sequence import number_and_neighbours

# Punch types, timestamp text format, seconds per hour.
PUNCH_IN = "IN"
PUNCH_OUT = "OUT"
PUNCH_FORMAT = "yyyy-MM-dd HH:mm:ss"
SECONDS_PER_HOUR = 3600.0


def parse_punches(df: DataFrame, time_col: str = "punch_time", fmt: str = PUNCH_FORMAT,
                  date_col: str = "work_date", ntz: bool = True, strict: bool = False) -> DataFrame:
    """Text punch times to timestamps (without zone by default) plus their date.

    With ``strict=False`` a value that does not match ``fmt`` becomes null
    instead of failing the job (Spark 4 parses under ANSI rules), so one bad
    row cannot stop a run over the whole log; count the nulls to report them.
    """
    fmt_lit = F.lit(fmt)
    ts = F.to_timestamp_ntz(F.col(time_col), fmt_lit) if ntz else F.to_timestamp(F.col(time_col), fmt)
    if not strict:
        ts = F.when(F.try_to_timestamp(F.col(time_col), fmt_lit).isNotNull(), ts)
    return df.withColumn(time_col, ts).withColumn(date_col, F.to_date(F.col(time_col)))


def punch_sequence(df: DataFrame, emp: str = "emp_id", date: str = "work_date",
                   time: str = "punch_time", tiebreak: Sequence[str] = (),
                   out: str = "punch_seq") -> DataFrame:
    """Number punches 1, 2, ... per employee-day in time order."""
    numbered = number_and_neighbours(df, [emp, date], [time, *tiebreak], time, seq=out)
    return numbered.drop("__prev", "__next")


def _hours(secs):
    return F.round(secs / F.lit(SECONDS_PER_HOUR), 2)


def _with_names(daily: DataFrame, employees: DataFrame | None, emp: str, name: str,
                keys: Sequence[str], sort: bool) -> DataFrame:
    out = daily
    if employees is not None:
        out = daily.join(employees.select(emp, name), on=emp, how="inner")
        out = out.select(emp, name, *[c for c in daily.columns if c != emp])
    if sort:
        out = out.orderBy(*keys)
    return out


def hours_by_lag(punches: DataFrame, employees: DataFrame | None = None, emp: str = "emp_id",
                 name: str = "emp_name", date: str = "work_date", time: str = "punch_time",
                 kind: str = "punch_type", tiebreak: Sequence[str] = (),
                 sort: bool = True) -> DataFrame:
    """``emp, name, date, first_in, last_out, hours_at_work`` per employee-day."""
    src = punches.select(emp, date, time, kind, *tiebreak)
    stepped = number_and_neighbours(src, [emp, date], [time, *tiebreak], time)
    is_out = F.col(kind) == F.lit(PUNCH_OUT)
    secs = F.when(is_out & F.col("__prev").isNotNull(), seconds_between(time, "__prev")).otherwise(F.lit(0))
    daily = stepped.groupBy(emp, date).agg(
        F.min(F.when(F.col(kind) == F.lit(PUNCH_IN), F.col(time))).alias("first_in"),
        F.max(F.when(is_out, F.col(time))).alias("last_out"),
        _hours(F.sum(secs)).alias("hours_at_work"))
    return _with_names(daily, employees, emp, name, [date, name if employees is not None else emp], sort)


def hours_by_pairs(punches: DataFrame, employees: DataFrame | None = None, emp: str = "emp_id",
                   name: str = "emp_name", date: str = "work_date", time: str = "punch_time",
                   tiebreak: Sequence[str] = (), sort: bool = True) -> DataFrame:
    """Pair punch 2k-1 with punch 2k of each employee-day; sum the pair spans.

    Each punch gets its sequence number and the next punch time from one
    (split) window; this replaces a self join on ``seq + 1``.
    """
    src = punches.select(emp, date, time, *tiebreak)
    stepped = number_and_neighbours(src, [emp, date], [time, *tiebreak], time)
    pairs = stepped.where((F.col("__seq") % 2 == 1) & F.col("__next").isNotNull())
    daily = pairs.groupBy(emp, date).agg(
        F.min(time).alias("first_in"),
        F.max("__next").alias("last_out"),
        _hours(F.sum(seconds_between("__next", time))).alias("hours_at_work"))
    return _with_names(daily, employees, emp, name, [date, name if employees is not None else emp], sort)


def shifts(punches: DataFrame, emp: str = "emp_id", time: str = "punch_time", kind: str = "punch_type",
           tiebreak: Sequence[str] = ()) -> DataFrame:
    """``emp, shift, first_in, last_out``: one row per shift, the one still open with a null ``last_out``.

    The state of an employee is closed, or open since a time. IN opens it, if
    it is closed; OUT closes it and ends a shift, if it is open; nothing else
    changes it. So what an OUT ends is decided by the punches since the OUT
    before it: the number of OUTs before a punch names its run, and the first
    IN of a run opens the shift that the run's OUT ends. That number is a
    running count, which adds up over ranges of a flooded employee's punches
    (``sequence.with_ranges``), and a run's first IN and OUT are partial
    aggregates; no employee is one task's work. Punches without a time, and of
    other kinds, take no part.
    """
    src = punches.where(F.col(time).isNotNull() & F.col(kind).isin(PUNCH_IN, PUNCH_OUT)).select(
        emp, time, kind, *tiebreak, (F.col(kind) == PUNCH_OUT).cast("long").alias("__out"))
    counted = running_total(src, emp, [time, *tiebreak], "__out", out="__outs")
    runs = counted.groupBy(emp, (F.col("__outs") - F.col("__out")).alias("shift")).agg(
        F.min(F.when(F.col(kind) == PUNCH_IN, F.col(time))).alias("first_in"),
        F.max(F.when(F.col(kind) == PUNCH_OUT, F.col(time))).alias("last_out"))
    return runs.where("first_in is not null")


def hours_by_shift(punches: DataFrame, employees: DataFrame | None = None, emp: str = "emp_id",
                   name: str = "emp_name", time: str = "punch_time", kind: str = "punch_type",
                   date: str = "work_date", tiebreak: Sequence[str] = (), sort: bool = True) -> DataFrame:
    """``emp, name, date, n_shifts, first_in, last_out, hours_at_work`` per employee and day on which shifts begin.

    Shifts still open add no hours and are not counted."""
    done = shifts(punches, emp, time, kind, tiebreak).where("last_out is not null")
    daily = done.groupBy(emp, F.to_date("first_in").alias(date)).agg(
        F.count(F.lit(1)).alias("n_shifts"), F.min("first_in").alias("first_in"), F.max("last_out").alias("last_out"),
        _hours(F.sum(seconds_between("last_out", "first_in"))).alias("hours_at_work"))
    return _with_names(daily, employees, emp, name, [date, name if employees is not None else emp], sort)
