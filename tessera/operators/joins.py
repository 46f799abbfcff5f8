"""Join helpers: size-checked broadcast and the null-safe join.

``checked_broadcast`` is the only place the library adds a broadcast hint.
The side is first written to the session's reliable checkpoint folder (so the
count and the join read the same materialised rows, and a lost executor does
not force a recompute), then counted; the hint is added only when the count
is within the bound. Above the bound the join stays a shuffle join and AQE
handles skewed partitions.

Plain scans of small tables need none of this: Spark's planner already
broadcasts a relation whose estimated size is under
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType

# Default bounds on a broadcast side: rows, and bytes as measured by
# ``size_of``; override per call or with the session settings
# ``tessera.broadcast.maxRows`` / ``tessera.broadcast.maxBytes``.
DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Setting by which Spark deletes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def max_broadcast_rows(df: DataFrame, override: int | None = None) -> int:
    if override is not None:
        return override
    conf = df.sparkSession.conf.get("tessera.broadcast.maxRows", None)
    return int(conf) if conf else DEFAULT_MAX_BROADCAST_ROWS


def max_broadcast_bytes(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("tessera.broadcast.maxBytes", None)
    return int(conf) if conf else DEFAULT_MAX_BROADCAST_BYTES


def _widths(df: DataFrame) -> tuple[int, list]:
    """Fixed bytes per row, and the per-row byte expressions of text/binary columns."""
    fixed, measured = 8 * len(df.schema.fields), []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (StringType, BinaryType)):
            measured.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(t, DecimalType):
            fixed += 16
        elif isinstance(t, (ArrayType, MapType, StructType)):
            fixed += 64
        else:
            fixed += 8
    return fixed, measured


def size_of(df: DataFrame) -> tuple[int, int]:
    """``(rows, bytes)`` of ``df`` in one aggregate job.

    Bytes are the summed lengths of text and binary values plus a fixed width
    per value of other types (16 for decimals, 8 otherwise, 64 for nested
    values), plus 8 per value of overhead: an upper estimate of the rows as
    they are held in a broadcast hash table.
    """
    fixed, measured = _widths(df)
    row = df.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(m), F.lit(0)) for m in measured]).first()
    rows = int(row[0])
    return rows, sum(int(v) for v in row[1:]) + rows * fixed


def size_up_to(df: DataFrame, bound: int) -> tuple[int, int]:
    """``(rows, bytes)`` of at most ``bound + 1`` rows of ``df``.

    The limited frame is aggregated, so only the two totals reach the driver.
    """
    fixed, measured = _widths(df)
    per_row = F.lit(fixed)
    for m in measured:
        per_row = per_row + m
    row = df.select(per_row.cast("long").alias("b")).limit(bound + 1).agg(F.count("b"), F.coalesce(F.sum("b"), F.lit(0))).first()
    return int(row[0]), int(row[1])


def checkpointed(df: DataFrame) -> tuple[DataFrame, int]:
    """Write ``df`` to the session's reliable checkpoint folder; return it and its row count.

    For aggregates that are used more than once: later steps read the written
    rows instead of re-running the aggregate, and a lost executor does not
    force a recompute from the source.
    """
    from tessera.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    return df, df.count()


def written(*parts: DataFrame, codec: str | None = None, release: bool = False) -> DataFrame:
    """Write ``parts`` (of one schema) to the session's shared folder and read them back; one job each, no lineage.

    ``codec`` is the files' codec instead of the session's. With ``release``
    the shuffle files of a part are deleted when it is written, before the next
    one begins; the session's setting is put back.
    """
    from tessera.session import scratch_path

    spark = parts[0].sparkSession
    path = scratch_path(spark, "written")
    before = spark.conf.get(CLEANUP, "false")
    if release:
        spark.conf.set(CLEANUP, "true")
    try:
        for part in parts:
            writer = part.write.mode("append")
            (writer.option("compression", codec) if codec else writer).parquet(path)
    finally:
        if release:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(parts[0].schema).parquet(path)


def measured_broadcast(df: DataFrame, max_rows: int | None = None,
                       materialize: bool = True) -> tuple[DataFrame, bool, int]:
    """``checked_broadcast`` that also returns the measured row count."""
    bound = max_broadcast_rows(df, max_rows)
    if materialize:
        from tessera.session import checkpoint_dir

        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
        n, size = size_of(df)
    else:
        n, size = size_up_to(df, bound)
    if n <= bound and size <= max_broadcast_bytes(df):
        return F.broadcast(df), True, n
    return df, False, n


def checked_broadcast(df: DataFrame, max_rows: int | None = None,
                      materialize: bool = True) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows.

    Returns ``(frame, broadcast)``. Both the row count and the measured size
    (``size_of``) must be within bounds; both come from the same job.

    ``materialize=True`` (for sides computed by an aggregate, such as
    per-group statistics or distinct keys) writes ``df`` to the checkpoint
    folder first, so the count and the join read the same rows and the
    aggregate runs once. ``materialize=False`` (for plain tables that may be
    large) measures at most ``max_rows + 1`` rows and leaves ``df`` as it is.
    """
    frame, small, _ = measured_broadcast(df, max_rows, materialize)
    return frame, small


def null_safe_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   how: str = "full", max_rows: int | None = None, suffix: str = "_right",
                   check_unique: bool = True) -> DataFrame:
    """Join where a null key matches a null key (``<=>``).

    Columns of ``right`` whose names ``left`` has, too, get ``suffix``.
    ``check_unique`` refuses a right side with a repeated key (null included),
    whose rows would all pair with each matching left row.

    A full outer join is computed as a left-outer join plus the right rows
    that no left row references. Those are found from the *distinct* left
    keys, so a hot key is collapsed map-side before any shuffle. The left
    outer join is broadcast when ``right`` is checked small; otherwise it is a
    shuffle join whose skewed left partitions AQE can split. A full outer
    sort-merge join could split neither side.
    """
    if check_unique and right.groupBy(right_key).count().where("count > 1").limit(1).count():
        raise ValueError(f"right key {right_key} is not unique; the join would fan out")
    taken = {c.lower() for c in left.columns}
    names = [c + suffix if c.lower() in taken else c for c in right.columns]
    key = names[right.columns.index(right_key)]
    right = right.toDF(*names)
    cond = left[left_key].eqNullSafe(right[key])
    if how not in ("full", "outer", "full_outer", "fullouter"):
        return left.join(right, cond, how)
    side, _ = checked_broadcast(right, max_rows, materialize=False)
    matched = left.join(side, left[left_key].eqNullSafe(side[key]), "left")
    used = left.select(F.col(left_key).alias("__used_key")).distinct()
    unused = right.join(used, right[key].eqNullSafe(used["__used_key"]), "left_anti")
    filler = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    unmatched = unused.select(*filler, *[F.col(c) for c in right.columns])
    return matched.unionByName(unmatched)
