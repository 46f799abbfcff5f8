"""Surrogate keys with collisions, versioned stages, rejected rows, exact large top-N."""

import datetime as dt
import threading

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tessera.operators import dims, numbering, topn
from tessera.session import scratch_path
from tessera.sources import quarantine, versions


# --- numbering and keys -------------------------------------------------------

def test_rows_are_numbered_in_order_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"), F.lit("x").alias("__id_like")).repartition(7)
        got = numbering.number_rows(df, [F.desc("v")], start=10)
        assert got.select("row_index").distinct().count() == 5000
        assert got.where(F.col("row_index") != 10 + 4999 - F.col("v")).count() == 0
        assert numbering.number_rows(df.limit(0), ["v"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def slow_keys(members, hashes, earlier):
    """Keys by the rule, one member after the other."""
    keys, taken = {m: earlier[m] for m in members if m in earlier}, set(earlier.values())
    losers = []
    for m in sorted((m for m in members if m not in earlier), key=lambda m: (m is not None, m)):
        if hashes[m] in taken:
            losers.append(m)
        else:
            keys[m] = hashes[m]
            taken.add(hashes[m])
    number = max(1 << 31, max(earlier.values(), default=0) + 1)
    return keys | {m: number + i for i, m in enumerate(losers)}


def narrow(monkeypatch, spread):
    """A hash of few values, so that most members collide."""
    monkeypatch.setattr(numbering, "hash_key", lambda cols, algo="murmur3_32": F.pmod(F.hash(*[F.col(c) if isinstance(c, str) else c for c in cols]), F.lit(spread)).cast("bigint"))


@pytest.mark.parametrize("spread", [3, 50])
def test_colliding_members_get_numbers_and_keep_them(spark, monkeypatch, spread):
    narrow(monkeypatch, spread)
    table = lambda xs: spark.createDataFrame([(x,) for x in xs], "code string")
    hashed = lambda xs: {r.code: r.h for r in table(xs).select("code", F.pmod(F.hash("code"), F.lit(spread)).cast("bigint").alias("h")).collect()}
    one = [f"m{i}" for i in range(0, 60, 2)] + [None, ""]
    first = dims.add_hash_key(table(one + one[:3]), ["code"], "id", conform=False, resolve=True)
    built = {r.code: r.id for r in first.collect()}
    assert built == slow_keys(set(one), hashed(one), {}) and first.count() == len(one) + 3
    two = [f"m{i}" for i in range(30, 90)] + [None]
    second = dims.add_hash_key(table(two), ["code"], "id", conform=False, earlier=first)
    again = {r.code: r.id for r in second.collect()}
    assert again == slow_keys(set(two), hashed(two), built)
    assert len(set((built | again).values())) == len(set(one) | set(two))
    third = dims.add_hash_key(table([*one, *two]), ["code"], "id", conform=False, earlier=second.unionByName(first).distinct())
    assert {r.code: r.id for r in third.collect()} == built | again


def test_keys_of_bare_members_are_given_without_a_lookup(spark):
    df = spark.createDataFrame([(f"m{i % 40}",) for i in range(50)] + [(None,)], "code string")
    first = dims.add_hash_key(df, ["code"], "id", resolve=True)
    second = dims.add_hash_key(df, ["code"], "id", earlier=first)
    # The whole table was joined with the members that are not at their hash.
    assert "LeftOuter" not in plan_text(second)
    assert rows(first) == rows(second) and first.count() == 51 and first.select("id").distinct().count() == 41


@pytest.mark.parametrize("spread", [7, 5000])
def test_many_members_are_keyed_in_runs(spark, monkeypatch, spread):
    narrow(monkeypatch, spread)
    parts, given = [], numbering.written
    monkeypatch.setattr(numbering, "written", lambda *dfs, **how: parts.append(len(dfs)) or given(*dfs, **how))
    monkeypatch.setattr(numbering, "ROWS_A_RUN", 30)
    monkeypatch.setattr(numbering, "ROWS_A_TASK", 3)
    table = lambda xs: spark.createDataFrame([(x,) for x in xs], "code string")
    hashed = lambda xs: {r.code: r.h for r in table(xs).select("code", F.pmod(F.hash("code"), F.lit(spread)).cast("bigint").alias("h")).collect()}
    one, two = [f"m{i}" for i in range(80)], [f"m{i}" for i in range(40, 150)] + [None]
    first = dims.add_hash_key(table(one), ["code"], "id", conform=False, resolve=True)
    built = {r.code: r.id for r in first.collect()}
    assert built == slow_keys(set(one), hashed(one), {}) and first.count() == 80
    second = dims.add_hash_key(table(two), ["code"], "id", conform=False, earlier=first)
    assert {r.code: r.id for r in second.collect()} == slow_keys(set(two), hashed(two), built) and second.count() == 111
    # Rows of the table and earlier keys, 30 a run: 80, then 111 and 80. Numbers past the hash are written whole.
    assert parts == [3, 1, 7, 1]


def test_keys_at_the_hash_are_not_written(spark, monkeypatch):
    kept, given = [], numbering.written
    monkeypatch.setattr(numbering, "written", lambda *dfs, **how: kept.append(given(*dfs, **how)) or kept[-1])
    first = dims.add_hash_key(spark.range(1000).select(F.col("id").cast("string").alias("code")), ["code"], "id", resolve=True)
    assert first.where(F.col("id") == F.hash("code")).count() == 1000
    numbers = [f.name for f in kept[0].schema.fields if f.dataType.typeName() == "long" and f.name != "__rows"]
    assert kept[0].where(F.coalesce(*[F.col(n) for n in numbers]).isNotNull()).count() == 0


def test_a_member_with_several_earlier_keys_has_all_but_its_hash(spark):
    now = spark.createDataFrame([("a",), ("b",), ("c",)], "code string")
    own = {r.code: r.h for r in now.select("code", F.hash("code").cast("long").alias("h")).collect()}
    past = spark.createDataFrame([("a", own["a"]), ("a", 7), ("a", 9), ("a", 9), ("b", own["b"]), ("b", None)], "code string, id long")
    got = rows(dims.add_hash_key(now, ["code"], "id", conform=False, earlier=past))
    assert got == [("a", 7), ("a", 9), ("b", own["b"]), ("c", own["c"])]


def test_earlier_keys_that_contradict_or_lack(spark):
    table = lambda xs: spark.createDataFrame(xs, "code string, id long")
    now = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "code string")
    with pytest.raises(ValueError, match="not unique"):
        dims.add_hash_key(now, ["code"], "id", conform=False, earlier=table([("a", 1), ("b", 1)]))
    own = {r.code: r.h for r in now.select("code", F.hash("code").cast("long").alias("h")).collect()}
    # "a" sits where "c" hashes to, "x" is gone and keeps its key, "b" came without a key and stays at its hash.
    got = rows(dims.add_hash_key(now, ["code"], "id", conform=False, earlier=table([("a", own["c"]), ("x", 1 << 40), ("b", None)])))
    assert got == [("a", own["c"]), ("b", own["b"]), ("b", own["b"]), ("c", (1 << 40) + 1)]


def test_codes_of_lines_with_nulls(spark):
    from tessera.plans import upkeep

    path = scratch_path(spark, "lines")
    lines = [(1, 2, None), (1, None, 2), (None, None, None), (None, 1, 2), (1, 2, 3), (1, 2, 3)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{path}/lineitem.parquet")
    codes = upkeep.shelf_codes(spark, path)
    want = {("-".join(str(x) for x in [*line, i] if x is not None), line[0]) for line in lines for i in range(upkeep.CODES_A_LINE)}
    assert codes.columns == ["code", "l_orderkey"] and codes.count() == len(want) and {tuple(r) for r in codes.collect()} == want
    # Lines are made distinct, not their five codes each.
    assert "Exchange" not in plan_text(codes)


def test_a_mapping_resolves_on_its_digest(spark, monkeypatch):
    narrow(monkeypatch, 4)
    df = spark.createDataFrame([(a, b, f"{a}/{b}") for a in ("x", "X ", "y") for b in ("p", "q", None)], "a string, b string, label string")
    out = dims.build_mapping(df, ["a", "b"], "label", "id", resolve=True)
    assert out.columns == ["id", "a", "b", "label"]
    assert out.select("id").distinct().count() == 9 and out.where("a = 'X'").count() == 6
    past = df.select("a", "b").join(out.select("id", "label"), F.concat_ws("/", "a", F.coalesce("b", F.lit("None"))) == F.col("label"))
    more = df.unionByName(spark.createDataFrame([("z", "p", "z/p")], df.schema))
    later = dims.build_mapping(more, ["a", "b"], "label", "id", earlier=past)
    assert set(rows(out, "id", "label")) < set(rows(later, "id", "label")) and later.select("id").distinct().count() == 10


def test_refused_builds(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "code string, id long")
    with pytest.raises(ValueError, match="not unique"):
        dims.add_hash_key(df.select("code"), ["code"], "id", earlier=df)
    with pytest.raises(ValueError, match="integer"):
        dims.add_hash_key(df.select("code"), ["code"], "id", algo="sha256", resolve=True)


def test_300_000_codes(spark):
    codes = spark.range(300_000).select(F.concat(F.lit("code-"), "id").alias("code"))
    with pytest.raises(ValueError):
        dims.add_hash_key(codes, ["code"], "id")
    out = dims.add_hash_key(codes, ["code"], "id", resolve=True).cache()
    assert out.select("id").distinct().count() == 300_000
    moved = out.where(F.col("id") != F.hash("code"))
    assert 0 < moved.count() < 100 and moved.agg(F.min("id")).first()[0] == 1 << 31
    out.unpersist()


# --- versions -----------------------------------------------------------------

def test_versions_are_published_whole(spark):
    root = scratch_path(spark, "versions")
    with pytest.raises(LookupError):
        versions.read(spark, root)
    a = spark.range(10).withColumn("x", F.lit("a"))
    assert versions.publish(a, root, note="first").number == 1
    early = versions.read(spark, root)
    versions.publish(spark.range(20).withColumn("y", F.lit(1.5)), root, least_rows=20)
    assert versions.read(spark, root).columns == ["id", "y"] and versions.read(spark, root).count() == 20
    assert early.count() == 10 and versions.read(spark, root, 1).columns == ["id", "x"]
    assert [(v.number, v.rows, v.note) for v in versions.history(spark, root)] == [(1, 10, "first"), (2, 20, "")]


def test_a_failed_write_changes_nothing(spark):
    root = scratch_path(spark, "versions")
    good = spark.range(10)
    versions.publish(good, root)
    before = versions.history(spark, root)
    bad = [dict(rows=11), dict(least_rows=11), dict(schema=spark.range(1).withColumnRenamed("id", "key").schema),
           dict(checks=[lambda df: ["negative ids"] if df.where("id < 5").count() else []])]
    for how in bad:
        with pytest.raises(versions.Unpublished):
            versions.publish(good, root, **how)
    with pytest.raises(Exception, match="boom"):
        versions.publish(good.select(F.when(F.col("id") > 8, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id")), root)
    assert versions.history(spark, root) == before
    assert versions._names(spark, f"{root}/data") == [before[0].folder]


def test_going_back_and_expiry(spark):
    root = scratch_path(spark, "versions")
    for i in range(1, 5):
        versions.publish(spark.range(i), root)
    assert versions.roll_back(spark, root, 2).number == 5 and versions.read(spark, root).count() == 2
    assert versions.expire(spark, root, keep=2, older_than=3600) == []
    gone = versions.expire(spark, root, keep=2)
    assert len(gone) == 2 and [v.number for v in versions.history(spark, root)] == [2, 4, 5]
    assert versions.read(spark, root).count() == 2 and versions.read(spark, root, 4).count() == 4
    assert versions.roll_back(spark, root).rows == 4
    with pytest.raises(LookupError):
        versions.roll_back(spark, root, 1)


def test_publishers_at_the_same_time_get_their_own_numbers(spark):
    root = scratch_path(spark, "versions")
    got, threads = [], []
    for i in range(1, 6):
        threads.append(threading.Thread(target=lambda i=i: got.append((versions.publish(spark.range(i), root).number, i))))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(n for n, _ in got) == [1, 2, 3, 4, 5]
    assert {v.number: v.rows for v in versions.history(spark, root)} == dict(got)


# --- rejected rows ------------------------------------------------------------

LINES = ["id,name,n", '1,"a, b",2', "2,c", "3,d,4,5", "x,e,6", "4,f,six", ',g,7', "", "5,,8", "   ", '6,"say ""hi"", x",9', "id,name,n", '7,"open,1']


def test_every_line_is_good_or_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES))
    (tmp_path / "b.csv").write_text("id,name,n\n8,h,9\n")
    out = quarantine.read_csv_split(spark, str(tmp_path), "id int, name string, n int", required=["id"], escape='"')
    assert sorted(tuple(r) for r in out.good.collect()) == [(1, "a, b", 2), (5, None, 8), (6, 'say "hi", x', 9), (8, "h", 9)]
    rejected = {r.raw: r.reason for r in out.rejected.collect()}
    assert rejected == {"2,c": "too few fields", "3,d,4,5": "too many fields", "x,e,6": "id is no int", "4,f,six": "n is no int",
                        ",g,7": "id is missing", '7,"open,1': rejected['7,"open,1']}
    assert {r.source_file.rsplit("/", 1)[1] for r in out.rejected.collect()} == {"a.csv"}
    assert sum(r.n_rows for r in out.counts().collect()) == 10
    assert out.good.schema.simpleString() == "struct<id:int,name:string,n:int>"


def test_lines_are_parsed_by_the_given_format(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1|2024-02-30|x|y\n2|2024-02-28|z\n3|28.02.2024|z\n")
    out = quarantine.read_csv_split(spark, str(tmp_path), "id long, day date, text string", header=False, sep="|")
    assert rows(out.good) == [(2, dt.date(2024, 2, 28), "z")]
    assert sorted((r.raw[0], r.reason) for r in out.rejected.collect()) == [("1", "too many fields"), ("3", "day is no date")]


def test_punches_are_split(spark):
    data = [(1, "2024-01-01 08:00:00", "IN"), (None, "2024-01-01 08:00:00", "IN"), (2, None, "OUT"), (3, "8 o'clock", "OUT"),
            (4, "2024-01-01 09:00:00", "in"), (5, "2024-01-01 09:00:00", None), (6, "2024-13-01 09:00:00", "OUT")]
    df = spark.createDataFrame(data, "emp_id int, punch_time string, punch_type string")
    out = quarantine.split_punches(df, source=F.lit("clock-7"))
    assert rows(out.good) == [(1, dt.datetime(2024, 1, 1, 8), "IN", dt.date(2024, 1, 1))]
    assert sorted(r.reason for r in out.rejected.collect()) == [
        "emp_id is missing", "punch_time is missing", "punch_time is not yyyy-MM-dd HH:mm:ss", "punch_time is not yyyy-MM-dd HH:mm:ss",
        "punch_type is none of IN, OUT", "punch_type is none of IN, OUT"]
    assert {r.source_file for r in out.rejected.collect()} == {"clock-7"}
    assert '"punch_time":"8 o\'clock"' in next(r.raw for r in out.rejected.collect() if '"emp_id":3' in r.raw)
    empty = quarantine.split_punches(df.limit(0))
    assert empty.good.count() == empty.rejected.count() == 0


# --- top-N --------------------------------------------------------------------

ORDER = [("v", "desc"), "w", ("id", "desc")]


def windowed(df, n):
    rank = F.row_number().over(Window.partitionBy("g", "h").orderBy(F.desc("v"), F.asc("w"), F.desc("id")))
    return df.withColumn("r", rank).where(F.col("r") <= n).drop("r")


@pytest.mark.parametrize("n", [0, 1, 90, 700, 1500, 10_000])
def test_first_n_equals_the_window(spark, n):
    k = F.col("id")
    df = spark.range(4000).select("id", F.when(k % 4 != 0, "hot").when(k % 8 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), k % 40)).alias("g"),
                                  (k % 3 == 5).cast("int").alias("h"),
                                  F.when(k % 11 == 0, F.lit(None)).otherwise((k * 7919) % 501 / 7).alias("v"), F.when(k % 5 == 0, F.lit(None)).otherwise(F.hex(k % 97)).alias("w"))
    want = rows(windowed(df, n), "id")
    for split in (50, 1_000_000):
        assert rows(topn.first_n(df, ["g", "h"], ORDER, n, split_above=split, edges=8), "id") == want


def test_first_n_of_ties_and_of_nothing(spark):
    df = spark.range(1000).select(F.lit(1).alias("g"), F.lit(2.5).alias("v"))
    assert topn.first_n(df, "g", ["v"], 300, split_above=100).count() == 300
    assert topn.first_n(df.limit(0), "g", ["v"], 3).count() == 0
    with pytest.raises(ValueError):
        topn.first_n(df, "g", [("v", "up")], 3)


def test_a_hot_group_is_ranked_in_several_tasks(spark):
    """Only the last bin of a large group meets in a window."""
    df = spark.range(60_000).select(F.lit("hot").alias("g"), ((F.col("id") * 48271) % 60_013).alias("v"))
    seen = []
    real = topn._narrowed

    def spy(rows_, state, key, edges):
        out = real(rows_, state, key, edges)
        seen.append(out.agg(F.max("__n")).first()[0])
        return out

    topn._narrowed = spy
    try:
        got = topn.first_n(df, "g", [("v", "desc")], 50_000, split_above=200)
        assert rows(got, "v") == rows(df.orderBy(F.desc("v")).limit(50_000), "v")
    finally:
        topn._narrowed = real
    assert seen[-1] <= 200 < seen[0] <= 6000
