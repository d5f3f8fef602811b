"""Helpers of the operators against plain windows and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.keys import newest_per_key, row_hash
from millrace.functions.lineage import cut_lineage, ensure_checkpoint_dir
from millrace.functions.ordered import preceding_counts, previous_row, running
from millrace.functions.periods import add_months, interval_start
from millrace.operators import checks, temporal


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds more than a third of the rows; days span several chunks."""
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 5 < 2 else f"k{i % 37}"
        data.append((key, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(1500)), i, rnd.choice([None, 1, 5, 9])))
    return spark.createDataFrame(data, "k string, d date, i int, v int")


@pytest.mark.parametrize("ahead", [False, True])
def test_previous_row_equals_lag(skewed, ahead):
    w = Window.partitionBy("k").orderBy("d", "i")
    plain = skewed.withColumn("p", (F.lead if ahead else F.lag)("i").over(w))
    ours = previous_row(skewed, ["k"], ["d", "i"], {"p": "i"}, F.trunc("d", "MM"), ahead)
    assert rows_of(ours, "i") == rows_of(plain, "i")


@pytest.mark.parametrize("before_only", [False, True])
def test_running_equals_window(skewed, before_only):
    w = Window.partitionBy("k").orderBy("d", "i").rowsBetween(Window.unboundedPreceding, -1 if before_only else 0)
    plain = skewed.select("*", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"), F.count("v").over(w).alias("c"))
    ours = running(skewed, ["k"], ["d", "i"], {"s": ("sum", "v"), "m": ("max", "v"), "c": ("count", "v")}, F.year("d"), before_only)
    assert rows_of(ours, "i") == rows_of(plain, "i")


@pytest.mark.parametrize("buckets", [4, 64, 1024])
def test_preceding_counts_are_exact(spark, buckets):
    rnd = random.Random(3)
    values = [rnd.choice([None, 0.5, rnd.random() * 100, float(rnd.randrange(9))]) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ranked = preceding_counts(counts, "v", ["n"], buckets)
    filled = sorted(v for v in values if v is not None)
    for row in ranked.rows.collect():
        expected = len(filled) if row.v is None else sum(x < row.v for x in filled)
        assert row.n_before == expected
    assert ranked.totals == {"n": len(filled)} and ranked.nulls == {"n": len(values) - len(filled)}


def test_newest_per_key_treats_null_as_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), (None, 2, "z")], "k string, o int, v string")
    assert rows_of(newest_per_key(df, ["k"], ["o"]), "v") == [("a", None, "y"), (None, 2, "z")]


def test_row_hash_separates_fields(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("1", None), (None, "1")], "a string, b string")
    assert df.select(row_hash(["a", "b"])).distinct().count() == 4
    assert df.select(row_hash(["a", "b"], compat=True)).distinct().count() == 2


def test_interval_start():
    day = dt.date(2024, 3, 31)
    assert interval_start(day, "quarter", 1) == dt.date(2023, 11, 30)
    assert interval_start(day, "month_ld", 1) == dt.date(2024, 2, 29)
    assert interval_start(day, "week", 2) == dt.date(2024, 3, 17)
    assert interval_start(day, "fortnight", 1) is None
    assert add_months(day, -13) == dt.date(2023, 2, 28)


def test_checkpoint_dir_comes_from_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert cut_lineage(spark.range(5)).count() == 5


def test_temporal_duplicates_against_all_dates(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        start = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(900))
        rows.append(("hot" if i % 3 == 0 else f"k{i % 40}", start, start + dt.timedelta(days=rnd.randrange(-1, 60)), i))
    df = spark.createDataFrame(rows, "k string, s date, e date, i int")
    dates = {r[1] for r in rows} | {r[2] for r in rows}
    expected = {}
    for d in dates:
        per = {}
        for k, s, e, _ in rows:
            if s <= d <= e:
                per[k] = per.get(k, 0) + 1
        for k, n in per.items():
            if n > 1:
                expected[k] = expected.get(k, 0) + n
    assert dict(rows_of(checks.temporal_duplicates(df, ["k"], "s", "e"), "k")) == expected
    assert {r.k for r in checks.overlapping_keys(df, ["k"], "s", "e").collect()} >= set(expected)
    top = checks.temporal_duplicates(df, ["k"], "s", "e", top=1).collect()
    assert top[0].k == max(expected, key=lambda k: expected[k])


def test_no_duplicates_after_removing_overlaps(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), dt.date(2020, 1, 5)), ("a", dt.date(2020, 1, 6), dt.date(9999, 12, 31))], "k string, s date, e date"
    )
    assert checks.temporal_duplicates(df, ["k"], "s", "e").isEmpty()


def test_interval_join_spans_years_and_open_ends(spark):
    rows = spark.createDataFrame([(1, dt.date(2019, 12, 31)), (1, dt.date(2021, 6, 1)), (2, dt.date(2020, 1, 1))], "k int, d date")
    periods = spark.createDataFrame(
        [(1, dt.date(2000, 1, 1), dt.date(9999, 12, 31), "open"), (1, dt.date(2021, 1, 1), dt.date(2021, 12, 31), "y21")], "pk int, s date, e date, v string"
    )
    out = temporal.interval_join(rows, periods, {"k": "pk"}, F.col("d"), "s", "e", temporal.day_span(rows, "d"))
    got = rows_of(out.select("k", "d", "v"), "k", "d", "v")
    assert got == [
        (1, dt.date(2019, 12, 31), "open"), (1, dt.date(2021, 6, 1), "open"), (1, dt.date(2021, 6, 1), "y21"), (2, dt.date(2020, 1, 1), None)
    ]


def test_tree_levels_and_cycles(spark):
    day, end = dt.date(2024, 1, 1), dt.date(9999, 12, 31)
    edges = spark.createDataFrame(
        [(2, 1, day, end), (3, 2, day, end), (2, 3, day, end), (4, 3, dt.date(2024, 1, 5), end), (5, 2, dt.date(2023, 1, 1), day)],
        "child int, parent int, date_start date, date_finish date",
    )
    paths = temporal.tree_paths(edges, spark.createDataFrame([(1,)], "root int"))
    got = {(r.org_id, r.lvl) for r in paths.collect()}
    # The edge to 5 only touches its parent edge on its last day, so it does not overlap it.
    assert got == {(2, 1), (3, 2), (4, 3)}
    daily = temporal.daily_tree(paths, day, dt.date(2024, 1, 6))
    assert daily.where("org_id = 4").count() == 2
    assert daily.where("org_id = 3 and lvl <> 2").isEmpty()


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    """A chain of 1000 nodes, a cycle on its way and a side branch: about ten rounds, paths as by single steps."""
    from millrace.operators import temporal

    always = (dt.date(2024, 1, 1), dt.date(9999, 12, 31))
    edges = [(i + 1, i, *always) for i in range(1, 1001)] + [(500, 700, *always), (5000, 998, dt.date(2024, 2, 1), dt.date(2024, 3, 1))]
    rounds = []
    real = temporal.cut_lineage
    monkeypatch.setattr(temporal, "cut_lineage", lambda df: rounds.append(1) or real(df))
    paths = temporal.tree_paths(spark.createDataFrame(edges, "child int, parent int, date_start date, date_finish date"), spark.createDataFrame([(1,)], "root int"))
    got = {(r.org_id, r.lvl, r.valid_from) for r in paths.select("org_id", "lvl", "valid_from").collect()}
    assert got == {(i + 1, i, always[0]) for i in range(1, 1001)} | {(5000, 998, dt.date(2024, 2, 1))}
    assert len(rounds) <= 2 * 11 + 1


def test_timeline_join_equals_interval_join(spark):
    """Random periods without overlaps on two keys, a key that holds most rows, NULL keys and days, two sides in one order."""
    rnd, day = random.Random(5), dt.date(2020, 1, 1)
    sides, held = [], []
    for _ in range(2):
        rows = []
        for k in range(6):
            at = 0
            while at < 900:
                first = at + rnd.randint(0, 40)
                last = first + rnd.randint(0, 60)
                rows.append((k, k % 2, day + dt.timedelta(first), day + dt.timedelta(last), rnd.randint(0, 99) or None))
                at = last + 1
            rows.append((k, k % 2, day + dt.timedelta(5000), dt.date(9999, 12, 31), 7))
            rows.append((k, k % 2, day + dt.timedelta(3), day + dt.timedelta(2), 13))  # holds no day
        rows.append((None, 0, day, day, 1))
        held.append(rows)
        sides.append(spark.createDataFrame(rows, "a int, b int, s date, e date, v int"))
    asked = [(0 if i % 3 else rnd.randint(0, 7), rnd.randint(0, 1), day + dt.timedelta(rnd.randint(-5, 950)), i) for i in range(900)]
    asked += [(None, 0, day, -1), (1, 1, None, -2), (0, 0, dt.date(2300, 1, 1), -3)] + asked[:5]
    rows = spark.createDataFrame(asked, "x int, y int, d date, n int")
    lines = [temporal.Timeline(f, ["a", "b"], {f"v{i}": "v", f"s{i}": "s"}, "s", "e") for i, f in enumerate(sides)]
    assert temporal.exclusive_periods(lines) == [True, True]
    out = temporal.timeline_join(rows, ["x", "y"], "d", lines)

    def at(rows, x, y, d):
        fits = [(v, s) for a, b, s, e, v in rows if None not in (x, d) and (a, b) == (x, y) and s <= d <= e]
        return fits[0] if fits else (None, None)

    want = sorted(((*r, *at(held[0], *r[:3]), *at(held[1], *r[:3])) for r in asked), key=repr)
    assert sorted((tuple(r) for r in out.select("x", "y", "d", "n", "v0", "s0", "v1", "s1").collect()), key=repr) == want


def test_exclusive_periods(spark):
    def line(*periods, **stated):
        rows = [(k, dt.date(2020, 1, s), dt.date(2020, 1, e)) for k, s, e in periods]
        return temporal.Timeline(spark.createDataFrame(rows, "k int, s date, e date"), ["k"], {"v": "s"}, "s", "e", **stated)

    touching, same_start, inside = line((1, 1, 5), (1, 5, 9)), line((1, 1, 5), (1, 1, 2)), line((1, 1, 9), (2, 2, 3), (1, 4, 5))
    apart, empty = line((1, 1, 4), (1, 5, 9), (2, 1, 9), (1, 7, 6)), line()
    stated = line((1, 1, 5), (1, 5, 9), exclusive=True)
    timed = temporal.Timeline(apart.frame.withColumn("s", F.col("s").cast("timestamp")), ["k"], {"v": "e"}, "s", "e")
    sides = [touching, same_start, inside, apart, empty, stated, line(exclusive=False), timed]
    assert temporal.exclusive_periods(sides) == [False, False, False, True, True, True, False, False]


def test_dictionaries_with_and_without_overlaps(spark):
    """Overlaps are noticed: such a dictionary gives a row per period, the others one row per report."""
    day = dt.date(2024, 1, 10)
    reports = spark.createDataFrame([(1, day, "x"), (2, day, "y")], "k int, d date, note string")
    terms = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(9999, 12, 31)), (2, day, day)], "k int, date_start date, date_finish date")
    twice = spark.createDataFrame([(1, day, day, "a"), (1, dt.date(2024, 1, 2), day, "b")], "k int, s date, e date, v string")
    once = spark.createDataFrame([(1, dt.date(2024, 1, 2), day, "c"), (2, dt.date(2024, 1, 11), dt.date(9999, 12, 31), "z")], "k int, s date, e date, v string")
    dictionaries = [
        temporal.Dictionary(once, {"k": "k"}, {"first": "v"}, "s", "e"),
        temporal.Dictionary(twice, {"k": "k"}, {"second": "v"}, "s", "e"),
        temporal.Dictionary(spark.createDataFrame([("c", "see")], "v string, w string"), {"first": "v"}, {"third": "w"}),
    ]
    out = temporal.enrich_intervals(terms, reports, "k", "d", dictionaries)
    assert rows_of(out.select("k", "note", "first", "second", "third"), "k", "second") == [(1, "x", "c", "a", "see"), (1, "x", "c", "b", "see"), (2, "y", None, None, None)]


def test_movement_detail_is_the_same_by_either_join(spark):
    """A position held twice on a day is noticed and gives a row per position; without it both joins agree."""
    moves = spark.createDataFrame(
        [(1, dt.date(2024, 1, d), "t", "r", d) for d in (1, 5, 5, 9)] + [(2, None, "t", "r", 1), (None, dt.date(2024, 1, 5), "t", "r", 1)],
        "i_pernr int, action_date date, action_type string, action_reason string, org_id int",
    )
    end = dt.date(9999, 12, 31)
    rows = [
        (10, 1, "A008", dt.date(2024, 1, 1), dt.date(2024, 1, 4)), (11, 1, "A008", dt.date(2024, 1, 5), end),
        (10, 100, "B007", dt.date(2024, 1, 1), end), (11, 101, "B007", dt.date(2024, 1, 6), end), (11, 201, "BZ71", dt.date(2024, 1, 1), end),
    ]
    schema = "id_object int, id_connection_object int, connection_type string, date_start date, date_finish date"
    flags = spark.createDataFrame([("t", "r", 1)], "code_movement_type string, movement_motive string, permanent_movement int")
    edges = spark.createDataFrame(rows, schema)
    found = {e: sorted(map(repr, temporal.movement_detail(moves, edges, flags, exclusive=e).collect())) for e in (None, False, True)}
    assert found[None] == found[False] == found[True] and len(found[None]) == 6
    double = spark.createDataFrame([*rows, (12, 1, "A008", dt.date(2024, 1, 9), end)], schema)
    out = temporal.movement_detail(moves, double, flags)
    assert sorted(r.pos_id for r in out.where("org_id = 9").collect()) == [11, 12]
