"""Small literal frames for the decided behaviours and for invariants."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from millrace.operators import anomaly, checks, cleaning, events, identity, loads, quality, runlog
from millrace.operators.quality import Period, VolumeCheck

D = dt.date


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_drift_is_negative_for_growth(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 10.0), (D(2024, 1, 2), 20.0)], "d date, v double")
    assert quality.aggregate_drift(df, "d", "sum(v)", D(2024, 1, 2), "day", 1).first().pct == -0.5
    assert quality.aggregate_drift(df, "d", "sum(v)", D(2024, 1, 5), "day", 1).first().pct is None


def test_freshness_units(spark):
    df = spark.createDataFrame([(D(2023, 11, 30),)], "d date")
    got = {u: quality.freshness(df, "d", D(2024, 2, 28), u).first().date_diff for u in ("day", "week", "month")}
    assert got == {"day": 90.0, "week": 12.857143, "month": -9.0}
    assert quality.freshness(df, "d", D(2024, 2, 28), "month", full_months=True).first().date_diff == 2.0


def test_categorical_stability(spark):
    b, t = D(2024, 1, 1), D(2024, 2, 1)
    df = spark.createDataFrame([(b, "x"), (b, "y"), (b, None), (t, "x"), (t, "xxx"), (t, "xxx")], "d date, c string")
    got = quality.stability_categorical(df, "c", "d", Period(b, b), Period(t, t)).first().psi
    third = 1 / 3
    expected = (third - third) * 0 + (third - 0) * math.log(third / 1e-4) + (third - 2 * third) * math.log(third / (2 * third))
    assert got == round(abs(expected), 4)
    assert quality.stability_categorical(df, "c", "d", Period(b, b), Period(b, b)).first().psi == 0.0


def test_missing_target_bin_drops_out(spark):
    b, t = D(2024, 1, 1), D(2024, 2, 1)
    df = spark.createDataFrame([(b, float(i)) for i in range(20)] + [(t, 1.0)] * 20, "d date, v double")
    rows = {r.group_cd: r for r in quality.stability_continuous(df, "v", "d", Period(b, b), Period(t, t)).collect()}
    # All target values tie at rank 1: bin 0 holds everything, the other bins have no partner.
    assert rows["0"].pct_target == 1.0 and rows["3"].pct_target is None and rows["3"].psi is None
    assert rows["9999"].psi == rows["0"].psi
    smooth = {r.group_cd: r for r in quality.stability_continuous(df, "v", "d", Period(b, b), Period(t, t), smooth_missing=True).collect()}
    assert smooth["9999"].psi != rows["9999"].psi
    assert rows["10"].ubound == 24.0
    closed = {r.group_cd: r for r in quality.stability_continuous(df, "v", "d", Period(b, b), Period(t, t), last_bound=None).collect()}
    assert closed["10"].ubound == 19.0


def test_volume_verdicts(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), 1), (D(2023, 12, 31), 1), (D(2023, 12, 31), None)], "d date, v int")
    at = D(2024, 2, 10)
    ok = quality.period_volume(df, [VolumeCheck("t", "v", "d", low=0.5, high=1.5)], at).first()
    assert (ok.res, ok.val2chk, ok.ratio_1) == (1, 1, 1.0)
    no = quality.period_volume(df, [VolumeCheck("t", "v", "d", low=5, high=9)], at).first()
    empty = quality.period_volume(df, [VolumeCheck("t", "v", "d", low=5, high=9)], D(2020, 2, 10)).first()
    assert no.res == 0 and empty.res == -1 and empty.error == "Empty data"
    suite = quality.check_suite(spark, [VolumeCheck("t", "zz", "d"), VolumeCheck("t", "v", "d", low=0.5, high=1.5)], {"t": df}, at)
    assert sorted(r.res for r in suite.collect()) == [-99, 1]
    summary = quality.suite_summary(suite).first()
    assert (summary.verdict, summary.res, summary.msg) == ("Error", -1, "True 1, Error 1")


def test_suite_metrics_share_scans(spark, tmp_path):
    """Twelve metrics of one table: one scan for those on date ranges, one for those on the whole table, one for a drift
    that is no plain aggregate call; every verdict is that of the metric alone."""
    days = [(D(2023, 12, 31), 4.0, "a"), (D(2024, 1, 31), 1.0, ""), (D(2024, 1, 31), None, "b"), (D(2024, 1, 15), 9.0, None), (None, 2.0, "c")]
    spark.createDataFrame([*days, (D(2199, 1, 1), -1.0, "x")], "d date, `v v` double, t string").write.parquet(str(tmp_path / "t"))
    df, at = spark.read.parquet(str(tmp_path / "t")), D(2024, 2, 10)

    def check(metric, field, unit="month", **params):
        return VolumeCheck("t", field, "d", metric=metric, unit=unit, low=-0.9, high=2.5, params=params)

    plain = [
        check("aggregate_drift", "v v", aggregate="sum(`v v`)"),
        check("aggregate_drift", "v v", "year", aggregate="count(1)"),
        check("aggregate_drift", "t", aggregate="max(length(t))"),
        check("nonnull_ratio", "t"),
        check("nonnull_ratio", "v v", "quarter"),
        check("nonnull_ratio", "t", "day"),
        check("freshness", "d"),
        check("freshness", "d", "year"),
        check("out_of_range", "v v", low=0, high=3),
        check("out_of_range", "v v", kind="int", low=0, high=100),
        check("insane_dates", "d"),
        check("aggregate_drift", "t", aggregate="count(distinct t)"),
    ]
    faulty = [check("out_of_range", "t", kind="no such type", low=0, high=1), check("out_of_range", "t"), check("aggregate_drift", "t", aggregate="nothing(t)")]
    suite = quality.check_suite(spark, plain, {"t": df}, at)
    alone = [tuple(quality.metric_verdict(df, c, at).first()) for c in plain]
    assert sorted(map(tuple, suite.collect()), key=repr) == sorted(alone, key=repr)
    assert {r[3] for r in alone} == {-1, 0, 1}
    plan = suite._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 4  # the last drift and the one with a nested call run alone
    both = quality.check_suite(spark, plain + faulty, {"t": df}, at).collect()
    assert sorted(r.res for r in both) == sorted([-99] * 3 + [r[3] for r in alone])


def test_p_value_of_a_huge_score_is_zero(spark):
    df = spark.createDataFrame([(1.96,), (500.0,), (-0.04,)], "zscore double")
    got = [r.p_value for r in anomaly.with_p_value(df).orderBy("zscore").collect()]
    assert got == [1.0, 0.0455, 0.0]


HIST = "object string, key_date date, rows_count bigint, value bigint, ztest boolean, ts timestamp, log_id bigint, avg bigint, std bigint, cnt bigint, min bigint, max bigint"
CAND = "object string, key_dates array<date>, rows_count bigint, log_id bigint, ts timestamp"


def _hist(spark, *points):
    rows = [("o", day, rows, value, ok, dt.datetime(2024, 1, 1, hour), i, 1, 2, 3, 4, 5) for i, (day, rows, value, ok, hour) in enumerate(points)]
    return spark.createDataFrame(rows, HIST)


def _candidate(spark, day, rows):
    return spark.createDataFrame([("o", [day], rows, 99, dt.datetime(2024, 2, 1))], CAND)


def test_growth_without_config_and_first_load(spark):
    config = spark.createDataFrame([], anomaly.CONFIG_SCHEMA)
    first = anomaly.growth_verdicts(_candidate(spark, D(2024, 1, 9), 5), _hist(spark), config, D(2024, 2, 1)).first()
    assert (first.ztest, first.msg, first.value) == (True, "Ok first", None)


def test_growth_division_truncates_and_null_verdict_wins(spark):
    config = spark.createDataFrame([], anomaly.CONFIG_SCHEMA)
    hist = _hist(spark, (D(2024, 1, 1), 100, 7, True, 5), (D(2024, 1, 1), 200, 3, None, 1))
    got = anomaly.growth_verdicts(_candidate(spark, D(2024, 1, 5), 197), hist, config, D(2024, 2, 1)).first()
    # The untested row (200 rows) is the newest verdict of the day; (197 - 200) / 4 truncates to 0.
    assert (got.value, got.key_diff, got.cnt) == (0, 4, 2)


def test_inactive_object_is_skipped_and_gate(spark):
    config = spark.createDataFrame([("o", False, True, None, None, None)], anomaly.CONFIG_SCHEMA)
    hist = _hist(spark, *[(D(2024, 1, i), 100 * i, 100, True, 1) for i in range(1, 9)])
    cand = _candidate(spark, D(2024, 1, 9), 9000)
    assert anomaly.growth_verdicts(cand, hist, config, D(2024, 2, 1)).isEmpty()
    strict = config.withColumn("active", F.lit(True)).withColumn("z_cfg", F.lit('{"max": 150}'))
    verdicts = anomaly.growth_verdicts(cand, hist, strict, D(2024, 2, 1))
    row = verdicts.first()
    assert (row.ztest, row.msg, row.avg, row.max) == (False, "No > max", 1, 5)
    assert not anomaly.accepted(verdicts)


def test_recalculation_equals_one_verdict_at_a_time(spark):
    config = spark.createDataFrame([("o", True, False, '{"dots": 6}', [D(2024, 1, 12)], [D(2024, 1, 6)])], anomaly.CONFIG_SCHEMA)
    sizes = [100, 110, 121, 130, 142, 150, 161, 900, 910, 921, 930, 940, 951, 20, 30]
    hist = _hist(spark)
    loads_rows = [(1000 + i, "o", [D(2024, 1, i + 1)], n, dt.datetime(2024, 1, i + 1, 12)) for i, n in enumerate(sizes)]
    state = hist
    expected = []
    for log_id, obj, days, n, ts in loads_rows:
        cand = spark.createDataFrame([(obj, days, n, log_id, ts)], CAND)
        out = anomaly.growth_verdicts(cand, state, config, D(2024, 2, 1)).collect()
        row = out[0]
        expected.append((row.log_id, row.ztest, row.msg, row.value, row.cnt, row.avg, row.std, round(row.zscore, 9) if row.zscore is not None else None))
        keep = [tuple(r) for r in state.collect()]
        keep.append((obj, row.key_date, row.rows_count, row.value, row.ztest, ts, row.log_id, row.avg, row.std, row.cnt, row.min, row.max))
        state = spark.createDataFrame(keep, HIST)
    frame = spark.createDataFrame(loads_rows, "log_id bigint, object string, key_dates array<date>, rows_count bigint, ts timestamp")
    got = [
        (r.log_id, r.ztest, r.msg, r.value, r.cnt, r.avg, r.std, round(r.zscore, 9) if r.zscore is not None and not math.isnan(r.zscore) else None)
        for r in anomaly.recalculate(frame, hist, config, dt.datetime(2023, 1, 1), D(2024, 2, 1)).orderBy("log_id").collect()
    ]
    assert got == expected


def test_both_recalculations_agree_on_an_object_with_a_third_of_all_loads(spark):
    pick = random.Random(5)
    names = ["hot"] * 60 + [f"o{i % 12}" for i in range(120)]
    pick.shuffle(names)
    loads = []
    for i, name in enumerate(names):
        # Several loads a date, dates out of log order, dates that go back, negative and repeated sizes.
        day = D(2024, 1, 1 + pick.randrange(9))
        loads.append((1000 + i, name, [day], pick.choice([-5, 40, 90, 100, 100, 120, 400, 2000]), dt.datetime(2024, 1, 20, i % 24)))
    hist = [
        (name, D(2023, 12, d), 80 + d, pick.choice([None, 0, 1, 2, 3]), pick.choice([None, True, False]), dt.datetime(2023, 12, d, h), 10 * d + h, 1, 2, 3, 4, 5)
        for name in ("hot", "o1", "o2", "unseen") for d in range(20, 31) for h in (1, 2)
    ]
    config = [
        ("hot", True, False, '{"dots": 3, "hist": 99}', [D(2024, 1, 3)], [D(2024, 1, 5)]),
        ("o1", True, False, '{"interval": "2 days", "min": 0, "skip": false}', None, None),
        ("o2", False, False, None, None, None),
        ("o3", True, False, '{"beg": "2024-01-03", "end": "2024-01-07", "max": 50, "zfr": -1}', None, None),
    ]
    inputs = (
        spark.createDataFrame(loads, "log_id bigint, object string, key_dates array<date>, rows_count bigint, ts timestamp"),
        spark.createDataFrame(hist, HIST), spark.createDataFrame(config, anomaly.CONFIG_SCHEMA), dt.datetime(2024, 1, 1), D(2024, 2, 1),
    )

    def rows(df):
        shown = df.select(*anomaly.VERDICT).withColumn("zscore", F.round("zscore", 6)).collect()
        return sorted((tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in shown), key=lambda r: r[anomaly.VERDICT.index("log_id")])

    stepwise = anomaly.recalculate_by_steps(*inputs)
    assert "Python" not in stepwise._jdf.queryExecution().executedPlan().toString()
    got = rows(stepwise)
    assert len(got) == sum(n != "o2" for n in names) and got == rows(anomaly.recalculate(*inputs))


def test_recalculation_by_steps_of_nothing(spark):
    none = spark.createDataFrame([], "log_id bigint, object string, key_dates array<date>, rows_count bigint, ts timestamp")
    out = anomaly.recalculate_by_steps(none, _hist(spark), spark.createDataFrame([], anomaly.CONFIG_SCHEMA), dt.datetime(2024, 1, 1), D(2024, 2, 1))
    assert out.columns == list(anomaly.VERDICT) and out.isEmpty()


def test_refresh_scores_judge_touched_days_only(spark):
    points = spark.createDataFrame([("m", D(2024, 1, d), dt.datetime(2024, 1, 9), 4) for d in range(1, 5)], "object string, day date, calc_dt timestamp, value bigint")
    mart = spark.createDataFrame([(D(2024, 1, 1 + i % 4),) for i in range(16)] + [(D(2024, 1, 4),)] * 8, "day date")
    changed = mart.where("day >= date '2024-01-03'")
    got = loads.refresh_scores(mart, changed, points, "m", "day", dt.datetime(2024, 1, 10)).orderBy("date_field_value").collect()
    assert [(r.date_field_value.day, r.field_value, r.avg_value) for r in got] == [(3, 4, 6.0), (4, 12, 6.0)]
    assert loads.refresh_scores(mart, changed.where("false"), points, "m", "day", dt.datetime(2024, 1, 10)).isEmpty()


def test_toggle_twice_restores(spark):
    config = spark.createDataFrame([("o", True, False, None, [D(2024, 1, 2)], [])], anomaly.CONFIG_SCHEMA)
    change = spark.createDataFrame([("o", D(2024, 1, 9))], "object string, day date")
    once = anomaly.toggle_dates(config, change, "z_except")
    assert once.first().z_except == [D(2024, 1, 9), D(2024, 1, 2)]
    assert anomaly.toggle_dates(once, change, "z_except").first().z_except == [D(2024, 1, 2)]


def _orders(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, load_date date, mod_date date")


def test_history_merge_is_idempotent_and_keeps_first_seen(spark):
    new = _orders(spark, [(1, "a", D(2024, 1, 8), D(2024, 1, 8)), (None, "n", D(2024, 1, 8), D(2024, 1, 8))])
    empty = loads.hash_history_merge(new, new.withColumn("hash", F.lit("")).limit(0), ["k"], ["load_date"])
    later = _orders(spark, [(1, "a", D(2024, 2, 8), D(2024, 2, 8)), (1, "b", D(2024, 2, 8), D(2024, 2, 8)), (None, "n", D(2024, 2, 8), D(2024, 2, 8))])
    once = loads.hash_history_merge(later, empty, ["k"], ["load_date"])
    twice = loads.hash_history_merge(later, once, ["k"], ["load_date"])
    delta = loads.hash_history_merge(later, empty, ["k"], ["load_date"], touch_only_matching=True)
    key = ["k", "v"]
    assert rows_of(once, *key) == rows_of(twice, *key) == rows_of(delta, *key)
    assert {(r.k, r.v): r.mod_date for r in once.collect()} == {
        (1, "a"): D(2024, 1, 8), (1, "b"): D(2024, 2, 8), (None, "n"): D(2024, 1, 8)
    }


def test_snapshot_drops_keys_that_left_the_partition(spark):
    cols = "k int, report_date date, actual_date date, ctl_loading int, load_date date, hash string, mod_date date"
    day = D(2024, 1, 1)
    old = spark.createDataFrame([(1, day, day, 1, day, "a", day), (2, day, day, 1, day, "b", day), (3, D(2023, 1, 1), day, 1, day, "c", day)], cols)
    later = D(2024, 1, 9)
    new = spark.createDataFrame([(1, day, later, 2, later, "a", later)], cols)
    got = rows_of(loads.snapshot_replace(new, old, ["k", "report_date"], "report_date").select("k", "actual_date", "mod_date"), "k")
    assert got == [(1, later, day), (3, day, day)]


def test_full_reload_statuses(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert loads.full_reload_if_changed(a, a)[0] == "No New data"
    assert loads.full_reload_if_changed(a.limit(1), a)[0] == "No New data"
    assert loads.full_reload_if_changed(a.where("k = 1"), a, detect_deletes=True)[0] == "Ok"
    assert loads.full_reload_if_changed(a.limit(0), a)[0] == "No data"
    assert loads.reload_newer(a, a, "k")[0] == "No New data"
    status, rows = loads.reload_newer(a, a.where("k = 1"), "k")
    assert status == "Ok" and rows_of(rows) == [(2, "y")]


def test_load_without_target_rows(spark):
    source = spark.createDataFrame([(1, "x")], "k int, v string")
    assert loads.append_above_mark(source, source.limit(0), "k").count() == 1
    out = loads.date_range_replace(source.limit(0).withColumn("d", F.lit(D(2024, 1, 1))), source.withColumn("d", F.lit(D(2024, 1, 1))), "d")
    assert out.count() == 1


def test_blank_texts_are_null(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("a",)], "v string")
    assert checks.null_counts(df).first().null_cnt == 3


def test_fingerprint_ignores_order_but_not_copies(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "k int, v string")
    twice = a.union(a)
    h = [checks.fingerprint(f).first().hash for f in (a, b, twice, a.limit(0))]
    assert h[0] == h[1] and len(set(h)) == 3
    assert checks.custom_fingerprint(a, "count(*) as cnt, max(concat(k, ',', v)) as m").first().m == "2,y"


def test_archive_gate_switch(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "s", True, 2, False, 9, False)], "b int, e date, srs string, arch_ok boolean, arch_cnt int, cnt_ok boolean, row_cnt int, ok boolean")
    assert checks.archive_gate(df, "b", "e").first().rejected
    assert not checks.archive_gate(df, "b", "e", either=False).first().rejected


def test_reference_names_empty_table(spark):
    df = spark.createDataFrame([("a", ["a", "b"])], "n string, rel array<string>")
    assert [r.wf for r in checks.dangling_references(df, "n", ["rel"]).collect()] == ["b"]


def test_empty_nested_array_counts_as_parsed(spark):
    text = '{"message_id":"1","user_info":[]}'
    messages = spark.createDataFrame([(D(2024, 1, 1), "f", "BulkAgentServices_Events", "h", text, 0)], "load_date date, file_name string, schema_name string, hash string, payload_json string, is_parsed int")
    assert events.shred_nested(messages, ["message_id", "user_info"]).isEmpty()
    assert events.mark_routed(messages).first().is_parsed == 1
    assert [r.file_name for r in events.complete_files(events.mark_routed(messages)).collect()] == ["f"]
    assert events.payload_fields(messages) == {"bulkagentservices_events": ["message_id", "user_info"]}


def test_duplicates_keep_switch(spark):
    df = spark.createDataFrame([(i, "k", D(2024, 1, 1)) for i in (1, 2, 3)], "id int, k string, d date")
    assert [r.id for r in identity.sliding_duplicates(df, F.col("k"), "d", "id").collect()] == [3]
    assert sorted(r.id for r in identity.sliding_duplicates(df, F.col("k"), "d", "id", keep="first").collect()) == [2, 3]


def test_array_texts(spark):
    df = spark.createDataFrame([("{a,b}",), ("[a, b]",), ('{"x,y",z}',), ("{}",), ("{a,NULL}",), ("plain",), (None,)], "v string")
    got = [r[0] for r in df.select(cleaning.to_array(F.col("v"))).collect()]
    assert got[0] == got[1] == ["a", "b"] and got[3] == [] and got[4] == ["a", None] and got[5] is None and got[6] is None


def test_json_repair_keeps_whole_text(spark):
    long_text = '{"k":"' + "v" * 50000 + '"}'
    df = spark.createDataFrame([(long_text,), ('{"k":"中' + 'a"}',), ("{",), (None,)], "raw string")
    got = [(r.repaired, r.stage) for r in cleaning.repair_json(df, "raw").collect()]
    assert got[0] == (long_text, "as is") and got[2] == (None, None) and got[3] == (None, None)


def test_standard_text(spark):
    df = spark.createDataFrame([(" \t a b\t ",), ("--",), ("Ж",), (None,)], "v string")
    assert [r[0] for r in df.select(cleaning.standard_text(F.col("v"))).collect()] == [" a b", None, "Ж", None]


def test_exchange_diagnostics(spark):
    log = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), "w", "k", '{"type":"OUT","cnt":5,"sum_len":9,"time":"00:01:00"}'), (1, dt.datetime(2024, 1, 2), "w", "k", '{"type":"OUT","cnt":6,"sum_len":9,"time":"1 day"}')],
        "id int, ts timestamp, wf_name string, wf_key string, wf_data string",
    )
    row = runlog.exchange_batches(log).first()
    assert not row.completed and row.time_s == 86460 and row.wf_data == '{"ts":"2024-01-02 00:00:00","type":"OUT","cnt":6}'


def test_outcome_of_null_is_error(spark):
    df = spark.createDataFrame([(None,), ("ok",), ("okay",)], "t string")
    assert [r[0] for r in df.select(runlog.outcome_code("t")).collect()] == [-9, 1, -9]


def test_row_growth_of_empty_status_list(spark):
    snap = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "loading", "u", '{"alive":"ACTIVE"}')], "id int, ts timestamp, obj string, url string, msg string")
    row = runlog.latest_loads(snap).first()
    assert row.status_dttm is None and row.alive == "ACTIVE"


def test_rows_to_append(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    target = a.where("k = 2")
    assert loads.rows_to_append(a, target, loads.LoadConfig("INSERT")).count() == 3
    assert rows_of(loads.rows_to_append(a, target, loads.LoadConfig("EXCEPT"))) == [(1, "x")]


def test_partition_fingerprints_merge_and_show_the_touched_partition(spark):
    rows = [(i % 40, i, f"v{i}") for i in range(4000)] + [(None, 1, "x")] * 3
    table = spark.createDataFrame(rows, "part int, k int, v string")
    touched = table.withColumn("v", F.when(F.col("k") == 57, "other").otherwise(F.col("v"))).where("part is null or part <> 5")
    before, after = (checks.partition_fingerprints(f, ["part"]) for f in (table, touched))
    assert checks.merged_fingerprint(before).first() == checks.fingerprint(table).first()
    assert checks.merged_fingerprint(before.limit(0)).first().cnt == 0
    assert sorted(map(tuple, checks.changed_partitions(after, before, ["part"]).collect())) == [(5, "gone", None, 100), (17, "changed", 100, 100)]
    assert checks.changed_partitions(before, before, ["part"]).isEmpty()


def test_concurrency_sweep_equals_slots(spark):
    """Long, short, empty and overlapping runs of few workflows against a plain count per slot."""
    import random

    from millrace.operators import reports

    rng, day = random.Random(4), dt.date(2024, 1, 20)
    start = dt.datetime(2024, 1, 19, 20)
    runs = []
    for i in range(200):
        at = start + dt.timedelta(seconds=rng.randrange(30 * 3600))
        runs.append((rng.choice(["a", "b", "c", None]), at, rng.choice([None, at, at + dt.timedelta(seconds=rng.choice([1, 599, 600, 4000, 90000]))])))
    runs.append(("d", dt.datetime(2024, 1, 20, 3), dt.datetime(2024, 1, 20, 3)))
    got = reports.concurrency_load(spark.createDataFrame(runs, "workflow string, start_ts timestamp, end_ts timestamp"), day, 4).collect()
    for row in got:
        for m in range(0, 60, 10):
            lo = dt.datetime.combine(day, dt.time(row.hour, m))
            hi = lo + dt.timedelta(minutes=10)
            inside = [(w, (min(e, hi) - max(s, lo)).total_seconds()) for w, s, e in runs if e and s < hi and e > lo]
            assert row[f"cnt_{m:02d}"] == len({w for w, _ in inside if w})
            assert abs(row[f"rate_{m:02d}"] - sum(b for _, b in inside) / 2400) < 0.0051


def test_workflow_catalogue_from_odd_snapshots(spark, tmp_path):
    """Both shapes and their connections, repeated ids in an answer, older answers, broken messages; the snapshots are read once."""

    def at(day):
        return dt.datetime(2024, 1, day)

    def wf(i, name, sched="null", category="hr.a"):
        return (
            f'{{"id":{i},"name":"{name}","category":"{category}","scheduled":true,"deleted":"no","eventAwaitStrategy":"and",'
            f'"wf_event_sched":{sched},"wf_time_sched":{{"sched":"daily"}},"param":[{{"param":"wf_interval","prior_value":"2 days"}}]}}'
        )

    sched = '[{"active":"true","profile":"HR","stat_id":"5","entity_id":"70"},{"active":"x","profile":"HR","stat_id":"5","entity_id":"71"}]'
    rows = [
        (1, "wf", at(1), "/wf/extended", f'{{"wf":{wf(1, "older")},"connectedEntities":[9]}}'),
        (1, "wf", at(2), "/wf/extended", f'{{"wf":{wf(1, "one", sched)},"connectedEntities":[8,7,7]}}'),
        (2, "wf", at(1), "/wf/extended", f'{{"wf":{wf(2, "older")},"connectedEntities":[9]}}'),
        (500, "load", at(3), "/loading/500", f'{{"workflow":{wf(2, "two")}}}'),
        (3, "wf", at(1), "/wf/extended", f'{{"wf":{wf(3, "other", category="zz")}}}'),
        (4, "wf", at(1), "/wf/extended", '{"wf":{"id":4,"category"'),
        (5, "wf", at(1), "/wf/extended", None),
        (None, None, None, None, None),
        # The newest answer about workflow 2 lists 6 twice; 9 was only in the older one.
        *[(i, "entity", at(d), "/entity/wf/2", f'{{"name":"n{i}_{d}"}}') for i, d in ((9, 1), (6, 2), (6, 2), (5, 2))],
        (7, "entity", at(2), "/entity/7", '{"name":"seven"}'), (7, "entity", at(1), "/entity/7", '{"name":"seventeen"}'),
        (8, "entity", at(1), "/entity/8", "no json"),
        (30, "statval", at(1), "/statval", '{"entity_id":"70","stat_id":"5","profile":"HR"}'),
        (31, "statval", at(2), "/statval", '{"entity_id":"70","stat_id":"5","profile":"HR"}'), (32, "statval", at(3), "/statval", "{"),
        (31, "loading", at(1), "/l", '{"end_dttm":"2024-01-05 06:07:08"}'), (31, "loading", at(2), "/l", '{"end_dttm":"2024-01-06 06:07:08"}'),
        (30, "loading", at(2), "/l", '{"end_dttm":"never"}'),
    ]
    schema = "id bigint, obj string, ts timestamp, url string, msg string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "api"))
    out = runlog.workflow_catalogue(spark.read.parquet(str(tmp_path / "api")), "hr")
    got = [(r.id, r.name, r.connected, r.wf_sched, r.scheduled, r.deleted, r.wf_interval_s) for r in out.orderBy("id").collect()]
    assert got == [
        (1, "one", "8: , 7: seven, 7: seven", "and: HR [5] {70 (2024-01-06 06:07:08)}", True, False, 172800),
        (2, "two", "5: n5_2, 6: n6_2, 6: n6_2", "sched: daily", True, False, 172800),
    ]
    assert str(tmp_path) not in out._jdf.queryExecution().optimizedPlan().toString()
    assert runlog.workflow_catalogue(spark.createDataFrame([], schema), "hr").isEmpty()


def _most_joined(df):
    """Rows out of the join of ``df`` that puts out most, after a run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    found, open_ = [0], [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            open_.append(node.executedPlan())
        elif "QueryStage" in name:
            open_.append(node.plan())
        else:
            if "Join" in name:
                found.append(node.metrics().get("numOutputRows").get().value())
            children = node.children()
            open_.extend(children.apply(i) for i in range(children.size()))
    return max(found)


def test_most_frequent_name_meets_a_name_a_few_times_per_range(spark):
    n, names = 4000, 5
    dictionary = spark.range(n).selectExpr("id as code", f"concat('n', id % {names}) as name")
    rows = spark.range(300).selectExpr("id", "concat('x (коды ', 100 + id, '-', 3900 - id, ')') as val")
    got = checks.most_frequent_name(rows, "id", "val", dictionary, "code", "name")
    assert _most_joined(got) <= 300 * names * 2 * 12


def test_most_frequent_name_agrees_with_a_plain_search(spark):
    rng = random.Random(5)
    words = [None, "a", "b", "c", "d"]
    entries = [(rng.choice([None, rng.randint(3, 70), rng.randint(3, 70)]), rng.choice(words)) for _ in range(150)]
    spans = [(rng.randint(0, 80), rng.randint(0, 90)) for _ in range(200)] + [(3, 70), (0, 2), (70, 70), (0, 2_000_000_000), (71, 99)]
    dictionary = spark.createDataFrame(entries, "code int, name string")
    rows = spark.createDataFrame([(i, f"x (коды {lo}-{hi})") for i, (lo, hi) in enumerate(spans)] + [(-1, None), (-2, "nan"), (-3, "12")], "id int, val string")

    def plain(lo, hi):
        counted = {w: sum(c is not None and lo <= c <= hi and x == w for c, x in entries) for w in words}
        most = max(counted.values())
        return "" if not most else min(((w or "") for w in words if counted[w] == most))

    expected = {i: plain(lo, hi) for i, (lo, hi) in enumerate(spans)} | {-1: "", -2: "", -3: plain(12, 12)}
    got = checks.most_frequent_name(rows, "id", "val", dictionary, "code", "name")
    assert {r.id: r.main_name for r in got.collect()} == expected
    empty = checks.most_frequent_name(rows, "id", "val", dictionary.where("false"), "code", "name")
    assert {r.main_name for r in empty.collect()} == {""}
