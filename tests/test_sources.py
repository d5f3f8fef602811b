"""Publishing, partition replacement, ingest and the streaming forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import marks
from millrace.operators import anomaly, loads
from millrace.sources import ingest, sink
from millrace.streaming import increments


def test_publish_versions_and_gate(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        sink.read_table(spark, path)
    sink.publish(spark.range(3).toDF("k"), path)
    grown = sink.read_table(spark, path).union(spark.range(3, 5).toDF("k"))
    sink.publish(grown, path)
    assert sink.read_table(spark, path).count() == 5 and sink.current_version(spark, path) == 2
    verdict = spark.createDataFrame([("o", 1, dt.date(2024, 1, 1), False, True, "No")], "object string, log_id int, key_date date, ztest boolean, back boolean, msg string")
    assert sink.publish_if_accepted(grown, verdict, path) is None
    assert sink.publish_if_accepted(grown, verdict.withColumn("ztest", F.lit(True)), path) is not None
    assert anomaly.rejected_loads(verdict).first().error == "Ztest error No"


def test_replace_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "parts")
    first = spark.range(10).selectExpr("id as v", "id % 2 as p")
    sink.replace_partitions(first, path, ["p"])
    sink.replace_partitions(spark.range(1).selectExpr("id + 100 as v", "id % 2 as p"), path, ["p"])
    got = sorted(r.v for r in spark.read.parquet(path).collect())
    assert got == [1, 3, 5, 7, 9, 100]
    sink.append(first, path, ["p"])
    assert spark.read.parquet(path).count() == 16


def test_csv_export_is_typed(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("20240105101500;0000-00-00;X;7\n;2024-02-03;;8\n0;20240204;0;9\n")
    raw = T.StructType([T.StructField(n, T.StringType()) for n in ("hexportid", "d", "f")] + [T.StructField("ctl_loading", T.LongType())])
    target = T.StructType(
        [T.StructField("ts", T.TimestampType()), T.StructField("d", T.DateType()), T.StructField("f", T.BooleanType()), T.StructField("ctl_loading", T.LongType())]
    )
    df = ingest.read_export(spark, str(folder), "csv", raw, sep=";")
    rows = ingest.typed_ingest(df, target, above=6).orderBy("ctl_loading").collect()
    assert [r.ts for r in rows] == [dt.datetime(2024, 1, 5, 10, 15), None, None]
    assert [r.d for r in rows] == [None, dt.date(2024, 2, 3), dt.date(2024, 2, 4)]
    assert [r.f for r in rows] == [True, None, False]
    assert ingest.typed_ingest(df, target, above=8, inclusive=True, backfill=True).agg(F.min("ctl_loading")).first()[0] == -9


def test_stream_appends_each_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.range(5).toDF("k").write.parquet(source)
    for expected in (5, 8):
        stream = increments.stream_above_mark(increments.read_files(spark, source, "parquet", "k bigint"), "k", -1)
        increments.append_available(stream, target, state).awaitTermination()
        assert spark.read.parquet(target).count() == expected
        spark.range(5, 8).toDF("k").write.mode("append").parquet(source)


def test_a_dead_write_does_not_hinder_the_next(spark, tmp_path):
    path = str(tmp_path / "table")
    sink.publish(spark.range(3).toDF("k"), path)
    spark.range(9).write.parquet(f"{path}/v2-dead")  # a writer that died before it switched
    (tmp_path / "table" / "_current" / "v2").touch()  # and one that died while it switched
    assert sink.read_table(spark, path).count() == 3
    sink.publish(spark.range(4).toDF("k"), path)
    assert sink.read_table(spark, path).count() == 4 and sink.current_version(spark, path) == 3


def test_a_replayed_batch_is_published_once(spark, tmp_path):
    path = str(tmp_path / "table")
    first = sink.publish(spark.range(3).toDF("k"), path, batch=7)
    assert sink.publish(spark.range(5).toDF("k"), path, batch=7) == first and sink.current_version(spark, path) == 1
    sink.publish(spark.range(5).toDF("k"), path, batch=8)
    assert sink.read_table(spark, path).count() == 5


def test_stream_merge(spark, tmp_path):
    source, state, table = (str(tmp_path / n) for n in ("log", "state", "table"))
    spark.range(4).toDF("k").write.parquet(source)
    for expected in (4, 6):
        stream = increments.read_files(spark, source, "parquet", "k bigint")

        def merge(batch, batch_id):
            before = sink.read_table(spark, table) if sink.current_version(spark, table) else batch.limit(0)
            sink.publish(before.unionByName(batch), table, batch=batch_id)

        increments.merge_available(stream, merge, state).awaitTermination()
        assert sink.read_table(spark, table).count() == expected
        spark.range(4, 6).toDF("k").write.mode("append").parquet(source)


def test_stream_keeps_first_copies_and_late_rows(spark, tmp_path):
    source, state, target = (str(tmp_path / n) for n in ("log", "state", "out"))
    schema = "id int, k string, ts timestamp"

    def arrive(*rows):
        spark.createDataFrame([(i, k, dt.datetime(2024, 1, day)) for i, k, day in rows], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = increments.read_files(spark, source, "parquet", schema)
        increments.append_first_copies(stream, target, state, ["k"], "ts").awaitTermination()
        return sorted((r.id, r.k) for r in increments.read_copies(spark, target).collect())

    arrive((1, "a", 20), (2, "a", 21), (3, "b", 22))
    assert run() == [(1, "a"), (3, "b")]
    arrive((4, "c", 1), (5, "a", 2))  # weeks late: the new key is kept, the copy is still known
    assert run() == [(1, "a"), (3, "b"), (4, "c")]


def test_stream_of_envelopes(spark, tmp_path):
    source, state, target = (str(tmp_path / n) for n in ("files", "state", "out"))
    text = '{"data":[{"schema":{"name":"Agent_Events"},"payload":{"message_id":"1"}},{"schema":{"name":"Agent_Events"},"payload":{"message_id":"1"}}]}'
    schema = "file_name string, json_text string, is_parsed boolean, add_dtts timestamp"
    spark.createDataFrame([("f", text, False, dt.datetime(2024, 1, 1)), ("g", text, True, dt.datetime(2024, 1, 1))], schema).write.parquet(source)
    stream = increments.stream_envelopes(increments.read_files(spark, source, "parquet", schema), "add_dtts")
    increments.append_first_copies(stream, target, state, increments.ENVELOPE_KEY, "add_dtts").awaitTermination()
    assert [(r.file_name, r.schema_name, r.message_id) for r in increments.read_copies(spark, target).collect()] == [("f", "agent_events", "1")]


def test_marks_from_file_footers(spark, tmp_path):
    """Footers give rows and bounds without a scan; files without statistics, texts, times, doubles with NaN and empty tables are right too."""
    day, nan = dt.date(2024, 1, 1), float("nan")
    rows = [(i, day + dt.timedelta(i), f"t{i:03d}" + "x" * 80, float(i) if i else nan, dt.datetime(2024, 1, 1, i % 24), None) for i in range(50)]
    schema = "k bigint, d date, s string, x double, ts timestamp, nothing int"
    df = spark.createDataFrame([*rows, (None,) * 6], schema)
    want = {c: spark_bounds for c in df.columns for spark_bounds in [df.agg(F.min(c), F.max(c)).first()]}

    def values(bounds):
        row = spark.range(1).select(*[(F.lit(None) if b is None else b).alias(f"{c}_{i}") for c, pair in bounds.items() for i, b in enumerate(pair)]).first()
        return {c: (row[f"{c}_0"], row[f"{c}_1"]) for c in bounds}

    for name, options in (("noted", {}), ("bare", {"parquet.column.statistics.enabled": "false"})):
        path = str(tmp_path / name)
        df.repartition(3).write.options(**options).parquet(path)
        n, bounds = marks.stored_span(spark, path, df.columns)
        got = values(bounds)
        assert n == 51 and repr(got) == repr({c: tuple(w) for c, w in want.items()})
        assert values({"k": (marks.stored_edge(spark, path, "k"), None)})["k"][0] == 49
    df.limit(0).write.parquet(str(tmp_path / "empty"))
    assert marks.stored_span(spark, str(tmp_path / "empty"), ["k"]) == (0, {"k": (None, None)})
    assert marks.stored_edge(spark, str(tmp_path / "empty"), "s") is None
    fast = marks.footer_session(spark).read.parquet(str(tmp_path / "noted"))
    plan = marks.bounds(fast, ["k", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(k), MAX(k), MIN(d), MAX(d)]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_append_with_a_stored_mark(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(5).toDF("k").write.parquet(path)
    target, source = spark.read.parquet(path), spark.range(3, 8).toDF("k")
    mark = marks.stored_edge(spark, path, "k")
    for out in (loads.append_above_mark(source, target, "k", mark=mark), loads.newer_rows(source, target, "k", mark), loads.append_above_mark(source, target, "k")):
        assert sorted(r.k for r in out.collect()) == [5, 6, 7]
    assert sorted(r.k for r in loads.changed_slices(source, target, "k", mark=mark).collect()) == [4, 5, 6, 7]
