"""The engine's operators: all SQL on a small scale, and cases that the tables don't hold."""

import math
import os
import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from frameloom import queries as Q
from frameloom.functions import vectors as V
from frameloom.operators import align, episodes, stats, tasks
from frameloom.plans import layouts
from frameloom.sources import episodes as src
from frameloom.sources import sinks

SF = "/root/testdata/sf0.001"


#: Halfway between two texts of six decimals, and other values whose text differs from language to language.
ODD = [0.0078125, -0.0703125, 0.0390625, 2.0234375, 8191.9921875, 0.0, -0.0, -1e-9, 4.9999999e-7, 16777217.0, 2.0**53, 2.0**63, -3.0000001e20, 3.4028234663852886e38, math.nan, math.inf, -math.inf]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_sql_gives_the_same(spark, duck, name):
    got = Q.QUERIES[name](spark, SF)
    cur = duck.execute(Q.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(got.columns)
    want = [tuple(map(plain, r)) for r in cur.fetchall()]
    assert sorted(map(repr, want)) == sorted(repr(tuple(map(plain, r))) for r in got.select(*cols).collect())


def same_as_sql_over(spark, folder, name, rows):
    """The query's rows and its SQL's over embeddings of ``rows``."""
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{folder}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    cur = con.execute(Q.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    want = [tuple(map(plain, r)) for r in cur.fetchall()]
    assert len(want) == len(rows)
    assert sorted(map(repr, want)) == sorted(repr(tuple(map(plain, r))) for r in Q.QUERIES[name](spark, folder).select(*cols).collect())


def halves(n):
    """Vectors all of whose values lie halfway between two texts of six decimals."""
    return [(i, [(-1) ** i * (2 * (64 * i + j) + 1) / 128 for j in range(64)], i % 2) for i in range(n)]


def test_six_decimals_are_those_of_c(spark):
    got = spark.createDataFrame([(ODD,)], "v array<float>").select(F.transform("v", V.six_decimals)).first()[0]
    floats = [struct.unpack("f", struct.pack("f", x))[0] for x in ODD]
    assert got == ["%.6f" % x for x in floats]
    assert spark.sql("SELECT CAST(NULL AS FLOAT) AS x").select(V.six_decimals("x")).first()[0] is None


def test_converted_values_halfway_are_as_in_sql(spark, tmp_path):
    same_as_sql_over(spark, str(tmp_path), "dataset_converted", halves(12))


def test_compact_values_halfway_are_as_in_sql(spark, tmp_path):
    same_as_sql_over(spark, str(tmp_path), "layout_compact", halves(6))


def test_state_action_values_halfway_are_as_in_sql(spark, tmp_path):
    odd = [v for v in ODD if not math.isnan(v)] + [None]
    same_as_sql_over(spark, str(tmp_path), "layout_state_action", [*halves(6), (6, (odd * 4)[:64], 1)])


def test_every_cell_of_the_state_machine():
    modes = ["IDLE", "RECORDING", "NEED_TO_SAVE", "FAILED", "DISCARD"]
    want = {
        episodes.START: ["RECORDING", *modes[1:]],
        episodes.STOP: ["IDLE", "NEED_TO_SAVE", *modes[2:]],
        episodes.DISCARD: ["IDLE", "DISCARD", "DISCARD", "DISCARD", "DISCARD"],
        episodes.TICK: ["IDLE", "RECORDING", "IDLE", "FAILED", "IDLE"],
        episodes.FAIL: ["IDLE", "FAILED", "FAILED", "FAILED", "DISCARD"],
    }
    for code, after in want.items():
        assert [episodes.step(m, code)[0] for m in modes] == after
    assert episodes.step("IDLE", episodes.START, prompt_ok=False) == ("IDLE", False, "WARN")
    assert episodes.step("IDLE", 77) == ("IDLE", False, "ERROR")


def test_age_of_exactly_the_limit_is_fresh(spark):
    t = lambda s: F.expr(f"TIMESTAMP_NTZ'2024-01-01 00:00:{s}'")
    row = spark.range(1).select(align.fresh(t("01.200"), t("01.000"), 0.2).alias("at"), align.fresh(t("01.201"), t("01.000"), 0.2).alias("over"), align.fresh(t("59"), t("01"), 0).alias("off")).first()
    assert (row["at"], row["over"], row["off"]) == (True, False, True)


def test_history_windows(spark):
    def at(n, index):
        df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array().cast("array<int>"), lambda x: x.cast("float")).alias("v"))
        return df.select(V.history_window("v", 29, index).alias("w")).first()["w"]

    assert at(290, -1) == [float(x) for x in range(261, 290)] and at(290, 0)[0] == 0.0 and at(58, -2)[0] == 0.0 and at(29, 5)[0] == 0.0
    for n, index in ((290, 10), (290, -11), (30, 0), (0, -1)):
        with pytest.raises(Exception, match="no window"):
            at(n, index)


def test_barrier_loses_values_of_fast_streams(spark):
    rows = [(1, k, s, float(k)) for k, s in enumerate("aabbabcab", 1)]
    got = align.barrier_zip(spark.createDataFrame(rows, "k int, o int, s string, v double"), "k", "o", "s", "v", ["a", "b"]).orderBy("o").collect()
    assert [(r["o"], r["a"], r["b"]) for r in got] == [(3, 2.0, 3.0), (5, 5.0, 4.0), (8, 8.0, 6.0)]


def test_stats_record_and_l2(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 2.0])], "e int, v array<double>")
    s = stats.vector_stats_record(df, ["e"], "v").first()["stats"]
    assert (s["min"], s["max"], s["mean"], s["std"], s["count"]) == ([1.0, 2.0], [3.0, 2.0], [2.0, 2.0], [1.0, 0.0], [2, 2])
    assert df.select(V.l2_distance("v", F.array(F.lit(1.0), F.lit(2.0))).alias("d")).orderBy("d").first()["d"] == 0.0


def test_fields_and_guards(tmp_path):
    known = {"target": ["a", "b"], "state": ["c"]}
    p = tmp_path / "f.yml"
    p.write_text("target: [a]\nstate: [c]\n")
    assert src.read_fields(str(p), known) == {"target": ["a"], "state": ["c"]}
    for bad in ("target: [a, a]\nstate: [c]", "target: []\nstate: [c]", "target: [z]\nstate: [c]", "target: [a]"):
        p.write_text(bad)
        with pytest.raises(ValueError):
            src.read_fields(str(p), known)
    with pytest.raises(ValueError):
        src.inside(str(tmp_path), "../x")
    with pytest.raises(ValueError):
        src.safe_name("../x")
    assert tasks.schema_difference(["a"], ["b"]) == (["b"], ["a"])


def test_files_are_replaced_together(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text("old")
    b.mkdir()
    (b / "x").write_text("in the way")
    sinks.replace_files({str(a): "new"})
    assert a.read_text() == "new" and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
    with pytest.raises(FileExistsError), sinks.staged(str(b)):
        pass
    with pytest.raises(RuntimeError), sinks.staged(str(tmp_path / "c")) as f:
        open(f"{f}/x", "w").close()
        raise RuntimeError
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]


def test_a_failure_while_files_are_swapped_puts_the_old_ones_back(tmp_path, monkeypatch):
    names = [tmp_path / n for n in "abc"]
    for p in names[:2]:
        p.write_text(f"old {p.name}")
    real, calls = os.rename, []

    def failing(x, y):
        calls.append(y)
        if str(y).endswith("/c"):
            raise OSError("disk full")
        real(x, y)

    monkeypatch.setattr(sinks.os, "rename", failing)
    with pytest.raises(OSError):
        sinks.replace_files({str(p): "new" for p in names})
    monkeypatch.undo()
    assert sorted((p.name, p.read_text()) for p in tmp_path.iterdir()) == [("a", "old a"), ("b", "old b")]


def test_stream_agrees_with_batch(spark, tmp_path):
    from frameloom.streaming import latest

    rows = spark.read.parquet(f"{SF}/events.parquet").where("user_id < 4").select("user_id", "event_id", F.expr(Q.MACHINE_CODE).alias("code"))
    rows.repartitionByRange(3, "event_id").sortWithinPartitions("event_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = latest.run_to_end(latest.command_machine(stream, "user_id", "event_id", "code"), "machine", str(tmp_path / "cp"))
    want = episodes.command_machine(rows, "user_id", "event_id", "code")
    assert math.isclose(got.count(), want.count()) and got.exceptAll(want).count() == 0


def test_as_of_stream_agrees_with_batch_and_keeps_values_over_nulls(spark, tmp_path):
    from frameloom.streaming import latest

    rows = [(1, f"2024-01-01 00:00:0{t}", t, trigger, v) for t, (trigger, v) in enumerate([(True, None), (False, 2.0), (False, None), (True, None), (False, 5.0), (True, None)], 1)]
    df = spark.createDataFrame(rows, "k int, t string, o int, trigger boolean, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    for k in range(0, 6, 2):
        df.where((F.col("o") > k) & (F.col("o") <= k + 2)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = latest.run_to_end(latest.asof_latest(stream, "k", "t", "o", "trigger", "v", 2.0), "asof", str(tmp_path / "cp"))
    assert {r["o"]: r["v"] for r in got.collect()} == {1: None, 4: 2.0, 6: 5.0}
    batch = align.merge_latest(df.where("trigger").select("k", "t", "o"), {"v": df.where("NOT trigger").select("k", "t", F.col("v").alias("value"))}, ["k"], "t", 2.0, only_complete=False)
    assert {r["o"]: r["v"] for r in batch.collect()} == {1: None, 4: 2.0, 6: 5.0}


def test_feeds_keep_the_latest_and_report(spark, tmp_path):
    from frameloom.streaming import feeds

    for k in range(3):
        rows = [(f"r{k % 2}", "gyro", f"2024-01-01 00:00:0{k}", [float(k)]), ("r9", "gyro", f"2024-01-01 00:00:0{2 - k}", [10.0 + k])]
        df = spark.createDataFrame(rows, "key string, name string, t string, value array<float>").select("key", "name", F.col("t").cast("timestamp_ntz").alias("ts"), "value")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = feeds.telemetry(spark, str(tmp_path / "in"), files_per_trigger=1)
    feeds.keep_latest(stream, ["key", "name"], "ts", ["value"], str(tmp_path / "last"), str(tmp_path / "cp1")).awaitTermination()
    last = max((tmp_path / "last").iterdir(), key=lambda p: int(p.name.split("=")[1]))
    assert {r["key"]: r["value"] for r in spark.read.parquet(str(last)).collect()} == {"r0": [2.0], "r1": [1.0], "r9": [10.0]}
    feeds.publish(stream, str(tmp_path / "out"), str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    levels = stream.withColumns({"level": F.when(F.col("key") == "r9", 2).otherwise(0), "message": F.col("name")})
    feeds.report_status(levels, ["key"], "level", "message", str(tmp_path / "status"), str(tmp_path / "cp3"), {"limit": "0.2"}).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "status")).where("key = 'r9'").collect()
    assert sum(r["n"] for r in found) == 3 and all(r["level"] == 2 and r["values"]["limit"] == "0.2" for r in found)


def test_prompt_of_white_space_is_blank_and_a_discarded_session_leaves_nothing(spark):
    rows = [(1, k, c, p) for k, (c, p) in enumerate([(1, "\t"), (1, "go"), (2, ""), (10, ""), (1, "\u3000"), (1, " x ")])]
    got = episodes.command_machine(spark.createDataFrame(rows, "k int, o int, c int, p string"), "k", "o", "c", "p").orderBy("o").collect()
    assert [r["mode"] for r in got] == ["IDLE", "RECORDING", "NEED_TO_SAVE", "IDLE", "IDLE", "RECORDING"] and [r["level"] for r in got] == ["WARN", "OK", "OK", "OK", "WARN", "OK"]
    frames = spark.createDataFrame([(1, k, c) for k, c in enumerate([1, None, None, 3, 1, None, 2, 1, None])], "k int, o int, c int")
    assert [(r["o"], r["session"]) for r in episodes.session_frames(frames, "k", "o", "c").orderBy("o").collect()] == [(5, 2), (8, 3)]


def test_folds_go_on_from_batch_to_batch(spark):
    from frameloom.operators.folds import fold_sorted

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").union(spark.range(5).select(F.lit(None).cast("long"), "id"))
        got = fold_sorted(rows, ["k"], ["id"], lambda s, r: (s + r[1], (r[0], s + r[1])), "k long, total long", 0)
        want = {k: sum(range(k, 1000, 3)) for k in range(3)} | {None: 10}
        assert {r["k"]: r["m"] for r in got.groupBy("k").agg(F.max("total").alias("m")).collect()} == want
        assert fold_sorted(rows.limit(0), ["k"], ["id"], lambda s, r: (s, r), "k long, id long").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_merge_reads_all_streams_in_one_window(spark):
    t = spark.range(3).select(F.col("id").alias("k"), F.expr("TIMESTAMP_NTZ'2024-01-01'").alias("ts"))
    plan = align.merge_latest(t, {n: t.withColumn("value", F.lit(1.0)) for n in "abcdef"}, ["k"], "ts", 1.0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Window") + plan.count("- Window") >= 1


def test_wrong_joint_names_and_lists_are_errors(spark):
    def run(names):
        rows = spark.createDataFrame([(0, k, n, 1.0) for k, n in enumerate(names)], "k int, o int, name string, effort double")
        return tasks.joint_state(rows, "k", "o", "name", ["effort"], {"_joint": "joint", "_cmd": "cmd"}, "effort").collect()

    got = run(["b_joint", "a_joint", "a_cmd", "b_cmd", "left"])[0]
    assert got["names"] == ["b", "a"] and got["rest_names"] == ["left"] and got["rest_effort"] == [1.0]
    for bad in (["a_joint"], ["a_joint", "a_joint", "a_cmd"], ["_joint", "_cmd"], ["a_joint", "a_cmd", "b_cmd"]):
        with pytest.raises(Exception, match="names don't match or repeat"):
            run(bad)
    with pytest.raises(Exception, match="differ in length"):
        spark.sql("SELECT array(1) AS x, array(1, 2) AS y").select(tasks.parallel_lists(["x", "y"])).collect()
    with pytest.raises(ValueError):
        tasks.distinct_names(["a", " a"])


def test_codec_failures_drop_an_image_only(spark):
    from frameloom.functions import images
    from frameloom.operators import bundles

    def decode(blob, unchanged):
        if blob == b"bad":
            raise ValueError
        return blob.upper() if not unchanged else blob

    df = spark.sql("SELECT 1 AS `a.b`, map('head', CAST('x' AS BINARY), 'ego', CAST('bad' AS BINARY), 'head_depth', CAST('y' AS BINARY)) AS images UNION ALL SELECT 2, NULL")
    got = {r["a.b"]: r["images"] for r in bundles.decode_packets(df, decode).collect()}
    assert got == {1: {"head": bytearray(b"X"), "head_depth": bytearray(b"y")}, 2: None}
    assert images.to_bytes([[[0.5, 2.0, -1.0]]]).tolist() == [[[127, 255, 0]]] and images.to_bytes([[[300, -5, 7]]]).tolist() == [[[255, 0, 7]]]
    with pytest.raises(ValueError):
        images.rgb_shape([[1, 2]])
    assert images.swap_channels(images.to_bytes([[[1, 2, 3]]])).tolist() == [[[3, 2, 1]]]
