"""Queries of the engine's operators over the test tables, and the same in DuckDB SQL."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.functions import names as N
from frameloom.functions import vectors as V
from frameloom.operators import align, bundles, episodes, stats, tasks
from frameloom.plans import convert, documents, layouts, writer
from frameloom.sources import episodes as src
from frameloom.sources import sinks, video
from frameloom.streaming import feeds

HOUR = 3600.0
SESSION_CODE = "CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 END"
MACHINE_CODE = "CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 WHEN 'view' THEN 10 ELSE 11 END"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = _table(spark, d, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return clicks, events.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("view_value"), F.col("event_id").alias("view_id"))


def asof_latest(spark: SparkSession, d: str) -> DataFrame:
    clicks, views = _sides(spark, d)
    return align.asof_latest(clicks, views, ["user_id"], "ts", ["view_value", "view_id"], 6 * HOUR).drop("ts_of")


def asof_optional_default(spark: SparkSession, d: str) -> DataFrame:
    clicks, views = _sides(spark, d)
    out = align.merge_latest(clicks, {"view": views.select("user_id", "ts", F.col("view_value").alias("value"))}, ["user_id"], "ts", 0, {"view": F.lit(0.0)})
    return out.select("event_id", "user_id", F.col("view").alias("view_value"), (F.size("missing") > 0).alias("missing"))


def merge_required(spark: SparkSession, d: str) -> DataFrame:
    events = _table(spark, d, "events").select("user_id", "ts", "value", "event_type", "event_id")
    one = lambda k: events.where(F.col("event_type") == k).select("user_id", "ts", "value")
    trigger = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return align.merge_latest(trigger, {"view": one("view"), "signup": one("signup")}, ["user_id"], "ts", 48 * HOUR).select("event_id", "user_id", "view", "signup")


def merge_many(spark: SparkSession, d: str) -> DataFrame:
    """Three streams, one of them optional, in one window; a null value displaces none."""
    events = _table(spark, d, "events").select("user_id", "ts", "value", "event_type", "event_id")
    one = lambda k: events.where(F.col("event_type") == k).select("user_id", "ts", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    trigger = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    streams = {k: one(k) for k in ("view", "signup", "error")}
    out = align.merge_latest(trigger, streams, ["user_id"], "ts", 48 * HOUR, {"error": F.lit(-1.0)}, only_complete=False)
    return out.select("event_id", "view", "signup", "error", F.array_join("missing", ",").alias("missing"))


def tick_resample(spark: SparkSession, d: str) -> DataFrame:
    events = _table(spark, d, "events").select("user_id", "ts", "value")
    return align.tick_resample(events, ["user_id"], "ts", ["value"], "2024-01-01 00:00:00", "2024-01-31 00:00:00", "12 HOURS", 24 * HOUR).select("user_id", "ts", "value")


def barrier_zip(spark: SparkSession, d: str) -> DataFrame:
    return align.barrier_zip(_table(spark, d, "events"), "user_id", "event_id", "event_type", "value", ["view", "click", "error"])


def _commands(spark: SparkSession, d: str, code: str) -> DataFrame:
    return _table(spark, d, "events").select("user_id", "event_id", F.expr(code).alias("code"))


def session_commands(spark: SparkSession, d: str) -> DataFrame:
    return episodes.session_commands(_commands(spark, d, SESSION_CODE).where("code IS NOT NULL"), "user_id", "event_id", "code")


def session_frames(spark: SparkSession, d: str) -> DataFrame:
    return episodes.session_frames(_commands(spark, d, SESSION_CODE), "user_id", "event_id", "code").select("user_id", "event_id", "session", "frame_index")


def command_machine(spark: SparkSession, d: str) -> DataFrame:
    return episodes.command_machine(_commands(spark, d, MACHINE_CODE), "user_id", "event_id", "code")


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "conversations").select("conv_id", "turn", "role")


def episode_index(spark: SparkSession, d: str) -> DataFrame:
    return episodes.episode_index(_turns(spark, d), "conv_id", "turn").select("conv_id", "turn", "frame_index", "length", "from_index", "to_index", "index")


def done_flag(spark: SparkSession, d: str) -> DataFrame:
    return _turns(spark, d).select("conv_id", "turn", episodes.done_flag("conv_id", "turn").alias("done"), F.lit(0.0).alias("reward"), (F.col("turn") / F.lit(50.0)).cast("float").cast("double").alias("timestamp"))


def dense_check(spark: SparkSession, d: str) -> DataFrame:
    return episodes.dense_check(_table(spark, d, "lineitem"), "l_orderkey", "l_linenumber", 1)


def dense_episodes(spark: SparkSession, d: str) -> DataFrame:
    one = _turns(spark, d).select("conv_id").distinct().withColumn("whole", F.lit(1))
    return episodes.dense_check(one, "whole", "conv_id").select("n", "dense")


def physical_order(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "events").select("event_id", F.col("_metadata.row_index").alias("row"))
    return episodes.in_physical_order(rows, "event_id", "row")


def task_encode(spark: SparkSession, d: str) -> DataFrame:
    rows = _turns(spark, d)
    return tasks.encode_tasks(rows, "role", tasks.task_dictionary(rows, "role", ["conv_id", "turn"])).select("conv_id", "turn", "task_index")


def task_decode(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "events").select("event_id", "event_type")
    codes = tasks.task_dictionary(rows, "event_type", ["event_id"])
    return tasks.decode_tasks(tasks.encode_tasks(rows, "event_type", codes).select("event_id", "task_index"), codes).select("event_id", "task")


def task_extend(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame([("click", 3), ("other", 7)], "task string, task_index long")
    return tasks.task_dictionary(_table(spark, d, "events"), "event_type", ["event_id"], known)


def episode_tasks(spark: SparkSession, d: str) -> DataFrame:
    return tasks.tasks_of_episodes(_turns(spark, d), "conv_id", "role").select("conv_id", F.array_join("tasks", ",").alias("tasks"))


def vector_concat(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "embeddings")
    parts = V.concat_vectors([(F.slice("embedding", 33, 32), 32), (F.slice("embedding", 1, 32), 32)])
    return e.select("vec_id", F.posexplode(parts).alias("pos", "x")).select("vec_id", "pos", F.round(F.col("x").cast("double"), 6).alias("x"))


def history_slice(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "embeddings")
    last, first = V.history_window("embedding", 16, -1), V.history_window("embedding", 16, 0)
    total = lambda v: F.round(F.aggregate(v.cast("array<double>"), F.lit(0.0), lambda s, x: s + x), 6)
    return e.select("vec_id", F.size(last).alias("width"), total(last).alias("last_sum"), total(first).alias("first_sum"), F.array_join(F.transform(last, lambda x: F.format_string("%.6f", x.cast("double"))), ",").alias("last"))


def vector_stats(spark: SparkSession, d: str) -> DataFrame:
    s = stats.vector_stats(_table(spark, d, "embeddings"), ["label"], "embedding")
    return s.select("label", "pos", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")), "count")


def scalar_stats(spark: SparkSession, d: str) -> DataFrame:
    s = stats.scalar_stats(_table(spark, d, "events"), ["event_type"], "value")
    return s.select("event_type", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")), "count")


def image_stats_partial(spark: SparkSession, d: str) -> DataFrame:
    partial = stats.channel_partials(_table(spark, d, "embeddings").select("label", "vec_id", "embedding"), ["label", "vec_id"], "embedding")
    s = stats.merge_channels(partial, ["label"])
    return s.select("label", "channel", *(F.round(c, 9).alias(c) for c in ("min", "max", "mean", "std")), "count")


def vector_l2(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return e.join(b, "vec_id").select("vec_id", F.round(V.l2_distance("embedding", "next"), 6).alias("l2"))


def suffix_pivot(spark: SparkSession, d: str) -> DataFrame:
    n = _table(spark, d, "nation")
    base = F.lower("n_name")
    long = None
    for k, suffix in enumerate(("_joint", "_cmd", "_gain", "_foot")):
        part = n.select(F.concat(base, F.lit(suffix)).alias("name"), (F.col("n_nationkey") + 100 * k).cast("double").alias("position"), (F.col("n_regionkey") + 10 * k).cast("double").alias("effort"))
        long = part if long is None else long.unionByName(part)
    return tasks.suffix_pivot(long, "name", ["position", "effort"], {"_joint": "joint", "_cmd": "cmd", "_gain": "gain"})


def joint_state(spark: SparkSession, d: str) -> DataFrame:
    """By region, the nations as joints with their commands and gains, and feet as the rest."""
    n = _table(spark, d, "nation")
    long = None
    for k, suffix in enumerate(("_joint", "_cmd", "_gain", "_foot")):
        part = n.select("n_regionkey", F.concat(F.lower("n_name"), F.lit(suffix)).alias("name"), (F.col("n_nationkey") * (1 if k != 1 else -1)).alias("at"), (F.col("n_nationkey") + 100 * k).cast("double").alias("position"), (F.col("n_regionkey") + 10 * k).cast("double").alias("effort"))
        long = part if long is None else long.unionByName(part)
    out = tasks.joint_state(long, "n_regionkey", "at", "name", ["position", "effort"], {"_joint": "joint", "_cmd": "cmd", "_gain": "gain"}, "effort")
    lists = [F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")) if c not in ("names", "rest_names") else F.col(c), ",").alias(c) for c in out.columns if c != "n_regionkey"]
    return out.select("n_regionkey", *lists)


def name_match(spark: SparkSession, d: str) -> DataFrame:
    n = _table(spark, d, "nation")
    return tasks.unmatched_names(n.where("n_nationkey < 15").select("n_name"), n.where("n_nationkey > 5").select("n_name"), "n_name")


def throttle(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return episodes.throttle(e, ["user_id", "event_type"], "event_id", "ts", 24 * HOUR).select("event_id", "user_id", "event_type")


def gap_log(spark: SparkSession, d: str) -> DataFrame:
    return episodes.gaps(_table(spark, d, "events"), ["user_id"], "ts", 12 * HOUR).select("event_id", "user_id", F.round("gap", 3).alias("gap"))


def recovery_edge(spark: SparkSession, d: str) -> DataFrame:
    return episodes.recoveries(_table(spark, d, "events"), ["user_id"], "ts", F.col("event_type") == "error").select("event_id", "user_id")


def windowed_rate(spark: SparkSession, d: str) -> DataFrame:
    return episodes.rate(_table(spark, d, "events"), ["event_type"], "ts", 100).select("event_type", F.col("n").cast("long").alias("n"), F.round("rate", 9).alias("rate"))


def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return episodes.latest_per_key(_table(spark, d, "events"), ["user_id"], "ts", ["event_id", "value"]).select("user_id", "event_id", "value")


_LEVEL = "CASE event_type WHEN 'error' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END"


def status_level(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "events").withColumns({"own": F.expr(_LEVEL), "upstream": (F.col("event_id") % 2).cast("int")})
    return episodes.worst_level(rows, ["user_id"], ["own", "upstream"])


def status_report(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "events").withColumn("level", F.expr(_LEVEL))
    out = feeds.status_rows(rows, ["user_id"], "level", "event_type", {"limit": "0.2"})
    return out.select("user_id", "level", "message", "n", out["values"]["limit"].alias("limit"), out["values"]["level_1"].alias("level_1"))


def _packets(spark: SparkSession, d: str) -> DataFrame:
    """Each event as a packet of up to two images."""
    e = _table(spark, d, "events")
    images = F.expr("map_filter(map('head', CAST(event_type AS BINARY), 'ego', CASE WHEN event_type <> 'error' THEN CAST(event_id AS STRING) END), (k, v) -> v IS NOT NULL)").cast("map<string,binary>")
    times = F.expr("map('head', CAST(event_id AS DOUBLE), 'ego', (event_id + 1) * 1e12D)")
    return e.select("user_id", "ts", "event_id", images.alias("images"), times.alias("timestamps"))


def packet_decode(spark: SparkSession, d: str) -> DataFrame:
    """A codec that can't read one kind of image."""
    out = bundles.decode_packets(_packets(spark, d), lambda blob, unchanged: None if blob == b"click" else blob[::-1])
    return out.select("event_id", F.array_join(F.array_sort(F.map_keys("images")), ",").alias("names"), F.try_element_at("images", F.lit("head")).cast("string").alias("head"))


def bundle_complete(spark: SparkSession, d: str) -> DataFrame:
    out = bundles.complete_bundles(_packets(spark, d), ["head", "ego"])
    return out.select("event_id", F.array_join("missing", ",").alias("missing"), F.col("bundle")["ego"]["camera_time"].alias("ego_time"), F.when(F.col("bundle").isNotNull(), bundles.bundle_image(F.transform_values("bundle", lambda k, v: v["image"]), "observation.images.head")).cast("string").alias("head"))


def tick_gate(spark: SparkSession, d: str) -> DataFrame:
    """Ticks of half a day with the latest sample (views) and bundle (all packets; incomplete ones clear it), and why one is skipped."""
    e = _table(spark, d, "events")
    at = align.ticks(e.select("user_id").distinct(), "ts", "2024-01-01 00:00:00", "2024-01-31 00:00:00", "12 HOURS")
    sample = align.asof_latest(at, e.where("event_type = 'view'"), ["user_id"], "ts", ["value"], keep_stale=True).withColumnRenamed("ts_of", "sample_ts")
    held = bundles.latest_bundles(sample, bundles.complete_bundles(_packets(spark, d), ["head", "ego"]).select("user_id", "ts", "bundle"), ["user_id"], "ts").withColumnRenamed("ts_of", "bundle_ts")
    gated = bundles.gate_ticks(held, "ts", F.col("user_id") % 10 != 3, "sample_ts", "bundle_ts", 48 * HOUR, 24 * HOUR)
    kept = bundles.numbered_frames(gated, ["user_id"], "ts").select("user_id", "ts", "frame_index")
    return gated.select("user_id", "ts", "skip").join(kept, ["user_id", "ts"], "left")


def first_values(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "events").withColumn("late", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return episodes.first_values(rows, "user_id", "event_id", ["event_type", "late"])


def frame_number(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("index"), F.when(F.col("l_linenumber") > 2, F.col("l_linenumber") * 10).alias("frame_index"))
    return rows.select("l_orderkey", "index", episodes.frame_number(rows).alias("n"))


def task_values(spark: SparkSession, d: str) -> DataFrame:
    """Task texts as bytes with white space around."""
    rows = _turns(spark, d).withColumn("task", F.concat(F.lit(" \t"), "role", F.lit("\n")).cast("binary"))
    known = spark.createDataFrame([("system", 4)], "task string, task_index long")
    return tasks.task_codes(rows, "task", ["conv_id", "turn"], known)[0].select("conv_id", "turn", "task_index")


def nested_record(spark: SparkSession, d: str) -> DataFrame:
    """Orders as nested messages, flattened to dotted columns and selected."""
    o = _table(spark, d, "orders").select("o_orderkey", F.struct(F.struct(F.col("o_totalprice").alias("x"), F.col("o_custkey").cast("double").alias("y")).alias("gyro"), F.array("o_totalprice").alias("joint")).alias("imu"))
    flat = bundles.flatten_record(o, {"imu.gyro": "observation.state.gyro", "imu.joint": "action.joint"}, ["o_orderkey"])
    picked = bundles.select_fields(flat, {"state": ["gyro"], "target": ["joint"]}, ["o_orderkey"])
    back = bundles.nest_record(picked, {"sample": {"gyro": "observation.state.gyro", "joint": "action.joint"}}, ["o_orderkey"])
    return back.select("o_orderkey", F.col("sample.gyro")[1].cast("double").alias("y"), F.size("sample.gyro").alias("width"), F.round(F.col("sample.joint")[0].cast("double"), 0).alias("joint"))


def list_lengths(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("l"))
    zipped = o.select("l_orderkey", F.col("l.l_linenumber").alias("a"), F.col("l.l_quantity").alias("b"))
    return zipped.select("l_orderkey", F.explode(tasks.parallel_lists(["a", "b"])).alias("z")).select("l_orderkey", F.col("z.a").alias("line"), F.col("z.b").alias("quantity"))


def required_streams(spark: SparkSession, d: str) -> DataFrame:
    per = _table(spark, d, "events").where("ts < TIMESTAMP_NTZ'2024-01-08'").groupBy("user_id").agg(F.collect_set("event_type").alias("have"))
    return per.select("user_id", F.array_join(tasks.missing_of(["view", "click", "signup", "error", "purchase"], "have"), ",").alias("missing"))


def episode_forms(spark: SparkSession, d: str) -> DataFrame:
    """The three forms of episode records, side by side."""
    m = layouts.episode_records(_turns(spark, d), "conv_id", "turn", "role")
    full = m.withColumns({"episode_id": F.lit("").cast("string"), "task_index": F.lit(0), "video_path": F.concat(F.lit("videos/head/"), F.col("episode_index").cast("string")), "video_paths": F.create_map(F.lit("head"), F.concat(F.lit("videos/head/"), F.col("episode_index").cast("string"))), "dataset_from_index": F.col("from_index"), "dataset_to_index": F.col("to_index")})
    parts = [documents.episode_rows(full, form).select("episode_index", F.lit(form).alias("form"), F.lit(n).alias("width"), F.to_json(F.struct("tasks", "length")).alias("record")) for form, n in (("collected", 11), ("state_action", 6), ("compact", 3))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def episode_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of vectors, scalars and images as records by episode and column."""
    e = _table(spark, d, "embeddings").withColumnRenamed("label", "episode")
    images = stats.channel_partials(e.withColumn("name", F.lit("image")), ["episode", "name", "vec_id"], "embedding")
    out = stats.episode_stats(e, "episode", ["embedding"], ["vec_id"], images)
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, x: s + x), 6)
    return out.select("episode", "name", F.size("mean").alias("width"), *(total(c).alias(c) for c in ("min", "max", "mean", "std")), "count")


def running_total(spark: SparkSession, d: str) -> DataFrame:
    """Episodes in two lots, the second after the first: the greatest end so far and the next number (reopening and appending)."""
    turns = _turns(spark, d)
    half = (turns.agg(F.max("conv_id").alias("m")).first()["m"] or 0) // 2
    a = layouts.episode_records(turns.where(F.col("conv_id") <= half), "conv_id", "turn", "role").select("episode_index", "length", "to_index")
    end = a.agg(F.coalesce(F.max("to_index"), F.lit(0)).alias("end"))
    b = layouts.episode_records(turns.where(F.col("conv_id") > half), "conv_id", "turn", "role").crossJoin(F.broadcast(end)).select("episode_index", "length", (F.col("to_index") + F.col("end")).alias("to_index"))
    return a.unionByName(b)


def _folder(spark: SparkSession) -> str:
    """A new folder on what all executors share; a temporary one only where the session is of one machine and names none."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = tempfile.mkdtemp(prefix="frameloom-")
    return f"{top.removeprefix('file://')}/dataset-{uuid.uuid4().hex}"


def dataset_written(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as recorded sessions, appended in two commits, reopened between them and read back; every fifth was discarded."""
    turns = _turns(spark, d).withColumns({"end": F.when(F.col("conv_id") % 5 == 3, 3).otherwise(2), "prompt": F.concat(F.lit(" \t"), (F.col("conv_id") % 7).cast("string"))})
    frames = turns.select("conv_id", "turn", "end", "prompt", F.array_repeat(F.col("turn").cast("double"), 29).alias("observation.state.joint_position"), F.array_repeat(F.col("conv_id").cast("double"), 45).alias("action.aligned_target_pos"))
    columns, root = frames.columns[4:], _folder(spark)
    half = (turns.agg(F.max("conv_id").alias("m")).first()["m"] or 0) // 2
    for k, part in enumerate((frames.where(F.col("conv_id") <= half), frames.where(F.col("conv_id") > half))):
        writer.append_sessions(spark, writer.open_dataset(root, columns, 50), part, "conv_id", "turn", "prompt", "end", f"part {k}")
    records = src.read_jsonl(spark, f"{root}/meta/episodes.jsonl", "episode_index long, data_path string, length long, dataset_from_index long, dataset_to_index long")
    rows = src.read_listed(spark, root, records).join(records, "episode_index")
    return rows.select(
        "episode_index", "frame_index", "index", "row_index", "task_index", F.col("`annotation.human.action.task_description`").alias("task"), F.round("timestamp", 6).alias("timestamp"), "length", "dataset_from_index", "dataset_to_index",
        F.col("`observation.state.joint_position`")[28].alias("turn"), F.col("`action.aligned_target_pos`")[44].alias("conv_id"),
    )


def dataset_converted(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as a stored dataset of ten episodes, converted to the compact form and read back with its records."""
    e = _table(spark, d, "embeddings")
    number = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    rows = e.select(
        F.slice("embedding", 1, 58).alias("observation.state.history"), F.slice("embedding", 36, 29).alias("action.policy_action"), F.concat(F.lit(" task "), (F.col("vec_id") % 3).cast("string")).alias(documents.TASK),
        number.cast("long").alias("frame_index"), F.col("label").cast("long").alias("episode_index"), F.lit(0).cast("long").alias("task_index"),
    )
    root, target = _folder(spark), _folder(spark)
    sinks.write_fixed_lists(rows, f"{root}/data", "episode_index", name="train-{episode:06d}.parquet")
    listed = [{"episode_index": r[0]} for r in rows.select("episode_index").distinct().orderBy("episode_index").collect()]
    sinks.replace_files({f"{root}/meta/info.json": json.dumps({"fps": 50, "features": {}}), f"{root}/meta/tasks.jsonl": '{"task": "task 2", "task_index": 5}\n', f"{root}/meta/episodes.jsonl": documents.jsonl(listed)})
    convert.convert_compact(spark, root, target, "observation.state.history", "action.policy_action", window=-2)
    records = src.read_jsonl(spark, f"{target}/meta/episodes.jsonl", "episode_index long, tasks array<string>, length long")
    stats_of = src.read_jsonl(spark, f"{target}/meta/episodes_stats.jsonl", "episode_index long, stats map<string,struct<mean:array<double>,count:array<long>>>")
    out = src.read_episodes(spark, target).join(records, "episode_index").join(stats_of, "episode_index")
    return out.select("episode_index", "frame_index", "index", "task_index", _listed("state").alias("state"), _listed("actions").alias("actions"), F.array_join("tasks", ",").alias("tasks"), "length", F.round(F.col("stats")["actions"]["mean"][28], 6).alias("mean"), F.col("stats")["state"]["count"][0].alias("count"))


def video_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths of two cameras: from the record of even conversations, from the first row of odd ones."""
    turns = _turns(spark, d)
    name = lambda k: F.concat(F.lit(f"v/{k}/"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    rows = turns.select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("frame_index"), *(F.struct(name(k).alias("path"), F.lit(0.0).alias("timestamp")).alias(f"observation.images.{k}") for k in "ab"))
    given = F.create_map(*(x for k in "ab" for x in (F.lit(f"observation.images.{k}"), F.concat(F.lit(f"given/{k}/"), F.col("conv_id").cast("string")))))
    records = turns.select("conv_id").distinct().select(F.col("conv_id").alias("episode_index"), F.when(F.col("conv_id") % 2 == 0, given).alias("video_paths"))
    return video.video_paths(records, rows, ["observation.images.a", "observation.images.b"])


def text_functions(spark: SparkSession, d: str) -> DataFrame:
    n = _table(spark, d, "nation")
    pair = N.split_pair(F.concat("n_name", F.lit(" : a:b")))
    m = F.create_map(F.lit("a"), F.col("n_regionkey"), F.lit("b"), F.col("n_nationkey"))
    return n.select(
        "n_nationkey", pair["left"].alias("left_part"), pair["right"].alias("right_part"), N.namespace(F.concat(F.lit(" //x/"), "n_name", F.lit("/ "))).alias("namespace"),
        N.text_of(F.col("n_name").cast("binary")).alias("decoded"), N.last_part(F.concat(F.lit("observation.images."), "n_name"), "observation.images.").alias("stream"), N.last_part(F.concat(F.lit("x.y."), "n_name"), "z.").alias("tail"),
        N.fill_template("d/{chunk:03d}/{name}.p", chunk=F.col("n_regionkey"), name=F.col("n_name")).alias("path"), N.latency_ms(F.col("n_nationkey") + F.lit(1.5), (F.col("n_nationkey") + 2) * F.lit(1e0)).alias("latency"),
        N.dataset_name(F.expr("TIMESTAMP_NTZ'2024-03-01 04:05:06'")).alias("dataset"), N.look_up(m, "z", "b").alias("found"), N.look_up(m, "z", default=F.lit(-1)).alias("other"),
        F.array_join(N.tensor_shape(F.array(F.array(F.array(F.lit(1), F.lit(2)))), 3).cast("array<string>"), ",").alias("shape"),
        N.components(F.struct(F.col("n_nationkey").alias("x"), F.lit(2).alias("y"), F.lit(3).alias("z")))[0].cast("double").alias("first"),
    )


def duplicate_names(spark: SparkSession, d: str) -> DataFrame:
    return tasks.duplicates(_table(spark, d, "customer"), "c_mktsegment")


def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the JSON in each event's props that aren't wanted, and wanted ones that it lacks."""
    keys = _table(spark, d, "events").select("event_type", F.explode(F.json_object_keys("props")).alias("name")).distinct().groupBy("event_type").agg(F.collect_set("name").alias("have"))
    want = F.array(F.lit("a"), F.lit("z"))
    sides = keys.select("event_type", F.explode(F.array_union(F.transform(F.array_except(want, "have"), lambda x: F.struct(x.alias("name"), F.lit("missing").alias("side"))), F.transform(F.array_except("have", want), lambda x: F.struct(x.alias("name"), F.lit("extra").alias("side"))))).alias("s"))
    return sides.select("event_type", "s.name", "s.side")


def json_meta(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


def path_layout(spark: SparkSession, d: str) -> DataFrame:
    one = _turns(spark, d).select("conv_id").distinct()
    return one.select("conv_id", V.episode_path("conv_id").alias("flat"), V.episode_path("conv_id", 40).alias("chunked"))


def episode_meta(spark: SparkSession, d: str) -> DataFrame:
    m = layouts.episode_records(_turns(spark, d), "conv_id", "turn", "role")
    return m.select("episode_index", F.array_join("tasks", ",").alias("tasks"), "length", "fps", "data_path", "from_index", "to_index")


def dataset_info(spark: SparkSession, d: str) -> DataFrame:
    return layouts.dataset_info(_turns(spark, d), "conv_id", "role", cameras=2, chunk=40)


def name_functions(spark: SparkSession, d: str) -> DataFrame:
    n = _table(spark, d, "nation")
    padded = F.concat(F.lit("\t  "), F.col("n_name"), F.lit(" \n"))
    return n.select("n_nationkey", V.strip(padded).alias("stripped"), V.not_blank(F.lit(" \t")).alias("blank_ok"), V.base_name(F.concat("n_name", F.lit("_cmd")), ["_joint", "_cmd"]).alias("base"), F.array_join(V.split_list(F.concat("n_name", F.lit(" , ,x,"))), "|").alias("parts"), V.epoch_seconds((F.col("n_nationkey") + 1) * F.lit(1e11)).alias("seconds"))


def _frames(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "embeddings")
    return e.select(F.col("label").alias("episode_index"), F.col("vec_id").alias("frame_index"), (F.col("vec_id") % 3).alias("task_index"), F.slice("embedding", 1, 40).alias("observation.state.a"), F.slice("embedding", 41, 8).alias("observation.state.b"), F.slice("embedding", 49, 16).alias("action.c"))


def _listed(c: str) -> Column:
    """All values of a vector as text, to six decimals; nulls go."""
    return F.array_join(F.transform(F.col(c), V.six_decimals), ",")


def layout_state_action(spark: SparkSession, d: str) -> DataFrame:
    out = layouts.state_action_layout(_frames(spark, d), [("observation.state.b", 8), ("observation.state.a", 40)], ("action.c", 16))
    return out.select("episode_index", "frame_index", "index", "task_index", F.round(F.col("timestamp").cast("double"), 4).alias("ts"), F.col("`next.done`").alias("done"), F.col("`next.reward`").cast("double").alias("reward"), _listed("`observation.state`").alias("state"), _listed("action").alias("action"))


def layout_compact(spark: SparkSession, d: str) -> DataFrame:
    out = layouts.compact_layout(_frames(spark, d), "observation.state.a", "action.c", width=8, window=-2)
    return out.select("episode_index", "frame_index", "index", _listed("state").alias("state"), _listed("actions").alias("actions"))


QUERIES = {f.__name__: f for f in (
    asof_latest, asof_optional_default, merge_required, merge_many, tick_resample, barrier_zip, session_commands, session_frames, command_machine, episode_index, done_flag,
    dense_check, dense_episodes, physical_order, task_encode, task_decode, task_extend, episode_tasks, vector_concat, history_slice, vector_stats, scalar_stats,
    image_stats_partial, vector_l2, suffix_pivot, name_match, throttle, gap_log, recovery_edge, windowed_rate, latest_per_key, status_level, duplicate_names,
    schema_diff, json_meta, path_layout, episode_meta, dataset_info, name_functions, layout_state_action, layout_compact,
    joint_state, status_report, packet_decode, bundle_complete, tick_gate, first_values, frame_number, task_values, nested_record, list_lengths, required_streams, episode_forms, episode_stats,
    running_total, text_functions, dataset_written, dataset_converted, video_paths,
)}

_SIDES = "c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), v AS (SELECT user_id, ts, value, event_id AS view_id FROM events WHERE event_type = 'view')"
_PER = "PARTITION BY user_id ORDER BY event_id"
_RN = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM"
_EP = "SELECT conv_id, count(*) AS length, sum(count(*)) OVER (ORDER BY conv_id)::BIGINT AS to_index FROM conversations GROUP BY conv_id"
_FR = "SELECT label AS episode_index, vec_id, vec_id % 3 AS task_index, embedding AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, lead(1) OVER (PARTITION BY label ORDER BY vec_id) IS NULL AS done, row_number() OVER (ORDER BY label, vec_id) - 1 AS index FROM embeddings"


def _LS(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x: printf('%.6f', x::DOUBLE)), ',')"


ORACLE_SQL: dict[str, str] = {
    "asof_latest": f"WITH {_SIDES} SELECT c.event_id, c.user_id, c.ts, CASE WHEN c.ts - v.ts <= INTERVAL 6 HOUR THEN v.value END AS view_value, CASE WHEN c.ts - v.ts <= INTERVAL 6 HOUR THEN v.view_id END AS view_id FROM c ASOF LEFT JOIN v ON c.user_id = v.user_id AND c.ts >= v.ts",
    "asof_optional_default": f"WITH {_SIDES} SELECT c.event_id, c.user_id, coalesce(v.value, 0::DOUBLE) AS view_value, v.ts IS NULL AS missing FROM c ASOF LEFT JOIN v ON c.user_id = v.user_id AND c.ts >= v.ts",
    "merge_required": f"WITH {_SIDES}, s AS (SELECT user_id, ts, value FROM events WHERE event_type = 'signup'), a AS (SELECT c.*, v.value AS view, v.ts AS vt FROM c ASOF JOIN v ON c.user_id = v.user_id AND c.ts >= v.ts) SELECT a.event_id, a.user_id, a.view, s.value AS signup FROM a ASOF JOIN s ON a.user_id = s.user_id AND a.ts >= s.ts WHERE a.ts - vt <= INTERVAL 48 HOUR AND a.ts - s.ts <= INTERVAL 48 HOUR",
    "tick_resample": "WITH k AS (SELECT DISTINCT user_id FROM events), t AS (SELECT user_id, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 12 HOUR)) AS ts FROM k) SELECT t.user_id, t.ts, e.value FROM t ASOF JOIN events e ON t.user_id = e.user_id AND t.ts >= e.ts WHERE t.ts - e.ts <= INTERVAL 24 HOUR",
    "barrier_zip": f"""WITH RECURSIVE e AS ({_RN} (SELECT user_id, event_id, event_type, value FROM events WHERE event_type IN ('view', 'click', 'error'))),
        f AS (SELECT user_id, 0::BIGINT AS rn, NULL::BIGINT AS event_id, NULL::DOUBLE AS v, NULL::DOUBLE AS c, NULL::DOUBLE AS r FROM (SELECT DISTINCT user_id FROM e) UNION ALL
        SELECT e.user_id, e.rn, e.event_id, CASE WHEN e.event_type = 'view' THEN e.value WHEN f.v + f.c + f.r IS NULL THEN f.v END, CASE WHEN e.event_type = 'click' THEN e.value WHEN f.v + f.c + f.r IS NULL THEN f.c END, CASE WHEN e.event_type = 'error' THEN e.value WHEN f.v + f.c + f.r IS NULL THEN f.r END
        FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1) SELECT user_id, event_id, v AS view, c AS click, r AS error FROM f WHERE v + c + r IS NOT NULL""",
    "session_commands": f"WITH c AS (SELECT user_id, event_id, {SESSION_CODE} AS code FROM events), n AS (SELECT *, coalesce(lag(code) OVER ({_PER}) = 1, false) AS rec FROM c WHERE code IS NOT NULL) SELECT user_id, event_id, code::INTEGER AS code, CASE WHEN code = 1 THEN NOT rec ELSE rec END AS accepted FROM n",
    "session_frames": f"WITH c AS (SELECT user_id, event_id, {SESSION_CODE} AS code FROM events), l AS (SELECT *, last_value(code IGNORE NULLS) OVER ({_PER} ROWS UNBOUNDED PRECEDING) AS last FROM c), s AS (SELECT *, CASE WHEN code = 1 AND coalesce(lag(last) OVER ({_PER}), 0) <> 1 THEN 1 ELSE 0 END AS st FROM l), n AS (SELECT *, sum(st) OVER ({_PER} ROWS UNBOUNDED PRECEDING)::BIGINT AS session, first_value(nullif(code, 1) IGNORE NULLS) OVER ({_PER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fin FROM s) SELECT user_id, event_id, session, (row_number() OVER (PARTITION BY user_id, session ORDER BY event_id) - 1)::INTEGER AS frame_index FROM n WHERE code IS NULL AND last = 1 AND coalesce(fin, 0) <> 3",
    "command_machine": f"""WITH RECURSIVE e AS ({_RN} (SELECT user_id, event_id, ({MACHINE_CODE})::INTEGER AS code FROM events)),
        f AS (SELECT user_id, 0::BIGINT AS rn, NULL::BIGINT AS event_id, NULL::INTEGER AS code, 'IDLE' AS mode, false AS accepted FROM (SELECT DISTINCT user_id FROM e) UNION ALL
        SELECT e.user_id, e.rn, e.event_id, e.code,
            CASE WHEN e.code = 1 AND f.mode = 'IDLE' THEN 'RECORDING' WHEN e.code = 2 AND f.mode = 'RECORDING' THEN 'NEED_TO_SAVE' WHEN e.code = 3 AND f.mode IN ('RECORDING', 'NEED_TO_SAVE', 'FAILED') THEN 'DISCARD'
                WHEN e.code = 10 AND f.mode IN ('NEED_TO_SAVE', 'DISCARD') THEN 'IDLE' WHEN e.code = 11 AND f.mode IN ('RECORDING', 'NEED_TO_SAVE') THEN 'FAILED' ELSE f.mode END,
            (e.code = 1 AND f.mode = 'IDLE') OR (e.code = 2 AND f.mode = 'RECORDING') OR (e.code = 3 AND f.mode IN ('RECORDING', 'NEED_TO_SAVE', 'FAILED')) OR (e.code = 10 AND f.mode IN ('NEED_TO_SAVE', 'DISCARD')) OR (e.code = 11 AND f.mode IN ('RECORDING', 'NEED_TO_SAVE'))
        FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
        SELECT user_id, event_id, code, mode, accepted, CASE WHEN code = 11 AND accepted THEN 'ERROR' WHEN code IN (10, 11) OR accepted THEN 'OK' ELSE 'WARN' END AS level FROM f WHERE rn > 0""",
    "episode_index": f"WITH n AS ({_EP}) SELECT c.conv_id, c.turn, row_number() OVER w - 1 AS frame_index, n.length, n.to_index - n.length AS from_index, n.to_index, n.to_index - n.length + row_number() OVER w - 1 AS index FROM conversations c JOIN n ON c.conv_id = n.conv_id WINDOW w AS (PARTITION BY c.conv_id ORDER BY c.turn)",
    "done_flag": "SELECT conv_id, turn, lead(1) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AS done, 0::DOUBLE AS reward, (turn / 50::DOUBLE)::FLOAT::DOUBLE AS timestamp FROM conversations",
    "dense_check": "SELECT l_orderkey, count(*) AS n, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS dense FROM lineitem GROUP BY 1",
    "dense_episodes": "SELECT count(*) AS n, min(conv_id) = 0 AND max(conv_id) = count(*) - 1 AS dense FROM (SELECT DISTINCT conv_id FROM conversations)",
    "physical_order": "SELECT count(*) FILTER (WHERE event_id <> r) AS bad_rows FROM (SELECT event_id, row_number() OVER () - 1 AS r FROM events)",
    "task_encode": "WITH f AS (SELECT role, row_number() OVER (ORDER BY min(conv_id * 1000000 + turn)) - 1 AS task_index FROM conversations GROUP BY role) SELECT conv_id, turn, task_index FROM conversations c JOIN f ON c.role = f.role",
    "task_decode": "SELECT event_id, event_type AS task FROM events",
    "task_extend": "SELECT 'click' AS task, 3::BIGINT AS task_index UNION ALL SELECT 'other', 7 UNION ALL SELECT event_type, 7 + row_number() OVER (ORDER BY min(event_id)) FROM events WHERE event_type <> 'click' GROUP BY event_type",
    "episode_tasks": "SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS tasks FROM conversations GROUP BY conv_id",
    "vector_concat": "WITH v AS (SELECT vec_id, list_concat(embedding[33:64], embedding[1:32]) AS e FROM embeddings) SELECT vec_id, unnest(range(64))::INTEGER AS pos, round(unnest(e)::DOUBLE, 6) AS x FROM v",
    "history_slice": "SELECT vec_id, 16 AS width, round(list_sum(embedding[49:64]::DOUBLE[]), 6) AS last_sum, round(list_sum(embedding[1:16]::DOUBLE[]), 6) AS first_sum, array_to_string(list_transform(embedding[49:64], lambda x: printf('%.6f', x::DOUBLE)), ',') AS last FROM embeddings",
    "vector_stats": "WITH x AS (SELECT label, unnest(range(64))::INTEGER AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings) SELECT label, pos, round(min(v), 6) AS min, round(max(v), 6) AS max, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, count(v) AS count FROM x GROUP BY ALL",
    "scalar_stats": "SELECT event_type, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(value) AS count FROM events GROUP BY event_type",
    "image_stats_partial": "WITH x AS (SELECT label, vec_id, unnest(range(64))::INTEGER % 3 AS channel, unnest(embedding)::DOUBLE / 255 AS v FROM embeddings) SELECT label, channel::INTEGER AS channel, round(min(v), 9) AS min, round(max(v), 9) AS max, round(avg(v), 9) AS mean, round(sqrt(greatest(0, sum(v * v) / count(v) - avg(v) * avg(v))), 9) AS std, count(DISTINCT vec_id) AS count FROM x GROUP BY ALL",
    "vector_l2": "SELECT a.vec_id, round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS l2 FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "suffix_pivot": "SELECT lower(n_name) AS base, n_nationkey::DOUBLE AS joint_position, n_regionkey::DOUBLE AS joint_effort, (n_nationkey + 100)::DOUBLE AS cmd_position, (n_regionkey + 10)::DOUBLE AS cmd_effort, (n_nationkey + 200)::DOUBLE AS gain_position, (n_regionkey + 20)::DOUBLE AS gain_effort FROM nation",
    "name_match": "SELECT n_name, CASE WHEN n_nationkey < 15 THEN 'left' ELSE 'right' END AS side FROM nation WHERE n_nationkey <= 5 OR n_nationkey >= 15",
    "throttle": """WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events),
        f AS (SELECT user_id, event_type, event_id, rn, ts AS last, true AS ok FROM e WHERE rn = 1 UNION ALL
        SELECT e.user_id, e.event_type, e.event_id, e.rn, CASE WHEN e.ts - f.last >= INTERVAL 24 HOUR THEN e.ts ELSE f.last END, e.ts - f.last >= INTERVAL 24 HOUR FROM f JOIN e ON e.user_id = f.user_id AND e.event_type = f.event_type AND e.rn = f.rn + 1)
        SELECT event_id, user_id, event_type FROM f WHERE ok""",
    "gap_log": "WITH g AS (SELECT event_id, user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1e6::DOUBLE AS gap FROM events) SELECT event_id, user_id, round(gap, 3) AS gap FROM g WHERE gap > 43200",
    "recovery_edge": "WITH g AS (SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events) SELECT event_id, user_id FROM g WHERE before = 'error' AND event_type <> 'error'",
    "windowed_rate": "WITH g AS (SELECT event_type, row_number() OVER w AS n, ts, lag(ts, 100) OVER w AS t0 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)) SELECT event_type, n, round(100 / ((epoch_us(ts) - epoch_us(t0)) / 1e6::DOUBLE), 9) AS rate FROM g WHERE n % 100 = 0 AND t0 IS NOT NULL",
    "latest_per_key": "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM events GROUP BY user_id",
    "status_level": "SELECT user_id, max(greatest(CASE event_type WHEN 'error' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END, event_id % 2))::INTEGER AS level, count(*) AS n FROM events GROUP BY user_id",
    "status_report": f"WITH e AS (SELECT *, {_LEVEL} AS level FROM events) SELECT user_id, max(level)::INTEGER AS level, arg_max(event_type, level * 1000 + ascii(event_type) * 2 + CASE event_type WHEN 'click' THEN 0 ELSE 1 END) AS message, count(*) AS n, '0.2' AS limit, count(*) FILTER (WHERE level = 1)::VARCHAR AS level_1 FROM e GROUP BY user_id",
    "merge_many": f"""WITH e AS (SELECT user_id, ts, value, event_type FROM events WHERE event_id % 7 <> 0), c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
        a AS (SELECT c.*, v.value AS view, v.ts AS vt FROM c ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'view') v ON c.user_id = v.user_id AND c.ts >= v.ts),
        b AS (SELECT a.*, s.value AS signup, s.ts AS st FROM a ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'signup') s ON a.user_id = s.user_id AND a.ts >= s.ts),
        d AS (SELECT b.*, r.value AS er, r.ts AS rt FROM b ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'error') r ON b.user_id = r.user_id AND b.ts >= r.ts)
        SELECT event_id, view, signup, coalesce(er, -1::DOUBLE) AS error, concat_ws(',', CASE WHEN rt IS NULL THEN 'error' END, CASE WHEN st IS NULL OR ts - st > INTERVAL 48 HOUR THEN 'signup' END, CASE WHEN vt IS NULL OR ts - vt > INTERVAL 48 HOUR THEN 'view' END) AS missing FROM d""",
    "joint_state": """SELECT n_regionkey, string_agg(lower(n_name), ',' ORDER BY n_nationkey) AS names, string_agg(n_nationkey::VARCHAR, ',' ORDER BY n_nationkey) AS joint_position, string_agg(n_regionkey::VARCHAR, ',' ORDER BY n_nationkey) AS joint_effort,
        string_agg((n_nationkey + 100)::VARCHAR, ',' ORDER BY n_nationkey) AS cmd_position, string_agg((n_regionkey + 10)::VARCHAR, ',' ORDER BY n_nationkey) AS cmd_effort, string_agg((n_nationkey + 200)::VARCHAR, ',' ORDER BY n_nationkey) AS gain_position,
        string_agg((n_regionkey + 20)::VARCHAR, ',' ORDER BY n_nationkey) AS gain_effort, string_agg(lower(n_name) || '_foot', ',' ORDER BY n_nationkey) AS rest_names, string_agg((n_regionkey + 30)::VARCHAR, ',' ORDER BY n_nationkey) AS rest_effort FROM nation GROUP BY n_regionkey""",
    "packet_decode": "SELECT event_id, CASE WHEN event_type = 'click' THEN 'ego' WHEN event_type = 'error' THEN 'head' ELSE 'ego,head' END AS names, CASE WHEN event_type <> 'click' THEN reverse(event_type) END AS head FROM events",
    "bundle_complete": "SELECT event_id, CASE WHEN event_type = 'error' THEN 'ego' ELSE '' END AS missing, CASE WHEN event_type <> 'error' THEN CASE WHEN (event_id + 1) * 1e12::DOUBLE > 1e12 THEN (event_id + 1) * 1e12::DOUBLE / 1e9::DOUBLE ELSE (event_id + 1) * 1e12::DOUBLE END END AS ego_time, CASE WHEN event_type <> 'error' THEN event_type END AS head FROM events",
    "tick_gate": """WITH k AS (SELECT DISTINCT user_id FROM events), t AS (SELECT user_id, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 12 HOUR)) AS ts FROM k),
        s AS (SELECT t.*, v.ts AS st FROM t ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON t.user_id = v.user_id AND t.ts >= v.ts),
        b AS (SELECT s.*, CASE WHEN e.event_type <> 'error' THEN e.ts END AS bt FROM s ASOF LEFT JOIN events e ON s.user_id = e.user_id AND s.ts >= e.ts),
        g AS (SELECT user_id, ts, CASE WHEN user_id % 10 = 3 THEN 'not recording' WHEN st IS NULL THEN 'no sample' WHEN bt IS NULL THEN 'no bundle' WHEN ts - st > INTERVAL 48 HOUR THEN 'stale sample' WHEN ts - bt > INTERVAL 24 HOUR THEN 'stale bundle' END AS skip FROM b)
        SELECT user_id, ts, skip, CASE WHEN skip IS NULL THEN row_number() OVER (PARTITION BY user_id, skip IS NULL ORDER BY ts) - 1 END AS frame_index FROM g""",
    "first_values": "SELECT user_id, arg_min(event_type, event_id) AS event_type, min(event_id) FILTER (WHERE event_type = 'purchase') AS late FROM events GROUP BY user_id",
    "frame_number": "SELECT l_orderkey, l_linenumber AS index, (CASE WHEN l_linenumber > 2 THEN l_linenumber * 10 ELSE l_linenumber END)::BIGINT AS n FROM lineitem",
    "task_values": "WITH f AS (SELECT role, CASE role WHEN 'system' THEN 4 ELSE 4 + row_number() OVER (PARTITION BY role = 'system' ORDER BY min(conv_id * 1000000 + turn)) END AS task_index FROM conversations GROUP BY role) SELECT conv_id, turn, task_index FROM conversations c JOIN f ON c.role = f.role",
    "nested_record": "SELECT o_orderkey, o_custkey::FLOAT::DOUBLE AS y, 2 AS width, round(o_totalprice::FLOAT::DOUBLE, 0) AS joint FROM orders",
    "list_lengths": "SELECT l_orderkey, l_linenumber AS line, l_quantity AS quantity FROM lineitem",
    "required_streams": "SELECT user_id, array_to_string(list_sort(list_filter(['view', 'click', 'signup', 'error', 'purchase'], lambda x: NOT list_contains(list(DISTINCT event_type), x))), ',') AS missing FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY user_id",
    "episode_forms": "WITH r AS (SELECT conv_id AS episode_index, '{\"tasks\":[' || string_agg(DISTINCT '\"' || role || '\"', ',' ORDER BY '\"' || role || '\"') || '],\"length\":' || count(*) || '}' AS record FROM conversations GROUP BY conv_id) SELECT episode_index, form, width::INTEGER AS width, record FROM r, (VALUES ('collected', 11), ('state_action', 6), ('compact', 3)) f(form, width)",
    "episode_stats": """WITH v AS (SELECT label AS episode, 'embedding' AS name, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings UNION ALL SELECT label, 'vec_id', 0, vec_id FROM embeddings),
        p AS (SELECT episode, name, pos, min(x) AS lo, max(x) AS hi, avg(x) AS mean, stddev_pop(x) AS sd, count(x) AS n FROM v GROUP BY ALL),
        i AS (SELECT label AS episode, 'image' AS name, pos % 3 AS pos, min(x) AS lo, max(x) AS hi, avg(x) AS mean, sqrt(greatest(0, sum(x * x) / count(x) - avg(x) * avg(x))) AS sd, count(DISTINCT vec_id) AS n FROM (SELECT label, vec_id, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE / 255 AS x FROM embeddings) GROUP BY ALL)
        SELECT episode, name, count(*)::INTEGER AS width, round(sum(lo), 6) AS min, round(sum(hi), 6) AS max, round(sum(mean), 6) AS mean, round(sum(sd), 6) AS std, max(n) AS count FROM (SELECT * FROM p UNION ALL SELECT * FROM i) GROUP BY episode, name""",
    "dataset_written": """WITH t AS (SELECT *, dense_rank() OVER (ORDER BY conv_id) - 1 AS e FROM conversations WHERE conv_id % 5 <> 3), k AS (SELECT conv_id % 7 AS k, row_number() OVER (ORDER BY min(conv_id)) - 1 AS task_index FROM t GROUP BY 1),
        n AS (SELECT e, count(*) AS length, sum(count(*)) OVER (ORDER BY e)::BIGINT AS hi FROM t GROUP BY e), f AS (SELECT t.*, row_number() OVER (PARTITION BY t.e ORDER BY turn) - 1 AS i FROM t)
        SELECT f.e AS episode_index, i AS frame_index, hi - length + i AS index, i AS row_index, task_index, (conv_id % 7)::VARCHAR AS task, round(i / 50::DOUBLE, 6) AS timestamp, length, hi - length AS dataset_from_index, hi AS dataset_to_index, turn::DOUBLE AS turn, conv_id::DOUBLE AS conv_id
        FROM f JOIN n ON f.e = n.e JOIN k ON f.conv_id % 7 = k.k""",
    "dataset_converted": f"""WITH f AS ({_FR}), c AS (SELECT vec_id % 3 AS k, CASE WHEN vec_id % 3 = 2 THEN 5 ELSE 5 + row_number() OVER (PARTITION BY vec_id % 3 = 2 ORDER BY min(index)) END AS task_index FROM f GROUP BY vec_id % 3),
        g AS (SELECT f.*, c.task_index AS code FROM f JOIN c ON f.vec_id % 3 = c.k), t AS (SELECT episode_index, string_agg(name, ',' ORDER BY code) AS tasks FROM (SELECT DISTINCT episode_index, code, 'task ' || (vec_id % 3) AS name FROM g) GROUP BY episode_index)
        SELECT g.episode_index::BIGINT AS episode_index, frame_index, index, code AS task_index, {_LS('e[1:29]')} AS state, {_LS('e[36:64]')} AS actions, tasks, count(*) OVER w AS length, round(avg(e[64]::DOUBLE) OVER w, 6) AS mean, count(*) OVER w AS count
        FROM g JOIN t ON g.episode_index = t.episode_index WINDOW w AS (PARTITION BY g.episode_index)""",
    "video_paths": "SELECT c.conv_id AS episode_index, 'observation.images.' || k AS camera, CASE WHEN c.conv_id % 2 = 0 THEN 'given/' || k || '/' || c.conv_id ELSE 'v/' || k || '/' || c.conv_id || '-' || m END AS path FROM (SELECT conv_id, min(turn) AS m FROM conversations GROUP BY conv_id) c, (VALUES ('a'), ('b')) x(k)",
    "running_total": f"WITH n AS ({_EP}) SELECT conv_id AS episode_index, length, to_index FROM n",
    "text_functions": "SELECT n_nationkey, n_name AS left_part, 'a:b' AS right_part, '/x/' || n_name AS namespace, n_name AS decoded, n_name AS stream, n_name AS tail, printf('d/%03d/%s.p', n_regionkey, n_name) AS path, 500::DOUBLE AS latency, 'dataset_20240301_040506' AS dataset, n_nationkey AS found, -1 AS other, '1,1,2' AS shape, n_nationkey::DOUBLE AS first FROM nation",
    "duplicate_names": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1",
    "schema_diff": "WITH k AS (SELECT event_type, list(DISTINCT name) AS have FROM (SELECT event_type, unnest(json_keys(props)) AS name FROM events) GROUP BY event_type) SELECT event_type, unnest(list_filter(['a', 'z'], lambda x: NOT list_contains(have, x))) AS name, 'missing' AS side FROM k UNION ALL SELECT event_type, unnest(list_filter(have, lambda x: x NOT IN ('a', 'z'))), 'extra' FROM k",
    "json_meta": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
    "path_layout": "SELECT DISTINCT conv_id, printf('data/train-%06d.parquet', conv_id) AS flat, printf('data/chunk-%03d/episode_%06d.parquet', conv_id // 40, conv_id) AS chunked FROM conversations",
    "episode_meta": f"WITH n AS ({_EP}), t AS (SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS tasks FROM conversations GROUP BY conv_id) SELECT n.conv_id AS episode_index, tasks, length, 50::DOUBLE AS fps, printf('data/train-%06d.parquet', n.conv_id) AS data_path, to_index - length AS from_index, to_index FROM n JOIN t ON n.conv_id = t.conv_id",
    "dataset_info": "SELECT count(DISTINCT conv_id) AS total_episodes, count(*) AS total_frames, count(DISTINCT role) AS total_tasks, count(DISTINCT conv_id) * 2 AS total_videos, greatest(1, ceil(count(DISTINCT conv_id) / 40))::BIGINT AS total_chunks, max(conv_id) + 1 AS next_episode, '0:' || count(DISTINCT conv_id) AS train_split FROM conversations",
    "name_functions": "SELECT n_nationkey, n_name AS stripped, false AS blank_ok, n_name AS base, n_name || '|x' AS parts, CASE WHEN (n_nationkey + 1) * 1e11::DOUBLE > 1e12 THEN (n_nationkey + 1) * 1e11::DOUBLE / 1e9::DOUBLE ELSE (n_nationkey + 1) * 1e11::DOUBLE END AS seconds FROM nation",
    "layout_state_action": f"WITH f AS ({_FR}) SELECT episode_index::BIGINT AS episode_index, frame_index, index, task_index::BIGINT AS task_index, round((frame_index / 50::DOUBLE)::FLOAT::DOUBLE, 4) AS ts, done, 0::DOUBLE AS reward, {_LS('list_concat(e[41:48], e[1:40])')} AS state, {_LS('e[49:64]')} AS action FROM f",
    "layout_compact": f"WITH f AS ({_FR}) SELECT episode_index::BIGINT AS episode_index, frame_index, index, {_LS('e[25:32]')} AS state, {_LS('e[49:56]')} AS actions FROM f",
}
