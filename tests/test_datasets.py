"""Whole datasets: both conversions with their guards, growing datasets, videos."""

import json

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frameloom.functions import images
from frameloom.functions.vectors import STATE_FIELDS
from frameloom.plans import convert, documents, writer
from frameloom.sources import video

HEAD, EGO = "observation.images.head", "observation.images.ego_view"
TASK = "annotation.human.action.task_description"
SHAPE = (4, 6, 3)


def make(spark, root, lengths=(2, 3), task=lambda e: f"task {e}", first=lambda e, f: f, listed=True, cameras=True, frames=0):
    """A stored dataset with a column of each kind."""
    for e, n in enumerate(lengths):
        rows = spark.range(n, numPartitions=1).select(
            *(F.array_repeat(F.lit(float(k)), w).alias(f"observation.state.{c}") for k, (c, w) in enumerate(STATE_FIELDS.items())),
            F.transform(F.sequence(F.lit(0), F.lit(57)), lambda x: x.cast("double")).alias("observation.state.history"),
            F.array_repeat(F.lit(6.0), 45).alias("action.aligned_target_pos"), F.array_repeat(F.lit(7.0), 29).alias("action.policy_action"),
            F.lit(task(e)).alias(TASK), (F.col("id") / 50.0).alias("timestamp"), first(e, F.col("id")).cast("long").alias("frame_index"), F.lit(e).cast("long").alias("episode_index"), F.lit(0).cast("long").alias("task_index"),
            *(F.struct(F.lit(f"videos/{c}/episode_{e:06d}.raw").alias("path"), (F.col("id") / 50.0).alias("timestamp")).alias(c) for c in ((HEAD, EGO) if cameras else ())),
        )
        rows.write.parquet(str(root / f"data/train-{e:06d}.parquet"))
        for k, c in enumerate((HEAD, EGO) if cameras else ()):
            sink = video.RawVideoSink(str(root / f"videos/{c}/episode_{e:06d}.raw"))
            for f in range(n + frames):
                sink.write(np.full(SHAPE, 32 + 64 * k + f, np.uint8))
            sink.close()
    (root / "meta").mkdir()
    features = {c: documents.video_feature(SHAPE, 50) for c in ((HEAD, EGO) if cameras else ())}
    (root / "meta/info.json").write_text(json.dumps({"fps": 50, "robot_type": "arm", "features": features}))
    (root / "meta/tasks.jsonl").write_text('{"task_index": 4, "task": "task 1"}\n\n')
    records = [{"episode_index": e} | ({"video_paths": {c: f"videos/{c}/episode_{e:06d}.raw" for c in (HEAD, EGO)}} if listed and cameras else {}) for e in range(len(lengths))]
    (root / "meta/episodes.jsonl").write_text("".join(json.dumps(r) + "\n" for r in [*records, {"note": "no index"}]))
    return str(root)


def lines(path):
    return [json.loads(x) for x in path.read_text().splitlines()]


def test_state_action(spark, tmp_path):
    root = make(spark, tmp_path / "in", listed=False)
    convert.convert_state_action(spark, root, str(tmp_path / "out"))
    got = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out/data")).orderBy("index").collect()
    assert [r["index"] for r in got] == [0, 1, 2, 3, 4] and [r["next.done"] for r in got] == [False, True, False, False, True]
    assert [r["task_index"] for r in got] == [5, 5, 4, 4, 4] and len(got[0]["observation.state"]) == 1110 and got[0]["action"] == [6.0] * 45
    assert got[2][HEAD]["path"] == f"videos/chunk-000/{HEAD}/episode_000001.mp4" and (tmp_path / "out" / got[2][HEAD]["path"]).is_file()
    info = json.loads((tmp_path / "out/meta/info.json").read_text())
    assert (info["total_episodes"], info["total_frames"], info["total_tasks"], info["total_videos"], info["robot_type"]) == (2, 5, 2, 4, "arm")
    assert info["features"]["observation.state"]["shape"] == [1110] and info["features"][HEAD]["info"]["video.height"] == 4
    assert lines(tmp_path / "out/meta/tasks.jsonl") == [{"task": "task 1", "task_index": 4}, {"task": "task 0", "task_index": 5}]
    records = lines(tmp_path / "out/meta/episodes.jsonl")
    assert [(r["episode_index"], r["tasks"], r["length"], r["data_path"]) for r in records] == [(0, ["task 0"], 2, "data/chunk-000/episode_000000.parquet"), (1, ["task 1"], 3, "data/chunk-000/episode_000001.parquet")]
    assert sorted(records[0]) == sorted(["episode_index", "tasks", "length", "fps", "data_path", "video_paths"]) and (tmp_path / "out" / records[0]["data_path"]).is_file()
    modality = json.loads((tmp_path / "out/meta/modality.json").read_text())
    assert modality["state"]["action_history"] == {"start": 820, "end": 1110} and modality["video"]["head"] == {"original_key": HEAD}
    with pytest.raises(FileExistsError):
        convert.convert_state_action(spark, root, str(tmp_path / "out"))


def test_compact_with_images(spark, tmp_path):
    root = make(spark, tmp_path / "in", frames=1)
    encode, _ = images.raw_codec(SHAPE)
    convert.convert_compact(spark, root, str(tmp_path / "out"), "observation.state.history", "action.policy_action", images={HEAD: "head", EGO: "ego"}, reader=video.RawVideo, encode=encode)
    path = tmp_path / "out/data/chunk-000/episode_000001.parquet"
    schema = pq.read_schema(path)
    assert str(schema.field("state").type).startswith("fixed_size_list<") and schema.field("state").type.list_size == 29
    hub = json.loads(schema.metadata[b"huggingface"])["info"]["features"]
    assert hub["head"] == {"_type": "Image"} and hub["state"]["length"] == 29 and hub["index"]["dtype"] == "int64"
    rows = pq.read_table(path).to_pylist()
    assert [r["frame_index"] for r in rows] == [0, 1, 2] and rows[1]["state"] == [float(x) for x in range(29, 58)] and rows[1]["actions"] == [7.0] * 29
    assert rows[2]["head"] == {"bytes": bytes([34]) * 72, "path": "frame_000002.png"} and rows[0]["ego"]["bytes"][0] == 96
    stats = lines(tmp_path / "out/meta/episodes_stats.jsonl")[1]
    assert stats["episode_index"] == 1 and stats["stats"]["head"]["count"] == [3] and np.allclose(stats["stats"]["head"]["mean"], [[[33 / 255]]] * 3) and np.allclose(stats["stats"]["head"]["min"], [[[32 / 255]]] * 3)
    assert stats["stats"]["state"]["count"] == [3] and stats["stats"]["state"]["std"] == [0.0] * 29 and stats["stats"]["frame_index"] == {"min": [0.0], "max": [2.0], "mean": [1.0], "std": [np.std([0, 1, 2])], "count": [3]}
    assert set(stats["stats"]) == {"head", "ego", "state", "actions", "timestamp", "frame_index", "episode_index", "index", "task_index"}
    assert [sorted(r) for r in lines(tmp_path / "out/meta/episodes.jsonl")] == [["episode_index", "length", "tasks"]] * 2
    info = json.loads((tmp_path / "out/meta/info.json").read_text())
    assert info["total_chunks"] == 1 and info["features"]["head"] == {"dtype": "image", "shape": [4, 6, 3], "names": ["height", "width", "channel"]} and documents.chunk_count(1001) == 2


@pytest.mark.parametrize("what, message", [
    ("blank task", "task must be"), ("permuted", "order of rows|dense"), ("gap", "dense"), ("fps", "fps"), ("no camera", "cameras"), ("missing file", "no such"), ("outside", "leads out"), ("sparse episodes", "dense"),
    ("short video", "frames for"), ("other shape", "differs"), ("no path", "no video path"), ("no episodes", "no episodes"), ("stray code", "no task has"),
])
def test_guards_leave_no_target(spark, tmp_path, what, message):
    how = {}
    if what == "blank task":
        how["task"] = lambda e: " \t" if e else "x"
    if what == "stray code":
        how["task"] = lambda e: 99
    if what == "permuted":
        how["first"] = lambda e, f: F.lit(1) - f if e == 0 else f
    if what == "gap":
        how["first"] = lambda e, f: f * 2
    root = make(spark, tmp_path / "in", **how)
    meta = tmp_path / "in/meta"
    info = json.loads((meta / "info.json").read_text())
    if what == "fps":
        info["fps"] = 0
    if what == "no camera":
        del info["features"][EGO]
    (meta / "info.json").write_text(json.dumps(info))
    if what == "no episodes":
        (meta / "episodes.jsonl").write_text("\n")
    if what == "missing file":
        (meta / "episodes.jsonl").write_text('{"episode_index": 0, "data_path": "data/none.parquet"}\n')
    if what == "outside":
        (meta / "episodes.jsonl").write_text('{"episode_index": 0, "data_path": "../x.parquet"}\n')
    if what == "sparse episodes":
        (meta / "episodes.jsonl").write_text('{"episode_index": 0}\n{"episode_index": 2, "data_path": "data/train-000001.parquet"}\n')
    if what in ("short video", "other shape"):
        sink = video.RawVideoSink(str(tmp_path / f"in/videos/{HEAD}/episode_000001.raw"))
        for _ in range(1 if what == "short video" else 3):
            sink.write(np.zeros(SHAPE if what == "short video" else (2, 2, 3), np.uint8))
        sink.close()
    if what == "no path":
        (meta / "episodes.jsonl").write_text('{"episode_index": 0, "video_paths": {}}\n{"episode_index": 1, "video_paths": {}}\n')
    encode, _ = images.raw_codec(SHAPE)
    with pytest.raises(Exception, match=message):
        convert.convert_compact(spark, root, str(tmp_path / "out"), "observation.state.history", "action.policy_action", images={HEAD: "head", EGO: "ego"}, reader=video.RawVideo, encode=encode)
    assert [p.name for p in tmp_path.iterdir()] == ["in"]


def sessions(spark, rows):
    return spark.createDataFrame(rows, "s int, o int, p string, end int, x double").select("s", "o", "p", "end", F.array_repeat("x", 29).alias("observation.state.joint_position"), F.array_repeat("x", 45).alias("action.aligned_target_pos"))


COLUMNS = ["observation.state.joint_position", "action.aligned_target_pos"]


def test_a_dataset_grows_by_saved_sessions_only(spark, tmp_path):
    root = str(tmp_path / "set")
    empty = writer.open_dataset(root, COLUMNS, 50)
    assert not (tmp_path / "set").exists() and (empty.next_episode, empty.total_frames) == (0, 0)
    first = sessions(spark, [(0, 0, " pick ", 2, 1.0), (0, 1, "pick", 2, 2.0), (1, 0, "gone", 3, 9.0), (2, 0, "place", 2, 3.0), (3, 0, "open", None, 9.0)])
    one = writer.append_sessions(spark, empty, first, "s", "o", "p", "end", "a", {HEAD: SHAPE})
    assert one.tasks == {"pick": 0, "place": 1} and [e["length"] for e in one.episodes] == [2, 1] and len(one.episodes[0]) == 11
    assert writer.append_sessions(spark, one, first, "s", "o", "p", "end", "a", {HEAD: SHAPE}) is one
    again = writer.open_dataset(root, COLUMNS, 50)
    assert (again.tasks, again.episodes, again.next_episode, again.total_frames, again.commits) == (one.tasks, one.episodes, 2, 3, ["a"])
    two = writer.append_sessions(spark, again, sessions(spark, [(0, 0, "wave", 2, 4.0), (0, 1, "wave", 2, 5.0)]), "s", "o", "p", "end", "b", {HEAD: SHAPE})
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data").orderBy("index").collect()
    assert [(r["episode_index"], r["frame_index"], r["index"], r["task_index"], r[TASK]) for r in rows] == [(0, 0, 0, 0, "pick"), (0, 1, 1, 0, "pick"), (1, 0, 2, 1, "place"), (2, 0, 3, 2, "wave"), (2, 1, 4, 2, "wave")]
    assert rows[4]["timestamp"] == 0.02 and rows[4][HEAD]["path"] == f"videos/{HEAD}/episode_000002.mp4" and two.episodes[2]["dataset_from_index"] == 3
    info = json.loads((tmp_path / "set/meta/info.json").read_text())
    assert info["splits"] == {"train": "0:3"} and info["features"]["observation.state.joint_position"]["shape"] == [29] and info["features"][HEAD]["shape"] == [4, 6, 3]
    modality = json.loads((tmp_path / "set/meta/modality.json").read_text())
    assert modality["action"] == {"aligned_target_pos": {"shape": [45]}} and modality["observation"]["images"]["head"]["key"] == HEAD
    (tmp_path / "set/data/train-000009.parquet").write_text("left over")
    assert writer.remove_uncommitted(two) == ["data/train-000009.parquet"] and len(list((tmp_path / "set/data").iterdir())) == 3


def test_a_failed_commit_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    one = writer.append_sessions(spark, writer.open_dataset(root, COLUMNS, 50), sessions(spark, [(0, 0, "a", 2, 1.0)]), "s", "o", "p", "end", "a")
    before = {p.name: p.read_text() for p in (tmp_path / "set/meta").iterdir()}

    def fail(files):
        raise OSError("disk full")

    monkeypatch.setattr(writer.sinks, "replace_files", fail)
    with pytest.raises(OSError):
        writer.append_sessions(spark, one, sessions(spark, [(0, 0, "b", 2, 2.0)]), "s", "o", "p", "end", "b")
    monkeypatch.undo()
    assert {p.name: p.read_text() for p in (tmp_path / "set/meta").iterdir()} == before
    retry = writer.append_sessions(spark, writer.open_dataset(root, COLUMNS, 50), sessions(spark, [(0, 0, "b", 2, 2.0)]), "s", "o", "p", "end", "b")
    assert retry.tasks == {"a": 0, "b": 1} and len(retry.episodes) == 2


def test_other_columns_and_blank_prompts_are_refused(spark, tmp_path):
    root = str(tmp_path / "set")
    one = writer.open_dataset(root, COLUMNS, 50)
    with pytest.raises(ValueError, match="blank"):
        writer.append_sessions(spark, one, sessions(spark, [(0, 0, "\t", 2, 1.0)]), "s", "o", "p", "end", "a")
    writer.append_sessions(spark, one, sessions(spark, [(0, 0, "a", 2, 1.0)]), "s", "o", "p", "end", "a")
    with pytest.raises(ValueError, match="missing .*action.aligned_target_pos"):
        writer.open_dataset(root, ["observation.state.joint_position", "action.policy_action"], 50)
    with pytest.raises(ValueError, match="fps"):
        writer.open_dataset(root, COLUMNS, 0)


def test_readers_are_closed_when_one_fails():
    closed = []

    class Reader:
        def __init__(self, path):
            if path == "bad":
                raise OSError(path)
            self.path = path

        def close(self):
            closed.append(self.path)

    with pytest.raises(OSError), video.open_readers({"a": "good", "b": "bad"}, Reader):
        pass
    assert closed == ["good"]


def test_a_sink_refuses_another_shape_and_can_be_discarded(tmp_path):
    sink = video.RawVideoSink(str(tmp_path / "v/x.raw"))
    sink.write(np.zeros(SHAPE, np.uint8))
    with pytest.raises(ValueError, match="changed its shape"):
        sink.write(np.zeros((2, 2, 3), np.uint8))
    sink.discard()
    assert not (tmp_path / "v/x.raw").exists()
