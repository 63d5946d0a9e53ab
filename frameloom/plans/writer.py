"""A dataset that grows by recorded sessions: reopened, checked against what it has, committed as a whole or not at all."""

from __future__ import annotations

import os
import shutil
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.functions.vectors import not_blank, strip
from frameloom.operators.tasks import distinct_names, schema_difference, task_dictionary
from frameloom.plans import documents as doc
from frameloom.sources import episodes as src
from frameloom.sources import sinks

_ROBOT = ("observation.state.", "action.")


@dataclass
class Dataset:
    """What a dataset's documents say: tasks by text, episode records, running totals, features."""

    root: str
    fps: float
    columns: list[str]
    tasks: dict[str, int] = field(default_factory=dict)
    episodes: list[dict] = field(default_factory=list)
    features: dict[str, dict] = field(default_factory=dict)
    commits: list[str] = field(default_factory=list)

    @property
    def next_episode(self) -> int:
        return max((e["episode_index"] for e in self.episodes), default=-1) + 1

    @property
    def total_frames(self) -> int:
        return max((e.get("dataset_to_index", 0) for e in self.episodes), default=0)


def _lines(path: str) -> list[dict]:
    import json

    if not os.path.isfile(path):
        return []
    with open(path, encoding="utf-8") as f:
        return [json.loads(line) for line in f if line.strip()]


def open_dataset(root: str, columns: Sequence[str], fps: float) -> Dataset:
    """A new or stored dataset; an error if it was stored with other robot columns. Nothing is made before the first commit."""
    if not fps > 0:
        raise ValueError("fps must be positive")
    out = Dataset(root, fps, distinct_names(columns))
    out.tasks = {str(r["task"]): int(r["task_index"]) for r in _lines(f"{root}/meta/tasks.jsonl")}
    out.episodes = _lines(f"{root}/meta/episodes.jsonl")
    if os.path.isfile(f"{root}/meta/info.json"):
        info = src.read_json(f"{root}/meta/info.json")
        out.features, out.commits = info.get("features", {}), list(info.get("commits", []))
        if not isinstance(out.features, dict):
            raise ValueError("features must be a mapping")
        missing, extra = schema_difference([c for c in out.features if c.startswith(_ROBOT)], columns)
        if missing or extra:
            raise ValueError(f"the dataset has other columns: missing {missing}, extra {extra}")
    return out


def append_sessions(spark: SparkSession, dataset: Dataset, frames: DataFrame, session: str, order: str, prompt: str, end: str, commit: str, cameras: Mapping[str, Sequence[int]] | None = None, joints: Sequence[str] = ()) -> Dataset:
    """Adds the sessions of ``frames`` that were saved, as episodes that follow those of ``dataset``, and returns the dataset as stored.

    ``end`` is a column with the code of the command that ended a session: those that end in DISCARD or not at all leave no
    frame and no task. Prompts are stripped and must not be blank. Episodes are numbered in the order of sessions, tasks in that
    of first appearance, and rows get timestamp, frame_index, episode_index, index and task_index. Files are written first and
    the documents replaced together after, so a failure leaves the dataset as it was; files that it left are overwritten. A
    ``commit`` that the dataset already has is skipped, which makes retries safe.
    """
    if commit in dataset.commits:
        return dataset
    cameras = dict(cameras or {})
    saved = frames.where(F.col(end) == 2).withColumn("_prompt", strip(prompt))
    if not saved.where(~not_blank("_prompt")).isEmpty():
        raise ValueError("a session has a blank prompt")
    absent = [c for c in dataset.columns if c not in frames.columns]
    if absent:
        raise ValueError(f"frames lack the columns {absent}")
    per = saved.groupBy(F.col(session).alias("_session")).agg(F.count("*").alias("length"), F.min("_prompt").alias("task"), F.count_distinct("_prompt").alias("n"))
    if not per.where("n > 1").isEmpty():
        raise ValueError("a session has several prompts")
    by = Window.orderBy("_session")  # a row for each session
    numbered = per.withColumns({"episode_index": (F.row_number().over(by) - 1 + dataset.next_episode).cast("long"), "to": F.sum("length").over(by) + dataset.total_frames})
    known = spark.createDataFrame([(t, i) for t, i in dataset.tasks.items()], "task string, task_index long")
    tasks = task_dictionary(numbered, "task", ["episode_index"], known)
    numbered = numbered.join(F.broadcast(tasks), "task").select("_session", "episode_index", "task_index", "task", "length", (F.col("to") - F.col("length")).alias("from"), "to").cache()
    rows = saved.join(F.broadcast(numbered), F.col(session) == F.col("_session"))  # a row for each session
    rows = rows.withColumn("frame_index", (F.row_number().over(Window.partitionBy("episode_index").orderBy(order)) - 1).cast("long"))
    time = F.col("frame_index") / F.lit(float(dataset.fps))
    video = {c: F.struct(F.format_string(f"videos/{c}/episode_%06d.mp4", "episode_index").alias("path"), time.alias("timestamp")) for c in cameras}
    out = rows.select(
        *(F.col(f"`{c}`") for c in dataset.columns), F.col("task").alias(doc.TASK), time.alias("timestamp"), "frame_index", "episode_index", (F.col("from") + F.col("frame_index")).alias("index"), "task_index", *(c.alias(n) for n, c in video.items()),
    )
    root = dataset.root
    sinks.write_fixed_lists(out, f"{root}/data", "episode_index", name="train-{episode:06d}.parquet", chunk=0)
    new = []
    for r in numbered.orderBy("episode_index").collect():  # one for each session
        paths = {c: f"videos/{c}/episode_{r['episode_index']:06d}.mp4" for c in cameras}
        new.append({
            "episode_index": r["episode_index"], "episode_id": str(r["_session"]), "task_index": r["task_index"], "tasks": [r["task"]], "length": r["length"], "fps": dataset.fps,
            "data_path": f"data/train-{r['episode_index']:06d}.parquet", "video_path": next(iter(paths.values()), ""), "video_paths": paths, "dataset_from_index": r["from"], "dataset_to_index": r["to"],
        })
    made = Dataset(root, dataset.fps, dataset.columns, {r["task"]: r["task_index"] for r in tasks.collect()}, [*dataset.episodes, *new], dataset.features, [*dataset.commits, commit])
    shapes = cameras or {c: f["shape"] for c, f in dataset.features.items() if c.startswith("observation.images.")}
    made.features = doc.collected_features(dataset.columns, shapes, dataset.fps, joints)
    state = [c.removeprefix(_ROBOT[0]) for c in made.columns if c.startswith(_ROBOT[0])]
    actions = [c.removeprefix(_ROBOT[1]) for c in made.columns if c.startswith(_ROBOT[1])]
    info = doc.info(doc.COLLECTED, made.features, made.fps, len(made.episodes), made.total_frames, len(made.tasks), len(made.episodes) * len(shapes)) | {"commits": made.commits}
    sinks.replace_files({
        f"{root}/meta/tasks.jsonl": doc.jsonl([{"task_index": i, "task": t} for t, i in sorted(made.tasks.items(), key=lambda x: x[1])]),
        f"{root}/meta/episodes.jsonl": doc.jsonl(made.episodes),
        f"{root}/meta/info.json": sinks.pretty(info),
        f"{root}/meta/modality.json": sinks.pretty(doc.collected_modality(state, actions, shapes, made.fps)),
    })
    return made


def remove_uncommitted(dataset: Dataset) -> list[str]:
    """Deletes episode files that no record names, as a failed commit or a discarded session may leave them; returns their names."""
    named = {e["data_path"] for e in dataset.episodes} | {p for e in dataset.episodes for p in e.get("video_paths", {}).values()}
    gone = []
    for top in ("data", "videos"):
        for folder, _, files in os.walk(f"{dataset.root}/{top}"):
            for name in files:
                path = os.path.relpath(f"{folder}/{name}", dataset.root)
                if path not in named:
                    os.remove(f"{dataset.root}/{path}")
                    gone.append(path)
    return sorted(gone)


def discard_dataset(dataset: Dataset) -> None:
    """Deletes a dataset that has no episode; an error if it has any."""
    if dataset.episodes:
        raise ValueError("the dataset has episodes")
    shutil.rmtree(dataset.root, ignore_errors=True)
