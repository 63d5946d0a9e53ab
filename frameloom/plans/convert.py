"""Conversion of a stored dataset: read, check everything, write beside the target, then move into place."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions.vectors import DOF, STATE_FIELDS, episode_path
from frameloom.operators.episodes import frame_number, require_dense
from frameloom.operators.stats import episode_stats
from frameloom.operators.tasks import task_codes
from frameloom.plans import documents as doc
from frameloom.plans import layouts
from frameloom.sources import episodes as src
from frameloom.sources import sinks, video

_EPISODES = "episode_index long, data_path string, video_paths map<string,string>"


@dataclass
class Source:
    """A dataset that passed all checks that need no video."""

    root: str
    info: dict
    episodes: DataFrame
    frames: DataFrame
    tasks: DataFrame
    fps: float


def load(spark: SparkSession, root: str) -> Source:
    """Reads a dataset; frames get frame_index by their place and task_index by the task dictionary.

    Errors: no positive fps, no episodes, episode or frame indices that aren't dense, frame indices out of the order of
    rows, files that are missing or out of ``root``, episodes without rows, tasks that are blank or have no text.
    """
    info = src.read_json(f"{root}/meta/info.json")
    fps = info.get("fps", 0)
    if not fps > 0:
        raise ValueError("fps must be positive")
    episodes = src.read_jsonl(spark, f"{root}/meta/episodes.jsonl", _EPISODES).where("episode_index IS NOT NULL").cache()
    require_dense(episodes.withColumn("dataset", F.lit(root)), "dataset", "episode_index")
    raw = src.read_listed(spark, root, episodes)
    frames = raw.withColumn("frame_index", frame_number(raw)).drop("index")
    require_dense(frames, "episode_index", "frame_index")
    if not frames.where("frame_index <> row_index").isEmpty():
        raise ValueError("frame_index doesn't follow the order of rows")
    empty = episodes.join(frames.select("episode_index").distinct(), "episode_index", "left_anti").limit(10).collect()
    if empty:
        raise ValueError(f"episodes without rows: {[r[0] for r in empty]}")
    known = src.read_jsonl(spark, f"{root}/meta/tasks.jsonl", "task_index long, task string").where("task IS NOT NULL AND task_index IS NOT NULL")
    coded, tasks = task_codes(frames, doc.TASK, ["episode_index", "frame_index"], known)
    stray = coded.select("task_index").distinct().join(tasks, "task_index", "left_anti").limit(10).collect()
    if stray:
        raise ValueError(f"no task has the index {[r[0] for r in stray]}")
    return Source(root, info, episodes, coded, tasks.cache(), fps)


def records(source: Source, chunk: int, videos: DataFrame | None = None) -> DataFrame:
    """Episode records with tasks in the order of their codes."""
    per = source.frames.groupBy("episode_index").agg(F.sort_array(F.collect_set("task_index")).alias("codes"), F.count("*").alias("length"))
    named = per.select("episode_index", "length", F.posexplode("codes").alias("at", "task_index")).join(F.broadcast(source.tasks), "task_index")  # a row for each task
    listed = named.groupBy("episode_index", "length").agg(F.sort_array(F.collect_list(F.struct("at", "task")))["task"].alias("tasks"))
    out = listed.withColumn("fps", F.lit(source.fps)).withColumn("data_path", episode_path("episode_index", chunk) if chunk else F.format_string("data/chunk-000/episode_%06d.parquet", "episode_index"))
    return out if videos is None else out.join(video.video_records(videos), "episode_index", "left")


def _meta(folder: str, source: Source, episodes: DataFrame, documents: Mapping[str, dict], more: Mapping[str, str] | None = None) -> None:
    """The documents of a dataset, and its tasks and episodes as files of a line each."""
    tasks = [{"task_index": r["task_index"], "task": r["task"]} for r in source.tasks.orderBy("task_index").collect()]
    listed = [r.asDict(recursive=True) for r in episodes.collect()]  # one for each episode
    files = {f"{folder}/meta/tasks.jsonl": doc.jsonl(tasks), f"{folder}/meta/episodes.jsonl": doc.jsonl(listed)} | {f"{folder}/meta/{k}": v for k, v in (more or {}).items()}
    sinks.replace_files(files | {f"{folder}/meta/{k}": sinks.pretty(v) for k, v in documents.items()})


def convert_state_action(spark: SparkSession, root: str, target: str, action: str = "aligned_target_pos") -> None:
    """Writes the state-action form of the dataset at ``root`` to ``target``, which must not exist; videos are copied."""
    source = load(spark, root)
    cameras = sorted(c for c in source.info.get("features", {}) if c.startswith("observation.images."))
    state = [(f"observation.state.{n}", w) for n, w in STATE_FIELDS.items()]
    features = doc.state_action_features(sum(STATE_FIELDS.values()), layouts.ACTIONS[action], source.info.get("features", {}), cameras)
    with sinks.staged(target) as folder:
        videos, frames = None, source.frames
        if cameras:
            videos = video.copy_videos(video.video_paths(source.episodes, frames, cameras), root, folder)
            moved = video.video_records(videos)
            at = {c: F.struct(F.try_element_at("video_paths", F.lit(c)).alias("path"), F.col(f"`{c}`.timestamp").alias("timestamp")) for c in cameras if c in frames.columns}
            frames = frames.join(moved, "episode_index").withColumns(at).drop("video_paths")
        rows = layouts.state_action_layout(frames, state, (f"action.{action}", layouts.ACTIONS[action]), source.fps)
        sinks.write_fixed_lists(rows, f"{folder}/data", "episode_index", chunk=0)
        totals = _totals(source)
        _meta(folder, source, doc.episode_rows(records(source, 0, videos) if videos is not None else records(source, 0).withColumn("video_paths", F.create_map().cast("map<string,string>")), "state_action"), {
            "info.json": doc.info(doc.STATE_ACTION, features, source.fps, *totals, totals[0] * len(cameras), source.info),
            "modality.json": layouts.modality(STATE_FIELDS, {action: layouts.ACTIONS[action]}, cameras),
        })


def convert_compact(
    spark: SparkSession, root: str, target: str, state: str, actions: str, window: int = -1, images: Mapping[str, str] | None = None,
    reader: Callable[[str], video.FrameReader] | None = None, encode: Callable[[Any], bytes] | None = None,
) -> None:
    """Writes the compact form: ``state`` and ``actions`` are columns of one or more windows of 29 values.

    ``images`` names the image column of each camera; its frames come from ``reader`` and are stored as ``encode`` makes them. Files
    have lists of fixed size and describe their columns in their metadata; statistics of each episode lie beside them.
    """
    source, images = load(spark, root), dict(images or {})
    video.required_cameras(source.info | {"features": source.info.get("features") or {}}, list(images))
    shapes: dict[str, tuple[int, int, int]] = {}
    columns, partials = [], None
    frames = source.frames
    if images:
        if reader is None or encode is None:
            raise ValueError("images need a reader and an encoder")
        paths = video.video_paths(source.episodes, frames, list(images))
        shapes = video.image_shapes(paths, frames.groupBy("episode_index").agg(F.count("*").alias("length")), root, reader)
        pictures = video.read_frames(frames, paths, root, reader, encode, shapes)
        wide = pictures.groupBy("episode_index", "frame_index").agg(*(F.max(F.when(F.col("camera") == c, F.col("bytes"))).alias(n) for c, n in images.items()))
        frames = frames.join(wide, ["episode_index", "frame_index"])
        columns = [(n, F.struct(F.col(n).alias("bytes"), F.format_string("frame_%06d.png", "frame_index").alias("path"))) for n in images.values()]
        named = F.create_map(*(x for c, n in images.items() for x in (F.lit(c), F.lit(n))))
        sums = F.posexplode(F.arrays_zip("lo", "hi", "total", "squares"))
        partials = pictures.select("episode_index", named[F.col("camera")].alias("name"), "n", sums.alias("channel", "s")).select("episode_index", "name", "channel", "s.*", "n", F.lit(1).cast("long").alias("frames"))
    rows = layouts.compact_layout(frames, state, actions, window=window, images=columns, fps=source.fps)
    features = doc.compact_features({n: shapes[c] for c, n in images.items()})
    with sinks.staged(target) as folder:
        sinks.write_fixed_lists(rows, f"{folder}/data", "episode_index", widths={"state": DOF, "actions": DOF}, metadata={"huggingface": doc.hub_metadata(list(images.values()))}, chunk=layouts.CHUNK)
        written = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/data")
        stats = episode_stats(written, "episode_index", ["state", "actions"], ["timestamp", "frame_index", "index", "task_index"], partials)
        own = written.select(F.col("episode_index"), F.col("episode_index").alias("x"))
        stats = stats.unionByName(episode_stats(own, "episode_index", [], ["x"]).withColumn("name", F.lit("episode_index")))
        listed = [doc.stats_document(r.asDict(recursive=True), list(images.values())) for r in doc.stats_rows(stats).collect()]  # one for each episode
        totals = _totals(source)
        _meta(folder, source, doc.episode_rows(records(source, layouts.CHUNK), "compact"), {
            "info.json": doc.info(doc.COMPACT, features, source.fps, *totals, 0, source.info | {"codebase_version": doc.VERSION}, chunks=doc.chunk_count(totals[0])),
        }, {"episodes_stats.jsonl": doc.jsonl(listed)})


def _totals(source: Source) -> tuple[int, int, int]:
    """Episodes, frames, tasks."""
    row = source.frames.agg(F.count_distinct("episode_index").alias("e"), F.count("*").alias("f")).first()
    return row["e"], row["f"], source.tasks.count()


def field_columns(fields: Mapping[str, Sequence[str]]) -> list[str]:
    """Columns of a selection of ``read_fields``, state first."""
    return [f"observation.state.{n}" for n in fields["state"]] + [f"action.{n}" for n in fields["target"]]
