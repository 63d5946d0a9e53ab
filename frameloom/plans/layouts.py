"""Export layouts of episodes and the tables that describe them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.vectors import DOF, STATE_FIELDS, checked, concat_vectors, episode_path, history_window
from frameloom.operators.episodes import done_flag, episode_index

#: Widths of the three columns that can serve as action.
ACTIONS = {"policy_action": 29, "target_joint_pos": 29, "aligned_target_pos": 45}
CHUNK = 1000


def _cameras(frames: DataFrame) -> list[str]:
    return sorted(c for c in frames.columns if c.startswith("observation.images."))


def state_action_layout(frames: DataFrame, state: Sequence[tuple[str, int]] = tuple((f"observation.state.{n}", w) for n, w in STATE_FIELDS.items()), action: tuple[str, int] = ("action.aligned_target_pos", 45), fps: float = 50.0) -> DataFrame:
    """Frames of all episodes as one state vector and one action vector a row, with running index, reward and done.

    Columns of ``frames``: episode_index, frame_index, task_index, the vectors and ``observation.images.*``.
    """
    rows = episode_index(frames.withColumnRenamed("frame_index", "_at").drop("index"), "episode_index", "_at")
    quote = lambda c: f"`{c}`"
    return rows.select(
        concat_vectors([(quote(c), n) for c, n in state]).alias("observation.state"),
        checked(quote(action[0]), action[1], action[0]).alias("action"),
        (F.col("frame_index") / F.lit(fps)).cast("float").alias("timestamp"),
        "frame_index",
        F.col("episode_index").cast("long").alias("episode_index"),
        "index",
        F.col("task_index").cast("long").alias("task_index"),
        F.col("task_index").cast("long").alias("annotation.human.action.task_description"),
        F.lit(0.0).cast("float").alias("next.reward"),
        done_flag("episode_index", "frame_index").alias("next.done"),
        *(F.col(quote(c)) for c in _cameras(frames)),
    )


def compact_layout(frames: DataFrame, state: str, actions: str, width: int = DOF, window: int = -1, images: Sequence[tuple[str, Column]] = (), fps: float = 50.0) -> DataFrame:
    """Frames as two vectors of one window each, with images given as struct<bytes, path> columns."""
    rows = episode_index(frames.withColumnRenamed("frame_index", "_at").drop("index"), "episode_index", "_at")
    return rows.select(
        *(c.alias(n) for n, c in images),
        history_window(f"`{state}`", width, window).alias("state"),
        history_window(f"`{actions}`", width, window).alias("actions"),
        (F.col("frame_index") / F.lit(fps)).cast("float").alias("timestamp"),
        "frame_index",
        F.col("episode_index").cast("long").alias("episode_index"),
        "index",
        F.col("task_index").cast("long").alias("task_index"),
    )


def episode_records(rows: DataFrame, episode: str, order: str, task: str, fps: float = 50.0, chunk: int = 0) -> DataFrame:
    """(episode_index, tasks, length, fps, data_path, from_index, to_index) of each episode."""
    per = rows.groupBy(F.col(episode).alias("episode_index")).agg(F.sort_array(F.collect_set(task)).alias("tasks"), F.count("*").alias("length"))
    to = F.sum("length").over(Window.orderBy("episode_index").rowsBetween(Window.unboundedPreceding, 0))  # a row for each episode
    return per.withColumn("to_index", to).select("episode_index", "tasks", "length", F.lit(fps).alias("fps"), episode_path("episode_index", chunk).alias("data_path"), (F.col("to_index") - F.col("length")).alias("from_index"), "to_index")


def dataset_info(rows: DataFrame, episode: str, task: str, cameras: int = 0, chunk: int = CHUNK) -> DataFrame:
    """One row of totals: episodes, frames, tasks, videos, chunks, next episode and the split."""
    n = F.count_distinct(episode)
    return rows.agg(
        n.alias("total_episodes"),
        F.count("*").alias("total_frames"),
        F.count_distinct(task).alias("total_tasks"),
        (n * cameras).alias("total_videos"),
        F.greatest(F.lit(1), F.ceil(n / chunk)).cast("long").alias("total_chunks"),
        (F.coalesce(F.max(episode), F.lit(-1)) + 1).cast("long").alias("next_episode"),
        F.concat(F.lit("0:"), n.cast("string")).alias("train_split"),
    )


def modality(state: dict[str, int], action: dict[str, int], cameras: Sequence[str]) -> dict:
    """Slices of each field in the state and action vectors, and the cameras, as a document."""

    def slices(fields: dict[str, int]) -> dict:
        out, at = {}, 0
        for name, width in fields.items():
            out[name] = {"start": at, "end": at + width}
            at += width
        return out

    return {
        "state": slices(state),
        "action": slices(action),
        "video": {c.rsplit(".", 1)[-1]: {"original_key": c} for c in sorted(cameras)},
        "annotation": {"annotation.human.action.task_description": {}},
    }
