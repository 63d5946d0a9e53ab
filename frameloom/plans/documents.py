"""Documents and records that describe a dataset, in three forms: collected, state-action and compact."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.functions.vectors import DOF, STATE_FIELDS

VERSION = "v2.1"
CHUNK = 1000
TASK = "annotation.human.action.task_description"
#: Where files of the three forms lie.
COLLECTED = {"data": "data/train-{episode_index:06d}.parquet", "video": "videos/{video_key}/episode_{episode_index:06d}.mp4"}
STATE_ACTION = {"data": "data/chunk-000/episode_{episode_index:06d}.parquet", "video": "videos/chunk-000/{video_key}/episode_{episode_index:06d}.mp4"}
COMPACT = {"data": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "video": "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"}

#: Widths (and names of the places) of state columns beside the policy's own fields.
RAW_STATE = {"joint_position": DOF, "joint_velocity": DOF, "joint_torque": DOF, "imu_angular_velocity": 3, "imu_linear_acceleration": 3, "projected_gravity_or_quat": 4}
ACTION_FIELDS = {"joint_position": DOF, "aligned_target_pos": 45, "policy_action": DOF}
_PLACES = {3: ["x", "y", "z"], 4: ["x", "y", "z", "w"]}


def feature(dtype: str, shape: Sequence[int] = (1,), names: Sequence[str] | None = None) -> dict:
    return {"dtype": dtype, "shape": list(shape), "names": list(names) if names else None}


def index_features() -> dict[str, dict]:
    return {"timestamp": feature("float32"), **{n: feature("int64") for n in ("frame_index", "episode_index", "index", "task_index")}}


def video_feature(shape: Sequence[int], fps: float) -> dict:
    height, width, channels = (int(x) for x in shape)
    about = {"height": height, "width": width, "codec": "mp4v", "pix_fmt": "yuv420p", "is_depth_map": False, "fps": fps, "channels": channels}
    return feature("video", (height, width, channels), ("height", "width", "channels")) | {"info": {f"video.{k}": v for k, v in about.items()} | {"has_audio": False}}


def robot_features(columns: Sequence[str], joints: Sequence[str] = ()) -> dict[str, dict]:
    """Features of observation.state.* and action.* columns; joint vectors carry the names of joints if there are 29."""
    widths = {f"observation.state.{n}": w for n, w in (RAW_STATE | STATE_FIELDS).items()} | {f"action.{n}": w for n, w in ACTION_FIELDS.items()}
    plain = {f"observation.state.{n}" for n in RAW_STATE} | {f"action.{n}" for n in ACTION_FIELDS}
    unknown = sorted(set(columns) - set(widths))
    if unknown:
        raise ValueError(f"unknown columns {unknown}")

    def names(c: str) -> Sequence[str] | None:
        if c not in plain:
            return None
        return joints if widths[c] == DOF and len(joints) == DOF else _PLACES.get(widths[c])

    return {c: feature("float32", (widths[c],), names(c)) for c in columns}


def collected_features(columns: Sequence[str], shapes: Mapping[str, Sequence[int]], fps: float, joints: Sequence[str] = ()) -> dict[str, dict]:
    return {c: video_feature(s, fps) for c, s in shapes.items()} | robot_features(columns, joints) | {TASK: feature("string")} | index_features()


def state_action_features(state: int, action: int, source: Mapping[str, dict], cameras: Sequence[str]) -> dict[str, dict]:
    """Features of the state-action form; those of cameras are the source's, and an error if it has none."""
    absent = [c for c in cameras if not isinstance(source.get(c), dict)]
    if absent:
        raise ValueError(f"features lack the cameras {absent}")
    made = {"observation.state": feature("float32", (state,)), "action": feature("float32", (action,)), TASK: feature("int64")}
    return made | index_features() | {"next.reward": feature("float32"), "next.done": feature("bool")} | {c: source[c] for c in cameras}


def compact_features(shapes: Mapping[str, Sequence[int]], width: int = DOF) -> dict[str, dict]:
    images = {c: feature("image", [int(x) for x in s], ("height", "width", "channel")) for c, s in shapes.items()}
    return images | {c: feature("float32", (width,), ("joint",)) for c in ("state", "actions")} | index_features()


def info(paths: Mapping[str, str], features: Mapping[str, dict], fps: float, episodes: int, frames: int, tasks: int, videos: int, source: Mapping[str, object] | None = None, robot: str = "unknown", chunks: int | None = None) -> dict:
    """The document of a dataset; version and robot come from that of its ``source``, if that has them."""
    source = source or {}
    return {
        "codebase_version": str(source.get("codebase_version", VERSION)), "robot_type": str(source.get("robot_type", robot)),
        "total_episodes": episodes, "total_frames": frames, "total_tasks": tasks, "total_videos": videos, "total_chunks": 1 if chunks is None else chunks, "chunks_size": CHUNK,
        "fps": fps, "splits": {"train": f"0:{episodes}"}, "data_path": paths["data"], "video_path": paths["video"], "features": dict(features),
    }


def chunk_count(episodes: int, size: int = CHUNK) -> int:
    return max(1, -(-episodes // size))


def collected_modality(state: Sequence[str], actions: Sequence[str], shapes: Mapping[str, Sequence[int]], fps: float) -> dict:
    """What the columns of the collected form are."""
    widths = RAW_STATE | STATE_FIELDS
    images = {c.rsplit(".", 1)[-1]: {"key": c, "dtype": "rgb", "shape": [int(x) for x in s], "fps": fps} for c, s in shapes.items()}
    return {
        "observation": {"images": images, "state": {n: {"shape": [widths[n]]} for n in state}},
        "action": {n: {"shape": [ACTION_FIELDS[n]]} for n in actions},
        "annotation": {"human": {"action": {"task_description": {"key": TASK, "dtype": "string"}}}},
    }


def hub_metadata(shapes: Sequence[str], width: int = DOF) -> bytes:
    """The description of the compact form's columns that is kept in the metadata of its files, under the key "huggingface"."""
    value = {"dtype": "float32", "_type": "Value"}
    made = {c: {"_type": "Image"} for c in shapes} | {c: {"feature": value, "length": width, "_type": "Sequence"} for c in ("state", "actions")}
    made |= {n: {"dtype": f["dtype"], "_type": "Value"} for n, f in index_features().items()}
    return json.dumps({"info": {"features": made}}, sort_keys=True).encode()


def jsonl(rows: Sequence[Mapping[str, object]]) -> str:
    """A line for each record, keys sorted."""
    return "".join(json.dumps(r, sort_keys=True, ensure_ascii=False) + "\n" for r in rows)


def episode_rows(records: DataFrame, form: str) -> DataFrame:
    """Records of episodes in a form's columns: 11 of the collected one, 6 of state-action, 3 of compact."""
    names = {
        "collected": ["episode_index", "episode_id", "task_index", "tasks", "length", "fps", "data_path", "video_path", "video_paths", "dataset_from_index", "dataset_to_index"],
        "state_action": ["episode_index", "tasks", "length", "fps", "data_path", "video_paths"],
        "compact": ["episode_index", "tasks", "length"],
    }[form]
    return records.select(*names).orderBy("episode_index")


def stats_rows(stats: DataFrame, images: Sequence[str] = ()) -> DataFrame:
    """(episode_index, stats): of ``episode_stats`` rows a map by column; image statistics are nested as channels x 1 x 1 in ``jsonl_stats``."""
    return stats.groupBy("episode_index").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", F.struct("min", "max", "mean", "std", "count"))))).alias("stats")).orderBy("episode_index")


def stats_document(row: Mapping[str, object], images: Sequence[str] = ()) -> dict:
    """A row of ``stats_rows`` as a record: counts are lists of one, and of images each channel's value lies two lists deep."""
    out = {}
    for name, s in row["stats"].items():
        deep = (lambda xs: [[[x]] for x in xs]) if name in images else list
        out[name] = {k: deep(s[k]) for k in ("min", "max", "mean", "std")} | {"count": [s["count"]]}
    return {"episode_index": row["episode_index"], "stats": out}
