"""Videos of episodes: where they lie, whether they suit their rows, their frames, and copies of them. Readers are given by the caller."""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.functions.images import rgb_shape, same_shape, to_bytes
from frameloom.operators.episodes import first_values
from frameloom.sources.episodes import inside, safe_name


class FrameReader(Protocol):
    """Random access to the frames of a video."""

    frame_count: int
    shape: Sequence[int]

    def read_rgb(self, index: int) -> Any: ...

    def close(self) -> None: ...


Factory = Callable[[str], FrameReader]


@contextmanager
def open_readers(paths: Mapping[str, str], factory: Factory) -> Iterator[dict[str, FrameReader]]:
    """A reader for each name; whatever fails, those that were opened are closed."""
    with ExitStack() as stack:
        opened = {}
        for name, path in paths.items():
            opened[name] = factory(path)
            stack.callback(opened[name].close)
        yield opened


def video_paths(episodes: DataFrame, frames: DataFrame, cameras: Sequence[str], order: str = "frame_index") -> DataFrame:
    """(episode_index, camera, path): from the episode's ``video_paths``, where that is null from its first row's camera column; an error without either."""
    columns = [c for c in cameras if c in frames.columns]
    given = F.col("video_paths") if "video_paths" in episodes.columns else F.lit(None).cast("map<string,string>")
    listed = episodes.select("episode_index", given.alias("given"), F.explode(F.array(*map(F.lit, cameras))).alias("camera"))
    if columns:
        slim = frames.select("episode_index", order, *(F.col(f"`{c}`.path").alias(f"p{i}") for i, c in enumerate(columns)))
        first = first_values(slim, "episode_index", order, [f"p{i}" for i in range(len(columns))])
        own = first.select("episode_index", F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(F.col(f"p{i}") for i in range(len(columns))))).alias("own"))
        listed = listed.join(own, "episode_index", "left")
    else:
        listed = listed.withColumn("own", F.lit(None).cast("map<string,string>"))
    path = F.when(F.col("given").isNotNull(), F.try_element_at("given", F.col("camera"))).otherwise(F.try_element_at("own", F.col("camera")))
    missing = F.raise_error(F.concat(F.lit("no video path of "), F.col("camera"))).cast("string")
    return listed.select("episode_index", "camera", F.coalesce(F.nullif(path, F.lit("")), missing).alias("path"))


def required_cameras(info: dict, cameras: Sequence[str]) -> None:
    """An error if the features of a dataset's ``info`` lack a camera."""
    features = info.get("features")
    if not isinstance(features, dict):
        raise ValueError("features must be a mapping")
    absent = sorted(set(map(safe_name, cameras)) - set(features))
    if absent:
        raise ValueError(f"features lack the cameras {absent}")


def image_shapes(paths: DataFrame, lengths: DataFrame, root: str, factory: Factory) -> dict[str, tuple[int, int, int]]:
    """The one shape of each camera; an error for a missing video, one with fewer frames than rows, one of another kind or shape.

    Videos are opened by the tasks, and only one row for each different answer comes back.
    """
    todo = paths.join(lengths, "episode_index").select("camera", "path", F.col("length").cast("long").alias("length"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for camera, path, length in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    whole = inside(root, path)
                    if not os.path.isfile(whole):
                        raise ValueError("there is no such file")
                    with open_readers({camera: whole}, factory) as readers:
                        count, shape = readers[camera].frame_count, tuple(int(x) for x in readers[camera].shape)
                    if count < length:
                        raise ValueError(f"{count} frames for {length} rows")
                    if len(shape) != 3 or shape[2] != 3 or min(shape) <= 0:
                        raise ValueError(f"no RGB shape: {shape}")
                    rows.append((camera, list(shape), None))
                except (ValueError, OSError) as e:
                    rows.append((camera, None, f"{path}: {e}"))
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.list_(pa.int64()), pa.string()))], ["camera", "shape", "error"])

    found = todo.mapInArrow(run, "camera string, shape array<long>, error string").distinct()
    rows = found.limit(1000).collect()
    errors = sorted(r["error"] for r in rows if r["error"])
    if errors:
        raise ValueError(f"videos don't suit their episodes: {errors[:10]}")
    shapes: dict[str, tuple[int, int, int]] = {}
    for r in rows:
        if shapes.setdefault(r["camera"], tuple(r["shape"])) != tuple(r["shape"]):
            raise ValueError(f"the shape of {r['camera']} differs between episodes")
    return shapes


def read_frames(frames: DataFrame, paths: DataFrame, root: str, factory: Factory, encode: Callable[[Any], bytes], shapes: Mapping[str, Sequence[int]]) -> DataFrame:
    """(episode_index, frame_index, camera, bytes, lo, hi, total, squares): the encoded image of each row of (episode_index, frame_index), and
    sums of its channels from 0 to 1 as in ``channel_partials``. Each task opens a video once for consecutive rows.
    """
    todo = frames.select("episode_index", "frame_index").join(paths, "episode_index")
    todo = todo.repartition("episode_index", "camera").sortWithinPartitions("episode_index", "camera", "frame_index").select("episode_index", "frame_index", "camera", "path")
    names = ["episode_index", "frame_index", "camera", "bytes", "lo", "hi", "total", "squares", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ExitStack() as stack:
            current, reader = None, None
            for batch in batches:
                rows = []
                for e, f, camera, path in zip(*(c.to_pylist() for c in batch.columns)):
                    if path != current:
                        stack.close()
                        current, reader = path, factory(inside(root, path))
                        stack.callback(reader.close)
                    image = to_bytes(reader.read_rgb(f))
                    same_shape(camera, image, tuple(shapes[camera]))
                    pixels = image.reshape(-1, 3) / 255.0
                    rows.append((e, f, camera, encode(image), *(x.tolist() for x in (pixels.min(0), pixels.max(0), pixels.sum(0), (pixels * pixels).sum(0))), len(pixels)))
                columns = list(zip(*rows)) or [[] for _ in names]
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(), *[pa.list_(pa.float64())] * 4, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    lists = ", ".join(f"{c} array<double>" for c in ("lo", "hi", "total", "squares"))
    return todo.mapInArrow(run, f"episode_index long, frame_index long, camera string, bytes binary, {lists}, n long")


def copy_videos(paths: DataFrame, root: str, target: str, where: str = "videos/chunk-000/{camera}/episode_{episode:06d}.mp4") -> DataFrame:
    """Copies every video to its place in ``target``, by the tasks; (episode_index, camera, path) of the copies. A copy that runs again replaces itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for e, camera, path in zip(*(c.to_pylist() for c in batch.columns)):
                to = where.format(camera=safe_name(camera), episode=e)
                whole = inside(target, to)
                os.makedirs(os.path.dirname(whole), exist_ok=True)
                part = f"{whole}.{os.getpid()}"
                shutil.copy2(inside(root, path), part)
                os.replace(part, whole)
                rows.append((e, camera, to))
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()))], ["episode_index", "camera", "path"])

    made = paths.select("episode_index", "camera", "path").mapInArrow(run, "episode_index long, camera string, path string")
    rows = made.collect()  # one for each video
    return paths.sparkSession.createDataFrame(rows, made.schema)


def video_records(paths: DataFrame) -> DataFrame:
    """(episode_index, video_paths): the paths of an episode as a map."""
    return paths.groupBy("episode_index").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("camera", "path")))).alias("video_paths"))


class RawVideo:
    """A reader and a sink of uncompressed frames with a header of their shape, for tests and as an example of both."""

    def __init__(self, path: str) -> None:
        import numpy as np

        with open(path, "rb") as f:
            self.shape = tuple(np.frombuffer(f.read(12), "<i4").tolist())
            data = np.frombuffer(f.read(), np.uint8)
        self.frames = data.reshape(-1, *self.shape)
        self.frame_count = len(self.frames)

    def read_rgb(self, index: int):
        if not 0 <= index < self.frame_count:
            raise ValueError(f"no frame {index} of {self.frame_count}")
        return self.frames[index]

    def close(self) -> None:
        self.frames = None


class RawVideoSink:
    """Opens its file on the first frame; a frame of another shape is an error."""

    def __init__(self, path: str) -> None:
        self.path, self.file, self.shape = path, None, None

    def write(self, image) -> None:
        import numpy as np

        image = to_bytes(image)
        if self.file is None:
            os.makedirs(os.path.dirname(self.path), exist_ok=True)
            self.file, self.shape = open(self.path, "wb"), rgb_shape(image)
            self.file.write(np.array(self.shape, "<i4").tobytes())
        same_shape(self.path, image, self.shape)
        self.file.write(image.tobytes())

    def close(self) -> None:
        if self.file:
            self.file.close()
            self.file = None

    def discard(self) -> None:
        self.close()
        if os.path.exists(self.path):
            os.remove(self.path)
