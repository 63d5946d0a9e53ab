"""Packets of several streams: decoding, completeness, the bundle that holds at a time, and which ticks are recorded."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.names import look_up
from frameloom.functions.vectors import epoch_seconds, seconds_between
from frameloom.operators.tasks import missing_of

DEPTH = "_depth"


def decode_packets(packets: DataFrame, decode: Callable[[bytes, bool], bytes | None], images: str = "images") -> DataFrame:
    """``packets`` with the blobs of the map ``images`` decoded; those that can't be are dropped.

    ``decode(blob, unchanged)`` is the codec that the caller gives; it returns None (or fails) for what it can't read. Depth
    images, whose names end with ``_depth``, are to be decoded unchanged.
    """
    names = packets.columns
    plain = packets.toDF(*(f"c{i}" for i in range(len(names))))  # names with dots don't reach Python workers
    at = names.index(images)
    kind = pa.map_(pa.string(), pa.binary())

    def one(name: str, blob: bytes | None) -> bytes | None:
        try:
            return None if blob is None else decode(blob, name.endswith(DEPTH))
        except (ValueError, OSError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for entries in batch.column(at).to_pylist():
                got = None if entries is None else [(n, one(n, b)) for n, b in (entries.items() if isinstance(entries, dict) else entries)]
                made.append(None if got is None else [(n, b) for n, b in got if b is not None])
            columns = list(batch.columns)
            columns[at] = pa.array(made, kind)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def complete_bundles(packets: DataFrame, required: Sequence[str], images: str = "images", timestamps: str = "timestamps") -> DataFrame:
    """``packets`` with ``missing`` streams and ``bundle``, a map of required stream to struct<image, camera_time>; null if one is missing."""
    present = F.coalesce(F.map_keys(images), F.array().cast("array<string>"))
    out = packets.withColumn("missing", missing_of(required, present))
    frames = F.map_from_arrays(
        F.array(*map(F.lit, required)),
        F.array(*(F.struct(F.try_element_at(images, F.lit(n)).alias("image"), epoch_seconds(F.try_element_at(timestamps, F.lit(n))).alias("camera_time")) for n in required)),
    )
    return out.withColumn("bundle", F.when(F.size("missing") == 0, frames))


def bundle_image(bundle: Column | str, camera: str) -> Column:
    """The image under a camera's key, else under its stream, the last part of the key; an error where there is neither."""
    return F.coalesce(look_up(bundle, camera, camera.rsplit(".", 1)[-1]), F.raise_error(F.lit(f"no image of {camera}")))


def latest_bundles(ticks: DataFrame, bundles: DataFrame, keys: Sequence[str], ts: str, value: str = "bundle") -> DataFrame:
    """``ticks`` with the value of the last row of ``bundles`` at or before them, and its time; an incomplete packet (null) clears what was held."""
    given = F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))
    kind = bundles.select(given.alias("g")).schema["g"].dataType
    a = ticks.select("*", F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_given"))
    b = bundles.select(*(F.col(c) if c in (*keys, ts) else F.lit(None).cast(ticks.schema[c].dataType).alias(c) for c in ticks.columns), F.lit(0).alias("_side"), given.alias("_given"))
    w = Window.partitionBy(*keys).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("_last", F.last("_given", ignorenulls=True).over(w)).where("_side = 1")
    held = F.col("_last.v").isNotNull()
    return both.select(*ticks.columns, F.col("_last.v").alias(value), F.when(held, F.col("_last.t")).alias(f"{ts}_of"))


SKIPS = ("not recording", "no sample", "no bundle", "stale sample", "stale bundle")


def gate_ticks(ticks: DataFrame, ts: str, recording: Column, sample_ts: str, bundle_ts: str, sample_age: float, bundle_age: float) -> DataFrame:
    """``ticks`` with ``skip``, the first reason why a tick isn't recorded, or null; an age of exactly the limit is fresh."""

    def stale(stamp: str, limit: float) -> Column:
        return F.coalesce(seconds_between(stamp, ts) > limit, F.lit(False)) if limit > 0 else F.lit(False)

    reasons = (~F.coalesce(recording, F.lit(False)), F.col(sample_ts).isNull(), F.col(bundle_ts).isNull(), stale(sample_ts, sample_age), stale(bundle_ts, bundle_age))
    skip = F.lit(None).cast("string")
    for wrong, name in reversed(list(zip(reasons, SKIPS))):
        skip = F.when(wrong, F.lit(name)).otherwise(skip)
    return ticks.withColumn("skip", skip)


def numbered_frames(gated: DataFrame, episode: Sequence[str], ts: str) -> DataFrame:
    """The ticks that aren't skipped, with frame_index: a skipped one takes no number."""
    kept = gated.where("skip IS NULL").drop("skip")
    return kept.withColumn("frame_index", (F.row_number().over(Window.partitionBy(*episode).orderBy(ts)) - 1).cast("long"))


def select_fields(rows: DataFrame, fields: Mapping[str, Sequence[str]], always: Sequence[str] = ()) -> DataFrame:
    """``observation.state.*`` and then ``action.*`` columns that a selection of ``read_fields`` names (state, then target), then ``always``."""
    names = [f"observation.state.{n}" for n in fields.get("state", ())] + [f"action.{n}" for n in fields.get("target", ())]
    names += [n for n in always if n not in names]
    absent = [n for n in names if n not in rows.columns]
    if absent:
        raise ValueError(f"selected columns are missing: {absent}")
    return rows.select(*(F.col(f"`{n}`") for n in names))


def flatten_record(rows: DataFrame, renames: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Paths in nested records ("imu.angular_velocity") as columns of dotted names; lists as 32-bit floats, structs of numbers as vectors."""
    from frameloom.functions.names import components

    out = []
    for path, name in renames.items():
        kind = rows.select(F.col(path).alias("v")).schema["v"].dataType
        c = F.col(path)
        if kind.typeName() == "struct":
            c = components(c, kind.fieldNames())
        elif kind.typeName() == "array" and kind.elementType.typeName() != "string":
            c = c.cast("array<float>")
        out.append(c.alias(name))
    return rows.select(*keep, *out)


def nest_record(rows: DataFrame, groups: Mapping[str, Mapping[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """The other way: flat columns under each other in a struct for each group (field: column)."""
    return rows.select(*keep, *(F.struct(*(F.col(f"`{c}`").alias(f) for f, c in fields.items())).alias(g) for g, fields in groups.items()))
