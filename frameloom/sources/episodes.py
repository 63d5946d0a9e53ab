"""Episode files and the documents beside them."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    """All rows of ``root``/data with their place in their file as ``row_index``."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data").select("*", F.col("_metadata.row_index").alias("row_index"))


def read_listed(spark: SparkSession, root: str, episodes: DataFrame) -> DataFrame:
    """Rows of the files that episode records name in ``data_path`` (by default data/train-NNNNNN.parquet), with ``row_index``.

    Records without tasks or index are left out. A path that leads out of ``root`` or to no file is an error, as is a
    file of another episode than its record's.
    """
    default = F.format_string("data/train-%06d.parquet", "episode_index")
    path = F.coalesce(F.col("data_path"), default) if "data_path" in episodes.columns else default
    listed = episodes.where("episode_index IS NOT NULL").select("episode_index", path.alias("path")).orderBy("episode_index").collect()  # one for each file
    if not listed:
        raise ValueError("the dataset has no episodes")
    whole = {r["episode_index"]: inside(root, r["path"]) for r in listed}
    absent = [p for p in whole.values() if not Path(p).exists()]
    if absent:
        raise FileNotFoundError(f"no such episode files: {absent[:10]}")
    return spark.read.parquet(*whole.values()).select("*", F.col("_metadata.row_index").alias("row_index"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A line a row; blank lines go."""
    return spark.read.schema(schema).json(path)


def read_json(path: str) -> dict:
    """One small document; an error where there is none."""
    if not Path(path).is_file():
        raise FileNotFoundError(path)
    return json.loads(Path(path).read_text(encoding="utf-8"))


def read_fields(path: str, known: dict[str, list[str]]) -> dict[str, list[str]]:
    """Column selection of a YAML file with exactly the keys of ``known``; unknown, repeated or missing names are errors."""
    import yaml

    given = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(given, dict) or set(given) != set(known):
        raise ValueError(f"the top level must have {sorted(known)}")
    for key, names in given.items():
        if not isinstance(names, list) or not names or not all(isinstance(n, str) and n for n in names):
            raise ValueError(f"{key} must be a list of names that isn't empty")
        if len(set(names)) < len(names):
            raise ValueError(f"{key} names columns twice: {sorted({n for n in names if names.count(n) > 1})}")
        if unknown := sorted(set(names) - set(known[key])):
            raise ValueError(f"{key} has unknown columns {unknown}")
    return given


def inside(root: str, path: str) -> str:
    """``path`` under ``root``; an error if it leads out of it."""
    whole = Path(root, path).resolve()
    if not whole.is_relative_to(Path(root).resolve()):
        raise ValueError(f"{path} leads out of {root}")
    return str(whole)


def safe_name(name: str) -> str:
    """``name`` if it can be that of a folder or camera."""
    if not re.fullmatch(r"[A-Za-z0-9_][A-Za-z0-9_.-]*", name) or ".." in name:
        raise ValueError(f"unsafe name {name!r}")
    return name
