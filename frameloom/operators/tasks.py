"""Dictionary codes of task texts, name matching and the suffix pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.vectors import not_blank, strip


def task_dictionary(rows: DataFrame, task: str, order: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """(task, task_index): known codes, then unseen tasks from the greatest code + 1 in order of first appearance."""
    first = rows.where(F.col(task).isNotNull()).groupBy(F.col(task).alias("task")).agg(F.min(F.struct(*order)).alias("_first"))
    base = 0
    if known is not None:
        last = known.agg(F.max("task_index").alias("m")).first()["m"]
        base = 0 if last is None else last + 1
        first = first.join(known.select("task"), "task", "left_anti")
    new = first.select("task", (F.row_number().over(Window.orderBy("_first")) - 1 + base).cast("long").alias("task_index"))  # a row for each task
    return new if known is None else known.select("task", F.col("task_index").cast("long").alias("task_index")).unionByName(new)


def encode_tasks(rows: DataFrame, task: str, dictionary: DataFrame) -> DataFrame:
    return rows.join(dictionary.withColumnRenamed("task", "_entry"), F.col(task) == F.col("_entry"), "left").drop("_entry")


def decode_tasks(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``rows`` with the task of their task_index; an error for a code without one."""
    joined = rows.join(dictionary.select("task_index", F.col("task").alias("_task")), "task_index", "left")
    missing = F.raise_error(F.concat(F.lit("no task of index "), F.col("task_index").cast("string"))).cast("string")
    return joined.withColumn("task", F.coalesce("_task", missing)).drop("_task")


def tasks_of_episodes(rows: DataFrame, episode: str, task: str) -> DataFrame:
    """(episode, tasks): the distinct tasks of each, sorted."""
    return rows.groupBy(episode).agg(F.sort_array(F.collect_set(task)).alias("tasks"))


def suffix_pivot(rows: DataFrame, name: str, values: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """One row for each base name with ``<kind>_<value>`` columns; ``kinds`` maps suffixes to kinds, other names are left out."""
    kind, base = F.lit(None).cast("string"), F.lit(None).cast("string")
    for suffix, k in kinds.items():
        ends = F.col(name).endswith(suffix)
        kind = F.when(ends, F.lit(k)).otherwise(kind)
        base = F.when(ends, F.col(name).substr(F.lit(1), F.length(name) - len(suffix))).otherwise(base)
    long = rows.withColumns({"base": base, "_kind": kind}).where("_kind IS NOT NULL")
    return long.groupBy("base").agg(*(F.max(F.when(F.col("_kind") == k, F.col(v))).alias(f"{k}_{v}") for k in kinds.values() for v in values))


def unmatched_names(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """(name, side): names that only one of both tables has."""
    left = a.select(name).distinct().join(b.select(name).distinct(), name, "left_anti").withColumn("side", F.lit("left"))
    right = b.select(name).distinct().join(a.select(name).distinct(), name, "left_anti").withColumn("side", F.lit("right"))
    return left.unionByName(right)


def duplicates(rows: DataFrame, name: str) -> DataFrame:
    """(name, n) of names that come more than once, sorted."""
    return rows.groupBy(name).agg(F.count("*").alias("n")).where("n > 1").orderBy(name)


def schema_difference(have: Sequence[str], want: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) names, sorted."""
    return sorted(set(want) - set(have)), sorted(set(have) - set(want))


def task_text(rows: DataFrame, task: str) -> tuple[Column, Column]:
    """(text, code) of a column of task values: whole numbers are codes; texts are stripped and bytes decoded first; a blank one is an error."""
    kind = rows.select(F.col(f"`{task}`").alias("t")).dtypes[0][1]
    c = F.col(f"`{task}`")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        missing = F.raise_error(F.lit("a task must be a text that isn't blank, or a whole number")).cast("long")
        return F.lit(None).cast("string"), F.coalesce(c.cast("long"), missing)
    text = strip(F.decode(c, "UTF-8") if kind == "binary" else c.cast("string"))
    blank = F.raise_error(F.lit("a task must be a text that isn't blank, or a whole number")).cast("string")
    return F.when(not_blank(text), text).otherwise(blank), F.lit(None).cast("long")


def task_codes(rows: DataFrame, task: str, order: Sequence[str], known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with task_index by the rules of ``task_text``, the dictionary with the tasks that were new, by code)."""
    text, code = task_text(rows, task)
    named = rows.drop("task_index").withColumns({"_text": text, "_code": code})
    made = task_dictionary(named, "_text", order, known)
    coded = encode_tasks(named, "_text", made)
    return coded.withColumn("task_index", F.coalesce("_code", "task_index")).drop("_text", "_code"), made.orderBy("task_index")


def joint_state(rows: DataFrame, key: str, order: str, name: str, values: Sequence[str], kinds: Mapping[str, str], effort: str) -> DataFrame:
    """(key, names, ``<kind>_<value>`` lists in the order of the first kind, rest_names, rest_``effort``): the whole suffix pivot by key.

    ``kinds`` maps suffixes to kinds. Other names are the rest, of which only ``effort`` counts. Repeated and empty base names
    are errors, as are names that one kind has and another hasn't.
    """
    kind, base = F.lit(None).cast("string"), F.col(name)
    for suffix, k in kinds.items():
        ends = F.col(name).endswith(suffix)
        kind = F.when(ends, F.lit(k)).otherwise(kind)
        base = F.when(ends, F.col(name).substr(F.lit(1), F.length(name) - len(suffix))).otherwise(base)
    long = rows.withColumns({"_base": base, "_kind": kind})
    main, *others = kinds.values()
    per = long.where("_kind IS NOT NULL").groupBy(key, "_base").agg(
        *(F.count_if(F.col("_kind") == k).alias(f"_n_{k}") for k in kinds.values()), F.min(F.when(F.col("_kind") == main, F.col(order))).alias("_at"),
        *(F.max(F.when(F.col("_kind") == k, F.col(v))).alias(f"{k}_{v}") for k in kinds.values() for v in values),
    )
    wrong = F.raise_error(F.concat(F.lit("names don't match or repeat: "), F.coalesce("_base", F.lit("null")))).cast("string")
    sound = (F.length("_base") > 0) & F.forall(F.array(*(F.col(f"_n_{k}") for k in kinds.values())), lambda n: n == 1)
    columns = [f"{k}_{v}" for k in kinds.values() for v in values]
    joints = per.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_at", F.when(sound, F.col("_base")).otherwise(wrong).alias("_base"), *columns))).alias("j"))
    rest = long.where("_kind IS NULL").groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(name).alias("n"), F.col(effort).alias("e")))).alias("r"))
    both = joints.join(rest, key, "left")
    none = F.array().cast("array<string>"), F.array().cast("array<double>")
    return both.select(key, F.col("j._base").alias("names"), *(F.col(f"j.{c}").alias(c) for c in columns), F.coalesce(F.col("r.n"), none[0]).alias("rest_names"), F.coalesce(F.col("r.e").cast("array<double>"), none[1]).alias(f"rest_{effort}"))


def parallel_lists(columns: Sequence[str]) -> Column:
    """The lists zipped; an error where they differ in length."""
    same = F.lit(True)
    for c in columns[1:]:
        same = same & (F.size(c) == F.size(columns[0]))
    return F.when(same, F.arrays_zip(*columns)).otherwise(F.raise_error(F.lit(f"lists differ in length: {list(columns)}")))


def missing_of(required: Sequence[str], present: Column | str) -> Column:
    """Sorted names that are required and not present."""
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), present))


def distinct_names(names: Sequence[str]) -> list[str]:
    """Stripped names; an error if there is none, or a blank or repeated one."""
    found = [n.strip() for n in names]
    twice = sorted({n for n in found if found.count(n) > 1})
    if not found or not all(found) or twice:
        raise ValueError(f"names must be given, not be blank and not repeat: {twice or found}")
    return found
