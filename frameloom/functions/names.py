"""Column functions for names, paths, maps and small values; all run in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from frameloom.functions.vectors import as_column


def split_pair(c: Column | str, sep: str = ":") -> Column:
    """struct<left, right> around the first separator; an error where a side is missing or blank."""
    c = as_column(c)
    at = F.instr(c, sep)
    left, right = F.trim(F.substr(c, F.lit(1), at - 1)), F.trim(F.substr(c, at + len(sep)))
    bad = F.raise_error(F.concat(F.lit(f"not two parts around '{sep}': "), c)).cast("struct<left:string,right:string>")
    return F.when(c.isNull(), F.lit(None).cast("struct<left:string,right:string>")).when((at > 0) & (left != "") & (right != ""), F.struct(left.alias("left"), right.alias("right"))).otherwise(bad)


def namespace(c: Column | str) -> Column:
    """With one slash before and none after; empty stays empty."""
    bare = F.regexp_replace(as_column(c), r"^[\s/]+|[\s/]+$", "")
    return F.when(bare == "", F.lit("")).otherwise(F.concat(F.lit("/"), bare))


def text_of(c: Column | str) -> Column:
    """UTF-8 bytes as text; an error where they aren't that."""
    return F.decode(as_column(c), "UTF-8")


def dataset_name(ts: Column | str, prefix: str = "dataset_") -> Column:
    """A name by the local time."""
    return F.concat(F.lit(prefix), F.date_format(as_column(ts), "yyyyMMdd_HHmmss"))


def last_part(c: Column | str, prefix: str = "") -> Column:
    """The name without ``prefix``; without that, what follows its last dot."""
    c = as_column(c)
    tail = F.substring_index(c, ".", -1)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(tail) if prefix else tail


def fill_template(template: str, **values: Column | str) -> Column:
    """A template like "data/chunk-{chunk:03d}/{name}.bin" with columns in its fields."""
    import string

    form, columns = "", []
    for text, field, spec, _ in string.Formatter().parse(template):
        form += text.replace("%", "%%")
        if field is not None:
            form += f"%{spec}" if spec else "%s"
            columns.append(as_column(values[field]))
    return F.format_string(form, *columns)


def latency_ms(sent: Column | str, received: Column | str) -> Column:
    """Milliseconds between two times in seconds or nanoseconds (see ``epoch_seconds``)."""
    from frameloom.functions.vectors import epoch_seconds

    return (epoch_seconds(received) - epoch_seconds(sent)) * 1000


def components(c: Column | str, names: Sequence[str] = ("x", "y", "z")) -> Column:
    """Fields of a struct as a vector of 32-bit floats."""
    c = as_column(c)
    return F.array(*(c[n].cast("float") for n in names))


def look_up(c: Column | str, *names: str, default: Column | None = None) -> Column:
    """The value of the first of ``names`` that a map has, else ``default`` (null without one)."""
    c = as_column(c)
    found = [F.try_element_at(c, F.lit(n)) for n in names]
    return F.coalesce(*found, *([default] if default is not None else []))


def tensor_shape(c: Column | str, depth: int = 3) -> Column:
    """Sizes of nested lists of ``depth`` levels; 0 below an empty one."""
    c, out = as_column(c), []
    for _ in range(depth):
        out.append(F.coalesce(F.size(c), F.lit(0)))
        c = F.get(c, F.lit(0))
    return F.array(*out)
