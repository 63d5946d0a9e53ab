"""Column functions for vectors of fixed width and for the text around them; all run in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DOF = 29
#: Fields of the state vector and their widths, in their order (1,110 values).
STATE_FIELDS = {
    "relative_ori_6d": 90,
    "motion_anchor_lin_vel_b": 45,
    "motion_anchor_ang_vel_b": 45,
    "ang_vel_history": 30,
    "gravity_history": 30,
    "joint_pos_rel_history": 290,
    "joint_vel_history": 290,
    "action_history": 290,
}
_SPACE = r"[\s\u0085   -     　\x1c-\x1f]+"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def checked(v: Column | str, width: int, name: str = "vector") -> Column:
    """``v`` as 32-bit floats; an error where it hasn't ``width`` values. Null stays null."""
    v = as_column(v)
    bad = F.raise_error(F.concat(F.lit(f"{name} must have {width} values, not "), F.size(v).cast("string")))
    return F.when(v.isNull() | (F.size(v) == width), v.cast("array<float>")).otherwise(bad.cast("array<float>"))


def concat_vectors(fields: Sequence[tuple[Column | str, int]]) -> Column:
    """Checked vectors one after another."""
    return F.concat(*(checked(c, n, c if isinstance(c, str) else "vector") for c, n in fields))


def history_window(v: Column | str, width: int = DOF, index: int = -1) -> Column:
    """The ``index``-th of the windows of ``width`` values in ``v`` (negative: from the end); ``v`` itself if it is one window."""
    v = as_column(v)
    n = F.size(v)
    count = (n / width).cast("int")
    at = F.lit(index) if index >= 0 else count + index
    fail = F.raise_error(F.concat(F.lit(f"no window {index} of {width} in a vector of "), n.cast("string"))).cast("array<float>")
    inside = (n % width == 0) & (at >= 0) & (at < count)
    return F.when(v.isNull() | (n == width), v.cast("array<float>")).when(inside, F.slice(v, F.greatest(at, F.lit(0)) * width + 1, width).cast("array<float>")).otherwise(fail)


def or_zeros(v: Column | str, width: int) -> Column:
    """``v``, or a vector of zeros where it is null."""
    return F.coalesce(as_column(v).cast("array<float>"), F.array_repeat(F.lit(0.0).cast("float"), width))


def l2_distance(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance; an error if the lengths differ."""
    a, b = as_column(a), as_column(b)
    square = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: (x - y) * (x - y))
    whole = F.sqrt(F.aggregate(square, F.lit(0.0), lambda s, x: s + x))
    return F.when(F.size(a) == F.size(b), whole).otherwise(F.raise_error(F.lit("vectors differ in length")).cast("double"))


def _whole_digits(x: Column) -> Column:
    """All digits of a double that is positive, whole and at least 2**53."""
    unit = F.lit(Decimal(10**20))
    quarter = F.floor(x / 2.0**65).cast("decimal(19,0)") * F.lit(Decimal(2**63)) + (x / 4 % 2.0**63).cast("long").cast("decimal(19,0)")  # x itself may have 39 digits
    low = quarter % unit * 4
    high = F.call_function("div", quarter, unit) * 4 + F.call_function("div", low, unit)
    return F.ltrim(F.concat(high.cast("string"), F.lpad((low % unit).cast("string"), 20, "0")), F.lit("0"))


def six_decimals(c: Column | str) -> Column:
    """A 32-bit float as text with six decimals, as C's ``%.6f``: a value that lies halfway (an odd number of 128ths) goes to the even digit.

    Java's ``%.6f`` takes it up instead. Null stays null.
    """
    x = as_column(c).cast("double")
    small = F.when(F.abs(x) < 2.0**53, F.call_function("format_number", x, F.lit("0.000000")))
    sign = F.when(x < 0, "-").otherwise("")
    odd = small.when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf")))
    return odd.otherwise(F.concat(sign, _whole_digits(F.abs(x)), F.lit(".000000")))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.regexp_replace(as_column(c), f"^{_SPACE}", ""), f"{_SPACE}$", "")


def not_blank(c: Column | str) -> Column:
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def base_name(c: Column | str, suffixes: Sequence[str]) -> Column:
    """The name without the first of ``suffixes`` that it ends with."""
    c = as_column(c)
    out = c
    for s in reversed(suffixes):
        out = F.when(c.endswith(s), c.substr(F.lit(1), F.length(c) - len(s))).otherwise(out)
    return out


def split_list(c: Column | str, sep: str = ",") -> Column:
    """Parts between separators, stripped; empty ones go."""
    return F.filter(F.transform(F.split(as_column(c), sep), strip), lambda x: F.length(x) > 0)


def epoch_seconds(c: Column | str) -> Column:
    """Seconds; a value above 1e12 is taken for nanoseconds."""
    c = as_column(c).cast("double")
    return F.when(c > 1e12, c / 1e9).otherwise(c)


def episode_path(index: Column | str, chunk: int = 0) -> Column:
    """Path of an episode's file; in folders of ``chunk`` episodes, if that is given."""
    index = as_column(index)
    if not chunk:
        return F.format_string("data/train-%06d.parquet", index)
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(index / chunk), index)


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """``b - a`` of two timestamps (with or without time zone) in seconds."""
    gap = as_column(b) - as_column(a)
    return gap.cast("interval second").cast("decimal(20,6)").cast("double")
