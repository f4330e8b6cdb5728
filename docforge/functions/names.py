"""Column helpers for file names and sizes (no UDFs).

``split_ext`` follows ``os.path.splitext`` on a base name: the extension starts
at the last dot, but leading dots never start one (``.bashrc`` has none).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXT = r"(?s)^\.*[^.].*(\.[^.]*)$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def parent_dir(path: Column) -> Column:
    """Directory part of a '/'-separated path ('' when there is none)."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*\z", 1)


def split_ext(name: Column) -> Column:
    """Extension of a base name, as ``os.path.splitext(name)[1]``."""
    return F.regexp_extract(name, _EXT, 1)


def stem(name: Column) -> Column:
    """Base name without extension, as ``os.path.splitext(name)[0]``."""
    return F.substring(name, F.lit(1), F.length(name) - F.length(split_ext(name)))


def format_size(size: Column) -> Column:
    """bytes / KB / MB / GB with two decimals in 1024 steps.

    ``format_number`` rounds half-even on the binary value, like Python's
    ``f"{x:.2f}"``; it adds grouping commas, which are removed.
    """
    def two(x):
        return F.regexp_replace(F.format_number(x, 2), ",", "")
    kb, mb, gb = 1024, 1024 ** 2, 1024 ** 3
    return (F.when(size < kb, F.concat(size.cast("string"), F.lit(" bytes")))
            .when(size < mb, F.concat(two(size / kb), F.lit(" KB")))
            .when(size < gb, F.concat(two(size / mb), F.lit(" MB")))
            .otherwise(F.concat(two(size / gb), F.lit(" GB"))))


def shorten_path(path: Column, max_length: int | None) -> Column:
    """Middle ellipsis: ``p[:half] + '...' + p[-half:]`` with
    ``half = (max_length - 3) // 2`` when the path is longer than the limit.
    Python slice rules are kept, so half = 0 keeps the whole tail."""
    if not max_length:
        return path
    half = (max_length - 3) // 2
    n = F.length(path)
    if half > 0:
        head = F.substring(path, 1, half)
        tail = F.substring(path, F.greatest(n - half + 1, F.lit(1)), half)
    elif half == 0:
        head = F.lit("")
        tail = path
    else:  # negative: p[:-k] and p[k:]
        k = -half
        head = F.substring(path, F.lit(1), F.greatest(n - k, F.lit(0)))
        tail = F.substring(path, k + 1, 2147483647)
    return F.when(n > max_length, F.concat(head, F.lit("..."), tail)).otherwise(path)


def relative_link(target: Column, link_path: Column) -> Column:
    """``os.path.relpath(target, dirname(link_path))`` for absolute,
    normalised '/'-paths: up-steps for the link directory's components after
    the common prefix, then the target's remaining components."""
    t = F.split(F.regexp_replace(target, "^/+", ""), "/")
    d_raw = F.regexp_replace(parent_dir(link_path), "^/+", "")
    d = F.when(d_raw == "", F.array().cast("array<string>")).otherwise(F.split(d_raw, "/"))
    n = F.least(F.size(t), F.size(d))
    idx = F.sequence(F.lit(0), n - 1)
    mism = F.filter(F.when(n > 0, idx).otherwise(F.array().cast("array<int>")),
                    lambda i: F.element_at(t, i + 1) != F.element_at(d, i + 1))
    common = F.when(F.size(mism) > 0, F.element_at(mism, 1)).otherwise(n)
    ups = F.array_repeat(F.lit(".."), F.size(d) - common)
    rest = F.slice(t, common + 1, F.greatest(F.size(t) - common, F.lit(0)))
    parts = F.concat(ups, rest)
    return F.when(F.size(parts) == 0, F.lit(".")).otherwise(F.array_join(parts, "/"))


def file_id(path: Column, mtime_us: Column, size: Column) -> Column:
    """Stable id of a file version: md5 of path, modification time (epoch
    microseconds) and size."""
    return F.md5(F.concat_ws("_", path, mtime_us.cast("string"), size.cast("string")))
