"""Text functions: tag lists and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_tags(tags: Column) -> Column:
    """tags joined by ', '; empty text for a missing or empty list."""
    return F.coalesce(F.array_join(tags, ", "), F.lit(""))


def safe_part(text: Column) -> Column:
    """runs of other characters than A-Z a-z 0-9 _ . - become '_', stripped at the ends; 'all' if nothing is left."""
    cleaned = F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9_.-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.when(cleaned != "", cleaned), F.lit("all"))


def mjd_part(mjd: Column) -> Column:
    """MJD with eight decimals and 'p' for the point, a minus sign first. Rounded on the integer side, so every engine agrees."""
    units = F.round(F.abs(mjd) * F.lit(100000000.0)).cast("long")
    whole = F.floor(units / F.lit(100000000)).cast("long")
    return F.concat(F.when(mjd < 0, "-").otherwise(""), whole.cast("string"), F.lit("p"), F.lpad((units - whole * 100000000).cast("string"), 8, "0"))


def chunk_key(label: Column, start: Column, end: Column, tag: Column) -> Column:
    """the key of a cached chunk."""
    return F.concat_ws("__", safe_part(label), mjd_part(start), mjd_part(end), safe_part(tag))


def pull_key(start: Column, end: Column, include_upper: Column, max_results: int, split_threshold: int) -> Column:
    """F5 with every setting that decides what a cached chunk of an adaptive pull stands for; label and tag are keys of their own."""
    return F.concat_ws("__", mjd_part(start), mjd_part(end), F.when(include_upper, "closed").otherwise("open"), F.lit(f"cap{max_results}"), F.lit(f"split{split_threshold}"))
