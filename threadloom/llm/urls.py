"""URL lists with dates, joined to captures as of their fetch time, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.sizing import dealt_anew


def url_parts(url: str = "url"):
    """Lower-case host without port, user and closing dot, and the address without scheme, query and fragment.

    A numeric address of the sixth version keeps its brackets.
    """
    named = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    host = F.lower(F.regexp_replace(named, r"\.$", ""))
    path = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return host, F.concat(host, F.regexp_replace(path, "/+$", ""))


def validity(entries: DataFrame) -> DataFrame:
    """Dated list entries as intervals ``[valid_from, valid_to)``; an open end is null.

    ``entries`` has list, effect (``block`` or ``allow``), kind (``host`` or
    ``url``), pattern, action (``add`` or ``remove``) and dated.  An add opens
    an interval that the next dated entry of the same list, effect, kind and
    pattern closes.  Entries of one day count once; a removal wins over an add
    of that day.  Entries with a null in any of these columns state nothing and
    are ignored.

    Entries are first reduced to one per pattern and day, so what one pattern
    brings into a window is bounded by the days of the history.
    """
    key = ["list", "effect", "kind", "pattern"]
    known = entries.select(*key, "action", F.col("dated").cast("date").alias("dated")).na.drop()
    daily = known.groupBy(*key, "dated").agg(F.max("action").alias("action"))
    later = Window.partitionBy(*key).orderBy("dated")
    return (
        daily.withColumn("valid_to", F.lead("dated").over(later))
        .where(F.col("action") == "add")
        .select(*key, F.col("dated").alias("valid_from"), "valid_to")
    )


def _active(keyed: DataFrame, intervals: DataFrame, kind: str) -> DataFrame:
    """Per (key, day): how many entries of each effect hold, and the lists that block.

    ``keyed`` has key, day and pattern, one row per pattern that can match.
    """
    held = intervals.where(F.col("kind") == kind).drop("kind")
    now = (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    active = (
        keyed.join(held, "pattern")
        .where(now)
        .groupBy("key", "day")
        .agg(
            F.count(F.when(F.col("effect") == "block", 1)).alias("blocks"),
            F.count(F.when(F.col("effect") == "allow", 1)).alias("allows"),
            F.collect_set(F.when(F.col("effect") == "block", F.col("list"))).alias("lists"),
        )
    )
    return active.withColumn("key", dealt_anew(active, "key"))


def filter_urls(
    captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on", most_labels: int | None = None
) -> DataFrame:
    """Captures with the verdict of the lists as they stood on the day of the fetch.

    Adds host, blocks, allows, lists (sorted names of the blocking lists, comma-joined) and blocked.
    A host entry covers the host and everything below it, an url entry one
    address.  A capture is blocked if a blocking entry holds and no allowing
    one.  Entries for hosts are looked up for every run of last labels of a host,
    whatever their number.  With ``most_labels`` only the whole host and its
    last one to ``most_labels`` labels are looked up.

    The as-of join runs over distinct (host, day) and (address, day), not over
    captures: a host with a third of all captures is one row per day there.
    The small results return to the captures by outer joins whose skewed
    capture side adaptive execution splits.  A null or unparsable url and a
    null fetch time match nothing.  Repeated captures are kept.  Columns named
    like the added ones are replaced.
    """
    added = ["host", "blocks", "allows", "lists", "blocked"]
    kept = [c for c in captures.columns if c not in added]
    host, address = url_parts(url)
    seen = captures.select(
        *kept, host.alias("_host"), address.alias("_address"), F.col(fetched).cast("date").alias("_day")
    )
    intervals = validity(entries)
    hosts = seen.select(F.col("_host").alias("key"), F.col("_day").alias("day")).distinct().na.drop()
    labels = F.split("key", r"\.")
    depth = F.size(labels) if most_labels is None else F.least(F.size(labels), F.lit(most_labels))
    below = F.transform(
        F.sequence(F.lit(1), depth),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )
    patterns = F.array_distinct(F.concat(below, F.array("key")))
    by_host = _active(hosts.withColumn("pattern", F.explode(patterns)), intervals, "host")
    pages = seen.select(F.col("_address").alias("key"), F.col("_day").alias("day")).distinct().na.drop()
    by_page = _active(pages.withColumn("pattern", F.col("key")), intervals, "url")
    for frame, key, prefix in ((by_host, "_host", "_h"), (by_page, "_address", "_p")):
        named = frame.toDF(*[prefix + c for c in frame.columns])
        seen = seen.join(named, (F.col(key) == F.col(f"{prefix}key")) & (F.col("_day") == F.col(f"{prefix}day")), "left")
    both = lambda c: F.coalesce(F.col(f"_h{c}"), F.lit(0)) + F.coalesce(F.col(f"_p{c}"), F.lit(0))
    none = F.array().cast("array<string>")
    lists = F.array_union(F.coalesce("_hlists", none), F.coalesce("_plists", none))
    return seen.select(
        *kept,
        F.nullif(F.col("_host"), F.lit("")).alias("host"),
        both("blocks").cast("long").alias("blocks"),
        both("allows").cast("long").alias("allows"),
        F.array_join(F.array_sort(lists), ",").alias("lists"),
        ((both("blocks") > 0) & (both("allows") == 0)).alias("blocked"),
    )
