"""URL filter lists that change over time, joined to captures as of their fetch.

Dated entries (a pattern is listed with an action, or taken off) become validity intervals
per list and pattern. A capture asks for every pattern that could cover its URL: its host,
the domains above it and its path's directories. Intervals are cut at slice borders (days),
so the as-of join is an equality on pattern and slice with the fetch time in the interval:
a host with very many captures spreads over its slices, its join side can be split, and an
entry valid for long is met by the captures of one day at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

REMOVED = "remove"
SLICE_SECONDS = 86_400


def host(url: Column) -> Column:
    """Host in lower case, without user and port; empty if there is none."""
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)


def patterns(url: Column) -> Column:
    """Host, the domains above it down to two labels, and host with each path directory.

    Without duplicates; empty for null, empty and host-less URLs.
    """
    name = host(url)
    labels = F.split(name, r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, count), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    depth = F.size(parts)
    directories = F.transform(
        F.filter(F.sequence(F.lit(0), depth), lambda i: i > 0),
        lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))
    return F.when(F.coalesce(name, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, directories)))


def validity(entries: DataFrame) -> DataFrame:
    """list, pattern, action, valid_from, valid_to from entries (list, pattern, action, dated).

    An entry holds until the next of the same list and pattern, the last one for good
    (valid_to null); a `remove` entry only ends the one before. Entries without pattern,
    list, action or date are passed over. Of entries with the same date, the greatest
    action counts.
    """
    known = entries.filter("list is not null and pattern is not null and action is not null "
                           "and dated is not null")
    known = known.groupBy("list", "pattern", "dated").agg(F.max("action").alias("action"))
    next_one = F.lead("dated").over(Window.partitionBy("list", "pattern").orderBy("dated"))
    return (known.withColumn("valid_to", next_one).filter(F.col("action") != REMOVED)
            .select("list", "pattern", "action", F.col("dated").alias("valid_from"), "valid_to"))


def as_of(captures: DataFrame, entries: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every capture (capture_id, url, fetched) judged by the entries active at its fetch.

    Columns: capture_id, url, fetched, host, n_active (active entries that cover the URL),
    verdict ("allow", "block", ... of the deciding entry, else "unlisted"), list, pattern,
    valid_from and valid_to of that entry. The longest pattern decides; among equals the
    latest valid_from, then the smaller action and list. Intervals are closed at their
    begin and open at their end. Captures without a URL, host or date are unlisted. Rows
    with the same capture_id, url and date are judged alike and returned each.
    """
    def at(moment: Column) -> Column:
        return F.floor(F.unix_timestamp(moment.cast("timestamp")) / slice_seconds)

    key = F.xxhash64("capture_id", "url", "fetched")
    asked = captures.select("capture_id", "url", "fetched", key.alias("key"))
    # captures that are alike are judged once
    distinct = asked.filter("fetched is not null").groupBy("capture_id", "url", "fetched", "key").agg(
        F.lit(1).alias("one"))
    wanted = distinct.select(
        "key", "fetched", at(F.col("fetched")).alias("slice"),
        F.explode(patterns(F.col("url"))).alias("pattern"))
    spans = validity(entries)
    horizon = captures.agg(F.max("fetched")).first()[0]  # one value
    if horizon is None:
        spans = spans.limit(0)
    end = F.coalesce(F.col("valid_to"), F.lit(horizon).cast(entries.schema["dated"].dataType))
    sliced = spans.withColumn("slice", F.explode(F.sequence(
        at(F.col("valid_from")), F.greatest(at(end), at(F.col("valid_from"))))))
    active = wanted.join(sliced, ["pattern", "slice"]).filter(
        (F.col("fetched") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))))
    best = F.min(F.struct(
        (-F.length("pattern")).alias("shorter"),
        (-F.unix_micros(F.col("valid_from").cast("timestamp"))).alias("older"),
        "action", "list", "pattern", "valid_from", "valid_to")).alias("best")
    judged = active.groupBy("key").agg(F.count(F.lit(1)).alias("n_active"), best)
    return asked.join(judged, "key", "left").select(
        "capture_id", "url", "fetched", F.coalesce(host(F.col("url")), F.lit("")).alias("host"),
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.coalesce("best.action", F.lit("unlisted")).alias("verdict"),
        "best.list", "best.pattern", "best.valid_from", "best.valid_to")
