"""Ordered computations per key that never put a whole key into one task.

One station may hold a large part of all rows, so no window here is partitioned by the
station alone. Rows are cut into time chunks per key; each chunk gets, from the chunks
before it, exactly what its own rows need:

* `carry_forward`: the last value of each column before the chunk (one row per chunk);
* `with_history`: the last `rows` rows before the chunk, however many chunks they span;
* `over_recent`: the rows of the last `hours` before the chunk, however many they are;
* `with_position`: the number of rows in all earlier sort partitions.

Windows over keys alone run on the per-chunk summaries, one row per key and chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from chargelake.functions.scalar import floor_time
from chargelake.session import ensure_checkpoint_dir

CHUNK = "_chunk"
HISTORY = "_history"


def time_chunk(ts: str, unit: str) -> Column:
    """Chunk of a timestamp; rows without one share the last chunk."""
    last = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    return F.coalesce(floor_time(ts, unit), last)


def oldest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in columns]


def carry_forward(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str],
                  chunk: str = "month") -> DataFrame:
    """Replace nulls by the last earlier value of the same key. `ts` is unique per key."""
    slot = [*keys, CHUNK]
    chunked = df.withColumn(CHUNK, time_chunk(ts, chunk))
    last_in_chunk = chunked.groupBy(*slot).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in columns]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = last_in_chunk.select(
        *slot, *[F.last(c, ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in columns]
    )
    so_far = (
        Window.partitionBy(*slot).orderBy(*oldest_first([ts]))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_before_{c}"))
        for c in columns
    }
    return (
        chunked.join(carried, slot, "left")
        .withColumns(filled)
        .select(*df.columns)
    )


def with_history(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int,
                 columns: Sequence[str], chunk: str = "year") -> DataFrame:
    """Add to every chunk the `rows` rows that precede it within its key.

    A chunk is worked on by one task, so `chunk` should bound its rows: the hourly rows of
    a station are at most 8,784 a year. A table that has its chunks in CHUNK already, as a
    bucketed stage, keeps them: its rows are not shuffled, only the copies are. Chunks much larger than `rows` keep the copies few.
    `order` starts with a timestamp and must be unique per key. The copies carry the keys,
    the order columns and `columns` only and are marked in HISTORY.
    """
    slot = [*keys, CHUNK]
    stored_by_chunk = CHUNK in df.columns
    chunked = df if stored_by_chunk else df.withColumn(CHUNK, time_chunk(order[0], chunk))
    slim = chunked.select(*dict.fromkeys([*slot, *order, *columns]))

    # the last rows of every chunk, with their distance from its end; the row_number
    # limit is applied before the shuffle as well as after it
    from_end = F.row_number().over(Window.partitionBy(*slot).orderBy(*newest_first(order)))
    tail = slim.withColumn("_from_end", from_end).filter(F.col("_from_end") <= rows)

    # per chunk: the later chunks of the key with the number of rows in between
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    sizes = slim.groupBy(*slot).agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn(
        "_end", F.sum("_size").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    )
    start = F.struct(F.col(CHUNK).alias("chunk"), (F.col("_end") - F.col("_size")).alias("start"))
    later = F.collect_list(start).over(by_key.rowsBetween(1, rows))
    near = F.filter(later, lambda x: x["start"] - F.col("_end") < rows)
    later = sizes.select(*slot, "_end", near.alias("_later")).filter(F.size("_later") > 0)

    reached = F.filter(
        "_later", lambda x: x["start"] - F.col("_end") + F.col("_from_end") <= rows
    )
    history = (
        tail.join(later, slot)
        .withColumn(CHUNK, F.explode(F.transform(reached, lambda x: x["chunk"])))
        .drop("_later", "_end", "_from_end")
        .withColumn(HISTORY, F.lit(True))
    )
    if stored_by_chunk:
        return _beside_first(chunked, history.drop(HISTORY), slot, order)
    return chunked.withColumn(HISTORY, F.lit(False)).unionByName(
        history, allowMissingColumns=True
    )


def _beside_first(chunked: DataFrame, history: DataFrame, slot: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """`chunked` and `history` in one, without moving the rows of `chunked`.

    A union would lose how a bucketed table is dealt out. Instead the copies of a chunk, a
    few rows, are joined to it as one list, and its first row turns into itself and them.
    """
    carried = [c for c in history.columns if c not in slot]
    lists = history.groupBy(*slot).agg(F.collect_list(F.struct(*carried)).alias("_copies"))
    first = F.row_number().over(Window.partitionBy(*slot).orderBy(*oldest_first(order))) == 1
    itself = F.array(F.lit(None).cast(history.select(F.struct(*carried).alias("s")).schema["s"].dataType))
    both = (
        chunked.join(lists, slot, "left")
        .withColumn("_first", first)
        .withColumn("_copy", F.explode(F.when(
            F.col("_first") & F.col("_copies").isNotNull(), F.concat(itself, F.col("_copies")))
            .otherwise(itself)))
    )
    own = F.col("_copy").isNull()
    values = {c: F.when(own, F.col(f"`{c}`")).otherwise(F.col(f"_copy.`{c}`")) if c in carried
              else F.when(own, F.col(f"`{c}`")) for c in chunked.columns if c not in slot}
    return both.select(
        *slot, *[v.alias(c) for c, v in values.items()], (~own).alias(HISTORY)
    ).select(*[F.col(f"`{c}`") for c in chunked.columns], HISTORY)


def over_history(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int,
                 columns: Sequence[str], build: Callable[[WindowSpec], dict[str, Column]],
                 chunk: str = "year") -> DataFrame:
    """Add the window columns `build` makes; they may look back at most `rows` rows.

    A row whose key has a null gets null, as a null belongs to no group.
    """
    window = Window.partitionBy(*keys, CHUNK).orderBy(*oldest_first(order))
    added = build(window)
    if keys:
        known = F.lit(True)
        for key in keys:
            known = known & F.col(key).isNotNull()
        added = {name: F.when(known, column) for name, column in added.items()}
    return (
        with_history(df, keys, order, rows, columns, chunk)
        .withColumns(added)
        .filter(~F.col(HISTORY))
        .drop(HISTORY, *([] if CHUNK in df.columns else [CHUNK]))
    )


def instant(ts: str) -> Column:
    """Microseconds of a timestamp on its own clock, whatever the session zone."""
    at = F.col(ts).cast("timestamp_ntz")
    seconds = (F.datediff(at, F.lit("1970-01-01")).cast("bigint") * 86_400
               + F.hour(at) * 3_600 + F.minute(at) * 60)
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def over_recent(df: DataFrame, keys: Sequence[str], ts: str, hours: int, columns: Sequence[str],
                build: Callable[[WindowSpec], dict[str, Column]],
                chunk: str = "year") -> DataFrame:
    """Add the window columns `build` makes; their ranges may look back less than `hours`.

    The window is ordered by instant(), for rangeBetween on microseconds. A row is copied
    to each later chunk that begins less than `hours` after it. Rows without a time, or
    whose key has a null, get null.
    """
    at = F.col(ts).cast("timestamp_ntz")
    reach = at + F.make_dt_interval(F.lit(0), F.lit(hours)) - F.expr("INTERVAL '0.000001' SECOND")
    chunks = F.sequence(floor_time(ts, chunk), floor_time(reach, chunk),
                        F.expr(f"INTERVAL '1' {chunk.upper()}"))
    own = df.withColumns({CHUNK: time_chunk(ts, chunk), HISTORY: F.lit(False)})
    history = (
        df.filter(F.col(ts).isNotNull()).select(*dict.fromkeys([*keys, ts, *columns]))
        .withColumn(CHUNK, F.explode(F.slice(chunks, F.lit(2), F.size(chunks))))
        .withColumn(HISTORY, F.lit(True))
    )
    known = F.col(ts).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    window = Window.partitionBy(*keys, CHUNK).orderBy(instant(ts))
    return (
        own.unionByName(history, allowMissingColumns=True)
        .withColumns({name: F.when(known, column) for name, column in build(window).items()})
        .filter(~F.col(HISTORY))
        .drop(CHUNK, HISTORY)
    )


def running_total(df: DataFrame, keys: Sequence[str], chunk: str, order: str,
                  amounts: dict[str, str], source: DataFrame | None = None) -> DataFrame:
    """Inclusive running sums per key, in the order of (chunk, order).

    `chunk` names a column that grows with `order`; `amounts` maps new to summed columns.
    `source` is a table with the same sums per chunk that is cheaper to read than `df`.
    """
    slot = [*keys, chunk]
    sums = (df if source is None else source).groupBy(*slot).agg(
        *[F.sum(c).alias(n) for n, c in amounts.items()])
    earlier = (
        Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sums.select(
        *slot,
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in amounts],
    )
    inside = (
        Window.partitionBy(*slot).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = {
        n: F.col(f"_before_{n}") + F.sum(c).over(inside) for n, c in amounts.items()
    }
    return (
        df.join(offsets, slot).withColumns(totals)
        .drop(*[f"_before_{n}" for n in amounts])
    )


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Zero-based place of every row in the global order, which must be total.

    The range-sorted rows are checkpointed once, so row ids stay the same for the count
    per partition and for the rows, also when an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = (
        df.orderBy(*oldest_first(order))
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_id", 33))
    )
    # one row per sort partition
    parts = numbered.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return (
        numbered.join(F.broadcast(parts), "_part")
        .withColumn(name, F.col("_before") + F.col("_id") - F.col("_first"))
        .select(*df.columns, name)
    )
