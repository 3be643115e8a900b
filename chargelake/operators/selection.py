"""Rows at given places of the order (station, time), found without sorting the table.

Stations are counted; the place wanted is looked for in the counts by the bytes of the
stations' names, two bytes a step, and then among the times of the one station found. The
table is read for the counts and for that station, never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from chargelake.operators.quantiles import day_slot, values_at_ranks
from chargelake.session import stored

#: hexadecimal digits of a station's name that one step tells apart: two bytes
_STEP = 4


@dataclass(frozen=True)
class Cut:
    """The row at a place: the rows before it are those with a smaller key.

    A missing station or time comes last. `beyond`: the place is after all rows.
    """

    station: str | None = None
    ts: object | None = None
    beyond: bool = False

    def after(self, station: str, ts: str) -> Column:
        """Whether a row comes before the cut."""
        if self.beyond:
            return F.lit(True)
        time = F.col(ts)
        earlier = time.isNotNull() if self.ts is None else F.coalesce(
            time < F.lit(self.ts).cast("timestamp_ntz"), F.lit(False))
        if self.station is None:
            return F.col(station).isNotNull() | earlier
        return F.coalesce((F.col(station) < self.station) | (
            (F.col(station) == self.station) & earlier), F.lit(False))


def _station_at(counts: DataFrame, rank: int) -> tuple[str | None, int, int]:
    """The station with the row of that rank, the rank inside it, and its rows with a time."""
    known = counts.filter("name is not null")
    before = known.agg(F.sum("rows")).first()[0] or 0
    if rank >= before:
        timed = counts.filter("name is null").agg(F.sum("timed")).first()[0]
        return None, rank - before, timed or 0
    prefix = ""
    while True:
        inside = known.filter(F.col("name").startswith(prefix))
        parts = sorted(inside.groupBy(F.substring("name", len(prefix) + 1, _STEP).alias("part")).agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("stations"),
            F.min("name").alias("name"), F.sum("timed").alias("timed")).collect())
        for part in parts:
            if rank < part["rows"]:
                break
            rank -= part["rows"]
        if part["stations"] == 1:
            return bytes.fromhex(part["name"]).decode(), rank, part["timed"]
        prefix += part["part"]


def cuts_at(df: DataFrame, ranks: dict[str, int], station: str = "station_id",
            ts: str = "timestamp") -> dict[str, Cut]:
    """The cut at each zero-based place of the order (station, ts)."""
    counts = stored(df.groupBy(F.hex(F.col(station).cast("binary")).alias("name")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(ts).alias("timed")), "station-rows")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    found: dict[str, Cut] = {}
    for name, rank in ranks.items():
        if rank >= total:
            found[name] = Cut(beyond=True)
            continue
        at, inside, timed = _station_at(counts, rank)
        own = df.filter(F.col(station).eqNullSafe(F.lit(at)))
        if inside >= timed:
            found[name] = Cut(at, None)
        else:
            row = values_at_ranks(own, ts, {"at": lambda n, r=inside: F.lit(r)}, slot=day_slot,
                                  narrow=0).first()
            found[name] = Cut(at, row["at"])
    return found
