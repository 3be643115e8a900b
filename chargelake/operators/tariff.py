"""The optimal-tariff lookup and the pricing of tables through it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chargelake import config
from chargelake.functions.pricing import best_cents, reference_price
from chargelake.functions.scalar import clip, tenth_index, without_nan

_CELL = ["hour", "u_idx", "c_idx"]
LOOKUP_CELLS = 24 * 11 * 11
# prices of all cells in order, per application
_SEARCHED: dict[str, str] = {}


def tariff_lookup(spark: SparkSession) -> DataFrame:
    """Best tariff per hour and tenth of utilisation and congestion: 2,904 rows."""
    cells = spark.range(0, LOOKUP_CELLS, 1, 8).select(
        F.expr("id div 121").cast("int").alias("hour"),
        F.expr("id div 11 % 11").cast("int").alias("u_idx"),
        F.expr("id % 11").cast("int").alias("c_idx"),
    )
    cells = cells.withColumn("_reference", reference_price(F.col("hour")))
    cents = best_cents(F.col("u_idx") / 10.0, F.col("_reference"), F.col("c_idx") / 10.0)
    return cells.select(*_CELL, (cents / 100).alias("tariff_inr"))


def price_cell(df: DataFrame, utilization: str | None = "predicted_utilization",
               hour: str = "hour_of_day",
               congestion: str = "congestion_probability") -> dict[str, F.Column]:
    """Lookup cell of every row; missing values and columns get their defaults."""
    source = next(
        (c for c in (utilization, "charger_utilization_rate") if c in df.columns), None
    )
    share = lambda name, default: F.coalesce(
        without_nan(F.col(name).cast("double")) if name in df.columns else F.lit(default),
        F.lit(default),
    )
    hours = F.lit(12)
    if hour in df.columns:
        hours = clip(F.coalesce(F.col(hour).cast("int"), F.lit(12)), 0, 23).cast("int")
    return {
        "hour": hours,
        "u_idx": tenth_index(share(source, 0.5)),
        "c_idx": tenth_index(share(congestion, 0.0)),
    }


def dense_price(spark: SparkSession, cell: dict[str, F.Column]) -> F.Column:
    """The best tariff of a cell from an array of all 2,904, addressed by the cell's place.

    The array is a constant of the plan, so nothing is joined. The search for it runs once
    in the life of the application.
    """
    key = spark.sparkContext.applicationId
    if key not in _SEARCHED:
        order = sorted(tuple(r) for r in tariff_lookup(spark).collect())
        _SEARCHED[key] = ",".join(repr(price) for *_, price in order)
    prices = F.split(F.lit(_SEARCHED[key]), ",").cast("array<double>")
    place = (cell["hour"] * 11 + cell["u_idx"]) * 11 + cell["c_idx"]
    return F.get(prices, place)


def _one_per_cell(lookup: DataFrame) -> DataFrame:
    """A lookup from elsewhere with one row for each cell there is: 2,904 at most.

    Two prices of a cell fail the query; cells that no row can have go.
    """
    hour, use, congestion = (F.col(c).cast("int") for c in _CELL)
    possible = hour.between(0, 23) & use.between(0, 10) & congestion.between(0, 10)
    once = F.when(F.min("tariff_inr").eqNullSafe(F.max("tariff_inr")), F.max("tariff_inr")).otherwise(
        F.raise_error(F.lit("the tariff lookup has several prices for a cell")).cast("double"))
    return (
        lookup.filter(possible)
        .groupBy(*[F.col(c).cast("int").alias(f"_{c}") for c in _CELL])
        .agg(once.alias("tariff_inr"))
    )


def price_table(df: DataFrame, lookup: DataFrame | None = None,
                utilization: str | None = "predicted_utilization", hour: str = "hour_of_day",
                congestion: str = "congestion_probability",
                name: str = "dynamic_tariff") -> DataFrame:
    """Add the tariff of every row, from the best tariffs or from a lookup given.

    A given lookup is broadcast after it has been brought to one row per cell; rows in a
    cell it lacks get the baseline tariff.
    """
    cell = price_cell(df, utilization, hour, congestion)
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    if lookup is None:
        return df.select(*kept, dense_price(df.sparkSession, cell).alias(name))
    keyed = df.withColumns({f"_{c}": column for c, column in cell.items()})
    tariff = F.coalesce(F.col("tariff_inr"), F.lit(config.BASELINE_TARIFF))
    return (
        keyed.join(F.broadcast(_one_per_cell(lookup)), [f"_{c}" for c in _CELL], "left")
        .select(*kept, tariff.alias(name))
    )


def pricing_schedule(lookup: DataFrame) -> DataFrame:
    """Tariff by hour and utilisation without congestion: 264 rows."""
    return lookup.filter(F.col("c_idx") == 0).select(
        "hour", (F.col("u_idx") / 10.0).alias("utilization"), "tariff_inr"
    )


def with_predictions(df: DataFrame, predictions: DataFrame,
                     keys: tuple[str, ...] = ("station_id", "timestamp")) -> DataFrame:
    """Attach predicted columns by key; rows without a prediction keep null."""
    return df.join(predictions, list(keys), "left")


def congestion_flag(utilization: str, threshold: float = config.SURGE_UTILISATION):
    """1 above the threshold, else 0, also without a value."""
    return F.coalesce((F.col(utilization) > threshold).cast("int"), F.lit(0))
