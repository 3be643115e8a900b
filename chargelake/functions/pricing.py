"""The tariff objective and its best price per (hour, utilisation, congestion) cell."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chargelake import config
from chargelake.functions.scalar import clip, time_of_use_factor

_LOWEST_CENTS = int(config.LOWEST_TARIFF * 100)
_HIGHEST_CENTS = int(config.HIGHEST_TARIFF * 100)
# halvings that leave one price of the range
_HALVINGS = (_HIGHEST_CENTS - _LOWEST_CENTS).bit_length()


def objective(price: Column, utilisation: Column, reference: Column,
              congestion: Column) -> Column:
    """Expected revenue less the cost of leaving the target price and of overload.

    `reference` is the baseline tariff times the time-of-use factor.
    """
    demand = clip(
        1.0 + config.ELASTICITY * (price / reference - 1.0), *config.PRICING_DEMAND_BOUNDS
    )
    revenue = utilisation * 50.0 * demand * price
    over_discount = F.greatest(price - reference * 0.7, F.lit(0.0))
    under_surge = F.greatest(reference * 1.5 - price, F.lit(0.0))
    from_reference = price - reference
    target_cost = (
        F.when(utilisation < config.DISCOUNT_UTILISATION, over_discount * over_discount * 10.0)
        .when(utilisation > config.SURGE_UTILISATION, under_surge * under_surge * 10.0)
        .otherwise(from_reference * from_reference * 2.0)
    )
    overload = F.greatest(utilisation * demand - config.SURGE_UTILISATION, F.lit(0.0))
    penalty = (congestion * 2.0 + 1.0) * 1000.0 * overload * overload
    return revenue - target_cost - penalty


def reference_price(hour: Column) -> Column:
    return time_of_use_factor(hour) * config.BASELINE_TARIFF


def best_cents(utilisation: Column, reference: Column, congestion: Column) -> Column:
    """The price in whole cents with the largest objective.

    Of two neighbours that are equally good the best price lies half way, and rounds up;
    on a longer flat stretch the lowest price is taken.

    Within the price range the demand bounds do not bind and every term is concave in the
    price. So the objective rises up to the best price and never after it, and halving
    the range by the sign of the next step finds the best cent exactly.
    """
    # A millionth is finer than any step between neighbouring prices that is not a tie,
    # and hides last-bit noise.
    score = lambda cents: F.rint(
        objective(cents / 100, utilisation, reference, congestion) * 1e6)

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        rises = (span["low"] < span["high"]) & (score(middle + 1) > score(middle))
        return F.struct(
            F.when(rises, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(rises, span["high"]).otherwise(middle).alias("high"),
        )

    whole = F.struct(F.lit(_LOWEST_CENTS).alias("low"), F.lit(_HIGHEST_CENTS).alias("high"))

    def round_up(span: Column) -> Column:
        best = span["low"]
        pair = (score(best + 1) == score(best)) & (score(best + 2) < score(best))
        return F.when(pair & (best < _HIGHEST_CENTS), best + 1).otherwise(best)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_HALVINGS)), whole, halve, round_up)
