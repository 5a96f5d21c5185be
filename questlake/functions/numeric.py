"""Rounded averages and scores."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from questlake.functions.bound import bound

#: Decimal places that averages keep of each value, unless the caller asks for others.
SCALE = 12


def exact(value: Column, scale: int = SCALE) -> Column:
    """The value as a decimal with ``scale`` places; NULL if it is NaN, infinite or too large for one."""
    return value.cast("double").try_cast(f"decimal(38,{scale})")


def limbs(value: Column, scale: int = SCALE) -> tuple[Column, Column]:
    """The value as ``high * 10 ** (22 - scale) + low``, both decimals that can be added up for any number of rows.

    ``high`` is NULL for values of up to ``26 - scale`` digits before the point, so that it costs nothing where there
    are no larger ones. With a ``scale`` above 12 all of the value is in ``low``.
    """
    fits = exact(value, scale)
    if scale > SCALE:
        return F.lit(None).cast("decimal(28,0)"), fits
    large = F.abs(value.cast("double")) >= 10.0 ** (26 - scale)
    unit = F.lit(Decimal(10 ** (22 - scale)))
    high = F.when(large, F.call_function("div", fits, unit).cast("decimal(28,0)"))
    return high, F.when(large, fits % unit).otherwise(fits).cast(f"decimal(28,{scale})")


def limb_ratio(high: Column, low: Column, count: Column, digits: int, scale: int = SCALE) -> Column:
    """The sum in two limbs over the count, rounded half away from zero, without any rounding before.

    Each step is computed once and handed to the next (see ``bound``)."""
    whole = lambda c: c.cast("decimal(38,0)")
    of = lambda n: F.lit(Decimal(n))
    unit, count = of(10 ** (22 - scale)), count.cast("decimal(15,0)")
    carried = F.struct(
        (high + F.call_function("div", low, unit)).alias("over"), (low % unit).cast(f"decimal(24,{scale})").alias("rest"), count.alias("count")
    )

    def signed(s: Column) -> Column:
        """Both limbs get the sign of the whole, which is then put aside."""
        over, rest = s["over"], s["rest"]
        step = F.when((over > 0) & (rest < 0), F.lit(1)).when((over < 0) & (rest > 0), F.lit(-1)).otherwise(F.lit(0)).cast("decimal(1,0)")
        sign = F.when((over < 0) | ((over == 0) & (rest < 0)), F.lit("-")).otherwise(F.lit(""))
        rest = (rest + step * unit).cast(f"decimal(24,{scale})")
        return F.struct(sign.alias("sign"), whole(F.abs(over - step)).alias("over"), whole(F.abs(rest) * of(10**scale)).alias("rest"), s["count"].alias("count"))

    def divided(s: Column) -> Column:
        left = whole(s["over"] % s["count"])
        top = whole(left.cast("decimal(15,0)") * of(10**22)) + s["rest"]
        bottom = whole(s["count"] * of(10 ** max(0, scale - digits)))
        return F.struct(s["sign"].alias("sign"), whole((s["over"] - left) / s["count"]).alias("each"), whole(top).alias("top"), bottom.alias("bottom"))

    def rounded(s: Column) -> Column:
        odd = whole(s["top"] % s["bottom"])
        part = whole((s["top"] - odd) / s["bottom"]) + F.when(odd * of(2) >= s["bottom"], F.lit(1)).otherwise(F.lit(0)).cast("decimal(1,0)")
        total = whole(s["each"] * of(10 ** (22 - scale + digits))) + part
        return F.concat(s["sign"], whole(total).cast("string"), F.lit(f"E{-digits}")).cast("double")

    return bound(carried, lambda s: bound(signed(s), lambda t: bound(divided(t), rounded)))


def rounded_avg(value: Column, digits: int, scale: int = SCALE) -> Column:
    """``ROUND(AVG(value), digits)`` summed as decimals, so that the result does not depend
    on the order in which partitions are added up. Values keep ``scale`` decimal places. Sums of any
    number of values below 10 to the ``38 - scale`` are exact; if a value is not below that (or is NaN or an
    infinity), doubles are averaged."""
    number = value.cast("double")
    # NaN is above all numbers here.
    plain = F.bool_or(F.abs(number) >= 10.0 ** (38 - scale))
    high, low = limbs(value, scale)
    exactly = F.round(F.avg(low), digits).cast("double")
    if scale <= SCALE:
        exactly = F.when(F.sum(high).isNotNull(), limb_ratio(F.sum(high), F.sum(low), F.count(value), digits, scale)).otherwise(exactly)
    return F.when(plain, F.round(F.avg(number), digits)).otherwise(exactly)


def rounded_ratio(total: Column, count: Column, digits: int) -> Column:
    """The same from a decimal sum and a count, NULL for no values."""
    return F.round(total / F.nullif(count, F.lit(0).cast("bigint")).cast("decimal(20,0)"), digits).cast("double")


def weighted_score(
    critic: Column,
    user: Column,
    critic_weight: float = 0.6,
    user_weight: float = 0.4,
    critic_scale: float = 100.0,
    top: int = 5,
    digits: int = 2,
) -> Column:
    """Critic score brought to ``0..top`` and mixed with the user rating."""
    critic_part = critic / F.lit(critic_scale) * F.lit(top) * F.lit(critic_weight)
    return F.round(critic_part + user * F.lit(user_weight), digits)
