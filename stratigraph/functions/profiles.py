"""The spread of a group's contributing ranges as a smooth curve."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once: as a column of its own it would be inlined wherever it is used, in a lambda
    even once for each element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def spread_profile(df: DataFrame, a: Column, b: Column, mean: Column, sd: Column, samples: int = 400) -> DataFrame:
    """Adds `profile`, the arrays xs and density: a Beta density on [a, b] with the given mean and deviation, zero at both ends
    and of area 1 (trapezoid rule). The mean keeps 2 % off the ends, the deviation is at least 0.35, the variance at
    most 0.92 of what a Beta allows, and both shapes are at least 1.06."""
    low = a.cast("double")
    span = F.when(b > a, b.cast("double")).otherwise(low + 1) - low
    last = samples - 1

    def shaped(p: Column) -> Column:
        t = F.least(F.greatest((p["mean"] - p["low"]) / p["span"], F.lit(0.02)), F.lit(0.98))
        v = F.least(F.pow(F.greatest(p["sd"], F.lit(0.35)) / p["span"], 2), t * (1 - t) * 0.92)
        k = t * (1 - t) / v - 1
        return F.struct(p["low"].alias("low"), p["span"].alias("span"), (F.greatest(t * k, F.lit(1.06)) - 1).alias("a"), (F.greatest((1 - t) * k, F.lit(1.06)) - 1).alias("b"))

    def curve(p: Column) -> Column:
        xs = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda i: p["low"] + i * p["span"] / last)

        def log_density(x: Column) -> Column:
            u = F.least(F.greatest((x - p["low"]) / p["span"], F.lit(1e-9)), F.lit(1 - 1e-9))
            return p["a"] * F.log(u) + p["b"] * F.log1p(-u)

        def scaled(logs: Column) -> Column:
            """exp of the logarithms less their peak, both ends zero."""
            return bound(F.array_max(logs), lambda top: F.transform(logs, lambda x, i: F.when((i == 0) | (i == last), 0.0).otherwise(F.exp(x - top))))

        def normal(raw: Column) -> Column:
            # both ends are zero, so the trapezoid rule is the plain sum times the step
            area = F.aggregate(raw, F.lit(0.0), lambda s, x: s + x) * p["span"] / last
            return bound(area, lambda a: F.transform(raw, lambda x: F.when(a > 0, x / a).otherwise(x)))

        return bound(xs, lambda xs: F.struct(xs.alias("xs"), bound(F.transform(xs, log_density), lambda logs: bound(scaled(logs), normal)).alias("density")))

    given = F.struct(low.alias("low"), span.alias("span"), mean.cast("double").alias("mean"), sd.cast("double").alias("sd"))
    return df.withColumn("profile", bound(bound(given, shaped), curve))


def profile_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, peak, mean of each profile, summed within its arrays."""

    def sums(p: Column) -> Column:
        weight = F.aggregate(p["density"], F.lit(0.0), lambda s, x: s + x)
        moment = F.aggregate(F.zip_with(p["xs"], p["density"], lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        return F.struct(F.size(p["density"]).cast("bigint").alias("n"), F.array_max(p["density"]).alias("peak"), F.when(weight > 0, moment / weight).alias("mean"))

    return df.select(*keys, bound(F.col("profile"), sums).alias("_sums")).select(*keys, "_sums.*")


def profile_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Long form of `profile`: keys, point, x, density."""
    return df.select(*keys, F.posexplode(F.arrays_zip("profile.xs", "profile.density")).alias("point", "z")).select(*keys, "point", F.col("z.xs").alias("x"), F.col("z.density").alias("density"))
