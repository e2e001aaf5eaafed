"""The data behind figures: positions, whiskers, domains, value tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import year_label
from ..sources.scratch import carried, in_ranges


def row_position(df: DataFrame) -> DataFrame:
    """0-based row by avg_datemin, site and spot, and by the_id where two share all three. Ranks are given within ranges
    of the keys and moved by the number of rows before each range, so no task orders all rows."""
    keys = ["avg_datemin", "the_site", "the_findspot", *(["the_id"] if "the_id" in df.columns else [])]
    parts = in_ranges(df, *keys)
    ranked = parts.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*keys)))
    before = carried(parts, F.count("*"), F.sum)
    return ranked.join(before, "_part").withColumn("row", (F.coalesce("carried", F.lit(0)) + F.col("_rank") - 1).cast("int")).drop("_part", "_rank", "carried")


def whisker_geometry(df: DataFrame, stub: float = 10) -> DataFrame:
    unc_a, unc_b = F.coalesce("unc_start_years", F.lit(0)), F.coalesce("unc_end_years", F.lit(0))
    return df.withColumns({
        "whisker_start": F.col("eff_start") - unc_a, "whisker_end": F.col("eff_end") + unc_b,
        "stub_start": F.least(F.col("min_datemin") + F.lit(float(stub)), F.col("eff_start")), "stub_end": F.greatest(F.col("max_datemax") - F.lit(float(stub)), F.col("eff_end")),
        "dashed_start": unc_a > 0, "dashed_end": unc_b > 0,
    })


def axis_domain(df: DataFrame, pad: float = 60, mode: str = "classic") -> DataFrame:
    """One row lo, hi. classic: interval and whiskers; modern: extremes too, half the pad; ridge: extremes, a quarter."""
    unc_a, unc_b = F.coalesce("unc_start_years", F.lit(0)), F.coalesce("unc_end_years", F.lit(0))
    a, b = F.col("eff_start") - unc_a, F.col("eff_end") + unc_b
    low, high = F.col("min_datemin").cast("double"), F.col("max_datemax").cast("double")
    lo, hi, share = {"classic": (a, b, 1), "modern": (F.least(a, low), F.greatest(b, high), 2), "ridge": (low, high, 4)}[mode]
    return df.agg((F.min(lo) - pad / share).alias("lo"), (F.max(hi) + pad / share).alias("hi"))


def value_table(df: DataFrame, era: str = "historical") -> DataFrame:
    """Formatted columns; undefined values read as a dash."""
    dash = lambda c: F.coalesce(c, F.lit("–"))
    number = lambda c, n: dash(F.when(F.col(c).isNotNull(), F.format_string(f"%.{n}f", F.col(c).cast("double"))))
    return df.select(
        "the_site", "the_findspot",
        F.concat(year_label(F.col("eff_start"), era), F.lit(" – "), year_label(F.col("eff_end"), era)).alias("interval"),
        dash(F.col("count_stamps").cast("string")).alias("n"), number("sigma_eff", 1).alias("sigma"),
        number("unc_start_years", 0).alias("unc_start"), number("q_start", 3).alias("q_start"), number("q_interval", 3).alias("q_interval"),
        number("unc_end_years", 0).alias("unc_end"), number("q_end", 3).alias("q_end"),
    )


def scale_to_peak(df: DataFrame, value: str, target: float) -> DataFrame:
    """One scale for all rows: the largest value becomes `target`."""
    return df.crossJoin(df.agg(F.max(value).alias("_peak"))).withColumn("scaled", F.when(F.col("_peak") > 0, F.col(value) * F.lit(float(target)) / F.col("_peak"))).drop("_peak")


def first_by(df: DataFrame, keys: list[Column | str]) -> DataFrame:
    return df.orderBy(*keys).limit(1)
