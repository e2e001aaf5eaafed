"""Assemblage dating: from observations and the date ranges of their makers to one dated interval per group.

The qualifying rows are computed once; both branches (volume of die-linked observations, date statistics) sum before
their single join on the group key, so each branch is one shuffle with map-side sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_int, norm_key, round_signed
from ..params import DatingParams

GROUP = ["the_site", "the_findspot"]


# joins
def join_sources(obs: DataFrame, src: DataFrame) -> DataFrame:
    """Left join on the normalised name; names that recur in `src` multiply rows, as in SQL. The planner broadcasts
    the ranges only where their size is under its threshold."""
    ranges = src.select(norm_key(F.col("pottername")).alias("_key"), "datemin", "datemax")
    return obs.withColumn("_key", norm_key(F.col("pottername"))).join(ranges, "_key", "left").drop("_key")


def join_registry(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds the_id by site label; null where the site isn't registered."""
    return df.join(registry.select(F.col("id").alias("the_id"), F.col("label").alias("the_site")), "the_site", "left")


def join_volume(df: DataFrame, volume: DataFrame) -> DataFrame:
    return df.join(volume, GROUP, "left")


# filters
def qualifying(joined: DataFrame, p: DatingParams) -> DataFrame:
    return joined.where((F.col("isdate") == p.date_flag) & (F.col("sitecharacter") == p.site_flag) & F.col("the_findspot").isNotNull() & (F.col("datemin") != 0))


def exclude_placeholder_ends(df: DataFrame, values: tuple[int, ...]) -> DataFrame:
    """Drops placeholder range ends, and with them rows without one."""
    return df.where(~F.col("datemax").isin(*values)) if values else df.where("datemax is not null")


def with_die(df: DataFrame) -> DataFrame:
    return df.where("die is not null")


def qualifying_rows(obs: DataFrame, src: DataFrame, p: DatingParams) -> DataFrame:
    return exclude_placeholder_ends(qualifying(join_sources(obs, src), p), p.excluded_ends)


# volume branch
def die_counts(rows: DataFrame) -> DataFrame:
    """Per group and maker (by its name as written): distinct dies and observations with a die."""
    return with_die(rows).groupBy(*GROUP, "pottername").agg(F.count_distinct("die").alias("dies_pp"), F.count("*").alias("stamps_pp"))


def k_factor(n: Column, p: DatingParams) -> Column:
    return F.round(p.k_max - (p.k_max - p.k_min) * (1 - F.exp(-n / F.lit(p.tau))), 4)


def volume(counts: DataFrame, p: DatingParams) -> DataFrame:
    """n_dies, n_stamps_die, die_repetition and k of each group; dies are distinct within a maker, then summed."""
    sums = counts.groupBy(*GROUP).agg(F.sum("dies_pp").alias("n_dies"), F.sum("stamps_pp").alias("n_stamps_die"))
    return sums.withColumns({"die_repetition": F.round(F.col("n_stamps_die") / F.nullif(F.col("n_dies"), F.lit(0)), 3), "_k": k_factor(F.col("n_stamps_die"), p)})


def q_repetition(rep: Column) -> Column:
    return F.when(rep.isNotNull(), F.round(1 - 1.0 / F.greatest(rep, F.lit(1.0)), 3))


# date statistics
def edge_sharpness(sd: Column, t0: float) -> Column:
    return F.round(F.exp(-(sd / F.lit(t0))), 3)


def edge_sharpness_legacy(sd: Column, mean: Column) -> Column:
    """The older form, which depends on where the calendar begins; kept to reconstruct older results."""
    return F.round(F.when(mean != 0, F.exp(-(sd / F.abs(F.nullif(mean, F.lit(0.0)))))), 3)


def interval_sharpness(sd: Column, ma: Column, mb: Column) -> Column:
    return F.round(F.when(mb - ma != 0, F.exp(-(sd / F.abs(F.nullif(mb - ma, F.lit(0.0)))))), 3)


def interval_text(ma: Column, mb: Column) -> Column:
    return F.concat(F.round(ma, 0).cast("long").cast("string"), F.lit(" to "), F.round(mb, 0).cast("long").cast("string"))


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def date_statistics(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per group: counts, means, extremes, deviations of both range ends and of both together, and sigma, unrounded.

    Whole years are summed exactly and divided once: a running variance is off in its last bit by the order in which rows
    come, so that a deviation of 26.5 would round to 26 or to 27."""
    a, b = F.col("datemin"), F.col("datemax")
    head = {
        "count_stamps": F.count("number"), "_ma": F.avg(a.cast("double")), "_mb": F.avg(b.cast("double")),
        "min_datemin": F.min(a), "max_datemin": F.max(a), "min_datemax": F.min(b), "max_datemax": F.max(b),
    }
    if any(t not in _WHOLE for c, t in rows.dtypes if c in ("datemin", "datemax")):
        a, b = a.cast("double"), b.cast("double")
        sigma = F.sqrt(F.avg(F.pow(b - a, 2) / 12.0) + F.coalesce(F.var_samp((a + b) / 2.0), F.lit(0.0)))
        stats = {"_sa": F.stddev_samp(a), "_sb": F.stddev_samp(b), "_sab": F.sqrt(F.var_samp(a) + F.var_samp(b)), "_sigma": sigma}
        return rows.groupBy(*by).agg(*[c.alias(n) for n, c in (head | stats).items()])
    a, b = a.cast("bigint"), b.cast("bigint")
    square = lambda x: F.sum((x * x).cast("decimal(19,0)"))
    sums = {"_n": F.count(a + b), "_a": F.sum(a), "_b": F.sum(b), "_aa": square(a), "_bb": square(b), "_mm": square(a + b), "_ww": square(b - a)}
    n, pairs = F.col("_n").cast("decimal(10,0)"), F.col("_n") * (F.col("_n") - 1)
    spread = lambda x, xx: n * F.col(xx) - F.expr(f"CAST({x} AS DECIMAL(19,0)) * CAST({x} AS DECIMAL(19,0))")  # noqa: E731  n (n - 1) times the variance
    root = lambda c, times=1: F.sqrt(F.when(pairs > 0, c.cast("double") / (times * pairs)))
    va, vb, middle = spread("_a", "_aa"), spread("_b", "_bb"), spread("_a + _b", "_mm")
    stats = {
        "_sa": root(va), "_sb": root(vb), "_sab": root(va + vb),
        # avg(width^2) / 12 + var(middle), over one denominator; middle is (a + b) / 2
        "_sigma": F.when(F.col("_n") > 1, root((n - 1) * F.col("_ww") + 3 * middle, 12)).otherwise(F.sqrt(F.col("_ww").cast("double") / 12.0)),
    }
    return rows.groupBy(*by).agg(*[c.alias(n) for n, c in (head | sums).items()]).withColumns(stats).drop(*sums)


def project_dated(stats: DataFrame, p: DatingParams, legacy: bool = False, extra: list[str] = ()) -> DataFrame:
    """The published columns with their rounding: the coverage factor is rounded before it widens the interval, the
    midpoint and sigma are not."""
    ma, mb, sa, sb, sab, sigma = (F.col(c) for c in ("_ma", "_mb", "_sa", "_sb", "_sab", "_sigma"))
    k = F.coalesce(F.col("_k"), F.lit(float(p.k_max)))
    middle = (ma + mb) / 2.0
    out = {
        "count_stamps": F.col("count_stamps").cast("int"),
        "avg_datemin": as_int(ma), "avg_datemax": as_int(mb),
        "min_datemin": as_int(F.col("min_datemin").cast("double")), "max_datemin": as_int(F.col("max_datemin").cast("double")),
        "min_datemax": as_int(F.col("min_datemax").cast("double")), "max_datemax": as_int(F.col("max_datemax").cast("double")),
        "q_start": edge_sharpness(sa, p.t0), "q_end": edge_sharpness(sb, p.t0),
        "q_interval": interval_sharpness(sab, ma, mb),
        "n_dies": F.col("n_dies").cast("int"), "die_repetition": F.col("die_repetition"), "q_repetition": q_repetition(F.col("die_repetition")),
        "avg_interval": interval_text(ma, mb),
        "unc_start_years": as_int(sa), "unc_end_years": as_int(sb), "unc_interval_years": as_int(sab),
        "unc_start_years_exact": F.round(sa, 6), "unc_end_years_exact": F.round(sb, 6),
        "midpoint_year": round_signed(middle, 3),
        "n_stamps_die": F.col("n_stamps_die").cast("int"),
        "k_eff": F.round(k, 4), "k_is_fallback": F.col("_k").isNull(),
        "sigma_eff": F.round(sigma, 3),
        "p_k_min": F.lit(float(p.k_min)), "p_k_max": F.lit(float(p.k_max)), "p_tau": F.lit(float(p.tau)), "p_w": F.lit(float(p.w)), "p_t0": F.lit(float(p.t0)),
        "eff_start": round_signed(middle - k * sigma, 1), "eff_end": round_signed(middle + k * sigma, 1),
    }
    if legacy:
        out |= {"q_start_legacy": edge_sharpness_legacy(sa, ma), "q_end_legacy": edge_sharpness_legacy(sb, mb)}
    return stats.select(*extra, *GROUP, *[c.alias(n) for n, c in out.items()])


#: What is constant within a group and published with it.
PLACE = ["latinsitename", "long", "lat", "pleiades"]


def date_groups(obs: DataFrame, src: DataFrame, registry: DataFrame | None = None, p: DatingParams = DatingParams(), legacy: bool = False) -> DataFrame:
    """The dated groups. `obs` has the_site, the_findspot, pottername, die, number, isdate, sitecharacter, and may have
    the columns of PLACE; with a registry the_id is looked up, else taken from `obs` where it is there."""
    rows = qualifying_rows(obs, src, p)
    place = [c for c in PLACE if c in obs.columns]
    by = (["the_id"] if registry is None and "the_id" in obs.columns else []) + GROUP + place
    stats = join_volume(date_statistics(rows, by), volume(die_counts(rows), p))
    if registry is not None:
        stats = join_registry(stats, registry)
    extra = (["the_id"] if "the_id" in stats.columns else []) + place
    return project_dated(stats, p, legacy, extra)
