"""Verification: every published value is derived again from the other columns of its row.

A check is a DataFrame of one row: key, title, status (pass, warn, fail, info), detail, n_offenders, offenders (the
first ten group labels, sorted).
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import group_label
from ..params import DatingParams
from ..sources.scratch import carried, in_ranges, stored

#: Tolerances (fixed values): half of the last published digit, with its error carried through.
TOL_K, TOL_WIDTH, TOL_Q, TOL_Q_WARN, TOL_INT, TOL_MONOTONIC = 5e-5, 0.11, 1e-9, 1.1e-3, 0.5 + 1e-9, 1e-12

PARAMETER_COLUMNS = ["p_k_min", "p_k_max", "p_tau", "p_w", "p_t0"]
LISTED = 10

#: The columns that the checks read.
REQUIRED = [
    "the_site", "the_findspot", "n_stamps_die", "k_eff", "k_is_fallback", "sigma_eff", "eff_start", "eff_end", "midpoint_year", "q_start", "q_end", "q_interval",
    "unc_start_years", "unc_end_years", "unc_interval_years", "unc_start_years_exact", "unc_end_years_exact", *PARAMETER_COLUMNS,
]


def _label() -> Column:
    return group_label(F.col("the_site"), F.col("the_findspot"))


class Check(NamedTuple):
    """Fails where a row is `bad`, warns where one is in `warn` only; `deviation` is reported at its largest."""

    key: str
    title: str
    bad: Column
    deviation: Column | None = None
    warn: Column | None = None

    def odd(self) -> Column:
        bad = F.coalesce(self.bad, F.lit(False))
        return bad if self.warn is None else bad | F.coalesce(self.warn, F.lit(False))


def checked(df: DataFrame, checks: list[Check]) -> DataFrame:
    """A row for each check, all from one pass for the sums and one for the offenders, which are kept by rank (ten a
    task at most) and never gathered whole."""
    none = F.lit(None).cast("double")
    sums = df.agg(*[F.struct(F.count_if(F.coalesce(c.bad, F.lit(False))).alias("n_bad"), F.count_if(c.odd()).alias("n_odd"), F.max(none if c.deviation is None else c.deviation).alias("worst")).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = sums.select(F.explode(F.array(*[F.struct(F.lit(c.key).alias("key"), F.lit(c.title).alias("title"), F.col(f"c{i}.n_bad").alias("n_bad"), F.col(f"c{i}.n_odd").alias("n_odd"), F.col(f"c{i}.worst").alias("worst")) for i, c in enumerate(checks)])).alias("r")).select("r.*")
    marked = df.select(_label().alias("label"), F.explode(F.filter(F.array(*[F.when(c.odd(), F.lit(c.key)) for c in checks]), lambda k: k.isNotNull())).alias("key"))
    ranked = marked.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("label"))).where(F.col("rank") <= LISTED)
    first = ranked.groupBy("key").agg(F.sort_array(F.collect_list("label")).alias("offenders"))
    status = F.when(F.col("n_bad") > 0, "fail").when(F.col("n_odd") > 0, "warn").otherwise("pass")
    detail = F.when(F.col("worst").isNotNull(), F.format_string("largest deviation %.2e", F.col("worst"))).otherwise(F.concat(F.col("n_odd").cast("string"), F.lit(" rows")))
    return rows.join(first, "key", "left").select("key", "title", status.alias("status"), detail.alias("detail"), F.col("n_odd").alias("n_offenders"), F.coalesce("offenders", F.array().cast("array<string>")).alias("offenders"))


def check_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    empty = df.isEmpty()
    status = "fail" if missing or empty else "pass"
    spark = df.sparkSession
    return spark.createDataFrame([("k", "required columns", status, "no rows" if empty and not missing else f"missing: {', '.join(missing) or 'none'}", len(missing), missing)], "key string, title string, status string, detail string, n_offenders bigint, offenders array<string>")


def check_count(df: DataFrame, expected: int) -> DataFrame:
    return df.agg(F.count("*").alias("n")).select(F.lit("a").alias("key"), F.lit("row count").alias("title"), F.when(F.col("n") == expected, "pass").otherwise("warn").alias("status"), F.concat(F.col("n").cast("string"), F.lit(f" rows, expected {expected}")).alias("detail"), F.lit(0).cast("bigint").alias("n_offenders"), F.array().cast("array<string>").alias("offenders"))


def check_parameters(df: DataFrame) -> DataFrame:
    """Each parameter column holds one value and no null."""
    sums = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in PARAMETER_COLUMNS], *[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in PARAMETER_COLUMNS])
    odd = F.filter(F.array(*[F.when((F.col(c) != 1) | (F.col(f"{c}_null") > 0), F.lit(c)) for c in PARAMETER_COLUMNS]), lambda x: x.isNotNull())
    return sums.select(odd.alias("offenders")).select(F.lit("p").alias("key"), F.lit("constant parameters").alias("title"), F.when(F.size("offenders") == 0, "pass").otherwise("fail").alias("status"), F.concat(F.lit("not constant: "), F.size("offenders").cast("string")).alias("detail"), F.size("offenders").cast("bigint").alias("n_offenders"), "offenders")


def k_check() -> Check:
    n, low, high = F.col("n_stamps_die"), F.col("p_k_min"), F.col("p_k_max")
    formula = high - (high - low) * (1 - F.exp(-n / F.col("p_tau")))
    wanted = F.when(F.col("k_is_fallback") | n.isNull(), high).otherwise(formula)
    dev = F.abs(F.col("k_eff") - wanted)
    return Check("c", "coverage factor from volume", dev.isNull() | (dev > TOL_K), dev)


def width_check() -> Check:
    dev = F.abs((F.col("eff_end") - F.col("eff_start")) - 2 * F.col("k_eff") * F.col("sigma_eff"))
    return Check("d", "width is twice k sigma", dev.isNull() | (dev > TOL_WIDTH), dev)


def sharpness_check(q: str, sd: str, key: str) -> Check:
    dev = F.when(F.col(q).isNotNull() & F.col(sd).isNotNull(), F.abs(F.col(q) - F.round(F.exp(-F.col(sd) / F.col("p_t0")), 3)))
    return Check(key, f"{q} from {sd}", dev > TOL_Q_WARN, dev, dev > TOL_Q)


def undefined_together_check() -> Check:
    pairs = [("q_start", "unc_start_years_exact"), ("q_end", "unc_end_years_exact")]
    return Check("n", "q undefined exactly where sigma is", reduce(lambda a, b: a | b, [F.col(q).isNull() != F.col(s).isNull() for q, s in pairs]))


def no_placeholder_check() -> Check:
    pairs = [("q_start", "unc_start_years_exact"), ("q_end", "unc_end_years_exact"), ("q_interval", "unc_interval_years")]
    return Check("f", "no 0.5 in place of an undefined value", reduce(lambda a, b: a | b, [F.col(s).isNull() & F.coalesce(F.abs(F.col(q) - 0.5) < 1e-9, F.lit(False)) for q, s in pairs]))


def integer_casts_check() -> Check:
    pairs = [("unc_start_years", "unc_start_years_exact"), ("unc_end_years", "unc_end_years_exact")]
    dev = F.greatest(*[F.abs(F.col(i) - F.col(x)) for i, x in pairs])
    return Check("r", "whole years within half a year", dev > TOL_INT, dev)


def check_k(df: DataFrame) -> DataFrame:
    return checked(df, [k_check()])


def check_width(df: DataFrame) -> DataFrame:
    return checked(df, [width_check()])


def check_sharpness(df: DataFrame, q: str, sd: str, key: str) -> DataFrame:
    return checked(df, [sharpness_check(q, sd, key)])


def check_undefined_together(df: DataFrame) -> DataFrame:
    return checked(df, [undefined_together_check()])


def check_no_placeholder(df: DataFrame) -> DataFrame:
    return checked(df, [no_placeholder_check()])


def check_integer_casts(df: DataFrame) -> DataFrame:
    return checked(df, [integer_casts_check()])


def monotonic_violations(df: DataFrame, x: str, y: str, part: list[str], tolerance: float = TOL_MONOTONIC) -> DataFrame:
    """Rows whose y is above that of the row before by x (ties by site and spot), within each part."""
    order = Window.partitionBy(*part).orderBy("x", "the_site", "the_findspot")
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*dict.fromkeys([*part, "the_site", "the_findspot"]), F.col(x).alias("x"), F.col(y).alias("y"))
    before = rows.withColumns({"y_before": F.lag("y").over(order), "before": F.lag(_label()).over(order)})
    return before.where(F.col("y") > F.col("y_before") + tolerance).withColumn("label", _label())


def monotonic_violations_at_scale(df: DataFrame, x: str, y: str, tolerance: float = TOL_MONOTONIC) -> DataFrame:
    """The same over one huge set: since y may only fall with x, a row is compared with the least y of smaller x.

    Rows are summed to the least and largest y of each x first; x values are cut into ranges, each range is read in
    order by itself, and the least y of the ranges before it (one row a range) is carried over."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x")).agg(F.min(y).alias("low"), F.max(y).alias("high"))
    ranges = in_ranges(rows, "x")
    inside = Window.partitionBy("_part").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    least = F.least(F.min("low").over(inside), F.col("carried"))
    return ranges.join(carried(ranges, F.min("low"), F.min), "_part").withColumn("least_before", least).where(F.col("high") > F.col("least_before") + tolerance).select("x", "high", "least_before")


def inversions(df: DataFrame, x: str, y: str, tolerance: float = TOL_MONOTONIC) -> DataFrame:
    """label, y, y_before of the rows whose y is above that of the row before by x (ties by site and spot) over one huge
    set: neighbours meet within ranges, and the last row of each range is carried to the next."""
    keys = ["x", "the_site", "the_findspot"]
    rows = in_ranges(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"), "the_site", "the_findspot"), *keys)
    last = rows.groupBy("_part").agg(F.max_by("y", F.struct(*keys)).alias("end"))  # a row for each range
    last = last.select("_part", F.lag("end").over(Window.orderBy("_part")).alias("end"))
    before = F.coalesce(F.lag("y").over(Window.partitionBy("_part").orderBy(*keys)), F.when(F.row_number().over(Window.partitionBy("_part").orderBy(*keys)) == 1, F.col("end")))
    return rows.join(last, "_part").select(_label().alias("label"), "y", before.alias("y_before")).where(F.col("y") > F.col("y_before") + tolerance)


def check_monotonic(df: DataFrame, q: str, sd: str, key: str) -> DataFrame:
    found = inversions(df, sd, q)
    n = found.agg(F.count("*").alias("n"))
    first = found.orderBy("label").limit(LISTED).agg(F.sort_array(F.collect_list("label")).alias("offenders"))
    return n.crossJoin(first).select(F.lit(key).alias("key"), F.lit(f"{q} falls with {sd}").alias("title"), F.when(F.col("n") == 0, "pass").otherwise("fail").alias("status"), F.concat(F.col("n").cast("string"), F.lit(" inversions")).alias("detail"), F.col("n").alias("n_offenders"), "offenders")


# correlations, medians, facts
def pearson(x: Column, y: Column) -> Column:
    """Correlation over complete pairs; null under three pairs or without variance."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)  # corr itself divides by it, an error where it is zero
    return F.when((F.count(x) >= 3) & (spread > 0), F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0)))


def median_where(x: Column, cond: Column, approximate: bool = False) -> Column:
    value = F.when(cond, x.cast("double"))
    return F.percentile_approx(value, 0.5, 100_000) if approximate else F.median(value)


def middles(df: DataFrame, by: str, x: str, n: str | None = None) -> DataFrame:
    """by, low, high: the two middle values of x for each value of `by` (the same one twice where their number is odd),
    exact. n: a column with the number of rows that each row stands for. Equal values are counted, the counts cut into ranges, and each range's sum is carried on, so no task holds all
    values as a built-in median does."""
    counts = df.where(F.col(x).isNotNull()).groupBy(by, x).agg((F.sum(n) if n else F.count("*")).alias("n"))
    ranges = in_ranges(counts, by, x)
    ends = ranges.groupBy(by, "_part").agg(F.sum("n").alias("m"))  # a row for each range and value of `by`
    ends = ends.select(by, "_part", F.coalesce(F.sum("m").over(Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carried"), F.sum("m").over(Window.partitionBy(by)).alias("total"))
    upto = F.sum("n").over(Window.partitionBy(by, "_part").orderBy(x)) + F.col("carried")
    found = ranges.join(ends, [by, "_part"]).select(by, x, "n", "total", upto.alias("upto"))
    holds = lambda at: F.max(F.when((F.col("upto") >= at) & (F.col("upto") - F.col("n") < at), F.col(x)))
    return found.groupBy(by).agg(holds(F.floor((F.col("total") + 1) / 2)).alias("low"), holds(F.floor(F.col("total") / 2) + 1).alias("high"))


def epoch_drift(df: DataFrame, cut: int = 100) -> DataFrame:
    """Correlations of width, sigma, q_interval and q_start with the midpoint; median widths before and after `cut`. The
    columns are stored once, as two passes read them."""
    df = stored(df.select("midpoint_year", "eff_start", "eff_end", "sigma_eff", "q_interval", "q_start"), "drift")
    year, width = F.col("midpoint_year"), F.col("eff_end") - F.col("eff_start")
    sums = df.agg(
        pearson(width, year).alias("r_width"), pearson(F.col("sigma_eff"), year).alias("r_sigma"), pearson(F.col("q_interval"), year).alias("r_q_interval"), pearson(F.col("q_start"), year).alias("r_q_start"),
        F.count_if(year < cut).alias("n_before"), F.count_if(year >= cut).alias("n_after"),
    )
    half = middles(df.where(year.isNotNull()).select((year >= cut).alias("late"), width.cast("double").alias("x")), "late", "x").withColumn("m", (F.col("low") + F.col("high")) / 2)
    medians = half.agg(F.max(F.when(~F.col("late"), F.col("m"))).alias("median_width_before"), F.max(F.when(F.col("late"), F.col("m"))).alias("median_width_after"))
    return sums.crossJoin(medians).select("r_width", "r_sigma", "r_q_interval", "r_q_start", "median_width_before", "median_width_after", "n_before", "n_after")


def spectrum(df: DataFrame, cols: list[str], t0: float) -> DataFrame:
    """n, least, median and largest of several columns together, and of exp(-x / t0)."""
    rows = df.select(F.explode(F.array(*[F.col(c).cast("double") for c in cols])).alias("x")).where("x is not null")
    q = lambda c: F.exp(-F.col(c) / F.lit(float(t0)))
    ends = rows.agg(F.count("x").alias("n"), F.min("x").alias("sigma_min"), F.max("x").alias("sigma_max"))
    half = middles(rows.withColumn("all", F.lit(0)), "all", "x").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    return ends.crossJoin(half).select("n", "sigma_min", ((F.col("low") + F.col("high")) / 2).alias("sigma_median"), "sigma_max", q("sigma_max").alias("q_min"), ((q("low") + q("high")) / 2).alias("q_median"), q("sigma_min").alias("q_max"))


def facts(df: DataFrame, p: DatingParams, anchors: tuple[float, ...] = (5.0, 25.0)) -> DataFrame:
    """One row: number of groups, parameters, q at the anchor deviations, spectrum, drift."""
    head = df.agg(F.count("*").alias("n_groups"))
    anchor = [F.round(F.exp(F.lit(-a / p.t0)), 3).alias(f"q_at_{a:g}") for a in anchors]
    values = [F.lit(float(v)).alias(n) for n, v in (("k_min", p.k_min), ("k_max", p.k_max), ("tau", p.tau), ("w", p.w), ("t0", p.t0))]
    return head.crossJoin(spectrum(df, ["unc_start_years_exact", "unc_end_years_exact"], p.t0)).crossJoin(epoch_drift(df)).select("*", *values, *anchor)


def fallback_rows(df: DataFrame) -> DataFrame:
    return df.where("k_is_fallback")


def unresolved_ids(df: DataFrame) -> DataFrame:
    return df.where("the_id is null")


def row_checks() -> list[Check]:
    """The checks that look at one row at a time."""
    return [k_check(), width_check(), sharpness_check("q_start", "unc_start_years_exact", "h"), sharpness_check("q_end", "unc_end_years_exact", "h'"), undefined_together_check(), no_placeholder_check(), integer_casts_check()]


def all_checks(df: DataFrame, required: list[str] = REQUIRED, expected: int | None = None) -> DataFrame:
    """The checks in their order, with two gates: where a column is missing or there is no row, only that is reported; where
    a parameter differs between rows, nothing after it is, since every later formula reads the parameters. Past the gates
    all row checks are one pass, and each monotonic pair an ordered one."""
    columns = check_columns(df, required)
    if columns.first().status == "fail":
        return columns
    parameters = check_parameters(df)
    found = [columns, *([check_count(df, expected)] if expected is not None else []), parameters]
    if parameters.first().status != "fail":
        found += [checked(df, row_checks()), check_monotonic(df, "q_start", "unc_start_years_exact", "i"), check_monotonic(df, "q_end", "unc_end_years_exact", "i'")]
    return reduce(DataFrame.unionByName, found)


def verdict(checks: DataFrame, strict: bool = False) -> DataFrame:
    """One row: verdict is error if a check fails (strict: or warns), else ok."""
    rank = F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0)
    return checks.agg(F.max(rank).alias("worst"), F.count_if(F.col("status") == "fail").alias("n_fail"), F.count_if(F.col("status") == "warn").alias("n_warn")).select(F.when(F.col("worst") >= (1 if strict else 2), "error").otherwise("ok").alias("verdict"), "n_fail", "n_warn")


def require_constant_parameters(df: DataFrame) -> DatingParams:
    """The parameters of a published set, or an error where they differ between rows."""
    row = df.agg(*[F.min(c).alias(c) for c in PARAMETER_COLUMNS], *[(F.count_distinct(F.col(c)) + F.count_if(F.col(c).isNull())).alias(f"n_{c}") for c in PARAMETER_COLUMNS]).first()
    if odd := [c for c in PARAMETER_COLUMNS if row[f"n_{c}"] != 1]:
        raise ValueError(f"parameters differ between rows or are missing: {', '.join(odd)}")
    return DatingParams(k_min=row.p_k_min, k_max=row.p_k_max, tau=row.p_tau, w=row.p_w, t0=row.p_t0)
