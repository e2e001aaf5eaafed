"""Where the model's constants come from: the volume constant from independently dated groups, rank invariance of the
sharpness under its reference length, and linear trends with the epoch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import DatingParams
from ..sources.scratch import carried, in_ranges, stored
from .checks import middles, pearson

#: Half of the last published digit of the coverage factor.
HALF_DIGIT = 5e-5


def needed_factor(year: Column, middle: Column, sigma: Column) -> Column:
    """The least published factor (four decimals) whose interval around `middle` holds `year`; null where none does."""
    off = F.abs(year - middle)
    return F.when(sigma > 0, F.ceil(off / sigma * 10000) / 10000).when(off == 0, F.lit(0.0))


def tau_for_factor(need: Column, n: Column, p: DatingParams) -> Column:
    """The least volume constant with which n items get a published factor of `need`: the inverse of k(n, tau), which
    rises with tau from k_min to k_max. 0 where every constant will do, null where none does."""
    share = (need - HALF_DIGIT - p.k_min) / (p.k_max - p.k_min)
    inside = (share > 0) & (share < 1)
    return F.when(share <= 0, F.lit(0.0)).when(inside & (n > 0), -n / F.log(F.when(inside, share)))


def reference_constraints(dated: DataFrame, references: DataFrame, p: DatingParams) -> DataFrame:
    """One row for each reference (the_site, the_findspot, terminus): status, need and the least tau.

    status: `bound` (some tau is too small), `free` (every tau will do; a group without dies has the largest factor
    whatever tau is), `unsatisfiable` (no tau will do), `absent` (no such group)."""
    groups = dated.select("the_site", "the_findspot", "midpoint_year", "sigma_eff", "n_stamps_die", F.lit(True).alias("_there"))
    rows = references.select("the_site", "the_findspot", "terminus").join(groups, ["the_site", "the_findspot"], "left")
    need = needed_factor(F.col("terminus"), F.col("midpoint_year"), F.col("sigma_eff"))
    tau = F.when(F.col("n_stamps_die").isNull(), F.when(F.col("need") <= p.k_max, F.lit(0.0))).otherwise(tau_for_factor(F.col("need"), F.col("n_stamps_die"), p))
    rows = rows.withColumn("need", need).withColumn("tau", tau)
    status = F.when(F.col("_there").isNull(), "absent").when(F.col("tau").isNull(), "unsatisfiable").when(F.col("tau") > 0, "bound").otherwise("free")
    return rows.select("the_site", "the_findspot", "terminus", "need", "tau", status.alias("status"))


def calibrate_tau(dated: DataFrame, references: DataFrame, p: DatingParams) -> DataFrame:
    """One row: tau (the least at which all satisfiable references lie in their intervals), the reference that binds it
    (of equal ones the first by name), and the number of references by status."""
    rows = reference_constraints(dated, references, p)
    order = F.struct(F.col("tau"), F.struct("the_site", "the_findspot"))
    largest = rows.where("tau is not null").agg(F.max("tau").alias("tau"))
    binding = rows.where("status = 'bound'").join(largest, "tau").agg(F.min(order).alias("first"))
    counts = rows.agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("bound", "free", "unsatisfiable", "absent")])
    return counts.crossJoin(largest).crossJoin(binding).select("tau", F.col("first.col2.the_site").alias("the_site"), F.col("first.col2.the_findspot").alias("the_findspot"), "n_bound", "n_free", "n_unsatisfiable", "n_absent")


# rank correlation
def mid_ranks(counts: DataFrame, x: str) -> DataFrame:
    """x, rank: the middle rank (from 1) of each value, from x and n (its number of rows, each x once). The values are cut
    into ranges, ranked within them, and moved by the number of rows before each range, so no task orders all values."""
    ranges = in_ranges(counts, x)
    before = carried(ranges, F.sum("n"), F.sum)
    upto = F.sum("n").over(Window.partitionBy("_part").orderBy(x)) + F.coalesce("carried", F.lit(0))
    return ranges.join(before, "_part").select(x, (upto - (F.col("n") - 1) / 2).alias("rank"))


def spearman(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """One row: n (complete pairs) and rho, their rank correlation, ties at their middle rank; null under three pairs or
    without variance."""
    pairs = df.select(x.cast("double").alias("x"), y.cast("double").alias("y")).where("x is not null and y is not null")
    pairs = stored(pairs.groupBy("x", "y").agg(F.count("*").alias("n")), "pairs")
    ranked = pairs
    for c in ("x", "y"):
        ranks = mid_ranks(pairs.groupBy(c).agg(F.sum("n").alias("n")), c)
        ranked = ranked.join(ranks.withColumnRenamed("rank", f"rank_{c}"), c)
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    off_x, off_y = (F.col(f"rank_{c}") - (F.col("total") + 1) / 2 for c in ("x", "y"))  # the mean rank is known
    sums = ranked.crossJoin(total).agg(*[F.sum(F.col("n") * a * b).alias(name) for name, a, b in (("xy", off_x, off_y), ("xx", off_x, off_x), ("yy", off_y, off_y))])
    spread = F.sqrt("xx") * F.sqrt("yy")
    return total.crossJoin(sums).select(F.col("total").alias("n"), F.when((F.col("total") >= 3) & (spread > 0), F.col("xy") / F.nullif(spread, F.lit(0.0))).alias("rho"))


# trends, grids and epochs
def trends(df: DataFrame, x: str, measures: dict[str, Column], at: tuple[float, ...] = (1.0, 200.0)) -> DataFrame:
    """measure, n, slope, intercept, r, r2 and the value of the line at some x, for each measure: one pass that sums all."""
    fits = []
    for name, y in measures.items():
        both = F.col(x).isNotNull() & y.isNotNull()
        a, b = F.when(both, F.col(x).cast("double")), F.when(both, y.cast("double"))
        spread = F.var_pop(a)
        slope = F.when((F.count(a) >= 2) & (spread > 0), F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0)))
        fits.append(F.struct(F.lit(name).alias("measure"), F.count(a).alias("n"), slope.alias("slope"), (F.avg(b) - slope * F.avg(a)).alias("intercept"), pearson(F.col(x), y).alias("r")).alias(f"fit_{len(fits)}"))
    rows = df.agg(*fits).select(F.explode(F.array(*[F.col(f"fit_{i}") for i in range(len(fits))])).alias("f")).select("f.*")
    return rows.select("*", (F.col("r") * F.col("r")).alias("r2"), *[(F.col("intercept") + F.lit(v) * F.col("slope")).alias(f"at_{v:g}") for v in at])


def sharpness_grid(df: DataFrame, deviations: list[str], lengths: tuple[float, ...] = (15.0, 20.0, 25.0, 30.0), anchors: tuple[float, ...] = (5.0, 25.0), blurred: float = 1 / 3) -> DataFrame:
    """For each reference length: sharpness at the anchor deviations; mean, least and largest sharpness of all deviations
    and the number that is below `blurred`, from one pass."""
    c = [F.col(d).cast("double") for d in deviations]
    sums = lambda f: reduce(lambda a, b: a + b, [f(x) for x in c])
    rows = []
    for t0 in lengths:
        q = lambda x: F.exp(-x / F.lit(t0))  # noqa: B023, E731
        rows.append(F.struct(
            F.lit(t0).alias("t0"), *[F.lit(a).alias(f"sd_{a:g}") for a in anchors], sums(F.count).alias("n"), sums(lambda x: F.coalesce(F.sum(q(x)), F.lit(0.0))).alias("total"),
            F.min(F.least(*[q(x) for x in c]) if len(c) > 1 else q(c[0])).alias("q_min"), F.max(F.greatest(*[q(x) for x in c]) if len(c) > 1 else q(c[0])).alias("q_max"), sums(lambda x: F.count_if(q(x) < blurred)).alias("n_blurred"),
        ).alias(f"g{len(rows)}"))
    out = df.agg(*rows).select(F.explode(F.array(*[F.col(f"g{i}") for i in range(len(rows))])).alias("g")).select("g.*")
    return out.select("t0", *[F.exp(-F.col(f"sd_{a:g}") / F.col("t0")).alias(f"q_at_{a:g}") for a in anchors], "n", F.when(F.col("n") > 0, F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("q_mean"), "q_min", "q_max", "n_blurred")


def groups_per_century(df: DataFrame) -> DataFrame:
    """century (of the middle year, from -1 to 1 without 0), n."""
    c = F.floor(F.col("midpoint_year") / 100)
    return df.where("midpoint_year is not null").groupBy(F.when(c >= 0, c + 1).otherwise(c).alias("century")).agg(F.count("*").alias("n"))


def epoch_medians(df: DataFrame, measures: dict[str, Column], cut: float = 100) -> DataFrame:
    """measure, late, n, median: exact medians of several measures before and from `cut` on, all from one set of ranges."""
    rows = F.array(*[F.struct(F.lit(name).alias("measure"), y.cast("double").alias("x")) for name, y in measures.items()])
    long = df.where("midpoint_year is not null").select((F.col("midpoint_year") >= cut).alias("late"), F.explode(rows).alias("r")).where("r.x is not null").select(F.struct("r.measure", "late").alias("by"), "r.x")
    long = stored(long.groupBy("by", "x").agg(F.count("*").alias("n")), "values")
    middle = middles(long, "by", "x", "n").select("by", ((F.col("low") + F.col("high")) / 2).alias("median"))
    return long.groupBy("by").agg(F.sum("n").alias("n")).join(middle, "by").select("by.measure", "by.late", "n", "median")
