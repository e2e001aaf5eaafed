"""Golden values and properties of the dating operators."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from stratigraph.functions import exprs
from stratigraph.operators import checks, dating, figures
from stratigraph.params import DatingParams, params_df
from stratigraph.plans import driver_data

OBS = "the_id int, the_site string, the_findspot string, pottername string, die string, number int, isdate string, sitecharacter string"


@pytest.fixture(scope="module")
def worked(spark):
    """Three ranges 60-80, 65-85, 50-90, one observation each; and the odd rows that must not count."""
    obs = [
        (1, "A", "x", " One ", "d1", 1, "Θ", "Σ"), (1, "A", "x", "TWO", "d2", 2, "Θ", "Σ"), (1, "A", "x", "three", "d3", 3, "Θ", "Σ"),
        (1, "A", "x", "nobody", "d4", 4, "Θ", "Σ"), (1, "A", "x", "undated", "d5", 5, "Θ", "Σ"), (1, "A", "x", "placeholder", "d6", 6, "Θ", "Σ"),
        (1, "A", None, "one", "d1", 7, "Θ", "Σ"), (1, "A", "x", "one", "d1", 8, "-", "Σ"),
        (2, "B", "y", "one", None, 9, "Θ", "Σ"), (3, "C", "z", "bc", "d", 1, "Θ", "Σ"), (3, "C", "z", "bc", "d", 2, "Θ", "Σ"),
    ]
    src = [("one", 60, 80), ("two ", 65, 85), ("Three", 50, 90), ("undated", 0, 50), ("placeholder", 100, 260), ("bc", -20, 10)]
    df = dating.date_groups(spark.createDataFrame(obs, OBS), spark.createDataFrame(src, "pottername string, datemin int, datemax int"), legacy=True)
    return {r.the_site: r for r in df.collect()}, df


def test_worked_example(worked):
    a = worked[0]["A"]
    assert (a.count_stamps, a.n_stamps_die, a.n_dies) == (3, 3, 3)
    assert round(a.midpoint_year, 1) == 71.7 and round(a.sigma_eff, 1) == 8.7 and round(a.k_eff, 2) == 1.36
    assert round(a.q_interval, 2) == 0.71 and a.q_repetition == 0 and a.avg_interval == "58 to 85"
    assert round(a.eff_start) == 60 and 83 <= a.eff_end < 84


def test_single_row_and_no_die(worked):
    b = worked[0]["B"]
    assert b.q_start is None and b.unc_start_years is None and b.q_interval is None
    assert b.k_is_fallback and b.k_eff == 1.5 and b.n_dies is None and b.q_repetition is None


def test_across_year_zero(worked):
    c = worked[0]["C"]
    assert c.min_datemin == -20 and c.eff_start < 0 < c.eff_end and c.q_start == 1.0 and c.die_repetition == 2.0 and c.q_repetition == 0.5


@pytest.mark.parametrize("sd, q", [(0.0, 1.0), (2.26, 0.893), (1.96, 0.907), (7.05, 0.703), (14.58, 0.482), (25.40, 0.281), (29.29, 0.231), (36.55, 0.161), (3.30, 0.848)])
def test_sharpness_at_t0_20(spark, sd, q):
    assert spark.range(1).select(dating.edge_sharpness(F.lit(sd), 20.0)).first()[0] == q


@pytest.mark.parametrize("n, k", [(41, 0.5011), (5, 0.9346), (3, 1.1065)])
def test_k_at_tau_6(spark, n, k):
    assert spark.range(1).select(dating.k_factor(F.lit(n), DatingParams(tau=6.0))).first()[0] == k


def test_checks_pass_and_catch_changes(worked):
    df = worked[1]
    assert checks.verdict(checks.all_checks(df)).first().verdict == "ok"
    broken = {
        "c": df.withColumn("k_eff", F.col("k_eff") + 0.01), "d": df.withColumn("eff_end", F.col("eff_end") + 1), "h": df.withColumn("q_start", F.col("q_start") - 0.01),
        "n": df.withColumn("q_start", F.coalesce("q_start", F.lit(0.3))), "f": df.withColumn("q_start", F.coalesce("q_start", F.lit(0.5))), "r": df.withColumn("unc_start_years", F.col("unc_start_years") + 2),
        "p": df.withColumn("p_tau", F.when(F.col("the_site") == "A", 3.0).otherwise(F.col("p_tau"))),
    }
    for key, changed in broken.items():
        status = {r.key: r.status for r in checks.all_checks(changed).collect()}
        assert status[key] == "fail", key


def test_monotonic_finds_inversions(spark):
    rows = spark.createDataFrame([("s", str(i), float(x), y) for i, (x, y) in enumerate([(1, 0.9), (2, 0.5), (3, 0.7), (4, 0.1), (4, 0.05)])], "the_site string, the_findspot string, sd double, q double")
    assert [r.label for r in checks.monotonic_violations(rows, "sd", "q", []).collect()] == ["s / 2"]
    assert [(r.label, r.y_before) for r in checks.inversions(rows, "sd", "q").collect()] == [(r.label, r.y_before) for r in checks.monotonic_violations(rows, "sd", "q", []).collect()]
    assert [r.x for r in checks.monotonic_violations_at_scale(rows, "sd", "q").collect()] == [3.0]


def test_pearson_needs_three_pairs_and_variance(spark):
    def r(rows):
        return spark.createDataFrame(rows, "x double, y double").agg(checks.pearson(F.col("x"), F.col("y"))).first()[0]

    assert r([(1.0, 2.0), (2.0, 3.0), (None, 1.0)]) is None and r([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)]) is None
    assert math.isclose(r([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (4.0, None)]), 1.0)


def test_parameters(spark, worked):
    assert checks.require_constant_parameters(worked[1]).tau == 20.0 and params_df(spark, DatingParams()).first().t0 == 20.0
    assert checks.check_columns(worked[1], ["the_id", "nothing"]).first().status == "fail"
    assert checks.check_count(worked[1], 4).first().status == "warn"


def test_scale_forms_equal_plain_ones(spark):
    """Neighbours, middle values and positions over ranges are those of one sorted list."""
    rng = random.Random(3)
    rows = [(f"s{rng.randrange(5)}", f"f{i}", rng.choice([None, float(rng.randrange(40))]), rng.choice([None, rng.random()]), rng.randrange(6)) for i in range(300)]
    df = spark.createDataFrame(rows, "the_site string, the_findspot string, sd double, q double, avg_datemin int").repartition(7)
    found = {(r.label, r.y_before) for r in checks.inversions(df, "sd", "q").collect()}
    assert found == {(r.label, r.y_before) for r in checks.monotonic_violations(df, "sd", "q", []).collect()} and len(found) > 20
    for r in checks.middles(df, "the_site", "sd").collect():
        x = sorted(v for site, _, v, *_ in rows if site == r.the_site and v is not None)
        assert (r.low, r.high) == (x[(len(x) - 1) // 2], x[len(x) // 2])
    order = {spot: i for i, (*_, spot) in enumerate(sorted((d, site, spot) for site, spot, _, _, d in rows))}
    assert {r.the_findspot: r.row for r in figures.row_position(df).collect()} == order


def test_checks_find_bad_rows(spark):
    """One broken value each; a check that a row breaks names it, the others pass."""
    df = driver_data._kept(spark, "/root/testdata/sf0.001").where("q_start is not null and q_end is not null").limit(20).cache()
    for key, change in {"c": {"k_eff": F.lit(9.0)}, "d": {"eff_end": F.col("eff_end") + 5}, "h": {"q_start": F.col("q_start") + 0.01}, "n": {"q_end": F.lit(None).cast("double")}, "f": {"unc_interval_years": F.lit(None).cast("int"), "q_interval": F.lit(0.5)}, "r": {"unc_end_years": F.col("unc_end_years") + 2}}.items():
        first = df.orderBy("the_id", "the_findspot").first()
        here = (F.col("the_id") == first.the_id) & (F.col("the_findspot") == first.the_findspot)
        status = {r.key: (r.status, r.n_offenders) for r in checks.checked(df.withColumns({c: F.when(here, v).otherwise(F.col(c)) for c, v in change.items()}), checks.row_checks()).collect()}
        assert status[key] == ("fail", 1), (key, status)
        if key in "hnfr":
            assert all(v[0] == "pass" for k, v in status.items() if k != key), status
    assert checks.verdict(checks.checked(df.withColumn("k_eff", F.lit(9.0)), checks.row_checks())).first().verdict == "error"


def test_deviation_of_half_a_year_rounds_up_in_any_order(spark):
    """Four ends whose deviation is 57.5, in all orders: a running variance rounds some of them to 57."""
    ends = [154, 128, 170, 41]
    orders = list(itertools.permutations(ends))
    obs = [(1, "A", f"s{g}", f"m{x}", "d", i, "Θ", "Σ") for g, order in enumerate(orders) for i, x in enumerate(order)]
    src = [(f"m{x}", 1000 - x, 1000 + x) for x in ends]
    df = dating.date_groups(spark.createDataFrame(obs, OBS).coalesce(1), spark.createDataFrame(src, "pottername string, datemin int, datemax int"))
    found = {tuple(r) for r in df.select("unc_start_years", "unc_end_years", "unc_start_years_exact", "sigma_eff").collect()}
    assert found == {(58, 58, 57.5, 76.747)}


def test_what_rounds_to_zero_from_below_keeps_its_sign(spark):
    x = spark.range(1).select(*[exprs.round_signed(F.lit(v), 1) for v in (-0.04, 0.04, -0.25, 0.0)]).first()
    assert [str(v) for v in x] == ["-0.0", "0.0", "-0.3", "0.0"]


def test_start_just_before_zero_reads_minus_zero(spark):
    """Middle 0.02, sigma 0.04, k 1.5: the interval is -0.04 to 0.08."""
    stats = spark.createDataFrame([("A", "x", 2, -4.0, 4.04, 1.0, 1.0, 1.4, 0.04, -4, -3, 3, 5, None, None, None, None)], "the_site string, the_findspot string, count_stamps long, _ma double, _mb double, _sa double, _sb double, _sab double, _sigma double, min_datemin int, max_datemin int, min_datemax int, max_datemax int, n_dies long, n_stamps_die long, die_repetition double, _k double")
    row = dating.project_dated(stats, DatingParams()).select(F.col("eff_start").cast("string"), F.col("eff_end").cast("string"), F.col("midpoint_year").cast("string")).first()
    assert tuple(row) == ("-0.0", "0.1", "0.02")
