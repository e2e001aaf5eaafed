"""Calibration, rank correlation, trends, digests, gates and the store of intermediate tables, against plain Python."""

import hashlib
import math
import random
import shutil

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratigraph.operators import calibration, checks, compare
from stratigraph.params import DatingParams
from stratigraph.plans import driver_data, driver_graph

P = DatingParams()
GROUP = "the_site string, the_findspot string, midpoint_year double, sigma_eff double, n_stamps_die int"


def k(n, tau):
    return round(P.k_max - (P.k_max - P.k_min) * (1 - math.exp(-n / tau)), 4)


def test_tau_is_the_least_that_covers_every_reference(spark):
    rng = random.Random(3)
    groups = [(f"s{i}", "x", round(rng.uniform(-50, 200), 3), round(rng.uniform(1, 20), 3), rng.choice([None, 1, 3, 10, 40])) for i in range(60)]
    groups += [("flat", "x", 10.0, 0.0, 5), ("flat off", "x", 10.5, 0.0, 5)]
    refs = [(s, f, int(m + sd * rng.uniform(0, 1.7))) for s, f, m, sd, _ in groups] + [("nowhere", "x", 1)]
    df, r = spark.createDataFrame(groups, GROUP), spark.createDataFrame(refs, "the_site string, the_findspot string, terminus int")
    found = {x.the_site: x for x in calibration.reference_constraints(df, r, P).collect()}
    assert found["nowhere"].status == "absent" and found["flat"].status == "free" and found["flat off"].status == "unsatisfiable"
    for (site, _, m, sd, n), (_, _, year) in zip(groups, refs):
        x, off = found[site], abs(year - m)
        if sd == 0:
            continue
        covers = lambda tau: (P.k_max if n is None else k(n, tau)) * sd >= off - 1e-9  # noqa: B023, E731
        if x.status == "free":
            assert covers(1e-3)
        elif x.status == "bound":
            assert covers(x.tau * 1.0001) and not covers(x.tau * 0.995)
        else:
            assert not covers(1e7)
    one = calibration.calibrate_tau(df, r, P).first()
    bound = [x for x in found.values() if x.status == "bound"]
    assert one.tau == max(x.tau for x in bound) and one.the_site == max(bound, key=lambda x: x.tau).the_site
    assert one.n_bound + one.n_free + one.n_unsatisfiable + one.n_absent == len(refs)
    none = calibration.calibrate_tau(df, r.where("false"), P).first()
    assert none.tau is None and none.the_site is None and none.n_bound == 0


def ranks(x):
    order = sorted(x)
    return [(order.index(v) + 1 + len(order) - order[::-1].index(v)) / 2 for v in x]


@pytest.mark.parametrize("values", [4, 1000])
def test_rank_correlation_with_ties(spark, values):
    rng = random.Random(values)
    rows = [(rng.randrange(values), rng.randrange(values)) for _ in range(300)]
    df = spark.createDataFrame([(float(a), float(a * 0.5 + b)) for a, b in rows] + [(1.0, None), (None, 2.0)], "a double, b double").repartition(6)
    x, y = zip(*[(a, a * 0.5 + b) for a, b in rows])
    got = calibration.spearman(df, F.col("a"), F.col("b")).first()
    assert got.n == 300 and got.rho == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1], abs=1e-12)


def test_rank_correlation_without_variance(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert calibration.spearman(df, F.col("a"), F.col("b")).first().rho is None
    assert calibration.spearman(df.where("false"), F.col("a"), F.col("b")).first() == (0, None)


def test_trend_of_a_line_and_of_nothing(spark):
    df = spark.createDataFrame([(float(x), 3.0 + 0.5 * x) for x in range(20)] + [(5.0, None)], "midpoint_year double, y double")
    line = calibration.trends(df, "midpoint_year", {"y": F.col("y"), "none": F.lit(None).cast("double")}).collect()
    assert (line[0].n, line[0].slope, line[0].intercept, line[0].r2, line[0].at_200) == (20, pytest.approx(0.5), pytest.approx(3), pytest.approx(1), pytest.approx(103))
    assert line[1].n == 0 and line[1].slope is None and line[1].r is None


@pytest.mark.parametrize("leaf", [3, 10, 1 << 18])
def test_digest_of_sorted_lines(spark, leaf):
    lines = [f"line {random.Random(i).random()} é" for i in range(200)] + ["", "x"]
    rows = spark.createDataFrame([(x,) for x in lines + lines[:30]], "line string").repartition(5)
    level = sorted(set(lines))
    while True:
        parts = [level[i : i + leaf] for i in range(0, len(level), leaf)]
        level = [hashlib.sha256("\n".join(p).encode()).hexdigest() for p in parts]
        if len(level) == 1:
            break
    assert compare.digest_lines(rows, leaf).first() == (len(set(lines)), level[0])


def test_digest_of_nothing(spark):
    assert compare.digest_lines(spark.createDataFrame([], "line string")).first() == (0, hashlib.sha256(b"").hexdigest())


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for t in driver_data.BASE:
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", folder)
    return folder


def test_changed_files_are_read_anew(spark, tables):
    here = str(tables)
    queries = [driver_graph.csv_round_trip, driver_graph.qry_era, driver_data.date_groups]

    def number(q):
        rows = q(spark, here).collect()
        return rows[0].n if hasattr(rows[0], "n") else len(rows)

    before = [number(q) for q in queries]
    assert before == [241, 241, 241]
    items = pq.read_table(tables / "lineitem.parquet")
    pq.write_table(items.slice(0, items.num_rows // 2), tables / "lineitem.parquet")
    assert len({number(q) for q in queries}) == 1 and number(queries[0]) < 241


def test_gates(spark):
    df = driver_data._kept(spark, "/root/testdata/sf0.001")
    keys = lambda d, **kw: [r.key for r in checks.all_checks(d, **kw).collect()]
    assert keys(df.drop("q_end")) == ["k"] and keys(df.where("false")) == ["k"]
    assert keys(df.withColumn("p_w", F.when(F.col("the_id") == 1, 2.0).otherwise(1.0)), expected=241) == ["k", "a", "p"]
    assert keys(df.withColumn("p_w", F.when(F.col("the_id") != 1, 1.0))) == ["k", "p"]
    assert sorted(keys(df)) == sorted(["k", "p", "c", "d", "h", "h'", "n", "f", "r", "i", "i'"])


@pytest.mark.parametrize("pack", [1, 40, 1 << 14])
def test_digest_of_the_whole_stream(spark, pack):
    """One SHA-256 of all distinct lines in order, across packs and ranges."""
    lines = [f"line {random.Random(i).random()} é" for i in range(300)] + ["", "x", "Z", "ﬀ", "𝄞"]
    rows = spark.createDataFrame([(x,) for x in lines + lines[:30]], "line string").repartition(5)
    wanted = hashlib.sha256("\n".join(sorted(set(lines), key=str.encode)).encode()).hexdigest()
    assert compare.digest_stream(rows, pack).first() == (len(set(lines)), wanted)
    assert compare.digest_stream(rows.where("false"), pack).first() == (0, hashlib.sha256(b"").hexdigest())
    assert compare.digest_stream(rows.where("line = ''"), pack).first() == (1, hashlib.sha256(b"").hexdigest())


def test_digest_of_more_lines_than_a_leaf(spark):
    """A graph of over 262,144 lines has the digest of its lines, not one of digests."""
    t = spark.range(270_000).select(F.concat(F.lit("s"), "id").alias("s"), F.lit("p").alias("p"), F.lit("o").alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))
    wanted = hashlib.sha256("\n".join(sorted(f"<s{i}> <p> <o> ." for i in range(270_000))).encode()).hexdigest()
    assert compare.graph_digest(t).first() == (270_000, wanted)
