"""Calibration, rank invariance, trends, epochs and digests on the driver's tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calibration as K
from ..operators import checks as C
from ..operators import compare
from .driver_data import PARAMS, _kept, _query, built
from .driver_graph import _GRAPH, _LINE, changed


def _rounded(df, digits: int = 6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# calibration: groups of every tenth site, with a year that lies more or less far from their middle, and one that isn't there
_FAR = "CAST((the_id * 7 + count_stamps) % 17 AS DOUBLE) / 10 - 0.1"
_REFERENCES = f"(SELECT the_site, the_findspot, CAST(round(midpoint_year + sigma_eff * ({_FAR})) AS INT) AS terminus FROM dated WHERE the_id % 10 = 1 UNION ALL SELECT 'nowhere', 'nothing', 10)"
_CONSTRAINTS = f"""(SELECT the_site, the_findspot, terminus, need, tau, CASE WHEN n IS NULL THEN 'absent' WHEN tau IS NULL THEN 'unsatisfiable' WHEN tau > 0 THEN 'bound' ELSE 'free' END AS status FROM (
  SELECT *, CASE WHEN n_stamps_die IS NULL THEN CASE WHEN need <= 1.5 THEN 0.0::DOUBLE END WHEN share <= 0 THEN 0.0::DOUBLE WHEN share < 1 THEN -n_stamps_die::DOUBLE / ln(share) END AS tau FROM (
    SELECT *, (need - 5e-5::DOUBLE - 0.5::DOUBLE) / (1.5::DOUBLE - 0.5::DOUBLE) AS share FROM (
      SELECT r.*, d.count_stamps AS n, d.n_stamps_die, CASE WHEN d.sigma_eff > 0 THEN ceil(abs(terminus - d.midpoint_year) / d.sigma_eff * 10000) / 10000 WHEN abs(terminus - d.midpoint_year) = 0 THEN 0 END AS need
      FROM {_REFERENCES} r LEFT JOIN dated d USING (the_site, the_findspot)))))"""


def _references(spark, sf_dir):
    far = ((F.col("the_id") * 7 + F.col("count_stamps")) % 17).cast("double") / 10 - 0.1
    rows = _kept(spark, sf_dir).where("the_id % 10 = 1").select("the_site", "the_findspot", F.round(F.col("midpoint_year") + F.col("sigma_eff") * far).cast("int").alias("terminus"))
    return rows.unionByName(spark.createDataFrame([("nowhere", "nothing", 10)], rows.schema))


@_query(f"SELECT the_site, the_findspot, terminus, round(need, 6) AS need, round(tau, 6) AS tau, status FROM {_CONSTRAINTS}")
def reference_constraints(spark, sf_dir):
    return _rounded(K.reference_constraints(_kept(spark, sf_dir), _references(spark, sf_dir), PARAMS))


@_query(f"""SELECT * FROM (WITH c AS (SELECT * FROM {_CONSTRAINTS}), b AS (SELECT * FROM c WHERE status = 'bound' ORDER BY tau DESC, the_site, the_findspot LIMIT 1)
SELECT round((SELECT max(tau) FROM c), 6) AS tau, (SELECT the_site FROM b) AS the_site, (SELECT the_findspot FROM b) AS the_findspot, count(*) FILTER (status = 'bound') AS n_bound, count(*) FILTER (status = 'free') AS n_free,
  count(*) FILTER (status = 'unsatisfiable') AS n_unsatisfiable, count(*) FILTER (status = 'absent') AS n_absent FROM c)""")
def tau_calibration(spark, sf_dir):
    """The least tau at which every satisfiable reference lies in its interval, and the group that binds it."""
    return _rounded(K.calibrate_tau(_kept(spark, sf_dir), _references(spark, sf_dir), PARAMS))


# rank invariance
def _spearman_sql(name: str, x: str, y: str) -> str:
    mid = lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"
    return f"SELECT '{name}' AS pair, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM (SELECT {mid('x')} AS rx, {mid('y')} AS ry FROM (SELECT {x} AS x, {y} AS y FROM dated) WHERE x IS NOT NULL AND y IS NOT NULL)"


@_query(" UNION ALL ".join([_spearman_sql("t0 10 and 100", "exp(-unc_start_years_exact / 10.0)", "exp(-unc_start_years_exact / 100.0)"), _spearman_sql("q_start and q_interval", "q_start", "q_interval"), _spearman_sql("stamps and dies", "count_stamps", "n_dies")]))
def rank_invariance(spark, sf_dir):
    """The order of the sharpness doesn't depend on its reference length; that of other pairs does differ, with many ties."""
    df, sd = _kept(spark, sf_dir), F.col("unc_start_years_exact")
    pairs = {"t0 10 and 100": (F.exp(-sd / 10.0), F.exp(-sd / 100.0)), "q_start and q_interval": (F.col("q_start"), F.col("q_interval")), "stamps and dies": (F.col("count_stamps"), F.col("n_dies"))}
    found = [K.spearman(df, x, y).select(F.lit(name).alias("pair"), "n", F.round("rho", 6).alias("rho")) for name, (x, y) in pairs.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


# trends, grids, epochs
_MEASURED = {"sigma_eff": "sigma_eff", "unc_start": "unc_start_years_exact", "unc_end": "unc_end_years_exact", "k_eff": "k_eff", "width": "eff_end - eff_start"}


@_query(" UNION ALL ".join(f"SELECT '{name}' AS measure, regr_count({y}, midpoint_year)::BIGINT AS n, round(regr_slope({y}, midpoint_year), 6) AS slope, round(regr_intercept({y}, midpoint_year), 6) AS intercept, round(corr({y}, midpoint_year), 6) AS r, round(regr_r2({y}, midpoint_year), 6) AS r2, round(regr_intercept({y}, midpoint_year) + regr_slope({y}, midpoint_year), 6) AS at_1, round(regr_intercept({y}, midpoint_year) + 200 * regr_slope({y}, midpoint_year), 6) AS at_200 FROM dated" for name, y in _MEASURED.items()))
def epoch_trends(spark, sf_dir):
    """Lines of deviation, factor and width over the middle year, all from one pass over the dated groups."""
    return _rounded(K.trends(_kept(spark, sf_dir), "midpoint_year", {name: F.expr(y) for name, y in _MEASURED.items()}))


@_query("""SELECT t0, round(exp(-5 / t0), 6) AS q_at_5, round(exp(-25 / t0), 6) AS q_at_25, count(*) AS n, round(avg(exp(-x / t0)), 6) AS q_mean, round(min(exp(-x / t0)), 6) AS q_min, round(max(exp(-x / t0)), 6) AS q_max, count(*) FILTER (exp(-x / t0) < 1.0::DOUBLE / 3) AS n_blurred
FROM (SELECT unc_start_years_exact AS x FROM dated UNION ALL SELECT unc_end_years_exact FROM dated), (SELECT unnest([15.0::DOUBLE, 20.0::DOUBLE, 25.0::DOUBLE, 30.0::DOUBLE]) AS t0) WHERE x IS NOT NULL GROUP BY t0""")
def reference_length_grid(spark, sf_dir):
    return _rounded(K.sharpness_grid(_kept(spark, sf_dir), ["unc_start_years_exact", "unc_end_years_exact"]))


@_query("SELECT CASE WHEN c >= 0 THEN c + 1 ELSE c END AS century, count(*) AS n FROM (SELECT CAST(floor(midpoint_year / 100) AS BIGINT) AS c FROM dated WHERE midpoint_year IS NOT NULL) GROUP BY 1")
def groups_per_century(spark, sf_dir):
    return K.groups_per_century(_kept(spark, sf_dir))


@_query(" UNION ALL ".join(f"SELECT '{name}' AS measure, midpoint_year >= 100 AS late, count({y}) AS n, round(median({y}), 6) AS median FROM dated WHERE midpoint_year IS NOT NULL AND ({y}) IS NOT NULL GROUP BY 2" for name, y in (("width", "eff_end - eff_start"), ("k_eff", "k_eff"), ("count_stamps", "count_stamps"))))
def epoch_medians(spark, sf_dir):
    return _rounded(K.epoch_medians(_kept(spark, sf_dir), {"width": F.col("eff_end") - F.col("eff_start"), "k_eff": F.col("k_eff"), "count_stamps": F.col("count_stamps")}))


# exact digest
_MASKED = rf"""regexp_replace(regexp_replace(regexp_replace(l, '"\d{{4}}-\d\d-\d\dT[^"]*"', '"TIMESTAMP"', 'g'), '(dataset_[^>]*_)\d{{4}}-\d\d-\d\d>', '\1DATE>', 'g'), '"\d{{4}}-\d\d-\d\d"', '"DATE"', 'g')"""


@_query(f"SELECT count(*) AS n, sha256(string_agg(line, chr(10) ORDER BY line)) AS sha256 FROM (SELECT DISTINCT {_MASKED} AS line FROM (SELECT {_LINE} AS l FROM {_GRAPH}))")
def graph_digest(spark, sf_dir):
    """The SHA-256 of all lines in order, as one stream."""
    return compare.graph_digest(built(spark, sf_dir))


# gates
@_query("SELECT 'k' AS key, 'pass' AS status, CAST(0 AS BIGINT) AS n_offenders, '' AS offenders UNION ALL SELECT 'p', CASE WHEN n > 1 THEN 'fail' ELSE 'pass' END, CAST(n > 1 AS BIGINT), CASE WHEN n > 1 THEN 'p_tau' ELSE '' END FROM (SELECT count(DISTINCT CASE WHEN the_id % 50 = 9 THEN 21.0 ELSE p_tau END) AS n FROM dated)")
def gated_parameters(spark, sf_dir):
    """Rows with two values of a parameter: nothing after the gate is reported."""
    df = changed(spark, sf_dir).withColumn("p_tau", F.when(F.col("the_id") % 50 == 9, 21.0).otherwise(F.col("p_tau")))
    return C.all_checks(df).select("key", "status", "n_offenders", F.array_join("offenders", " | ").alias("offenders"))


@_query("SELECT 'k' AS key, 'fail' AS status, CAST(1 AS BIGINT) AS n_offenders, 'missing: k_eff' AS detail WHERE (SELECT count(*) FROM dated) > 0")
def gated_columns(spark, sf_dir):
    """Rows without a column that the checks read: only that is reported."""
    return C.all_checks(changed(spark, sf_dir).drop("k_eff")).select("key", "status", "n_offenders", "detail")

