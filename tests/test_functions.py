import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from stratigraph.functions import exprs as X
from stratigraph.functions.profiles import spread_profile
from stratigraph.functions.text import short_hash, slug


def values(spark, column, rows, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}").orderBy("i").select(column(F.col("c"))).collect()]


def test_parse(spark):
    assert values(spark, X.parse_num, ["1.5", " 2 ", "", "NULL", "nan", "x", None]) == [1.5, 2.0, None, None, None, None, None]
    assert values(spark, X.parse_flag, ["t", "TRUE", " Yes", "f", "0", "NULL", None]) == [True, True, True, False, False, None, None]


def test_rounding(spark):
    assert values(spark, X.round_half_even, [2.5, -16.5, 3.5], "double") == [2.0, -16.0, 4.0]
    assert values(spark, X.as_int, [2.5, -2.5, 2.7, None], "double") == [3, -3, 3, None]


def test_years(spark):
    assert values(spark, X.gyear, [-15.0, -2.8, -16.6, 79.2, 0.0], "double") == ["-0014", "-0002", "-0016", "0079", "0000"]
    assert values(spark, lambda c: X.gyear(c, "astronomical"), [-15.0], "double") == ["-0015"]
    assert values(spark, X.year_label, [-15.0, 0.0, 79.0], "double") == ["15 BC", "1 BC", "AD 79"]
    assert values(spark, lambda c: X.year_label(c, "astronomical"), [-15.0, 0.0], "double") == ["16 BC", "0"]


def test_lexical(spark):
    assert values(spark, X.decimal_lexical, [6.0, 0.5011, 0.0005, 1.5e8, None], "double") == ["6.0", "0.5011", "0.0005", "150000000.0", None]
    assert values(spark, lambda c: X.external_id(c, "b/"), ["109321.0", None]) == ["b/109321", None]
    assert values(spark, lambda c: X.truncate_text(c, 5), ["a  b", "abcdefg"]) == ["a b", "abcd…"]
    assert values(spark, X.local_name, ["http://a/b#c", "http://a/b/d"]) == ["c", "d"]
    assert values(spark, lambda c: X.qname(c, {"a": "http://a/"}), ["http://a/x", "http://b/x"]) == ["a:x", "http://b/x"]


def test_slug(spark):
    assert values(spark, slug, ["Emmeranstraße", "Köln", " Ångström  Ø ", "é è", "梦", "", None]) == ["emmeranstrasse", "koeln", "aangstroem_oe", "e_e", "unknown", "unknown", None]


def test_hash_composes_names(spark):
    names = ["Sq. Bocquet pit 1973", "Köln", unicodedata.normalize("NFD", "Köln"), " Köln "]
    found = values(spark, short_hash, names)
    assert found[0] == "969c47" and len(set(found[1:])) == 1
    assert found[1] == hashlib.sha256("Köln".encode()).hexdigest()[:6]


def test_bands_keep_null_apart(spark):
    assert values(spark, X.quality_band, [None, 0.9, 0.8, 0.5, 0.1], "double") == ["undefined", "high", "high", "medium", "low"]
    assert values(spark, X.repetition_band, [None, 0.0, 0.2, 0.3, 0.7], "double") == ["undefined", "none", "low", "medium", "high"]


def test_profile(spark):
    df = spark.createDataFrame([(0.0, 10.0, 4.0, 2.0), (5.0, 5.0, 5.0, 0.0), (0.0, 10.0, 0.0, 50.0)], "a double, b double, m double, sd double")
    for r in spread_profile(df, F.col("a"), F.col("b"), F.col("m"), F.col("sd")).select("*", "profile.*").collect():
        step = r.xs[1] - r.xs[0]
        assert len(r.xs) == 400 and r.density[0] == r.density[-1] == 0 and sum(r.density) * step == pytest.approx(1)
    first = spread_profile(df, F.col("a"), F.col("b"), F.col("m"), F.col("sd")).select("*", "profile.*").first()
    assert sum(x * d for x, d in zip(first.xs, first.density)) * (first.xs[1] - first.xs[0]) == pytest.approx(4.0, abs=0.05)
