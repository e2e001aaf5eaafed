"""Scalar column expressions: parsing, rounding, calendar, term and band functions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import XSD


def norm_key(c: Column) -> Column:
    """Join key of a name: trimmed, lower case."""
    return F.lower(F.trim(c))


def parse_num(c: Column) -> Column:
    """Number of a text; empty, NULL, NaN (any case) and what doesn't parse are null."""
    t = F.trim(c)
    return F.when(~F.upper(t).isin("", "NULL", "NAN"), F.nanvl(t.try_cast("double"), F.lit(None).cast("double")))


def parse_flag(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return F.when(t.isin("t", "true", "1", "y", "yes"), True).when(t.isin("f", "false", "0", "n", "no"), False)


def round_half_even(c: Column) -> Column:
    return F.bround(c, 0)


def round_half_away(c: Column, n: int = 0) -> Column:
    return F.round(c, n)


def round_signed(c: Column, n: int) -> Column:
    """Half away from zero; below zero what rounds to zero is -0.0, which Spark's own rounding loses."""
    r = F.round(c, n)
    return F.when((r == 0) & (c < 0), F.lit(-0.0)).otherwise(r)


def as_int(c: Column) -> Column:
    """Half away from zero, as a numeric cast rounds (a plain cast would truncate)."""
    return F.round(c, 0).cast("int")


def gyear(c: Column, era: str = "historical") -> Column:
    """Calendar year: half-even rounding; historical years before 0 move up by one (1 BC is year 0); four digits."""
    y = F.bround(c, 0).cast("long")
    if era == "historical":
        y = F.when(y < 0, y + 1).otherwise(y)
    return F.concat(F.when(y < 0, "-").otherwise(""), F.lpad(F.abs(y).cast("string"), 4, "0"))


def year_label(c: Column, era: str = "historical") -> Column:
    """`n BC` or `AD n`. Historical: year 0 reads 1 BC; astronomical: year 0 reads 0, earlier ones count one more."""
    y = F.bround(c, 0).cast("long")
    if era == "historical":
        return F.when(y < 0, F.concat(F.abs(y).cast("string"), F.lit(" BC"))).when(y == 0, "1 BC").otherwise(F.concat(F.lit("AD "), y.cast("string")))
    return F.when(y < 0, F.concat((F.abs(y) + 1).cast("string"), F.lit(" BC"))).when(y == 0, "0").otherwise(F.concat(F.lit("AD "), y.cast("string")))


def decimal_lexical(c: Column) -> Column:
    """Shortest decimal without an exponent; whole numbers end in .0."""
    d = c.cast("double")
    plain = d.cast("string")
    wide = F.regexp_replace(F.regexp_replace(d.cast("decimal(38,12)").cast("string"), "0+$", ""), "\\.$", ".0")
    return F.when(plain.contains("E"), wide).otherwise(plain)


def integer_lexical(c: Column) -> Column:
    return c.cast("long").cast("string")


def external_id(c: Column, base: str) -> Column:
    """`109321.0` becomes base + `109321`."""
    return F.concat(F.lit(base), parse_num(c.cast("string")).cast("long").cast("string"))


def wkt_point(lon: Column, lat: Column) -> Column:
    return F.when(lon.isNotNull() & lat.isNotNull(), F.concat(F.lit("<http://www.opengis.net/def/crs/EPSG/0/4326> POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")))


def qname(c: Column, prefixes: dict[str, str]) -> Column:
    """Prefix form by the first namespace that fits, else the IRI itself."""
    out = c
    for p, ns in reversed(list(prefixes.items())):
        out = F.when(c.startswith(ns), F.concat(F.lit(p + ":"), F.substring(c, len(ns) + 1, 1 << 20))).otherwise(out)
    return out


def local_name(c: Column) -> Column:
    """What follows the last #, or the last / where there is none."""
    return F.when(c.contains("#"), F.substring_index(c, "#", -1)).otherwise(F.substring_index(c, "/", -1))


def truncate_text(c: Column, n: int = 46) -> Column:
    t = F.trim(F.regexp_replace(c, "\\s+", " "))
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n - 1), F.lit("…"))).otherwise(t)


def normalise_snapshot(line: Column) -> Column:
    """Masks what changes with each export: timestamps, dataset IRIs with a date, date and version literals."""
    line = F.regexp_replace(line, r'"\d{4}-\d\d-\d\dT[^"]*"', '"TIMESTAMP"')
    line = F.regexp_replace(line, r"(dataset_[^>]*_)\d{4}-\d\d-\d\d>", "$1DATE>")
    return F.regexp_replace(line, r'"\d{4}-\d\d-\d\d"', '"DATE"')


_NOT_IN_IRI = r'[\x00-\x20<>"{}|^`\\]'


def iri_text(c: Column) -> Column:
    """N-Triples text of an IRI; characters that may not stand in one are escaped."""
    safe = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.rlike(_NOT_IN_IRI), F.format_string("\\u%04X", F.ascii(x))).otherwise(x)), "")
    return F.concat(F.lit("<"), F.when(c.rlike(_NOT_IN_IRI), safe).otherwise(c), F.lit(">"))


def escape_literal(c: Column) -> Column:
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def term_text(o: Column, kind: Column, dt: Column, lang: Column) -> Column:
    """N-Triples text of a term."""
    literal = F.concat(F.lit('"'), escape_literal(o), F.lit('"'))
    tail = F.when(lang.isNotNull(), F.concat(F.lit("@"), lang)).when(dt.isNotNull() & (dt != XSD + "string"), F.concat(F.lit("^^"), iri_text(dt))).otherwise("")
    return F.when(kind == "iri", iri_text(o)).when(kind == "bnode", o).otherwise(F.concat(literal, tail))


def quality_band(q: Column) -> Column:
    return F.when(q.isNull(), "undefined").when(q >= 0.8, "high").when(q >= 0.5, "medium").otherwise("low")


def repetition_band(q: Column) -> Column:
    return F.when(q.isNull(), "undefined").when(q <= 0, "none").when(q < 0.3, "low").when(q < 0.6, "medium").otherwise("high")


def width_band(w: Column) -> Column:
    return F.when(w.isNull(), "undefined").when(w < 20, "narrow").when(w <= 50, "medium").otherwise("wide")


def group_label(site: Column, spot: Column) -> Column:
    """`site / spot`, or the site alone where the spot is blank."""
    return F.when(F.coalesce(F.trim(spot), F.lit("")) != "", F.concat_ws(" / ", site, spot)).otherwise(site)


def inside_interval(x: Column, start: Column, end: Column) -> Column:
    return x.between(start, end)
