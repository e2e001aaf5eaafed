"""Named queries over the graph of dated groups (see operators.triples)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import patterns as P
from ..operators.entailment import count_instances
from ..operators.triples import FIGURE_CONSTANTS
from ..params import CRM, DCAT, DCTERMS, LABEL, PROV, SKOS, TIME, TYPE, Names

_WITHIN, _SPAN = CRM + "P89_falls_within", CRM + "P4_has_time-span"


def _number(c: str):
    return F.col(c).try_cast("double")


def _spots(t: P.Triples, n: Names) -> DataFrame:
    """fs, findspot, p, site, ts of every group."""
    return P.bgp(t, [("?fs", TYPE, n.vocab + "Findspot"), ("?fs", LABEL, "?findspot"), ("?fs", _WITHIN, "?p"), ("?fs", _SPAN, "?ts"), ("?p", LABEL, "?site")])


def _edge(t: P.Triples, link: str, name: str) -> DataFrame:
    return P.seq_path(t, "ts", [TIME + link, TIME + "inTimePosition", TIME + "numericPosition"], name).withColumn(name, _number(name))


def dated_findspots(t: P.Triples, n: Names = Names()) -> DataFrame:
    spans = P.star(t, {"qInterval": n.vocab + "qInterval", "nStamps": n.vocab + "nStamps", "order": n.vocab + "avgDatemin"}, subject="ts")
    b = _spots(t, n).join(_edge(t, "hasBeginning", "from"), "ts").join(_edge(t, "hasEnd", "to"), "ts").join(P.unsent(t, spans), "ts")
    b = P.bind(b, "span", F.col("to") - F.col("from")).withColumns({"qInterval": _number("qInterval"), "nStamps": _number("nStamps").cast("long"), "order": _number("order")})
    return b.orderBy("order", "site", "findspot").select("site", "findspot", "from", "to", "span", "qInterval", "nStamps")


def crm_only(t: P.Triples) -> DataFrame:
    """Public classes and bounds alone; needs materialised types."""
    b = P.bgp(t, [("?fs", TYPE, CRM + "E53_Place"), ("?fs", LABEL, "?findspot"), ("?fs", _WITHIN, "?p"), ("?p", LABEL, "?place"), ("?p", TYPE, CRM + "E53_Place"), ("?fs", _SPAN, "?ts"), ("?ts", TYPE, CRM + "E52_Time-Span"), ("?ts", CRM + "P82a_begin_of_the_begin", "?from"), ("?ts", CRM + "P82b_end_of_the_end", "?to")])
    return b.orderBy(F.col("from").try_cast("int"), "place", "findspot").select("place", "findspot", "from", "to")


def era_and_scale(t: P.Triples, n: Names = Names()) -> DataFrame:
    b = _spots(t, n).join(P.bgp_of_hubs(t, [("?ts", TIME + "hasBeginning", "?inst"), ("?inst", TIME + "inXSDgYear", "?calendar"), ("?inst", TIME + "inTimePosition", "?pos"), ("?pos", TIME + "numericPosition", "?numeric"), ("?pos", TIME + "hasTRS", "?trs"), ("?trs", LABEL, "?scale")]), "ts")
    return P.where_num(b, "numeric", "<", 0).withColumn("numeric", _number("numeric")).orderBy("numeric", "site", "findspot").select("site", "findspot", "numeric", "calendar", "scale")


def two_quality_axes(t: P.Triples, n: Names = Names(), sharp: float = 0.55, repeated: float = 0.2) -> DataFrame:
    spans = P.star(t, {k: n.vocab + k for k in ("qInterval", "qRepetition", "nStamps", "nDies", "dieRepetition")}, subject="ts")
    b = _spots(t, n).join(P.unsent(t, P.where_num(P.where_num(spans, "qInterval", ">", sharp), "qRepetition", "<", repeated)), "ts")
    return b.select("site", "findspot", _number("qInterval").alias("qInterval"), _number("qRepetition").alias("qRepetition"), _number("nStamps").cast("long").alias("nStamps"), _number("nDies").cast("long").alias("nDies"), _number("dieRepetition").alias("repetition")).orderBy(F.desc("qInterval"), "site", "findspot")


def findspots_per_site(t: P.Triples, n: Names = Names(), most: int = 1000) -> DataFrame:
    """site, findspots, part, names: a site's names in rows of `most`, as one row would grow with its groups."""
    b = _spots(t, n)
    counts = P.count_distinct_by(b, ["site"], "fs", "findspots", having=1)
    names = P.group_concat_parts(b.join(counts, "site", "left_semi"), ["site"], "findspot", " · ", most)
    return counts.join(names, "site").orderBy(F.desc("findspots"), "site", "part")


def external_identifiers(t: P.Triples, n: Names = Names()) -> DataFrame:
    counts = P.count_distinct_by(P.bgp(t, [("?fs", TYPE, n.vocab + "Findspot"), ("?fs", _WITHIN, "?p")]), ["p"], "fs", "findspots")
    b = P.join_subselect(P.unsent(t, P.match(t, ("?p", LABEL, "?site"))), counts)
    b = P.optional(b, t, [("?p", n.vocab + "ancientName", "?ancientName")])
    b = P.optional(b, t, [("?p", n.vocab + "pleiadesID", "?pleiades")])
    return b.orderBy("site").select("site", "ancientName", "pleiades", "findspots")


def provenance(t: P.Triples, n: Names = Names()) -> DataFrame:
    model = P.star(t, {"model": LABEL, "kMin": n.vocab + "kMin", "kMax": n.vocab + "kMax", "tau": n.vocab + "tau", "t0": n.vocab + "referenceLength", "w": n.vocab + "volumeWeight", "era": n.vocab + "eraConvention"}, subject="m")
    datings = P.bgp_of_hubs(t, [("?ts", TYPE, n.vocab + "FindspotDating"), ("?ts", PROV + "wasGeneratedBy", "?act"), ("?act", CRM + "P33_used_specific_technique", "?m"), ("?act", CRM + "P14_carried_out_by", "?agent"), ("?agent", LABEL, "?software")])
    # summed before the excluded values multiply the datings
    counts = P.count_distinct_by(datings, ["m", "software"], "ts", "datings")
    excluded = P.group_concat(P.match(t, ("?m", n.vocab + "excludedDatemax", "?ex")), ["m"], "ex", ", ", distinct=True, name="excludedDatemax")
    return counts.join(model, "m").join(excluded, "m").select("software", "model", "kMin", "kMax", "tau", "t0", "w", "era", "excludedDatemax", "datings")


def figure_constants(t: P.Triples, n: Names = Names()) -> DataFrame:
    out = P.star(t, {k: n.vocab + k for k in FIGURE_CONSTANTS}).join(P.match(t, ("?s", TYPE, n.vocab + "Figure")), "s", "left_semi")
    if out.isEmpty():
        raise ValueError("the graph has no figure")
    return out.drop("s")


#: (variable, published column) of a row of the figure.
FIELD_PAIRS = [
    ("effStart", "eff_start"), ("effEnd", "eff_end"), ("qInterval", "q_interval"), ("qStart", "q_start"), ("qEnd", "q_end"), ("qRepetition", "q_repetition"),
    ("uncStartYears", "unc_start_years"), ("uncEndYears", "unc_end_years"), ("uncIntervalYears", "unc_interval_years"),
    ("minDatemin", "min_datemin"), ("maxDatemax", "max_datemax"), ("maxDatemin", "max_datemin"), ("minDatemax", "min_datemax"),
    ("nStamps", "count_stamps"), ("nDies", "n_dies"), ("avgDatemin", "avg_datemin"), ("avgDatemax", "avg_datemax"), ("sigmaYears", "sigma_eff"), ("kFactor", "k_eff"),
]
_SPAN_NEEDS = ["minDatemin", "maxDatemax", "maxDatemin", "minDatemax", "nStamps", "avgDatemin", "avgDatemax", "sigmaYears", "kFactor"]
_SPAN_MAY = ["nDies", "qInterval", "qStart", "qEnd", "qRepetition"]
_ROW_MAY = ["uncStartYears", "uncEndYears", "uncIntervalYears"]


def figure_rows(t: P.Triples, n: Names = Names()) -> DataFrame:
    """site, findspot and 19 numbers of each row of the figure. Groups without a die are rows too."""
    spans = P.star(t, {k: n.vocab + k for k in _SPAN_NEEDS}, {k: n.vocab + k for k in _SPAN_MAY}, subject="ts")
    rows = P.star(t, {"ts": n.vocab + "renders"}, {k: n.vocab + k for k in _ROW_MAY}, subject="row")
    b = P.bgp(t, [("?fs", _SPAN, "?ts"), ("?fs", LABEL, "?findspot"), ("?fs", _WITHIN, "?place"), ("?place", LABEL, "?site")])
    b = b.join(P.unsent(t, rows), "ts").join(P.unsent(t, spans), "ts").join(_edge(t, "hasBeginning", "effStart"), "ts").join(_edge(t, "hasEnd", "effEnd"), "ts")
    return b.select("site", "findspot", *[_number(v).alias(v) for v, _ in FIELD_PAIRS])


def era(t: P.Triples, n: Names = Names()) -> str:
    row = P.bgp(t, [("?m", TYPE, n.vocab + "DatingModel"), ("?m", n.vocab + "eraConvention", "?era")]).select("era").first()
    return row.era if row else "historical"


def model(t: P.Triples, n: Names = Names()) -> DataFrame:
    return P.star(t, {"kMin": n.vocab + "kMin", "kMax": n.vocab + "kMax", "tau": n.vocab + "tau", "w": n.vocab + "volumeWeight"}).drop("s")


def crm_path_count(t: P.Triples) -> DataFrame:
    return P.count_solutions(P.seq_path(t, "fs", [_SPAN, TIME + "hasBeginning", TIME + "inTimePosition", TIME + "numericPosition"], "year"))


def one_instance(t: P.Triples, label: str, n: Names = Names()) -> DataFrame:
    b = P.where_contains(_spots(t, n), "findspot", label)
    return P.limit_n(b.join(_edge(t, "hasBeginning", "from"), "ts").join(_edge(t, "hasEnd", "to"), "ts"), 1, "site", "findspot")


def earliest_negative_start(t: P.Triples, n: Names = Names()) -> DataFrame:
    return era_and_scale(t, n).limit(1)


def link_counts(t: P.Triples, n: Names = Names()) -> DataFrame:
    """n_sites, n_groups, n_linked."""
    b = _spots(t, n).agg(F.count_distinct("p").alias("n_sites"), F.count_distinct("fs").alias("n_groups"))
    return b.crossJoin(P.match(t, ("?p", n.vocab + "pleiadesID", "?id")).agg(F.count_distinct("p").alias("n_linked")))


def cut_templates(n: Names = Names()) -> dict[str, P.Template]:
    """The four cuts around groups (variable fs): the group with its span, place and row; the way from the span's start to
    its number; where the dating comes from; the group's types."""
    v, begin, end = n.vocab, TIME + "hasBeginning", TIME + "hasEnd"
    of_span = [("?ts", v + "nStamps", "?n"), ("?ts", v + "sigmaYears", "?sigma"), ("?ts", v + "kFactor", "?k"), ("?ts", v + "qInterval", "?qi"), ("?ts", begin, "?begin"), ("?ts", end, "?end")]
    spot = [("?fs", LABEL, "?fsLabel"), ("?fs", _WITHIN, "?place"), ("?fs", _SPAN, "?ts"), ("?place", LABEL, "?placeLabel")]
    dates = [("?begin", TIME + "inXSDgYear", "?gyB"), ("?end", TIME + "inXSDgYear", "?gyE")]
    row = [("?row", v + "renders", "?ts"), ("?row", v + "uncStartYears", "?uncS")]
    kinds = [("?fs", TYPE, v + "Findspot"), ("?place", TYPE, v + "DiscoverySite"), ("?ts", TYPE, v + "FindspotDating"), ("?begin", TYPE, TIME + "Instant"), ("?end", TYPE, TIME + "Instant"), ("?row", TYPE, v + "PlotRow")]
    chain = [("?ts", begin, "?i"), ("?ts", CRM + "P82a_begin_of_the_begin", "?bb"), ("?i", TIME + "inTimePosition", "?p"), ("?i", TIME + "inXSDgYear", "?gy"), ("?p", TIME + "numericPosition", "?np"), ("?p", TIME + "hasTRS", "?trs"), ("?trs", LABEL, "?trsLabel")]
    match_ = ("?trs", SKOS + "closeMatch", "?greg")
    source = [("?ts", PROV + "wasGeneratedBy", "?act"), ("?ts", PROV + "wasDerivedFrom", "?ds"), ("?act", CRM + "P33_used_specific_technique", "?m"), ("?act", CRM + "P14_carried_out_by", "?ag"), ("?ag", LABEL, "?agLabel"), ("?ds", DCTERMS + "title", "?dsTitle")]
    model_ = [("?m", v + p, f"?{p}") for p in ("kMin", "kMax", "tau", "referenceLength", "eraConvention")]
    to_span = [("?fs", _SPAN, "?ts")]
    return {
        "group": P.Template([*spot, *of_span, *dates, *row], [], [*spot, *of_span, *dates, *row, *kinds]),
        "time-chain": P.Template([*to_span, *chain], [[match_]], [*chain, match_, ("?i", TYPE, TIME + "Instant"), ("?p", TYPE, TIME + "TimePosition"), ("?trs", TYPE, TIME + "TRS")]),
        "provenance": P.Template([*to_span, *source, *model_], [], [
            *source, *model_, ("?act", PROV + "used", "?m"), ("?act", PROV + "used", "?ds"), ("?act", PROV + "wasAssociatedWith", "?ag"),
            ("?ts", TYPE, v + "FindspotDating"), ("?act", TYPE, v + "DatingActivity"), ("?m", TYPE, v + "DatingModel"), ("?ag", TYPE, PROV + "SoftwareAgent"), ("?ds", TYPE, DCAT + "Dataset"),
        ]),
        "types": P.Template([("?fs", LABEL, "?label"), ("?fs", TYPE, "?cls")], [], [("?fs", TYPE, "?cls"), ("?fs", LABEL, "?label")]),
    }


def cuts(t: P.Triples, seeds: DataFrame, name: str, n: Names = Names()) -> DataFrame:
    """fs and the triples of one of the cuts around each group of `seeds` (fs). Seeds without one are left out."""
    return P.construct_for(t, seeds.select("fs"), cut_templates(n)[name])


# the ways along some predicates from one group
def cut_group(t: P.Triples, seed: str, n: Names = Names()) -> DataFrame:
    return P.cut(t, lambda g: P.reachable(g, seed, [TYPE, LABEL, _WITHIN, _SPAN], 2))


def cut_time_chain(t: P.Triples, seed: str, n: Names = Names()) -> DataFrame:
    return P.cut(t, lambda g: P.reachable(g, seed, [_SPAN, TIME + "hasBeginning", TIME + "hasEnd", TIME + "inTimePosition", TIME + "numericPosition", TIME + "inXSDgYear", TIME + "hasTRS"], 4))


def cut_provenance(t: P.Triples, seed: str, n: Names = Names()) -> DataFrame:
    return P.cut(t, lambda g: P.reachable(g, seed, [_SPAN, PROV + "wasGeneratedBy", PROV + "wasDerivedFrom", PROV + "used", PROV + "wasAssociatedWith", CRM + "P33_used_specific_technique", CRM + "P14_carried_out_by"], 3))


def cut_types(t: P.Triples, seed: str, n: Names = Names()) -> DataFrame:
    return P.cut(t, lambda g: P.reachable(g, seed, [TYPE, _SPAN], 2).where(F.col("p") == TYPE))


CATALOGUE: dict[str, Callable[[P.Triples], DataFrame]] = {
    "dated-findspots": dated_findspots, "crm-only": crm_only, "era-and-scale": era_and_scale, "two-quality-axes": two_quality_axes,
    "findspots-per-site": findspots_per_site, "external-identifiers": external_identifiers, "provenance": provenance,
}


def require_non_empty(t: P.Triples, catalogue: dict[str, Callable[[P.Triples], DataFrame]] = CATALOGUE) -> list[str]:
    """Names of the queries; one without a row is an error."""
    if empty := [name for name, query in catalogue.items() if query(t).isEmpty()]:
        raise ValueError(f"no rows: {', '.join(empty)}")
    return list(catalogue)


def class_counts(t: DataFrame, classes: list[str]) -> DataFrame:
    return count_instances(t, classes)
