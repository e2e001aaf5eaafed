"""More operators on the driver's tables, with the same in SQL: the graph itself, what is read off it, sources and sinks,
terms, and checks on rows that are really wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import checks as C
from ..operators import compare, entailment, figures
from ..operators import patterns as P
from ..operators import triples as G
from ..operators import vocabulary as V
from ..params import CRM, CRMDIG, DCAT, DCTERMS, GEO, LABEL, OWL, PROV, RDFS, SKOS, TIME, TYPE, XSD
from ..sources import readers, writers
from ..sources.scratch import scratch_path
from . import catalogue as Q
from .driver_data import ABOUT, AT, PARAMS, N, _edges, _gyear_sql, _kept, _query, _table, _tree, built, dated, graph, graph_of_groups

DATE = AT[:10]
DATASET = f"{N.data}dataset_sites_{DATE}"


def _iri(s: str, p: str, o: str) -> str:
    return f"{{'s': {s}, 'p': '{p}', 'o': {o}, 'o_kind': 'iri', 'o_dt': CAST(NULL AS VARCHAR), 'o_lang': CAST(NULL AS VARCHAR)}}"


def _lit(s: str, p: str, o: str, dt: str | None = None, lang: str | None = None) -> str:
    quoted = lambda x: f"'{x}'" if x else "CAST(NULL AS VARCHAR)"
    return f"{{'s': {s}, 'p': '{p}', 'o': CAST({o} AS VARCHAR), 'o_kind': 'lit', 'o_dt': {quoted(dt)}, 'o_lang': {quoted(lang)}}}"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _graph_sql() -> str:
    """The statements of a dated group and of the whole, one list each."""
    v, d = N.vocab, N.data
    place, spot, span, row, act = f"'{d}loc_ds_' || the_id", f"'{d}fs_' || key", f"'{d}ts_' || key", f"'{d}plotrow_' || key", f"'{d}act_dating_' || key"
    whole = lambda c: f"CAST(CAST(round_even({c}, 0) AS BIGINT) AS VARCHAR)"
    slug = "lower(trim(regexp_replace(trim(the_findspot), '[^A-Za-z0-9]+', '_', 'g'), '_'))"
    out = [
        _iri(spot, TYPE, _q(v + "Findspot")), _lit(spot, LABEL, "the_findspot"), _lit(spot, SKOS + "notation", slug), _iri(spot, CRM + "P89_falls_within", place), _iri(spot, CRM + "P4_has_time-span", span),
        _iri(span, TYPE, _q(v + "FindspotDating")), _lit(span, LABEL, f"the_site || ' — ' || the_findspot || ': ' || {whole('eff_start')} || ' to ' || {whole('eff_end')}", lang="en"), _iri(span, PROV + "wasGeneratedBy", act),
        _lit(span, CRM + "P82a_begin_of_the_begin", _gyear_sql("eff_start"), XSD + "gYear"), _lit(span, CRM + "P82b_end_of_the_end", _gyear_sql("eff_end"), XSD + "gYear"),
        _lit(span, v + "intervalLabel", "avg_interval"), _lit(span, v + "kIsFallback", "k_is_fallback", XSD + "boolean"),
        _iri(row, TYPE, _q(v + "PlotRow")), _iri(row, v + "renders", span), _iri(_q(d + "fig_sites"), v + "hasRow", row),
        _iri(act, TYPE, _q(PROV + "Activity")), _iri(act, TYPE, _q(v + "DatingActivity")), _lit(act, LABEL, "'Dating of ' || the_site || ' — ' || the_findspot", lang="en"),
        _iri(act, PROV + "wasAssociatedWith", _q(d + "exporter")), _lit(act, PROV + "endedAtTime", _q(AT), XSD + "dateTime"), _iri(act, PROV + "used", _q(DATASET)), _iri(act, PROV + "used", _q(d + "DatingModel_v1")),
        _iri(act, CRM + "P33_used_specific_technique", _q(d + "DatingModel_v1")), _iri(act, CRM + "P14_carried_out_by", _q(d + "exporter")), _iri(span, PROV + "wasDerivedFrom", _q(DATASET)),
        _lit(place, LABEL, "the_site", lang="en"), _lit(place, v + "ancientName", "CASE WHEN the_id % 3 = 0 THEN 'Vicus ' || the_site END"), _iri(place, v + "pleiadesID", f"CASE WHEN the_id % 2 = 0 THEN '{N.external_ids}' || the_id * 100 END"),
    ]
    shape = f"CASE WHEN the_id % 4 <> 0 THEN {place} || '_geom' END"
    out += [_iri(place, GEO + "hasGeometry", shape), _lit(shape, GEO + "asWKT", "'<http://www.opengis.net/def/crs/EPSG/0/4326> POINT(' || CAST(the_id / 2 AS DOUBLE) || ' ' || CAST(the_id % 90 AS DOUBLE) || ')'", GEO + "wktLiteral")]
    out += [_iri("CASE WHEN the_id % 10 = 1 THEN " + _q(d + "DatingModel_v1") + " END", v + "calibratedAgainst", spot)]
    for edge, link, value in (("begin", "hasBeginning", "eff_start"), ("end", "hasEnd", "eff_end")):
        instant, position = f"{span} || '_{edge}'", f"{span} || '_{edge}_pos'"
        out += [
            _iri(span, TIME + link, instant), _iri(instant, TYPE, _q(TIME + "Instant")), _iri(instant, TYPE, _q(v + "DatingInstant")), _iri(instant, TIME + "inTimePosition", position), _lit(instant, TIME + "inXSDgYear", _gyear_sql(value), XSD + "gYear"),
            _iri(position, TYPE, _q(TIME + "TimePosition")), _iri(position, TYPE, _q(v + "DatingTimePosition")), _iri(position, TIME + "hasTRS", _q(d + "trs_year")), _lit(position, TIME + "numericPosition", value, XSD + "decimal"),
        ]
    for subject, measures in ((span, G.MEASURES), (row, G.ROW_MEASURES)):
        for prop, column, dt in measures:
            out += [_lit(subject, v + prop, column, dt), _iri(f"CASE WHEN {column} IS NULL THEN {subject} END", v + "undefinedMeasure", _q(v + prop))]
    agent, model, fig, scale = (_q(d + x) for x in ("exporter", "DatingModel_v1", "fig_sites", "trs_year"))
    ds = _q(DATASET)
    once = [
        _iri(agent, TYPE, _q(PROV + "SoftwareAgent")), _iri(agent, TYPE, _q(CRMDIG + "D14_Software")), _lit(agent, LABEL, "'exporter'", lang="en"),
        _iri(scale, TYPE, _q(TIME + "TRS")), _iri(scale, TYPE, _q(v + "YearScale")), _lit(scale, LABEL, "'signed year scale'", lang="en"), _iri(scale, SKOS + "closeMatch", "'http://www.opengis.net/def/uom/ISO-8601/0/Gregorian'"),
        _iri(model, TYPE, _q(v + "DatingModel")), _lit(model, LABEL, "'dating model'", lang="en"), _lit(model, v + "fuzzinessDivisor", "12", XSD + "integer"), _lit(model, v + "eraConvention", "'historical'"),
        *[_lit(model, v + k, f"'{x}'", XSD + "decimal") for k, x in (("kMin", "0.5"), ("kMax", "1.5"), ("tau", "20.0"), ("volumeWeight", "1.0"), ("referenceLength", "20.0"))], *[_lit(model, v + "excludedDatemax", str(x), XSD + "integer") for x in (260, 120, 150)],
        *[_iri(ds, TYPE, _q(x)) for x in (DCAT + "Dataset", PROV + "Entity", CRMDIG + "D1_Digital_Object")], _iri(ds, PROV + "wasAttributedTo", agent),
        _lit(ds, DCTERMS + "created", _q(AT), XSD + "dateTime"), _lit(ds, DCTERMS + "issued", _q(DATE), XSD + "date"), _lit(ds, OWL + "versionInfo", _q(DATE)),
        _lit(ds, DCTERMS + "title", _q(ABOUT["title"]), lang="en"), _lit(ds, DCTERMS + "rights", _q(ABOUT["rights"]), lang="en"), _lit(ds, DCTERMS + "publisher", _q(ABOUT["publisher"])), _iri(ds, DCTERMS + "license", _q(ABOUT["license"])), _lit(model, v + "calibrationBasis", _q(ABOUT["basis"]), lang="en"),
        _iri(fig, TYPE, _q(v + "Figure")), _lit(fig, LABEL, "'Dated groups'", lang="en"), _iri(fig, DCTERMS + "isPartOf", ds), _iri(fig, RDFS + "seeAlso", ds),
        *[_lit(fig, v + k, f"'{x}'", {int: XSD + "integer", float: XSD + "decimal", str: None}[type(x)]) for k, x in G.FIGURE_CONSTANTS.items()],
    ]
    return f"""(SELECT DISTINCT t.* FROM (SELECT unnest([{', '.join(out)}]) AS t FROM dated WHERE the_id IS NOT NULL UNION ALL SELECT unnest([{', '.join(once)}])) WHERE t.s IS NOT NULL AND t.o IS NOT NULL)"""


_GRAPH = _graph_sql()
_TERM = """CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE '"' || o || '"' || CASE WHEN o_lang IS NOT NULL THEN '@' || o_lang WHEN o_dt IS NOT NULL THEN '^^<' || o_dt || '>' ELSE '' END END"""
_LINE = f"'<' || s || '> <' || p || '> ' || {_TERM} || ' .'"


@_query(f"SELECT * FROM {_GRAPH}")
def build_graph(spark, sf_dir):
    return built(spark, sf_dir)


@_query(rf"""SELECT count(*) AS n, bit_xor(h) AS "xor", CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS total FROM (SELECT ('0x' || substr(md5(line), 1, 15))::BIGINT AS h FROM (SELECT DISTINCT
  regexp_replace(regexp_replace(regexp_replace(l, '"\d{{4}}-\d\d-\d\dT[^"]*"', '"TIMESTAMP"', 'g'), '(dataset_[^>]*_)\d{{4}}-\d\d-\d\d>', '\1DATE>', 'g'), '"\d{{4}}-\d\d-\d\d"', '"DATE"', 'g') AS line FROM (SELECT {_LINE} AS l FROM {_GRAPH})))""")
def graph_fingerprint(spark, sf_dir):
    return compare.graph_fingerprint(built(spark, sf_dir))


_PART = "CASE WHEN n > 1000 THEN ('0x' || substr(md5(concat_ws('|', p, o, o_kind, coalesce(o_dt, ''), coalesce(o_lang, ''))), 1, 8))::BIGINT % CAST(ceil(n / 1000.0) AS BIGINT) ELSE 0 END"


@_query(f"""SELECT s, CAST(part AS INT) AS part, '{{"id":"' || s || '","statements":[' || string_agg('{{"p":"' || p || '","o":"' || o || '","o_kind":"' || o_kind || '"' || coalesce(',"o_dt":"' || o_dt || '"', '') || coalesce(',"o_lang":"' || o_lang || '"', '') || '}}', ',' ORDER BY p, o, o_kind, o_dt NULLS FIRST, o_lang NULLS FIRST) || ']}}' AS document
  FROM (SELECT *, {_PART} AS part FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM {_GRAPH})) GROUP BY s, part""")
def node_json(spark, sf_dir):
    return writers.node_documents(built(spark, sf_dir))


@_query(f"SELECT * FROM {_GRAPH}")
def ntriples_round_trip(spark, sf_dir):
    """Written as lines and read again."""
    path = scratch_path(spark, "ntriples")
    writers.write_ntriples(built(spark, sf_dir), path)
    return readers.read_ntriples(spark, path)[0]


@_query(f"SELECT p, count(*) AS n FROM {_GRAPH} GROUP BY p")
def triples_by_predicate(spark, sf_dir):
    """Written by predicate and read again."""
    path = scratch_path(spark, "triples")
    writers.write_triples(built(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("p").agg(F.count("*").alias("n"))


_CSV = ["the_id", "the_site", "the_findspot", "count_stamps", "avg_datemin", "avg_datemax", "q_start", "q_interval", "n_dies", "die_repetition", "avg_interval", "unc_start_years_exact", "k_eff", "k_is_fallback", "sigma_eff", "eff_start", "eff_end"]


@_query(f"SELECT {', '.join(_CSV)} FROM dated")
def csv_round_trip(spark, sf_dir):
    """Dated groups written as CSV and read again with their types."""
    path = scratch_path(spark, "csv")
    writers.write_dated(_kept(spark, sf_dir), path)
    return readers.resolve_columns(readers.read_dated(spark, path), _CSV)


@_query("PLAIN SELECT n_name AS nation, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def base_tables(spark, sf_dir):
    base = readers.read_base(spark, {t: f"{sf_dir}/{t}.parquet" for t in ("customer", "nation")})
    return base["customer"].join(base["nation"], F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("nation")).agg(F.count("*").alias("n"))


# cuts: the way from one group along some predicates
def _cut_sql(predicates: list[str], steps: int, only: str = "TRUE") -> str:
    wanted = ", ".join(map(_q, predicates))
    ctes = [f"g AS (SELECT * FROM {_GRAPH})", f"e AS (SELECT * FROM g WHERE p IN ({wanted}))", f"c1 AS (SELECT * FROM e WHERE s = (SELECT min(s) FROM g WHERE p = '{CRM}P4_has_time-span'))"]
    ctes += [f"c{k} AS (SELECT * FROM e WHERE s IN (SELECT o FROM c{k - 1} WHERE o_kind = 'iri'))" for k in range(2, steps + 1)]
    return f"SELECT s, p, o FROM (WITH {', '.join(ctes)} {' UNION '.join(f'SELECT * FROM c{k}' for k in range(1, steps + 1))}) WHERE {only}"


def _cut(spark, sf_dir, build) -> DataFrame:
    t = graph(spark, sf_dir)
    seed = t.of([CRM + "P4_has_time-span"]).agg(F.min("s")).first()[0]
    return build(t, seed).select("s", "p", "o")


@_query(_cut_sql([TYPE, LABEL, CRM + "P89_falls_within", CRM + "P4_has_time-span"], 2))
def cut_group(spark, sf_dir):
    return _cut(spark, sf_dir, Q.cut_group)


@_query(_cut_sql([CRM + "P4_has_time-span", *[TIME + x for x in ("hasBeginning", "hasEnd", "inTimePosition", "numericPosition", "inXSDgYear", "hasTRS")]], 4))
def cut_time_chain(spark, sf_dir):
    return _cut(spark, sf_dir, Q.cut_time_chain)


@_query(_cut_sql([CRM + "P4_has_time-span", *[PROV + x for x in ("wasGeneratedBy", "wasDerivedFrom", "used", "wasAssociatedWith")], CRM + "P33_used_specific_technique", CRM + "P14_carried_out_by"], 3))
def cut_provenance(spark, sf_dir):
    return _cut(spark, sf_dir, Q.cut_provenance)


@_query(_cut_sql([TYPE, CRM + "P4_has_time-span"], 2, f"p = '{TYPE}'"))
def cut_types(spark, sf_dir):
    return _cut(spark, sf_dir, Q.cut_types)


@_query("SELECT 'historical' AS era, count(*) AS n FROM dated")
def qry_era(spark, sf_dir):
    t = graph_of_groups(spark, sf_dir)
    return P.count_solutions(P.match(t, ("?ts", TYPE, N.vocab + "FindspotDating"))).select(F.lit(Q.era(t)).alias("era"), "n")


@_query('SELECT the_site AS site, the_findspot AS findspot, eff_start AS "from", eff_end AS "to" FROM dated WHERE contains(the_findspot, \'Brand#3\') ORDER BY 1, 2 LIMIT 1')
def qry_one_instance(spark, sf_dir):
    return Q.one_instance(graph_of_groups(spark, sf_dir), "Brand#3").select("site", "findspot", "from", "to")


@_query("SELECT the_site AS site, the_findspot AS findspot, eff_start AS numeric_ FROM dated WHERE eff_start < 0 ORDER BY eff_start, the_site, the_findspot LIMIT 1")
def qry_earliest_negative_start(spark, sf_dir):
    return Q.earliest_negative_start(graph_of_groups(spark, sf_dir)).select("site", "findspot", F.col("numeric").alias("numeric_"))


@_query(f"SELECT DISTINCT '{N.data}DatingModel_v1' AS s, '{N.data}fs_' || key AS o FROM dated WHERE the_id % 10 = 1")
def resolved_references(spark, sf_dir):
    keyed = G.build_keys(_kept(spark, sf_dir), check=False)
    return G.resolve_references(keyed, keyed.where("the_id % 10 = 1"), N).select("s", "o")


@_query(f"SELECT DISTINCT p AS term FROM {_GRAPH} WHERE p NOT IN ({', '.join(_q(N.vocab + p) for p, _, _ in V.PROPERTIES)})")
def undocumented_predicates(spark, sf_dir):
    """Predicates of the graph that its vocabulary doesn't describe: those of public vocabularies."""
    used = graph(spark, sf_dir).of().select(F.col("p").alias("term"))
    return V.undocumented_terms(used, V.build_vocabulary(spark, N).where(F.col("p") == LABEL).select(F.col("s").alias("term")))


# cuts by template, around many groups at once
def _template_sql(made: list[str], where: str = "TRUE") -> str:
    return f"SELECT DISTINCT fs, t.* FROM (SELECT '{N.data}fs_' || key AS fs, unnest([{', '.join(made)}]) AS t FROM dated WHERE the_id % 10 = 1 AND {where}) WHERE t.o IS NOT NULL"


def _made_sql(name: str) -> list[str]:
    """The statements of a cut, from the columns of the dated groups."""
    v, d = N.vocab, N.data
    fs, place, ts, row, act = f"'{d}fs_' || key", f"'{d}loc_ds_' || the_id", f"'{d}ts_' || key", f"'{d}plotrow_' || key", f"'{d}act_dating_' || key"
    model, agent, ds, trs = _q(d + "DatingModel_v1"), _q(d + "exporter"), _q(DATASET), _q(d + "trs_year")
    begin, end = f"{ts} || '_begin'", f"{ts} || '_end'"
    decimal, whole, year = XSD + "decimal", XSD + "integer", XSD + "gYear"
    if name == "group":
        return [
            _iri(fs, TYPE, _q(v + "Findspot")), _lit(fs, LABEL, "the_findspot"), _iri(fs, CRM + "P89_falls_within", place), _iri(fs, CRM + "P4_has_time-span", ts),
            _iri(place, TYPE, _q(v + "DiscoverySite")), _lit(place, LABEL, "the_site", lang="en"), _iri(ts, TYPE, _q(v + "FindspotDating")),
            _lit(ts, v + "nStamps", "count_stamps", whole), _lit(ts, v + "sigmaYears", "sigma_eff", decimal), _lit(ts, v + "kFactor", "k_eff", decimal), _lit(ts, v + "qInterval", "q_interval", decimal),
            _iri(ts, TIME + "hasBeginning", begin), _iri(ts, TIME + "hasEnd", end), _iri(begin, TYPE, _q(TIME + "Instant")), _iri(end, TYPE, _q(TIME + "Instant")),
            _lit(begin, TIME + "inXSDgYear", _gyear_sql("eff_start"), year), _lit(end, TIME + "inXSDgYear", _gyear_sql("eff_end"), year),
            _iri(row, TYPE, _q(v + "PlotRow")), _iri(row, v + "renders", ts), _lit(row, v + "uncStartYears", "unc_start_years", whole),
        ]
    if name == "time-chain":
        position = f"{begin} || '_pos'"
        return [
            _iri(ts, TIME + "hasBeginning", begin), _lit(ts, CRM + "P82a_begin_of_the_begin", _gyear_sql("eff_start"), year), _iri(begin, TYPE, _q(TIME + "Instant")), _iri(begin, TIME + "inTimePosition", position),
            _lit(begin, TIME + "inXSDgYear", _gyear_sql("eff_start"), year), _iri(position, TYPE, _q(TIME + "TimePosition")), _lit(position, TIME + "numericPosition", "eff_start", decimal), _iri(position, TIME + "hasTRS", trs),
            _iri(trs, TYPE, _q(TIME + "TRS")), _lit(trs, LABEL, "'signed year scale'", lang="en"), _iri(trs, SKOS + "closeMatch", "'http://www.opengis.net/def/uom/ISO-8601/0/Gregorian'"),
        ]
    return [
        _iri(ts, TYPE, _q(v + "FindspotDating")), _iri(ts, PROV + "wasGeneratedBy", act), _iri(ts, PROV + "wasDerivedFrom", ds), _iri(act, TYPE, _q(v + "DatingActivity")), _iri(act, PROV + "used", model), _iri(act, PROV + "used", ds),
        _iri(act, CRM + "P33_used_specific_technique", model), _iri(act, PROV + "wasAssociatedWith", agent), _iri(act, CRM + "P14_carried_out_by", agent), _iri(model, TYPE, _q(v + "DatingModel")),
        *[_lit(model, v + k, f"'{x}'", decimal) for k, x in (("kMin", "0.5"), ("kMax", "1.5"), ("tau", "20.0"), ("referenceLength", "20.0"))], _lit(model, v + "eraConvention", "'historical'"),
        _iri(agent, TYPE, _q(PROV + "SoftwareAgent")), _lit(agent, LABEL, "'exporter'", lang="en"), _iri(ds, TYPE, _q(DCAT + "Dataset")), _lit(ds, DCTERMS + "title", _q(ABOUT["title"]), lang="en"),
    ]


def _seeds(spark, sf_dir) -> DataFrame:
    """The groups of every tenth site."""
    keyed = G.build_keys(_kept(spark, sf_dir), check=False).where("the_id % 10 = 1")
    return keyed.select(F.concat(F.lit(f"{N.data}fs_"), "key").alias("fs"))


@_query(_template_sql(_made_sql("group"), "q_interval IS NOT NULL AND unc_start_years IS NOT NULL"))
def template_group(spark, sf_dir):
    """Groups whose sharpness is undefined have no cut, as the pattern asks for it."""
    return Q.cuts(graph(spark, sf_dir), _seeds(spark, sf_dir), "group")


@_query(_template_sql(_made_sql("time-chain")))
def template_time_chain(spark, sf_dir):
    return Q.cuts(graph(spark, sf_dir), _seeds(spark, sf_dir), "time-chain")


@_query(_template_sql(_made_sql("provenance")))
def template_provenance(spark, sf_dir):
    return Q.cuts(graph(spark, sf_dir), _seeds(spark, sf_dir), "provenance")


def _supers(name: str) -> set[str]:
    above = dict(V.CLASSES)
    for a, b in V.EXTERNAL_AXIOMS:
        above.setdefault(a, []).append(b)
    found, left = set(), [name]
    while left:
        for x in above.get(left.pop(), []):
            if x not in found:
                found.add(x)
                left.append(x)
    return found | {name}


@_query(_template_sql([*[_iri(f"'{N.data}fs_' || key", TYPE, _q(V.iri(c, N))) for c in sorted(_supers("Findspot"))], _lit(f"'{N.data}fs_' || key", LABEL, "the_findspot")]))
def template_types(spark, sf_dir):
    """Every type a group carries once the types are inferred."""
    seeds = _seeds(spark, sf_dir)
    theirs = graph(spark, sf_dir).of([TYPE, LABEL]).join(seeds.select(F.col("fs").alias("s")), "s", "left_semi")  # a cut reads nothing of other subjects
    full = entailment.materialise_types(theirs, entailment.superclass_closure(V.class_edges(spark, N)))
    return Q.cuts(full, seeds, "types")


# metadata of the graph, vocabulary, capped rows, reports
@_query("SELECT '0.5' AS \"kMin\", '1.5' AS \"kMax\", '20.0' AS tau, '1.0' AS w, count(*) AS n FROM dated")
def qry_model(spark, sf_dir):
    t = graph_of_groups(spark, sf_dir)
    return Q.model(t).crossJoin(P.count_solutions(P.match(t, ("?act", PROV + "used", N.data + "DatingModel_v1"))))


@_query(f"SELECT term, count(*) AS n FROM (SELECT p AS term FROM {_GRAPH} UNION ALL SELECT o FROM {_GRAPH} WHERE p = '{TYPE}') WHERE term IN ({', '.join(_q(V.iri(x, N)) for x in [*V.CLASSES, *[p for p, _, _ in V.PROPERTIES]])}) GROUP BY term")
def vocabulary_in_use(spark, sf_dir):
    """How often the graph uses each class and property that its vocabulary declares."""
    declared = V.build_vocabulary(spark, N).where(F.col("p") == TYPE).select(F.col("s").alias("term"))
    t = built(spark, sf_dir).select("p", F.when(F.col("p") == TYPE, F.col("o")).alias("o"))
    used = t.select(F.explode(F.array("p", "o")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return used.join(declared, "term", "left_semi")


@_query("SELECT count(*) AS shown, sum(held) AS held, (SELECT count(*) FROM customer) AS total FROM (SELECT 1 AS held FROM customer LIMIT 100)")
def preview_rows(spark, sf_dir):
    """At most so many rows, all of them rows of the whole, beside the true total."""
    rows = P.match(_tree(spark, sf_dir), ("?c", "nation", "?n"))
    shown, total = P.preview(rows, 100)
    held = shown.join(rows.withColumn("there", F.lit(1)), ["c", "n"], "left").agg(F.count("*").alias("shown"), F.sum("there").alias("held"))
    return held.crossJoin(total)


@_query("SELECT unnest(['dated-findspots', 'era-and-scale', 'external-identifiers', 'findspots-per-site', 'provenance', 'two-quality-axes']) AS query, (SELECT count(*) FROM dated) AS datings")
def catalogue_is_not_empty(spark, sf_dir):
    """The catalogue's queries over this graph; one without a row would be an error."""
    t = graph_of_groups(spark, sf_dir)
    names = Q.require_non_empty(t, {k: q for k, q in Q.CATALOGUE.items() if k != "crm-only"})
    return spark.createDataFrame([(x,) for x in names], "query string").crossJoin(P.count_solutions(P.match(t, ("?ts", TYPE, N.vocab + "FindspotDating"))).withColumnRenamed("n", "datings"))


# entailment over the class tree
@_query("SELECT 'g#count_' || sha256(cls) AS s, cls, CAST(n AS VARCHAR) AS entities FROM (SELECT 'n' || c_nationkey AS cls, count(DISTINCT c_custkey) AS n FROM customer WHERE c_custkey % 7 <> 0 AND c_nationkey < 5 GROUP BY 1)")
def described_classes(spark, sf_dir):
    found = entailment.describe_graph(_tree(spark, sf_dir), [f"n{i}" for i in range(5)], "g", "v:")
    return P.star(found, {"cls": "v:class", "entities": "v:entities"})


@_query("SELECT count(*) AS n_instances, count(*) FILTER (starts_with('n' || c_nationkey, 'n1')) AS n_anchored FROM customer WHERE c_custkey % 7 <> 0")
def anchored_instances(spark, sf_dir):
    return entailment.count_anchored(_tree(spark, sf_dir), "n1", ["Class"])


@_query("SELECT 'c' || c_custkey AS s, string_agg(t, ' ' ORDER BY t) AS types FROM (SELECT c_custkey, 'n' || c_nationkey AS t FROM customer WHERE c_custkey % 7 <> 0 UNION SELECT c_custkey, sup FROM customer JOIN closure ON cls = 'n' || c_nationkey WHERE c_custkey % 7 <> 0) GROUP BY 1")
def folded_types(spark, sf_dir):
    full = entailment.materialise_types(_tree(spark, sf_dir), entailment.superclass_closure(_edges(spark, sf_dir)))
    return entailment.fold_types(full)[0].select("s", F.array_join("types", " ").alias("types"))


@_query("SELECT CASE WHEN starts_with(sup, 'r') THEN 'r' ELSE 'root' END AS prefix, count(DISTINCT sub) AS n_classes FROM edges WHERE starts_with(sub, 'n') GROUP BY 1")
def vocabulary_usage(spark, sf_dir):
    return V.vocab_usage(_edges(spark, sf_dir), {"r": "r"}, "n")


@_query("PLAIN SELECT 'c' || c_custkey AS subject, 'n' || c_nationkey AS object, 'external' AS subject_layer, CASE WHEN n_regionkey < 3 THEN 'r' || n_regionkey ELSE 'external' END AS object_layer FROM customer JOIN nation ON c_nationkey = n_nationkey")
def layered_relations(spark, sf_dir):
    t = _tree(spark, sf_dir)
    layers = P.match(t, ("?cls", "region", "?layer")).where("layer in ('r0', 'r1', 'r2')")
    relations = P.match(t, ("?subject", "nation", "?object")).withColumn("predicate", F.lit("nation"))
    return V.layer_edges(relations, layers).drop("predicate")


@_query("PLAIN SELECT 'c' || c_custkey AS customer, c_name AS label FROM customer WHERE contains(c_name, '7')")
def filtered_and_renamed(spark, sf_dir):
    found = P.where_contains(P.match(_tree(spark, sf_dir), ("?c", LABEL, "?name")), "name", "7").where("c like 'c%'")
    return P.rename_fields(found, [("c", "customer"), ("name", "label")])


@_query("PLAIN SELECT 'c' || c_custkey AS c FROM customer WHERE c_nationkey = 3")
def seeded_pattern(spark, sf_dir):
    return P.seeded(P.match(_tree(spark, sf_dir), ("?c", "nation", "?n")), "n", "n3").select("c")


# terms
@_query(f"""PLAIN SELECT c_custkey, 'https://example.org/places/' || c_custkey AS external, CASE WHEN c_custkey % 3 <> 0 THEN '<http://www.opengis.net/def/crs/EPSG/0/4326> POINT(' || c_custkey || ' ' || c_nationkey || ')' END AS point,
  CASE WHEN c_custkey % 2 = 0 THEN 'skos:' || c_nationkey ELSE 'urn:x' || c_nationkey END AS qname, 'x <dataset_a_DATE> "DATE" "TIMESTAMP"' || c_custkey AS masked,
  CASE c_custkey % 3 WHEN 0 THEN '<' || c_name || '>' WHEN 1 THEN '"' || c_name || '\\n\\"x\\""@en' ELSE '"' || c_name || '"^^<{XSD}integer>' END AS term,
  CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE c_name || ' / ' || c_mktsegment END AS label, c_acctbal BETWEEN 0 AND 1000 AS inside FROM customer""")
def terms(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    kind = F.col("c_custkey") % 3
    line = F.concat(F.lit('x <dataset_a_2024-05-06> "2024-05-06" "2024-05-06T01:02:03Z"'), key)
    return _table(spark, sf_dir, "customer").select(
        "c_custkey", X.external_id(F.concat(key, F.lit(".0")), N.external_ids).alias("external"),
        X.wkt_point(F.when(kind != 0, key), F.col("c_nationkey")).alias("point"),
        X.qname(F.concat(F.when(F.col("c_custkey") % 2 == 0, SKOS).otherwise("urn:x"), F.col("c_nationkey").cast("string")), {"skos": SKOS}).alias("qname"),
        X.normalise_snapshot(line).alias("masked"),
        X.term_text(F.when(kind == 1, F.concat("c_name", F.lit('\n"x"'))).otherwise(F.col("c_name")), F.when(kind == 0, "iri").otherwise("lit"), F.when(kind == 2, XSD + "integer"), F.when(kind == 1, "en")).alias("term"),
        X.group_label(F.col("c_name"), F.when(F.col("c_custkey") % 4 == 0, " ").otherwise(F.col("c_mktsegment"))).alias("label"),
        X.inside_interval(F.col("c_acctbal"), F.lit(0), F.lit(1000)).alias("inside"),
    )


# figures
@_query("SELECT the_site, the_findspot, eff_start FROM dated ORDER BY eff_start, the_site, the_findspot LIMIT 1")
def first_group(spark, sf_dir):
    return figures.first_by(dated(spark, sf_dir), ["eff_start", "the_site", "the_findspot"]).select("the_site", "the_findspot", "eff_start")


@_query("SELECT the_id, the_findspot, round(count_stamps * 100.0::DOUBLE / max(count_stamps) OVER (), 6) AS scaled FROM dated")
def scaled_to_peak(spark, sf_dir):
    return figures.scale_to_peak(_kept(spark, sf_dir), "count_stamps", 100).select("the_id", "the_findspot", F.round("scaled", 6).alias("scaled"))


def _year_sql(c: str) -> str:
    y = f"CAST(round_even({c}, 0) AS BIGINT)"
    return f"CASE WHEN {y} < 0 THEN CAST(-{y} AS VARCHAR) || ' BC' WHEN {y} = 0 THEN '1 BC' ELSE 'AD ' || CAST({y} AS VARCHAR) END"


def _number_sql(c: str, n: int) -> str:
    return f"coalesce(CAST(CAST(CAST({c} AS DECIMAL(18, 6)) AS DECIMAL(18, {n})) AS VARCHAR), '–')"


@_query(f"""SELECT the_site, the_findspot, {_year_sql('eff_start')} || ' – ' || {_year_sql('eff_end')} AS interval, coalesce(CAST(count_stamps AS VARCHAR), '–') AS n, {_number_sql('sigma_eff', 1)} AS sigma,
  {_number_sql('unc_start_years', 0)} AS unc_start, {_number_sql('q_start', 3)} AS q_start, {_number_sql('q_interval', 3)} AS q_interval, {_number_sql('unc_end_years', 0)} AS unc_end, {_number_sql('q_end', 3)} AS q_end FROM dated""")
def value_table(spark, sf_dir):
    return figures.value_table(dated(spark, sf_dir))


# checks on groups of which some have been changed
CHANGES = {
    "k_eff": (3, "k_eff + 0.01"), "eff_end": (4, "eff_end + 1"), "q_start": (5, "q_start + 0.001"), "q_end": (6, "q_end + 0.01"),
    "unc_end_years": (7, "unc_end_years + 2"), "unc_start_years_exact": (8, "NULL"),
}
_CHANGED = f"(SELECT * REPLACE ({', '.join(f'CASE WHEN the_id % 50 = {k} THEN {v} ELSE {c} END AS {c}' for c, (k, v) in CHANGES.items())}) FROM dated)"


def changed(spark, sf_dir) -> DataFrame:
    return _kept(spark, sf_dir).withColumns({c: F.when(F.col("the_id") % 50 == k, F.expr(v)).otherwise(F.col(c)) for c, (k, v) in CHANGES.items()})


def _sharp(q: str, sd: str) -> str:
    return f"abs({q} - round(exp(-{sd} / p_t0), 3))"


_K = "abs(k_eff - CASE WHEN k_is_fallback OR n_stamps_die IS NULL THEN p_k_max ELSE p_k_max - (p_k_max - p_k_min) * (1 - exp(-n_stamps_die / p_tau)) END)"
_ROWS = {
    "c": (f"{_K} > 5e-5", None), "d": ("abs((eff_end - eff_start) - 2 * k_eff * sigma_eff) > 0.11", None),
    "h": (f"{_sharp('q_start', 'unc_start_years_exact')} > 1.1e-3", f"{_sharp('q_start', 'unc_start_years_exact')} > 1e-9"), "h''": (f"{_sharp('q_end', 'unc_end_years_exact')} > 1.1e-3", f"{_sharp('q_end', 'unc_end_years_exact')} > 1e-9"),
    "n": ("(q_start IS NULL) <> (unc_start_years_exact IS NULL) OR (q_end IS NULL) <> (unc_end_years_exact IS NULL)", None),
    "f": ("(unc_start_years_exact IS NULL AND abs(q_start - 0.5) < 1e-9) OR (unc_end_years_exact IS NULL AND abs(q_end - 0.5) < 1e-9) OR (unc_interval_years IS NULL AND abs(q_interval - 0.5) < 1e-9)", None),
    "r": ("greatest(abs(unc_start_years - unc_start_years_exact), abs(unc_end_years - unc_end_years_exact)) > 0.5 + 1e-9", None),
}


def _inversions_sql(q: str, sd: str) -> str:
    return f"(SELECT * FROM (SELECT label, {q} AS y, lag({q}) OVER (ORDER BY {sd}, the_site, the_findspot) AS before FROM changed WHERE {sd} IS NOT NULL AND {q} IS NOT NULL) WHERE y > before + 1e-12)"


_CHECKS = " UNION ALL ".join([
    "SELECT 'k' AS key, 'pass' AS status, CAST(0 AS BIGINT) AS n_offenders, '' AS offenders",
    "SELECT 'p', CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END, n, CASE WHEN n > 0 THEN 'p_tau' ELSE '' END FROM (SELECT CAST(count(DISTINCT p_tau) > 1 AS BIGINT) AS n FROM changed)",
    *[f"SELECT '{k}', CASE WHEN count(*) FILTER ({bad}) > 0 THEN 'fail' WHEN count(*) FILTER ({odd or bad}) > 0 THEN 'warn' ELSE 'pass' END, count(*) FILTER ({odd or bad}), coalesce(array_to_string(list_sort(list(label) FILTER ({odd or bad}))[1:10], ' | '), '') FROM changed" for k, (bad, odd) in _ROWS.items()],
    *[f"SELECT '{k}', CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END, count(*), coalesce(array_to_string(list_sort(list(label))[1:10], ' | '), '') FROM {_inversions_sql(q, sd)}" for k, q, sd in (("i", "q_start", "unc_start_years_exact"), ("i''", "q_end", "unc_end_years_exact"))],
])
_CHECKS = f"(WITH changed AS (SELECT *, the_site || ' / ' || the_findspot AS label FROM {_CHANGED}) {_CHECKS})"


@_query(f"SELECT * FROM {_CHECKS}")
def all_checks(spark, sf_dir):
    return C.all_checks(changed(spark, sf_dir)).select("key", "status", "n_offenders", F.array_join("offenders", " | ").alias("offenders"))


@_query(f"SELECT CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 'error' ELSE 'ok' END AS verdict, count(*) FILTER (status = 'fail') AS n_fail, count(*) FILTER (status = 'warn') AS n_warn FROM {_CHECKS}")
def verdict(spark, sf_dir):
    return C.verdict(C.all_checks(changed(spark, sf_dir)))


@_query(f"SELECT key, status, n_offenders FROM {_CHECKS}")
def report_round_trip(spark, sf_dir):
    """The checks written as a report and read again."""
    path = scratch_path(spark, "report")
    writers.write_report(C.all_checks(changed(spark, sf_dir)), path)
    return spark.read.json(path).select("key", "status", "n_offenders")


@_query("SELECT 'a' AS key, CASE WHEN count(*) = 1000 THEN 'pass' ELSE 'warn' END AS status, CAST(0 AS BIGINT) AS n_offenders, count(*) || ' rows, expected 1000' AS detail FROM dated UNION ALL SELECT 'k', 'fail', 2, 'missing: bearing, depth'")
def input_checks(spark, sf_dir):
    df = _kept(spark, sf_dir)
    return C.check_count(df, 1000).unionByName(C.check_columns(df, ["the_id", "depth", "k_eff", "bearing"])).select("key", "status", "n_offenders", "detail")


_SPECTRUM = """SELECT count(x) AS n, min(x) AS sigma_min, round(median(x), 6) AS sigma_median, max(x) AS sigma_max, round(min(exp(-x / 20.0)), 6) AS q_min, round(median(exp(-x / 20.0)), 6) AS q_median, round(max(exp(-x / 20.0)), 6) AS q_max
  FROM (SELECT unc_start_years_exact AS x FROM dated UNION ALL SELECT unc_end_years_exact FROM dated) WHERE x IS NOT NULL"""
_DRIFT = """SELECT round(corr(eff_end - eff_start, midpoint_year), 6) AS r_width, round(corr(sigma_eff, midpoint_year), 6) AS r_sigma, round(corr(q_interval, midpoint_year), 6) AS r_q_interval, round(corr(q_start, midpoint_year), 6) AS r_q_start,
  round(median(eff_end - eff_start) FILTER (midpoint_year < 100), 6) AS median_width_before, round(median(eff_end - eff_start) FILTER (midpoint_year >= 100), 6) AS median_width_after,
  count(*) FILTER (midpoint_year < 100) AS n_before, count(*) FILTER (midpoint_year >= 100) AS n_after, count(*) AS n_groups FROM dated"""


@_query(f"SELECT *, 0.5::DOUBLE AS k_min, 1.5::DOUBLE AS k_max, 20.0::DOUBLE AS tau, 1.0::DOUBLE AS w, 20.0::DOUBLE AS t0, round(exp(-0.25::DOUBLE), 3) AS q_at_5, round(exp(-1.25::DOUBLE), 3) AS q_at_25 FROM ({_SPECTRUM}), ({_DRIFT})")
def facts(spark, sf_dir):
    out = C.facts(_kept(spark, sf_dir), PARAMS)
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])
