"""From dated groups to triples (s, p, o, o_kind, o_dt, o_lang).

All statements about a group are one array per row that is exploded once, so the graph of any number of groups is one
pass over them; for patterns it is a union over predicates instead, of which only the branches asked for are read. Statements about places, which several groups share, are made distinct. A missing measure has no
statement but is named as undefined.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import decimal_lexical, external_id, gyear, integer_lexical, round_half_even, wkt_point
from ..functions.text import short_hash, slug
from ..params import CRM, CRMDIG, DCAT, DCTERMS, GEO, LABEL, OWL, PROV, RDFS, SKOS, TIME, TYPE, XSD, DatingParams, Names
from ..sources.scratch import stored
from .compare import distinct_triples

#: The measures of a time span with their columns, and of its row in the figure.
INTEGER, DECIMAL = XSD + "integer", XSD + "decimal"
MEASURES = [
    ("nStamps", "count_stamps", INTEGER), ("nStampsWithDie", "n_stamps_die", INTEGER), ("nDies", "n_dies", INTEGER),
    ("dieRepetition", "die_repetition", DECIMAL), ("qRepetition", "q_repetition", DECIMAL), ("qInterval", "q_interval", DECIMAL),
    ("qStart", "q_start", DECIMAL), ("qEnd", "q_end", DECIMAL), ("sigmaYears", "sigma_eff", DECIMAL), ("kFactor", "k_eff", DECIMAL), ("midpointYear", "midpoint_year", DECIMAL),
    ("avgDatemin", "avg_datemin", INTEGER), ("avgDatemax", "avg_datemax", INTEGER), ("minDatemin", "min_datemin", INTEGER),
    ("maxDatemin", "max_datemin", INTEGER), ("minDatemax", "min_datemax", INTEGER), ("maxDatemax", "max_datemax", INTEGER),
]
ROW_MEASURES = [("uncStartYears", "unc_start_years", INTEGER), ("uncEndYears", "unc_end_years", INTEGER), ("uncIntervalYears", "unc_interval_years", INTEGER)]

#: Constants of the figure.
FIGURE_CONSTANTS = {"padYears": 60, "extremeStubYears": 10, "rowHeight": 36, "svgWidth": 1200, "marginLeft": 400, "marginRight": 260, "marginTop": 40, "marginBottom": 120, "bandPadding": 0.4, "colourRamp": "interpolateRdYlGn", "rowOrder": "avg_datemin ASC"}

def _none() -> Column:
    return F.lit(None).cast("string")


def _s(x) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def _constant(x) -> str | None:
    return x if isinstance(x, str) else None


class Statement(NamedTuple):
    """A triple of the row it is read from; its predicate is a constant."""

    s: Column
    p: str
    o: Column
    o_kind: str
    o_dt: str | None = None
    o_lang: str | None = None
    s_is: str | None = None  # its subject and object, where they are constants too
    o_is: str | None = None

    def columns(self) -> list[Column]:
        return [self.s.alias("s"), F.lit(self.p).alias("p"), self.o.alias("o"), F.lit(self.o_kind).alias("o_kind"), F.lit(self.o_dt).cast("string").alias("o_dt"), F.lit(self.o_lang).cast("string").alias("o_lang")]


def node(s, p: str, o) -> Statement:
    return Statement(_s(s), p, _s(o), "iri", s_is=_constant(s), o_is=_constant(o))


def text(s, p: str, o, dt: str | None = None, lang: str | None = None) -> Statement:
    return Statement(_s(s), p, _s(o).cast("string"), "lit", dt, lang, _constant(s), _constant(o))


_MADE = "s is not null and o is not null"


def explode_triples(df: DataFrame, statements: list[Statement]) -> DataFrame:
    """One row per statement; a statement without subject or object isn't made."""
    return df.select(F.explode(F.array(*[F.struct(*x.columns()) for x in statements])).alias("t")).select("t.*").where(_MADE)


def by_predicate(df: DataFrame, statements: list[Statement]) -> DataFrame:
    """The same triples as a union over predicates (and over the statements of types), each of them a constant of its branch: a pattern's
    filter then leaves its own branch alone, and of that only the columns that it reads."""
    branches: dict[tuple, list[Statement]] = {}
    for i, x in enumerate(statements):
        branches.setdefault((x.p, i if x.p == TYPE else None), []).append(x)
    parts = []
    for (p, _), made in branches.items():
        if len(made) == 1:
            parts.append(df.select(*made[0].columns()))
        else:
            rows = F.explode(F.array(*[F.struct(*x.columns()).dropFields("p") for x in made])).alias("t")
            parts.append(df.select(rows).select("t.s", F.lit(p).alias("p"), "t.o", "t.o_kind", "t.o_dt", "t.o_lang"))
    return reduce(DataFrame.unionByName, [x.where(_MADE) for x in parts])


class Part(NamedTuple):
    """Statements of the rows that they are read from. few: these don't grow with the groups; repeats: rows share statements."""

    rows: DataFrame
    statements: list[Statement]
    few: bool = False
    repeats: bool = False


class Branches(NamedTuple):
    """A graph of parts that have nothing in common, for patterns: each takes the statements it can match while its plan is
    written, so a plan of many patterns doesn't hold the whole union once for each of them."""

    parts: list[Part]

    @property
    def sparkSession(self) -> SparkSession:
        return self.parts[0].rows.sparkSession

    def _chosen(self, predicates: list[str] | None, s: str | None, o: str | None) -> list[Part]:
        fits = lambda x: (predicates is None or x.p in predicates) and (s is None or x.s_is in (None, s)) and (o is None or x.o_is in (None, o))
        return [x for part in self.parts if (x := part._replace(statements=[y for y in part.statements if fits(y)])).statements]

    def of(self, predicates: list[str] | None = None, s: str | None = None, o: str | None = None) -> DataFrame:
        """The triples of some predicates (default: all); s, o: statements with another constant are left out."""
        made = [distinct_triples(x) if part.repeats else x for part in self._chosen(predicates, s, o) for x in [by_predicate(part.rows, part.statements)]]
        return reduce(DataFrame.unionByName, made) if made else by_predicate(self.sparkSession.range(0), [node("", "", "")])

    def grows(self, predicates: list[str], s: str | None = None, o: str | None = None) -> bool:
        """Whether their number grows with the groups."""
        return not all(part.few for part in self._chosen(predicates, s, o))


def build_keys(dated: DataFrame, mode: str = "hash", check: bool = True) -> DataFrame:
    """Adds `key` (id and fragment of the group's name). Two names of one id with one fragment are an error."""
    rows = dated.where("the_id is not null").withColumn("_frag", short_hash(F.col("the_findspot")) if mode == "hash" else slug(F.col("the_findspot")))
    if check:
        clash = rows.groupBy("the_id", "_frag").agg(F.count_distinct("the_findspot").alias("n"), F.min("the_findspot").alias("a"), F.max("the_findspot").alias("b")).where("n > 1").limit(1).collect()
        if clash:
            raise ValueError(f"names of id {clash[0].the_id} share the fragment {clash[0]._frag}: {clash[0].a!r}, {clash[0].b!r}")
    return rows.withColumn("key", F.concat_ws("_", F.col("the_id").cast("string"), F.col("_frag"))).drop("_frag")


def _has(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else _none()


def _iris(names: Names) -> dict[str, Column]:
    key = F.col("key")
    at = lambda kind: F.concat(F.lit(f"{names.data}{kind}_"), key)
    return {"place": F.concat(F.lit(f"{names.data}loc_ds_"), F.col("the_id").cast("string")), "spot": at("fs"), "span": at("ts"), "row": at("plotrow"), "act": at("act_dating")}


def place_statements(keyed: DataFrame, names: Names, geometry: bool = False) -> list[Statement]:
    i = _iris(names)
    out = [
        text(i["place"], LABEL, F.col("the_site"), lang="en"),
        text(i["place"], names.vocab + "ancientName", _has(keyed, "latinsitename")),
        node(i["place"], names.vocab + "pleiadesID", external_id(_has(keyed, "pleiades"), names.external_ids)),
    ]
    if geometry:
        wkt = wkt_point(_has(keyed, "long"), _has(keyed, "lat"))
        shape = F.when(wkt.isNotNull(), F.concat(i["place"], F.lit("_geom")))
        out += [node(i["place"], GEO + "hasGeometry", shape), text(shape, GEO + "asWKT", wkt, GEO + "wktLiteral")]
    return out


def emit_places(keyed: DataFrame, names: Names, geometry: bool = False) -> DataFrame:
    return explode_triples(keyed, place_statements(keyed, names, geometry)).distinct()


def group_statements(names: Names) -> list[Statement]:
    """`_slug`: the slug of the findspot's name."""
    i = _iris(names)
    return [
        node(i["spot"], TYPE, names.vocab + "Findspot"), text(i["spot"], LABEL, F.col("the_findspot")), text(i["spot"], SKOS + "notation", F.col("_slug")),
        node(i["spot"], CRM + "P89_falls_within", i["place"]), node(i["spot"], CRM + "P4_has_time-span", i["span"]),
    ]


def span_statements(names: Names, era: str) -> list[Statement]:
    i = _iris(names)
    whole = lambda c: round_half_even(F.col(c)).cast("long").cast("string")
    out = [node(i["span"], TYPE, names.vocab + "FindspotDating"), text(i["span"], LABEL, F.concat(F.col("the_site"), F.lit(" — "), F.col("the_findspot"), F.lit(": "), whole("eff_start"), F.lit(" to "), whole("eff_end")), lang="en"), node(i["span"], PROV + "wasGeneratedBy", i["act"])]
    for edge, link, value in (("begin", "hasBeginning", "eff_start"), ("end", "hasEnd", "eff_end")):
        instant = F.concat(i["span"], F.lit(f"_{edge}"))
        position = F.concat(instant, F.lit("_pos"))
        out += [
            node(i["span"], TIME + link, instant), node(instant, TYPE, TIME + "Instant"), node(instant, TYPE, names.vocab + "DatingInstant"), node(instant, TIME + "inTimePosition", position),
            node(position, TYPE, TIME + "TimePosition"), node(position, TYPE, names.vocab + "DatingTimePosition"), node(position, TIME + "hasTRS", names.data + "trs_year"),
            text(position, TIME + "numericPosition", decimal_lexical(F.col(value)), DECIMAL), text(instant, TIME + "inXSDgYear", gyear(F.col(value), era), XSD + "gYear"),
        ]
    return out


def bound_statements(names: Names, era: str) -> list[Statement]:
    span = _iris(names)["span"]
    return [text(span, CRM + "P82a_begin_of_the_begin", gyear(F.col("eff_start"), era), XSD + "gYear"), text(span, CRM + "P82b_end_of_the_end", gyear(F.col("eff_end"), era), XSD + "gYear")]


def measure_statements(subject: Column, measures: list[tuple[str, str, str]], names: Names) -> list[Statement]:
    """A value, or the mark that it is undefined, never both."""
    out = []
    for prop, column, dt in measures:
        c = F.col(column)
        out += [text(subject, names.vocab + prop, integer_lexical(c) if dt == INTEGER else decimal_lexical(c), dt), node(F.when(c.isNull(), subject), names.vocab + "undefinedMeasure", names.vocab + prop)]
    return out


def emit_measures(keyed: DataFrame, names: Names = Names()) -> DataFrame:
    return explode_triples(keyed, measure_statements(_iris(names)["span"], MEASURES, names))


def label_statements(names: Names) -> list[Statement]:
    span = _iris(names)["span"]
    return [text(span, names.vocab + "intervalLabel", F.col("avg_interval")), text(span, names.vocab + "kIsFallback", F.col("k_is_fallback").cast("string"), XSD + "boolean")]


def row_statements(names: Names, figure: str) -> list[Statement]:
    i = _iris(names)
    return [node(i["row"], TYPE, names.vocab + "PlotRow"), node(i["row"], names.vocab + "renders", i["span"]), node(f"{names.data}fig_{figure}", names.vocab + "hasRow", i["row"]), *measure_statements(i["row"], ROW_MEASURES, names)]


def activity_statements(names: Names, dataset: str, generated_at: str) -> list[Statement]:
    i, agent, model = _iris(names), names.data + "exporter", names.data + "DatingModel_v1"
    return [
        node(i["act"], TYPE, PROV + "Activity"), node(i["act"], TYPE, names.vocab + "DatingActivity"),
        text(i["act"], LABEL, F.concat(F.lit("Dating of "), F.col("the_site"), F.lit(" — "), F.col("the_findspot")), lang="en"),
        node(i["act"], PROV + "wasAssociatedWith", agent), text(i["act"], PROV + "endedAtTime", generated_at, XSD + "dateTime"),
        node(i["act"], PROV + "used", dataset), node(i["act"], PROV + "used", model), node(i["act"], CRM + "P33_used_specific_technique", model), node(i["act"], CRM + "P14_carried_out_by", agent),
        node(i["span"], PROV + "wasDerivedFrom", dataset),
    ]


def reference_part(keyed: DataFrame, references: DataFrame, names: Names) -> Part:
    wanted = references.select("the_site", "the_findspot").distinct().hint("merge")  # as many as they are, none is sent to every task
    found = keyed.join(wanted, ["the_site", "the_findspot"])
    return Part(found, [node(names.data + "DatingModel_v1", names.vocab + "calibratedAgainst", _iris(names)["spot"])], repeats=True)


def resolve_references(keyed: DataFrame, references: DataFrame, names: Names) -> DataFrame:
    """Triples from the model to the groups of a small reference list (the_site, the_findspot); absent ones are left out."""
    return Branches([reference_part(keyed, references, names)]).of()


def single_statements(p: DatingParams, names: Names, era: str, figure: str, dataset: str, generated_at: str, about: dict[str, str] | None = None) -> list[Statement]:
    """Agent, year scale, model, dataset and figure. `about`: the model's label, title, source, license, rights, creator,
    publisher, contact, calibration basis and identifier scheme, as far as they are given."""
    about, v, d = about or {}, names.vocab, names.data
    rows: dict[tuple, Statement] = {}
    iri = lambda s, q, o: rows.setdefault((s, q, o), node(s, q, o))
    lit = lambda s, q, o, dt=None, lang=None: rows.setdefault((s, q, str(o), dt, lang), text(s, q, str(o), dt, lang))
    agent, model, fig, scale = d + "exporter", d + "DatingModel_v1", f"{d}fig_{figure}", d + "trs_year"
    iri(agent, TYPE, PROV + "SoftwareAgent"); iri(agent, TYPE, CRMDIG + "D14_Software"); lit(agent, LABEL, "exporter", lang="en")  # noqa: E702
    iri(scale, TYPE, TIME + "TRS"); iri(scale, TYPE, v + "YearScale"); lit(scale, LABEL, "signed year scale", lang="en")  # noqa: E702
    iri(scale, SKOS + "closeMatch", "http://www.opengis.net/def/uom/ISO-8601/0/Gregorian")
    iri(model, TYPE, v + "DatingModel"); lit(model, LABEL, about.get("model", "dating model"), lang="en")  # noqa: E702
    for name, value in (("kMin", p.k_min), ("kMax", p.k_max), ("tau", p.tau), ("volumeWeight", p.w), ("referenceLength", p.t0)):
        lit(model, v + name, float(value), DECIMAL)
    lit(model, v + "fuzzinessDivisor", 12, INTEGER)
    lit(model, v + "eraConvention", era)
    for value in p.excluded_ends:
        lit(model, v + "excludedDatemax", value, INTEGER)
    day = generated_at[:10]
    for kind in (DCAT + "Dataset", PROV + "Entity", CRMDIG + "D1_Digital_Object"):
        iri(dataset, TYPE, kind)
    iri(dataset, PROV + "wasAttributedTo", agent)
    lit(dataset, DCTERMS + "created", generated_at, XSD + "dateTime"); lit(dataset, DCTERMS + "issued", day, XSD + "date"); lit(dataset, OWL + "versionInfo", day)  # noqa: E702
    for name, pred, s in (("title", DCTERMS + "title", dataset), ("source", DCTERMS + "source", dataset), ("rights", DCTERMS + "rights", dataset), ("creator", DCTERMS + "creator", dataset), ("publisher", DCTERMS + "publisher", dataset), ("contact", DCAT + "contactPoint", dataset), ("basis", v + "calibrationBasis", model), ("identifiers", v + "identifierScheme", dataset)):
        if name in about:
            lit(s, pred, about[name], lang="en" if name in ("title", "rights", "basis") else None)
    if "license" in about:
        iri(dataset, DCTERMS + "license", about["license"])
    iri(fig, TYPE, v + "Figure"); lit(fig, LABEL, "Dated groups", lang="en"); iri(fig, DCTERMS + "isPartOf", dataset)  # noqa: E702
    for name, value in FIGURE_CONSTANTS.items():
        lit(fig, v + name, value, {int: INTEGER, float: DECIMAL, str: None}[type(value)])
    iri(fig, RDFS + "seeAlso", dataset)
    return list(rows.values())


class Graph(NamedTuple):
    """What a graph is made with. `generated_at` (ISO) is an input, so equal data make equal graphs."""

    p: DatingParams
    generated_at: str
    names: Names = Names()
    era: str = "historical"
    figure: str = "sites"
    geometry: bool = False
    about: dict[str, str] | None = None

    def own(self) -> list[Statement]:
        """The statements of a group, whose subjects (or objects, in the figure's rows) are its own."""
        names, i = self.names, _iris(self.names)
        return [*group_statements(names), *span_statements(names, self.era), *bound_statements(names, self.era), *measure_statements(i["span"], MEASURES, names), *label_statements(names), *row_statements(names, self.figure), *activity_statements(names, self._dataset(), self.generated_at)]

    def _dataset(self) -> str:
        return f"{self.names.data}dataset_{self.figure}_{self.generated_at[:10]}"

    def _shared(self, keyed: DataFrame, references: DataFrame | None) -> list[Part]:
        """Places, which several groups share, what is said once, and references: sets that have nothing in common."""
        once = single_statements(self.p, self.names, self.era, self.figure, self._dataset(), self.generated_at, self.about)
        parts = [Part(keyed, place_statements(keyed, self.names, self.geometry), repeats=True), Part(keyed.sparkSession.range(1), once, few=True)]
        return parts + ([] if references is None else [reference_part(keyed, references, self.names)])

    def whole(self, keyed: DataFrame, references: DataFrame | None = None) -> DataFrame:
        """For reading all of it: every group's statements are exploded once, so many groups a task."""
        spark = keyed.sparkSession
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keyed.count() // GROUPS_A_TASK)
        parts = [explode_triples(keyed.where("_same = 1").repartition(tasks), self.own()), Branches(self._shared(keyed, references)).of()]
        return reduce(DataFrame.unionByName, parts + [distinct_triples(explode_triples(x.rows, x.statements)) for x in self._repeated(keyed)])

    def branches(self, keyed: DataFrame, references: DataFrame | None = None) -> Branches:
        """For patterns: nothing but the branches of their predicates is planned and read."""
        return Branches([Part(keyed.where("_same = 1"), self.own()), *self._shared(keyed, references), *self._repeated(keyed)])

    def by_predicate(self, keyed: DataFrame, references: DataFrame | None = None) -> DataFrame:
        """The union of all branches, for what reads triples by other things than patterns."""
        return self.branches(keyed, references).of()

    def _repeated(self, keyed: DataFrame) -> list[Part]:
        """Statements repeat only where a key does: the others are never compared."""
        again = keyed.where("_same > 1")
        return [] if again.isEmpty() else [Part(again, self.own(), repeats=True)]


#: So many groups (of some sixty statements) a task, however many there are.
GROUPS_A_TASK = 25_000


def keyed_groups(dated: DataFrame, key_mode: str = "hash", check: bool = True) -> DataFrame:
    """The groups with their key, the number of groups of that key and the slug of their name; to be stored, as several
    plans read them. Rows without an id are left out; check `g` names them. check: see `build_keys`; without it, groups
    whose names share a fragment share their nodes."""
    return build_keys(dated, key_mode, check).withColumns({"_same": F.count("*").over(Window.partitionBy("key")), "_slug": slug(F.col("the_findspot"))})


def apart(keyed: DataFrame) -> DataFrame:
    """Keyed groups of which none shares its key: those that did have the hash of their whole name in it too."""
    longer = F.concat_ws("_", "key", F.sha2(F.concat_ws("\n", "the_site", "the_findspot"), 256))
    return keyed.withColumns({"key": F.when(F.col("_same") > 1, longer).otherwise(F.col("key")), "_same": F.lit(1).cast("bigint")})


def build_graph(dated: DataFrame, p: DatingParams, generated_at: str, names: Names = Names(), era: str = "historical", figure: str = "sites", key_mode: str = "hash", geometry: bool = False, references: DataFrame | None = None, about: dict[str, str] | None = None) -> DataFrame:
    """The whole graph as a set."""
    return Graph(p, generated_at, names, era, figure, geometry, about).whole(stored(keyed_groups(dated, key_mode), "keyed"), references)


def count_bc_years(t: DataFrame) -> DataFrame:
    """Calendar years at or before year 0000."""
    return t.where((F.col("o_dt") == XSD + "gYear") & (F.col("o").startswith("-") | (F.col("o") == "0000"))).agg(F.count("*").alias("n_bc_years"))
