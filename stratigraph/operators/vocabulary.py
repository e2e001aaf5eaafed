"""The graph's vocabulary as small tables, and what follows from class and relation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import CRM, CRMDIG, DCAT, LABEL, OWL, PROV, RDF, RDFS, SUBCLASS, TIME, TYPE, XSD, Names

TRIPLE = "s string, p string, o string, o_kind string, o_dt string, o_lang string"

#: Local classes and their superclasses (names with a prefix are public ones).
CLASSES = {
    "Location": ["crm:E53_Place"],
    "DiscoverySite": ["Location"],
    "Findspot": ["Location"],
    "DatedTimeSpan": ["crm:E52_Time-Span", "time:ProperInterval"],
    "FindspotDating": ["DatedTimeSpan"],
    "DatingInstant": ["time:Instant", "crm:E52_Time-Span"],
    "DatingTimePosition": ["time:TimePosition", "crm:E54_Dimension"],
    "YearScale": ["time:TRS", "crm:E73_Information_Object"],
    "DatingModel": ["prov:Plan", "crm:E29_Design_or_Procedure"],
    "DatingActivity": ["prov:Activity", "crmdig:D10_Software_Execution"],
    "Figure": ["crm:E36_Visual_Item"],
    "PlotRow": ["crm:E36_Visual_Item"],
}

#: Subclass statements of public vocabularies that the closure needs.
EXTERNAL_AXIOMS = [
    ("crmdig:D10_Software_Execution", "crmdig:D7_Digital_Machine_Event"),
    ("crmdig:D7_Digital_Machine_Event", "crm:E11_Modification"),
    ("crmdig:D7_Digital_Machine_Event", "crm:E65_Creation"),
    ("crm:E11_Modification", "crm:E7_Activity"),
    ("crm:E65_Creation", "crm:E7_Activity"),
    ("crmdig:D14_Software", "crmdig:D1_Digital_Object"),
    ("crmdig:D1_Digital_Object", "crm:E73_Information_Object"),
]

#: Property, domain, range.
PROPERTIES = [
    ("renders", "PlotRow", "DatedTimeSpan"),
    ("hasRow", "Figure", "PlotRow"),
    ("undefinedMeasure", "DatedTimeSpan", "rdf:Property"),
    ("nStamps", "DatedTimeSpan", "xsd:integer"),
    ("nStampsWithDie", "DatedTimeSpan", "xsd:integer"),
    ("nDies", "DatedTimeSpan", "xsd:integer"),
    ("dieRepetition", "DatedTimeSpan", "xsd:decimal"),
    ("qRepetition", "DatedTimeSpan", "xsd:decimal"),
    ("qInterval", "DatedTimeSpan", "xsd:decimal"),
    ("qStart", "DatedTimeSpan", "xsd:decimal"),
    ("qEnd", "DatedTimeSpan", "xsd:decimal"),
    ("sigmaYears", "DatedTimeSpan", "xsd:decimal"),
    ("kFactor", "DatedTimeSpan", "xsd:decimal"),
    ("kIsFallback", "DatedTimeSpan", "xsd:boolean"),
    ("midpointYear", "DatedTimeSpan", "xsd:decimal"),
    ("avgDatemin", "DatedTimeSpan", "xsd:integer"),
    ("avgDatemax", "DatedTimeSpan", "xsd:integer"),
    ("minDatemin", "DatedTimeSpan", "xsd:integer"),
    ("maxDatemin", "DatedTimeSpan", "xsd:integer"),
    ("minDatemax", "DatedTimeSpan", "xsd:integer"),
    ("maxDatemax", "DatedTimeSpan", "xsd:integer"),
    ("intervalLabel", "DatedTimeSpan", "xsd:string"),
    ("uncStartYears", "PlotRow", "xsd:integer"),
    ("uncEndYears", "PlotRow", "xsd:integer"),
    ("uncIntervalYears", "PlotRow", "xsd:integer"),
    ("kMin", "DatingModel", "xsd:decimal"),
    ("kMax", "DatingModel", "xsd:decimal"),
    ("tau", "DatingModel", "xsd:decimal"),
    ("volumeWeight", "DatingModel", "xsd:decimal"),
    ("calibrationBasis", "DatingModel", "xsd:string"),
    ("calibratedAgainst", "DatingModel", "Findspot"),
    ("referenceLength", "DatingModel", "xsd:decimal"),
    ("fuzzinessDivisor", "DatingModel", "xsd:integer"),
    ("excludedDatemax", "DatingModel", "xsd:integer"),
    ("identifierScheme", "dcat:Dataset", "xsd:string"),
    ("eraConvention", "DatingModel", "xsd:string"),
    ("padYears", "Figure", "xsd:integer"),
    ("extremeStubYears", "Figure", "xsd:integer"),
    ("rowHeight", "Figure", "xsd:integer"),
    ("svgWidth", "Figure", "xsd:integer"),
    ("marginLeft", "Figure", "xsd:integer"),
    ("marginRight", "Figure", "xsd:integer"),
    ("marginTop", "Figure", "xsd:integer"),
    ("marginBottom", "Figure", "xsd:integer"),
    ("bandPadding", "Figure", "xsd:decimal"),
    ("colourRamp", "Figure", "xsd:string"),
    ("rowOrder", "Figure", "xsd:string"),
]

#: The relations between classes that the graph is built from, and the layer of each class.
RELATIONS = [
    ("Findspot", "crm:P89_falls_within", "DiscoverySite"),
    ("Findspot", "crm:P4_has_time-span", "FindspotDating"),
    ("FindspotDating", "time:hasBeginning", "time:Instant"),
    ("FindspotDating", "time:hasEnd", "time:Instant"),
    ("time:Instant", "time:inTimePosition", "time:TimePosition"),
    ("time:TimePosition", "time:hasTRS", "time:TRS"),
    ("PlotRow", "renders", "FindspotDating"),
    ("Figure", "hasRow", "PlotRow"),
    ("FindspotDating", "prov:wasGeneratedBy", "DatingActivity"),
    ("DatingActivity", "prov:used", "DatingModel"),
    ("FindspotDating", "prov:wasDerivedFrom", "dcat:Dataset"),
]
LAYERS = {"DiscoverySite": "place", "Findspot": "place", "DatedTimeSpan": "dating", "FindspotDating": "dating", "DatingModel": "provenance", "DatingActivity": "provenance", "PlotRow": "presentation", "Figure": "presentation", "Location": "place"}

_PUBLIC = {"rdf": RDF, "rdfs": RDFS, "owl": OWL, "xsd": XSD, "prov": PROV, "time": TIME, "dcat": DCAT, "crm": CRM, "crmdig": CRMDIG}


def iri(name: str, names: Names) -> str:
    prefix, _, local = name.partition(":")
    return _PUBLIC[prefix] + local if local else names.vocab + name


def class_edges(spark: SparkSession, names: Names = Names()) -> DataFrame:
    """(sub, sup) of the local classes and the external axioms."""
    rows = [(iri(c, names), iri(s, names)) for c, supers in CLASSES.items() for s in supers] + [(iri(a, names), iri(b, names)) for a, b in EXTERNAL_AXIOMS]
    return spark.createDataFrame(rows, "sub string, sup string")


def properties(spark: SparkSession, names: Names = Names()) -> DataFrame:
    rows = [(iri(p, names), iri(d, names), iri(r, names)) for p, d, r in PROPERTIES]
    return spark.createDataFrame(rows, "prop string, domain string, range string")


def _words(name: str) -> str:
    return "".join(f" {c.lower()}" if c.isupper() else c for c in name).strip()


def build_vocabulary(spark: SparkSession, names: Names = Names(), docs: dict[str, str] | None = None) -> DataFrame:
    """Triples of classes, subclasses and properties. A range outside XSD makes an object property. `docs`: local
    name to English description."""
    docs, rows = docs or {}, []
    onto = names.vocab.rstrip("#/")

    def add(s: str, p: str, o: str, kind: str = "iri", dt: str | None = None, lang: str | None = None) -> None:
        rows.append((s, p, o, kind, dt, lang))

    def describe(s: str, local: str) -> None:
        add(s, LABEL, _words(local), "lit", lang="en")
        add(s, RDFS + "isDefinedBy", onto)
        if local in docs:
            add(s, RDFS + "comment", docs[local], "lit", lang="en")

    add(onto, TYPE, OWL + "Ontology")
    for c in CLASSES:
        add(iri(c, names), TYPE, OWL + "Class")
        describe(iri(c, names), c)
    for p, domain, r in PROPERTIES:
        add(iri(p, names), TYPE, OWL + ("DatatypeProperty" if r.startswith("xsd:") else "ObjectProperty"))
        add(iri(p, names), RDFS + "domain", iri(domain, names))
        add(iri(p, names), RDFS + "range", iri(r, names))
        describe(iri(p, names), p)
    edges = class_edges(spark, names).select(F.col("sub").alias("s"), F.lit(SUBCLASS).alias("p"), F.col("sup").alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))
    return spark.createDataFrame(rows, TRIPLE).unionByName(edges)


def layer_edges(relations: DataFrame, layers: DataFrame) -> DataFrame:
    """(subject, predicate, object) with the layer of both ends; classes without one are external."""
    a, b = layers.select(F.col("cls").alias("subject"), F.col("layer").alias("subject_layer")), layers.select(F.col("cls").alias("object"), F.col("layer").alias("object_layer"))
    joined = relations.join(a, "subject", "left").join(b, "object", "left")
    return joined.select("subject", "predicate", "object", F.coalesce("subject_layer", F.lit("external")).alias("subject_layer"), F.coalesce("object_layer", F.lit("external")).alias("object_layer"))


def vocab_usage(edges: DataFrame, prefixes: dict[str, str], local: str) -> DataFrame:
    """prefix, n_classes: how many local classes hang directly under each external namespace."""
    prefix = F.lit(None).cast("string")
    for p, ns in reversed(list(prefixes.items())):
        prefix = F.when(F.col("sup").startswith(ns), p).otherwise(prefix)
    return edges.where(F.col("sub").startswith(local) & ~F.col("sup").startswith(local)).select(prefix.alias("prefix"), "sub").where("prefix is not null").groupBy("prefix").agg(F.count_distinct("sub").alias("n_classes"))


def undocumented_terms(terms: DataFrame, docs: DataFrame) -> DataFrame:
    return terms.select("term").distinct().join(docs.select("term"), "term", "left_anti")
