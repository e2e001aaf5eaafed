"""Parameters of the dating model and names of the graph's vocabulary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class DatingParams:
    """Coverage factor between k_min and k_max with saturation tau, weight w, reference length t0; and input filters."""

    k_min: float = 0.5
    k_max: float = 1.5
    tau: float = 20.0
    w: float = 1.0
    t0: float = 20.0
    date_flag: str = "Θ"
    site_flag: str = "Σ"
    excluded_ends: tuple[int, ...] = (260, 120, 150)


def params_df(spark: SparkSession, p: DatingParams) -> DataFrame:
    """The parameters as a relation of one row."""
    return spark.createDataFrame([(p.k_min, p.k_max, p.tau, p.w, p.t0)], "k_min double, k_max double, tau double, w double, t0 double")


@dataclass(frozen=True)
class Names:
    """Namespaces of the graph; vocabulary and data ones are the user's own."""

    vocab: str = "http://example.org/ontology#"
    data: str = "http://example.org/data/"
    external_ids: str = "https://example.org/places/"


#: Public namespaces (fixed values).
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
DCTERMS = "http://purl.org/dc/terms/"
DCAT = "http://www.w3.org/ns/dcat#"
PROV = "http://www.w3.org/ns/prov#"
TIME = "http://www.w3.org/2006/time#"
GEO = "http://www.opengis.net/ont/geosparql#"
CRM = "http://www.cidoc-crm.org/cidoc-crm/"
CRMDIG = "http://www.ics.forth.gr/isl/CRMdig/"

PREFIXES = {"rdf": RDF, "rdfs": RDFS, "owl": OWL, "xsd": XSD, "skos": SKOS, "dcterms": DCTERMS, "dcat": DCAT, "prov": PROV, "time": TIME, "geo": GEO, "crm": CRM, "crmdig": CRMDIG}

TYPE = RDF + "type"
LABEL = RDFS + "label"
SUBCLASS = RDFS + "subClassOf"
