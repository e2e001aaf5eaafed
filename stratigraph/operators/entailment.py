"""Entailment: superclass closure and paths, materialised types, class counts, instances without an anchor."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import SUBCLASS, TYPE, XSD
from ..sources.scratch import stored
from .compare import distinct_triples
from .triples import by_predicate, node, text


def superclass_closure(edges: DataFrame) -> DataFrame:
    """(cls, sup): every superclass over any number of steps, itself excluded; safe on cycles. Each round doubles the
    number of steps and is stored, so the plan stays short and a tree of depth d takes log2(d) + 1 rounds."""
    known = stored(edges.select(F.col("sub").alias("cls"), "sup").where("cls <> sup").distinct(), "closure")
    n = known.count()
    while n:
        above = known.select(F.col("cls").alias("sup"), F.col("sup").alias("above"))
        further = known.join(above, "sup").select("cls", F.col("above").alias("sup")).where("cls <> sup")
        known, before = stored(known.unionByName(further).distinct(), "closure"), n
        n = known.count()
        if n == before:
            break
    return known


def superclass_paths(edges: DataFrame) -> DataFrame:
    """(cls, path): every way from a class up to a root, as an array that begins with the class. Each round is stored."""
    step = stored(edges.select(F.col("sub").alias("top"), F.col("sup").alias("above")).where("top <> above").distinct(), "steps")
    walks = step.select(F.col("top").alias("cls"), F.array("top", "above").alias("path"), F.col("above").alias("top"))
    done = []
    while True:
        longer = stored(walks.join(step, "top", "left").where(F.col("above").isNull() | ~F.array_contains("path", F.col("above"))), "walks")
        done.append(longer.where("above is null").select("cls", "path"))
        walks = longer.where("above is not null").select("cls", F.array_append("path", F.col("above")).alias("path"), F.col("above").alias("top"))
        if walks.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _type_triples(df: DataFrame) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.select("s", F.lit(TYPE).alias("p"), F.col("cls").alias("o"), F.lit("iri").alias("o_kind"), null.alias("o_dt"), null.alias("o_lang"))


def subjects_with_prefix(t: DataFrame, prefix: str) -> DataFrame:
    return t.where(F.col("s").startswith(prefix)).select("s").distinct()


def has_no_type(t: DataFrame) -> DataFrame:
    return t.select("s").distinct().join(t.where(F.col("p") == TYPE).select("s").distinct(), "s", "left_anti")


def type_referenced_sites(t: DataFrame, prefix: str, cls: str) -> DataFrame:
    """Type statements for untyped subjects under a prefix."""
    return _type_triples(has_no_type(t.where(F.col("s").startswith(prefix))).withColumn("cls", F.lit(cls)))


def join_type_closure(t: DataFrame, closure: DataFrame) -> DataFrame:
    """(s, cls): every superclass of every instance's types."""
    return t.where(F.col("p") == TYPE).select("s", F.col("o").alias("cls")).join(closure, "cls").select("s", F.col("sup").alias("cls")).distinct()


def inferred_types(t: DataFrame, closure: DataFrame) -> DataFrame:
    """The type statements that the closure adds."""
    return _type_triples(join_type_closure(t, closure)).join(t.where(F.col("p") == TYPE).select("s", "o"), ["s", "o"], "left_anti").select("s", "p", "o", "o_kind", "o_dt", "o_lang")


def materialise_types(t: DataFrame, closure: DataFrame) -> DataFrame:
    return t.unionByName(inferred_types(t, closure))


def count_instances(t: DataFrame, classes: list[str] | None = None) -> DataFrame:
    types = t.where(F.col("p") == TYPE)
    return (types.where(F.col("o").isin(classes)) if classes else types).groupBy(F.col("o").alias("cls")).agg(F.count_distinct("s").alias("n"))


def describe_graph(t: DataFrame, classes: list[str], about: str, vocab: str) -> DataFrame:
    """Class counts as triples, one node for each class."""
    at = F.concat(F.lit(f"{about}#count_"), F.sha2("cls", 256))
    return by_predicate(stored(count_instances(t, classes), "counts"), [node(about, f"{vocab}classPartition", at), node(at, f"{vocab}class", F.col("cls")), text(at, f"{vocab}entities", F.col("n"), XSD + "integer")])


def build_bundle(data: DataFrame, vocab: DataFrame, prefix: str, site_class: str, about: str, classes: list[str], stats_vocab: str = "http://rdfs.org/ns/void#") -> DataFrame:
    """Data and vocabulary (sets both), untyped sites typed, all inferred types written out, and the graph's own counts.
    Stored are the vocabulary with what the data says of its terms, the sites and the counts; the rest stays a union, so
    that a pattern over the bundle makes the triples that it reads and no others."""
    terms = stored(distinct_triples(vocab), "vocabulary")
    named = [r.s for r in terms.select("s").distinct().collect()]
    known = stored(data.where(F.col("s").startswith(prefix) | F.col("s").isin(named)), "known")
    merged = data.unionByName(stored(terms.exceptAll(known.select(terms.columns)), "terms"))
    typed = merged.unionByName(stored(type_referenced_sites(known.unionByName(terms), prefix, site_class), "sites"))
    full = materialise_types(typed, superclass_closure(typed.where(F.col("p") == SUBCLASS).select(F.col("s").alias("sub"), F.col("o").alias("sup"))))
    return full.unionByName(describe_graph(full, classes, about, stats_vocab))


def anchoring(t: DataFrame, ns: str, vocabulary_types: list[str]) -> DataFrame:
    """s, anchored (a type in ns), vocabulary (a type of vocabulary terms) for every typed subject."""
    return t.where(F.col("p") == TYPE).groupBy("s").agg(F.bool_or(F.col("o").startswith(ns)).alias("anchored"), F.bool_or(F.col("o").isin(vocabulary_types)).alias("vocabulary"))


def unanchored_instances(t: DataFrame, ns: str, vocabulary_types: list[str]) -> DataFrame:
    return anchoring(t, ns, vocabulary_types).where("not anchored and not vocabulary").select("s")


def count_anchored(t: DataFrame, ns: str, vocabulary_types: list[str]) -> DataFrame:
    return anchoring(t, ns, vocabulary_types).where("not vocabulary").agg(F.count("*").alias("n_instances"), F.count_if("anchored").alias("n_anchored"))


def fold_types(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(s, types sorted), and the statements that aren't types."""
    return t.where(F.col("p") == TYPE).groupBy("s").agg(F.sort_array(F.collect_set("o")).alias("types")), t.where(F.col("p") != TYPE)
