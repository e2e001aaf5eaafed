"""Graph patterns over triples as DataFrame joins. Solutions are bags: nothing is made distinct unless asked for.

A pattern is (subject, predicate, object): `?x` names a variable, anything else is a constant; predicates are constants.
Every pattern fixes its predicate, so over triples stored by predicate each reads one partition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import in_ranges, stored
from .triples import Branches

Pattern = tuple[str, str, str]
Triples = DataFrame | Branches


def of(t: Triples, predicates: list[str], s: str | None = None, o: str | None = None) -> DataFrame:
    """The triples of some predicates. s, o: of branches, those with another constant are left out."""
    return t.of(predicates, s, o) if isinstance(t, Branches) else t.where(F.col("p").isin(predicates))


def unsent(t: Triples, df: DataFrame) -> DataFrame:
    """A side of a join that is made of branches. The planner takes it for many times smaller than it is, as it knows nothing
    of the lengths of IRIs that are put together, and would send all of it to the driver and every executor."""
    return df.hint("merge") if isinstance(t, Branches) else df


def _constant(x: str) -> str | None:
    return None if x.startswith("?") else x


def _side(t: Triples, pattern: Pattern, df: DataFrame) -> DataFrame:
    s, p, o = pattern
    return unsent(t, df) if isinstance(t, Branches) and t.grows([p], _constant(s), _constant(o)) else df


def match(t: Triples, pattern: Pattern) -> DataFrame:
    """Solutions of one pattern: one column for each variable."""
    s, p, o = pattern
    rows = of(t, [p], _constant(s), _constant(o))
    if not s.startswith("?"):
        rows = rows.where(F.col("s") == s)
    if not o.startswith("?"):
        rows = rows.where(F.col("o") == o)
    if s == o and s.startswith("?"):
        rows = rows.where(F.col("s") == F.col("o"))
    out = {}
    if s.startswith("?"):
        out[s[1:]] = F.col("s")
    if o.startswith("?"):
        out[o[1:]] = F.col("o")
    return rows.select(*[c.alias(v) for v, c in out.items()])


def _join(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    shared = [c for c in a.columns if c in b.columns]
    return a.join(b, shared, how) if shared else (a.crossJoin(b) if how == "inner" else a.join(b, F.lit(True), how))


def bgp(t: Triples, patterns: list[Pattern]) -> DataFrame:
    """All patterns together, joined on the variables they share, each pattern next to one it shares a variable with."""
    left = list(patterns)
    out = match(t, left.pop(0))
    while left:
        at = next((i for i, (s, _, o) in enumerate(left) if {s[1:] if s[0] == "?" else None, o[1:] if o[0] == "?" else None} & set(out.columns)), 0)
        pattern = left.pop(at)
        out = _join(out, _side(t, pattern, match(t, pattern)), "inner")
    return out


def optional(b: DataFrame, t: Triples, patterns: list[Pattern]) -> DataFrame:
    """Keeps solutions without a match; their new variables are null."""
    return _join(b, unsent(t, bgp(t, patterns)), "left")


def seq_path(t: Triples, subject: str, predicates: list[str], obj: str) -> DataFrame:
    """subject p1/p2/... object, with multiplicity; only IRIs lead on."""
    out = of(t, predicates[:1]).select(F.col("s").alias(subject), F.col("o").alias("_o"), F.col("o_kind").alias("_kind"))
    for p in predicates[1:]:
        step = of(t, [p]).select(F.col("s").alias("_s"), F.col("o").alias("_next"), F.col("o_kind").alias("_next_kind"))
        out = out.where("_kind = 'iri'").join(_side(t, ("?s", p, "?o"), step), F.col("_o") == F.col("_s")).select(subject, F.col("_next").alias("_o"), F.col("_next_kind").alias("_kind"))
    return out.select(subject, F.col("_o").alias(obj))


def join_subselect(b: DataFrame, sub: DataFrame) -> DataFrame:
    return _join(b, sub, "inner")


def seeded(b: DataFrame, var: str, value: str) -> DataFrame:
    """Pins a variable; Catalyst carries the filter down to the patterns."""
    return b.where(F.col(var) == value)


def star(t: Triples, required: dict[str, str], optionals: dict[str, str] = {}, subject: str = "s", check: bool = False) -> DataFrame:
    """Single-valued predicates of one subject as one wide row, by one shuffle: column name to predicate.

    check: raises where a predicate has several values for a subject, as the row would hide them (a bag join of
    patterns is right there)."""
    wanted = required | optionals
    rows = of(t, list(wanted.values()))
    if check and (twice := rows.groupBy("s", "p").count().where("count > 1").limit(1).collect()):
        raise ValueError(f"{twice[0].p} has several values for {twice[0].s}")
    one = lambda p: F.max(F.when(F.col("p") == p, F.col("o")))
    out = rows.groupBy(F.col("s").alias(subject)).agg(*[one(p).alias(c) for c, p in wanted.items()])
    return out.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])) if required else out


def where_num(b: DataFrame, var: str, op: str, value: float) -> DataFrame:
    """Numeric filter; unbound or non-numeric drops the row."""
    x = F.col(var).try_cast("double")
    return b.where({"<": x < value, "<=": x <= value, ">": x > value, ">=": x >= value, "=": x == value, "!=": x != value}[op])


def where_contains(b: DataFrame, var: str, s: str) -> DataFrame:
    return b.where(F.col(var).contains(s))


def bind(b: DataFrame, name: str, expr: Column) -> DataFrame:
    return b.withColumn(name, expr)


def rename_fields(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in pairs])


def count_distinct_by(b: DataFrame, keys: list[str], var: str, name: str = "n", having: int | None = None) -> DataFrame:
    out = b.groupBy(*keys).agg(F.count_distinct(var).alias(name))
    return out if having is None else out.where(F.col(name) > having)


def group_concat(b: DataFrame, keys: list[str], var: str, sep: str, distinct: bool = False, name: str = "names") -> DataFrame:
    """Values joined in sorted order, so that the result doesn't depend on how rows arrive."""
    values = F.sort_array(F.collect_set(var) if distinct else F.collect_list(var))
    return b.groupBy(*keys).agg(F.array_join(values, sep).alias(name))


def group_concat_parts(b: DataFrame, keys: list[str], var: str, sep: str, most: int = 1000, name: str = "names") -> DataFrame:
    """keys, part, name: values joined in sorted order, `most` of them in a row, so that no row grows with its group. Values
    are put in order by ranges over keys and values and counted through the ranges, so no task holds a group either."""
    ranges = in_ranges(b.where(F.col(var).isNotNull()).select(*keys, F.col(var).alias("_value")), *keys, "_value")
    sizes = ranges.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))  # a row for each group and range
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = ranges.join(sizes.select(*keys, "_part", before.alias("_before")), [*keys, "_part"])
    place = F.col("_before") + F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("_value")) - 1
    parts = joined.select(*keys, F.floor(place / most).cast("int").alias("part"), "_value")
    return parts.groupBy(*keys, "part").agg(F.array_join(F.sort_array(F.collect_list("_value")), sep).alias(name))


def count_solutions(b: DataFrame) -> DataFrame:
    return b.agg(F.count("*").alias("n"))


def order_rows(b: DataFrame, *keys: str) -> DataFrame:
    """`-x` is descending; unbound values come first ascending, last descending."""
    return b.orderBy(*[F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_first() for k in keys])


def limit_n(b: DataFrame, n: int, *keys: str) -> DataFrame:
    return (order_rows(b, *keys) if keys else b).limit(n)


def preview(b: DataFrame, max_rows: int = 500) -> tuple[DataFrame, DataFrame]:
    """(at most max_rows rows, one row with the true total)."""
    return b.limit(max_rows), b.agg(F.count("*").alias("total"))


# construction
def construct(b: DataFrame, templates: list[Pattern], literals: frozenset[str] = frozenset()) -> DataFrame:
    """Solutions to a set of triples; a template with an unbound variable is skipped. literals: variables whose values
    are literals."""
    term = lambda x: F.col(x[1:]) if x.startswith("?") else F.lit(x)
    null = F.lit(None).cast("string")
    rows = F.array(*[F.struct(term(s).alias("s"), F.lit(p).alias("p"), term(o).cast("string").alias("o"), F.lit("lit" if o[1:] in literals and o.startswith("?") else "iri").alias("o_kind"), null.alias("o_dt"), null.alias("o_lang")) for s, p, o in templates])
    return b.select(F.explode(rows).alias("t")).select("t.*").where("s is not null and o is not null").distinct()


class Template(NamedTuple):
    """A CONSTRUCT: what has to be there, what may be there, and the triples that are made of it."""

    where: list[Pattern]
    optionals: list[list[Pattern]]
    made: list[Pattern]


def _terms(t: Triples, pattern: Pattern, known: set[str]) -> DataFrame:
    """Solutions of one pattern with the kind, datatype and language of an object that isn't bound yet."""
    s, p, o = pattern
    out = match(t, pattern)
    if not o.startswith("?") or o[1:] in known or s == o:
        return out
    rows = of(t, [p], _constant(s))
    rows = rows if s.startswith("?") else rows.where(F.col("s") == s)
    more = [F.struct("o_kind", "o_dt", "o_lang").alias(f"{o[1:]} term")]
    return rows.select(*([F.col("s").alias(s[1:])] if s.startswith("?") else []), F.col("o").alias(o[1:]), *more)


#: A variable with at most so many values in the whole graph, each of them an object so many times on average, is a hub.
HUB, HUB_ROWS = 1000, 100


def hubs(t: Triples, patterns: list[Pattern], known: list[str]) -> dict[str, DataFrame]:
    """Variables that lead from many solutions to few values (an agent, a model), with these values, stored: joined row by
    row to what is said of them, all solutions of a value would meet in one task."""
    leads = {o[1:]: (s, p, o) for s, p, o in patterns if o.startswith("?") and o[1:] not in known and any(q[0] == o for q in patterns)}
    if not leads:
        return {}
    found = of(t, [p for _, p, _ in leads.values()]).groupBy("p").agg(F.count("*").alias("n"), F.approx_count_distinct("o").alias("values"))
    few = {r.p for r in found.collect() if r["values"] <= HUB and r.n >= HUB_ROWS * r["values"]}
    return {v: stored(match(t, q).select(v).distinct(), "hub") for v, q in leads.items() if q[1] in few}


def extended(b: DataFrame, t: Triples, patterns: list[Pattern], how: str = "inner", values: dict[str, DataFrame] = {}) -> DataFrame:
    """Solutions b and what the patterns add to them; only rows that b leads to travel on. how: `left` keeps solutions
    without a match of all patterns together. values: those of hubs; what is said of them is a small stored table and
    joined last."""
    left, out = list(patterns), b
    once = lambda o: not o.startswith("?") or o[1:] not in b.columns and sum(o in (q[0], q[2]) for q in patterns) == 1
    few = {v: own for v in values if (own := [q for q in left if q[0] == f"?{v}" and once(q[2])])}
    if how == "left" and (hub := next((v for v, own in few.items() if len(own) == len(left)), None)) in b.columns:
        return _join(b, stored(extended(F.broadcast(values[hub]), t, left), "hub"), "left")
    if how == "left":
        own = [v[1:] for q in patterns for v in (q[0], q[2]) if v.startswith("?")]
        shared = [c for c in b.columns if c in own]
        return b.join(unsent(t, extended(b.select(*shared).distinct(), t, patterns)), shared, "left")
    left = [q for q in left if not any(q in own for own in few.values())]
    few = {v: stored(extended(F.broadcast(values[v]), t, own), "hub") for v, own in few.items()}  # at most HUB values
    while left or few:
        at = next((i for i, (s, _, o) in enumerate(left) if {s[1:], o[1:]} & set(out.columns)), None)
        if at is None and (hub := next((v for v in few if v in out.columns), None)):
            out = _join(out, few.pop(hub), "inner")
            continue
        if at is None:
            raise ValueError(f"{left[0] if left else list(few)} shares no variable with the solutions")
        pattern = left.pop(at)
        out = _join(out, _side(t, pattern, _terms(t, pattern, set(out.columns))), "inner")
    return out


def bgp_of_hubs(t: Triples, patterns: list[Pattern]) -> DataFrame:
    """All patterns together as `bgp` joins them, but what is said of hubs is joined last, as a small stored table."""
    out = extended(match(t, patterns[0]), t, patterns[1:], values=hubs(t, patterns, []))
    return out.select(*[c for c in out.columns if not c.endswith(" term")])


def construct_for(t: Triples, seeds: DataFrame, template: Template) -> DataFrame:
    """The template's triples around each seed, all seeds in one plan: the columns of `seeds` (variables of the template),
    s, p, o, o_kind, o_dt, o_lang. A triple with an unbound variable isn't made; each comes once a seed."""
    few = hubs(t, template.where + [q for patterns in template.optionals for q in patterns], seeds.columns)
    b = extended(seeds.distinct(), t, template.where, values=few)
    for patterns in template.optionals:
        b = extended(b, t, patterns, "left", few)
    value = lambda x: F.col(x[1:]) if x.startswith("?") else F.lit(x)
    iri = F.struct(F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))
    term = lambda x: F.col(f"`{x[1:]} term`") if x.startswith("?") and f"{x[1:]} term" in b.columns else iri
    rows = F.array(*[F.struct(value(s).alias("s"), F.lit(p).alias("p"), value(o).alias("o"), term(o).alias("t")) for s, p, o in template.made])
    found = b.select(*seeds.columns, F.explode(rows).alias("r")).where("r.s is not null and r.o is not null")
    return found.select(*seeds.columns, "r.s", "r.p", "r.o", "r.t.o_kind", "r.t.o_dt", "r.t.o_lang").distinct()


def reachable(t: Triples, seed: str, predicates: list[str], steps: int) -> DataFrame:
    """Triples on the way from a seed along some predicates, up to so many steps, with the types and labels on it."""
    edges = of(t, predicates)
    nodes = t.sparkSession.range(1).select(F.lit(seed).alias("s"))
    found = []
    for _ in range(steps):
        out = stored(edges.join(nodes, "s", "left_semi"), "reached")  # so the next step's join knows how few they are
        found.append(out)
        nodes = out.where("o_kind = 'iri'").select(F.col("o").alias("s")).distinct()
    return reduce(DataFrame.unionByName, found).distinct()


def cut(t: Triples, build: Callable[[Triples], DataFrame]) -> DataFrame:
    """A named sub-graph; an empty one is an error."""
    out = build(t)
    if out.isEmpty():
        raise ValueError("the cut is empty: its seed isn't in the graph")
    return out
