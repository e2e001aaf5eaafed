import pytest
from pyspark.sql import functions as F

from stratigraph.operators import compare, entailment, triples
from stratigraph.operators import patterns as P
from stratigraph.operators.vocabulary import LAYERS, RELATIONS, build_vocabulary, class_edges, iri, layer_edges, properties, undocumented_terms, vocab_usage
from stratigraph.params import CRM, PREFIXES, TYPE, Names
from stratigraph.plans import catalogue, driver_data
from stratigraph.sources import readers, writers
from stratigraph.sources.scratch import stored

SF = "/root/testdata/sf0.001"
T = "s string, p string, o string, o_kind string, o_dt string, o_lang string"


@pytest.fixture(scope="module")
def dated(spark):
    return driver_data._kept(spark, SF).where("the_id <= 3").cache()


@pytest.fixture(scope="module")
def graph(spark, dated):
    return stored(triples.build_graph(dated, driver_data.PARAMS, driver_data.AT, about={"title": 'a "title"\n'}), "graph")


def test_graph_is_a_set_in_any_order(spark, dated, graph):
    again = triples.build_graph(dated.orderBy(F.rand()).repartition(7), driver_data.PARAMS, "2025-02-03T00:00:00+00:00", about={"title": 'a "title"\n'})
    assert graph.count() == graph.distinct().count()
    assert compare.parity(graph, again).first().equal
    assert compare.graph_fingerprint(graph, mask_snapshot=False).first() != compare.graph_fingerprint(again, mask_snapshot=False).first()


def test_null_contract(dated, graph):
    n = dated.where("q_start is null").count()
    assert n and graph.where("p like '%undefinedMeasure' and o like '%qStart'").count() == n
    assert graph.where("p like '%qStart'").count() == dated.count() - n


def test_catalogue_and_round_trip(dated, graph):
    assert catalogue.require_non_empty(graph.where("p is not null"), {k: v for k, v in catalogue.CATALOGUE.items() if k != "crm-only"})
    flags = compare.round_trip(catalogue.figure_rows(graph), dated, catalogue.FIELD_PAIRS, [("site", "the_site"), ("findspot", "the_findspot")])
    assert {r.flag for r in flags.collect()} == {"OK"}
    assert catalogue.era(graph) == "historical" and catalogue.model(graph).first().tau == "20.0"
    assert catalogue.one_instance(graph, "Supplier").count() == 1 and catalogue.earliest_negative_start(graph).first().numeric < 0


def test_round_trip_sees_null_against_zero(spark):
    a, b = spark.createDataFrame([("k", 0.0)], "k string, x double"), spark.createDataFrame([("k", None)], "k string, x double")
    assert compare.round_trip(a, b, [("x", "x")], [("k", "k")]).first().flag == "XX"


def test_key_collision_stops(spark, dated):
    two = dated.limit(1).withColumn("the_findspot", F.explode(F.array(F.lit("a b"), F.lit("a-b"))))
    with pytest.raises(ValueError, match="share the fragment"):
        triples.build_keys(two, "slug")


def test_ntriples_round_trip(spark, graph, tmp_path):
    writers.write_ntriples(graph, str(tmp_path / "nt"))
    back, rejected = readers.read_ntriples(spark, str(tmp_path / "nt"))
    assert rejected.isEmpty() and compare.graph_diff(graph, back)[0].first() == (0, 0)


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "x.nt").write_text('<a> <b> "c\\\\n\\n"@en .\n# note\n\nbroken\n<a> <b> <c> .\n')
    good, bad = readers.read_ntriples(spark, str(tmp_path / "x.nt"))
    assert {r.o for r in good.collect()} == {"c\\n\n", "c"} and [r.value for r in bad.collect()] == ["broken"]


def test_csv_round_trip(spark, dated, tmp_path):
    writers.write_dated(dated, str(tmp_path / "csv"))
    back = readers.read_dated(spark, str(tmp_path / "csv"))
    cols = [c for c in dated.columns if c in back.columns]
    assert back.select(cols).exceptAll(dated.select(cols)).isEmpty() and back.count() == dated.count()


def test_null_tokens_and_bom(spark, tmp_path):
    (tmp_path / "d.csv").write_text("﻿THE_ID,the_site,q_start,k_is_fallback\n1,A,NULL,True\n,B,0.5,f\n", encoding="utf-8")
    rows = readers.read_dated(spark, str(tmp_path / "d.csv")).orderBy("the_site").collect()
    assert [tuple(r) for r in rows] == [(1, "A", None, True), (None, "B", 0.5, False)]
    with pytest.raises(ValueError, match="missing columns: z"):
        readers.resolve_columns(spark.range(1).withColumnRenamed("id", "ID"), ["id", "z"])


def test_sinks(spark, graph, tmp_path):
    writers.write_triples(graph, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == graph.count()
    assert writers.node_documents(graph, most=10**6).count() == graph.select("s").distinct().count()
    cut = writers.node_documents(graph, most=5)
    assert cut.select(F.size(F.from_json("document", "id string, statements array<struct<p:string,o:string>>").statements).alias("n")).agg(F.sum("n")).first()[0] == graph.count()
    writers.write_report(spark.createDataFrame([("k", "pass")], "key string, status string"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).columns == ["key", "status"]


def test_vocabulary(spark):
    v = build_vocabulary(spark)
    assert v.where(F.col("p") == TYPE).where("o like '%#Class'").count() == 12 and properties(spark).count() == 47
    usage = {r.prefix: r.n_classes for r in vocab_usage(class_edges(spark), PREFIXES, Names().vocab).collect()}
    assert usage["crm"] == 8 and usage["time"] == 4
    rel = spark.createDataFrame([(iri(a, Names()), iri(b, Names()), iri(c, Names())) for a, b, c in RELATIONS], "subject string, predicate string, object string")
    lay = spark.createDataFrame([(iri(c, Names()), x) for c, x in LAYERS.items()], "cls string, layer string")
    assert {r.object_layer for r in layer_edges(rel, lay).where("predicate like '%hasRow'").collect()} == {"presentation"}
    terms = spark.createDataFrame([("a",), ("b",)], "term string")
    assert [r.term for r in undocumented_terms(terms, terms.where("term = 'a'")).collect()] == ["b"]


def test_bundle_reaches_public_classes(spark, dated, graph):
    bundle = entailment.build_bundle(graph, build_vocabulary(spark), f"{Names().data}loc_ds_", iri("DiscoverySite", Names()), "http://example.org/bundle", [iri("Findspot", Names()), iri("crm:E53_Place", Names())]).cache()
    n, sites = dated.count(), dated.select("the_id").distinct().count()
    counts = {r.cls.rpartition("/")[2].rpartition("#")[2]: r.n for r in entailment.count_instances(bundle).collect()}
    assert counts["Findspot"] == n and counts["DiscoverySite"] == sites and counts["E53_Place"] == n + sites and counts["E52_Time-Span"] == 3 * n
    assert catalogue.crm_only(bundle).count() == n
    assert entailment.unanchored_instances(graph.unionByName(bundle.select(graph.columns)), "http://www.cidoc-crm.org/", ["http://www.w3.org/2002/07/owl#Class", "http://www.w3.org/2002/07/owl#ObjectProperty", "http://www.w3.org/2002/07/owl#DatatypeProperty", "http://www.w3.org/2002/07/owl#Ontology"]).isEmpty()


def test_bundle_stores_only_what_is_small(spark, dated, graph, monkeypatch):
    """Data is never stored again, and what data and vocabulary both say comes once."""
    rows, vocab = [], build_vocabulary(spark)
    monkeypatch.setattr(entailment, "stored", lambda df, *more: (out := stored(df, *more), rows.append(out.count()))[0])
    about = f"{Names().data}loc_ds_", iri("DiscoverySite", Names()), "http://example.org/bundle", [iri("Findspot", Names())]
    bundle = entailment.build_bundle(graph, vocab, *about)
    assert catalogue.crm_only(bundle).count() == dated.count()
    assert max(rows) < graph.count() / 5
    n = bundle.count()
    assert n == bundle.distinct().count() == entailment.build_bundle(graph.unionByName(vocab.limit(3)), vocab, *about).count()


def test_closure_of_cycles_and_diamonds(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("a", "e")], "sub string, sup string")
    found = {(r.cls, r.sup) for r in entailment.superclass_closure(edges).collect()}
    assert found == {(x, y) for x in "abc" for y in "abce" if x != y} | {("d", x) for x in "abce"}
    tree = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")], "sub string, sup string")
    assert {"".join(r.path) for r in entailment.superclass_paths(tree).where("cls = 'a'").collect()} == {"abd", "acd"}
    assert entailment.superclass_closure(edges.limit(0)).isEmpty()


def test_closure_of_a_deep_chain(spark):
    chain = spark.range(30).select(F.col("id").cast("string").alias("sub"), (F.col("id") + 1).cast("string").alias("sup"))
    assert entailment.superclass_closure(chain).count() == 31 * 30 // 2
    assert {len(r.path) for r in entailment.superclass_paths(chain.where("sub >= 24")).collect()} == {2, 3, 4, 5, 6, 7}


def test_bags_and_optional(spark):
    t = spark.createDataFrame([("a", "p", "x", "iri"), ("a", "p", "y", "iri"), ("x", "q", "1", "lit"), ("y", "q", "1", "lit"), ("b", "p", "1", "lit")], "s string, p string, o string, o_kind string").withColumns({"o_dt": F.lit(None).cast("string"), "o_lang": F.lit(None).cast("string")})
    assert [r.v for r in P.seq_path(t, "s", ["p", "q"], "v").collect()] == ["1", "1"]  # multiplicity stays, literals don't lead on
    b = P.optional(P.match(t, ("?s", "p", "?o")), t, [("?o", "q", "?v")])
    assert sorted((r.s, r.v) for r in b.collect() if r.v) == [("a", "1"), ("a", "1")] and b.count() == 3
    assert P.where_num(b, "v", ">", 0).count() == 2 and P.seeded(b, "s", "b").count() == 1
    with pytest.raises(ValueError, match="several values"):
        P.star(t, {"p": "p"}, check=True)
    assert P.construct(b, [("?s", "is", "?v")], frozenset({"v"})).count() == 1
    with pytest.raises(ValueError, match="empty"):
        P.cut(t, lambda g: P.reachable(g, "nobody", ["p"], 2))
    assert P.cut(t, lambda g: P.reachable(g, "a", ["p", "q"], 2)).count() == 4


def test_cuts(graph):
    seed = graph.where("p like '%P4_has_time-span'").first().s
    for build in (catalogue.cut_group, catalogue.cut_time_chain, catalogue.cut_provenance, catalogue.cut_types):
        assert build(graph, seed).count() > 1
    types, rest = entailment.fold_types(graph)
    assert types.count() > 0 and rest.where(F.col("p") == TYPE).isEmpty()


def test_cuts_by_template_for_many_seeds(spark, graph):
    """All seeds in one plan give what each seed gives alone; triples keep datatype and language."""
    seeds = graph.where(f"p = '{TYPE}' and o like '%#Findspot'").select(F.col("s").alias("fs"))
    there, first = {tuple(r) for r in graph.select(*T.replace(" string", "").split(", ")).collect()}, seeds.agg(F.min("fs").alias("fs"))
    for name in ("group", "time-chain", "provenance", "types"):
        every = [tuple(r) for r in catalogue.cuts(graph, seeds.unionByName(seeds), name).collect()]
        assert every and len(every) == len(set(every))
        alone = [tuple(r) for r in catalogue.cuts(graph, first, name).collect()]
        assert set(alone) == {r for r in every if r[0] == min(x[0] for x in every)} and len({r[0] for r in every}) > 1
        assert {r[1:] for r in every if not r[2].endswith(("#type", "#used"))} <= there
    assert catalogue.cuts(graph, spark.createDataFrame([("nobody",)], "fs string"), "group").isEmpty()


def test_optionals_of_templates(spark):
    t = spark.createDataFrame([("a", "p", "b", "iri", None, None), ("b", "q", "1", "lit", "int", None), ("b", "q", "x", "lit", None, "en"), ("c", "p", "d", "iri", None, None)], T)
    template = P.Template([("?s", "p", "?o")], [[("?o", "q", "?v")]], [("?s", "is", "?v"), ("?s", "p", "?o"), ("?v", "of", "?s")])
    got = {tuple(r) for r in P.construct_for(t, spark.createDataFrame([("a",), ("c",), ("z",)], "s string"), template).collect()}
    assert {r[1:] for r in got if r[2] == "is"} == {("a", "is", "1", "lit", "int", None), ("a", "is", "x", "lit", None, "en")}
    assert {r[1:4] for r in got if r[2] == "p"} == {("a", "p", "b"), ("c", "p", "d")}
    with pytest.raises(ValueError, match="shares no variable"):
        P.extended(spark.createDataFrame([("a",)], "z string"), t, [("?s", "p", "?o")])


def test_many_solutions_of_few_values_do_not_meet(spark):
    """What all seeds share (an agent) is joined as a small table, not by a shuffle over its one value."""
    rows = [x for i in range(300) for x in ((f"a{i}", "by", "agent", "iri", None, None), (f"a{i}", "label", f"A {i}", "lit", None, "en"))]
    t = spark.createDataFrame([*rows, ("agent", "label", "the agent", "lit", None, "en"), ("agent", "home", "x", "iri", None, None)], T)
    template = P.Template([("?s", "by", "?ag"), ("?ag", "label", "?name")], [[("?ag", "home", "?h")], [("?ag", "mail", "?m")]], [("?s", "by", "?ag"), ("?ag", "label", "?name"), ("?ag", "home", "?h"), ("?ag", "mail", "?m")])
    found = P.construct_for(t, spark.createDataFrame([(f"a{i}",) for i in range(0, 300, 3)], "s string"), template)
    assert "hashpartitioning(ag#" not in found._jdf.queryExecution().executedPlan().toString()
    got = {tuple(r) for r in found.collect()}
    assert got == {(f"a{i}", *x) for i in range(0, 300, 3) for x in ((f"a{i}", "by", "agent", "iri", None, None), ("agent", "label", "the agent", "lit", None, "en"), ("agent", "home", "x", "iri", None, None))}


@pytest.mark.parametrize("most", [1, 7, 10_000])
def test_concatenation_in_parts(spark, most):
    rows = [("big", f"v{i % 90:02}") for i in range(100)] + [("small", "x"), ("none", None), (None, "y")]
    df = spark.createDataFrame(rows, "k string, v string").repartition(5)
    got = {(r.k, r.part): r.names for r in P.group_concat_parts(df, ["k"], "v", "|", most).where("k is not null").collect()}
    wanted = {}
    for k in ("big", "small"):
        values = sorted(v for x, v in rows if x == k)
        wanted |= {(k, i // most): "|".join(values[i : i + most]) for i in range(0, len(values), most)}
    assert got == wanted


def test_graph_with_everything(spark, dated):
    """Geometry, references and metadata are in the graph if they are given."""
    placed = dated.withColumns({"long": F.lit(7.5), "lat": F.when(F.col("the_id") == 1, 50.0)})
    refs = spark.createDataFrame([(r.the_site, r.the_findspot) for r in dated.limit(2).collect()] + [("no", "where")], "the_site string, the_findspot string")
    about = {"title": "t", "rights": "r", "license": "http://l", "basis": "b", "model": "m"}
    full = triples.build_graph(placed, driver_data.PARAMS, driver_data.AT, geometry=True, references=refs, about=about)
    plain = triples.build_graph(dated, driver_data.PARAMS, driver_data.AT)
    more = full.select("s", "p", "o").subtract(plain.select("s", "p", "o")).collect()
    last = lambda x: x.rpartition("/")[2].rpartition("#")[2]
    assert sorted(last(r.p) for r in more) == sorted(["hasGeometry", "asWKT", "calibratedAgainst", "calibratedAgainst", "title", "rights", "license", "calibrationBasis", "label"])
    assert [r.o for r in more if r.p.endswith("asWKT")] == ["<http://www.opengis.net/def/crs/EPSG/0/4326> POINT(7.5 50.0)"]


def test_patterns_read_their_own_branch(spark, dated):
    """By predicate it is the same graph, and a pattern scans the groups once, for its predicate (or type) alone."""
    keyed = stored(triples.keyed_groups(dated), "keyed")
    made = triples.Graph(driver_data.PARAMS, driver_data.AT)
    parts, whole = made.by_predicate(keyed), made.whole(keyed)
    assert parts.exceptAll(whole).isEmpty() and whole.exceptAll(parts).isEmpty()
    for pattern in (("?fs", CRM + "P4_has_time-span", "?ts"), ("?ts", TYPE, driver_data.N.vocab + "FindspotDating")):
        plan = P.match(parts, pattern)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "Union" not in plan


def test_plans_of_patterns_are_short_and_send_no_side(spark):
    """A query plans the branches of its patterns alone, and no side that grows with the groups goes through the driver."""
    t = driver_data.graph(spark, SF)
    for query, most in ((catalogue.crm_path_count, 8), (catalogue.dated_findspots, 40), (catalogue.figure_rows, 60), (lambda g: catalogue.one_instance(g, "Brand"), 40)):
        plan = query(t)._jdf.queryExecution()
        assert plan.analyzed().toString().count("Relation [") <= most
        assert "BroadcastExchange" not in plan.executedPlan().toString()
    hub = catalogue.era_and_scale(t)._jdf.queryExecution()  # the year scale alone is sent
    assert hub.analyzed().toString().count("Relation [") <= 40 and hub.executedPlan().toString().count("BroadcastHashJoin") == 1


def test_branches_hold_the_whole_graph(spark, dated):
    keyed = stored(triples.keyed_groups(dated), "keyed")
    made = triples.Graph(driver_data.PARAMS, driver_data.AT)
    parts, whole = made.branches(keyed), made.by_predicate(keyed)
    for p in [r.p for r in whole.select("p").distinct().collect()][:6] + [TYPE, driver_data.LABEL]:
        one, other = parts.of([p]), whole.where(F.col("p") == p)
        assert one.count() == other.count() and one.exceptAll(other).isEmpty()
    assert parts.of(["nothing"]).isEmpty()
    kind = Names().vocab + "Findspot"
    assert P.match(parts, ("?s", TYPE, kind)).count() == P.match(whole, ("?s", TYPE, kind)).count() == dated.count()
