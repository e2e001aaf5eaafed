"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from stratigraph.plans import driver_calibration, driver_data, driver_graph  # noqa: F401  (registers their queries)
from stratigraph.plans.driver_data import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{SF}/{t}'")
    return c


def plain(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    result = db.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    wanted = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == wanted


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_document_slugs_read_whole_texts(spark, tmp_path):
    rows = [(1, "First line\nSecond line\n\nthird"), (2, "\nafter an empty line"), (3, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.slug for r in driver_data.document_slugs(spark, str(tmp_path)).collect()}
    assert found == {1: "first_line_second_line_third", 2: "after_an_empty_line", 3: None}


def test_names_that_share_a_fragment(spark, tmp_path):
    """Two brands of one supplier whose hashes begin alike (the first such case by number): the graph has them at one node,
    as its SQL has, and what reads the groups' rows back keeps both."""
    with duckdb.connect() as c:
        for t in ("part", "lineitem", "supplier", "nation"):
            c.execute(f"create table {t} as select * from '{SF}/{t}.parquet'")
        s, a, b = 129702, *[r[0] for r in c.execute("select min(p_partkey) from part where p_partkey % 97 between 20 and 80 group by p_brand order by p_brand limit 2").fetchall()]
        c.execute("update part set p_brand = 'Brand#90' where p_brand in ('Brand#17', 'Brand#20')")
        c.execute(f"update part set p_brand = case p_partkey when {a} then 'Brand#17' else 'Brand#20' end where p_partkey in ({a}, {b})")
        c.execute(f"insert into supplier select * replace ({s} as s_suppkey, 'Supplier#000129702' as s_name) from supplier limit 1")
        for p in (a, b):
            c.execute(f"insert into lineitem select * replace ({p} as l_partkey, {s} as l_suppkey, 'A' as l_returnflag, 'F' as l_linestatus, 1 as l_linenumber) from lineitem limit 5")
        for t in ("part", "lineitem", "supplier", "nation"):
            c.execute(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
        c.execute("set threads = 1")
        clash = c.execute(f"{driver_data._SQL} select key from dated group by key having count(*) > 1").fetchall()
        assert len(clash) == 1 and clash[0][0].startswith("129702_")
        for name in ("build_graph", "node_json", "ntriples_round_trip", "graph_fingerprint", "graph_digest", "qry_crm_path_count", "qry_one_instance", "qry_dated_findspots", "emit_measures", "resolved_references"):
            df, result = QUERIES[name](spark, str(tmp_path)), c.execute(ORACLE[name])
            names = [d[0] for d in result.description]
            wanted = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in result.fetchall())
            assert sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()) == wanted, name


def test_vocabulary_in_use_reads_the_graph_once(spark):
    """Every predicate and type in one pass, and not a scan for each branch."""
    plan = driver_graph.vocabulary_in_use(spark, SF)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [") <= 20
