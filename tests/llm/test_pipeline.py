import corpus_pipeline
from pyspark.sql import functions as F


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("kept", F.lit("clashes"))
    odd = spark.createDataFrame([(None, None, None, None, None, "x"), (100_000, "", "en", "s", 0, "x"), (100_001, "12 34", None, None, 5, "x")], docs.schema)
    docs = docs.unionByName(odd).cache()
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[0] == 200 and sizes[1] == 200 and sizes[1] > sizes[2] > sizes[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == sizes[3] and last.where("not exact").isEmpty()


def test_pipeline_with_ids_of_text(spark):
    """Ids that aren't whole numbers are null ids; their rows stay."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("doc_id", F.col("doc_id").cast("string"))
    odd = spark.createDataFrame([("x1", "a walk along the river in the morning with my brother", "en", "s", 0), ("2.5", None, "en", "s", 0)], "doc_id string, text string, lang string, source string, n_chars long").select(*docs.columns)
    docs = docs.unionByName(odd).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
    left = {r.doc_id for r in docs.collect()}
    numbers = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        numbers = stage(spark, numbers, sf).cache()
    assert left - {"x1", "2.5"} == {str(r.doc_id) for r in numbers.collect()} and "x1" in left


def test_pipeline_of_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_pipeline_equals_brute_force(spark):
    """All five stages in plain Python over whole texts; the language model's rows are rejected one by one."""
    import collections
    import itertools
    import re

    import sentencepiece

    from stratigraph.llm import langid, sentencepiece_fst

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = {r.doc_id: r.text for r in table.collect()}
    model = langid.fit(table)
    docs = {i: t for i, t in docs.items() if not model.predict(t, langid.REACH)[2]}

    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    where = collections.defaultdict(set)
    for i, t in docs.items():
        for line in (t or "").split("\n"):
            where[key(line)].add(i)
    goes = lambda i, line: len(key(line)) >= 20 and len(where[key(line)]) >= 3 and max(where[key(line)]) != i
    docs = {i: "\n".join(x for x in (t or "").split("\n") if not goes(i, x)) for i, t in docs.items()}

    words = {i: lower(t).split() for i, t in docs.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in words.items()}
    part = {i: i for i in sets}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if (both := len(sets[a] & sets[b])) and 100 * both >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in linked:
            part[a] = part[b] = min(part[a], part[b])
    docs = {i: t for i, t in docs.items() if part[i] == i}

    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {tuple(w[k : k + 10]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [terms(r.text)] for k in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(w) for w in windows}
    leaks = lambda t: any(tuple(w[k : k + n]) in windows for w in [terms(t)] for n in sizes for k in range(len(w) - n + 1))
    docs = {i: t for i, t in docs.items() if not leaks(t)}

    library = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_fst.read_model(spark))
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert found == {i: library.encode(t) for i, t in docs.items()} and 0 < len(found) < 200
