"""Collocations, byte-level BPE and fill-in-middle against brute force and the library, and cases that all operators share."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratigraph.llm import byte_bpe, chat, collocations, decontamination, fill_in_middle, hashing, html_text, langid, line_dedup, minhash, sentencepiece_fst, suffix_dedup, topk
from stratigraph.llm.common import small_batches

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, n int, w1 string, id string"  # columns that clash with names the operators use


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", "i") for r in rows], DOCS).repartition(4)


# 11
def corpus():
    rng = random.Random(8)
    fixed = ["new york city hall", "as soon as possible", "Ünter den linden", "the the the the the the"]
    words = ["the", "of", "a", "new", "york", "city", "Ünter", "den", "possible", "x"]
    out = []
    for i in range(400):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 8))]
        out.append((i, rng.choice([" ", ". ", "\t", "\r\n", "  ", ", "]).join(parts), rng.choice(["en", "en", "de", None])))
    return out + [(None, "New York city hall", "en"), (5, None, "en"), (6, "", None), (7, " .,\t\n", "fr"), (3, out[3][1], "en"), (3, out[3][1], "en")]


def phrases(rows, least, longest, top, covered=100):
    found, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", lower(text)):
            ws = re.findall("[^\\x20\\x09]+", piece)
            total[lang or "und"] += len(ws)
            for n in range(1, longest + 1):
                for i in range(len(ws) - n + 1):
                    found[lang or "und"][tuple(ws[i : i + n])] += 1
    out = []
    for lang, f in found.items():
        wanted = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        held = collections.Counter()
        for w, a in wanted.items():
            for n in range(2, len(w)):
                for i in range(len(w) - n + 1):
                    held[w[i : i + n]] = max(held[w[i : i + n]], a)
        rows_ = []
        for w, a in wanted.items():
            if 100 * held[w] >= covered * a:
                continue
            score, k = min((1000 * a * total[lang] // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
            rows_.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        out += [(lang, i + 1, w.decode(), -a, l, r, total[lang], -s) for i, (s, a, w, l, r) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


@pytest.mark.parametrize("least,longest,top,covered", [(3, 5, 40, 100), (1, 5, 10_000, 100), (2, 2, 7, 100), (5, 3, 1000, 60)])
def test_collocations(spark, least, longest, top, covered):
    rows = corpus()
    got = collocations.collocations(table(spark, rows), top, least, longest, covered, limit=300)
    assert sorted(map(tuple, got.collect())) == phrases(rows, least, longest, top, covered)


def test_collocations_with_a_full_filter_and_small_slices(spark, monkeypatch):
    """A bit table in which everything seems to be known, and texts in many stretches, change nothing."""
    rows = corpus()
    for name, value in (("STRETCH", 64), ("TOGETHER", 40), ("RUN", 7), ("HOT", 10)):
        monkeypatch.setattr(collocations, name, value)
    got = collocations.collocations(table(spark, rows).coalesce(1), 1000, 4, filter_bits=16, limit=50)
    assert sorted(map(tuple, got.collect())) == phrases(rows, 4, 5, 1000)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, corpus()).limit(0)).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None), (2, " ", "en")])).count() == 0


def test_hat_trie_counts_and_spills():
    rng = random.Random(1)
    trie, wanted, got = collocations.HatTrie(4, limit=400, burst=10), collections.Counter(), collections.Counter()

    of = collections.defaultdict(set)

    def take(batches):
        for b in batches:
            for part, grams, counts in zip(*(c.to_pylist() for c in b.columns)):
                rows = [tuple(r) for r in np.frombuffer(grams, np.uint64).reshape(-1, 4).tolist()]
                assert rows == sorted(rows)  # a run is sorted
                for k, n in zip(rows, np.frombuffer(counts, np.int64).tolist()):
                    got[k] += n
                    of[k].add(part)

    for _ in range(40):
        rows = np.array([[rng.choice([1, 2, 2**63 + 5]), rng.randrange(30), rng.randrange(3), rng.choice([0, 2**64 - 1])] for _ in range(60)], np.uint64)
        wanted.update(map(tuple, rows.tolist()))
        trie.add(*collocations.distinct_rows(rows))
        assert trie.size == sum(c.size for c in trie.root.values())
        if trie.size >= trie.limit:
            take(trie.spilled(trie.limit // 2, 10, frozenset([2])))
            assert trie.size <= trie.limit // 2
    assert any(c.counts is None for c in trie.root.values())  # some have burst
    take(trie.spilled(0, 10, frozenset([2])))
    assert got == wanted and all(len(p) == 1 for p in of.values())
    places = {first: {p for k, parts in of.items() for p in parts if k[0] == first} for first in (1, 2)}
    assert len(places[1]) == 1 and len(places[2]) > 5  # a hot word is spread


def test_span_hashes_tell_spans_apart():
    raw = np.frombuffer(b"abcabcab", np.uint8)
    spans = [(i, j) for i in range(9) for j in range(i, 9)]
    got = hashing.span_hashes(raw, *np.array(spans).T)
    assert len({h for h in got.tolist()}) == len({raw[i:j].tobytes() for i, j in spans})
    assert all((got[k] == got[m]) == (raw[slice(*spans[k])].tobytes() == raw[slice(*spans[m])].tobytes()) for k in range(0, 45, 4) for m in range(45))


# 12
@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.Vocabulary(open(RANKS, "rb").read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def encoded(v, texts):
    raw = [t.encode() for t in texts]
    ids, n = v.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_perfect_hash_is_minimal(bpe):
    tokens = list(bpe.ranks)
    blob, ends = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([len(t) for t in tokens])
    starts = np.concatenate(([0], ends[:-1]))
    slots = bpe.perfect.slot(hashing.span_hashes(blob, starts, ends))
    assert sorted(slots.tolist()) == list(range(len(tokens)))
    assert bpe.perfect.find(blob, starts, ends).tolist() == list(range(len(tokens)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("aest'lrvd ML\n\t\u3000\u00a0é1²中😀.,", max_size=60)), min_size=1, max_size=20))
def test_byte_bpe_like_the_library(texts):
    v = test_byte_bpe_like_the_library.v
    assert encoded(v, texts) == [test_byte_bpe_like_the_library.library.encode_ordinary(t) for t in texts]


@pytest.fixture(autouse=True)
def _vocabulary(request):
    if request.function is test_byte_bpe_like_the_library:
        request.function.v, request.function.library = request.getfixturevalue("bpe"), request.getfixturevalue("library")


def test_byte_bpe_table(spark, library):
    special = ["<|endoftext|>", "a" * 3000, "x" + " " * 500 + "y", "abcdefghijklmnop" * 700, "don't I'll we've \n\n 12 345,6", "Straße 中文 😀"]
    rows = [(i, t, "en") for i, t in enumerate(special)] + [(7, None, "en"), (None, "", None), (7, "repeated", "en"), (7, "repeated", "en")]
    ranks = byte_bpe.read_ranks(spark, RANKS)
    found = byte_bpe.decode(byte_bpe.encode(table(spark, rows), ranks, pattern=public_tokenizers.PATTERN), ranks).collect()
    got = sorted((r.doc_id or -1, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in found)
    ids = lambda t: library.encode_ordinary(t or "")
    assert got == sorted((i or -1 if i != 0 else -1, len(ids(t)), ids(t), (t or "").encode()) for i, t, _ in rows)
    assert byte_bpe.encode(table(spark, rows).limit(0), ranks).count() == 0


def test_byte_bpe_in_parts_and_by_another_pattern(bpe, library, monkeypatch):
    text = " ".join(random.Random(2).choice(["word", "don't", "\n", "  x", "é" * 30, "12"]) for _ in range(5000))
    whole = library.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "SLICE", 999)
    assert encoded(bpe, [text]) == [whole]
    other = byte_bpe.Vocabulary(open(RANKS, "rb").read(), r"\p{L}+|[^\p{L}]")
    own = tiktoken.Encoding("other", pat_str=r"\p{L}+|[^\p{L}]", mergeable_ranks=bpe.ranks, special_tokens={})
    assert encoded(other, ["straße 12", "", "中 a"]) == [own.encode_ordinary(t) for t in ("straße 12", "", "中 a")]


def test_byte_bpe_unknown_id(bpe):
    with pytest.raises(ValueError, match="no id"):
        bpe.decode(np.array([50256], "<u4"))


# 13
def cut(doc_id, text, unit=r"[A-Za-z]+|[^A-Za-z]"):
    text = text or ""
    units = re.findall(unit, text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit,pattern", [("token", r"[A-Za-z]+|[^A-Za-z]"), ("char", r"(?s:.)"), ("line", r"[^\n]*\n|[^\n]+")])
def test_fill_in_middle(spark, unit, pattern):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcXYZ  \n1é中😀<>PSM_") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += [None, "", "a<P>b", "<S>", "a<" * 9, "word", "x" * 70_000, "long words and lines\n" * 9000, "<", "P>"]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(None, "a null id has its own draw", "en"), (3, texts[3], "en"), (3, "another text of the same id", "en")]
    df = fill_in_middle.fill_in_middle(table(spark, rows), unit).withColumn("again", fill_in_middle.restored(F.col("output"), F.col("form")))
    got = df.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[-1] or "")
    wanted = sorted(((i, *cut(i, t, pattern), t or "") for i, t, _ in rows), key=key)
    assert sorted((tuple(r) for r in got), key=key) == wanted
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(table(spark, rows).limit(0)).count() == 0


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(1)
    for size in (0, 1, 255, 256, 257, 5000):
        x = rng.integers(0, 4, size).astype(np.uint8)
        m = fill_in_middle.WaveletMatrix(x, 2)
        at = np.arange(size + 1)
        for c in range(4):
            assert m.rank(c, at).tolist() == np.concatenate(([0], np.cumsum(x == c))).tolist()


# what all operators share: ids that aren't whole numbers are null ids
@pytest.mark.parametrize("kind", ["string", "double"])
def test_ids_that_are_not_whole_numbers(spark, kind):
    texts = ["a line that is long enough to count here\nand another one that is long enough", "short text of some words", None]
    rows = [(v, t, "en") for v, t in zip({"string": ["7", "x1", "2.5"], "double": [7.0, 1.5, None]}[kind], texts)]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string, lang string")
    ranks = byte_bpe.read_ranks(spark, RANKS)
    ids = {
        "bpe": byte_bpe.encode(df, ranks), "fim": fill_in_middle.fill_in_middle(df), "near": minhash.near_duplicates(df), "repeats": suffix_dedup.remove_repeats(df),
        "pieces": sentencepiece_fst.encode_decode(df, sentencepiece_fst.read_model(spark)), "language": langid.predict(df, langid.fit(df)),
        "leaks": decontamination.find_matches(df, spark.createDataFrame([("b", "short text of some words")], "item_id string, text string")),
        "pages": html_text.extract(df.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))).withColumnRenamed("page_id", "doc_id"),
        "turns": chat.format_turns(df.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text")).withColumnRenamed("conv_id", "doc_id"),
    }
    for name, out in ids.items():
        assert {r.doc_id for r in out.collect()} == {7, None}, name
    assert line_dedup.drop_repeated(df).count() == 3
    vectors = spark.createDataFrame([(r[0], [float(i)]) for i, r in enumerate(rows)], f"vec_id {kind}, embedding array<double>")
    assert topk.top_k(vectors, F.lit(True)).count() == 0  # one row takes part


def test_line_dedup_of_a_column_in_capitals(spark):
    line = "a line that is long enough to count here"
    df = spark.createDataFrame([(i, f"{line}\nown {i}") for i in range(4)], "doc_id bigint, Text string")
    out = line_dedup.drop_repeated(df)
    assert out.columns[:2] == ["doc_id", "Text"] and sorted(r.Text for r in out.collect()) == [f"{line}\nown 3", "own 0", "own 1", "own 2"]


def test_empty_vectors_take_part(spark):
    df = spark.createDataFrame([(1, [1.0, -1.0]), (2, []), (3, [-1.0, 0.5]), (4, None), (5, [None, 1.0])], "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.lit(True)).collect()))
    s = 256 * 256
    assert got == [(1, 1, 2, 0), (1, 2, 3, -s - s // 2), (2, 1, 1, 0), (2, 2, 3, 0), (3, 1, 2, 0), (3, 2, 1, -s - s // 2)]
    assert topk.top_k(df.where("vec_id = 2"), F.lit(True)).count() == 0


def test_decontamination_in_many_blocks(spark):
    """Blocks of items are searched one after the other and give what one block gives."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    items = [(f"i{i}", " ".join(rng.choice(words) for _ in range(rng.randint(2, 14)))) for i in range(50)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(40)) + " " + rng.choice(items)[1], "en") for i in range(40)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    one, many = (decontamination.contamination(decontamination.find_matches(table(spark, docs), bench, window=4, block_words=b)) for b in (10**6, 10))
    order = lambda df: sorted((r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in df.collect())
    assert order(one) == order(many) and any(r[1] for r in order(one))


# 8
def _unigram(prefix: bool, collapse: bool):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    kinds = pb.ModelProto.SentencePiece
    own = [("▁", -3), ("a", -2), ("b", -2.125), ("ab", -3), ("▁a", -2.5), ("bb", -3.5), ("▁▁", -4), ("b▁a", -5.25), (".", -3.25)]  # exact in binary, so that ties are
    for piece, score, kind in [("<unk>", 0, kinds.UNKNOWN), ("<s>", 0, kinds.CONTROL), ("</s>", 0, kinds.CONTROL), *[(f"<0x{b:02X}>", 0, kinds.BYTE) for b in range(256)], *[(p, x, kinds.NORMAL) for p, x in own]]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = 1, True
    proto.normalizer_spec.name, proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = "identity", prefix, collapse
    return proto.SerializeToString()


@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("collapse", [True, False])
def test_normaliser_composed_with_pieces(prefix, collapse):
    """The compiled normaliser puts out what the library's does, and the composition gives its ids."""
    import sentencepiece

    model = _unigram(prefix, collapse)
    t, library = sentencepiece_fst.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(5)
    for k in range(600):
        text = "".join(rng.choice("aabb  .\né" if k % 2 else "ab ") for _ in range(rng.randint(0, 14)))
        assert t.normaliser.compose(text) == library.normalize(text)
        assert np.frombuffer(t.encode(text), "<i4").tolist() == library.encode(text), text


def test_composed_arcs():
    n = sentencepiece_fst.Normaliser(True, False)
    assert n.letterwise and n.preimage("▁") == [" ", "▁"] and n.preimage(" ") == [] and n.preimage("a") == ["a"] and n.image(" ") == "▁"
    assert not sentencepiece_fst.Normaliser(True, True).letterwise
    t = sentencepiece_fst.Transducer(_unigram(True, False))
    assert t.trie[" "] is t.trie["▁"] and t.trie["b"][" "] is t.trie["b"]["▁"] and " " not in t.trie["a"]


def test_small_batches(spark):
    """Settings that are at their defaults, set or not, are lowered; the session's own stay."""
    rows, size = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))
    before = {k: spark.conf.get(k) for k in (rows, size)}
    try:
        for k in before:
            spark.conf.unset(k)
        small_batches(spark)
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("2000", "67108864b")
        small_batches(spark, "8m")
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("2000", "8m")
        spark.conf.set(rows, "500")
        spark.conf.set(size, "1m")
        small_batches(spark, "8m")
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("500", "1m")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
