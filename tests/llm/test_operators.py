"""The training-data operators against brute force on small tables with nulls, ties, repeats and clashing columns."""

import collections
import hashlib
import html
import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratigraph.llm import chat, decontamination, html_text, langid, line_dedup, lm_score, minhash, sentencepiece_fst, suffix_dedup, topk
from stratigraph.llm.common import written
from stratigraph.llm.components import connected_components, contractions

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, pos int, h1 string"  # columns that clash with names the operators use


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def texts():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta", "iota", "kappa", "la", "mu"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    common, passage = line(9), line(40)
    out = [None, "", " ", "\n\n", "word", "word two", common, f"{common}\n{common}\n x", f"\t{common.upper()} \nshort", passage, f"{passage}\n{line(30)}", line(3000)]
    for _ in range(25):
        out.append("\n".join(rng.choice([common, line(rng.randint(1, 12)), passage, "ab"]) for _ in range(rng.randint(1, 8))))
    base = line(120).split()
    for _ in range(6):  # near copies
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "x" + rng.choice(words)
        out.append(" ".join(copy))
    return out + [out[-1], out[-2]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "h") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Also a row without an id, and repeated rows."""
    return docs.unionByName(spark.createDataFrame([(None, texts()[10], 1, "h"), (9, texts()[9], 1, "h"), (9, texts()[9], 1, "h")], DOCS))


# 1
def test_line_dedup(spark, odd):
    rows = odd.collect()
    key = lambda s: lower(s.strip(" \t\n\x0b\x0c\r"))
    where = collections.defaultdict(set)
    for r in rows:
        if r.doc_id is not None:
            for s in (r.text or "").split("\n"):
                where[key(s)].add(r.doc_id)
    goes = lambda i, s: len(key(s)) >= 20 and len(where[key(s)]) >= 3 and max(where[key(s)]) != i
    wanted = sorted((str(r.doc_id), len((r.text or "").split("\n")), "\n".join(s for s in (r.text or "").split("\n") if r.doc_id is None or not goes(r.doc_id, s))) for r in rows)
    for batches, fanout in ((4, 4), (5, 2), (1, 3)):
        found = line_dedup.drop_repeated(odd, batches=batches, fanout=fanout)
        assert found.columns[:4] == odd.columns
        assert sorted((str(r.doc_id), r.line_dedup_total, r.text) for r in found.collect()) == wanted
    assert line_dedup.drop_repeated(odd.limit(0)).count() == 0
    clash = odd.withColumns({c: F.lit("mine") for c in ("line_dedup_total", "line_dedup_dropped", "key_0", "lines_0", "id_0", "gone_0", "LINES_1")})
    found = line_dedup.drop_repeated(clash)
    assert len(set(found.columns)) == len(found.columns) and found.where("key_0 = 'mine' and lines_1 = 'mine'").count() == len(rows)
    assert sorted((str(r.doc_id), r.line_dedup_total, r.text) for r in found.collect()) == wanted


# 2
def test_lm_score(spark, odd):
    target = spark.createDataFrame([(i,) for i in range(6, 20)] + [(6,)], "doc_id bigint")
    found = lm_score.cross_entropy_difference(odd, target, vocabulary=8).collect()
    assert len(found) == odd.count()
    for r in found:
        assert (r.score is None) == (r.n_tokens == 0)
    words = {r.doc_id: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r.text)) for r in odd.collect()}
    rows = [words[r.doc_id] for r in odd.collect()]
    counts = collections.Counter(w for r in rows for w in r)
    number = {w: i + 1 for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:7])}

    def model(part):
        pairs = collections.Counter(p for ws in part for p in itertools.pairwise([0] + [number.get(w, 0) for w in ws]))
        one = collections.Counter(b for (_, b), n in pairs.items() for _ in range(n))

        def bits(a, b):
            n, kinds = sum(v for (x, _), v in pairs.items() if x == a), max(1, sum(x == a for x, _ in pairs))
            return -np.log2((pairs[a, b] + kinds * (one[b] + 1) / (sum(one.values()) + 8)) / (n + kinds))

        return bits

    good, all_ = model([words[r.doc_id] for r in odd.collect() if r.doc_id is not None and 6 <= r.doc_id < 20]), model(rows)
    for r in found:
        if r.n_tokens and r.n_tokens < 300:
            pairs = list(itertools.pairwise([0] + [number.get(w, 0) for w in words[r.doc_id]]))
            assert r.n_tokens == len(pairs) and abs(r.score - np.mean([good(*p) - all_(*p) for p in pairs])) < 1e-4
    none = lm_score.cross_entropy_difference(odd, target.limit(0), vocabulary=8).where("n_tokens > 0").collect()
    assert all(abs(r.target_bits - 3) < 1e-5 for r in none)  # a uniform model over 8 entries
    assert lm_score.cross_entropy_difference(odd.limit(0), target, vocabulary=8).count() == 0


def test_lm_losses_sum_to_one():
    table = lm_score.losses(np.array([1, 5, 9]), np.array([3, 2, 1]), 4)
    assert np.allclose((2.0**-table).sum(axis=1), 1, atol=1e-5)


def test_lm_score_whole_vocabulary(spark):
    """Every word counts: rare words tell documents apart, and no two slices or parts change a loss."""
    rows = [(i, f"the {'cat' if i % 2 else 'dog'} rare{i} word{i % 7} the end") for i in range(1500)] + [(2000, "the cat rare1 word1 the end"), (2001, "the cat unseen word1 the end"), (2002, ""), (None, "the the")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    target = spark.createDataFrame([(i,) for i in range(0, 1500, 3)], "doc_id bigint")
    words = [(i, t.split()) for i, t in rows]
    size = len({w for _, ws in words for w in ws}) + 1
    assert size > 1024

    def model(part):
        pairs = collections.Counter(p for ws in part for p in itertools.pairwise([None, *ws]))
        one, total, kinds = collections.Counter(), collections.Counter(), collections.Counter(a for a, _ in pairs)
        for (a, b), n in pairs.items():
            one[b] += n
            total[a] += n
        every = sum(one.values())
        return lambda a, b: -np.log2((pairs[a, b] + max(1, kinds[a]) * (one[b] + 1) / (every + size)) / (total[a] + max(1, kinds[a])))

    good, all_ = model([ws for i, ws in words if i is not None and i < 1500 and i % 3 == 0]), model([ws for _, ws in words])
    for options in ({}, {"size": 5000, "part": 700}, {"size": 400, "part": 200, "fan": 3}):  # the last over a tree of five levels
        found = {r.doc_id: r for r in lm_score.cross_entropy_difference(df, target, **options).collect()}
        assert len(found) == len(rows) and found[2002].score is None
        for i, ws in words:
            if ws:
                pairs = list(itertools.pairwise([None, *ws]))
                a, b = np.mean([good(*p) for p in pairs]), np.mean([all_(*p) for p in pairs])
                assert np.allclose((found[i].target_bits, found[i].background_bits, found[i].score), (a, b, a - b), atol=1e-9)
        assert found[2000].background_bits != found[2001].background_bits


# 3
PAGES = [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>", ""),
    ("<body><nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>One  <b>two</b>\n three<p>Next &eacute;&#33;<br>more</article><footer>foot</footer>", "Title\n\nOne two three\n\nNext é! more"),
    ("<main><div class='cookie-notice'><p>Accept?</p></div><p>Real text.</p><aside>side</aside><form><p>Mail</p></form><div id=comments><p>First!</p></div><p>End</p></main>", "Real text.\n\nEnd"),
    ("<article><p>a<script>var x = '<p>no</p>'</script> b<style>p{}</style></p><!-- no --><ul><li>x<li>y</ul></article>", "a b\n\nx\n\ny"),
    ("<article><header><p>by</p></header><p>Only this</p><div class='adBox share'>buy</div>", "Only this"),
    ("<div class=ad>short ad</div><article><p>T&am", "T&am"),
]


@pytest.mark.parametrize("page, wanted", PAGES)
def test_html_cases(page, wanted):
    assert html_text.main_text(page) == wanted


def test_html_without_containers_clusters_by_ratio():
    menu = "".join(f"<li><a href='/{i}'>item {i}</a></li>" for i in range(8))
    body = "".join(f"<p>{'long sentence of content number %d ' % i * 6}</p>" for i in range(5))
    found = html_text.main_text(f"<body><ul>{menu}</ul><div>{body}</div><ul>{menu}</ul></body>")
    assert found.count("long sentence of content number") == 30 and "item" not in found


P = "<p>" + "real words of the article body go here, many of them. " * 5 + "</p>"
N = "<ul>" + "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize("page, n", [
    (f'<div class="layout with-sidebar"><article>{P}{P}</article></div>', 2),
    (f'<article class="post comments-open">{P}{P}</article>', 2),
    (f'<main class="page no-ads">{P}{P}</main>', 2),
    (f'<div id="search-theory">{P}{P}</div>', 2),
    (f'<div class="widget"><article>{P}{P}</article></div>', 2),  # a mark around the container
    (f'{N}<div class="sidebar">{P}</div><div class="post">{P}{P}</div>', 2),
    (f'<div class="comments">{P}{P}</div>', 2),  # nothing but marked lines
    (f"<main><article>{P}</article><article>{P}</article></main><article>{P}</article>", 2),
    (f'<article>{P}{P}<div class="ad-banner">{P}</div><div class="cookieBox">{P}</div></article>', 2),
    (f"<article>{P}{P}<section><article>{P}</article></section></article>", 2),  # an article within one: a comment
    (f'<article>{P}{P}</article><section class="comments"><article class="comment">{P}</article></section>', 2),
    ("<div>" * 2000 + P + "</div>" * 2000, 1),
])
def test_html_marks_are_evidence(page, n):
    assert html_text.main_text(page).count("real words") == 5 * n


def test_html_short_and_linked_text_stays():
    found = html_text.main_text(f"{N}<article>{P}{P}<p>where <math><mi>x</mi></math> is <label>good</label></p></article><article><p>Short note.</p></article>")
    assert found.endswith("where x is good\n\nShort note.") and "item" not in found
    assert html_text.main_text(f"<body>{P}<p><a href=x>a paragraph that is a link</a></p>{P}</body>").split("\n\n")[1] == "a paragraph that is a link"


REAL = "<p>" + "real words of a paragraph that goes on for a while, as paragraphs do. " * 3 + "</p>"


@pytest.mark.parametrize("page,wanted,gone", [
    (f'<form id="aspnetForm"><nav>menu</nav><h1>Title</h1>{REAL}{REAL}<div class="sidebar"><p>side text</p></div></form>', 2, "side"),
    (f'<div class="layout-right-sidebar"><h1>Title</h1>{REAL}{REAL}</div><div>Copyright 2020</div>', 2, "Copyright"),
    (f'<article><h1>Title</h1>{REAL}<section id="discussion"><h2>Discussion</h2>{REAL}</section><section id="cookies">{REAL}</section><section id="comments"><p>nice one</p></section></article>', 3, "nice"),
    (f'<article>{REAL}<ul><li class="share">share it<li>first real words<li>second real words</ul></article>', 1, "share"),
    (f'<form class="find"><label>Search</label><input></form><div><h1>Title</h1>{REAL}{REAL}</div><div class="comments">{REAL * 9}</div>', 2, "Search"),
])
def test_html_marks_that_cannot_be_what_they_say(page, wanted, gone):
    found = html_text.main_text(f"<body>{page}</body>")
    assert found.count("real words of") == 3 * wanted and gone not in found
    if "<li>" in page:
        assert found.endswith("first real words\n\nsecond real words")


@pytest.mark.parametrize("page", ["<table><tr>" + "<td>cell text" * 20_000 + "</table>", "<table>" + "".join(f"<tr><td>cell {i}<td>more" for i in range(10_000)) + "</table>", "<div>" * 20_000 + "<b>x" * 20_000 + "</i>" * 20_000])
def test_html_time_is_linear(page):
    start = time.process_time()
    assert html_text.main_text(page)
    assert time.process_time() - start < 3


def test_html_by_ratio_alone():
    """Pages without containers or marks against a second, plain form of ratio, smoothing and threshold."""
    rng = random.Random(11)
    for _ in range(60):
        blocks = [(rng.randint(1, 40), rng.choice([0, 0, 1, 3])) for _ in range(rng.randint(2, 25))]  # words, links of one word
        page = "".join("<div>" + " ".join(["word"] * n) + "".join(" <a href=x>link</a>" for _ in range(k)) + "</div>" for n, k in blocks)
        # tags of a line: its own two, and two for each link
        ratios = [math.log1p(min(100, (5 * n - 1 + k) / (2 + 2 * k))) for i, (n, k) in enumerate(blocks)]
        smooth = []
        for i in range(len(ratios)):
            near = [(math.exp(-((i - j) ** 2) / 2), ratios[j]) for j in range(len(ratios)) if abs(i - j) <= 2]
            smooth.append(sum(w * x for w, x in near) / sum(w for w, _ in near))
        low, high = min(smooth), max(smooth)
        for _ in range(32):
            if high > low and (under := [x for x in smooth if x < (low + high) / 2]) and (over := [x for x in smooth if x >= (low + high) / 2]):
                low, high = np.mean(under), np.mean(over)
        cut = (low + high) / 2 if high - low > math.log(3) else -1
        at = [i for i, x in enumerate(smooth) if x >= cut]
        kept = set(at) | {j for a, b in zip(at, at[1:]) if b - a <= 4 for j in range(a, b)}
        text = lambda n, k: " ".join(["word"] * n + ["link"] * k)
        assert html_text.main_text(page) == "\n\n".join(text(*blocks[i]) for i in sorted(kept))


def test_html_defined_cases(spark):
    rows = [(1, "u", f"<article>{P}</article>", "x"), (1, "u", f"<article>{P}</article>", "x"), (None, None, None, None), (2, None, "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = html_text.extract(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in found) == [("1", 269), ("1", 269), ("2", 0), ("None", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_html_keeps_what_is_text():
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>item {i}</a></li>" for i in range(8)) + "</ul>"
    text = lambda n, word: f"<p>{(word + ' ') * n}</p>"
    both = html_text.main_text(f"<body>{menu}<article>{text(50, 'first')}</article><article>{text(48, 'second')}</article>{menu}</body>")
    assert both.count("first") == 50 and both.count("second") == 48 and "item" not in both
    beside = html_text.main_text(f"<body>{menu}<div><h2>Heading</h2>{text(20, 'normal')}{text(2000, 'long')}{text(20, 'after')}</div>{menu}</body>")
    assert beside.startswith("Heading") and beside.count("normal") == 20 and beside.count("after") == 20 and "item" not in beside
    assert html_text.main_text(f"<article class='post ad share'>{text(30, 'marked')}</article>").count("marked") == 30
    assert html_text.main_text(f"<main><p><a href=x>go</a></p></main><div>{text(100, 'body')}{text(90, 'body')}</div>").count("body") == 190


def test_html_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body)]
        assert found[r.page_id].text == "\n\n".join(b for b in blocks if b) and found[r.page_id].n_chars == len(found[r.page_id].text)


# 4
def test_chat_round_trip(spark):
    rng = random.Random(1)
    pieces = ["\\", "<|", "<|turn|>", "<|end|>", "</s>", "[INST]", "[/INST]", "<\\|", "a", "\n", "é", "<s>", "<", "|", "", "[\\INST]"]
    odd = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    assert all(chat.unescaped(chat.escaped(t)) == t and not any(c in chat.escaped(t) for c in chat.CONTROL) for t in odd)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|end|>"]), rng.choice([*odd, None])) for c in (1, 2, None) for t in range(40)] + [(3, 0, "user", None), (3, 0, "assistant", "x"), (3, None, "assistant", "first")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(df.repartition(4))).collect()}
    for c in (1, 2, None):
        own = sorted((r for r in rows if r[0] == c), key=lambda r: r[1])
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert found[c].n_turns == 40 and found[c].turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert found[3].loss_sha256 == hashlib.sha256(b"firstx").hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_chat_parts(spark):
    parts = [[("text", "see <|", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 3), ("odd", None, "d", None, None, None, None), None], None]
    df = spark.createDataFrame([(1, 0, "user", "plain", parts[0]), (1, 1, "user", "plain", parts[1])], "conv_id int, turn int, role string, text string, parts array<struct<kind:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>>")
    a, b = chat.format_turns(df, "parts").orderBy("turn").collect()
    assert [(x.kind, x.ref, x.tokens) for x in a.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 768), ("odd", "d", 0)] and a.expanded_tokens == 809
    assert all(a.formatted[x.at :].startswith(chat.MEDIA) for x in a.attachments) and b.formatted.endswith("plain<|end|>")


def test_chat_placeholders_are_no_text(spark):
    """A user's literal placeholder, one beside a real one, and clashing columns."""
    schema = "conv_id int, turn int, role string, text string, formatted string, loss_start int, media array<struct<kind:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>>"
    rich = [("text", "a <|media|> b", None, None, None, None, None), ("image", None, "x.png", 28, 28, None, None), ("text", "\\<|media|>", None, None, None, None, None)]
    rows = chat.format_turns(spark.createDataFrame([(1, 0, "assistant", "-", "clash", 1, rich), (1, 1, "user", "<|media|>", "clash", 1, None)], schema), "media").orderBy("turn").collect()
    back = [chat.read_parts(r.formatted, [x.asDict() for x in r.attachments]) for r in rows]
    assert [(p["kind"], p.get("text") or p.get("ref")) for p in back[0][0]] == [("text", "a <|media|> b"), ("image", "x.png"), ("text", "\\<|media|>")]
    assert back[1] == [[{"kind": "text", "text": "<|media|>"}]] and not rows[1].attachments


# 5
@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(spark, docs, odd, shingle):
    sets = {}
    for r in docs.collect():
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    part = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                part[a] = part[b] = min(part[a], part[b])
    found = minhash.near_duplicates(docs, shingle).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {i: (len(s), part[i], part[i] == i) for i, s in sets.items()}
    more = minhash.near_duplicates(odd, shingle, block=2).collect()
    assert len(more) == odd.count() and all(r.component_id == part.get(r.doc_id) and r.kept == (part.get(r.doc_id) == r.doc_id) for r in more)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_texts_of_one_id_are_one_document(spark):
    """A repeated doc_id with two texts joins what each of them is linked with; no link is lost."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(9, text("a")), (9, text("b")), (3, text("a") + " x"), (4, text("b") + " y"), (5, text("c")), (9, ""), (6, text("a")), (6, text("a"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(df, 2).collect()}
    assert found == {(9, 59): (3, False), (3, 60): (3, True), (4, 60): (3, False), (6, 59): (3, False), (5, 59): (5, True), (9, 0): (9, True)}


def test_large_buckets_are_cut_by_size(spark):
    """One short phrase in texts of many sizes, blocks of 3 rows: the same links as without cuts."""
    rng = random.Random(8)
    base = [[f"p{k}_{i}" for i in range(rng.choice([3, 4, 5, 20, 25, 30]))] for k in range(8)]
    rows = [(i, " ".join(w if rng.random() > 0.02 else f"z{rng.randrange(999)}" for w in base[i % 8])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    one, cut = ({r.doc_id: r.component_id for r in minhash.near_duplicates(df, 2, block=b).collect()} for b in (512, 3))
    assert one == cut and len(set(one.values())) < 60


def test_links_that_stars_miss(spark):
    """A chain of copies: the ends differ, so only pairs within the buckets join them."""
    base = [f"w{i}" for i in range(200)]
    chain = []
    for k in range(12):
        base = [f"v{k}_{i}" if i in range(k * 8, k * 8 + 8) else w for i, w in enumerate(base)]
        chain.append((k, " ".join(base)))
    df = spark.createDataFrame(chain[::-1], "doc_id bigint, text string")
    assert {r.component_id for r in minhash.near_duplicates(df, 2).collect()} == {0}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7), (7, 6)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {n: r for n, r in root.items() if n in found} and {n for e in edges for n in e if e[0] != e[1]} <= found.keys()
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_of_a_rising_chain(spark):
    """Successive versions of one text: the rounds grow with the logarithm of the chain's length."""
    chain = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert len(contractions(chain)) <= 10
    found = connected_components(chain)
    assert found.count() == 2001 and found.where("component <> 0").isEmpty()


# 6
def test_decontamination(spark, odd):
    items = [(1, "Alpha beta GAMMA"), (2, texts()[9]), (2, None), (None, "word two"), (30, "word"), (4, ""), (5, " ".join((texts()[11] or "").split()[100:125]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w and i is not None else 0):
            windows[tuple(w[k : k + 10])].add(i)
    wanted = []
    for r in odd.collect():
        w, hit, found = words(r.text), set(), set()
        for window, owners in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found |= owners
        wanted.append((str(r.doc_id), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    for block_words, segment in ((200_000, 8 << 20), (20, 300)):
        found = decontamination.contamination(decontamination.find_matches(odd, bench, block_words=block_words, segment_bytes=segment)).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found) == sorted(wanted)
    assert not any(r.contaminated for r in decontamination.contamination(decontamination.find_matches(odd, bench.limit(0))).collect())


def test_decontamination_of_random_words(spark):
    """Few different words, so that runs overlap, touch and repeat; item ids that aren't numbers; several blocks."""
    rng = random.Random(6)
    line = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    docs = [(i, line(rng.choice([0, 3, 30, 200])), "x") for i in range(60)]
    items = [(f"item-{i}", line(rng.choice([1, 2, 4, 9, 10, 11, 14]))) for i in range(40)]
    windows = [(i, " ".join(w.split()[k : k + 10])) for i, w in items for k in range(max(1, len(w.split()) - 9))]
    wanted = []
    for i, text, _ in docs:
        w, hit, found = text.split(), set(), set()
        for item, window in windows:
            n = len(window.split())
            for k in range(len(w) - n + 1):
                if " ".join(w[k : k + n]) == window:
                    hit.update(range(k, k + n))
                    found.add(item)
        wanted.append((i, len(hit), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    df, bench = spark.createDataFrame(docs, "doc_id bigint, text string, segment string"), spark.createDataFrame(items, "item_id string, text string")
    for options in ({}, {"block_words": 30, "segment_bytes": 500}):
        found = decontamination.contamination(decontamination.find_matches(df, bench, **options)).collect()
        assert sorted((r.doc_id, r.n_hit, r.items_sha256) for r in found) == wanted


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x green y blue"), (2, "red green"), (3, "red a b c d e f g h green blue"), (4, "blue green red")], "doc_id bigint, text string")
    phrases = decontamination.TestPhrases([("9", "red green blue")], 10)
    found = decontamination.proximity_matches(written(decontamination.build_index(docs), "index"), phrases, slop=3)
    assert {r.doc_id for r in found.collect()} == {1, 4}


# 7
@pytest.mark.parametrize("length", [30, 100])
def test_suffix_dedup(spark, docs, odd, length):
    seen, wanted = set(), {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        raw = (r.text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        wanted[r.doc_id] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    for rows, most in ((docs, 8192), (docs, 2), (odd, 8192)):
        for r in suffix_dedup.remove_repeats(rows, length, gram=12, most=most).collect():
            if r.doc_id is not None:
                assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == wanted[r.doc_id]
            else:
                assert r.n_removed == 0
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [8192, 2])
def test_repeat_groups(spark, docs, most):
    """Each group lists all places of its string; each string that repeats is in one; a copied text is one group."""
    length = 30
    raw = {r.doc_id: (r.text or "").encode() for r in docs.collect() if len(r.text or "") < 2000}
    raw[900] = raw[901] = random.Random(9).randbytes(400).hex().encode()
    df = spark.createDataFrame([(i, t.decode()) for i, t in raw.items()], "doc_id bigint, text string")
    groups = collections.defaultdict(set)
    for r in suffix_dedup.repeat_groups(df, length, gram=12, most=most).collect():
        groups[r.group, r.n_bytes].add((r.doc_id, r.start))
    covered = collections.defaultdict(set)
    for (_, size), places in groups.items():
        doc, start = next(iter(places))
        text = raw[doc][start : start + size]
        assert len(text) == size >= length and len(places) > 1
        assert places == {(i, p) for i, t in raw.items() for p in range(len(t) - size + 1) if t[p : p + size] == text}
        for i, p in places:
            covered[i].update(range(p, p + size - length + 1))
    seen = collections.defaultdict(list)
    for i, t in raw.items():
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]].append((i, p))
    assert all(p in covered[i] for places in seen.values() if len(places) > 1 for i, p in places)
    if most > 2:
        assert any(size == 800 and places == {(900, 0), (901, 0)} for (_, size), places in groups.items())


def test_maximal_repeats_have_all_occurrences():
    a, b = b"abcdefghij", b"klm"
    raw = b"x" + a + b + b"y" + a + b + b"z" + a + b"q"
    starts = np.arange(len(raw) - 9)
    found = {(size, tuple(sorted(at.tolist()))) for size, at in suffix_dedup.maximal_repeats(np.frombuffer(raw, np.uint8), starts, np.zeros(len(starts), int), np.full(len(starts), len(raw)), starts == 0, 10)}
    assert found == {(13, (1, 15)), (10, (1, 15, 29))}


# 8
def test_sentencepiece(spark, odd):
    import sentencepiece

    model = sentencepiece_fst.read_model(spark)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    t = sentencepiece_fst.transducer(model)
    rng = random.Random(4)
    some = ["  a   b ", "\n\nx\n y", "日本語 梦ゼ벨", "a▁b", "🙂\t tab", "a" * 400, "x  ▁ y", "\x1f", "▁", "é ﬁ"] + ["".join(rng.choice("abcdehinorst  ▁é\nTA.,'") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    for text in some:
        ids = np.frombuffer(t.encode(text), "<i4").tolist()
        assert ids == library.encode(text) and t.decode(ids) == library.decode(ids)
    found = sentencepiece_fst.encode_decode(odd, model).collect()
    by_text = {r.doc_id: r.text for r in odd.collect()}
    assert all(r.ids == library.encode(by_text[r.doc_id] or "") and r.n_pieces == len(r.ids) and r.exact for r in found)
    assert sentencepiece_fst.encode_decode(odd.limit(0), model).count() == 0


def test_unigram_shortest_path():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    kinds = pb.ModelProto.SentencePiece
    for piece, score, kind in [("<unk>", 0, kinds.UNKNOWN), *[(f"<0x{b:02X}>", 0, kinds.BYTE) for b in range(256)], ("▁", -3, kinds.NORMAL), ("a", -2, kinds.NORMAL), ("b", -2, kinds.NORMAL), ("ab", -3, kinds.NORMAL), ("▁a", -2.5, kinds.NORMAL), ("bb", -3.5, kinds.NORMAL)]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.model_type, proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = 1, True, False
    t = sentencepiece_fst.Transducer(proto.SerializeToString())
    name = lambda text: [proto.pieces[i].piece for i in np.frombuffer(t.encode(text), "<i4")]
    assert name("abb") == ["▁a", "bb"] and name("aé") == ["▁a", "<0xC3>", "<0xA9>"] and t.decode(np.frombuffer(t.encode("abé b"), "<i4")) == "abé b"


# 9
def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("text", F.when(F.col("doc_id") % 50 == 1, F.lit("12 ... !")).when(F.col("doc_id") % 50 == 2, None).otherwise(F.col("text")))
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs, ~held)
    found = langid.predict(docs, model).alias("a").join(docs.alias("b"), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and (r.lang_pred != "und" or r.rejected)
    right = [r.lang_pred == r.lang for r in found if r.lang_pred != "und" and hash_fold(r.doc_id)]
    assert np.mean(right) > 0.97
    assert not any(r.rejected for r in found if r.lang_pred != "und")
    far = spark.createDataFrame([(1, "zqxj vkwq zzzq xxjq qqzx jjkv"), (2, "Ωμέγα άλφα"), (None, "the of and")], "doc_id bigint, text string")
    assert {r.doc_id for r in langid.predict(far, model).where("rejected").collect()} >= {2}
    # rows that repeat ids, with the same text or another: the same model whatever the partitions
    twice = docs.unionByName(docs.where("doc_id % 3 = 0")).unionByName(docs.withColumn("text", F.reverse("text")).where("doc_id % 5 = 0"))
    a, b = (langid.fit(twice.repartition(n), sample=60) for n in (2, 7))
    assert a.langs == b.langs and np.array_equal(a.at, b.at) and np.array_equal(a.least, b.least)
    blank = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(docs.limit(5), blank).collect()} == {"und"}


def test_language_equals_plain_cosines(spark):
    """N-grams counted in a dictionary, cosines summed term by term."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, buckets=512)
    mask = (1 << 64) - 1

    def plain(text):
        letters = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
        if not any(map(str.isalpha, letters)):
            return "und", 0.0
        c = [ord(x) for x in f" {letters} "]
        codes = c[1:-1] + [(a * 0x9E3779B97F4A7C15 + b) & mask for a, b in itertools.pairwise(c)]
        codes += [(((a * 0x9E3779B97F4A7C15 + b) & mask) * 0xC2B2AE3D27D4EB4F + d) & mask for a, b, d in zip(c, c[1:], c[2:])]
        counts = collections.Counter(((x * 0xFF51AFD7ED558CCD & mask) >> 40) % 512 for x in codes)
        v = {k: np.log1p(n) * model.idf[k] for k, n in counts.items()}
        length = np.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * row[k] for k, x in v.items()) / length for row in model.at]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        return model.langs[model.of[best]], cosines[best]

    texts = {r.doc_id: r.text for r in docs.limit(60).collect() if len(r.text or "") < 4000}
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for i, text in texts.items():
        lang, score = plain(text)
        assert found[i].lang_pred == lang and abs(found[i].score - score) < 1e-4


def test_language_rejects_what_was_not_learnt(spark):
    import base64

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs, ~held)
    clean = langid.predict(docs.where(held), model).where("lang_pred <> 'und'").collect()
    assert np.mean([r.rejected for r in clean]) < 0.01
    noise = np.random.default_rng(1).bytes(600)
    others = [
        noise.hex(), base64.b64encode(noise).decode(),
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    ]
    far = spark.createDataFrame(list(enumerate(others)), "doc_id bigint, text string")
    found = langid.predict(far, model).collect()
    assert all(r.rejected for r in found), found


def hash_fold(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# 10
def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype("float32")], i) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)] + [(2000, None, 0), (2050, [1.0, None] + [0.0] * 6, 0), (2100, [float("nan")] * 8, 0), (2150, [float("inf")] + [0.0] * 7, 0), (None, rows[1][1], 0), (2200, [0.5, -0.25], 0), (5, rows[5][1], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int")
    good = [(i, np.floor(256 * np.array(v + [0.0] * (8 - len(v))))) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    wanted = {}
    for q, v in good:
        if q % 50 == 0:
            wanted[q] = sorted(((int(v @ x), i) for i, x in good if i != q), key=lambda p: (-p[0], p[1]))[:5]
    for pivots, block in ((24, 8192), (6, 16), (1, 50)):
        found = collections.defaultdict(list)
        for r in topk.top_k(df, F.col("vec_id") % 50 == 0, pivots=pivots, block=block).orderBy("query_id", "rank").collect():
            found[r.query_id].append((r.score, r.vec_id))
        assert found == wanted
    few = topk.top_k(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_top_k_with_repeated_query_rows(spark):
    """Many rows of the query's own id, exact copies or near ones, hide none of its partners in other cells."""
    rng = np.random.default_rng(4)
    others = [(i, [float(x) for x in rng.normal(size=2)]) for i in range(1, 60)] + [(7, [3.0, 0.5])] * 3
    for own in ([(100, [5.0, 0.0])] * 30, [(100, [5.0, j / 64]) for j in range(9)]):
        rows = others + own
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        for query in (7, 100):
            queries = {tuple(v) for i, v in rows if i == query}
            pairs = ((int(np.floor(256 * np.array(q)) @ np.floor(256 * np.array(x))), i) for q in queries for i, x in rows if i != query)
            wanted = sorted(pairs, key=lambda p: (-p[0], p[1]))[:5]
            found = topk.top_k(df, F.col("vec_id") == query, pivots=60, block=8).collect()
            assert [(r.score, r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == wanted


def test_top_k_prunes_clustered_vectors(spark):
    """Queries go to few data groups, rows to few query groups, and the result is whole."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 8)) * 40
    rows = [(i, [float(x) for x in centres[i % 20] * (1 + i % 3 / 50) + rng.normal(size=8) * 0.05]) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    sent, data, _ = topk.join_plan(df, F.col("vec_id") % 50 == 0, 5, 60, 4, 256)
    groups = data.select("query_group").distinct().count()
    assert groups >= 5 and sent.select("query_id", "cell").distinct().count() < 40 * 60 / 10
    assert data.count() < 2000 * groups / 4
    x = np.floor(256 * np.array([v for _, v in rows]))
    found = topk.top_k(df, F.col("vec_id") % 50 == 0, pivots=60, block=4).collect()
    for q in range(0, 2000, 50):
        wanted = sorted(((int(x[q] @ x[i]), i) for i in range(2000) if i != q), key=lambda p: (-p[0], p[1]))[:5]
        assert [(r.score, r.vec_id) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] == wanted


def test_top_k_is_exact_beyond_doubles(spark):
    rows = [(i, [1048576.0 + i, 2097152.0 - i / 256, float(i)]) for i in range(40)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 7, pivots=3).collect()
    x = {i: [int(256 * c // 1) for c in v] for i, v in rows}
    wanted = sorted(((sum(a * b for a, b in zip(x[7], x[i])), i) for i in x if i != 7), key=lambda p: (-p[0], p[1]))[:5]
    assert wanted[0][0] > 2**53 and [(r.score, r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == wanted
