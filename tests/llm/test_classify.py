"""Main text of pages, the two classifiers, the pipeline, and the registration."""

import re
import subprocess
import sys
import zlib
from html import unescape
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from brute import near_duplicates

import corpus_pipeline as cp
from sitelens.llm import classify as cl
from sitelens.llm import chunks, html, packing, quality, queries, toxicity

ROOT = Path(__file__).resolve().parents[2]

PAGES = {
    "": "",
    "plain &amp; text": "plain & text",
    "<p>a<p>b": "a\n\nb",
    "<p>one&nbsp;two\n  three</p>": "one two three",
    "<script>var t='<p>x</p>'</script><style>p{}</style><p>kept": "kept",
    "<!-- <p>gone</p> --><p>kept</p><!-- open": "kept",
    '<div class="comments"><p>a long comment that goes on and on and on</p></div><div><h1>T</h1><p>Hello world this is</p><ul><li>one<li>two</ul></div>': "T\n\nHello world this is\n\none\n\ntwo",
    '<body><header><h1>Site</h1></header><div id="wrap"><nav><a href=x>a</a></nav><main><h1>Title</h1><p>First para with <a href="x">link</a> in.</p>'
    '<aside>side</aside><div class="cookie-notice">cookies!</div><form><input><label>Name</label></form><p>Short.</p><section id="comments"><p>great post</p></section></main></div><footer>f</footer>':
    "Title\n\nFirst para with link in.\n\nShort.",
    '<body class="has-sidebar"><div class="with-comments"><article class="post"><header><h1>Head</h1><span>by x</span></header><p>Body <b>bold<p>next</article></div>': "Head\n\nBody bold\n\nnext",
    '<div class="sidebar">s</div><div role="navigation">n</div><div hidden>h</div><div style="display:none">d</div><div><p>' + "word " * 30 + "</p></div>": ("word " * 30).strip(),
    "<table><tr><td>a<td>b<tr><td>c</table>": "a b\n\nc",
    "<p>1 < 2 and <b title='a>b'>3</b></p": "1 < 2 and 3",
    "<div>" * 3000 + "deep" + "</div>" * 3000: "deep",
    "<p>a<br>b</p></p></div></article>": "a b",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    if page.endswith("</p"):
        assert html.main_text(page).startswith(PAGES[page])
    else:
        assert html.main_text(page) == PAGES[page]


#: Pages whose raw-text elements are self-closed, unclosed or only alike in name.
RAW = {
    '<article><p>first</p><svg class="i"/><p>second</p><svg><path d="M0"/><text>drawn</text></svg><p>third</p></article>': "first\n\nsecond\n\nthird",
    '<article><p>first</p><svg class="i"><path d="M0"/><p>second</p></article>': "first\n\nsecond",
    '<article><svg><title/><style/><g></svg><p>first</p><svg><foreignObject><p>drawn</p></foreignObject></svg><p>second</p></article>': "first\n\nsecond",
    "<article><title-card>first</title-card><p>second</p><template-x>third</template-x></article>": "first\n\nsecond\n\nthird",
    '<article><div><p>first</p><iframe src="a"></div><p>second</p><iframe src="b"></iframe><iframe src="c"/><p>third</p></article>': "first\n\nsecond\n\nthird",
    "<article><p>first</p><noscript><div><article>none</article></noscript><template><p>none</p><template>none</template></div></template><p>second</p></article>": "first\n\nsecond",
    '<script src="a"/><article><p>first</p><script src="b"></script><p>second</p></article><script>"<p>none</p>"': "first\n\nsecond",
    "<body><noscript><article><p>kept of an open one</p></article></body>": "kept of an open one",
}


@pytest.mark.parametrize("page", RAW)
def test_raw_text_elements_take_no_more_than_their_own(page):
    assert html.main_text(page) == RAW[page]


LONG, MORE = ("Many plain words that tell the story. " * 8).strip(), ("And the other half of it, as long. " * 8).strip()
BOTH = f"{LONG}\n\n{MORE}"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "with-comments", "header-fixed", "layout sidebar-left", "elementor-widget", "menu", "content-sidebar-wrap", "tag-ad post"])
def test_a_wrapper_is_kept_whatever_its_name(name):
    page = f'<body><div class="nav"><a href="/">home</a></div><div class="{name}"><p>{LONG}</p><p>{MORE}</p></div><div class="site-footer">f</div></body>'
    assert html.main_text(page) == BOTH


NAMED = {
    '<h2 id="related-work">Related work</h2>': "Related work",
    '<h2 class="header" id="cookies">Cookies</h2>': "Cookies",
    '<section id="cookie-recipe"><p>Take flour.</p></section>': "Take flour.",
    '<p class="social sharing-policy" id="comment">A policy.</p>': "A policy.",
    '<div class="post-header"><h1>Head</h1></div>': "Head",
    '<div class="header"><h1>Head</h1><span>by x</span></div>': "Head",
    '<div class="post has-comments">It has some.</div>': "It has some.",
    '<div id="cookie-policy">We keep none.</div>': "We keep none.",
    '<pre>x = 1 <span class="comment"># one</span></pre>': "x = 1 # one",
    **dict.fromkeys(['<p class="ad">buy</p>', '<div class="ad-slot-300x250">buy</div>', '<div class="adBanner">buy</div>', '<section id="comments">great</section>', '<div class="comments-area">great</div>',
                     '<div class="related-posts">more</div>', '<ul class="share-buttons"><li>tell</ul>', '<div id="cookie_notice">ok?</div>', '<div class="left sidebar">side</div>', '<div class="entry-footer">tags</div>',
                     '<article class="comment">great</article>', '<div class="newsletter-signup">join</div>'], ""),
}


@pytest.mark.parametrize("part", NAMED)
@pytest.mark.parametrize("outer", ["article", "div"])
def test_noise_is_named_by_a_whole_class_or_id(part, outer):
    if outer == "div" and 'class="header"><h1>' in part:
        return  # outside an article it is the site's
    want = "\n\n".join(x for x in (LONG, NAMED[part], MORE) if x)
    assert html.main_text(f"<body><{outer}><p>{LONG}</p>{part}<p>{MORE}</p></{outer}></body>") == want


def test_density_falls_with_links():
    text, links = html._density(400, 2, 0, 0, 0.2), html._density(400, 20, 380, 20, 0.2)
    assert text > 50 * max(links, 1e-9)
    menu = "".join(f'<li><a href="/{i}">some menu entry {i}</a></li>' for i in range(30))
    page = f"<div><ul>{menu}</ul></div><div><p>{'plain words here. ' * 8}</p><p>{'more of them. ' * 9}</p></div>"
    assert html.main_text(page) == f"{('plain words here. ' * 8).strip()}\n\n{('more of them. ' * 9).strip()}"


def test_given_pages_against_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|<footer)", r.html, re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        want[r.page_id] = "\n\n".join(b for b in blocks if b)
    got = queries.op4_html(spark, "/root/testdata/sf0.01").collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, html_ int"
    rows = [(1, "u", None, "t", 1), (None, None, "<p>a", "t", 1), (2, "u", "<p>" + "x" * 300_000, "t", 1), (2, "u", "<" * 20_000, "t", 1), (3, "u", "<a b='" * 5000, "t", 1)]
    got = html.extracted(spark.createDataFrame(rows, schema)).collect()
    assert [len(r.text) for r in got if r.page_id != 2] == [0, 1, html.main_text("<a b='" * 5000).__len__()]
    assert html.extracted(spark.createDataFrame([], schema)).count() == 0


def _labelled(spark, docs, sf):
    return spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").join(docs, "doc_id").collect()


def _auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(1, len(score) + 1)
    n = (y == 1).sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("name", "label", "parts", "held", "least"), [("op9_quality", "quality", 5, 0, 0.99), ("op10_toxicity", "toxic", 4, 2, 0.97)])
def test_held_out_rows(spark, name, label, parts, held, least):
    sf = "sf0.1"
    scored = queries.QUERIES[name](spark, f"/root/testdata/{sf}")
    rows = _labelled(spark, scored, sf)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out]
    y, p = (np.array([r[c] for r in out]) for c in (label, "predicted"))
    assert _auc(np.array([r.score for r in out]), y) > least
    assert (y == p).mean() > 0.96


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_odd_rows(spark, documents, module):
    from pyspark.sql import functions as F

    rows = [(1, None), (2, ""), (3, "good words here"), (4, "bad!! words!! here!!"), (None, "no id"), (5, "x" * 400_000), (6, "é🙂ﬀ İstanbul"), (3, "good words here")]
    docs = documents(rows)
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (3, 0), (4, 0), (None, 1), (99, 1)], "doc_id long, label int").withColumnsRenamed({"label": "quality"}).withColumn("toxic", F.col("quality"))
    model = module.train(docs, labels, F.lit(True))
    got = module.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 < r.score < 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and len({r.score for r in got if r.doc_id == 3}) == 1
    nothing = module.train(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in module.score(docs, nothing).collect()} == {0.5}
    assert module.score(documents([]), model).count() == 0


def test_character_grams_against_plain_ones():
    texts = ["ÀbC déf", None, "", "xyz", "日本語テキスト", "aaaaaaa"]
    for _, n, found in toxicity.grams(pa.array(texts, pa.string())):
        assert n == len(texts)
        for size, (row, place) in zip(toxicity.SIZES, found, strict=True):
            assert [int((row == i).sum()) for i in range(n)] == [max(0, len(t or "") - size + 1) for t in texts]
            assert len(set(place[row == 5].tolist())) == 1
    low, up = (next(toxicity.grams(pa.array([t])))[2][0][1].tolist() for t in ("àbc déf", "ÀBC DÉF"))
    assert low == up


def test_a_carried_text_is_scored_once_sent(documents):
    docs = documents([(1, "some words"), (2, None)])
    model = (np.ones(1 << toxicity.BITS), 0.0)
    from pyspark.sql import functions as F

    plain = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    carried = toxicity.score(docs, model, carried={"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    assert {r.doc_id: (r.text, r.score) for r in carried} == {1: ("some words", plain[1]), 2: (None, plain[2])}


def test_ftrl_separates_and_drops_noise():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400).astype(float)
    rows = [(np.array([0 if label else 1, *rng.choice(np.arange(2, 50), 4, replace=False)]), np.ones(5)) for label in y]
    w, bias = cl.ftrl(rows, y, 50, 5, alpha=0.5, beta=1.0, l1=1.0, l2=0.1)
    assert w[0] > 1 and w[1] < -1 and np.abs(w[2:]).max() < w[0] / 2 and (w[2:] == 0).sum() > 5


@pytest.mark.parametrize("own", [True, False])
def test_a_fit_holds_its_rows_once(own):
    """The rows are views of the batches that came: an epoch copies none but the one it is at."""
    import tracemalloc

    rng, size, per, n = np.random.default_rng(2), 1 << 12, 2000, 500
    flat, value = rng.integers(0, size, per * n).astype(np.int32), rng.random(size).astype(np.float32)
    flat = flat.reshape(n, per)
    flat.sort(axis=1)
    rows = [(row,) if own else (row, value[:per]) for row in flat]
    y = rng.integers(0, 2, n).astype(float)
    tracemalloc.start()
    cl.ftrl(rows, y, size, 1, alpha=0.1, beta=1.0, l1=0.05, l2=0.1, values=value if own else None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < flat.nbytes / 4 and len(rows[0]) == 2 - own


@pytest.mark.parametrize("module", [quality, toxicity])
def test_a_fit_gets_features_of_all_tasks(spark, documents, monkeypatch, module):
    """No text goes to the one task of a fit, and its rows are those of the whole sample."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    words = ["plain", "good", "fine", "bad!!", "vile", "worse", "é🙂", "Text"]
    texts = [" ".join(rng.choice(words[3:] if i % 3 == 0 else words[:5], 40)) if i % 50 else None for i in range(400)]
    docs = documents(list(enumerate(texts))).repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, label int").withColumnsRenamed({"label": "quality"}).withColumn("toxic", F.col("quality"))
    seen, fitted = [], cl.fitted
    monkeypatch.setattr(cl, "fitted", lambda rows, *a, **k: seen.append(rows) or fitted(rows, *a, **k))
    weights, bias = module.train(docs, labels, F.lit(True))
    assert seen[0].columns[:4] == ["rank", "id", "label", "at"] and "text" not in seen[0].columns
    rows = seen[0].orderBy("rank", "id").collect()
    assert sorted(r.id for r in rows) == list(range(400))
    y, column = np.array([float(r.label) for r in rows]), pa.array([texts[r.id] for r in rows], pa.string())
    size = 1 << module.BITS
    if module is quality:
        want = [(at.astype(np.int32), value.astype(np.float32)) for at, value in quality.features(column)]
        plain, plain_bias = cl.ftrl(want, y, size, quality.EPOCHS, alpha=10.0, beta=1.0, l1=0.05, l2=0.0)
        assert all(np.array_equal(r.value, v) for r, (_, v) in zip(rows, want, strict=True))
    else:
        ((_, _, found),) = toxicity.grams(column)
        sets = [sorted({p for row, place in found for p in place[row == i].tolist()}) for i in range(400)]
        toxic, clean = np.zeros(size), np.zeros(size)
        for places, label in zip(sets, y, strict=True):
            (toxic if label else clean)[places] += 1
        n1, n0 = y.sum(), (1 - y).sum()
        ratio = np.log((toxic + 0.5) / (n1 + 1)) - np.log((clean + 0.5) / (n0 + 1))
        both = (toxic + clean) / (n1 + n0)
        apart = np.abs(toxic / n1 - clean / n0) / np.sqrt(np.maximum(both * (1 - both) * (1 / n1 + 1 / n0), 1e-12))
        keep = (apart >= toxicity.CLEAR) & (toxic + clean >= toxicity.SUPPORT)
        want = [(np.array([p for p in places if keep[p]], np.int32),) for places in sets]
        plain, plain_bias = cl.ftrl(want, y, size, toxicity.EPOCHS, alpha=0.1, beta=1.0, l1=0.05, l2=0.1, values=ratio.astype(np.float32))
        plain = plain * ratio
    assert all(r["at"] == w[0].tolist() for r, w in zip(rows, want, strict=True)) and sum(len(w[0]) for w in want) > 1000
    assert np.array_equal(weights, plain) and bias == plain_bias and (weights != 0).any()


def test_pipeline_stage_by_stage(spark):
    """Every stage's result against its input, the last against the tokens of the one before."""
    sf = "/root/testdata/sf0.01"
    from sitelens.llm.common import materialize

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in cp.STAGES:
        docs, _ = materialize(stage(spark, docs, sf), name)
        seen.append(docs)
        if name != "packing":
            assert docs.columns == list(cp.COLUMNS)
    start, clean, apart, cut, mixed, packed = ([r.asDict() for r in x.collect()] for x in seen)
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic == 1}
    gone = {r["doc_id"] for r in start} - {r["doc_id"] for r in clean}
    assert len(gone & toxic) > 0.8 * len(toxic) and all(r in start for r in clean)
    of = near_duplicates([(r["doc_id"], r["text"]) for r in clean], cp.NEAR)
    assert {r["doc_id"] for r in apart} == {i for i, (_, c) in of.items() if i == c}
    from test_texts import _plain_chunks

    want = _plain_chunks([(r["doc_id"], r["text"]) for r in apart], chunks.MIN_RUN)
    assert {r["doc_id"]: r["text"] for r in cut} == want and all(r["n_chars"] == len(r["text"]) for r in cut)
    by_id = {r["doc_id"]: r for r in cut}
    assert all(r == by_id[r["doc_id"]] for r in mixed)
    words = sum(len(r["text"].split()) for r in cut)
    assert abs(sum(len(r["text"].split()) for r in mixed) - words) < 0.05 * words
    from collections import Counter
    from public_tokenizers import path

    encode = packing.encoder(path("byte_bpe_50k.json"))
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed)
    for r in packed:
        ids = np.append(encode(by_id[r["doc_id"]]["text"]), 0)[r["start"] : r["start"] + r["length"]].astype("<u4").tobytes()
        assert bytes(r["ids"]) == ids and zlib.crc32(ids) == r["ids_crc32"]


def test_pipeline_rejects_what_op10_calls_toxic(spark, documents, monkeypatch):
    from pyspark.sql import functions as F

    scores = [0.1, queries.THRESHOLD - 0.01, queries.THRESHOLD, 0.4, 0.49, 0.5, 0.9]
    docs = documents([(i, "words") for i in range(len(scores))])
    score = F.element_at(F.array(*map(F.lit, scores)), F.col("doc_id").cast("int") + 1)
    monkeypatch.setattr(toxicity, "train", lambda *a, **k: None)
    monkeypatch.setattr(toxicity, "score", lambda docs, model, carried: docs.select(*[c.alias(n) for n, c in carried.items()], score.alias("score")))
    kept = cp.drop_toxic(spark, docs, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in kept} == {0, 1}


def test_pipeline_of_nothing(spark, documents):
    docs = documents([]).select(*cp.COLUMNS)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0


def test_registration():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_the_rest_works_without_these_folders(tmp_path):
    """The entry module imports and lists the other queries where this subpackage and the pipeline are absent."""
    code = ("import sys\n"
            "class No:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'sitelens.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, No())\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not [n for n in e.queries() if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in e.queries()\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
