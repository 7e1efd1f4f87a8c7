"""Toxicity, media, main texts and personal data."""

import hashlib
import html
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicework.llm import media, pii, toxicity
from sluicework.llm.main_text import Page, extracted, main_text
from sluicework.llm.queries import QUERIES


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=14))
def test_segments_are_all_maximal(scores):
    """By definition: the best segment first, then the same on either side of it."""

    def brute(lo, hi):
        best = None
        for a, b in itertools.combinations(range(lo, hi + 1), 2):
            s = sum(scores[a:b])
            if s > 0 and (best is None or s > best[2] or s == best[2] and b - a < best[1] - best[0]):
                best = (a, b, s)
        return [] if best is None else [*brute(lo, best[0]), best, *brute(best[1], hi)]

    got = toxicity.segments(np.array(scores, float))
    assert sum(s for *_, s in got) == sum(s for *_, s in brute(0, len(scores)))
    assert all(sum(scores[a:b]) == s > 0 for a, b, s in got)
    assert all(x[1] <= y[0] for x, y in itertools.pairwise(got))


def test_toxicity(spark, make_docs, texts):
    rng = random.Random(4)
    plain, bad = [f"word{i}" for i in range(200)], ["vile", "scum", "vileness"]
    docs, labels = [], []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        if i % 5 == 0:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(bad)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 5 == 0)))
    docs += [(10_000 + i, t) for i, t in enumerate(texts)] + [(None, "scum"), (1, docs[1][1])]
    table = make_docs(spark, docs)
    known = spark.createDataFrame([*labels, (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int").filter(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(table, known)
    got = toxicity.score(table, model, "doc_id", "score", "lang").collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    right = [(r.score >= 0.3) == (r.doc_id % 5 == 0) for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(right) > 100 and sum(right) > 0.97 * len(right)
    spans = [(r.score, p) for r in toxicity.score(table, model, "doc_id").collect() for p in r.passages]
    assert spans and all(p.significant == (p.chance <= toxicity.SIGNIFICANT) for _, p in spans) and any(p.significant for _, p in spans)
    kept = toxicity.without_toxic(table, model, threshold=0.5)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 600} >= {i for i in range(600) if i % 5}
    none = toxicity.fit(table, known.limit(0))
    assert len(toxicity.score(table, none, "doc_id").collect()) == len(docs)
    assert not toxicity.score(make_docs(spark, []), model, "doc_id").collect()


_ODDS = {"vile": 2.5, "scum": 1.5, "scum*": 0.4, "nast*": 0.9, "meek": 0.2}


def _plain_score(model, text):
    """The score by definition: the best stretch of words, then the best on either side of it, and the chances of all of them."""

    def odds(word):
        w = re.sub(r"^[\W_]+|[\W_]+$", "", word)
        names = [w, *(w[:k] + "*" for k in (4, 5, 6) if len(w) > k)] if w else []
        return max([_ODDS[x] for x in names if x in _ODDS], default=0.0) - toxicity.DRIFT

    scores = [odds(w) for w in text.lower().split()]

    def stretches(lo, hi):
        ways = [(sum(scores[a:b]), a - b, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)]
        best = max(ways, default=(0.0, 0, 0, 0))
        return [] if best[0] <= 1e-9 else [*stretches(lo, best[2]), best[0], *stretches(best[3], hi)]

    n, total = len(scores), 0.0
    for k, x in enumerate(sorted(stretches(0, n), reverse=True)):
        told = -math.log(1 - math.exp(-model.scale * n * math.exp(-model.rate * x)))
        total += told if k == 0 else max(0.0, told - 3.0)
    return 1 / (1 + math.exp(-(model.bias + model.slope * math.log1p(min(total, toxicity.MOST_EVIDENCE)))))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["vile", "Scum!", "scumbag", "nasty", "meek", "word", "other", "...", "a"]), max_size=18))
def test_score_is_its_definition(words):
    model = toxicity.Model(dict(_ODDS), rate=0.8, scale=0.05, bias=-3.0, slope=1.4)
    text = " ".join(words)
    assert math.isclose(model.probability(model.evidence(*model.passages(text))), _plain_score(model, text), rel_tol=1e-9, abs_tol=1e-12)


def test_ties_and_repeats_score_alike(spark, make_docs):
    model = toxicity.Model(dict(_ODDS), rate=0.8, scale=0.05, bias=-3.0, slope=1.4)
    docs = [(1, "vile word vile"), (2, "word vile vile"), (1, "vile word vile"), (3, "scum word vile"), (4, "vile word scum"), (5, "x" * 100_000), (6, "word " * 50_000 + "vile " * 20)]
    rows = toxicity.score(make_docs(spark, docs), model, "doc_id").collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(rows) == len(docs) and all(len(v) == 1 for v in by.values()) and by[3] == by[4] and min(by[5]) < min(by[1])


def test_toxicity_on_held_out_documents(spark, sf_dir):
    from sluicework.llm import common

    rows = QUERIES["op4_toxicity"](spark, sf_dir.replace("0.001", "0.01")).join(common.table(spark, sf_dir.replace("0.001", "0.01"), "labels"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=400))
def test_stored_sound_is_lossless(text):
    n, raw = media.payload(text)
    assert len(raw) % 64 == 0 and raw[:n] == text.encode() and not any(raw[n:])
    back, rate = media.samples(media.wav(raw))
    assert back == raw and rate == media.STORED_RATE


@pytest.mark.parametrize(("up", "down"), [(1, 2), (2, 3), (3, 2), (1, 1)])
def test_resampling_is_filtering(up, down):
    x = np.random.default_rng(1).normal(size=500).astype("f4")
    h = media._phases(up, down)[:, ::-1].T.reshape(-1)
    z = np.zeros(x.size * up, "f4")
    z[::up] = x
    y = media.resample(x, up, down)
    assert np.allclose(np.convolve(z, h)[: z.size][::down][: y.size], y, atol=1e-5)


def test_audio(spark, make_docs, texts, tmp_path):
    x = np.concatenate([np.zeros(4000), np.sin(np.arange(8000) * 0.6), np.zeros(4000)]).astype("f4")
    (span,) = media.active(media.log_mel(x).mean(1))
    assert abs(span[0] * media.HOP - 4000) < 400 and abs(span[1] * media.HOP - 12000) < 400
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (3, "one")]
    path = str(tmp_path / "media")
    media.store_audio(make_docs(spark, docs), path, "doc_id", "lang")
    found = media.audio_features(media.read_audio(spark, path), "doc_id", "lang", "n_bytes", "tensors").cache()
    got = found.collect()
    for r, (i, text) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.payload_sha256)), sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, hashlib.sha256(media.payload(d[1])[1]).hexdigest())), strict=True):
        n, raw = media.payload(text)
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (i, n, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(raw) + 44, hashlib.sha256(media.wav(raw)).hexdigest())
        _, mel, spans = media.features(media.wav(raw))
        assert np.allclose(np.array(r.tensors).reshape(mel.shape), mel) and [tuple(s) for s in r.segments] == spans
    one = hashlib.sha256(media.payload("one")[1]).hexdigest()
    assert len({str(r.tensors) for r in got if r.payload_sha256 == one}) == 1
    rows = media.tensor_rows(found, "doc_id").toPandas()
    t = media.tensors(pa.Table.from_pandas(rows))
    assert t.type == media.TENSOR and t.to_numpy_ndarray().shape == (sum(len(r.tensors) for r in got), media.TENSOR_FRAMES, media.MELS)
    media.write_tensors(found, str(tmp_path / "tensors"), "doc_id")
    for r in spark.read.parquet(str(tmp_path / "tensors")).collect():
        stored = media.unpack_tensors(r.tensors)
        assert stored.schema.field("log_mel").type == media.TENSOR and stored["start"][0].as_py() == 0 and len(stored) == len(next(x.tensors for x in got if x.doc_id == r.doc_id and [tuple(s) for s in x.segments] == [tuple(s) for s in r.segments]))
    media.store_features(media.read_audio(spark, path), str(tmp_path / "features"), "doc_id", "tensors", "segments")
    back = media.read_features(spark, str(tmp_path / "features")).collect()
    assert len(back) == len(docs)
    for r in back:
        _, mel, spans = media.features(media.wav(next(media.payload(t)[1] for i, t in docs if hashlib.sha256(media.payload(t)[1]).hexdigest() == r.payload_sha256)))
        half = mel.astype(np.float16)
        assert r.log_mel_sha256 == hashlib.sha256(half.tobytes()).hexdigest() and np.abs(half.astype("f4") - mel).max() <= 1 / 16
        assert [tuple(s) for s in r.segments] == spans and len(r.spans) == len(mel) and all(abs(s.end - s.start - media.TENSOR_FRAMES * media.HOP / media.RATE) < 1e-9 for s in r.spans)
        assert np.allclose(r.mean_level, mel.reshape(-1, media.MELS).mean(0), atol=0.04)
    (kept,) = spark.read.parquet(str(tmp_path / "features")).filter("doc_id IS NULL").collect()
    stream = media.unpack_tensors(kept.tensors)
    assert stream.schema.field("log_mel").type == media.HALF_TENSOR and stream["end"][0].as_py() == media.TENSOR_FRAMES * media.HOP / media.RATE
    media.store_audio(make_docs(spark, []), str(tmp_path / "none"), "doc_id")
    media.store_features(media.read_audio(spark, str(tmp_path / "none")), str(tmp_path / "no features"), "doc_id")
    assert not media.read_features(spark, str(tmp_path / "no features")).collect()
    assert not media.audio_features(media.read_audio(spark, str(tmp_path / "none")), "doc_id").collect()


def test_audio_query(spark, sf_dir):
    from sluicework.llm import common

    texts = {r.doc_id: r.text for r in common.table(spark, sf_dir, "documents").collect()}
    got = QUERIES["op6_audio_features"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        n, raw = media.payload(texts[r.doc_id])
        _, mel, spans = media.features(media.wav(raw))
        shape, k, seconds, levels = r.feature.split(";")
        assert (r.n_bytes, r.payload_sha256, shape, int(k)) == (n, hashlib.sha256(raw).hexdigest(), f"{mel.shape[0]}x{media.TENSOR_FRAMES}x{media.MELS}", len(spans))
        assert abs(float(seconds) - sum(e - a for a, e in spans)) < 1e-3 and np.allclose([float(x) for x in levels.split(",")], mel.reshape(-1, media.MELS).mean(0), atol=0.09)


def test_log_mel_is_its_definition():
    """Frame by frame: windowed, transformed by a plain sum, gathered by triangles."""
    x = np.random.default_rng(2).normal(size=700).astype("f4")
    got = media.log_mel(x)
    k = np.arange(media.WINDOW)
    basis = np.exp(-2j * np.pi * np.outer(np.arange(media.WINDOW // 2 + 1), k) / media.WINDOW)
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * k / media.WINDOW)
    mel = np.linspace(0, 2595 * np.log10(1 + media.RATE / 2 / 700), media.MELS + 2)
    edges = 700 * (10 ** (mel / 2595) - 1) / media.RATE * media.WINDOW
    assert got.shape == (5, media.MELS)
    for n in range(5):
        frame = np.zeros(media.WINDOW)
        part = x[n * media.HOP : n * media.HOP + media.WINDOW]
        frame[: part.size] = part
        power = np.abs(basis @ (frame * hann)) ** 2
        for m in range(media.MELS):
            a, b, c = edges[m : m + 3]
            weight = [max(0.0, min((f - a) / (b - a), (c - f) / (c - b))) for f in range(media.WINDOW // 2 + 1)]
            assert abs(got[n, m] - 10 * np.log10(weight @ power + 1e-10)) < 1e-2


PAGES = [
    (None, ""), ("", ""), ("<p>hi", "hi"), ("plain &amp; simple", "plain & simple"),
    ("<div><p>One, two</p><ul><li><a href=x>menu</a></li></ul></div>", "One, two"),
    ("<body><header><h1>Site</h1></header><main><article><header><h1>T</h1></header><p>A&nbsp;b\n c<br>d</p><div class='comments'><p>a reader said, at length, much</p></div><aside>x</aside></article></main><form><p>sub</p></form></body>", "T\nA b c d"),
    ("<nav><ul><li><a href=/>Home</a></ul></nav><div class=content><p>First, par.<p>Second &lt;b&gt; par.</div><div id=cookie-notice>We use cookies, yes, we do.</div><script>var x='</p>';</script>", "First, par.\nSecond <b> par."),
    ("<article><p>Text <!-- <p>no</p> --> here</p><table><tr><td>a<td>b</table></article><footer>&copy; us, them, all, of, us</footer>", "Text here\na\nb"),
    ("<ul><li><a href=a>only</a></li><li><a href=b>links</a></li></ul>", ""),
    ("<div class='sidebar widget'><p>Side, bar, text, of, some, length</p></div><div><p>Main.</p></div>", "Main."),
]


@pytest.mark.parametrize(("source", "want"), PAGES)
def test_main_text(source, want):
    assert extracted(source) == want


LONG = "word, " * 3 + "x" * 282


@pytest.mark.parametrize(("source", "want"), [
    (f"<nav>n</nav><article><h1>Head</h1><section>{f'<p>{LONG}</p>' * 20}</section><section><p>The end.</p></section><aside>a</aside></article>", ["Head", *[LONG] * 20, "The end."]),
    (f"<nav>n</nav><article><h1>Head</h1><p>Lede.</p><div class=article-body>{f'<p>{LONG}</p>' * 20}</div><ul><li><a href=x>Source</a></ul></article>", ["Head", "Lede.", *[LONG] * 20, "Source"]),
    (f"<nav>n</nav><main><h1>Head</h1><div>{f'<p>{LONG}</p>' * 20}</div><ul><li><a href=x>menu</a></ul></main>", ["Head", *[LONG] * 20]),
    (f"<nav>n</nav><div><h1>Head</h1><div>{f'<p>{LONG}</p>' * 20}</div></div>", ["Head", *[LONG] * 20]),
    (f"<nav>n</nav><h1>Site</h1><div>{f'<p>{LONG}</p>' * 20}</div>", [LONG] * 20),
    (f"<nav>n</nav><article><p>{LONG}</p><p>{LONG}</p></article><article>{f'<p>{LONG}</p>' * 3}</article>", [LONG] * 5),
])
def test_main_text_is_whole(source, want):
    assert Page(source).article().split("\n") == want


P1, P2, P3 = (f"{a}, a sentence of some length that tells about {a}, with commas, and goes on until it is long enough to be text." for a in ("rivers", "bridges", "boats"))
TEMPLATES = {
    "blog": (
        f"""<html><head><title>T</title><style>p{{}}</style></head><body class=home><div id=page><div id=masthead><h1><a href=/>My blog</a></h1><p>Just another site</p></div>
        <div id=primary class=content-area><div class=post><h2 class=entry-title>On rivers</h2><div class=entry-meta>by A</div><div class=entry-content><p>{P1}</p><blockquote><p>{P2}</p></blockquote><p>{P3}</p></div>
        <div class=sharedaddy><ul class=share><li><a href=x>Tweet</a></ul></div></div><div id=comments class=comments-area><p>{P1} says a reader</p></div></div>
        <div id=secondary class=widget-area><aside class=widget><ul><li><a href=1>Old</a></li></ul></aside></div><div id=colophon class=site-footer>powered</div></div></body></html>""", ["On rivers", "by A", P1, P2, P3]),
    "old table": (
        f"<table width=100%><tr><td colspan=2><a href=/>Home</a> | <a href=/n>News</a></td></tr><tr><td width=120><a href=1>One</a><br><a href=2>Two</a></td><td><font size=+2>Rivers</font><p>{P1}<p>{P2}<p>{P3}</td></tr></table>", ["Rivers", P1, P2, P3]),
    "documentation": (
        f"<body><header><nav><a href=/>Docs</a></nav></header><div class=layout><nav class=toc><ul><li><a href=#a>A</a></ul></nav><main><h1>Guide</h1><p>{P1}</p><pre><code>x = 1\ny = 2</code></pre><h2>Next</h2><p>{P2}</p><table><tr><th>k<th>v<tr><td>a<td>b</table></main></div><footer>(c)</footer>",
        ["Guide", P1, "x = 1 y = 2", "Next", P2, "k", "v", "a", "b"]),
    "one form": (
        f"<body><form id=aspnetForm action=x><input type=hidden value=1><div id=header><a href=/>Site</a></div><div id=content><h1>Boats</h1><p>{P3}</p><p>{P1}</p></div><div id=footer>end</div></form></body>", ["Boats", P3, P1]),
    "references": (
        f"<nav><a href=/>x</a></nav><div class=content><h1>R</h1><p>{P1}</p><p>{P2}</p><ul><li><a href=1>A study of rivers and of their bridges, 2019</a></li><li><a href=2>Boats through the ages, a second edition</a></li></ul></div>",
        ["R", P1, P2, "A study of rivers and of their bridges, 2019", "Boats through the ages, a second edition"]),
    "broken": (f"<div class=content><p title=\"a>b\">{P1}<p class='x'>{P2}<b>bold<i>both</b> on</p></span></div><!-- never ended <p>{P3}</p>", [P1, f"{P2}boldboth on"]),
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_main_text_of_templates(name):
    source, want = TEMPLATES[name]
    assert extracted(source).split("\n") == want


EIGHT = [f"{w}, a sentence that tells about {w}, with commas, and goes on until it is long enough to be taken for a text of its own." for w in "rivers bridges boats locks mills weirs ferries docks".split()]
_MENU = "<nav><a href=/>Home</a></nav><div class=menu><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>"


@pytest.mark.parametrize("opening", ['<div class="content-with-sidebar">', '<div id="content" class="has-sidebar">', '<div class="page no-comments">', '<div class="main search">', '<div id="login">', '<section class="widget">', '<div class="layout header-fixed">'])
def test_layout_words_lose_no_page(opening):
    body = "".join(f"<p>{p}</p>" for p in EIGHT)
    assert extracted(f"<body>{_MENU}{opening}{body}</div><div class=footer>the end of it</div></body>").split("\n") == EIGHT


@pytest.mark.parametrize(("piece", "kept"), [
    (f'<section id="social"><h2>Social</h2><p>{EIGHT[0]}</p><p>{EIGHT[1]}</p><p>{EIGHT[2]}</p></section>', ["Social", *EIGHT[:3]]),
    ('<h2 id="login">Login</h2>', ["Login"]), ('<h2 id="share">Share</h2>', ["Share"]), (f'<p id="related-work">{EIGHT[0]}</p>', [EIGHT[0]]), ('<p class="byline">By A. Writer</p>', ["By A. Writer"]),
    ("<p>Where <math><mi>x</mi><mo>=</mo><mn>3</mn></math> holds</p>", ["Where x=3 holds"]),
    ('<ul class="share"><li><a href=x>Tweet</a></li></ul>', []), ('<div class="ad">Buy now, cheap.</div>', []), (f'<div id="comments"><p>{EIGHT[0]}</p><p>{EIGHT[1]}</p></div>', []), (f'<div class="notice"><p>{EIGHT[0]}</p></div>', []),
    (f'<ol class="comment-list"><li class="comment"><article class="comment-body"><p>{EIGHT[0]}</p></article></li></ol>', []), ('<form action=x><label>Mail</label><input></form>', []), ('<p class="cookie-note">We use cookies.</p>', []),
])
def test_names_inside_an_article(piece, kept):
    before, after = EIGHT[3:6], EIGHT[6:]
    source = f"<body>{_MENU}<article><h1>Title</h1>{''.join(f'<p>{p}</p>' for p in before)}{piece}{''.join(f'<p>{p}</p>' for p in after)}</article></body>"
    assert extracted(source).split("\n") == ["Title", *before, *kept, *after]


def test_comments_longer_than_the_article():
    replies = "".join(f'<div class="comment"><p>{p}</p></div>' for p in EIGHT * 5)
    for opening in ("<article>", "<div class=post>", "<div>"):
        assert extracted(f"<body>{_MENU}{opening}<p>{EIGHT[0]}</p><p>{EIGHT[1]}</p></div></article><section id=comments>{replies}</section></body>").split("\n") == EIGHT[:2]


@pytest.mark.parametrize("words", [0, 3, 40])
def test_an_article_in_a_form_whatever_stands_outside(words):
    """The form's text counts by what it holds, however long a notice beside it is."""
    notice = f"<div class=notice>{' '.join(['word'] * 20 * words)}</div>"
    source = f"<body>{notice}<form id=aspnetForm><div id=content>{''.join(f'<p>{p}</p>' for p in EIGHT)}</div></form></body>"
    assert extracted(source).split("\n") == EIGHT


def test_short_references_of_a_container():
    links = "<ul><li><a href=1>Source A</a></li><li><a href=2>Source B</a></li></ul>"
    for opening in ("<main>", "<div class=content>"):
        source = f"<body>{_MENU}{opening}<h1>T</h1>{''.join(f'<p>{p}</p>' for p in EIGHT[:3])}<h2>References</h2>{links}</div></main></body>"
        assert extracted(source).split("\n") == ["T", *EIGHT[:3], "References", "Source A", "Source B"]
    assert "Source A" not in extracted(f"<body><div class=content>{links}{''.join(f'<p>{p}</p>' for p in EIGHT[:3])}</div></body>")


@pytest.mark.parametrize("piece", ["<a ", '<a href="x', "<a href='x\"", "<div>", "<p><span>", "<!-- x ", "< ", "&amp", "<p>a, b", "</p>", "<ul><li><a href=x>k", '<a b=">', "<script>", "<form><p>t", "<table><tr><td>"])
def test_broken_pages_take_linear_time(piece):
    """Twenty times as much must not take two hundred times as long."""

    def seconds(n):
        source = f"<p>{P1}</p>" + piece * n
        began = time.process_time()
        extracted(source)
        return time.process_time() - began

    assert seconds(40_000) < 60 * max(seconds(2_000), 0.01)


def test_deep_pages():
    for n in (600, 10_000):
        source = "<div>" * n + f"<p>{P1}</p><p>{P2}</p>" + "</div>" * n
        assert extracted(source).split("\n") == [P1, P2]


def test_main_text_of_pages(spark, sf_dir):
    """The articles of the test pages, by their own markup."""
    from sluicework.llm import common

    pages = {r.page_id: r.html for r in common.table(spark, sf_dir, "pages").collect()}
    got = QUERIES["op7_main_text"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", b))).strip() for b in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text)
    rows = spark.createDataFrame([(1, "u", "<p>a, b</p>", "clash"), (1, "u", "<p>a, b</p>", "clash"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in main_text(rows, "page_id", "text").collect()) == [(0, ""), (1, "a, b"), (1, "a, b")]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "1", "@", ".", "-", "+", "%", " ", "9_b", "2", "(", ")", "4539 1488 0343 6467", "4539148803436467", "10.0.0.1", "256", "+1 (555) 010-9999", "é", "x@y.z"]), max_size=12).map("".join))
def test_base_patterns(text):
    assert pii.base_spans(text) == base(text)


def _spans(kind):
    return st.lists(st.tuples(st.integers(0, 30), st.integers(1, 6)).map(lambda s: (kind, s[0], s[0] + s[1])), max_size=8)


@settings(max_examples=500, deadline=None)
@given(_spans("secret"), _spans("email"))
def test_secrets_apart_from_base_spans(secrets, found):
    assert pii.apart(secrets, found) == [s for s in secrets if not any(s[1] < e and b < s[2] for _, b, e in found)]


def test_many_spans_of_one_text():
    """Half of 100,000 secrets meet one of 100,000 base spans; comparing all with all would take hours."""
    secrets = [("secret", 10 * i, 10 * i + 4) for i in range(100_000)]
    found = [("ip", 20 * i + 3, 20 * i + 9) for i in range(100_000)]
    began = time.process_time()
    assert pii.apart(secrets, found) == secrets[1::2]
    assert time.process_time() - began < 10


def test_secrets_are_found_and_plain_text_is_left():
    field = pii.default_field()
    rng = random.Random(11)
    found = miss = false = 0
    for _ in range(300):
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((18, 32, 40)))) + "7"
        line = rng.choice([f"some words password={secret} follow", f'here token = "{secret}" and more', f"api_key: {secret}", f"take AKIA{secret[:14].upper()}7Q then"])
        (spans,) = pii.secret_spans(field, [line])
        found += len(spans) == 1
        miss += not spans
        plain = f"In {rng.randrange(3000)} the {rng.randrange(99)}th word of chapter{rng.randrange(9)}, costs 12.50 or +1 555 010 {rng.randrange(9999)} token list"
        false += len(pii.secret_spans(field, [plain])[0])
    assert found > 285 and miss < 15 and false == 0


def test_secrets_without_a_digit():
    """Announced ones are found on lines without any digit; long words, names and headings are left."""
    field = pii.default_field()
    rng = random.Random(12)
    found = 0
    for _ in range(300):
        secret = "".join(rng.choice(rng.choice(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) for _ in range(rng.randint(14, 40)))
        secret = rng.choice((secret, secret.lower()))
        line = rng.choice([f"some words password = {secret} follow", f'here token = "{secret}" and more', f"access_token: {secret}"])
        found += [line[a:b] for _, a, b in pii.secret_spans(field, [line])[0]] == [secret]
    assert found > 285
    for line in ("The password is internationalization", "name = internationalization", "see: Donaudampfschifffahrtsgesellschaft", "AN INTERNATIONALIZATION KEY", "getElementByIdentifier(token)", "password: required", "public key infrastructure"):
        assert not pii.secret_spans(field, [line])[0]


def test_secrets_of_texts_decoded_apart(monkeypatch):
    text = "one\npassword = correcthorsebattery\n\nlonger line with token: 0a1b2c3d4e5f60718293 and api_key = qwertyuiopasdfgh\nx"
    want = pii.secret_spans(pii.default_field(), [text, "", text])
    assert [text[a:b] for _, a, b in want[0]] == ["correcthorsebattery", "0a1b2c3d4e5f60718293", "qwertyuiopasdfgh"] and want[2] == want[0] and not want[1]
    monkeypatch.setattr(pii, "HELD_TOKENS", 3)
    assert pii.secret_spans(pii.default_field(), [text, "", text]) == want


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    field = pii.default_field()
    lines = [[["a", "12ab", "=", "token", '"', "9f9f9f9f9f9f9f9f"][i] for i in rng.integers(0, 6, rng.integers(1, 7))] for _ in range(60)]
    emissions = [field.emissions(x, np.array([len(x)])) for x in lines]
    whole, sizes = field.emissions([t for x in lines for t in x], np.array([len(x) for x in lines])), np.array([len(x) for x in lines])
    assert np.allclose(whole, np.concatenate(emissions))
    plain = field.plain(whole, sizes)
    for tokens, e, path, left in zip(lines, emissions, field.viterbi(emissions), plain, strict=True):
        near = [sum((field.weights.get(f, np.zeros(3)) for f in pii.token_features(tokens, i)), np.zeros(3)) for i in range(len(tokens))]
        assert np.allclose(e, near)
        score = lambda p: sum(e[i, y] for i, y in enumerate(p)) + sum(field.steps[a, b] for a, b in itertools.pairwise(p))  # noqa: E731, B023
        assert np.isclose(score(path), max(score(p) for p in itertools.product(range(3), repeat=len(tokens))))
        assert not (left and path.any())
    assert plain.any() and not plain.all()


FORMS = {
    "assigned at the start": ("api_key = {}", "h24"), "issued by a forge": ("git clone https://x/y.git with {} please", "ghp_m36"), "issued, alone": ("{}", "ghp_m36"), "header": ("Authorization: Bearer {}", "m32"),
    "signed token": ("the session {} was sent", "jwt"), "cloud key": ("aws_secret_access_key = {}", "b40"), "cloud id": ("use {} for that", "AKIAu16"), "JSON": ('{{"client_secret": "{}", "n": 3}}', "h32"), "camel case": ("accessToken: '{}'", "m24"),
    "environment": ("export GITHUB_TOKEN={}", "m40"), "address": ("see https://api.site.org/v1/x?access_token={}&page=2", "h32"), "in the middle": ("some words password={} follow here", "h20"), "payment key": ("key {} leaked", "sk_live_m24"),
    "maps key": ("maps use {}", "AIzam35"), "letters": ("password = {}", "l18"), "element": ("<password>{}</password>", "m20"), "YAML": ("  db_password: {}  # local", "m16"), "name and number": ("password={}", "w9"), "with signs": ("PASSWORD: {}", "s10"),
}


@pytest.mark.parametrize("form", FORMS)
def test_secrets_by_form(form):
    """Lines that the labelled table's templates don't draw: nine in ten secrets of each form, exactly."""
    rng = random.Random(form)
    line, kind = FORMS[form]
    m = pii._LOWER + pii._UPPER + pii._DIGITS
    pools = {"h": "0123456789abcdef", "m": m, "b": m + "+/", "u": pii._UPPER + pii._DIGITS, "l": pii._LOWER}

    def draw():
        if kind == "jwt":
            return ".".join(start + "".join(rng.choice(m) for _ in range(n)) for start, n in (("eyJ", 33), ("eyJ", 70), ("", 43)))
        if kind in ("w9", "s10"):
            name = rng.choice(("hunter", "summer", "blackcat", "Monday", "dragon", "liverpool"))
            return f"{name}{rng.choice('@#!_$') if kind == 's10' else ''}{rng.randrange(10, 9999)}"
        start, letters, n = re.fullmatch(r"(.*?)([hmbul])(\d+)", kind).groups()
        return start + "".join(rng.choice(pools[letters]) for _ in range(int(n)))

    found = 0
    for _ in range(100):
        secret = draw()
        text = line.format(secret)
        found += [text[a:b] for _, a, b in pii.secret_spans(pii.default_field(), [text])[0]] == [secret]
    assert found >= 90


def test_lines_without_secrets():
    lines = [
        "The key to success is persistence.", "token ring networks were used in 1985", "commit 3f786850e387550fdab836ed7e6dc881de23001b", "ISBN 978-3-16-148410-0", "id 550e8400-e29b-41d4-a716-446655440000", "secret: none", "api version: v1.2.3",
        "auth = true", "key=value", "See https://www.example.org/some-long-path/with-words.html for keys", "monkey business 123", "passport number required", "compass12 heading", "password: ********", "api_key: <your key here>", "The token budget is 2048.", "room B12 and seat 14C",
        "key findings: growth of 12.5% in Q3", "author: M. Keyes, 2004", "secretary general", "a b c d e f g", "iPhone15ProMax review", "see RFC2616 and ISO8601", "x = 3.14159265358979",
    ]
    assert not [x for x in lines if pii.secret_spans(pii.default_field(), [x])[0]]


def test_a_long_line_is_decoded_with_little_memory():
    import tracemalloc

    text = "\n".join(["few words here"] * 300 + [" ".join(f"w{i % 977}" for i in range(100_000)) + " password=0a1b2c3d4e5f60718293"])
    field = pii.default_field()
    tracemalloc.start()
    (spans,) = pii.secret_spans(field, [text])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [text[a:b] for _, a, b in spans] == ["0a1b2c3d4e5f60718293"] and most < 80e6


@pytest.mark.parametrize("part", range(4))
def test_any_number_of_leading_zeros(part):
    parts = ["7"] * 4
    parts[part] = "0" * 5000 + "1"
    text = f"at {'.'.join(parts)} and {'0' * 4999}256.1.1.1 end"
    assert pii.base_spans(text) == [("ip", 3, 3 + 5001 + 6)]


def test_zeros_in_every_part(spark, make_docs):
    text = ".".join(["0" * 5000] * 4)
    (row,) = pii.personal_data(make_docs(spark, [(1, text)]), "doc_id").collect()
    assert [tuple(s) for s in row.base] == [("ip", 0, len(text))]


def test_redaction_of_many_spans_takes_linear_time(spark, make_docs):
    n = 40_000
    docs = make_docs(spark, [(1, " ".join(f"a{i}@b.cc" for i in range(n))), (2, None), (3, "x")])
    began = time.time()
    rows = {r.doc_id: r for r in pii.personal_data(docs, "doc_id", clean=True).withColumn("again", pii.redacted(F.col("text"), F.col("spans"))).collect()}
    assert time.time() - began < 25
    assert rows[1].clean == rows[1].again == " ".join(["<EMAIL>"] * n)
    assert rows[2].clean is rows[2].again is None and rows[3].clean == rows[3].again == "x"


def test_overlapping_spans_are_one_stretch():
    assert pii.redact("0123456789", [("b", 2, 5), ("a", 4, 7), ("c", 7, 8), ("d", 2, 3)]) == "01<D><C>89"


_PROSE = ["the password for the server is {}", "pw: {}", "I set my password to {}", "Passwort: {}", "das Passwort für den Server lautet {}", "le mot de passe est {}", "la contraseña del servidor es {}", "mdp = {}", "Kennwort: {}", "the access token is {}"]


@pytest.mark.parametrize("form", _PROSE)
def test_secrets_told_in_prose_of_four_languages(form):
    rng = random.Random(form)
    made = ["".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(rng.randrange(12, 33))) for _ in range(150)]
    found = pii.secret_spans(pii.default_field(), [form.format(x) for x in made])
    assert sum(f == [("secret", len(form) - 2, len(form) - 2 + len(x))] for f, x in zip(found, made, strict=True)) >= 135


def test_personal_data(spark, make_docs, texts):
    docs = [(i, t) for i, t in enumerate(texts)] + [(50, "mail a.b@c.de or +1 (555) 010-9999, 10.1.2.3 and 4539148803436467.\npassword=0a1b2c3d4e5f60718293\n😀 x@y.zz"), (None, "x@y.zz"), (50, "é 1.2.3.4")]
    rows = pii.personal_data(make_docs(spark, docs), "doc_id", "spans", "lang").withColumn("clean", pii.redacted(F.col("text"), F.col("spans"))).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert [tuple(s) for s in r.base] == base(r.text or "") and [tuple(s) for s in r.spans][: len(r.base)] == base(r.text or "")
        want = r.text
        for kind, a, b in sorted(map(tuple, r.spans), key=lambda s: -s[1]):
            want = want[:a] + f"<{kind.upper()}>" + want[b:]
        assert r.clean == want
    long = next(r for r in rows if r.text and r.text.startswith("mail"))
    assert [s.kind for s in long.spans] == ["email", "email", "ip", "card", "phone", "secret"]
    assert not pii.personal_data(make_docs(spark, []), "doc_id").collect()
