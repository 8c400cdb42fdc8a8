"""Phrase collocations and hard negatives against brute force; main texts of pages of many shapes."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasieve.llm import collocations, extraction, negatives

# ---- collocations


def brute_phrases(rows, least, top):
    """The definition, phrase by phrase."""
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: f for key, f in counts.items() if f >= least}
    held = {}
    for (lang, w), f in often.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                held[lang, part] = max(f, held.get((lang, part), 0))
    out = []
    for lang in total:
        found = []
        for (own, w), a in often.items():
            if own == lang and len(w) > 1 and 100 * held.get((lang, w), 0) < 50 * a:
                score, _, l, r = min((10**6 * a * a // (often[lang, w[:k]] * often[lang, w[k:]]), k, often[lang, w[:k]], often[lang, w[k:]]) for k in range(1, len(w)))
                found.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -score) for i, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return Counter(out)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(11)
    vocabulary = ["the", "The", "of", "sea", "été", "日本", "a-b", "x y", "q" * 40, "to", "go", "no"]
    prose = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " \t "]) for _ in range(n))
    rows = [(prose(rng.randrange(120)), rng.choice(["en", "en", "fr", None, "und", ""])) for _ in range(60)]
    rows += [(None, "en"), ("", None), ("   ", "fr"), ("...", "de"), ("once only here", "sv"), ("New York City now " * 40, "en"), (("go to " * 3000).strip(), "fr")]
    return rows + rows[:7]  # repeated rows


SHAPE = "text string, lang string, f long, k int, phrase string, pack long, n long, rank int"


@pytest.mark.parametrize("bits", [collocations.BITS, 5])  # five bits: every fingerprint collides
def test_collocations(spark, talk, bits):
    docs = spark.createDataFrame([(t, lang, 1, 2, "p", 3, 4, 5) for t, lang in talk], SHAPE).repartition(3)
    for least, top in ((10, 2000), (2, 7)):
        got = collocations.mine(docs, least, top, bits=bits).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        assert Counter(map(tuple, got.collect())) == brute_phrases(talk, least, top)


def test_no_collocations(spark):
    assert collocations.mine(spark.createDataFrame([], SHAPE)).count() == 0
    assert collocations.mine(spark.createDataFrame([("a b", "en")], "text string, lang string")).count() == 0


def test_scores_past_64_bits(spark):
    f = 3_000_000_000_001
    counts = spark.createDataFrame([("en", 1, "a", f + 7), ("en", 1, "b", f + 1), ("en", 2, "a b", f)], "lang string, k int, phrase string, f long")
    (row,) = collocations.scores(counts).collect()
    assert (row.a, row.l, row.r, row.score) == (f, f + 7, f + 1, 10**6 * f * f // ((f + 7) * (f + 1)))


def test_parts_cut_no_phrase(monkeypatch):
    raw = ("one Two, three  four\tfive six. seven " * 50 + "w" * 500 + " eight nine").encode()
    whole = Counter()
    for most in (1 << 20, 300, 40, 1):
        monkeypatch.setattr(collocations, "CHUNK", 97 if most == 300 else 1 << 19)
        seen = Counter()
        for text, own in collocations.parts(raw, most):
            starts, ends, piece = collocations.words_of(text)
            prints, counts, pointers = collocations.count_grams(text, starts, ends, piece, own, 9, 64)
            for p, c, at in zip(prints.tolist(), counts.tolist(), pointers.tolist()):
                seen[p, text[starts[at >> 2] : ends[(at >> 2) + (at & 3) - 1]].tobytes()] += c
        whole = whole or seen
        assert seen == whole and sum(v for (_, t), v in seen.items() if b" " not in t) == 353


# ---- hard negatives


def brute_negatives(rows, every, n_positive=5, n_negative=5):
    kept = set()
    for i, vec, label in rows:
        if None not in (i, vec, label) and all(x is not None and math.isfinite(x) for x in vec) and len(vec) == 6:
            kept.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in vec)))
    out = Counter()
    for i, label, vec in kept:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(vec, v)), j, own) for j, own, v in kept if j != i)
            for score, j, own in [x for x in scored if x[2] == label][:n_positive]:
                near = [(s, m) for s, m, own in scored if own != label and 80 * -score <= 100 * -s <= 100 * -score][:n_negative]
                out.update((i, j, rank, m, -score, -s) for rank, (s, m) in enumerate(near, 1))
    return out


def test_hard_negatives(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], int(rng.integers(0, 10))) for i in range(1, 400)]
    rows += [(400 + i, [1.0, 0.5, 0.0, 0.0, 0.25, -1.0], i % 3) for i in range(90)]  # a vector of many rows
    rows += [(600, None, 1), (601, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (602, [float("nan")] * 6, 2), (603, [float("inf")] * 6, 2), (604, [0.0] * 6, 2), (700, [0.0] * 6, 1), (605, [1.0], 2), (606, [0.5] * 6, None), (None, [0.5] * 6, 1)]
    rows += rows[3:30]  # repeated rows
    vectors = spark.createDataFrame([(i, v, label, 1, 2, "z") for i, v, label in rows], "vec_id long, embedding array<double>, label int, id long, key long, vec string").repartition(3)
    got = negatives.mine(vectors, F.col("id") % 20 == 0)
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows, 20)
    assert negatives.mine(vectors.limit(0), F.col("id") % 20 == 0).count() == 0


def test_bitmap_shrinks():
    rng = np.random.default_rng(1)
    v = np.floor(256 * rng.normal(size=(2000, 32)) * np.geomspace(4, 0.01, 32)).astype(np.int64)
    columns, read = negatives.Columns(v), []
    order = np.argsort(-np.abs(v[0]), kind="stable")

    def want(low, high):
        read.append(len(low))
        return high >= negatives.fifth(low, 5)

    rows, scores = columns.scan(v[0], np.ones(2000, bool), want)
    assert read[0] == 2000 and read[-1] < 200 and (scores == v[rows] @ v[0]).all() and len(order) == 32
    assert sorted((v @ v[0]).tolist())[-5:] == sorted(scores.tolist())[-5:]


def test_components_past_the_bound(spark):
    rows = [(100, [3e38, 1.0], 1), (1, [3e38, 1.0], 1), (2, [1.0, 1.0], 1), (3, [1.0, 0.9], 2), (200, [1.0, 1.0], 1)]
    got = negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("id") % 100 == 0).collect()
    assert [(r.anchor_id, r.positive_id, r.negative_id) for r in got] == [(200, 2, 3)]


# ---- main text


PROSE = [f"Paragraph {i} of the story goes on for a while, with commas, and it ends here." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PROSE)
LINKS = "".join(f'<li><a href="/{i}">Section number {i}</a></li>' for i in range(8))
TEXT = "\n\n".join(PROSE)

PAGES = [
    (None, ""),
    ("", ""),
    ("plain text only", "plain text only"),
    (f"<body><nav><ul>{LINKS}</ul></nav><article><h1>Title &amp; more</h1>{BODY}</article><footer>&copy; 2020</footer></body>", "Title & more\n\n" + TEXT),
    # no telling names: density decides
    (f"<body><div><ul>{LINKS}</ul></div><div><div><h2>Head</h2>{BODY}</div></div><div><a href=a>Home</a> <a href=b>About us</a> <a href=c>Contact</a></div><div>Made by us</div></body>", "Head\n\n" + TEXT),
    (f"<table><tr><td><ul>{LINKS}</ul><td>{BODY}</table>", TEXT),
    (f"<div class='wrap'><div class='content-sidebar-wrap'><h1>T</h1>{BODY}</div><div id='sidebar-left'><p>{PROSE[0]}</p></div></div>", "T\n\n" + TEXT),
    (f"<main><header><h1>T</h1></header>{BODY}<div class='post-comments'>{BODY * 3}</div><div class='ad-slot'>Buy</div></main>", "T\n\n" + TEXT),
    (f"<article>{BODY}<article class='comment depth-1'><p>{PROSE[1]}</p></article></article>", TEXT),
    (f"<header>Site <b>name</b></header><div>{BODY}</div><div role=banner>Hi</div><div hidden>h</div><p style='display: none'>s</p>", TEXT),
    (f"<form><div>{BODY}</div><input value=x><select><option>one<option>two</select><button>Go</button></form>", TEXT),
    (f"<div>{BODY}<form><p>Your name please</p></form></div>", TEXT),
    (f"<div>{BODY}<div class='cookie-notice'>We use cookies</div><aside>{PROSE[0]}</aside></div>", TEXT),
    ("<p>a<p>b &lt;i&gt;<br>c&nbsp;&nbsp;d &#x41;&amp e</p>", "a\n\nb <i> c d A& e"),
    (f"<body class='has-sidebar'><div>{BODY}<!-- <p>no</p> --><script>var t='</p><p>no';</script><style>p{{}}</style></div>", TEXT),
    (f"<div>{BODY}</b></i></div></div><!-- open", TEXT),
    (f"<section><p>{PROSE[0]} <a href=x>link</a></p>{BODY}<ul><li>first <b>bold</b></li><li>second</li></ul></section>", f"{PROSE[0]} link\n\n{TEXT}\n\nfirst bold\n\nsecond"),
    (f"<h1>Only title</h1><div><p>{'long ' * 50}</p><p>{'text ' * 50}</p></div>", f"Only title\n\n{('long ' * 50).strip()}\n\n{('text ' * 50).strip()}"),
    (f"<div>{BODY}</div><a href='1' title='a > b'>x</a>", TEXT),
    ("<div><p>" + "word " * 200_000 + "</p></div>", ("word " * 200_000).strip()),
    ("<div>" * 5000 + "deep" + "</div>" * 3000, "deep"),
]


def test_extraction(spark):
    rows = [(i, f"u{i}", source, "t", 7) for i, (source, _) in enumerate(PAGES)] + [(None, None, PAGES[3][0], "t", 7), (3, "u3", PAGES[3][0], "t", 7)]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long").repartition(3))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {r.page_id: r for r in got.collect()}
    for i, (_, text) in enumerate(PAGES):
        assert found[i].text == text and found[i].n_chars == len(text) and found[i].url == f"u{i}", i
    assert found[None].text == PAGES[3][1] and got.filter("page_id = 3").count() == 2
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_broken_markup_is_read_once():
    for source in ("<div>" * 50_000, '<a "' * 50_000, "<b>" * 20_000 + "</i>" * 20_000, "<p>x" * 20_000, "<!--" * 50_000, "<" * 200_000, "<script>" * 50_000):
        extraction.Page(source).main_text()
