from __future__ import annotations

import itertools

import numpy as np
import pytest
from llm_cases import LONG, saved

from ampflow.llm.html_blocks import blocks, described
from ampflow.llm.html_crf import ChainField, op1_html, train
from ampflow.llm.html_training import labelled_pages

PAGE = "page_id long, url string, html string, text string, n_chars int"


@pytest.fixture(scope="module")
def model():
    return train(labelled_pages())


def test_held_out_pages(model):
    wrong = total = 0
    for page in labelled_pages(200, seed=77):
        found = described(page)
        labels = model.labels([b.features for b in found])
        wrong += sum((b.part == "main") != bool(y) for b, y in zip(found, labels, strict=True))
        total += len(found)
    assert wrong <= 0.005 * total


def test_viterbi_is_the_best_of_all_sequences():
    rng = np.random.default_rng(3)
    names = [f"f{i}" for i in range(6)]
    field = ChainField({n: tuple(rng.normal(size=2)) for n in names}, tuple(map(tuple, rng.normal(size=(2, 2)))))
    for length in range(6):
        sequence = [list(rng.choice(names, 3)) for _ in range(length)]

        def score(labels, sequence=sequence):
            own = sum(field.features[f][y] for fs, y in zip(sequence, labels, strict=True) for f in fs)
            return own + sum(field.pairs[a][b] for a, b in zip(labels, labels[1:], strict=False))

        best = max(itertools.product((0, 1), repeat=length), key=score)
        assert score(field.labels(sequence)) == pytest.approx(score(best))


def test_article_without_the_rest(model):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
    <article><h1>A &amp; B</h1><p>One   two<br>three &eacute;&#233; &copy; &am</p><!-- <p>no</p> --><div class="ad">Buy this now</div>
    <p>x <b>y<p>z</p><ul><li>item</li></ul></article><section class="comments"><div class="comment"><p>I disagree with it.</p></div></section>
    <aside class="sidebar"><p>More to read</p></aside><form><label>Mail</label><textarea>t</textarea></form><footer>&copy; Site</footer></body></html>"""
    assert model.extract(page) == "A & B\n\nOne two three éé © &am\n\nx y\n\nz\n\nitem"


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "</p></div>", "<script>never ends", "<!-- never ends", "a < b > c", "<p title='a > b'>t", "&#0;&bogus;", "<a <b <c", "<svg/><p>t</p>"])
def test_broken_markup_does_not_fail(model, page):
    assert isinstance(model.extract(page), str)


def test_blocks_of_wrongly_nested_markup():
    assert [b.text for b in blocks("<div><p>a<p>b<b>c</div>d</b><table><tr><td>e<td>f</table>")] == ["a", "bc", "d", "e", "f"]


def test_query_on_awkward_rows(spark, tmp_path):
    article = f"<body><nav><a href='/'>Home</a></nav><article><p>{LONG}</p></article></body>"
    rows = [(1, None, None, "old", 1), (2, "u", "", None, None), (None, "u", article, None, None), (3, "u", "<article><p>t</p></article>", None, None)]
    rows += [rows[-1]]
    stored = spark.createDataFrame(rows, PAGE)
    got = op1_html(spark, saved(spark, tmp_path / "a", pages=stored))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [(1, None, "", 0), (2, "u", "", 0), (None, "u", LONG.strip(), len(LONG.strip())), (3, "u", "t", 1), (3, "u", "t", 1)])
    )
    assert op1_html(spark, saved(spark, tmp_path / "b", pages=stored.limit(0))).collect() == []


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<svg/><p>t</p>", ["t"]),
        ('<svg class="icon" /><article><p>t</p></article><svg><text>no</text></svg><p>u</p>', ["t", "u"]),
        ("<div><svg><path d='x'><p>t</p></div><p>u</p>", ["t", "u"]),
        ("<a><svg><title>no</a><article>t</article>", ["t"]),
        ("<p>x <svg><title/><style/><g><text>no</text></g></svg> y</p>", ["x y"]),
        ("<p><svg><foreignObject><div>t</div></foreignObject><text>no</text></svg>u</p>", ["t", "u"]),
        ("<math><p>t</p>", ["t"]),
        ("<p>if <math><mi>a</mi><mo>=</mo><mn>1</mn></math> holds</p>", ["if a=1 holds"]),
        ("<p>a <noscript>b <b>c</b></noscript> <object data='x'>d</object></p><object><p>e</p>", ["a b c d", "e"]),
        ("<p>t</p><template><p>no</p></template><p>u</p>", ["t", "u"]),
        ("<p>t</p><script/>no</script><p>u</p><style>no", ["t", "u"]),
    ],
)
def test_only_raw_elements_hide_what_follows(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_article_after_a_closed_drawing_is_kept(model):
    assert model.extract("<svg/><article><p>t</p></article>") == model.extract("<article><p>t</p></article>") == "t"
    page = f'<body><nav><a href="/">Home</a></nav><svg class="icon" /><article><p>{LONG}</p></article></body>'
    assert model.extract(page) == LONG.strip()


@pytest.mark.parametrize("opened", ["", "<div>", "<div id=xyz>", "<section class='qwk zz'>", "<div><div>"])
def test_articles_in_plain_containers(model, opened):
    said = ["A title of some words", *(f"Paragraph {i} says a number of things, and it says them at some length." for i in range(8))]
    article = f"<h1>{said[0]}</h1>" + "".join(f"<p>{p}</p>" for p in said[1:])
    closed = "".join(f"</{t.split()[0]}>" for t in opened.replace("<", " <").replace(">", "").split(" <")[1:][::-1])
    for before, after in (("", ""), ("<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<footer>&copy; Site</footer>")):
        assert model.extract(f"<html><body>{before}{opened}{article}{closed}{after}</body></html>") == "\n\n".join(said)


def test_controls_inside_an_article_are_left_out(model):
    said = [f"Paragraph {i} says a number of things, and it says them at some length." for i in range(4)]
    controls = "<button>Share</button><select><option>One</option><option>Two</option></select>"
    page = f"<body><article><p>{said[0]}</p><p>{said[1]}</p>{controls}<p>{said[2]}</p><p>{said[3]}</p></article></body>"
    assert model.extract(page) == "\n\n".join(said)


@pytest.mark.parametrize("unit", ["<div>x", "<font>x ", "<div class='c%d'>x", "<x%d>x ", "<ul><li>x", "<p><b>x", "<b><p>x</b>", "<table><tr><td>x"])
def test_deep_pages_take_linear_time(model, unit):
    count = 40_000
    page = "".join(unit % i if "%" in unit else unit for i in range(count))
    assert len("".join("".join(b.text for b in blocks(page, model.features)).split())) == count
    assert isinstance(model.extract(page), str)


def test_gradient_of_the_training_is_that_of_all_sequences(monkeypatch):
    """One step of training moves each weight against the slope of the likelihood, which all label sequences give."""
    from ampflow.llm import html_crf as C

    pages = ["<body><p data-part='main'>a b c d.</p><p>x</p></body>", "<div data-part='main'><h1>t</h1>u</div><a href=''>v</a><p>w.</p>"]
    monkeypatch.setattr(C, "STEPS", 1)
    moved = train(pages)
    observed, expected = {}, {}
    for page in pages:
        found = described(page)
        truth = [int(b.part == "main") for b in found]
        every = list(itertools.product((0, 1), repeat=len(found)))  # all weights are zero: all sequences are as likely
        for i, block in enumerate(found):
            for f in block.features:
                observed[f, truth[i]] = observed.get((f, truth[i]), 0) + 1
                for y in (0, 1):
                    expected[f, y] = expected.get((f, y), 0) + sum(s[i] == y for s in every) / len(every)
    for (feature, label), value in expected.items():
        slope = value - observed.get((feature, label), 0)
        step = moved.features[feature][label]
        assert abs(step) < 1e-9 if abs(slope) < 1e-12 else step * slope < 0
