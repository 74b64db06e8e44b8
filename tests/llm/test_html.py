"""The page reader, the chain field, and extraction over odd pages."""

import itertools
import random

import numpy as np

from cdclake.llm import html_extraction as h


def test_blocks():
    page = "<div>a <b>b</b>c<p>d&amp;e<p>f<br>g</div><script>no</script><!-- no --><ul><li>x<li>y</ul>tail <i>z"
    assert [b.text for b in h.blocks(page)] == ["a bc", "d&e", "f", "g", "x", "y", "tail z"]
    assert [b.text for b in h.blocks('<a title="1 > 0">link</a> 1 < 2 <')] == ["link 1 < 2 <"]
    assert h.blocks("") == [] and h.blocks("<p>  </p>") == [] and [b.text for b in h.blocks("<p>x<style>p{}")] == ["x"]
    assert [b.path[-1][0] for b in h.blocks("<article><h1>t</h1>u</article>v")[:2]] == ["h1", "article"]


def test_self_closed_and_nested_raw_elements():
    texts = lambda page: [b.text for b in h.blocks(page)]
    assert texts('<p>a</p><svg class="icon"/><p>b</p><math/><p>c</p>') == ["a", "b", "c"]
    assert texts("<p>a</p><svg>x<svg>y</svg><svg/>z</svg><p>b</p>") == ["a", "b"]
    assert texts("<template>x<template>y</template>z</template><p>b</p>") == ["b"]
    assert texts("<svg>x<svg>y</svg><p>b</p>") == ["b"]
    assert texts("<script>'<script>'</script><p>b</p>") == ["b"]


def test_long_broken_pages_stay_cheap():
    import time
    start = time.time()
    for page in ("<" * 200_000, '<a "' * 50_000, "<p>" * 20_000 + "x", "<!--" * 50_000, "</p>" * 100_000):
        h.blocks(page)
    assert time.time() - start < 30


def test_viterbi_and_marginals():
    rng = np.random.default_rng(2)
    model = h.Field(rng.normal(size=(h.BUCKETS, 2)), rng.normal(size=(2, 2)))
    rows = [rng.integers(0, h.BUCKETS, 3) for _ in range(7)]
    score = model.scores(rows)
    value = lambda path: sum(score[i, y] for i, y in enumerate(path)) + sum(model.pair[a, b] for a, b in zip(path, path[1:]))
    paths = list(itertools.product((0, 1), repeat=7))
    assert tuple(model.decode(rows)) == max(paths, key=value)
    weights = np.exp([value(p) for p in paths])
    p, steps = model.marginals(rows)
    assert np.allclose(p[:, 1], (np.array(paths) * weights[:, None]).sum(axis=0) / weights.sum())
    assert np.isclose(steps.sum(), 6)


def test_extraction(spark):
    model = h.train_field(h.training_pages([]))
    rng = random.Random(99)
    wrong = total = 0
    for _ in range(60):
        found = h.blocks(h.made_page(rng))
        truth = [b.text.startswith("mainmark") for b in found]
        for b in found:
            b.parts = [p.replace("mainmark ", "") for p in b.parts]
        wrong += sum(a != bool(b) for a, b in zip(truth, model.decode(h.features(found))))
        total += len(found)
    assert wrong < 0.03 * total
    page = "<nav><a href='/'>home</a></nav><article><h1>T</h1><p>one &lt; two</p></article><footer>&copy; x</footer>"
    rows = [(1, "u", page, 5), (1, "u", page, 5), (2, None, None, 5), (3, "v", "", 5), (None, "w", "<p>" + "word " * 50_000, 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = {(r["page_id"], r["url"]): r["text"] for r in h.extract(pages, model).collect()}
    assert got[(1, "u")] == "T\none < two" and got[(2, None)] == "" and got[(3, "v")] == ""
    assert h.extract(pages.limit(0), model).count() == 0
