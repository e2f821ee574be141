"""Ranked lexical search against brute force, and on awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import AWKWARD, cluttered, documents, lower, prose

from marquee.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_ranking(docs, items, k=20):
    counted = [(d, Counter(TERM.findall(lower(t)))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, all_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for number, (item, text) in enumerate(items):
        query = Counter(TERM.findall(lower(text)))
        scored = []
        for d, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // all_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in query.items() if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, number, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=lambda r: r[1:3])


def ranking(docs, items, **options):
    return sorted((tuple(r) for r in ranked_search.ranked_search(docs, items, **options).collect()), key=lambda r: r[1:3])


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randint(1, 120)).replace("w1", "W1-é")) for i in range(150)]
    rows += [(150 + i, "tied Tied words of w3 w4") for i in range(60)]
    rows += [(300 + i, f"tied words {'pad ' * i}") for i in range(5)] + AWKWARD
    items = [(i, prose(rng, 30)) for i in range(6)] + [(6, "tied words"), (6, "tied words"), (7, None), (8, ""), (9, "absent"), (None, "w3, W3; w3")]
    return rows, items


@pytest.mark.parametrize("options", [{}, {"k": 3}, {"pass_chars": 100}])
def test_ranking_equals_brute_force(spark, corpus, options):
    rows, items = corpus
    docs = cluttered(documents(spark, rows)).withColumn("item_id", F.lit(1)).withColumn("rank", F.lit(2)).repartition(5)
    got = ranking(docs, items_of(spark, items), **options)
    assert [r[1:] for r in got] == [r[1:] for r in brute_ranking(rows, items, options.get("k", 20))]


def test_ranking_does_not_depend_on_tiles(spark, corpus, monkeypatch):
    rows, items = corpus
    for name, value in (("VOCABULARY_TILE", 7), ("ITEM_TILE", 2), ("_HELD", 10), ("_PIECE_CHARS", 50)):
        monkeypatch.setattr(ranked_search, name, value)
    vocabulary = ranked_search.queries_of(items).vocabulary
    length, text, place, count = ranked_search.term_counts([t for _, t in rows], vocabulary)
    assert length.tolist() == [len(TERM.findall(t or "")) for _, t in rows]
    monkeypatch.undo()
    whole = ranked_search.term_counts([t for _, t in rows], vocabulary)
    assert all((a == b).all() for a, b in zip(whole[1:], (text, place, count), strict=True))


def test_scores_are_exact_beyond_a_double():
    rng = np.random.default_rng(3)
    doc, term = (x.ravel() for x in np.meshgrid(np.arange(4), np.arange(5000), indexing="ij"))
    impact = rng.integers(1, 10**6, len(doc))
    weight = rng.integers(1 << 26, 1 << 28, 5000)
    got = ranked_search.tile_scores(doc, term, impact, 4, np.zeros(5000, np.int64), np.arange(5000), weight, 1)
    want = [sum(int(w) * int(x) for w, x in zip(weight, impact[doc == d], strict=True)) for d in range(4)]
    assert want[0] > 1 << 53 and got[0].tolist() == want


def test_best_keeps_ties_by_id():
    best = ranked_search.Best(1, 3)
    for ids in ([9, 8, 7], [6, 1], [5, 2]):
        best.add(0, np.full((1, len(ids)), 4), np.array(ids), np.zeros(len(ids), bool))
        best.keep()
    best.add(0, np.array([[0, 3, 5]]), np.array([0, 0, 3]), np.zeros(3, bool))
    assert best.keep()[3].tolist() == [3, 1, 2]


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, " ")], [(1, "a")]), ([(1, "a")], [(1, None)])])
def test_ranking_of_nothing(spark, docs, items):
    assert ranking(documents(spark, docs), items_of(spark, items)) == []
