"""Substring dedup against brute force, and on awkward rows."""

import random
import re

import numpy as np
import pytest
from test_llm_operators import AWKWARD, cluttered, documents, prose

from marquee.llm import relative_parsing as rlz

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_removal(rows, least=13):
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - least + 1):
            if d is not None:
                key = tuple(w[i : i + least])
                first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - least + 1):
            if d is not None and first[tuple(w[i : i + least])] < d:
                gone.update(range(i, i + least))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def removal(docs, **options):
    return sorted((tuple(r) for r in rlz.remove_repeats(docs, **options).collect()), key=repr)


def repeats(rng):
    """Passages that begin and end anywhere, edited copies, exact copies, texts of few words."""
    passages = [prose(rng, rng.randint(10, 70), 5000).split() for _ in range(12)]
    rows = []
    for i in range(160):
        text = prose(rng, rng.randint(0, 80), 5000).split()
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            begin = rng.randint(0, len(p) // 2)
            at = rng.randint(0, len(text))
            text[at:at] = p[begin : rng.randint(begin, len(p))]
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 2)):
                if text:
                    text[rng.randrange(len(text))] = "edited"
        rows.append((rng.randint(0, 10**6) * 2 + i % 2, "\n".join(text) if i % 2 else " \t".join(text)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_removal_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    low = [(d + 2_000_000, t) for d, t in repeats(rng)]
    rows = repeats(rng) + low + AWKWARD + [(3_000_000, "few " * 40), (3_000_001, "few " * 17), (3_000_001, "few " * 12), (None, "few " * 40)]
    rng.shuffle(rows)
    assert removal(cluttered(documents(spark, rows)).repartition(5)) == brute_removal(rows)


def test_removal_with_a_few_words_only(spark):
    """Few distinct words: every anchor is common, and matches overlap everywhere."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(120)]
    assert removal(documents(spark, rows).repartition(3)) == brute_removal(rows)


@pytest.mark.parametrize("name, value", [("HOT_SEGMENTS", 3), ("FLUSH_SEGMENTS", 50), ("BLOCK_WORDS", 60), ("PIECE_BYTES", 90)])
def test_removal_does_not_depend_on_sizes(spark, monkeypatch, name, value):
    rng = random.Random(11)
    rows = repeats(rng) + [(5 * i, f"in the case of the last w{i} and " + prose(rng, 30, 3000)) for i in range(60)]
    monkeypatch.setattr(rlz, name, value)
    if name == "HOT_SEGMENTS":
        monkeypatch.setattr(rlz, "HOT_SHARE", 0)
        monkeypatch.setattr(rlz, "HOT_IN_FLUSH", 2)
        data = rlz._rows(documents(spark, rows), "doc_id", "text")
        assert len(rlz.hot_anchors(data))
    # The tasks' own module has the standard sizes: the parts are run here as well.
    assert removal(documents(spark, rows).repartition(2)) == brute_removal(rows)
    texts = [t.encode() for _, t in rows]
    whole = rlz.segments(texts, np.zeros(0, np.uint64))
    windows = {(n, i) for n, a, b in zip(whole.number, whole.at, whole.to, strict=True) for i in range(a, b - 12)}
    assert windows == {(n, i) for n, t in enumerate(texts) for i in range(len(t.split()) - 12)}


def test_equal_windows_have_equal_keys():
    rng = random.Random(2)
    texts = [t.encode() for _, t in repeats(rng)]
    for hot in (np.zeros(0, np.uint64), np.unique(rlz.segments(texts, np.zeros(0, np.uint64)).key.view(np.uint64))[::3]):
        found, keys = rlz.segments(texts, hot), {}
        for key, n, a, b in zip(found.key, found.number, found.at, found.to, strict=True):
            words = texts[n].split()
            for i in range(a, b - 12):
                assert keys.setdefault(tuple(words[i : i + 13]), key) == key


def test_factors_are_greedy_and_checked_at_their_ends():
    """Words 0-13 match one segment, words 4-17 another: the first factor hides the second."""
    texts = [list(range(14)) + [90], [91] + list(range(4, 18)), list(range(18))]
    words = np.concatenate([np.array(t, dtype=np.uint64) * np.uint64(7919) for t in texts])
    bounds = np.cumsum([0] + [len(t) for t in texts])
    segment, at, to = rlz.factors(words, bounds, np.array([1, 2, 3]))
    spans = {(int(a), int(b)) for s, a, b in zip(segment, at, to, strict=True) if s == 2}
    assert (0, 14) in spans
    assert set().union(*(range(a, b) for a, b in spans)) == set(range(18))
    assert not any(s < 2 for s in segment if s == 0)


def test_removal_with_other_lengths(spark):
    rng = random.Random(21)
    rows = repeats(rng)
    for least in (3, 20):
        assert removal(documents(spark, rows), least=least) == brute_removal(rows, least)


def test_removal_of_nothing(spark):
    assert removal(documents(spark, [])) == []
    assert removal(documents(spark, [(1, None), (None, None), (2, "")])) == sorted([(1, 0, 0, ""), (None, 0, 0, ""), (2, 0, 0, "")], key=repr)
