"""The numpy networks against plain loops and finite differences."""

import math
import random

import numpy as np
import pytest

from marquee.llm import attention_lm, toxicity

# ---- convolutional classifier


TEXTS = ["bad worse bad", "good", "", "fine good words here today", "bad", "worse thing to say today", "good day good day", "say bad"]
LABELS = np.array([1, 0, 0, 0, 1, 1, 0, 1], dtype=np.float64)


@pytest.fixture()
def trained(monkeypatch):
    """Gradients of the first step, and the model before it."""
    seen = {}

    class Watched(toxicity._Adam):
        def update(self, name, value, gradient, rows=slice(None)):
            full = np.zeros_like(value)
            full[rows] = gradient
            seen.setdefault(name, full)

    monkeypatch.setattr(toxicity, "_Adam", Watched)
    for name in ("EPOCHS", "LEAST_STEPS", "LEAST_TEXTS"):
        monkeypatch.setattr(toxicity, name, 1)
    monkeypatch.setattr(toxicity, "BATCH", len(TEXTS))
    model = toxicity.train(toxicity._bucketed(TEXTS), LABELS)
    return model, seen


def plain_logits(model, texts):
    buckets, bounds = toxicity.word_buckets(texts)
    ids = model.slot[buckets]
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        words = [model.embedding[i].astype(float) + model.embedding[j].astype(float) for i, j in ids[a:b]]
        total = float(model.bias) + float(model.prior)
        at = 0
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = -math.inf
                # Windows may reach over the end of the text, where there is nothing.
                for p in range(len(words) + max(toxicity.WIDTHS)):
                    value = 0.0
                    for shift in range(width):
                        if p + shift < len(words):
                            value += float(words[p + shift] @ model.filters[k][shift][:, f].astype(float))
                    best = max(best, value)
                total += max(best + float(model.filter_bias[k][f]), 0.0) * float(model.weight[at])
                at += 1
        out.append(total)
    return out


def test_convolution_equals_plain_loops(trained):
    model, _ = trained
    texts = [*TEXTS, "words never seen", " ".join(["long", "bad", "text"] * 40)]
    buckets, bounds = toxicity.word_buckets(texts)
    assert model.logits(model.slot[buckets], bounds) == pytest.approx(plain_logits(model, texts), abs=1e-4)


def loss(model):
    z = np.array(plain_logits(model, TEXTS))
    return float(np.mean(np.log1p(np.exp(z)) - LABELS * z)) + 0.5e-4 * float((model.weight.astype(float) ** 2).sum())


def test_a_score_does_not_depend_on_the_next_text(trained):
    model, _ = trained
    alone = [float(model.scores([t])[0]) for t in TEXTS]
    assert model.scores(TEXTS).tolist() == pytest.approx(alone, abs=1e-6)
    assert model.scores(TEXTS[::-1]).tolist()[::-1] == pytest.approx(alone, abs=1e-6)


def test_convolution_gradients_equal_differences(trained):
    model, seen = trained
    parts = {f"filter{k}": model.filters[k] for k in range(len(toxicity.WIDTHS))}
    parts |= {f"filter_bias{k}": model.filter_bias[k] for k in range(len(toxicity.WIDTHS))}
    parts |= {"weight": model.weight, "embedding": model.embedding}
    for name, value in parts.items():
        gradient = seen[name]
        for flat in np.argsort(-np.abs(gradient).ravel())[:3]:
            at = np.unravel_index(flat, gradient.shape)
            step = np.float32(2e-3)
            kept = value[at]
            # A text without a positive window stands at the bend of its maximum: only a bias that falls leaves it there.
            ahead = np.float32(0) if "bias" in name else step
            value[at] = kept + ahead
            up = loss(model)
            value[at] = kept - step
            down = loss(model)
            value[at] = kept
            assert (up - down) / float(ahead + step) == pytest.approx(gradient[at], rel=0.05, abs=2e-4), name


def test_a_block_of_texts_is_packed(spark):
    """A row holds each distinct word once and gives the texts back, in order and with their labels."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["good", "bad", f"word{rng.randrange(500)}"]) for _ in range(rng.randrange(300))), "en" if i % 3 else None) for i in range(400)]
    docs = spark.createDataFrame([*rows, (400, None, "fr"), (401, "", "fr")], "doc_id long, text string, lang string").repartition(5)
    marked = docs.selectExpr("doc_id", "int(doc_id % 2) as label")
    packed = toxicity.text_blocks(docs, marked, 402).toArrow().to_batches()
    texts = {d: t for d, t, _ in rows}
    seen = 0
    for row, found in toxicity._block_rows(iter(packed)):
        assert len(found) == len(row["labels"]) == len(row["langs"])
        ids = sorted(r["doc_id"] for r in marked.selectExpr("doc_id", "pmod(xxhash64(doc_id), 2) as block").filter(f"block = {row['block']}").collect())
        want = toxicity._bucketed([texts.get(i) for i in ids])
        assert all(np.array_equal(a, b) for a, b in zip(found, want, strict=True)) and row["labels"] == [i % 2 for i in ids]
        seen += len(found)
    assert seen == 402
    # Words were 8 bytes each.
    size = sum(len(b) for row in spark.createDataFrame(packed[0].to_pandas()).collect() for b in row["words"])
    assert size * 2 < 8 * sum(len(t.split()) for t in texts.values())


def test_labelled_texts_move_once_as_buckets(spark, monkeypatch):
    """However big the labels, one exchange brings buckets to blocks; ids may repeat on both sides."""
    rows = [(i % 40, f"some words of number {i}", "en" if i % 3 else None) for i in range(100)] + [(None, "no id", "en"), (50, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    given = [(i, i % 2) for i in range(0, 60, 2)] + [(4, 1), (4, 1), (6, 0), (77, 1)]
    marked = spark.createDataFrame(given, "doc_id long, label int")
    monkeypatch.setattr(toxicity, "written", lambda df, label: df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        packed = toxicity.text_blocks(docs, marked, len(given))
        assert packed._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(") == 1
        found = packed.toArrow().to_batches()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = sorted((label, lang or "", toxicity._bucketed([text])[0].tobytes()) for d, text, lang in rows for i, label in given if d == i)
    got = [(label, lang or "", t.tobytes()) for row, texts in toxicity._block_rows(iter(found)) for label, lang, t in zip(row["labels"], row["langs"], texts, strict=True)]
    assert sorted(got) == want


# ---- attention


def plain_score(net, classes, ids, word_starts):
    """Log probability of the class of each token's first id, one window, by loops."""
    w = {k: v.astype(float) for k, v in net.w.items()}
    before = [attention_lm.END, *ids[:-1]]
    x = [w["embedding"][classes.slot[i]] + w["position"][t] for t, i in enumerate(before)]
    out = []
    for t in word_starts:
        q = x[t] @ w["query"] / math.sqrt(attention_lm.DIMENSION)
        weights = [math.exp(q @ (x[s] @ w["key"])) for s in range(t + 1)]
        mixed = sum(a * (x[s] @ w["value"]) for s, a in enumerate(weights)) / sum(weights)
        h = np.tanh(x[t] @ w["own"] + mixed @ w["mixed"] + w["hidden_bias"])
        z = h @ w["out"] + w["out_bias"]
        out.append(z[classes.of[ids[t]]] - math.log(np.exp(z).sum()))
    return out


def network(seed=1):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 40, attention_lm.N_IDS)
    classes = attention_lm.Classes.from_counts(counts, counts)
    return attention_lm.Network.fresh(counts, classes), classes, rng


def test_attention_equals_plain_loops():
    net, classes, rng = network()
    ids = rng.integers(0, 900, attention_lm.WINDOW)
    starts = np.array([0, 1, 4, 9, 15, 30])
    got = attention_lm.class_log_probabilities(net, classes, ids, starts, np.array([0]))
    assert got == pytest.approx(plain_score(net, classes, ids.tolist(), starts.tolist()), abs=1e-4)


def test_whole_score_by_loops(spark):
    """A text's score is the sum over its tokens of the class by the network and the token in its class by its count."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"word{rng.randrange(9)}" for _ in range(rng.randint(1, 6)))) for i in range(30)]
    docs = spark.createDataFrame([(d, t, d % 5 == 0) for d, t in rows], "doc_id long, text string, held boolean")
    chunks = attention_lm.written(attention_lm.word_chunks(docs), "lm-chunks")
    net, classes, _ = network()
    counted = {}
    for d, t in rows:
        if d % 5:
            for word in [*t.split(), None]:
                counted[word] = counted.get(word, 0) + 1
    encoding = attention_lm._encoding(attention_lm.VOCABULARY)
    pieces = {w: encoding.encode_ordinary(" " + w) if w else [attention_lm.END] for w in {x for _, t in rows for x in [*t.split(), None]}}
    kind = {w: int(classes.of[p[0]]) for w, p in pieces.items()}
    tokens, distinct = np.zeros((2, attention_lm.SINGLE_CLASSES + attention_lm.BAND_CLASSES), dtype=np.int64)
    for w, c in counted.items():
        tokens[kind[w]] += c
        distinct[kind[w]] += 1
    answers = attention_lm.word_counts(chunks, classes)
    got = {r["doc_id"]: r["score"] for r in attention_lm.score_chunks(chunks, answers, net, classes, tokens, distinct, counted[None]).collect()}
    for d, t in rows:
        words = [*t.split(), None]
        ids = [i for w in words for i in pieces[w]]
        starts = np.cumsum([0] + [len(pieces[w]) for w in words[:-1]]).tolist()
        assert len(ids) <= attention_lm.WINDOW
        inside = [math.log((counted.get(w, 0) + 1) / (tokens[kind[w]] + distinct[kind[w]] + 1)) for w in words]
        want = (sum(plain_score(net, classes, ids, starts)) + sum(inside)) / math.log(10)
        assert got[d] == pytest.approx(want, abs=1e-3)


def test_pieces_of_a_word_are_encoded_once():
    odd = ["Qué", "a\u00a0b", "x\u2003y", "\u3000", "tab\x1cz", "naïve", "\u0085q", "日本", "\u1680m", "can't", "123abc", "\u200bz", "emoji😀"]
    encoding = attention_lm._encoding(attention_lm.VOCABULARY)
    asked = []

    class Watched:
        def encode_to_numpy(self, text, **options):
            asked.append(text)
            return encoding.encode_to_numpy(text, **options)

        def encode_ordinary(self, text):
            asked.append(text)
            return encoding.encode_ordinary(text)

    pieces = attention_lm.Pieces(Watched())
    for listed in (["plain", *odd], [*odd, "more"], [*odd, "plain"]):
        words = attention_lm.split_words([" ".join(listed)])
        hashes, first = np.unique(words.hashes(lower=True), return_index=True)
        flat, lengths = pieces(hashes, words.raw, words.starts[first], words.ends[first])
        want = [encoding.encode_ordinary(" " + words.bytes_of(i).lower().decode()) for i in first]
        assert flat.tolist() == [x for w in want for x in w] and lengths.tolist() == [len(w) for w in want]
    assert sum(t.count("plain") for t in asked) == 1 and sum(t.count("日本") for t in asked) == 1
    assert sum(t.count("more") for t in asked) == 1


def test_weights_are_averaged_by_windows(spark):
    rng = np.random.default_rng(2)
    fits = [(slot, int(rng.integers(1, 9)), rng.normal(size=5)) for slot in range(700)]
    df = spark.createDataFrame([(s, n, (w * n).tobytes()) for s, n, w in fits], attention_lm._WEIGHTS)
    want = sum(n * w for _, n, w in fits) / sum(n for _, n, _ in fits)
    assert attention_lm.averaged(df) == pytest.approx(want)
    assert attention_lm.averaged(df.limit(0)) is None


def test_rounds_cover_all_blocks_once():
    import zlib

    names = [f"{p}-{i}" for p in range(40) for i in range(10)]
    shares = [sum(zlib.crc32(n.encode()) % attention_lm.ROUNDS == k for n in names) for k in range(attention_lm.ROUNDS)]
    assert sum(shares) == 400 and min(shares) > 80


def test_every_id_is_trained_and_scored_by_loops(spark):
    """A token is the class of its first id and then a token of the corpus, by its count, or its
    ids one by one: later ids of a word are trained on and scored like the first."""
    rng = random.Random(9)
    vocabulary = [f"{rng.choice('bdk')}{rng.choice('aou')}lmqx{rng.randrange(90)}" for _ in range(12)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 3)))) for i in range(40)] + [(41, "neverseenbefore7"), (45, "neverseen qqzx")]
    docs = spark.createDataFrame([(d, t, d % 5 in (0, 1)) for d, t in rows], "doc_id long, text string, held boolean")
    chunks = attention_lm.written(attention_lm.word_chunks(docs), "lm-chunks")
    encoding = attention_lm._encoding(attention_lm.VOCABULARY)
    spelled = lambda w: encoding.encode_ordinary(" " + w) if w else [attention_lm.END]
    of_words, of_ids, firsts = {}, np.zeros(attention_lm.N_IDS, np.int64), np.zeros(attention_lm.N_IDS, np.int64)
    for d, t in rows:
        if d % 5 not in (0, 1):
            for word in [*t.split(), None]:
                of_words[word] = of_words.get(word, 0) + 1
                np.add.at(of_ids, spelled(word), 1)
                firsts[spelled(word)[0]] += 1
    counts, begun = attention_lm.subword_counts(chunks)
    assert (counts == of_ids).all() and (begun == firsts).all()
    classes = attention_lm.Classes.from_counts(counts, begun)
    net, shares = attention_lm.Network.fresh(counts, classes), classes.log_shares(counts)
    kinds = attention_lm.SINGLE_CLASSES + attention_lm.BAND_CLASSES
    tokens, distinct = np.zeros((2, kinds), dtype=np.int64)
    for w, c in of_words.items():
        tokens[classes.of[spelled(w)[0]]] += c
        distinct[classes.of[spelled(w)[0]]] += 1
    sizes = np.bincount(classes.of, weights=of_ids + 1.0, minlength=kinds)
    answers = attention_lm.word_counts(chunks, classes)
    scored = attention_lm.score_chunks(chunks, answers, net, classes, tokens, distinct, of_words[None], shares)
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    later = 0
    for d, t in rows:
        words = [*t.split(), None]
        ids = [i for w in words for i in spelled(w)]
        assert len(ids) <= attention_lm.WINDOW
        by_class, at, want = plain_score(net, classes, ids, range(len(ids))), 0, 0.0
        for w in words:
            own, kind = spelled(w), classes.of[ids[at]]
            letters = math.log((of_ids[own[0]] + 1) / sizes[kind])
            for k in range(1, len(own)):
                letters += by_class[at + k] + math.log((of_ids[own[k]] + 1) / sizes[classes.of[own[k]]])
            total = tokens[kind] + distinct[kind]
            inside = math.log((of_words.get(w, 0) + distinct[kind] * math.exp(letters)) / total) if total else letters
            want, at, later = want + by_class[at] + inside, at + len(own), later + len(own) - 1
        assert got[d] == pytest.approx(want / math.log(10), abs=2e-3)
    assert later > 2 * len(rows)
    for row in (c.asDict() for c in chunks.collect()):
        chunk = attention_lm.Chunk.of(row)
        ids, _, starts = attention_lm.sequences(row, chunk)
        taught = sum(len(x) for x, held in zip(np.split(ids, starts[1:]), chunk.held, strict=True) if not held)
        assert int((attention_lm.training_windows(row, chunk)[:, 1:] & 1).sum()) == taught


def test_a_long_new_word_has_a_finite_score():
    by_class, in_class = np.full(4000, -4.0), np.full(4000, -6.0)
    got = attention_lm.token_log_probabilities(by_class, in_class, np.array([0, 3999]), np.array([0, 5]), np.array([9, 0]), np.array([3, 0]))
    assert got == pytest.approx([-4 + math.log(3 / 12) - 6 - 3998 * 10, -10])
