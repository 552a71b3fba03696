"""The recurrent network: gradients, held-out accuracy, windows, edges."""

import math

import numpy as np
import pytest
from corpus_rows import documents

from wattline.llm import recurrent as R
from wattline.llm import toxicity as T


def test_gradients():
    rng, net = np.random.default_rng(1), R.Network.fresh(1)
    x = rng.standard_normal((R.WINDOW, 4, 2 * R.DIMENSIONS)).astype(np.float32)
    mask = np.ones((R.WINDOW, 4), bool)
    mask[11:, 1] = mask[1:, 2] = False
    _, memory = net.forward(x, mask, keep=True)
    gradients, d_x = net.backward(np.ones(4, np.float32), memory)

    def slope(values, at):
        held = values[at]
        values[at] = held + 1e-2
        high = net.forward(x, mask).sum()
        values[at] = held - 1e-2
        low = net.forward(x, mask).sum()
        values[at] = held
        return (high - low) / 2e-2

    for name in ("in", "bias", "gates", "candidate", "attend", "look", "out"):
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in net.values[name].shape)
            assert abs(slope(net.values[name], at) - gradients[name][at]) < 2e-3 + 0.02 * abs(gradients[name][at])
    assert abs(slope(x, (3, 0, 2)) - d_x[3, 0, 2]) < 2e-3
    assert (d_x[11:, 1] == 0).all()


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 49, 100])
def test_windows_overlap_and_cover(n):
    starts = R.window_starts(n)
    assert {j for s in starts for j in range(s, min(n, s + R.WINDOW))} == set(range(n))
    assert all(b - a <= R.STRIDE for a, b in zip(starts, starts[1:]))
    cut = R.windows(np.arange(n))
    assert cut.shape == (len(starts), R.WINDOW) and (n == 0 or cut.max() == n - 1)


def texts(n, seed):
    rng = np.random.default_rng(seed)
    common = [f"w{i}" for i in range(300)]
    bad = ["vile", "rotten", *(f"snarl{x}" for x in "abcdefgh")]
    rows = []
    for i in range(n):
        words = rng.choice(common, rng.integers(5, 150)).tolist()
        toxic = bool(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.integers(0, len(words)), rng.choice(bad[: 6 if seed == 0 else 10]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learns_words_and_forms_it_has_not_seen():
    learnt, new = texts(1200, 0), texts(300, 1)
    net = R.train([t for _, t, _ in learnt], [y for _, _, y in learnt])
    scores = R.Scorer(net).scores([t for _, t, _ in new])
    y = np.array([y for _, _, y in new])
    assert ((scores >= T.THRESHOLD) == y).mean() > 0.95
    long = " ".join(["w1 w2 w3 w4"] * 5000)
    clean, late = R.Scorer(net).scores([long, long + " vile rotten vile"])
    assert clean < T.THRESHOLD < late


def test_scores_do_not_depend_on_neighbours(monkeypatch):
    net = R.Network.fresh(2)
    some = ["a b c", "", None, "d " * 70, "e"]
    alone = [R.Scorer(net).scores([t])[0] for t in some]
    monkeypatch.setattr(R, "REMEMBERED", 2)
    assert np.allclose(R.Scorer(net).scores(some), alone, atol=1e-5)
    assert alone[1] == alone[2] == 0


def test_edges(spark, edge, empty):
    known = spark.createDataFrame([(1, 1, 1, "x"), (5, 1, 0, "x"), (6, 0, None, "x"), (None, 1, 1, "x"), (1, 0, 0, "x")], "doc_id bigint, quality int, toxic int, text string")
    got = T.toxicity(edge, known).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert T.toxicity(empty, known).collect() == []
    assert {r.predicted for r in T.toxicity(edge, known.limit(0)).collect()} == {0}


def test_held_out_rows_are_never_learnt_from(spark, monkeypatch):
    import zlib

    seen = []
    monkeypatch.setattr(T, "train", lambda texts, labels: seen.extend(texts))
    docs = documents(spark, [(i, f"text {i}", "en", "s") for i in range(200)])
    known = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id bigint, quality int, toxic int")
    T.fit(docs, known)
    assert sorted(seen) == sorted(f"text {i}" for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2)


def plain_score(net, text):
    """The highest window's probability, unit by unit and word by word in Python's own numbers."""
    v = {k: np.asarray(x, np.float64) if k not in ("word", "gram") else x for k, x in net.values.items()}
    words, units = R.tokens(text), range(R.UNITS)
    squash = lambda z: 1 / (1 + math.exp(-z))
    n, best = len(words), None
    starts = [0] if n <= 32 else sorted({*range(0, n - 32, 16), n - 32})
    for start in starts if n else []:
        rows = []
        for w in words[start : start + 32]:
            grams = [[float(c) for c in v["gram"][b]] for b in R.gram_buckets(w)]
            rows.append([float(c) for c in v["word"][R.word_bucket(w)]] + [max(g[d] for g in grams) for d in range(R.DIMENSIONS)])
        ways = []
        for way, order in ((0, rows), (1, rows[::-1])):
            h, seen = [0.0] * R.UNITS, []
            for x in order:
                own = [v["bias"][way][0][j] + sum(x[i] * v["in"][way][i][j] for i in range(len(x))) for j in range(3 * R.UNITS)]
                gate = [squash(own[j] + sum(h[i] * v["gates"][way][i][j] for i in units)) for j in range(2 * R.UNITS)]
                new = [math.tanh(own[2 * R.UNITS + j] + gate[R.UNITS + j] * sum(h[i] * v["candidate"][way][i][j] for i in units)) for j in units]
                h = [(1 - gate[j]) * h[j] + gate[j] * new[j] for j in units]
                seen.append(h)
            ways.append(seen if way == 0 else seen[::-1])
        joint = [a + b for a, b in zip(*ways)]
        looks = [sum(math.tanh(sum(s[i] * v["attend"][i][j] for i in range(2 * R.UNITS))) * v["look"][j][0] for j in units) for s in joint]
        focus = [math.exp(x) for x in looks]
        logit = v["level"][0] + sum(f / sum(focus) * s[i] * v["out"][i][0] for f, s in zip(focus, joint) for i in range(2 * R.UNITS))
        best = logit if best is None else max(best, logit)
    return 0.0 if best is None else squash(best)


def test_scores_equal_a_plain_forward_pass(spark):
    net, rng = R.Network.fresh(5), np.random.default_rng(5)
    for name in ("word", "gram", "out"):
        net.values[name] *= 8  # so that scores differ
    vocabulary = ["Grüße", "don't", "x", "42", "vile", "snarled", "snarls", "über_all", "一二三"]
    rows = [(i, " ".join(rng.choice(vocabulary, n)), "en", "s") for i, n in enumerate([1, 2, 31, 32, 33, 47, 48, 49, 64, 65, 130])]
    rows += [(50, None, "en", "s"), (51, "", "en", "s"), (52, "-- _ !", "en", "s"), (53, rows[5][1], "en", "s")]
    got = {r.doc_id: r.score for r in T.score(documents(spark, rows), net).collect()}
    want = {i: plain_score(net, text) for i, text, *_ in rows}
    assert got == pytest.approx(want, abs=1e-4)
    assert max(want.values()) - min(x for x in want.values() if x) > 0.02
