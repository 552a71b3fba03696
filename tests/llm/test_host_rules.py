"""Host rules against plain counting."""

import random
import re
from collections import Counter

from corpus_rows import EDGE, documents

from wattline.llm import host_rules as H


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(grams)
    hit = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(lines)


def test_measures():
    rng = random.Random(2)
    texts = [None, "", " \n\x0b ", "a b\na b\n\n \na b", "é<> ü|\r\nx", " w  " * 9, "a b c d e f g h " * 2]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (7, 8, 9, 40, 200)]
    texts += ["\n".join(rng.choice(["x y", "z", "", " "]) for _ in range(30))]
    texts += [" ".join(map(str, range(50))) + " " + " ".join(map(str, range(40, 60)))]
    for text in texts:
        assert H.measures_of(text) == brute(text), text


def test_edges(spark, edge, empty):
    got = H.host_rules(edge).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) for r in got))) == sorted(
        str((i, *brute(t))) for i, t, _, _ in EDGE
    )
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert H.host_rules(empty).collect() == []


def test_a_bad_host_is_dropped_and_a_small_one_shrunk(spark):
    clean = lambda i: " ".join(f"word{i}x{j}" for j in range(30))
    rows = [(i, clean(i), "en", f"h{i % 10}") for i in range(400)]
    rows += [(1000 + i, "bad bad", "en", "spam") for i in range(150)] + [(1200, clean(1200), "en", "spam")]
    rows += [(1300, "too short", "en", "tiny"), (1301, clean(1301), "en", "tiny")]
    got = {r.doc_id: r for r in H.host_rules(documents(spark, rows)).collect()}
    assert not got[1200].kept and not got[1200].base_failed and got[1200].host_failed
    assert got[1301].kept and not got[1300].kept and got[1300].failed_rules == ["short"]
    assert all(got[i].kept for i in range(400))
    rates = {r.host: r for r in H.host_rates(H.measures(documents(spark, rows))).collect()}
    assert rates["spam"].short_rate > 0.9 and 0.05 < rates["tiny"].short_rate < 0.5 and rates["h1"].short_rate < 0.05
