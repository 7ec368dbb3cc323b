import random
import time

import pytest
from millrace.operators import dictionary


@pytest.mark.parametrize("seed", range(4))
def test_all_occurrences_equal_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(dictionary, "WINDOW", 8)
    monkeypatch.setattr(dictionary, "TOGETHER", 5)
    word = lambda n: "".join(rng.choice("abé𝄞") for _ in range(n))
    terms = [word(rng.randrange(1, 7)) for _ in range(40)] + ["abab", "b"]
    texts = [word(rng.randrange(120)) for _ in range(30)] + [None, "", "x", "ab" * 40]
    a = dictionary.Automaton(terms)
    got = sorted((int(i), int(p), a.terms[t]) for i, p, t in zip(*a.scan(texts)))
    want = sorted((i, at, w) for i, t in enumerate(texts) if t for w in set(terms) for at in range(len(t)) if t.startswith(w, at))
    assert got == want


def test_tables_and_parts(spark):
    texts = [(1, "she sells hers"), (2, None), (3, "he he"), (3, "he he"), (None, "ushers")]
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "k int, t string, term string")
    terms = spark.createDataFrame([("he",), ("she",), ("hers",), ("he",), (" ",), (None,), ("zz",)], "w string")
    want = sorted((str(i), w, at) for i, t in texts if t for w in ("he", "she", "hers") for at in range(len(t)) if t.startswith(w, at))
    for part_chars in (1 << 20, 3):
        assert sorted((str(r.k), r.term, r.place) for r in dictionary.scan_dictionary(df, "t", ["k"], terms, "w", part_chars).collect()) == want
    assert dictionary.scan_dictionary(df, "t", ["k"], terms.limit(0), "w").count() == 0


def test_a_hundred_thousand_terms():
    rng = random.Random(1)
    terms = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(4, 30))) for _ in range(100_000)]
    text = "".join(rng.choice("abcdefghij") for _ in range(200_000))
    start = time.perf_counter()
    a = dictionary.Automaton(terms)
    i, place, term = a.scan([text])
    assert time.perf_counter() - start < 60
    assert len(place) and all(text.startswith(a.terms[t], p) for p, t in zip(place.tolist(), term.tolist()))
    short = {t for t in terms if len(t) == 4}
    assert sum(len(a.terms[t]) == 4 for t in term) == sum(text[k : k + 4] in short for k in range(len(text) - 3))
