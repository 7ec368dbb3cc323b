from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.llm import quality
from millrace.llm.common import WORDS


def brute(text):
    w = WORDS.findall(text or "")
    windows = list(zip(w, w[1:], w[2:]))
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\t\xa0É", max_size=80))
def test_facts_equal_brute_force(text):
    t = quality.TextFacts(text)
    assert (len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.base_failed) == brute(text)


def test_report_and_filter(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    rows = [(1, good), (2, None), (3, ""), (4, "spam " * 200), (5, good.upper()), (6, " ".join(w + "###" for w in good.split())), (7, good), (7, good)]
    df = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, kept string")
    out = quality.quality_report(df).collect()
    assert sorted((r.doc_id, r.kept) for r in out) == [(1, True), (2, False), (3, False), (4, False), (5, False), (6, False), (7, True), (7, True)]
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(dict(rows)[r.doc_id])
    kept = quality.filter_quality(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 7, 7]
    empty = df.limit(0)
    assert quality.quality_report(empty).count() == 0 and quality.filter_quality(empty).count() == 0


def test_order_is_by_rejection_per_cost(spark):
    import time

    slow = quality.Rule("slow", lambda t: time.sleep(0.002) or True)
    quick = quality.Rule("quick", lambda t: True)
    never = quality.Rule("never", lambda t: False)
    df = spark.createDataFrame([(i, "x") for i in range(50)], "doc_id long, text string")
    assert [r.name for r in quality.estimate_order(df, (never, slow, quick))] == ["quick", "slow", "never"]


def test_order_changes_with_shared_costs_and_with_what_is_left():
    rule = lambda name, *needs: quality.Rule(name, lambda t: False, needs)
    names = lambda rules, profile: [r.name for r in quality.order_rules(rules, profile)]
    a, b, c = rule("a", "words"), rule("b", "words"), rule("c", "lines")
    own, sets = dict.fromkeys("abc", 0.1), {frozenset("a"): 50, frozenset("b"): 30, frozenset("c"): 40, frozenset(): 9}
    # alone c has the better rate than b; after a has paid for the words, b is almost free
    assert names((c, b, a), quality.Profile(own, {"words": 1.0, "lines": 1.0}, sets)) == ["a", "b", "c"]
    assert names((c, b, a), quality.Profile(own, {"words": 0.0, "lines": 0.0}, sets)) == ["a", "c", "b"]
    # b rejects what a has rejected, but for one text
    again = {frozenset("a"): 20, frozenset("ab"): 30, frozenset("b"): 1, frozenset("c"): 5}
    assert names((c, b, a), quality.Profile(own, {"words": 1.0, "lines": 0.0}, again))[0] == "c"
    assert names((c, b, a), quality.Profile(own, {"words": 0.0, "lines": 0.0}, again)) == ["a", "c", "b"]
