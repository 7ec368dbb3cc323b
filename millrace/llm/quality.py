"""Quality rules as a short-circuit cascade.

``estimate_order`` runs every rule on a bounded sample, measuring what it costs and
which texts it rejects, and orders the rules by rejection per cost: first the
rule that rejects most of the texts for its cost, then the one that rejects most
of those that are left for the cost that it adds, and so on.  What rules ask
about a text (its words, its lines) is measured once for each such fact, and a
rule that comes after another with the same facts is charged only for the rest.
``cascade`` then applies them in that order to every whole text and stops at
the first rejection.  A text is kept if no rule rejects it, so the verdict does
not depend on the measured order; only the work done does.

Rows map one to one, with no shuffle.  Defined cases: a null text has no words
and is rejected as too short, like an empty one.  Repeated rows get equal
verdicts, other columns pass through.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORDS

SAMPLE_ROWS = 2000
SYMBOLS = "#*$%&|<>"
_LETTER = regex.compile(r"\p{L}")


class TextFacts:
    """What rules ask about one text; each fact is computed once, when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORDS.findall(self.text)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if WORDS.search(line)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a 3-word window found twice or more in the text."""
        w = self.words
        if len(w) < 4 or len(set(zip(w, w[1:], w[2:]))) == len(w) - 2:
            return 0
        windows = list(zip(w, w[1:], w[2:]))
        counts = Counter(windows)
        covered, end = 0, 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
        return covered

    @cached_property
    def n_shouted(self) -> int:
        return sum(map(str.isupper, self.words))

    @cached_property
    def n_lettered(self) -> int:
        return sum(1 for w in self.words if w.isalpha() or _LETTER.search(w))

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < 50 or 100 * self.n_repeat_words > 50 * n


@dataclass(frozen=True)
class Rule:
    """A named test that is true for texts to reject."""

    name: str
    rejects: Callable[[TextFacts], bool]
    #: Facts that the test asks for; those that others have asked for cost nothing more.
    needs: tuple[str, ...] = ()


RULES = (
    Rule("too_short", lambda t: len(t.words) < 50, ("words",)),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 50 * len(t.words), ("words", "n_repeat_words")),
    Rule("symbols", lambda t: 10 * t.n_symbols > 3 * len(t.words), ("words", "n_symbols")),
    Rule("exclamations", lambda t: 2 * t.text.count("!") > len(t.words), ("words",)),
    Rule("shouting", lambda t: 2 * t.n_shouted > len(t.words), ("words", "n_shouted")),
    Rule("few_letters", lambda t: 10 * t.n_lettered < 7 * len(t.words), ("words", "n_lettered")),
    Rule("duplicate_lines", lambda t: 2 * t.n_dup_lines > len(t.lines), ("lines", "n_dup_lines")),
)


@dataclass(frozen=True)
class Profile:
    """What a sample says: seconds spent on each rule's own test and on each fact, and texts by the set of rules that reject them."""

    own: dict[str, float]
    facts: dict[str, float]
    rejected: dict[frozenset[str], int]


def measure(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id_column: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Profile:
    """The profile of about ``sample_rows`` rows chosen by a hash of the id.

    Facts are timed in the order in which rules name them, so each is charged
    without those that it rests on; then each rule is timed with its facts at
    hand.  A row for each rule, fact and set of rules reaches the driver.
    """
    facts = list(dict.fromkeys(f for r in rules for f in r.needs))
    total = df.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = df.filter(F.pmod(F.xxhash64(id_column, F.lit("quality")), F.lit(1 << 30)) < share * (1 << 30)).limit(2 * sample_rows).select(F.col(text).cast("string").alias("text"))

    def run(frames):
        spent, sets = Counter(), Counter()
        for frame in frames:
            for value in frame["text"]:
                t, hits, shared = TextFacts(value), [], time.perf_counter()
                for f in facts:
                    getattr(t, f)
                    spent["fact", f] += (now := time.perf_counter()) - shared
                    shared = now
                for rule in rules:
                    own = t if rule.needs else TextFacts(value)
                    start = time.perf_counter()
                    if rule.rejects(own):
                        hits.append(rule.name)
                    spent["rule", rule.name] += time.perf_counter() - start
                sets["set", "\n".join(hits)] += 1
        rows = [(*k, v) for c in (spent, sets) for k, v in c.items()]
        yield pd.DataFrame(rows, columns=["kind", "name", "value"])

    found = {(r[0], r[1]): r[2] for r in sample.mapInPandas(run, "kind string, name string, value double").groupBy("kind", "name").agg(F.sum("value")).collect()}
    of = lambda kind: {n: v for (k, n), v in found.items() if k == kind}
    return Profile(of("rule"), of("fact"), {frozenset(n.split("\n")) if n else frozenset(): int(v) for n, v in of("set").items()})


def order_rules(rules: tuple[Rule, ...], profile: Profile) -> tuple[Rule, ...]:
    """Greedy: of the texts that are left, the most rejected for the cost that a rule adds.

    Where that ties, as among rules that reject none of what is left, rejection
    of all texts per cost decides, then the cost.
    """
    left, ordered, known = list(rules), [], set()

    def key(rule: Rule) -> tuple[float, float, float]:
        hits = lambda sets: sum(n for s, n in sets if rule.name in s)
        gone = {r.name for r in ordered}
        added = max(profile.own.get(rule.name, 0.0) + sum(profile.facts.get(f, 0.0) for f in rule.needs if f not in known), 1e-9)
        alone = max(profile.own.get(rule.name, 0.0) + sum(profile.facts.get(f, 0.0) for f in rule.needs), 1e-9)
        return hits((s, n) for s, n in profile.rejected.items() if not s & gone) / added, hits(profile.rejected.items()) / alone, -added

    while left:
        best = max(left, key=key)
        left.remove(best)
        ordered.append(best)
        known.update(best.needs)
    return tuple(ordered)


def estimate_order(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id_column: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules in the order that a sample calls for."""
    return order_rules(rules, measure(df, rules, text, id_column, sample_rows))


def first_rejection(facts: TextFacts, ordered: tuple[Rule, ...]) -> str | None:
    return next((rule.name for rule in ordered if rule.rejects(facts)), None)


def kept_column(text: str, ordered: tuple[Rule, ...]) -> Column:
    """True where no rule rejects the text."""

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series([first_rejection(TextFacts(t), ordered) is None for t in texts], dtype=bool)

    return kept(F.col(text).cast("string"))


def filter_quality(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that pass the cascade, with all their columns."""
    return df.filter(kept_column(text, estimate_order(df, rules, text, id_column)))


def quality_report(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: the base measures of the whole text and the cascade's verdict."""
    ordered = estimate_order(df, rules, text, id_column)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")
    def report(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            t = TextFacts(value)
            kept = first_rejection(t, ordered) is None
            rows.append((len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.base_failed, kept and not t.base_failed))
        return pd.DataFrame(rows, columns=names)

    return df.select(id_column, report(F.col(text).cast("string")).alias("r")).select(id_column, *(F.col(f"r.{n}") for n in names))


REPORT_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), pos AS (
  SELECT doc_id, u.i AS i, ws[u.i] AS a, ws[u.i + 1] AS b, ws[u.i + 2] AS c FROM w, unnest(range(1, len(ws) - 1)) AS u(i)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM pos) WHERE n > 1
  ) GROUP BY doc_id
), f AS (
  SELECT w.doc_id, w.text, len(ws)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks,
    len(list_filter(ws, lambda x: x = upper(x) AND x <> lower(x))) AS n_shouted,
    len(list_filter(ws, lambda x: regexp_matches(x, '\pL'))) AS n_lettered
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id
), g AS (
  SELECT *, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_marks > n_words OR 2 * n_shouted > n_words OR 10 * n_lettered < 7 * n_words OR 2 * n_dup_lines > len(ls)) AS kept
FROM g
"""
