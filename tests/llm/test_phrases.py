import random
import re
from collections import Counter

from millrace.llm import phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, top, longest=4):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = []
    frequent = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    drop = {(lang, w[i : i + s]) for (lang, w), b in frequent.items() for s in range(2, len(w)) for i in range(len(w) - s + 1) if 100 * b >= 80 * f[lang, w[i : i + s]]}
    for (lang, w), a in frequent.items():
        if (lang, w) not in drop:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.append((lang, score, a, " ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out, key=lambda r: (r[0], -r[1], -r[2], r[3].encode())):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase, a, left, right, n[lang], score))
    return sorted(ranked)


def texts(seed, many=400):
    rng = random.Random(seed)
    words = ["The", "of", "a", "New", "york", "city", "é", "É", " x", "z z"]
    made = []
    for _ in range(many):
        made.append(("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "?"]) for _ in range(rng.randrange(30))), rng.choice(["en", "en", "en", "fr", None, "und"])))
    return made + [(None, "en"), ("", "en"), ("...", None), ("New York City", "de")] + [("same words here again", "fr")] * 40 + [("long " * 5000, "es")]


def test_equals_brute_force(spark, monkeypatch):
    for seed, block in ((1, 1 << 20), (2, 50)):
        monkeypatch.setattr(phrases, "BLOCK_TOKENS", block)
        rows = texts(seed)
        df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, a int, words string").repartition(5)
        for least, top in ((5, 2000), (30, 7)):
            got = sorted(tuple(r) for r in phrases.collocations(df, least=least, top=top).collect())
            assert got == brute(rows, least, top) and got


def test_empty_and_rare(spark):
    df = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(df, least=1, top=9).count() == len(brute([("a b c", "en")], 1, 9)) == 1


def test_scores_past_64_bits(spark):
    big = 3_000_000_000_000_000_000
    df = spark.createDataFrame([([2 * big, big], [2 * big, big])], "prefixes array<long>, suffixes array<long>")
    assert tuple(df.select(phrases._weakest_cut(2).alias("c")).select("c.score", "c.l").first()) == (500_000, 2 * big)


def test_pairs_of_a_block_travel_as_one_message_for_each_range(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(phrases, "RANGE_TOKENS", 1000)
    rows = texts(3, 800)
    seen, write = {}, phrases.written
    monkeypatch.setattr(phrases, "written", lambda df, label: seen.setdefault(label, write(df, label)))
    df = spark.createDataFrame(rows, "text string, lang string").repartition(9)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=5, top=2000).collect())
    assert got == brute(rows, 5, 2000) and got
    counted = seen["phrases-counted-2"]
    blocks, ranges = seen["phrases-relation-1"].count(), counted.filter("block < 0").count()
    assert ranges > 2 and counted.filter("block >= 0").count() <= blocks * ranges
    assert counted.filter("block >= 0").groupBy("block", "range").count().filter("count > 1").count() == 0
