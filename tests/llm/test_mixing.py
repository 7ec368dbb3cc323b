import random
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.llm import mixing


def off(shares, owners):
    """The largest deviation from the weights after any number of slots, in blocks."""
    total, done, worst = sum(shares), [0] * len(shares), 0
    for t, i in enumerate(owners, 1):
        done[i] += 1
        worst = max(worst, max(abs(n * total - a * t) for n, a in zip(done, shares)))
    return Fraction(worst, total)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.floats(0.01, 100), min_size=1, max_size=20), st.integers(3, 90))
def test_schedule_is_never_a_block_off(weights, size):
    shares = mixing.exact_shares(weights)
    exact = [Fraction(repr(w)) for w in weights]
    assert [Fraction(a, sum(shares)) for a in shares] == [w / sum(exact) for w in exact]
    schedule = mixing.Schedule(shares)
    found = [x for j in range(8) for x in schedule.segment(j * size, (j + 1) * size, j == 7)]
    assert off(shares, [i for i, _ in found]) < 1
    for i in range(len(shares)):
        assert [k for j, k in found if j == i] == list(range(sum(j == i for j, _ in found)))


@pytest.mark.parametrize("weights", [[0.7, 0.2, 0.1], [Fraction(1, 3)] * 3, [0.9, 0.05, 0.03, 0.02], [1.0, 2**0.5, 3**0.5, 1e-3]])
def test_true_weights_over_100_000_slots(weights):
    schedule = mixing.Schedule(mixing.exact_shares(weights))
    owners = [i for j in range(25) for i, _ in schedule.segment(4096 * j, 4096 * (j + 1), j == 24)]
    assert len(owners) > 100_000
    total, done, weights = sum(map(Fraction, weights)), [0] * len(weights), list(map(Fraction, weights))
    limits = [float(w / total) for w in weights]
    for t, i in enumerate(owners, 1):
        done[i] += 1
        # the floats are the given weights to within 1e-16, so 1e-11 here
        assert all(abs(n - w * t) < 1 + 1e-9 for n, w in zip(done, limits))
    assert off(schedule.shares, owners) < 1


def test_block_slots_are_those_of_one_sequential_run(spark):
    shares, blocks = [5, 3, 2], [400, 700, 30]
    got = sorted(tuple(r) for r in mixing.block_slots(spark, shares, blocks, 10_000).collect())
    schedule = mixing.Schedule(shares)
    want = [(i, k, t) for t, (i, k) in enumerate(schedule.run(0, [0, 0, 0], 2334)) if k < blocks[i]]
    assert got == sorted(want) and len(got) == sum(blocks)
    cut = mixing.block_slots(spark, shares, blocks, 7).collect()
    assert len({r.slot for r in cut}) == len({(r.key, r.block) for r in cut}) == len(cut) == sum(blocks)
    assert all(r.block * 10 // shares[r.key] <= r.slot < -(-(r.block + 1) * 10 // shares[r.key]) for r in cut)


def test_mix_places_every_row_once(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "a", "a", "b", "c", None]), "t") for i in range(3000)] + [(5, "a", "t")] * 3
    df = spark.createDataFrame(rows, "doc_id long, source string, key string")
    out = mixing.mix(df, {"a": 0.5, "b": 0.25, "c": 0.125}, block_rows=10, bucket_rows=100, segment_slots=16)
    got = out.collect()
    assert Counter((r.doc_id, r.source, r.key) for r in got) == Counter(rows)
    left = [r for r in got if r.source is None]
    assert left and all(r.mix_slot is r.mix_place is r.mix_block is None for r in left)
    got = [r for r in got if r.source is not None]
    assert len({(r.mix_slot, r.mix_place) for r in got}) == len(got)
    by_slot = {}
    for r in got:
        assert by_slot.setdefault(r.mix_slot, (r.source, r.mix_block)) == (r.source, r.mix_block)
    # until the first source runs out, each has its share to within a block
    shares = dict(zip("abc", [Fraction(4, 7), Fraction(2, 7), Fraction(1, 7)]))
    n, done = Counter(s for _, s, _ in rows), Counter()
    for slot in range(max(by_slot) + 1):
        if slot not in by_slot:
            break
        done[by_slot[slot][0]] += 1
        assert all(abs(done[s] - a * (slot + 1)) < 1 for s, a in shares.items())
    assert slot >= min(n[s] // 10 / a for s, a in shares.items()) - 8
    place = {(r.doc_id, r.source): (r.mix_slot, r.mix_place) for r in got if r.doc_id != 5}
    in_order = mixing.in_mixed_order(out).collect()
    assert all(r.source is None for r in in_order[-len(left) :])
    ordered = [place[r.doc_id, r.source] for r in in_order[: -len(left)] if r.doc_id != 5]
    assert ordered == sorted(ordered)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mix(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(spark.createDataFrame([(1, "a")], "doc_id long, source string"), {"b": 1.0})
    for bad in (-1.0, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing.mix(spark.createDataFrame([(1, "a")], "doc_id long, source string"), {"a": bad})
    one = mixing.mix(spark.createDataFrame([(None, None)], "doc_id long, source string")).collect()
    assert [(r.mix_block, r.mix_slot, r.mix_place) for r in one] == [(0, 0, 0)]
    odd = spark.createDataFrame([(1, "a", 7, 8, 9)], "doc_id long, source string, mix_slot int, rank int, name int")
    mixed = mixing.mix(odd)
    assert mixed.columns == ["doc_id", "source", "mix_slot", "rank", "name", "mix_block", "mix_slot_", "mix_place"]
    assert tuple(mixing.in_mixed_order(mixed).first()) == (1, "a", 7, 8, 9)


def test_the_last_source_goes_on_alone(spark):
    shares, blocks = [999, 1, 500], [3000, 40, 1200]
    schedule = mixing.Schedule(shares)
    got = sorted((r.slot, r.key, r.block) for r in mixing.block_slots(spark, shares, blocks, 300).collect())
    assert len(got) == len({s for s, _, _ in got}) == sum(blocks)
    assert [k for _, i, k in got if i == 1] == list(range(40))
    total = sum(shares)
    for slot, i, k in got:
        assert k * total // shares[i] <= slot < -(-(k + 1) * total // shares[i])
    others = max(s for s, i, _ in got if i != 1)
    assert [k for s, i, k in got if s > others] and others <= max(schedule.deadline(i, blocks[i] - 1) for i in (0, 2))


def test_tiny_weights(spark):
    with pytest.raises(ValueError, match="weight is below"):
        mixing.block_slots(spark, [10**9, 1], [5, 5])
    # all that is left of one source takes no run over its slots
    assert mixing.block_slots(spark, [100_000, 1], [3, 4000]).count() == 4003
