"""Windows halved by their records, against a recursive version."""

from __future__ import annotations

import random

import pytest

from ledgerlake.operators import selection


def halves(blocks, lo, hi, most):
    n = sum(lo <= b <= hi for b in blocks)
    if n <= most or lo == hi:
        return [(lo, hi, n, n > most)]
    mid = (lo + hi) // 2
    return halves(blocks, lo, mid, most) + halves(blocks, mid + 1, hi, most)


@pytest.mark.parametrize("most", [0, 1, 3, 20])
def test_windows_are_halved_as_by_recursion(spark, most):
    rng = random.Random(most)
    rows, ranges = [], []
    for k in range(30):
        lo = rng.randrange(50)
        hi = lo + rng.choice([0, 1, 2, 6, 63, 64, 65, 1000, 10**9])
        ranges.append((k, f"a{k}", lo, hi))
        near = [rng.randrange(max(0, lo - 3), min(hi, lo + 90) + 4) for _ in range(rng.randrange(60))]
        rows += [(k, f"a{k}", b) for b in near + near[:1] * rng.randrange(30)]
    ranges += [(3, "a3", 0, 40), (90, "empty", 5, 900), (91, "none", 5, 4)]
    facts = spark.createDataFrame(rows, "chain_id bigint, address string, block bigint")
    asked = spark.createDataFrame(ranges, "chain_id bigint, address string, first bigint, last bigint")
    got = selection.halved(facts, asked.unionByName(asked), most)
    want = [(c, a, lo, hi, *w) for c, a, lo, hi in ranges if lo <= hi for w in halves([b for x, _, b in rows if x == c], lo, hi, most)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(w[-1] for w in want) > 0
    assert selection.exact_cover(got, ["chain_id", "address", "first", "last"], "first", "last").count() == 0


def test_halves_of_nothing(spark):
    facts = spark.createDataFrame([], "address string, block bigint")
    asked = spark.createDataFrame([("a", 1, 9)], "address string, first bigint, last bigint")
    assert [tuple(r) for r in selection.halved(facts, asked, 5).collect()] == [("a", 1, 9, 1, 9, 0, False)]
    assert selection.halved(facts, asked.limit(0), 5).count() == 0


def test_a_record_limit_fails_beyond_it(spark):
    rows = spark.range(10)
    assert selection.within_limit(rows, 10).count() == 10
    with pytest.raises(ValueError, match="more than 9"):
        selection.within_limit(rows, 9)
