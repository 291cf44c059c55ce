"""The candidate search of the similarity joins: what it leaves to the exact step, and what it repeats."""

import numpy as np

from scorewright.llm import candidates, ngram_join


def test_long_unrelated_sets_are_told_apart():
    rng = np.random.default_rng(5)
    for size in (2_000, 5_000, 9_000, 20_000):
        for percent in (80, 85):
            one, other = (np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64)) for _ in range(2))
            near = np.unique(np.concatenate((one[size // 20:], other[:size // 20])))     # a linked pair stays possible
            sets = [one, other, near]
            bits = [ngram_join.parity_bits(h, ngram_join.most_bits(len(h), percent)) for h in sets]
            possible = ngram_join.bitmap_test([len(h) for h in sets], bits, percent)
            assert not possible(0, 1) and possible(0, 2)


def test_tiles_of_the_same_items_are_made_once(spark):
    # 1 and 2 share three keys, 3 shares keys with them but has another size, 100 ... 139 share one key
    many = range(100, 140)
    rows = [(1, 100, [7, 8, 9]), (2, 100, [7, 8, 9]), (3, 10, [8, 9]), *((i, 50, [5]) for i in many)]
    sig = spark.createDataFrame([(n, s, n, p, b"") for n, s, p in rows], candidates.SIGNATURE)
    shared = candidates.shared_keys(spark, sig, ngram_join.near_sizes(85))
    tiles: dict = {}
    for unit, node in candidates.tile_members(shared).collect():
        tiles.setdefault(unit, []).append(node)
    assert sorted(map(sorted, tiles.values())) == [[1, 2], list(many)]
