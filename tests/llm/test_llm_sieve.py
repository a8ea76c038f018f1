"""Bits of whole sets: no pair that links is lost, most that do not are never fetched."""

from __future__ import annotations

import numpy as np

from snapstar.llm import jaccard


def test_pairs_that_link_pass_the_sieve_and_far_ones_do_not(spark):
    rng = np.random.default_rng(5)
    rows, links = [], {}
    for k in range(60):
        own = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
        kept = int(len(own) * (k + 40) / 100)
        other = np.unique(np.concatenate([
            own[:kept], rng.integers(0, 1 << 63, len(own) - kept).astype(np.uint64)]))
        both = len(np.intersect1d(own, other))
        links[2 * k] = both / (len(own) + len(other) - both)
        rows += [(2 * k, own.view(np.int64).tolist(), jaccard.drawn(own).tolist()),
                 (2 * k + 1, other.view(np.int64).tolist(), jaccard.drawn(other).tolist())]
    whole = spark.createDataFrame(rows, "node long, held array<long>, bits array<long>")
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(60)], "a long, b long")
    left = {r["a"] for r in jaccard.sieved(pairs, whole, 75).collect()}
    assert {a for a, share in links.items() if share >= 0.75} <= left
    assert not {a for a, share in links.items() if share < 0.6} & left
