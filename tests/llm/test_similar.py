"""The near-duplicate stage of the pipeline finds its pairs by fingerprints."""

import itertools
import random

import numpy as np
import pytest

from quoteloom.llm import simhash

from .test_texts import edited, shingles


def test_fingerprints_find_the_pairs(spark, texts):
    """Whatever similarity is asked for, pairs whose fingerprints are near meet; groups of
    equal ranges in the sketches, made for 0.8, miss a fifth of these."""
    rng, rows, want = random.Random(31), [], {}
    for g in range(40):
        pair = edited(rng, 250, rng.choice([22, 24, 26, 28]))
        a, b = map(shingles, pair)
        rows += [(2 * g, pair[0]), (2 * g + 1, pair[1])]
        want[2 * g + 1] = 2 * g if len(a & b) >= 0.4 * len(a | b) else 2 * g + 1
    assert sum(k != v for k, v in want.items()) > 20
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(texts(rows).repartition(3), similarity=0.4, radius=40).collect()}
    assert {k: got[k] for k in want} == want


def hashes_of(words):
    return simhash.shingle_set(list(simhash.shingle_digests(" ".join(words), simhash.SIMILAR_WORDS)))


def far_fingerprints():
    """Two texts of similarity 0.8 of which one goes on with words that turn many bits."""
    rng = random.Random(5)

    def votes(words):
        bits = np.unpackbits(hashes_of(words).astype(">u8").view("u1").reshape(-1, 8), axis=1)
        return 2 * bits.sum(axis=0).astype(int) - len(bits)

    one = [f"w{rng.randrange(10**6)}" for _ in range(24)]
    other, ones = one, votes(one) > 0
    for _ in range(5):
        tried = [[*other, f"x{rng.randrange(10**6)}"] for _ in range(500)]
        turned = [np.where(ones, -v, v - 1) for v in map(votes, tried)]
        other = tried[int(np.argmax([(t >= 0).sum() + np.tanh((t + 0.5) / 2.5).sum() for t in turned]))]
    fps = [np.uint64(simhash.portrait(" ".join(w), simhash.SIMILAR_WORDS)[1] % 2**64) for w in (one, other)]
    assert np.bitwise_count(fps[0] ^ fps[1]) > simhash.SIMILAR_RADIUS and len(hashes_of(one)) > simhash.SMALL
    return one, other


def far_sketches():
    """Two texts of similarity 0.8 of which one goes on with words whose shingles come first in
    as many ranges of its sketch."""
    rng = random.Random(6)

    def sketch(words):
        return np.frombuffer(simhash.portrait(" ".join(words), simhash.SIMILAR_WORDS)[3], "<u4")

    one = [f"w{rng.randrange(10**6)}" for _ in range(204)]
    other, first = one, sketch(one)
    for _ in range(50):
        tried = [[*other, f"x{rng.randrange(10**6)}"] for _ in range(20)]
        other = min(tried, key=lambda w: simhash.resemblance(first, sketch(w)[None, :])[0])
    assert simhash.resemblance(first, sketch(other)[None, :])[0] < simhash.SIMILARITY - simhash.MARGIN
    return one, other


@pytest.mark.parametrize("pair", [far_fingerprints, far_sketches])
def test_no_similar_pair_is_lost(spark, texts, pair):
    """Similar texts link however far apart their fingerprints lie or their sketches look."""
    one, other = pair()
    assert simhash.jaccard(hashes_of(one), hashes_of(other)) >= simhash.SIMILARITY
    rng = random.Random(7)
    rows = [(1, " ".join(one)), (2, " ".join(other)), (3, " ".join(one[:-5] + other[-3:])), (4, edited(rng, 60, 0)[0])]
    want, sets = {k: k for k, _ in rows}, {k: hashes_of(t.split()) for k, t in rows}
    for (a, x), (b, y) in itertools.combinations(sets.items(), 2):
        if simhash.jaccard(x, y) >= simhash.SIMILARITY:
            want = {k: want[a] if v == want[b] else v for k, v in want.items()}
    assert want[2] == 1 and want[4] == 4
    assert {r.doc_id: r.component_id for r in simhash.similar_documents(texts(rows).repartition(2)).collect()} == want


@pytest.mark.parametrize("long", [64, 3])
def test_rare_shingles_alone_find_all_pairs(spark, texts, monkeypatch, long):
    """With a radius of 0 the fingerprints find next to nothing; the links are those of all pairs."""
    monkeypatch.setattr(simhash, "LONG", long)
    monkeypatch.setattr(simhash, "SMALL", 0)
    rng, rows = random.Random(32), []
    for n in [4, 5, 8, 9, 12, 20, 40, 120] * 8:
        words = edited(rng, n, 0)[0].split()
        rows += [" ".join(words), " ".join(words[:-1]), " ".join([*words, "y"]), " ".join(words)]
    line, base = edited(rng, 12, 0)[0], edited(rng, 200, 0)[0].split()
    rows += [f"{line} {edited(rng, rng.choice([3, 30]), 0)[0]} {line}" for _ in range(60)]
    for _ in range(80):  # around one text, as near as 0.75 and 0.9
        other = base.copy()
        for k in rng.sample(range(200), rng.choice([1, 2, 4, 5])):
            other[k] = f"z{rng.randrange(10**6)}"
        rows.append(" ".join(other))
    sets, root = [shingles(r) for r in rows], list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    got = simhash.similar_documents(texts(list(enumerate(rows))).repartition(3), radius=0).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))


def test_similar_sets_share_a_rare_hash():
    """Whatever the levels; and spreads never rule a similar pair out."""
    rng = np.random.default_rng(9)
    for trial in range(3000):
        similarity = rng.choice([0.4, 0.8, 0.9])
        levels = rng.integers(0, 3, 1 << simhash.TALLY_BITS, np.uint8) if trial % 300 == 0 else levels
        n = int(rng.integers(1, 400))
        shared = int(np.ceil(similarity * n - 1e-6))
        pool = rng.integers(0, 1 << 64, 2 * n, np.uint64)
        own = (n - shared) // 2  # one set holds the other, or both have hashes of their own
        one, other = (pool[:n], pool[:shared]) if trial % 2 else (pool[: shared + own], np.concatenate([pool[:shared], pool[n : n + own]]))
        small, large = sorted((np.sort(one), np.sort(other)), key=len)
        assert simhash.jaccard(small, large) >= similarity - 1e-9
        common = np.intersect1d(*(simhash.rare_prefix(x, levels, similarity) for x in (small, large)))
        need = simhash.common_prefix(np.array([len(small)]), np.array([len(large)]), similarity)[0]
        assert len(common) >= need >= 1
        counts = [simhash.spread(x)[None, :] for x in (small, large)]
        assert simhash._within(*counts, np.array([len(small)]), np.array([len(large)]), similarity)[0].all()
