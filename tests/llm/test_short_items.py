"""Benchmark items below a window: substituted words, and whole texts."""

import random
import re

import pytest

from quoteloom.llm import decontaminate


@pytest.mark.parametrize("words", range(decontaminate.SHORTEST, decontaminate.WINDOW))
def test_short_masks_hit_every_agreement(words):
    lost = words - decontaminate.needed_of(words)
    masks = decontaminate.masks_of(words)
    assert lost >= 1 and decontaminate.hits_all(masks, words, lost)
    assert len(masks) == 1 or not decontaminate.hits_all(masks[:-1], words, lost)


def words_of(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items):
    found = {}
    for doc_id, text in docs:
        x = words_of(text)
        for item_id, item in items:
            y = words_of(item)
            if not y or item_id is None:
                continue
            if len(y) < 5:
                if x == y:
                    found[doc_id, item_id] = (len(y), 0)
                continue
            span = min(len(y), 13)
            need = -(-4 * span // 5)
            for d in range(-len(y), len(x) + 1):
                same = [0 <= j + d < len(x) and x[j + d] == y[j] for j in range(len(y))]
                for s in range(len(y) - span + 1):
                    n = sum(same[s : s + span])
                    if n >= need:
                        best, first = found.get((doc_id, item_id), (0, 1 << 30))
                        found[doc_id, item_id] = (max(best, n), min(first, s + d))
    return found


def test_short_items_against_brute_force(spark, texts):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 15)))) for k in range(40)]
    items += [(90, "two words"), (91, "Four, words; all here!"), (92, ""), (None, "two words"), (93, None)]
    docs = []
    for k in range(150):
        own = words_of(rng.choice(items)[1]) or ["x"]
        for at in rng.sample(range(len(own)), min(len(own), rng.choice([0, 1, 2, 3]))):
            own[at] = rng.choice(["sub", rng.choice(vocabulary)])
        docs.append((k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 0, 3, 9])) + own + rng.choices(vocabulary, k=rng.choice([0, 0, 4])))))
    docs += [(500, "Two words."), (501, "two words more"), (502, "four words all here"), (503, ""), (504, None), (505, "words two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1_000_000, 0):
        got = decontaminate.overlaps(texts(docs), bench, max_broadcast=limit).collect()
        assert {(r.doc_id, r.item_id): (r.matched, r.first_word) for r in got} == brute(docs, items)
    assert {(500, 90), (502, 91)} <= set(brute(docs, items))
