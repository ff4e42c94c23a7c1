"""Count-level bitmaps against sums over every term of every pair."""

import random
import re
from collections import Counter, defaultdict

import pytest

from quoteloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    seen, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        n[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in n}:
        kept = sorted((t for t, d in seen[lang].items() if d >= 3), key=str.encode)
        v, groups = len(kept), {s: n[lang, s] for g, s in n if g == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + v) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s]
            over = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", over)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def table(spark, rows):
    data = [(*r, 1, "x", 0) for r in rows]
    return spark.createDataFrame(data, "lang string, source string, text string, id long, term string, n int")


@pytest.mark.parametrize("top", [5, 200])
def test_audit(spark, top):
    rng = random.Random(3)
    words = ["ab", "Ab", "ÄB", "日本", "äb", "x1y", "z-z", "😀"] + [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(100)]
    rows = []
    for k in range(240):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", "D", "é", None])
        weights = [(7 * j + len(source or "")) % 13 + (40 if j < 6 else 0) for j in range(len(words))]
        rows.append((lang, source, " ".join(rng.choices(words, weights, k=rng.randint(0, 80)))))
    rows += [("en", "silent", None), ("en", "silent", ""), ("xx", "one", "only here"), ("xx", "two", ""), rows[0], rows[0]]
    rows += [("fr", s, "mot " * 30_000) for s in ("a", "a", "b")]
    found = divergence.audit(table(spark, rows).repartition(3), top_terms=top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute(rows, top)


def test_no_rows(spark):
    assert divergence.audit(table(spark, []).limit(0)).count() == 0


def test_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    rows = [(b"alpha beta  gamma " * 3).decode()] * 4
    for data in (rows[0].encode(), b"", b"abcdefghijklmnop", b"  a"):
        assert sum(divergence._terms(data), []) == re.findall(rb"[a-z]+", data)
