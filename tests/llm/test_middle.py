"""Fill-in-the-middle against the plain way: decode everything, cut by code point."""

import random
from hashlib import sha256

from pyspark.sql import functions as F

from quoteloom.llm import middle

PIECES = ["word ", "日本 ", "é", "😀", "<", "<P", "P>", "<S", "x<M", "longer passage of words, ", "\n"]


def plainly(doc_id, text):
    text, n = text or "", len(text or "")
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:i], text[i:j], text[j:]
    spm = h[3] % 100 < 20
    return doc_id, n, "spm" if spm else "psm", i, j - i, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def some_text(rng, parts):
    return "".join(rng.choice(PIECES) for _ in range(parts))


def test_fill_in_middle(spark, texts):
    rng = random.Random(11)
    shared = some_text(rng, 4000)
    rows = [(None, "no id"), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "w" * 50_000), (5, "日" * 9000), (6, "a" * 8191 + "<P>" + "b" * 900)]
    rows += [(10 + k, some_text(rng, rng.randint(0, 60))) for k in range(120)]
    rows += [(200 + k, some_text(rng, k) + shared.replace(">", "") + some_text(rng, 40 - k).replace(">", "")) for k in range(40)]
    found = middle.fill_in_middle(texts(rows).repartition(3))
    out = found.withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r[:6]) for r in out), key=order) == sorted((plainly(*r) for r in rows), key=order)
    assert sorted(r.back for r in out) == sorted(t or "" for _, t in rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chunks_follow_content():
    rng = random.Random(5)
    shared = bytes(rng.choices(b"abcdefgh ", k=200_000))
    memo = middle.Memo()
    for lead in (b"", b"x", b"some other beginning " * 40):
        data = lead + shared
        edges = middle.chunk_edges(data)
        sizes = [b - a for a, b in zip(edges, edges[1:])]
        assert edges[0] == 0 and edges[-1] == len(data)
        assert all(middle.SMALLEST <= s <= middle.LARGEST for s in sizes[:-1])
        middle.Cutter(data, memo)
    assert memo.found > 0.6 * memo.asked  # two of three copies come from the cache


def test_chunks_across_stretches(monkeypatch):
    data = "".join(random.Random(6).choices("aé日😀 ", k=30_000)).encode()
    whole = middle.chunk_edges(data)
    monkeypatch.setattr(middle, "STRETCH", 1000)
    assert middle.chunk_edges(data) == whole
    for a, b in zip(whole, whole[1:]):
        data[a:b].decode()


def test_marker_between_chunks():
    memo = middle.Memo()
    data = bytes(random.Random(7).choices(b"abcdefgh ", k=60_000))
    for cut in middle.chunk_edges(data)[1:-1]:
        for inside in (1, 2):
            marked = data[: cut - inside] + b"<S>" + data[cut - inside + 3 :]
            assert middle.Cutter(marked, memo).marked
    assert not middle.Cutter(data, memo).marked


def test_memo_stays_small():
    memo = middle.Memo(limit=10_000)
    for k in range(500):
        memo.summary(str(k).encode() * 100)
    held = [sum(len(c) for c in generation) for generation in (memo.young, memo.old)]
    assert max(held) <= 10_000
