"""Operators on texts: brute force, round trips, and odd tables."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quoteloom.llm import attribution, chat, decontaminate, licenses, packing, quality, sharding, shards, simhash, tokens
from quoteloom.llm.common import shared_path

ODD = [(None, "one two three"), (1, None), (2, ""), (3, "same text here"), (3, "same text here"), (4, "Ünï 日本 😀 \xa0 x"), (5, "w " * 30_000)]


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def encode(text):
    return tokens.encoder(tokens.default_path()).tokenizer.encode(text or "", add_special_tokens=False)


def test_encoder_equals_tokenizers():
    coder, rng = tokens.encoder(tokens.default_path()), random.Random(3)
    alphabet = " \n\t\r'sabté1 2😀.,!-_日本\x00<|endoftext|>‍\xa0 re'll"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(coder.ids(text), coder.dtype).tolist() == encode(text).ids
        assert list(zip(*(x.tolist() for x in coder.spans(text)))) == encode(text).offsets


def test_packing_round_trip(spark, texts):
    rows = ODD + [(10 + k, "word " * k) for k in range(60)]
    pieces = packing.pack(texts(rows).repartition(3), tokens.default_path(), window=64).toPandas()
    used = pieces.groupby("sequence_id").length.sum()
    assert sorted(used.index) == list(range(len(used))) and (used.iloc[:-1] == 64).all()
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]]
    have = sorted((tuple(np.frombuffer(b"".join(g.sort_values("start").ids), "<u4")) for _, g in pieces[pieces.doc_id >= 4].groupby("doc_id")))
    assert have == sorted(tuple(encode(t).ids + [0]) for i, t in rows if i is not None and i >= 4)
    assert pieces[pieces.start == 0].shape[0] == len(rows)
    whole = packing.sequences(packing.pack(texts(rows), tokens.default_path(), window=64), 64).toPandas()
    assert all(len(x) == 64 for x in whole.input_ids) and whole.tokens.sum() == used.sum()
    assert packing.pack(empty(spark), tokens.default_path()).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    at = shards.slots(np.arange(n), n, 99)
    assert sorted(at) == list(range(n)) and (shards.sequences_at(at, n, 99) == np.arange(n)).all()
    assert n < 64 or (at != shards.slots(np.arange(n), n, 98)).any()


def test_shards_round_trip_and_resume(spark, texts):
    docs = texts([(k, f"document {k} " * (k % 50)) for k in range(300)])
    pieces = packing.pack(docs, tokens.default_path(), window=32).cache()
    whole = {r.sequence_id: r.input_ids for r in packing.sequences(pieces, 32).collect()}
    n, folder = len(whole), shared_path(spark, "shards-test")
    folder = folder if ":" in folder else f"file://{folder}"
    manifest = shards.write_shards(pieces, n, folder, 5, per_shard=16, window=32).collect()
    assert sum(m.sequences for m in manifest) == n and {m.sequences for m in manifest[:-1]} <= {16, n % 16 or 16}
    records = shards.read_records(spark, folder, n, 5, per_shard=16, window=32).collect()
    assert sorted(r.slot for r in records) == list(range(n))
    for r in records:
        assert r.crc32 == zlib.crc32(np.array(whole[r.sequence_id], "<u2").tobytes())
        assert r.byte_offset == r.slot % 16 * 64 and r.slot == shards.slots([r.sequence_id], n, 5)[0]
    rest = shards.read_records(spark, folder, n, 5, from_slot=20, per_shard=16, window=32).collect()
    assert sorted(r.slot for r in rest) == list(range(20, n))
    again = shards.write_shards(pieces, n, folder, 5, per_shard=16, window=32).collect()
    assert sorted(again) == sorted(manifest)


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution(spark, texts, rule):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("ab cdé 日\n.😀x") for _ in range(rng.randint(0, 60)))) for k in range(80)]
    cuts = {k: sorted(rng.sample(range(len(t) + 1), min(3, len(t)))) for k, t in rows}
    edges = {k: list(zip([0, *c], [*c, len(t)])) for (k, t), c in zip(rows, cuts.values())}
    data = [(k, t, [("s", a, b) for a, b in edges[k]]) for k, t in rows] + [(900, None, [("s", 0, 0)]), (901, "abc", None), (None, "a b", [("s", 0, 3)])]
    docs = spark.createDataFrame(data, "doc_id long, text string, sections array<struct<name:string,start:long,end:long>>")
    found = attribution.attribute(docs, F.col("text"), F.col("sections"), tokens.default_path(), rule).collect()
    have = {(r.doc_id, r.section): r.tokens for r in found}
    for k, t in rows:
        want = [0.0] * len(edges[k])
        for a, b in encode(t).offsets:
            share = [max(0, min(b, y) - max(a, x)) for x, y in edges[k]]
            if rule == "split":
                want = [w + s / (b - a) for w, s in zip(want, share)]
            elif rule == "most":
                want[share.index(max(share))] += 1
            else:
                want[next(i for i, (x, y) in enumerate(edges[k]) if x <= a < y)] += 1
        assert np.allclose([have[k, s] for s in range(len(want))], want), (k, t)
    assert have[900, 0] == 0 and (901, 0) not in have and have[None, 0] == 2


def test_masks_hit_every_window():
    """Two substitutions anywhere in 13 words leave a placement that sees neither."""
    for lost in itertools.combinations(range(decontaminate.WINDOW), decontaminate.WINDOW - decontaminate.NEEDED):
        assert any(
            all(m[k] == "0" or at + k not in lost for k in range(len(m)))
            for m in decontaminate.MASKS
            for at in range(decontaminate.WINDOW - len(m) + 1)
        )


def test_overlaps(spark, texts):
    item = [f"i{k}" for k in range(20)]
    two = item.copy()
    two[4], two[9] = "xx", "yy"
    three = item[:13]
    three[2], three[6], three[10] = "p", "q", "r"
    docs = [(1, "a b " + " ".join(item)), (2, " ".join(two).upper()), (3, " ".join(three)), (4, "no match"), (5, None), (6, "u five words stand here! v"), (None, " ".join(item)), (7, " ".join(item)), (7, " ".join(item)), (8, "z " * 20_000 + " ".join(item))]
    items = [(0, " ".join(item)), (1, "Five words, stand here"), (2, "five words stand here v"), (3, None), (4, ""), (None, " ".join(item)), (5, "u five words stand here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1_000_000, 0):
        found = decontaminate.overlaps(texts(docs), bench, max_broadcast=limit).collect()
        got = {(r.doc_id, r.item_id): (r.matched, r.first_word) for r in found}
        assert got == {(1, 0): (13, 2), (2, 0): (12, 0), (None, 0): (13, 0), (7, 0): (13, 0), (8, 0): (13, 20_000), (6, 2): (5, 1), (6, 5): (5, 0)}
    left = decontaminate.decontaminated(texts(docs), bench)
    assert sorted(str(r.doc_id) for r in left.collect()) == ["3", "4", "5", "None"] and "fp" in left.columns
    assert decontaminate.overlaps(empty(spark), bench).count() == 0
    assert decontaminate.overlaps(texts(docs), bench.limit(0)).count() == 0


def test_overlaps_plan_is_native(spark, texts):
    docs, bench = texts(ODD), spark.createDataFrame([(0, "a b c d e f g h i j k l m n")], "item_id long, text string")
    plan = decontaminate.overlaps(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    parts = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("aB cÉ\x1c\x85 \t\nd\x0b") for _ in range(rng.randint(0, 40)))
        assert simhash.fingerprint(text) % (1 << 64) == slow_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint("  \n") == 0


def test_near_duplicates_against_all_pairs(spark, texts):
    """Chains and dense groups of fingerprints through small leaves and chunks."""
    rng = random.Random(8)
    values = [rng.getrandbits(64) for _ in range(250)]
    for k in range(40):
        chain = values[k]
        for _ in range(6):
            chain ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.append(chain)
    values += [values[0] ^ (1 << a) for a in range(64)]
    signed = np.unique(np.array(values, np.uint64)).view(np.int64)
    distinct = spark.createDataFrame([(int(v),) for v in signed], "fp long").repartition(3)
    links = simhash.links(distinct, leaf_rows=32, max_sample=200)
    roots = dict(simhash.connected(links).collect())
    parent = {int(v): int(v) for v in signed}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(map(int, signed), 2):
        if ((a ^ b) % (1 << 64)).bit_count() <= 2 and top(a) != top(b):
            parent[max(top(a), top(b))] = min(top(a), top(b))
    assert {v: roots.get(v, v) for v in parent} == {v: top(v) for v in parent}


def test_near_duplicates_odd(spark, texts):
    found = sorted(map(str, (tuple(r)[::2] for r in simhash.near_duplicates(texts(ODD)).collect())))
    want = [(None, None), (1, 1), (2, 1), (3, 3), (3, 3), (4, 4), (5, 5)]
    assert found == sorted(map(str, want))
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert sorted(str(r.doc_id) for r in simhash.deduplicated(texts(ODD)).collect()) == ["1", "3", "3", "4", "5", "None"]


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    rows = [(rng.integers(0, 50, n), rng.normal(size=n)) for n in (1, 5, 12)]
    sizes = np.array([len(r[0]) for r in rows])
    got = m.margins(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), np.cumsum(sizes) - sizes)
    for margin, (i, x) in zip(got, rows):
        pairs = sum(m.factors[i[a]] @ m.factors[i[b]] * x[a] * x[b] for a, b in itertools.combinations(range(len(i)), 2))
        assert np.isclose(margin, 0.3 + m.linear[i] @ x + pairs)


def test_quality_odd(spark, texts):
    docs = texts(ODD)
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    machine = quality.train(docs, labels)
    scored = quality.score(docs, machine).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert quality.accepted(docs, machine, threshold=0.0).count() == len(ODD)
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(empty(spark), machine).count() == 0


def test_license_scan(spark, texts):
    cases = {
        "": "", "Released under the MIT License.": "mit", "GNU Lesser General Public License, version 2.1": "lgpl-2.1",
        "SPDX-License-Identifier: Apache-2.0": "apache-2", "CC BY-NC-SA 4.0": "cc-by-nc,cc-by-nc-sa-4",
        "the 3-clause BSD license": "bsd-3-clause", "a committed licensee": "", "GNU GPL": "gpl",
        "https://creativecommons.org/licenses/by/4.0/": "cc-by-4",
    }
    for text, labels in cases.items():
        assert licenses.scan_text(text)[5] == labels, text
    assert len(licenses.rules()) >= 300
    rng, vocabulary = random.Random(4), ["mit", "License", "apache", "version", "2", "cc", "BY", "nc", "é", "-", "..", "4"]
    for _ in range(400):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", "-", "\n"]) for _ in range(rng.randint(0, 25)))
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())
        hits = [(k, lab) for p, lab in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        got = licenses.scan_text(text)
        at = [k for k, _ in hits]
        assert got[:5] == (len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))
        assert {x for _, x in hits} <= set(got[5].split(","))
    rows = licenses.scan(texts(ODD)).collect()
    assert len(rows) == len(ODD) and licenses.scan(empty(spark)).count() == 0


def test_sharding(spark, texts):
    rng = random.Random(6)
    rows = [(k, "x" * rng.randint(0, 400)) for k in range(600)] + [(7, "y" * 300)] * 200 + [(None, "z" * 50)] * 3 + [(8000, None), (8001, "w" * 9000)]
    found = sharding.assign(texts(rows).repartition(3), max_bytes=4000).toPandas()
    assert len(found) == len(rows) and found.n_bytes.sum() == sum(len(t or "") for _, t in rows)
    for shard, own in found.groupby("shard"):
        assert own.n_bytes.sum() == own.shard_bytes.iloc[0] and len(own) == own.shard_docs.iloc[0]
        assert own.shard_bytes.iloc[0] <= 4000 or len(own) == 1
        # Only an oversized bucket was split: the parent must not fit.
        if shard:
            assert found[found.shard.str.startswith(shard[:-1])].n_bytes.sum() > 4000
    names = sorted(found.shard.unique())
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert found[found.doc_id == 7].shard.nunique() > 1
    assert sharding.assign(texts(rows), max_bytes=1 << 30).select("shard").distinct().collect()[0][0] == ""
    assert sharding.assign(empty(spark)).count() == 0


def test_sharded_write(spark, texts):
    docs = texts([(k, "x" * 100) for k in range(50)])
    found, path = sharding.assign(docs, max_bytes=1000), shared_path(spark, "sharded")
    sharding.write_sharded(docs, found, path)
    back = spark.read.parquet(path)
    assert back.count() == 50 and back.drop("shard").columns == docs.columns


EVENTS = "conv_id long, seq long, message_id string, kind string, role string, text string"


def test_fold(spark):
    log = [
        (1, 0, "s", "message", "system", "be kind"), (1, 1, "u", "message", "user", "hi"), (1, 2, "a", "delta", "assistant", "he"),
        (1, 4, "a", "delta", None, "lo"), (1, 3, "a", "delta", None, "l"), (1, 5, "u2", "message", "user", "gone"),
        (1, 6, "a", "regenerate", None, None), (1, 8, "a", "delta", None, "there"), (1, 7, "a", "delta", None, "hey "),
        (1, 9, "u3", "message", "user", "bye"), (2, 0, "u", "message", "user", "old"), (2, 1, "a", "message", "assistant", "answer"),
        (2, 2, "u", "edit", None, "new"), (2, 3, "b", "delta", "assistant", "fresh"), (3, 0, None, None, None, None),
        (3, 1, None, "message", "user", "x"), (3, 1, None, "message", "user", "x"), (None, 0, "q", "message", "tool", "y"),
    ]
    random.Random(1).shuffle(log)
    rows = chat.fold(spark.createDataFrame(log, EVENTS).repartition(3)).orderBy("conv_id", "position").collect()
    have = [(r.conv_id, r.role, r.text) for r in rows]
    assert have == [
        (None, "tool", "y"), (1, "system", "be kind"), (1, "user", "hi"), (1, "assistant", "hey there"), (1, "user", "bye"),
        (2, "user", "new"), (2, "assistant", "fresh"), (3, None, ""), (3, "user", "x"), (3, "user", "x"),
    ]
    assert chat.format_chats(spark.createDataFrame([], EVENTS)).count() == 0


def test_render_round_trip(spark):
    rng = random.Random(9)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[TEXT]", "[/TURN]", "\\", "<", "[", "/", ">", "]", "é😀", "\n", " ", "$1", ""]
    roles = ["user", "assistant", "system", "tool", "[TEXT]", "", None, "a\\b</s>"]
    log, want = [], {}
    for c in range(60):
        want[c] = [(rng.choice(roles), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))) for _ in range(rng.randint(1, 12))]
        log += [(c, k, None, "message", r, t) for k, (r, t) in enumerate(want[c])]
    out = chat.format_chats(spark.createDataFrame(log, EVENTS).repartition(4))
    out = out.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    for r in out.collect():
        assert [(t.role, t.text) for t in r.turns] == [(role or "", t) for role, t in want[r.conv_id]]
        assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.n_turns == len(want[r.conv_id])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow", plan)


def shingles(text, k=5):
    words = text.lower().split()
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def test_similar_documents(spark, texts):
    """Chains of edited copies in which every link is well above or below the threshold."""
    rng = random.Random(12)
    rows, truth = [], {}
    for g in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([150, 250, 400]))]
        for k in range(6):
            rows.append((100 * g + k, " ".join(words)))
            truth[100 * g + k] = 100 * g
            words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"  # one word: over 0.93
        far = [w if i % 4 else f"y{rng.randrange(5000)}" for i, w in enumerate(words)]
        rows.append((100 * g + 50, " ".join(far)))  # every fourth word: no shingle is left
        truth[100 * g + 50] = 100 * g + 50
    rows += [(5000, None), (5001, " "), (5002, "a b"), (5003, "A  b"), (None, "a b")]
    truth |= {5000: 5000, 5001: 5000, 5002: 5002, 5003: 5002, None: 5002}
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(texts(rows).repartition(3)).collect()}
    assert got == truth
    kept = sorted(r.doc_id for r in simhash.deduplicated(texts(rows)).collect() if r.doc_id is not None)
    assert kept == sorted(set(truth.values()))
    assert simhash.similar_documents(empty(spark)).count() == 0
    for a, b in ((rows[0][1], rows[3][1]), (rows[0][1], rows[6][1]), (rows[7][1], rows[9][1])):
        exact = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        x, y = (np.frombuffer(simhash.portrait(text, 5)[3], "<u4") for text in (a, b))
        assert abs(simhash.resemblance(x, y[None, :])[0] - exact) < 0.15


def edited(rng, n, changed):
    """A text of n words, and it with so many of them changed."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
    other = words.copy()
    for k in rng.sample(range(n), changed):
        other[k] = f"x{rng.randrange(10**6)}"
    return " ".join(words), " ".join(other)


def test_similar_documents_near_the_limit(spark, texts):
    """Pairs on both sides of 0.8, as near as 0.79 and 0.81, link by their exact similarity."""
    rng, rows, want = random.Random(21), [], {}
    for g, (n, changed) in enumerate([(100, 2), (100, 3), (1000, 20), (1000, 22), (1000, 23), (1000, 26), (40, 1), (30, 1)] * 12):
        pair = edited(rng, n, changed)
        rows += [(2 * g, pair[0]), (2 * g + 1, pair[1])]
        a, b = map(shingles, pair)
        want[2 * g + 1] = 2 * g if len(a & b) / len(a | b) >= 0.8 else 2 * g + 1
    assert 30 < sum(k == v for k, v in want.items()) < 70
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(texts(rows).repartition(3)).collect()}
    assert {k: got[k] for k in want} == want


def test_similar_documents_with_repeats(spark, texts):
    """A line that one copy repeats sixty times changes few distinct shingles."""
    rng, rows = random.Random(22), []
    for g in range(20):
        text, line = edited(rng, 300, 0)[0], edited(rng, 10, 0)[0]
        rows += [(2 * g, text), (2 * g + 1, text + f" {line}" * 60)]
        a, b = map(shingles, (rows[-2][1], rows[-1][1]))
        assert len(a & b) / len(a | b) > 0.9
    got = simhash.similar_documents(texts(rows).repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k - k % 2 for k, _ in rows}


def test_meeting_keys():
    """Sets at a similarity of 0.8 share keys with room to spare; sets that share a tenth rarely do."""

    def sketch(hashes):
        ranges, first = np.unique(hashes // np.uint64((1 << 64) // simhash.SKETCH), return_index=True)
        out = np.zeros(simhash.SKETCH, np.uint32)
        out[ranges.astype(int)] = (hashes[first] & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        return simhash.meeting_keys(out, len(hashes))

    rng, strangers = np.random.default_rng(8), 0
    for n in (4, 5, 8, 12, 20, 31, 32, 36, 40, 64, 128, 250, 1000):
        shared = -(-4 * n // 5)
        fewest = 10**6
        for trial in range(1000):
            pool = rng.integers(0, 1 << 64, 3 * n, np.uint64)
            # Either one set holds the other, or both have shingles of their own.
            one = pool[:n] if trial % 2 else pool[: n - (n - shared) // 2]
            other = pool[:shared] if trial % 2 else np.concatenate([pool[:shared], pool[2 * n : 2 * n + (n - shared) // 2]])
            keys = [set(sketch(np.sort(x)).tolist()) for x in (one, other)]
            fewest = min(fewest, len(keys[0] & keys[1]))
            if n >= 250:
                far = np.concatenate([pool[: n // 5], pool[2 * n : 2 * n + n - n // 5]])
                strangers += bool(keys[0] & set(sketch(np.sort(far)).tolist()))
        assert fewest >= (1 if n < simhash.MANY else 3), (n, fewest)
    assert strangers < 100


def test_similar_sets_of_every_size(spark, texts, monkeypatch):
    """Sets of a few shingles, whose fingerprints may lie far apart, groups of copies that fill
    cells of their own, and texts around one passage, against all pairs."""
    monkeypatch.setattr(simhash, "SKETCH_CHUNK_ROWS", 8)
    monkeypatch.setattr(simhash, "SET_CHUNK_ROWS", 8)
    rng, rows = random.Random(23), []
    for n in [8, 9, 9, 10, 12, 16, 20, 24, 30] * 12:
        words = edited(rng, n, 0)[0].split()
        rows += [" ".join(words), " ".join(words[:-1]), " ".join([*words, "y"])]
    passage = edited(rng, 60, 0)[0]
    rows += [f"{edited(rng, rng.choice([20, 80]), 0)[0]} {passage}" for _ in range(30)]
    base = edited(rng, 300, 0)[0].split()
    for _ in range(40):
        other = base.copy()
        for k in rng.sample(range(300), rng.choice([1, 3, 8])):
            other[k] = f"z{rng.randrange(10**6)}"
        rows.append(" ".join(other[: rng.choice([300, 290, 250])]))
    sets, root = [shingles(r) for r in rows], list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(texts(list(enumerate(rows))).repartition(3)).collect()}
    assert [got[k] for k in range(len(rows))] == root


def branches(parsed):
    """Texts that an expression matches, each of its alternatives in one of them at least."""
    parts = []
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            parts.append([chr(value)])
        elif name == "IN":
            parts.append([chr(v) if str(k) == "LITERAL" else "2" for k, v in value if str(k) in ("LITERAL", "CATEGORY")])
        elif name == "ANY":
            parts.append(["x"])
        elif name == "SUBPATTERN":
            parts.append(branches(value[-1]))
        elif name == "BRANCH":
            parts.append([t for branch in value[1] for t in branches(branch)])
        else:
            assert name == "MAX_REPEAT"
            parts.append([""] * (value[0] == 0) + branches(value[2]))
    least = [p[0] for p in parts]
    return ["".join(least)] + ["".join([*least[:k], t, *least[k + 1 :]]) for k, p in enumerate(parts) for t in p[1:]]


def test_every_license_rule_fires_on_each_branch():
    named = {"gnu fdl 1.3": "gfdl-1.3", "scripts.sil.org/OFL": "ofl-1.1", "mariadb.com/bsl11": "busl-1.1", "ASF 2.0": "apache-2", "SSPL": "sspl-1",
             "the Expat license": "mit", "licenses.ai": "openrail", "joinup.ec.europa.eu/software/page/eupl": "eupl-1.2"}
    for text, label in named.items():
        assert licenses.scan_text(text)[5] == label, text
    for rule in licenses.rules():
        samples = branches(re._parser.parse(rule.pattern.pattern.decode().removeprefix("(?<= )").removesuffix("(?= )")))
        samples = [text for text in samples if text == " ".join(text.split())]  # as words are joined
        assert samples, rule
        for text in samples:
            assert rule.pattern.search(f" {text} ".encode()), (rule.label, text)
            # Only a rule before it can have taken its place, and that is as sure as it is.
            assert licenses.scan_text(text)[6] >= rule.confidence, (rule.label, text)


def test_license_base_phrases():
    """The phrases as the contract has them; a bare "mit license" is the rules' affair."""
    first = {"x under the MIT License": (1, 1, "mit"), "a Apache License, Version 2.0": (1, 1, "apache-2"), "CC-BY-NC": (0, 1, "cc-by-nc"), "the MIT License": (None, 0, "")}
    for text, (at, n, label) in first.items():
        got = licenses.scan_text(text)
        assert (got[1], got[2], got[3], got[4]) == (n, at, at, label), text
    assert licenses.scan_text("the MIT License")[5] == "mit"


def test_sharded_write_null_and_split_ids(spark, texts):
    """Every row is written once, also without an id or with one that several shards hold."""
    docs = texts([(None, f"n{k}".ljust(100)) for k in range(5)] + [(7, f"s{k}".ljust(100)) for k in range(60)] + [(8, "same")] * 3 + [(9, None)])
    found, path = sharding.assign(docs.repartition(3), max_bytes=1000), shared_path(spark, "sharded")
    assert found.where("doc_id = 7").select("shard").distinct().count() > 1
    sharding.write_sharded(docs, found, path)
    back = spark.read.option("recursiveFileLookup", True).schema(docs.schema).parquet(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
    sizes = spark.read.parquet(path).groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b")).collect()
    assert len(sizes) > 1 and max(x.b for x in sizes) <= 1000
