"""Work and memory that follow the data: long texts, shared ids, folders used again."""

import time

import numpy as np
import pytest

from quoteloom.llm import licenses, packing, quality, shards, tokens
from quoteloom.llm.common import shared_path


def test_license_scan_is_linear():
    phrase = "it is under the mit license and the gnu general public license version 3 "
    taken = []
    for n in (10_000, 140_000):  # the second text has 10 MB
        begun = time.perf_counter()
        n_words, n_base, first, last, *_ = licenses.scan_text(phrase * n)
        taken.append(time.perf_counter() - begun)
        assert (n_words, n_base, first, last) == (14 * n, n, 2, 14 * (n - 1) + 2)
    assert taken[1] < 60 * max(taken[0], 0.05)  # 14 times the text; pairs would be 196


def test_kept_intervals():
    rng, kept, spans = np.random.default_rng(1), licenses._Kept(), []
    for _ in range(30):
        starts = np.sort(rng.choice(200, 4, replace=False)).tolist()
        fresh = [(a, a + int(rng.integers(1, 20))) for a in starts]
        for a, b in fresh:
            assert kept.covers(a, b) == any(x <= a and b <= y for x, y in spans)
        kept.add(fresh)
        spans += fresh


def test_features_are_bounded_and_one_row_an_id(spark):
    index, value = quality.features(" ".join(f"w{k}" for k in range(200_000)))
    assert len(index) == len(set(index.tolist())) <= quality.SPACE and len(value) == len(index)
    rows = [(k, f"good text {k}" if k % 2 else "x" * 5) for k in range(1, 60)] + [(7, f"again {k}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 60)], "doc_id long, quality int")
    least = docs.groupBy("doc_id").agg({"text": "min"}).withColumnRenamed("min(text)", "text")
    a, b = quality.train(docs, labels), quality.train(least, labels)
    assert a.bias == b.bias and (a.linear == b.linear).all()


def shard_folder(spark):
    folder = shared_path(spark, "shards-again")
    return folder if ":" in folder else f"file://{folder}"


def test_shards_of_another_corpus_replace_the_old(spark, texts):
    folder = shard_folder(spark)
    sums = []
    for word in ("alpha", "gamma"):
        pieces = packing.pack(texts([(k, f"{word} {k} " * 20) for k in range(80)]), tokens.default_path(), window=32).cache()
        n = pieces.agg({"sequence_id": "max"}).first()[0] + 1
        manifest = shards.write_shards(pieces, n, folder, 5, per_shard=16, window=32).collect()
        records = shards.read_records(spark, folder, n, 5, per_shard=16, window=32).collect()
        want = {r.sequence_id: np.array(r.input_ids, "<u2") for r in packing.sequences(pieces, 32).collect()}
        assert {r.sequence_id: r.crc32 for r in records} == {k: __import__("zlib").crc32(v.tobytes()) for k, v in want.items()}
        sums.append([m.crc32 for m in manifest])
    assert all(a != b for a, b in zip(*sums))


def test_shards_of_nothing_odd_rows_and_wide_ids(spark, texts):
    folder = shard_folder(spark)
    none = packing.pack(texts([]).limit(0), tokens.default_path(), window=32)
    assert shards.write_shards(none, 0, folder, 5, window=32).count() == 0
    assert shards.read_records(spark, folder, 0, 5, window=32).count() == 0
    rows = [(None, "no id"), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "long " * 5000)]
    pieces = packing.pack(texts(rows), tokens.default_path(), window=32)
    n = pieces.agg({"sequence_id": "max"}).first()[0] + 1
    doubled = pieces.unionByName(pieces)
    one = shards.write_shards(pieces, n, shard_folder(spark), 5, per_shard=16, window=32).collect()
    two = shards.write_shards(doubled, n, shard_folder(spark), 5, per_shard=16, window=32).collect()
    assert sorted(m.crc32 for m in one) == sorted(m.crc32 for m in two)
    with pytest.raises(Exception, match="does not fit"):
        shards.write_shards(pieces, n, shard_folder(spark), 5, per_shard=16, window=32, width=1).collect()
