"""Training-order materialisation: every sequence gets a global slot by a keyed permutation,
and ranges of slots are written as files of fixed-stride records.

The permutation is a Feistel network over the smallest even number of bits that holds all
sequence numbers; values beyond the last number walk the cycle until they fall inside.  It
is a bijection that needs no state, so any task can place a sequence, and a reader can tell
which sequence stands at any slot.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_schema, slices

ROUNDS = 6
BLOCK = "shard long, block binary"
BLOCK_BYTES = 16 << 20
MAX_TASKS = 20_000
MANIFEST = "shard long, first_slot long, sequences long, bytes long, crc32 long, file string"
RECORD = "sequence_id long, slot long, shard long, byte_offset long, n_bytes long, crc32 long"


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed 64-bit finaliser; only used one way, so it need not be invertible."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _keys(key: int) -> list[int]:
    return [(key * 0x2545F4914F6CDD1D + 0x632BE59BD9B4E019 * (r + 1)) % (1 << 64) for r in range(ROUNDS)]


def _walk(values, n: int, key: int, backwards: bool) -> np.ndarray:
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = np.array(values, np.uint64)
    todo = np.arange(len(out))
    keys = _keys(key)[::-1] if backwards else _keys(key)
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            if backwards:
                left, right = right ^ (_mix(left, k) & mask), left
            else:
                left, right = right, left ^ (_mix(right, k) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def slots(sequence_ids, n: int, key: int) -> np.ndarray:
    """Slots of sequences 0..n-1: a permutation of 0..n-1 chosen by ``key``."""
    return _walk(sequence_ids, n, key, False)


def sequences_at(slot_ids, n: int, key: int) -> np.ndarray:
    """The inverse: which sequence stands at each slot."""
    return _walk(slot_ids, n, key, True)


def write_shards(
    pieces: DataFrame, n: int, directory: str, key: int, per_shard: int = 8192, window: int = 1024, width: int = 2,
    pad_id: int = 0,
) -> DataFrame:
    """Write sequences 0..n-1 (``pieces`` of packing) as shard files; return the manifest.

    Shard s holds slots s*per_shard up to the next shard's, one record of ``window`` ids of
    ``width`` bytes each (little-endian, padded with ``pad_id``), so slot and byte offset are
    linear.  Pieces are shuffled once, in compressed blocks by shard; every shard has the same
    size whatever the documents are, and a task holds one shard at a time.  A file appears
    under its name only when it is whole and has the same bytes whenever it is made, so a task
    that runs twice, or a second call over the same folder after a failure, leaves finished
    shards as they are; a file of another corpus or key has another checksum and is replaced.
    An id that does not fit ``width`` bytes is an error.  Pieces that repeat a place of a
    sequence are written once; places without a piece hold ``pad_id``.  ``directory`` must be on a file system that all executors reach (a
    URI that pyarrow's file systems know).  Without sequences nothing but an empty manifest
    is written.
    """
    dtype = np.dtype(f"<u{width}")
    head = np.dtype([("row", "<i4"), ("offset", "<i4"), ("length", "<i4")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink, held, size = zstandard.ZstdCompressor(), [], 0

        def blocks():
            held.sort(key=lambda x: x[0])
            rows = []
            for shard, group in itertools.groupby(held, key=lambda x: x[0]):
                group = list(group)
                heads = np.array([x[1:4] for x in group], head)
                raw = len(group).to_bytes(4, "little") + heads.tobytes() + b"".join(x[4] for x in group)
                rows.append((shard, shrink.compress(raw)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow_schema(BLOCK))], schema=arrow_schema(BLOCK))

        for batch in slices(batches, 256):
            at = slots(batch.column("sequence_id").to_numpy(), n, key)
            for slot, offset, raw in zip(at.tolist(), batch.column("offset").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(raw, "<u4")
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"token id {ids.max()} does not fit {width} bytes")
                ids = ids.astype(dtype)
                held.append((slot // per_shard, slot % per_shard, offset, len(ids), ids.tobytes()))
                size += ids.nbytes
            if size >= BLOCK_BYTES:
                yield blocks()
                size = 0
        if held:
            yield blocks()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(directory)
        unpack, shard, records = zstandard.ZstdDecompressor(), None, None

        def checksum(path: str) -> int:
            crc = 0
            with store.open_input_stream(path) as file:
                while some := file.read(1 << 20):
                    crc = zlib.crc32(some, crc)
            return crc

        def close():
            raw = records.tobytes()
            name, crc = f"shard-{shard:09d}.bin", zlib.crc32(raw)
            there = store.get_file_info(f"{base}/{name}")
            if there.size != len(raw) or checksum(f"{base}/{name}") != crc:
                part = f"{base}/{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(raw)
                if there.type == fs.FileType.File:
                    store.delete_file(f"{base}/{name}")
                store.move(part, f"{base}/{name}")
            row = (shard, shard * per_shard, len(records), len(raw), crc, name)
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, arrow_schema(MANIFEST))], schema=arrow_schema(MANIFEST))

        for batch in batches:
            for own, block in zip(batch.column("shard").to_pylist(), batch.column("block").to_pylist()):
                if own != shard:
                    if records is not None:
                        yield close()
                    shard = own
                    records = np.full((min(per_shard, n - shard * per_shard), window), pad_id, dtype)
                raw = unpack.decompress(block)
                count = int.from_bytes(raw[:4], "little")
                heads = np.frombuffer(raw, head, count, 4)
                at = 4 + heads.nbytes
                for row, offset, length in heads.tolist():
                    records[row, offset : offset + length] = np.frombuffer(raw, dtype, length, at)
                    at += length * width
        if records is not None:
            yield close()

    spark = pieces.sparkSession
    store, base = fs.FileSystem.from_uri(directory)
    store.create_dir(base, recursive=True)
    placed = pieces.select("sequence_id", "offset", "ids").mapInArrow(place, BLOCK)
    ordered = placed.repartition("shard").sortWithinPartitions("shard")
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{directory}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{directory}/manifest")


def read_records(
    spark: SparkSession, directory: str, n: int, key: int, from_slot: int = 0, per_shard: int = 8192, window: int = 1024,
    width: int = 2,
) -> DataFrame:
    """What the shard files hold from a slot on: one row per record with its checksum and the
    sequence that the inverse permutation gives.  A reader that stopped goes on with
    ``from_slot``; shards before it aren't opened, and files are read in stretches of a few
    hundred records."""
    stride, shards = window * width, -(-n // per_shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(directory)
        for shard in (s for batch in batches for s in batch.column("id").to_pylist()):
            first = shard * per_shard
            skip = max(0, from_slot - first)
            with store.open_input_file(f"{base}/shard-{shard:09d}.bin") as file:
                file.seek(skip * stride)
                while raw := file.read(256 * stride):
                    at = first + skip + np.arange(len(raw) // stride)
                    skip += len(at)
                    sums = [zlib.crc32(raw[k * stride : (k + 1) * stride]) for k in range(len(at))]
                    columns = [sequences_at(at, n, key), at, np.full(len(at), shard), (at - first) * stride, np.full(len(at), stride), sums]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=arrow_schema(RECORD))

    start = min(from_slot // per_shard, shards)
    return spark.range(start, shards, 1, max(1, min(shards - start, MAX_TASKS))).mapInArrow(run, RECORD)
