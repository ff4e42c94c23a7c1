"""Fill-in-the-middle: cuts found by adding up remembered counts of content-defined chunks.

A rolling hash of the last 32 bytes cuts a text into chunks, so equal passages of different
documents give equal chunks wherever they stand.  What a cut needs to know of a chunk (its
code points, whether it holds a marker, and the bytes at both ends, in which a marker may
cross into the neighbour) is worked out once and kept in a cache whose key is the chunk's
content itself: a hit compares all its bytes.  Adding the chunks' code points up finds the
chunk in which a cut lies, and only that chunk is decoded.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, keyed_texts, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WINDOW = 32  # bytes under the rolling hash: its 32 bits forget anything older
SMALLEST, LARGEST, ZERO_BITS = 256, 8192, 10  # bytes of a chunk; a cut once in 2**10 places
STRETCH = 1 << 20
CACHE_BYTES = 32 << 20
FORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_MARKERS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
_EDGE = max(map(len, _MARKERS)) - 1
_GEAR = np.random.default_rng(32).integers(0, 1 << 32, 256, dtype=np.uint32)


class Summary(NamedTuple):
    chars: int
    marked: bool
    head: bytes
    tail: bytes


class Memo:
    """Summaries by content, at most about twice ``limit`` bytes: when the young generation
    is full it becomes the old one, and what is asked for again moves back."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held = limit, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.asked = self.found = 0

    def summary(self, chunk: bytes) -> Summary:
        self.asked += 1
        known = self.young.get(chunk)
        if known is not None:
            self.found += 1
            return known
        known = self.old.get(chunk)
        if known is not None:
            self.found += 1
        else:
            known = Summary(len(chunk.decode()), any(m in chunk for m in _MARKERS), chunk[:_EDGE], chunk[-_EDGE:])
        if self.held + len(chunk) > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[chunk] = known
        self.held += len(chunk) + 200
        return known


def _candidates(data: bytes) -> np.ndarray:
    """Offsets after which the rolling hash allows a cut, between whole characters."""
    found = []
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(data), STRETCH):
        lead = min(at, WINDOW - 1)
        own = whole[at - lead : at + STRETCH]
        h = _GEAR[own]
        for step in (1, 2, 4, 8, 16):
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        ends = np.flatnonzero(h[lead:] >> np.uint32(32 - ZERO_BITS) == 0) + at + 1
        ends = ends[ends < len(data)]
        found.append(ends[whole[ends] & 0xC0 != 0x80])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_edges(data: bytes) -> list[int]:
    """0, every cut and the length; each chunk but the last has 256 to 8192 bytes."""
    ends = _candidates(data).tolist()
    edges, at, k = [0], 0, 0
    while len(data) - at > SMALLEST:
        while k < len(ends) and ends[k] < at + SMALLEST:
            k += 1
        at = min(ends[k] if k < len(ends) else len(data), at + LARGEST, len(data))
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        edges.append(at)
    return edges if edges[-1] == len(data) else [*edges, len(data)]


class Cutter:
    """One text through its chunks: code points, markers, and bytes before a code point."""

    def __init__(self, data: bytes, memo: Memo):
        self.data, self.edges = data, chunk_edges(data)
        self.before, self.marked, carry = [0], False, b""
        for a, b in zip(self.edges, self.edges[1:]):
            known = memo.summary(data[a:b])
            self.before.append(self.before[-1] + known.chars)
            seam = carry + known.head
            self.marked = self.marked or known.marked or any(m in seam for m in _MARKERS)
            carry = (carry + known.tail)[-_EDGE:]
        self.chars = self.before[-1]

    def byte_at(self, chars: int) -> int:
        if chars == self.chars:
            return len(self.data)
        k = bisect_right(self.before, chars) - 1
        a, b, inside = self.edges[k], self.edges[k + 1], chars - self.before[k]
        if b - a == self.before[k + 1] - self.before[k]:
            return a + inside
        return a + len(self.data[a:b].decode()[:inside].encode())


def _formed(doc_id, data: bytes, memo: Memo, seed: int, plain_percent: int, spm_percent: int) -> tuple:
    cutter = Cutter(data, memo)
    n = cutter.chars
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    if not n or cutter.marked or h3 % 100 >= 100 - plain_percent:
        return doc_id, n, "plain", None, None, data
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = cutter.byte_at(first), cutter.byte_at(last)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = _MARKERS
    if h4 % 100 < spm_percent:
        return doc_id, n, "spm", first, last - first, b"".join((s, suffix, p, prefix, m, middle))
    return doc_id, n, "psm", first, last - first, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every text with its middle moved behind its prefix and suffix.

    Columns: doc_id, n (code points), form (plain, psm, spm), prefix_chars, middle_chars (null
    where plain), output.  Both cuts and the form come from the hash of ``seed:id``, so equal
    ids are cut alike and a rerun gives the same rows.  Texts that are empty or hold a marker
    stay plain.  A null text counts as empty, a null id hashes as no digits, repeated rows
    give repeated rows, an empty table gives none, other columns are not read.  No shuffle; a
    task holds one text, its output and the cache.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, schema = Memo(), arrow_schema(FORMED)
        for batch in slices(batches, 64):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rows = [
                _formed(i, t or b"", memo, seed, plain_percent, spm_percent)
                for i, t in zip(batch.column("doc_id").to_pylist(), texts)
            ]
            *left, output = zip(*rows)
            columns = [pa.array(c, f.type) for c, f in zip(left, schema)] + [pa.array(output, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    texts = keyed_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(run, FORMED)


def restored(output: Column, form: Column) -> Column:
    """The text again: a formed output holds each marker once, and no text in it holds any."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda k: F.element_at(parts, k)
    return (
        F.when(form == "psm", F.concat(part(2), part(4), part(3)))
        .when(form == "spm", F.concat(part(3), part(4), part(2)))
        .otherwise(output)
    )
