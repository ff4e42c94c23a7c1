"""SimHash near-duplicates by vantage-point shards.

Distinct fingerprints are dealt to the leaves of a vantage-point tree by their Hamming
distances to the tree's vantage points.  A fingerprint whose ball of ``radius`` reaches over
a threshold also visits the other side, and a branch that the triangle inequality rules out
is never entered; only one of two neighbours needs to visit the other's leaf.  Leaves compare
exactly, and hand on no more links than keep their groups connected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import scan
from .common import arrow_schema, keyed_texts, slices, staged
from .components import connected

SEED = 42
WORDS = 3
RADIUS = 2
LEAF_ROWS = 4096
MAX_SAMPLE = 1 << 17
BLOCK = 1 << 15
SKETCH = 128
# Near copies by similarity: shingles of five words, and how far apart fingerprints are searched:
# of 624,000 simulated pairs at 0.8 none lay further than 24 (10 further than 22), but of sets of
# four and five shingles 4 of 48,000 did.  So sets of at most ``SMALL`` shingles meet whatever
# their fingerprints are.  What lies further all the same is found by ``_unmet``.
SIMILAR_WORDS = 5
SIMILARITY = 0.8
SIMILAR_RADIUS = 24
SMALL = 16
# ``meeting_keys``: of fewer than ``MANY`` shingles pairs of ranges, of more 48 groups of four.
MANY = 32
# How far below the similarity a sketch still makes a candidate: five standard errors.
MARGIN = 0.18
# Bands within that factor of size, and classes in a chunk, for sketches and for whole sets.
SKETCH_BANDS, SKETCH_CHUNK_ROWS = 4, 1 << 14
SET_BANDS, SET_CHUNK_ROWS = 2, 1 << 10
# Buckets in which shingles are counted to tell rare ones, how many of them stand in a row, and
# how many classes around one shingle are paired one by one.
TALLY_BITS, TALLY_ROWS = 20, 1 << 12
LONG = 64
# Up to so many rows (8 bytes each) are broadcast to pick their texts; more are joined.
PICKED_ROWS = 1 << 20


def shingle_digests(text: str | None, words: int) -> Iterator[bytes]:
    """Big-endian XXH64 digests of all shingles, end to end, in blocks.

    Only A-Z is lower-cased and only ASCII white space separates words (what ``bytes`` do).
    Fewer words than a shingle are one shingle; no word at all gives none.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return
    joined, k = b" ".join(parts), min(words, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    spans = list(zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist()))
    for at in range(0, len(spans), BLOCK):
        yield b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in spans[at : at + BLOCK]])


def _majority(blocks: list[bytes]) -> int:
    ones, total = np.zeros(64, np.int64), 0
    for digests in blocks:
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(bits)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority of the bits of the hashes of all shingles, as a signed 64-bit integer; 0 for
    a text without words."""
    return _majority(list(shingle_digests(text, words)))


def shingle_set(blocks: list[bytes]) -> np.ndarray:
    """The distinct hashes among digests, sorted."""
    return np.unique(np.frombuffer(b"".join(blocks), ">u8").astype(np.uint64))


def portrait(text: str | None, words: int) -> tuple[int, int, int, bytes]:
    """(class, fingerprint, distinct shingles, sketch): texts with the same set of shingles
    are one class, and have one fingerprint, also where they repeat some; the sketch holds the
    smallest hash in each of ``SKETCH`` equal ranges (32 bits of it; 0 where a range has none)."""
    return _portrait(shingle_set(list(shingle_digests(text, words))))


def _class(hashes: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh64_digest(hashes.tobytes(), SEED), "big", signed=True)


def _portrait(hashes: np.ndarray) -> tuple[int, int, int, bytes]:
    ranges, first = np.unique(hashes // np.uint64((1 << 64) // SKETCH), return_index=True)
    sketch = np.zeros(SKETCH, "<u4")
    sketch[ranges.astype(np.int64)] = (hashes[first] & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return _class(hashes), _majority([hashes.astype(">u8").tobytes()]), len(hashes), sketch.tobytes()


def spread(hashes: np.ndarray) -> np.ndarray:
    """How many of a set's hashes lie in each of ``SKETCH`` equal ranges (255 at most).  Two sets
    differ in at least as many hashes as these numbers do, added up."""
    ranges = (hashes // np.uint64((1 << 64) // SKETCH)).astype(np.int64)
    return np.minimum(255, np.bincount(ranges, minlength=SKETCH)).astype("u1")


def _least(share: float, n):
    """The smallest whole number that is at least that share of n."""
    return np.ceil(share * n - 1e-6).astype(np.int64)


def rare_prefix(hashes: np.ndarray, levels: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest hashes of a sorted set, of which similar sets have some in common.

    All sets are ordered alike, by the level of a hash's bucket and then by the hash.  Whatever
    the levels are, similar sets have ``common_prefix`` of them in common: levels only decide
    how many others do.
    """
    order = np.argsort(levels[hashes >> np.uint64(64 - TALLY_BITS)], kind="stable")
    return hashes[order[: len(hashes) - _least(similarity, len(hashes)) + 1]]


def common_prefix(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """How many hashes the rare prefixes of similar sets of n and m have in common at least: what
    the sets must share, less all that follows the prefix of the larger one.  At least one."""
    return _least(similarity / (1 + similarity), n + m) - _least(similarity, np.maximum(n, m)) + 1


def resemblance(sketch: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of a shingle set with others, from their sketches: of the
    ranges that either set fills, the share in which both have the same smallest hash."""
    filled = ((sketch != 0) | (others != 0)).sum(axis=1)
    return ((sketch == others) & (others != 0)).sum(axis=1) / np.maximum(1, filled)


def meeting_keys(sketch: np.ndarray, shingles: int) -> np.ndarray:
    """Names of groups of ranges in a sketch (32 bits a range) that hold anything, for callers
    who look for texts alike by sketches alone; ``similar_documents`` searches fingerprints.

    Pairs: if more than half of the ranges that either of two sets fills agree, so does a pair
    with something in it, for a differing range spoils one pair and an agreeing one stands in
    a pair with at most one other.  Four together are rarely alike in texts that only share a
    passage.  Sets of a size that can be similar to both kinds have both.
    """
    wide = sketch.astype(np.uint64)
    forms = [wide.reshape(-1, 2)] if shingles * SIMILARITY < MANY else []
    if shingles >= MANY:
        forms += [wide.reshape(-1, 4), wide.reshape(4, -1).T[: SKETCH // 8]]
    names = []
    for form in forms:
        at = np.flatnonzero(form.any(axis=1))
        code = at.astype(np.uint64) + np.uint64(SKETCH * form.shape[1] + (form.shape[0] == SKETCH // 8))
        for j in range(form.shape[1]):
            code = (code ^ form[at, j]) * np.uint64(0xBF58476D1CE4E5B9)
            code = (code ^ code >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            code ^= code >> np.uint64(31)
        names.append(code.view(np.int64))
    return np.concatenate(names)


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp of every row; a null text counts as empty."""
    schema = arrow_schema("doc_id long, fp long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], schema=schema)

    texts = keyed_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(run, "doc_id long, fp long")


@dataclass
class Tree:
    """Inner node k: vantage point, threshold, and children (a leaf L is stored as ~L)."""

    point: np.ndarray
    limit: np.ndarray
    near: np.ndarray
    far: np.ndarray
    leaves: int


def distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def grow(sample: np.ndarray, leaf_size: int, radius: int, candidates: int = 8) -> Tree:
    """A tree whose leaves hold about ``leaf_size`` of the sample.

    Of a few vantage points and the thresholds that leave a fifth on either side, the one
    with the fewest fingerprints within ``radius`` of the threshold is taken.
    """
    point, limit, near, far, leaves = [], [], [], [], 0

    def split(rows: np.ndarray):
        best = None
        for v in rows[:: max(1, len(rows) // candidates)][:candidates]:
            counts = np.bincount(distance(rows, v), minlength=65 + radius)
            upto = np.cumsum(counts)
            for t in range(64):
                low, high = upto[t], len(rows) - upto[t]
                if min(low, high) * 5 >= len(rows):
                    band = counts[max(0, t - radius + 1) : t + radius + 1].sum()
                    if best is None or band < best[0]:
                        best = (band, v, t)
        return best

    def build(rows: np.ndarray) -> int:
        nonlocal leaves
        best = split(rows) if len(rows) > leaf_size else None
        if best is None:
            leaves += 1
            return ~(leaves - 1)
        k = len(point)
        point.append(best[1])
        limit.append(best[2])
        near.append(0)
        far.append(0)
        d = distance(rows, best[1])
        near[k] = build(rows[d <= best[2]])
        far[k] = build(rows[d > best[2]])
        return k

    build(sample)
    ints = (np.array(x, np.int64) for x in (limit, near, far))
    return Tree(np.array(point, np.uint64), *ints, leaves)


def route(tree: Tree, fps: np.ndarray, radius: int, visit_all: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, is_home) of every leaf that each fingerprint belongs to or has to visit;
    with ``visit_all`` it is at home nowhere and visits all leaves in its reach."""
    rows, nodes, home = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.full(len(fps), not visit_all)
    if not len(tree.point):
        return rows, nodes, home
    done = []
    while len(rows):
        d = distance(fps[rows], tree.point[nodes])
        limit = tree.limit[nodes]
        near = np.where(home, d <= limit, d - radius <= limit)
        # A row at home on the near side visits the far side, never the other way round.
        far = np.where(home, d > limit, d + radius > limit)
        visit = home & near & (d + radius > limit)
        parts = ((near, tree.near, home), (far, tree.far, home), (visit, tree.far, np.zeros(len(home), bool)))
        rows, nodes, home = (
            np.concatenate(x) for x in zip(*((rows[m], child[nodes[m]], h[m]) for m, child, h in parts))
        )
        end = nodes < 0
        done.append((rows[end], ~nodes[end], home[end]))
        rows, nodes, home = rows[~end], nodes[~end], home[~end]
    return tuple(np.concatenate(x) for x in zip(*done))


def _links(table: pa.Table, probes: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of one chunk: each probe with one member of every group that it joins."""
    fps = np.sort(table.column("fp").to_numpy().view(np.uint64))
    pivot = fps[len(fps) // 2]
    d = distance(fps, pivot)
    order = np.argsort(d, kind="stable")
    fps, d = fps[order], d[order]
    group = np.arange(len(fps))
    for batch in probes:
        asked = batch.column("fp").to_numpy().view(np.uint64)
        to_pivot, out = distance(asked, pivot), []
        for value in np.unique(to_pivot):
            a, b = np.searchsorted(d, value - radius, "left"), np.searchsorted(d, value + radius, "right")
            mine = asked[to_pivot == value]
            for at in range(0, len(mine), 256):
                block = mine[at : at + 256]
                apart = distance(block[:, None], fps[None, a:b])
                for p in np.flatnonzero(((apart <= radius) & (apart > 0)).any(axis=1)):
                    hits = a + np.flatnonzero((apart[p] <= radius) & (apart[p] > 0))
                    groups, first = np.unique(group[hits], return_index=True)
                    out += [(block[p], fps[h]) for h in hits[first]]
                    if len(groups) > 1:
                        group[np.isin(group, groups)] = groups[0]
        if out:
            pairs = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def _planted(distinct: DataFrame, leaf_rows: int, max_sample: int, radius: int) -> Tree:
    n = distinct.count()
    share = max(16, -(-n // max_sample))
    picked = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).select("fp").limit(2 * max_sample)
    sample = np.sort(np.array([r[0] for r in picked.collect()], np.int64).view(np.uint64))
    return grow(sample, max(1, leaf_rows // share), radius)


def links(distinct: DataFrame, radius: int = RADIUS, leaf_rows: int = LEAF_ROWS, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(u, v): links that connect exactly what fingerprints within ``radius`` connect.

    ``distinct`` has one row per fingerprint (fp).  The tree is grown on a sample of a
    sixteenth of them, chosen by hash, of about ``max_sample`` at most; leaves whose rows
    outnumber the plan are cut into chunks, so the sample only decides how fast it is.
    """
    tree = _planted(distinct, leaf_rows, max_sample, radius)
    kinds = arrow_schema("cell long, fp long, home boolean")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            fps = batch.column("fp").to_numpy()
            rows, leaf, home = route(tree, fps.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(fps[rows]), pa.array(home)], schema=kinds)

    dealt = distinct.select("fp").mapInArrow(deal, "cell long, fp long, home boolean")
    members = dealt.where("home").drop("home")
    return scan(members, dealt.drop("home"), 2 * leaf_rows, "fp", lambda t, p: _links(t, p, radius), "u long, v long")


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, words: int = WORDS, leaf_rows: int = LEAF_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fp and component_id of every row.

    component_id is the smallest doc_id that links of at most ``radius`` differing bits reach,
    the row's own included.  Equal texts meet as one fingerprint before anything is compared.
    Null texts count as empty; null ids take part, and name a component only where it has no
    other id (then it is null); repeated rows come back as often; no rows give none.
    """
    marked = staged(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected(links(classes.select("fp"), radius, leaf_rows)).withColumnRenamed("u", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(named, "root").drop("root"), "fp").select("doc_id", "fp", "component_id")


def _packed(rows, column: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in rows.column(column).to_pylist()]


def _candidates(table: pa.Table, batch: pa.RecordBatch, radius: int, floor: float, similarity: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(probe, member, resemblance) of the pairs of a batch and a chunk whose sizes allow the
    similarity, whose fingerprints are near or whose sets are small, and whose sketches
    resemble each other by ``floor`` or more, probe by probe."""
    fps, names, sketches = table.column("fp").to_numpy().view(np.uint64), table.column("id").to_numpy(), np.stack(_packed(table, "sketch", "u1"))
    asked, own, mine = batch.column("fp").to_numpy().view(np.uint64), batch.column("id").to_numpy(), np.stack(_packed(batch, "sketch", "u1"))
    sizes, counts = table.column("n").to_numpy(), batch.column("n").to_numpy()
    for at in range(0, len(asked), 128):
        near = np.bitwise_count(asked[at : at + 128, None] ^ fps[None, :]) <= radius
        here = counts[at : at + 128]
        if (here <= SMALL).any():
            near |= (here <= SMALL)[:, None] & (sizes <= SMALL / similarity)[None, :]
        p, h = np.nonzero(near & (own[at : at + 128, None] != names[None, :]))
        a, b = here[p], sizes[h]
        fits = np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-6
        p, h = p[fits], h[fits]
        likely = np.concatenate([resemblance(mine[at + p[k : k + BLOCK]], sketches[h[k : k + BLOCK]]) for k in range(0, max(1, len(p)), BLOCK)])
        good = likely >= floor
        if good.any():
            yield at + p[good], h[good], likely[good]


def _paired(table: pa.Table, probes: Iterator[pa.RecordBatch], radius: int, floor: float, similarity: float) -> Iterator[pa.RecordBatch]:
    """The classes of one chunk and of its probes that are in any candidate pair, one by one."""
    names, seen = table.column("id").to_numpy(), np.zeros(table.num_rows, bool)
    for batch in probes:
        own, paired = batch.column("id").to_numpy(), np.zeros(batch.num_rows, bool)
        for p, h, _ in _candidates(table, batch, radius, floor, similarity):
            paired[p], seen[h] = True, True
        yield pa.RecordBatch.from_arrays([pa.array(own[paired])], names=["id"])
    yield pa.RecordBatch.from_arrays([pa.array(names[seen])], names=["id"])


def jaccard(one: np.ndarray, other: np.ndarray) -> float:
    """Similarity of two sorted arrays without repeats, of which one isn't empty."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both / (len(one) + len(other) - both)


def _possible(table: pa.Table, batch: pa.RecordBatch, similarity: float) -> Iterator[tuple[np.ndarray, ...]]:
    """As ``_candidates``, but all pairs with different roots that sizes and spreads allow."""
    roots, spreads, sizes = table.column("root").to_numpy(), np.stack(_packed(table, "spread", "u1")), table.column("n").to_numpy()
    own, mine, counts = batch.column("root").to_numpy(), np.stack(_packed(batch, "spread", "u1")), batch.column("n").to_numpy()
    for at in range(0, len(own), 128):
        here = counts[at : at + 128, None]
        fits = np.minimum(here, sizes[None, :]) >= similarity * np.maximum(here, sizes[None, :]) - 1e-6
        p, h = np.nonzero(fits & (own[at : at + 128, None] != roots[None, :]))
        for k in range(0, len(p), BLOCK):
            a, b = at + p[k : k + BLOCK], h[k : k + BLOCK]
            good, likely = _within(mine[a], spreads[b], counts[a], sizes[b], similarity)
            if good.any():
                yield a[good], b[good], likely[good]


def _within(one: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of spreads leave room for the similarity, and how alike they look at best."""
    apart = np.abs(one.astype(np.int16) - other).sum(axis=1, dtype=np.int64)
    return apart <= (1 - similarity) / (1 + similarity) * (n + m) + 1e-6, 1 - apart / (n + m)


def _similar_links(table: pa.Table, probes: Iterator[pa.RecordBatch], candidates: Callable, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links of one chunk: of the candidate pairs those whose sets have the similarity, each
    probe with one member of every group that it joins.  Likely members come first, and the
    others of a group that a probe has joined need no look."""
    names, sets = table.column("id").to_numpy(), _packed(table, "hashes", "<u8")
    group = table.column("root").to_numpy().copy() if "root" in table.column_names else np.arange(len(names))
    for batch in probes:
        own, mine, out = batch.column("id").to_numpy(), _packed(batch, "hashes", "<u8"), []
        for ps, hs, likely in candidates(table, batch):
            for p in np.unique(ps):
                a, b = np.searchsorted(ps, p), np.searchsorted(ps, p, "right")
                joined = []
                for h in hs[a:b][np.argsort(-likely[a:b], kind="stable")]:
                    if group[h] not in joined and jaccard(mine[p], sets[h]) >= similarity:
                        out.append((own[p], names[h]))
                        joined.append(group[h])
                if len(joined) > 1:
                    group[np.isin(group, joined)] = joined[0]
        if out:
            pairs = np.array(out, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def _banded(rows: DataFrame, similarity: float, split: int) -> DataFrame:
    """Rows with ``n`` dealt to bands of size: at home in their own, and visiting it and the
    ``split`` next ones, which hold all larger sets that can have the similarity."""
    band = F.floor(F.log(F.greatest(F.lit(1), F.col("n"))) / (-math.log(similarity) / split) + 1e-9)
    to = F.concat(F.array(F.lit(-1)), F.sequence(F.lit(0), F.lit(split)))
    dealt = rows.withColumn("band", band).withColumn("up", F.explode(to))
    return dealt.withColumns({"cell": F.col("band") + F.greatest("up", F.lit(0)), "home": F.col("up") < 0}).drop("band", "up")


def _whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches as tables that hold all rows of their keys."""
    held, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (held and at != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
        at = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def _meetings(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(u, v, need) of classes that a rare shingle brings together: sizes allow the similarity,
    roots differ, and ``need`` such shingles have to do so.  Where one does it to many, each
    of them comes by itself, paired with itself."""

    def row(u: np.ndarray, v: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(need)], names=["u", "v", "need"])

    def pairs(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        fits = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-6
        i, j = (x[fits & (root[i] != root[j])] for x in (i, j))
        return row(np.minimum(name[i], name[j]), np.maximum(name[i], name[j]), common_prefix(n[i], n[j], similarity))

    for table in _whole_runs(batches, "token"):
        token, name, root, n = (table.column(c).to_numpy() for c in ("token", "id", "root", "n"))
        edges = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        lengths = np.diff(edges)
        end = np.repeat(edges[1:], lengths)
        short = np.flatnonzero(np.repeat(lengths <= LONG, lengths))
        for step in range(1, LONG):
            short = short[short + step < end[short]]
            if not len(short):
                break
            yield pairs(short, short + step)
        for k in np.flatnonzero(lengths > LONG):
            run = np.arange(edges[k], edges[k + 1])
            _, group, sizes = np.unique(root[run], return_inverse=True, return_counts=True)
            others = run[group != sizes.argmax()]
            if len(others) > LONG:
                yield row(name[run], name[run], np.ones(len(run), np.int64))
                continue
            for i in others:  # a pair of two others once
                yield pairs(*(x[(group[run - run[0]] == sizes.argmax()) | (run > i)] for x in (np.full(len(run), i), run)))


def _unmet(marks: DataFrame, classes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """id and root of the classes that may be similar to one with another root.

    ``marks`` has the rare prefixes (token, id, n).  Few tokens stand in two prefixes; only the
    rows of those are told their roots.  Pairs that have enough of them in common are held
    against each other by their spreads; neither rules out a similar pair.
    """

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_runs(batches, "token"):
            token, name, n = (table.column(c).to_numpy() for c in ("token", "id", "n"))
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (name[1:] != name[:-1])])  # copies come together
            at = np.flatnonzero(new)
            near = (token[at[1:]] == token[at[:-1]]) & (n[at[:-1]] >= similarity * n[at[1:]] - 1e-6)
            partner = np.concatenate([[False], near]) | np.concatenate([near, [False]])
            yield from table.take(pa.array(at[partner])).to_batches()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _meetings(batches, similarity)

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            one, other = (np.stack(_packed(batch, c, "u1")) for c in ("spread", "spread_v"))
            good = _within(one, other, batch.column("n").to_numpy(), batch.column("n_v").to_numpy(), similarity)[0]
            found = np.concatenate([batch.column(c).to_numpy()[good] for c in "uv"])
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["id"])

    named = roots.withColumnRenamed("u", "id")
    rooted = F.coalesce("root", "id").alias("root")
    shared = marks.repartition("token").sortWithinPartitions("token", "n", "id").mapInArrow(common, "token long, id long, n long")
    told = staged(shared, "shared").join(named, "id", "left").select("token", "id", "n", rooted)
    met = told.repartition("token").sortWithinPartitions("token").mapInArrow(meet, "u long, v long, need long")
    met = staged(met.groupBy("u", "v").agg(F.count("*").alias("common"), F.min("need").alias("need")).where("common >= need"), "met")
    own = classes.select(F.col("id").alias("u"), "n", "spread")
    other = classes.select(F.col("id").alias("v"), F.col("n").alias("n_v"), F.col("spread").alias("spread_v"))
    single = met.where("u <> v").join(own, "u").join(other, "v").mapInArrow(allowed, "id long")
    found = single.unionByName(met.where("u = v").select(F.col("u").alias("id"))).distinct()
    return found.join(named, "id", "left").select("id", rooted)


def similar_documents(
    docs: DataFrame, similarity: float = SIMILARITY, words: int = SIMILAR_WORDS, radius: int = SIMILAR_RADIUS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id and component_id of every row, linked where shingle sets resemble each other.

    Two texts link if the Jaccard similarity of their shingle sets is ``similarity`` or more.
    Sets of such similarity differ in size by that factor at most, so classes meet in bands of
    size (``_banded``), and there every fingerprint is held against every other: at this
    radius the bounds of a vantage-point tree rule out nothing.  Of the pairs whose
    fingerprints differ in at most ``radius`` bits (or whose sets are small) those are
    candidates whose sketches give ``MARGIN`` less than the similarity; only classes in one of
    them have their sets made and sent, and a link needs the sets themselves.

    Fingerprints and sketches can miss a pair.  So classes that this leaves apart meet again
    by their rarest shingles, of which similar sets have some in common (``_unmet``), and those
    that sizes and spreads allow have their sets compared too: no pair is lost.  Empty texts
    are one class; null ids and repeated rows as in ``near_duplicates``.
    """
    look = "row long, doc_id long, id long, fp long, n long, sketch binary, spread binary, block long, tally binary"
    floor = similarity - MARGIN

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Portraits, and at the end how often shingles fell into each bucket."""
        schema, tally = arrow_schema(look), np.zeros(1 << TALLY_BITS, np.uint32)
        for batch in slices(batches, 256):
            sets = [shingle_set(list(shingle_digests(t, words))) for t in batch.column("text").to_pylist()]
            tally += np.bincount(np.concatenate(sets) >> np.uint64(64 - TALLY_BITS), minlength=len(tally)).astype(np.uint32)
            found = [_portrait(x) for x in sets]
            short = [(*p[:3], np.frombuffer(p[3], "<u4").astype("u1").tobytes(), spread(x).tobytes()) for p, x in zip(found, sets)]  # the lowest bytes
            columns = [batch.column("row"), batch.column("doc_id"), *zip(*short), *2 * [[None] * len(found)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        for k, block in enumerate(tally.reshape(-1, TALLY_ROWS)):
            columns = [*7 * [[None]], [k], [block.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Levels of the buckets, eight to a doubling of their counts."""
        sums = {}
        for batch in batches:
            for k, counts in zip(batch.column("block").to_pylist(), _packed(batch, "tally", "u4")):
                sums[k] = sums.get(k, 0) + counts.astype(np.int64)
        found = [np.minimum(255, 8 * np.log2(1 + x)).astype("u1").tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int64()), pa.array(found, pa.binary())], names=["block", "tally"])

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            sets = [shingle_set(list(shingle_digests(t, words))) for t in batch.column("text").to_pylist()]
            found = [rare_prefix(x, levels, similarity) for x in sets]
            lengths = [len(x) for x in found]
            columns = [np.concatenate(found).view(np.int64), np.repeat([_class(x) for x in sets], lengths), np.repeat([len(x) for x in sets], lengths)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["token", "id", "n"])

    def linked(wanted: DataFrame, candidates: Callable) -> DataFrame:
        """(u, v) of similar classes among those wanted, whose sets are made for it."""
        wanted = staged(wanted, "wanted")
        picked = texts.select("row", "text")
        if wanted.count() <= PICKED_ROWS:
            picked = picked.join(F.broadcast(wanted.select("row")), "row", "left_semi")
        kept = [f for f in wanted.schema if f.name != "row"]
        kinds = ", ".join(f"{f.name} {'binary' if f.dataType.typeName() == 'binary' else 'long'}" for f in kept) + ", hashes binary"
        names = [f.name for f in kept]

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 256):
                hashes = [shingle_set(list(shingle_digests(t, words))).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(hashes, pa.binary())], schema=arrow_schema(kinds))

        sets = staged(wanted.join(picked, "row").mapInArrow(gather, kinds), "sets")
        dealt = _banded(sets, similarity, SET_BANDS)
        meet = partial(_similar_links, candidates=candidates, similarity=similarity)
        return scan(dealt.where("home").drop("home"), dealt.drop("home"), SET_CHUNK_ROWS, "id", meet, "u long, v long")

    texts = keyed_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = staged(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    drawn = staged(texts.mapInArrow(describe, look), "portraits")
    marked = drawn.where("block IS NULL").drop("block", "tally")
    # All rows of a class have the same set, so any of them will do.
    classes = marked.groupBy("id").agg(F.min("doc_id").alias("least"), *(F.min(c).alias(c) for c in ("row", "fp", "n", "sketch", "spread")))
    classes = staged(classes, "classes")
    dealt = _banded(classes.drop("least", "row", "spread"), similarity, SKETCH_BANDS)
    meet = partial(_paired, radius=radius, floor=floor, similarity=similarity)
    paired = staged(scan(dealt.where("home").drop("home"), dealt.drop("home"), SKETCH_CHUNK_ROWS, "id", meet, "id long").distinct(), "paired")
    near = linked(classes.drop("least", "spread").join(paired, "id"), partial(_candidates, radius=radius, floor=floor, similarity=similarity))
    roots = connected(near)
    tallies = drawn.where("block IS NOT NULL").select("block", "tally").repartition("block")
    levels = np.zeros(1 << TALLY_BITS, np.uint8)
    for k, block in tallies.mapInArrow(added, "block long, tally binary").collect():
        levels[k * TALLY_ROWS : (k + 1) * TALLY_ROWS] = np.frombuffer(block, np.uint8)
    marks = texts.mapInArrow(prefixes, "token long, id long, n long")
    unmet = staged(_unmet(marks, classes, roots, similarity), "unmet")
    if not unmet.isEmpty():
        more = linked(classes.select("id", "row", "n", "spread").join(unmet, "id"), partial(_possible, similarity=similarity))
        roots = connected(more.unionByName(roots.select("u", F.col("root").alias("v"))))
    roots = roots.withColumnRenamed("u", "id")
    rooted = classes.select("id", "least").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.select("doc_id", "id").join(rooted.select("id", "root").join(named, "root").drop("root"), "id").select("doc_id", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` (all their columns) without those whose component of similar
    documents has a smaller id.  Rows that share an id stay or go together; rows without one
    stay."""
    found = similar_documents(docs, id_col=id_col, **options)
    copies = staged(found.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct(), "copies")
    return docs.join(copies, id_col, "left_anti")
