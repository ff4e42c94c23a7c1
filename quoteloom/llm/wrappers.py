"""Main text of pages by wrappers: union-free regular expressions inferred per host.

A wrapper is a tree of fields, one per label under its parent.  The token streams of a host's
pages are aligned with it one after the other, level by level, and every mismatch makes it
more general: a label that the wrapper lacks, or the page, becomes optional; one that comes
again becomes a repeated group, together with all that stood in between; texts that differ
make the place a slot.  Labels stand once under a parent, so the expression needs no union,
and wrappers of parts of a host's pages merge into the same wrapper whatever their order.

The task that reads pages folds them into one wrapper per host, so that wrappers, not pages,
are shuffled for the inference.  A finished wrapper names the field that holds the article.
For the extraction, pages go to their host's wrapper in cells of a bounded share, and are
read through it field by field.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, slices, staged
from .markup import CLOSE, OPEN, tokens

SAME_ELEMENT = 48  # labels of one element under one parent; further ones share a field
HEAVY = 12  # counters for texts that stand in many pages
HELD_FIELDS = 300_000  # fields that a folding task holds before it emits its wrappers
CELL_PAGES = 256
HOT_HOSTS = 100_000  # at most so many hosts are salted; the others have few pages each
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.6, 4
MAIN_SHARE, DESCENT_SHARE, LINKED_SHARE = 0.4, 0.6, 0.6

FOLDED = "host string, pages long, wrapper string"
EXTRACTED = "page_id long, url string, text string"
_CONTAINERS = frozenset("html body div section center table tbody tr td main article form".split())


class Field:
    """What all occurrences of a label under one parent field have in common."""

    __slots__ = ("parents", "times", "order", "kids", "groups", "chars", "linked", "blocks", "heavy")

    def __init__(self):
        self.parents = self.times = self.order = self.chars = self.linked = self.blocks = 0
        self.kids: dict[str, Field] = {}
        self.groups: list[set[str]] = []
        self.heavy: dict[str, int] = {}

    def kid(self, label: str) -> tuple[str, Field]:
        """The field of a label, made if need be."""
        found = self.kids.get(label)
        if found is not None:
            return label, found
        element = label.split(".")[0]
        if element != label and sum(k.split(".")[0] == element for k in self.kids) >= SAME_ELEMENT:
            label = f"{element}.~"
        return label, self.kids.setdefault(label, Field())

    def known(self, label: str) -> Field | None:
        return self.kids.get(label) or self.kids.get(f"{label.split('.')[0]}.~")

    def group(self, labels: set[str]) -> None:
        apart = [g for g in self.groups if not g & labels]
        self.groups = [*apart, labels.union(*(g for g in self.groups if g & labels))]

    def count_text(self, key: str, n: int = 1) -> None:
        """Misra-Gries: what stands in more than one in HEAVY of the blocks is never lost."""
        if key in self.heavy or len(self.heavy) < HEAVY:
            self.heavy[key] = self.heavy.get(key, 0) + n
            return
        least = min(n, *self.heavy.values())
        self.heavy = {k: c - least for k, c in self.heavy.items() if c > least}
        if n > least:
            self.heavy[key] = n - least

    def merge(self, other: Field) -> None:
        for name in ("parents", "times", "order", "chars", "linked", "blocks"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        for labels in other.groups:
            self.group(labels)
        for key, n in sorted(other.heavy.items()):
            self.count_text(key, n)
        for label, kid in other.kids.items():
            self.kid(label)[1].merge(kid)

    def packed(self) -> list:
        numbers = [self.parents, self.times, self.order, self.chars, self.linked, self.blocks]
        return [numbers, {k: f.packed() for k, f in self.kids.items()}, [sorted(g) for g in self.groups], self.heavy]

    @staticmethod
    def unpacked(given: list) -> Field:
        field = Field()
        field.parents, field.times, field.order, field.chars, field.linked, field.blocks = given[0]
        field.kids = {k: Field.unpacked(f) for k, f in given[1].items()}
        field.groups, field.heavy = [set(g) for g in given[2]], given[3]
        return field

    def size(self) -> int:
        return 1 + sum(k.size() for k in self.kids.values())


def text_key(text: str) -> str:
    return blake2b(text.encode(), digest_size=6).hexdigest()


class _Frame:
    """One open element while it is aligned: the fields met so far, in order, repeats joined."""

    __slots__ = ("field", "cells", "where", "counts")

    def __init__(self, field: Field):
        self.field, self.cells, self.where, self.counts = field, [], {}, {}

    def meet(self, label: str) -> Field:
        label, kid = self.field.kid(label)
        at = self.where.get(label)
        if at is None:
            at = self.where[label] = len(self.cells)
            self.cells.append({label})
        elif at < len(self.cells) - 1:
            for cell in self.cells[at + 1 :]:
                self.cells[at] |= cell
            del self.cells[at + 1 :]
            for met in self.cells[at]:
                self.where[met] = at
        if label not in self.counts:
            self.counts[label] = 0
            kid.parents += 1
        self.counts[label] += 1
        kid.times += 1
        kid.order += at
        return kid

    def done(self) -> None:
        for cell in self.cells:
            if len(cell) > 1:
                self.field.group(set(cell))


def align(wrapper: Field, page: Iterable[tuple]) -> None:
    """Make ``wrapper`` general enough for one more page."""
    wrapper.times += 1
    frames = [_Frame(wrapper)]
    texts: set[tuple[int, str]] = set()
    for token in page:
        if token[0] == OPEN:
            frames.append(_Frame(frames[-1].meet(token[1])))
        elif token[0] == CLOSE:
            frames.pop().done()
        else:
            slot = frames[-1].meet("#")
            slot.chars += len(token[1])
            slot.linked += token[2]
            slot.blocks += 1
            key = text_key(token[1])
            if (id(slot), key) not in texts:  # once a page: a text that fills one page isn't the host's
                texts.add((id(slot), key))
                slot.count_text(key)
    while frames:
        frames.pop().done()


def expression(field: Field, label: str = "") -> str:
    """The wrapper as a union-free regular expression; ``#`` is a text slot."""
    place = lambda k: (field.kids[k].order / max(1, field.kids[k].times), k)
    done, parts = set(), []
    for k in sorted(field.kids, key=place):
        if k in done:
            continue
        members = next((g for g in field.groups if k in g), {k})
        inner = []
        for m in sorted(members & field.kids.keys(), key=place):
            kid = field.kids[m]
            many = kid.times > kid.parents and len(members) == 1
            inner.append(expression(kid, m) + ("+" if many else "") + ("?" if kid.parents < field.times or len(members) > 1 else ""))
        done |= members
        parts.append(f"({' '.join(inner)})+" if len(members) > 1 else inner[0])
    body = " ".join(parts)
    return f"{label}({body})" if label and field.kids else label or body


# -- the article's field ---------------------------------------------------------------


def _texts(field: Field, label: str = "") -> int:
    """Characters outside links in what may be shown, less those of texts that all pages share."""
    if "!" in label:
        return 0
    if label == "#":
        fixed = field.blocks and any(_fixed(field, c) for c in field.heavy.values())
        return 0 if fixed and len(field.heavy) == 1 else max(0, field.chars - field.linked)
    return sum(_texts(kid, k) for k, kid in field.kids.items())


def _fixed(slot: Field, count: int) -> bool:
    return slot.parents >= TEMPLATE_PAGES and count >= TEMPLATE_SHARE * slot.parents


def _ranked(field: Field, rank: int, path: tuple = ()) -> list[tuple]:
    found = []
    for label, kid in field.kids.items():
        if "!" in label or label == "#":
            continue
        here = label.split(".")[0].count("*") >= rank
        found += [(*path, label)] if here else _ranked(kid, rank, (*path, label))
    return found


def _at(field: Field, path: tuple) -> Field:
    for label in path:
        field = field.kids[label]
    return field


def article_paths(wrapper: Field) -> tuple[list[tuple], bool]:
    """Paths of the fields that hold the article, and whether the pages name it themselves.

    The strongest name that covers a good share of the host's text counts; without one, the
    deepest container that still holds most of what its parent holds.
    """
    whole = _texts(wrapper)
    for rank in (3, 2, 1):
        paths = _ranked(wrapper, rank)
        if paths and sum(_texts(_at(wrapper, p), p[-1]) for p in paths) >= MAIN_SHARE * whole:
            return paths, True
    field, path = wrapper, ()
    while True:
        share = _texts(field, path[-1] if path else "")
        best = max(field.kids.items(), key=lambda kid: (_texts(kid[1], kid[0]), kid[0]), default=None)
        if best is None or not share or best[0].split(".")[0].rstrip("*") not in _CONTAINERS:
            return [path], False
        if _texts(best[1], best[0]) < DESCENT_SHARE * share or best[1].times > 1.5 * best[1].parents:
            return [path], False
        field, path = best[1], (*path, best[0])


class Reader:
    """A finished wrapper, ready to read pages of its host."""

    def __init__(self, wrapper: Field):
        self.wrapper = wrapper
        self.paths, self.named = article_paths(wrapper)
        self.roots = {id(_at(wrapper, p)) for p in self.paths}

    def boilerplate(self, slot: Field, text: str, linked: int) -> bool:
        """Only where the pages don't name their article: texts of the template, and menus."""
        if self.named:
            return False
        return linked > LINKED_SHARE * len(text) or _fixed(slot, slot.heavy.get(text_key(text), 0))

    def read(self, page: list[tuple]) -> list[str]:
        """The article's blocks.  A page without the field is read whole, less what any page
        of the host leaves out."""
        blocks = self._read(page, self.roots)
        return blocks or self._read(page, {id(self.wrapper)})

    def _read(self, page: list[tuple], roots: set[int]) -> list[str]:
        blocks: list[str] = []
        fields, inside = [self.wrapper], [id(self.wrapper) in roots]
        for token in page:
            here = fields[-1]
            if token[0] == OPEN:
                kid = here.known(token[1]) if here is not None else None
                fields.append(kid)
                inside.append("!" not in token[1] and (inside[-1] or id(kid) in roots))
            elif token[0] == CLOSE:
                fields.pop()
                inside.pop()
            elif inside[-1]:
                slot = here.known("#") if here is not None else None
                if slot is None or not self.boilerplate(slot, token[1], token[2]):
                    blocks.append(token[1])
        return blocks


# -- jobs ------------------------------------------------------------------------------


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.lower("url"), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.select(
        F.coalesce(host, F.lit("")).alias("host"), F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, held, size = arrow_schema(FOLDED), {}, 0

    def emit():
        for host, wrapper in held.items():
            yield _rows(schema, [(host, wrapper.times, json.dumps(wrapper.packed()))])
        held.clear()

    for batch in slices(batches, 64):
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            wrapper = held.get(host)
            if wrapper is None:
                wrapper = held[host] = Field()
                size += 60
            align(wrapper, tokens(html))
        if size > HELD_FIELDS:
            size = sum(w.size() for w in held.values())
            if size > HELD_FIELDS:
                yield from emit()
                size = 0
    yield from emit()


def _fold_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by host; one wrapper is held."""
    schema, at, wrapper = arrow_schema(FOLDED), None, None
    for batch in slices(batches, 256):
        for host, given in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            if host != at:
                if wrapper is not None:
                    yield _rows(schema, [(at, wrapper.times, json.dumps(wrapper.packed()))])
                at, wrapper = host, Field()
            wrapper.merge(Field.unpacked(json.loads(given)))
    if wrapper is not None:
        yield _rows(schema, [(at, wrapper.times, json.dumps(wrapper.packed()))])


def infer(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper): one wrapper per host, from all its pages.

    Folded where the pages are read; the parts of a host, one or a few a task, merge in two
    steps, so that even a host of every task gives each merging task a bounded share.
    """
    parts = _hosted(pages).select("host", "html").mapInArrow(_fold_pages, FOLDED)
    parts = staged(parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(64))), "wrapper-parts")
    some = parts.repartition("host", "salt").sortWithinPartitions("host", "wrapper").select("host", "pages", "wrapper")
    whole = some.mapInArrow(_fold_wrappers, FOLDED).repartition("host").sortWithinPartitions("host", "wrapper")
    return staged(whole.mapInArrow(_fold_wrappers, FOLDED), "wrappers")


def _read_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell, its wrapper first; one wrapper is held."""
    schema, at, reader = arrow_schema(EXTRACTED), None, None
    for batch in slices(batches, 64):
        rows = []
        for host, page_id, url, html, wrapper in zip(*(batch.column(c).to_pylist() for c in ("host", "page_id", "url", "html", "wrapper"))):
            if wrapper is not None:
                if at != host:
                    at, reader = host, Reader(Field.unpacked(json.loads(wrapper)))
                continue
            rows.append((page_id, url, "\n".join(reader.read(tokens(html)))))
        if rows:
            yield _rows(schema, rows)


def extract(pages: DataFrame, wrappers: DataFrame | None = None, cell_pages: int = CELL_PAGES) -> DataFrame:
    """(page_id, url, text): the article of every page, its blocks joined by newlines.

    Left out are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and readers' comments; nothing else is, so a text that stands in many articles stays in all.
    A null html counts as empty and gives an empty text, pages without a host share one
    wrapper, repeated rows give repeated rows, an empty table gives none, other columns are not
    read.  ``wrappers`` are those of ``infer`` over the same pages, made here if not given.
    Hosts with many pages are dealt over cells of about ``cell_pages``; a task holds one
    wrapper and one batch of pages.
    """
    wrappers = infer(pages) if wrappers is None else wrappers
    total = wrappers.agg(F.sum("pages")).first()[0] or 0
    often = max(cell_pages, total // HOT_HOSTS)
    cells = F.ceil(F.col("pages") / cell_pages).cast("int")
    hot = F.broadcast(wrappers.where(F.col("pages") > often).select("host", cells.alias("cells")))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.col("cells")).cast("int")
    dealt = _hosted(pages).join(hot, "host", "left").withColumn("salt", F.coalesce(salt, F.lit(0))).drop("cells")
    copies = F.when(F.col("pages") > often, F.sequence(F.lit(0), cells - 1)).otherwise(F.array(F.lit(0)))
    first = wrappers.select("host", "wrapper", F.explode(copies).alias("salt"))
    both = dealt.unionByName(first, allowMissingColumns=True).repartition("host", "salt")
    ordered = both.sortWithinPartitions("host", "salt", F.col("wrapper").isNull())
    return ordered.select("host", "page_id", "url", "html", "wrapper").mapInArrow(_read_cells, EXTRACTED)
