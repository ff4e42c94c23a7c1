"""Offset-mapped attribution: tokens of whole documents, counted for fields and sections.

A document is encoded once, as one text, so the tokens are those a model sees.  Each token's
character span is joined with the sections' intervals; a token that crosses a boundary is
allocated by a stated rule:

* ``most``: to the section that holds most of its characters, the earlier one on a tie;
* ``first``: to the section that holds its first character;
* ``split``: to all of them in proportion to its characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, slices
from .tokens import encoder

RULES = ("most", "first", "split")
COUNTED = "doc_id long, section int, name string, start long, end long, tokens double, crossing long"


def fields_as_sections(fields: dict[str, Column], separator: str = "\n") -> tuple[Column, Column]:
    """(text, sections) of a document made of fields; a separator belongs to the field before
    it, a null field is empty."""
    names = list(fields)
    parts = [F.coalesce(fields[n].cast("string"), F.lit("")) for n in names]
    parts = [p if k == len(parts) - 1 else F.concat(p, F.lit(separator)) for k, p in enumerate(parts)]
    at, sections = F.lit(0), []
    for name, part in zip(names, parts):
        end = at + F.length(part)
        sections.append(F.struct(F.lit(name).alias("name"), at.cast("long").alias("start"), end.cast("long").alias("end")))
        at = end
    return F.concat(*parts), F.array(*sections)


def allot(starts: np.ndarray, ends: np.ndarray, edges: list[tuple[int, int]], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of each section (sorted, disjoint intervals)."""
    a = np.array([e[0] for e in edges], np.int64)
    b = np.maximum(a, np.array([e[1] for e in edges], np.int64))
    # Starts and ends never fall, so the tokens that touch a section are a range.
    first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
    last = np.where(b > a, last, first)
    cuts = np.concatenate([a[b > a], b[b > a]])
    cuts = cuts[cuts < (ends[-1] if len(ends) else 0)]
    inside = np.searchsorted(ends, cuts, "right")
    across = np.unique(inside[starts[inside] < cuts])
    tokens, crossing = (last - first).astype(float), np.zeros(len(a), np.int64)
    for t in across:
        touched = [k for k in range(len(a)) if first[k] <= t < last[k]]
        share = np.array([min(ends[t], b[k]) - max(starts[t], a[k]) for k in touched], float)
        for k in touched:
            tokens[k] -= 1
            crossing[k] += 1
        if rule == "split":
            for k, s in zip(touched, share):
                tokens[k] += s / (ends[t] - starts[t])
        elif rule == "most":
            tokens[touched[int(np.argmax(share))]] += 1
        elif rule == "first":
            for k in touched:
                if a[k] <= starts[t] < b[k]:
                    tokens[k] += 1
    return tokens, crossing


def attribute(
    docs: DataFrame, text: Column, sections: Column, path: str, rule: str = "most", id_col: str = "doc_id"
) -> DataFrame:
    """One row per document and section: tokens allotted to it, and how many cross its edges.

    ``sections`` is an array of (name, start, end) in code points; they may leave gaps but
    must not overlap.  With ``most`` and ``first`` the sections that cover a text add up to
    its tokens; what lies in a gap is counted nowhere.  A null text is empty, null sections
    give no rows, an empty section counts 0, repeated rows are counted each.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, schema = encoder(path), arrow_schema(COUNTED)
        for batch in slices(batches, 256):
            rows = {f.name: [] for f in schema}
            for row in batch.to_pylist():
                own = sorted((s for s in row["sections"] or () if s), key=lambda s: (s["start"], s["end"]))
                if not own:
                    continue
                starts, ends = coder.spans(row["text"] or "")
                tokens, crossing = allot(starts, ends, [(s["start"], s["end"]) for s in own], rule)
                for k, s in enumerate(own):
                    values = (row["doc_id"], k, s["name"], s["start"], s["end"], float(tokens[k]), int(crossing[k]))
                    for column, value in zip(rows.values(), values):
                        column.append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), sections.alias("sections"))
    return rows.mapInArrow(run, COUNTED)
