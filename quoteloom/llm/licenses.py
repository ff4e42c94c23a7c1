"""License scans by ordered signature rules.

A text is reduced to its words (letters a-z after lower-casing A-Z, digits, and everything
beyond ASCII), joined by blanks, so rules are regular expressions over words.  A rule names
the phrases of which each of its matches has one, and is tried only where one of them stands
in the text.  Detections are taken by priority, and one that lies inside the interval of a
better one is suppressed: the general public license inside "lesser general public license
version 3" is no finding of its own.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, keyed_texts, slices
from .signatures import NAMES, TEXTS

# Phrases whose labels always stand, suppressed or not.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

V = r"(?:version |v)?"
GPL = r"(?:gnu )?(?:general public licen[cs]e|gpl)"
LGPL = r"(?:gnu )?(?:lesser general public licen[cs]e|library general public licen[cs]e|lgpl)"
AGPL = r"(?:gnu )?(?:affero general public licen[cs]e|affero gpl|agpl)"
FDL = r"(?:gnu )?(?:free documentation licen[cs]e|gfdl|gnu fdl)"
CC = r"(?:creative commons|cc) "
BY, NC, SA, ND = r"(?:by|attribution)", r" (?:nc|non ?commercial)", r" (?:sa|share ?alike)", r" (?:nd|no ?deriv(?:ative)?s?(?: works)?)"
L = r" (?:public )?licen[cs]e"
CC_GATE = "cc by|cc attribution|creative commons|creativecommons"
NC_GATE = " & nc|noncommercial|non commercial"
SA_GATE = " & sa|sharealike|share alike"
ND_GATE = " & nd|no|noderiv|noderivs|noderivative|noderivatives"

# (label, SPDX identifier in words, name, address in words, gate), the more specific before
# the more general.  A gate lists phrases (whole words); where " & " joins several lists, a
# match has a phrase of each.
FAMILIES = (
    ("agpl-3", r"agpl 3 0", rf"{AGPL} {V}3(?: 0)?", r"gnu org licenses agpl 3 0", "agpl|affero"),
    ("agpl-1", r"agpl 1 0", rf"{AGPL} {V}1(?: 0)?", r"affero org oagpl", "agpl|affero"),
    ("agpl", r"agpl", AGPL, r"gnu org licenses agpl", "agpl|affero"),
    ("lgpl-3", r"lgpl 3 0", rf"{LGPL} {V}3(?: 0)?", r"gnu org licenses lgpl 3 0", "lgpl|lesser|library general public"),
    ("lgpl-2.1", r"lgpl 2 1", rf"{LGPL} {V}2 1", r"gnu org licenses (?:old licenses )?lgpl 2 1", "lgpl|lesser|library general public"),
    ("lgpl-2", r"lgpl 2 0", rf"{LGPL} {V}2(?: 0)?", r"gnu org licenses old licenses lgpl 2 0", "lgpl|lesser|library general public"),
    ("lgpl", r"lgpl", LGPL, r"gnu org (?:licenses|copyleft) lesser", "lgpl|lesser|library general public"),
    ("gpl-3", r"gpl 3 0", rf"{GPL} {V}3(?: 0)?", r"gnu org licenses gpl 3 0", "gpl|general public"),
    ("gpl-2", r"gpl 2 0", rf"{GPL} {V}2(?: 0)?", r"gnu org licenses (?:old licenses )?gpl 2 0", "gpl|general public"),
    ("gpl-1", r"gpl 1 0", rf"{GPL} {V}1(?: 0)?", r"gnu org licenses old licenses gpl 1 0", "gpl|general public"),
    ("gpl", r"gpl", GPL, r"gnu org (?:licenses|copyleft) gpl", "gpl|general public"),
    ("gfdl-1.3", r"gfdl 1 3", rf"{FDL} {V}1 3", r"gnu org licenses fdl 1 3", "gfdl|fdl|free documentation"),
    ("gfdl-1.2", r"gfdl 1 2", rf"{FDL} {V}1 2", r"gnu org licenses old licenses fdl 1 2", "gfdl|fdl|free documentation"),
    ("gfdl", r"gfdl", FDL, r"gnu org (?:licenses|copyleft) fdl", "gfdl|fdl|free documentation"),
    ("apache-2", r"apache 2 0", rf"(?:asf|apache)(?: software)?(?:{L})? {V}2(?: 0)?", r"apache org licenses license 2 0", "apache|asf"),
    ("apache-1.1", r"apache 1 1", rf"apache(?: software)?(?:{L})? {V}1 1", r"apache org licenses license 1 1", "apache|asf"),
    ("apache-1", r"apache 1 0", rf"apache(?: software)?(?:{L})? {V}1(?: 0)?", r"apache org licenses license 1 0", "apache|asf"),
    ("apache", r"apache", rf"apache(?: software)?{L}", r"apache org licenses", "apache|asf"),
    ("mit-0", r"mit 0", r"mit (?:no attribution|0)(?: licen[cs]e)?", r"opensource org licenses? mit 0", "mit|expat"),
    ("mit", r"mit", r"(?:mit|expat)(?: x11)? licen[cs]e", r"opensource org licenses? mit", "mit|expat"),
    ("x11", r"x11", r"x11 licen[cs]e", r"opensource org licenses? x11", "x11"),
    ("bsd-4-clause", r"bsd 4 clause", r"(?:4|four) clause bsd(?: licen[cs]e)?|bsd 4 clause(?: licen[cs]e)?|original bsd licen[cs]e", r"spdx org licenses bsd 4 clause", "bsd|freebsd"),
    ("bsd-3-clause", r"bsd 3 clause", r"(?:3|three) clause bsd(?: licen[cs]e)?|bsd 3 clause(?: licen[cs]e)?|(?:new|revised|modified) bsd licen[cs]e", r"opensource org licenses? bsd 3 clause", "bsd|freebsd"),
    ("bsd-2-clause", r"bsd 2 clause", r"(?:2|two) clause bsd(?: licen[cs]e)?|bsd 2 clause(?: licen[cs]e)?|simplified bsd licen[cs]e|freebsd licen[cs]e", r"opensource org licenses? bsd 2 clause", "bsd|freebsd"),
    ("0bsd", r"0bsd", r"(?:zero|0) clause bsd(?: licen[cs]e)?|0bsd", r"opensource org licenses? 0bsd", "0bsd|bsd"),
    ("bsd", r"bsd", r"bsd(?: style)? licen[cs]e", r"opensource org licenses? bsd", "bsd|freebsd"),
    ("isc", r"isc", r"isc licen[cs]e", r"opensource org licenses? isc", "isc"),
    ("mpl-2", r"mpl 2 0", rf"(?:mozilla{L}|mpl) {V}2(?: 0)?", r"mozilla org mpl 2 0", "mpl|mozilla"),
    ("mpl-1.1", r"mpl 1 1", rf"(?:mozilla{L}|mpl) {V}1 1", r"mozilla org mpl 1 1", "mpl|mozilla"),
    ("mpl", r"mpl", rf"mozilla{L}", r"mozilla org mpl", "mpl|mozilla"),
    ("epl-2", r"epl 2 0", rf"(?:eclipse{L}|epl) {V}2(?: 0)?", r"eclipse org legal epl 2 0", "epl|eclipse"),
    ("epl-1", r"epl 1 0", rf"(?:eclipse{L}|epl) {V}1(?: 0)?", r"eclipse org legal epl v10", "epl|eclipse"),
    ("epl", r"epl", rf"eclipse{L}", r"eclipse org legal epl", "epl|eclipse"),
    ("eupl-1.2", r"eupl 1 2", rf"(?:european union{L}|eupl) {V}1 2", r"joinup ec europa eu .{0,60}eupl", "eupl|european union|joinup"),
    ("eupl", r"eupl 1 1", rf"european union{L}", r"joinup ec europa eu software page eupl", "eupl|european union|joinup"),
    ("cddl-1", r"cddl 1 [01]", rf"(?:common development and distribution{L}|cddl)(?: {V}1 [01])?", r"opensource org licenses? cddl", "cddl|common development"),
    ("cpl-1", r"cpl 1 0", rf"common{L} {V}1 0", r"opensource org licenses? cpl1 0", "cpl|cpl1|common public|common license|common licence"),
    ("artistic-2", r"artistic 2 0", rf"artistic{L} {V}2(?: 0)?", r"opensource org licenses? artistic 2 0", "artistic"),
    ("artistic", r"artistic 1 0", rf"artistic{L}", r"opensource org licenses? artistic", "artistic"),
    ("bsl-1", r"bsl 1 0", rf"boost software{L}(?: {V}1 0)?", r"boost org license 1 0", "bsl|boost"),
    ("busl-1.1", r"busl 1 1", rf"business source{L}(?: {V}1 1)?", r"mariadb com bsl11", "busl|business source|bsl11"),
    ("sspl-1", r"sspl 1 0", rf"server side{L}(?: {V}1)?|sspl", r"mongodb com licensing server side public license", "sspl|server side"),
    ("elastic-2", r"elastic 2 0", rf"elastic{L} {V}2(?: 0)?", r"elastic co licensing elastic license", "elastic"),
    ("unlicense", r"unlicense", r"the unlicense|unlicense", r"unlicense org", "unlicense"),
    ("wtfpl", r"wtfpl", rf"wtfpl|do what the fuck you want to{L}", r"wtfpl net", "wtfpl|the fuck"),
    ("zlib", r"zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib net zlib license", "zlib"),
    ("libpng", r"libpng", r"(?:libpng|png reference library) licen[cs]e", r"libpng org .{0,30}license", "libpng|png reference"),
    ("openssl", r"openssl", r"openssl licen[cs]e", r"openssl org source license", "openssl"),
    ("python-2", r"python 2 0", rf"python software foundation{L}(?: {V}2)?|psf licen[cs]e", r"docs python org 3 license", "python|psf"),
    ("ruby", r"ruby", r"ruby licen[cs]e", r"ruby lang org en about license", "ruby"),
    ("php-3", r"php 3 01?", rf"php{L}(?: {V}3 01?)?", r"php net license", "php"),
    ("postgresql", r"postgresql", r"postgresql licen[cs]e", r"postgresql org about licence", "postgresql"),
    ("ofl-1.1", r"ofl 1 1", rf"(?:sil )?open font{L}(?: {V}1 1)?", r"(?:scripts sil|openfontlicense) org", "ofl|open font|sil org|openfontlicense"),
    ("odbl-1", r"odbl 1 0", rf"open (?:data ?commons )?(?:open )?database{L}(?: {V}1 0)?|odbl", r"opendatacommons org licenses odbl", "odbl|database"),
    ("odc-by-1", r"odc by 1 0", rf"open data commons attribution{L}|odc by", r"opendatacommons org licenses by", "odc by|commons attribution|opendatacommons"),
    ("pddl-1", r"pddl 1 0", rf"public domain dedication and{L}|pddl", r"opendatacommons org licenses pddl", "pddl|domain dedication"),
    ("openrail", r"(?:creativeml )?openrail m?", r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[cs]e)?", r"licenses ai", "openrail|open rail|licenses ai"),
    ("llama-community", r"llama(?: ?[23])?", r"llama (?:\d )?(?:\d )?community licen[cs]e", r"llama meta com license", "llama|llama2|llama3"),
    ("cc0-1", r"cc0 1 0", r"cc0(?: 1 0)?(?: universal)?|creative commons (?:zero|0)(?: 1 0)?", r"creativecommons org publicdomain zero", "cc0|creative commons|creativecommons"),
    *(
        (f"cc-by{tag}{'-' + version if version else ''}", f"cc by{tag.replace('-', ' ')}{' ' + version + ' 0' if version else ''}",
         f"{CC}{BY}{words}" + (rf" {V}{version} 0" if version else ""),
         f"creativecommons org licenses by{tag.replace('-', ' ')}" + (f" {version} 0" if version else ""),
         CC_GATE + also + (f" & {version} 0|v{version} 0" if version else ""))
        for tag, words, also in (("-nc-nd", NC + ND, NC_GATE + ND_GATE), ("-nc-sa", NC + SA, NC_GATE + SA_GATE), ("-nc", NC, NC_GATE), ("-nd", ND, ND_GATE), ("-sa", SA, SA_GATE), ("", "", ""))
        for version in ("4", "3", "2", "")
    ),
    ("public-domain", r"public domain", r"(?:released into|placed in|dedicated to|in) the public domain", r"creativecommons org publicdomain mark", "public domain|creativecommons"),
    ("proprietary", r"proprietary", r"all rights reserved|proprietary and confidential", r"proprietary license agreement", "proprietary|all rights reserved"),
)

# How a license is named: (template, confidence, gate beside the license's own), by priority.
TEMPLATES = (
    (r"spdx license identifier {spdx}(?: only| or later)?", 1.0, "spdx license identifier"),
    (r"spdx license identifier (?:\w+ ){{1,6}}(?:and|or|with) {spdx}(?: only| or later)?", 1.0, "spdx license identifier"),
    (r"(?:https? )?(?:www )?{url}", 0.95, ""),
    (r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared|redistributed) under (?:the )?(?:terms (?:and conditions )?of )?(?:an? |the )?(?:{name})", 0.9, "under"),
    (r"(?:licen[cs]e|copyright)(?: type)?(?: is)?(?: the)? (?:{name})", 0.8, "license|licence|copyright"),
    (r"(?:{name})", 0.6, ""),
)


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    gates: tuple[tuple[bytes, ...], ...]
    confidence: float
    pattern: re.Pattern


def _gates(*lists: str) -> tuple[tuple[bytes, ...], ...]:
    parts = [x for y in lists if y for x in y.split(" & ")]
    return tuple(tuple(f" {phrase} ".encode() for phrase in x.split("|")) for x in parts)


def rules() -> list[Rule]:
    """All rules in their order: what only whole texts of a license say, then names, a better
    template first and the more specific license first, then what is said in passing."""
    named = [
        (label, confidence, _gates(gate, also), template.format(spdx=spdx, name=name, url=url))
        for template, confidence, also in TEMPLATES
        for label, spdx, name, url, gate in FAMILIES
    ]
    # A rule that is a plain phrase is its own gate.
    written = [[(label, sure, _gates(gate or text), text) for label, sure, gate, text in x] for x in (TEXTS, NAMES)]
    return [
        Rule(at, label, gates, confidence, re.compile(f"(?<= )(?:{text})(?= )".encode()))
        for at, (label, confidence, gates, text) in enumerate([*written[0], *named, *written[1]])
    ]


def _triggers(found: list[Rule]) -> dict[bytes, list[int]]:
    """Rules by the words without which they can't match: of each phrase of the first gate the
    longest word, which is likely the rarest."""
    out: dict[bytes, list[int]] = {}
    for rule in found:
        for phrase in rule.gates[0]:
            out.setdefault(max(phrase.split(), key=len), []).append(rule.priority)
    return out


_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_BASE = [(re.compile(f"(?<= ){phrase}(?= )".encode()), label) for phrase, label in BASE.items()]
_RULES = rules()
_TRIGGERS = _triggers(_RULES)
_TRIGGER_WORDS = frozenset(_TRIGGERS)
FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


class _Kept:
    """Kept intervals by their start, with the furthest end up to each."""

    def __init__(self):
        self.spans, self.starts, self.ends = [], [], []

    def covers(self, start: int, end: int) -> bool:
        at = bisect.bisect_right(self.starts, start)
        return at > 0 and self.ends[at - 1] >= end

    def add(self, spans: list[tuple[int, int]]) -> None:
        self.spans = list(heapq.merge(self.spans, spans))
        self.starts = [a for a, _ in self.spans]
        self.ends = list(itertools.accumulate((b for _, b in self.spans), max))


def scan_text(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    words = (text or "").encode().translate(_WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    places, base = [], set()
    for pattern, label in _BASE:
        at, blanks = 0, 0
        for m in pattern.finditer(joined):
            blanks += joined.count(b" ", at, m.start())
            at = m.start()
            places.append(blanks - 1)
            base.add(label)
    kept, labels, score = _Kept(), set(base), 0.9 if base else 0.0
    present: dict[tuple[bytes, ...], bool] = {}
    tried = {at for word in _TRIGGER_WORDS.intersection(words) for at in _TRIGGERS[word]}
    for rule in map(_RULES.__getitem__, sorted(tried)):
        for phrases in rule.gates:
            hit = present.get(phrases)
            if hit is None:
                hit = present[phrases] = any(x in joined for x in phrases)
            if not hit:
                break
        else:
            # Matches of one rule don't overlap, so they are kept or suppressed together.
            fresh = [m.span() for m in rule.pattern.finditer(joined) if not kept.covers(*m.span())]
            if fresh:
                kept.add(fresh)
                labels.add(rule.label)
                score = max(score, rule.confidence)
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``; whole texts, where they are read, without a shuffle.

    n_base counts all places of the base phrases, first_word and last_word their smallest
    and largest word index; labels joins those with what the rules add; score is the best
    confidence.  A null or empty text has no words, no labels and score 0; null ids and
    repeated rows come back as they are, an empty table gives no rows, and other columns of
    ``docs`` take no part, whatever their names.
    """
    schema = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows = [scan_text(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), *zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    texts = keyed_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(run, FOUND)
