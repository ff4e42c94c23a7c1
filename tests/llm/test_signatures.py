"""Hand-written signatures: texts of licenses, versions, expressions, and gates that lose nothing."""

import random
import re

from quoteloom.llm import licenses, signatures

from .test_texts import branches

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."""
CASES = {
    MIT: "mit",
    "Redistributions of source code must retain the above copyright notice, this list of conditions": "bsd",
    "Neither the name of the X nor the names of its contributors may be used to endorse or promote products": "bsd-3-clause",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.": "isc",
    "it is licensed under MIT": "mit", "License: MIT": "mit", "GPLv2": "gpl-2", "GPLv3+": "gpl-3", "LGPLv2.1": "lgpl-2.1", "MPLv2": "mpl-2",
    "SPDX-License-Identifier: MIT AND Zlib": "mit,zlib",
    "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": "classpath-exception,gpl-2",
    "SPDX-License-Identifier: Apache-2.0 OR GPL-3.0-or-later OR MPL-2.0": "apache-2,gpl-3,mpl-2",
    "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1": "lgpl-2.1",
    "released under the terms of the PolyForm Shield License 1.0.0": "polyform-shield",
    "we met the library board and the general public": "", "a database server on the other side, reserved for all": "", "permission was granted": "",
}


def test_signatures():
    for text, labels in CASES.items():
        assert licenses.scan_text(text)[5] == labels, text
    written = {text for *_, text in (*signatures.TEXTS, *signatures.NAMES)}
    assert len(written) >= 150


def samples(rule):
    pattern = rule.pattern.pattern.decode().removeprefix("(?<= )").removesuffix("(?= )")
    return [x for x in branches(re._parser.parse(pattern)) if x == " ".join(x.split())]


def test_gates_pass_whatever_matches():
    """Any match holds a phrase of each gate, so trying only gated rules loses none."""
    for rule in licenses.rules():
        for text in samples(rule):
            joined = f" {text} ".encode()
            assert all(any(x in joined for x in gate) for gate in rule.gates), (rule, text)


def test_scan_is_that_of_all_rules(monkeypatch):
    """The scan against one that tries every rule on every text."""
    rng, rules = random.Random(2), licenses.rules()
    texts = [" ".join([rng.choice(samples(rng.choice(rules)) or ["x"]) for _ in range(5)]) for _ in range(60)]
    texts += [*CASES, "", "x " * 500]
    got = [licenses.scan_text(x) for x in texts]
    monkeypatch.setattr(licenses, "_RULES", [type(r)(r.priority, r.label, (), r.confidence, r.pattern) for r in rules])
    words = {w for x in texts for w in x.encode().translate(licenses._WORDS).split()}
    everything = list(range(len(rules)))
    monkeypatch.setattr(licenses, "_TRIGGERS", dict.fromkeys(words, everything))
    monkeypatch.setattr(licenses, "_TRIGGER_WORDS", frozenset(words))
    assert got == [licenses.scan_text(x) for x in texts]
