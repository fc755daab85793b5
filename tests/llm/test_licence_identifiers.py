"""Identifiers of licences in tags and sentences, and both spellings of the word."""

import re

import pytest

from millrace.llm import licenses

RULES = licenses.rules()
SCANNER = licenses.Scanner(RULES)


def labels(text):
    return {(RULES[d.rule].label, RULES[d.rule].confidence) for d in SCANNER.detections(text)[1]}


@pytest.mark.parametrize("label", licenses.identifiers())
def test_every_tag_rule_finds_its_identifier(label):
    assert (label, 1.0) in labels(f"// SPDX-License-Identifier: {label.upper()}\n")
    assert {x for x, c in labels(f"SPDX-License-Identifier: {label}") if c == 1.0} == {label}


@pytest.mark.parametrize("name", "MIT ISC Zlib BSL-1.0 MPL-2.0 EPL-2.0 CDDL-1.0 Artistic-2.0 OFL-1.1 EUPL-1.2 GPL-2.0-or-later".split())
def test_licensed_under_an_identifier(name):
    label = re.sub("-or-later", "", name.lower())
    assert (label, 0.9) in labels(f"Licensed under {name}.") and (label, 0.9) in labels(f"released under the {name} licence")


def test_spellings_and_no_license():
    assert ("mit", 0.9) in labels("Licensed under the MIT License") and ("mit", 0.6) in labels("see the MIT licence")
    assert ("apache-2.0", 0.6) in labels("the Apache Licence 2.0")
    assert not labels("limits under review; commit the summit") and not labels("provided under vim")


def test_gate_lets_identifiers_through(spark):
    rows = [(1, "SPDX-License-Identifier: Zlib"), (2, "Licensed under MPL-2.0"), (3, "reply under"), (4, "Licensed under UPL-1.0")]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: "zlib", 2: "mpl-2.0", 3: "", 4: "upl-1.0"}


@pytest.mark.parametrize(
    "expression, expected",
    [
        ("Apache-2.0 OR MIT", {"apache-2.0", "mit"}),
        ("(MIT AND BSD-3-Clause) or GPL-2.0-or-later", {"mit", "bsd-3-clause", "gpl-2.0"}),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0", {"gpl-2.0", "classpath-exception-2.0"}),
        ("GPL-2.0-only WITH Linux-syscall-note OR MIT", {"gpl-2.0", "linux-syscall-note", "mit"}),
        ("MIT or whatever, and ISC", {"mit"}),
        ("MIT\nand vim users", {"mit", "vim"}),
    ],
)
def test_expressions_name_every_licence(expression, expected):
    assert {label for label, confidence in labels(f"# SPDX-License-Identifier: {expression}\n") if confidence == 1.0} == expected


def test_joined_identifiers_count_in_tags_only():
    assert not {label for label, c in labels("ruby or vim with json and openssl") if c == 1.0}
    words = SCANNER.word.findall("x spdx license identifier apache 2 0 or mit")
    spans = sorted((d.first, d.last, RULES[d.rule].label) for d in SCANNER.detections(" ".join(words))[1])
    assert (1, 6, "apache-2.0") in spans and (8, 8, "mit") in spans
