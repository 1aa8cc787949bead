"""Keywords and anchors are necessary conditions of the rules they gate."""

import random
import re

import pytest

from tidemark.llm.licenses import claim, detect, plain, rules, scan_text


def sample(rng, tree):
    """A string that a parsed pattern matches; blanks become line breaks or other white space."""
    out = ""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            kind, value = rng.choice(arg)
            out += chr(value) if str(kind) == "LITERAL" else chr(rng.randint(*value)) if str(kind) == "RANGE" else rng.choice("\n \t")
        elif op == "ANY":
            out += "."
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(sample(rng, arg[2]) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 1))))
        elif op == "SUBPATTERN":
            out += sample(rng, arg[3])
        elif op == "BRANCH":
            out += sample(rng, rng.choice(arg[1]))
        else:
            assert op == "ASSERT_NOT", op
    return out


def test_gates_lose_no_detection_of_any_rule():
    rng = random.Random(5)
    for rule in rules():
        tree = re._parser.parse(rule.pattern.pattern)
        for _ in range(8):
            text = f"so {sample(rng, tree)} ."
            assert rule.pattern.search(plain(text)), (rule, text)
            assert any(k in plain(text) for k in rule.keywords), (rule, text)
            want = claim(plain(text), rules())
            assert want and detect(text) == want, (rule, text)
            assert {d.rule.label for d in want} <= set(scan_text(text)[5].split(",")), (rule, text)


@pytest.mark.parametrize(
    "text, label",
    [
        ("under the terms of the GNU General\nPublic License, version 3", "gpl-3.0"),
        ("the SIL Open\nFont License", "ofl-1.1"),
        ("Common\nDevelopment and Distribution License", "cddl"),
        ("CreativeML Open RAIL-M", "openrail-m"),
        ("Berkeley Software\nDistribution", "bsd"),
        ("PSF License", "python-2.0"),
        ("Creative\nCommons Attribution 4.0", "cc-by-4.0"),
        ("CC\nBY 4.0", "cc-by-4.0"),
        ("Apache\n2.0", "apache-2.0"),
        ("the Expat License", "mit"),
        ("European\nUnion Public Licence", "eupl-1.2"),
        ("Open\nDatabase License", "odbl-1.0"),
    ],
)
def test_wrapped_and_other_spellings(text, label):
    assert label in scan_text(text)[5].split(",")


@pytest.mark.parametrize(
    "text, label",
    [
        ("SPDX-License-Identifier: MIT", "mit"),
        ("// SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)", "bsd-3-clause"),
        ("License: MIT", "mit"),
        ('license = "MIT"', "mit"),
        ('"license": "Apache-2.0",', "apache-2.0"),
        ("licensed under GPL", "gpl"),
        ("Permission is hereby granted, free of charge, to any\n * person obtaining a copy of this software", "mit"),
        ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted", "bsd"),
        ("see https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
        ("https://opensource.org/licenses/MIT", "mit"),
        ("PROPRIETARY AND CONFIDENTIAL", "proprietary"),
        ("GNU General\n# Public License, version 3", "gpl-3.0"),
    ],
)
def test_identifiers_sentences_and_addresses(text, label):
    row = scan_text(text)
    assert label in row[5].split(",") and row[6] > 0.5


def test_one_mention_is_counted_once_and_the_stronger_stays():
    assert scan_text("apache-2.0")[6] < 0.75
    assert abs(scan_text("the Apache License 2.0")[6] - 0.7) < 1e-9
    found = detect("licensed under the mit license")
    assert len(found) == 1 and found[0].rule.weight > 0.9
    assert scan_text("all the rights of the permit are under review: see the licence office")[5] == ""


def test_the_prefilter_equals_all_rules_on_documents(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        low = (r.text or "").lower()
        assert detect(low) == claim(plain(low), rules())


def test_reserved_rights_yield_to_a_grant():
    assert scan_text("Copyright 2020 A. Author. All rights reserved.")[5] == "proprietary"
    assert scan_text("Copyright 2020. All rights reserved. Licensed under the MIT License.")[5] == "mit"
    assert "proprietary" in scan_text("Proprietary and confidential. Contains parts under the MIT license. All rights reserved.")[5]


def test_many_identifiers_keep_the_widest_of_each_label():
    text = "license: mit or apache-2.0 and " * 400 + "spdx-license-identifier: mit"
    found = scan_text(text)
    assert set(found[5].split(",")) >= {"mit", "apache-2.0"} and found[6] > 0.99
