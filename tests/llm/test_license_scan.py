import random
import re

from linernotes.llm.license_notices import NOTICES
from linernotes.llm.license_scan import scan
from tests.llm.conftest import SCHEMA, prose, row


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, templates):
    out = []
    for doc_id, text in docs:
        for name, template in templates:
            wanted = shingles(template)
            shared = len(wanted & shingles(text))
            if wanted and shared >= 0.8 * len(wanted):
                out.append((doc_id, name, shared, len(wanted), round(shared / len(wanted), 6)))
    return sorted(out)


def case():
    rng = random.Random(6)
    templates = NOTICES + [("long", prose(rng, 400)), ("tiny", "four words are few")]
    docs = [(0, None), (1, ""), (2, prose(rng, 4)), (3, "Released under the MIT License")]
    for i in range(4, 160):
        _, text = rng.choice(templates)
        words = text.split()
        for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
            words[rng.randrange(len(words))] = "exchanged"
        cut = rng.choice([0, 0, 1, len(words) // 10])
        docs.append((i, prose(rng, rng.randint(0, 40)) + "\n" + " ".join(words[cut:]).upper() + "; " + prose(rng, rng.randint(0, 40))))
    return docs, templates


def test_against_brute_force(spark):
    docs, templates = case()
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    want = brute(docs, templates)
    assert len(want) > 60
    assert sorted(map(tuple, scan(df, templates).collect())) == want


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([row(1, "a text")], SCHEMA)
    plan = scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_work_follows_the_length_of_a_text(spark):
    """A text of 200 000 words ends in seconds; work in its square wouldn't."""
    text = prose(random.Random(1), 200_000) + " Licensed under CC BY-NC 4.0."
    df = spark.createDataFrame([row(1, text)], SCHEMA)
    assert [r["license_id"] for r in scan(df).collect()] == ["CC-BY-NC-4.0"]


def test_odd_rows(odd_docs, no_docs):
    assert scan(odd_docs).count() == 0
    assert scan(no_docs).count() == 0
    assert scan(odd_docs, []).count() == 0


def test_usual_headers(spark):
    """Each usual header is named, and not by a like one's name."""
    gnu = (
        "# This {0} is free software{3} you can redistribute it and/or modify\n# it under the terms of the GNU {1}General Public License as published by\n"
        "# the Free Software Foundation{4} either version {2} of the License, or\n# (at your option) any later version.\n"
    )
    bsd = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.\n{}"
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
    )
    third = (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.\n"
    )
    isc = (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    )
    cases = [
        (gnu.format("program", "", "3", ":", ","), {"GPL-3.0-header"}), (gnu.format("program", "", "2", ";", ";"), {"GPL-2.0-header"}),
        (gnu.format("library", "Lesser ", "2.1", ";", ";"), {"LGPL-2.1-header"}), (gnu.format("library", "Lesser ", "3", ":", ","), {"LGPL-3.0-header"}),
        (gnu.format("program", "Affero ", "3", ":", ","), {"AGPL-3.0-header"}), (bsd.format(""), {"BSD", "BSD-2-Clause"}),
        (bsd.format(third), {"BSD", "BSD-3-Clause"}), (isc, {"ISC"}),
    ]
    df = spark.createDataFrame([row(i, f"some code\n{text}\nmore code") for i, (text, _) in enumerate(cases)], SCHEMA)
    got = {(r["doc_id"], r["license_id"]) for r in scan(df).collect()}
    assert got == {(i, name) for i, (_, names) in enumerate(cases) for name in names}
