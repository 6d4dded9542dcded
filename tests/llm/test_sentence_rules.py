import random

import pytest

from chunkloom.llm import sentence_rules as sr

MIT = ".\n".join(sr.SENTENCES[k] for k in ("mit.grant", "mit.notice", "mit.warranty")) + "."


def wrapped(text, width=60):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join([*lines, line])


@pytest.mark.parametrize(
    ("text", "named"),
    [
        ("Prose before. This work is licensed under the GNU General Public License, version 3. And behind.", ["GPL-3.0"]),
        ("Title without mark\nReleased under the MIT License", ["MIT"]),
        ("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!", ["Apache-2.0"]),
        ("Licensed under CC BY-NC 4.0.\nAll rights reserved.", ["CC-BY-NC-4.0"]),
        ("All rights reserved.", [sr.RESERVED]),
        ("The licence of the driver was lost.", []),
        (MIT, ["MIT"]),
        (wrapped(MIT), ["MIT"]),
        (wrapped(MIT).replace("\n", " \n  "), ["MIT"]),
        (wrapped(MIT, 20), ["MIT"]),
        (wrapped(MIT, 1), ["MIT"]),
        (wrapped("This work is made available under the terms and conditions of the MIT License", 1), ["MIT"]),
        (". ".join(sr.SENTENCES[k] for k in ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names")) + ".", ["BSD-3-Clause"]),
        (". ".join(sr.SENTENCES[k] for k in ("bsd.grant", "bsd.source", "bsd.binary")) + ".", ["BSD-2-Clause"]),
        ("This program is free software: " + sr.SENTENCES["gpl.terms3"] + ".", ["GPL-3.0-or-later"]),
        (MIT + "\nReleased under CC0.", ["MIT", "CC0-1.0"]),
    ],
)
def test_licences(text, named):
    assert sr.licences(sr.sentence_ids(text)) == named


def test_every_known_sentence_is_looked_at():
    for key, sentence in sr.SENTENCES.items():
        assert sr._HINTS.search(sentence.encode())
        assert sr.sentence_ids(sentence + ".") == [key]
    for name, spdx in sr.NAMES.items():
        assert sr.sentence_ids(f"This text is distributed under the terms of the {name}.") == [f"ref.{spdx}"]


def test_rules_are_ordered():
    assert sr.licences(["mit.grant", "ref.MIT", "mit.notice", "mit.warranty"]) == ["MIT"]
    assert sr.licences(["bsd.source", "bsd.grant"]) == []
    assert sr.kind_of("CC-BY-NC-SA-4.0") == "restricted"
    assert sr.kind_of("LGPL-3.0") == "copyleft"


def test_table(spark):
    rows = [(1, MIT, "clash"), (1, MIT, "again"), (2, None, ""), (3, "", ""), (None, "Released under the MIT License.", "")]
    rows.append((4, "word " * 100_000 + "Released under the MIT License.", ""))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    found = sr.scan_licences(docs).collect()
    assert [(r["doc_id"], r["licences"], r["kind"]) for r in found] == [
        (1, ["MIT"], "permissive"), (1, ["MIT"], "permissive"), (2, [], "none"), (3, [], "none"), (None, ["MIT"], "permissive"), (4, [], "none"),
    ]
    assert found[2]["n_sentences"] == 0
    assert sr.scan_licences(docs.limit(0)).count() == 0


def test_no_known_sentence_is_filtered_out(spark):
    cases = [("Released under CC0.", ["CC0-1.0"]), ("All rights\nreserved.", [sr.RESERVED]), ("All  rights \t reserved", [sr.RESERVED])]
    cases += [("This software is released under the GPLv3.", ["GPL-3.0"]), ("Our wor\u212a is provided\naccording to CC BY 4.0!", ["CC-BY-4.0"])]
    cases += [(f"This text is published under\nthe {name}.", [spdx]) for name, spdx in sr.NAMES.items()]
    cases += [(f"Provided according to the terms of the {name.upper()}.", [spdx]) for name, spdx in sr.NAMES.items()]
    cases += [("\n".join(s.split(" ", 10)), None) for s in sr.SENTENCES.values()]
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id bigint, text string")
    for row in sr.scan_licences(docs).collect():
        text, named = cases[row["doc_id"]]
        assert row["sentence_ids"] == sr.sentence_ids(text) != []
        assert named is None or row["licences"] == named
    assert all(sr._HINTS.search(sentence.upper().encode()) for sentence in sr.KNOWN)


def plain_ids(text):
    """Every run of units against the table, the longest first; a run ends at the first end of a sentence."""
    units = [u for u in sr._ENDS.split(text) if u and not u.isspace()]

    def ends(unit):
        return unit.rstrip()[-1:] in ".!?:" and not unit.rstrip().endswith(("v.", "Inc."))

    found, at = [], 0
    while at < len(units):
        stop = next((i for i in range(at, len(units)) if ends(" ".join(units[at : i + 1]))), len(units) - 1)
        for last in range(stop, at - 1, -1):
            key = sr.KNOWN.get(sr.normalised(" ".join(units[at : last + 1])))
            if key:
                found.append(key)
                at = last
                break
        at += 1
    return found


def test_recognition_is_a_plain_search_of_all_windows():
    rng = random.Random(9)
    known = [*sr.SENTENCES.values(), *(f"This work is licensed under the {name}" for name in sr.NAMES), "Released under CC0"]
    other = ["under the", "this software", "Permission is", "all", "The quick brown fox", "licensed", "v.", "Redistribution and use; in"]
    for _ in range(300):
        parts = [rng.choice(known if rng.random() < 0.5 else other) for _ in range(rng.randrange(1, 6))]
        text = "".join(p + rng.choice([". ", "\n", ".\n", "; ", " "]) for p in parts)
        words = text.split(" ")
        text = "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words)
        assert sr.sentence_ids(text) == plain_ids(text), text
