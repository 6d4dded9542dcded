import re
from collections import Counter

import pytest

from chunkloom.llm import quality_rules as qr

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def measures(text):
    """The base measures, counted plainly."""
    raw = (text or "").encode()
    words = WORD.findall(raw)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in raw.decode())
    return len(words), chars, symbols, dup, len(again), len(words) < 50 or 100 * len(again) > 50 * len(words)


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("The cat sat on the mat.", None),
        ("Short", None),
        ("no mark in this line", "punctuation"),
        ("Home | About | News | Contact.", "navigation"),
        ("Some### of%%% these&&& words*** here.", "symbols"),
        ("BUY!! THIS!! NOW!! OR!! NEVER!!", "shouting"),
        ("so so so so so, so so", "stutter"),
        ("All rights reserved.", "boilerplate"),
        ("Das steht so nur in diesem Satz: sonst nirgends", None),
    ],
)
def test_line_rules(line, rule):
    assert qr.failed_rule(line.encode(), line.encode().split()) == rule


def test_measures_and_verdicts(spark):
    clean = "\n".join(f"{i} " + " ".join(f"w{i}{j}" for j in range(12)) + "." for i in range(9))
    menu = "\n".join("Home | News | About | Login | Help" + str(i) for i in range(30))
    texts = [clean, menu, clean + "\n" + menu[:60], None, "", " \n\t", "a b c " * 40, "é x y " * 30, "x " * 200_000, clean + "\n\n" + clean]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, clean, "again"), (None, clean, "none")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    found = qr.clean_lines(docs).collect()
    assert len(found) == len(rows)
    for row, (key, text, _) in zip(found, rows, strict=True):
        assert tuple(row)[:7] == (key, *measures(text))
    verdict = [r["kept"] for r in found]
    assert verdict == [True, False, True, False, False, False, False, False, False, False, True, True]
    assert found[2]["cleaned"] == clean

    left = qr.kept_documents(docs)
    assert left.columns == docs.columns
    assert [(r[0], r[1]) for r in left.collect()] == [(0, clean), (2, clean), (0, clean), (None, clean)]
    assert qr.clean_lines(docs.limit(0)).count() == 0


def test_number_of_characters_follows(spark):
    clean = "\n".join(f"{i} " + " ".join(f"é{i}{j}" for j in range(12)) + "." for i in range(9))
    docs = spark.createDataFrame([(1, clean + "\nAll rights reserved.", 7)], "doc_id bigint, text string, n_chars bigint")
    (row,) = qr.kept_documents(docs).collect()
    assert row["text"] == clean
    assert row["n_chars"] == len(clean)
