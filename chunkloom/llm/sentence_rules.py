"""Licence recognition: known sentences become identifiers, identifier sequences meet ordered rules.

A text is cut into sentences at line ends and behind sentence marks; lines without a mark at their end
also join the next ones, as wrapped licence texts do, as long as what they make can still become a known
sentence, over however many lines. A sentence is normalised
(lower case, letters and digits only, the many ways to say "licensed under" made one) and looked up
among the known licence sentences. The identifiers a text gives, in order, are then read from left to
right: the first rule of the list whose identifiers follow there, with at most ``MAX_GAP`` others
between them, names a licence and takes them. A right reserved counts only beside no licence.

Defined cases: a null or empty text has no sentences and no licence; of the input only the id and the
text are read; every row is judged by itself, so ties and repeated rows do not matter. Texts are read
whole, one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, binary_text, lists, map_columns

MAX_GAP = 2

# Names under which licences are referred to, and their SPDX identifiers.
NAMES = {
    "mit license": "MIT",
    "mit licence": "MIT",
    "apache license version 2 0": "Apache-2.0",
    "apache license 2 0": "Apache-2.0",
    "apache 2 0 license": "Apache-2.0",
    "bsd license": "BSD-3-Clause",
    "bsd 2 clause license": "BSD-2-Clause",
    "bsd 3 clause license": "BSD-3-Clause",
    "isc license": "ISC",
    "mozilla public license version 2 0": "MPL-2.0",
    "mozilla public license v 2 0": "MPL-2.0",
    "gnu general public license": "GPL",
    "gnu general public license version 2": "GPL-2.0",
    "gnu general public license version 3": "GPL-3.0",
    "gnu lesser general public license version 2 1": "LGPL-2.1",
    "gnu lesser general public license version 3": "LGPL-3.0",
    "gnu affero general public license version 3": "AGPL-3.0",
    "gpl v2": "GPL-2.0",
    "gpl v3": "GPL-3.0",
    "gplv2": "GPL-2.0",
    "gplv3": "GPL-3.0",
    "cc0 1 0": "CC0-1.0",
    "cc0": "CC0-1.0",
    "cc by 4 0": "CC-BY-4.0",
    "cc by 3 0": "CC-BY-3.0",
    "cc by sa 4 0": "CC-BY-SA-4.0",
    "cc by sa 3 0": "CC-BY-SA-3.0",
    "cc by nc 4 0": "CC-BY-NC-4.0",
    "cc by nd 4 0": "CC-BY-ND-4.0",
    "cc by nc sa 4 0": "CC-BY-NC-SA-4.0",
    "cc by nc nd 4 0": "CC-BY-NC-ND-4.0",
    "creative commons attribution 4 0 international license": "CC-BY-4.0",
    "creative commons attribution sharealike 4 0 international license": "CC-BY-SA-4.0",
    "creative commons attribution noncommercial 4 0 international license": "CC-BY-NC-4.0",
    "unlicense": "Unlicense",
}

# Sentences of licence texts, as the licences have them.
SENTENCES = {
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software",
    "mit.warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd.names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "apache.grant": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache.use": "you may not use this file except in compliance with the License",
    "gpl.free": "This program is free software",
    "gpl.terms3": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl.terms2": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "mpl.terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense.domain": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
}

_REFERENCE = re.compile(
    r"^(?:this|the|all|our)? ?(?:work|software|text|document|page|file|article|content|code|site|project|program|material)?s? ?"
    r"(?:is|are)? ?(?:licensed|licenced|released|distributed|published|available|made available|provided)"
    r" (?:under|according to)(?: the terms(?: and conditions)? of)?(?: the| an| a)? "
)
_NOT_PLAIN = re.compile(r"[^0-9a-z]+")
_ENDS = re.compile(r"(?<=[.!?;:])[ \t]+|[ \t]*\n")


def normalised(sentence: str) -> str:
    plain = _NOT_PLAIN.sub(" ", sentence.lower()).strip()
    plain = _REFERENCE.sub("under ", plain)
    return plain.removesuffix(" license") + " license" if plain.endswith(" license license") else plain


def _known() -> dict[str, str]:
    table = {f"under {name}": f"ref.{spdx}" for name, spdx in NAMES.items()}
    table |= {f"under {name} license": f"ref.{spdx}" for name, spdx in NAMES.items() if not name.endswith("license")}
    return table | {normalised(text): key for key, text in SENTENCES.items()}


KNOWN = _known()


def _beginnings() -> frozenset[str]:
    """Everything that known sentences begin with, word by word."""
    words = (sentence.split() for sentence in KNOWN)
    return frozenset(" ".join(w[:i]) for w in words for i in range(1, len(w) + 1))


_BEGINNINGS = _beginnings()
# Words before the "under" of a reference, and between that and the name.
_LEAD = frozenset(
    "this the all our a an is are made available licensed licenced released distributed published provided "
    "under according to terms and conditions of".split()
) | {noun + s for noun in "work software text document page file article content code site project program material".split() for s in ("", "s")}
_LEAD_WORDS = 16


def may_go_on(plain: str) -> bool:
    """Whether a normalised text can be the beginning of a known sentence."""
    if plain in _BEGINNINGS:
        return True
    words = plain.split()
    return bool(words) and len(words) <= _LEAD_WORDS and all(w in _LEAD for w in words)


class Hints:
    """Words of which every text with a known sentence has at least one; other texts need no closer look.

    Single words, so that no line end or space can part them: of a reference its preposition, of any
    other sentence its longest word. None has a k, which is also the lower case of the Kelvin sign.
    """

    def __init__(self, known: Iterable[str]):
        words = {"under", "according"}
        for sentence in known:
            if not sentence.startswith("under "):
                words.add(max((w for w in sentence.split() if "k" not in w), key=len))
        self.words = sorted(w.encode() for w in words)

    def search(self, text: bytes) -> bool:
        lower = text.lower()
        return any(word in lower for word in self.words)


_HINTS = Hints(KNOWN)

# In this order: a longer licence before one whose identifiers it also has.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit.grant", "mit.notice", "mit.warranty")),
    ("MIT", ("mit.grant", "mit.notice")),
    ("ISC", ("isc.grant",)),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names")),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary")),
    ("Apache-2.0", ("apache.grant", "apache.use")),
    ("Apache-2.0", ("apache.grant",)),
    ("GPL-3.0-or-later", ("gpl.free", "gpl.terms3")),
    ("GPL-2.0-or-later", ("gpl.free", "gpl.terms2")),
    ("MPL-2.0", ("mpl.terms",)),
    ("Unlicense", ("unlicense.domain",)),
    *((spdx, (f"ref.{spdx}",)) for spdx in dict.fromkeys(NAMES.values())),
]
RESERVED = "LicenseRef-all-rights-reserved"

_KINDS = (("NC", "restricted"), ("ND", "restricted"), ("GPL", "copyleft"), ("SA", "copyleft"), ("MPL", "copyleft"))


def kind_of(licence: str) -> str:
    if licence == RESERVED:
        return "reserved"
    parts = licence.split("-")
    return next((kind for mark, kind in _KINDS if mark in parts or (mark == "GPL" and mark in parts[0])), "permissive")


def sentence_ids(text: str) -> list[str]:
    """Identifiers of the known sentences of a text, in order; the longest of joined lines counts."""
    units = [u for u in _ENDS.split(text) if u and not u.isspace()]
    found, at = [], 0
    while at < len(units):
        joined, best = units[at], None
        for last in range(at, len(units)):
            if last > at:
                joined += " " + units[last]
            plain = normalised(joined)
            key = KNOWN.get(plain)
            if key:
                best = (key, last)
            if not may_go_on(plain):
                break
            # sentences with a semicolon inside go on behind it
            if joined.rstrip()[-1:] in ".!?:" and not joined.rstrip().endswith(("v.", "Inc.")):
                break
        if best:
            found.append(best[0])
        at = best[1] + 1 if best else at + 1
    return found


def licences(ids: list[str]) -> list[str]:
    """Licences by the ordered rules; every identifier belongs to at most one."""
    left, named = list(ids), []
    at = 0
    while at < len(left):
        for name, wanted in RULES:
            place, taken = at, []
            for key in wanted:
                window = left[place : place + (1 if not taken else MAX_GAP + 1)]
                if key not in window:
                    break
                place += window.index(key)
                taken.append(place)
                place += 1
            else:
                named.append(name)
                for place in reversed(taken[1:]):
                    del left[place]
                break
        at += 1
    named = list(dict.fromkeys(named))
    return named or ([RESERVED] if "reserved" in ids else [])


def scan_licences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licences, kind``: one row per document.

    The arrays keep the order of the text; ``kind`` is that of the strictest licence, or ``none``.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    ddl = f"doc_id {id_type}, n_sentences bigint, sentence_ids array<string>, licences array<string>, kind string"
    strict = ("reserved", "restricted", "copyleft", "permissive")

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            rows = []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = raw.decode("utf-8", "replace")
                count = sum(1 for u in _ENDS.split(text) if u and not u.isspace())
                ids = sentence_ids(text) if _HINTS.search(raw) else []
                named = licences(ids)
                kinds = {kind_of(n) for n in named}
                rows.append((key, count, ids, named, next((k for k in strict if k in kinds), "none")))
            yield lists(rows, [part.split()[0] for part in ddl.split(", ")])

    return map_columns(docs.select(F.col(id_column).alias("doc_id"), binary_text(text_column).alias("text")), ddl, worker)
