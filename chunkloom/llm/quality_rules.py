"""Quality rules, line first: lines that break a rule go, then texts that lose too much go.

Defined cases: a null text counts as empty and has no words; a text without words is not kept; line
rules look at one line at a time, so a text of any length needs memory for itself only. Every row is
judged by itself, so ties and repeated rows do not matter. Of the input only the id and the text are
read; other columns can have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, binary_text, lists, map_columns

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50  # of the bytes in words
SYMBOLS = b"#*$%&|<>"

# Marks that end or structure a sentence; a line of prose has at least one of them.
_SENTENCE_MARK = re.compile(rb"[.!?:;,]|" + "\u2026|\u3002|\uff01|\uff1f|\u061f|\u0964".encode())
_BARS = frozenset([b"|", b">", b">>", b"\xc2\xbb", b"\xc2\xb7", b"\xe2\x80\xa2", b"/", b"-", b"*"])
_BOILERPLATE = re.compile(
    rb"cookie|javascript|all rights reserved|terms of (?:use|service)|privacy policy|click here"
    rb"|subscribe|sign up|log in|read more|share this|powered by|lorem ipsum|copyright \d{4}",
    re.IGNORECASE,
)
_CAPITALS = bytes(range(65, 91))
LINE_RULES = ("punctuation", "symbols", "shouting", "navigation", "stutter", "boilerplate")


def failed_rule(line: bytes, words: list[bytes]) -> str | None:
    """The first rule that a line with words breaks.

    punctuation: three words or more and no sentence mark. symbols: symbols in 30 percent of the words.
    shouting: of four words or more, 60 percent in capitals or with ``!!``. navigation: two menu bars,
    and a bar for every five words. stutter: of six words or more, 40 percent repeat the one before.
    boilerplate: a notice of at most twelve words.
    """
    count = len(words)
    if count >= 3 and not _SENTENCE_MARK.search(line):
        return "punctuation"
    if line.count(b"|") + line.count(b">") + line.count(b"/") + line.count(b"\xc2") + line.count(b"\xe2"):
        bars = sum(w in _BARS for w in words)
        if bars >= 2 and 5 * bars >= count:
            return "navigation"
    if len(line.translate(None, SYMBOLS)) < len(line):
        if 10 * sum(len(w.translate(None, SYMBOLS)) < len(w) for w in words) >= 3 * count:
            return "symbols"
    # a word in capitals has at least one, so most lines need no look at their words
    capitals = len(line) - len(line.translate(None, _CAPITALS))
    if count >= 4 and (10 * capitals >= 6 * count or b"!!" in line):
        if 10 * sum(b"!!" in w or (len(w) > 1 and w.isupper()) for w in words) >= 6 * count:
            return "shouting"
    if count >= 6 and 10 * sum(map(eq, words, words[1:])) >= 4 * count:
        return "stutter"
    if count <= 12 and _BOILERPLATE.search(line):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that the text has twice or more."""
    if len(words) <= width:
        return 0
    index = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    key = ids[: len(ids) - width + 1]
    for i in range(1, width):
        if i > 1 or len(index) > 1 << 31:  # make room for the next word
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(index) + ids[i : i + len(key)]
    _, group, sizes = np.unique(key, return_inverse=True, return_counts=True)
    again = sizes[group] > 1
    covered = np.zeros(len(ids), bool)
    for i in range(width):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def judge(text: bytes) -> tuple:
    """All measures of one text, and the text without the lines that failed."""
    words = text.split()
    n_words = len(words)
    solid = b"".join(words)
    word_chars = len(solid.decode("utf-8", "replace"))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    n_repeat = repeated_words(words)
    seen: set[bytes] = set()
    fails = dict.fromkeys(LINE_RULES, 0)
    n_dup, lost, kept_lines = 0, 0, []
    lines = text.split(b"\n")
    for line in lines:
        own = line.split()
        rule = None
        if own:
            if line in seen:
                n_dup += 1
            seen.add(line)
            rule = failed_rule(line, own)
        if rule:
            fails[rule] += 1
            lost += sum(map(len, own))
        else:
            kept_lines.append(line)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    kept = not base_failed and 100 * lost <= MAX_LOST_PERCENT * len(solid)
    measures = (n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, kept)
    return (*measures, len(lines), *fails.values(), len(solid), lost), b"\n".join(kept_lines)


_MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
    *(f"failed_{r}" for r in LINE_RULES), "word_bytes", "lost_bytes",
)


def clean_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_text: bool = True
) -> DataFrame:
    """One row per document: measures, lines failed by rule, the verdict and the cleaned text."""
    kinds = {"base_failed": "boolean", "kept": "boolean"}
    id_type = docs.schema[id_column].dataType.simpleString()
    ddl = f"doc_id {id_type}, " + ", ".join(f"{m} {kinds.get(m, 'bigint')}" for m in _MEASURES)
    names = ["doc_id", *_MEASURES]
    if with_text:
        ddl += ", cleaned binary"

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            rows, cleaned = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                measures, rest = judge(text)
                rows.append((key, *measures))
                if with_text:
                    cleaned.append(rest)
            yield lists(rows, names) | ({"cleaned": cleaned} if with_text else {})

    out = map_columns(docs.select(F.col(id_column).alias("doc_id"), binary_text(text_column).alias("text")), ddl, worker)
    return out.withColumn("cleaned", F.col("cleaned").cast("string")) if with_text else out


def kept_documents(docs: DataFrame) -> DataFrame:
    """Documents that are kept, as they are but for their failed lines; ``n_chars`` follows the text."""
    fields = [f.name for f in docs.schema]
    ddl_schema = docs.schema

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = fields.index("text")
        sized = fields.index("n_chars") if "n_chars" in fields else None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            judged = [judge(t) for t in table.column(len(fields)).to_pylist()]
            keep = pa.array([measures[6] for measures, _ in judged], pa.bool_())
            texts = [rest.decode("utf-8", "replace") for _, rest in judged]
            arrays = [table.column(i) for i in range(len(fields))]
            arrays[at] = pa.chunked_array([pa.array(texts, table.schema.field(at).type)])
            if sized is not None:
                arrays[sized] = pa.chunked_array([pa.array(map(len, texts), table.schema.field(sized).type)])
            out = pa.table(arrays, schema=pa.schema([table.schema.field(i) for i in range(len(fields))]))
            yield from out.filter(keep).to_batches()

    return docs.select("*", binary_text().alias("__bytes")).mapInArrow(worker, ddl_schema)
