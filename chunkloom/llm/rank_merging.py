"""Token counts by rank-synchronous merging of ragged arrays.

1. Texts are cut into pre-tokens by the tokenizer library's own normalizer and pre-tokenizer, after the
   strings of added tokens, which count as one token each, as the library does by default.
2. Distinct pre-tokens of a batch become one ragged array: symbol ids of all of them in a row, and where
   each begins. In every round each sequence looks up the ranks of its pairs of neighbours and applies
   its lowest one everywhere at once, from the left where a symbol could go to either side. Sequences
   without a pair of the merge table are done; what is left of them is their number of tokens.
3. Counts of pre-tokens are added up over each text.

Merging everywhere at once is the same as one pair at a time, as a merge's product only occurs in later
merges; where a table breaks that rule (checked when it is loaded), such a rank is applied one at a time.

Where normalizer and pre-tokenizer work within what ASCII white space separates (``by_word``), counts
are those of words and are remembered, up to a bound, from one task to the next.

Defined cases: a null or empty text has no bytes and no tokens; bytes that are no UTF-8 are read as
U+FFFD; rows that repeat an id, or have none, are counted each by itself; an empty table gives no rows;
of the input only the id and the text are read. A tokenizer that is no byte-pair model, or drops merges
at random, or has unknown tokens or added tokens with other than plain matching, raises ``ValueError``.
Memory: one text, or texts of together ``SLICE_BYTES``, with their words, and ``KNOWN_WORDS`` counts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, kept_in_process, map_columns, slices_of

TOKEN_LIMIT = 2048
KNOWN_WORDS = 400_000
SLICE_BYTES = 4 << 20
# A normalizer and a pattern that never look past white space, fixed values of a public tokenizer.
_WORDWISE_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_WORDWISE_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class MergeTable:
    """The merges of a byte-pair model as sorted arrays, and the symbols that texts begin with."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        prefix = model.get("continuing_subword_prefix") or ""
        self._size = max(vocabulary.values(), default=0) + 1
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b[len(prefix) :]] for a, b in pairs], np.int64)
        # of a pair listed twice the last counts
        keys, last = np.unique((left * self._size + right)[::-1], return_index=True)
        self._keys = np.append(keys, np.iinfo(np.int64).max)
        self._ranks = np.append(len(pairs) - 1 - last, len(pairs))
        self._made = made
        first_use = np.full(self._size, len(pairs))
        np.minimum.at(first_use, left, np.arange(len(pairs)))
        np.minimum.at(first_use, right, np.arange(len(pairs)))
        # ranks whose product is in an earlier merge
        self._one_by_one = np.append(first_use[made] <= np.arange(len(pairs)), False)
        suffix = model.get("end_of_word_suffix") or ""
        letters = {token: i for token, i in vocabulary.items() if len(token) == 1}
        self._inner = self._table(letters)
        ends = {t[: len(t) - len(suffix)]: i for t, i in vocabulary.items() if t.endswith(suffix)}
        self._last = self._table({t: i for t, i in ends.items() if len(t) == 1})
        self._prefixed = self._table({t[len(prefix) :]: i for t, i in vocabulary.items() if prefix and t.startswith(prefix) and len(t) == len(prefix) + 1}) if prefix else self._inner
        if prefix and suffix:
            raise ValueError("a tokenizer with both prefixes and suffixes of word parts")

    @staticmethod
    def _table(letters: dict[str, int]) -> np.ndarray:
        table = np.full(max(map(ord, letters), default=0) + 2, -1, np.int64)
        for letter, i in letters.items():
            table[ord(letter)] = i
        return table

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ragged array of the pieces: symbols, and the piece that each belongs to.

        Letters outside the vocabulary are no symbols, as in the library.
        """
        points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        owner = np.repeat(np.arange(len(pieces)), sizes)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        symbols = self._prefixed[np.minimum(points, len(self._prefixed) - 1)]
        some = sizes > 0
        if self._prefixed is not self._inner:
            symbols[begins[some]] = self._inner[np.minimum(points[begins[some]], len(self._inner) - 1)]
        else:
            symbols[ends[some] - 1] = self._last[np.minimum(points[ends[some] - 1], len(self._last) - 1)]
        known = symbols >= 0
        return symbols[known], owner[known]

    def _ranks_of(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The rank of each symbol with the next one; the number of merges where there is none."""
        none = len(self._made)
        ranks = np.full(len(symbols), none)
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        keys = symbols[pair] * self._size + symbols[pair + 1]
        at = np.searchsorted(self._keys, keys)
        ranks[pair] = np.where(self._keys[at] == keys, self._ranks[at], none)
        return ranks

    def counts(self, pieces: list[str]) -> np.ndarray:
        """How many tokens each piece has."""
        symbols, owner = self.symbols(pieces)
        left = np.bincount(owner, minlength=len(pieces))
        none = len(self._made)
        while len(symbols):
            ranks = self._ranks_of(symbols, owner)
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(ranks, heads)
            sizes = np.diff(np.append(heads, len(symbols)))
            own = np.repeat(lowest, sizes)
            hit = (ranks == own) & (own < none)
            hit = _leftmost(hit, self._one_by_one[own], np.repeat(heads, sizes))
            merged = np.flatnonzero(hit)
            left -= np.bincount(owner[merged], minlength=len(pieces))
            symbols[merged] = self._made[ranks[merged]]
            # a symbol goes if the one before it took it in, and a whole sequence once it is done
            stays = own < none
            stays[merged + 1] = False
            symbols, owner = symbols[stays], owner[stays]
        return left


def _leftmost(hit: np.ndarray, one_by_one: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Of hits that follow one another every other one, from the left; of those under ``one_by_one``
    only the first of the sequence, which begins at ``heads``."""
    places = np.arange(len(hit))
    if len(hit) > 1 and (hit[1:] & hit[:-1]).any():
        before = np.concatenate([[False], hit[:-1]])
        begins = np.maximum.accumulate(np.where(hit & ~before, places, -1))
        hit = hit & ((places - begins) % 2 == 0)
    if (hit & one_by_one).any():
        so_far = np.cumsum(hit)
        in_sequence = so_far - np.where(heads > 0, so_far[heads - 1], 0)
        hit = hit & (~one_by_one | (in_sequence == 1))
    return hit


class TokenCounter:
    """The number of tokens of texts, as the library counts them without special tokens added."""

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        parts = json.loads(whole.to_str())
        model, added = parts["model"], parts["added_tokens"] or []
        odd = [k for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"cannot count tokens of a {model['type']} model with {odd}")
        if any(token[k] for token in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("cannot count added tokens with other than plain matching")
        self._table = MergeTable(model)
        self._normalize = whole.normalizer.normalize_str if whole.normalizer else str
        self._cut = whole.pre_tokenizer.pre_tokenize_str if whole.pre_tokenizer else lambda text: [(text, (0, len(text)))]
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, contents))) if contents else None
        self.by_word = self._wordwise(parts) and not any(re.search(r"\s", c) for c in contents)
        self._bound = known_words
        self._known: dict[bytes, int] = {}

    @staticmethod
    def _wordwise(parts: dict) -> bool:
        normalizers = (parts["normalizer"] or {}).get("normalizers")
        cutters = (parts["pre_tokenizer"] or {}).get("pretokenizers")
        if normalizers != _WORDWISE_NORMALIZERS or not cutters or len(cutters) != 2:
            return False
        split, letters = cutters
        return (
            split["type"] == "Split"
            and split["pattern"] == {"Regex": _WORDWISE_PATTERN}
            and letters["type"] == "ByteLevel"
            and not letters["add_prefix_space"]
            and not letters["use_regex"]
        )

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each of a list of texts (or words), all at once."""
        fixed = np.zeros(len(texts), np.int64)
        numbers: dict[str, int] = {}
        pieces, owners = [], []
        for i, text in enumerate(texts):
            spans = self._added.split(text) if self._added else [text]
            fixed[i] = len(spans) - 1
            for span in spans:
                for piece, _ in self._cut(self._normalize(span)) if span else ():
                    pieces.append(numbers.setdefault(piece, len(numbers)))
                    owners.append(i)
        each = self._table.counts(list(numbers))
        np.add.at(fixed, np.array(owners, np.int64), each[np.array(pieces, np.int64)])
        return fixed

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of an Arrow array of strings without nulls."""
        if not self.by_word:
            return self.counts([t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()])
        words = pc.ascii_split_whitespace(texts)
        flat = words.flatten().dictionary_encode()
        spelled = flat.dictionary.cast(pa.binary()).to_pylist()
        if len(self._known) + len(spelled) > self._bound:
            self._known.clear()
        known = self._known
        new = [w for w in spelled if w not in known]
        if new:
            known.update(zip(new, self.counts([w.decode("utf-8", "replace") for w in new]).tolist(), strict=True))
        per_word = np.fromiter((known[w] for w in spelled), np.int64, len(spelled))[flat.indices.to_numpy()]
        after = np.concatenate([[0], np.cumsum(per_word)])
        edges = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        return after[edges[1:]] - after[edges[:-1]]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = TOKEN_LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: one row per document."""
    id_type = docs.schema[id_column].dataType.simpleString()
    text: Column = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    picked = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        count = kept_in_process("token-counter", tokenizer, lambda: TokenCounter(tokenizer))
        for batch in batches:
            for start, length in slices_of(batch.column(2), SLICE_BYTES):
                part = batch.slice(start, length)
                yield {"doc_id": part.column(0), "n_bytes": part.column(1), "n_tokens": count(part.column(2))}

    counted = map_columns(picked, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint", worker)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
