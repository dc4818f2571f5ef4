"""Token counts with a whole-token shortcut.

For a byte-level BPE vocabulary, the driver proves which vocabulary strings
encode alone as exactly one token: it encodes each of them.  The set is
bounded by the vocabulary and goes to the tasks.  A task cuts texts into
words with the single space before them, keeps the distinct ones, splits
those into pre-tokens by the tokenizer's pattern and counts 1 for each
proven one; only the rest is merged by the library, once per distinct
pre-token.  A text's count is the sum over its words and white-space runs.

Texts with the tokenizer's special strings or with white space outside
ASCII are counted by the library directly, as cuts at ASCII white space say
nothing about them.

Edge cases: null and empty texts have 0 bytes and 0 tokens; every row of the
input gives one row, repeated ids too.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import mix64, slices, small_batches, word_arrays

LIMIT = 1024
MEMO_UNITS = 1 << 20  # units whose counts a worker keeps; a memory bound only
#: the published pre-token pattern of this vocabulary family
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: white space outside the six ASCII characters that separate words here
OTHER_SPACE = "\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_STATE: dict = {}


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else 256 and up in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


def proven(path: str) -> frozenset[str]:
    """Vocabulary strings that alone encode as one token."""
    from tokenizers import Tokenizer
    tok, letters, texts = Tokenizer.from_file(path), byte_letters(), []
    special = {t["content"] for t in json.loads(tok.to_str())["added_tokens"]}
    for piece in tok.get_vocab():
        if piece not in special and all(c in letters for c in piece):
            try:
                texts.append(bytes(letters[c] for c in piece).decode())
            except UnicodeDecodeError:
                pass  # part of a character: never a pre-token by itself
    one = tok.encode_batch_fast(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, one) if len(e.ids) == 1)


class Counter:
    def __init__(self, path: str, whole: frozenset[str]):
        import regex
        from tokenizers import Tokenizer
        self.tok, self.whole, self.split = Tokenizer.from_file(path), whole, regex.compile(PATTERN).findall
        special = [t["content"] for t in json.loads(self.tok.to_str())["added_tokens"]]
        self.direct = re.compile("|".join([f"[{OTHER_SPACE}]", *map(re.escape, special)])).search
        self.name, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.runs: dict[bytes, int] = {}

    def library(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def units(self, texts: list[str]) -> list[int]:
        """Tokens of each unit: proven pre-tokens are 1, the others are merged once."""
        out, rest, spots = [], {}, []
        for k, text in enumerate(texts):
            n = 0
            if max(text) > "\u024f":  # letter classes beyond Latin may differ by Unicode version: the library cuts these
                spots.append((k, rest.setdefault(text, len(rest))))
                out.append(n)
                continue
            for piece in self.split(text):
                if piece in self.whole:
                    n += 1
                else:
                    spots.append((k, rest.setdefault(piece, len(rest))))
            out.append(n)
        if rest:
            merged = self.library(list(rest))
            for k, r in spots:
                out[k] += merged[r]
        return out

    def known(self, name: np.ndarray, text_of) -> np.ndarray:
        """Counts of distinct units; ``text_of(mask)`` gives the texts of the new ones."""
        if len(self.name) + len(name) > MEMO_UNITS:
            self.name, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k = np.searchsorted(self.name, name)
        new = np.ones(len(name), bool)
        inside = k < len(self.name)
        new[inside] = self.name[k[inside]] != name[inside]
        if new.any():
            names = np.concatenate([self.name, name[new]])
            counts = np.concatenate([self.count, np.array(self.units(text_of(new)), np.int64)])
            order = np.argsort(names, kind="stable")
            self.name, self.count = names[order], counts[order]
            k = np.searchsorted(self.name, name)
        return self.count[k]

    def run(self, space: bytes) -> int:
        """Tokens of a white-space run beyond the one space that joins the next word."""
        if space not in self.runs:
            if len(self.runs) > MEMO_UNITS:
                self.runs.clear()
            text = space.decode()
            parts = [text[:-1]] if text.endswith(" ") else [text[:-1], text[-1]]
            self.runs[space] = sum(self.units([p for p in parts if p]))
        return self.runs[space]

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        w = word_arrays(column)
        size = np.diff(w.offsets)
        total = np.zeros(len(size), np.int64)
        raw = w.data.tobytes()
        at = w.offsets
        if len(w.name):
            opens = np.zeros(len(w.name), bool)  # first word of its text
            opens[w.first[:-1][np.diff(w.first) > 0]] = True
            left = np.where(opens, at[w.row], np.r_[0, w.end[:-1]])
            gap = w.start - left
            joined = (gap > 0) & (w.data[w.start - 1] == 32)
            name = mix64(w.name + (w.end - w.start).astype(np.uint64) * np.uint64(2) + joined.astype(np.uint64))
            uniq, pick, back = np.unique(name, return_index=True, return_inverse=True)
            begin = (w.start - joined)[pick]

            def text_of(mask):
                return [raw[a:b].decode() for a, b in zip(begin[mask].tolist(), w.end[pick][mask].tolist())]
            total += np.bincount(w.row, self.known(uniq, text_of)[back], len(size)).astype(np.int64)
            for k in np.flatnonzero((gap > 1) | ((gap == 1) & ~joined)).tolist():
                total[w.row[k]] += self.run(raw[left[k]: w.start[k]])
        filled = np.diff(w.first) > 0
        tail = np.where(filled, w.end[np.maximum(w.first[1:] - 1, 0)] if len(w.end) else 0, at[:-1])
        for r in np.flatnonzero(tail < at[1:]).tolist():  # white space at the end is one pre-token
            total[r] += sum(self.units([raw[tail[r]: at[r + 1]].decode()]))
        odd = [r for r in range(len(size)) if size[r] and self.direct(raw[at[r]: at[r + 1]].decode())] \
            if self.direct(raw.decode()) else []
        for r, n in zip(odd, self.library([raw[at[r]: at[r + 1]].decode() for r in odd])):
            total[r] = n
        return size, total


def counter_of(path: str, whole: frozenset[str]) -> Counter:
    """This worker's memo, kept from task to task."""
    if path not in _STATE:
        _STATE[path] = Counter(path, whole)
    return _STATE[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs(doc_id, text, ..)``: doc_id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    small_batches(spark)
    whole = spark.sparkContext.broadcast(proven(tokenizer))  # at most the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer, whole.value)
        for batch in batches:
            for part in slices(batch, "text"):
                size, total = counter.texts(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), pa.array(total, pa.int64()),
                                                  pa.array(total > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
