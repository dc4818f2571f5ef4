"""Token-id files: ORC with run-length encoded ids, row indexes and Bloom filters.

Documents are range-partitioned and sorted by doc_id before they are
encoded, so file order is id order and each file holds one id range.  A row
is (doc_id, start, n_tokens, ids array<int>), ``start`` counted within the
writing task; ORC's integer run-length encoding packs the numbers, its row
index keeps min and max of doc_id per ``ROW_STRIDE`` rows, and a Bloom
filter on doc_id lets a lookup skip stripes.  Readers split files by stripe.
The index needs the ids read once: the tokens before a file come from the
``n_tokens`` column alone.

Texts are encoded through their distinct words: the tokenizer drops white
space and no piece spans it, so a text's ids are its words' ids in a row.
A worker keeps the ids of words it has met, by 64-bit name and length.  For
a tokenizer that folds case and splits letters from other characters
(``NORMALIZER``, ``PIECES``: read from its file), capitals and the ASCII marks at a word's end are taken
off before words are told apart, and a word of Latin letters alone, being one
piece, goes straight to the library's merges; all else goes through the
whole library.

Edge cases: null and empty texts hold the end id alone; a null doc_id sorts
last; rows that share a doc_id are separate records in the order they have in the
file, by length and hash of the text (a common or missing id may reach over
several files); an empty table writes no file and reads back empty; other
columns are never read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.session import scratch_path

from .textarrays import SPACE, buffers, lists, mix64, runs, slices, small_batches, span_names

END_ID = 2
ROW_STRIDE = 1000
MEMO_WORDS = 1 << 20  # words whose ids a worker keeps; a memory bound only
SCHEMA = "doc_id long, start long, n_tokens long, ids array<int>"
_STATE: dict = {}
# fixed values: the normalizer and pre-tokenizer under which words may be taken apart beforehand
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PIECES = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
LETTERS = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
#: ASCII marks; those of special tokens stay with their word
MARK = np.zeros(256, bool)
MARK[list(b"!\"#$%&'()*+,-./:;=?@[\\]^_`{}~")] = True
ALNUM = np.zeros(256, bool)
ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for characters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_CHAR = _byte_chars()


class WordIds:
    """Ids of words, kept as flat arrays sorted by word name."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        # one word that becomes one id, written between words to tell them apart
        mark = self.tok.encode("0", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        part = lambda p: None if p is None else json.loads(p.__getstate__())
        model = self.tok.model
        self.split = part(self.tok.normalizer) == NORMALIZER and part(self.tok.pre_tokenizer) == PIECES
        self.merge = model.tokenize if self.split and type(model).__name__ == "BPE" and not model.dropout else None
        self.clear()

    def clear(self) -> None:
        self.name, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of the words, in some order, and the place and number of each word's ids."""
        order, flat, pieces, size = [], [], [], np.zeros(len(words), np.int64)
        plain, rest = [], []
        for k, w in enumerate(words):
            if self.merge and LETTERS.fullmatch(w):
                low = w.lower()
                ids = [t.id for t in self.merge(low if low.isascii() else "".join(map(BYTE_CHAR.get, low.encode())))]
                size[k] = len(ids)
                order.append(k)
                flat += ids
            elif self.mark is not None and "0" not in w and "<|" not in w:
                plain.append(k)
            else:
                rest.append(k)
        pieces.append(np.array(flat, np.int32))
        for a in range(0, len(plain), 512):
            part = plain[a: a + 512]
            ids = np.array(self.tok.encode(" 0 ".join([words[k] for k in part]), add_special_tokens=False).ids, np.int32)
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(part) - 1:
                rest += part
                continue
            size[part] = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1
            order += part
            pieces.append(np.delete(ids, cut))
        for a in range(0, len(rest), 4096):
            part = rest[a: a + 4096]
            for k, e in zip(part, self.tok.encode_batch_fast([words[k] for k in part], add_special_tokens=False)):
                size[k] = len(e.ids)
                order.append(k)
                pieces.append(np.array(e.ids, np.int32))
        at = np.zeros(len(words), np.int64)
        at[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate([*pieces, np.zeros(0, np.int32)]), at, size

    def lookup(self, name: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and sizes in ``self.ids`` of distinct words (ascending by name), encoding the new ones."""
        if len(self.name) + len(name) > MEMO_WORDS:
            self.clear()
        k = np.searchsorted(self.name, name)
        new = np.ones(len(name), bool)
        inside = k < len(self.name)
        new[inside] = self.name[k[inside]] != name[inside]
        if new.any():
            raw = data.tobytes()
            flat, at, size = self._encode([raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())])
            at += len(self.ids)
            self.ids = np.concatenate([self.ids, flat])
            place = k[new]  # where they belong among the names, which are sorted
            self.name, self.at, self.size = np.insert(self.name, place, name[new]), np.insert(self.at, place, at), np.insert(self.size, place, size)
            k = np.searchsorted(self.name, name)
        return self.at[k], self.size[k]


def take_apart(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z folded, and starts and ends of words whose closing ASCII marks are words of their own.

    A word with a character from U+0100 on keeps its capitals, as a mark after one could combine with it, and so does one with
    "<", as special tokens are matched as they stand.  Marks are cut off after a letter or digit of ASCII or Latin-1 only: there
    the pre-tokenizer cuts too, and nothing combines over the cut.
    """
    at = np.arange(len(data))
    last = np.maximum.accumulate(np.where(MARK[data], -1, at))[end - 1]  # last byte that is no mark
    before = data[np.maximum(last - 1, 0)]
    letter = ALNUM[data[last]] | ((before == 0xC3) & (data[last] >= 0x80) & (data[last] != 0x97) & (data[last] != 0xB7))
    cut = (last >= start) & (last < end - 1) & letter
    odd = np.logical_or.reduceat((data >= 0xC4) | (data == 0x3C), start)
    high = np.flatnonzero((data >= 65) & (data <= 90))
    high = high[~odd[np.searchsorted(start, high, side="right") - 1]]
    data = data.copy()
    data[high] += 32
    return data, np.sort(np.concatenate([start, last[cut] + 1])), np.sort(np.concatenate([end, last[cut] + 1]))


def encoded(texts: pa.Array, ids: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the texts, each closed by ``end_id``, and ids per text."""
    data, offsets = buffers(pc.fill_null(texts, "") if texts.null_count else texts)
    start, end = runs(~SPACE[data], offsets)
    if ids.split and len(start):
        data, start, end = take_apart(data, start, end)
    row = np.searchsorted(offsets[1:], start, side="right")
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    # words of equal hash but another length are kept apart
    name = mix64(span_names(data, start) + (end - start).astype(np.uint64))
    uniq, pick, back = np.unique(name, return_index=True, return_inverse=True)
    at, size = ids.lookup(uniq, start[pick], end[pick], data)
    at, size = at[back], size[back]
    total = np.concatenate([[0], np.cumsum(size)])
    counts = total[first[1:]] - total[first[:-1]] + 1
    out = np.full(int(counts.sum()), end_id, np.int32)
    n = int(total[-1])
    source = np.repeat(at - total[:-1], size) + np.arange(n)
    row = np.repeat(row, size)  # each text before leaves one end id
    out[np.arange(n) + row] = ids.ids[source]
    return out, counts


def word_ids(path: str) -> WordIds:
    """This worker's memo, kept from task to task."""
    if path not in _STATE:
        _STATE[path] = WordIds(path)
    return _STATE[path]


def _encoder(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        before = 0  # ids of this task so far
        for batch in batches:
            for part in slices(batch, "text"):
                flat, counts = encoded(part.column("text"), ids, end_id)
                ends = before + np.cumsum(counts)
                before += len(flat)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ends - counts), pa.array(counts), lists(flat, counts, pa.int32())],
                                                 names=["doc_id", "start", "n_tokens", "ids"])
    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes ``docs(doc_id, text, ..)`` as ORC token files in ascending doc_id order."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.asc_nulls_last("doc_id"), F.octet_length("text"), F.xxhash64("text")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order)
    (d.mapInArrow(_encoder(tokenizer, end_id), SCHEMA).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").option("orc.create.index", "true")
     .option("orc.row.index.stride", str(ROW_STRIDE)).option("compression", "zstd").orc(path))


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """The records, or those of some doc_ids: the filter reaches ORC's row index and Bloom filters."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df if ids is None else df.where(F.col("doc_id").isin(ids))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column("ids")
        at = col.offsets.to_numpy()
        flat = np.ascontiguousarray(col.values.to_numpy(zero_copy_only=False), "<u4")
        crc = [zlib.crc32(flat[x:y]) for x, y in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()),
                                          b.column("part")], names=["doc_id", "start", "n_tokens", "ids_crc32", "part"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids of all records before it), n_tokens, ids_crc32."""
    # the number of the writing task; ranges ascend with it
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("part")
    d = read_tokens(spark, path)
    sizes = d.select(part, "n_tokens").groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    sizes = sizes.select(F.col("part").alias("p"), F.coalesce(F.sum("of_part").over(before), F.lit(0)).alias("base"))
    d = d.select("doc_id", "start", "ids", part).mapInArrow(_measure, "doc_id long, start long, n_tokens long, ids_crc32 long, part long")
    return d.join(F.broadcast(sizes), F.col("part") == F.col("p")).select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_index(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Writes token files (below the shared folder unless ``path`` is given) and returns their index."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return token_index(docs.sparkSession, path)
