"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word's symbols stand in an array; leaf i of the tree holds the merge rank of the pair that starts at symbol i. The root
holds the lowest rank, the path of left-most minima leads to the leftmost pair that has it, and a merge changes three
leaves. A word of n bytes thus takes O(n log n), however long it is.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from headway.llm.common import Batches, texts_of, with_columns

# Fixed value: how text is cut into words before the merges of this family of vocabularies.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Words kept in each of the two generations of a worker's cache, and the longest word kept. They bound memory only.
CACHED_WORDS = 400_000
CACHED_WORD_LENGTH = 48


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256."""
    printable = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def merge_word(symbols: list[int], merge_of: dict[int, tuple[int, int]], base: int) -> list[int]:
    """Apply merges, lowest rank first and leftmost among equals, until none applies.

    ``merge_of`` maps ``left * base + right`` to (rank, merged symbol).
    """
    count = len(symbols)
    if count < 2:
        return symbols
    none = (1 << 62, -1)
    look = merge_of.get
    width = 1 << (count - 2).bit_length() if count > 2 else 1
    tree = [none] * (2 * width)
    for i in range(count - 1):
        tree[width + i] = look(symbols[i] * base + symbols[i + 1], none)
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left[0] <= right[0] else right
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))

    def put(leaf: int, value: tuple[int, int]) -> None:
        node = width + leaf
        tree[node] = value
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left[0] <= right[0] else right

    while tree[1][1] >= 0:
        lowest, node = tree[1][0], 1
        while node < width:
            node *= 2
            if tree[node][0] != lowest:
                node += 1
        at = node - width
        gone = after[at]
        follower = after[gone]
        symbols[at] = tree[1][1]
        symbols[gone] = -1
        after[at] = follower
        if gone < count - 1:
            put(gone, none)
        if follower < count:
            before[follower] = at
            put(at, look(symbols[at] * base + symbols[follower], none))
        else:
            put(at, none)
        if before[at] >= 0:
            put(before[at], look(symbols[before[at]] * base + symbols[at], none))
    return [s for s in symbols if s >= 0]


class _Words(dict):
    """Ids of words as little-endian bytes: two generations, the older dropped when the newer is full."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= CACHED_WORD_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or spec["normalizer"] or not plain:
            raise ValueError(f"{path}: only byte-level BPE without normaliser, prefix space or affixes is supported")
        vocab: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t[flag] for t in spec["added_tokens"] for flag in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError(f"{path}: added tokens may not strip, be normalised or match single words only")
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in letters.items()}
        self.base = 1 + max([*vocab.values(), *special.values()])
        self.first = [vocab[letters[byte]] for byte in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merge_of = {vocab[a] * self.base + vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.bytes_of = {i: bytes(map(byte_of.__getitem__, token)) for token, i in vocab.items()}
        self.bytes_of |= {i: token.encode() for token, i in special.items()}
        self.special = {token: i.to_bytes(4, "little") for token, i in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, longest_first))) if special else None
        self.cut = regex.compile(WORD_PATTERN).findall
        self.words = _Words(self._encode_word)

    def _encode_word(self, word: str) -> bytes:
        first = self.first
        ids = merge_word([first[b] for b in word.encode()], self.merge_of, self.base)
        return np.array(ids, "<u4").tobytes()

    def _encode_plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.cut(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; special tokens in the text are recognised."""
        if not self.special_pattern or not any(token in text for token in self.special):
            return self._encode_plain(text)
        pieces, at = [], 0
        for found in self.special_pattern.finditer(text):
            pieces += (self._encode_plain(text[at : found.start()]), self.special[found.group()])
            at = found.end()
        return b"".join([*pieces, self._encode_plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        known = self.bytes_of
        try:
            data = b"".join(map(known.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        except KeyError:
            data = b"".join(known.get(i, b"") for i in np.frombuffer(ids, "<u4").tolist())
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> ByteBpe:
    """One vocabulary per worker and path."""
    return ByteBpe(path)


def _id_lists(encoded: list[bytes]) -> pa.Array:
    """Lists of ids from their bytes, without a Python object for each id."""
    ends = np.cumsum([0, *(len(ids) // 4 for ids in encoded)])
    values = pa.array(np.frombuffer(b"".join(encoded), "<u4").astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encode_texts(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with an array of token ids of each whole text.

    Null and empty texts have no ids; repeated rows are each encoded; an empty table stays empty; other columns pass
    through, and a column already called ``ids`` is replaced. No shuffle. Every executor must be able to read ``path``.
    """
    wanted = docs.drop(ids)

    def run(batches: Batches) -> Batches:
        encode = vocabulary(path).encode
        for batch in batches:
            yield with_columns(batch, {ids: _id_lists([encode(x or "") for x in texts_of(batch, text)])})

    return wanted.mapInArrow(run, StructType([*wanted.schema.fields, *StructType.fromDDL(f"`{ids}` array<int>").fields]))


def decode_ids(docs: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that each array of ids stands for; null and empty arrays give the empty text."""
    wanted = docs.drop(text)

    def run(batches: Batches) -> Batches:
        decode = vocabulary(path).decode
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            texts = [decode(np.asarray(row.values, "<u4").tobytes()) if row.is_valid else "" for row in lists]
            yield with_columns(batch, {text: pa.array(texts, pa.string())})

    return wanted.mapInArrow(run, StructType([*wanted.schema.fields, *StructType.fromDDL(f"`{text}` string").fields]))


def digest_columns(docs: DataFrame, path: str) -> DataFrame:
    """Per ``doc_id``: number of ids, digest of the ids, digest of the text they decode to."""
    encoded = encode_texts(docs.select("doc_id", "text"), path).drop("text")

    def run(batches: Batches) -> Batches:
        decode = vocabulary(path).decode
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("token_ids"))
            ids = [np.asarray(row.values, "<u4").tobytes() for row in lists]
            new = {
                "n_tokens": lists.value_lengths().cast(pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(decode(x).encode()).hexdigest() for x in ids], pa.string()),
            }
            yield with_columns(batch.select(["doc_id"]), new)

    kind = dict(docs.dtypes)["doc_id"]
    return encoded.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
