"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

All distinct new words of a batch lie in one flat array of symbols.  A round looks up every
neighbouring pair by binary search over the sorted pair keys of the merge list, finds the lowest
rank of each word, merges that pair everywhere in the word, and drops words that are done.  A
merged symbol only takes part in later (higher) ranks, so merging all places of the lowest pair
at once gives the same ids as merging one at a time.

The file is a ``tokenizers`` JSON of a byte-level BPE without normalizer; its path is a parameter
and must name the same file on every executor.

Edge cases: null counts as the empty text, which has no ids and decodes to the empty text; the
string of an added token is that token wherever it stands; rows are treated one by one, so
repeated rows and ids, null ids and an empty table need no rule; other columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import ROW, column, in_parts, map_arrow, nested

#: Fixed value: how byte-level BPE cuts a text into words (white space as Unicode defines it).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The same for texts of ASCII and Latin letters only, which the faster standard engine can cut.
_LETTERS, _WHITE = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"\x09-\x0D\x20"
USUAL_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_WHITE}0-9{_LETTERS}]+"
    rf"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
UNUSUAL = re.compile(f"[^\\x00-\\x7f{_LETTERS}]")
SHIFT = np.int64(20)
PART_CHARACTERS = 4 << 20
NO_RANK = np.int64(1 << 40)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Known(dict):
    """Numbers of words; ``new`` lists those numbered but not encoded yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.new.append(word)
        return i


class Bpe:
    """The arrays of one vocabulary and a bounded store of words already encoded."""

    def __init__(self, path: str, most_words: int = 250_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        symbol = byte_symbols()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces = {i: bytes(symbol[c] for c in t) for t, i in vocab.items()}
        pieces |= {i: t.encode() for t, i in added.items()}
        self.byte_id = np.empty(256, np.int64)
        for c, b in symbol.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << int(SHIFT)) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.word = regex.compile(PATTERN)
        self.usual_word = re.compile(USUAL_PATTERN)
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        size = max(pieces) + 1
        lengths = np.zeros(size, np.int64)
        for i, p in pieces.items():
            lengths[i] = len(p)
        self.piece_at = np.concatenate([[0], np.cumsum(lengths)])
        self.piece_bytes = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(size)), np.uint8)
        self.most_words = most_words
        self.forget()

    def forget(self) -> None:
        self.known = _Known()
        self.at = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.int64)
        for text, i in self.added.items():
            self.known[text]
            self._store(np.array([i], np.int64), np.array([1], np.int64))
        self.known.new.clear()

    def _store(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, flat])

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair by binary search; ``NO_RANK`` for one that is never merged."""
        key = (left << SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over many words: ids of all words, and how many each has."""
        n = len(lengths)
        owner = np.repeat(np.arange(n, dtype=np.int64), lengths)
        done_owner, done_symbols = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        rank = np.full(len(symbols), NO_RANK)
        inner = np.flatnonzero(~last)
        rank[inner] = self.pair_ranks(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, last[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            low = np.repeat(best, sizes)
            if (best == NO_RANK).any():
                over = low == NO_RANK
                done_owner.append(owner[over])
                done_symbols.append(symbols[over])
                symbols, owner, rank, low, last = (x[~over] for x in (symbols, owner, rank, low, last))
            hit = np.flatnonzero(rank == low)
            if not len(hit):
                break
            # In a run of overlapping hits (a pair of equal symbols) every other one counts, from the left.
            where = np.arange(len(hit))
            first = np.append(True, np.diff(hit) > 1)
            hit = hit[(where - np.maximum.accumulate(np.where(first, where, 0))) % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            last[hit] = last[hit + 1]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[hit] = True
            before = hit[hit > 0] - 1
            changed[before] = True
            changed[before[~stay[before]] - 1] = True  # the neighbour on the left was merged away, too
            symbols, owner, rank, last, changed = (x[stay] for x in (symbols, owner, rank, last, changed))
            rank[changed & last] = NO_RANK
            look = np.flatnonzero(changed & ~last)
            rank[look] = self.pair_ranks(symbols[look], symbols[look + 1])
        owner, symbols = np.concatenate(done_owner), np.concatenate(done_symbols)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=n)

    def learn(self, words: list[str]) -> None:
        """Encode words not seen yet."""
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self._store(*self.merge(self.byte_id[np.frombuffer(b"".join(raw), np.uint8)], lengths))

    def split(self, text: str) -> list[str]:
        word = self.word if UNUSUAL.search(text) else self.usual_word
        if not any(map(text.__contains__, self.added)):
            return word.findall(text)
        parts = self.special.split(text)
        return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else word.findall(p))]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > self.most_words:
            self.forget()
        numbers = []
        for t in texts:
            words = self.split(t) if t else []
            numbers.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        if self.known.new:
            self.learn(self.known.new)
            self.known.new.clear()
        return [gather(self.flat, self.at, n) for n in numbers]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens as UTF-8; what is not UTF-8 becomes U+FFFD."""
        raw = gather(self.piece_bytes, self.piece_at, ids).tobytes()
        return raw.decode("utf-8", "replace").encode()


def gather(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The concatenated ``flat[at[r]:at[r + 1]]`` of all ``rows``."""
    starts, sizes = at[rows], at[rows + 1] - at[rows]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "input_ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as ``out`` (array of int), in place of a column of that name."""
    rows = docs.select(nested(docs), column(text).alias("text"))
    kind = rows.schema[ROW].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        ids = [i for part in in_parts(b.column("text").to_pylist(), PART_CHARACTERS) for i in bpe.encode(part)]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = np.concatenate([np.empty(0, np.int64), *ids]).astype(np.int32)
        return pa.RecordBatch.from_arrays([b.column(ROW), pa.ListArray.from_arrays(ends, flat)], [ROW, "ids"])

    done = map_arrow(rows, batch, f"{ROW} {kind}, ids array<int>")
    return done.select(*[F.col(ROW).getField(c).alias(c) for c in docs.columns if c != out], F.col("ids").alias(out))


def decode(df: DataFrame, path: str, ids: str = "input_ids", out: str = "text") -> DataFrame:
    """``df`` with the text of ``ids`` as ``out``, in place of a column of that name; null ids give ''."""
    rows = df.select(nested(df), column(ids).alias("ids"))
    kind = rows.schema[ROW].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        texts = [bpe.decode(np.asarray(i or [], np.int64)).decode() for i in b.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(ROW), pa.array(texts, pa.string())], [ROW, "decoded"])

    done = map_arrow(rows, batch, f"{ROW} {kind}, decoded string")
    return done.select(*[F.col(ROW).getField(c).alias(c) for c in df.columns if c != out], F.col("decoded").alias(out))


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, then decode the ids: ``(key, n_tokens, ids_sha256, decoded_sha256)`` of each row."""
    kind = docs.schema[key].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe, rows = load(path), []
        for part in in_parts(b.column("text").to_pylist(), PART_CHARACTERS):
            for ids in bpe.encode(part):
                packed = ids.astype("<u4").tobytes()
                rows.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
        n, a, d = zip(*rows, strict=True)
        arrays = [b.column("id"), pa.array(n, pa.int64()), pa.array(a), pa.array(d)]
        return pa.RecordBatch.from_arrays(arrays, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    light = docs.select(column(key).alias("id"), column(text).alias("text"))
    out = map_arrow(light, batch, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", key)
