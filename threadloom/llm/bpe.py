"""Byte-level BPE encoding and decoding with the vocabulary file of a public tokenizer.

Pre-tokens are cut by the tokenizer's pattern; those not met before by a task are encoded together: the symbols of all of
them lie in one flat array, and each round finds every adjacent pair in the sorted merge keys by binary search, takes
the lowest rank of each word and merges its occurrences from the left.  Words without a pair leave the array.  A cache
of encoded words, emptied when it is full, saves work and changes no result.

Defined cases: null and empty texts have no ids and decode to the empty text.  Special tokens in a text are encoded as
such.  Rows are encoded one by one, so repeated rows, ties and further columns have no effect; an empty table stays
empty.  Texts of any length are cut into pre-tokens as a stream.  Only ``doc_id`` and ``text`` (or ``ids``) are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import flat
from .common import prepare, texts

#: The pattern that splits text before byte-level merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers assigned after Unicode 16, which the vocabulary's library still counts as neither.
NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
]
#: First UTF-8 byte of the smallest of them.
NEWER_LEAD_BYTE = 0xD5
CACHE_BYTES = 24 << 20
STREAM_CHARS = 1 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it is printable Latin-1, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


def _weight(word: str) -> int:
    """About the bytes that a cached word takes: its text, its ids and the overhead of both."""
    return 200 + 4 * len(word)


class Codec:
    """Encoder and decoder of one vocabulary file (the JSON of the ``tokenizers`` library, byte-level BPE)."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        letters = byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.width = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = [b""] * self.width
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        newer = "".join(chr(a) + "-" + chr(b) for a, b in NEWER)
        self.newer = regex.compile(f"[{newer}]")
        self.pattern = regex.compile(PATTERN)
        self.careful = regex.compile("(?V1)" + PATTERN.replace(r"\p{L}", rf"[\p{{L}}--[{newer}]]", 1).replace(r"\p{N}", rf"[\p{{N}}--[{newer}]]", 1).replace(
            r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]"))
        self.fixed = {t: i.to_bytes(4, "little") for t, i in self.special.items()}
        self.known, self.held = dict(self.fixed), 0

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the offsets of the words in it."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owner = [], []
        never = len(self.ranks)
        while len(symbols):
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.append(np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], never), never)
            begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            counts = np.diff(np.append(begins, len(symbols)))
            lowest = np.minimum.reduceat(rank, begins)
            closed = np.repeat(lowest == never, counts)
            if closed.any():
                done_symbols.append(symbols[closed])
                done_owner.append(owner[closed])
                open_ = ~closed
                symbols, owner, rank = symbols[open_], owner[open_], rank[open_]
                lowest, counts = lowest[lowest < never], counts[lowest < never]
            if not len(symbols):
                break
            take = rank == np.repeat(lowest, counts)
            hits = np.flatnonzero(take)
            run = np.flatnonzero(np.append(True, np.diff(hits) > 1))  # overlapping pairs: every second from the left
            place = np.arange(len(hits)) - np.repeat(run, np.diff(np.append(run, len(hits))))
            hits = hits[place % 2 == 0]
            symbols[hits] = self.merged[rank[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done_symbols:
            return np.zeros(0, np.uint32), np.zeros(len(words) + 1, np.int64)
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        ids = np.concatenate(done_symbols)[order].astype("<u4")
        return ids, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet; afterwards all of ``words`` are known."""
        new = [w for w in words if w not in self.known]
        if self.held + sum(map(_weight, new)) > CACHE_BYTES:
            self.known, self.held = dict(self.fixed), 0
            new = [w for w in words if w not in self.known]
        self.held += sum(map(_weight, new))
        for i in range(0, len(new), 50_000):
            part = new[i:i + 50_000]
            ids, at = self.merge_words([w.encode() for w in part])
            data = ids.tobytes()
            cuts = (at * 4).tolist()
            self.known.update((w, data[a:b]) for w, a, b in zip(part, cuts, cuts[1:]))

    def cut(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text in bounded lists; special tokens stand alone."""
        pieces = self.special_pattern.split(text) if self.special and any(t in text for t in self.special) else [text]
        for i, piece in enumerate(pieces):
            plain = not piece or np.frombuffer(piece.encode(), np.uint8).max() < NEWER_LEAD_BYTE or not self.newer.search(piece)
            pattern = self.pattern if plain else self.careful
            if i % 2:
                yield [piece]
            elif len(piece) <= STREAM_CHARS:
                yield pattern.findall(piece)
            else:
                found = (m.group() for m in pattern.finditer(piece))
                while part := list(islice(found, 100_000)):
                    yield part

    def encode(self, values: list[str | None]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers."""
        cuts = [list(self.cut(v or "")) if len(v or "") <= STREAM_CHARS else v for v in values]
        self.learn(set().union(*(piece for cut in cuts if isinstance(cut, list) for piece in cut)))
        out = []
        for cut in cuts:
            if isinstance(cut, list):
                out.append(b"".join(map(self.known.__getitem__, chain.from_iterable(cut))))
        if len(out) == len(cuts):
            return out
        short = iter(out)
        return [next(short) if isinstance(cut, list) else self._encode_long(cut) for cut in cuts]

    def _encode_long(self, text: str) -> bytes:
        parts = []
        for piece in self.cut(text):
            self.learn(set(piece))
            parts.append(b"".join(map(self.known.__getitem__, piece)))
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _codec(digest: str, data: bytes) -> Codec:
    return Codec(data)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes, a few MB whatever the corpus, sent to every executor."""
    prepare(spark)
    with open(path, "rb") as file:
        data = file.read()
    return spark.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), data))


def encode(docs: DataFrame, vocab: Broadcast) -> DataFrame:
    """``doc_id`` and ``ids array<int>`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*vocab.value)
        for batch in batches:
            for part in flat.slices(batch):
                values = part.column(1).to_pylist()
                found = codec.encode(values)
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)], ["doc_id", "ids"])

    return texts(docs).mapInArrow(flat.tidy(run), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, vocab: Broadcast) -> DataFrame:
    """``doc_id`` and the ``text`` of every list of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*vocab.value)
        for batch in batches:
            for key, ids in _lists(batch):
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([codec.decode(ids)])], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(flat.tidy(run), "doc_id long, text string")


def _lists(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    column = batch.column(1)
    at = column.offsets.to_numpy()
    values = column.values.to_numpy()
    for i, key in enumerate(batch.column(0).to_pylist()):
        yield key, values[at[i]:at[i + 1]]


def digests(tokens: DataFrame, vocab: Broadcast) -> DataFrame:
    """Per list of ids: its length, the digest of the ids and the digest of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*vocab.value)
        for batch in batches:
            rows = [(key, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                    for key, ids in _lists(batch)]
            keys, sizes, first, second = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return tokens.select("doc_id", F.col("ids")).mapInArrow(flat.tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
