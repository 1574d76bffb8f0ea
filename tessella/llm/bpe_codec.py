"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of symbols. Every mergeable neighbour pair
waits in the bucket of its merge rank; three levels of bitmaps over the buckets
give the lowest non-empty rank by find-first-set. A popped position is skipped
if its pair has changed since it was filed (a stale entry). Work is linear in
the pre-token but for the bucket heaps, so very long pre-tokens stay cheap.

Each worker keeps the encodings of recent short pre-tokens, in two generations
of bounded size. Texts are encoded and decoded whole, in the task that reads
them; nothing is shuffled.

Letters, digits and white space are those of the library that is to be matched:
its classes are read from it once, in the driver, and texts that hold a character
which the pattern engine here classes otherwise are split by a corrected pattern.

Defined cases: a null text counts as empty (no ids); repeated rows give
repeated results; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from struct import pack
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, read_table

KEPT_EACH = 500_000
KEPT_LENGTH = 64
WORD = 63


class RankQueue:
    """Positions by rank; the lowest rank comes first, then the leftmost position."""

    def __init__(self, n_ranks: int):
        n0 = n_ranks // 64 + 1
        self.low, self.mid, self.top = [0] * n0, [0] * (n0 // 64 + 1), 0
        self.buckets: list[list[int] | None] = [None] * (n_ranks + 1)

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
        elif bucket is None:
            self.buckets[rank] = [position]
            self._mark(rank)
        else:
            bucket.append(position)
            self._mark(rank)

    def _mark(self, rank: int) -> None:
        word = rank >> 6
        if not self.low[word]:
            over = word >> 6
            if not self.mid[over]:
                self.top |= 1 << over
            self.mid[over] |= 1 << (word & WORD)
        self.low[word] |= 1 << (rank & WORD)

    def pop(self) -> tuple[int, int] | None:
        top = self.top
        if not top:
            return None
        i = (top & -top).bit_length() - 1
        bits = self.mid[i]
        word = (i << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        # The lowest bit of each level that runs empty goes.
        self.low[word] = bits & (bits - 1)
        if not self.low[word]:
            self.mid[i] &= self.mid[i] - 1
            if not self.mid[i]:
                self.top &= top - 1
        return rank, bucket.pop()


class Split(NamedTuple):
    """A pattern, the same with the library's character classes, and the characters on which they differ."""

    pattern: str
    exact: str
    odd: str


def _as_set(chars: set[str]) -> str:
    """The characters as ranges of a pattern's set."""
    codes = np.array(sorted(map(ord, chars)), dtype=np.int64)
    first = np.flatnonzero(np.diff(codes, prepend=-2) > 1)
    last = np.flatnonzero(np.diff(codes, append=1 << 40) > 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(codes[first], codes[last], strict=True))


@lru_cache(maxsize=2)
def library_split(pattern: str) -> Split:
    """The pattern with the classes of letters, digits and white space that tiktoken's engine has."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    bytes_only = {bytes([b]): b for b in range(256)}
    exact, odd = pattern, set()
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        if kind not in pattern:
            continue
        # Only what the pattern matches is encoded, here byte by byte.
        theirs = set(bytes(tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=bytes_only, special_tokens={}).encode_ordinary(every)).decode())
        ours = set(regex.findall(kind, every))
        more, less = theirs - ours, ours - theirs
        if more or less:
            odd |= more | less
            whole = f"[{kind}{_as_set(more)}]"
            exact = exact.replace(kind, f"[{whole}--[{_as_set(less)}]]" if less else whole)
    return Split(pattern, f"(?V1){exact}", "".join(sorted(odd))) if odd else Split(pattern, pattern, "")


class Codec:
    """Encode and decode by merge ranks; ids are ranks."""

    def __init__(self, ranks: dict[bytes, int], split: Split):
        import regex

        self.ranks = ranks
        self.words = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            self.words[rank] = word
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        # Every way to make a token of two, by their ids.
        self.pairs = {
            ranks[word[:i]] << 32 | ranks[word[i:]]: rank
            for word, rank in ranks.items() for i in range(1, len(word)) if word[:i] in ranks and word[i:] in ranks
        }
        self.find = regex.compile(split.pattern).findall
        self.find_exact = regex.compile(split.exact).findall
        self.odd = frozenset(split.odd)
        self.odd_from = min(map(ord, split.odd), default=0x110000)
        self.queue = RankQueue(len(self.words))
        self.young, self.old = _Young(self), {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        get, queue = self.pairs.get, self.queue
        push, pop, buckets = queue.push, queue.pop, queue.buckets
        one = self.byte_ids
        ids = [one[b] for b in piece]
        n = len(ids)
        end = list(range(1, n + 1))  # the place after the live symbol that starts at i
        before = list(range(-1, n))
        # The rank of the pair that starts at each place.
        filed = [get(left << 32 | right, -1) for left, right in zip(ids, ids[1:], strict=False)]
        filed.append(-1)
        for i, rank in enumerate(filed):
            if rank >= 0:
                if buckets[rank]:
                    buckets[rank].append(i)  # places only grow here, so the bucket stays a heap
                else:
                    push(rank, i)
        while (found := pop()) is not None:
            rank, i = found
            if filed[i] != rank:
                continue
            right = end[i]
            stop = end[i] = end[right]
            ids[i] = rank
            filed[right] = -1
            if stop < n:
                before[stop] = i
                new = filed[i] = get(rank << 32 | ids[stop], -1)
                if new >= 0:
                    push(new, i)
            else:
                filed[i] = -1
            left = before[i]
            if left >= 0:
                new = get(ids[left] << 32 | rank, -1)
                if filed[left] != new:
                    filed[left] = new
                    if new >= 0:
                        push(new, left)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        find = self.find if self._splits_alike(text) else self.find_exact
        return b"".join(map(self.young.__getitem__, find(text)))

    def _splits_alike(self, text: str) -> bool:
        """Whether a text has no character on which the engines differ."""
        if text.isascii() or not self.odd:
            return True
        if self.odd_from > 0xFF:
            try:
                text.encode("latin-1")
                return True
            except UnicodeEncodeError:
                pass
        return self.odd.isdisjoint(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Young(dict):
    """Recent pre-tokens; when full it becomes the old generation."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        codec = self.codec
        known = codec.old.get(piece)
        if known is None:
            known = pack(f"<{len(ids := codec.merge(piece.encode()))}I", *ids)
            if len(piece) > KEPT_LENGTH:
                return known
        if len(self) >= KEPT_EACH:
            codec.old = dict(self)
            self.clear()
        self[piece] = known
        return known


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def codec(path: str, split: Split) -> Codec:
    return Codec(read_ranks(path), split)


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of every whole text."""

    split = library_split(pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks_path, split)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": [own.encode(t) for t in batch["text"]]})

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(F.col(text_col)).alias("text"))
    return source.mapInPandas(run, "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, data (binary) for rows of doc_id and ids."""

    split = library_split(pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks_path, split)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "data": [own.decode(i or b"") for i in batch["ids"]]})

    return encoded.mapInPandas(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document the number of ids and the digests of ids and decoded bytes.

    Encoding and decoding share one Python stage, so a text crosses to Python
    once and only digests come back.
    """

    split = library_split(pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(ranks_path, split)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = own.encode(text)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out

    source = docs.select(F.col("doc_id").cast("long"), clean_text(F.col("text")).alias("text"))
    return source.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
