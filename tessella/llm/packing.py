"""Best-fit packing: bounded-space online best-fit.

A fixed number of bins is open at any time. The open bins hang in buckets by
their free space, and one bitset marks the buckets that hold a bin, so the
fullest bin that still takes a piece is one shift and one lowest-set-bit away.
When a new bin is needed and all are open, the fullest one closes first.

Texts are tokenised where they are read; only (document, piece, start, length,
checksum) goes on. That small table is written to the shared folder, counted,
and dealt to as many packers as it has multiples of ``pieces_per_packer``; each
packer streams its pieces and holds at most ``open_bins`` bins.

Defined cases: a null text counts as empty (one piece holding the end id); a
null id stays null; repeated rows are packed once each; an empty table gives
an empty table; further input columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, cut, partitions_for, read_table

CAPACITY = 1024
END_ID = 2
OPEN_BINS = 4096
PIECES_PER_PACKER = 400_000
PIECE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEQUENCE_SHIFT = 40


class BestFit:
    """Online best-fit over at most ``open_bins`` bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int):
        if capacity < 1 or open_bins < 1:
            raise ValueError("capacity and open_bins must be positive")
        self.capacity, self.open_bins = capacity, open_bins
        self.marks = 0
        self.buckets: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0
        self.n_bins = 0

    def _take(self, free: int) -> int:
        bucket = self.buckets[free]
        found = bucket.pop()
        if not bucket:
            self.marks &= ~(1 << free)
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The bin for a piece and the piece's offset in it."""
        if not 0 <= length <= self.capacity:
            raise ValueError(f"a piece of {length} does not fit {self.capacity}")
        fitting = self.marks >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.marks & -self.marks).bit_length() - 1)
                self.n_open -= 1
            free, chosen = self.capacity, self.n_bins
            self.n_bins += 1
            self.n_open += 1
        left = free - length
        if left:
            self.buckets[left].append(chosen)
            self.marks |= 1 << left
        else:
            self.n_open -= 1
        return chosen, self.capacity - free


@lru_cache(maxsize=1)
def _shown() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


def _raw(token: str) -> bytes:
    return bytes(_shown()[c] for c in token)


def engine_fits(spec: dict) -> bool:
    """Whether ids can serve as merge ranks: byte-level BPE without further steps, merges and their results in one order."""
    model, before = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not spec.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return False
    vocab = model["vocab"]
    if not set(_shown()) <= vocab.keys() or spec.get("truncation") or spec.get("padding"):
        return False
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    added = {t["content"] for t in spec.get("added_tokens", ())}
    return made == sorted(set(made)) and len(made) + 256 == sum(t not in added for t in vocab) and max(vocab[c] for c in _shown()) < made[0]


class Encoder:
    """Ids as the ``tokenizers`` library gives them for a byte-level BPE file.

    Where the file's vocabulary is in merge order and nothing but the byte-level
    split precedes the merges, ids serve as merge ranks and the merges run in
    tiktoken's engine, about five times faster. A text that holds one of the file's
    added tokens goes to the library itself, as do all texts of other files.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", ())]
        ranks = {_raw(t): i for t, i in spec["model"]["vocab"].items() if t not in self.added} if engine_fits(spec) else {}
        self.library = Tokenizer.from_file(path)
        self.engine = None if not engine_fits(spec) else tiktoken.Encoding("file", pat_str=PIECE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.engine is None or any(a in text for a in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(self.engine.encode_to_numpy(text, disallowed_special=()), dtype="<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first takes the rest."""
    first = n % capacity or min(n, capacity)
    out = [(0, first)]
    out += [(s, capacity) for s in range(first, n, capacity)]
    return out


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, on request, ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.concatenate([encode(text), end])
                for k, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    own = ids[start : start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(own.tobytes()), *([own.astype("i4")] if with_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(F.col(text_col)).alias("text"))
    return source.mapInPandas(run, schema)


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, pieces_per_packer: int = PIECES_PER_PACKER
) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece and length (at most ``capacity``)."""
    pieces = cut(pieces, "pieces")
    packers = partitions_for(pieces.count(), pieces_per_packer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << SEQUENCE_SHIFT
        for batch in batches:
            placed = [bins.place(n) for n in batch["length"].tolist()]
            batch["sequence_id"] = np.array([base + b for b, _ in placed], dtype="i8")
            batch["offset"] = np.array([o for _, o in placed], dtype="i8")
            yield batch

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    # The number of the row in the written table parts rows that are alike; a task that runs again finds the same numbers.
    dealt = pieces.withColumn("_deal", F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())).repartition(packers, "_deal")
    return dealt.sortWithinPartitions("_deal", "doc_id", "piece").drop("_deal").mapInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, **options) -> DataFrame:
    """Tokenise, cut and pack a table of documents."""
    pieces = token_pieces(docs, tokenizer, capacity, with_ids=with_ids)
    return pack(pieces, capacity, **options)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), default_tokenizer())
