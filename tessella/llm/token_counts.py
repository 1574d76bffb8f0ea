"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch lie end to end in one array of symbol ids.
In a round every sequence finds its lowest pair rank and applies that pair at
all its places at once; the arrays are then compacted, and sequences without a
mergeable pair leave. The surviving symbols are counted.

The vocabulary is a piece model with scores (merge order) and byte fallback.
White space shows as U+2581. No piece of such a model continues past a word
into the next white space, so texts split exactly there; a model for which this
is untrue is merged over whole texts.

Applying one rank at all places equals the serial order unless a merge opens a
pair of an even lower rank. Such ranks are found when the model is loaded, and
for them only the leftmost place is applied in a round.

Defined cases: null text counts as empty (0 tokens); repeated rows give
repeated results; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, read_table

LIMIT = 4096
SPACE = "▁"
KEPT_EACH = 500_000
KEPT_LENGTH = 48
ROUND_SYMBOLS = 1 << 20
NO_RANK = np.iinfo(np.int32).max


class PieceCounter:
    def __init__(self, pieces: list[str], scores: list[float], dummy_prefix: bool = True):
        """``pieces`` and ``scores``: the mergeable pieces, without control and byte entries."""
        known = dict.fromkeys(pieces)
        loose = {c for p in pieces for c in p} - set(known)
        self.ids = {p: i for i, p in enumerate([*known, *sorted(loose)])}
        self.base = len(self.ids) + 1
        self.prefix = dummy_prefix
        rank_of = {s: i for i, s in enumerate(sorted(set(scores), reverse=True))}
        pairs: dict[int, tuple[int, int]] = {}
        for piece, score in zip(pieces, scores, strict=True):
            for i in range(1, len(piece)):
                left, right = self.ids.get(piece[:i]), self.ids.get(piece[i:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = (rank_of[score], self.ids[piece])
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int32)
        # The best rank that a symbol takes part in, against the rank that makes it.
        best = np.full(self.base, NO_RANK, dtype=np.int64)
        np.minimum.at(best, self.keys // self.base, self.ranks)
        np.minimum.at(best, self.keys % self.base, self.ranks)
        self.careful = np.zeros(len(rank_of) + 1, dtype=bool)
        self.careful[self.ranks[best[self.made] <= self.ranks]] = True
        # A pre-token may end before each white space that follows another character.
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.find = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.whole = {p for p in known if all(c in self.ids for c in p)}
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def normal(self, text: str) -> str:
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def pre_tokens(self, text: str) -> list[str]:
        text = self.normal(text)
        return self.find(text) if self.splits else [text] if text else []

    def _pair_ranks(self, symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
        """For each place the index of the pair that starts there, or -1."""
        out = np.full(len(symbols), -1, dtype=np.int64)
        if len(symbols) < 2 or not len(self.keys):
            return out
        left, right = symbols[:-1].astype(np.int64), symbols[1:]
        able = np.flatnonzero((left >= 0) & (right >= 0) & ~last[:-1])
        key = left[able] * self.base + right[able]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        out[able[hit]] = at[hit]
        return out

    def count(self, pre_tokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token, all merged together."""
        n = len(pre_tokens)
        total = np.zeros(n, dtype=np.int64)
        chars = "".join(pre_tokens)
        if not chars:
            return total
        points = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        distinct, inverse = np.unique(points, return_inverse=True)
        look = np.array([self.ids.get(chr(c), -1) for c in distinct.tolist()], dtype=np.int32)
        width = 1 + (distinct > 0x7F).astype(np.int64) + (distinct > 0x7FF) + (distinct > 0xFFFF)
        symbols = look[inverse]
        lengths = np.fromiter(map(len, pre_tokens), dtype=np.int64, count=n)
        owner = np.repeat(np.arange(n), lengths)
        # Characters without a piece fall back to their bytes.
        weight = np.where(symbols < 0, width[inverse], 1)
        last = np.ones(len(symbols), dtype=bool)
        last[:-1] = owner[1:] != owner[:-1]
        pair = self._pair_ranks(symbols, last)
        while True:
            rank = np.where(pair >= 0, self.ranks[pair] if len(self.ranks) else NO_RANK, NO_RANK)
            starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            done = best == NO_RANK
            if done.any():
                # Finished sequences leave with their counts.
                per_seq = np.diff(np.append(starts, len(symbols)))
                total[owner[starts[done]]] += np.add.reduceat(weight, starts)[done]
                keep = ~np.repeat(done, per_seq)
                symbols, owner, weight, last, pair, rank = (x[keep] for x in (symbols, owner, weight, last, pair, rank))
                if not len(symbols):
                    return total
                starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
                best = best[~done]
            per_seq = np.diff(np.append(starts, len(symbols)))
            chosen = rank == np.repeat(best, per_seq)
            # Overlapping places: the leftmost of a run goes first, then every other one.
            place = np.flatnonzero(chosen)
            fresh = np.ones(len(place), dtype=bool)
            fresh[1:] = (place[1:] != place[:-1] + 1) | (owner[place[1:]] != owner[place[:-1]])
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))
            place = place[(np.arange(len(place)) - run_start) % 2 == 0]
            slow = self.careful[rank[place]]
            if slow.any():
                first = np.ones(len(place), dtype=bool)
                first[1:] = owner[place[1:]] != owner[place[:-1]]
                place = place[first | ~slow]
            symbols[place] = self.made[pair[place]]
            last[place] = last[place + 1]
            keep = np.ones(len(symbols), dtype=bool)
            keep[place + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[place]
            symbols, owner, weight, last, pair = (x[keep] for x in (symbols, owner, weight, last, pair))
            # Only pairs beside a new symbol have changed.
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            pair[touched] = -1
            inner = touched[(touched < len(symbols) - 1)]
            inner = inner[~last[inner]]
            left, right = symbols[inner].astype(np.int64), symbols[inner + 1]
            able = (left >= 0) & (right >= 0)
            inner, key = inner[able], (left * self.base + right)[able]
            spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[spot] == key
            pair[inner[hit]] = spot[hit]

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [self.pre_tokens(t) for t in texts]
        if len(self.young) >= KEPT_EACH:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new: list[str] = []
        size = 0
        own: dict[str, int] = {}

        def settle() -> None:
            nonlocal new, size
            for piece, n in zip(new, self.count(new).tolist(), strict=True):
                (young if len(piece) <= KEPT_LENGTH else own)[piece] = n
            new, size = [], 0

        out = []
        for pieces in split:
            for piece in set(pieces):
                if piece not in young:
                    known = old.get(piece)
                    if known is not None:
                        young[piece] = known
                    elif piece not in own:
                        new.append(piece)
                        size += len(piece)
                        if size > ROUND_SYMBOLS:
                            settle()
        settle()
        for pieces in split:
            if own:
                out.append(sum(young[p] if p in young else own[p] for p in pieces))
            else:
                out.append(sum(map(young.__getitem__, pieces)))
        return out


def load_pieces(path: str) -> PieceCounter:
    """A counter for a sentencepiece BPE model with an identity normaliser."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    usual = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    probe = "é  a①ﬁ "
    if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("only models that leave texts as they are can be counted")
    return PieceCounter([model.id_to_piece(i) for i in usual], [model.get_score(i) for i in usual])


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return load_pieces(path)


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = counter(model_path)
        for batch in batches:
            counts = own.count_texts(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_bytes": batch["n_bytes"], "n_tokens": counts})

    text = clean_text(F.col(text_col))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return source.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
