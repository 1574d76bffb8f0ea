"""Suffix-array deduplication by prefix-free parsing.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. Strings are judged on the input.

*Phrases.* A rolling hash of ``TRIGGER`` bytes is taken everywhere; the trigger of
a string is the place of its least hash (the leftmost one of equals). Adjacent
strings with one trigger form a phrase, and phrases overlap by ``LENGTH - 1``
bytes, so every string lies in exactly one phrase, and equal strings have equal
triggers at equal distance wherever they occur. (Triggers at a fixed residue of
the hash would leave phrases without bound, and would not say where equal strings
meet: every suffix would have to be dealt out by itself, some 8 bytes a byte.)

*Filter.* Trigger hashes of all documents are dealt out by value; only phrases
whose trigger occurs in two documents go on. A trigger with more than ``HOT``
occurrences (a passage that many documents share) is hot: its phrases are cut
into their single strings, which are dealt out by their own bytes, so the many
variants at the ends of such a passage spread over all tasks.

*Dictionary.* Distinct phrases are dealt out by trigger. The suffixes of a
dictionary that are at least ``LENGTH`` long form its suffix array, in the order
of their first ``LENGTH`` bytes; where neighbours share that many, a class of
equal strings goes on.

*Parse.* The parse of a dictionary is the documents of its phrases. Its suffix
array lists them by phrase and then by document; since no string reaches into a
next phrase, suffixes of the parse differ in their first element or not at all.

*Corpus order.* The two arrays merge: a class of the dictionary's array takes the
first entry of the parse's array for each of its phrases, which gives the first
document of the class in corpus order. A phrase in a document gets a bit mask of
the strings that start earlier.

Before anything is dealt out, occurrences are combined: a trigger or phrase goes
once per task and input file, with the smallest and the largest of its documents
there. What comes back for a phrase and a file is the strings that start earlier
than all those documents, and for other strings the document after which they
count. So a string in a third of all documents costs its tasks, not its documents.

*Cut.* Masks go back to the texts. Texts themselves are never shuffled: what is
dealt back is filed by the input file of a document in the shared folder, and
the tasks that scan that file read it.

Between tasks go packed arrays, not rows: about 8 bytes a phrase in the filter,
and each distinct phrase once per task. Memory of a task is bounded by
``PART_BYTES`` for parsing, ``FLUSH`` phrases for sending, and for sorting by the
triggers or phrases of ``SORT_BYTES`` of text, a few at most for each byte; there are
``PARTS_EACH`` times ``spark.sql.shuffle.partitions`` parts or more.

Defined cases: null text counts as empty; texts under ``LENGTH`` bytes lose
nothing; rows without an id neither lose nor cause anything; rows that repeat
an id are one document's (never earlier than each other); an empty table gives
an empty table; other columns are ignored or, in :func:`remove_repeats`, kept.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, cut, fresh_path, read_table

LENGTH = 50
TRIGGER = 24
WINDOW = LENGTH - TRIGGER + 1
PART_BYTES = 1 << 20
FLUSH = 1_200_000
FLUSH_PHRASES = 200_000
PARTS_EACH = 3
SORT_BYTES = 64 << 20
FILES_EACH = 16
HOT = 1 << 16
VERIFY_ROWS = 1 << 18
#: Columns that pass through a table with any columns of its own.
FILE, NEW = "_tessella_file", "_tessella_kept"

K = 0x9E3779B97F4A7C15
POSITION = np.uint64((1 << 24) - 1)
NONE = np.iinfo(np.int64).min
#: In a filed value beside the WINDOW bits of strings: documents after the filed one only, whose number has a high word; more strings follow.
AFTER, HIGH, MORE = (np.uint32(1 << b) for b in (29, 30, 31))
STRINGS = np.uint32((1 << WINDOW) - 1)
BYTE = np.random.default_rng(515253).integers(1, 1 << 63, 256, dtype=np.uint64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(K, n, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """K**i and its inverse modulo 2**64."""
    n = PART_BYTES + 4 * LENGTH
    up = np.full(n, K, dtype=np.uint64)
    down = np.full(n, pow(K, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Phrases:
    """The phrases of some segments of documents, as arrays."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, doc: np.ndarray, offset: np.ndarray):
        """``ends``, ``doc`` and ``offset`` (place in the document) of each segment of ``data``."""
        self.data = data
        n = len(data)
        if n < LENGTH:
            self.trigger = self.doc = self.lo = self.hi = self.at = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        h1 = BYTE[data]
        h2 = h1[:-1] * _power(1) + h1[1:]
        h4 = h2[:-2] * _power(2) + h2[2:]
        h8 = h4[:-4] * _power(4) + h4[4:]
        h16 = h8[:-8] * _power(8) + h8[8:]
        m = n - TRIGGER + 1
        rolled = mix(h16[:m] * _power(8) + h8[16 : 16 + m])
        key = (rolled & ~POSITION) | np.arange(m, dtype=np.uint64)
        m2 = np.minimum(key[:-1], key[1:])
        m4 = np.minimum(m2[:-2], m2[2:])
        m8 = np.minimum(m4[:-4], m4[4:])
        m16 = np.minimum(m8[:-8], m8[8:])
        q = n - LENGTH + 1
        trigger = (np.minimum(m16[:q], m16[WINDOW - 16 : WINDOW - 16 + q]) & POSITION).astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        # Strings that end in another segment are none.
        inside = np.ones(q, dtype=bool)
        for end in ends[:-1].tolist():
            inside[max(0, end - LENGTH + 1) : end] = False
        inside[max(0, int(ends[-1]) - LENGTH + 1) :] = False
        s = np.flatnonzero(inside)
        segment = np.searchsorted(ends, s, side="right")
        trigger = trigger[s]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (segment[1:] != segment[:-1])
        first = np.flatnonzero(new)
        self.lo = s[first]
        self.hi = s[np.append(first[1:], len(s))[: len(first)] - 1] if len(first) else self.lo
        self.trigger = trigger[first]
        self.hash = rolled[self.trigger]
        own = segment[first]
        self.doc = doc[own]
        self.at = self.lo - starts[own] + offset[own]

    def split(self, hot: np.ndarray) -> None:
        """Cut the phrases where ``hot`` is set into phrases of one string; ``alone`` tells which those are."""
        self.alone = hot
        if not hot.any():
            return
        n = np.where(hot, self.hi - self.lo + 1, 1)
        own = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        self.alone = hot[own]
        self.lo, self.at = self.lo[own] + step, self.at[own] + step
        self.hi = np.where(self.alone, self.lo, self.hi[own])
        self.trigger, self.hash, self.doc = self.trigger[own], self.hash[own], self.doc[own]

    def identity(self) -> np.ndarray:
        """A number for each phrase's trigger hash and bytes."""
        up, down = _powers()
        total = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[self.data] * up[: len(self.data)], dtype=np.uint64)])
        whole = (total[self.hi + LENGTH] - total[self.lo]) * down[self.lo]
        return mix(mix(whole + (self.hi - self.lo).astype(np.uint64)) ^ self.hash)


def parse(texts: list[bytes]) -> Iterator[Phrases]:
    """Phrases of the texts, in parts; a text over PART_BYTES is cut into overlapping segments."""
    held: list[tuple[bytes, int, int]] = []
    size = 0

    def made() -> Phrases:
        data = np.frombuffer(b"".join(s for s, _, _ in held), dtype=np.uint8)
        ends = np.cumsum([len(s) for s, _, _ in held])
        return Phrases(data, ends, np.array([d for _, d, _ in held]), np.array([o for _, _, o in held]))

    step = PART_BYTES // 2
    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), step):
            segment = text[offset : offset + step + LENGTH - 1]
            if len(segment) < LENGTH:
                continue
            if size + len(segment) > PART_BYTES:
                yield made()
                held, size = [], 0
            held.append((segment, i, offset))
            size += len(segment)
    if held:
        yield made()


def filed_key(identity: np.ndarray, turn: int, word: int) -> np.ndarray:
    """The key of a phrase's values: of each turn the strings, and the low and high word of a document's number."""
    return mix(identity + np.uint64((3 * turn + word) * 0x9E6C63D0876A9A47 & (1 << 64) - 1))


def extremes(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct key, in order: the key, its number of rows, and its smallest and largest document."""
    if not len(key):
        return key, np.zeros(0, np.int64), doc, doc
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.diff(np.append(first, len(key))), np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)


# --- filing by input file ---------------------------------------------------


def file_marks(rows: DataFrame, folder: str) -> None:
    """File the packed arrays of rows (f, b, key, value) as ``folder/f-b``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        unit, keys, values = None, [], []

        def write() -> pd.DataFrame:
            key, value = np.frombuffer(b"".join(keys), "<u8"), np.frombuffer(b"".join(values), "<u4")
            order = np.argsort(key, kind="stable")
            name = f"{root}/{unit[0]}-{unit[1]}"
            # A task that runs twice writes the same bytes under the same name.
            part = f"{name}.{uuid.uuid4().hex}.part"
            with store.open_output_stream(part) as out:
                out.write(np.int64(len(key)).tobytes() + key[order].tobytes() + (value[order].tobytes() if len(value) else b""))
            try:
                store.move(part, name)
            except OSError:
                # Some stores do not move onto a file that another attempt has left.
                if store.get_file_info(name).type != fs.FileType.File:
                    raise
                store.delete_file(part)
            return pd.DataFrame([(unit[0], unit[1], len(key))], columns=["f", "b", "n"])

        for batch in batches:
            for f, b, key, value in zip(batch["f"], batch["b"], batch["key"], batch["value"], strict=True):
                if unit != (f, b):
                    if unit is not None:
                        yield write()
                    unit, keys, values = (f, b), [], []
                keys.append(key)
                values.append(value)
        if unit is not None:
            yield write()

    dealt = rows.repartition("f", "b").sortWithinPartitions("f", "b")
    cut(dealt.mapInPandas(run, "f string, b int, n long"), "filed")


class Marks:
    """What was filed for an input file: sorted keys, and values if there are any."""

    def __init__(self, folder: str):
        self.folder, self.of, self.keys, self.values = folder, None, None, None

    def load(self, f: str) -> None:
        if self.of == f:
            return
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.folder)
        keys, values = [], []
        for info in store.get_file_info([f"{root}/{f}-{b}" for b in range(FILES_EACH)]):
            if info.type != fs.FileType.File:
                continue
            with store.open_input_stream(info.path) as source:
                data = source.read()
            n = int(np.frombuffer(data[:8], "<i8")[0])
            keys.append(np.frombuffer(data, "<u8", n, 8))
            values.append(np.frombuffer(data, "<u4", (len(data) - 8 - 8 * n) // 4, 8 + 8 * n))
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        value = np.concatenate(values) if values else np.zeros(0, np.uint32)
        order = np.argsort(key, kind="stable")
        self.keys = key[order]
        self.values = value[order] if len(value) else value
        self.of = f

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and where."""
        if not len(self.keys):
            return np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key, at


class Found:
    """What the passes filed in a folder: triggers, the hot ones among them, and masks."""

    def __init__(self, folder: str):
        self.triggers, self.hot, self.masks = Marks(f"{folder}/triggers"), Marks(f"{folder}/triggers"), Marks(f"{folder}/masks")

    def load(self, f: str) -> None:
        self.hot.load(f"{f}-hot")
        self.masks.load(f)

    def split(self, part: Phrases) -> Phrases:
        part.split(self.hot.find(part.hash >> np.uint64(16))[0])
        return part


# --- the four passes ---------------------------------------------------------


def _per_file(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """Runs of rows of one input file: file, ids, texts."""
    for batch in batches:
        f = batch["f"].to_numpy()
        bounds = np.append(np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])), len(f)) if len(f) else [0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = batch.iloc[a:b]
            yield f[a], part["doc_id"].to_numpy(dtype=np.int64), [bytes(t) for t in part["data"]]


def send_triggers(source: DataFrame, parts: int) -> DataFrame:
    """Packed arrays of trigger hashes (6 bytes each), dealt by value.

    Per p: hash, once for the first and once for another last document of a file;
    doc, n, f (runs of hashes of one document and file); files; again (hashes that
    occur more often in a file) and times (how often).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, docs, files, names = [], [], [], {}
        size = 0

        def flush() -> pd.DataFrame:
            f = np.concatenate(files)
            key, n, least, most = extremes((np.concatenate(hashes) & ~np.uint64(0xFFFF)) | f, np.concatenate(docs))
            again = n > 1
            again, times = key[again] >> np.uint64(16), n[again]
            deal = again % np.uint64(parts)
            order = np.argsort(deal, kind="stable")
            again, times, deal = again[order], times[order], deal[order]
            other = most > least
            key, d = np.concatenate([key, key[other]]), np.concatenate([least, most[other]])
            h, f = key >> np.uint64(16), key & np.uint64(0xFFFF)
            p = h % np.uint64(parts)
            order = np.lexsort((d, f, p))
            h, d, f, p = h[order], d[order], f[order], p[order]
            bounds = np.append(np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])), len(p))
            rows = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                new = np.concatenate([[True], (d[a + 1 : b] != d[a : b - 1]) | (f[a + 1 : b] != f[a : b - 1])])
                run = a + np.flatnonzero(new)
                lo, hi = np.searchsorted(deal, [p[a], p[a] + np.uint64(1)])
                rows.append((
                    int(p[a]), pack(h[a:b]), d[run].astype("<i8").tobytes(), np.diff(np.append(run, b)).astype("<u4").tobytes(),
                    f[run].astype("<u2").tobytes(), list(names), pack(again[lo:hi]), times[lo:hi].astype("<u4").tobytes(),
                ))
            return pd.DataFrame(rows, columns=["p", "hash", "doc", "n", "f", "files", "again", "times"])

        for name, ids, texts in _per_file(batches):
            number = names.setdefault(name, len(names))
            for part in parse(texts):
                hashes.append(part.hash)
                docs.append(ids[part.doc])
                files.append(np.full(len(part.hash), number, dtype=np.uint16))
                size += len(part.hash)
            if size >= FLUSH or len(names) > 60_000:
                yield flush()
                hashes, docs, files, names, size = [], [], [], {}, 0
        if size:
            yield flush()

    return source.mapInPandas(run, "p int, hash binary, doc binary, n binary, f binary, files array<string>, again binary, times binary")


def pack(h: np.ndarray) -> bytes:
    """Six bytes of each number."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.zeros((len(data) // 6, 8), np.uint8)
    raw[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return raw.view("<u8").ravel()


def repeated_triggers(sent: DataFrame, parts: int, hot: int) -> DataFrame:
    """For triggers in two documents or more: f, b, key (packed hashes), value (empty); hot ones again under f-hot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by p; a partition may hold several.
        p_now, held = None, []

        def flush() -> Iterator[pd.DataFrame]:
            hashes, docs, files, often, counts, names = [], [], [], [], [], {}
            for packed, doc, n, f, its, again, times in held:
                hashes.append(unpack(packed))
                n = np.frombuffer(n, "<u4")
                docs.append(np.repeat(np.frombuffer(doc, "<i8"), n))
                table = np.array([names.setdefault(x, len(names)) for x in its])
                files.append(np.repeat(table[np.frombuffer(f, "<u2")], n))
                often.append(unpack(again))
                counts.append(np.frombuffer(times, "<u4"))
            h, d, f = np.concatenate(hashes), np.concatenate(docs), np.concatenate(files)
            order = np.argsort(h, kind="stable")
            h, d, f = h[order], d[order], f[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            several = np.minimum.reduceat(d, first) < np.maximum.reduceat(d, first)
            n = np.diff(np.append(first, len(h)))
            # A file's first and last document count twice at most; that only makes a trigger hot a little earlier.
            total = n + np.bincount(np.searchsorted(h[first], np.concatenate(often)), np.concatenate(counts), len(first))
            keep, heat = np.repeat(several, n), np.repeat(total > hot, n)
            h, f, heat = h[keep], f[keep], heat[keep]
            order = np.lexsort((f, h))
            h, f, heat = h[order], f[order], heat[order]
            fresh = np.ones(len(h), dtype=bool)
            fresh[1:] = (h[1:] != h[:-1]) | (f[1:] != f[:-1])
            h, f, heat = h[fresh], f[fresh], heat[fresh]
            yield from by_file(h, f, list(names), p_now)
            yield from by_file(h[heat], f[heat], [f"{x}-hot" for x in names], p_now)

        for batch in batches:
            for p, *row in zip(*(batch[c] for c in ("p", "hash", "doc", "n", "f", "files", "again", "times")), strict=True):
                if p != p_now:
                    if held:
                        yield from flush()
                    p_now, held = p, []
                held.append(row)
        if held:
            yield from flush()

    dealt = sent.repartition(parts, "p").sortWithinPartitions("p")
    return dealt.mapInPandas(run, "f string, b int, key binary, value binary")


def by_file(key: np.ndarray, f: np.ndarray, names: list[str], p: int, value: np.ndarray | None = None) -> Iterator[pd.DataFrame]:
    order = np.argsort(f, kind="stable")
    key, f = key[order], f[order]
    value = value[order] if value is not None else None
    bounds = np.append(np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])), len(f)) if len(f) else [0]
    rows = [(names[f[a]], p % FILES_EACH, key[a:b].astype("<u8").tobytes(), value[a:b].astype("<u4").tobytes() if value is not None else b"") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    yield pd.DataFrame(rows, columns=["f", "b", "key", "value"])


def send_phrases(source: DataFrame, folder: str, parts: int) -> DataFrame:
    """Phrases with a repeated trigger, each once per task, with the first and last of its documents in each file.

    They are dealt by trigger, strings of hot triggers by their bytes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filed = Found(folder)
        held: list[tuple] = []
        names: dict[str, int] = {}
        size = 0

        def flush() -> pd.DataFrame:
            ident, deal, n, d, f = (np.concatenate([x[i] for x in held]) for i in range(5))
            content = np.concatenate([x[5] for x in held])
            begin = np.concatenate([[0], np.cumsum(n)])[:-1]
            _, first, word = np.unique(ident, return_index=True, return_inverse=True)
            p = (deal % np.uint64(parts))[first]
            by_part = np.argsort(p, kind="stable")
            place = np.empty(len(first), np.int64)
            place[by_part] = np.arange(len(first))
            first, p = first[by_part], p[by_part]
            key, _, least, most = extremes(place[word] * len(names) + f, d)
            other = most > least
            key, d = np.concatenate([key, key[other]]), np.concatenate([least, most[other]])
            order = np.argsort(key, kind="stable")
            key, d = key[order], d[order]
            occ, f = key // len(names), key % len(names)
            bounds = np.append(np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])), len(p))
            rows = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                own = first[a:b]
                lens = n[own]
                index = np.repeat(begin[own] - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
                lo, hi = np.searchsorted(occ, [a, b])
                times = np.bincount(occ[lo:hi] - a, minlength=b - a)
                rows.append((int(p[a]), ident[own].astype("<u8").tobytes(), lens.astype("u1").tobytes(), content[index].tobytes(), times.astype("<u4").tobytes(), d[lo:hi].astype("<i8").tobytes(), f[lo:hi].astype("<u2").tobytes(), list(names)))
            return pd.DataFrame(rows, columns=["p", "ident", "len", "content", "times", "doc", "f", "files"])

        for name, ids, texts in _per_file(batches):
            filed.triggers.load(name)
            filed.hot.load(f"{name}-hot")
            number = names.setdefault(name, len(names))
            for part in parse(texts):
                part = filed.split(part)
                found = np.flatnonzero(filed.triggers.find(part.hash >> np.uint64(16))[0])
                if not len(found):
                    continue
                lens = part.hi[found] - part.lo[found] + LENGTH
                index = np.repeat(part.lo[found] - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
                ident = part.identity()[found]
                deal = np.where(part.alone[found], mix(ident), part.hash[found] >> np.uint64(16))
                held.append((ident, deal, lens, ids[part.doc[found]], np.full(len(found), number, np.int64), part.data[index]))
                size += len(found)
                if size >= FLUSH_PHRASES or len(names) > 60_000:
                    yield flush()
                    held, size = [], 0
                    names = {name: 0}
                    number = 0
        if held:
            yield flush()

    return source.mapInPandas(run, "p int, ident binary, len binary, content binary, times binary, doc binary, f binary, files array<string>")


def _fingerprints(content: np.ndarray) -> np.ndarray:
    """A number for the LENGTH bytes at each place."""
    h1 = BYTE[content]
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h32 = h16[:-16] * _power(16) + h16[16:]
    n = len(content) - LENGTH + 1
    return mix(h32[:n] * _power(18) + h16[32 : 32 + n] * _power(2) + h2[48 : 48 + n])


def words_at(content: np.ndarray, at: np.ndarray, width: int = 8) -> np.ndarray:
    """The ``width`` bytes at each place as numbers that compare as the bytes do."""
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        out <<= np.uint64(8)
        out |= content[at + k]
    return out


def string_order(content: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The order of the strings of LENGTH bytes at ``start``, word by word; ties are sorted on, others are done."""
    order = np.arange(len(start))
    place, group = order.copy(), np.zeros(len(start), np.int64)
    for at in range(0, LENGTH, 8):
        key = words_at(content, start[order[place]] + at, min(8, LENGTH - at))
        inner = np.lexsort((key, group)) if at else np.argsort(key, kind="stable")
        order[place] = order[place[inner]]
        key, group = key[inner], group[inner]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        tied = ~new | ~np.append(new[1:], True)
        group, place = np.cumsum(new)[tied], place[tied]
        if not len(place):
            break
    return order


def suffix_array(content: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of phrases that are LENGTH or longer, sorted by their first LENGTH bytes.

    Returns the phrase of each suffix in phrase order, the suffix array (an order
    of them), and for each place in it whether it shares fewer than LENGTH bytes
    with the one before. Equal strings are brought together by a fingerprint and
    compared byte by byte; one of each then takes part in the sorting.
    """
    n = lens - LENGTH + 1
    phrase = np.repeat(np.arange(len(lens), dtype=np.int32), n)
    start = (np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))).astype(np.int32 if len(content) < 1 << 31 else np.int64)
    finger = np.empty(len(start), np.uint64)
    ends = np.cumsum(n)
    low = 0
    while low < len(n):
        # Phrases lie in order of ``begin``, so a run of them is a stretch of bytes.
        high = max(low + 1, int(np.searchsorted(begin, begin[low] + PART_BYTES)))
        base, top = int(begin[low]), int(begin[high - 1] + lens[high - 1])
        a, b = int(ends[low] - n[low]), int(ends[high - 1])
        finger[a:b] = _fingerprints(content[base:top])[start[a:b] - base]
        low = high
    order = np.argsort(finger, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = finger[order[1:]] != finger[order[:-1]]
    del finger
    wide = np.arange(LENGTH)
    check = np.flatnonzero(~new)
    for a in range(0, len(check), VERIFY_ROWS):
        i = check[a : a + VERIFY_ROWS]
        left, right = content[start[order[i - 1]][:, None] + wide], content[start[order[i]][:, None] + wide]
        if (left != right).any():
            # Fingerprints of unequal strings met: all strings are sorted.
            order, new = string_order(content, start), np.ones(len(order), dtype=bool)
            for c in range(1, len(order), VERIFY_ROWS):
                j = np.arange(c, min(c + VERIFY_ROWS, len(order)))
                new[j] = (content[start[order[j - 1]][:, None] + wide] != content[start[order[j]][:, None] + wide]).any(1)
            return phrase, order, new
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(order)))
    rank = string_order(content, start[order[heads]])
    n_of = sizes[rank]
    first = np.cumsum(n_of) - n_of
    out = order[np.repeat(heads[rank] - first, n_of) + np.arange(len(order))]
    new = np.zeros(len(order), dtype=bool)
    new[first] = True
    return phrase, out, new


def parse_array(phrase: np.ndarray, doc: np.ndarray, n_phrases: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a parse (its entries by phrase, then by document), and where each phrase begins in it."""
    order = np.lexsort((doc, phrase))
    return order, np.searchsorted(phrase[order], np.arange(n_phrases))


def check_equal(content: np.ndarray, begin: np.ndarray, lens: np.ndarray, first: np.ndarray, word: np.ndarray) -> None:
    """Phrases with one number must have the same bytes; an error else (another seed of BYTE then parts them)."""
    other = np.flatnonzero(first[word] != np.arange(len(word)))
    same = first[word[other]]
    if (lens[other] != lens[same]).any():
        raise ValueError("two phrases have one number")
    for a in range(0, len(other), VERIFY_ROWS // 4):
        i, j = other[a : a + VERIFY_ROWS // 4], same[a : a + VERIFY_ROWS // 4]
        n = lens[i]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        if (content[np.repeat(begin[i], n) + step] != content[np.repeat(begin[j], n) + step]).any():
            raise ValueError("two phrases have one number")


def conditions(ident: np.ndarray, at: np.ndarray, n: np.ndarray, of_start: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, rows and values to file for phrases, of which some strings start earlier than some documents of a file.

    ``at`` and ``n`` place a phrase's strings in ``of_start``, their first documents;
    ``low`` and ``high`` are the file's first and last document with the phrase.
    """
    row = np.repeat(np.arange(len(n)), n)
    bit = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    first = of_start[np.repeat(at, n) + bit]
    some = first < high[row]
    row, bit, first = row[some], bit[some], first[some]
    # Strings that are earlier than the whole file need no condition.
    first = np.where(first < low[row], NONE, first)
    order = np.lexsort((first, row))
    row, bit, first = row[order], bit[order], first[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (first[1:] != first[:-1])]))
    strings = np.add.reduceat(np.uint32(1) << bit.astype(np.uint32), new, dtype=np.uint32)
    row, first = row[new], first[new]
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    turn = np.arange(len(row)) - np.repeat(head, np.diff(np.append(head, len(row))))
    low_word, high_word = (first & 0xFFFFFFFF).astype(np.uint32), (first >> 32 & 0xFFFFFFFF).astype(np.uint32)
    after = first != NONE
    strings |= np.where(after, AFTER, 0).astype(np.uint32) | np.where(after & (high_word > 0), HIGH, 0).astype(np.uint32)
    strings[:-1] |= np.where(row[1:] == row[:-1], MORE, 0).astype(np.uint32)
    out = []
    for j in range(int(turn.max()) + 1):
        for word, values, which in ((0, strings, turn == j), (1, low_word, (turn == j) & after), (2, high_word, (turn == j) & after & (high_word > 0))):
            out.append((filed_key(ident[row[which]], j, word), row[which], values[which]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def judge_phrases(sent: DataFrame, parts: int) -> DataFrame:
    """f, b, key (packed keys of phrases), value (packed strings that start earlier, and after which document)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p_now, held = None, []

        def flush() -> Iterator[pd.DataFrame]:
            names: dict[str, int] = {}
            idents, lens, contents, times, docs, files = [], [], [], [], [], []
            for ident, n, content, many, doc, f, its in held:
                idents.append(np.frombuffer(ident, "<u8"))
                lens.append(np.frombuffer(n, "u1").astype(np.int64))
                contents.append(np.frombuffer(content, np.uint8))
                times.append(np.frombuffer(many, "<u4"))
                docs.append(np.frombuffer(doc, "<i8"))
                table = np.array([names.setdefault(x, len(names)) for x in its])
                files.append(table[np.frombuffer(f, "<u2")])
            held.clear()
            every, n, content = np.concatenate(idents), np.concatenate(lens), np.concatenate(contents)
            d, f = np.concatenate(docs), np.concatenate(files)
            begin = np.cumsum(n) - n
            ident, first, word = np.unique(every, return_index=True, return_inverse=True)
            check_equal(content, begin, n, first, word)
            occ = np.repeat(word, np.concatenate(times))
            # In the order in which their bytes lie, which suffix_array() reads in stretches.
            order = np.argsort(first, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            first, ident, occ = first[order], ident[order], rank[occ]
            del every, word, idents, contents, docs
            in_parse, head_of = parse_array(occ, d, len(ident))
            n, begin = n[first], begin[first]
            phrase, order, new = suffix_array(content, begin, n)
            heads = np.flatnonzero(new)
            # Corpus order: of the phrases of a class, the first entry in the parse's array.
            least = np.minimum.reduceat(d[in_parse][head_of][phrase[order]], heads)
            of_start = np.empty(len(order), np.int64)
            of_start[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
            n_starts = n - LENGTH + 1
            at = np.cumsum(n_starts) - n_starts
            last = np.maximum.reduceat(of_start, at)
            soonest = np.minimum.reduceat(of_start, at)
            key, _, low, high = extremes(occ * len(names) + f, d)
            occ, f = key // len(names), key % len(names)
            whole = np.flatnonzero(last[occ] < low)
            bits = (np.uint64(1) << n_starts[occ[whole]].astype(np.uint64)) - np.uint64(1)
            yield from by_file(filed_key(ident[occ[whole]], 0, 0), f[whole], list(names), p_now, bits.astype(np.uint32))
            part = np.flatnonzero((last[occ] >= low) & (soonest[occ] < high))
            for a in range(0, len(part), VERIFY_ROWS):
                rows = part[a : a + VERIFY_ROWS]
                keys, own, values = conditions(ident[occ[rows]], at[occ[rows]], n_starts[occ[rows]], of_start, low[rows], high[rows])
                yield from by_file(keys, f[rows[own]], list(names), p_now, values)

        for batch in batches:
            for p, *row in zip(batch["p"], batch["ident"], batch["len"], batch["content"], batch["times"], batch["doc"], batch["f"], batch["files"], strict=True):
                if p != p_now:
                    if held:
                        yield from flush()
                    p_now, held = p, []
                held.append(row)
        if held:
            yield from flush()

    dealt = sent.repartition(parts, "p").sortWithinPartitions("p")
    return dealt.mapInPandas(run, "f string, b int, key binary, value binary")


def without_nulls(batch: pd.DataFrame) -> pd.DataFrame:
    return batch.assign(doc_id=batch["doc_id"].fillna(0))


def covered(texts: list[bytes], ids: np.ndarray, filed: Found) -> tuple[np.ndarray, np.ndarray]:
    """For the texts end to end, which bytes go; and the texts' bounds. A text with the id NONE loses nothing."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    change = np.zeros(int(bounds[-1]) + 1, dtype=np.int32)
    masks = filed.masks
    for part in parse(texts):
        part = filed.split(part)
        ident, doc = part.identity(), ids[part.doc]
        rows, turn = np.flatnonzero(doc != NONE), 0
        while len(rows):
            found, at = masks.find(filed_key(ident[rows], turn, 0))
            rows, value = rows[found], masks.values[at[found]]
            limit = np.full(len(rows), NONE)
            after = np.flatnonzero(value & AFTER)
            limit[after] = masks.values[masks.find(filed_key(ident[rows[after]], turn, 1))[1]]
            high = np.flatnonzero(value & HIGH)
            limit[high] |= masks.values[masks.find(filed_key(ident[rows[high]], turn, 2))[1]].astype(np.int64) << 32
            goes = limit < doc[rows]
            begin, strings = bounds[part.doc[rows[goes]]] + part.at[rows[goes]], value[goes] & STRINGS
            for bit in range(WINDOW):
                s = begin[(strings >> np.uint32(bit)) & np.uint32(1) == 1] + bit
                np.add.at(change, s, 1)
                np.add.at(change, s + LENGTH, -1)
            rows, turn = rows[(value & MORE) > 0], turn + 1
    return np.cumsum(change[:-1]) > 0, bounds


def repeat_marks(source: DataFrame, hot: int) -> str:
    """Find the repeats of rows (f, doc_id, data); returns the folder that holds them by input file, for Found."""
    spark = source.sparkSession
    size = source.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    parts = max(PARTS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SORT_BYTES))
    folder = fresh_path(spark, "repeats")
    file_marks(repeated_triggers(send_triggers(source, parts), parts, hot), f"{folder}/triggers")
    file_marks(judge_phrases(send_phrases(source, folder, parts), parts), f"{folder}/masks")
    return folder


def with_files(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table, written to the shared folder unless it is a plain file scan, and its column of input files."""
    try:
        return docs, docs.withColumn(FILE, F.md5(F.col("_metadata.file_path")))
    except AnalysisException:
        docs = cut(docs, "input")
        return docs, docs.withColumn(FILE, F.md5(F.col("_metadata.file_path")))


def _source(named: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return named.select(F.col(FILE).alias("f"), F.col(id_col).cast("long").alias("doc_id"), clean_text(F.col(text_col)).cast("binary").alias("data"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, on request, kept (binary)."""
    _, named = with_files(docs)
    source = _source(named, id_col, text_col)
    folder = repeat_marks(source.where("doc_id is not null"), hot)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filed = Found(folder)
        for batch in batches:
            null = batch["doc_id"].isna().to_numpy()
            for name, ids, texts in _per_file([without_nulls(batch)]):
                filed.load(name)
                gone, bounds = covered(texts, np.where(null[: len(ids)], NONE, ids), filed)
                rows = []
                for i, text in enumerate(texts):
                    own = gone[bounds[i] : bounds[i + 1]]
                    n = int(own.sum())
                    spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if n else 0
                    kept = np.frombuffer(text, np.uint8)[~own].tobytes() if n else text
                    rows.append((len(text), n, spans, hashlib.sha256(kept).hexdigest(), *([kept] if with_kept else [])))
                out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept)
                out.insert(0, "doc_id", pd.Series(ids, dtype="Int64").mask(null[: len(ids)]))
                null = null[len(ids) :]
                yield out

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    return source.mapInPandas(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """The table with repeated bytes cut out of ``text_col``; characters that lose a byte go whole."""
    docs, named = with_files(docs)
    folder = repeat_marks(_source(named, id_col, text_col).where("doc_id is not null"), hot)

    @F.pandas_udf("string")
    def kept(f: pd.Series, doc_id: pd.Series, data: pd.Series) -> pd.Series:
        filed = _found(folder)
        frame = pd.DataFrame({"f": f, "doc_id": doc_id, "data": data})
        out: list[str | None] = []
        for name, ids, texts in _per_file([frame]):
            filed.load(name)
            gone, bounds = covered(texts, ids, filed)
            for i, text in enumerate(texts):
                own = gone[bounds[i] : bounds[i + 1]]
                out.append((np.frombuffer(text, np.uint8)[~own].tobytes() if own.any() else text).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    usable = F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    # Rows without id or text pass through; the function sees empty data for them.
    safe = named.withColumn(NEW, kept(FILE, F.coalesce(F.col(id_col).cast("long"), F.lit(0)), clean_text(F.when(usable, F.col(text_col))).cast("binary")))
    return safe.withColumn(text_col, F.when(usable, F.col(NEW)).otherwise(F.col(text_col))).drop(NEW, FILE)


@lru_cache(maxsize=1)
def _found(folder: str) -> Found:
    return Found(folder)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(read_table(spark, sf_dir, "documents"))


ORACLE_OP4 = """
with b as (select doc_id, hex(coalesce(text, '')) as h, strlen(coalesce(text, '')) as n from documents),
k as (select doc_id, n, h, unnest(range(n // 1000 + 1)) as j from b),
w as (select doc_id, j, substr(h, 2000 * j + 1, 2098) as part, unnest(range(least(1000, n - 49 - 1000 * j))) as i from k),
s as (select doc_id, 1000 * j + i as i, substr(part, 2 * i + 1, 100) as s from w),
f as (select s, min(doc_id) as first from s group by s having min(doc_id) < max(doc_id)),
m as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > 50, true) as fresh from s join f using (s) where first < doc_id),
g as (select doc_id, i, sum(fresh::int) over (partition by doc_id order by i) as run from m),
r as (select doc_id, run, min(i) as a, max(i) + 50 as z from g group by doc_id, run),
e as (select doc_id, coalesce(lag(z) over (partition by doc_id order by run), 0) as from_, a as to_, run, z - a as cut from r
  union all select b.doc_id, coalesce(max(z), 0), any_value(n), coalesce(max(run), 0) + 1, null from b left join r on b.doc_id = r.doc_id group by b.doc_id),
v as (select e.doc_id, coalesce(sum(cut), 0)::bigint as n_removed, count(cut) as n_spans, string_agg(substr(h, 2 * from_ + 1, 2 * (to_ - from_)), '' order by run) as kept
  from e join b on e.doc_id = b.doc_id group by e.doc_id)
select b.doc_id, n as n_bytes, n_removed, n_spans, sha256(unhex(kept)) as kept_sha256 from b join v on b.doc_id = v.doc_id
"""
