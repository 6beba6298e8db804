"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token of n bytes is a doubly linked list of parts. Each mergeable pair of neighbours waits in the bucket of its
merge rank, a list of positions. A bitmap of two levels over the ranks (256 buckets a word, and one word over the words) says
which buckets are in use; the next rank is found by find-first-set from the top, so taking the lowest rank costs two
steps however many pairs wait. Entries are not removed when a neighbour is merged: they are checked when taken and
skipped if stale. A bucket's positions are taken from the left, as the lowest rank's leftmost pair merges first.

Text is cut into spans that no match of the pattern crosses (before a space that precedes a non-space), and spans and
pre-tokens that a task meets again are looked up. Vocabulary files are read from their path, never copied.

Defined results: null text counts as empty and has no tokens; every byte is in the vocabulary, so any text encodes and
decodes to itself; repeated rows give repeated results and an empty table an empty one; long texts and pre-tokens cost n log n; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import ship, small

#: Entries of a task's young look-up table; when it is full it becomes the old one, and what is met there comes back.
HELD = 400_000
#: Bits of a rank within a word of the bitmap: 256 buckets a word, one word over the words.
WORD, MASK = 8, 255
BIT = [1 << i for i in range(256)]
#: Fixed pattern of the byte-level vocabularies; texts are cut into spans under this one alone.
STANDARD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: One of these after letters, at the end of a span, is a pre-token of its own.
STOPS = frozenset(".,;:!?")
#: White space next to white space or at the end.
WIDE = re.compile(r"\s(?:\s|\Z)")
LONG = 40


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    """The rank of each token of a tiktoken rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@functools.cache
def _two_bytes(key: int) -> tuple[list[int | None], int]:
    """The rank of each pair of bytes, of the vocabulary that ``merge`` was given, and the words of its bitmap."""
    ranks = _known[key]
    return [ranks.get(bytes((i >> 8, i & 255))) for i in range(1 << 16)], (max(ranks.values()) >> WORD) + 1


_known: dict[int, dict[bytes, int]] = {}


def merge(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token. The queue is written out here: calls would cost more than its steps."""
    if (whole := ranks.get(data)) is not None:
        return [whole]
    _known[id(ranks)] = ranks
    two, size = _two_bytes(id(ranks))
    get, n = ranks.get, len(data)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    pair = [two[a << 8 | b] for a, b in zip(data, data[1:], strict=False)]
    pair.append(None)
    buckets: dict[int, int | list[int]] = {}  # a position, or a heap of several
    words = [0] * size
    top = 0
    for at, r in enumerate(pair):
        if r is not None:
            if r in buckets:
                if type(held := buckets[r]) is int:
                    buckets[r] = [held, at]
                else:
                    held.append(at)  # positions ascend, so the list is a heap
            else:
                buckets[r] = at
                words[r >> WORD] |= BIT[r & MASK]
                top |= 1 << (r >> WORD)
    while top:
        a = (top & -top).bit_length() - 1
        bits = words[a]
        one = bits & -bits
        rank = a << WORD | one.bit_length() - 1
        i = buckets[rank]
        if type(i) is int or len(i) == 1:
            del buckets[rank]
            words[a] = bits = bits ^ one
            if not bits:
                top &= top - 1
            if type(i) is not int:
                i = i[0]
        else:
            i = heapq.heappop(i)
        if pair[i] != rank:
            continue  # stale: a neighbour was merged since
        j = after[i]
        k = end[i] = end[j]
        pair[j] = None
        after[i] = nxt = after[j]
        if nxt < n:
            before[nxt] = i
            r = pair[i] = get(data[i : end[nxt]])
        else:
            r = pair[i] = None
        at = i
        while True:  # the new pair on the right, then the one on the left
            if r is not None:
                if r in buckets:
                    if type(held := buckets[r]) is int:
                        buckets[r] = [held, at] if held < at else [at, held]
                    else:
                        heapq.heappush(held, at)
                else:
                    buckets[r] = at
                    words[r >> WORD] |= BIT[r & MASK]
                    top |= 1 << (r >> WORD)
            if at != i or (at := before[i]) < 0:
                break
            r = pair[at] = get(data[at:k])
    out, i = [], 0
    while i < n:
        out.append(ranks[data[i : end[i]]])
        i = after[i]
    return out


def spans(text: str) -> list[str]:
    """The text in spans that no pre-token of STANDARD crosses: cut before a space that precedes a non-space and,
    where white space stands alone everywhere, around newlines too."""
    if "\0" not in text and not WIDE.search(text):
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


def letters(s: str) -> bool:
    """Whether a span is one pre-token of letters."""
    return s.isalpha() or s[:1] == " " and s[1:].isalpha()


class Known:
    """Two generations of looked-up spans: a full young table becomes the old one, from which what is met again comes
    back. Spans of LONG characters and more are let go when ``forget`` is called."""

    def __init__(self, held: int = HELD):
        self.young, self.old, self.held, self.long = {}, {}, held, []

    def table(self, wanted: set[str], fresh) -> dict:
        """A table with all wanted spans. ``fresh`` adds what neither generation has, given the list and the table."""
        young = self.young
        new = wanted.difference(young)
        if new:
            if len(young) + len(new) > self.held:
                self.old, young, new = young, {}, wanted
                self.young = young
            old, missing = self.old, []
            for s in new:
                if (v := old.get(s)) is None:
                    missing.append(s)
                else:
                    young[s] = v
            fresh(missing, young)
            self.long += [s for s in missing if len(s) >= LONG]
        return young

    def forget(self) -> None:
        for s in self.long:
            self.young.pop(s, None)
        self.long.clear()


class Encoder:
    """Encodes texts as the vocabulary's own library does for ordinary text."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.find = read_ranks(path), regex.compile(pattern).findall
        self.cut = spans if pattern == STANDARD else self.find
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.known = Known()

    def fresh(self, new: list[str], table: dict[str, tuple[int, ...]]) -> None:
        ranks = self.ranks

        def piece(p):
            if (ids := table.get(p)) is None:
                ids = tuple(merge(p.encode(), ranks))
                if len(p) < LONG:
                    table[p] = ids
            return ids

        for s in new:
            if self.cut is not spans or letters(s):
                table[s] = piece(s)
            elif s[-1:] in STOPS and letters(s[:-1]):
                table[s] = piece(s[:-1]) + piece(s[-1])
            else:
                table[s] = tuple(i for p in self.find(s) for i in piece(p))

    def encode(self, text: str) -> list[int]:
        cut = self.cut(text)
        table = self.known.table(set(cut), self.fresh)
        ids = list(chain.from_iterable(map(table.__getitem__, cut)))
        self.known.forget()
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.cache
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process, so that its look-up tables serve all its tasks."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of its text."""
    ship(docs.sparkSession)

    def run(batches):
        e = encoder(path, pattern)
        for b in small(batches):
            ids = [e.encode(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 of the ids in decimal, decoded_sha256 of the bytes decoded from the ids."""
    ship(docs.sparkSession)

    def run(batches):
        e = encoder(path, pattern)
        decimal = list(map(str, range(max(e.tokens) + 1)))
        for b in small(batches):
            counts, coded, plain = [], [], []
            for t in b.column("text").to_pylist():
                ids = e.encode(t or "")
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                plain.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(plain, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
