"""Secret scans: patterns of known shapes, and the token-efficiency test.

Known shapes are assignments to secret names, access keys and long hex runs. The token-efficiency test takes runs of
20 and more key characters that hold a letter and are not of a few characters over and over, and counts the tokens that a tiktoken vocabulary needs for
them: words and identifiers give some three characters a token, random strings fewer than two. Of a run that is not marked as a
whole, the stretches of 20 and more characters between its words are tested alone, as words dilute the ratio. Known digests (hex of a
digest's length), UUIDs, numbers and names whose parts code as words do are excluded, and so is what lies within a base
span.

Defined results: null text counts as empty; a text without findings has counts 0, the hash of the empty string and
empty spans; spans count code points of the whole text, however long; repeated rows give repeated results; an empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from seqloom.llm.bpe import read_ranks
from seqloom.llm.common import ship, small

#: Fixed patterns: kind, pattern, group whose length counts, its least length. Kinds are in order of report.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
KINDS = ("assign", "access", "hex", "random")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LETTER, LETTERS = re.compile(r"[A-Za-z]"), re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Runs of fewer different characters are rules and repeats, not random strings.
DISTINCT = 8
#: Digest lengths in hex: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST = re.compile(r"(?i)(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})")
UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
#: Words, each with digits at its end at most, joined by separators: names, slugs, paths.
NAME = re.compile(r"(?:[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]+)(?:[_/=+-]+(?:[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]+))*[_/=+-]*")
PART = re.compile(r"[^_/=+-]+")
WORD = re.compile(r"[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+[0-9]{0,4}")
#: Fewer characters a token than this mark a random string.
RATIO = 2.0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known shapes, by start and then kind."""
    found = []
    for k, (_, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


@functools.cache
def vocabulary(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def unworded(run: str) -> list[tuple[int, int]]:
    """(start, end) of the longest stretches of the run's parts between separators without words, UUIDs and digests;
    numbers count within a stretch only."""
    out, at = [], 0
    known = [*UUID.finditer(run)]
    for m in [*known, None]:
        end = m.start() if m else len(run)
        stretch = None
        for part in PART.finditer(run, at, end):
            if WORD.fullmatch(part[0]) or DIGEST.fullmatch(part[0]):
                out += [stretch] if stretch else []
                stretch = None
            elif not part[0].isdigit():
                stretch = (stretch[0] if stretch else part.start(), part.end())
        out += [stretch] if stretch else []
        at = m.end() if m else end
    return out


def wordlike(run: str, coder: tiktoken.Encoding, ratio: float) -> bool:
    """Whether a name's parts of four letters and more code as words do, each by itself."""
    parts = [p for p in LETTERS.findall(run) if len(p) > 3]
    return not parts or sum(map(len, parts)) / sum(len(coder.encode_ordinary(p)) for p in parts) >= ratio


def random_spans(text: str, coder: tiktoken.Encoding, base: list[tuple[int, int, str]], ratio: float = RATIO) -> list[tuple[int, int, str]]:
    """(start, end, "random") of runs that the vocabulary codes badly."""
    def marked(s: int, e: int) -> bool:
        run = text[s:e]
        if not LETTER.search(run) or DIGEST.fullmatch(run) or UUID.fullmatch(run) or any(a <= s and e <= b for a, b, _ in base):
            return False
        if len(run) / len(coder.encode_ordinary(run)) >= ratio or len(set(run)) < DISTINCT:
            return False
        return not (NAME.fullmatch(run) and wordlike(run, coder, ratio))

    out = []
    for m in RUN.finditer(text):
        if marked(*m.span()):
            out.append((*m.span(), "random"))
        else:
            # words joined to a random string hide it
            parts = [(m.start() + a, m.start() + b) for a, b in unworded(m[0]) if 20 <= b - a < len(m[0])]
            out += [(a, b, "random") for a, b in parts if marked(a, b)]
    return out


def scan(docs: DataFrame, path: str, pattern: str, ratio: float = RATIO) -> DataFrame:
    """doc_id and found: array of (kind, start, end, random?) by start, then kind."""
    ship(docs.sparkSession)

    def run(batches):
        coder = vocabulary(path, pattern)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in small(batches):
            rows = []
            for t in b.column("text").to_pylist():
                base = base_spans(t) if t else []
                more = random_spans(t, coder, base, ratio) if t else []
                rows.append([{"kind": k, "start": s, "end": e} for s, e, k in sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, found array<struct<kind:string,start:long,end:long>>")


def written(found: list[dict]) -> str:
    return ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in found)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
