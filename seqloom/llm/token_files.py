"""Token ids as flat unsigned files with 64-bit document offsets.

Documents are dealt out by ranges of doc_id and sorted within them, so that the shards, in order, hold the documents
in ascending doc_id. Each task encodes its documents with the tokenizers library and writes three files: ``ids`` (the
narrowest unsigned integers that hold the vocabulary), ``off`` (64-bit offsets in ids from the shard's start, one more
than documents) and ``doc`` (64-bit doc_ids). A shard's row in the manifest names them; Spark's commit of the manifest
decides which attempt's files count. A shard's base is the sum of the shards before it. Readers map the files.

Defined results: null text counts as empty, so it has the end id alone; null doc_ids come first; rows that share a
doc_id follow each other by text; texts of any length are encoded whole; an empty table gives an empty manifest. doc_id is integral. Only doc_id and text are read.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm import files
from seqloom.llm.bpe import STOPS, Known, letters, spans
from seqloom.llm.common import shared_dir, ship, small, staged


#: Words that are encoded as one text.
WORDS = 200


class Speller:
    """Encodes texts with the tokenizers library; spans met before are looked up."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        marks = sorted(t.content for t in self.coder.get_added_tokens_decoder().values())
        self.marked = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.width = "<u2" if self.coder.get_vocab_size() <= 1 << 16 else "<u4"
        self.known = Known(700_000)

    def fresh(self, new: list[str], table: dict[str, bytes]) -> None:
        words = {s for s in new if s[:1] == " " and letters(s)}
        stopped = [s for s in new if s[-1:] in STOPS and s[:1] == " " and letters(s[:-1])]
        need = list(words.union(s[:-1] for s in stopped).difference(table))
        # words that begin with a space are a pre-token each, so many go in one text and come apart by word number
        for i in range(0, len(need), WORDS):
            part = need[i : i + WORDS]
            e = self.coder.encode("".join(part), add_special_tokens=False)
            ids, n = np.array(e.ids, self.width), np.bincount(e.word_ids, minlength=len(part))
            ends = (np.cumsum(n) * ids.itemsize).tolist()
            flat, at = ids.tobytes(), 0
            for s, end in zip(part, ends, strict=True):
                table[s] = flat[at:end]
                at = end
        rest = list(set(new).difference(words, stopped).union({s[-1] for s in stopped} - table.keys()))
        for s, e in zip(rest, self.coder.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            table[s] = np.array(e.ids, self.width).tobytes()
        for s in stopped:
            table[s] = table[s[:-1]] + table[s[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in the file's integers."""
        # a text that holds one of the vocabulary's special tokens goes to the library whole
        whole = {i: np.array(self.coder.encode(t, add_special_tokens=False).ids, self.width).tobytes() for i, t in enumerate(texts) if self.marked and self.marked.search(t)}
        cut = [[] if i in whole else spans(t) for i, t in enumerate(texts)]
        table = self.known.table(set().union(*cut), self.fresh)
        out = [whole[i] if i in whole else b"".join(map(table.__getitem__, c)) for i, c in enumerate(cut)]
        self.known.forget()
        return out


@functools.cache
def speller(path: str) -> Speller:
    return Speller(path)


def write_tokens(docs: DataFrame, path: str, end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Write the files; return the manifest (shard, ids, off, doc, width, n_null, n_docs, n_ids, base)."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    shards = shards or max(8, 2 * narrow.rdd.getNumPartitions())
    root = shared_dir(docs.sparkSession, "tokens")

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        e, ids, ends, names, nulls = speller(path), [], [0], [], 0
        end = np.array([end_id], e.width).tobytes()
        size = len(end)

        def coded():  # a batch at a time goes to the file
            nonlocal nulls
            for b in small(batches):
                names.append(b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
                nulls += b.column("doc_id").null_count
                rows = [x + end for x in e.encode([t or "" for t in b.column("text").to_pylist()])]
                for x in rows:
                    ends.append(ends[-1] + len(x) // size)
                yield b"".join(rows)

        first = next(parts := coded(), None)
        if first is None:
            return
        ids = files.write(f"{root}/{shard:08d}.ids", (x for p in ([first], parts) for x in p))
        off = files.write(f"{root}/{shard:08d}.off", [np.array(ends, "<u8").tobytes()])
        doc = files.write(f"{root}/{shard:08d}.doc", [x.astype("<i8").tobytes() for x in names])
        row = {"shard": shard, "ids": ids, "off": off, "doc": doc, "width": size, "n_null": nulls, "n_docs": len(ends) - 1, "n_ids": ends[-1]}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int32()), ("ids", pa.string()), ("off", pa.string()), ("doc", pa.string()), ("width", pa.int32()), ("n_null", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    dealt = narrow.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    manifest = staged(dealt.mapInArrow(write, "shard int, ids string, off string, doc string, width int, n_null long, n_docs long, n_ids long"), "token-manifest")
    # prefix sums over one row a shard; the driver holds a row a shard, as it does for Spark's own tasks
    sizes = sorted(manifest.select("shard", "n_ids").collect())
    at = np.cumsum([0, *(n for _, n in sizes)])
    bases = manifest.sparkSession.createDataFrame([(s, int(b)) for (s, _), b in zip(sizes, at, strict=False)], "shard int, base long")
    return manifest.join(bases, "shard")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """A row per document, from the files: doc_id, start, n_tokens, ids_crc32 of its ids as 32-bit integers."""
    def run(batches):
        for b in small(batches):
            for r in b.to_pylist():
                ids, off, doc = (np.frombuffer(files.mapped(r[k]), t) for k, t in (("ids", f"<u{r['width']}"), ("off", "<u8"), ("doc", "<i8")))
                for i in range(0, len(doc), 4096):
                    part = off[i : i + 4097]
                    sums = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(part[:-1], part[1:], strict=True)]
                    names = doc[i : i + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, mask=np.arange(i, i + len(names)) < r["n_null"]), pa.array(part[:-1].astype("i8") + r["base"]), pa.array(np.diff(part.astype("i8"))), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    spread = manifest.repartition(max(8, manifest.sparkSession.sparkContext.defaultParallelism), "shard")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
