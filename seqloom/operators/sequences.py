"""Tables of sequences (def, seq): dereplication, words, entropy, islands and windows."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import seq as S
from seqloom.plans.stages import batches_bounded

LEAST = 50
WORDS = [a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT"]
#: 0 to 3 for the bases, N is left out, 4 for all else.
SKIPPED = 5
#: Most windows that leave a task at a time.
WINDOWS = 1 << 16
#: Words that one task takes, about.
WORDS_DEALT = 2_000_000
PLACES = np.full(256, 4, np.uint8)
PLACES[np.frombuffer(b"ACGTNacgtn", np.uint8)] = [0, 1, 2, 3, SKIPPED] * 2


def dereplicate(seqs: DataFrame) -> DataFrame:
    """def (the first), seq, size: sequences that are equal on either strand are one. Partial counts leave each task,
    so a sequence of many copies is not gathered anywhere."""
    batches_bounded(seqs.sparkSession)
    strand = F.least(F.upper("seq"), S.other_strand(F.upper("seq")))
    return seqs.select("def", strand.alias("seq")).groupBy("seq").agg(F.min("def").alias("def"), F.count("*").alias("size")).select("def", "seq", "size")


def keep_first(seqs: DataFrame) -> DataFrame:
    """def, checksum: the first name of every checksum."""
    return seqs.select("def", S.checksum("seq").alias("checksum")).groupBy("checksum").agg(F.min("def").alias("def")).select("def", "checksum")


def duplicate_keys(seqs: DataFrame) -> DataFrame:
    return seqs.select(S.checksum("seq").alias("checksum")).groupBy("checksum").agg(F.count("*").alias("copies")).where("copies > 1")


def both_strands(seqs: DataFrame) -> DataFrame:
    """Every row, and its reverse complement marked ;rev=1."""
    name = F.col("def").cast("string")
    rows = F.array(F.struct(name.alias("def"), F.col("seq").alias("seq")), F.struct(F.concat(name, F.lit(";rev=1")).alias("def"), S.reverse_complement_cased("seq").alias("seq")))
    return seqs.select(F.inline(rows))


def histograms(seqs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` (def, if none is named) and counts: how often each of the words of three bases, from every start
    but the last, occurs in a sequence without N, in order of WORDS. One row in, one row out, one pass over its letters:
    nothing is shuffled."""
    keep = keep or ("def",)
    batches_bounded(seqs.sparkSession)

    def run(batches):
        for b in batches:
            counts = np.array([_threes(s) for s in b.column("seq").to_pylist()], np.int64).reshape(-1, 64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * 64, pa.int32()), pa.array(counts.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), lists], [*keep, "counts"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in seqs.select(*keep).dtypes)
    return seqs.select(*dict.fromkeys([*keep, "seq"])).mapInArrow(run, f"{kinds}, counts array<long>")


def _threes(text: str | None, part: int = 1 << 22) -> np.ndarray:
    """Counts of the 64 words of three bases; words with other letters count for none."""
    out = np.zeros(64, np.int64)
    x = PLACES[np.frombuffer((text or "").encode("latin-1", "replace"), np.uint8)]
    x = x[x != SKIPPED][:-1]
    for at in range(0, len(x) - 2, part):
        piece = x[at : at + part + 2]
        a, b, c = piece[:-2], piece[1:-1], piece[2:]
        out += np.bincount((a << 4 | b << 2 | c)[(a | b | c) < 4], minlength=64)
    return out


def scrambled(codes: np.ndarray) -> np.ndarray:
    """An order of words in which runs of one letter do not come first."""
    h = codes * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def word_hashes(letters: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the words of k letters (code points) from every start, put together from those of half as many letters."""
    power, size, part = 0x9FB21C651E98DF25, 1, scrambled(letters.astype(np.uint64) + np.uint64(1))
    whole, done = None, 0
    while True:
        if k & size:
            n = len(letters) - done - size + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            whole = part[:n] if whole is None else whole[:n] * np.uint64(power) + part[done : done + n]
            done += size
        if done == k:
            return scrambled(whole)
        part = part[: len(part) - size] * np.uint64(power) + part[size:] if len(part) > size else part[:0]
        power, size = power * power % (1 << 64), 2 * size


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), np.uint32)


#: Bases and their complements, of upper case, by code point.
FLIPPED = np.arange(128, dtype=np.uint32)
FLIPPED[[65, 67, 71, 84]] = [84, 71, 67, 65]


def kept_words(text: str | None, k: int, window: int, part: int = 1 << 20) -> np.ndarray:
    """The distinct words of k letters, as hashes that both strands share, that are the least in some ``window`` letters. Whatever
    a letter is, it counts as one, so a text whole within another has words, if it is as long as a window, and the other has them all."""
    found = []
    x = code_points(text)
    for begin in range(0, max(len(x) - window + 1, 0), part):
        piece = x[begin : begin + part + window - 1]
        words = np.minimum(word_hashes(piece, k), word_hashes(flipped(piece), k)[::-1])
        found.append(np.unique(np.lib.stride_tricks.sliding_window_view(words, window - k + 1).min(axis=1)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


#: Letters by whose least hash a word is dealt out, and words that a task of them takes up at a time.
ANCHOR, TAKEN = 12, 4_000_000
#: Words of a piece at most: their number is a byte.
LONG = 255
PARTS = "parts array<struct<bucket int, kind int, keys array<{}>, letters array<int>, of binary, at binary, size binary, text binary>>"


def pieces(texts: list[str | None], k: int, n: int, strands: bool):
    """The words of k letters at all starts but the last, as pieces of texts whose words have one anchor: the least hash of ANCHOR
    letters in them (that both strands share, if ``strands``). Bucket, text and start of each piece, and its letters but the last k - 1."""
    size = min(ANCHOR, k)
    for i, text in enumerate(texts):
        x = code_points(text)[:-1]
        part = 1 << 20
        for begin in range(0, len(x) - k + 1, part):
            piece = x[begin : begin + part + k - 1]
            low = word_hashes(piece, size)
            if strands:
                low = np.minimum(low, word_hashes(flipped(piece), size)[::-1])
            # the least in each k letters, by minima of twice as many
            left, done = k - size + 1, 1
            while done < left:
                step = min(done, left - done)
                low, done = np.minimum(low[:-step], low[step:]), done + step
            new = np.concatenate([[True], low[1:] != low[:-1]])
            cut = np.flatnonzero(new)
            new[(np.arange(len(low)) - np.repeat(cut, np.diff(np.append(cut, len(low))))) % LONG == 0] = True
            cut = np.flatnonzero(new)
            yield (scrambled(low[cut]) % np.uint64(n)).astype(np.int32), i, cut + begin, np.diff(np.append(cut, len(low))), x


def dealt_pieces(seqs: DataFrame, k: int, n: int, strands: bool = False, starts: bool = False, kind: int = 0) -> DataFrame:
    """The words of (def, seq) in ``n`` buckets, equal words in one: neighbours with one anchor move as one piece of text, two letters a
    byte, so that a word takes some two bytes and not a row. ``starts`` asks for their places; ``kind`` is carried along."""
    batches_bounded(seqs.sparkSession)

    def run(batches):
        for b in batches:
            texts = b.column("seq").to_pylist()
            found = list(pieces(texts, k, n, strands))
            if not found:
                continue
            bucket, at, size = (np.concatenate([f[c] for f in found]) for c in (0, 2, 3))
            of = np.repeat([f[1] for f in found], [len(f[0]) for f in found])
            lengths = np.array([len(t or "") for t in texts])
            begins = np.cumsum(lengths) - lengths
            letters, x = np.unique(code_points("".join(t or "" for t in texts)), return_inverse=True)
            order = np.argsort(bucket, kind="stable")
            bucket, of, at, size = bucket[order], of[order], at[order], size[order]
            ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
            told, first = [], 0
            for last in ends.tolist():
                own, back = np.unique(of[first:last], return_inverse=True)
                wide = size[first:last] + k - 1
                whole = x[np.repeat(begins[of[first:last]] + at[first:last] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())]
                if len(letters) <= 16:
                    whole = np.append(whole, 0) if len(whole) % 2 else whole
                    whole = (whole[::2] << 4 | whole[1::2]).astype(np.uint8)
                raw = lambda v: v.astype(np.int32).tobytes()
                told.append((int(bucket[first]), own, raw(np.bincount(back)), raw(at[first:last]) if starts else b"", size[first:last].astype(np.uint8).tobytes(), raw(whole) if len(letters) > 16 else whole.tobytes()))
                first = last
            m = len(told)
            keys = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(t[1]) for t in told]]), pa.int32()), b.column("def").take(pa.array(np.concatenate([t[1] for t in told]))))
            used = pa.array([letters.tolist()] * m, pa.list_(pa.int32()))
            columns = [pa.array([t[0] for t in told], pa.int32()), pa.array([kind] * m, pa.int32()), keys, used, *[pa.array([t[c] for t in told], pa.binary()) for c in (2, 3, 4, 5)]]
            rows = pa.StructArray.from_arrays(columns, ["bucket", "kind", "keys", "letters", "of", "at", "size", "text"])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, m], pa.int32()), rows)], ["parts"])

    parts = seqs.select("def", "seq").mapInArrow(run, PARTS.format(dict(seqs.dtypes)["def"]))
    return parts.select(F.explode("parts").alias("p")).select("p.*")


def opened(t: pa.Table, k: int):
    """A bucket of ``dealt_pieces``: its names in order (null last), and a function that gives, for part p of q of its words by hash, the
    place of the name, the hash or hashes, the start (null unless asked for) and the kind of each, one row of the bucket at a time."""
    keys = t.column("keys").combine_chunks()
    names = keys.flatten().unique()
    names = names.take(pc.sort_indices(names))
    coded = pc.index_in(keys.flatten(), names).to_numpy()
    ends = np.cumsum([0, *[len(x) for x in keys]])
    columns = [t.column(c).to_pylist() for c in ("of", "at", "size", "letters", "text", "kind")]
    number = lambda raw: np.frombuffer(raw, np.int32)
    total = sum(int(np.frombuffer(x, np.uint8).sum()) for x in columns[2])

    def words(p: int, q: int, more=None):
        for r, (of, at, size, letters, text, kind) in enumerate(zip(*columns, strict=True)):
            of, at, size = np.repeat(np.arange(len(number(of))), number(of)), number(at), np.frombuffer(size, np.uint8).astype(np.int64)
            wide = size + k - 1
            if len(letters) <= 16:
                x = np.frombuffer(text, np.uint8)
                x = np.stack([x >> 4, x & 15], 1).ravel()[: wide.sum()]
            else:
                x = number(text)
            x = np.array(letters, np.uint32)[x]
            # a word that reaches into the next piece is none
            begin = np.cumsum(wide) - wide
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            place = np.repeat(begin, size) + inner
            hashes = [v[place] for v in (more or (lambda y: [word_hashes(y, k)]))(x)]
            keep = np.flatnonzero(hashes[0] % np.uint64(q) == p) if q > 1 else slice(None)
            yield coded[ends[r] : ends[r + 1]][np.repeat(of, size)][keep], *[h[keep] for h in hashes], (np.repeat(at, size) + inner)[keep] if len(at) else None, kind

    return names, words, -(-total // TAKEN)


def flipped(x: np.ndarray) -> np.ndarray:
    """The other strand of code points of upper case."""
    return np.where(x < 128, FLIPPED[np.minimum(x, 127)], x)[::-1]


def kmer_counts(seqs: DataFrame, k: int, step: int = 1) -> DataFrame:
    """def, kmer, n of the sequence without N; a row of its own for each row of ``seqs`` where k is 3."""
    if k == 3 and step == 1:
        words = F.arrays_zip(F.array(*map(F.lit, WORDS)).alias("kmer"), F.col("counts").alias("n"))
        return histograms(seqs).select("def", F.inline(words)).toDF("def", "kmer", "n").where("n > 0")
    bare = F.translate(F.upper("seq"), "N", "")
    return seqs.select("def", F.explode(S.kmers(bare, k, step)).alias("kmer")).groupBy("def", "kmer").agg(F.count("*").alias("n"))


def _bits(counts) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)
    weighted = F.aggregate(counts, F.lit(0.0), lambda a, n: a + F.when(n > 0, n * F.log2(n)).otherwise(0.0))
    return F.when(total > 0, F.greatest(F.log2(total) - weighted / total, F.lit(0.0)) + 0.0)


def entropy(seqs: DataFrame) -> DataFrame:
    """def, entropy in bits a word of three bases; null where the sequence without N has no word."""
    return histograms(seqs).select("def", _bits(F.col("counts")).alias("entropy"))


def rich(seqs: DataFrame, limit: float = 5.0) -> DataFrame:
    """Sequences of more than ``limit`` bits a word; those without a word stay, as nothing speaks against them."""
    return histograms(seqs, "def", "seq").where(F.coalesce(_bits(F.col("counts")) > limit, F.lit(True))).select("def", "seq")


def islands(seqs: DataFrame, least: int = LEAST) -> DataFrame:
    """def, start (from 0), seq: stretches without N of ``least`` letters and more. n neither begins nor ends one, and is
    an N within. One pass over a row's letters: nothing is shuffled, and rows of one name are apart."""
    batches_bounded(seqs.sparkSession)

    def run(batches):
        for b in batches:
            rows, starts, found = [], [], []
            for i, text in enumerate(b.column("seq").to_pylist()):
                for m in re.finditer("[^N]+", text or ""):
                    late = m.group().lstrip("n")
                    bare = late.rstrip("n")
                    if len(bare) >= least:
                        rows.append(i)
                        starts.append(m.end() - len(late))
                        found.append(bare.replace("n", "N"))
            yield pa.RecordBatch.from_arrays([b.column("def").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(found, pa.string())], ["def", "start", "seq"])

    return seqs.select("def", "seq").mapInArrow(run, f"def {seqs.schema['def'].dataType.simpleString()}, start long, seq string")


def tiles(found: DataFrame, size: int, least: int = LEAST) -> DataFrame:
    """def, start, seq: windows of ``size`` letters every half size over islands. The last whole window takes what is
    left and has no half step after it; size 0 gives the islands. A row's letters are passed over once, however long it is."""
    batches_bounded(found.sparkSession)

    def cut(text):
        n = len(text)
        last = 2 * (max(n // size, 1) - 1) if size else 0
        for i in range(last + 1):
            at = size * (i // 2) + (size // 2 if i % 2 else 0)
            piece = text[at : n if i == last else at + size]
            if len(piece) >= least:
                yield at, piece

    def run(batches):
        for b in batches:
            rows, at, pieces = [], [], []
            told = lambda: pa.RecordBatch.from_arrays([b.column("def").take(pa.array(rows, pa.int64())), pa.array(at, pa.int64()), pa.array(pieces, pa.string())], ["def", "start", "seq"])  # noqa: B023, E731
            for i, (start, text) in enumerate(zip(b.column("start").to_pylist(), b.column("seq").to_pylist())):
                for place, piece in cut(text or ""):
                    rows.append(i)
                    at.append(start + place)
                    pieces.append(piece)
                    if len(rows) == WINDOWS:
                        yield told()
                        rows, at, pieces = [], [], []
            yield told()

    kept = found.select("def", F.col("start").cast("long").alias("start"), "seq").where("seq IS NOT NULL")
    return kept.mapInArrow(run, f"def {found.schema['def'].dataType.simpleString()}, start long, seq string")


def word_tasks(seqs: DataFrame) -> int:
    """As many tasks as there are words for, which are about as many as letters."""
    letters = seqs.agg(F.sum(F.length("seq"))).first()[0] or 0
    return max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-letters // WORDS_DEALT))


def earlier_overlap(seqs: DataFrame, k: int) -> DataFrame:
    """def, kmers, shared: distinct k-letter words, and how many of them a sequence with a smaller name has too. One
    minimum a word tells, so no pairs of sequences are formed, and words move once, as pieces of text."""
    n = word_tasks(seqs)

    def run(t):
        names, words, q = opened(t, k)
        known = len(names) - names.null_count
        sums = np.zeros((2, len(names)), np.int64)
        for p in range(q):
            of, h = (np.concatenate(c) for c in zip(*((x[0], x[1]) for x in words(p, q)), strict=True))
            order = np.lexsort((of, h))
            of, h = of[order], h[order]
            new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
            own = np.concatenate([[True], new[1:] | (of[1:] != of[:-1])])[: len(h)]
            sums += [np.bincount(of[own], minlength=len(names)), np.bincount(of[own & ~new & (of < known)], minlength=len(names))]
        return pa.table([names, sums[0], sums[1]], ["def", "kmers", "shared"])

    kind = dict(seqs.dtypes)["def"]
    told = dealt_pieces(seqs, k, n).repartition(n, "bucket").groupBy("bucket").applyInArrow(run, f"def {kind}, kmers long, shared long")
    return told.groupBy("def").agg(F.sum("kmers").alias("kmers"), F.sum("shared").alias("shared"))


def split_by_copies(seqs: DataFrame) -> DataFrame:
    """Rows with checksum and shared: whether other rows have the checksum too. The checksums that are shared are a row each,
    so a frequent one's rows are split by Spark."""
    marked = seqs.withColumn("checksum", S.checksum("seq"))
    several = duplicate_keys(seqs).select("checksum", F.lit(True).alias("shared"))
    return marked.join(several, "checksum", "left").withColumn("shared", F.coalesce("shared", F.lit(False)))


def normalised(seqs: DataFrame, k: int = 31, target: int = 5) -> DataFrame:
    """def, depth (median count of the sequence's words in the whole table), kept: sequences of a depth above ``target`` stay with
    a chance of target / depth, by a hash of their name, so that deep regions thin out to about the target."""
    n = word_tasks(seqs)

    def run(t):
        names, words, q = opened(t, k)
        for p in range(q):
            of, h = (np.concatenate(c) for c in zip(*((x[0], x[1]) for x in words(p, q)), strict=True))
            _, back, n = np.unique(h, return_inverse=True, return_counts=True)
            pair, m = np.unique(n[back] * len(names) + of, return_counts=True)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(pair % len(names))), pa.array(pair // len(names)), pa.array(m)], ["def", "n", "m"])

    # words move once, as pieces of text; where they are dealt to, they are counted, and of each count a sequence has one row leaves
    kind = dict(seqs.dtypes)["def"]
    told = dealt_pieces(seqs, k, n).repartition(n, "bucket").groupBy("bucket").applyInArrow(lambda t: pa.Table.from_batches(run(t)), f"def {kind}, n long, m long")
    counts = told.groupBy("def", "n").agg(F.sum("m").alias("m"))
    lists = counts.groupBy("def").agg(F.array_sort(F.collect_list(F.struct("n", "m"))).alias("l"), F.sum("m").alias("all"))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("depth"))
    step = lambda a, x: F.when(2 * a["seen"] < F.col("all"), F.struct((a["seen"] + x["m"]).alias("seen"), x["n"].alias("depth"))).otherwise(a)
    depth = lists.select("def", F.aggregate("l", start, step)["depth"].alias("depth"))
    chance = F.conv(F.substring(F.md5(F.col("def").cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / (1 << 32)
    return depth.select("def", "depth", ((F.col("depth") <= target) | (chance < target / F.col("depth"))).alias("kept"))
