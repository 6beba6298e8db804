"""Sequence functions as Spark column expressions.

Case and N carry meaning and are never normalised by accident: upper case is supported by references, lower case comes
from contigs or conflicts, N is a gap and n an observed tie.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The genetic code, stops as *.
CODON_TABLE = {
    "TTT": "F", "TTC": "F", "TTA": "L", "TTG": "L", "CTT": "L", "CTC": "L", "CTA": "L", "CTG": "L",
    "ATT": "I", "ATC": "I", "ATA": "I", "ATG": "M", "GTT": "V", "GTC": "V", "GTA": "V", "GTG": "V",
    "TCT": "S", "TCC": "S", "TCA": "S", "TCG": "S", "CCT": "P", "CCC": "P", "CCA": "P", "CCG": "P",
    "ACT": "T", "ACC": "T", "ACA": "T", "ACG": "T", "GCT": "A", "GCC": "A", "GCA": "A", "GCG": "A",
    "TAT": "Y", "TAC": "Y", "TAA": "*", "TAG": "*", "CAT": "H", "CAC": "H", "CAA": "Q", "CAG": "Q",
    "AAT": "N", "AAC": "N", "AAA": "K", "AAG": "K", "GAT": "D", "GAC": "D", "GAA": "E", "GAG": "E",
    "TGT": "C", "TGC": "C", "TGA": "*", "TGG": "W", "CGT": "R", "CGC": "R", "CGA": "R", "CGG": "R",
    "AGT": "S", "AGC": "S", "AGA": "R", "AGG": "R", "GGT": "G", "GGC": "G", "GGA": "G", "GGG": "G",
}
# The BLOSUM62 diagonal, a stop scores 1.
BLOSUM_SELF = {"A": 4, "R": 5, "N": 6, "D": 6, "C": 9, "Q": 5, "E": 5, "G": 6, "H": 8, "I": 4, "L": 4, "K": 5, "M": 5, "F": 6, "P": 7, "S": 4, "T": 5, "W": 11, "Y": 7, "V": 4, "*": 1}
# Lambda and K of the two scoring systems, and the attainable bits a base.
NUC_LAMBDA, NUC_K, PROT_LAMBDA, PROT_K = 0.625, 0.410, 0.267, 0.041
LN2 = 0.6931471805599453
BITS_CAP = 2 * NUC_LAMBDA / LN2


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_case(seq) -> Column:
    """acgt in upper case; n stays."""
    return F.translate(col(seq), "acgt", "ACGT")


def reverse_complement(seq) -> Column:
    """Of upper-case bases; all else stays what it is."""
    return F.reverse(F.translate(col(seq), "ACGT", "TGCA"))


@F.pandas_udf(T.StringType())
def _other_strand(seq: pd.Series) -> pd.Series:
    return seq.map(lambda s: s.translate(_FLIP)[::-1], na_action="ignore")


_FLIP = str.maketrans("ACGT", "TGCA")


def other_strand(seq) -> Column:
    """``reverse_complement`` of whole sequences, in one look-up a sequence: Spark's translate takes a map's for each letter."""
    return _other_strand(col(seq))


@F.pandas_udf(T.StringType())
def _lettered(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s.encode("latin-1", "replace").translate(_LETTERED).decode("ascii"), na_action="ignore")


#: Bytes of letters as bases. What is no letter is N first, and N is a letter like any other.
_LETTERED = bytearray((b"acgt" * 7)[ord("N") - ord("A") : ord("N") - ord("A") + 1] * 256)
_LETTERED[ord("a") : ord("z") + 1], _LETTERED[ord("A") : ord("Z") + 1], _LETTERED[ord("\n")] = (b"ACGT" * 7)[:26], (b"acgt" * 7)[:26], ord("n")
_LETTERED = bytes(_LETTERED)


def lettered(text) -> Column:
    """Text as a sequence: lower-case letters become bases, upper-case letters bases of lower case, a newline n and every other
    code point what the letter N becomes. One look-up a text."""
    return _lettered(col(text))


def reverse_complement_cased(seq) -> Column:
    return F.reverse(F.translate(col(seq), "ACGTacgt", "TGCAtgca"))


def complement(seq) -> Column:
    """Without reversal, for walks in descending positions."""
    return F.translate(col(seq), "ACGTacgt", "TGCAtgca")


def pad_n(seq, k: int) -> Column:
    return F.concat(F.lit("N" * k), col(seq), F.lit("N" * k))


def trim_n(seq) -> Column:
    return F.regexp_replace(col(seq), "^[Nn|]+|[Nn|]+$", "")


def known_length(seq) -> Column:
    return F.length(F.translate(col(seq), "Nn", ""))


def unknown_count(seq) -> Column:
    return F.length(col(seq)) - known_length(seq)


def gc_fraction(seq) -> Column:
    """Share of G and C, of either case, in all letters; null for the empty sequence."""
    n = F.length(col(seq))
    return F.when(n > 0, (n - F.length(F.translate(col(seq), "GCgc", ""))) / n)


def letter_occupancy(seq) -> Column:
    """Percentage of letters that are not N; null for the empty sequence."""
    n = F.length(col(seq))
    return F.when(n > 0, known_length(seq) / n * 100)


def checksum(seq) -> Column:
    """md5 over the two hex digests."""
    return F.md5(F.concat(F.md5(col(seq)), F.sha1(col(seq))))


def codons(seq) -> Column:
    """Whole codons from the first letter; one or two letters at the end are left out."""
    return F.regexp_extract_all(col(seq), F.lit("(...)"), F.lit(1))


def _places(text: str) -> np.ndarray:
    """Each codon's place among the 64 in order of ACGT, from 0; 64 where it is not of ACGT."""
    x = BASE_CODES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    three = x[: len(x) // 3 * 3].reshape(-1, 3)
    return np.where((three < 4).all(axis=1), three @ np.array([16, 4, 1]), 64)


BASE_CODES = np.full(256, 4, np.int64)
BASE_CODES[np.frombuffer(b"ACGT", np.uint8)] = range(4)
_CODONS = [CODON_TABLE[a + b + c] for a in "ACGT" for b in "ACGT" for c in "ACGT"]
_ACIDS = np.frombuffer(("".join(_CODONS) + "X").encode(), np.uint8)
_SCORES = np.array([BLOSUM_SELF[a] for a in _CODONS] + [-1])


@F.pandas_udf(T.StringType())
def _translated(seq: pd.Series) -> pd.Series:
    return seq.map(lambda s: _ACIDS[_places(s)].tobytes().decode(), na_action="ignore")


@F.pandas_udf(T.IntegerType())
def _scored(seq: pd.Series) -> pd.Series:
    return seq.map(lambda s: int(_SCORES[_places(s)].sum()), na_action="ignore").astype("Int32")


def translate_codons(seq) -> Column:
    """Amino acids of the codons; X where a codon is not of ACGT. A text is one look-up in numpy."""
    return _translated(col(seq))


def protein_self_score(seq) -> Column:
    """Sum of BLOSUM62 self scores over the codons; -1 for an unknown codon."""
    return _scored(col(seq))


def codon_self_score(seq) -> Column:
    """``protein_self_score`` for short stretches, without Python, behind which Spark no longer knows how rows are dealt out."""
    score = F.create_map(*[F.lit(x) for c, a in CODON_TABLE.items() for x in (c, BLOSUM_SELF[a])])
    return F.aggregate(codons(seq), F.lit(0), lambda total, c: total + F.coalesce(F.try_element_at(score, c), F.lit(-1)))


def nucleotide_self_score(seq) -> Column:
    """2 for a base, -2 for an N."""
    return 2 * known_length(seq) - 2 * unknown_count(seq)


def raw_to_bits(raw, protein: bool = False) -> Column:
    lam, k = (PROT_LAMBDA, PROT_K) if protein else (NUC_LAMBDA, NUC_K)
    return (F.lit(lam) * col(raw) - F.log(F.lit(k))) / F.lit(LN2)


def bits_to_raw(bits, protein: bool = False) -> Column:
    lam, k = (PROT_LAMBDA, PROT_K) if protein else (NUC_LAMBDA, NUC_K)
    return (col(bits) * F.lit(LN2) + F.log(F.lit(k))) / F.lit(lam)


def bits_per_base(bits, span) -> Column:
    """Density, at most what a perfect alignment attains."""
    return F.least(col(bits) / col(span), F.lit(BITS_CAP))


def scale_accuracy(rep, least, accuracy) -> Column:
    """(rep / least) to the tenth power of the accuracy; rep itself where accuracy is 1 or rep is 0."""
    return F.when((col(accuracy) == 1) | (col(rep) == 0), col(rep)).otherwise(F.pow(col(rep) / col(least), F.pow(col(accuracy), F.lit(10))))


def hamming(a, b) -> Column:
    """Differing letters of equally long sequences; null where lengths differ."""
    differ = F.aggregate(F.zip_with(F.split(col(a), ""), F.split(col(b), ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(F.length(col(a)) == F.length(col(b)), differ)


def attribute(header, key: str) -> Column:
    """The value of ;key=value in a header; null where there is none."""
    found = F.regexp_extract(col(header), f";{key}=([^;]*)", 1)
    return F.when(F.col(header).rlike(f";{key}=") if isinstance(header, str) else col(header).rlike(f";{key}="), found)


def with_attribute(header, key: str, value) -> Column:
    """The header with ;key=value, replaced where it is and else added at the end."""
    text = F.concat(F.lit(f";{key}="), col(value).cast("string"))
    gone = F.regexp_replace(col(header), f";{key}=[^;]*", "")
    return F.concat(F.regexp_replace(gone, ";+$", ""), text)


def accession(header) -> Column:
    """Fourth field of a bar-separated header, else the contig's number."""
    bar = F.regexp_extract(col(header), r"^(?:[^|]*\|){3}([^|]+)\|", 1)
    contig = F.regexp_extract(col(header), r"contig_(\d+)", 1)
    return F.when(bar != "", bar).when(contig != "", contig)


def sanitised(text) -> Column:
    """Non-word characters as dots, runs of dots as one."""
    return F.regexp_replace(F.regexp_replace(col(text), r"\W", "."), r"\.+", ".")


def clean_bases(text) -> Column:
    """Upper case without digits and white space; what is not of ACGT is N."""
    return F.regexp_replace(F.upper(F.regexp_replace(col(text), r"[\d\s]", "")), "[^ACGTN]", "N")


def safe_year(locus) -> Column:
    """The year of a dd-MON-yyyy date at the end of a LOCUS line."""
    found = F.regexp_extract(col(locus), r"\d{2}-[A-Z]{3}-(\d{4})\s*$", 1)
    return F.when(found != "", found.cast("int"))


def cigar_steps(cigar) -> Column:
    """CIGAR as an array of (op, n)."""
    whole = F.regexp_extract_all(col(cigar), F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    return F.transform(whole, lambda s: F.struct(F.substring(s, -1, 1).alias("op"), F.expr("0").cast("int").alias("_")).withField("n", F.regexp_extract(s, r"^(\d+)", 1).cast("int")).dropFields("_"))


def kmers(seq, k: int, step: int = 1) -> Column:
    """Array of the k-letter words at 0, step, ...; the last possible start is left out.

    One pass of a look-ahead over the sequence: taking substrings by position would count letters from the start each time."""
    whole = F.regexp_extract_all(col(seq), F.lit(f"(?=(.{{{k}}}))."), F.lit(1))
    words = F.slice(whole, F.lit(1), F.greatest(F.size(whole) - 1, F.lit(0)))
    return words if step == 1 else F.filter(words, lambda _, i: i % step == 0)


def location_ranges(location) -> Column:
    """A record's location, such as complement(join(3..20,<40..>99)), as an array of (start, stop, reverse) in the order of
    the sequence. A single position is a range of one; marks of open ends are left out."""
    pattern = F.lit(r"<?(\d+)(?:\.\.>?(\d+))?")
    starts = F.regexp_extract_all(col(location), pattern, F.lit(1))
    stops = F.regexp_extract_all(col(location), pattern, F.lit(2))
    back = col(location).contains("complement")
    return F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda r: F.struct(r["a"].cast("long").alias("start"), F.coalesce(F.nullif(r["b"], F.lit("")), r["a"]).cast("long").alias("stop"), back.alias("reverse")))


def shifted_ranges(ranges, codon_start) -> Column:
    """Ranges whose first codon begins at ``codon_start`` (from 1): the reading start moves into the first range, or, on the
    other strand, out of the last."""
    shift, last = (col(codon_start) - 1).cast("long"), F.size(col(ranges)) - 1
    ahead = lambda r, i: F.when(~r["reverse"] & (i == 0), shift).otherwise(F.lit(0))
    behind = lambda r, i: F.when(r["reverse"] & (i == last), shift).otherwise(F.lit(0))
    return F.transform(col(ranges), lambda r, i: F.struct((r["start"] + ahead(r, i)).alias("start"), (r["stop"] - behind(r, i)).alias("stop"), r["reverse"].alias("reverse")))


def with_gap(seq, offset, n) -> Column:
    """n letters N put in before letter number ``offset`` (from 0)."""
    return F.concat(F.substring(col(seq), F.lit(1), col(offset).cast("int")), F.repeat(F.lit("N"), col(n).cast("int")), F.substr(col(seq), (col(offset) + 1).cast("int")))


def damerau_distance(a: str, b: str, swaps: bool = True) -> int:
    """Insertions, deletions, changes and, with ``swaps``, swaps of neighbours that lead from a to b; what was swapped may be
    edited again.

    Only cells that a bound allows are filled, as many beside the diagonal as the bound; it doubles until the distance is
    within it, so the cost is the length times the distance."""
    most = max(8, abs(len(a) - len(b)))
    while (found := _within(a, b, most, swaps)) is None:
        most *= 2
    return found


def _within(a: str, b: str, most: int, swaps: bool) -> int | None:
    far = len(a) + len(b)
    seen: dict[str, int] = {}
    rows: list[dict[int, int]] = [{j: j for j in range(min(len(b), most) + 1)}]
    for i, x in enumerate(a, 1):
        up, match = rows[-1], 0
        row = {0: i} if i <= most else {}
        if i - most > 1:  # the last equal letter before the cells of this row
            match = b.rfind(x, 0, i - most - 1) + 1
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            k, m = seen.get(y, 0), match
            if x == y:
                match = j
            best = min(up.get(j - 1, far) + (x != y), row.get(j - 1, far) + 1, up.get(j, far) + 1)
            if swaps and k and m:
                best = min(best, rows[k - 1].get(m - 1, far) + i - k + j - m - 1)
            row[j] = best
        rows.append(row)
        seen[x] = i
    found = rows[-1].get(len(b), far)
    return found if found <= most else None
