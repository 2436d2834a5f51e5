"""K-mers as packed numbers: the seed index of read mapping.

A base takes two bits, so up to 31 bases are one BIGINT and a longer k-mer is
several.  Sequences are packed 16 bases a word once; every k-mer is then cut
out of two or three neighbouring words by shifts, so no k-mer ever exists as
a string and a shuffled seed row is a few numbers.  The codes are the k-mers
(not hashes of them): equal codes are equal k-mers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import fits
from .partitions import pin

WORD = 16   # bases of a packed word
CODE = 31   # bases of a code at most


def code_names(k: int) -> list[str]:
    """Columns that hold a k-mer of ``k`` bases."""
    return [f"code{i}" for i in range(-(-k // CODE))]


def packed_words(seq) -> Column:
    """``ARRAY<BIGINT>`` of the sequence's words, 16 bases each, the last one filled up;
    letters other than A, C, G, T count as A (see ``kmers`` for how such k-mers go)."""
    plain = F.translate(F.regexp_replace(seq, "[^ACGT]", "A"), "ACGT", "0123")
    filled = F.concat(plain, F.lit("0" * (WORD - 1)))   # what is over falls off
    return F.transform(F.regexp_extract_all(filled, F.lit(f".{{{WORD}}}"), F.lit(0)),
                       lambda w: F.conv(w, 4, 10).cast("bigint"))


def _cut_code(words: str, start: Column, length: int) -> Column:
    """The code of ``length`` (at most 31) bases from 0-based base ``start``.  Never
    NULL, so a join on it infers no filter that would cut every k-mer twice."""
    at = F.call_function("div", start, F.lit(WORD)).cast("int")
    skip = (start % WORD).cast("int")

    def word(i):
        return F.coalesce(F.get(F.col(words), at + i), F.lit(0).cast("bigint"))

    two = F.shiftleft(word(0), 32).bitwiseOR(word(1))
    code = F.shiftrightunsigned(F.call_function("shiftleft", two, 2 * skip), 64 - 2 * length)
    if length <= WORD + 1:
        return code
    over = skip + length - 2 * WORD     # bases that the third word gives
    return F.when(over > 0, code.bitwiseOR(F.call_function("shiftrightunsigned", word(2), 32 - 2 * over))).otherwise(code)


def kmers(df: DataFrame, keys: list[str], seq: str, k: int, base_pos: str | None = None,
          limit_col: str | None = None) -> DataFrame:
    """``keys, pos`` and ``code_names(k)`` for every ACGT-only k-mer of ``seq``; ``pos`` is
    its 0-based place plus ``base_pos``.  ``limit_col`` bounds the number of places.

    The ACGT test runs once per sequence, in a projection below the explode (an
    expression listed next to a generator is evaluated once per generated row), and
    per k-mer only for sequences that hold other letters (e.g. ``N``).  A NULL
    sequence has no k-mers."""
    n = F.length(seq) - k + 1
    if limit_col is not None:
        n = F.least(n, F.col(limit_col))
    extra = [base_pos] if base_pos is not None else []
    clean = F.coalesce(F.col(seq).rlike("^[ACGT]*$"), F.lit(True))
    staged = df.select(*keys, *extra, F.when(~clean, F.col(seq)).alias("_other"), packed_words(F.col(seq)).alias("_words"),
                       n.alias("_n"))
    placed = staged.select(*keys, *extra, "_other", "_words",
                           F.explode(F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1))).alias("_i"))
    whole = F.col("_other").isNull() | ~F.substring(F.col("_other"), F.col("_i") + 1, k).rlike("[^ACGT]")
    pos = F.col("_i") + (F.col(base_pos) if base_pos is not None else F.lit(0))
    codes = [_cut_code("_words", F.col("_i") + CODE * i, min(CODE, k - CODE * i)).alias(c)
             for i, c in enumerate(code_names(k))]
    return placed.filter(whole).select(*keys, pos.cast("bigint").alias("pos"), *codes)


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def both_strands(windows: DataFrame, keys: list[str], seq: str, k: int, base_pos: str) -> DataFrame:
    """K-mers of windows and of their reverse complements: ``keys, pos, strand`` and
    codes; ``pos`` is the place on the forward strand of the k-mer or of the one it
    complements.  Windows overlap by ``k - 1`` bases, so none is taken twice."""
    plus = kmers(windows, keys, seq, k, base_pos).withColumn("strand", F.lit("+"))
    turned = windows.select(*keys, base_pos, F.length(seq).alias("_len"), reverse_complement(F.col(seq)).alias("_rc"))
    codes = code_names(k)
    minus = kmers(turned, [*keys, base_pos, "_len"], "_rc", k).select(
        *keys, (F.col(base_pos) + F.col("_len") - k - F.col("pos")).cast("bigint").alias("pos"), *codes,
        F.lit("-").alias("strand"))
    return plus.unionByName(minus)


def known_only(read_kmers: DataFrame, index: DataFrame, codes: list[str], max_rows: int) -> DataFrame:
    """The rows of ``read_kmers`` whose k-mer the index holds, before any of them is
    shuffled with what it carries.

    The distinct codes of both sides meet in a semi join (codes alone, distinct
    per task first).  If at most ``max_rows`` are shared, which is proven by a
    count, they are broadcast and filter the reads; else the reads stay as they
    are, since the join with the index then drops little more than they hold."""
    shared = pin(read_kmers.select(*codes).distinct().join(index.select(*codes).distinct(), codes, "left_semi"))
    if not fits(shared, max_rows):
        return read_kmers
    return read_kmers.join(F.broadcast(shared), codes, "left_semi")
