"""Gapped placement of reads: chains of seeds on neighbouring diagonals, aligned in a band.

An insertion or deletion splits a read's seeds over two diagonals.  Diagonals at
most ``max_shift`` apart are therefore summed before the best placement is chosen,
and the read is aligned end to end with the reference around that chain, the
reference's ends being free:

    match +1, mismatch -2, every base of a gap -4.

Of the alignments in the band the one with the highest score comes back, then the
most matches, then the smallest start, then the smallest end.  All of it is built-in
expressions: a cell of the band is one BIGINT (score, matches and where the
alignment began, in this order of bits), so the best of two cells is ``greatest``.
A read that differs from the reference in at most one base on its best diagonal
cannot gain by a gap and skips the band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS
from .mapping import TILE, cut, held_reads, read_keys, seed_hits
from .partitions import pin
from .seeds import reverse_complement

MATCH, MISMATCH, GAP = 1, -2, -4
#: Diagonals that one chain may join, counted from its middle.
MAX_SHIFT = 6

# A cell: score in the high bits, then 20 bits of matches, then 12 bits that fall as the start grows.
_SCORE, _MATCHES, _STARTS = 1 << 32, 1 << 12, 4095
_NONE = -(1 << 62)


def chains(hits: DataFrame, min_seeds: int, max_shift: int = MAX_SHIFT) -> DataFrame:
    """``rid, ref_id, strand, low, high, diag, seeds``: the best chain of every read.

    Diagonals are dealt into buckets of ``2 * max_shift`` twice, the second time moved
    by half a bucket, so any two that are at most ``max_shift`` apart share one.  The
    bucket with the most seeds wins, ties going to the narrower, then to the smallest
    reference, ``+``, the smallest diagonal; ``diag`` is its diagonal with the most seeds
    (the smallest of several).  Counts and choices are partial aggregates: two rows a
    diagonal, however many seeds it has."""
    votes = hits.groupBy("rid", "ref_id", "strand", "diag").agg(F.count(F.lit(1)).alias("n"))
    dealt = votes.select("*", F.explode(F.array(F.lit(0), F.lit(max_shift))).alias("moved")) \
        .withColumn("bucket", F.floor((F.col("diag") + F.col("moved")) / (2 * max_shift)))
    summed = (dealt.groupBy("rid", "ref_id", "strand", "moved", "bucket")
              .agg(F.sum("n").alias("seeds"), F.min("diag").alias("low"), F.max("diag").alias("high"),
                   F.max(F.struct("n", (-F.col("diag")).alias("d"))).alias("top"))
              .filter(F.col("seeds") >= min_seeds))
    pick = F.min(F.struct((-F.col("seeds")).alias("s"), (F.col("high") - F.col("low")).alias("w"), "ref_id", "strand",
                          "low", "high", (-F.col("top.d")).alias("diag"))).alias("b")
    return summed.groupBy("rid").agg(pick).select(
        "rid", "b.ref_id", "b.strand", "b.low", "b.high", "b.diag", (-F.col("b.s")).alias("seeds"))


def _windows(placed: DataFrame, genomes: DataFrame, width: int, broadcast: bool) -> DataFrame:
    """``placed`` with ``window``: the reference from base ``from`` on, as long as the read
    and the band together; bases outside the reference are ``-``."""
    size = F.col("nt_length") + width
    first = F.floor(F.greatest(F.col("from"), F.lit(0)) / TILE) * TILE
    asked = placed.select("rid", "ref_id", F.explode(F.sequence(
        first, F.greatest(F.col("from") + size - 1, F.lit(0)), F.lit(TILE).cast("bigint"))).alias("start"))
    tiles = cut(genomes, ["ref_id"], "seq", TILE).select("ref_id", "start", "piece")
    met = asked.join(F.broadcast(tiles) if broadcast else tiles, ["ref_id", "start"])
    # as many tiles a read as the read and the band are long
    joined = met.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("tiles"))
    text = F.array_join(F.transform("tiles", lambda t: t["piece"]), "")
    cut_off = (F.greatest(F.col("from"), F.lit(0)) - F.get("tiles", F.lit(0))["start"]).cast("int")
    window = F.rpad(F.concat(F.repeat(F.lit("-"), F.greatest(-F.col("from"), F.lit(0)).cast("int")),
                             F.substring(text, cut_off + 1, size)), size.cast("int"), "-")
    return placed.join(joined, "rid").select(*placed.columns, window.alias("window"))


# Codes of letters in the band: bases as they are, and where a read's row begins, has not begun, is over.
_BEGIN, _BEFORE, _OVER = 1, 2, 3


def _letters(text: Column, length: Column) -> Column:
    """The first ``length`` letters of ``text`` as an array of their codes."""
    return F.transform(F.slice(F.split(text, "", -1), 1, length), lambda c: F.ascii(c))


def _banded(read: str, window: str, width: int) -> Column:
    """``cell, ended``: the best cell after the last base, and its diagonal (from 0).

    ``read`` and ``window`` are columns of letter codes, the read's padded and reversed by
    ``_padded``.  The band (``width`` diagonals, odd) is worked by antidiagonals: a cell after
    ``i`` bases on diagonal ``d`` lies on number ``2 i + d`` and follows from the two before it
    (a match from the second, gaps from the first), so a step is one pass over half the
    diagonals.  Cells of rows that have not begun hold nothing, those of the first row begin
    an alignment, those behind the last keep its value."""
    half = (width + 1) // 2
    none = F.lit(_NONE).cast("bigint")

    def starts(parity: int) -> Column:
        return F.array(*[F.lit(_STARTS - d).cast("bigint") for d in range(parity, width, 2)])

    length = F.size(read) - 2 * half - 2
    state = F.struct(F.array_repeat(none, half - 1).alias("second"),
                     F.concat(F.array(F.lit(_STARTS).cast("bigint")), F.array_repeat(none, half - 1)).alias("first"))

    def step(acc: Column, t: Column) -> Column:
        odd, u = t % 2 == 1, F.shiftright(t, 1)
        n = F.when(odd, half - 1).otherwise(half)
        zipped = F.arrays_zip(
            acc["second"].alias("same"),
            F.slice(F.when(odd, acc["first"]).otherwise(F.concat(F.array(none), acc["first"])), 1, n).alias("left"),
            F.slice(F.when(odd, F.slice(acc["first"], 2, half - 1)).otherwise(F.concat(acc["first"], F.array(none))), 1, n)
            .alias("right"),
            F.slice(F.col(read), length + half + 2 - u, n).alias("base"),
            F.slice(F.col(window), u + F.when(odd, 1).otherwise(0), n).alias("on"),
            F.when(odd, starts(1)).otherwise(starts(0)).alias("start"))
        cells = F.transform(zipped, lambda z: F.when(z["base"] == _BEGIN, z["start"]).when(z["base"] == _OVER, z["same"])
                            .otherwise(F.greatest(
                                z["same"] + F.when(z["base"] == z["on"], F.lit(MATCH * _SCORE + _MATCHES)).otherwise(F.lit(MISMATCH * _SCORE)),
                                F.greatest(z["left"], z["right"]) + GAP * _SCORE)))
        return F.struct(acc["first"].alias("second"), cells.alias("first"))

    def last(acc: Column) -> Column:   # the last antidiagonal is an even one
        both = F.flatten(F.zip_with(acc["first"], acc["second"], lambda a, b: F.array(a, b)))
        return F.struct(F.array_max(both).alias("cell"), (F.array_position(both, F.array_max(both)) - 1).cast("int").alias("ended"))

    return F.aggregate(F.sequence(F.lit(1), 2 * length + width - 1), state, step, last)


def _padded(read: Column, width: int) -> Column:
    """A read's letter codes reversed, with the marks of rows outside it (see ``_banded``)."""
    half = (width + 1) // 2
    return F.reverse(F.concat(F.array_repeat(F.lit(_BEFORE), half), F.array(F.lit(_BEGIN)), read,
                              F.array_repeat(F.lit(_OVER), half + 1)))


def align_reads(reads: DataFrame, refs: DataFrame, k: int = 21, window: int = 200, min_seeds: int = 2,
                read_id: str | list[str] = "read_id", read_seq: str = "seq", ref_id: str = "ref_id", ref_seq: str = "seq",
                max_shift: int = MAX_SHIFT, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Place each read on a reference (both strands), allowing for gaps.

    Returns the read's keys (see ``map_reads``) and ``gene, strand, start, end,
    nt_length, seeds, score, matches, columns, identity``: the reference bases
    ``start`` to ``end`` (0-based, ``end`` not included) that the whole read is aligned
    with, the chain's seeds, the alignment's score, equal bases and length (read bases
    plus deleted reference bases), and ``identity = matches / columns``.  Letters other
    than A, C, G, T match nothing, nor do bases beyond a reference's ends.  Reads whose
    best chain has fewer than ``min_seeds`` seeds are left out.  Gaps reach at most
    ``2 * max_shift`` diagonals from the chain's middle.  Repeated references count once;
    repeated reads are reads of their own.  Reads may have up to a million bases."""
    if not 1 <= max_shift <= 500:
        raise ValueError("max_shift must be between 1 and 500")
    keys, named = read_keys(read_id)
    width = 4 * max_shift + 1
    genomes = refs.select(F.col(ref_id).alias("ref_id"), F.upper(F.col(ref_seq)).alias("seq")).distinct()
    held = held_reads(reads, named, read_seq)
    hits, small = seed_hits(held, genomes, k, window, max_broadcast_rows)
    middle = F.floor((F.col("low") + F.col("high")) / 2)
    best = chains(hits, min_seeds, max_shift).withColumn("from", middle - 2 * max_shift)
    # the chain is used twice below (its reference window and the result), so seeds are found once
    placed = pin(best.join(held, "rid"))
    oriented = F.when(F.col("strand") == "+", F.col("fwd")).otherwise(reverse_complement(F.col("fwd")))
    # pinned: an array that is only an expression would be built anew for every base
    staged = pin(_windows(placed, genomes, width, small).select(
        "rid", *keys, "ref_id", "strand", "diag", "from", "nt_length", "seeds",
        _letters(F.regexp_replace(oriented, "[^ACGT]", "."), F.col("nt_length")).alias("read"),
        _letters(F.col("window"), F.col("nt_length") + width).alias("window")))
    shift = (F.col("diag") - F.col("from")).cast("int")
    same = F.zip_with("read", F.slice(F.col("window"), shift + 1, F.col("nt_length")), lambda a, b: (a == b).cast("int"))
    plain = pin(staged.withColumn("plain", F.aggregate(same, F.lit(0), lambda n, x: n + x)))
    kept = [c for c in plain.columns if c not in ("read", "window", "plain")]
    done = plain.filter(F.col("plain") >= F.col("nt_length") - 1).select(
        *kept, shift.alias("began"), shift.alias("ended"), F.col("plain").alias("matches"),
        (MATCH * F.col("plain") + MISMATCH * (F.col("nt_length") - F.col("plain"))).alias("score"))
    # the band takes far longer than reading its rows: spread over all cores, however small the table, and kept
    parts = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    uneven = pin(plain.filter(F.col("plain") < F.col("nt_length") - 1).repartition(parts, "rid")
                 .withColumn("read", _padded(F.col("read"), width)))
    top = pin(uneven.select(*kept, _banded("read", "window", width).alias("top")))
    low = F.pmod(F.col("top.cell"), F.lit(_MATCHES))
    banded = top.select(*kept, (_STARTS - low).cast("int").alias("began"), F.col("top.ended").alias("ended"),
                        F.shiftright("top.cell", 12).bitwiseAND((1 << 20) - 1).cast("int").alias("matches"),
                        F.shiftright("top.cell", 32).cast("int").alias("score"))
    found = done.unionByName(banded)
    length, moved = F.col("nt_length"), F.col("ended") - F.col("began")
    # score = matches - 2 mismatches - 4 gap bases, with read bases = matches + mismatches + insertions
    inserted = ((MATCH - MISMATCH) * F.col("matches") + MISMATCH * length + GAP * moved - F.col("score")) / (MISMATCH - 2 * GAP)
    columns = (length + inserted + moved).cast("int")
    return found.select(*keys, F.col("ref_id").alias("gene"), "strand", (F.col("from") + F.col("began")).alias("start"),
                        (F.col("from") + F.col("ended") + length).alias("end"), "nt_length", "seeds", "score", "matches",
                        columns.alias("columns"), F.round(F.col("matches") / columns, 6).alias("identity"))


def mapping_result(aligned: DataFrame, read_id, labels: DataFrame | None = None, sample=None) -> DataFrame:
    """The 11 columns of a mapping result (``sources.files.MAPPING_RESULT_SCHEMA``) and
    ``sample`` from ``align_reads`` rows: ``accuracy`` is the share of the read's bases that
    are matched in whole percent, ``count`` the chain's seeds, ``strain`` the label of the
    reference (``labels``: ``gene, strain``; its id without one), ``identification`` the
    strand."""
    named = aligned if labels is None else aligned.join(labels, "gene", "left")
    strain = F.col("gene") if labels is None else F.coalesce("strain", "gene")
    percent = F.floor(100 * F.col("matches") / F.col("nt_length")).cast("int")
    return named.select(read_id.alias("id"), "nt_length", F.concat(percent.cast("string"), F.lit("%")).alias("accuracy"),
                        F.col("score").alias("alignment_score"), F.col("seeds").cast("int").alias("count"),
                        F.col("identity").alias("alignment_identity"), strain.alias("strain"),
                        F.col("strand").alias("identification"), "gene", "start", "end",
                        *([] if sample is None else [sample.alias("sample")]))
