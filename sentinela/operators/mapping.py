"""Read mapping as a seed-and-vote equi-join.

Reads and references are cut into overlapping k-grams (DNA k-mers or word
shingles); shared k-grams are found by an equi-join, votes are counted per
candidate placement and the best placement per read is kept.

Scale notes:
* A reference is cut into windows before exploding, so no row holds a whole
  genome's k-mers.
* DNA k-mers are packed numbers (``seeds``), never strings.
* The reference side is broadcast only when its row count is proven under a
  bound; otherwise reads keep only the k-mers that the references hold, and both
  sides are shuffled on the codes, AQE splitting skewed (repeat) keys.  No k-gram
  is capped or sampled away.
* The bound is proven on the raw references (total length), before any
  k-gram is built.  Word shingles are broadcast by ``xxhash64`` and every hit is
  re-checked against the words; otherwise they shuffle on the words.  Both are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import DEFAULT_BROADCAST_ROWS, total_at_most
from .partitions import pin, spread
from .seeds import both_strands, code_names, kmers, known_only, reverse_complement

# ---------------------------------------------------------------- text form


def word_tokens(text) -> F.Column:
    """Lower-case words of letters of any script, empty pieces removed; a NULL text has no
    words.  The result is never NULL, so a join on k-grams of it infers no
    ``isnotnull(tokens)`` filter, which would be pushed below the shuffle and
    tokenize every text a second time."""
    return F.coalesce(F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), ""), F.array().cast("array<string>"))


def _gram_starts(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``id_col, _w, _i``: the word array and one row per k-gram start (1-based).
    Texts with fewer than ``k`` words give no rows."""
    words = df.select(id_col, word_tokens(F.col(text_col)).alias("_w"))
    n = F.size("_w")
    return words.select(id_col, "_w", F.explode(F.when(n >= k, F.sequence(F.lit(1), n - k + 1))).alias("_i"))


def _gram(k: int) -> F.Column:
    return F.slice(F.col("_w"), F.col("_i"), F.lit(k))


def shingles(df: DataFrame, id_col: str, text_col: str, k: int = 8,
             out: str = "shingle") -> DataFrame:
    """All k-word shingles of every text as strings: ``id_col, out``."""
    return _gram_starts(df, id_col, text_col, k).select(id_col, F.array_join(_gram(k), " ").alias(out))


def shingle_seeds(docs: DataFrame, refs: DataFrame, doc_id: str = "doc_id",
                  ref_id: str = "item_id", text: str = "text", k: int = 8,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Distinct shared shingles per (document, reference): ``doc_id, ref_id, seeds``.

    Shingles are word arrays.  When the reference shingles are proven to fit
    ``max_broadcast_rows`` they are broadcast keyed by ``xxhash64`` of the
    array: documents are never shuffled, each document shingle costs one hash
    and one probe, and only probe hits are checked word by word (so a hash
    collision cannot create a seed).  The bound is proven on the raw
    references (total characters), before any shingle is built.  Otherwise
    both sides are shuffled on the word array itself.
    """
    ref_sh = _gram_starts(refs, ref_id, text, k).select(ref_id, _gram(k).alias("gram")).distinct()
    doc_g = _gram_starts(spread(docs.select(doc_id, text), [doc_id]), doc_id, text, k)
    # a text of n characters has fewer than n word starts, hence fewer shingles
    if total_at_most(refs, F.length(text), max_broadcast_rows):
        probe = doc_g.withColumn("h", F.xxhash64(_gram(k)))
        build = F.broadcast(ref_sh.withColumn("h", F.xxhash64("gram")))
        hits = probe.join(build, "h", "inner").filter(_gram(k) == F.col("gram"))
    else:
        hits = doc_g.select(doc_id, _gram(k).alias("gram")).join(ref_sh, "gram", "inner")
    return (hits.select(doc_id, ref_id, "gram").distinct()
            .groupBy(doc_id, ref_id).agg(F.count(F.lit(1)).alias("seeds")))


def best_reference(seeds: DataFrame, doc_id: str = "doc_id", ref_id: str = "item_id",
                   score: str = "seeds") -> DataFrame:
    """Best reference per document: most seeds, ties to the smallest numeric id.
    A plain ``max`` aggregate with partial merge (no window)."""
    best = F.max(F.struct(F.col(score).alias("s"), (-F.col(ref_id)).alias("r"))).alias("_b")
    return seeds.groupBy(doc_id).agg(best).select(
        doc_id, (-F.col("_b.r")).alias(ref_id), F.col("_b.s").alias(score))


# ----------------------------------------------------------------- DNA form

#: Bases a read is cut into before its k-mers are taken (reads of up to so many are one piece).
READ_PIECE = 500


_kmers = kmers


def cut(df: DataFrame, keys: list[str], seq: str, size: int, overlap: int = 0) -> DataFrame:
    """``keys, start BIGINT, piece, n``: ``seq`` cut at every multiple of ``size``, each
    piece extended by ``overlap`` letters of the next; ``n`` is its length without
    them.  An empty or NULL sequence is one empty piece.

    A letter is found by walking the string to it, so long sequences are cut in
    steps (about 100,000, 4,000, ``size``): each walk is over a short string and
    the whole cut is near linear in the length."""
    levels = [size]
    for coarse in (4_000, 100_000):
        if coarse >= 2 * levels[-1]:
            levels.append(coarse // levels[-1] * levels[-1])
    out = df.select(*keys, F.coalesce(F.col(seq), F.lit("")).alias("piece"), F.lit(0).cast("bigint").alias("start"))
    out = out.withColumn("n", F.length("piece"))
    for step in reversed(levels):
        starts = F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(step))
        staged = out.select(*keys, "start", "piece", "n", F.explode(starts).alias("_at"))
        out = staged.select(*keys, (F.col("start") + F.col("_at")).alias("start"),
                            F.substring(F.col("piece"), F.col("_at") + 1, step + overlap).alias("piece"),
                            F.least(F.lit(step), F.col("n") - F.col("_at")).alias("n"))
    return out


def reference_windows(refs: DataFrame, ref_id: str = "ref_id", seq: str = "seq",
                      window: int = 200, k: int = 21) -> DataFrame:
    """Cut references into windows of ``window`` k-mer starts, each extended by
    ``k - 1`` bases so that every k-mer lies whole in exactly one window:
    ``ref_id, wstart, wseq, _wn``."""
    return cut(refs, [ref_id], seq, window, k - 1).select(
        ref_id, F.col("start").alias("wstart"), F.col("piece").alias("wseq"), F.col("n").alias("_wn"))


#: Bases per reference tile when placed reads are compared base by base.
TILE = 64


def matching_bases(placed: DataFrame, refs: DataFrame, broadcast: bool = False) -> DataFrame:
    """``rid, matches``: bases of a placed read that equal the reference base
    they lie on; letters other than A, C, G, T never match.

    ``placed`` has ``rid, fwd, ref_id, strand, diag, nt_length``, ``refs`` has
    ``ref_id, seq``.  Reads and references meet tile by tile (``TILE`` reference
    bases), so neither a genome nor a long read is compared in one row."""
    one = placed.select("rid", "ref_id", "diag", "nt_length", F.regexp_replace(
        F.when(F.col("strand") == "+", F.col("fwd")).otherwise(reverse_complement(F.col("fwd"))), "[^ACGT]", ".").alias("_o"))
    first = F.floor(F.greatest(F.col("diag"), F.lit(0)) / TILE) * TILE
    tiled = (one.select("*", F.explode(F.sequence(first, F.col("diag") + F.col("nt_length") - 1, F.lit(TILE).cast("bigint")))
                        .alias("start"))
             .withColumn("_lo", F.greatest("diag", "start"))
             .withColumn("_len", (F.least(F.col("diag") + F.col("nt_length"), F.col("start") + TILE) - F.col("_lo"))
                         .cast("int"))
             .select("rid", "ref_id", "start", "_len",
                     F.substring(F.col("_o"), (F.col("_lo") - F.col("diag") + 1).cast("int"), F.col("_len")).alias("_a"),
                     (F.col("_lo") - F.col("start")).cast("int").alias("_skip")))
    tiles = cut(refs.select("ref_id", "seq"), ["ref_id"], "seq", TILE).select("ref_id", "start", "piece")
    met = tiled.join(F.broadcast(tiles) if broadcast else tiles, ["ref_id", "start"])
    equal = F.size(F.filter(F.sequence(F.lit(1), F.col("_len")), lambda i: F.substring(F.col("_a"), i, 1)
                            == F.substring(F.col("piece"), F.col("_skip") + i, 1)))
    return met.groupBy("rid").agg(F.sum(equal).alias("matches"))


def held_reads(reads: DataFrame, keys: list[Column], seq: str) -> DataFrame:
    """``rid``, the key columns, ``fwd`` and ``nt_length``, kept in the shared folder:
    seeds then carry one BIGINT for a read whatever names it, and what made the
    reads (framing, cutting) runs once."""
    spark = reads.sparkSession
    made = reads.select(F.monotonically_increasing_id().alias("rid"), *keys, F.upper(F.col(seq)).alias("fwd"))
    made = made.withColumn("nt_length", F.length("fwd"))
    path = scratch_path(spark, "reads")
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def seed_hits(held: DataFrame, genomes: DataFrame, k: int, window: int,
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              max_filter_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``rid, ref_id, strand, diag``, one row per shared k-mer of a read and a reference,
    and whether the references were proven small.

    Reads are enumerated on one strand: the read's reverse complement has at
    ``q'`` the k-mer rc(read[L-k-q' : L-q']), so it matches a reference k-mer exactly
    when the read's forward k-mer at ``q = L-k-q'`` equals that k-mer's reverse
    complement, which the (smaller) reference side adds."""
    codes = code_names(k)
    index = both_strands(reference_windows(genomes, "ref_id", "seq", window, k), ["ref_id"], "wseq", k, "wstart") \
        .withColumnRenamed("pos", "rpos")
    pieces = cut(held.filter(F.col("nt_length") >= k), ["rid", "nt_length"], "fwd", READ_PIECE, k - 1)
    # the read's place and its length as one number
    read_k = kmers(pieces, ["rid", "nt_length"], "piece", k, base_pos="start", limit_col="n").select(
        "rid", (F.shiftleft(F.col("nt_length").cast("bigint"), 32) + F.col("pos")).alias("at"), *codes)
    # a reference of n bases has at most n k-mers per strand: prove the bound on the raw input
    small = total_at_most(genomes, 2 * F.length("seq"), max_broadcast_rows)
    if small:
        met = read_k.join(F.broadcast(index), codes, "inner")
    else:
        met = known_only(read_k, index, codes, max_filter_rows).join(index, codes, "inner")
    q, length = F.col("at") % (1 << 32), F.shiftright("at", 32)
    qpos = F.when(F.col("strand") == "+", q).otherwise(length - k - q)
    return met.select("rid", "ref_id", "strand", (F.col("rpos") - qpos).alias("diag")), small


def read_keys(read_id: str | list[str]) -> tuple[list[str], list[Column]]:
    """Names and columns that name a read: one id, or several columns together (sample, mate, ...)."""
    if isinstance(read_id, str):
        return ["read_id"], [F.col(read_id).alias("read_id")]
    return list(read_id), [F.col(c) for c in read_id]


def map_reads(reads: DataFrame, refs: DataFrame, k: int = 21, window: int = 200,
              min_seeds: int = 2, read_id: str | list[str] = "read_id", read_seq: str = "seq",
              ref_id: str = "ref_id", ref_seq: str = "seq",
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Place each read on a reference (both strands) by k-mer voting.

    ``read_id`` is one column (returned as ``read_id``) or a list of columns that
    name a read together and are returned as they are, such as sample, mate and
    id.  Repeated references count once; repeated reads are reads of their own.

    Returns ``read_id, gene, strand, start, end, nt_length, seeds, identity``
    where ``start`` is the 0-based reference position of read base 0 on the
    winning diagonal, ``seeds`` the number of read k-mers on that diagonal and
    ``identity`` the share of the read's bases that equal the reference base on
    that diagonal (see ``matching_bases``).  Reads with fewer than ``min_seeds`` seeds on every diagonal are left out.  Ties go to the smallest
    reference id, then ``+`` strand, then smallest start.  ``operators.alignment``
    places reads with gaps.
    """
    if k < 1:
        raise ValueError("k must be positive")
    keys, named = read_keys(read_id)
    genomes = refs.select(F.col(ref_id).alias("ref_id"), F.upper(F.col(ref_seq)).alias("seq")).distinct()
    held = held_reads(reads, named, read_seq)
    hits, small = seed_hits(held, genomes, k, window, max_broadcast_rows)
    # one row per (read k-mer, reference k-mer): on a fixed diagonal each read position meets at most one reference position
    votes = (hits.groupBy("rid", "strand", "ref_id", "diag").agg(F.count(F.lit(1)).alias("seeds"))
             .filter(F.col("seeds") >= min_seeds))
    # best placement per read: a plain min aggregate (partial before the
    # shuffle), so a read with many candidate placements is never sorted whole
    pick = F.min(F.struct((-F.col("seeds")).alias("ns"), "ref_id", "strand", "diag"))
    best = votes.groupBy("rid").agg(pick.alias("_b")).select(
        "rid", (-F.col("_b.ns")).alias("seeds"), "_b.ref_id", "_b.strand", "_b.diag")
    # read twice below (comparison and result), so the votes are counted and the winners' reads fetched once
    placed = pin(best.join(held, "rid"))
    found = placed.join(matching_bases(placed, genomes, small), "rid")
    return found.select(*keys, F.col("ref_id").alias("gene"), "strand",
                        F.col("diag").alias("start"), (F.col("diag") + F.col("nt_length")).alias("end"),
                        "nt_length", "seeds",
                        F.round(F.col("matches") / F.col("nt_length"), 6).alias("identity"))
