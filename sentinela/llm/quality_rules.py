"""Quality rules: a threshold table compiled into one Spark projection.

Counts are built-in expressions over the word and line arrays of a text; every
rule compares ``scale * numerator`` with ``bound * denominator`` in whole
numbers, so no verdict hangs on rounding.  No user functions run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import passes_columns

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
MIN_WORDS = 50
REPEAT_PERCENT = 50

# Frequent function words of English, German, French and Spanish, then of Italian,
# Portuguese, Dutch, Swedish, Polish, Turkish and Russian.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "it", "that", "was", "for", "on", "with", "as", "are", "by", "an", "be",
    "der", "die", "das", "und", "ein", "eine", "ist", "den", "dem", "des", "mit", "von", "zu", "für", "auf", "im",
    "le", "la", "les", "de", "des", "et", "est", "un", "une", "en", "du", "que", "qui", "dans", "pour", "pas",
    "el", "los", "las", "del", "y", "se", "su", "con", "por", "es", "para", "una", "lo",
    "il", "di", "che", "non", "per", "della", "sono", "gli", "alla",
    "não", "uma", "com", "dos", "mais", "como", "pela", "ao",
    "het", "een", "van", "niet", "zijn", "voor", "met", "aan", "ook",
    "och", "att", "det", "som", "är", "inte", "med", "till", "av",
    "się", "nie", "jest", "na", "że", "jak", "ale", "przez", "oraz",
    "ve", "bir", "bu", "için", "ile", "olarak", "çok", "daha", "gibi",
    "и", "в", "не", "на", "что", "он", "как", "это", "из",
)


#: Lower case, capitalized and in capitals, as they stand in a text without punctuation.
STOP_FORMS = sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})
#: Letters of the scripts of these languages: Latin and Cyrillic.
LISTED_SCRIPTS = r"[^A-Za-z\x{C0}-\x{24F}\x{400}-\x{4FF}]+"


@dataclass(frozen=True)
class Rule:
    """Passes when ``scale * num`` is at least (``low``) or at most (``high``) ``bound * den``,
    or when ``scale * count`` is below ``bound * other`` for the counts of ``unless``."""

    name: str
    num: str
    den: str
    low: tuple[int, int] | None = None   # (scale, bound)
    high: tuple[int, int] | None = None
    unless: tuple[int, str, int, str] | None = None

    def passed(self) -> Column:
        checks = []
        if self.low:
            checks.append(F.lit(self.low[0]) * F.col(self.num) >= F.lit(self.low[1]) * F.col(self.den))
        if self.high:
            checks.append(F.lit(self.high[0]) * F.col(self.num) <= F.lit(self.high[1]) * F.col(self.den))
        out = checks[0]
        for c in checks[1:]:
            out = out & c
        if self.unless:
            scale, count, bound, other = self.unless
            out = out | (F.lit(scale) * F.col(count) < F.lit(bound) * F.col(other))
        return out


#: The threshold table.  Ratios are per word unless a denominator says otherwise.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=(10, 25), high=(1, 12)),     # 2.5 to 12 code points a word
    Rule("symbols", "n_symbols", "n_words", high=(100, 10)),                      # at most 0.1 symbols a word
    Rule("stop_words", "n_stop_words", "n_words", low=(100, 4),                   # at least 4 % function words,
         unless=(2, "n_listed", 1, "word_chars")),                                # or mostly in other scripts
    Rule("shouting", "n_bangs", "n_words", high=(100, 20)),                       # at most 0.2 exclamation marks a word
    Rule("dup_lines", "n_dup_lines", "n_lines", high=(100, 50)),                  # at most half repeated lines
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by their 64-bit hash (two different windows of a text of
    20,000 words share one with a chance of 1e-11).  If all are distinct, which
    one pass tells, there is nothing to add up; else equal ones meet by sorting
    the hashes with their places, and the words from one covered place to the
    next are added up."""
    def starts(s: Column) -> Column:
        again = F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False))
                         | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False)))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.aggregate(F.sequence(F.lit(1), F.size(at) - 1), F.lit(3),
                            lambda acc, j: acc + F.least(F.lit(3), F.get(at, j) - F.get(at, j - 1)))
        return F.when(F.size(at) >= 2, steps).otherwise(0)

    def repeated(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(h) > F.size(F.array_distinct(h)), _let(_let(F.sort_array(placed), starts), covered))

    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    found = F.when(F.size(words) > 3, _let(F.slice(hashes, 1, F.size(words) - 2), repeated))
    return F.coalesce(found, F.lit(0)).cast("long")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct ``__quality`` of the measured counts (see ``judge``)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    q = docs.withColumn("__text", text)
    q = q.withColumn("__spaced", F.btrim(F.regexp_replace("__text", WORD_GAP, " ")))
    q = q.withColumn("__in_words", _let(F.split("__spaced", " "), lambda w: F.struct(
        _repeat_words(w).alias("repeat"), F.size(F.filter(w, lambda x: x.isin(STOP_FORMS))).cast("long").alias("stop"))))
    q = q.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    lines = F.col("__lines")
    bare = F.char_length(F.replace("__spaced", F.lit(" "), F.lit("")))
    gaps = F.char_length("__spaced") - bare
    counts = F.struct(
        F.when(bare == 0, 0).otherwise(gaps + 1).cast("long").alias("n_words"),
        bare.cast("long").alias("word_chars"),
        (F.char_length("__text") - F.char_length(F.regexp_replace("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.col("__in_words.repeat").alias("n_repeat_words"),
        F.col("__in_words.stop").alias("n_stop_words"),
        # looked at only where function words are few
        F.when(100 * F.col("__in_words.stop") >= 4 * (gaps + 1), bare).otherwise(
            F.char_length(F.regexp_replace("__text", LISTED_SCRIPTS, ""))).cast("long").alias("n_listed"),
        (F.char_length("__text") - F.char_length(F.replace("__text", F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
    )
    return q.withColumn("__quality", counts).select(*[F.col(f"`{c}`") for c in docs.columns], "__quality")


@passes_columns
def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus the struct ``__quality``: the counts of ``measure``,
    ``base_failed``, ``kept`` and ``failed_rules`` (names in table order).

    Null and empty texts have no words and fail.  Rows are judged one by one, so
    repeated rows, ties and nulls elsewhere change nothing; an empty table stays
    empty.  Extra columns are passed on."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    q = measure(docs, text_col)
    names = q.schema["__quality"].dataType.names
    flat = q.select(F.struct(*own).alias("__row"), *[F.col(f"__quality.{n}").alias(n) for n in names])
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules]))
    flat = flat.withColumn("base_failed", base).withColumn("failed_rules", failed)
    verdict = F.struct(*names, "base_failed", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
                       "failed_rules")
    return flat.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns], verdict.alias("__quality"))


@passes_columns
def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were.

    Rows leave through a generator of the verdict (one row or none): a plain
    filter would be pushed below the projection and count everything again for
    every mention of a count."""
    judged = judge(docs, text_col, rules)
    good = F.filter(F.array("__quality"), lambda q: q["kept"])
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(good).alias("__good")).drop("__good")
