"""Column expressions for cleaning positional records.

All are built-in Spark SQL expressions, so they stay inside whole-stage codegen.
Parsers come in two modes from one definition: ``strict`` raises on a bad value
(like the reference, where one bad field stops the job) and ``quarantine``
returns NULL so that the caller can route the row to a rejects frame.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT = "strict"
QUARANTINE = "quarantine"

# The reference's date-time layout (strptime %Y/%m/%d %H:%M:%S,
# which also takes one-digit fields) and its pharmacy layout.
RECORD_DATETIME = "yyyy/M/d H:m:s"
SERVICE_DATETIME = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_chars(c, chars: str) -> Column:
    """``s.replace(a, '').replace(b, '')...`` for single characters."""
    return F.translate(_c(c), chars, "")


def strip_chars(c, chars: str) -> Column:
    """Python ``s.strip(chars)``."""
    return F.btrim(_c(c), F.lit(chars))


def py_slice(c, start: int, stop: int | None = None) -> Column:
    """Python ``s[start:stop]`` for ``start >= 0`` and any ``stop``.

    Out-of-range bounds give ``''`` like Python, never an error.
    """
    c = _c(c)
    if stop is None:
        return c.substr(F.lit(start + 1), F.greatest(F.length(c) - start, F.lit(0)))
    end = F.length(c) + stop if stop < 0 else F.least(F.length(c), F.lit(stop))
    return c.substr(F.lit(start + 1), F.greatest(end - start, F.lit(0)))


def _checked(parsed: Column, raw: Column, mode: str, what: str) -> Column:
    if mode == STRICT:
        return F.when(parsed.isNull(),
                      F.raise_error(F.concat(F.lit(f"bad {what}: "), F.coalesce(raw, F.lit("NULL")))))\
                .otherwise(parsed)
    return parsed


# Number syntax of Python's float(): digits may be grouped by single underscores.
_DIGITS = r"\d+(_\d+)*"
_NUMBER = (rf"^\s*[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?"
           r"|(?i:inf|infinity|nan))\s*$")


def _py_float(raw: Column) -> Column:
    """``float(s)`` where Python takes the text, else NULL (Spark's cast also takes ``1.0d``)."""
    text = raw.cast("string")
    # of digits, points and signs alone, both take the same texts; the pattern is for the rest
    return F.when(F.translate(text, "0123456789.+-", "") == "", text.try_cast("double")).when(
        text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def parse_double(c, mode: str = QUARANTINE) -> Column:
    """Python ``float(s)``."""
    raw = _c(c)
    return _checked(_py_float(raw), raw, mode, "number")


def parse_int_trunc(c, mode: str = QUARANTINE) -> Column:
    """Python ``int(float(s))``: parse, then truncate toward zero."""
    raw = _c(c)
    parsed = _py_float(raw).try_cast("bigint")
    return _checked(parsed, raw, mode, "integer")


# Date-time pattern letters understood by ``parse_datetime`` and the digits each takes.
_DT_TOKENS = [("yyyy", "y", r"(\d{4})"), ("MM", "M", r"(\d{2})"), ("M", "M", r"(\d{1,2})"),
              ("dd", "d", r"(\d{2})"), ("d", "d", r"(\d{1,2})"), ("HH", "H", r"(\d{2})"),
              ("H", "H", r"(\d{1,2})"), ("mm", "m", r"(\d{2})"), ("m", "m", r"(\d{1,2})"),
              ("ss", "s", r"(\d{2})"), ("s", "s", r"(\d{1,2})")]


def _datetime_regex(fmt: str) -> tuple[str, list[str], bool]:
    """Anchored regex for ``fmt``, the field letters in order, and whether
    every two fields are parted by a non-digit literal."""
    out, fields, i, parted, last_was_field = [], [], 0, True, False
    while i < len(fmt):
        for tok, field, rx in _DT_TOKENS:
            if fmt.startswith(tok, i):
                out.append(rx)
                fields.append(field)
                parted = parted and not last_was_field
                last_was_field = True
                i += len(tok)
                break
        else:
            out.append(re.escape(fmt[i]))
            last_was_field = last_was_field and fmt[i].isdigit()
            i += 1
    return "^" + "".join(out) + "$", fields, parted


def _canonical_date_sep(fmt: str, fields: list[str]) -> str | None:
    """The date separator when ``fmt`` is ``y?M?d H:m:s`` (or ``y?M?d``) with
    ``?`` one of ``/`` and ``-``; else None."""
    if fields not in (list("yMdHms"), list("yMd")):
        return None
    lits = [ch for ch in re.sub(r"yyyy|MM|M|dd|d|HH|H|mm|m|ss|s", "", fmt)]
    want_time = [" ", ":", ":"] if len(fields) == 6 else []
    if len(lits) == 2 + len(want_time) and lits[0] == lits[1] and lits[0] in "/-" \
            and lits[2:] == want_time:
        return lits[0]
    return None


def parse_datetime(c, fmt: str = RECORD_DATETIME, mode: str = QUARANTINE) -> Column:
    """``strptime`` to a zone-less timestamp.

    The fields are matched by a regular expression built from ``fmt`` and
    assembled with ``try_make_timestamp_ntz``, so the result never passes
    through the session time zone (no DST gap can shift it) and impossible
    dates such as Feb 30 give NULL."""
    raw = _c(c)
    rx, fields, parted = _datetime_regex(fmt)
    date_sep = _canonical_date_sep(fmt, fields)
    if date_sep is not None:
        # y-M-d H:m:s layouts: once the shape is checked, Spark's own cast to
        # TIMESTAMP_NTZ reads one- or two-digit fields, validates the calendar
        # and never uses the session zone.  One expression, no field array:
        # a pushed-down reject filter has no common-subexpression elimination,
        # and would otherwise rebuild the array once per field.
        text = F.translate(raw, date_sep, "-") if date_sep != "-" else raw
        parsed = F.when(raw.rlike(rx), text.try_cast("timestamp_ntz"))
        return _checked(parsed, raw, mode, "timestamp")
    if parted:   # one split on non-digits gives the fields in order
        digits = F.split(raw, "[^0-9]+", -1)
        part = {f: F.get(digits, i).try_cast("int") for i, f in enumerate(fields)}
    else:
        part = {f: F.regexp_extract(raw, rx, i + 1).try_cast("int") for i, f in enumerate(fields)}
    zero = F.lit(0)
    parsed = F.when(raw.rlike(rx), F.try_make_timestamp_ntz(
        part["y"], part.get("M", F.lit(1)), part.get("d", F.lit(1)),
        part.get("H", zero), part.get("m", zero), part.get("s", zero)))
    return _checked(parsed, raw, mode, "timestamp")


def completed_years(born, at) -> Column:
    """Age in completed years at a date (C11): year difference minus one
    when the (month, day) of ``at`` comes before that of ``born``."""
    born, at = _c(born), _c(at)
    before = (F.month(at) * 100 + F.dayofmonth(at)) < (F.month(born) * 100 + F.dayofmonth(born))
    return (F.year(at) - F.year(born) - F.when(before, 1).otherwise(0)).cast("bigint")


def key_prefix(c, sep: str) -> Column:
    """``s.split(sep)[0]``."""
    return F.split_part(_c(c), F.lit(sep), F.lit(1))


def sample_folder(name) -> Column:
    """First nine characters of a sequence file name."""
    return F.substring(_c(name), 1, 9)


def sample_rest(name) -> Column:
    """Name after the folder and its separator, ``name[10:]``."""
    return py_slice(name, 10)


def mate_digit(name) -> Column:
    """``name[-7]``: the mate digit before ``.fastq``."""
    return F.substring(_c(name), -7, 1)


def chunk_name(*parts) -> Column:
    """``folder_mate_n`` style names (C20)."""
    return F.concat_ws("_", *[_c(p).cast("string") for p in parts])


def lineage_label(lineage) -> Column:
    """``'_'.join(lineage)`` (C14)."""
    return F.array_join(_c(lineage), "_")


def level_band(value, n_bands: int = 9) -> tuple[Column, Column]:
    """Band number ``floor(v)`` clamped to ``0..n_bands-1`` and its label ``'b-(b+1)'``
    (C16).  NULL and NaN have no band (NULL, NULL)."""
    v = _c(value)
    band = F.when(v.isNotNull() & ~F.isnan(v.cast("double")), F.least(F.greatest(F.floor(_c(value)), F.lit(0)), F.lit(n_bands - 1)).cast("int"))
    label = F.concat(band.cast("string"), F.lit("-"), (band + 1).cast("string"))
    return band, label


def split_list(c, sep: str = ",") -> Column:
    """Comma string to ``ARRAY<STRING>``."""
    return F.split(_c(c), sep, -1)


def split_long_list(c, sep: str = ",") -> Column:
    """Comma string to ``ARRAY<BIGINT>``."""
    return F.transform(F.split(_c(c), sep, -1), lambda x: x.cast("bigint"))


def share_rounded(part, total, digits: int = 4) -> Column:
    """``round(100 * part / total, digits)`` with exact half-up rounding done in
    whole DECIMAL numbers (any BIGINT counts), so the value does not depend on floating-point evaluation order."""
    scale = 10 ** (digits + 2)
    whole = _c(total).cast("decimal(20,0)")
    num = _c(part).cast("decimal(20,0)") * F.lit(2 * scale).cast("decimal(12,0)") + whole
    return F.when(_c(total) > 0, F.call_function("div", num, whole * F.lit(2).cast("decimal(1,0)"))
                  / F.lit(float(10 ** digits)))
