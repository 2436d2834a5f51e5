"""Medical-records cleaning: positional discharge lines to ``demographics`` and
``billing`` (P1, P2, C1-C11), pharmacy JSON to ``pharmacy`` (P3, C10), and the
strict / quarantine modes (M1, I2).

Both tables are projections of one parsed frame; write or cache that frame to
read the files once.  In quarantine mode every
row gets ``reject_reason`` (NULL when clean); ``split_rejects`` cuts the frame
into the clean table and the rejects, in the same plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C

# Field positions (0-based) of the discharge file and the
# cleaning applied to each, in the reference's order of the demographics table.
# Cleaning kinds: dequote = remove '"'; dequote_q = remove '"' and '?';
# squote = strip "'" at both ends; inner = s[1:-1]; datetime = s[1:-2] parsed
# as yyyy/M/d H:m:s; number = float(s); id = int(float(s));
# icd_code = strip "'" then [1:4]; icd_title = strip "'" then [8:-1].
DEMOGRAPHIC_FIELDS = [
    ("record_id", 4, "id"),
    ("hospital_city", 1, "dequote"),
    ("campus_name", 3, "dequote_q"),
    ("dob", 10, "datetime"),
    ("age", None, "age"),
    ("gender", 12, "dequote"),
    ("ethnicity", 14, "dequote"),
    ("patient_type", 9, "squote"),
    ("admit_date", 25, "datetime"),
    ("source_admission", 30, "dequote"),
    ("icu_flag", 32, "dequote"),
    ("nicu_flag", 33, "dequote"),
    ("infection_flag", 38, "dequote"),
    ("total_days_in_icu", 73, "number"),
    ("diagnosis_count", 74, "number"),
    ("renal_urologic_flag", 70, "dequote"),
    ("medical_complication_flag", 39, "inner"),
    ("surgical_complication_flag", 40, "inner"),
    ("icd_code", 50, "icd_code"),
    ("icd_title", 50, "icd_title"),
    ("severity_level", 61, "dequote"),
    ("risk_of_mortality", 63, "dequote"),
]

# Billing table, id, billing number and 14 amounts at 75..88.
BILLING_FIELDS = [
    ("record_id", 4, "id"),
    ("billing_no", 5, "squote"),
    ("billed_charges", 75, "number"),
    ("adj_billed_charges", 76, "number"),
    ("clinical_charges", 77, "number"),
    ("imaging_charges", 78, "number"),
    ("lab_charges", 79, "number"),
    ("other_charges", 80, "number"),
    ("pharmacy_charges", 81, "number"),
    ("supply_charges", 82, "number"),
    ("adj_clinical_charges", 83, "number"),
    ("adj_imaging_charges", 84, "number"),
    ("adj_lab_charges", 85, "number"),
    ("adj_other_charges", 86, "number"),
    ("adj_pharmacy_charges", 87, "number"),
    ("adj_supply_charges", 88, "number"),
]

# Pharmacy JSON field names -> table columns (P3), and the
# fields the reference drops first.
PHARMACY_COLUMNS = [
    ("Discharge ID", "record_id"),
    ("Drug Class Title", "drug_class"),
    ("Therapeutic Category Title", "therapeutic_category"),
    ("Generic Drug Title", "generic_drug"),
    ("Adj Pharmacy Charges", "adj_pharmacy_charges"),
    ("Pharmacy Charges", "pharmacy_charges"),
    ("Date Of Service", "date_of_service"),
]
PHARMACY_AMOUNTS = ("adj_pharmacy_charges", "pharmacy_charges")
PHARMACY_DROPPED = ["Day Of Service", "Drug Class", "Generic Drug", "Route Of Administration",
                    "Route Of Administration Title", "Therapeutic Category"]

PHARMACY_SCHEMA = T.StructType(
    [T.StructField("Discharge ID", T.StringType()),
     T.StructField("Drug Class Title", T.StringType()),
     T.StructField("Therapeutic Category Title", T.StringType()),
     T.StructField("Generic Drug Title", T.StringType()),
     T.StructField("Adj Pharmacy Charges", T.StringType()),   # text, so that a bad amount is seen
     T.StructField("Pharmacy Charges", T.StringType()),
     T.StructField("Date Of Service", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in PHARMACY_DROPPED])

MIN_FIELDS = 89  # highest position read is 88

_PRIORITY = ["short_line", "bad_id", "bad_date", "bad_number"]


def _field(fields: Column, pos: int) -> Column:
    return F.get(fields, pos)


def _clean(kind: str, raw: Column, mode: str) -> Column:
    if kind == "dequote":
        return C.remove_chars(raw, '"')
    if kind == "dequote_q":
        return C.remove_chars(raw, '"?')
    if kind == "squote":
        return C.strip_chars(raw, "'")
    if kind == "inner":
        return C.py_slice(raw, 1, -1)
    if kind == "icd_code":
        return C.py_slice(C.strip_chars(raw, "'"), 1, 4)
    if kind == "icd_title":
        return C.py_slice(C.strip_chars(raw, "'"), 8, -1)
    if kind == "datetime":
        return C.parse_datetime(C.py_slice(raw, 1, -2), C.RECORD_DATETIME, mode)
    if kind == "number":
        return C.parse_double(raw, mode)
    if kind == "id":
        return C.parse_int_trunc(raw, mode)
    raise ValueError(kind)


def parse_discharge(split_lines: DataFrame, mode: str = C.QUARANTINE,
                    fields_col: str = "fields") -> DataFrame:
    """All demographic and billing columns from split discharge lines.

    ``mode='strict'`` raises on the first bad value (and on short lines);
    ``mode='quarantine'`` adds ``reject_reason``: the first of short_line,
    bad_id, bad_date, bad_number that applies, else NULL.
    """
    f = F.col(fields_col)
    seen: dict[str, Column] = {}
    for name, pos, kind in DEMOGRAPHIC_FIELDS + BILLING_FIELDS:
        if name in seen or kind == "age":
            continue
        seen[name] = _clean(kind, _field(f, pos), mode)
    if mode == C.STRICT:
        guard = F.when(F.size(f) < MIN_FIELDS,
                       F.raise_error(F.concat(F.lit("short line with fields: "), F.size(f).cast("string"))))
        seen["record_id"] = F.coalesce(guard.cast("bigint"), seen["record_id"])
    staged = split_lines.select(F.size(f).alias("_n"), *[c.alias(n) for n, c in seen.items()],
                                *[F.col(c) for c in split_lines.columns if c in ("file", "line")])
    staged = staged.withColumn("age", C.completed_years("dob", "admit_date"))
    if mode == C.STRICT:
        return staged.drop("_n")
    numbers = [n for n, _, k in DEMOGRAPHIC_FIELDS + BILLING_FIELDS if k == "number"]
    checks = {
        "short_line": F.col("_n") < MIN_FIELDS,
        "bad_id": F.col("record_id").isNull(),
        "bad_date": F.col("dob").isNull() | F.col("admit_date").isNull(),
        "bad_number": F.greatest(*[F.col(n).isNull() for n in numbers]),
    }
    reason = F.lit(None).cast("string")
    for label in reversed(_PRIORITY):
        reason = F.when(checks[label], F.lit(label)).otherwise(reason)
    return staged.withColumn("reject_reason", reason).drop("_n")


def demographics(parsed: DataFrame) -> DataFrame:
    return parsed.select(*[n for n, _, _ in DEMOGRAPHIC_FIELDS],
                         *(["reject_reason"] if "reject_reason" in parsed.columns else []))


def billing(parsed: DataFrame) -> DataFrame:
    return parsed.select(*[n for n, _, _ in BILLING_FIELDS],
                         *(["reject_reason"] if "reject_reason" in parsed.columns else []))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the reason column, rejected rows with it)."""
    if "reject_reason" not in df.columns:
        return df, df.limit(0)
    clean = df.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return clean, df.filter(F.col("reject_reason").isNotNull())


def pharmacy(raw: DataFrame, mode: str = C.QUARANTINE, rejects: bool = False) -> DataFrame:
    """Pharmacy records: drop the unused fields, rename the kept ones, parse the
    service date (P3, C10); ``record_id`` by ``int(float(s))``, amounts by ``float(s)``
    (quoted or not; a missing one stays NULL).  With ``rejects`` (quarantine mode),
    ``reject_reason`` is bad_id, bad_date, bad_number or NULL, for ``split_rejects`` (M1)."""
    kept = raw.drop(*PHARMACY_DROPPED)
    cols, bad_amount = [], F.lit(False)
    for src, dst in PHARMACY_COLUMNS:
        c = F.col(f"`{src}`")
        if dst == "record_id":
            c = C.parse_int_trunc(c.cast("string"), mode)
        elif dst == "date_of_service":
            c = C.parse_datetime(c, C.SERVICE_DATETIME, mode)
        elif dst in PHARMACY_AMOUNTS:
            text = c.cast("string")
            c = F.when(text.isNotNull(), C.parse_double(text, mode))
            bad_amount = bad_amount | (text.isNotNull() & C.parse_double(text).isNull())
        cols.append(c.alias(dst))
    if not rejects:
        return kept.select(*cols)
    out = kept.select(*cols, bad_amount.alias("_bad_amount"))
    reason = (F.when(F.col("record_id").isNull(), "bad_id").when(F.col("date_of_service").isNull(), "bad_date")
              .when(F.col("_bad_amount"), "bad_number"))
    return out.withColumn("reject_reason", reason).drop("_bad_amount")
