"""Hand-written discharge and pharmacy fixtures (FIXTURES.md layouts A and B)."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import write_text
from sentinela.functions import cleaning as C
from sentinela.operators import records as R
from sentinela.sources import files as S


def line(pos=None):
    f = [""] * 89
    defaults = {1: '"Boston"', 3: '"Main?"', 4: "7.0", 5: "'B-7'", 9: "'In'",
                10: '"1980/5/17 0:0:0" ', 25: '"2020/5/17 8:30:0" ', 12: '"F"', 14: '"X"',
                39: '"Y"', 40: '"N"', 50: "'A12 xx Title text'", 61: '"2"', 63: '"3"', 70: '"0"'}
    for p in range(73, 89):
        defaults[p] = "0"
    defaults.update(pos or {})
    for p, v in defaults.items():
        f[p] = v
    return ";".join(f)


def parse(spark, tmp_path, lines, mode=C.QUARANTINE, skip=3):
    path = write_text(str(tmp_path / "discharge" / "part-0.csv"), lines)
    split = S.read_delimited(spark, path, sep=";", min_fields=2, skip=skip)
    return R.parse_discharge(split, mode=mode)


HEAD = ["name;of;extract", "lonely-one-field-line", "date;2024", "col;names"]


def test_header_rows_and_one_field_line(spark, tmp_path):
    rows = parse(spark, tmp_path, HEAD + [line(), line({4: "8.0"})]).collect()
    assert [r.record_id for r in rows] == [7, 8]
    assert all(r.reject_reason is None for r in rows)


def test_field_cleaning(spark, tmp_path):
    r = parse(spark, tmp_path, HEAD + [line({4: "12.7", 73: "1e3", 39: '"a', 40: "", 5: "''"})]).collect()[0]
    assert r.record_id == 12                      # int(float('12.7'))
    assert r.hospital_city == "Boston"            # quotes removed
    assert r.campus_name == "Main"                # quotes and '?' removed
    assert r.billing_no == ""                     # "''".strip("'")
    assert r.patient_type == "In"
    assert r.total_days_in_icu == 1000.0          # float('1e3')
    assert r.icd_code == "A12 xx Title text"[1:4]
    assert r.icd_title == "A12 xx Title text"[8:-1]
    assert r.medical_complication_flag == ""      # '"a'[1:-1]
    assert r.surgical_complication_flag == ""     # ''[1:-1]
    assert r.dob == dt.datetime(1980, 5, 17)
    assert r.admit_date == dt.datetime(2020, 5, 17, 8, 30)


@pytest.mark.parametrize("born,admit,age", [
    ("2000/2/29 0:0:0", "2020/2/28 0:0:0", 19),   # day before the birthday
    ("2000/2/29 0:0:0", "2020/2/29 0:0:0", 20),   # on the birthday
    ("2000/2/29 0:0:0", "2021/2/28 0:0:0", 20),   # no 29th: birthday not reached yet
    ("2000/2/29 0:0:0", "2021/3/1 0:0:0", 21),
    ("1990/12/31 23:59:59", "1991/1/1 0:0:0", 0),
    ("1990/01/05 03:04:05", "2000/01/04 00:00:00", 9),  # two-digit fields also parse
])
def test_age_in_completed_years(spark, tmp_path, born, admit, age):
    r = parse(spark, tmp_path, HEAD + [line({10: f'"{born}" ', 25: f'"{admit}" '})]).collect()[0]
    assert r.age == age


def test_quarantine_reasons(spark, tmp_path):
    lines = HEAD + [
        line(),
        line({4: ""}),                       # blank id
        line({25: '"junk" '}),               # bad date
        line({80: ""}),                      # blank amount
        "a;b;c",                               # short line
        line({1: '"Bos;ton"'}),              # ';' inside quotes is still a separator
    ]
    df = parse(spark, tmp_path, lines)
    got = {r.reject_reason for r in df.collect()}
    assert got == {None, "bad_id", "bad_date", "bad_number", "short_line"}
    clean, rejects = R.split_rejects(df)
    assert clean.count() == 1
    assert "reject_reason" not in clean.columns
    # the shifted line puts a quoted name at the id position: caught as bad_id
    assert sorted(r.reject_reason for r in rejects.collect()) == [
        "bad_date", "bad_id", "bad_id", "bad_number", "short_line"]


def test_quoted_separator_shifts_fields(spark, tmp_path):
    r = parse(spark, tmp_path, HEAD + [line({1: '"Bos;ton"'})]).collect()[0]
    assert r.hospital_city == "Bos"            # no quote handling, as in the reference


def test_strict_mode_raises(spark, tmp_path):
    with pytest.raises(PySparkException):
        parse(spark, tmp_path, HEAD + [line({80: ""})], mode=C.STRICT).collect()
    with pytest.raises(PySparkException):
        parse(spark, tmp_path, HEAD + ["a;b;c"], mode=C.STRICT).collect()
    ok = parse(spark, tmp_path, HEAD + [line()], mode=C.STRICT)
    assert "reject_reason" not in ok.columns and ok.count() == 1


def test_demographics_and_billing_share_one_parse(spark, tmp_path):
    parsed = parse(spark, tmp_path, HEAD + [line({75: "10.5", 88: "2"})])
    demo, bill = R.demographics(parsed), R.billing(parsed)
    assert demo.columns[:5] == ["record_id", "hospital_city", "campus_name", "dob", "age"]
    b = bill.collect()[0]
    assert (b.record_id, b.billed_charges, b.adj_supply_charges) == (7, 10.5, 2.0)
    assert len(bill.columns) == 17  # 16 billing columns + reject_reason


def test_pharmacy_json(spark, tmp_path):
    recs = [{"Discharge ID": "5.0", "Drug Class Title": "A", "Therapeutic Category Title": "B",
             "Generic Drug Title": "C", "Adj Pharmacy Charges": 1.5, "Pharmacy Charges": 2.5,
             "Date Of Service": "2019-03-04 05:06:07", "Day Of Service": "Mon", "Drug Class": "x",
             "Generic Drug": "y", "Route Of Administration": "z",
             "Route Of Administration Title": "w", "Therapeutic Category": "v"},
            {"Discharge ID": "6", "Date Of Service": "not a date"}]
    path = write_text(str(tmp_path / "ph" / "pharmacy.csv"), [json.dumps(r) for r in recs])
    df = R.pharmacy(S.read_json_records(spark, path, R.PHARMACY_SCHEMA))
    assert df.columns == ["record_id", "drug_class", "therapeutic_category", "generic_drug",
                          "adj_pharmacy_charges", "pharmacy_charges", "date_of_service"]
    rows = sorted(df.collect(), key=lambda r: r.record_id)
    assert rows[0].record_id == 5 and rows[0].date_of_service == dt.datetime(2019, 3, 4, 5, 6, 7)
    assert rows[1].record_id == 6 and rows[1].date_of_service is None


def test_python_slice_semantics(spark):
    words = ["", "a", "ab", "abc", "abcd", "abcdefghij"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    cases = [(1, -1), (1, -2), (1, 4), (8, -1), (0, 1), (3, None), (10, None)]
    cols = [C.py_slice(F.col("s"), a, b).alias(f"c{i}") for i, (a, b) in enumerate(cases)]
    for r in df.select("s", *cols).collect():
        for i, (a, b) in enumerate(cases):
            assert r[f"c{i}"] == r.s[a:b], (r.s, a, b)


def test_strip_and_remove(spark):
    df = spark.createDataFrame([("''x'y''",), ('"a?"',)], "s string")
    r = df.select(C.strip_chars("s", "'").alias("a"), C.remove_chars("s", '"?').alias("b")).collect()
    assert r[0].a == "x'y" and r[1].b == "a"


def test_datetime_parse_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2019/3/10 2:30:0",), ("2019/2/30 0:0:0",), ("2019/3/10 2:30:0x",)], "s string")
        got = [r.t for r in df.select(C.parse_datetime("s").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2019, 3, 10, 2, 30), None, None]   # DST gap kept; Feb 30 and junk rejected


def _birthdays_passed(born: dt.datetime, at: dt.datetime) -> int:
    """Birthdays from the first one to the day of ``at``, counted one by one; in
    common years someone born on 29 February has theirs on 1 March."""
    def birthday(year: int) -> dt.date:
        try:
            return dt.date(year, born.month, born.day)
        except ValueError:
            return dt.date(year, 3, 1)

    passed = 0
    while birthday(born.year + passed + 1) <= at.date():
        passed += 1
    return passed


def test_age_matches_python_and_is_monotone(spark):
    """C11 over many random (birth, admission) pairs in one job: equal to the
    Python formula, and never smaller for a later admission."""
    import random
    rnd = random.Random(7)
    base = dt.datetime(1900, 1, 1)
    rows = []
    for i in range(3000):
        born = base + dt.timedelta(days=rnd.randrange(0, 40000), seconds=rnd.randrange(86400))
        at = born + dt.timedelta(days=rnd.randrange(0, 40000), seconds=rnd.randrange(86400))
        rows.append((i, born, at, at + dt.timedelta(days=rnd.randrange(0, 800))))
    df = spark.createDataFrame(rows, "i int, born timestamp_ntz, at timestamp_ntz, later timestamp_ntz")
    got = df.select("i", C.completed_years("born", "at").alias("a"),
                    C.completed_years("born", "later").alias("b")).collect()
    by_id = {r.i: r for r in got}
    for i, born, at, later in rows:
        assert by_id[i].a == _birthdays_passed(born, at), (born, at)
        assert by_id[i].b >= by_id[i].a


def test_datetime_parse_matches_strptime(spark):
    """The record layout parsed as Python's strptime('%Y/%m/%d %H:%M:%S') does:
    one- or two-digit fields, calendar checks, no second 60, no hour 24."""
    vals = ["2020/1/2 3:4:5", "2020/01/02 03:04:05", "2000/2/29 0:0:0", "2001/2/29 0:0:0",
            "2020/13/1 0:0:0", "2020/1/1 24:0:0", "2020/1/1 23:59:60", "2020/1/1 23:60:0",
            "2020/3/8 2:30:0", "2020/1/1", "x", "", " 2020/1/1 1:1:1", "2020/1/1 1:1:1 ",
            "99999/1/1 1:1:1", "2020-1-1 1:1:1", "1/1/2020 1:1:1", "2020/001/1 1:1:1", "0001/1/1 0:0:0"]

    def py(v):
        try:
            return dt.datetime.strptime(v, "%Y/%m/%d %H:%M:%S")
        except ValueError:
            return None

    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = {r.s: r.t for r in df.select("s", C.parse_datetime("s").alias("t")).collect()}
    assert got == {v: py(v) for v in vals}
