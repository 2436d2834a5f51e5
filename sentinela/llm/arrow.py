"""Small helpers for operators that run on Arrow batches inside tasks."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def _table(keep) -> bytes:
    return bytes(_LOWER.get(c, c if keep(c) else 0x20) for c in range(256))


#: A-Z lower-cased, every other byte as it is.
LOWER_TABLE = _table(lambda c: True)
#: A-Z lower-cased; bytes outside ``0-9a-z`` and UTF-8 sequences become a space,
#: so ``bytes.split()`` yields the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
WORD_TABLE = _table(lambda c: 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80)


def utf8(column: pa.Array) -> list[bytes]:
    """The column's strings as UTF-8 bytes; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def lists(offsets, values, kind) -> pa.Array:
    """A list column from row offsets and flat values, without Python lists."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


_SHIPPED: "weakref.WeakSet" = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per context, so tasks
    can import it wherever they run."""
    sc = spark.sparkContext
    if sc in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    z.write(whole, os.path.relpath(whole, os.path.dirname(package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` for functions that use this package's modules."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
