"""Exact BPE encoding by dynamic programming over the prefixes of a word.

For every prefix of a word, BPE's encoding of the prefix ends in one unique
token.  A vocabulary token that is a suffix of the prefix is that token exactly
if BPE would leave it whole next to the last token of the remaining, shorter
prefix.  So one automaton pass finds all suffix matches, each match needs one
compatibility test of two tokens, the winner is stored per prefix, and
back-pointers give the ids.

A word's last symbol carries the end-of-word mark; here the mark is an extra
character after the word, and only whole tokens ever contain it.

Every task keeps its own automaton, the outcome of pair tests and the encoded
pieces it has met, each in tables of a fixed size: when the young one is full it
becomes the old one, so frequent pieces stay and rare ones go.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import lists, map_arrow
from .columns import passes_columns

END = "Ā"                 # stands for the end-of-word suffix; bytes are U+0000 to U+00FF
NEVER = 1 << 60
PAIR_CACHE = 300_000           # outcomes kept, about 30 MB
PIECE_CACHE = 200_000          # pieces in the young and in the old table, about 70 MB each
PIECE_CHARS = 64               # longer pieces are encoded without being kept
SLICE = 1 << 20                # characters taken apart at once
_SPACE = r"\t\n\x0B\x0C\r \x85\xA0  -     　"
_GAPS = regex.compile(f"[{_SPACE}]+")
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, reversed:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class PrefixBpe:
    """Vocabulary, merge order and automaton of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()

        def plain(token: str) -> str:
            end = bool(suffix) and token.endswith(suffix)
            body = token[:-len(suffix)] if end else token
            return "".join(chr(letters[c]) for c in body) + (END if end else "")

        self.vocab = {plain(t): i for t, i in model["vocab"].items()}
        self.names = {i: t for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.names.update({i: t for t, i in self.added.items()})
        self.added_re = re.compile("|".join(sorted(map(re.escape, self.added), key=len, reverse=True))) \
            if self.added else None
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}   # token: left, right, rank of its merge
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            left, right = plain(left), plain(right)
            a, b, whole = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.rank.setdefault((a, b), r)
            self.parts.setdefault(whole, (a, b, r))
        self.automaton = ahocorasick.Automaton()
        for text, i in self.vocab.items():
            if text.rstrip(END):
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.young: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens on the left (0) or right (1) edge of ``token``, from its
        outermost letter to itself, each with the rank at which it is merged away."""
        known = self.edges.get((token, side))
        if known is None:
            known = [(token, NEVER)]
            while (p := self.parts.get(known[-1][0])) is not None:
                known.append((p[side], p[2]))
            known.reverse()
            self.edges[token, side] = known
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE keeps ``a`` and ``b`` whole when their texts stand next to each other.

        Goes along the right edge of ``a`` and the left edge of ``b`` in merge
        order: a merge over the border happens if its rank comes before both
        edges have moved on.  At equal rank the leftmost merge goes first."""
        right, left, rank = self._edge(a, 1), self._edge(b, 0), self.rank
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = right[i], left[j]
            r = rank.get((x, y))
            if r is not None and r < x_until and r <= y_until:
                return False
            if x_until <= y_until:
                if x_until == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def encode_word(self, word: bytes) -> list[int]:
        """Token ids of one pre-token, as UTF-8 bytes; an empty one has none."""
        if not word:
            return []
        text = word.decode("latin-1") + END
        whole = self.vocab.get(text)
        if whole is not None:
            return [whole]
        n = len(text)
        last = [-1] * (n + 1)             # the unique last token of every prefix
        back = [0] * (n + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIR_CACHE:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(before, token)
                if not fits:
                    continue
            last[end], back[end] = token, start
        ids, at = [], n
        while at > 0:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]

    def _piece(self, piece: str) -> tuple[str, str]:
        """Ids and decoded text of a piece that the young table does not hold."""
        out = self.old.get(piece)
        if out is None:
            ids = self.encode_word(piece.encode())
            out = (" ".join(map(str, ids)), " ".join(map(self.names.__getitem__, ids)))
        if len(piece) <= PIECE_CHARS:
            if len(self.young) >= PIECE_CACHE:
                self.young, self.old = {}, self.young
            self.young[piece] = out
        return out

    def _plain(self, text: str):
        """Parts of a text without added tokens: NFC, lower case letter by letter, pieces."""
        out, at = [], 0
        while at < len(text):
            to = len(text)
            if to - at > SLICE and (gap := _GAPS.search(text, at + SLICE)):  # no piece reaches over white space
                to = gap.end()
            part, at = text[at:to], to
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final sigma rule
            known, other = self.young.get, self._piece
            out += [known(p) or other(p) for p in _PIECES.findall(part.lower())]
        return out

    def parts_of(self, text: str) -> list[tuple[str, str]]:
        """``(ids as text, decoded text)`` of the pieces of a whole text, in order."""
        if self.added_re is None or not self.added_re.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.added_re.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append((str(self.added[m[0]]), m[0]))
            at = m.end()
        return out + self._plain(text[at:])

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(int, ids.split()) for ids, _ in self.parts_of(text)))

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by one space, special tokens included; an unknown id raises KeyError."""
        return " ".join(self.names[i] for i in ids)


_LOADED: dict[str, PrefixBpe] = {}


def _loaded(spec: str) -> PrefixBpe:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = PrefixBpe(spec)
    return _LOADED[key]


def _spec(spark: SparkSession, path: str):
    """The tokenizer file's text, broadcast (a fixed vocabulary: a few MB)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _run(docs: DataFrame, path: str, text_col: str, out: list[T.StructField], columns) -> DataFrame:
    """``docs`` with ``out`` appended; ``columns(model, texts)`` gives their Arrow arrays."""
    if clash := {f.name for f in out} & set(docs.columns):
        raise ValueError(f"columns are there already: {sorted(clash)}")
    spec = _spec(docs.sparkSession, path)
    n = len(docs.columns)
    rows = docs.withColumn("__text", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))

    def run(batches):
        model = _loaded(spec.value)
        for b in batches:
            made = columns(model, b.column(n).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), *made],
                                             names=[*b.schema.names[:n], *(f.name for f in out)])

    return map_arrow(rows, run, T.StructType([*docs.schema.fields, *out]))


def _ids_array(rows: list[str]) -> pa.Array:
    """A list column from the ids as text, row by row, without keeping Python numbers."""
    flat = [np.array(list(map(int, r.split())), np.int32) for r in rows]
    ends = np.cumsum([0] + [len(x) for x in flat])
    return lists(ends, np.concatenate([np.zeros(0, np.int32), *flat]), pa.int32())


_DIGESTS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType())]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@passes_columns
def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
           with_digests: bool = False) -> DataFrame:
    """``docs`` plus ``ids ARRAY<INT>``, as the tokenizers library encodes with
    ``add_special_tokens=False`` and without truncation or padding; with
    ``with_digests`` also the columns of ``digests``, from the same pass.

    Null and empty texts have no ids.  Rows are independent, so nulls, ties and
    repeated rows elsewhere change nothing; an empty table stays empty.  The
    texts of added tokens in a document are those tokens, as in the library.
    Columns that are there already raise."""
    out = [T.StructField(ids_col, T.ArrayType(T.IntegerType())), *(_DIGESTS if with_digests else [])]

    def columns(model, texts):
        ids, made = [], []
        for t in texts:
            parts = model.parts_of(t)
            ids.append(" ".join([p[0] for p in parts]))
            if with_digests:
                made.append((_sha256(ids[-1]), _sha256(" ".join([p[1] for p in parts]))))
        arrays = [_ids_array(ids)]
        if with_digests:
            arrays += [pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64()),
                       pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.string())]
        return arrays

    return _run(docs, path, text_col, out, columns)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` plus the decoded text of ``ids_col`` (special tokens kept; a null list is empty)."""
    spec = _spec(rows.sparkSession, path)
    at = rows.columns.index(ids_col)

    def run(batches):
        model = _loaded(spec.value)
        for b in batches:
            made = pa.array([model.decode(x or []) for x in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, out_col])

    return map_arrow(rows, run, T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())]))


@passes_columns
def digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space)
    and ``decoded_sha256``, without carrying the ids through Spark."""
    def columns(model, texts):
        n, a, b = [], [], []
        for t in texts:
            parts = model.parts_of(t)
            ids = " ".join([p[0] for p in parts])
            n.append(ids.count(" ") + 1 if ids else 0)
            a.append(_sha256(ids))
            b.append(_sha256(" ".join([p[1] for p in parts])))
        return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]

    return _run(docs, path, text_col, _DIGESTS, columns)
