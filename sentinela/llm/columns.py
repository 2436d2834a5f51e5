"""Callers' columns that look like the operators' own."""

from __future__ import annotations

from functools import wraps


def passes_columns(operator):
    """For operators that return the columns of their first argument, a DataFrame, as they
    were (and perhaps more).  Names starting ``__`` are the operators' helpers: columns of
    the caller with such names go through under other names and get theirs back.  One that
    the operator itself returns raises ``ValueError``."""
    @wraps(operator)
    def run(docs, *args, **kwargs):
        hidden, taken = {}, set(docs.columns)
        for c in docs.columns:
            if c.startswith("__"):
                name = f"own{c}"
                while name in taken:
                    name = f"own_{name}"
                taken.add(name)
                hidden[c] = name
        if not hidden:
            return operator(docs, *args, **kwargs)
        out = operator(docs.withColumnsRenamed(hidden), *args, **kwargs)
        if clash := set(hidden) & set(out.columns):
            raise ValueError(f"columns are there already: {sorted(clash)}")
        return out.withColumnsRenamed({v: k for k, v in hidden.items()})
    return run
