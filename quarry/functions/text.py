"""String helpers shared by all native (Catalyst-only) expressions."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's notion of whitespace (what str.strip() removes), built by rule so
# that btrim in Spark and trim in SQL strip exactly what Python strips.
PY_WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def strip(col: Column) -> Column:
    """``str.strip()``: remove Python whitespace at both ends."""
    return F.btrim(col, F.lit(PY_WHITESPACE))


def is_blank(col: Column) -> Column:
    """True when null or only whitespace (``not s or not s.strip()``)."""
    return F.coalesce(strip(col) == F.lit(""), F.lit(True))


def not_blank(col: Column) -> Column:
    return ~is_blank(col)


def sql_whitespace_literal() -> str:
    """The same whitespace set as a DuckDB expression (chr() concatenation)."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body``.

    Catalyst copies a sub-expression every time a Column is reused, and it
    shares nothing inside lambda functions, so an expensive intermediate used
    several times would be evaluated several times per row (and can grow the
    generated code past the JVM method limit).  Binding it to a lambda
    variable evaluates it exactly once."""
    return F.element_at(F.transform(F.array(value), body), 1)


class Runs:
    """Maximal runs of the characters of a class (that of one character in the
    syntax of ``regex``, no white space), many texts at once.  A character is
    looked up in a table, which the pattern fills as characters are met."""

    def __init__(self, chars: str):
        import regex

        self.match = regex.compile(chars).fullmatch
        self.known = np.zeros(0x110000, np.int8)  # 0: not met yet, 1: in the class, 2: not

    def of(self, texts: list[str]) -> list[list[str]]:
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.known[codes]
        if not kind.all():
            for c in np.unique(codes[kind == 0]).tolist():
                self.known[c] = 1 if self.match(chr(c)) else 2
            kind = self.known[codes]
        spaced = np.where(kind == 1, codes, np.uint32(32)).tobytes().decode("utf-32-le", "surrogatepass")
        out, at = [], 0
        for t in texts:
            out.append(spaced[at:at + len(t)].split())
            at += len(t)
        return out


@cache
def runs_of(chars: str) -> Runs:
    return Runs(chars)
