"""Compatibility decomposition (NFKD) as a column expression.

Characters are replaced by their full decompositions, Hangul syllables by
arithmetic, and runs of combining marks are sorted by combining class, marks
of one class staying in order.  The tables are built from the character
database that comes with Python: single mappings are applied until none is
left.  ASCII strings pass untouched.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the Hangul rule: first syllable and jamo, counts of vowels and trailing consonants.
SYLLABLE, LEAD, VOWEL, TRAIL = 0xAC00, 0x1100, 0x1161, 0x11A7
SYLLABLES, LEADS, VOWELS, TRAILS = 11172, 19, 21, 28


def full_decomposition(c: str) -> str:
    """All mappings of a character, canonical and compatible, applied through."""
    mapping = unicodedata.decomposition(c).split()
    if not mapping:
        return c
    return "".join(full_decomposition(chr(int(x, 16))) for x in mapping if not x.startswith("<"))


@lru_cache(maxsize=1)
def tables() -> tuple[str, list[str], str, str, str]:
    """Characters with a decomposition, longest first, and the k-th characters of theirs;
    combining marks, their classes as characters, and a regex class of the marks."""
    every = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    whole = {c: d for c in every if (d := full_decomposition(c)) != c}
    keys = sorted(whole, key=lambda c: -len(whole[c]))
    places = ["".join(whole[c][k] for c in keys if len(whole[c]) > k) for k in range(len(whole[keys[0]]))]
    marks = [c for c in every if unicodedata.combining(c)]
    ranges: list[list[int]] = []
    for i in map(ord, marks):
        if ranges and ranges[-1][1] == i - 1:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    regex = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    return "".join(keys), places, "".join(marks), "".join(chr(CLASS_BASE + unicodedata.combining(c)) for c in marks), regex


CLASS_BASE = 0x100  # classes as characters from here on


def _characters(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)


def _decomposed(ch: Column) -> Column:
    keys, places, *_ = tables()
    listed = F.translate(ch, keys, "") == ""
    one = F.concat(*[F.translate(ch, keys, p) for p in places])
    index = F.ascii(ch) - SYLLABLE
    jamo = lambda first, n, i: F.substr(F.lit("".join(chr(first + k) for k in range(n))), i.cast("int") + 1, F.lit(1))
    tail = index % TRAILS
    syllable = F.concat(
        jamo(LEAD, LEADS, F.floor(index / (VOWELS * TRAILS))),
        jamo(VOWEL, VOWELS, F.floor(index % (VOWELS * TRAILS) / TRAILS)),
        F.when(tail > 0, jamo(TRAIL, TRAILS, tail)).otherwise(""),
    )
    return F.when(index.between(0, SYLLABLES - 1), syllable).when(listed, one).otherwise(ch)


def _sorted_run(run: Column) -> Column:
    _, _, marks, classes, _ = tables()
    held = F.transform(_characters(run), lambda ch, i: F.struct(F.ascii(F.translate(ch, marks, classes)).alias("class"), i.alias("i"), ch.alias("ch")))
    return F.array_join(F.transform(F.array_sort(held), lambda x: x["ch"]), "")


def nfkd(c: Column) -> Column:
    """The string's compatibility decomposition; NULL stays NULL."""
    *_, regex = tables()
    plain = F.array_join(F.transform(_characters(c), _decomposed), "")
    runs = F.regexp_extract_all(plain, F.lit(f"(?s)[{regex}]+|[^{regex}]+"), 0)
    ordered = F.array_join(F.transform(runs, lambda r: F.when(r.rlike(f"^[{regex}]{{2}}"), _sorted_run(r)).otherwise(r)), "")
    return F.when(c.rlike("[^\\x{00}-\\x{7F}]"), ordered).otherwise(c)
