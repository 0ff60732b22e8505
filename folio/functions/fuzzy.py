"""Similarity scores.

* ``lev_score`` - native: ``round(100 * (1 - lev / max_len))`` in integer
  arithmetic, computed by Spark's own ``levenshtein`` (codegen, no Python).
* ``ratio_score`` - the matching-blocks ratio (``functions.blocks``), equal
  strings 100, a NULL or empty side 0.  Arrow-batched pandas UDF.
* ``best_ratio`` - arg-max of that ratio over a row's line combinations, in
  one Arrow-batched pass that stops at the best score.
* ``nfkd`` - compatibility decomposition (``functions.normal_form``).
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks
from .normal_form import nfkd  # noqa: F401
from .text import col, let

# The UDFs below run in Python workers.  Pickle this module's functions by
# value so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table_cells(n: Column, m: Column, most: Column) -> Column:
    """Cells of the table of two strings of ``n`` and ``m`` characters, as far as ``most`` edits from its diagonal."""
    return F.least(n, m).cast("long") * F.least(F.greatest(n, m), 2 * most + 1)


def edits(a: Column, b: Column, most: Column | None = None, low: Column | None = None, room: Column | None = None) -> Column:
    """Levenshtein distance of two strings; -1, or more than ``most``, beyond it.  ``low`` is at most the distance.
    NULL where it takes a table of more than ``room`` cells.

    The strings are laid side by side, in time in proportion to their lengths.  The places that differ are no
    less than the distance: they are it where they meet ``low``, and else its threshold.  What is equal at the
    beginning goes, and at the end of strings of equal length, before the table of the rest is filled."""

    def of(same: Column) -> Column:
        apart = F.size(F.filter(same, lambda x: ~x))
        start = F.array_position(same, False).cast("int")
        end = F.when(F.length(a) == F.length(b), F.array_position(F.reverse(same), False).cast("int")).otherwise(1)
        rest = lambda s: F.substr(s, start, F.length(s) - start - end + 2)
        lev = F.call_function("levenshtein", rest(a), rest(b), apart if most is None else F.least(most, apart))
        if room is not None:
            lev = F.when(table_cells(F.length(rest(a)), F.length(rest(b)), apart) <= room, lev)
        settled = apart <= (F.lit(1) if low is None else F.greatest(low, F.lit(1)))  # the distance of one place or none is known
        return F.when(settled, apart).otherwise(lev)

    return let(F.zip_with(F.split(a, "", -1), F.split(b, "", -1), lambda x, y: x.eqNullSafe(y)), of)


def lev_score(a: Column | str, b: Column | str, room: int | None = None) -> Column:
    """The native score; NULL for strings whose table takes more than ``room`` cells."""
    a, b = col(a), col(b)
    m = F.greatest(F.length(a), F.length(b))
    lev = edits(a, b, room=None if room is None else F.lit(room))
    score = F.floor((F.lit(200) * (m - lev) + m) / (F.lit(2) * m)).cast("int")
    return F.when(a.isNull() | b.isNull(), F.lit(0)).when(m == 0, F.lit(100)).otherwise(score)


@F.pandas_udf(T.IntegerType())
def ratio_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([blocks.ratio(x, y) for x, y in zip(a, b)], dtype="int32")


BEST_TYPE = T.StructType([T.StructField("score", T.IntegerType()), T.StructField("ord", T.IntegerType()), T.StructField("text", T.StringType())])


def best_ratio(keyword: Column, lines: Column, sets: list[tuple[int, tuple[int, ...]]], min_lines: int) -> Column:
    """``struct<score, ord, text>`` of the best combination of ``lines`` (pairs of ord and line numbers); NULLs without one."""

    @F.pandas_udf(BEST_TYPE)
    def run(kw: pd.Series, ls: pd.Series) -> pd.DataFrame:
        rows = [blocks.best(k, None if l is None else list(l), sets, min_lines) or (None, None, None) for k, l in zip(kw, ls)]
        score, at, text = zip(*rows) if rows else ((), (), ())
        return pd.DataFrame({"score": pd.array(score, dtype="Int32"), "ord": pd.array(at, dtype="Int32"), "text": list(text)})

    return run(keyword, lines)
