"""String functions of the crosswalk and of the quality-control steps.

Every function takes and returns a ``Column``.  Regular expressions are
written so that Java (Spark) and RE2 (the DuckDB oracle) read them the same
way: ``\\z`` instead of ``$``, explicit character classes instead of ``\\s``,
and ``(?d)`` where a ``.`` must not stop at ``\\r``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# XPath's whitespace (normalize-space, tokenize's \s): space, tab, CR, LF.
XML_SPACE = "[ \\t\\r\\n]"
# Python's str.strip()/str.isspace() whitespace set, written out.
PY_SPACE = (
    "[\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
PY_SPACES = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Ordered replacement rules for extracted majors (pattern, replacement),
# applied one after the other, each to the result of the previous one.
MAJOR_REPLACEMENTS = [
    ("Agricultural and Biological Engineering", "Agricultural and Biosystems Engineering"),
    ("Industrial Engineering", "Industrial and Manufacturing Systems Engineering"),
    ("Materials Science & Engineering", "Materials Science and Engineering"),
    ("Molecular, Cellular, and Developmental Biology", "Molecular, Cellular and Developmental Biology"),
    ("Education Leadership", "Education"),
    ("Agriculture Engineering", "Agricultural and Biosystems Engineering"),
    ("Agricultural Engineering", "Agricultural and Biosystems Engineering"),
    ("Materials Science", "Materials Science and Engineering"),
    ("Electrical and Computer Engineering", "Computer Engineering"),
    ("Nutritional Science", "Nutritional Sciences"),
]
# Character repairs applied to report text: (character, replacement).
CHAR_REPAIRS = [
    ("\u201c", '"'),
    ("\u201d", '"'),
    ("\u2019", "'"),
    ("\u2018", "'"),
    ("\u2212", "-"),
    ("\u03b2", "b"),
    ("\u2013", "-"),
    ("\u03b3", "(&#947)"),
    ("\u0301", "'"),
    ("\u0306", "g"),
    ("\u0131", "i"),
]
# Labels that introduce the major on a title page.
MAJOR_LABELS = ["Major:", "majors:", "Co-Majors:"]
# Paragraph markup rewrite used by the abstract field (from, to).
ABSTRACT_MARKUP = [
    ("<bold>", "<strong>"),
    ("</bold>", "</strong>"),
    ("<italic>", "<em>"),
    ("</italic>", "</em>"),
    ("<super>", "<sup>"),
    ("</super>", "</sup>"),
    ("<underline>", " "),
    ("</underline>", " "),
]
# ---------------------------------------------------------------------------


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A one-element ``transform``: an expression that a rule chain or a lambda
    refers to many times would otherwise be evaluated once per reference
    (higher-order functions are interpreted, outside common-subexpression
    elimination)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normalize_space(c: Column | str) -> Column:
    """XPath normalize-space: collapse XML whitespace runs, trim the ends."""
    return F.trim(F.regexp_replace(col(c), XML_SPACE + "+", " "))


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()`` (all of Python's whitespace)."""
    return F.trim(col(c), F.lit(PY_SPACES))


def title_case(c: Column | str) -> Column:
    """Split at ``~`` or blank, upper-case the first letter of each token and
    lower-case the rest, join with one blank (the stylesheet's title-case)."""
    return F.array_join(
        F.transform(
            F.split(col(c), "[~ ]"),
            lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2)))),
        ),
        " ",
    )


def hyphen_title_case(c: Column | str, normalize_first: bool = True) -> Column:
    """Title-case that also capitalises after a hyphen: protect ``-`` as
    ``-~``, title-case, then glue ``- `` back to ``-``."""
    s = F.replace(col(c), F.lit("-"), F.lit("-~"))
    if normalize_first:
        s = normalize_space(s)
    return F.replace(title_case(s), F.lit("- "), F.lit("-"))


def strip_tags(c: Column | str) -> Column:
    """Cut every ``<...>``; an unclosed ``<`` drops the rest of the text."""
    return F.regexp_replace(col(c), "<[^>]*(>|\\z)", "")


def contains_any_lower_vowel(c: Column | str) -> Column:
    return col(c).rlike("[aeiou]")


def title_field(c: Column | str, compat: bool = False) -> Column:
    """The target ``title``.

    Titles with a lower-case vowel are whitespace-normalised.  All-capital
    titles are title-cased (after cutting tags, with the hyphen rule); with
    ``compat=True`` the raw title is kept in front of the title-cased one,
    exactly as the original stylesheet emits it."""
    raw = F.coalesce(col(c), F.lit(""))
    cased = normalize_space(
        F.replace(title_case(strip_tags(F.replace(raw, F.lit("-"), F.lit("-~")))), F.lit("- "), F.lit("-"))
    )
    upper_branch = F.concat(raw, cased) if compat else cased
    return F.when(contains_any_lower_vowel(raw), normalize_space(raw)).otherwise(upper_branch)


def split_keywords(c: Column | str) -> Column:
    """``;`` becomes ``,``; split at a comma followed by at least one XML
    blank.  Empty input gives an empty array (no keyword)."""
    s = col(c)
    parts = F.split(F.translate(s, ";", ","), "," + XML_SPACE + "+")
    return F.when(s.isNull() | (s == ""), F.array().cast("array<string>")).otherwise(parts)


def rewrite_markup(c: Column | str, pairs=ABSTRACT_MARKUP) -> Column:
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, col(c))


def abstract_paragraphs(paras: Column | str, pairs=ABSTRACT_MARKUP, skip: str = "Abstract") -> Column:
    """Drop paragraphs that are exactly ``skip``; rewrite markup; normalise
    whitespace; end each paragraph with one blank."""
    return F.transform(
        F.filter(col(paras), lambda p: p != F.lit(skip)),
        lambda p: F.concat(normalize_space(rewrite_markup(p, pairs)), F.lit(" ")),
    )


def doc_type(c: Column | str) -> Column:
    """Starts with D (any case) -> dissertation, M -> thesis, else itself."""
    t = F.coalesce(col(c), F.lit(""))
    u = F.upper(t)
    return F.when(u.startswith("D"), "dissertation").when(u.startswith("M"), "thesis").otherwise(t)


def repair_chars(c: Column | str, repairs=CHAR_REPAIRS) -> Column:
    """Character repairs: the one-to-one pairs by one ``translate``, the
    rest by ``replace``."""
    one = [(a, b) for a, b in repairs if len(b) == 1]
    many = [(a, b) for a, b in repairs if len(b) != 1]
    s = F.translate(col(c), "".join(a for a, _ in one), "".join(b for _, b in one))
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), many, s)


def clean_text(c: Column | str) -> Column:
    """Remove tabs, one pass of double line break -> single, strip."""
    s = F.replace(F.replace(col(c), F.lit("\t"), F.lit("")), F.lit("\n\n"), F.lit("\n"))
    return py_strip(s)


def text_lines(c: Column | str) -> Column:
    """Cleaned text split at line breaks, each line stripped.  Empty text has
    no lines."""

    def lines(cleaned: Column) -> Column:
        found = F.transform(F.split(cleaned, "\n"), lambda l: py_strip(F.replace(l, F.lit("\t"), F.lit(" "))))
        return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(found)

    return let(clean_text(c), lines)


def _label_pattern(labels=MAJOR_LABELS) -> str:
    import re

    return "(?:" + "|".join(re.escape(x).replace("\\:", ":") for x in labels) + ")(.*)\\z"


def replace_chain(c: Column | str, rules=MAJOR_REPLACEMENTS, compat: bool = True) -> Column:
    """Ordered replacement rules.

    ``compat=True``: every rule is a regex applied to the result of the
    previous one (later rules may re-match earlier output).  ``compat=False``:
    a rule applies only when it matches the whole value, and only the first
    such rule applies."""
    s = col(c)
    if compat:
        return reduce(lambda acc, r: F.regexp_replace(acc, r[0], r[1].replace("\\", "\\\\").replace("$", "\\$")), rules, s)

    def first_whole_match(v: Column) -> Column:
        out = None
        for pat, rep in rules:
            cond = v.rlike("^(?:" + pat + ")\\z")
            out = F.when(cond, F.lit(rep)) if out is None else out.when(cond, F.lit(rep))
        return out.otherwise(v)

    return let(s, first_whole_match)


def find_major(text: Column | str, labels=MAJOR_LABELS, compat: bool = False, default: str = "None") -> Column:
    """Major named on a labelled line of the cleaned text.

    The text after the first label on the line, stripped, with everything
    from the first ``(`` to the last ``)`` cut, then the replacement chain.
    The whole-value rules see the value without the blank that the cut
    leaves; the cascade (``compat=True``) keeps it, as the original does.
    The last labelled line wins; no labelled line gives ``default``."""
    pat = _label_pattern(labels)
    lines = F.split(clean_text(text), "\n")
    # the last labelled line, or NULL (an empty label still gives a line)
    last = F.try_element_at(F.filter(lines, lambda l: reduce(lambda x, y: x | y, [l.contains(x) for x in labels])), F.lit(-1))

    def value_of(line: Column) -> Column:
        v = py_strip(F.regexp_extract(line, "(?d)" + pat, 1))
        v = F.regexp_replace(v, "(?d)\\(.*\\)", "")
        if not compat:
            v = py_strip(v)
        return F.when(line.isNotNull(), replace_chain(v, compat=compat)).otherwise(F.lit(default))

    return let(last, value_of)


def split_pair(c: Column | str, sep: str = ";") -> tuple[Column, Column]:
    """First and second part of a double value, each stripped; NULL when the
    value has no separator."""
    parts = F.split(col(c), sep, -1)
    has = F.size(parts) >= 2
    first = F.when(has, py_strip(F.get(parts, 0)))
    second = F.when(has, py_strip(F.get(parts, 1)))
    return first, second


def match_key(c: Column | str) -> Column:
    """Key used for authority matching: drop Latin-1 supplement characters,
    every non-word character becomes a blank, lower-case, trim."""
    s = F.regexp_replace(col(c), "[\\x{80}-\\x{FF}]", "")
    s = F.regexp_replace(s, "(?U)\\W", " ")
    return F.trim(F.lower(s))


def ascii_folded(c: Column | str) -> Column:
    """Every character outside ASCII as ``x``: lengths stay whole."""
    return F.regexp_replace(col(c), "[^\\x{00}-\\x{7F}]", "x")


def basename(c: Column | str) -> Column:
    return F.regexp_extract(col(c), "[^/\\\\]+\\z", 0)


def record_key_from_path(c: Column | str, suffix: str = "_DATA-out", cur_ext: str = ".xml", new_ext: str = ".pdf") -> Column:
    """Document file name belonging to a transformed record file: drop the
    suffix, swap the extension (every occurrence, as a plain replace)."""
    b = F.replace(col(c), F.lit(suffix), F.lit(""))
    b = F.replace(b, F.lit(cur_ext), F.lit(new_ext))
    return basename(b)


def stem(c: Column | str) -> Column:
    """File name without folder and without the last extension."""
    return F.regexp_replace(basename(c), "\\.[^.]*\\z", "")


def record_key(c: Column | str) -> Column:
    """Key shared by all files of a record: the stem without the delivery
    suffix ``_DATA`` (source record) or ``_DATA-out`` (transformed record)."""
    return F.regexp_replace(stem(c), "_DATA(-out)?\\z", "")
