"""DuckDB SQL equivalent to each catalogue query (the correctness oracle).

The SQL re-states each operator independently with DuckDB's own functions;
the helpers below only build expression text.
"""

from __future__ import annotations

from ..functions import text as T
from . import catalogue as C
from . import inputs as I


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PY_SPACE = T.PY_SPACE


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_SPACE}+|{PY_SPACE}+\\z', '', 'g')"


def normalize_space(x: str) -> str:
    return f"trim(regexp_replace({x}, '[ \\t\\r\\n]+', ' ', 'g'))"


def upper_full(x: str) -> str:
    """Upper case with the full Unicode mapping of sharp s (as Java/Spark)."""
    return f"upper(replace({x}, 'ß', 'ss'))"


def title_case(x: str) -> str:
    return f"array_to_string(list_transform(string_split_regex({x}, '[~ ]'), lambda t: {upper_full('substr(t, 1, 1)')} || lower(substr(t, 2))), ' ')"


def hyphen_title_case(x: str) -> str:
    return f"replace({title_case(normalize_space(f'replace({x}, {q(chr(45))}, {q(chr(45) + chr(126))})'))}, '- ', '-')"


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*(>|\\z)', '', 'g')"


def title_field(x: str, compat: bool = False) -> str:
    cased = normalize_space(f"replace({title_case(strip_tags(f'replace({x}, {q(chr(45))}, {q(chr(45) + chr(126))})'))}, '- ', '-')")
    upper_branch = f"({x} || {cased})" if compat else cased
    return f"CASE WHEN regexp_matches({x}, '[aeiou]') THEN {normalize_space(x)} ELSE {upper_branch} END"


def pad1(x: str) -> str:
    return f"CASE WHEN length({x}) = 1 THEN '0' || {x} ELSE {x} END"


def mdy(x: str) -> str:
    s = f"coalesce({x}, '')"
    m = f"regexp_extract({s}, '(?s)^([^/]*)/', 1)"
    d = f"regexp_extract({s}, '(?s)^[^/]*/([^/]*)/', 1)"
    y = f"regexp_extract({s}, '(?s)^[^/]*/[^/]*/(.*)\\z', 1)"
    return f"({y} || '-' || {pad1(m)} || '-' || {pad1(d)})"


def first_line(x: str) -> str:
    return f"string_split({x}, chr(10))[1]"


def clean_text(x: str) -> str:
    return py_strip(f"replace(replace({x}, chr(9), ''), chr(10) || chr(10), chr(10))")


def text_lines(x: str) -> str:
    c = clean_text(x)
    return f"CASE WHEN {c} = '' THEN []::VARCHAR[] ELSE list_transform(string_split({c}, chr(10)), lambda l: {py_strip('replace(l, chr(9), chr(32))')}) END"


def basename(x: str) -> str:
    return f"regexp_extract({x}, '[^/\\\\]+\\z', 0)"


def stem(x: str) -> str:
    return f"regexp_replace({basename(x)}, '\\.[^.]*\\z', '')"


def markup(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def case_map(x: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} ELSE {x} END"


def values_table(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


# -----------------------------------------------------------------------------------
PAGE_PATH = (
    "regexp_replace(url, '[?#].*\\z', '') || '.' || "
    + "(" + "[" + ", ".join(q(e) for e in I.FILE_EXTENSIONS) + f"])[(page_id % {len(I.FILE_EXTENSIONS)}) + 1]"
)


def _kind(path: str) -> str:
    ext = f"lower(regexp_extract({basename(path)}, '\\.([^.]*)\\z', 1))"
    return f"CASE {ext} WHEN 'xml' THEN 'xml' WHEN 'pdf' THEN 'pdf' ELSE 'media' END"


SQL: dict[str, str] = {}

SQL["file_manifest"] = f"""
WITH p AS (SELECT page_id, {PAGE_PATH} AS path FROM pages)
SELECT page_id, path, {basename('path')} AS name, {_kind('path')} AS kind, {stem('path')} AS record_key FROM p
"""

SQL["record_completeness"] = f"""
WITH p AS (SELECT page_id, {PAGE_PATH} AS path FROM pages),
m AS (SELECT {_kind('path')} AS kind, {stem('path')} AS record_key FROM p)
SELECT record_key, bool_or(kind = 'xml') AS has_xml, bool_or(kind = 'pdf') AS has_pdf,
       CAST(sum(CASE WHEN kind = 'media' THEN 1 ELSE 0 END) AS BIGINT) AS n_media
FROM m GROUP BY record_key
"""

_RK_PATH = "'/batch/XML-Transformed/' || source || '_' || CAST(doc_id AS VARCHAR) || '_DATA-out.xml'"
SQL["record_keys"] = f"""
WITH p AS (SELECT doc_id, {_RK_PATH} AS path FROM documents)
SELECT doc_id, {basename('path')} AS xml_name,
       {basename("replace(replace(path, '_DATA-out', ''), '.xml', '.pdf')")} AS pdf_name,
       {stem('path')} AS stem
FROM p
"""

_LINES = "(SELECT doc_id, lang, CAST(unnest(range(0, len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS ls FROM documents))"
_TITLE_SRC = "CASE WHEN lang IN ('fr', 'de') THEN upper(replace(line, 'ß', 'ss')) ELSE line END"
SQL["title_normalise"] = f"""
WITH t AS (SELECT doc_id, line_no, {_TITLE_SRC} AS s FROM {_LINES})
SELECT doc_id, line_no, {title_field('s')} AS title, {title_field('s', True)} AS title_compat FROM t
"""

SQL["title_case"] = f"""
WITH t AS (SELECT doc_id, line_no, {_TITLE_SRC} AS s FROM {_LINES})
SELECT doc_id, line_no, {title_case('s')} AS cased, {hyphen_title_case('s')} AS cased_hyphen FROM t
"""

SQL["strip_tags"] = f"SELECT page_id, {strip_tags('html')} AS stripped FROM pages"

_PARAS = "list_transform(list_filter(string_split(html, '<p>'), lambda x, i: i > 1), lambda x: regexp_extract(x, '(?s)^(.*?)(</p>|\\z)', 1))"
_ABS = f"list_transform(list_filter({_PARAS}, lambda p: p <> 'Abstract'), lambda p: {normalize_space(markup('p', C.PAGE_MARKUP))} || ' ')"
SQL["abstract_markup"] = f"""
WITH a AS (SELECT page_id, {_ABS} AS ps FROM pages)
SELECT page_id, CAST(unnest(range(0, len(ps))) AS INTEGER) AS pos, unnest(ps) AS p FROM a
"""

SQL["iso_date"] = f"""
WITH o AS (SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN strftime(o_orderdate, '%-m/%Y')
                                  WHEN '4-NOT SPECIFIED' THEN '' ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS d FROM orders)
SELECT o_orderkey, {mdy('d')} AS pub_date FROM o
"""

SQL["keyword_split"] = f"""
WITH k AS (SELECT doc_id, translate(text, '.', ';') AS s FROM documents),
a AS (SELECT doc_id, CASE WHEN s IS NULL OR s = '' THEN []::VARCHAR[]
                         ELSE string_split_regex(translate(s, ';', ','), ',[ \\t\\r\\n]+') END AS kw FROM k)
SELECT doc_id, CAST(unnest(range(0, len(kw))) AS INTEGER) AS pos, unnest(kw) AS keyword FROM a
"""

_SUBJ = values_table([(k, i, t) for k, ts in C.SUBJECT_RULES.items() for i, t in enumerate(ts)], ["key", "pos", "target"])
SQL["subject_crosswalk"] = f"""
WITH c AS (SELECT p_partkey, 0 AS cat_pos, p_type AS category FROM part
           UNION ALL SELECT p_partkey, 1 AS cat_pos, p_brand AS category FROM part)
SELECT p_partkey, CAST(cat_pos AS INTEGER) AS cat_pos, CAST(coalesce(t.pos, 0) AS INTEGER) AS tgt_pos,
       coalesce(t.target, c.category) AS discipline
FROM c LEFT JOIN {_SUBJ} ON c.category = t.key
"""

SQL["subject_crosswalk_array"] = f"""
WITH c AS (SELECT p_partkey, 0 AS cat_pos, p_type AS category FROM part
           UNION ALL SELECT p_partkey, 1 AS cat_pos, p_brand AS category FROM part),
m AS (SELECT p_partkey, cat_pos, coalesce(t.pos, 0) AS tgt_pos, coalesce(t.target, c.category) AS discipline
      FROM c LEFT JOIN {_SUBJ} ON c.category = t.key)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY cat_pos, tgt_pos) - 1 AS INTEGER) AS pos, discipline FROM m
"""


def _contains_case(x: str, rules) -> str:
    whens = " ".join(
        "WHEN " + " AND ".join(f"contains({x}, {q(p)})" for p in r.parts) + f" THEN {q(r.target)}" for r in rules
    )
    return f"CASE {whens} ELSE {x} END"


SQL["ordered_contains_rules"] = f"""
SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_contains_case('x', C.DEGREE_RULES)}), '') AS degree_name
FROM documents
"""

SQL["exact_map_with_escape"] = f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_mktsegment || ' & SERVICES' ELSE c_mktsegment END AS d FROM customer)
SELECT c_custkey, CASE WHEN contains(d, '&') THEN replace(d, '&', 'and') ELSE {case_map('d', C.DEPARTMENT_RULES)} END AS department FROM c
"""

SQL["doc_type"] = """
WITH o AS (SELECT o_orderkey, lower(substr(o_orderpriority, 3)) AS t FROM orders)
SELECT o_orderkey, CASE WHEN starts_with(upper(t), 'D') THEN 'dissertation' WHEN starts_with(upper(t), 'M') THEN 'thesis' ELSE t END AS document_type FROM o
"""

SQL["embargo_date"] = f"""
WITH s AS (
  SELECT event_id,
    CASE event_type WHEN 'view' THEN '0' WHEN 'error' THEN '' ELSE '1' END AS acc,
    CASE WHEN value > 10 THEN [{{'_VALUE': CASE WHEN user_id % 2 = 0 THEN '1' ELSE '0' END, '_code': '1', '_remove': strftime(ts, '%-m/%-d/%Y')}}]
         ELSE [] END AS rs,
    CASE WHEN value < 5 THEN '' WHEN event_type = 'click' THEN 'No, 6 month delayed release'
         WHEN event_type = 'purchase' THEN 'No, 1 year delayed release' WHEN event_type = 'signup' THEN 'No, 2 year delayed release'
         ELSE '' END AS opt,
    CASE WHEN value > 18 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS dec,
    CASE WHEN value < 2.5 THEN '' ELSE strftime(ts + INTERVAL 90 DAY, '%Y-%m-%dT%H:%M') END AS rel
  FROM events),
t AS (
  SELECT *, CASE opt WHEN 'No, 6 month delayed release' THEN 180 WHEN 'No, 1 year delayed release' THEN 365
                     WHEN 'No, 2 year delayed release' THEN 730 END AS days,
         try_strptime(substr(dec, 1, 10) || 'T' || substr(dec, 12, 19), '%Y-%m-%dT%H:%M:%S') AS dts,
         try_strptime(substr(rel, 1, 10), '%Y-%m-%d') AS rdate
  FROM s)
SELECT event_id,
  CASE WHEN acc = '0' THEN
         CASE WHEN len(list_filter(rs, lambda r: r._code IS NOT NULL AND coalesce(r._VALUE, '') <> '0')) > 0
              THEN {mdy("rs[1]._remove")} ELSE '2001-01-01' END
       WHEN acc = '1' THEN
         CASE WHEN opt <> '' THEN CASE WHEN days IS NOT NULL AND dec <> '' THEN strftime(CAST(dts AS DATE) + days, '%Y-%m-%d') ELSE '2001-01-01' END
              WHEN rel <> '' THEN strftime(rdate, '%Y-%m-%d')
              ELSE '2001-01-01' END
       ELSE '2001-01-01' END AS embargo_date,
  CASE WHEN acc = '1' AND opt <> '' AND days IS NOT NULL AND dec <> '' AND dts IS NULL THEN 'bad decision date'
       WHEN acc = '1' AND opt = '' AND rel <> '' AND rdate IS NULL THEN 'bad delayed release date' END AS embargo_error
FROM t
"""


# -- authors, names, advisors ----------------------------------------------------------
def _w(line: str, i: int) -> str:
    return f"string_split({line}, ' ')[{i + 1}]"


def _rest(line: str, i: int) -> str:
    return f"coalesce(array_to_string(string_split({line}, ' ')[{i + 1}:], ' '), '')"


_CONV_AUTHORS = f"""
SELECT conv_id, turn, CAST(a.pos - 1 AS INTEGER) AS author_pos, a.line AS line, role
FROM (SELECT conv_id, turn, role, unnest(list_transform(string_split(text, chr(10)), lambda l, i: {{'pos': i, 'line': l}})) AS a FROM conversations)
"""

SQL["contact_filter"] = f"""
WITH a AS ({_CONV_AUTHORS}),
c AS (SELECT conv_id, turn, author_pos,
        [{{'t': CASE WHEN role = 'user' THEN 'current' ELSE 'future' END, 'e': lower({_w('line', 0)}) || '@example.org'}},
         {{'t': 'current', 'e': lower({_w('line', 1)}) || '@example.org'}}] AS contacts FROM a)
SELECT conv_id, turn, author_pos,
       array_to_string(list_transform(list_filter(contacts, lambda c: c.t = 'current' AND c.e IS NOT NULL), lambda c: c.e), ' ') AS email
FROM c
"""

SQL["author_array"] = f"""
WITH a AS ({_CONV_AUTHORS})
SELECT conv_id, turn, author_pos,
       {hyphen_title_case(f"coalesce({_w('line', 0)}, '')")} AS lname,
       {hyphen_title_case(f"coalesce({_w('line', 1)}, '')")} AS fname,
       {hyphen_title_case(_rest('line', 2))} AS mname,
       {title_case("''")} AS suffix
FROM a
"""

_PART_PERSON = f"SELECT p_partkey, {_w('p_name', 0)} AS f, CASE WHEN p_size > 25 THEN p_brand WHEN p_size > 10 THEN '' END AS m, {_w('p_name', 1)} AS l FROM part"


def _full_name(f: str, m: str, l: str) -> str:
    return f"concat_ws(' ', nullif({f}, ''), nullif({m}, ''), nullif({l}, ''))"


SQL["person_names"] = f"""
WITH p AS ({_PART_PERSON}) SELECT p_partkey, {_full_name('f', 'm', 'l')} AS full_name FROM p
"""

SQL["rights_holder"] = f"""
WITH p AS ({_PART_PERSON})
SELECT p_partkey, concat_ws(' ', f, CASE WHEN m = '' THEN l END) || concat_ws(' ', m, l) || concat_ws(' ', l, f) || '' AS rights_holder_compat,
       {_full_name(hyphen_title_case("coalesce(f, '')"), hyphen_title_case("coalesce(m, '')"), hyphen_title_case("coalesce(l, '')"))} AS rights_holder
FROM p
"""


def _advisor(lines: str, i: int) -> str:
    line = f"{lines}[{i + 1}]"
    f = f"coalesce({_w(line, 0)}, '')"
    m = f"coalesce(CASE WHEN role = 'assistant' THEN {_w(line, 1)} ELSE '' END, '')"
    l = _rest(line, 2)
    disp = f"CASE WHEN {m} = '' THEN {f} || ' ' || {l} ELSE {f} || ' ' || substr({m}, 1, 1) || '. ' || {l} END"
    return f"CASE WHEN len({lines}) > {i} THEN {disp} END"


SQL["advisor_slots"] = f"""
WITH c AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS ls FROM conversations)
SELECT conv_id, turn, {_advisor('ls', 0)} AS advisor1, {_advisor('ls', 1)} AS advisor2, {_advisor('ls', 2)} AS advisor3 FROM c
"""

# -- field list edits ------------------------------------------------------------------
_FIELDS_LONG = """
SELECT event_id, event_type, user_id, unnest(json_keys(props)) AS name, props FROM events
"""

SQL["field_lookup"] = """
SELECT event_id,
       coalesce(json_extract_string(props, '$.k'), '') AS k_value,
       CASE WHEN event_type = 'purchase' THEN 'Existing' ELSE '' END AS major_value,
       json_extract_string(props, '$.k') IS NOT NULL AS has_k,
       event_type = 'purchase' AS has_major
FROM events
"""

SQL["upsert_field"] = f"""
WITH f AS ({_FIELDS_LONG})
SELECT event_id, name, 0 AS pos, json_extract_string(props, '$.' || name) AS value FROM f
UNION ALL
SELECT event_id, 'major' AS name, 0 AS pos, CASE WHEN event_type = 'purchase' THEN 'Existing' ELSE event_type END AS value FROM events
"""

SQL["set_field"] = f"""
WITH f AS ({_FIELDS_LONG})
SELECT event_id, name, 0 AS pos, CASE WHEN name = 'k' THEN CAST(user_id AS VARCHAR) ELSE json_extract_string(props, '$.' || name) END AS value FROM f
UNION ALL
SELECT event_id, 'major' AS name, 0 AS pos, 'Updated' AS value FROM events WHERE event_type = 'purchase'
"""

# -- document text ------------------------------------------------------------------------
SQL["clean_lines"] = f"""
WITH l AS (SELECT doc_id, {text_lines('text')} AS ls FROM documents)
SELECT doc_id, CAST(unnest(range(0, len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line FROM l
"""

_LABEL_PAT = "(?:Major:|majors:|Co\\-Majors:)(.*)\\z"


def _replace_chain_sql(x: str, compat: bool = True) -> str:
    if compat:
        for pat, rep in T.MAJOR_REPLACEMENTS:
            x = f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"
        return x
    whens = " ".join(f"WHEN regexp_full_match({x}, {q(pat)}) THEN {q(rep)}" for pat, rep in T.MAJOR_REPLACEMENTS)
    return f"CASE {whens} ELSE {x} END"


def _find_major(t: str, compat: bool) -> str:
    hits = f"list_filter(string_split({clean_text(t)}, chr(10)), lambda l: regexp_matches(l, {q(_LABEL_PAT)}))"
    value = f"regexp_replace({py_strip(f'regexp_extract(({hits})[-1], {q(_LABEL_PAT)}, 1)')}, '\\(.*\\)', '', 'g')"
    value = value if compat else py_strip(value)
    return f"CASE WHEN len({hits}) > 0 THEN {_replace_chain_sql(value, compat)} ELSE 'None' END"


_LABELLED = f"""
SELECT doc_id, CASE WHEN lab IS NULL THEN text ELSE lab || 'Agronomy' || chr(10) || text || chr(10) || lab || val END AS text
FROM (SELECT doc_id, text,
        CASE lang WHEN 'en' THEN {q(I.LABEL_BY_LANG['en'])} WHEN 'fr' THEN {q(I.LABEL_BY_LANG['fr'])} WHEN 'es' THEN {q(I.LABEL_BY_LANG['es'])} END AS lab,
        CASE lang WHEN 'en' THEN 'Materials Science & Engineering' WHEN 'fr' THEN {first_line('text')} ELSE 'Nutritional Sciences; Agronomy' END
          || ' (' || source || ')' AS val
      FROM documents)
"""

SQL["label_extract"] = f"""
WITH d AS ({_LABELLED})
SELECT doc_id, {_find_major('text', True)} AS major, {_find_major('text', False)} AS major_fixed FROM d
"""

_MAJOR_OPTS = "[" + ", ".join(q(p) for p, _ in T.MAJOR_REPLACEMENTS) + ", 'Agronomy']"
SQL["replace_chain"] = f"""
WITH m AS (SELECT p_partkey, {_MAJOR_OPTS}[(p_partkey % {len(T.MAJOR_REPLACEMENTS) + 1}) + 1]
                  || CASE WHEN p_size > 25 THEN ' and ' || p_name ELSE '' END AS major FROM part)
SELECT p_partkey, major, {_replace_chain_sql('major')} AS replaced_compat, {_replace_chain_sql('major', False)} AS replaced_fixed FROM m
"""

_ONE = [(a, b) for a, b in T.CHAR_REPAIRS if len(b) == 1]
_MANY = [(a, b) for a, b in T.CHAR_REPAIRS if len(b) != 1]
_REPAIR = f"translate(translate(text, {q(I.CHAR_SOURCE)}, {q(I.CHAR_TARGET)}), {q(''.join(a for a, _ in _ONE))}, {q(''.join(b for _, b in _ONE))})"
for _a, _b in _MANY:
    _REPAIR = f"replace({_REPAIR}, {q(_a)}, {q(_b)})"
SQL["char_map"] = f"SELECT doc_id, {_REPAIR} AS repaired FROM documents"


# -- candidate lines and best match ------------------------------------------------------
from ..operators import matching as M  # noqa: E402


def _sets_values(indexed) -> str:
    rows = ", ".join(f"({o}, [{', '.join(str(i) for i in s)}])" for o, s in indexed)
    return f"(VALUES {rows}) AS s(ord, ix)"


# --- fixed values: the scored line combinations, in evaluation order ----------
LINE_SETS = [
    (0,), (1,), (2,), (3,), (0,1), (0,1,2), (1,2), (2,3), (1,2,3), (3,4), (0,2), (1,3), (4,), (5,), (6,), (7,), (8,),
    (9,), (10,), (4,5), (5,6), (6,7), (7,8), (8,9), (9,10), (11,), (12,), (13,), (14,), (15,), (11,), (12,), (13,),
    (14,), (15,), (16,), (17,), (18,), (19,), (20,), (21,), (22,), (23,), (24,), (25,), (4,5), (5,6), (6,7), (7,8),
    (8,9), (9,10), (10,11), (11,12), (12,13), (13,14), (14,15), (15,16), (16,17), (17,18), (18,19), (19,20), (20,21),
    (21,22), (22,23), (23,24), (24,25), (25,26), (4,5,6), (5,6,7), (6,7,8), (7,8,9), (8,9,10), (9,10,11), (10,11,12),
    (11,12,13), (12,13,14), (13,14,15), (14,15,16), (15,16,17), (16,17,18), (17,18,19), (18,19,20), (19,20,21),
    (20,21,22), (21,22,23), (22,23,24), (23,24,25), (24,25,26), (25,26,27), (0,3), (1,0), (2,1), (3,2), (4,3),
]
# -------------------------------------------------------------------------------
_ALL_SETS = _sets_values(list(enumerate(LINE_SETS)))
_DISTINCT_SETS = _sets_values([(i, s) for i, s in enumerate(LINE_SETS) if s not in LINE_SETS[:i]])


def ascii_only(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x{{00}}-\\x{{7F}}]', 'x', 'g')"


def lev_score(a: str, b: str) -> str:
    m = f"greatest(length({a}), length({b}))"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0 WHEN {m} = 0 THEN 100 "
        f"ELSE CAST(floor((200 * ({m} - levenshtein({a}, {b})) + {m}) / (2 * {m})) AS INTEGER) END"
    )


def _candidates_sql(min_lines: int) -> str:
    return f"""
WITH d AS (SELECT doc_id, {text_lines('text')} AS lines FROM documents)
SELECT doc_id, CAST(s.ord AS INTEGER) AS ord, array_to_string(list_transform(s.ix, lambda j: lines[j + 1]), ' ') AS text
FROM d, {_ALL_SETS}
WHERE len(lines) >= {min_lines} AND list_max(s.ix) < len(lines)
"""


SQL["line_candidates"] = _candidates_sql(M.MIN_LINES)
SQL["line_candidates_short"] = _candidates_sql(4)


def _best_native_sql(min_lines: int, docs: str, kw: str = "kw") -> str:
    """``docs`` yields (doc_id, lines, kw); result (doc_id, score, ord, text)."""
    return f"""
WITH d AS ({docs}),
c AS (SELECT doc_id, s.ord AS ord, array_to_string(list_transform(s.ix, lambda j: lines[j + 1]), ' ') AS t, {kw} AS kw
      FROM d, {_DISTINCT_SETS} WHERE len(lines) >= {min_lines} AND list_max(s.ix) < len(lines)),
sc AS (SELECT doc_id, ord, t, {lev_score('kw', 't')} AS score FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ord) AS rn FROM sc)
SELECT d.doc_id, r.score, CAST(r.ord AS INTEGER) AS ord, {py_strip('r.t')} AS text
FROM d LEFT JOIN r ON d.doc_id = r.doc_id AND r.rn = 1
"""


_KW_DOCS = f"""
SELECT doc_id, lines, translate(lines[1], {q(I.VOWEL_SHIFT[0])}, {q(I.VOWEL_SHIFT[1])}) AS kw
FROM (SELECT doc_id, {text_lines(ascii_only('text'))} AS lines FROM documents)
"""
SQL["best_line_native"] = _best_native_sql(M.MIN_LINES, _KW_DOCS)
SQL["best_line_native_short"] = _best_native_sql(4, _KW_DOCS)


# -- authority reconciliation ------------------------------------------------------------
def match_key(x: str) -> str:
    return f"trim(lower(regexp_replace(regexp_replace({x}, '[\\x{{80}}-\\x{{FF}}]', '', 'g'), '\\W', ' ', 'g')))"


_AUTH_KEYS = f"""
SELECT akey, arg_min(aname, aord) AS aname, min(aord) AS aord FROM (
  SELECT {match_key('p_name')} AS akey, p_name AS aname, min(p_partkey) AS aord FROM part GROUP BY p_name)
WHERE akey <> '' GROUP BY akey
"""


def _reconcile_sql(values: str) -> str:
    return f"""
WITH k AS ({_AUTH_KEYS}),
v AS (SELECT p_partkey, major, string_split(major, ';') AS parts FROM ({values})),
w AS (SELECT p_partkey, major,
        CASE WHEN len(parts) >= 2 THEN {py_strip('parts[1]')} END AS f,
        CASE WHEN len(parts) >= 2 THEN {py_strip('parts[2]')} END AS s FROM v)
SELECT p_partkey, major,
  CASE WHEN k2.akey IS NOT NULL AND k3.akey IS NOT NULL THEN f || '; ' || s WHEN k1.akey IS NOT NULL THEN k1.aname END AS resolved,
  CASE WHEN k2.akey IS NOT NULL AND k3.akey IS NOT NULL THEN 'pair' WHEN k1.akey IS NOT NULL THEN 'exact' ELSE 'review' END AS status
FROM w LEFT JOIN k k1 ON {match_key('w.major')} = k1.akey
       LEFT JOIN k k2 ON {match_key('w.f')} = k2.akey
       LEFT JOIN k k3 ON {match_key('w.s')} = k3.akey
"""


SQL["authority_exact"] = _reconcile_sql(
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '-')
       WHEN 2 THEN p_name || 's' ELSE '  ' || p_name || '!' END AS major FROM part"""
)
SQL["authority_pair"] = _reconcile_sql(
    """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_name || '; ' || upper(p_name) WHEN 1 THEN p_name || ' ;' || p_type
       ELSE p_name || ';' || p_name || ';x' END AS major FROM part"""
)

def _matched(name: str, pairs: str) -> str:
    """CTEs of the matching blocks of pairs (a, b): ``{name}(a, b, i, j, k)``, starts from 0, and ``{name}_ratio(a, b, score)``."""
    enc = """list_max(flatten(list_transform(range(0, length(sa)), lambda i: list_transform(
        list_filter(range(1, least(length(sa) - i, length(sbm)) + 1), lambda k: instr(sbm, substr(sa, i + 1, k)) > 0), lambda k: k * 10000000 - i))))"""
    same = lambda x, y: f"coalesce(list_position(list_transform(range(1, least(length({x}), length({y})) + 1), lambda t: substr({x}, t, 1) <> substr({y}, t, 1)), TRUE) - 1, least(length({x}), length({y})))"
    found = lambda rows: f"""
        SELECT a, b, sa, sb, sbm, oi, oj, i0 - e1 AS i, j0 - e1 AS j, k0 + e1 + e2 AS k FROM (
          SELECT *, CASE WHEN sb = sbm THEN 0 ELSE {same('reverse(left(sa, i0))', 'reverse(left(sb, j0))')} END AS e1,
                 CASE WHEN sb = sbm THEN 0 ELSE {same('substr(sa, i0 + k0 + 1)', 'substr(sb, j0 + k0 + 1)')} END AS e2 FROM (
            SELECT *, CASE WHEN k0 = 0 THEN 0 ELSE instr(sbm, substr(sa, i0 + 1, k0)) - 1 END AS j0 FROM (
              SELECT *, coalesce(k0_ * 10000000 - enc, 0) AS i0, coalesce(k0_, 0) AS k0 FROM (
                SELECT *, (enc + 9999999) // 10000000 AS k0_ FROM (SELECT *, {enc} AS enc FROM ({rows}))))))"""  # noqa: E731
    return f"""
{name}_p AS (SELECT DISTINCT a, b FROM ({pairs}) WHERE a <> b AND a <> '' AND b <> ''),
{name}_often AS (SELECT b, string_agg(c, '') AS cs FROM (SELECT b, c, count(*) AS n FROM (SELECT b, unnest(string_split(b, '')) AS c FROM (SELECT DISTINCT b FROM {name}_p WHERE length(b) >= 200)) GROUP BY b, c)
                 WHERE n > length(b) // 100 + 1 GROUP BY b),
{name}_m AS (SELECT a, b, CASE WHEN cs IS NULL THEN b ELSE translate(b, cs, repeat(chr(1), length(cs))) END AS bm FROM {name}_p LEFT JOIN {name}_often USING (b)),
{name}_seg AS (
  {found(f"SELECT a, b, a AS sa, b AS sb, bm AS sbm, 0::BIGINT AS oi, 0::BIGINT AS oj FROM {name}_m")}
  UNION ALL
  {found(f"""SELECT a, b, s.sa AS sa, s.sb AS sb, s.sbm AS sbm, s.oi AS oi, s.oj AS oj FROM (
      SELECT a, b, unnest([{{'sa': left(sa, i), 'sb': left(sb, j), 'sbm': left(sbm, j), 'oi': oi, 'oj': oj}},
                           {{'sa': substr(sa, i + k + 1), 'sb': substr(sb, j + k + 1), 'sbm': substr(sbm, j + k + 1), 'oi': oi + i + k, 'oj': oj + j + k}}]) AS s
      FROM {name}_seg WHERE k > 0) WHERE s.sa <> '' AND s.sb <> ''""")}),
{name} AS (SELECT a, b, oi + i AS i, oj + j AS j, k FROM {name}_seg WHERE k > 0),
{name}_ratio AS (SELECT a, b, CAST(round_even(100 * (2.0::DOUBLE * coalesce(sum(k), 0) / (length(a) + length(b))), 0) AS INTEGER) AS score FROM {name}_p LEFT JOIN {name} USING (a, b) GROUP BY a, b)"""


def _ratio(a: str, b: str, found: str) -> str:
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0 WHEN {a} = {b} THEN 100 WHEN {a} = '' OR {b} = '' THEN 0 ELSE {found} END"


def _suggestions_sql(values: str, keys: str) -> str:
    """(value, rank, suggestion, score): every value against every entry by the weighted score."""
    words = lambda x: f"array_to_string(list_sort({x}), ' ')"
    split = lambda x: f"list_filter(string_split({x}, ' '), lambda w: w <> '')"
    kinds = {"base": ("v", "k"), "sorted": ("sv", "sk"), "s1": ("meet", "one"), "s2": ("meet", "other"), "s3": ("one", "other")}
    union = " UNION ALL ".join(f"SELECT v, k, far, '{n}' AS kind, {a} AS x, {b} AS y FROM sg_n" for n, (a, b) in kinds.items())
    value = lambda k: f"max(CASE WHEN kind = '{k}' THEN s END)"
    sets = "greatest(" + ", ".join(value(k) for k in ("s1", "s2", "s3")) + ")"
    return f"""
WITH RECURSIVE sg_v AS (SELECT DISTINCT value, {match_key('value')} AS v FROM ({values})),
sg_k AS ({keys}),
sg_w AS (SELECT v, akey AS k, {split('v')} AS wv, {split('akey')} AS wk, greatest(length(v), length(akey))::DOUBLE / least(length(v), length(akey)) AS far FROM (SELECT DISTINCT v FROM sg_v WHERE v <> ''), sg_k),
sg_n AS (SELECT *, {words('wv')} AS sv, {words('wk')} AS sk, meet, trim(meet || ' ' || {words('list_filter(list_distinct(wv), lambda w: NOT list_contains(wk, w))')}) AS one,
                trim(meet || ' ' || {words('list_filter(list_distinct(wk), lambda w: NOT list_contains(wv, w))')}) AS other
         FROM (SELECT *, {words('list_filter(list_distinct(wv), lambda w: list_contains(wk, w))')} AS meet FROM sg_w)),
sg_t AS (SELECT *, far >= 1.5 AND kind <> 'base' AS part FROM ({union})
         UNION ALL SELECT v, k, far, 'part', v, k, TRUE FROM sg_n WHERE far >= 1.5),
sg_u AS (SELECT *, CASE WHEN part AND length(x) > length(y) THEN y ELSE x END AS a, CASE WHEN part AND length(x) > length(y) THEN x ELSE y END AS b FROM sg_t),
{_matched('sg_b', 'SELECT a, b FROM sg_u')},
sg_win AS (SELECT DISTINCT a, b, substr(b, begins + 1, length(a)) AS w FROM (
             SELECT a, b, greatest(j - i, 0) AS begins FROM sg_b UNION ALL SELECT a, b, length(b) - length(a) FROM sg_b_p) WHERE length(a) <= length(b) AND (a, b) IN (SELECT (a, b) FROM sg_u WHERE part)),
{_matched('sg_c', 'SELECT a, w AS b FROM sg_win')},
sg_r AS (SELECT sg_win.a, w, 2.0::DOUBLE * sum(k) / (length(sg_win.a) + length(w)) AS r FROM sg_win JOIN sg_c ON sg_c.a = sg_win.a AND sg_c.b = sg_win.w GROUP BY sg_win.a, sg_win.b, sg_win.w),
sg_p AS (SELECT sg_win.a, sg_win.b, CASE WHEN bool_or(sg_win.a = sg_win.w OR r > 0.995) THEN 100 ELSE CAST(round_even(100 * max(coalesce(r, 0)), 0) AS INTEGER) END AS score
         FROM sg_win LEFT JOIN sg_r ON sg_r.a = sg_win.a AND sg_r.w = sg_win.w GROUP BY sg_win.a, sg_win.b),
sg_s AS (SELECT v, k, far, kind, {_ratio('sg_u.a', 'sg_u.b', 'CASE WHEN part THEN sg_p.score ELSE sg_b_ratio.score END')} AS s
         FROM sg_u LEFT JOIN sg_b_ratio ON sg_u.a = sg_b_ratio.a AND sg_u.b = sg_b_ratio.b LEFT JOIN sg_p ON sg_u.a = sg_p.a AND sg_u.b = sg_p.b),
sg_z AS (SELECT v, k, CAST(round_even(CASE
           WHEN far < 1.5 THEN greatest({value('base')}, {value('sorted')} * 0.95::DOUBLE, {sets} * 0.95::DOUBLE)
           ELSE greatest({value('base')}, {value('part')} * w, {value('sorted')} * 0.95::DOUBLE * w, {sets} * 0.95::DOUBLE * w) END, 0) AS INTEGER) AS score
         FROM (SELECT *, CASE WHEN far > 8 THEN 0.6::DOUBLE ELSE 0.9::DOUBLE END AS w FROM sg_s) GROUP BY v, k, far, w),
sg_o AS (SELECT value, aname, score, row_number() OVER (PARTITION BY value ORDER BY score DESC, aord) AS rank
         FROM sg_v JOIN sg_z USING (v) JOIN sg_k ON akey = k WHERE score > 0)
SELECT value, CAST(rank AS INTEGER) AS rank, aname AS suggestion, score FROM sg_o WHERE rank <= 3
"""


_RATIO_INPUTS = f"""SELECT p_partkey, p_name, translate(p_name, {q(I.VOWEL_SHIFT[0])}, {q(I.VOWEL_SHIFT[1])}) AS m, lower(p_type) AS t,
  p_type || ' ' || translate(p_name, {q(I.VOWEL_SHIFT[0])}, {q(I.VOWEL_SHIFT[1])}) || ' ' || upper(p_name) || ' ' || p_name AS l FROM part"""
_RATIOS = {"misspelt": ("p_name", "m"), "part_type": ("p_name", "t"), "longer": ("p_name", "l"), "reversed": ("l", "p_name")}
SQL["ratio_scores"] = f"""
WITH RECURSIVE rs AS ({_RATIO_INPUTS}),
{_matched('rs_b', ' UNION ALL '.join(f'SELECT {a} AS a, {b} AS b FROM rs' for a, b in _RATIOS.values()))}
SELECT p_partkey, {', '.join(f"{_ratio(a, b, f'{n}_.score')} AS {n}" for n, (a, b) in _RATIOS.items())}
FROM rs {' '.join(f'LEFT JOIN rs_b_ratio {n}_ ON {n}_.a = rs.{a} AND {n}_.b = rs.{b}' for n, (a, b) in _RATIOS.items())}
"""

SQL["authority_top3"] = _suggestions_sql(
    f"SELECT translate(p_name, {q(I.VOWEL_SHIFT[0])}, {q(I.VOWEL_SHIFT[1])}) AS value FROM part", _AUTH_KEYS)

_SENT = "string_split_regex(" + ascii_only("text") + ", '[.!?]+[ \\n]+')"
SQL["fuzzy_join_blocked"] = f"""
WITH b AS (SELECT item_id, CAST(unnest(range(0, len(ss))) AS INTEGER) AS item_sent, unnest(ss) AS s FROM (SELECT item_id, {_SENT} AS ss FROM benchmark)),
d AS (SELECT doc_id, CAST(unnest(range(0, len(ss))) AS INTEGER) AS doc_sent, unnest(ss) AS r FROM (SELECT doc_id, {_SENT} AS ss FROM documents))
SELECT item_id, item_sent, doc_id, doc_sent, CAST(levenshtein(s, r) AS INTEGER) AS dist
FROM b JOIN d ON length(s) >= {C.FUZZY_CHARS} AND length(r) >= {C.FUZZY_CHARS}
  AND abs(length(s) - length(r)) <= floor({C.FUZZY_RATE}::DOUBLE * greatest(length(s), length(r)))
WHERE levenshtein(s, r) <= floor({C.FUZZY_RATE}::DOUBLE * greatest(length(s), length(r)))
"""


# -- validation ------------------------------------------------------------------------------
def _record_title_sql(lines: str = "lines", lang: str = "lang") -> str:
    l0 = f"{lines}[1]"
    misspelt = f"left({l0}, CAST(length({l0}) - 1 AS INTEGER)) || '#'"
    return f"CASE {lang} WHEN 'en' THEN upper({l0}) WHEN 'es' THEN translate({l0}, {q(I.VOWEL_SHIFT[0])}, {q(I.VOWEL_SHIFT[1])}) WHEN 'fr' THEN {misspelt} ELSE {l0} END"


def _title_valid(title: str, doc: str) -> str:
    return f"({_title_score(title, doc)} = 100)"


def _title_score(title: str, doc: str) -> str:
    a, b = f"lower(coalesce({doc}, 'Error'))", f"lower(coalesce({title}, 'None'))"
    return f"CASE WHEN {a} = {b} THEN 100 ELSE {lev_score(a, b)} END"


_ASCII_DOCS = f"SELECT doc_id, lang, source, {text_lines(ascii_only('text'))} AS lines FROM documents"

SQL["title_validation"] = f"""
WITH tv_d AS (SELECT doc_id, lines, {_record_title_sql()} AS kw FROM ({_ASCII_DOCS})),
tv_b AS ({_best_native_sql(C.VALIDATION_MIN_LINES, "SELECT doc_id, lines, kw FROM tv_d")}),
tv AS (SELECT tv_d.doc_id, tv_d.kw AS title, coalesce(tv_b.text, 'Error') AS doc_title FROM tv_d JOIN tv_b USING (doc_id))
SELECT doc_id, doc_title, {_title_valid('title', 'doc_title')} AS title_ok, {_title_score('title', 'doc_title')} AS score FROM tv
"""


def _eq_part(part: str, name: str) -> str:
    return f"coalesce(coalesce({name}, '') <> '' AND {py_strip(part)} = {name}, false)"


def _author_valid(doc: str, f: str, m: str, l: str) -> str:
    parts = f"string_split(coalesce({doc}, 'None'), ' ')"
    p0 = f"coalesce({parts}[1], 'None')"
    p1 = f"coalesce({parts}[2], 'None')"
    p2 = f"coalesce({parts}[3], 'None')"
    pair = f"CASE WHEN len({parts}) >= 3 THEN {parts}[2] || ' ' || {parts}[3] ELSE 'False' END"
    full = _full_name(f"coalesce({f}, '')", f"coalesce({m}, '')", f"coalesce({l}, '')")
    return (
        f"(({_eq_part(p0, f)} AND ({_eq_part(p2, l)} OR {_eq_part(p1, l)} OR {_eq_part(pair, l)})) "
        f"OR {_eq_part(f'coalesce({doc}, {q(chr(78) + 'one')})', full)})"
    )


SQL["author_validation"] = f"""
WITH c AS (SELECT conv_id, turn, role, string_split({ascii_only('text')}, chr(10)) AS ls FROM conversations),
n AS (SELECT conv_id, turn, line_no, doc_author, string_split(doc_author, ' ') AS w, role
      FROM (SELECT conv_id, turn, role, CAST(unnest(range(0, len(ls))) AS INTEGER) AS line_no, unnest(ls) AS doc_author FROM c)),
p AS (SELECT conv_id, turn, line_no, doc_author,
        CASE WHEN role = 'system' THEN lower(w[1]) ELSE w[1] END AS f,
        CASE WHEN role = 'assistant' THEN w[2] ELSE '' END AS m,
        CASE WHEN role = 'user' THEN {_rest('doc_author', 2)} WHEN role = 'assistant' THEN {_rest('doc_author', 1)} ELSE w[2] END AS l FROM n)
SELECT conv_id, turn, line_no, {_author_valid('doc_author', 'f', 'm', 'l')} AS author_ok FROM p
"""

# -- quality control plan ------------------------------------------------------------------------
_QC_AUTH_KEYS = f"""
SELECT akey, arg_min(aname, aord) AS aname, min(aord) AS aord FROM (
  SELECT {match_key('aname')} AS akey, aname, aord FROM {values_table([(n, i) for i, n in enumerate(C.QC_AUTHORITY)], ['aname', 'aord'])})
WHERE akey <> '' GROUP BY akey
"""

SQL["review_queue"] = f"""
WITH RECURSIVE qc_lab AS ({_LABELLED}),
qc_raw AS (SELECT doc_id, {text_lines(ascii_only('text'))} AS raw FROM documents),
qc_d1 AS (
  SELECT source || '_' || CAST(doc_id AS VARCHAR) AS record_key, doc_id, {text_lines(ascii_only('qc_lab.text'))} AS lines, {_record_title_sql('raw')} AS title,
         coalesce(string_split(coalesce(raw[2], ''), ' ')[1], '') AS fname, '' AS mname,
         coalesce(string_split(coalesce(raw[2], ''), ' ')[2], '') AS lname,
         {_find_major(ascii_only('qc_lab.text'), False)} AS major
  FROM documents JOIN qc_lab USING (doc_id) JOIN qc_raw USING (doc_id)),
qc_d2 AS (SELECT *, {_full_name('fname', 'mname', 'lname')} AS author FROM qc_d1),
qc_bt AS ({_best_native_sql(C.VALIDATION_MIN_LINES, "SELECT doc_id, lines, title AS kw FROM qc_d2")}),
qc_ba AS ({_best_native_sql(C.VALIDATION_MIN_LINES, "SELECT doc_id, lines, author AS kw FROM qc_d2")}),
qc_d3 AS (SELECT qc_d2.*, coalesce(qc_bt.text, 'Error') AS doc_title, coalesce(qc_ba.text, 'None') AS doc_author
          FROM qc_d2 JOIN qc_bt USING (doc_id) JOIN qc_ba USING (doc_id)),
qc_k AS ({_QC_AUTH_KEYS}),
qc_m AS (SELECT record_key, major, string_split(major, ';') AS parts FROM qc_d3),
qc_m2 AS (SELECT record_key, major, CASE WHEN len(parts) >= 2 THEN {py_strip('parts[1]')} END AS f,
                 CASE WHEN len(parts) >= 2 THEN {py_strip('parts[2]')} END AS s FROM qc_m),
qc_st AS (SELECT record_key, CASE WHEN k2.akey IS NOT NULL AND k3.akey IS NOT NULL THEN 'pair' WHEN k1.akey IS NOT NULL THEN 'exact' ELSE 'review' END AS status
          FROM qc_m2 LEFT JOIN qc_k k1 ON {match_key('qc_m2.major')} = k1.akey
                     LEFT JOIN qc_k k2 ON {match_key('qc_m2.f')} = k2.akey
                     LEFT JOIN qc_k k3 ON {match_key('qc_m2.s')} = k3.akey),
qc_rv AS (SELECT DISTINCT d.major AS value FROM qc_d3 d JOIN qc_st USING (record_key) WHERE qc_st.status = 'review'),
qc_top AS ({_suggestions_sql('SELECT value FROM qc_rv', 'SELECT * FROM qc_k')}),
qc_sug AS (SELECT value AS major, string_agg(suggestion, ' | ' ORDER BY rank) AS sug FROM qc_top GROUP BY value),
qc AS (SELECT qc_d3.*, qc_st.status, {_title_valid('title', 'doc_title')} AS title_ok, {_title_score('title', 'doc_title')} AS title_score,
              {_author_valid('doc_author', 'fname', 'mname', 'lname')} AS author_ok
       FROM qc_d3 JOIN qc_st USING (record_key))
SELECT record_key, 'title' AS "check", title AS source_value, doc_title AS document_value, CAST(title_score AS INTEGER) AS score, '' AS suggestions
FROM qc WHERE NOT title_ok
UNION ALL
SELECT record_key, 'author', author, doc_author, CAST(NULL AS INTEGER), '' FROM qc WHERE NOT author_ok
UNION ALL
SELECT record_key, 'major', qc.major, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), coalesce(qc_sug.sug, '')
FROM qc LEFT JOIN qc_sug USING (major) WHERE qc.status = 'review'
"""

# -- corrections and reports ----------------------------------------------------------------
_QC_RECORDS = f"""
SELECT source || '_' || CAST(doc_id AS VARCHAR) AS record_key, doc_id, lang, {_record_title_sql()} AS title, lines,
       len(lines) > 1 AS has0, CASE WHEN len(lines) > 1 THEN {_w('lines[2]', 0)} END AS f0, CASE WHEN len(lines) > 1 THEN {_rest('lines[2]', 2)} END AS m0,
       CASE WHEN len(lines) > 1 THEN coalesce({_w('lines[2]', 1)}, '') END AS l0,
       CASE WHEN len(lines) > 2 THEN coalesce({_w('lines[3]', 1)}, '') END AS l1
FROM ({_ASCII_DOCS})
"""
_QC_CORR = f"""
SELECT record_key, CASE WHEN lang = 'es' THEN {py_strip('lines[1]')} END AS ct,
       CASE WHEN lang = 'fr' THEN l0 END AS cf, CASE WHEN lang = 'fr' THEN 'None' END AS cm, CASE WHEN lang = 'fr' THEN f0 END AS cl
FROM qr
"""

SQL["apply_corrections"] = f"""
WITH qr AS ({_QC_RECORDS}), qcorr AS ({_QC_CORR}),
j AS (SELECT qr.*, ct, cf, cm, cl FROM qr LEFT JOIN qcorr USING (record_key)),
u AS (SELECT record_key, coalesce(ct, title) AS title, has0, CASE WHEN has0 THEN coalesce(cf, f0) END AS fname,
             CASE WHEN has0 THEN CASE WHEN cm IS NULL OR cm IN ('', ' ', 'None') THEN m0 ELSE cm END END AS mname,
             CASE WHEN has0 THEN coalesce(cl, l0) END AS lname, l1 AS second_lname, lines FROM j)
SELECT record_key, title, fname, mname, lname, second_lname, CAST(greatest(len(lines) - 1, 0) AS INTEGER) AS n_authors,
       md5(array_to_string(list_transform(lines[2:], lambda l, i: CASE WHEN i = 1 THEN {_full_name('fname', 'mname', 'lname')}
           ELSE {_full_name(_w('l', 0), _rest('l', 2), _w('l', 1))} END), '|')) AS authors_md5,
       CASE WHEN has0 THEN {_full_name('fname', 'mname', 'lname')} ELSE 'glued' END AS rights_holder FROM u
"""
SQL["major_corrections"] = f"""
WITH qr AS ({_QC_RECORDS}), qcorr AS ({_QC_CORR})
SELECT record_key, 0 AS field_pos, 'rights_holder' AS name, CASE WHEN has0 THEN {_full_name('coalesce(cf, f0)', 'm0', 'coalesce(cl, l0)')} ELSE 'glued' END AS field_values FROM qr JOIN qcorr USING (record_key)
UNION ALL
SELECT record_key, 1, 'major', CASE lang WHEN 'de' THEN 'Existing' WHEN 'fr' THEN 'Agronomy|Physics' ELSE 'Agronomy' END FROM qr WHERE lang <> 'es'
"""



def _repair(x: str) -> str:
    out = f"translate({x}, {q(''.join(a for a, _ in _ONE))}, {q(''.join(b for _, b in _ONE))})"
    for a, b in _MANY:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


SQL["error_report"] = f"""
WITH qr AS ({_QC_RECORDS}), qcorr AS ({_QC_CORR})
SELECT record_key || '-out.xml' AS file, {_repair('title')} AS title, ct AS title_correction,
       {_repair(_full_name('f0', 'm0', 'l0'))} AS author,
       CASE WHEN cl IS NOT NULL THEN concat_ws(' ', cf, cm, cl) END AS author_correction
FROM qr JOIN qcorr USING (record_key) WHERE ct IS NOT NULL OR cl IS NOT NULL
"""

SQL["error_report_csv"] = f"""
SELECT file, coalesce(title, '') AS title, coalesce(title_correction, '') AS title_correction, coalesce(author, '') AS author,
       coalesce(author_correction, '') AS author_correction FROM ({SQL['error_report']})
"""
SQL["error_report_indexed"] = f"""
SELECT *, row_number() OVER (ORDER BY file NULLS FIRST, title NULLS FIRST, title_correction NULLS FIRST, author NULLS FIRST, author_correction NULLS FIRST) - 1 AS index FROM ({SQL['error_report']})
"""
_LOG_MAJORS = f"list_filter(list_transform(string_split(concat_ws('; ', w[1], w[2]), ';'), lambda x: {py_strip('x')}), lambda x: x <> '')"
SQL["correction_log"] = f"""
WITH qr AS ({_QC_RECORDS}),
lg AS (SELECT record_key, seq, line, string_split(line, ' ') AS w FROM (SELECT record_key, unnest(lines) AS line, unnest(range(0, len(lines))) AS seq FROM qr) WHERE seq <= {C.LOG_AS_OF}),
f AS (SELECT record_key, arg_max(line, seq) FILTER (seq % 5 = 0) AS t, arg_max(w[1], seq) FILTER (seq % 5 = 1) AS f, arg_max(w[2], seq) FILTER (seq % 5 = 2 AND w[2] NOT IN ('', ' ', 'None')) AS m,
             arg_max(w[1], seq) FILTER (seq % 5 = 3) AS l, arg_min({_LOG_MAJORS}, seq) FILTER (seq % 5 = 4 AND len({_LOG_MAJORS}) > 0) AS j FROM lg GROUP BY record_key),
u AS (SELECT record_key, lang, coalesce(t, title) AS title, has0, CASE WHEN has0 THEN coalesce(f, f0) END AS fname, CASE WHEN has0 THEN coalesce(m, m0) END AS mname,
             CASE WHEN has0 THEN coalesce(l, l0) END AS lname, j FROM qr LEFT JOIN f USING (record_key))
SELECT record_key, title, fname, mname, lname, CASE WHEN has0 THEN {_full_name('fname', 'mname', 'lname')} ELSE 'glued' END AS rights_holder,
       CASE WHEN lang = 'de' THEN 'Existing' ELSE array_to_string(j, '|') END AS majors FROM u
"""
SQL["upload_batches"] = f"""
WITH qr AS ({_QC_RECORDS}), n AS (SELECT record_key, row_number() OVER (ORDER BY l0 NULLS FIRST, f0 NULLS FIRST, record_key, title NULLS FIRST) - 1 AS i FROM qr)
SELECT record_key, i // {C.BATCH_SIZE} AS batch, i % {C.BATCH_SIZE} AS position FROM n
"""
SQL["record_rejects"] = """
SELECT source || '_' || CAST(kind AS VARCHAR) AS file, count(t) AS n_records, min(t) AS first_title, max(t) AS last_title,
       max(CASE kind WHEN 3 THEN 'malformed record' WHEN 5 THEN 'no record' WHEN 6 THEN 'empty record' END) AS reason
FROM (SELECT source, doc_id % 8 AS kind, CASE WHEN doc_id % 8 NOT IN (3, 5, 6) THEN md5(text) END AS t FROM documents) GROUP BY source, kind
"""
SQL["contains_automaton"] = """
WITH r AS (SELECT substr(lower(string_split(p_name, ' ')[1]), 1, 3) AS a, substr(lower(string_split(p_type, ' ')[1]), 1, 3) AS b, min(p_partkey) AS ord FROM part GROUP BY ALL),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents),
h AS (SELECT doc_id, line_no, arg_min(a || '+' || b, ord) AS target FROM l JOIN r ON contains(lower(line), a) AND contains(lower(line), substr(b, 1, 2)) GROUP BY doc_id, line_no)
SELECT l.doc_id, CAST(l.line_no AS INTEGER) AS line_no, coalesce(h.target, lower(l.line)) AS target FROM l LEFT JOIN h ON l.doc_id = h.doc_id AND l.line_no = h.line_no
"""
SQL["rule_audit"] = """
WITH RECURSIVE c AS (SELECT p_partkey AS ord, substr(lower(p_name), 1, CAST(p_partkey % 5 + 2 AS INTEGER)) AS x, p_brand || '-' || CAST(p_size AS VARCHAR) AS y FROM part),
hidden AS (SELECT l.ord, min(e.ord) AS by_ord FROM c l JOIN c e ON e.ord < l.ord AND (contains(l.x, e.x) OR contains(l.y, e.x)) AND (contains(l.x, e.y) OR contains(l.y, e.y)) GROUP BY l.ord),
m0 AS (SELECT 'k' || CAST(p_partkey AS VARCHAR) AS k, 'k' || CAST(CASE WHEN p_partkey % 4 = 0 THEN p_partkey + 4 - CASE WHEN p_partkey % 28 = 0 THEN 28 ELSE 0 END ELSE p_size * 41 + p_partkey % 37 END AS VARCHAR) AS t FROM part),
m AS (SELECT k, min(t) AS t FROM m0 GROUP BY k HAVING k <> min(t)),
walk AS (SELECT k, t AS cur, [k] AS path FROM m
         UNION ALL SELECT walk.k, m.t, list_append(path, cur) FROM walk JOIN m ON m.k = cur WHERE NOT list_contains(path, cur)),
ends AS (SELECT k, arg_max(cur, len(path)) AS cur, arg_max(path, len(path)) AS path FROM walk GROUP BY k),
told AS (SELECT k, CASE WHEN NOT list_contains(path, cur) THEN 'chain' WHEN list_position(path, cur) = 1 THEN 'cycle' ELSE 'into cycle' END AS kind,
                CASE WHEN list_contains(path, cur) AND list_position(path, cur) = 1 THEN list_min(path) ELSE cur END AS cause,
                CASE WHEN list_contains(path, cur) AND list_position(path, cur) > 1 THEN list_position(path, cur) - 1 ELSE len(path) END AS steps FROM ends)
SELECT 'hidden' AS kind, CAST(ord AS VARCHAR) AS rule, CAST(by_ord AS VARCHAR) AS cause, CAST(NULL AS BIGINT) AS steps FROM hidden
UNION ALL SELECT kind, k, cause, steps FROM told WHERE kind <> 'chain' OR steps > 1
"""
SQL["authority_csv"] = "SELECT DISTINCT p_name || ', ' || p_type AS authority_name FROM part"
SQL["merge_sorted"] = f"WITH qr AS ({_QC_RECORDS}) SELECT record_key, title, l0 AS lname, f0 AS fname FROM qr"

# -- record <-> document pairing, merge ---------------------------------------------------------
_REC_FILES = "SELECT doc_id, 'doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS pdf_name FROM documents"
_DOC_FILES = "SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS pdf_name, quality FROM labels"
SQL["record_document_join"] = f"""
SELECT r.doc_id, r.pdf_name, f.pdf_name IS NOT NULL AS has_document, f.quality
FROM ({_REC_FILES}) r LEFT JOIN ({_DOC_FILES}) f ON r.pdf_name = f.pdf_name
"""
SQL["unmatched"] = f"""
SELECT pdf_name, 'record_without_document' AS side FROM ({_REC_FILES}) r WHERE pdf_name NOT IN (SELECT pdf_name FROM ({_DOC_FILES}))
UNION ALL
SELECT pdf_name, 'document_without_record' AS side FROM ({_DOC_FILES}) f WHERE pdf_name NOT IN (SELECT pdf_name FROM ({_REC_FILES}))
"""
SQL["merge_batches"] = f"""
SELECT record_key, title FROM (
  SELECT source || '_' || CAST(doc_id AS VARCHAR) AS record_key, {title_field('text')} AS title FROM documents)
"""
SQL["skip_records"] = f"""
SELECT record_key, title FROM (SELECT source AS record_key, {title_field('text')} AS title FROM documents)
ORDER BY record_key, title OFFSET {C.SKIP}
"""

SQL["document_first_pages"] = f"""
SELECT doc_id AS record_key,
       array_to_string(list_transform(string_split(text, chr(10))[1:{11 * C.LINES_PER_PAGE}], lambda l: l || chr(10)), '') AS text
FROM documents
"""


# -- whole crosswalk ------------------------------------------------------------------------------
def _xw_cte() -> str:
    l0 = "ls[1]"
    w = "string_split(coalesce(ls[2], ''), ' ')"
    title_src = f"CASE WHEN lang IN ('fr', 'de') THEN upper(replace({l0}, 'ß', 'ss')) ELSE {l0} END"
    accept = "CAST(doc_id % 12 + 1 AS VARCHAR) || '/' || CAST(doc_id % 28 + 1 AS VARCHAR) || '/2019'"
    kw_src = f"translate({l0}, '.', ';')"
    kws = f"CASE WHEN {kw_src} IS NULL OR {kw_src} = '' THEN []::VARCHAR[] ELSE string_split_regex(translate({kw_src}, ';', ','), ',[ \\t\\r\\n]+') END"
    paras = f"list_transform(list_filter(ls[2:], lambda p: p <> 'Abstract'), lambda p: {normalize_space(markup('p', T.ABSTRACT_MARKUP))} || ' ')"
    dept_src = "CASE WHEN lang = 'es' THEN source || ' & partners' ELSE source END"
    dept = f"CASE WHEN contains({dept_src}, '&') THEN replace({dept_src}, '&', 'and') ELSE {case_map('source', C.DEPARTMENT_RULES)} END"
    subj = lambda x: f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN [{', '.join(map(q, ts))}]" for k, ts in C.SUBJECT_RULES.items()) + f" ELSE [{x}] END"
    f1, m1, s1 = f"{w}[2]", f"coalesce({w}[3], '')", "CASE WHEN doc_id % 5 = 0 THEN 'jr' ELSE '' END"
    two = lambda a, b: f"concat_ws(' ', {a}, CASE WHEN doc_id % 3 = 0 THEN {b} END)"
    return f"""
SELECT source || '_' || CAST(doc_id AS VARCHAR) AS record_key,
       {title_field(title_src)} AS title,
       {mdy(accept)} AS publication_date,
       CASE lang WHEN 'en' THEN 'dissertation' WHEN 'de' THEN 'thesis' ELSE 'report' END AS document_type,
       CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS n_authors,
       {hyphen_title_case(f"coalesce({w}[1], '')")} AS lname,
       {hyphen_title_case(f"coalesce({f1}, '')")} AS fname,
       {hyphen_title_case(m1)} AS mname,
       CASE WHEN doc_id % 5 = 0 THEN 'Jr' ELSE '' END AS suffix,
       source || '@example.org' AS email,
       array_to_string(list_concat({subj('lang')}, {subj('source')}), '|') AS disciplines,
       array_to_string({kws}, '|') AS keywords,
       array_to_string({paras}, '|') AS abstract,
       array_to_string(list_transform({kws}, lambda x: trim(x)), '|') AS keywords_trimmed,
       array_to_string(list_transform({paras}, lambda x: trim(x)), '|') AS abstract_trimmed,
       'https://repository.example.org/uploads/' || source || '_' || CAST(doc_id AS VARCHAR) || '.pdf' AS fulltext_url,
       coalesce({_contains_case(l0, C.DEGREE_RULES)}, '') || {_contains_case("'Ph.D.'", C.DEGREE_RULES)} AS degree_name,
       {dept} AS department,
       CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id % 8 = 0 THEN '2001-01-01' ELSE '2020-03-04' END
                       WHEN 1 THEN CASE WHEN doc_id % 3 <> 0 THEN '2020-02-03' END
                       WHEN 2 THEN '2021-05-06' ELSE '2001-01-01' END AS embargo_date,
       CASE WHEN doc_id % 4 = 1 AND doc_id % 3 = 0 THEN 'bad decision date' END AS errors,
       {two(f"{f1}", "lang")} || {two(m1, "NULL")} || {two(f"{w}[1]", "source")} || {two(s1, "NULL")} AS rights_holder,
       CAST(n_chars // 100 AS VARCHAR) || ' pages' AS file_size,
       CASE WHEN doc_id % 4 > 0 THEN coalesce({w}[1], '') || ' ' || coalesce({w}[2], '') END AS advisor1,
       CASE WHEN doc_id % 4 > 1 THEN lang || ' ' || left(source, 1) || '. ' || coalesce({w}[1], '') END AS advisor2,
       CASE WHEN doc_id % 4 > 2 THEN source || ' ' || lang END AS advisor3,
       lang AS language, CAST(2000 + doc_id % 20 AS VARCHAR) AS copyright_date,
       'Received from the submission service' AS provenance, 'application/pdf' AS fileformat, 'Example University' AS institution,
       CASE WHEN doc_id % 3 = 0 THEN {hyphen_title_case('source')} END AS lname2, CASE WHEN doc_id % 3 = 0 THEN '' END AS suffix2, CASE WHEN doc_id % 3 = 0 THEN '' END AS email2,
       CAST(7 + doc_id % 4 AS INTEGER) AS n_fields
FROM (SELECT doc_id, lang, source, n_chars, string_split(text, chr(10)) AS ls FROM documents)
"""


SQL["crosswalk_records"] = f"SELECT * EXCLUDE (keywords_trimmed, abstract_trimmed) FROM ({_xw_cte()})"
SQL["crosswalk_roundtrip"] = f"""
SELECT fulltext_url, title, publication_date, document_type, 'individual' AS author_type, lname, fname, n_authors, disciplines,
       keywords_trimmed AS keywords, abstract_trimmed AS abstract, degree_name, department,
       concat_ws('|', 'language=' || language, 'provenance=' || provenance, 'copyright_date=' || copyright_date, 'embargo_date=' || coalesce(embargo_date, ''),
                 'file_size=' || file_size, 'fileformat=' || fileformat, 'rights_holder=' || rights_holder,
                 'advisor1=' || advisor1, 'advisor2=' || advisor2, 'advisor3=' || advisor3) AS field_list
FROM ({_xw_cte()})
"""
