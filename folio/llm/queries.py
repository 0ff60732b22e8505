"""Queries of this package's operators over the driver's tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import filter_audit, hnsw, langid, toxicity, turn_repair
from .backoff_lm import score_documents
from .bpe import encode_documents
from .common import fold, table
from .cuckoo import exact_groups
from .packing import pack_documents
from .pii import KINDS, find_spans, fit
from .set_join import jaccard_components
from .simhash import near_components
from .url_reputation import MAX_BAD, RHO, TWO_LABEL_SUFFIXES, EMPTY_RATE, Z, judge_pages, url_path

VOCABULARY = "word_bpe_49k.json"


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; the fold of remainder 0 is held out of training."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id") != 0))
    return langid.predict_languages(docs, model).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids packed into windows of 2048; one row per piece."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), chunks=700_000)  # two workers an executor: some 700 MB


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of ids and text."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), digests=True)


#: The rules of the URL filter (fixed values).
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict.  A page shows the document that its path's first
    number names; its outcome is bad if that document's label is low quality
    or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_path(F.col("url")), "/([0-9]{1,18})", 1)
    shown = pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return judge_pages(pages, shown.join(labels, "doc_id").select("page_id", "bad"), URL_RULES)


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hnsw.search(hnsw.build_index(vectors), vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base spans (counts and digest) and all spans."""
    docs = table(spark, sf_dir, "documents")
    found = find_spans(docs, fit(docs))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
    )


def op7_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores; the fold of remainder 1 is held out of training."""
    docs = table(spark, sf_dir, "documents")
    found = score_documents(docs, fold("doc_id") != 1)
    return found.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's severity grade, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade_texts(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents; the largest id of each group stays."""
    return exact_groups(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components at 4 or fewer differing bits."""
    return near_components(table(spark, sf_dir, "documents"))


def op11_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by its rows' crc32 and repaired by the cheapest edits."""
    turns = table(spark, sf_dir, "conversations")
    return turn_repair.repair(turn_repair.damage(turns), turns, times="times")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, audited in all 120 orders for each language."""
    return filter_audit.audit(filter_audit.masked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "ABCDE")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_langid, op2_packing, op3_bpe, op4_url_reputation, op5_hnsw, op6_pii, op7_backoff_lm, op8_toxicity, op9_exact_dedup, op10_simhash, op11_set_join, op12_turn_repair, op13_filter_audit)}

def _reputation_sql() -> str:
    """The beta-binomial levels of ``url_reputation`` as SQL: each level's groups, prior weight and posterior mean."""

    def strength(level: str) -> str:
        return f"""(SELECT 1 / least(greatest(coalesce(sum(pow(k - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0), {RHO[0]}), {RHO[1]}) - 1 FROM {level})"""

    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    return f"""
        WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u FROM pages),
        parsed AS (SELECT page_id, translate(regexp_extract(u, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        judged AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NULL OR toxic IS NULL THEN NULL ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
        outcome AS (SELECT page_id, max(bad) AS bad FROM (SELECT page_id, TRY_CAST(nullif(regexp_extract(path, '/([0-9]{{1,18}})', 1), '') AS BIGINT) AS doc_id FROM parsed) JOIN judged USING (doc_id) WHERE bad IS NOT NULL GROUP BY page_id),
        named AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS l FROM parsed),
        leveled AS (SELECT page_id, host, path, array_to_string(l, '.') AS name, array_to_string(l[-2:], '.') IN ({two}) AS is_two,
                           CASE WHEN is_two THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain,
                           CASE WHEN is_two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix FROM named),
        hosts AS (SELECT name, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM leveled LEFT JOIN outcome USING (page_id) GROUP BY ALL),
        s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, coalesce((SELECT sum(k) / nullif(sum(n), 0) FROM hosts), {EMPTY_RATE}) AS m FROM hosts GROUP BY suffix),
        s1 AS (SELECT suffix, (k + {strength('s0')} * m) / (n + {strength('s0')}) AS m FROM s0),
        d0 AS (SELECT domain, any_value(s1.m) AS m, sum(n) AS n, sum(k) AS k FROM hosts JOIN s1 USING (suffix) GROUP BY domain),
        d1 AS (SELECT domain, (k + {strength('d0')} * m) / (n + {strength('d0')}) AS m FROM d0),
        h0 AS (SELECT name, n, k, d1.m FROM hosts JOIN d1 USING (domain)),
        h1 AS (SELECT name, k + {strength('h0')} * m AS a, n - k + {strength('h0')} * (1 - m) AS b FROM h0),
        rep AS (SELECT name, a / (a + b) - {Z} * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) AS lower_bad FROM h1),
        ruled AS (SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                                 WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                                 WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
                                 WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
                                 WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM leveled)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN lower_bad > {MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict,
               lower_bad
        FROM ruled JOIN rep USING (name)
    """


def _repair_sql() -> str:
    """The damage, faults and cheapest edits as SQL: a recursive walk over each conversation's rows keeps, for the last
    role written (0: none yet), the least (cost, audit) with the repaired text so far."""
    best = lambda *ways: f"list_sort(list_filter([{', '.join(ways)}], lambda z: z IS NOT NULL))[1]"
    add = lambda state, cost, edit, text="''": f"CASE WHEN {state} IS NULL THEN NULL ELSE {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'm': {state}.m || {text}}} END"
    only = lambda test, way: f"CASE WHEN {test} THEN {way} END"
    put = lambda role: f"chr(10) || '{role}:'"
    grown_u = lambda n, s, u, a: best(u, *(add(x, 3, "I", put("user")) for x in (n, s, a)))
    none = "NULL::STRUCT(c BIGINT, a VARCHAR, m VARCHAR)"
    as_user, as_assistant, as_is = "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text", "chr(10) || role || ':' || text"
    step = {
        "n": add("n", 4, "D"),
        "s": best(add("s", 4, "D"), only("free AND i = 's'", add("n", "t", "K", as_is))),
        "u": best(add("u", 4, "D"), *(only("free", add(x, "3 + t", "R", as_user)) for x in "nsa"), *(only("free AND i = 'u'", add(x, "t", "K", as_is)) for x in "nsa")),
        "a": best(add("a", 4, "D"), only("free", add("u", "3 + t", "R", as_assistant)), only("free AND i = 'a'", add("u", "t", "K", as_is))),
    }
    grown = lambda rows, more: f"SELECT conv_id, pos{more}, n, s, u, {best('a', add('u', 3, 'I', put('assistant')))} AS a FROM (SELECT conv_id, pos{more}, n, s, {grown_u('n', 's', 'u', 'a')} AS u, a FROM ({rows}))"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    crc = f"""xor(list_reduce(list_transform(string_split({key}, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda x, y: list_reduce(range(0, 8), lambda v, b: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(x, y)), 4294967295::BIGINT), 4294967295::BIGINT)"""
    return f"""
        WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS how FROM conversations),
        d AS (SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role, CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(range(0, CASE how WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE how <> 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM d),
        f AS (SELECT *, substr(role, 1, 1) AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
                     lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM o),
        r AS (SELECT conv_id, turn, role, text, pos, i, before, CASE WHEN solid = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM f),
        w AS (SELECT *, coalesce(fault NOT IN ('blank', 'duplicate'), TRUE) AS free, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS t FROM r),
        walk AS (
          {grown(f"SELECT DISTINCT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 'm': ''}} AS n, {none} AS s, {none} AS u, {none} AS a FROM r", "")}
          UNION ALL
          {grown(f"SELECT walk.conv_id, w.pos, {', '.join(f'{x} AS {k}' for k, x in step.items())} FROM walk JOIN w ON walk.conv_id IS NOT DISTINCT FROM w.conv_id AND w.pos = walk.pos + 1", "")}),
        ends AS (SELECT conv_id, {best('n', 'a')} AS e FROM walk QUALIFY pos = max(pos) OVER (PARTITION BY conv_id)),
        told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
        SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.m, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM k.conv_id
    """


ORACLE_SQL: dict[str, str] = {
    "op4_url_reputation": _reputation_sql(),
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_set_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM d),
        sets AS (SELECT g, min(doc_id) AS first, len(g) AS n FROM (SELECT doc_id, list_sort(g) AS g FROM s) GROUP BY g HAVING len(g) > 0),
        e AS (SELECT first, n, unnest(g) AS x FROM sets),
        links AS (SELECT a.first AS a, b.first AS b FROM e a JOIN e b USING (x) WHERE a.first <> b.first AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
                  GROUP BY a.first, b.first, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        least_of AS (SELECT first, least(first, (SELECT min(b) FROM reach WHERE a = first)) AS component_id FROM sets)
        SELECT s.doc_id, len(s.g) AS n_shingles, CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE component_id END AS component_id
        FROM s LEFT JOIN sets ON list_sort(s.g) = sets.g LEFT JOIN least_of USING (first)
    """,
    "op12_turn_repair": _repair_sql(),
    "op13_filter_audit": r"""
        WITH d AS (SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                          min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
        l AS (SELECT doc_id, max(coalesce(quality = 1, FALSE)::INT) AS good, max(coalesce(toxic = 1, FALSE)::INT) AS toxic FROM labels GROUP BY doc_id),
        m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                     [(len(w) < 200)::INT, (100 * len(list_distinct(w)) < 50 * len(w))::INT, (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT,
                      regexp_matches(t, '[#$%&*|]')::INT, coalesce(d.doc_id > least, FALSE)::INT] AS fails
              FROM d LEFT JOIN l USING (doc_id)),
        cells AS (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
        x(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
        seen AS (SELECT part, filter_order, step, n, good, toxic, fails[instr('ABCDE', substr(filter_order, step, 1))] = 1 AS failing,
                        len(list_filter(range(1, step), lambda k: fails[instr('ABCDE', substr(filter_order, k, 1))] = 1)) > 0 AS earlier, list_sum(fails) = 1 AS lone
                 FROM cells, steps),
        told AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS f,
                        coalesce(sum(n) FILTER (NOT failing AND NOT earlier), 0) AS kept, coalesce(sum(n) FILTER (failing AND NOT earlier), 0) AS removed,
                        coalesce(sum(n) FILTER (failing AND earlier), 0) AS redundant, coalesce(sum(n) FILTER (failing AND lone), 0) AS unique_fails,
                        coalesce(sum(n * good) FILTER (failing AND NOT earlier), 0) AS good_lost, coalesce(sum(n * toxic) FILTER (failing AND NOT earlier), 0) AS toxic_lost
                 FROM seen GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
               good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM told
    """,
}
