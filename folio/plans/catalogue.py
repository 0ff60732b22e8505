"""Query catalogue over the driver's tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the oracle SQL in ``oracles.py``.  Every query reads whole tables and
whole texts; inputs are shaped by ``inputs.py`` and all the work is done by
the library's operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, fuzzy, names, text
from ..operators import crosswalk as X
from ..operators import matching as M
from ..operators import rules as R
from ..operators import updates as U
from ..operators import validation as V
from ..operators.ordering import with_row_index
from ..session import scratch_path, written
from ..sources import files
from . import inputs as I
from .inputs import first_line, rest, table, word

# --- fixed values: example rule tables of this catalogue ---------------------
SUBJECT_RULES = {
    "ECONOMY": ["Economics", "Public Policy"],
    "STANDARD": ["Engineering"],
    "PROMO": ["Marketing", "Communication", "Business"],
    "LARGE": ["Large-Scale Systems"],
    "SMALL": ["SMALL"],
    "de": ["German Studies", "Languages"],
    "src1": ["Archives", "src1", "Records"],
}
DEGREE_RULES = [
    R.ContainsRule(("the", "and"), "Both"),
    R.ContainsRule(("the",), "The"),
    R.ContainsRule(("le", "la"), "Le La"),
    R.ContainsRule(("de",), "De"),
    R.ContainsRule(("der", "die"), "Der Die"),
    R.ContainsRule(("el",), "El"),
]
DEPARTMENT_RULES = {
    "BUILDING": "Construction",
    "MACHINERY": "Engineering",
    "FURNITURE": "FURNITURE",
    "AUTOMOBILE & SERVICES": "Vehicles",
    "src2": "Agronomy",
    "src3": "Food Science",
}
PAGE_MARKUP = [("<b>", "<strong>"), ("</b>", "</strong>"), ("<i>", "<em>"), ("</i>", "</em>"), ("<u>", " "), ("</u>", " ")]
# -------------------------------------------------------------------------------


# -- sources / keys -----------------------------------------------------------------
def _page_paths(spark, sf):
    pages = table(spark, sf, "pages")
    ext = F.element_at(F.array(*[F.lit(e) for e in I.FILE_EXTENSIONS]), (F.col("page_id") % len(I.FILE_EXTENSIONS) + 1).cast("int"))
    return pages.select("page_id", F.concat(F.regexp_replace("url", "[?#].*\\z", ""), F.lit("."), ext).alias("path"))


def file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Page URLs as delivered file paths, classified by extension (xml / pdf / media)."""
    return files.manifest_from_paths(_page_paths(spark, sf), keep=["page_id"])


def record_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Per record key: has its XML, has its PDF, number of media files."""
    return files.record_completeness(files.manifest_from_paths(_page_paths(spark, sf)))


def record_keys(spark: SparkSession, sf: str) -> DataFrame:
    """File name, document name and stem derived from a transformed record path."""
    d = table(spark, sf, "documents")
    path = F.concat(F.lit("/batch/XML-Transformed/"), F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit("_DATA-out.xml"))
    return d.select(
        "doc_id",
        text.basename(path).alias("xml_name"),
        text.record_key_from_path(path).alias("pdf_name"),
        text.stem(path).alias("stem"),
    )


# -- crosswalk fields ---------------------------------------------------------------
def _title_input(d: DataFrame) -> DataFrame:
    """Every line of every document as a title."""
    lines = d.select("doc_id", "lang", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    src = F.when(F.col("lang").isin("fr", "de"), F.upper(F.replace("line", F.lit("ß"), F.lit("ss")))).otherwise(F.col("line"))
    return lines.select("doc_id", "line_no", src.alias("title_src"))


def title_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """Target title of every line (all-capital ones for fr/de): fixed and compat forms."""
    t = _title_input(table(spark, sf, "documents"))
    return t.select("doc_id", "line_no", text.title_field("title_src").alias("title"), text.title_field("title_src", compat=True).alias("title_compat"))


def title_case(spark: SparkSession, sf: str) -> DataFrame:
    """Title case of every line, plain and with the hyphen rule."""
    t = _title_input(table(spark, sf, "documents"))
    return t.select("doc_id", "line_no", text.title_case("title_src").alias("cased"), text.hyphen_title_case("title_src").alias("cased_hyphen"))


def strip_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Every tag cut from whole page HTML."""
    return table(spark, sf, "pages", heavy=True).select("page_id", text.strip_tags("html").alias("stripped"))


def abstract_markup(spark: SparkSession, sf: str) -> DataFrame:
    """Page paragraphs as abstract paragraphs: markup rewritten, blanks normalised."""
    pages = table(spark, sf, "pages", heavy=True)
    pieces = F.filter(F.split("html", "<p>", -1), lambda x, i: i > 0)
    paras = F.transform(pieces, lambda x: F.regexp_extract(x, "(?s)^(.*?)(</p>|\\z)", 1))
    return pages.select("page_id", F.posexplode(text.abstract_paragraphs(paras, PAGE_MARKUP)).alias("pos", "p"))


def iso_date(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written M/D/YYYY (some malformed) re-formatted to YYYY-MM-DD."""
    o = table(spark, sf, "orders")
    d = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "M/yyyy"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    )
    return o.select("o_orderkey", dates.mdy_to_iso(d).alias("pub_date"))


def keyword_split(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts split into keywords (long form)."""
    d = table(spark, sf, "documents")
    src = F.translate("text", ".", ";")
    return d.select("doc_id", F.posexplode(text.split_keywords(src)).alias("pos", "keyword"))


def subject_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Part type and brand mapped through a one-to-many rule table (broadcast join, long form)."""
    p = table(spark, sf, "part")
    long = p.select("p_partkey", F.posexplode(F.array("p_type", "p_brand")).alias("cat_pos", "category"))
    out = R.one_to_many_join(long, "category", R.one_to_many_rules_df(spark, SUBJECT_RULES), out="discipline")
    return out.select("p_partkey", "cat_pos", "tgt_pos", "discipline")


def subject_crosswalk_array(spark: SparkSession, sf: str) -> DataFrame:
    """The same mapping in array form (literal map, no join)."""
    p = table(spark, sf, "part")
    arr = R.one_to_many_array(F.array("p_type", "p_brand"), SUBJECT_RULES)
    return p.select("p_partkey", F.posexplode(arr).alias("pos", "discipline"))


def ordered_contains_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document through ordered first-match contains rules, concatenated."""
    d = table(spark, sf, "documents", heavy=True)
    degrees = F.split("text", "\n", -1)
    mapped = F.array_join(F.transform(degrees, lambda x: R.ordered_contains(x, DEGREE_RULES)), "")
    return d.select("doc_id", mapped.alias("degree_name"))


def exact_map_with_escape(spark: SparkSession, sf: str) -> DataFrame:
    """Market segments (some with '&') through the department map with its '&' escape."""
    c = table(spark, sf, "customer")
    dept = F.when(F.col("c_acctbal") < 0, F.concat("c_mktsegment", F.lit(" & SERVICES"))).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", R.exact_map(dept, DEPARTMENT_RULES).alias("department"))


def doc_type(spark: SparkSession, sf: str) -> DataFrame:
    """Order priority words mapped to dissertation / thesis / themselves."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", text.doc_type(F.lower(F.substr("o_orderpriority", F.lit(3)))).alias("document_type"))


def _embargo_inputs(e: DataFrame) -> DataFrame:
    et, v = F.col("event_type"), F.col("value")
    acc = F.when(et == "view", "0").when(et == "error", "").otherwise("1")
    rs = F.when(
        v > 10,
        F.array(
            F.struct(
                F.when(F.col("user_id") % 2 == 0, "1").otherwise("0").alias("_VALUE"),
                F.lit("1").alias("_code"),
                F.date_format("ts", "M/d/yyyy").alias("_remove"),
            )
        ),
    ).otherwise(F.array().cast("array<struct<_VALUE:string,_code:string,_remove:string>>"))
    opt = (
        F.when(v < 5, "")
        .when(et == "click", "No, 6 month delayed release")
        .when(et == "purchase", "No, 1 year delayed release")
        .when(et == "signup", "No, 2 year delayed release")
        .otherwise("")
    )
    dec = F.when(v > 18, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rel = F.when(v < 2.5, "").otherwise(F.date_format(F.col("ts") + F.expr("INTERVAL 90 DAYS"), "yyyy-MM-dd'T'HH:mm"))
    return e.select("event_id", acc.alias("acc"), rs.alias("rs"), opt.alias("opt"), dec.alias("dec"), rel.alias("rel"))


def embargo_date(spark: SparkSession, sf: str) -> DataFrame:
    """Embargo decision tree over repository fields shaped from events."""
    s = _embargo_inputs(table(spark, sf, "events"))
    emb = dates.embargo_date(F.col("acc"), F.col("rs"), F.col("opt"), F.col("dec"), F.col("rel"))
    return s.select("event_id", emb["value"].alias("embargo_date"), emb["error"].alias("embargo_error"))


# -- authors, names, advisors ----------------------------------------------------------
def _conversation_authors(c: DataFrame) -> DataFrame:
    """Each conversation turn is a record; each line of its text one author
    (words: surname, first, the rest middle), with two contacts."""

    def author(line):
        w = F.split(line, " ", -1)
        ctype = F.when(F.col("role") == "user", "current").otherwise("future")
        return F.struct(
            F.struct(
                F.get(w, 0).alias("DISS_surname"), F.get(w, 1).alias("DISS_fname"), rest(w, 2).alias("DISS_middle"), F.lit("").alias("DISS_suffix")
            ).alias("DISS_name"),
            F.array(
                F.struct(ctype.alias("_type"), F.concat(F.lower(F.get(w, 0)), F.lit("@example.org")).alias("DISS_email")),
                F.struct(F.lit("current").alias("_type"), F.concat(F.lower(F.get(w, 1)), F.lit("@example.org")).alias("DISS_email")),
            ).alias("DISS_contact"),
        )

    return c.select("conv_id", "turn", F.transform(F.split("text", "\n", -1), author).alias("authors"))


def contact_filter(spark: SparkSession, sf: str) -> DataFrame:
    """E-mail of each author line: contacts filtered to type 'current'."""
    a = _conversation_authors(table(spark, sf, "conversations"))
    t = a.select("conv_id", "turn", F.posexplode(F.transform("authors", lambda x: X.author_struct(x, "Example University"))).alias("author_pos", "a"))
    return t.select("conv_id", "turn", "author_pos", F.col("a.email").alias("email"))


def author_array(spark: SparkSession, sf: str) -> DataFrame:
    """Author name parts of each line, cased as in the crosswalk."""
    a = _conversation_authors(table(spark, sf, "conversations"))
    t = a.select("conv_id", "turn", F.posexplode(F.transform("authors", lambda x: X.author_struct(x, "Example University"))).alias("author_pos", "a"))
    return t.select("conv_id", "turn", "author_pos", "a.lname", "a.fname", "a.mname", "a.suffix")


def _part_person(p: DataFrame) -> DataFrame:
    mid = F.when(F.col("p_size") > 25, F.col("p_brand")).when(F.col("p_size") > 10, F.lit(""))
    return p.select("p_partkey", word(F.col("p_name"), 0).alias("f"), mid.alias("m"), word(F.col("p_name"), 1).alias("l"))


def person_names(spark: SparkSession, sf: str) -> DataFrame:
    """Full names from part-name words, skipping empty parts."""
    p = _part_person(table(spark, sf, "part"))
    return p.select("p_partkey", names.full_name(F.col("f"), F.col("m"), F.col("l")).alias("full_name"))


def rights_holder(spark: SparkSession, sf: str) -> DataFrame:
    """First rights holder of two authors (parts glued, absent ones skipped) and the first author's full name."""
    p = _part_person(table(spark, sf, "part"))
    person = lambda last, first, mid, suffix: F.struct(F.struct(last.alias("DISS_surname"), first.alias("DISS_fname"), mid.alias("DISS_middle"), suffix.alias("DISS_suffix")).alias("DISS_name"))
    none = F.lit(None).cast("string")
    authors = F.array(person(F.col("l"), F.col("f"), F.col("m"), F.lit("")), person(F.col("f"), F.when(F.col("m") == "", F.col("l")), F.col("l"), none))
    cased = names.full_name(names.name_part("f"), names.name_part("m"), names.name_part("l"))
    return p.select("p_partkey", names.rights_holder_compat(authors).alias("rights_holder_compat"), cased.alias("rights_holder"))


def advisor_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Advisor display names of the first three lines of each turn (slots present only)."""
    c = table(spark, sf, "conversations")

    def advisor(line):
        w = F.split(line, " ", -1)
        mid = F.when(F.col("role") == "assistant", F.get(w, 1)).otherwise(F.lit(""))
        return F.struct(F.struct(rest(w, 2).alias("DISS_surname"), F.get(w, 0).alias("DISS_fname"), mid.alias("DISS_middle")).alias("DISS_name"))

    adv = F.transform(F.split("text", "\n", -1), advisor)
    return c.select("conv_id", "turn", *[names.advisor_slot(adv, i).alias(f"advisor{i + 1}") for i in range(3)])


# -- field list edits ------------------------------------------------------------------
def _event_fields(e: DataFrame) -> DataFrame:
    base = F.transform_values(F.from_json("props", "map<string,string>"), lambda k, v: F.array(v))
    fields = F.when(F.col("event_type") == "purchase", F.map_concat(base, F.create_map(F.lit("major"), F.array(F.lit("Existing"))))).otherwise(base)
    return e.select("event_id", "event_type", "user_id", fields.alias("fields"))


def _fields_long(df: DataFrame, col: str) -> DataFrame:
    t = df.select("event_id", F.explode(col).alias("name", "values"))
    return t.select("event_id", "name", F.posexplode("values").alias("pos", "value"))


def field_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Field map from event props: value of k and major, presence tests."""
    f = _event_fields(table(spark, sf, "events"))
    return f.select(
        "event_id",
        U.field_value_text(F.col("fields"), "k").alias("k_value"),
        U.field_value_text(F.col("fields"), "major").alias("major_value"),
        U.field_exists(F.col("fields"), "k").alias("has_k"),
        U.field_exists(F.col("fields"), "major").alias("has_major"),
    )


def upsert_field(spark: SparkSession, sf: str) -> DataFrame:
    """Major field added when absent (twice: idempotent), long form."""
    f = _event_fields(table(spark, sf, "events"))
    f = f.withColumn("fields", U.add_field_if_absent(F.col("fields"), "major", F.array(F.col("event_type"))))
    f = f.withColumn("fields", U.add_field_if_absent(F.col("fields"), "major", F.array(F.lit("second call"))))
    return _fields_long(f, "fields")


def set_field(spark: SparkSession, sf: str) -> DataFrame:
    """First value of existing fields overwritten, absent fields untouched, long form."""
    f = _event_fields(table(spark, sf, "events"))
    f = f.withColumn("fields", U.set_field(F.col("fields"), "k", F.col("user_id").cast("string")))
    f = f.withColumn("fields", U.set_field(F.col("fields"), "major", F.lit("Updated")))
    return _fields_long(f, "fields")


# -- document text ------------------------------------------------------------------------
def clean_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts cleaned and split into stripped lines (long form)."""
    d = table(spark, sf, "documents", heavy=True)
    return d.select("doc_id", F.posexplode(text.text_lines("text")).alias("line_no", "line"))


def _labelled_col() -> F.Column:
    """Document text with a major label line put first and last (by language)."""
    label = F.when(F.col("lang") == "en", I.LABEL_BY_LANG["en"]).when(F.col("lang") == "fr", I.LABEL_BY_LANG["fr"]).when(
        F.col("lang") == "es", I.LABEL_BY_LANG["es"]
    )
    value = F.concat(
        F.when(F.col("lang") == "en", F.lit("Materials Science & Engineering")).when(F.col("lang") == "fr", first_line(F.col("text"))).otherwise(F.lit("Nutritional Sciences; Agronomy")),
        F.lit(" ("),
        F.col("source"),
        F.lit(")"),
    )
    return F.when(label.isNull(), F.col("text")).otherwise(F.concat(label, F.lit("Agronomy\n"), F.col("text"), F.lit("\n"), label, value))


def _labelled_text(d: DataFrame) -> DataFrame:
    return d.select("doc_id", _labelled_col().alias("text"))


def label_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Major from labelled lines of whole texts (last one wins), both replacement modes."""
    d = _labelled_text(table(spark, sf, "documents", heavy=True))
    return d.select("doc_id", text.find_major("text", compat=True).alias("major"), text.find_major("text").alias("major_fixed"))


def _major_inputs(p: DataFrame) -> DataFrame:
    opts = [pat for pat, _ in text.MAJOR_REPLACEMENTS] + ["Agronomy"]
    m = F.concat(
        F.element_at(F.array(*[F.lit(o) for o in opts]), (F.col("p_partkey") % len(opts) + 1).cast("int")),
        F.when(F.col("p_size") > 25, F.concat(F.lit(" and "), F.col("p_name"))).otherwise(F.lit("")),
    )
    return p.select("p_partkey", m.alias("major"))


def replace_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Majors through the ordered replacement rules, cascade and whole-value modes."""
    m = _major_inputs(table(spark, sf, "part"))
    return m.select("p_partkey", "major", text.replace_chain("major").alias("replaced_compat"), text.replace_chain("major", compat=False).alias("replaced_fixed"))


def char_map(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with the character repairs applied."""
    d = table(spark, sf, "documents", heavy=True)
    src = F.translate("text", I.CHAR_SOURCE, I.CHAR_TARGET)
    return d.select("doc_id", text.repair_chars(src).alias("repaired"))


# -- candidate lines and best match ------------------------------------------------------
def _ascii_docs(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents", heavy=True)
    return d.select("doc_id", "lang", "source", text.text_lines(text.ascii_folded(F.col("text"))).alias("lines"))


def _line_candidates(spark, sf, min_lines) -> DataFrame:
    d = table(spark, sf, "documents", heavy=True).select("doc_id", text.text_lines("text").alias("lines"))
    c = d.select("doc_id", F.explode(M.line_candidates(F.col("lines"), min_lines)).alias("c"))
    return c.select("doc_id", F.col("c.ord").alias("ord"), F.col("c.text").alias("text"))


def line_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """All line combinations of documents with at least 28 lines (long form)."""
    return _line_candidates(spark, sf, M.MIN_LINES)


def line_candidates_short(spark: SparkSession, sf: str) -> DataFrame:
    """All line combinations with the 4-line setting (long form)."""
    return _line_candidates(spark, sf, 4)


def _keyword_docs(spark, sf) -> DataFrame:
    d = _ascii_docs(spark, sf)
    return d.withColumn("kw", F.translate(F.get(F.col("lines"), 0), *I.VOWEL_SHIFT))


def _best_native(spark, sf, min_lines) -> DataFrame:
    d = _keyword_docs(spark, sf)
    b = d.select("doc_id", M.best_line_native(F.col("lines"), F.col("kw"), min_lines).alias("b"))
    return b.select("doc_id", F.col("b.score").alias("score"), F.col("b.ord").alias("ord"), F.col("b.text").alias("text"))


def best_line_native(spark: SparkSession, sf: str) -> DataFrame:
    """Best line combination for a keyword by the native score (28-line setting)."""
    return _best_native(spark, sf, M.MIN_LINES)


def best_line_native_short(spark: SparkSession, sf: str) -> DataFrame:
    """Best line combination by the native score (4-line setting)."""
    return _best_native(spark, sf, 4)


def _best_ratio(spark, sf, min_lines) -> DataFrame:
    d = table(spark, sf, "documents", heavy=True).select("doc_id", text.text_lines("text").alias("lines"))
    d = d.withColumn("kw", F.translate(F.get(F.col("lines"), 0), *I.VOWEL_SHIFT))
    b = d.select("doc_id", M.best_line_ratio(F.col("lines"), F.col("kw"), min_lines).alias("b"))
    return b.select("doc_id", F.col("b.score").alias("score"), F.col("b.ord").alias("ord"), F.col("b.text").alias("text"))


def best_line_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Best line combination for a keyword by the matching-blocks ratio (28-line setting)."""
    return _best_ratio(spark, sf, M.MIN_LINES)


def best_line_ratio_short(spark: SparkSession, sf: str) -> DataFrame:
    """Best line combination by the matching-blocks ratio (4-line setting)."""
    return _best_ratio(spark, sf, 4)


def ratio_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The matching-blocks ratio of every part's name with its misspelling, its type and both of them."""
    p = table(spark, sf, "part")
    misspelt = F.translate("p_name", *I.VOWEL_SHIFT)
    others = {"misspelt": misspelt, "part_type": F.lower("p_type"), "longer": F.concat_ws(" ", "p_type", misspelt, F.upper("p_name"), "p_name")}
    return p.select("p_partkey", *[fuzzy.ratio_score(F.col("p_name"), o).alias(n) for n, o in others.items()], fuzzy.ratio_score(others["longer"], F.col("p_name")).alias("reversed"))


def nfkd_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts decomposed (NFKD): length and digest."""
    d = table(spark, sf, "documents").select("doc_id", fuzzy.nfkd(F.col("text")).alias("t"))
    return d.select("doc_id", F.length("t").alias("n_chars"), F.md5("t").alias("text_md5"))


# -- authority reconciliation ------------------------------------------------------------
def _authority(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    return p.groupBy(F.col("p_name").alias("authority_name")).agg(F.min("p_partkey").alias("ord"))


def _exact_inputs(p: DataFrame) -> DataFrame:
    m = (
        F.when(F.col("p_size") % 4 == 0, F.upper("p_name"))
        .when(F.col("p_size") % 4 == 1, F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
        .when(F.col("p_size") % 4 == 2, F.concat("p_name", F.lit("s")))
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit("!")))
    )
    return p.select("p_partkey", m.alias("major"))


def _pair_inputs(p: DataFrame) -> DataFrame:
    m = (
        F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit("; "), F.upper("p_name")))
        .when(F.col("p_size") % 3 == 1, F.concat("p_name", F.lit(" ;"), F.col("p_type")))
        .otherwise(F.concat("p_name", F.lit(";"), F.col("p_name"), F.lit(";x")))
    )
    return p.select("p_partkey", m.alias("major"))


def authority_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Part-name variants reconciled against the distinct part names."""
    v = _exact_inputs(table(spark, sf, "part"))
    return M.reconcile(v, "major", _authority(spark, sf)).select("p_partkey", "major", "resolved", "status")


def authority_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Double values 'a; b' reconciled part by part against the distinct part names."""
    v = _pair_inputs(table(spark, sf, "part"))
    return M.reconcile(v, "major", _authority(spark, sf)).select("p_partkey", "major", "resolved", "status")


def authority_top3(spark: SparkSession, sf: str) -> DataFrame:
    """Top-3 authority suggestions for misspelt part names."""
    p = table(spark, sf, "part")
    v = p.select(F.translate("p_name", *I.VOWEL_SHIFT).alias("major"))
    return M.suggestions(v, "major", _authority(spark, sf), k=3)


FUZZY_RATE, FUZZY_CHARS = 0.1, 12
SENTENCE_SPLIT = "[.!?]+[ \n]+"


def _sentences(df: DataFrame, key: str) -> DataFrame:
    t = df.select(key, F.posexplode(F.split(text.ascii_folded(F.col("text")), SENTENCE_SPLIT, -1)).alias("sent_no", "s"))
    return t


def fuzzy_join_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """Every (benchmark sentence, document sentence) pair of sentences of at
    least ``FUZZY_CHARS`` characters that differ in at most ``FUZZY_RATE`` of
    the longer one - whole texts, blocked by shared segments instead of
    comparing all pairs."""
    b = _sentences(table(spark, sf, "benchmark"), "item_id").select(F.struct("item_id", "sent_no").alias("lid"), "s")
    d = _sentences(table(spark, sf, "documents", heavy=True), "doc_id").select(F.struct("doc_id", "sent_no").alias("rid"), F.col("s").alias("r"))
    j = M.fuzzy_join(b, "lid", "s", d, "rid", "r", FUZZY_RATE, FUZZY_CHARS)
    return j.select(
        F.col("lid.item_id").alias("item_id"), F.col("lid.sent_no").alias("item_sent"),
        F.col("rid.doc_id").alias("doc_id"), F.col("rid.sent_no").alias("doc_sent"), "dist",
    )


# -- validation ------------------------------------------------------------------------------
VALIDATION_MIN_LINES = 4
# Fixed example authority list for the quality-control plan.
QC_AUTHORITY = sorted({t for _, t in text.MAJOR_REPLACEMENTS} | {"Agronomy"})


def _record_title(lines_col, lang_col) -> F.Column:
    l0 = F.get(lines_col, 0)
    misspelt = F.concat(F.left(l0, F.length(l0) - 1), F.lit("#"))
    return F.when(lang_col == "en", F.upper(l0)).when(lang_col == "es", F.translate(l0, *I.VOWEL_SHIFT)).when(lang_col == "fr", misspelt).otherwise(l0)


def title_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Record titles against their documents' best line (native score)."""
    d = _ascii_docs(spark, sf).withColumn("title", _record_title(F.col("lines"), F.col("lang")))
    best = M.best_line_native(F.col("lines"), F.col("title"), VALIDATION_MIN_LINES)
    d = d.withColumn("doc_title", F.coalesce(best["text"], F.lit(V.NO_TITLE)))
    return d.select(
        "doc_id",
        "doc_title",
        V.title_valid(F.col("title"), F.col("doc_title")).alias("title_ok"),
        V.title_score(F.col("title"), F.col("doc_title")).alias("score"),
    )


def title_validation_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Record titles against their documents' best line, searched and scored by the matching-blocks ratio."""
    d = _ascii_docs(spark, sf).withColumn("title", _record_title(F.col("lines"), F.col("lang")))
    d = d.withColumn("best", M.best_line_ratio(F.col("lines"), F.col("title"), VALIDATION_MIN_LINES))
    d = d.withColumn("doc_title", F.coalesce(F.col("best.text"), F.lit(V.NO_TITLE)))
    d = d.withColumn("score", V.title_score(F.col("title"), F.col("doc_title"), exact=True))
    return d.select("doc_id", "doc_title", (F.col("score") == 100).alias("title_ok"), "score")


def _conversation_names(c: DataFrame) -> DataFrame:
    c = c.select("conv_id", "turn", "role", F.posexplode(F.split(text.ascii_folded(F.col("text")), "\n", -1)).alias("line_no", "line"))
    line = F.col("line")
    w = F.split(line, " ", -1)
    f = F.when(F.col("role") == "system", F.lower(F.get(w, 0))).otherwise(F.get(w, 0))
    m = F.when(F.col("role") == "assistant", F.get(w, 1)).otherwise(F.lit(""))
    l = (
        F.when(F.col("role") == "user", rest(w, 2))
        .when(F.col("role") == "assistant", rest(w, 1))
        .otherwise(F.get(w, 1))
    )
    return c.select("conv_id", "turn", "line_no", line.alias("doc_author"), f.alias("f"), m.alias("m"), l.alias("l"))


def author_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Author name parts against every line of each turn (name-part rules)."""
    n = _conversation_names(table(spark, sf, "conversations"))
    return n.select("conv_id", "turn", "line_no", V.author_valid(F.col("doc_author"), F.col("f"), F.col("m"), F.col("l")).alias("author_ok"))


# -- quality control plan: validate, reconcile, review -------------------------------------
def _qc_authority(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, i) for i, n in enumerate(QC_AUTHORITY)], "authority_name string, ord long")


def qc_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Target records and document texts (label lines first and last) of all documents."""
    raw = table(spark, sf, "documents", heavy=True)
    key = F.concat("source", F.lit("_"), F.col("doc_id").cast("string")).alias("record_key")
    l1 = F.split(F.coalesce(F.get("lines", 1), F.lit("")), " ", -1)
    author = F.struct(F.coalesce(F.get(l1, 0), F.lit("")).alias("fname"), F.lit("").alias("mname"), F.coalesce(F.get(l1, 1), F.lit("")).alias("lname"))
    lined = raw.withColumn("lines", text.text_lines(text.ascii_folded(F.col("text"))))  # once for title and author
    records = lined.select(key, _record_title(F.col("lines"), F.col("lang")).alias("title"), F.struct(F.array(author).alias("author")).alias("authors"))
    return records, raw.select(key, text.ascii_folded(_labelled_col()).alias("text"))


def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Failed title, author and major checks of records against their documents."""
    from . import quality as Q

    records, documents = qc_inputs(spark, sf)
    q = V.review_queue(Q.check_records(records, documents, _qc_authority(spark), VALIDATION_MIN_LINES))
    return q.withColumn("suggestions", F.array_join("suggestions", " | "))


# -- corrections and reports ----------------------------------------------------------------
def _qc_records(spark, sf) -> DataFrame:
    d = _ascii_docs(spark, sf)
    """Title: the first line; authors: every further line (first name, last name, the rest middle)."""
    author = lambda w: F.struct(F.coalesce(F.get(w, 0), F.lit("")).alias("fname"), rest(w, 2).alias("mname"), F.coalesce(F.get(w, 1), F.lit("")).alias("lname"))
    authors = F.transform(F.slice(F.col("lines"), 2, F.greatest(F.size("lines"), F.lit(1))), lambda l: text.let(F.split(l, " ", -1), author))  # split once
    entry = lambda n, v: F.struct(F.lit(n).alias("_name"), F.lit("string").alias("_type"), F.array(F.lit(v)).alias("value"))
    return d.select(
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string")).alias("record_key"),
        "doc_id",
        "lang",
        _record_title(F.col("lines"), F.col("lang")).alias("title"),
        F.struct(authors.alias("author")).alias("authors"),
        F.struct(F.when(F.col("lang") == "de", F.array(entry("rights_holder", "glued"), entry("major", "Existing"))).otherwise(F.array(entry("rights_holder", "glued"))).alias("field")).alias("fields"),
        "lines",
    )


def _qc_corrections(records: DataFrame) -> DataFrame:
    """A reviewer's answers: new titles for Spanish records, new names for
    French ones (middle name answered ``None``: keep the old one), majors for
    all but Spanish ones (a double one for French)."""
    a0 = F.get(F.col("authors.author"), 0)
    return records.select(
        "record_key",
        F.when(F.col("lang") == "es", text.py_strip(F.get(F.col("lines"), 0))).alias("title"),
        F.when(F.col("lang") == "fr", a0["lname"]).alias("fname"),
        F.when(F.col("lang") == "fr", F.lit("None")).alias("mname"),
        F.when(F.col("lang") == "fr", a0["fname"]).alias("lname"),
        F.when(F.col("lang") == "fr", F.lit("Agronomy; Physics")).when(F.col("lang") != "es", F.lit("Agronomy")).alias("major"),
    )


def apply_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """A reviewer's corrections applied to records (first author only)."""
    r = _qc_records(spark, sf)
    out = U.apply_corrections(r.select("record_key", "doc_id", "title", "authors", "fields"), _qc_corrections(r))
    a0, a1 = F.get(F.col("authors.author"), 0), F.get(F.col("authors.author"), 1)
    return out.select("record_key", "title", a0["fname"].alias("fname"), a0["mname"].alias("mname"), a0["lname"].alias("lname"),
                      a1["lname"].alias("second_lname"), F.size("authors.author").alias("n_authors"), F.md5(F.array_join(F.transform("authors.author", lambda a: names.full_name(a["fname"], a["mname"], a["lname"])), "|")).alias("authors_md5"), _field_value("rights_holder").alias("rights_holder"))


def major_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Majors, single and double, written into the records' fields (long form)."""
    r = _qc_records(spark, sf)
    out = U.apply_corrections(r.select("record_key", "title", "authors", "fields"), _qc_corrections(r))
    f = out.select("record_key", F.posexplode("fields.field").alias("field_pos", "f"))
    return f.select("record_key", "field_pos", F.col("f._name").alias("name"), F.array_join("f.value", "|").alias("field_values"))


def error_report(spark: SparkSession, sf: str) -> DataFrame:
    """Records with a correction: original title and author next to the corrections."""
    from . import quality as Q

    r = _qc_records(spark, sf)
    return Q.error_report(r, _qc_corrections(r))


def error_report_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The error report written as CSV and read back."""
    out = scratch_path(spark, "error-report")
    files.write_error_report(error_report(spark, sf), out)
    back = spark.read.option("header", "true").csv(out)
    return back.select("file", *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "title_correction", "author", "author_correction")])


def error_report_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The error report with its running row number, in order of the file."""
    report = error_report(spark, sf)
    return with_row_index(report, list(report.columns))


def correction_log(spark: SparkSession, sf: str) -> DataFrame:
    """Records after a log of corrections of their document's lines, up to a number: every
    line is a correction (title, name parts or major by its number), some delivered twice."""
    r = written(_qc_records(spark, sf).select("record_key", "title", "authors", "fields", "lines"), "records")  # shaped once for both sides
    lines = r.select("record_key", F.posexplode("lines").alias("seq", "line"))
    w = F.split("line", " ", -1)
    when = lambda k, v: F.when(F.col("seq") % 5 == k, v)
    log = lines.select(
        "record_key", "seq", when(0, F.col("line")).alias("title"), when(1, F.get(w, 0)).alias("fname"),
        F.when(F.col("seq") % 5 == 2, F.get(w, 1)).when(F.col("seq") % 5 == 3, F.lit("None")).alias("mname"),
        when(3, F.get(w, 0)).alias("lname"), when(4, F.concat_ws("; ", F.get(w, 0), F.get(w, 1))).alias("major"),
    )
    log = log.unionByName(log.filter(F.col("seq") % 3 == 0))  # delivered again
    out = U.apply_correction_log(r.select("record_key", "title", "authors", "fields"), log, as_of=LOG_AS_OF)
    a0 = F.get(F.col("authors.author"), 0)
    major = F.get(F.filter(F.col("fields.field"), lambda f: f["_name"] == "major"), 0)["value"]
    return out.select("record_key", "title", a0["fname"].alias("fname"), a0["mname"].alias("mname"), a0["lname"].alias("lname"), _field_value("rights_holder").alias("rights_holder"), F.array_join(major, "|").alias("majors"))


LOG_AS_OF = 40


def authority_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Part names and types written as a headless CSV list and scanned as an authority list."""
    out = scratch_path(spark, "authority")
    p = table(spark, sf, "part")
    p.select(F.concat("p_name", F.lit(", "), "p_type")).distinct().write.csv(out)
    return files.read_authority_csv(spark, out).select("authority_name")


# -- record <-> document pairing, merge ---------------------------------------------------------
def _record_files(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    path = F.concat(F.lit("/XML-Transformed/doc_"), F.col("doc_id").cast("string"), F.lit("_DATA-out.xml"))
    return d.select("doc_id", text.record_key_from_path(path).alias("pdf_name"))


def _document_files(spark, sf) -> DataFrame:
    lab = table(spark, sf, "labels")
    return lab.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("pdf_name"), "quality")


def record_document_join(spark: SparkSession, sf: str) -> DataFrame:
    """Records paired with their document files (left join)."""
    r, f = _record_files(spark, sf), _document_files(spark, sf)
    j = r.join(f, "pdf_name", "left")
    return j.select("doc_id", "pdf_name", F.col("quality").isNotNull().alias("has_document"), "quality")


def unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Records without a document file and document files without a record."""
    r, f = _record_files(spark, sf), _document_files(spark, sf)
    a = r.join(f, "pdf_name", "left_anti").select("pdf_name", F.lit("record_without_document").alias("side"))
    b = f.join(r, "pdf_name", "left_anti").select("pdf_name", F.lit("document_without_record").alias("side"))
    return a.unionByName(b)


SKIP = 27


def merge_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two record batches merged, every record kept."""
    from ..sources.records import merge_batches as merge

    d = table(spark, sf, "documents")
    rec = d.select(
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string")).alias("record_key"),
        "lang",
        text.title_field("text").alias("title"),
    )
    a = rec.filter(F.col("lang").isin("en", "fr")).drop("lang")
    b = rec.filter(~F.col("lang").isin("en", "fr")).drop("lang")
    return merge([a, b])


def skip_records(spark: SparkSession, sf: str) -> DataFrame:
    """A batch whose keys repeat (the document's source), without its first 27 records."""
    from ..sources.records import merge_batches as merge

    d = table(spark, sf, "documents")
    return merge([d.select(F.col("source").alias("record_key"), text.title_field("text").alias("title"))], skip=SKIP)


def merge_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Two record batches merged and sorted by the first author's name."""
    from ..sources.records import merge_batches as merge

    r = _qc_records(spark, sf).select("record_key", "lang", "title", "authors")
    out = merge([r.filter(F.col("lang") == "en"), r.filter(F.col("lang") != "en")], sort_by_name=True)
    a0 = F.get(F.col("authors.author"), 0)
    return out.select("record_key", "title", a0["lname"].alias("lname"), a0["fname"].alias("fname"))


BATCH_SIZE = 100


def upload_batches(spark: SparkSession, sf: str) -> DataFrame:
    """All records by the first author's name in upload batches of exactly ``BATCH_SIZE``: batch and position of each."""
    from ..sources.records import upload_batches as batches

    r = _qc_records(spark, sf).select("record_key", "title", "authors")
    return batches(r, BATCH_SIZE).select("record_key", "batch", "position")


def record_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Files of documents as source records, some of them planted broken, read back:
    each file's good records and the reasons of its rejects."""
    from ..sources.records import SOURCE_ROW_TAG as tag
    from ..sources.records import accepted_and_rejects

    folder = scratch_path(spark, "deliveries")
    kind = F.col("doc_id") % 8
    title = F.md5("text")
    body = lambda end: F.concat(F.lit(f"<{tag}><DISS_description><DISS_title>"), title, F.lit(f"</{end}></DISS_description></{tag}>"))
    line = F.when(kind == 3, body("DISS_titel")).when(kind == 5, F.concat(F.lit("<other>"), title, F.lit("</other>"))).when(kind == 6, F.lit(f"<{tag}/>")).otherwise(body("DISS_title"))
    d = table(spark, sf, "documents").select(F.concat("source", F.lit("_"), kind.cast("string")).alias("file"), F.lit(1).alias("place"), line.alias("value"))
    ends = d.select("file").distinct().select("file", F.explode(F.array(F.struct(F.lit(0).alias("place"), F.lit("<deliveries>").alias("value")), F.struct(F.lit(2).alias("place"), F.lit("</deliveries>").alias("value")))).alias("e"))
    whole = d.unionByName(ends.select("file", "e.*")).repartition("file").sortWithinPartitions("file", "place").drop("place")
    whole.write.partitionBy("file").text(folder)
    good, bad = accepted_and_rejects(spark, f"{folder}/*")
    file = F.regexp_extract("path", "file=([^/]*)/", 1).alias("file")
    told = good.select(file, F.col("DISS_description.DISS_title").alias("title"), F.lit(None).cast("string").alias("reason")).unionByName(bad.select(file, F.lit(None).cast("string").alias("title"), "reason"))
    return told.groupBy("file").agg(F.count("title").alias("n_records"), F.min("title").alias("first_title"), F.max("title").alias("last_title"), F.max("reason").alias("reason"))


def contains_automaton(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of whole texts through one automaton of all rules made of part types and names."""
    rules = _name_rules(spark, sf)
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return d.select("doc_id", "line_no", R.contains_automaton(spark, F.lower("line"), R.contains_rules_from_df(rules)).alias("target"))


def _name_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Contains rules: the first three letters of each two words that a part's name and type have, by first part."""
    p = table(spark, sf, "part")
    word_ = lambda c: F.substring(F.lower(F.get(F.split(c, " "), 0)), 1, 3)
    pairs = p.groupBy(word_("p_name").alias("a"), word_("p_type").alias("b")).agg(F.min("p_partkey").cast("int").alias("ord"))
    return pairs.select("ord", F.array("a", F.substring("b", 1, 2)).alias("parts"), F.concat_ws("+", "a", "b").alias("target"))


def rule_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Faults of rule tables made from parts, one row a faulty rule with its cause: contains rules that an
    earlier one hides, and rules of a one-to-one map that are chained or on cycles."""
    p = table(spark, sf, "part")
    stem = F.substr(F.lower("p_name"), F.lit(1), (F.col("p_partkey") % 5 + 2).cast("int"))
    long_ = p.select(F.col("p_partkey").cast("int").alias("ord"), F.array(stem, F.concat_ws("-", "p_brand", F.col("p_size").cast("string"))).alias("parts"), F.lit("").alias("target"))
    hidden = R.audit_contains(long_).select(F.lit("hidden").alias("kind"), F.col("ord").cast("string").alias("rule"), F.col("by_ord").cast("string").alias("cause"), F.lit(None).cast("long").alias("steps"))
    key = lambda c: F.concat(F.lit("k"), c.cast("string"))
    n = F.col("p_size") * 41 + F.col("p_partkey") % 37
    mapped = p.select(key(F.col("p_partkey")).alias("key"), key(F.when(F.col("p_partkey") % 4 == 0, F.col("p_partkey") + 4 - F.when(F.col("p_partkey") % 28 == 0, 28).otherwise(0)).otherwise(n)).alias("target"))
    return hidden.unionByName(R.audit_map(mapped).select("kind", F.col("key").alias("rule"), F.col("end").alias("cause"), "steps"))


# -- XML round trip: source records -> crosswalk -> target batch ---------------------------------
def source_records_from_documents(d: DataFrame) -> DataFrame:
    """Shape documents into source records (``DISS_submission`` rows) that
    take every branch of the crosswalk: one or two authors, with and without
    suffix and e-mail, none to three advisors, mapped and unmapped subjects,
    degrees and departments, and all embargo cases."""
    i = F.col("doc_id")
    lines = F.split("text", "\n", -1)
    l0 = F.get(lines, 0)
    w = F.split(F.coalesce(F.get(lines, 1), F.lit("")), " ", -1)
    title = F.when(F.col("lang").isin("fr", "de"), F.upper(F.replace(l0, F.lit("ß"), F.lit("ss")))).otherwise(l0)
    none = F.lit(None).cast("string")

    def name(last, first, middle, suffix):
        return F.struct(last.alias("DISS_surname"), first.alias("DISS_fname"), middle.alias("DISS_middle"), suffix.alias("DISS_suffix")).alias("DISS_name")

    def contact(kind, mail):
        return F.struct(F.lit(kind).alias("_type"), mail.alias("DISS_email"))

    mail = F.concat(F.col("source"), F.lit("@example.org"))
    first = F.struct(name(F.get(w, 0), F.get(w, 1), F.coalesce(F.get(w, 2), F.lit("")), F.when(i % 5 == 0, F.lit("jr")).otherwise("")), F.array(contact("current", mail), contact("current", none), contact("future", F.lit("later@example.org"))).alias("DISS_contact"))
    second = F.struct(name(F.col("source"), F.col("lang"), none, none), F.array(contact("future", mail)).alias("DISS_contact"))

    def advisor(f, m, l):
        return F.struct(F.struct(l.alias("DISS_surname"), f.alias("DISS_fname"), m.alias("DISS_middle")).alias("DISS_name"))

    advisors = F.array(advisor(F.get(w, 0), F.lit(""), F.get(w, 1)), advisor(F.col("lang"), F.col("source"), F.get(w, 0)), advisor(F.col("source"), none, F.col("lang")))
    accept = F.concat((i % 12 + 1).cast("string"), F.lit("/"), (i % 28 + 1).cast("string"), F.lit("/2019"))
    desc = F.struct(
        (F.col("n_chars") / 100).cast("long").cast("string").alias("_page_count"),
        F.when(F.col("lang") == "en", "doctoral").when(F.col("lang") == "de", "Masters").otherwise("report").alias("_type"),
        title.alias("DISS_title"),
        F.struct(accept.alias("DISS_accept_date"), (2000 + i % 20).cast("string").alias("DISS_comp_date")).alias("DISS_dates"),
        F.array(l0, F.lit("Ph.D.")).alias("DISS_degree"),
        F.struct(F.array(F.when(F.col("lang") == "es", F.concat("source", F.lit(" & partners"))).otherwise(F.col("source"))).alias("DISS_inst_contact")).alias("DISS_institution"),
        F.slice(advisors, 1, (i % 4).cast("int")).alias("DISS_advisor"),
        F.struct(
            F.array(F.struct(F.array("lang", "source").alias("DISS_cat_desc"))).alias("DISS_category"),
            F.array(F.translate(l0, ".", ";")).alias("DISS_keyword"),
            F.array("lang").alias("DISS_language"),
        ).alias("DISS_categorization"),
    )
    content = F.struct(
        F.array(F.struct(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))).alias("DISS_para"))).alias("DISS_abstract"),
        F.concat("source", F.lit("_"), i.cast("string"), F.lit(".pdf")).alias("DISS_binary"),
    )
    case = i % 4
    repo = F.struct(
        F.when(case == 0, "0").when(case == 3, "").otherwise("1").alias("DISS_acceptance"),
        F.when(case == 1, "No, 1 year delayed release").otherwise("").alias("DISS_access_option"),
        F.when((case == 1) & (i % 3 == 0), "not a date").when(case == 1, "2019-02-03 10:11:12").otherwise("").alias("DISS_agreement_decision_date"),
        F.when(case == 2, "2021-05-06T00:00").otherwise("").alias("DISS_delayed_release"),
    )
    limit = F.struct(F.when(i % 8 == 0, "0").otherwise("x").alias("_VALUE"), F.lit("1").alias("_code"), F.lit("3/4/2020").alias("_remove"))
    restr = F.struct(F.when(case == 0, F.array(limit)).otherwise(F.array().cast("array<struct<_VALUE:string,_code:string,_remove:string>>")).alias("DISS_sales_restriction"))
    return d.select(
        F.concat("source", F.lit("_"), i.cast("string")).alias("record_key"),
        F.struct(F.when(i % 3 == 0, F.array(first, second)).otherwise(F.array(first)).alias("DISS_author")).alias("DISS_authorship"),
        desc.alias("DISS_description"),
        content.alias("DISS_content"),
        restr.alias("DISS_restriction"),
        repo.alias("DISS_repository"),
    )


def crosswalk_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write source records as XML files, scan them back with the fixed
    schema, crosswalk, write the target batch as XML, read it back, and
    return one flat row per record."""
    from ..sources import records as S

    src_dir, out_dir = scratch_path(spark, "source-xml"), scratch_path(spark, "target-xml")
    src = source_records_from_documents(table(spark, sf, "documents", heavy=True))
    (src.write.format("xml").option("rootTag", "deliveries").option("rowTag", S.SOURCE_ROW_TAG).mode("overwrite").save(src_dir))
    back = S.read_source_records(spark, src_dir)
    back = back.withColumn("record_key", F.concat(F.col("DISS_content.DISS_binary")))
    target = X.crosswalk(back, _crosswalk_config(), keep=["record_key"])
    target = target.drop("_errors")
    S.write_target_records(target, out_dir)
    t = S.read_target_records(spark, out_dir, schema=target.schema)
    # XML does not keep empty apart from absent: read-side NULLs become ''
    # / empty arrays, the crosswalk's own boundary rule; blanks around a
    # paragraph are not compared
    a0 = F.get(F.coalesce(F.col("authors.author"), F.array()), 0)
    s = lambda c: F.coalesce(c, F.lit(""))
    texts = lambda c: F.array_join(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.trim(s(x))), "|")
    return t.select(
        F.col("`fulltext-url`").alias("fulltext_url"),
        s(F.col("title")).alias("title"),
        F.col("`publication-date`").alias("publication_date"),
        F.col("`document-type`").alias("document_type"),
        a0["_xsi:type"].alias("author_type"),
        s(a0["lname"]).alias("lname"),
        s(a0["fname"]).alias("fname"),
        F.size("authors.author").alias("n_authors"),
        texts("disciplines.discipline").alias("disciplines"),
        texts("keywords.keyword").alias("keywords"),
        texts("abstract.p").alias("abstract"),
        F.col("degree_name").cast("string").alias("degree_name"),
        F.col("department").cast("string").alias("department"),
        F.array_join(F.transform("fields.field", lambda f: F.concat(f["_name"], F.lit("="), s(F.get(f["value"], 0)))), "|").alias("field_list"),
    )


# -- document text from pages -------------------------------------------------------------------
LINES_PER_PAGE = 5


def document_first_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages (every ``LINES_PER_PAGE`` lines of a document, each line ending
    with a line break) -> the text of the first 11 pages per record."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("record_key"), F.split("text", "\n", -1).alias("lines"))
    starts = F.sequence(F.lit(1), F.size("lines"), F.lit(LINES_PER_PAGE))
    page = lambda i: F.array_join(F.transform(F.slice(F.col("lines"), i, F.lit(LINES_PER_PAGE)), lambda l: F.concat(l, F.lit("\n"))), "")
    pages = d.select("record_key", F.posexplode(F.transform(starts, page)).alias("page_no", "text"))
    return files.document_text(pages, max_pages=11)


def _crosswalk_config() -> X.CrosswalkConfig:
    return X.CrosswalkConfig(subjects=SUBJECT_RULES, degrees=DEGREE_RULES, departments=DEPARTMENT_RULES)


def _field_value(name: str) -> F.Column:
    hit = F.filter(F.col("fields.field"), lambda f: f["_name"] == name)
    return F.get(F.get(hit, 0)["value"], 0)


def crosswalk_records(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-record crosswalk (P1) of records shaped from documents, with the
    target record flattened to one row of fields."""
    src = source_records_from_documents(table(spark, sf, "documents", heavy=True))
    t = X.crosswalk(src, _crosswalk_config(), keep=["record_key"])
    a0, a1 = F.get(F.col("authors.author"), 0), F.get(F.col("authors.author"), 1)
    return t.select(
        "record_key",
        "title",
        F.col("`publication-date`").alias("publication_date"),
        F.col("`document-type`").alias("document_type"),
        F.size("authors.author").alias("n_authors"),
        a0["lname"].alias("lname"),
        a0["fname"].alias("fname"),
        a0["mname"].alias("mname"),
        a0["suffix"].alias("suffix"),
        a0["email"].alias("email"),
        F.array_join("disciplines.discipline", "|").alias("disciplines"),
        F.array_join("keywords.keyword", "|").alias("keywords"),
        F.array_join("abstract.p", "|").alias("abstract"),
        F.col("`fulltext-url`").alias("fulltext_url"),
        "degree_name",
        "department",
        _field_value("embargo_date").alias("embargo_date"),
        _field_value("rights_holder").alias("rights_holder"),
        _field_value("file_size").alias("file_size"),
        *[_field_value(n).alias(n) for n in ("advisor1", "advisor2", "advisor3", "language", "copyright_date", "provenance", "fileformat")],
        a0["institution"].alias("institution"),
        a1["lname"].alias("lname2"),
        a1["suffix"].alias("suffix2"),
        a1["email"].alias("email2"),
        F.size("fields.field").alias("n_fields"),
        F.col("_errors").alias("errors"),
    )
