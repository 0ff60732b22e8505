"""The crosswalk: one source record (``DISS_submission``) -> one target
record (``document``), as a single ``select`` of nested columns.

No shuffle: every field is an expression over the record's own columns and
its (small, per-record) arrays.  Rule tables come from ``CrosswalkConfig``
as literal maps / ``CASE`` expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, names, text
from . import rules as R

# Read schema of a source record: every path the crosswalk reads.  Fixed and
# explicit - inference would turn ``page_count="007"`` into a number and a
# single author into a struct instead of an array.
SOURCE_SCHEMA = """
DISS_authorship struct<DISS_author:array<struct<
    DISS_name:struct<DISS_surname:string,DISS_fname:string,DISS_middle:string,DISS_suffix:string>,
    DISS_contact:array<struct<_type:string,DISS_email:string>>>>>,
DISS_description struct<_page_count:string,_type:string,DISS_title:string,
    DISS_dates:struct<DISS_accept_date:string,DISS_comp_date:string>,
    DISS_degree:array<string>,
    DISS_institution:struct<DISS_inst_contact:array<string>>,
    DISS_advisor:array<struct<DISS_name:struct<DISS_surname:string,DISS_fname:string,DISS_middle:string>>>,
    DISS_categorization:struct<DISS_category:array<struct<DISS_cat_desc:array<string>>>,
                               DISS_keyword:array<string>,DISS_language:array<string>>>,
DISS_content struct<DISS_abstract:array<struct<DISS_para:array<string>>>,DISS_binary:string>,
DISS_restriction struct<DISS_sales_restriction:array<struct<_VALUE:string,_code:string,_remove:string>>>,
DISS_repository struct<DISS_acceptance:string,DISS_access_option:string,
                       DISS_agreement_decision_date:string,DISS_delayed_release:string>
""".replace("\n", " ")

FIELD_TYPE = "struct<_name:string,_type:string,value:array<string>>"


@dataclass
class CrosswalkConfig:
    """Site settings and rule tables.  The defaults are small example rule
    sets; a site loads its full tables (``rules.load_rules_csv``)."""

    institution: str = "Example University"
    fulltext_prefix: str = "https://repository.example.org/uploads/"
    provenance: str = "Received from the submission service"
    subjects: dict[str, list[str]] = field(default_factory=dict)
    degrees: list[R.ContainsRule] = field(default_factory=list)
    departments: dict[str, str] = field(default_factory=dict)
    markup: list[tuple[str, str]] = field(default_factory=lambda: list(text.ABSTRACT_MARKUP))
    compat_title: bool = False  # keep the raw all-capital title in front of the cased one
    max_advisors: int = 3  # the original emits two because of a typo in the third test
    longest_degree_match: bool = False


def _s(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _field(name: str, typ: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("_name"), F.lit(typ).alias("_type"), F.array(value).alias("value"))


def author_struct(a: Column, institution: str) -> Column:
    n = a["DISS_name"]
    email = F.array_join(
        F.transform(F.filter(F.coalesce(a["DISS_contact"], F.array()), lambda c: (c["_type"] == "current") & c["DISS_email"].isNotNull()), lambda c: c["DISS_email"]),
        " ",
    )
    return F.struct(
        F.lit("individual").alias("_xsi:type"),
        email.alias("email"),
        F.lit(institution).alias("institution"),
        names.name_part(n["DISS_surname"]).alias("lname"),
        names.name_part(n["DISS_fname"]).alias("fname"),
        names.name_part(n["DISS_middle"]).alias("mname"),
        names.suffix_part(n["DISS_suffix"]).alias("suffix"),
    )


def crosswalk_columns(cfg: CrosswalkConfig) -> list[Column]:
    d = F.col("DISS_description")
    authors = F.coalesce(F.col("DISS_authorship.DISS_author"), F.array())
    cats = F.flatten(
        F.transform(F.coalesce(d["DISS_categorization"]["DISS_category"], F.array()), lambda c: F.coalesce(c["DISS_cat_desc"], F.array().cast("array<string>")))
    )
    keywords = F.flatten(F.transform(F.coalesce(d["DISS_categorization"]["DISS_keyword"], F.array().cast("array<string>")), text.split_keywords))
    paras = F.flatten(
        F.transform(F.coalesce(F.col("DISS_content.DISS_abstract"), F.array()), lambda a: F.coalesce(a["DISS_para"], F.array().cast("array<string>")))
    )
    degrees = F.array_join(
        F.transform(F.coalesce(d["DISS_degree"], F.array().cast("array<string>")), lambda x: R.ordered_contains(x, cfg.degrees, cfg.longest_degree_match)), ""
    )
    depts = F.array_join(
        F.transform(F.coalesce(d["DISS_institution"]["DISS_inst_contact"], F.array().cast("array<string>")), lambda x: R.exact_map(x, cfg.departments)), ""
    )
    repo = F.col("DISS_repository")
    embargo = dates.embargo_date(
        repo["DISS_acceptance"],
        F.col("DISS_restriction.DISS_sales_restriction"),
        repo["DISS_access_option"],
        repo["DISS_agreement_decision_date"],
        repo["DISS_delayed_release"],
    )
    advisors = F.coalesce(d["DISS_advisor"], F.array())
    advisor_fields = [
        F.when(F.size(advisors) > i, _field(f"advisor{i + 1}", "string", names.advisor_slot(advisors, i))) for i in range(cfg.max_advisors)
    ]
    fields = F.filter(
        F.array(
            _field("language", "string", F.array_join(F.coalesce(d["DISS_categorization"]["DISS_language"], F.array().cast("array<string>")), " ")),
            _field("provenance", "string", F.lit(cfg.provenance)),
            _field("copyright_date", "string", _s(d["DISS_dates"]["DISS_comp_date"])),
            _field("embargo_date", "date", embargo["value"]),
            _field("file_size", "string", F.concat(_s(d["_page_count"]), F.lit(" pages"))),
            _field("fileformat", "string", F.lit("application/pdf")),
            _field("rights_holder", "string", names.rights_holder_compat(authors)),
            *advisor_fields,
        ),
        lambda f: f.isNotNull(),
    )
    return [
        text.title_field(d["DISS_title"], compat=cfg.compat_title).alias("title"),
        dates.mdy_to_iso(d["DISS_dates"]["DISS_accept_date"]).alias("publication-date"),
        F.lit("YYYY-MM-DD").alias("publication_date_date_format"),
        F.struct(F.transform(authors, lambda a: author_struct(a, cfg.institution)).alias("author")).alias("authors"),
        F.struct((R.one_to_many_array(cats, cfg.subjects) if cfg.subjects else cats).alias("discipline")).alias("disciplines"),
        F.struct(keywords.alias("keyword")).alias("keywords"),
        F.struct(text.abstract_paragraphs(paras, cfg.markup).alias("p")).alias("abstract"),
        F.concat(F.lit(cfg.fulltext_prefix), _s(F.col("DISS_content.DISS_binary"))).alias("fulltext-url"),
        text.doc_type(d["_type"]).alias("document-type"),
        degrees.alias("degree_name"),
        depts.alias("department"),
        F.lit("html").alias("abstract_format"),
        F.struct(fields.alias("field")).alias("fields"),
        embargo["error"].alias("_errors"),
    ]


def crosswalk(records: DataFrame, cfg: CrosswalkConfig | None = None, keep: list[str] | None = None) -> DataFrame:
    """Map source records to target records.  ``keep`` columns (e.g. the
    record key) are carried through in front."""
    cfg = cfg or CrosswalkConfig()
    keep = keep or []
    return records.select(*[F.col(k) for k in keep], *crosswalk_columns(cfg))
