"""Fixed schemas of every source, in DDL; nothing is inferred."""

from __future__ import annotations

DATES = "STRUCT<`date-parts`: ARRAY<ARRAY<INT>>>"
JOURNAL = (
    "key STRING, name STRING, short STRING, publisher STRING, abs STRING, url STRING, base STRING, note STRING, addedBy STRING, retiredDate STRING, retiredReason STRING, "
    "issns ARRAY<STRING>, aia BOOLEAN, editors BOOLEAN, seEditors BOOLEAN, aeEditors BOOLEAN, retired BOOLEAN, limitedCoverage BOOLEAN, notFT BOOLEAN"
)
WORK = (
    "DOI STRING, type STRING, volume STRING, issue STRING, page STRING, abstract STRING, title ARRAY<STRING>, "
    "author ARRAY<STRUCT<given: STRING, family: STRING, name: STRING, ORCID: STRING, affiliation: ARRAY<STRUCT<name: STRING>>>>, "
    f"issued {DATES}, `published-print` {DATES}, `published-online` {DATES}, created {DATES}, "
    "`group-title` STRING, subject ARRAY<STRING>, assertion ARRAY<STRUCT<label: STRING, name: STRING, value: STRING>>, `is-referenced-by-count` BIGINT"
)
ENVELOPE = (f"message STRUCT<items: ARRAY<STRUCT<{WORK}>>, `total-results`: BIGINT, `next-cursor`: STRING>")
PAPER = (
    "jkey STRING, journal STRING, src_ord BIGINT, ord BIGINT, title STRING, authors ARRAY<STRING>, orcids ARRAY<STRING>, affiliations ARRAY<STRING>, doi_key STRING, volume STRING, issue STRING, page STRING, "
    "year STRING, status STRING, abstract STRING, editor STRING, area STRING, senior_editor STRING, associate_editor STRING, cited_by BIGINT, cited_src STRING, preprint STRING, preprint_src STRING, pub_rank BIGINT"
)
FIXUPS = ("volume STRING, issue STRING, page STRING, year STRING")
SUPPLEMENT = ("jkey STRING, Title STRING, Authors STRING, Affiliations STRING, Abstract STRING, Year STRING")
EDITORS = ("se STRING, ae STRING")
OVERRIDES = ("editor STRING, area STRING")
PREPRINTS = ("u STRING, s STRING, none INT, ts INT")
CITATIONS = ("c BIGINT, t INT, s2 INT")
REGISTRY = ("reg_key STRING, first_seen DATE")
SEARCH_HIT = (
    "doi STRING, title STRING, publication_year INT, authorships ARRAY<STRUCT<author: STRUCT<display_name: STRING>>>, locations ARRAY<STRUCT<landing_page_url: STRING, pdf_url: STRING>>, "
    "best_oa_location STRUCT<landing_page_url: STRING, pdf_url: STRING>, primary_location STRUCT<landing_page_url: STRING, pdf_url: STRING>, open_access STRUCT<oa_url: STRING>, cited_by_count BIGINT"
)
WORK_HIT = "DOI STRING, title ARRAY<STRING>, author ARRAY<STRUCT<family: STRING>>, issued STRUCT<`date-parts`: ARRAY<ARRAY<INT>>>"
COUNTS = ("citationCount BIGINT")
PAPER_COLUMNS = [x.split()[0] for x in PAPER.split(", ")]
