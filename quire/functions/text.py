"""Scalar rules of bibliographic text, as Column -> Column functions that stay in generated JVM code.

A blank string and null mean the same, "missing", throughout; results are '' where a rule says "missing" in text.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the web's string functions define it (Java's \s lacks NBSP, BOM and the U+2000s).
WS = r"[\t\n\x0B\f\r    -     　﻿]"
#: ASCII word edges; Java's \b knows Unicode letters.
EDGE_L, EDGE_R = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"


def _fold_tables() -> tuple[str, str]:
    """Characters whose decomposition without combining marks (U+0300 to U+036F) is one other character, and what they
    become; then the marks themselves, which translate() deletes for want of a counterpart."""
    source, target = [], []
    for c in map(chr, range(0xA0, 0x30000)):
        if 0x300 <= ord(c) <= 0x36F or unicodedata.category(c) in ("Cs", "Cn", "Co"):
            continue
        bare = "".join(x for x in unicodedata.normalize("NFD", c) if not 0x300 <= ord(x) <= 0x36F)
        if len(bare) == 1 and bare != c:
            source.append(c)
            target.append(bare)
    return "".join(source) + "".join(map(chr, range(0x300, 0x370))), "".join(target)


FOLD_FROM, FOLD_TO = _fold_tables()


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def or_blank(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def first_given(*xs: Column) -> Column:
    """The first that is not missing, else ''."""
    return F.coalesce(*[blank_to_null(x) for x in xs], F.lit(""))


def squeeze(x: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(x, WS + "+", " "))


def strip_markup(x: Column) -> Column:
    """Tags to spaces; &lt; and &gt;, then &amp; decoded once; white space squeezed."""
    plain = F.regexp_replace(or_blank(x), "<[^>]+>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return squeeze(plain)


def strip_accents(x: Column) -> Column:
    return F.translate(or_blank(x), FOLD_FROM, FOLD_TO)


def norm_name(x: Column) -> Column:
    return F.lower(strip_accents(x))


def norm_title(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(or_blank(x)), "[^a-z0-9]+", " "))


def match_norm(x: Column) -> Column:
    return F.regexp_replace(strip_accents(F.lower(or_blank(x))), "[^a-z0-9]", "")


def prefix_int(x: Column) -> Column:
    """The integer that a string begins with, else 0."""
    return F.coalesce(F.regexp_extract(or_blank(x.cast("string")), rf"^{WS}*([+-]?[0-9]+)", 1).try_cast("bigint"), F.lit(0))


def pub_rank(year: Column, volume: Column, issue: Column, page: Column, status: Column) -> Column:
    """Order of publication: advance articles first, then year, volume, issue and page."""
    first_page = F.element_at(F.split(or_blank(page), "[-–]"), 1)
    ahead = F.when(or_blank(status) != "", F.lit(10**13)).otherwise(F.lit(0))
    capped = [F.least(prefix_int(x), F.lit(999)) for x in (issue, first_page)]
    return ahead + prefix_int(year) * 10**9 + prefix_int(volume) * 10**6 + capped[0] * 1000 + capped[1]


ADVANCE = "Articles in Advance"


def forthcoming_status(volume: Column, issue: Column, year: Column, pull_year: int) -> Column:
    bare = (or_blank(volume) == "") & (or_blank(issue) == "")
    return F.when(bare & (prefix_int(year) >= pull_year - 3), F.lit(ADVANCE)).otherwise("")


def doi_key(x: Column) -> Column:
    return F.lower(F.regexp_replace(or_blank(x), r"(?i)^https?://doi\.org/", ""))


def orcid(x: Column) -> Column:
    return F.regexp_replace(or_blank(x), r"^https?://orcid\.org/", "")


def reg_key(doi: Column, title: Column, year: Column) -> Column:
    return F.when(or_blank(doi) != "", doi).otherwise(F.concat(F.lit("t:"), norm_title(title), F.lit("|"), or_blank(year)))


def year_of(*date_parts: Column) -> Column:
    """The first year that is neither missing nor 0 among several date-parts, as text."""
    years = [F.nullif(F.try_element_at(F.try_element_at(d, F.lit(1)), F.lit(1)), F.lit(0)) for d in date_parts]
    return or_blank(F.coalesce(*years).cast("string"))


def author_name(given: Column, family: Column, name: Column) -> Column:
    both = F.concat_ws(" ", blank_to_null(given), blank_to_null(family))
    return squeeze(F.replace(first_given(both, name), F.lit(","), F.lit(" ")))


TRAILERS = "funding|supplemental material|history|data|acknowledgments?|conflicts?[^:]{0,30}|epub"  # fixed value


def strip_trailers(x: Column) -> Column:
    """Cuts at the first labelled trailer ("Funding:" ...) and then at the first URL."""
    no_label = F.regexp_replace(or_blank(x), rf"(?is)\.?{WS}*(?:{TRAILERS}){WS}*:.*$", "")
    return squeeze(F.regexp_replace(no_label, rf"(?is)\.?{WS}*https?://.*$", ""))


#: Words that no editor's or other person's name holds (fixed values).
NOT_EDITOR = "the|this|that|is|are|was|were|we|when|which|of|by|in|on|to|as|editors?"
NOT_NAME = "the|this|that|is|are|was|were|we|of|in|on|to|as|for|paper|article|issue|editors?|received|accepted|revisions?"


def _plausible(x: Column, least: int, most: int, tokens: int, stop: str) -> Column:
    size = F.char_length(or_blank(x))
    few = F.size(F.split(or_blank(x), WS + "+")) <= tokens
    return size.between(least, most) & few & or_blank(x).rlike("^[A-ZÀ-Þ]") & ~or_blank(x).rlike(f"(?i){EDGE_L}(?:{stop}){EDGE_R}")


def plausible_editor(x: Column) -> Column:
    return _plausible(x, 1, 70, 8, NOT_EDITOR)


def plausible_name(x: Column) -> Column:
    return _plausible(x, 4, 60, 6, NOT_NAME)


ACCEPTED = "This paper was accepted by "


def acceptance(abstract: Column) -> Column:
    """struct(editor, area) from "accepted by <name>, <area>." in an abstract."""
    sentence = r"([^.]+(?:\.[^.]{0,5})*[^.]*)\."
    long_form = F.regexp_extract(or_blank(abstract), rf"(?i)(?:paper|work){WS}+(?:was|has{WS}+been){WS}+accepted by{WS}+{sentence}", 1)
    found = strip_trailers(first_given(long_form, F.regexp_extract(or_blank(abstract), rf"(?i)accepted by{WS}+{sentence}", 1)))
    comma = F.instr(found, ",")
    person = F.trim(F.when(comma > 0, F.substring(found, F.lit(1), comma - 1)).otherwise(found))
    rest = F.trim(F.when(comma > 0, F.substring(found, comma + 1, F.char_length(found))).otherwise(""))
    rest = F.trim(F.regexp_replace(F.element_at(F.split(rest, rf"\.{WS}"), 1), r"\.$", ""))
    special = rf"(?i)^(.*?){WS}+for{WS}+the{WS}+(.*(?:special{WS}+issue|special{WS}+section).*)$"  # fixed value
    is_special = person.rlike(special)
    body = F.when(is_special, F.trim(F.regexp_extract(person, special, 1))).otherwise(person)
    area = F.when(is_special, F.trim(F.regexp_extract(person, special, 2))).otherwise(rest)
    good = plausible_editor(body)
    text = F.concat(F.lit(ACCEPTED), body, F.when(area != "", F.concat(F.lit(", "), area)).otherwise(""), F.lit("."))
    return F.struct(F.when(good, text).otherwise("").alias("editor"), F.when(good, area).otherwise("").alias("area"))


def first_or_scalar(x: Column) -> Column:
    """A member that holds a string or an array of strings, read as text: the string, or the array's first element."""
    listed = F.try_element_at(F.from_json(x, "array<string>"), F.lit(1))
    return F.when(F.startswith(F.ltrim(x), F.lit("[")), listed).otherwise(x)


def norm_area(x: Column) -> Column:
    plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace(or_blank(x), "<[^>]+>", ""), rf"\.{WS}*$", "")))
    return F.when(plain.rlike("special issue on (?:the )?digital finance"), "special issue on the digital finance").otherwise(plain)


def assertion_editor(assertions: Column) -> Column:
    """From the first assertion that is about an editor; a blank one ends the search."""
    about = F.filter(assertions, lambda a: F.contains(F.lower(first_given(a["label"], a["name"])), F.lit("editor")))
    value = strip_markup(F.try_element_at(about, F.lit(1))["value"])
    dotted = F.concat(F.regexp_replace(value, r"\.$", ""), F.lit("."))
    return F.when(value == "", "").when(value.rlike("(?i)accepted by"), dotted).otherwise(F.concat(F.lit(ACCEPTED), dotted))


ARXIV_URL = r"(?i)^https?://(?:www\.|export\.)?arxiv\.org/(?:abs|pdf)/([^?#]+).*$"


def canon_arxiv(u: Column) -> Column:
    """Landing page of the latest version; other addresses stay."""
    ident = F.regexp_replace(F.regexp_replace(F.regexp_extract(u, ARXIV_URL, 1), r"(?i)\.pdf$", ""), r"(?i)v[0-9]+$", "")
    return F.when(u.rlike(ARXIV_URL), F.concat(F.lit("https://arxiv.org/abs/"), ident)).otherwise(u)


#: Repositories in order of preference: host, name, and what the address must hold (fixed values).
HOSTS = (
    ("arxiv.org", "arxiv", ""), ("ssrn.com", "ssrn", ""), ("biorxiv.org", "biorxiv", ""), ("medrxiv.org", "medrxiv", ""),
    ("nber.org", "nber", r"(?i)/(?:papers|system/files/working_papers)/w[0-9]+"), ("osf.io", "osf", "(?i)/preprints/"),
)


def host_of(u: Column) -> Column:
    return or_blank(F.lower(F.try_parse_url(u, F.lit("HOST"))))


def _on_host(domain: str, path: str):  # noqa: ANN202
    def test(u: Column) -> Column:
        here = (host_of(u) == domain) | F.endswith(host_of(u), F.lit("." + domain))
        return here & u.rlike(path) if path else here

    return test


def pick_preprint(urls: Column) -> Column:
    """struct(u, s): the first address, in order, of the best repository; null if there is none."""
    web = F.filter(urls, lambda u: u.rlike("(?i)^https?://"))
    out = F.lit(None).cast("struct<u:string,s:string>")
    for domain, name, path in reversed(HOSTS):
        first = F.try_element_at(F.filter(web, _on_host(domain, path)), F.lit(1))
        shown = first
        if name == "arxiv":
            shown = canon_arxiv(first)
        elif name == "nber":
            shown = F.concat(F.lit("https://www.nber.org/papers/"), F.lower(F.regexp_extract(first, "(?i)/(w[0-9]+)", 1)))
        out = F.when(first.isNotNull(), F.struct(shown.alias("u"), F.lit(name).alias("s"))).otherwise(out)
    return out


#: DOI patterns of preprints, the name of the source, and the address before and after the identifier (fixed values).
DOI_FORMS = (
    (r"^10\.2139/ssrn\.([0-9]+)$", "ssrn", "https://papers.ssrn.com/sol3/papers.cfm?abstract_id="),
    (r"^10\.48550/arxiv\.(.+?)(?:v[0-9]+)?$", "arxiv", "https://arxiv.org/abs/"),
    (r"^10\.1101/((?:[0-9]{4}\.[0-9]{2}\.[0-9]{2}\.)?[0-9]+)$", "cshl", "https://doi.org/10.1101/"),
    (r"^10\.3386/(w[0-9]+)$", "nber", "https://www.nber.org/papers/"),
    (r"^10\.31219/osf\.io/([A-Za-z0-9_]+)$", "osf", "https://osf.io/"),
)


def preprint_from_doi(doi: Column) -> Column:
    d, out = doi_key(doi), F.lit(None).cast("struct<u:string,s:string>")
    for pattern, name, base in reversed(DOI_FORMS):
        out = F.when(d.rlike(pattern), F.struct(F.concat(F.lit(base), F.regexp_extract(d, pattern, 1)).alias("u"), F.lit(name).alias("s"))).otherwise(out)
    return out


def surname(full: Column) -> Column:
    last = F.element_at(F.split(squeeze(or_blank(full)), " "), -1)
    return F.regexp_replace(strip_accents(F.lower(last)), "[^a-z]", "")


def surnames(names: Column) -> Column:
    """Different surnames of two letters or more, in order."""
    return F.array_distinct(F.filter(F.transform(names, surname), lambda s: F.char_length(s) >= 2))


PREFIX_LENGTH = 14
#: What a separate follow-up's title adds, and titles before a person's name (fixed values).
FOLLOW_UPS = "comment|repl(y|ies)|corrigend|errat|rejoinder|retract"
HONORIFICS = "dr|prof(?:essor)?|mr|mrs|ms"


def titles_match(a: Column, b: Column) -> Column:
    """'exact', 'prefix' or '' for two match_norm() titles."""
    short = F.when(F.char_length(a) <= F.char_length(b), a).otherwise(b)
    long = F.when(F.char_length(a) <= F.char_length(b), b).otherwise(a)
    tail = F.substring(long, F.char_length(short) + 1, F.char_length(long))
    prefix = (F.char_length(short) >= PREFIX_LENGTH) & F.startswith(long, short) & ~tail.rlike(FOLLOW_UPS)
    return F.when((or_blank(a) == "") | (or_blank(b) == ""), "").when(a == b, "exact").when(prefix, "prefix").otherwise("")


def sanitised_query(x: Column) -> Column:
    return squeeze(F.regexp_replace(or_blank(x), rf"(?:(?!{WS})[^A-Za-z0-9_'\-])", " "))


def without_initials(name: Column) -> Column:
    """A folded name without interior one-letter words; names of fewer than three words stay."""
    words = F.split(name, " ")
    inner = F.filter(words, lambda w, i: (i == 0) | (i == F.size(words) - 1) | ~w.rlike(r"^[a-z]\.?$"))
    return F.when(F.size(words) >= 3, F.array_join(inner, " ")).otherwise(name)


def tail_segment(x: Column) -> Column:
    return F.element_at(F.split(or_blank(x), rf"(?<=[a-zà-þ]{{2}})\.{WS}+"), -1)


def clean_name(x: Column) -> Column:
    s = squeeze(F.regexp_replace(tail_segment(x), rf"(?i)^.*(?:history|editors?){WS}*:{WS}*", ""))
    s = F.regexp_replace(s, rf"(?i)^(?:and|with|by){WS}+", "")
    s = F.regexp_replace(s, rf"(?i)^(?:{HONORIFICS})\.?{WS}+", "")
    return F.trim(F.regexp_replace(s, "[.,;:]+$", ""))


def split_names(x: Column) -> Column:
    pieces = F.transform(F.split(or_blank(x), rf"(?i){WS}+(?:and|&){WS}+"), clean_name)
    return F.filter(pieces, plausible_name)


def parse_editors(text: Column) -> Column:
    """struct(se, ae): senior and associate editors named in a history note, each list joined by '; '."""
    plain = F.regexp_replace(F.regexp_replace(or_blank(text), "<[^>]+>", " "), WS + "+", " ")

    def of(role: str) -> Column:
        title = rf"{role}{WS}+Editors?"
        listed = F.regexp_extract_all(plain, F.lit(rf"(?i)([^;:]{{2,80}}?),{WS}*(?:the{WS}+)?{title}{EDGE_R}"), F.lit(1))
        served = F.regexp_extract_all(plain, F.lit(rf"(?i)([^;:]{{2,90}}?){WS}+served{WS}+as{WS}+(?:the{WS}+)?{title}{EDGE_R}"), F.lit(1))
        label = F.array(F.regexp_extract(plain, rf"(?i){title}{WS}*[:—-]{WS}*([^.;]{{2,80}})", 1))
        return F.array_join(F.array_distinct(F.flatten(F.transform(F.concat(listed, served, label), split_names))), "; ")

    return F.struct(of("Senior").alias("se"), of("Associate").alias("ae"))


def journal_norm(x: Column) -> Column:
    joined = F.replace(F.lower(or_blank(x)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(joined, rf"^the{WS}+", ""), "[^a-z0-9]+", " "))


def list_split(x: Column, separator: str) -> Column:
    return F.filter(F.transform(F.split(or_blank(x), separator), squeeze_ends), lambda s: s != "")


def squeeze_ends(x: Column) -> Column:
    return F.regexp_replace(x, rf"^{WS}+|{WS}+$", "")


def url_encoded(x: Column) -> Column:
    return F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))


def affiliation_key(x: Column) -> Column:
    return squeeze(norm_name(x))


def text_prefix(x: Column, most: int = 4000) -> Column:
    return F.substring(x, 1, most)


def positive(x: Column) -> Column:
    return F.when(x > 0, x)


def epoch_day(moment: Column) -> Column:
    """Whole days since 1970-01-01 (UTC) at a moment; before that day rounded down. The clock of caches and queues."""
    return F.floor(F.unix_millis(moment.cast("timestamp")) / F.lit(86_400_000)).cast("int")


def retry_wait(attempt: Column, retry_after: Column) -> Column:
    """Seconds to wait before the next try, as sources.http.wait_seconds() has them for a task."""
    return F.greatest(F.coalesce(retry_after, F.lit(0.0)).cast("double"), F.least(5.0 * F.pow(F.lit(2.0), attempt - 1), F.lit(60.0)))
