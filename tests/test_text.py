from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T

def S(x):  # noqa: N802
    return F.lit(x)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def vectors():
    return [
        (T.strip_markup(S("<jats:p>a &amp; b</jats:p>")), "a & b"), (T.strip_markup(S("&amp;lt;")), "&lt;"), (T.strip_markup(S("&lt;b&gt;")), "<b>"), (T.strip_markup(S(None).cast("string")), ""),
        (T.strip_markup(S(" a  b ")), "a b"),
        (T.pub_rank(S("2024"), S("70"), S("3"), S("1500-1520"), S("")), 2024070003999), (T.pub_rank(S("2026"), S(""), S(""), S(""), S(T.ADVANCE)), 12026000000000),
        (T.forthcoming_status(S(""), S(""), S("2023"), 2026), T.ADVANCE), (T.forthcoming_status(S(""), S(""), S("2022"), 2026), ""), (T.forthcoming_status(S("1"), S(""), S("2026"), 2026), ""),
        (T.prefix_int(S(" 12a")), 12), (T.prefix_int(S("a12")), 0), (T.prefix_int(S("99999999999999999999999")), 0),
        (T.canon_arxiv(S("http://www.arxiv.org/pdf/2301.00001v3.pdf")), "https://arxiv.org/abs/2301.00001"), (T.canon_arxiv(S("https://x.org/abs/1")), "https://x.org/abs/1"),
        (T.pick_preprint(F.array(S("https://arxiv.org.evil.com/abs/1"), S("https://papers.ssrn.com/x")))["u"], "https://papers.ssrn.com/x"),
        (T.pick_preprint(F.array(S("https://papers.ssrn.com/x"), S("https://arxiv.org/abs/1v2")))["s"], "arxiv"), (T.pick_preprint(F.array(S("https://osf.io/abc"))), None),
        (T.pick_preprint(F.array(S("https://www.nber.org/system/files/working_papers/W12/w12.pdf")))["u"], "https://www.nber.org/papers/w12"),
        (T.preprint_from_doi(S("10.1101/gr.123")), None), (T.preprint_from_doi(S("10.1101/2023.01.02.522345"))["s"], "cshl"), (T.preprint_from_doi(S("https://doi.org/10.48550/arXiv.2301.1v2"))["u"], "https://arxiv.org/abs/2301.1"),
        (T.surnames(F.array(S("José Ñandú"), S("A B"))), ["nandu"]),
        (T.titles_match(S("duelingcontests"), S("duelingcontestsandplatform")), "prefix"), (T.titles_match(S("duelingcontests"), S("duelingcontestscomment")), ""), (T.titles_match(S("repeatedgames"), S("repeatedgamesrevisited")), ""), (T.titles_match(S(""), S("")), ""), (T.titles_match(S("ab"), S("ab")), "exact"),
        (T.without_initials(S("hau l. lee")), "hau lee"), (T.without_initials(S("h lee")), "h lee"),
        (T.strip_accents(S("Nguyễn Văn")), "Nguyen Van"), (T.strip_accents(S("Øystein Łukasz")), "Øystein Łukasz"),
        (T.parse_editors(S("History: Dr. Ram D. Gopal, Senior Editor; Dr. Hong Xu, Associate Editor."))["ae"], "Hong Xu"), (T.parse_editors(S("History: Dr. Ram D. Gopal, Senior Editor; Dr. Hong Xu, Associate Editor."))["se"], "Ram D. Gopal"),
        (T.parse_editors(S("History: Puneet Manchanda served as the senior editor."))["se"], "Puneet Manchanda"), (T.parse_editors(S("Associate Editor: Cy Diaz and Bo Chen."))["ae"], "Cy Diaz; Bo Chen"),
        (T.journal_norm(S("The RAND Journal of Economics")), "rand journal of economics"), (T.journal_norm(S("R&D")), "r and d"),
        (T.acceptance(S("We study. This paper was accepted by Suraj S. Rao, accounting. Funding: none."))["area"], "accounting"), (T.acceptance(S("accepted by Jo Lee for the Special Issue on X."))["area"], "Special Issue on X"), (T.acceptance(S("accepted by the committee."))["editor"], ""),
        (T.norm_area(S("Special Issue on Digital Finance.")), "special issue on the digital finance"),
        (T.year_of(F.from_json(S("[[null]]"), "array<array<int>>"), F.from_json(S("[[2019]]"), "array<array<int>>")), "2019"), (T.year_of(F.from_json(S("[[0]]"), "array<array<int>>")), ""),
        (T.author_name(S("Ann"), S("Lee, Jr."), S("x")), "Ann Lee Jr."), (T.author_name(S(""), S(None).cast("string"), S("Group A")), "Group A"),
        (T.reg_key(S(""), S("A Title!"), S("2020")), "t:a title|2020"), (T.doi_key(S("HTTPS://doi.org/10.1/AB")), "10.1/ab"), (T.orcid(S("https://orcid.org/0-1")), "0-1"),
        (T.url_encoded(S("a b&c")), "a%20b%26c"), (T.list_split(S(" a; ;b "), ";"), ["a", "b"]), (T.sanitised_query(S("a: b'c-d_e (f)")), "a b'c-d_e f"),
        (T.assertion_editor(F.from_json(S('[{"label":"x","value":"y"},{"name":"Handling Editor","value":"Bo Chen"}]'), "array<struct<label:string,name:string,value:string>>")), "This paper was accepted by Bo Chen."),
        (T.assertion_editor(F.from_json(S('[{"label":"Editor","value":""},{"label":"Editor","value":"Z"}]'), "array<struct<label:string,name:string,value:string>>")), ""),
    ]


def test_vectors(spark):
    cases = vectors()
    row = spark.range(1).select(*[c.alias(f"v{i}") for i, (c, _) in enumerate(cases)]).first()
    wrong = [(i, row[i], want) for i, (_, want) in enumerate(cases) if row[i] != want]
    assert not wrong


@pytest.mark.parametrize("name,good", [("Jo Lee", True), ("jo lee", False), ("The Board", False), ("A" * 71, False), ("", False)])
def test_plausible_editor(spark, name, good):
    assert value(spark, T.plausible_editor(S(name))) is good


def test_clocks(spark):
    from quire.sources.http import wait_seconds

    rows = [(n, after) for n in range(1, 9) for after in (0.0, 7.0, 300.0)]
    got = spark.createDataFrame(rows, "n int, after double").select("n", "after", T.retry_wait(F.col("n"), F.col("after")).alias("w")).collect()
    assert all(r.w == wait_seconds(r.n, r.after) for r in got)
    days = spark.sql("SELECT explode(array(timestamp'1970-01-01 23:59:59.999', timestamp'1970-01-02', timestamp'1969-12-31 23:00:00', timestamp'2026-07-23 12:00:00')) AS t")
    assert [r.d for r in days.select(T.epoch_day(F.col("t")).alias("d")).collect()] == [0, 1, -1, 20657]
