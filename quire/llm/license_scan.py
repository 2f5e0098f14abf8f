"""Licence recognition by sentence rules, in built-in column functions only; no row ever shuffles.

A text is cut into sentences at line ends and after . ! ? ; followed by white space. Each is normalised (ASCII lower
case, runs of other characters than a-z and 0-9 become one space). A known licence sentence is one such piece or a run
of neighbouring ones: texts are wrapped, commented line by line, and have a semicolon or blank line inside a known
sentence. It starts and ends where pieces do; of several from one place the longest counts, and what lies within it
doesn't count again. The identifiers that are found, in text order and without the unknown sentences between them,
form the document's sequence. The SQL knows single pieces only and has fewer identifiers where a sentence is wrapped.
Ordered rules are then matched against it: a rule is a run of identifiers, and one that lies within the run of an
earlier, longer rule of the same family (BSD licences are one) does not count again.

Null and empty texts have an empty sequence and no licence. Repeated sentences stay repeated in the sequence; a rule
counts once for a document. Repeated rows give repeated results; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents

#: Licence sentences, normalised, and their identifiers (fixed values).
SENTENCES = {
    "apache_short": "licensed under the apache license version 2 0",
    "apache_grant": "licensed under the apache license version 2 0 the license",
    "apache_may": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_short": "released under the mit license",
    "mit_title": "the mit license",
    "mit_title_paren": "mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl3_short": "this work is licensed under the gnu general public license version 3",
    "gpl_title": "gnu general public license",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_see": "see the gnu general public license for more details",
    "lgpl_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl_hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl_see": "see the gnu lesser general public license for more details",
    "agpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl_see": "see the gnu affero general public license for more details",
    "gpl_copy": "you should have received a copy of the gnu general public license along with this program",
    "epl_made": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl_copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl_copy_https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mit_asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc_asis": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "zlib_grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost": "distributed under the boost software license version 1 0",
    "cc_by_sa_long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc_by_nd_long": "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
    "spdx_bsd3": "spdx license identifier bsd 3 clause",
    "spdx_bsd2": "spdx license identifier bsd 2 clause",
    "spdx_isc": "spdx license identifier isc",
    "spdx_gpl2": "spdx license identifier gpl 2 0 only",
    "spdx_mpl": "spdx license identifier mpl 2 0",
    "spdx_lgpl": "spdx license identifier lgpl 2 1 or later",
    "spdx_agpl": "spdx license identifier agpl 3 0 or later",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl_form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc_by": "licensed under cc by 4 0",
    "cc_by_sa": "licensed under cc by sa 4 0",
    "cc_by_nc": "licensed under cc by nc 4 0",
    "cc_by_long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc_by_nc_long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "spdx_mit": "spdx license identifier mit",
    "spdx_apache": "spdx license identifier apache 2 0",
    "spdx_gpl3": "spdx license identifier gpl 3 0 only",
}
#: Rules in order: licence, rule, run of identifiers (fixed values).
RULES = (
    ("Apache-2.0", "header", ("apache_grant", "apache_may", "apache_copy", "apache_asis", "apache_see")),
    ("Apache-2.0", "grant", ("apache_grant", "apache_may")),
    ("Apache-2.0", "short", ("apache_short",)),
    ("Apache-2.0", "spdx", ("spdx_apache",)),
    ("MIT", "text", ("mit_grant", "mit_notice")),
    ("MIT", "grant", ("mit_grant",)),
    ("MIT", "short", ("mit_short",)),
    ("MIT", "title", ("mit_title",)),
    ("MIT", "title-plain", ("mit_title_paren",)),
    ("MIT", "spdx", ("spdx_mit",)),
    ("GPL-3.0", "notice", ("gpl_free", "gpl_hope", "gpl_see")),
    ("GPL-3.0", "grant", ("gpl_free",)),
    ("GPL-3.0", "short", ("gpl3_short",)),
    ("GPL-3.0", "spdx", ("spdx_gpl3",)),
    ("GPL-2.0", "notice", ("gpl2_free", "gpl_hope", "gpl_see")),
    ("GPL-2.0", "grant", ("gpl2_free",)),
    ("GPL", "title", ("gpl_title",)),
    ("LGPL-2.1", "notice", ("lgpl_free", "lgpl_hope", "lgpl_see")),
    ("LGPL-2.1", "grant", ("lgpl_free",)),
    ("LGPL-2.1", "spdx", ("spdx_lgpl",)),
    ("LGPL-3.0", "notice", ("lgpl3_free", "lgpl_hope", "lgpl_see")),
    ("LGPL-3.0", "grant", ("lgpl3_free",)),
    ("AGPL-3.0", "notice", ("agpl_free", "gpl_hope", "agpl_see")),
    ("AGPL-3.0", "grant", ("agpl_free",)),
    ("AGPL-3.0", "spdx", ("spdx_agpl",)),
    ("GPL-2.0", "spdx", ("spdx_gpl2",)),
    ("EPL-2.0", "made", ("epl_made",)),
    ("BSD-3-Clause", "text", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-3-Clause", "spdx", ("spdx_bsd3",)),
    ("BSD-2-Clause", "text", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD-2-Clause", "spdx", ("spdx_bsd2",)),
    ("BSD", "grant", ("bsd_grant",)),
    ("ISC", "spdx", ("spdx_isc",)),
    ("MPL-2.0", "spdx", ("spdx_mpl",)),
    ("Zlib", "grant", ("zlib_grant",)),
    ("BSL-1.0", "short", ("boost",)),
    ("CC-BY-SA-4.0", "long", ("cc_by_sa_long",)),
    ("CC-BY-ND-4.0", "long", ("cc_by_nd_long",)),
    ("ISC", "grant", ("isc_grant",)),
    ("MPL-2.0", "form", ("mpl_form",)),
    ("Unlicense", "text", ("unlicense",)),
    ("CC-BY-4.0", "short", ("cc_by",)),
    ("CC-BY-4.0", "long", ("cc_by_long",)),
    ("CC-BY-SA-4.0", "short", ("cc_by_sa",)),
    ("CC-BY-NC-4.0", "short", ("cc_by_nc",)),
    ("CC-BY-NC-4.0", "long", ("cc_by_nc_long",)),
    ("CC0-1.0", "waiver", ("cc0",)),
)
LICENSES = tuple(dict.fromkeys(r[0] for r in RULES))
BREAKS, OTHER = "[.!?;]+[ \\t\\r\\n]+|[\\r\\n]+", "[^a-z0-9\\n]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sentences(text: Column) -> Column:
    plain = F.regexp_replace(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), BREAKS, "\n"), UPPER, LOWER), OTHER, " ")
    return F.filter(F.transform(F.split(plain, "\n"), lambda s: F.trim(s)), lambda s: s != "")


#: Known sentences between piece ends, longest first; a piece may end between any two words.
KNOWN = "(?<=\n)(?:" + "|".join(x.replace(" ", "[ \n]") for x in sorted(SENTENCES.values(), key=len, reverse=True)) + ")(?=\n)"


def identifiers(found: Column) -> Column:
    known = F.create_map(*[F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)])
    runs = F.regexp_extract_all(F.concat(F.lit("\n"), F.array_join(found, "\n"), F.lit("\n")), F.lit(KNOWN), F.lit(0))
    return F.transform(runs, lambda s: F.try_element_at(known, F.translate(s, "\n", " ")))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_sentences, license_ids (the sequence), licenses and rules (comma-joined, in rule order), n_licenses."""
    found = docs.select(id_col, sentences(F.col(text_col)).alias("_s")).select(id_col, F.size("_s").cast("long").alias("n_sentences"), F.array_join(identifiers(F.col("_s")), " ").alias("license_ids"))
    padded = F.concat(F.lit(" "), "license_ids", F.lit(" "))
    hits = [padded.contains(f" {' '.join(ids)} ") for _, _, ids in RULES]
    left = [h & ~_covered(hits, k) if _earlier(k) else h for k, h in enumerate(hits)]
    rules = [F.when(h, F.lit(f"{name}/{rule}")) for (name, rule, _), h in zip(RULES, left, strict=True)]
    families = [F.when(_any([h for r, h in zip(RULES, left, strict=True) if r[0] == name]), F.lit(name)) for name in LICENSES]
    out = found.withColumns({"licenses": F.concat_ws(",", *families), "rules": F.concat_ws(",", *rules)})
    return out.withColumn("n_licenses", F.when(F.col("licenses") == "", 0).otherwise(F.size(F.split("licenses", ","))).cast("long"))


def _any(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out | t
    return out


def _earlier(k: int) -> list[int]:
    """Earlier rules whose longer run holds rule k's: of its own licence, or of one with the same beginning (BSD)."""
    name, _, ids = RULES[k]
    same = lambda other: other == name or (name.startswith("BSD") and other.startswith("BSD-"))
    return [j for j in range(k) if same(RULES[j][0]) and RULES[j][2] != ids and f" {' '.join(ids)} " in f" {' '.join(RULES[j][2])} "]


def _covered(hits: list[Column], k: int) -> Column:
    return _any([hits[j] for j in _earlier(k)] or [F.lit(False)])


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def oracle() -> str:
    known = ", ".join(f"('{s}', '{n}')" for n, s in SENTENCES.items())
    hit = [f"contains(' ' || license_ids || ' ', ' {' '.join(ids)} ')" for _, _, ids in RULES]
    left = [f"({h} AND NOT ({' OR '.join(hit[j] for j in _earlier(k)) or 'false'}))" for k, h in enumerate(hit)]
    rules = ", ".join(f"CASE WHEN {h} THEN '{name}/{rule}' END" for (name, rule, _), h in zip(RULES, left, strict=True))
    families = ", ".join(f"CASE WHEN {' OR '.join(h for r, h in zip(RULES, left, strict=True) if r[0] == name)} THEN '{name}' END" for name in LICENSES)
    return f"""
WITH known(sentence, name) AS (VALUES {known}),
cut AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(translate(regexp_replace(coalesce(text, ''), '[.!?;]+[ \\t\\r\\n]+|[\\r\\n]+', chr(10), 'g'), '{UPPER}', '{LOWER}'), '[^a-z0-9\\n]+', ' ', 'g'), chr(10)), lambda s: trim(s, ' ')), lambda s: s <> '') AS s FROM documents),
each AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS k FROM cut),
seq AS (SELECT doc_id, string_agg(name, ' ' ORDER BY k) AS ids FROM each JOIN known USING (sentence) GROUP BY doc_id),
got AS (SELECT cut.doc_id, len(s)::BIGINT AS n_sentences, coalesce(ids, '') AS license_ids FROM cut LEFT JOIN seq USING (doc_id)),
named AS (SELECT *, concat_ws(',', {families}) AS licenses, concat_ws(',', {rules}) AS rules FROM got)
SELECT *, (CASE WHEN licenses = '' THEN 0 ELSE len(string_split(licenses, ',')) END)::BIGINT AS n_licenses FROM named"""
