"""License scans by sentence rules.

A text is cut into sentences, each is normalised (lower case, letters and digits only, single
spaces) and looked up among known licence sentences; the identifiers found, in order, are
matched against an ordered list of rules, full texts before notices and notices before mentions.
Everything is a column expression over one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Well-known sentences of public licence texts and notices, normalised.
SENTENCES = {
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_name": "mit license",
    "mit_name_the": "the mit license",
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc_name": "isc license",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_licensed": "licensed under the bsd license",
    "bsd3_licensed": "licensed under the bsd 3 clause license",
    "bsd2_licensed": "licensed under the bsd 2 clause license",
    "apache_licensed": "licensed under the apache license version 2 0 the license",
    "apache_short": "licensed under the apache license version 2 0",
    "apache_released": "released under the apache license version 2 0",
    "apache_comply": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at",
    "apache_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_name": "apache license version 2 0",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_details": "see the gnu general public license for more details",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl2_work": "this work is licensed under the gnu general public license version 2",
    "gpl3_licensed": "licensed under the gnu general public license version 3",
    "gpl2_licensed": "licensed under the gnu general public license version 2",
    "lgpl_licensed": "licensed under the gnu lesser general public license version 3",
    "agpl_licensed": "licensed under the gnu affero general public license version 3",
    "mpl_subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl_licensed": "licensed under the mozilla public license version 2 0",
    "unlicense_free": "this is free and unencumbered software released into the public domain",
    "public_domain": "this work is in the public domain",
    "cc0_licensed": "licensed under cc0 1 0",
    "cc_by_licensed": "licensed under cc by 4 0",
    "cc_by_sa_licensed": "licensed under cc by sa 4 0",
    "cc_by_nc_licensed": "licensed under cc by nc 4 0",
    "cc_by_nd_licensed": "licensed under cc by nd 4 0",
    "cc_by_nc_sa_licensed": "licensed under cc by nc sa 4 0",
    "cc_by_nc_nd_licensed": "licensed under cc by nc nd 4 0",
    "cc_by_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc_by_sa_work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc_by_nc_work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "all_rights": "all rights reserved",
}

#: (name, licence in words, versions): the notices of the Free Software Foundation, whose sentences
#: end at ':' and ';' as well as at full stops, so that any of these parts may stand alone.
FAMILIES = [("gpl", "gnu general public license", ("2", "3")),
            ("lgpl", "gnu lesser general public license", ("2_1", "3")),
            ("agpl", "gnu affero general public license", ("3",))]
SENTENCES["gpl_implied"] = ("without even the implied warranty of merchantability or fitness for a "
                            "particular purpose")
for _name, _words, _versions in FAMILIES:
    _published = ("you can redistribute it and or modify it under the terms of the " + _words
                  + " as published by the free software foundation")
    SENTENCES[f"{_name}_published"] = _published
    SENTENCES.setdefault(f"{_name}_details", f"see the {_words} for more details")
    for _v in _versions:
        _either = f"either version {_v.replace('_', ' ')} of the license or at your option any later version"
        SENTENCES[f"either_{_v}"] = _either
        SENTENCES[f"{_name}{_v}_redistribute"] = f"{_published} {_either}"
#: The notice of MPL 2.0 is cut behind its 'v.'; no other version speaks of a source code form.
SENTENCES["mpl_subject_v"] = "this source code form is subject to the terms of the mozilla public license v"
#: What may stand before 'licensed under' and 'released under'; such a sentence has the identifier
#: of the plain one with the subject behind it, and rules take both.
SUBJECTS = [f"this {n}" for n in "project software program library package code work file".split()] + [
    "the project", "the software", "the code", "the source code", "it"]
VARIED = frozenset(i for i, s in SENTENCES.items() if s.startswith(("licensed under", "released under")))
for _i in sorted(VARIED):
    _plain = SENTENCES[_i]
    _ways = {"": _plain, "terms_": _plain.replace("under the", "under the terms of the", 1)}
    for _way, _sentence in _ways.items():
        if _sentence not in SENTENCES.values():
            SENTENCES[f"{_i}__{_way}alone"] = _sentence
        for _subject in SUBJECTS:
            if f"{_subject} is {_sentence}" not in SENTENCES.values():
                SENTENCES[f"{_i}__{_way}{_subject.replace(' ', '_')}"] = f"{_subject} is {_sentence}"
#: Identifiers that stand for a part of a sentence: in rules, nothing lies before them.
NEXT = frozenset(i for i in SENTENCES if i.startswith("either_"))
#: A sentence that begins so names a holder; its identifier stands for any name.
COPYRIGHT = "^copyright (c )?([0-9]{4} )+"



def _notice_rules(kind: str):
    """Rules over the parts of the notices: ``header`` with the warranty, ``free`` without."""
    for name, _, versions in FAMILIES:
        for v in versions:
            licence = f"{name.upper()}-{v.replace('_', '.') if '_' in v else v + '.0'}-or-later"
            for grant in ((f"{name}{v}_redistribute",), (f"{name}_published", f"either_{v}")):
                yield (f"{name}{v}_{kind}", licence,
                       grant + (("gpl_implied", f"{name}_details") if kind == "header" else ()))


#: (rule, licence, identifiers that must follow each other in this order, others may lie between)
RULES = [
    ("mit_text", "MIT", ("mit_grant", "mit_notice", "mit_warranty")),
    ("isc_text", "ISC", ("isc_grant",)),
    ("bsd3_text", "BSD-3-Clause", ("bsd_redistribution", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("bsd2_text", "BSD-2-Clause", ("bsd_redistribution", "bsd_source", "bsd_binary")),
    ("apache_header", "Apache-2.0", ("apache_licensed", "apache_comply", "apache_copy", "apache_basis")),
    ("gpl3_header", "GPL-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_details")),
    ("gpl2_header", "GPL-2.0-or-later", ("gpl2_free", "gpl_hope", "gpl_details")),
    *_notice_rules("header"),
    ("mpl_header", "MPL-2.0", ("mpl_subject",)),
    ("mpl_header", "MPL-2.0", ("mpl_subject_v",)),
    ("unlicense_text", "Unlicense", ("unlicense_free",)),
    ("mit_short", "MIT", ("mit_grant",)),
    ("mit_released", "MIT", ("mit_released",)),
    ("mit_licensed", "MIT", ("mit_licensed",)),
    ("apache_notice", "Apache-2.0", ("apache_licensed",)),
    ("apache_short", "Apache-2.0", ("apache_short",)),
    ("apache_released", "Apache-2.0", ("apache_released",)),
    ("gpl3_free", "GPL-3.0-or-later", ("gpl_free",)),
    ("gpl2_free", "GPL-2.0-or-later", ("gpl2_free",)),
    *_notice_rules("free"),
    ("gpl3_work", "GPL-3.0-only", ("gpl3_work",)),
    ("gpl2_work", "GPL-2.0-only", ("gpl2_work",)),
    ("gpl3_licensed", "GPL-3.0-only", ("gpl3_licensed",)),
    ("gpl2_licensed", "GPL-2.0-only", ("gpl2_licensed",)),
    ("lgpl_licensed", "LGPL-3.0-only", ("lgpl_licensed",)),
    ("agpl_licensed", "AGPL-3.0-only", ("agpl_licensed",)),
    ("mpl_licensed", "MPL-2.0", ("mpl_licensed",)),
    ("bsd3_licensed", "BSD-3-Clause", ("bsd3_licensed",)),
    ("bsd2_licensed", "BSD-2-Clause", ("bsd2_licensed",)),
    ("bsd_licensed", "BSD", ("bsd_licensed",)),
    ("cc_by_nc_nd", "CC-BY-NC-ND-4.0", ("cc_by_nc_nd_licensed",)),
    ("cc_by_nc_sa", "CC-BY-NC-SA-4.0", ("cc_by_nc_sa_licensed",)),
    ("cc_by_nc", "CC-BY-NC-4.0", ("cc_by_nc_licensed",)),
    ("cc_by_nc_work", "CC-BY-NC-4.0", ("cc_by_nc_work",)),
    ("cc_by_nd", "CC-BY-ND-4.0", ("cc_by_nd_licensed",)),
    ("cc_by_sa", "CC-BY-SA-4.0", ("cc_by_sa_licensed",)),
    ("cc_by_sa_work", "CC-BY-SA-4.0", ("cc_by_sa_work",)),
    ("cc_by", "CC-BY-4.0", ("cc_by_licensed",)),
    ("cc_by_work", "CC-BY-4.0", ("cc_by_work",)),
    ("cc0", "CC0-1.0", ("cc0_licensed",)),
    ("public_domain", "Public-Domain", ("public_domain",)),
    ("mit_name", "MIT", ("mit_name",)),
    ("mit_name_the", "MIT", ("mit_name_the",)),
    ("isc_name", "ISC", ("isc_name",)),
    ("apache_name", "Apache-2.0", ("apache_name",)),
    ("proprietary", "All-Rights-Reserved", ("copyright", "all_rights")),
]
#: Every known sentence holds one of these, so texts with none of them need no cutting. A cue may
#: be cut by white space or a sign in the text, never inside its letters.
CUE = "(?i)licens|copyright|permission|redistribut|software|warranty|public[^a-z0-9]+domain|rights[^a-z0-9]+reserved"
ENDS = "[.!?;:]+([ \\t\\n\\x0B\\f\\r]|$)"
#: A line of white space and the signs that comments are made of is a blank line of a comment.
PARAGRAPH = "\\n[ \\t\\n\\x0B\\f\\r/*#;%!<>-]*\\n"
OTHER = "[^a-z0-9]+"
NO_ID = ""


def identifiers(text: Column, by_line: bool) -> Column:
    """The identifiers of the known sentences of a text, in order. Sentences end at a sign that
    ends sentences, at a line without letters or digits (blank or with comment signs only) and, with ``by_line``, at every line's end."""
    cut = F.regexp_replace(F.regexp_replace(text, PARAGRAPH, "\x01"), ENDS, "\x01")
    cut = F.regexp_replace(cut, "\\n", "\x01") if by_line else cut
    known = F.create_map(*[F.lit(v) for k, s in SENTENCES.items() for v in (s, k)])

    def identify(sentence: Column) -> Column:
        plain = F.trim(F.regexp_replace(F.lower(sentence), OTHER, " "))
        return F.transform(F.array(plain), lambda p: F.coalesce(
            F.element_at(known, p),
            F.when(F.regexp_like(F.concat(p, F.lit(" ")), F.lit(COPYRIGHT)), F.lit("copyright")),
            F.lit(NO_ID)))[0]

    return F.filter(F.transform(F.split(cut, "\x01", -1), identify), lambda i: i != NO_ID)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, sentence_ids (in order, comma-separated), n_sentences (of
    them), rule and license (of the first rule that matches), licenses (of all that match).

    Lines may break a sentence or end one, so a text is cut both ways and the cut that knows
    more sentences counts (a tie: the one that ends at lines). Null and empty texts, and those
    without a known sentence, have none: empty lists, null rule and license. Texts are read
    whole; repeated rows and null ids are kept; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    lines, joined = identifiers(F.col("_text"), True), identifiers(F.col("_text"), False)
    best = F.transform(F.array(F.struct(lines.alias("l"), joined.alias("j"))),
                       lambda c: F.when(F.size(c.j) > F.size(c.l), c.j).otherwise(c.l))[0]
    found = F.when(F.regexp_like("_text", F.lit(CUE)), best).otherwise(
        F.array().cast("array<string>"))
    rows = rows.select("doc_id", found.alias("_ids"))
    rows = rows.select("doc_id", F.array_join("_ids", ",").alias("sentence_ids"),
                       F.size("_ids").cast("long").alias("n_sentences"),
                       F.concat(F.lit(","), F.array_join("_ids", ","), F.lit(",")).alias("_seq"))
    hits = F.filter(F.array(*[
        F.when(F.regexp_like("_seq", F.lit(rule_pattern(ids))),
               F.struct(F.lit(rule).alias("rule"), F.lit(licence).alias("license")))
        for rule, licence, ids in RULES]), lambda h: h.isNotNull())
    rows = rows.withColumn("_hits", F.when(F.col("n_sentences") > 0, hits))
    return rows.select(
        "doc_id", "sentence_ids", "n_sentences", F.get("_hits", F.lit(0))["rule"].alias("rule"),
        F.get("_hits", F.lit(0))["license"].alias("license"),
        F.coalesce(F.array_join(F.array_distinct(F.col("_hits.license")), ","), F.lit(""))
        .alias("licenses"))


def rule_pattern(ids: tuple[str, ...]) -> str:
    """A pattern over ``,id,id,``: the identifiers in order, any others between them, but none
    before one of ``NEXT``; one of ``VARIED`` with any subject."""
    return "," + "".join(
        ("(?:[a-z0-9_]+,)*" if n and i not in NEXT else "") + i
        + ("(?:__[a-z0-9_]+)?," if i in VARIED else ",") for n, i in enumerate(ids))
