"""Licence statements by sentence rules, in DataFrame functions only.

A text is cut into sentences; each is normalised and mapped to the identifier of a known licence sentence. The
identifiers, in text order, are matched against licence rules, the longest first; what a rule matches is taken out of the
sequence, so a sentence counts for one licence only.

Each pattern comes with a part that no sentence can do without (``NEEDS``; a test proves it from the patterns). These are of one word, so neither
line breaks nor normalisation can hide them: a text, and then a sentence, without any of them is known to hold no licence sentence before it
is cut or normalised. Nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licence texts and notices, as patterns of their normalised form.
_CC = r"(?:a |the )?(?:creative commons|cc)"
SENTENCES = (
    ("apache2", r"(?:is )?(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?apache licen[sc]e,? (?:version )?2(?:\.0)?\b.*"),
    ("apache2", r"apache licen[sc]e,? version 2\.0.*"),
    ("apacheUse", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apacheCopy", r"you may obtain a copy of the licen[sc]e at.*"),
    ("apacheAsIs", r"unless required by applicable law or agreed to in writing,? software distributed under the licen[sc]e is distributed on an as is basis.*"),
    ("mitGrant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files.*"),
    ("mitNotice", r"the above copyright notice and this permission notice .*shall be included in all copies or substantial portions of the software"),
    ("softwareAsIs", r"the software is provided as is,? without warranty of any kind.*"),
    ("noLiability", r"in no event shall the (?:authors?|copyright holders?|copyright owners?).* be liable.*"),
    ("mitName", r"(?:this .{0,60} is )?(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit licen[sc]e\b.*"),
    ("mitName", r"(?:this .{0,60} is )?mit licen[sc]ed\b.*"),
    ("bsdGrant", r"redistribution and use in source and binary forms,? with or without modification,? are permitted.*"),
    ("bsdSource", r"(?:\W*\d?\W*)?redistributions of source code must retain the above copyright notice.*"),
    ("bsdBinary", r"(?:\W*\d?\W*)?redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsdAdvert", r"(?:\W*\d?\W*)?all advertising materials mentioning features or use of this software.*"),
    ("bsdName", r"(?:\W*\d?\W*)?neither the names? of .* may be used to endorse or promote products.*"),
    ("bsdAsIs", r"this software is provided by .* as is and any express or implied warranties.*"),
    ("bsd3Name", r"(?:this .{0,60} is )?(?:licensed|released|distributed) under (?:the |a )?(?:terms of the )?(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd) licen[sc]e.*"),
    ("bsd2Name", r"(?:this .{0,60} is )?(?:licensed|released|distributed) under (?:the |a )?(?:terms of the )?(?:bsd 2 clause|2 clause bsd|simplified bsd) licen[sc]e.*"),
    ("iscGrant", r"permission to use,? copy,? modify,? and(?: or)? distribute this software for any purpose with or without fee is hereby granted.*"),
    ("agpl3Plus", r".*gnu affero general public licen[sc]e.*(?:version 3|v3).*(?:any later version|or later).*"),
    ("lgpl3Plus", r".*gnu lesser general public licen[sc]e.*(?:version 3|v3).*(?:any later version|or later).*"),
    ("lgpl21Plus", r".*gnu lesser general public licen[sc]e.*(?:version 2\.1|v2\.1).*(?:any later version|or later).*"),
    ("gpl3Plus", r".*gnu general public licen[sc]e.*(?:version 3|v3).*(?:any later version|or later).*"),
    ("gpl2Plus", r".*gnu general public licen[sc]e.*(?:version 2|v2).*(?:any later version|or later).*"),
    ("agpl3", r".*(?:under|of) the gnu affero general public licen[sc]e.*(?:version 3|v3).*"),
    ("lgpl3", r".*(?:under|of) the gnu lesser general public licen[sc]e.*(?:version 3|v3).*"),
    ("lgpl21", r".*(?:under|of) the gnu lesser general public licen[sc]e.*(?:version 2\.1|v2\.1).*"),
    ("gpl3", r".*(?:under|of) the gnu general public licen[sc]e,? (?:\w+ ){0,8}?(?:version 3|v3).*"),
    ("gpl2", r".*(?:under|of) the gnu general public licen[sc]e,? (?:\w+ ){0,8}?(?:version 2|v2).*"),
    ("gplNoWarranty", r"this (?:program|software|library) is distributed in the hope that it will be useful,? but without any warranty.*"),
    ("gplDetails", r"see the gnu (?:lesser |affero )?general public licen[sc]e for more details"),
    ("mpl2", r"this source code form is subject to the terms of the mozilla public licen[sc]e,? v ?\.? ?2\.0"),
    ("epl2", r".*under the terms of the eclipse public licen[sc]e,? (?:v\.?|version )? ?2\.0.*"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("cc0", rf".*(?:licensed|released|dedicated|available).* under {_CC} ?(?:0|zero)\b.*"),
    ("ccByNcSa", rf".*(?:licensed|released|available|distributed) under {_CC} (?:by nc sa|attribution non ?commercial share ?alike) (\d\.\d).*"),
    ("ccByNcNd", rf".*(?:licensed|released|available|distributed) under {_CC} (?:by nc nd|attribution non ?commercial no ?deriv\w*) (\d\.\d).*"),
    ("ccByNc", rf".*(?:licensed|released|available|distributed) under {_CC} (?:by nc|attribution non ?commercial) (\d\.\d).*"),
    ("ccBySa", rf".*(?:licensed|released|available|distributed) under {_CC} (?:by sa|attribution share ?alike) (\d\.\d).*"),
    ("ccByNd", rf".*(?:licensed|released|available|distributed) under {_CC} (?:by nd|attribution no ?deriv\w*) (\d\.\d).*"),
    ("ccBy", rf".*(?:licensed|released|available|distributed) under {_CC} (?:by|attribution) (\d\.\d).*"),
    ("allRights", r"(?:copyright .*)?all rights reserved"),
    ("spdx", r"spdx licen[sc]e identifier ([a-z0-9.+ ]+)"),
)
# Parts of which every known sentence has one.
NEEDS = (
    "licen[sc]e",
    "permission",
    "portions",
    "warrant",
    "liable",
    "redistribution",
    "advertising",
    "endorse",
    "unencumbered",
    "creative",
    "cc",
    "reserved",
)
#: "cc" begins a word; what stands before it in a text is no letter.
NEEDED = "(?i)" + "|".join(rf"(?<!\p{{L}}){n}" if n == "cc" else n for n in NEEDS)
#: A sentence matches this if and only if it matches one of the patterns.
KNOWN = "^(?:" + "|".join(f"(?:{p})" for _, p in SENTENCES) + ")$"
# Rules in the order in which they are tried. "<id>" is a sentence, with its version where it has one.
RULES = (
    ("BSD-4-Clause", "<bsdGrant><bsdSource><bsdBinary><bsdAdvert><bsdName>(?:<bsdAsIs>)?(?:<noLiability>)?"),
    ("BSD-3-Clause", "<bsdGrant><bsdSource><bsdBinary><bsdName>(?:<bsdAsIs>)?(?:<noLiability>)?"),
    ("BSD-2-Clause", "<bsdGrant><bsdSource><bsdBinary>(?:<bsdAsIs>)?(?:<noLiability>)?"),
    ("MIT", "<mitGrant><mitNotice>(?:<softwareAsIs>)?(?:<noLiability>)?"),
    ("ISC", "<iscGrant>(?:<softwareAsIs>)?(?:<noLiability>)?"),
    ("Apache-2.0", "<apache2>(?:<apacheUse>)?(?:<apacheCopy>)?(?:<apacheAsIs>)?"),
    ("AGPL-3.0-or-later", "<agpl3Plus>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("LGPL-3.0-or-later", "<lgpl3Plus>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("LGPL-2.1-or-later", "<lgpl21Plus>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("GPL-3.0-or-later", "<gpl3Plus>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("GPL-2.0-or-later", "<gpl2Plus>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("AGPL-3.0", "<agpl3>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("LGPL-3.0", "<lgpl3>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("LGPL-2.1", "<lgpl21>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("GPL-3.0", "<gpl3>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("GPL-2.0", "<gpl2>(?:<gplNoWarranty>)?(?:<gplDetails>)?"),
    ("MIT", "<mitName>"),
    ("BSD-3-Clause", "<bsd3Name>"),
    ("BSD-2-Clause", "<bsd2Name>"),
    ("MPL-2.0", "<mpl2>"),
    ("EPL-2.0", "<epl2>"),
    ("Unlicense", "<unlicense>"),
    ("CC0-1.0", "<cc0>"),
    ("CC-BY-NC-SA-$1", r"<ccByNcSa ([0-9.]+)>"),
    ("CC-BY-NC-ND-$1", r"<ccByNcNd ([0-9.]+)>"),
    ("CC-BY-NC-$1", r"<ccByNc ([0-9.]+)>"),
    ("CC-BY-SA-$1", r"<ccBySa ([0-9.]+)>"),
    ("CC-BY-ND-$1", r"<ccByNd ([0-9.]+)>"),
    ("CC-BY-$1", r"<ccBy ([0-9.]+)>"),
    ("SPDX:$1", r"<spdx ([a-z0-9.+-]+)>"),
    ("proprietary", "<allRights>"),
)


def _normal(sentence: Column) -> Column:
    """Lower case, one blank between words; what is neither letter, digit, ".", "," nor "+" becomes a blank."""
    words = F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}.,+]+", " ")
    return F.regexp_replace(F.regexp_replace(words, r" +([.,])", "$1"), r"^[ .,]+|[ .,]+$", "")


def sentences(text: Column, lines: bool) -> Column:
    """Normalised sentences that may be known ones: up to a stop before a blank, and to a line's end too if ``lines``.

    A semicolon ends none, nor does the stop of "v." before a number.
    """
    gap = r"\s*\n\s*" if lines else r"\n\s*\n\s*"
    # a licence identifier with its mark is a sentence
    kept = F.regexp_replace(text, r"(?i)spdx-license-identifier\s*:\s*([a-z0-9.+-]+)", "\x01spdx license identifier $1\x01")
    kept = F.regexp_replace(kept, r"(?i)\bv\.[ \t\n\r]+([0-9])", "v.$1")
    cut = F.regexp_replace(F.regexp_replace(kept, gap, "\x01"), r"([.!?:])\s+", "$1\x01")
    maybe = F.filter(F.split(cut, "\x01"), lambda s: s.rlike(NEEDED))
    return F.filter(F.transform(maybe, _normal), lambda s: s != "")


def identifier(sentence: Column) -> Column:
    """"<id>" or "<id version>" of the first pattern that the whole sentence matches, else null."""
    found = F.lit(None).cast("string")
    for name, pattern in reversed(SENTENCES):
        whole = f"^(?:{pattern})$"
        if "(\\d\\.\\d)" in pattern or name == "spdx":
            part = F.replace(F.trim(F.regexp_extract(sentence, whole, 1)), F.lit(" "), F.lit("-"))
            value = F.concat(F.lit(f"<{name} "), part, F.lit(">"))
        else:
            value = F.lit(f"<{name}>")
        found = F.when(sentence.rlike(whole), value).otherwise(found)
    return F.when(sentence.rlike(KNOWN), found)


def _apply_rules(sequence: Column) -> Column:
    """Licences of a sequence of identifiers, in the order of the rules."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(pattern).alias("pattern")) for name, pattern in RULES])
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hits = F.regexp_extract_all(state["rest"], F.concat(F.lit("("), rule["pattern"], F.lit(")")), F.lit(1))
        names = F.transform(hits, lambda hit: F.regexp_replace(hit, rule["pattern"], rule["name"]))
        return F.struct(
            F.regexp_replace(state["rest"], rule["pattern"], F.lit("|")).alias("rest"),
            F.concat(state["found"], names).alias("found"),
        )

    return F.aggregate(rules, start, step, lambda state: state["found"])


def scan_licenses(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``sentence_ids`` (known sentences in text order) and ``licenses`` (sorted, each once) of every row.

    Sentences are looked for line by line and, for wrapped texts, across lines; the licences of both readings count, and
    ``sentence_ids`` is the reading that knows more sentences. A null or empty text has none; repeated rows are scanned each for itself; an empty
    table gives an empty result; columns other than ``keep`` and ``text`` are not read.
    """
    # what lacks every needed part is as good as empty
    text = F.when(F.col("text").rlike(NEEDED), F.col("text")).otherwise(F.lit(""))
    none = F.array().cast("array<string>")

    def ids(lines: bool) -> Column:
        return F.filter(F.transform(sentences(text, lines), identifier), lambda i: i.isNotNull())

    read = documents.select(*keep, ids(True).alias("by_line"), ids(False).alias("across"))
    both = F.array_union(_apply_rules(F.array_join("by_line", "")), _apply_rules(F.array_join("across", "")))
    any_id = (F.size("by_line") > 0) | (F.size("across") > 0)
    more = F.when(F.size("across") > F.size("by_line"), F.col("across")).otherwise(F.col("by_line"))
    return read.select(
        *keep,
        more.alias("sentence_ids"),
        F.when(any_id, F.array_sort(F.array_distinct(both))).otherwise(none).alias("licenses"),
    )
