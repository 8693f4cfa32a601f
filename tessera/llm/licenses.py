"""Licence recognition by sentences and ordered rules.

Texts are cut into sentences, each is normalised (lower case, letters and
digits only) and looked up among known licence sentences, also where it is
wrapped over lines, with comment marks before them; the identifiers found, in
the order of the text, are matched against licence rules, the more specific
first.  Only DataFrame functions are used.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, without

#: licence: (SPDX name, verdict, names in running text, names after the SPDX tag), the stricter verdicts first.
#: The public licences' own names, normalised.
LICENCES = {
    "ccbync4": ("CC-BY-NC-4.0", "restricted", [], ["cc by nc 4 0"]),
    "gpl3": ("GPL-3.0", "copyleft", ["gnu general public license version 3", "gnu general public license v3 0", "gnu general public license v3",
             "gnu general public license version 3 or later", "gnu gpl v3", "gnu gplv3"], ["gpl 3 0 only", "gpl 3 0 or later", "gpl 3 0"]),
    "gpl2": ("GPL-2.0", "copyleft", ["gnu general public license version 2", "gnu general public license v2 0", "gnu general public license v2",
             "gnu general public license version 2 or later", "gnu gpl v2", "gnu gplv2"], ["gpl 2 0 only", "gpl 2 0 or later", "gpl 2 0"]),
    "agpl3": ("AGPL-3.0", "copyleft", ["gnu affero general public license version 3", "gnu affero general public license v3 0",
              "gnu affero general public license v3", "gnu agpl v3", "gnu agplv3"], ["agpl 3 0 only", "agpl 3 0 or later", "agpl 3 0"]),
    "lgpl3": ("LGPL-3.0", "copyleft", ["gnu lesser general public license version 3", "gnu lesser general public license v3 0",
              "gnu lesser general public license v3", "gnu lgpl v3", "gnu lgplv3"], ["lgpl 3 0 only", "lgpl 3 0 or later", "lgpl 3 0"]),
    "lgpl21": ("LGPL-2.1", "copyleft", ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "gnu lgpl v2 1"],
               ["lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 2 1"]),
    "ccbysa4": ("CC-BY-SA-4.0", "copyleft", [], ["cc by sa 4 0"]),
    "mpl2": ("MPL-2.0", "copyleft", ["mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v2 0"], ["mpl 2 0"]),
    "epl2": ("EPL-2.0", "copyleft", ["eclipse public license version 2 0", "eclipse public license 2 0", "eclipse public license v2 0",
             "eclipse public license v 2 0"], ["epl 2 0"]),
    "isc": ("ISC", "permissive", ["isc license"], ["isc"]),
    "ccby4": ("CC-BY-4.0", "permissive", [], ["cc by 4 0"]),
    "apache2": ("Apache-2.0", "permissive", ["apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license"],
                ["apache 2 0"]),
    "mit": ("MIT", "permissive", ["mit license", "mit licence"], ["mit"]),
    "bsd3": ("BSD-3-Clause", "permissive", ["bsd 3 clause license", "3 clause bsd license", "new bsd license"], ["bsd 3 clause"]),
    "bsd2": ("BSD-2-Clause", "permissive", ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"], ["bsd 2 clause"]),
    "bsl1": ("BSL-1.0", "permissive", ["boost software license version 1 0", "boost software license 1 0"], ["bsl 1 0"]),
    "zlib": ("Zlib", "permissive", ["zlib license"], ["zlib"]),
    "cc0": ("CC0-1.0", "permissive", ["cc0 1 0 universal license", "creative commons zero v1 0 universal license"], ["cc0 1 0"]),
    "unlicense": ("Unlicense", "permissive", ["unlicense"], ["unlicense"]),
}
#: what a notice begins with and may end with
LEADS = ["licensed under", "released under", "distributed under", "available under", "this project is licensed under", "this software is licensed under",
         "this work is licensed under", "this code is licensed under", "this project is released under", "this software is released under",
         "this software is distributed under", "this project is distributed under", "it is licensed under"]
TAILS = ["the license", "see the license file for details", "see license for details", "see license file for details", "see license for more information",
         "see the license md file for details", "see license md for details", "see license txt for details", "see the license file for more information",
         "see license txt for more information", "at your option"]
#: free software headers: licence family, its versions
FAMILIES = {"gpl": ("gnu general public license", {"2": "2", "3": "3"}), "lgpl": ("gnu lesser general public license", {"21": "2 1", "3": "3"}),
            "agpl": ("gnu affero general public license", {"3": "3"})}
SUBJECTS = ["this program is free software", "this library is free software", "this file is free software"]
#: other normalised sentences -> identifier (fixed values: wording of public licences).  Where the wording has a break
#: inside ('Identifier: MIT', 'software; you can', 'v. 2.0'), the parts between the breaks are sentences too.
WORDINGS = {
    "you may not use this file except in compliance with the license": "apache2_use",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2_copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2_warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache2_see",
    "the mit license": "mit_title",
    "mit license": "mit_title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_warranty",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_warranty",
    "see the gnu general public license for more details": "gpl_see",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_names",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2_notice",
    "this is free and unencumbered software released into the public domain": "unlicense_notice",
    "licensed under cc by nc 4 0": "ccbync4_notice",
    "licensed under cc by 4 0": "ccby4_notice",
    "licensed under cc by sa 4 0": "ccbysa4_notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4_notice",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa4_notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4_notice",
    "all rights reserved": "reserved",
    "spdx license identifier": "spdx_tag",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl_warranty",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2_notice",
    "this library is distributed in the hope that it will be useful but without any warranty": "gpl_warranty",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_warranty",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2_notice",
    "boost software license version 1 0": "bsl1_notice",
    "see the gnu lesser general public license for more details": "gpl_see",
    "see the gnu affero general public license for more details": "gpl_see",
}


def _terms(family: str) -> str:
    return f"you can redistribute it and or modify it under the terms of the {family} as published by the free software foundation"


def _either(version: str) -> str:
    return f"either version {version} of the license or at your option any later version"


def _known() -> dict[str, str]:
    """All known sentences: the wordings, the free software headers in whole
    and in parts, and the names with and without the tag before them."""
    out = dict(WORDINGS)
    for f, (family, versions) in FAMILIES.items():
        out[_terms(family)] = f"{f}_terms"
        for v, version in versions.items():
            out[_either(version)] = f"version{v}_later"
            for subject in ["", *[x + " " for x in SUBJECTS]]:
                out[f"{subject}{_terms(family)} {_either(version)}"] = f"{f}{v}_later"
    for x, (_, _, _, tagged) in LICENCES.items():
        out |= {t: f"name_{x}" for t in tagged} | {f"spdx license identifier {t}": f"spdx_{x}" for t in tagged}
    return out


SENTENCES = _known()
#: name in running text -> identifier of its notice
NOTICES = {name: f"{x}_notice" for x, (_, _, names, _) in LICENCES.items() for name in names}
TAG, CHOICE = "spdx license identifier", "choice"


def _rules() -> list[tuple[str, str, str, list[str]]]:
    """(rule, licence, verdict, identifiers that occur in this order), first
    match first; a rule with several wordings has several lines.  Whole texts
    and headers come first, then notices and tags, the stricter first."""
    out = [
        ("apache2_header", "Apache-2.0", "permissive", ["apache2_notice", "apache2_use", "apache2_warranty"]),
        ("mit_text", "MIT", "permissive", ["mit_grant", "mit_condition", "mit_warranty"]),
        ("bsd3_text", "BSD-3-Clause", "permissive", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
        ("bsd2_text", "BSD-2-Clause", "permissive", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ]
    headers = [(f, v) for f in ("gpl", "agpl", "lgpl") for v in sorted(FAMILIES[f][1], key=lambda v: v[0], reverse=True)]
    later = [(f"{f}{v}", LICENCES[f"{f}{v}"][0] + "-or-later", ids) for f, v in headers for ids in ([f"{f}{v}_later"], [f"{f}_terms", f"version{v}_later"])]
    out += [(f"{x}_header", name, "copyleft", [*ids, "gpl_warranty"]) for x, name, ids in later]
    for x, (name, verdict, names, tagged) in LICENCES.items():
        out += [(f"{x}_later", n, "copyleft", ids) for y, n, ids in later if y == x]
        if x == "apache2":
            out.append(("apache2_copy", name, verdict, ["apache2_notice", "apache2_copy"]))
        if x == "mit":
            out.append(("mit_titled", name, verdict, ["mit_title", "mit_grant"]))
        if x == "isc":
            out.append(("isc_text", name, verdict, ["isc_grant"]))
        out.append((x, name, verdict, [f"{x}_notice"]))
        out += [(f"{x}_spdx", name, verdict, ids) for ids in ([f"spdx_{x}"], ["spdx_tag", f"name_{x}"])]
    return [*out, ("reserved", "proprietary", "restricted", ["reserved"])]


RULES = _rules()
ADDED = ["sentence_ids", "rules", "licenses", "license", "verdict"]
#: every known sentence holds one of these
HINT = "(?i)licen[sc]e|permission|redistribut|free software|copyright|public domain|warrant|rights reserved|gnu|apache.2.0" \
    "|(licensed|released|distributed|available) under"


def _either_of(items, gap: str) -> str:
    return "(?:" + "|".join(s.replace(" ", gap) for s in sorted(items, key=lambda x: (-len(x), x))) + ")"


def wordings(gap: str) -> tuple[str, str]:
    """Patterns of a whole sentence, and of what may follow the SPDX tag: a
    name, or names joined by 'or' and 'and'.  ``gap`` stands for the blanks.
    The longer of two wordings that begin alike comes first."""
    fixed = _either_of([s for s, i in SENTENCES.items() if not i.startswith("name_")], gap)
    name = _either_of(NOTICES, gap)
    more = f"(?:{gap}or{gap}(?:the{gap})?{name})?"
    notice = f"{_either_of(LEADS, gap)}{gap}(?:either{gap}(?:of{gap})?)?(?:the{gap})?{name}{more}(?:{gap}{_either_of(TAILS, gap)})?"
    tagged = _either_of([s for s, i in SENTENCES.items() if i.startswith("name_")], gap)
    return f"(?:{notice}|{fixed})", f"{tagged}(?:{gap}(?:or|and){gap}{tagged})*"


#: of a notice, all but its licences' names; and what stands between these
AROUND = (f"^(?:{'|'.join(LEADS)}) (?:either (?:of )?)?(?:the )?", f" (?:{'|'.join(sorted(TAILS, key=len, reverse=True))})$")
BETWEEN = " (?:or|and) (?:the )?"


def _lookup(sentence: Column, tagged: Column) -> Column:
    """Identifiers of one found sentence: its own, or those of the licences
    that a notice or tag names, after ``choice`` where there are several."""
    known, notices = (F.create_map(*[F.lit(x) for pair in m.items() for x in pair]) for m in (SENTENCES, NOTICES))
    own = F.try_element_at(known, sentence)
    bare = F.regexp_replace(F.regexp_replace(sentence, AROUND[0], ""), AROUND[1], "")
    single = F.coalesce(F.when(tagged, own), F.try_element_at(notices, bare))
    names = F.filter(F.transform(F.split(bare, BETWEEN), lambda p: F.when(tagged, F.try_element_at(known, p)).otherwise(
        F.try_element_at(notices, p))), lambda x: x.isNotNull())
    several = F.when(F.size(names) > 1, F.concat(F.array(F.lit(CHOICE)), names)).otherwise(names)
    return F.when(~tagged & own.isNotNull(), F.array(own)).when(single.isNotNull(), F.array(single)).otherwise(several)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.  A sentence
    ends at . ! ? ; : before white space, at a line without letters and
    digits, or at any line feed; it may also go on over single line feeds
    and the comment marks around them.  Of the known sentences that begin at
    one place the longest counts."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    low = F.regexp_replace(F.concat(F.lit("\n"), low), "\n[^a-z0-9\n]+", "\n")  # comment marks
    # letters and digits, ' ' for what is between, '|' where a sentence ends and '~' for a line feed
    line = F.regexp_replace(F.regexp_replace(low, "[.!?;:](?=[ \t\r\n])", "\n\n"), "[^a-z0-9\n]+", " ")
    line = F.regexp_replace(F.regexp_replace(F.trim(line), "[ \n]*\n ?\n[ \n]*", "|"), " ?\n ?", "~")
    line = F.concat(F.lit("|"), line, F.lit("|"))
    whole, tagged = wordings("[ ~]")
    # the short name of a licence ('mit', a German word too) says something right after the tag only
    found = F.regexp_extract_all(line, F.lit(f"(?:(?<=[|~]{TAG})[|~]{tagged}|[|~]{whole})(?=[|~])"), F.lit(0))
    found = F.transform(found, lambda s: F.translate(F.substr(s, F.lit(2)), "~", " "))

    def ids(s: Column, i: Column) -> Column:
        return _lookup(s, (i > 0) & (F.get(found, i - 1) == TAG) & s.rlike(f"^{wordings(' ')[1]}$"))
    # the words of a hint may stand on two lines
    return F.when(text.rlike(HINT.replace(" ", "[^a-zA-Z0-9]+")), F.flatten(F.transform(found, ids))).otherwise(F.array().cast("array<string>"))


def ordered_pattern(ids: list[str]) -> str:
    """Pattern for ``ids`` in this order, others between, in ' id  id '."""
    return ".*".join(f" {i} " for i in ids)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids``, the ``rules`` that match in rule order,
    their distinct ``licenses``, and the first match's ``license`` and
    ``verdict`` (null where none matches).

    Whole texts are scanned; a null text is an empty one; repeated rows and
    sentences are reported each time; input columns named like the added ones
    are replaced."""
    docs = without(docs, ADDED)
    docs = docs.withColumn("sentence_ids", sentence_ids(F.coalesce(F.col(text), F.lit(""))))
    joined = F.concat(F.lit(" "), F.array_join("sentence_ids", "  "), F.lit(" "))
    hits = let(joined, lambda line: F.filter(F.array(*[
        F.when(line.rlike(ordered_pattern(ids)), F.struct(F.lit(r).alias("rule"), F.lit(lic).alias("license"),
                                                          F.lit(v).alias("verdict")))
        for r, lic, v, ids in RULES]), lambda h: h.isNotNull()))
    docs = docs.withColumn("__t_hits", F.when(F.size("sentence_ids") > 0, hits))
    return (docs.withColumn("rules", F.coalesce(F.transform("__t_hits", lambda h: h["rule"]), F.array().cast("array<string>")))
            .withColumn("licenses", F.coalesce(F.array_distinct(F.transform("__t_hits", lambda h: h["license"])),
                                               F.array().cast("array<string>")))
            .withColumn("license", F.get("__t_hits", F.lit(0))["license"])
            .withColumn("verdict", F.get("__t_hits", F.lit(0))["verdict"]).drop("__t_hits"))
