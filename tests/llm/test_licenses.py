import re
import textwrap

from tessera.llm import licenses

MIT = ("MIT License\nCopyright (c) 2020 Someone\nPermission is hereby granted, free of charge, to any person obtaining a copy of "
       "this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
       "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
       "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
       "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
       "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
       "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")


def plain_ids(sentence, before):
    """Identifiers of one normalised sentence: known ones, then notices cut up by hand."""
    L = licenses
    names = {t: f"name_{x}" for x, (_, _, _, tagged) in L.LICENCES.items() for t in tagged}
    if before == L.TAG:
        if sentence in names:
            return [names[sentence]]
        parts = re.split(" or | and ", sentence)
        found = [names[p] for p in parts if p in names]
        return ["choice", *found] if len(found) > 1 and all(p in names for p in parts) else []
    if sentence in L.SENTENCES and sentence not in names:
        return [L.SENTENCES[sentence]]
    for lead in L.LEADS:
        if not sentence.startswith(lead + " "):
            continue
        rest = sentence[len(lead) + 1:]
        for tail in ["", *L.TAILS]:
            if tail and not rest.endswith(" " + tail):
                continue
            body = re.sub("^(either (of )?)?(the )?", "", rest[:len(rest) - len(tail) - 1] if tail else rest)
            if body in L.NOTICES:
                return [L.NOTICES[body]]
            parts = [re.sub("^the ", "", p) for p in re.split(" or ", body)]
            if len(parts) == 2 and all(p in L.NOTICES for p in parts):
                return ["choice", *[L.NOTICES[p] for p in parts]]
    return []


def slow(text):
    """Sentences one by one, rules as subsequences."""
    ids, before = [], None
    for s in re.split("\n", re.sub("[.!?;:][ \t\r]+", "\n", text or "")):
        low = "".join(c.lower() if c.isascii() else c for c in s)
        words = " ".join(re.findall("[a-z0-9]+", low))
        ids += plain_ids(words, before)
        before = words

    def inside(rule):
        it = iter(ids)
        return all(r in it for r in rule)
    hits = [r for r in licenses.RULES if inside(r[3])]
    return ids, [r[0] for r in hits], list(dict.fromkeys(r[1] for r in hits)), *(hits[0][1:3] if hits else (None, None))


CASES = [MIT, MIT.replace("The above", "x. The above"), "Licensed under the Apache License, Version 2.0.", "No sentence here.",
         "Prose. Released under the MIT License. More; all rights reserved! End", "SPDX-License-Identifier: MIT", None, "", "\n\n",
         "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "Licensed under the Apache License, Version 2.0 (the \"License\"); "
         "you may not use this file except in compliance with the License. Unless required by applicable law or agreed to in writing, "
         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
         "either express or implied.", "this project is licensed under the mit licenſe", "word " * 50_000 + ". All rights reserved."]


def test_against_sentence_by_sentence(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(CASES)] + [(0, CASES[0], "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string, _hits string")
    got = licenses.scan_licenses(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (list(r.sentence_ids), list(r.rules), list(r.licenses), r.license, r.verdict) == slow(r.text)
    assert licenses.scan_licenses(df.limit(0)).collect() == []
    found = {r.doc_id: r.license for r in got}
    assert found[0] == "MIT" and found[9] == "CC-BY-NC-4.0" and found[10] == "Apache-2.0" and found[3] is None


def test_every_known_sentence_passes_the_prefilter():
    L = licenses
    alone = {s for s, i in L.SENTENCES.items() if not i.startswith("name_")}
    assert all(re.search(L.HINT, s) for s in alone if not s.startswith("either version"))
    assert all(re.search(L.HINT, f"{lead} the {name}") for lead in L.LEADS for name in L.NOTICES)
    used = {i for r in L.RULES for i in r[3]}
    assert used - {f"{x}_notice" for x in L.LICENCES} <= set(L.SENTENCES.values())
    assert all(re.fullmatch(L.wordings(" ")[0], s) for s in alone) and re.fullmatch(L.wordings(" ")[1], "mit or apache 2 0 and isc")


APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
          "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
          "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
          "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
       "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
       "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD3 = BSD + (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.")
LESSER = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU %s General Public License as "
          "published by the Free Software Foundation; either version %s of the License, or (at your option) any later version.")
GPL = ("This program is free software%s you can redistribute it and/or modify it under the terms of the GNU General Public License as "
       "published by the Free Software Foundation%s either version %d of the License, or (at your option) any later version.")
NO_WARRANTY = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
               "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.")
CC = "This work is licensed under a Creative Commons Attribution%s 4.0 International License."
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
       "provided that the above copyright notice and this permission notice appear in all copies.")
#: the standard text of every rule
STANDARD = {
    "apache2_header": APACHE.replace("LICENSE-2.0 ", "LICENSE-2.0\n\n"), "mit_text": MIT, "bsd3_text": BSD3, "bsd2_text": BSD,
    "gpl3_header": GPL % (":", ",", 3) + NO_WARRANTY, "gpl2_header": GPL % (";", ";", 2) + NO_WARRANTY,
    "gpl3_later": GPL % (":", ",", 3), "gpl2_later": GPL % (";", ";", 2), "ccbync4": CC % "-NonCommercial",
    "agpl3_header": LESSER % ("Affero", "3") + NO_WARRANTY, "lgpl3_header": LESSER % ("Lesser", "3") + NO_WARRANTY,
    "lgpl21_header": LESSER % ("Lesser", "2.1") + NO_WARRANTY.replace("program", "library"),
    "agpl3_later": LESSER.replace("; either", ", either") % ("Affero", "3"), "lgpl3_later": LESSER % ("Lesser", "3"), "lgpl21_later": LESSER % ("Lesser", "2.1"),
    "ccbysa4": CC % "-ShareAlike", "ccby4": CC % "", "isc_text": ISC,
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
            "available at https://www.eclipse.org/legal/epl-2.0/",
    "apache2_copy": "Licensed under the Apache License, Version 2.0 (the \"License\"); You may obtain a copy of the License at "
                    "http://www.apache.org/licenses/LICENSE-2.0", "mit_titled": MIT.split(" The above")[0],
    "unlicense": "This is free and unencumbered software released into the public domain.", "reserved": "All rights reserved.",
}
for x, (_, _, names, tagged) in licenses.LICENCES.items():
    STANDARD[f"{x}_spdx"] = f"// SPDX-License-Identifier: {tagged[0].replace(' ', '-').upper()}\nint main();"
    if x not in STANDARD:
        STANDARD[x] = f"This project is licensed under the {names[0].title()}."


def test_standard_text_of_every_rule(spark):
    assert {r[0] for r in licenses.RULES} == set(STANDARD)
    df = spark.createDataFrame([*STANDARD.items(), ("gpl3_spdx", "SPDX-License-Identifier: GPL-3.0-or-later")], "rule string, text string")
    for r in licenses.scan_licenses(df).collect():
        assert r.rule in r.rules and list(r.rules) == slow(r.text)[1], (r.rule, r.rules)
    names = spark.createDataFrame([("We list: MIT\nBSD-3-Clause\nmit",), ("Mit dem Zug. mit",)], "text string")
    assert [r.license for r in licenses.scan_licenses(names).collect()] == [None, None]


#: lines as they stand in files and READMEs -> licences found, in rule order
LINES = {
    "SPDX-License-Identifier: MIT OR Apache-2.0": ["Apache-2.0", "MIT"], "# SPDX-License-Identifier: LGPL-3.0-only": ["LGPL-3.0"],
    "This project is licensed under the MIT License - see the LICENSE file for details.": ["MIT"],
    "This project is licensed under the MIT License - see the [LICENSE.md](LICENSE.md) file for details": [],
    "Distributed under the MIT License. See `LICENSE.txt` for more information.": ["MIT"],
    "Licensed under the Apache License, Version 2.0 or the MIT license, at your option.": ["Apache-2.0", "MIT"],
    "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": ["Apache-2.0", "MIT"],
    "/* SPDX-License-Identifier: GPL-2.0-only OR BSD-3-Clause AND MIT */": ["GPL-2.0", "MIT", "BSD-3-Clause"],
    "SPDX-License-Identifier: MIT OR Unknown-1.0": [], "Released under the GNU GPL v3": ["GPL-3.0"],
    "Released under the GNU General Public License, version 3 or later": ["GPL-3.0"],
    "This software is distributed under the\n// Mozilla Public License, Version 2.0": ["MPL-2.0"],
    "This code is licensed under the 3-Clause BSD License": ["BSD-3-Clause"], "licensed under the license": [], "MIT OR Apache-2.0": [],
    "Licensed under the MIT License or the moon": [], "Available under the Boost Software License, Version 1.0; enjoy": ["BSL-1.0"],
}


def test_lines_of_files_and_readmes(spark):
    got = {r.text: (list(r.licenses), r.license) for r in licenses.scan_licenses(spark.createDataFrame([(t,) for t in LINES], "text string")).collect()}
    assert got == {t: (found, found[0] if found else None) for t, found in LINES.items()}
    ids = licenses.scan_licenses(spark.createDataFrame([("SPDX-License-Identifier: MIT OR ISC",)], "text string")).first().sentence_ids
    assert ids == ["spdx_tag", "choice", "name_mit", "name_isc"]


def test_sql_states_the_operator(spark):
    """The oracle's statement on texts of every kind."""
    import duckdb

    from tessera.llm.queries import ORACLE_SQL, licence_columns
    texts = [*CASES, *STANDARD.values(), *LINES, *(f"# {t}" for t in LINES), *(textwrap.fill(t, 40) for t in STANDARD.values()), MIT * 3,
             "x\n\nmit\nSPDX-License-Identifier:\n MIT\n\nSPDX-License-Identifier: MIT AND\n ISC. mit", "All rights\n * reserved.. All rights reserved!! ok"]
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in licence_columns(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(ORACLE_SQL["op4_license_scan"]).fetchall()) == got


def test_wrapped_and_commented_texts(spark):
    rows = []
    for rule, text in STANDARD.items():
        for width in (30, 72):
            for first, mark, last in (("", "", ""), ("", "# ", ""), ("/*\n", " * ", "\n */"), ("", "// ", ""), ("", ";; ", ""), ("", "> ", " \r")):
                parts = [textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n")]
                body = "\n".join(parts).split("\n")
                rows.append((rule, "Head line\n\n" + first + "\n".join((mark + x).rstrip(" ") for x in body) + last + "\nint x;"))
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "rule string, text string")).collect():
        assert r.rule in r.rules, r.text


def test_what_ends_a_sentence(spark):
    cases = {"All rights\nreserved": ["reserved"], "# All\r\n# rights\r\n# reserved.\r\n# x": ["reserved"],
             "All rights\n\nreserved": [], "All rights\n#\n# reserved": [], "All rights.\nreserved": [], "All rights\nreserved it": [],
             "MIT License\nCopyright 2020 A\nAll rights reserved": ["mit_title", "reserved"],
             "x\nThe\nMIT License\nMIT License": ["mit_title", "mit_title"], "all rights reserved|all rights reserved": [],
             "x all rights reserved": [], "All rights reserved\nAll rights reserved!": ["reserved", "reserved"],
             "All rights reserved. " * 3 + "\n \n" * 30_000: ["reserved"] * 3, "~All rights reserved~": ["reserved"],
             "SPDX-License-Identifier: LPPL-1.3\nMIT\nAll rights reserved. Mit. mit\nMIT": ["spdx_tag", "reserved"],
             "SPDX-License-Identifier: LGPL-2.1\nMIT": ["spdx_tag", "name_lgpl21"],
             "<!-- SPDX-License-Identifier: MIT -->": ["spdx_tag", "name_mit"], "/*\n * SPDX-License-Identifier: MIT\n */": ["spdx_tag", "name_mit"]}
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    for r in licenses.scan_licenses(df).collect():
        assert list(r.sentence_ids) == cases[r.text], r.text[:60]
