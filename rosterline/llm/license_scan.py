"""Licences in texts by sentences and rules.

A text is cut into sentences, each normalised (small letters, blanks for everything but letters, digits, dots and plus
signs) and looked up in a table of known licence sentences. What remains is a sequence of sentence identifiers, with
``-`` for any stretch of unknown sentences. Rules are sequences of identifiers with a licence each; they are tried in
order, and what a rule matches is taken out of the sequence, so that short rules see only what longer ones left.

Texts are cut in two ways, at line ends and sentence signs, and at sentence signs and empty lines only (for wrapped
paragraphs). A licence is reported if either way finds it, but a rule that only one way finds gives way to a longer rule that
the other way finds and that holds it (a wrapped last condition makes BSD-3 of what looks like BSD-2 line by line).
Only built-in expressions on one pass over the rows, no exchange; the table and the rules are constants of the plan.

Null and empty texts have no sentences and no licence. Very long texts are cut whole, in memory in proportion to the text.
Rows are independent of each other: repeated rows give repeated results, an empty table an empty one. Of rules that match
the same sentences the first in order takes them. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base

# Sentences of public licences as their texts have them, by identifier.
SENTENCES = {
    "mit-line": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-asis": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "apache-line": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License");'],
    "apache-comply": ["you may not use this file except in compliance with the License."],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apache-asis": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-name": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "gpl3-line": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "gpl2-line": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    # "This program is free software" stands before a cut and tells no version; what follows it bears the identifiers.
    "gpl-free": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl2-free": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."],
    "gpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"],
    "gpl3-later": ["either version 3 of the License, or (at your option) any later version."],
    "gpl2-later": ["either version 2 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "mpl2-line": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "rights": ["All rights reserved."],
    "mit0-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.'],
    "0bsd-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "bsd-advert": ["All advertising materials mentioning features or use of this software must display the following acknowledgement:", "All advertising materials mentioning features or use of this software must display the following acknowledgment:"],
    "ncsa-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimers."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "boost-grant": ['Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'],
    "boost-line": ["Distributed under the Boost Software License, Version 1.0."],
    "postgresql-grant": ["Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."],
    "cc0-waiver": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."],
    "wtfpl-title": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"],
    "mpl11-line": ['The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License");'],
    "cddl-line": ['The contents of this file are subject to the terms of the Common Development and Distribution License (the "License").'],
    "epl1-line": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"],
    "epl2-line": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "cpl-line": ["This program and the accompanying materials are made available under the terms of the Common Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/cpl-v10.html"],
    "ofl-line": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "afl-line": ["Licensed under the Academic Free License version 3.0"],
    "osl-line": ["Licensed under the Open Software License version 3.0"],
    "ruby-line": ["Ruby is copyrighted free software by Yukihiro Matsumoto <matz@netlab.com>."],
    "openssl-credit": ['This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit. (http://www.openssl.org/)'],
    "apache11-credit": ["The end-user documentation included with the redistribution, if any, must include the following acknowledgment:"],
    "x11-name": ["Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium."],
    "lgpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;"],
    "lgpl21-later": ["either version 2.1 of the License, or (at your option) any later version."],
    "lgpl21-free": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."],
    "lgpl3-free": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation;"],
    "agpl3-free": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
}
# What the letters of a Creative Commons licence stand for.
CC_WORDS = {
    "by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
# Licences by the name that a line gives them.
NAMED = {
    "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "Zlib": "zlib License", "BSL-1.0": "Boost Software License 1.0",
    "CC0-1.0": "CC0 1.0 Universal License", "EPL-2.0": "Eclipse Public License 2.0", "MPL-2.0": "Mozilla Public License 2.0", "Artistic-2.0": "Artistic License 2.0",
    "LGPL-2.1-only": "GNU Lesser General Public License, version 2.1", "LGPL-3.0-only": "GNU Lesser General Public License, version 3",
    "AGPL-3.0-only": "GNU Affero General Public License, version 3", "OFL-1.1": "SIL Open Font License 1.1", "MS-PL": "Microsoft Public License", "MS-RL": "Microsoft Reciprocal License",
    "EUPL-1.2": "European Union Public License 1.2", "PostgreSQL": "PostgreSQL License", "NCSA": "University of Illinois/NCSA Open Source License", "UPL-1.0": "Universal Permissive License 1.0",
    "Vim": "Vim License", "ODbL-1.0": "Open Database License 1.0", "PDDL-1.0": "Public Domain Dedication and License 1.0", "ECL-2.0": "Educational Community License 2.0",
    "CECILL-2.1": "CeCILL License 2.1", "QPL-1.0": "Q Public License 1.0", "LPPL-1.3c": "LaTeX Project Public License 1.3c", "BlueOak-1.0.0": "Blue Oak Model License 1.0.0",
    "MulanPSL-2.0": "Mulan Permissive Software License 2.0", "0BSD": "Zero-Clause BSD License",
}
for _kind, _words in CC_WORDS.items():
    for _version, _port, _tail in (("4.0", "International", ""), ("3.0", "Unported", "-3.0")):
        _name = f"CC {_kind.upper()} {_version}"
        SENTENCES[f"cc-{_kind}{_tail}-line"] = [f"Licensed under {_name}.", f"This work is licensed under {_name}.", f"This work is licensed under a Creative Commons {_words} {_version} {_port} License."]
for _id, _name in NAMED.items():
    SENTENCES[f"line-{_id.lower()}"] = [f"{_lead} the {_name}." for _lead in ("Licensed under", "Released under", "This project is licensed under", "This work is licensed under")]
# Ordered rules: licence and sequence of identifiers. Longer rules stand before their parts.
RULES = [
    ("Apache-2.0", ["apache-line", "apache-comply", "apache-copy", "apache-asis"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis"]),
    ("ISC", ["isc-grant"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl-terms", "gpl2-later", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl-terms", "gpl2-later"]),
    ("MPL-2.0", ["mpl2-line"]),
    ("GPL-3.0-only", ["gpl3-line"]),
    ("GPL-2.0-only", ["gpl2-line"]),
    ("Apache-2.0", ["apache-line", "apache-comply"]),
    ("Apache-2.0", ["apache-line"]),
    ("MIT", ["mit-line"]),
    ("Unlicense", ["unlicense"]),
    ("GPL-3.0-or-later", ["gpl-terms", "gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("X11", ["x11-name"]),
    ("MIT-0", ["mit0-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("NCSA", ["ncsa-source"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("BSL-1.0", ["boost-line"]),
    ("PostgreSQL", ["postgresql-grant"]),
    ("CC0-1.0", ["cc0-waiver"]),
    ("WTFPL", ["wtfpl-title"]),
    ("MPL-1.1", ["mpl11-line"]),
    ("CDDL-1.0", ["cddl-line"]),
    ("EPL-1.0", ["epl1-line"]),
    ("EPL-2.0", ["epl2-line"]),
    ("CPL-1.0", ["cpl-line"]),
    ("OFL-1.1", ["ofl-line"]),
    ("AFL-3.0", ["afl-line"]),
    ("OSL-3.0", ["osl-line"]),
    ("Ruby", ["ruby-line"]),
    ("OpenSSL", ["openssl-credit"]),
    ("Apache-1.1", ["apache11-credit"]),
    ("LGPL-2.1-or-later", ["lgpl-terms", "lgpl21-later"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-3.0-or-later", ["lgpl-terms", "gpl3-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("AGPL-3.0-or-later", ["agpl-terms", "gpl3-later"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    *((f"CC-{kind.upper()}-{version}", [f"cc-{kind}{tail}-line"]) for kind in CC_WORDS for version, tail in (("4.0", ""), ("3.0", "-3.0"))),
    *((name, [f"line-{name.lower()}"]) for name in NAMED),
]
#: Every known sentence holds one of these words, so a text or sentence without them needs no look-up (``known`` checks it).
MARKS = ("licen", "permission", "copyright", "redistribut", "warrant", "software", "unencumbered", "reserved", "obtain")
#: Where a sentence ends: a sign before white space, but for the dot of "v. 2.0". Cut marks are line feeds.
SIGN = r"(?<!\bv)([.!?;:])\s+"
#: A sentence that is only the number or letter of a list item, and such a lead before a bracket, which no cut parts.
LIST_ITEM, LIST_LEAD = r"^(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})$", r"^[^a-z0-9]*(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})\)\s*"
LONE_END, EMPTY_LINE = r"\s*\n\s*", r"\n[ \t\r]*\n"


def normalised(sentence: str) -> str:
    """The same normal form as the expression below, for the table."""
    import re

    return re.sub(r"[^a-z0-9.+]+", " ", sentence.lower()).strip(" .")


def known() -> dict[str, str]:
    """Identifier by normalised sentence. Sentences that a cut would part enter as their parts, the first bearing the id."""
    import re

    table = {}
    for name, texts in SENTENCES.items():
        for text in texts:
            parts = [p for p in (normalised(x) for x in re.sub(SIGN, r"\1\n", text.lower()).split("\n")) if p]
            if any(c.isdigit() and not any(m in p for m in MARKS) for p in parts[1:] for c in p):
                raise ValueError(f"a cut parts the version from: {parts[0]}")
            if table.get(parts[0], name) != name:
                raise ValueError(f"two identifiers for: {parts[0]}")
            table[parts[0]] = name
            for part in parts[1:]:  # those without a mark stay unknown
                if any(m in part for m in MARKS):
                    table.setdefault(part, "")
    if missed := [x for x in table if not any(m in x for m in MARKS)]:
        raise ValueError(f"sentences without a mark: {missed}")
    return table


def marked(text: Column) -> Column:
    out = F.lit(False)
    for mark in MARKS:
        out = out | F.contains(text, F.lit(mark))
    return out


def sequence(text: Column, by_line: bool, table: dict[str, str] | None = None) -> Column:
    """Identifiers of the sentences of a text in small letters in order, ``-`` for each sentence that is unknown."""
    pairs = [F.lit(x) for kv in (table or known()).items() for x in kv]
    if by_line:
        cut = F.regexp_replace(text, SIGN, "$1\n")
    else:
        joined = F.regexp_replace(F.regexp_replace(text, EMPTY_LINE, "\x01"), LONE_END, " ")
        cut = F.regexp_replace(F.replace(joined, F.lit("\x01"), F.lit("\n")), SIGN, "$1\n")
    parts = F.filter(F.transform(F.split(cut, "\n"), lambda s: F.trim(s)), lambda s: s != "")

    def identifier(s):
        bare = lambda x: F.trim(F.regexp_replace(x, "[^a-z0-9.+]+", " "), F.lit(" ."))
        name = F.coalesce(F.element_at(F.create_map(*pairs), bare(F.regexp_replace(s, LIST_LEAD, ""))), F.lit("-"))
        return F.when(marked(s), name).when((F.length(s) < 16) & bare(s).rlike(LIST_ITEM), "").otherwise("-")

    return F.filter(F.transform(parts, identifier), lambda i: i != "")


def flat(ids: Column) -> Column:
    """The sequence as text with stretches of unknown sentences drawn together: ``<a><b>-<c>``."""
    return F.regexp_replace(F.array_join(F.transform(ids, lambda i: F.when(i == "-", "-").otherwise(F.concat(F.lit("<"), i, F.lit(">")))), ""), "-+", "-")


def matched(sequence_text: Column, rules=RULES) -> Column:
    """array of (licence, rule) in rule order: each rule takes what it matches out of the sequence."""
    rows = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids"), F.lit(k).alias("rule")) for k, (licence, ids) in enumerate(rules)])
    first = F.struct(sequence_text.alias("left"), F.array().cast("array<struct<licence:string,rule:int>>").alias("out"))

    def step(acc, rule):
        hit = F.contains(acc["left"], rule["ids"])
        one = F.struct(rule["licence"].alias("licence"), rule["rule"].alias("rule"))
        return F.struct(F.when(hit, F.replace(acc["left"], rule["ids"], F.lit("."))).otherwise(acc["left"]).alias("left"), F.when(hit, F.array_append(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    # Nothing is tried where no sentence is known.
    return F.when(F.contains(sequence_text, F.lit("<")), F.aggregate(rows, first, step, lambda acc: acc["out"])).otherwise(F.array().cast("array<struct<licence:string,rule:int>>"))


def holders(rules) -> dict[int, list[int]]:
    """For each rule the longer ones that hold its identifiers in a row."""
    ids = ["".join(f"<{i}>" for i in own) for _, own in rules]
    return {k: [j for j, other in enumerate(ids) if own in other and own != other] for k, own in enumerate(ids)}


def settled(own: Column, other: Column, rules) -> Column:
    """Findings of one cut without those that only it has where the other cut has a rule that holds theirs."""
    longer = [(k, js) for k, js in holders(rules).items() if js]
    if not longer:
        return own
    table = F.create_map(*[x for k, js in longer for x in (F.lit(k), F.array(*map(F.lit, js)))])
    seen = F.transform(other, lambda g: g["rule"])
    beaten = lambda f: ~F.array_contains(seen, f["rule"]) & F.coalesce(F.arrays_overlap(F.element_at(table, f["rule"]), seen), F.lit(False))
    return F.filter(own, lambda f: ~beaten(f))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """doc_id, licences (array, sorted), rules (array), n_known, sequence (by lines; one ``-`` for a text without marks)."""
    df = base.keyed_text(docs, id_col, text_col).select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    df = df.withColumn("marked", marked(F.col("text")))
    none = F.when(F.col("text").rlike(r"\S"), F.array(F.lit("-"))).otherwise(F.array().cast("array<string>"))
    cut = {k: F.when(F.col("marked"), sequence(F.col("text"), k == "lines")).otherwise(none) for k in ("lines", "paragraphs")}
    df = df.select("doc_id", *[v.alias(k) for k, v in cut.items()])
    df = df.select("doc_id", "lines", flat(F.col("lines")).alias("by_line"), flat(F.col("paragraphs")).alias("by_paragraph"))
    df = df.withColumns({"hits": matched(F.col("by_line"), rules), "wide": matched(F.col("by_paragraph"), rules)})
    df = df.withColumn("found", F.concat(settled(F.col("hits"), F.col("wide"), rules), settled(F.col("wide"), F.col("hits"), rules)))
    return df.select(
        "doc_id",
        F.array_sort(F.array_distinct(F.transform("found", lambda f: f["licence"]))).alias("licences"),
        F.array_sort(F.array_distinct(F.transform("found", lambda f: f["rule"]))).alias("rules"),
        F.size(F.filter("lines", lambda i: i != "-")).cast("long").alias("n_known"),
        F.col("by_line").alias("sequence"),
    )


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, licences and rules joined by commas, n_known, sequence of what ``scan`` returns."""
    return scanned.select("doc_id", F.array_join("licences", ",").alias("licences"), F.array_join(F.transform("rules", lambda r: r.cast("string")), ",").alias("rules"), "n_known", "sequence")
