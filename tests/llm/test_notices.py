"""Real notices of licences, wrapped as files have them."""

import pytest

from rosterline.llm import license_scan

GPL = """This program is free software{a} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{b} either version {n} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def licences(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.licences for r in license_scan.digests(license_scan.scan(df)).orderBy("doc_id").collect()]


def test_gpl_versions(spark):
    texts = [GPL.format(a=a, b=b, n=n) for n in (2, 3) for a, b in ((":", ","), (";", ";"))]
    assert licences(spark, [*texts, "This program is free software."]) == ["GPL-2.0-or-later"] * 2 + ["GPL-3.0-or-later"] * 2 + [""]


def test_one_sentence_has_one_identifier(monkeypatch):
    monkeypatch.setitem(license_scan.SENTENCES, "other", ["All rights reserved."])
    with pytest.raises(ValueError):
        license_scan.known()


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

{1} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAME = """
{2} Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_numbered_bsd(spark):
    leads = [("1.", "2.", "3."), ("(1)", "(2)", "(3)"), ("a)", "b)", "c)"), ("*", "*", "*")]
    texts = [t.format(*x) for t in (BSD, BSD + NAME) for x in leads]
    texts += ["\n".join(f"# {line}".rstrip() for line in t.replace("\n\n", "\n").split("\n")) for t in (texts[0], texts[4])]
    assert licences(spark, texts) == ["BSD-2-Clause"] * 4 + ["BSD-3-Clause"] * 4 + ["BSD-2-Clause", "BSD-3-Clause"]


def test_wrapped_last_condition_is_part_of_the_longer_licence(spark):
    one_line = lambda t: "\n".join(p.replace("\n", " ") for p in t.split("\n\n"))
    wrapped = one_line(BSD.format("1.", "2.")) + "\n" + NAME.format("", "", "3.")
    assert licences(spark, [wrapped, one_line(BSD.format("1.", "2."))]) == ["BSD-3-Clause", "BSD-2-Clause"]
    # Both, where a text holds both.
    assert licences(spark, [wrapped + "\n\nother\n\n" + BSD.format("1.", "2.")]) == ["BSD-2-Clause,BSD-3-Clause"]


def test_versions_tell_licences_apart(spark):
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. {}. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/{}/."
    lesser = GPL.replace("GNU General", "GNU Lesser General").replace("This program", "This library")
    affero = GPL.replace("GNU General", "GNU Affero General")
    texts = [mpl.format("2.0", "2.0"), mpl.format("1.1", "1.1"), lesser.format(a=";", b=";", n="2.1"), lesser.format(a=":", b=",", n="3"), affero.format(a=":", b=",", n="3")]
    assert licences(spark, texts) == ["MPL-2.0", "", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later"]


def test_a_cut_that_sheds_a_version_is_refused(monkeypatch):
    monkeypatch.setitem(license_scan.SENTENCES, "other", ["This software is under some licence. 2.0"])
    with pytest.raises(ValueError, match="parts the version"):
        license_scan.known()


def test_sixty_licences_by_their_own_sentences(spark):
    """Every rule's sentences give its licence, line by line and wrapped."""
    assert len({name for name, _ in license_scan.RULES}) >= 60
    texts, want = [], []
    for name, ids in license_scan.RULES:
        whole = "\n\n".join(license_scan.SENTENCES[i][0] for i in ids)
        texts += [whole, whole.replace(", ", ",\n  ")]
        want += [name, name]
    assert licences(spark, texts) == want
