"""Standard notices as they stand in files: wrapped, in comments, with numbered clauses."""

import textwrap

import pytest

from earshot.llm.licenses import match_rules, sentence_ids

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies.",
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission.",
)
GPL = "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"
GPL2 = (f"This program is free software; {GPL}; either version 2 of the License, or (at your option) any later version.",)
GPL3 = (f"This program is free software: {GPL}, either version 3 of the License, or (at your option) any later version.",)
NOTICES = [(MIT, "MIT"), (ISC, "ISC"), (BSD, "BSD-3-Clause"), (BSD[:3], "BSD-2-Clause"), (GPL2, "GPL-2.0-or-later"), (GPL3, "GPL-3.0-or-later")]


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# ", "dnl "])
@pytest.mark.parametrize("width", [40, 70, 80, 1000])
@pytest.mark.parametrize("between", ["\n", "\n\n"])
def test_wrapped_notices(mark, width, between):
    for paragraphs, name in NOTICES:
        text = "Copyright (c) 2020 A. Nobody\n\n" + between.join("\n".join(textwrap.wrap(p, width)) for p in paragraphs) + "\n\nTHE END"
        lines = "\n".join(mark + line for line in text.split("\n"))
        assert match_rules(sentence_ids(lines)) == ([name], []), (name, lines)


def test_spdx_tags():
    for tag, name in (("Apache-2.0", "Apache-2.0"), ("MIT", "MIT"), ("GPL-3.0-only", "GPL-3.0-only"), ("GPL-2.0-only", "GPL-2.0-only")):
        for line in (f"SPDX-License-Identifier: {tag}", f"// SPDX-License-Identifier:  {tag}\r", f"/* SPDX-License-Identifier: {tag} */"):
            assert match_rules(sentence_ids(f"{line}\n\nint main;")) == ([name], []), line


def test_sentences_are_not_joined_over_blank_lines_or_unknown_text():
    assert sentence_ids("Released under\n\nthe MIT License.") == [None, None]
    assert sentence_ids("not released under the\nMIT License.") == [None, None]
    assert match_rules(sentence_ids(BSD[0] + "\n\nOther text here.\n\n" + BSD[1])) == ([], ["bsd_grant", "bsd_source"])
    assert sentence_ids("Licensed under the GNU General Public License version\n3. More.") == ["gpl3", None]


@pytest.mark.parametrize("owner", ["Example Inc.", "the University of Somewhere, Dept. of Computing", "Foo & Bar GmbH"])
@pytest.mark.parametrize("width", [40, 80, 1000])
def test_a_named_owner_does_not_weaken_the_licence(owner, width):
    paragraphs = (*BSD[:3], BSD[3].replace("the copyright holder", owner))
    text = "\n".join("\n".join(textwrap.wrap(p, width)) for p in paragraphs) + "\n\nTHIS SOFTWARE IS PROVIDED AS IS."
    assert match_rules(sentence_ids(text)) == (["BSD-3-Clause"], [])


def test_an_unknown_clause_leaves_a_notice_unnamed():
    ids = sentence_ids("\n".join(BSD[:3]) + "\n3. All advertising materials must display a notice.\n")
    assert match_rules(ids) == ([], ["bsd_grant", "bsd_source", "bsd_binary"])
    disclaimed = sentence_ids("\n".join(BSD[:3]) + "\n\nThis software is provided as is.")
    assert match_rules(disclaimed) == (["BSD-2-Clause"], [])


def test_spdx_expressions():
    cases = {
        "GPL-2.0": ["GPL-2.0-only"],
        "GPL-2.0+": ["GPL-2.0-or-later"],
        "BSD-3-Clause": ["BSD-3-Clause"],
        "GPL-3.0-or-later": ["GPL-3.0-or-later"],
        "MIT OR Apache-2.0": ["MIT", "Apache-2.0"],
        "(MIT AND BSD-2-Clause) OR GPL-2.0-only WITH Classpath-exception-2.0": ["MIT", "BSD-2-Clause", "GPL-2.0-only"],
    }
    for expression, names in cases.items():
        for line in (f"SPDX-License-Identifier: {expression}", f"<!-- SPDX-License-Identifier: {expression} -->", f"/* SPDX-License-Identifier: {expression} */\r"):
            assert match_rules(sentence_ids(f"{line}\nint main;")) == (names, []), line
    assert match_rules(sentence_ids("SPDX-License-Identifier: LicenseRef-own OR MIT")) == (["MIT"], ["spdx:licenseref-own"])
    for broken in ("MIT OR", "(MIT", "MIT Apache-2.0", "OR MIT", ")"):
        assert match_rules(sentence_ids(f"SPDX-License-Identifier: {broken}"))[0] == [], broken


def test_further_families():
    gnu = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
    later = "either version {} of the License, or (at your option) any later version."
    cases = {
        f"This library is free software; {gnu.format('Lesser General Public License')}; {later.format('2.1')}": "LGPL-2.1-or-later",
        f"This library is free software: {gnu.format('Lesser General Public License')}, {later.format('3')}": "LGPL-3.0-or-later",
        f"This program is free software: {gnu.format('Affero General Public License')}, {later.format('3')}": "AGPL-3.0-or-later",
        f"This program is free software; {gnu.format('General Public License version 2')}.": "GPL-2.0-only",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not": "MPL-2.0",
        "Released under the Apache License 2.0.": "Apache-2.0",
        "This software is distributed under the terms of the MIT license.": "MIT",
    }
    for text, name in cases.items():
        for width in (30, 70, 1000):
            assert match_rules(sentence_ids("\n".join(textwrap.wrap(text, width)))) == ([name], []), text
