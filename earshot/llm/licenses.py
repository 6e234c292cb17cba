"""Licence recognition by sentences: known sentences become identifiers, and sequences of
identifiers are matched against ordered licence rules.

A text is cut into pieces at line ends and behind ``. ! ? ; :`` that white space follows. A piece is
normalised (lower case, every run of other characters than letters and digits, so comment marks
too, one blank). A sentence is the longest run of pieces that is known, within a paragraph and up
to a piece that ends in ``. ! ? ;``, so it may be wrapped over lines; a piece that begins none is an
unknown sentence, or nothing if it is the number of a list. Some wordings have a variable part, as the
owner's name; these may hold full stops (``OPEN``). An SPDX line is parsed as an expression and
gives one identifier per licence in it. Rules are tried in order at each known sentence; the first whose identifiers
follow each other there names the licence, and the search goes on behind it. Known sentences that
fit no rule are reported as ``unmatched``. An unknown sentence breaks a sequence, and an unknown
numbered clause behind a BSD notice leaves it unnamed, as it may be another licence.

Defined results: null and empty texts have no sentences; repeated notices are found each time but
named once in ``licenses``, in the order of their first sentence; repeated documents are scanned
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wordings of public licence notices, normalised, and the identifiers they get.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2",
    "licensed under the apache license version 2 0 the license": "apache2",
    "you may not use this file except in compliance with the license": "apache_use",
    "you may obtain a copy of the license at": "apache_copy",
    "http www apache org licenses license 2 0": "apache_url",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "this project is licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission": "bsd_endorse",
    "this work is licensed under the gnu general public license version 3": "gpl3",
    "licensed under the gnu general public license version 3": "gpl3",
    "licensed under the gnu general public license version 2": "gpl2",
    "this program is free software": "gnu_free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl_terms",
    "either version 2 of the license or at your option any later version": "v2_later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version": "gpl3_terms",
    "licensed under cc by nc 4 0": "ccbync4",
    "licensed under cc by 4 0": "ccby4",
    "licensed under cc by sa 4 0": "ccbysa4",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4",
    "this library is free software": "gnu_free",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2_terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl_terms",
    "either version 2 1 of the license or at your option any later version": "v21_later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version": "lgpl3_terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version": "agpl3_terms",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2",
}

# Names as they follow "licensed under the" and the like.
NAMED = {
    "apache license version 2 0": "apache2",
    "apache license 2 0": "apache2",
    "mit license": "mit",
    "isc license": "isc_grant",
    "mozilla public license 2 0": "mpl2",
    "gnu general public license version 2": "gpl2",
    "gnu general public license version 3": "gpl3",
}
SENTENCES |= {
    f"{subject}{verb} under the {terms}{name}": identifier
    for name, identifier in NAMED.items()
    for subject in ("", "this project is ", "this software is ", "this program is ", "this work is ")
    for verb in ("licensed", "released", "distributed")
    for terms in ("", "terms of the ")
}

# Wordings with a variable part of at most 200 characters.
VARIABLE = [
    (re.compile("neither the name of .{1,200} nor the names of (?:its|their|any) contributors may be used to endorse or promote products "
                "derived from this software without specific prior written permission"), "bsd_endorse"),
    (re.compile("the names? of .{1,200} may not be used to endorse or promote products "
                "derived from this software without specific prior written permission"), "bsd_endorse"),
]
OPEN = ("neither the name of ", "the name of ", "the names of ", "this source code form is subject ")  # these go on behind a full stop

# SPDX identifiers, short forms that are not used any more behind the present ones.
SPDX = {
    i.lower(): i
    for i in "Apache-2.0 MIT ISC BSD-2-Clause BSD-3-Clause GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only "
    "LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 "
    "CC0-1.0 Unlicense Zlib BSL-1.0 EPL-2.0".split()
}
SPDX |= {i.lower(): f"{i}-only" for i in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")}
SPDX |= {f"{i.lower()}+": f"{i}-or-later" for i in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")}

# Longer sequences first, as the first rule that fits wins.
RULES = [
    (("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"), "BSD-3-Clause"),
    (("bsd_grant", "bsd_source", "bsd_binary"), "BSD-2-Clause"),
    (("gnu_free", "gpl3_terms"), "GPL-3.0-or-later"),
    (("gnu_free", "gpl_terms", "v2_later"), "GPL-2.0-or-later"),
    (("gnu_free", "gpl2_terms"), "GPL-2.0-only"),
    (("gnu_free", "lgpl_terms", "v21_later"), "LGPL-2.1-or-later"),
    (("gnu_free", "lgpl3_terms"), "LGPL-3.0-or-later"),
    (("gnu_free", "agpl3_terms"), "AGPL-3.0-or-later"),
    (("mpl2",), "MPL-2.0"),
    (("apache2", "apache_use", "apache_copy", "apache_url"), "Apache-2.0"),
    (("apache2", "apache_use", "apache_copy"), "Apache-2.0"),
    (("apache2", "apache_use"), "Apache-2.0"),
    (("mit_grant", "mit_notice"), "MIT"),
    (("isc_grant",), "ISC"),
    (("apache2",), "Apache-2.0"),
    (("mit",), "MIT"),
    (("gpl3",), "GPL-3.0-only"),
    (("gpl2",), "GPL-2.0-only"),
    (("ccbync4",), "CC-BY-NC-4.0"),
    (("ccbysa4",), "CC-BY-SA-4.0"),
    (("ccby4",), "CC-BY-4.0"),
]
SPDX_RULES = [((f"spdx:{name}",), name) for name in sorted(set(SPDX.values()))]  # for identifiers, which are no sentences
CLAUSE = "another clause"  # stands for an unknown numbered one; never reported

HINTS = ("licen", "copyright", "redistribut", "program", "permission", "software")  # one is in every known sentence; single words, as lines may be wrapped
PIECE_END = re.compile(r"(?<=[.!?;:])\s")
LIST_NUMBER = re.compile(r"\W*[0-9]{1,2}[.):]\s*")
COMMENT_WORD = re.compile(r"\s*@?(?:rem|dnl)\s")  # marks of letters; the others fall to normalise()
SPDX_LINE = re.compile(r"spdx-license-identifier:[ \t]*([a-z0-9.+() \t-]+)")
LONGEST = max(map(len, SENTENCES))
_OTHER = re.compile(r"[^a-z0-9]+")


def normalise(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


def spdx_ids(expression: str) -> list[str] | None:
    """The licences of an SPDX expression in lower case, in order; None if it is not one.

    ``OR``, ``AND``, ``WITH`` and brackets are understood; a licence that is not known keeps its name.
    """
    tokens = [t for t in re.findall(r"[()]|[a-z0-9.+-]+", expression) if t.strip("-")]
    found, depth, wants, exception = [], 0, True, False
    for token in tokens:
        if token == "(" and wants and not exception:
            depth += 1
        elif token == ")" and not wants and depth:
            depth -= 1
        elif token in ("or", "and", "with") and not wants:
            wants, exception = True, token == "with"
        elif token not in ("(", ")", "or", "and", "with") and wants:
            if not exception:
                found.append(f"spdx:{SPDX.get(token, token)}")
            wants = exception = False
        else:
            return None
    return None if wants or depth else found


def known_sentence(sentence: str) -> str | None:
    """The identifier of a normalised sentence."""
    if (found := SENTENCES.get(sentence)) or not sentence.startswith(OPEN):
        return found
    return next((identifier for wording, identifier in VARIABLE if wording.fullmatch(sentence)), None)


def _pieces(text: str) -> list[tuple]:
    """(normalised, whether a sentence ends here, whether it is a list number, SPDX identifiers) of every non-empty piece."""
    pieces = []
    for line in text.split("\n"):
        if (tag := SPDX_LINE.search(line)) and (ids := spdx_ids(tag[1])):
            pieces.append((normalise(line), True, False, ids))
            continue
        blank = True
        if comment := COMMENT_WORD.match(line):
            line = line[comment.end() :]
        for i, part in enumerate(PIECE_END.split(line)):
            if words := normalise(part):
                number = not i and LIST_NUMBER.fullmatch(part) is not None
                pieces.append((words, part.rstrip().endswith((".", "!", "?", ";")), number, None))
                blank = False
        if blank and pieces:
            pieces[-1] = (pieces[-1][0], True, *pieces[-1][2:])
    return pieces


def sentence_ids(text: str | None) -> list[str | None]:
    """The identifier of every non-empty sentence, None for an unknown one and ``CLAUSE`` if that has a number."""
    if not text or not any(h in (low := text.lower()) for h in HINTS):
        return []
    pieces, ids, at, numbered = _pieces(low), [], 0, False
    while at < len(pieces):
        if pieces[at][3]:
            ids += pieces[at][3]
            at, numbered = at + 1, False
            continue
        run, found, behind = "", None, at + 1
        for end in range(at, len(pieces)):
            run = f"{run} {pieces[end][0]}" if run else pieces[end][0]
            if len(run) > LONGEST or pieces[end][3]:
                break
            if known := known_sentence(run):
                found, behind = known, end + 1
            if pieces[end][1] and not run.startswith(OPEN):
                break
        if found or not pieces[at][2]:
            ids.append(found or (CLAUSE if numbered else None))
        numbered = pieces[at][2] and not found
        at = behind
    return ids


def match_rules(ids: list[str | None]) -> tuple[list[str], list[str]]:
    """(licences in order, known sentences that fit no rule)."""
    found, rest, at = [], [], 0
    while at < len(ids):
        if ids[at] is not None and ids[at] != CLAUSE:
            for sequence, name in RULES + SPDX_RULES:
                more = name.startswith("BSD") and ids[at + len(sequence) : at + len(sequence) + 1] == [CLAUSE]
                if tuple(ids[at : at + len(sequence)]) == sequence and not more:
                    found.append(name)
                    at += len(sequence)
                    break
            else:
                rest.append(ids[at])
                at += 1
        else:
            at += 1
    return list(dict.fromkeys(found)), rest


def find_licenses(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with the known sentences, the licences and the unmatched sentences."""
    source = docs.select(*keep, F.col("text").alias("_text"))
    names = ["sentences", "licenses", "unmatched"]
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField(n, T.ArrayType(T.StringType())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [sentence_ids(t.as_py()) for t in batch["_text"]]
            matched = [match_rules(i) for i in ids]
            columns = [[x for x in i if x and x != CLAUSE] for i in ids], [m[0] for m in matched], [m[1] for m in matched]
            arrays = [pa.array(c, pa.list_(pa.string())) for c in columns]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *arrays], [*keep, *names])

    return source.mapInArrow(run, schema)
