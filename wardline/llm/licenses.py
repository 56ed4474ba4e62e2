"""License scans by conditional compression.

Paragraphs (neighbouring lines that hold words) with a cue word are candidate blocks; their lines are
joined, without comment marks and with words put together again that a hyphen splits at the end of a
line, so that cues and notices may be wrapped.  A template is judged in windows of at most
twice its size, wherever a block holds enough of its words.  The wording of a window is compressed
alone and with the template as raw zstandard dictionary: the more of the template it shares, the
more its size falls.  If that saves ``least_reduction`` of the template's own compressed size, the
window is compared word by word, and every stretch with differences of at most ``most_differences``
of the template's words is confirmed, unless it lacks a word that sets the template's license apart (a name,
a version), holds one of another license, or is denied; where such stretches overlap, the one with the fewest
differences counts, then the one that saves more bytes.  A notice that two licenses share counts for the one whose
further clause stands in the same paragraph.  One pass over the documents, no shuffle.

Defined results: null and empty texts have no blocks; every document has one result row,
repeated rows one each; ties go to the template that saves more bytes, then to its place; case and punctuation do not count;
lines of any length are compared whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from wardline.llm.common import pieces, prepare, texts_of

#: Words that every license line of interest holds one of (lower case).
CUES = ("licens", "licenc", "copyright", "rights reserved", "public domain", "creative commons", "permission is hereby", "redistribution and use", "permission to use",
        "general public")
_FREE = ("This {work} is free software: you can redistribute it and/or modify it under the terms of the {license} as published by the "
         "Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


def _gnu(kind: str, version: str, work: str = "program") -> tuple[str, ...]:
    name = f"GNU {kind}General Public License"
    short = {"": "GPL", "Lesser ": "LGPL", "Affero ": "AGPL"}[kind]
    spdx = f"{short}-{version}" if "." in version else f"{short}-{version}.0"
    return (f"This work is licensed under the {name}, version {version}.", f"Licensed under the {name} version {version}",
            _FREE.format(work=work, license=name, version=version), f"{name} v{version}",
            *[f"SPDX-License-Identifier: {spdx}{x}" for x in ("", "-only", "-or-later")])


def _cc(code: str, name: str, version: str) -> tuple[str, ...]:
    return (f"Licensed under CC {code} {version}.", f"This work is licensed under a Creative Commons {name} {version} International License.",
            f"Creative Commons {name} {version}", f"SPDX-License-Identifier: CC-{code}-{version}")


#: Short notices and headers of common licenses.
TEMPLATES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "Distributed under the MIT License.", "MIT License",
            "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Apache License 2.0", "Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    "GPL-3.0": _gnu("", "3"),
    "GPL-2.0": _gnu("", "2"),
    "LGPL-3.0": _gnu("Lesser ", "3"),
    "LGPL-2.1": _gnu("Lesser ", "2.1", "library"),
    "AGPL-3.0": _gnu("Affero ", "3"),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
                     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
                     "this software without specific prior written permission."),
    "ISC": ("ISC License", "Released under the ISC License.", "SPDX-License-Identifier: ISC",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY-4.0": _cc("BY", "Attribution", "4.0"),
    "CC-BY-3.0": _cc("BY", "Attribution", "3.0"),
    "CC-BY-SA-4.0": _cc("BY-SA", "Attribution-ShareAlike", "4.0"),
    "CC-BY-SA-3.0": _cc("BY-SA", "Attribution-ShareAlike", "3.0"),
    "CC-BY-NC-4.0": _cc("BY-NC", "Attribution-NonCommercial", "4.0"),
    "CC-BY-ND-4.0": _cc("BY-ND", "Attribution-NoDerivatives", "4.0"),
    "CC-BY-NC-SA-4.0": _cc("BY-NC-SA", "Attribution-NonCommercial-ShareAlike", "4.0"),
    "CC-BY-NC-ND-4.0": _cc("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives", "4.0"),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "all-rights-reserved": ("All rights reserved.",),
}
#: Words that set licenses apart.  A stretch has those of its template and no others.
APART = frozenset((
    "mit apache gnu general lesser affero mozilla bsd isc eclipse 2-clause 3-clause 4-clause cc cc0 by-sa by-nc by-nd by-nc-sa by-nc-nd attribution "
    "attribution-sharealike attribution-noncommercial attribution-noderivatives attribution-noncommercial-sharealike "
    "attribution-noncommercial-noderivatives sharealike noncommercial noderivatives spdx-license-identifier").split())
_VERSION = re.compile(r"v?\d+(?:\.\d+)*")
#: Words that deny what follows.
DENIALS = frozenset(("not", "never", "neither", "nor", "cannot", "isn", "aren"))
#: Words before a stretch in which a denial turns it down.
REACH = 5
#: A notice that begins another license too: in a paragraph that also holds the other's own clause it is the other.
BEGINS = {TEMPLATES["BSD-2-Clause"][-1]: TEMPLATES["BSD-3-Clause"][-1]}
#: Cues as they stand in running text, also wrapped and behind comment marks, or a word split by a hyphen.
_CUE = re.compile("|".join(r"[\W_]+(?:(?:rem|dnl|c)[\W_]+)?".join(cue.split()) for cue in CUES) + r"|-[ \t\r]*\n")
#: First parts of license identifiers.
_CODES = frozenset(("gpl", "lgpl", "agpl", "apache", "mpl", "bsd", "cc", "cc0"))
_WORD = re.compile(r"[^\W_]+(?:[-.][^\W_]+)*")


def wording(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def marks(words: list[str]) -> set[str]:
    """The words that set licenses apart, among ``words``."""
    out = {w for w in words if w in APART or _VERSION.fullmatch(w) or "-" in w and w.split("-")[0] in _CODES}
    # "This library is free software" says nothing of the license, "Library General Public License" does.
    return out | {"library" for a, b in zip(words, words[1:], strict=False) if (a, b) == ("library", "general")}


def paragraphs(text: str, own: set[str]) -> Iterator[tuple[list[str], list[int], list[int]]]:
    """(words, line of each word, place of each word in its line) of every paragraph of a text.  Comment
    marks that are words go, and words split at the end of a line are joined if ``own`` has them."""
    words, at, place, split = [], [], [], False
    for k, line in enumerate(text.split("\n")):
        found = wording(line)
        first = int(found[:1] in (["rem"], ["dnl"], ["c"]) and found[0] not in own)
        if first == len(found):
            if words:
                yield words, at, place
            words, at, place, split = [], [], [], False
            continue
        if split:
            whole = next((w for w in (f"{words[-1]}-{found[first]}", words[-1] + found[first]) if w in own), None)
            if whole:
                words[-1] = whole
                first += 1
        words += found[first:]
        at += [k] * (len(found) - first)
        place += range(first, len(found))
        split = line.rstrip().endswith("-")
    if words:
        yield words, at, place


def cue_lines(words: list[str], at: list[int]) -> set[int]:
    """Lines in which a cue begins."""
    low = " ".join(words)
    starts = [m.start() for cue in CUES for m in re.finditer(cue, low)]
    ends = np.cumsum([len(w) + 1 for w in words]) if starts else []
    return {at[k] for k in np.searchsorted(ends, starts, "right")}


class Matcher:
    def __init__(self, templates: dict[str, tuple[str, ...]], most_differences: float = 0.15, least_reduction: float = 0.1):
        self.least = least_reduction
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
        self.templates = []
        for name, texts in templates.items():
            for wanted in map(wording, texts):
                raw = zstandard.ZstdCompressionDict(" ".join(wanted).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                given = zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
                self.templates.append((name, wanted, int(most_differences * len(wanted)), self._size(wanted), given))
        self.ids = {w: k for k, w in enumerate(sorted({w for t in self.templates for w in t[1]}))}
        # Words of the templates, and their first parts up to a hyphen, which may end a line.
        self.known = {w[:k] for w in self.ids for k in [len(w), *(i for i, c in enumerate(w) if c == "-")]}
        self.own = [np.array([w in t[1] for w in self.ids] + [False]) for t in self.templates]
        self.apart = [marks(t[1]) for t in self.templates]
        place = {tuple(t[1]): k for k, t in enumerate(self.templates)}
        ends = [[place.get(tuple(wording(x))) for x in pair] for pair in BEGINS.items()]
        self.begins = {a: b for a, b in ends if a is not None and b is not None}
        self.denials = [sum(w in DENIALS for w in t[1]) for t in self.templates]

    def __call__(self, words: list[str]) -> list[tuple[int, str, int, float]]:
        """(first word, license, differing words, size reduction) of the licenses of a block, which do
        not overlap: the stretch with the fewest differences first, then the next beside it."""
        taken, out = [], []
        for found, _, k, start, end, reduction in sorted(self._confirmed(words)):
            at = bisect(taken, (start, end))
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
                taken.insert(at, (start, end))
                out.append((start, k, found, reduction))
        seen = {x[1] for x in out}
        return sorted((start, self.templates[self.begins[k] if self.begins.get(k) in seen else k][0], *rest) for start, k, *rest in out)

    def _fits(self, k: int, words: list[str], start: int, end: int) -> bool:
        """Whether a stretch has the words that set template k apart, no others of that kind, and is not denied."""
        part = words[start:end]
        return (marks(part) == self.apart[k]
                and sum(w in DENIALS for w in words[max(0, start - REACH):end]) <= self.denials[k])

    def _confirmed(self, words: list[str]) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(differing words, minus the bytes saved, template, start, end, size reduction) of the
        stretches of words that follow a template."""
        ids = np.array([self.ids.get(w, -1) for w in words], np.int64)
        for k, (_, wanted, most, size, given) in enumerate(self.templates):
            for start, end in self._windows(self.own[k][ids], len(wanted), most):
                part = words[start:end]
                saved = self._size(part) - len(given.compress(" ".join(part).encode()))
                if saved >= self.least * size:
                    for found, i, j in stretches(wanted, part, most):
                        if self._fits(k, words, start + i, start + j):
                            yield found, -saved, k, start + i, start + j, saved / size

    def _size(self, words: list[str]) -> int:
        return len(self.alone.compress(" ".join(words).encode()))

    @staticmethod
    def _windows(own: np.ndarray, n: int, most: int) -> Iterator[tuple[int, int]]:
        """Windows of at most twice a template's size.  A stretch of at most n + most words that shares
        at least n - most of them with the template lies whole in one of them."""
        span, total = n + most, np.concatenate([[0], np.cumsum(own)])
        first = np.arange(len(own))
        at = np.flatnonzero(total[np.minimum(first + span, len(own))] - total[:-1] >= n - most)
        for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else ():
            for start in range(int(run[0]), int(run[-1]) + 1, span):
                yield start, min(len(own), min(start + span, int(run[-1]) + 1) - 1 + span)


def stretches(wanted: list[str], words: list[str], most: int) -> Iterator[tuple[int, int, int]]:
    """(differing words, start, end) of the stretches of ``words`` with at most ``most`` words to insert,
    delete or replace; one word too many and one missing elsewhere count as one."""
    n = len(wanted)
    cost, start = list(range(n + 1)), [0] * (n + 1)
    for j, word in enumerate(words, 1):
        above, above_start = cost, start
        cost, start = [0], [j]
        for i in range(1, n + 1):
            c, s = min((above[i - 1] + (wanted[i - 1] != word), -above_start[i - 1]), (above[i] + 1, -above_start[i]), (cost[i - 1] + 1, -start[i - 1]))
            cost.append(c)
            start.append(-s)
        if cost[n] <= 2 * most:
            found = min(cost[n], differences(wanted, words[max(0, j - n - most):j]))
            if found <= most:
                yield found, start[n], j


def differences(wanted: list[str], words: list[str]) -> int:
    """Words to insert, delete or replace between a template and the part of a block that follows it best."""
    blocks = [m for m in SequenceMatcher(None, wanted, words, autojunk=False).get_matching_blocks() if m.size]
    if not blocks:
        return len(wanted)
    inside = blocks[-1].b + blocks[-1].size - blocks[0].b
    same = sum(m.size for m in blocks)
    return max(len(wanted), inside) - same


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", templates: dict[str, tuple[str, ...]] | None = None,
         most_differences: float = 0.15) -> DataFrame:
    """``keep`` columns, ``n_blocks`` (lines in which a cue begins) and ``matches``: line number, first word in
    the line, license, differing words and size reduction of every confirmed license."""
    rows = texts_of(docs, *keep, text_col=text_col)
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(templates, most_differences=most_differences)
        kind = pa.list_(pa.struct([("line", pa.int64()), ("word", pa.int64()), ("license", pa.string()), ("differences", pa.int64()), ("reduction", pa.float64())]))
        for p in pieces(batches):
            counts, found = [], []
            for text in p.column("text").to_pylist():
                n, own = 0, []
                if _CUE.search(text.lower()):
                    for words, at, place in paragraphs(text, match.known):
                        cues = cue_lines(words, at)
                        if cues:
                            n += len(cues)
                            own += [dict(zip(("line", "word", "license", "differences", "reduction"), (at[k], place[k], *m), strict=True))
                                    for k, *m in match(words)]
                counts.append(n)
                found.append(own)
            yield pa.RecordBatch.from_arrays([*p.columns[:-1], pa.array(counts, pa.int64()), pa.array(found, kind)], [*keep, "n_blocks", "matches"])

    prepare(docs.sparkSession)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(run, schema + "n_blocks long, matches array<struct<line:bigint,word:bigint,license:string,differences:bigint,reduction:double>>")
