"""License scans by conditional compression.

A *block* is the stretch of words around words that license notices use (``CUES``);
overlapping stretches are one block, so a whole license text is one. A block is compressed
on its own and with each template (the usual headers, the paragraphs of short licenses,
tags) as zstandard raw-content dictionary. What a template saves is set against what
it costs by itself: templates that save less than ``SHARE`` of that are out, and the
``BEST`` that save the largest shares are candidates, in that order. A candidate is
confirmed by its exact wording: wherever its words align with the block's nearly completely
and the words that name the license and its version agree. Of the confirmed stretches
the one with the fewest differing words is taken, then the one with the largest
reduction; the exact differences are reported. What is left of the block on either side
is compressed and searched again, until nothing is confirmed: a block may hold many
notices, and the same one many times. An SPDX tag goes on over "OR", "AND" and "WITH":
each further identifier has a row.

Defined results: null, empty and cue-less texts and empty tables have no rows; case and
punctuation don't count; equal notices in one document, and repeated rows, each have
rows; equal differences and reductions go to the longer stretch, then to the first
license by name; rows with a null doc_id keep it; other columns are ignored. Very long
texts cost no more than their blocks.
"""

from __future__ import annotations

import difflib
from collections import Counter

import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import arrow_map, text_chunks

AROUND = 120  # words on either side of a cue, more than any template has
SHARE = 0.15  # of what a template costs by itself that it must save
BEST = 40  # candidates whose wording is compared
LEAST_MATCHED = 0.85  # of a template's words
LEVEL = 13  # measured: of 3, 13, 16 and 19 the one where a template that is there always saves most
CHUNK_BYTES = 4_000_000
CUES = ("license", "licensed", "licence", "licenced", "copyright", "spdx", "permission", "warranty", "redistribution", "redistributions", "unencumbered")
# cues by their beginning: tags and short forms are one word, or "CC" and the next one
CUE_STARTS = ("spdx-", "cc-by")

# fixed values: usual wordings of public license notices, and the paragraphs of short licenses
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "either version 3 of the License, or (at your option) any later version"),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication"),
)

# fixed values: the Creative Commons licenses, in words, short and as one tag
CREATIVE = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _kind, _words in CREATIVE.items():
    for _version, _scope in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES += tuple(
            (f"CC-{_kind}-{_version}", text)
            for text in (
                f"This work is licensed under a Creative Commons {_words} {_version} {_scope} License",
                f"Licensed under CC {_kind} {_version}",
                f"CC {_kind} {_version}",
                f"CC-{_kind}-{_version}",
            )
        )
# fixed values: SPDX identifiers of the licenses above
TAGS = {
    "BSD": ("BSD-2-Clause", "BSD-3-Clause"),
    **{x: (x,) for x in ("Apache-2.0", "MIT", "ISC", "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0", *(f"CC-{k}-{v}" for k in CREATIVE for v in ("4.0", "3.0")))},
    **{x: (x, f"{x}-only", f"{x}-or-later") for x in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")},
}
IDENTIFIERS = {tag.lower(): name for name, tags in TAGS.items() for tag in tags}
TAG, JOINTS = "spdx-license-identifier", ("or", "and", "with")
TEMPLATES += tuple((name, f"SPDX-License-Identifier: {tag}") for name, tags in TAGS.items() for tag in tags)

_WORD = regex.compile(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*")
_VERSION = regex.compile(r"v?\.?([0-9]{1,2}(?:\.[0-9]+)*)")
#: words that tell licenses apart, by the name they stand for
NAMES = {w: w for w in ("affero", "lesser", "library", "apache", "mit", "bsd", "mozilla", "eclipse", "cc")}
NAMES |= {"creative": "cc", "attribution": "by", "sharealike": "sa", "noncommercial": "nc", "noderivatives": "nd", "noderivs": "nd"}
SHORT = ("by", "sa", "nc", "nd")  # after "cc" only


def names(words: list[str]) -> list[str]:
    """What names a license and its version, in order and in one spelling."""
    out, after = [], False
    for word in words:
        for part in word.split("-"):
            if m := _VERSION.fullmatch(part):
                out.append(regex.sub(r"(\.0)+$", "", m[1]))
                after = False
            elif part in NAMES or (after and part in SHORT):
                out.append(NAMES.get(part, part))
                after = out[-1] == "cc" or (after and part in SHORT)
            else:
                after = False
    return out


def is_cue(words: list[str], i: int) -> bool:
    return words[i] in CUES or words[i].startswith(CUE_STARTS) or (words[i] == "cc" and i + 1 < len(words) and words[i + 1].split("-")[0] == "by")


def blocks(words: list[str]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for i in range(len(words)):
        if is_cue(words, i):
            start, end = max(0, i - AROUND), min(len(words), i + AROUND + 1)
            if out and start <= out[-1][1]:
                out[-1][1] = end
            else:
                out.append([start, end])
    return [(s, e) for s, e in out]


def runs(template: list[str], words: list[str]) -> list[tuple[int, int, int]]:
    """(size, place in words, place in template) of all longest runs of common words, the longest first."""
    places: dict[str, list[int]] = {}
    for j, word in enumerate(template):
        places.setdefault(word, []).append(j)
    out, open_runs = [], {}
    for i, word in enumerate([*words, ""]):
        here = {j: open_runs.get(j - 1, 0) + 1 for j in places.get(word, ())}
        out += [(size, i - size, j - size + 1) for j, size in open_runs.items() if j + 1 not in here]
        open_runs = here
    return sorted(out, key=lambda r: (-r[0], r[1], r[2]))


def aligned(template: list[str], words: list[str], a: int, b: int) -> tuple[int, int, int, int, str] | None:
    """(start, end, words matched, words that differ, differences) of the stretch
    around words[a] = template[b], if it is near enough and names the same license."""
    least = LEAST_MATCHED * len(template)
    low = max(0, a - b - len(template) // 4)
    high = min(len(words), a - b + len(template) + len(template) // 4 + 1)
    part = words[low:high]
    if (Counter(part) & Counter(template)).total() < least:
        return None
    operations = difflib.SequenceMatcher(None, part, template, autojunk=False).get_opcodes()
    same = [o for o in operations if o[0] == "equal"]
    size = lambda o: o[2] - o[1]
    matched = sum(map(size, same))
    # a stray word before or after the notice is no part of it
    for end, step in ((0, 1), (-1, -1)):
        while len(same) > 1 and matched - size(same[end]) >= least:
            near, far = (same[0], same[1]) if step > 0 else (same[-2], same[-1])
            if far[1] - near[2] <= size(same[end]):
                break
            matched -= size(same.pop(end))
    if matched < least:
        return None
    start, end = same[0][1], same[-1][2]
    if names(part[start:end]) != names(template):
        return None
    inside = [("delete" if c == d else "insert" if x == y else "replace", x, y, c, d) for (_, _, x, _, c), (_, y, _, d, _) in zip(same, same[1:])]
    edges = [("insert", start, start, 0, same[0][3]), *inside, ("insert", end, end, same[-1][4], len(template))]
    differ = [o for o in edges if o[1] < o[2] or o[3] < o[4]]
    listed = [f"{kind} '{' '.join(part[x:y])}' / '{' '.join(template[c:d])}'" for kind, x, y, c, d in differ]
    return low + start, low + end, matched, sum(max(y - x, d - c) for _, x, y, c, d in differ), "; ".join(listed)


def notices(template: list[str], words: list[str]) -> list[tuple[int, int, int, int, str]]:
    """All stretches that are near enough to the template, each from its longest run that succeeds."""
    out: dict[tuple[int, int, int, int, str], None] = {}
    covered = bytearray(len(words))
    for _, a, b in runs(template, words):
        if not covered[a] and (found := aligned(template, words, a, b)):
            out[found] = None
            covered[found[0] : found[1]] = b"1" * (found[1] - found[0])
    return list(out)


class Templates:
    """The templates' words, and a compressor with each of them as dictionary."""

    def __init__(self, templates=TEMPLATES, level: int = LEVEL):
        settings = zstandard.ZstdCompressionParameters.from_level(level, source_size=4096, dict_size=512, min_match=3, write_content_size=False, write_dict_id=False)
        self.plain = zstandard.ZstdCompressor(compression_params=settings)
        least = self.size("")
        self.known = []
        for name, text in templates:
            words = [w.lower() for w in _WORD.findall(text)]
            # zstandard indexes no match that begins in a dictionary's last bytes: these are no words
            content = zstandard.ZstdCompressionDict(" ".join(["", *words, ""]).encode() + bytes(16), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            cost = self.size(" ".join(words)) - least
            self.known.append((name, words, cost, zstandard.ZstdCompressor(compression_params=settings, dict_data=content)))

    def size(self, text: str, compressor=None) -> int:
        return len((compressor or self.plain).compress(text.encode("utf-8", "replace")))

    def candidates(self, words: list[str]) -> list[tuple[int, str, list[str]]]:
        """(bytes saved, name, template) of the templates that save most, best first."""
        text = " ".join(words)
        alone = self.size(text)
        saved = [(alone - self.size(text, compressor), name, template, cost) for name, template, cost, compressor in self.known]
        near = [(n / cost, n, name, template) for n, name, template, cost in saved if n >= max(1, SHARE * cost)]
        return [(n, name, template) for _, n, name, template in sorted(near, key=lambda c: (-c[0], -c[1], c[2], len(c[3])))[:BEST]]


def further(words: list[str], at: int) -> list[tuple[str, int, int]]:
    """(license, start, end) of what an SPDX tag's expression goes on with."""
    out = []
    while at + 1 < len(words) and words[at] in JOINTS and words[at + 1] in IDENTIFIERS:
        out.append((IDENTIFIERS[words[at + 1]], at + 1, at + 2))
        at += 2
    return out


def scanner(templates=TEMPLATES, level: int = LEVEL):
    known = Templates(templates, level)

    def block_notices(words: list[str]) -> list[tuple[str, int, int, int, int, str]]:
        """(license, start, end, bytes saved, words matched, differences) in a block."""
        out, todo = [], [(0, len(words))]
        while todo:
            low, high = todo.pop()
            rest = words[low:high]
            found = [(n[3], -saved, -n[2], name, n) for saved, name, template in known.candidates(rest) for n in notices(template, rest)]
            if not found:
                continue
            _, saved, _, name, (start, end, matched, _, differences) = min(found)
            out.append((name, low + start, low + end, -saved, matched, differences))
            if rest[start] == TAG:
                for other, a, b in further(rest, end):
                    out.append((other, low + a, low + b, -saved, 1, ""))
                    end = b
            todo += [(low, low + start), (low + end, high)]
        return out

    def scan(text: str) -> list[dict]:
        places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [text[s:e].lower() for s, e in places]
        out = []
        for low, high in blocks(words):
            for name, start, end, saved, matched, differences in block_notices(words[low:high]):
                first, last = places[low + start][0], places[low + end - 1][1]
                out.append({"license": name, "start": first, "end": last, "reduction": saved, "matched": matched, "differences": differences})
        return sorted(out, key=lambda r: (r["start"], r["license"]))

    return scan


def licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, license, start, end (code points), reduction in bytes, matched words, differences."""

    def run(batches):
        scan = scanner(templates)
        for batch in text_chunks(batches, CHUNK_BYTES):
            rows = [{"doc_id": d} | r for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for r in scan(t)]
            yield {c: [r[c] for r in rows] for c in ("doc_id", "license", "start", "end", "reduction", "matched", "differences")}

    # cues are ASCII, and the others begin with these: texts without any leave before they are sent to Python
    cued = docs.select(F.col("doc_id").cast("long"), "text").where(F.lower("text").rlike("|".join((*CUES, r"\bcc[^a-z0-9]+by"))))
    return arrow_map(cued, run, "doc_id long, license string, start int, end int, reduction int, matched int, differences string")
