"""License scans by conditional compression.

A text that has a license's words is cut into candidate blocks around its
anchor words.  A block is its lower-case words, so case, line breaks, white
space, punctuation and comment marks between words make no difference.  Each
block is compressed with zstandard, plainly and with each template as a raw
dictionary; what the dictionary saves, as a share of the template's own
compressed size, ranks the templates.  Those that save enough, and those whose
words the block holds, are confirmed by the exact differences of wording: the
block's words are aligned with the template's, and the missing, extra and
replaced words are counted and returned.

An anchor is found by one JVM expression over every whole text, so only texts
with an anchor reach Python.  A block reaches a quarter further than its template
on either side of the anchor, and anchors inside a wording already confirmed
are skipped, so long texts are linear work.

Defined results: null, empty and anchor-free texts have no rows.  Every
occurrence has a row of its own; equal templates at one place are ranked by
saving, then name.  Repeated rows repeat their findings, a null id keeps its
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Wordings of public licenses and of common notices.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT notice": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "BSD-2-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "rights reserved": "All rights reserved.",
}

#: An anchor is found in every template.
ANCHOR = r"licen[sc]ed?\b|hereby\W+granted|redistribution|public\W+license|rights\W+reserved"

#: Least share of a template's worth that its dictionary saves on a block; word differences allowed, as a share.
MIN_SAVING, MAX_DIFFERENCE = 0.35, 0.1

_FOUND = ("array<struct<template:string,start:int,end:int,saving:double,rank:int,n_words:int,n_missing:int,n_extra:int,"
          "difference:string>>")
_WORD = re.compile(r"\w+(?:[.-]\w+)*")


class _Template:
    def __init__(self, name: str, text: str):
        import zstandard

        self.name = name
        self.words = [w.lower() for w in _WORD.findall(text)]
        self.counts, self.least = Counter(self.words), len(self.words) * (1 - MAX_DIFFERENCE)
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        data = " ".join(self.words).encode()
        raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.primed = zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False)
        self.worth = max(1, len(self.plain.compress(data)) - len(self.primed.compress(data)))

    def saving(self, block: bytes) -> float:
        """Bytes the dictionary saves on the block, as a share of what it saves on the template itself."""
        return (len(self.plain.compress(block)) - len(self.primed.compress(block))) / self.worth

    def held(self, words: list[str]) -> bool:
        """Whether the words hold enough of the template's, in any order, for it to be confirmed."""
        there = Counter(words)
        return sum(min(n, there[w]) for w, n in self.counts.items()) >= self.least - 1e-9


@lru_cache(maxsize=2)
def _compiled(items: tuple) -> list[_Template]:
    return [_Template(n, t) for n, t in items]


def _align(told: list[str], template: _Template):
    """First and last word of the best alignment and its (missing, extra) words."""
    match = SequenceMatcher(None, told, template.words, autojunk=False)
    blocks = [b for b in match.get_matching_blocks() if b.size]
    if not blocks:
        return None
    first, last = blocks[0].a, blocks[-1].a + blocks[-1].size
    missing, extra = [], []
    for op, i, j, k, n in match.get_opcodes():
        if op != "equal":
            missing += template.words[k:n]
            extra += told[max(i, first):min(j, last)]
    return first, last - 1, missing, extra


def scan(text: str, templates: dict[str, str] = TEMPLATES) -> list[dict]:
    """The license wordings found in one text, by place."""
    out = []
    compiled = _compiled(tuple(templates.items()))
    starts, ends = array("q"), array("q")
    for m in _WORD.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
    done = dict.fromkeys(templates, 0)  # words
    for anchor in re.finditer(ANCHOR, text, re.IGNORECASE):
        at, ranking = bisect_right(starts, anchor.start()) - 1, []
        for t in compiled:
            if at >= done[t.name]:
                reach = len(t.words) + len(t.words) // 4 + 1
                low, high = max(done[t.name], at - reach), min(len(starts), at + reach)
                told = [text[i:j].lower() for i, j in zip(starts[low:high], ends[low:high])]
                saving = t.saving(" ".join(told).encode())
                if saving >= MIN_SAVING or t.held(told):
                    ranking.append((-saving, t.name, t, low, told))
        for rank, (saving, name, t, low, told) in enumerate(sorted(ranking, key=lambda r: r[:2]), 1):
            aligned = _align(told, t)
            if aligned is None or len(aligned[2]) + len(aligned[3]) > MAX_DIFFERENCE * len(t.words):
                continue
            first, last, missing, extra = aligned
            out.append({"template": name, "start": starts[low + first], "end": ends[low + last],
                        "saving": round(-saving, 6), "rank": rank,
                        "n_words": len(t.words), "n_missing": len(missing), "n_extra": len(extra),
                        "difference": " ".join([f"-{w}" for w in missing] + [f"+{w}" for w in extra])})
            done[name] = low + last + 1
    return _ranked(out)


def _ranked(found: list[dict]) -> list[dict]:
    """Of findings that overlap, the longest wording wins, then the fewest differences, saving and name."""
    best: list[dict] = []
    for f in sorted(found, key=lambda f: (-f["n_words"], f["n_missing"] + f["n_extra"], -f["saving"], f["template"])):
        if all(f["end"] <= b["start"] or f["start"] >= b["end"] for b in best):
            best.append(f)
    return sorted(best, key=lambda f: f["start"])


def scan_documents(df: DataFrame, id_col: str = "doc_id", text: str = "text",
                   templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """id, template, start, end, saving, rank, n_words, n_missing, n_extra, difference: a row per wording found."""

    def batches(texts: pd.Series) -> pd.Series:
        return pd.Series([scan(t, templates) for t in texts], dtype=object)

    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("t")).filter(F.col("t").rlike("(?iU)" + ANCHOR))
    rows = rows.select("id", F.explode(F.pandas_udf(batches, _FOUND)("t")).alias("f"))
    return rows.select(F.col("id").alias(id_col), "f.*")
