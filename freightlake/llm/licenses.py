"""License statements in texts, by patience alignment with templates.

Words that occur once in a stretch of text and once in a template are anchors;
the longest increasing subsequence of their places is kept, and the gaps between
its members are aligned in the same way. A gap without such a word is entered at
the longest run of equal words around the rarest one. The share of a template's
words that are aligned is its coverage.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common

COVERAGE = 0.8

# Least share of aligned words in the stretch from the first to the last one.
DENSITY = 0.6

# The usual wording of declarations and notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of "
        "this software and associated documentation files (the Software), to deal in the "
        "Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain "
        "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under "
        "the terms of the GNU General Public License as published by the Free Software "
        "Foundation; either version 2 of the License, or (at your option) any later version",
    ],
    "LGPL-3.0": [
        "licensed under the GNU Lesser General Public License, version 3",
        "This library is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "LGPL-2.1": [
        "licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under "
        "the terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation; either version 2.1 of the License, or (at your option) any later version",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License"],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be "
        "used to endorse or promote products derived from this software without specific "
        "prior written permission",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose "
        "with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0"],
    "CC0-1.0": ["Released under CC0 1.0, no rights reserved"],
    "proprietary": ["All rights reserved"],
}

# Bytes of text that a worker takes at a time.
CHUNK = 2_000_000

_WORD = re.compile("[A-Za-z0-9]+")


def words_of(text: str) -> tuple[list[str], list[int], list[int]]:
    """Words of ASCII letters and digits in lower case, and where they start and end."""
    found = list(_WORD.finditer(text))
    return (
        [m.group().lower() for m in found],
        [m.start() for m in found],
        [m.end() for m in found],
    )


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs, sorted by the first, that increases in the second."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for at, (_, value) in enumerate(pairs):
        pile = bisect.bisect_left(tails, value)
        if pile == len(tails):
            tails.append(value)
            ends.append(at)
        else:
            tails[pile], ends[pile] = value, at
        before[at] = ends[pile - 1] if pile else -1
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(pairs[at])
        at = before[at]
    return out[::-1]


def _rarest_run(
    text: list[str], template: list[str], shared: set[str], gap: tuple[int, int, int, int]
) -> tuple[int, int, int]:
    """Start and size of the longest run of equal words through the rarest word."""
    a, b, c, d = gap
    in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
    word = min(shared, key=lambda w: (in_text[w] * in_template[w], w))
    best = (0, 0, 0)
    for i in [i for i in range(a, b) if text[i] == word]:
        for j in [j for j in range(c, d) if template[j] == word]:
            back = 0
            most = min(i - a, j - c)
            while back < most and text[i - back - 1] == template[j - back - 1]:
                back += 1
            on, most = 1, min(b - i, d - j)
            while on < most and text[i + on] == template[j + on]:
                on += 1
            best = max(best, (back + on, back - i, back - j))
    size, i, j = best
    return -i, -j, size


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs of places with equal words, increasing in both lists."""
    out: list[tuple[int, int]] = []
    open_gaps = [(0, len(text), 0, len(template))]
    while open_gaps:
        a, b, c, d = open_gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: j for j, w in enumerate(template[c:d], c) if in_template[w] == 1}
        single = [(i, w) for i, w in enumerate(text[a:b], a) if in_text[w] == 1]
        anchors = increasing([(i, place[w]) for i, w in single if w in place])
        if not anchors:
            shared = in_text.keys() & in_template.keys()
            if not shared:
                continue
            i, j, size = _rarest_run(text, template, shared, (a, b, c, d))
            anchors = [(i + k, j + k) for k in range(size)]
        out += anchors
        for (i, j), (x, y) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            if x - i > 1 and y - j > 1:
                open_gaps.append((i + 1, x, j + 1, y))
    return sorted(out)


class Template:
    """Words of a template, and words one of which any statement of it must have."""

    def __init__(self, license: str, text: str, coverage: float, common_in: Counter) -> None:
        self.license = license
        self.words = words_of(text)[0]
        self.least = math.ceil(coverage * len(self.words))
        # Without all of these too few words are left to reach the coverage.
        own = Counter(self.words)
        self.marks: set[str] = set()
        left = len(self.words)
        for word in sorted(own, key=lambda w: (common_in[w], -len(w), w)):
            if left < self.least:
                break
            self.marks.add(word)
            left -= own[word]
        self.places = [(w, j) for j, w in enumerate(self.words) if w in self.marks]
        # Places one of which must be met: numbers of versions, each for itself, and
        # words that tell this template from one of another license.
        self.required = [{j} for j, w in enumerate(self.words) if w.isdigit()]

    def tell_from(self, other: Template) -> None:
        """Ask for one of the words that a text of the other template does not have."""
        pairs = align(other.words, self.words)
        if len(pairs) >= self.least:
            lacking = set(range(len(self.words))) - {j for _, j in pairs}
            if lacking:
                self.required.append(lacking)

    def best(self, words: list[str], low: int, high: int, density: float) -> tuple | None:
        """First and last place and number of words of a statement between two places.

        Words far off at either end are given up until the stretch is dense enough.
        """
        pairs = align(words[low:high], self.words)
        while len(pairs) >= self.least:
            first, last = pairs[0][0], pairs[-1][0]
            if len(pairs) >= density * (last - first + 1):
                break
            early = pairs[1][0] - first >= last - pairs[-2][0]
            pairs = pairs[1:] if early else pairs[:-1]
        if len(pairs) < self.least:
            return None
        met = {j for _, j in pairs}
        if not all(met & places for places in self.required):
            return None
        return low + first, low + last, len(pairs)

    def around(self, words: list[str], start: int, low: int, density: float) -> tuple | None:
        """The statement with most words of those in narrow and wide windows."""
        most = None
        size = len(self.words)
        widest = math.ceil(size / density) - size
        for slack in sorted({0, min(size // 4 + 1, widest), widest}):
            got = self.best(words, max(low, start - slack, 0), start + size + slack, density)
            if got and (most is None or got[2] > most[2]):
                most = got
            if most and most[2] == size:
                break
        return most


@lru_cache(maxsize=4)
def templates_of(listed: tuple, coverage: float) -> list[Template]:
    common_in = Counter(w for _, text in listed for w in set(words_of(text)[0]))
    # Function words and very short ones are no marks while there are others.
    common_in.update(dict.fromkeys(("the", "and", "all", "this", "any"), 1000))
    common_in.update({w: 500 for w in common_in if len(w) < 3})
    templates = [Template(name, text, coverage, common_in) for name, text in listed]
    for own in templates:
        for other in templates:
            if own.license != other.license:
                own.tell_from(other)
    return templates


def find(text: str, templates: list[Template], density: float = DENSITY) -> list[tuple]:
    """Statements in a text: license, first and last character, words, coverage.

    Statements that overlap are reduced to the one with the greatest coverage, of
    those the one with most words, then the first name.
    """
    lower = text.lower()
    likely = [t for t in templates if any(m in lower for m in t.marks)]
    if not likely:
        return []
    words, starts, ends = words_of(text)
    places: dict[str, list[int]] = {}
    marks = set().union(*(t.marks for t in likely))
    for at, word in enumerate(words):
        if word in marks:
            places.setdefault(word, []).append(at)
    found = []
    for t in likely:
        done = -1
        for at, j in sorted((at, j) for w, j in t.places for at in places.get(w, ())):
            if at <= done:
                continue
            # Where the template would lie with this word in its place.
            got = t.around(words, at - j, done + 1, density)
            if got:
                first, last, count = got
                done = last
                share = count / len(t.words)
                found.append((-share, -count, t.license, first, last, len(t.words)))
    chosen: list[tuple] = []
    taken: list[tuple[int, int]] = []
    for share, count, name, low, high, size in sorted(found):
        at = bisect.bisect_left(taken, (low, low))
        beside = taken[max(0, at - 1) : at + 1]
        if any(low <= b and a <= high for a, b in beside):
            continue
        bisect.insort(taken, (low, high))
        chosen.append((name, starts[low], ends[high], -count, size, -share))
    return sorted(chosen, key=lambda c: c[1])


def scan(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: dict[str, list[str]] | None = None,
    coverage: float = COVERAGE,
    density: float = DENSITY,
) -> DataFrame:
    """One row for each license statement in each whole text.

    Gives ``doc_id, license, start, end, matched_words, template_words,
    coverage``, with places in characters. A text without statements, null and
    empty ones included, has no row; repeated rows are scanned each for itself,
    and other columns are left out. Texts stay where they are: no shuffle.
    """
    listed = tuple((n, t) for n, some in (templates or TEMPLATES).items() for t in some)
    rows = common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )
    names = ["license", "start", "end", "matched_words", "template_words", "coverage"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = templates_of(listed, coverage)
        for batch in (p for b in batches for p in common.slices(b, "text", CHUNK)):
            at, out = [], []
            for index, value in enumerate(common.text_column(batch, "text")):
                for statement in find(value, own, density):
                    at.append(index)
                    out.append(statement)
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at, pa.int64())),
                    *(pa.array(c, k) for c, k in zip(columns, kinds)),
                ],
                ["doc_id", *names],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(
        rows,
        run,
        f"doc_id {kind}, license string, start long, end long, matched_words long, "
        "template_words long, coverage double",
    )
