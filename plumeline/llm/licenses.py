"""License scans: winnowed template fingerprints pick candidates, banded alignment reports matches.

Words are runs of ASCII letters and digits and of all other non-ASCII bytes, A-Z lower-cased. A template is fingerprinted by
winnowing: of every ``window`` consecutive ``gram``-word hashes the smallest is kept (the rightmost of
equals). The inverted index maps a kept hash to (template, word position). A document is hashed at every
word and each hash found in the index proposes (template, diagonal); hits of one template on nearby diagonals
and close together form a candidate region. The regions of one template are aligned with it together, word by word, inside
a band of ``band`` words (a quarter of a short template) around their diagonals (match +2, mismatch and gap -1, local alignment).

Aligned parts of one template that follow each other in both texts, with at most ``max_insert`` document words between
them, are chained before coverage is taken, so an insertion longer than the band does not split a notice. A match is
``complete`` when it covers ``min_coverage`` of the template with ``min_words`` words or more and has every word of the
template that the first part of its name has too (``Apache``, ``NC``, the version's digits), so a sibling license is not taken for it.
Other matches of at least ``min_partial`` words, or of ``min_coverage``, are reported as partial, with their coverage.

One span, one license: matches of a document are ranked (complete first, then more matched words, higher coverage, name,
place), and a match stays when at least two of its matched words, and a quarter of them, belong to no better one.

A region that shares a run of ``gram + window - 1`` template words with a template is always found, as
every such run contains a kept hash. Templates shorter than that are fingerprinted whole (all hashes; a
template shorter than ``gram`` words by its whole word run).

Templates are a bounded parameter (checked, ``MAX_TEMPLATE_BYTES``): the index goes to the executors with the
task. Documents are read once and not shuffled.

Defined results: null and empty texts have no matches. Ties of rank go to the earlier place. Repeated rows
repeat their matches. Null ids are passed on. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.runtime import with_package
from plumeline.llm.textkernels import ALNUM_WORDS, LOWER, slices, span_hashes, string_buffers, window_hashes, word_spans

MAX_TEMPLATE_BYTES = 16 << 20

# Words of the families below.
CC_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
GNU_KINDS = {"GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"),
             "AGPL-3.0": ("Affero General", "3")}


def _families() -> dict[str, str]:
    """Notices that differ only in the kind and version of the license."""
    out = {}
    for kind, words in CC_KINDS.items():
        for version, port in (("3.0", "Unported"), ("4.0", "International")):
            out[f"CC-{kind}-{version} line"] = f"Licensed under CC {kind} {version}."
            out[f"CC-{kind}-{version} notice"] = f"This work is licensed under a Creative Commons {words} {version} {port} License."
    for kind, (words, version) in GNU_KINDS.items():
        out[f"{kind} line"] = f"This work is licensed under the GNU {words} Public License, version {version}."
        if kind != "GPL-2.0":
            stop = ";" if version == "2.1" else ":"
            out[f"{kind} or later notice"] = (
                f"This {'library' if words.startswith('Lesser') else 'program'} is free software{stop} you can redistribute it and/or modify it "
                f"under the terms of the GNU {words} Public License as published by the Free Software Foundation, either version {version} of "
                "the License, or (at your option) any later version.")
    return out


# Well-known public license notices (short forms and the opening grants of the full texts).
TEMPLATES: dict[str, str] = _families() | {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "MIT licensed line": "Licensed under the MIT License.",
    "BSD-3-Clause line": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause line": "Licensed under the BSD 2-Clause License.",
    "GFDL-1.3 notice": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, "
        "Version 1.3 or any later version published by the Free Software Foundation."),
    "CC0-1.0 notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "OFL-1.1 line": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Artistic-Perl line": "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the "
        "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
    "EPL-1.0 notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
        "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    "EPL-2.0 notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/"),
    "MPL-1.1 notice": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    "CDDL notice": (
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You "
        "may not use this file except in compliance with the License."),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of "
        "the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."),
    "GPL-2.0 or later notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT."),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}


def _words(column: pa.Array):
    data, offsets = string_buffers(column)
    lower = LOWER[data]
    starts, ends, first = word_spans(lower, offsets, ALNUM_WORDS)
    return data, offsets, starts, ends, first, span_hashes(lower, starts, ends)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept by winnowing: the rightmost smallest hash of every run of ``window`` hashes."""
    if len(hashes) <= window:
        return np.arange(len(hashes))
    runs = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(runs)) + window - 1 - np.argmin(runs[:, ::-1], axis=1))


class TemplateIndex:
    """Winnowed fingerprints of the templates: hash -> (template, position)."""

    def __init__(self, templates: Mapping[str, str], gram: int, window: int):
        size = sum(len(t.encode()) for t in templates.values())
        if size > MAX_TEMPLATE_BYTES:
            raise ValueError(f"templates hold {size} bytes; the limit is {MAX_TEMPLATE_BYTES}")
        self.names = sorted(templates)
        *_, first, words = _words(pa.array([templates[n] for n in self.names], pa.string()))
        self.words = [words[a:b] for a, b in zip(first[:-1], first[1:])]
        self.grams = sorted({min(gram, len(w)) for w in self.words if len(w)})
        *_, first, own = _words(pa.array([n.split(" ")[0] for n in self.names], pa.string()))
        self.naming = [np.intersect1d(w, own[a:b]) for w, a, b in zip(self.words, first[:-1], first[1:])]
        rows = []
        for t, w in enumerate(self.words):
            if len(w):
                h = window_hashes(w, min(gram, len(w)), seed=2)
                rows += [(int(h[p]), t, p) for p in winnow(h, window).tolist()]
        rows.sort()
        self.keys, self.lead = np.unique(np.array([r[0] for r in rows], np.uint64), return_index=True)
        self.lead = np.append(self.lead, len(rows))
        self.template, self.position = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document word, template, template word) of every shared fingerprint inside one text."""
        found = []
        left = np.repeat(first[1:], np.diff(first)) - np.arange(len(words))
        for g in self.grams:
            h = window_hashes(words, g, seed=2)
            at = np.flatnonzero(self.sieve[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = at[left[at] >= g]
            k = np.minimum(np.searchsorted(self.keys, h[at]), max(len(self.keys) - 1, 0))
            ok = self.keys[k] == h[at] if len(self.keys) else np.zeros(0, bool)
            at, k = at[ok], k[ok]
            many = self.lead[k + 1] - self.lead[k]
            place = np.repeat(self.lead[k], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found.append(np.stack([np.repeat(at, many), self.template[place], self.position[place]]))
        return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 3


def align(words: np.ndarray, first: np.ndarray, last: np.ndarray, template: np.ndarray, diagonal: np.ndarray,
          band: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Best local alignments of many regions with one template, |document word - template word - diagonal| <= band.

    Region r lies in ``words[first[r]:last[r]]``, its diagonal counts from ``first[r]``. Returns for each the matched
    words' places in the text and in the template (empty without a match). Memory: a byte per cell of the bands.
    """
    n, width, out = len(template), 2 * band + 1, []
    step = max((32 << 20) // max(n * width, 1), 1)
    for s in range(0, len(diagonal), step):
        out += _align_some(words, first[s:s + step], last[s:s + step], template, diagonal[s:s + step], n, width, band)
    return out


def _align_some(words, first, last, template, diagonal, n, width, band):
    count, ramp = len(first), np.arange(width)
    column = (first + diagonal - band)[:, None] + ramp        # cell b of row i: document word column + i, template word i
    score = np.zeros((count, width), np.int64)
    came = np.zeros((n, count, width), np.int8)               # 0 start, 1 both words, 2 template word left out, 3 document word left out
    best, at_row, at_cell = np.zeros((3, count), np.int64)
    for i in range(n):
        j = column + i
        inside = (j >= first[:, None]) & (j < last[:, None])
        same = inside & (words[np.clip(j, 0, len(words) - 1)] == template[i])
        both = score + np.where(same, 2, -1)
        skip = np.concatenate([score[:, 1:], np.zeros((count, 1), np.int64)], axis=1) - 1
        value = np.where(inside, np.maximum(np.maximum(both, skip), 0), 0)
        run = np.maximum.accumulate(value + ramp, axis=1) - ramp              # the best of all runs of left-out document words
        came[i] = np.where(inside & (run > 0), np.where(run > value, 3, np.where(skip > both, 2, 1)), 0)
        score = np.where(inside, run, 0)
        top = score.max(axis=1)
        better = top > best
        best[better], at_row[better], at_cell[better] = top[better], i, score[better].argmax(axis=1)
    found, live = [], np.flatnonzero(best > 0)
    row, cell = at_row.copy(), at_cell.copy()
    while len(live):                                          # back along all paths at once
        kind = came[row[live], live, cell[live]]
        word = column[live, cell[live]] + row[live]
        hit = (kind == 1) & (words[np.clip(word, 0, len(words) - 1)] == template[row[live]])
        found.append(np.stack([live[hit], word[hit] - first[live[hit]], row[live][hit]]))
        row[live] -= (kind == 1) | (kind == 2)
        cell[live] += (kind == 2).astype(np.int64) - (kind == 3)
        live = live[(kind > 0) & (row[live] >= 0)]
    region, word, place = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((word, region))
    cuts = np.searchsorted(region[order], np.arange(1, count))
    return list(zip(np.split(word[order], cuts), np.split(place[order], cuts)))


def chains(parts: list[tuple[np.ndarray, np.ndarray, int]], max_insert: int) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
    """Join aligned parts (document places, template places, hits) of one template that follow each other in both texts.

    Returns (document places, template places, hits, number of parts) of disjoint chains, those with most words first.
    """
    unique = {(int(d[0]), int(d[-1]), int(t[0]), int(t[-1])): (d, t, n) for d, t, n in parts if len(d)}
    parts = sorted(unique.values(), key=lambda p: (p[0][0], p[0][-1], p[1][0]))
    size, before = [len(p[0]) for p in parts], [-1] * len(parts)
    start, reach = 0, max((int(p[0][-1] - p[0][0]) for p in parts), default=0)
    for i, (d, t, _) in enumerate(parts):
        while d[0] - parts[start][0][0] > reach + max_insert + 1:
            start += 1
        for k in range(start, i):
            kd, kt, _ = parts[k]
            if kd[0] < d[0] and kt[0] < t[0] and d[0] - kd[-1] <= max_insert + 1:
                gain = size[k] + int(((d > kd[-1]) & (t > kt[-1])).sum())
                if gain > size[i]:
                    size[i], before[i] = gain, k
    out, used = [], set()
    for i in sorted(range(len(parts)), key=lambda i: (-size[i], i)):
        path = [i]
        while before[path[-1]] >= 0:
            path.append(before[path[-1]])
        if used.intersection(path):
            continue
        used.update(path)
        d, t, n = parts[path[-1]]
        for k in path[-2::-1]:
            ok = (parts[k][0] > d[-1]) & (parts[k][1] > t[-1])
            d, t, n = np.concatenate([d, parts[k][0][ok]]), np.concatenate([t, parts[k][1][ok]]), n + parts[k][2]
        out.append((d, t, n, len(path)))
    return out


def _regions(at: np.ndarray, template: np.ndarray, position: np.ndarray, bands: np.ndarray, reach: int) -> Iterator[tuple[int, int, int]]:
    """(template, diagonal, hits) of groups of hits of one template that lie close together.

    ``bands``: band per template; a quarter of the template at most, so that two whole occurrences
    of a short template never fall into one group.
    """
    diagonal = at - position
    order = np.lexsort((at, diagonal, template))
    t, d, a = template[order], diagonal[order], at[order]
    # A new group starts with the template, beyond the band, or with a gap longer than the template.
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (d[1:] - d[:-1] > bands[t[1:]]) | (np.abs(a[1:] - a[:-1]) > reach)])
    for g in np.split(np.arange(len(t)), np.flatnonzero(new)[1:]):
        yield int(t[g[0]]), int(np.median(d[g])), len(g)


def _candidates(words, first, index: TemplateIndex, bands: np.ndarray, max_insert: int) -> Iterator[tuple[int, list[tuple]]]:
    """(text, [(template, document places, template places, hits, parts)]) of the texts with a candidate."""
    longest = max((len(w) for w in index.words), default=0)
    at, template, position = index.hits(words, first)
    text = np.searchsorted(first, at, side="right") - 1
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(len(first)))
    regions: dict[int, list[tuple[int, int, int]]] = {}
    for r in np.unique(text).tolist():
        own = order[cuts[r]:cuts[r + 1]]
        for t, diagonal, n in _regions(at[own] - first[r], template[own], position[own], bands, longest):
            regions.setdefault(t, []).append((r, diagonal, n))
    parts: dict[int, dict[int, list[tuple]]] = {}
    for t, some in regions.items():
        r, diagonal, n = np.array(some, np.int64).T
        aligned = align(words, first[r], first[r + 1], index.words[t], diagonal, int(bands[t]))
        for k, (d, p) in enumerate(aligned):
            parts.setdefault(int(r[k]), {}).setdefault(t, []).append((d, p, int(n[k])))
    for r in sorted(parts):
        yield r, [(t, *c) for t in sorted(parts[r]) for c in chains(parts[r][t], max_insert)]


def best_of_spans(candidates: list[tuple], index: TemplateIndex, min_coverage: float, min_words: int,
                  min_partial: int) -> list[tuple]:
    """(template, document places, hits, parts, complete) of the candidates that stay, by place."""
    ranked = []
    for t, d, p, n, k in candidates:
        whole = index.words[t]
        enough = len(d) >= min_coverage * len(whole)
        if len(d) < min_words or not (enough or len(d) >= min_partial):
            continue
        named = bool(np.isin(index.naming[t], whole[p]).all())
        ranked.append((not (enough and named), -len(d), -len(d) / len(whole), index.names[t], int(d[0]), t, d, n, k))
    taken: set[int] = set()
    kept = []
    for partial, *_, t, d, n, k in sorted(ranked, key=lambda m: m[:5]):
        new = [w for w in d.tolist() if w not in taken]
        if len(new) >= 2 and 4 * len(new) >= len(d):
            taken.update(new)
            kept.append((t, d, n, k, not partial))
    return sorted(kept, key=lambda m: (int(m[1][0]), m[0]))


def _scan(batches, index: TemplateIndex, band: int, min_coverage: float, min_words: int, min_partial: int,
          max_insert: int) -> Iterator[pa.RecordBatch]:
    """(id, text) -> matches."""
    bands = np.array([max(min(band, len(w) // 4), 1) for w in index.words], np.int64)
    for batch in slices(batches, 1):
        data, offsets, starts, ends, first, words = _words(batch.column(1))
        out: list[tuple] = []
        for r, candidates in _candidates(words, first, index, bands, max_insert):
            raw, lo = data[offsets[r]:offsets[r + 1]], int(first[r])
            for t, d, n, parts, complete in best_of_spans(candidates, index, min_coverage, min_words, min_partial):
                a, b, matched = int(d[0]), int(d[-1]) + 1, len(d)
                sa, sb = int(starts[lo + a] - offsets[r]), int(ends[lo + b - 1] - offsets[r])
                before = int(((raw[:sa] & 0xC0) != 0x80).sum())                # bytes to characters
                inside = int(((raw[sa:sb] & 0xC0) != 0x80).sum())
                out.append((r, index.names[t], matched, matched / len(index.words[t]), matched / (b - a), a, b, before, before + inside,
                            n, parts, complete))
        ids = batch.column(0).take(pa.array([o[0] for o in out], pa.int64()))
        kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64(), *[pa.int64()] * 6, pa.bool_()]
        yield pa.RecordBatch.from_arrays([ids, *[pa.array([o[i + 1] for o in out], k) for i, k in enumerate(kinds)]],
                                         ["id", "license", "matched_words", "coverage", "identity", "start_word", "end_word",
                                          "start_char", "end_char", "fingerprint_hits", "parts", "complete"])


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text",
                  gram: int = 3, window: int = 4, band: int = 6, min_coverage: float = 0.6, min_words: int = 4,
                  min_partial: int = 12, max_insert: int = 32) -> DataFrame:
    """One row per license match: id, license, matched_words, coverage (of the template), identity (of the span), word and
    character span, fingerprint_hits, parts (aligned pieces in the chain), complete."""
    with_package(docs.sparkSession)
    index = TemplateIndex(templates, gram, window)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    longs = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    schema = T.StructType([rows.schema["id"], T.StructField("license", T.StringType()), *longs("matched_words"),
                           T.StructField("coverage", T.DoubleType()), T.StructField("identity", T.DoubleType()),
                           *longs("start_word", "end_word", "start_char", "end_char", "fingerprint_hits", "parts"),
                           T.StructField("complete", T.BooleanType())])
    return rows.mapInArrow(lambda it: _scan(it, index, band, min_coverage, min_words, min_partial, max_insert), schema)
