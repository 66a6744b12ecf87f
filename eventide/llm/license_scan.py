"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

Words are runs of ASCII letters and digits and of all other letters' bytes, lower-cased; shingles
are five words. Templates are grouped by size: a template of t shingles belongs to the class c,
the power of two that is at least t. For each class a text is cut into windows of 2c shingles that
start every c, so any run of up to c shingles lies in a window whole.

If a window holds at least 0.8 of a template's shingles, with t > c/2 the Jaccard similarity of
the two is at least 0.4c / (2c + 0.1c) > 0.19. Signatures have ``BANDS`` bands of one row, so
such a pair meets in some band with a probability of 1 - (1 - 0.19)^BANDS, over 0.9999 for 48.
Windows that hold no shingle of any template have containment 0 and are not signed. Every pair
that meets is verified on its shingles themselves: containment is the share of the template's
distinct shingles that a copy holds. A window is verified together with its neighbours, so a copy
that straddles a border counts whole, and every disjoint copy of a template is reported.

Templates are a configuration of bounded size and travel with the task; a text never leaves the
task that reads it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import id_and_text

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 48
#: Templates are sent to every task, so all of them together may have this many characters.
MAX_TEMPLATE_CHARS = 4_000_000

# Notices as their licenses ask for them.
TEMPLATES = {
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (notice)":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    "MIT (line)": "Released under the MIT License.",
    "MIT (grant)":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD (conditions)":
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL (notice)":
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 (line)":
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
    "MPL-2.0 (notice)":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT (text)":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC (grant)":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    "ISC (text)":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
        "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause (terms)":
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
    "BSD-3-Clause (endorsement)":
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
    "zlib (text)":
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you "
        "must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not "
        "required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution.",
    "Unlicense (text)":
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    "BSL-1.0 (grant)":
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        "\"Software\") to use, reproduce, display, distribute, execute, and transmit the "
        "Software, and to prepare derivative works of the Software, and to permit third-parties "
        "to whom the Software is furnished to do so, all subject to the following",
    "LGPL (notice)":
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL-3.0 (notice)":
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0 (terms)":
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    "EPL-2.0 (notice)":
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at",
    "CC0-1.0 (line)":
        "To the extent possible under law, the author(s) have dedicated all copyright and related "
        "and neighboring rights to this software to the public domain worldwide.",
    "CC-BY-4.0 (line)":
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

_WORD = np.zeros(256, dtype=bool)
for _c in range(256):
    _WORD[_c] = _c >= 128 or chr(_c).isalnum()
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as a text has needed them."""
    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            m = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * _U(pow(_BASE, m, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * _U(pow(_INVERSE, m, 1 << 64))])
        return cls.up[:n], cls.down[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def shingles(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the shingles of lower-cased UTF-8 bytes, and where each word starts and ends."""
    b = np.frombuffer(raw, dtype=np.uint8)
    inside = np.concatenate([[False], _WORD[b], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(starts) < SHINGLE:
        return np.empty(0, dtype=np.uint64), starts, ends
    up, down = _Powers.to(len(b) + 1)
    total = np.concatenate([[_U(0)], np.cumsum((b.astype(np.uint64) + _U(1)) * up[:len(b)])])
    words = _mix((total[ends] - total[starts]) * down[starts])
    n = len(words) - SHINGLE + 1
    out = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE):
        out = out * _U(0xD6E8FEB86659FD93) + words[k:k + n]
    return _mix(out), starts, ends


_SEEDS = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F)) | _U(1)


class Index:
    """Templates by band: class -> band -> least hash -> names."""

    def __init__(self, templates: Mapping[str, str]):
        if sum(map(len, templates.values())) > MAX_TEMPLATE_CHARS:
            raise ValueError(f"templates have more than {MAX_TEMPLATE_CHARS} characters")
        self.sets: dict[str, Counter[tuple[bytes, ...]]] = {}
        self.classes: dict[int, list[dict[int, list[str]]]] = {}
        every = []
        for name, text in sorted(templates.items()):
            raw = text.lower().encode("utf-8", "replace")
            h, starts, ends = shingles(raw)
            if not len(h):
                raise ValueError(f"template {name!r} has fewer than {SHINGLE} words")
            self.sets[name] = shingle_set(raw, starts, ends, 0, len(h))
            c = 1 << (len(h) - 1).bit_length()
            bands = self.classes.setdefault(c, [defaultdict(list) for _ in range(BANDS)])
            for k in range(BANDS):
                bands[k][int((_mix(h * _SEEDS[k])).min())].append(name)
            every.append(h)
        self.known = np.unique(np.concatenate(every)) if every else np.empty(0, dtype=np.uint64)
        self.bits = np.zeros(1 << 16, dtype=bool)
        self.bits[(self.known & _U(0xFFFF)).astype(np.int64)] = True

    def scan(self, text: str) -> list[dict]:
        """Every copy of every template: license, containment, start and end (characters)."""
        raw = text.lower().encode("utf-8", "replace")
        h, starts, ends = shingles(raw)
        if not len(h) or not len(self.known):
            return []
        maybe = np.flatnonzero(self.bits[(h & _U(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.known, h[maybe])
        hits = maybe[self.known[np.minimum(at, len(self.known) - 1)] == h[maybe]]
        regions: dict[tuple[str, int], list[tuple[int, int]]] = defaultdict(list)
        for c, bands in self.classes.items() if len(hits) else ():
            # windows [w*c, w*c + 2c) that hold a known shingle
            windows = np.unique(np.concatenate([hits // c, np.maximum(hits // c - 1, 0)]))
            for w in windows.tolist():
                lo, hi = w * c, min(w * c + 2 * c, len(h))
                sig = _mix(h[None, lo:hi] * _SEEDS[:, None]).min(axis=1)
                for name in {x for k in range(BANDS) for x in bands[k].get(int(sig[k]), ())}:
                    regions[name, c].append((max(0, lo - c), min(hi + c, len(h))))
        found = []
        for (name, c), spans in sorted(regions.items()):
            for lo, hi in _merged(spans):
                near = hits[np.searchsorted(hits, lo):np.searchsorted(hits, hi)].tolist()
                found += [(name, *copy) for copy in self.copies(name, raw, starts, ends, near, c)]
        same = len(raw) == len(text)  # one byte a character: offsets are the same

        def char(x: int) -> int:
            return x if same else len(raw[:x].decode("utf-8", "replace"))
        return [{"license": name, "containment": v, "start": char(s), "end": char(e)}
                for name, v, s, e in found]

    def copies(self, name: str, raw: bytes, starts, ends, hits: list[int], c: int):
        """Disjoint copies of a template among the shingles ``hits``, left to right: containment,
        and the bytes its shingles span. A copy ends where its last new shingle does, before one
        that it has already when it is large enough, and is at most 2c shingles long."""
        want = self.sets[name]
        need = -(-len(want) * round(CONTAINMENT * 100) // 100)
        shingle = [(i, tuple(raw[starts[i + k]:ends[i + k]] for k in range(SHINGLE)))
                   for i in hits]
        at = [(i, s) for i, s in shingle if s in want]
        first = 0
        while first < len(at):
            seen: Counter[tuple[bytes, ...]] = Counter()
            last = first
            for j in range(first, len(at)):
                i, s = at[j]
                if i - at[first][0] >= 2 * c or (seen[s] >= want[s] and len(seen) >= need):
                    break
                if seen[s] < want[s]:
                    last = j
                seen[s] += 1
            seen = Counter(s for _, s in at[first:last + 1])
            if len(seen) < need:
                first += 1
                continue
            # shingles that come again later in the copy do not belong to its start
            while seen[at[first][1]] > want[at[first][1]]:
                seen[at[first][1]] -= 1
                first += 1
            yield (len(seen) / len(want), int(starts[at[first][0]]),
                   int(ends[at[last][0] + SHINGLE - 1]))
            first = last + 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def shingle_set(raw: bytes, starts, ends, lo: int, hi: int) -> Counter[tuple[bytes, ...]]:
    return Counter(tuple(raw[starts[i + k]:ends[i + k]] for k in range(SHINGLE))
                   for i in range(lo, hi))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row and copy of a template in it: doc_id, license, containment, start
    and end (characters of the lower-cased text). Copies of one template are disjoint; different
    templates may overlap, as a notice and the grant that it is a part of do.

    Null, empty and short texts contain nothing; a repeated row gives its rows again; a null id
    is a document like any other; an empty table gives no rows; texts of any length are read
    whole; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(dict(templates))
    rows = id_and_text(docs, id_col, text_col)
    Index(templates)  # refuse unusable templates before any task does

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(held.value)
        for b in batches:
            ids, found = [], []
            for i, t in enumerate(b.column(1)):
                for m in index.scan(t.as_py()):
                    ids.append(i)
                    found.append(m)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())),
                 pa.array([m["license"] for m in found], pa.string()),
                 pa.array([m["containment"] for m in found], pa.float64()),
                 pa.array([m["start"] for m in found], pa.int32()),
                 pa.array([m["end"] for m in found], pa.int32())],
                ["doc_id", "license", "containment", "start", "end"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, license string, containment double, start int, end int")
