"""License scans: patience alignment of texts with license templates.

Words that are rare in a template seed windows of a text; a window is aligned with
the template on the words unique to both, along their longest increasing
subsequence, and the gaps between them in the same way. A window that covers enough
of the template's words, and holds those in a row that tell the license from others
like it, is a finding. Templates are whole texts, headers of files, and notices made
from the names of licenses.
"""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import giving_back
from .patience import align
from .words import NOT_ALNUM, words_of

COVERAGE = 0.8

# Public license texts and notices, by SPDX identifier.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_0BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
# Names that licenses are given by in notices.
GNU = {"GPL-2.0": ("General Public License", "2"), "GPL-3.0": ("General Public License", "3"), "LGPL-2.1": ("Lesser General Public License", "2.1"), "LGPL-3.0": ("Lesser General Public License", "3"), "AGPL-3.0": ("Affero General Public License", "3")}
NAMES = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "3-Clause BSD License", "Revised BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License - v 2.0"],
    "EUPL-1.2": ["European Union Public License, version 1.2", "EUPL, Version 1.2", "EUPL 1.2"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
    "CC0-1.0": ["CC0 1.0 Universal", "CC0 1.0"],
}
CC_TERMS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
#: Whole texts in files, and words that tell each from those that are much like it.
FILES = {"Apache-2.0": "apache license version 2 0", "GPL-2.0": "gnu general public license version 2", "GPL-3.0": "gnu general public license version 3", "LGPL-2.1": "gnu lesser general public license version 2 1", "LGPL-3.0": "gnu lesser general public license version 3", "MPL-2.0": "mozilla public license version 2 0", "CC0-1.0": "cc0 1 0 universal"}


def templates() -> list[tuple[str, str, str, str]]:
    """(license, kind, text, words that must stand in a match, in a row) of texts, headers and notices."""
    found = [
        ("MIT", "text", _MIT, "sublicense and or sell copies"),
        ("ISC", "text", _ISC, "provided that the above copyright notice and this permission notice"),
        ("0BSD", "text", _0BSD, "with or without fee is hereby granted the software"),
        ("BSD-2-Clause", "text", _BSD_HEAD + _BSD_DISCLAIMER, "redistribution and use in source and binary forms"),
        ("BSD-3-Clause", "text", _BSD_HEAD + _BSD_THIRD + _BSD_DISCLAIMER, "endorse or promote products"),
        ("Apache-2.0", "header", _APACHE, "apache license version 2 0"),
        ("MPL-2.0", "header", _MPL, "mozilla public license v 2 0"),
        ("All-rights-reserved", "notice", "All rights reserved.", "all rights reserved"),
    ]
    folder = Path(__file__).parent / "licenses"
    found += [(name, "text", (folder / f"{name}.txt").read_text(encoding="utf-8"), must) for name, must in FILES.items()]
    names = {k: list(v) for k, v in NAMES.items()}
    for name, (family, version) in GNU.items():
        found.append((name, "header", _GNU.format(family, version), f"gnu {family}"))
        short = name.split("-")[0]
        names[name] = [f"GNU {family}, version {version}", f"GNU {family} v{version}", f"{short} version {version}", f"{short}v{version}", f"{short}-{version}", f"GNU {short}v{version}"]
        if "." not in version:
            names[name].append(f"GNU {family} v{version}.0")
    for code, words in CC_TERMS.items():
        for version in CC_VERSIONS:
            names[f"CC-{code}-{version}"] = [f"CC {code} {version}", f"Creative Commons {words} {version}"]
    for name, spellings in names.items():
        found += [(name, "notice", f"Licensed under the {x}.", x) for x in spellings]
        found.append((name, "spdx", f"SPDX-License-Identifier: {name}", f"identifier {name}"))
        if name in GNU:
            found += [(name, "spdx", f"SPDX-License-Identifier: {name}-{x}", f"identifier {name}-{x}") for x in ("only", "or-later")]
    return found


TEMPLATES = templates()


def word_hashes(text: str) -> np.ndarray:
    found = list(words_of(pa.array([text]), NOT_ALNUM, lower=True))
    return found[0].hash if found else np.zeros(0, np.uint64)


class Scanner:
    """Finds templates in sequences of word hashes."""

    def __init__(self, templates=TEMPLATES, coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = []
        for name, kind, text, must in templates:
            words = word_hashes(text).tolist()
            missing = len(words) - int(np.ceil(coverage * len(words)))
            # A window with the coverage holds at least one of these words: at most `missing` can be absent.
            counts = Counter(words)
            spelled = dict(zip(words, "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()))
            seeds, total = [], 0
            for w in sorted(counts, key=lambda w: (-len(spelled.get(w, "")), w)):
                if total > missing:
                    break
                seeds.append(w)
                total += counts[w]
            places: dict[int, list[int]] = {}
            for q, w in enumerate(words):
                if w in seeds:
                    places.setdefault(w, []).append(q)
            self.templates.append((name, kind, words, counts, places, word_hashes(must).tolist()))
        self.seeds = np.unique(np.array([s for t in self.templates for s in t[4]], np.uint64))

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Which words are seeds of some template."""
        at = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        return self.seeds[at] == hashes

    def scan(self, words: list[int], hits: list[int]) -> list[tuple[int, int, int, float]]:
        """(template, first word, end, coverage) of each finding, the better one where they overlap."""
        found = []
        every = Counter(words)
        for t, (_, _, own, counts, places, must) in enumerate(self.templates):
            n = len(own)
            need = int(np.ceil(self.coverage * n))
            if sum(min(k, every[w]) for w, k in counts.items()) < need:
                continue
            slack = n // 4 + 2
            done = -1
            for p in hits:
                if p < done or words[p] not in places:
                    continue
                best = None
                tried: set[tuple[int, int]] = set()
                for q in places[words[p]]:
                    # Windows of nearly the same place are tried once.
                    low, high = max(0, p - q - slack), min(len(words), p - q + n + slack)
                    if (low // (slack // 2 + 1), high // (slack // 2 + 1)) in tried:
                        continue
                    tried.add((low // (slack // 2 + 1), high // (slack // 2 + 1)))
                    window = words[low:high]
                    if sum((Counter(window) & counts).values()) < need:
                        continue
                    pairs = align(window, own)
                    first, last = (pairs[0][0], pairs[-1][0] + 1) if pairs else (0, 0)
                    row = window[max(0, first - len(must)) : last + len(must)]
                    told = any(row[i : i + len(must)] == must for i in range(len(row) - len(must) + 1))
                    if told and len(pairs) >= need and (best is None or len(pairs) > best[0]):
                        best = (len(pairs), low + first, low + last)
                if best:
                    found.append((t, best[1], best[2], best[0] / n))
                    done = max(best[2], p + 1)
        # A longer template that holds a shorter one goes first; then the better covered, then the earlier.
        found.sort(key=lambda f: (-round(f[3] * len(self.templates[f[0]][2])), -f[3], f[1], f[0]))
        kept: list[tuple[int, int, int, float]] = []
        for f in found:
            if all(f[2] <= k[1] or f[1] >= k[2] for k in kept):
                kept.append(f)
        return sorted(kept, key=lambda f: f[1])


def scan_licenses(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_column: str = "text", coverage: float = COVERAGE, templates=TEMPLATES) -> DataFrame:
    """The ``keep`` columns of every row and ``findings``: license, kind, first and end byte of
    the span in the UTF-8 text, coverage.

    Null and empty texts have no findings, texts of any length are scanned whole, repeated
    rows each give a row. Spans don't overlap: the one with more matched words stays.
    """
    source = docs.select(*keep, F.col(text_column).alias("__text"))
    known = {(t[0], t[1], t[2]): t for t in templates}
    templates = list(known.values())
    finding = "array<struct<license:string,kind:string,start:int,end:int,coverage:double>>"
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("findings", T._parse_datatype_string(finding))])
    arrow = to_arrow_schema(schema).field("findings").type

    def run(batches):
        scanner = Scanner(templates, coverage)
        for batch in batches:
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for words in words_of(batch.column(batch.num_columns - 1), NOT_ALNUM, lower=True):
                hits = np.flatnonzero(scanner.hits(words.hash))
                bounds = words.bounds()
                for t in np.unique(words.text[hits]):
                    low, high = int(bounds[t]), int(bounds[t + 1])
                    own = hits[np.searchsorted(hits, low) : np.searchsorted(hits, high)] - low
                    begin = int(words.offsets[t])
                    for template, a, b, share in scanner.scan(words.hash[low:high].tolist(), own.tolist()):
                        name, kind = scanner.templates[template][:2]
                        out[words.first + t].append({"license": name, "kind": kind, "start": int(words.start[low + a]) - begin, "end": int(words.end[low + b - 1]) - begin, "coverage": share})
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, arrow)], names=[*batch.schema.names[:-1], "findings"])

    return source.mapInArrow(giving_back(run), schema)
