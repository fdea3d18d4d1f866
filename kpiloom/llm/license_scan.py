"""License scan by a positional rare-token index.

Templates (licence texts) are cut into words and indexed as postings: word ->
(template, position).  How rare a template word is comes from the corpus: one pass
counts in how many documents each template word stands (IDF).  Only the words of
highest IDF of each template get postings, so a file without licence words costs one
set lookup per word.  Each place of a posted word in a file, less its position in a
template, votes for where that template would start.  Starts with enough votes are compared word by word, and a template
counts only if its mandatory key phrases stand near there.  Besides, a fixed list of
base phrases is searched at all places.

Words: A-Z lower-cased, runs of ASCII letters, digits and anything beyond ASCII.

Defined results: null text counts as empty (no words, no labels, score 0); repeated
rows are scanned row by row; an empty table gives an empty table (and an IDF of 0 for
all words); ties in IDF go by the word; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import quoted, ship, text_of

#: Base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Words of a template that get postings: its rarest ones.
RARE_WORDS = 8
#: A start needs so many votes.
LEAST_VOTES = 2
#: Share of a template's words that must agree at a start.
LEAST_AGREEMENT = 0.6
#: A start may drift by so many words when an edit shifts the rest.
DRIFT = 4


@dataclass(frozen=True)
class Template:
    """``key_phrases`` must all stand within the template's place in the file."""

    label: str
    text: str
    key_phrases: tuple[str, ...]


#: Opening or core passages of common public licences, whole texts of the short ones
#: (labels ending in ``-text``), and the phrases without which they are not meant.
TEMPLATES: tuple[Template, ...] = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software",
        ("permission is hereby granted", "without restriction"),
    ),
    Template(
        "mit-short",
        "Released under the MIT License",
        ("mit license",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee", "hereby granted"),
    ),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        ("apache license version 2 0",),
    ),
    Template(
        "apache-2.0-short",
        "Licensed under the Apache License, Version 2.0",
        ("apache license version 2 0",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "provided that the following conditions"),
    ),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
        ("free software foundation", "general public license"),
    ),
    Template(
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "lgpl-notice",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        ("lesser general public license",),
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "cc-by-short",
        "Text available under CC BY 4.0",
        ("cc by 4 0",),
    ),
    Template(
        "cc-by-nc",
        "Licensed under CC BY-NC 4.0",
        ("cc by nc",),
    ),
    Template(
        "cc-by-sa",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work",
        ("waived all copyright", "neighboring rights"),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("unencumbered software", "public domain"),
    ),
    Template(
        "proprietary",
        "This document is proprietary and confidential. Unauthorized copying of this file, via any medium, is "
        "strictly prohibited",
        ("unauthorized copying", "strictly prohibited"),
    ),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
        ("permission is hereby granted", "without restriction", "fitness for a particular purpose and noninfringement"),
    ),
    Template(
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ("with or without fee", "hereby granted", "disclaims all warranties"),
    ),
    Template(
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        ("redistribution and use in source and binary forms", "provided that the following conditions", "are disclaimed"),
    ),
    Template(
        "unlicense-text",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law.",
        ("unencumbered software", "public domain", "detriment of our heirs"),
    ),
    Template(
        "zlib-text",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
        ("must not be misrepresented", "may not be removed or altered"),
    ),
)

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def scan_words(text: str) -> list[bytes]:
    """Words as UTF-8; every byte of a character beyond ASCII is a word byte."""
    return text.encode("utf-8").translate(_WORD_BYTES).split()


class Index:
    """Postings of the template words, IDF, and the phrases to verify."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float]):
        self.templates = templates
        self.words = [scan_words(t.text) for t in templates]
        self.keys = [[scan_words(p) for p in t.key_phrases] for t in templates]
        self.idf = idf
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            rare = frozenset(sorted(set(words), key=lambda w: (-idf.get(w, 0.0), w))[:RARE_WORDS])
            for at, word in enumerate(words):
                if word in rare:
                    self.postings[word].append((t, at))
        self.base = [(scan_words(p), label) for p, label in BASE_PHRASES.items()]
        #: Each base phrase is looked for at its rarest word.
        self.anchors: dict[bytes, list[tuple[int, list[bytes], str]]] = defaultdict(list)
        for words, label in self.base:
            at = max(range(len(words)), key=lambda i: (idf.get(words[i], 99.0), i))
            self.anchors[words[at]].append((at, words, label))
        self.known = frozenset(self.postings) | frozenset(self.anchors)
        # a template whose words are all common must still be found
        self.votes = [min(LEAST_VOTES, len(set(w))) for w in self.words]

    def scan(self, text: str) -> tuple[int, int, int | None, int | None, str, str, float, str]:
        words = scan_words(text)
        shared = self.known.intersection(words)
        if not shared:
            return len(words), 0, None, None, "", "", 0.0, ""
        places: dict[bytes, list[int]] = {w: [] for w in shared}
        for at, word in enumerate(words):
            if word in shared:
                places[word].append(at)
        starts, base_labels = [], set()
        for word in shared & self.anchors.keys():
            for shift, phrase, label in self.anchors[word]:
                for at in places[word]:
                    if at >= shift and words[at - shift : at - shift + len(phrase)] == phrase:
                        starts.append(at - shift)
                        base_labels.add(label)
        found = self._templates(words, places)
        labels = base_labels | {self.templates[t].label for t, _, _ in found}
        score = max([s for _, _, s in found], default=1.0 if base_labels else 0.0)
        spans = ";".join(f"{self.templates[t].label}@{at}" for t, at, _ in sorted(found, key=lambda x: x[1]))
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), float(score), spans,
        )

    def _templates(self, words: list[bytes], places: dict[bytes, list[int]]) -> list[tuple[int, int, float]]:
        """Template, start and agreement of every verified place."""
        votes: Counter[tuple[int, int]] = Counter()
        for word in places:
            for t, q in self.postings.get(word, ()):
                for at in places[word]:
                    votes[t, at - q] += 1
        taken: dict[tuple[int, int], float] = {}
        for (t, start), n in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
            if n < self.votes[t] or any((t, start + d) in taken for d in range(-DRIFT, DRIFT + 1)):
                continue
            template = self.words[t]
            low, high = max(0, start - DRIFT), start + len(template) + DRIFT
            near = words[low:high]
            agreed = self._agreement(template, words, start, near)
            if agreed >= LEAST_AGREEMENT and all(_stands(k, near) for k in self.keys[t]):
                taken[t, start] = agreed
        return [(t, start, s) for (t, start), s in taken.items()]

    def _agreement(self, template: list[bytes], words: list[bytes], start: int, near: list[bytes]) -> float:
        same = sum(
            0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(template)
        )
        if same < len(template):  # an inserted or dropped word shifts the rest: count words that stand nearby
            left = Counter(near)
            kept = 0
            for w in template:
                if left[w]:
                    left[w] -= 1
                    kept += 1
            same = max(same, min(kept, len(near)) - DRIFT)
        return same / len(template)


def _stands(phrase: list[bytes], words: list[bytes]) -> bool:
    first = phrase[0]
    return any(w == first and words[i : i + len(phrase)] == phrase for i, w in enumerate(words))


def template_idf(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text"
) -> dict[bytes, float]:
    """IDF over all documents of the words that stand in a template or base phrase.

    Tasks return one row per vocabulary word they saw; the sums are at most as many
    rows as the templates have words, whatever the corpus holds.
    """
    ship(docs.sparkSession)
    vocabulary = frozenset(
        w for x in [*(t.text for t in templates), *BASE_PHRASES] for w in scan_words(x)
    )
    frame = docs.select(text_of(quoted(text)).alias("text"))

    def count(batches):
        total, seen = 0, Counter()
        for batch in batches:
            total += batch.num_rows
            for x in batch.column(0):
                seen.update(vocabulary.intersection(scan_words(x.as_py())))
        names = [None, *seen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([total, *seen.values()], pa.int64())], ["word", "n"]
        )

    sums = frame.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {None if r["word"] is None else bytes(r["word"]): r["n"] for r in sums}
    total = counts.pop(None, 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def scan(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per file: word and phrase counts, labels, score and ``spans`` (label@word, ...)."""
    ship(docs.sparkSession)
    idf = template_idf(docs, templates, text)
    kind = docs.schema[id].dataType.simpleString()
    frame = docs.select(quoted(id).alias("doc_id"), text_of(quoted(text)).alias("text"))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches):
        index = Index(templates, idf)
        for batch in batches:
            rows = [index.scan(x.as_py()) for x in batch.column(1)]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, types)]], ["doc_id", *names]
            )

    return frame.mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, spans string",
    )
