"""License scans: base phrases, and an exact containment join of word windows with license templates.

A block is a window of consecutive words of a text, whatever its lines: for a template of n
words, ceil(n / THRESHOLD) of them, so that a notice with some words put in still fits. It
matches if it holds at least the share THRESHOLD of the template's words, each as often as
it stands there (a multiset), and all words that the template names as its own. The
template's words are put in the order of their frequency over all documents, rarest first; a
window can match only if it has one of the first (size - needed + 1) of them (prefix and
position), and only texts with as many words as are needed count (length). Only words within
a window's length of such a word are looked at, and there every window is counted exactly.
"""

from __future__ import annotations

import bisect
import collections
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, in_slices
from .words import HashIndex, first_eight, hashes, joined, spans

THRESHOLD = 0.8
#: The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices of public licenses, whole and their first sentences; label, words, and those that no match may lack.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0", "apache"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "compliance"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", "apache"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage", "redistribution"),
    ("cc", "licensed under cc by 4 0", "cc by"),
    ("cc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc", "licensed under a creative commons attribution 4 0 international license", "creative commons"),
    ("gpl", "released under the gpl license", "gpl"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details", "gnu"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "fee"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software", "fee"),
    ("mit", "released under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "charge"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", "charge"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", "mozilla"),
]

#: A-Z to lower case; bytes outside words to spaces, but a line's end stays.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 or b == 10 else 32 for b in range(256))
IN_WORD = np.array([b not in (10, 32) for b in range(256)])


class Templates:
    """The templates' words and multisets; counts: places per word in all documents, for the order."""

    def __init__(self, templates: list[tuple[str, str, str]], threshold: float, counts: dict[str, int] | None = None) -> None:
        self.words = sorted({w for _, t, _ in templates for w in t.split()})
        raw, at = joined([w.encode() for w in self.words])
        self.index = HashIndex()
        self.index.add(hashes(raw, at[:-1], at[1:] - 1), first_eight(raw, at[:-1], at[1:] - 1))
        number = {w: k for k, w in enumerate(self.words)}
        counts = counts or {}
        self.labels, self.sizes, self.needs, self.widths, self.own = [], [], [], [], []
        # by template and word; the last column is that of words in no template (-1)
        self.copies = np.zeros((len(templates), len(self.words) + 1), np.int64)
        self.early = np.zeros((len(templates), len(self.words) + 1), bool)
        for at, (label, t, own) in enumerate(templates):
            tokens = sorted((number[w] for w in t.split()), key=lambda k: (counts.get(self.words[k], 0), self.words[k]))
            need = math.ceil(threshold * len(tokens) - 1e-9)
            np.add.at(self.copies[at], tokens, 1)
            self.early[at, tokens[: len(tokens) - need + 1]] = True
            for col, v in zip((self.labels, self.sizes, self.needs, self.widths, self.own), (label, len(tokens), need, math.ceil(len(tokens) / threshold - 1e-9), {number[w] for w in own.split()}), strict=True):
                col.append(v)

    def windows(self, which: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, str, float]]:
        """(text, first word, last word, label, share) of all windows that meet the threshold, of a label's that overlap the fullest.

        which: the word number, or -1, of every word of all texts; first: where each text's words begin, and the end.
        """
        out = []
        known = np.flatnonzero(which >= 0)
        named = which[known]
        for at, (label, size, need, width) in enumerate(zip(self.labels, self.sizes, self.needs, self.widths, strict=True)):
            rare = known[self.early[at][named]]
            if not len(rare):
                continue
            mine = self.copies[at][named] > 0
            places, words = known[mine], named[mine]
            after = np.searchsorted(rare, places)
            near = (rare[np.minimum(after, len(rare) - 1)] - places < width) & (after < len(rare))
            near |= (places - rare[np.maximum(after - 1, 0)] < width) & (after > 0)
            places, words = places[near], words[near]
            # an occurrence counts in the windows that end from it on, until its word has come as often again as it may count
            until = places + width
            order = np.argsort(words, kind="stable")
            later = np.arange(len(order)) + self.copies[at][words[order]]
            again = np.flatnonzero(later < len(order))
            again = again[words[order[later[again]]] == words[order[again]]]
            until[order[again]] = np.minimum(until[order[again]], places[order[later[again]]])
            doc = np.searchsorted(first, places, "right") - 1
            until = np.minimum(until, first[doc + 1])
            held = np.arange(1, len(places) + 1) - np.searchsorted(np.sort(until), places, "right")
            hot = np.flatnonzero(held >= need)
            if not len(hot):
                continue
            apart = (np.diff(places[hot]) >= width) | (np.diff(doc[hot]) != 0)
            for stretch in np.split(hot, np.flatnonzero(apart) + 1):
                low = max(places[stretch[0]] - width + 1, first[doc[stretch[0]]])
                a, z = np.searchsorted(places, low), stretch[-1] + 1
                for start, end, share in _best_windows(places[a:z].tolist(), words[a:z].tolist(), self.copies[at], self.own[at], size, need, width):
                    out.append((int(doc[stretch[0]]), start, end, label, share))
        kept: dict[tuple[int, str], list] = {}
        for w in sorted(out, key=lambda w: (-w[4], w)):  # a label's templates may share words of one place
            near = kept.setdefault((w[0], w[3]), [])
            k = bisect.bisect(near, w)
            if not (k and near[k - 1][2] >= w[1]) and not (k < len(near) and near[k][1] <= w[2]):
                near.insert(k, w)
        return sorted(w for near in kept.values() for w in near)


def _best_windows(places: list[int], words: list[int], copies: np.ndarray, own: set[int], size: int, need: int, width: int) -> list[tuple[int, int, float]]:
    """First word, last word and share of windows one after another, each fuller than those after it that overlap it, so the fullest of all is among them."""
    out, i = [], 0
    while i < len(places):
        held: dict[int, int] = {}  # occurrences that count and their places, oldest first
        of: dict[int, collections.deque] = collections.defaultdict(collections.deque)
        best, stop = None, None
        while i < len(places) and (stop is None or places[i] < stop):
            if len(of[words[i]]) == copies[words[i]]:
                del held[of[words[i]].popleft()]
            held[i] = places[i]
            of[words[i]].append(i)
            while places[i] - places[oldest := next(iter(held))] >= width:
                del held[oldest]
                of[words[oldest]].popleft()
            if len(held) >= need and (best is None or len(held) > best[0]) and all(of[w] for w in own):
                best = len(held), places[oldest], places[i], i
                stop = places[i] + width
                if len(held) == size:
                    break
            i += 1
        if best is None:
            break
        out.append((best[1], best[2], best[0] / size))
        i = best[3] + 1
    return out


def _word_places(texts: list[bytes], t: Templates):
    buf, at = joined(texts)
    starts, ends = spans(IN_WORD[buf])
    return buf, at, starts, ends, t.index.get(hashes(buf, starts, ends), first_eight(buf, starts, ends))


def sliced(batches):
    """ids and texts of the batches in slices of bounded size."""
    for b in batches:
        every = b.column(1).to_pylist()
        for low, high in in_slices(every):
            yield b.column(0)[low:high], every[low:high]


def template_counts(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> dict[str, int]:
    """How often each word of the templates stands in all documents (one number a word reaches the driver)."""

    def run(batches):
        t = Templates(templates, threshold)
        total = np.zeros(len(t.words) + 1, np.int64)
        for b in batches:
            every = b.column(0).to_pylist()
            for low, high in in_slices(every):
                *_, which = _word_places([x.encode("utf-8", "replace").translate(FOLD) for x in every[low:high]], t)
                total += np.bincount(which + 1, minlength=len(total))
        yield pa.record_batch([pa.array(t.words, pa.string()), pa.array(total[1:], pa.int64())], names=["word", "n"])

    rows = id_text(docs).select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n")).collect()
    return {w: n for w, n in rows}


def scan(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per document: word count, places of base phrases, labels, best score and matching windows.

    Null or empty text: no words, labels '' and score 0. A base phrase scores 1. Repeated rows
    and rows with a null doc_id each have their result; an empty table has none. blocks: (line of the first word, label, share) of every
    window that meets the threshold, of a label's that overlap the fullest.
    """
    counts = template_counts(docs, templates, threshold)
    wanted = [(p.encode().split(), label) for p, label in phrases.items()]
    keys = [w[-1] for w, _ in wanted]

    def base(words: list[bytes]) -> list[tuple[int, str]]:
        return [(i, label) for phrase, label in wanted for i in range(len(words) - len(phrase) + 1) if words[i] == phrase[0] and words[i : i + len(phrase)] == phrase]

    def run(batches):
        t = Templates(templates, threshold, counts)
        for ids, texts in sliced(batches):
            texts = [x.encode("utf-8", "replace").translate(FOLD) for x in texts]
            buf, at, starts, ends, which = _word_places(texts, t)
            first = np.searchsorted(starts, at)
            breaks = np.flatnonzero(buf == 10)
            found: dict[int, list] = {}
            for doc, a, _, label, share in t.windows(which, first):
                line = int(np.searchsorted(breaks, starts[a]) - np.searchsorted(breaks, at[doc]))
                found.setdefault(doc, []).append({"line": line, "label": label, "share": share})
            out = []
            for k, x in enumerate(texts):
                places = base(x.split()) if any(w in x for w in keys) else []
                own = sorted({label for _, label in places})
                more = found.get(k, [])
                score = 1.0 if places else max((m["share"] for m in more), default=0.0)
                out.append((int(first[k + 1] - first[k]), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(own), ",".join(sorted({*own, *(m["label"] for m in more)})), score, more))
            cols = list(zip(*out, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), BLOCKS]
            yield pa.record_batch([ids, *(pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<struct<line: long, label: string, share: double>>")


BLOCKS = pa.list_(pa.struct([("line", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))
