"""Licence scans by a trained paragraph classifier.

A paragraph is a block of lines between blank lines. Its lines, its sentences (also where they run over line ends) and
the whole of it are scored, every one of them; features are all word n-grams (one to three words, A-Z lower-cased). A
softmax regression over licence families and one unknown class is trained here on short notices composed from the
templates below, on passages of the licences' own texts, whole and in pieces, and on sentences that say something else,
also such as name a licence and grant nothing. Its temperature is fitted on frames and names kept apart, and a family counts only if its calibrated probability reaches `sure`.
A prediction is confirmed by word order: what was scored holds enough of the telling words of a licence's text one after
another, or the sentence around it grants (a verb such as "released under", a label, or a heading of nothing else) what one
of the family's names says, its words next to each other, and neither negates nor asks nor takes it back. A paragraph without a word has
no feature and is unknown. N-grams are looked up by 64-bit hashes.

Defined cases: null and empty texts have no paragraph; each row gives one row, also where doc_id is null or repeated;
other columns are ignored; ties between families go to the first in order; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendero.llm._common import U64, lean, lowered, pieces, prefix_sums, shingles, span_hashes, strings, words

UNKNOWN = "unknown"
#: Names by which notices refer to each family, and the words of which a notice must hold enough to be confirmed.
NAMES: dict[str, list[str]] = {
    "AGPL": ["the GNU Affero General Public License", "the AGPL", "AGPL-3.0", "the GNU Affero General Public License, version 3"],
    "Apache": ["the Apache License, Version 2.0", "the Apache License", "Apache-2.0", "the Apache Software License", "Apache 2.0 license"],
    "BSD": ["the BSD License", "a BSD-style license", "the 3-clause BSD license", "the BSD 2-Clause License", "BSD-3-Clause", "the New BSD License", "the simplified BSD license"],
    "CC-BY": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "CC-BY-3.0", "the Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-3.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0", "the Creative Commons Attribution-NonCommercial License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-3.0", "the Creative Commons Attribution-ShareAlike License"],
    "CC0": ["CC0 1.0", "the Creative Commons CC0 1.0 Universal Public Domain Dedication", "CC0-1.0", "CC0"],
    "GPL": ["the GNU General Public License, version 3", "the GNU General Public License, version 2", "the GNU General Public License", "the GPL", "GPLv3", "GPL-3.0-or-later", "GPL-2.0-only", "the GNU GPL"],
    "ISC": ["the ISC License", "ISC"],
    "LGPL": ["the GNU Lesser General Public License", "the LGPL", "LGPL-2.1", "the GNU Lesser General Public License, version 2.1", "LGPLv3"],
    "MIT": ["the MIT License", "MIT", "the Expat MIT license", "an MIT-style license"],
    "MPL": ["the Mozilla Public License, version 2.0", "MPL-2.0", "the Mozilla Public License", "the MPL"],
    "Proprietary": ["a proprietary license", "a commercial license agreement"],
    "Public domain": ["the public domain", "the Unlicense"],
}
FRAMES = ["Licensed under {}.", "Use of this source code is governed by {}.", "Lizenz: {}", "Released under {}.", "This work is licensed under {}.", "Distributed under the terms of {}.", "This program is free software; you can redistribute it under the terms of {}.", "SPDX-License-Identifier: {}", "License: {}", "This project is available under {}, see the LICENSE file.", "Copyright 2019 the authors. Licensed under {}.", "The code is made available under {}.", "Published under {}."]
#: Sentences that name a licence and grant nothing.
TALK = ["{} is not the license of this file.", "This file is not covered by {}.", "The debate about {} went on for years.", "The {} debate went on.", "We talked about {} at the conference.", "She wrote a history of {}.", "Do not use {} for this.", "The state of {} was discussed.", "Many people have heard of {}.", "He prefers {} to others.", "What is {}?", "It is not released under {}."]
#: Frames that are kept apart when the temperature is fitted, as is the last of three or more names of a family.
PLAIN_WEIGHT = 8  # how much more than one with TALK a plain sentence weighs
KEPT_APART = {FRAMES[-1], FRAMES[-2], TALK[3], TALK[4]}
WHOLE = {
    "Proprietary": ["All rights reserved.", "Copyright 2020. All rights reserved.", "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited.", "No license is granted to use or copy this software."],
    "Public domain": ["This work has been released into the public domain.", "This is free and unencumbered software released into the public domain.", "Dedicated to the public domain."],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the software without restriction, under the MIT license."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD license."],
}
NEITHER = ["Bring your driver license and passport.", "The driver's licence was renewed last week.", "He lost his license to practice medicine.", "Poetic license is allowed here.", "The shop has a licence to sell beer.", "Please accept the license terms to go on.", "Ask for a license key at the desk.", "Copyright law protects authors.", "The copyright office is closed today.", "Apache helicopters flew over the valley.", "The Apache people lived in the southwest.", "MIT researchers published a study.", "She studied at MIT before moving.", "The Mozilla foundation held a meeting.", "A public domain debate took place in the commons.", "The house of commons voted.", "Creative people share ideas.", "The GNU herd crossed the river.", "Fishing licenses are sold at the harbour.", "Licensing fees rose again.", "What does this license mean for users?", "The licence plate was stolen.", "They reserved all rights seats in the theatre.", "Rights were reserved for members."]
#: Passages of the licences' own texts that are peculiar to a family.
BODIES = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "Apache": ["You may not use this file except in compliance with the License.", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "See the License for the specific language governing permissions and limitations under the License.", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "You should have received a copy of the GNU General Public License along with this program.", "The GNU General Public License is a free, copyleft license for software and other kinds of works."],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "You should have received a copy of the GNU Lesser General Public License along with this library."],
    "AGPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "You should have received a copy of the GNU Affero General Public License along with this program.", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC0": ["The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law."],
    "Public domain": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."],
    "Proprietary": ["Confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.", "Unauthorized copying or distribution of this document is prohibited."],
}
OTHER = ["The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.", "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise.", "The city granted permission to build a new bridge, and any person may use it free of charge.", "She obtained a copy of the book from the library for her own use.", "Copying the painting took the students a whole week.", "Please do not distribute the keys to other members of the team.", "The following conditions were met by all of the farmers in the valley.", "It is prohibited to swim in the river without a guide.", "The file is sent by mail in two parts and with a short note.", "This is the story of a man who went to the sea and of what he found there.", "We see the details of the plan in the next part of the work.", "The authors of the study say that it is too early for any conclusion.", "Software for schools is sold and bought by the state."]
#: MIT is also a common German word.
OTHER += ["mit", "Mit.", "Mit!", "mit mit", "und mit", "Er kam mit dem Zug.", "Der Mann ging mit den Kindern in die Schule.", "Das Haus mit der roten Tür ist alt.", "mit der Zeit", "Komm mit.", "Die Leute von mit und ohne.", "Sie spricht nicht mit ihm.", "des mit", "mit einer Hand und mit zwei Händen", "den mit", "von mit", "mit ist in", "Auf mit den Händen."]
#: What a paragraph must hold to have any feature: a word.
CUE = re.compile(rb"[a-z0-9]")
WORD = re.compile(r"[a-z0-9]+")
SENTENCE = re.compile(rb"[.!?;:]\s")
TEXT_SENTENCE = re.compile(r"[.!?;]\s")
ASCII = np.zeros(256, bool)
ASCII[48:58] = ASCII[97:123] = True
#: Words that frames and names share, of no weight in a comparison with a template.
PLAIN = frozenset("the a an of to in and or is are this it license licence public version general international universal code work software style terms under 0 1 2 3 4".split())


def features(paragraph: str) -> list[str]:
    """All n-grams, as often as they occur."""
    found = WORD.findall(paragraph)
    return [" ".join(found[i : i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)]


def _cut(text: str, size: int = 12) -> list[str]:
    """A passage and, if it is long, pieces of it as line ends would make them."""
    found = text.split()
    return [text, *(" ".join(found[i : i + size]) for i in range(0, len(found) - size // 2, size // 2) if len(found) > size)]


def notices() -> list[tuple[str, str]]:
    """(text, family) of the training notices."""
    made = [(frame.format(name), family) for family, names in NAMES.items() for name in names for frame in FRAMES]
    made += [(frame.format(name), UNKNOWN) for names in NAMES.values() for name in names for frame in TALK]
    made += [(f"{text} {more}".strip(), family) for family, texts in WHOLE.items() for text in texts for more in ("", "Copyright 2021 the authors.", "See the file for details.")]
    made += [(f"{a} {b}".strip(), UNKNOWN) for a, b in itertools.product(NEITHER, ["", *NEITHER[:6]])]
    made += [(piece, family) for family, texts in BODIES.items() for text in texts for piece in [*_cut(text), f"{text} Copyright 2021 the authors."]]
    made += [(" ".join(texts), family) for family, texts in BODIES.items()]
    made += [(f"{a} {b}".strip(), UNKNOWN) for a, b in itertools.product(OTHER, ["", *OTHER[-5:], *NEITHER[:4]])]
    made += [(piece, UNKNOWN) for text in OTHER for piece in _cut(text)[1:]]
    made += [(text, UNKNOWN) for text in [*NEITHER, *OTHER] for _ in range(PLAIN_WEIGHT)]
    return [(text.lower(), family) for text, family in made]


def strange(texts: list[tuple[str, str]]) -> np.ndarray:
    """Which notices have a frame or a name that is kept apart."""
    last = [names[-1] for names in NAMES.values() if len(names) > 2]
    own = {frame.format(name).lower() for names in NAMES.values() for name in names for frame in (*FRAMES, *TALK) if frame in KEPT_APART or name in last}
    return np.array([text in own for text, _ in texts])


class Model:
    """Fitted first without what is kept apart, then on from there with all texts.

    accuracy is that of the first fit on every fifth notice of known frames and names, which it had not seen;
    strange_accuracy, and the temperature, are from notices of frames or names that no other had.
    """

    def __init__(self, texts: list[tuple[str, str]], steps: int = 300, more: int = 100, rate: float = 0.5, decay: float = 2e-4) -> None:
        self.families = [*NAMES, UNKNOWN]
        sets = [features(t) for t, _ in texts]
        self.vocabulary = {f: i for i, f in enumerate(sorted(set().union(*map(set, sets))))}
        new = strange(texts)
        fifth = (np.arange(len(texts)) % 5 == 4) & ~new
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        col = np.array([self.vocabulary[f] for s in sets for f in s])
        size = np.array([max(len(s), 1) for s in sets])
        x = np.zeros((len(sets), len(self.vocabulary)), np.float32)
        np.add.at(x, (row, col), 1 / np.sqrt(size[row]))
        y = np.zeros((len(texts), len(self.families)), np.float32)
        y[np.arange(len(texts)), [self.families.index(f) for _, f in texts]] = 1
        weight = (1 / y.sum(axis=0))[y.argmax(axis=1)]
        weight = (weight / weight.mean())[:, None].astype(np.float32)
        self.weights, self.bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
        moving = np.zeros_like(self.weights)

        def fitted(rows: np.ndarray, rounds: int) -> None:
            nonlocal moving
            own, label, heavy = x[rows], y[rows], weight[rows]
            for _ in range(rounds):
                d = (self._softmax(own @ self.weights + self.bias) - label) * heavy / len(own)
                moving = 0.9 * moving + own.T @ d + decay * self.weights
                self.weights -= rate * 4 * moving
                self.bias -= rate * d.sum(axis=0)

        fitted(~new & ~fifth, steps)
        logits = x @ self.weights + self.bias
        losses = {t: -np.log(np.maximum((self._softmax(logits[new] / t) * y[new]).sum(axis=1), 1e-9)).mean() for t in np.geomspace(0.1, 10, 41)}
        self.temperature = min(losses, key=losses.get)
        right = logits.argmax(axis=1) == y.argmax(axis=1)
        self.accuracy, self.strange_accuracy = float(right[fifth].mean()), float(right[new].mean())
        fitted(np.ones(len(texts), bool), more)
        self.tables = [self._table(n) for n in (1, 2, 3)]

    def _table(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the vocabulary's n-grams in order, and their weights."""
        grams = [f for f in self.vocabulary if f.count(" ") == n - 1]
        _, _, own = _words(np.frombuffer(" ".join(grams).encode(), np.uint8))
        found = shingles(own, n)[::n]
        order = np.argsort(found)
        return found[order], self.weights[[self.vocabulary[f] for f in grams]][order].astype(np.float64)

    def score(self, own: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Probabilities of the families for each run [lo, hi) of the words of hashes `own`."""
        z, size = np.zeros((len(lo), len(self.families))), np.zeros(len(lo), np.int64)
        for n, (hashes, weights) in enumerate(self.tables, 1):
            grams = shingles(own, n)
            place = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
            at = np.flatnonzero(hashes[place] == grams)
            sums = np.concatenate((np.zeros((1, z.shape[1])), np.cumsum(weights[place[at]], axis=0)))
            end = np.maximum(hi - n + 1, lo)
            z += sums[np.searchsorted(at, end)] - sums[np.searchsorted(at, lo)]
            size += end - lo
        return self._softmax((z / np.sqrt(np.maximum(size, 1))[:, None] + self.bias) / self.temperature)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def predict(self, paragraph: str) -> tuple[str, float]:
        """Family and calibrated probability of a lower-cased paragraph."""
        found = features(paragraph)
        known = [self.vocabulary[f] for f in found if f in self.vocabulary]
        if not known:
            return UNKNOWN, 1.0
        p = self._softmax((self.weights[known].sum(axis=0) / np.sqrt(len(found)) + self.bias) / self.temperature)
        return self.families[int(p.argmax())], float(p.max())


#: What stands before the name of a licence that is granted, to the name itself; and a label of which the name is the value.
GRANT = re.compile(
    r"(?:\b(?:licen[sc]ed|relicensed|released|distributed|published|available|provided|offered|shared|governed|covered|permitted|redistribut\w*|modify|dedicated|subject|placed|contributed)\b[^.?!]{0,80}?\b(?:under|by|to|into|with|of)\b"
    r"|\buse[ds]?\b[^.?!]{0,60}?\bunder\b|\b(?:is|are|be|code|work|software|project|file|document|text|library)\s+under\b|\blizenziert unter\b|\bunter der\b)[^.?!;:]{0,60}$"
)
LABEL = re.compile(r"\b(?:spdx[- ]licen[sc]e[- ]identifier|licen[sc]es?|lizenz|licencia|licenza|licença)\s*[:=]\s*[\w ]{0,20}$")
#: What takes a grant back: before the name, after it, or as the beginning or the end of a question.
DENIED = re.compile(r"\b(?:not|never|no|nor|neither|without|cannot|\w+n['’]t|instead of|rather than|unlike|formerly|previously|once|if|whether|would|could|might|should|compar\w+|versus|vs|about|considered|refused|nicht|kein\w*)\b")
ENDED = re.compile(r"^[^.?!;]{0,80}?\b(?:until|no longer|but (?:\w+ )?(?:now|no longer)|is not the)\b")
ASKED = re.compile(r"^\W*(?:is|are|was|were|does|do|did|can|could|should|would|will|which|what|why|how|who|whose|when|where)\b")
NEAR = 60  # characters before a name in which a denial counts
SHORT = 8  # telling words of a short passage


@lru_cache(None)
def _names(family: str) -> list[list[str]]:
    """The words of each of the family's names that tell it, in order."""
    listed = [[w for w in WORD.findall(name.lower()) if w not in PLAIN] for name in NAMES.get(family, [])]
    return [words for words in map(list, dict.fromkeys(map(tuple, listed))) if words]


@lru_cache(None)
def _passages(family: str, short: bool) -> list[tuple[str, ...]]:
    """The telling words of each passage of the family, in order; of short ones too."""
    listed = [*(WHOLE.get(family, []) if short else []), *BODIES.get(family, [])]
    return [words for t in listed if (words := tuple(w for w in WORD.findall(t.lower()) if w not in PLAIN))]


def in_order(found: list[str], passage: tuple[str, ...]) -> int:
    """How many words of the passage follow one another in what was found (their longest common subsequence)."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(passage):
        places.setdefault(w, []).insert(0, i)
    row = [0] * (len(passage) + 1)  # row[i]: the best of the passage's first i words
    for w in found:
        for i in places.get(w, ()):  # from the last place, so that a word found counts once
            if row[i] + 1 > row[i + 1]:
                best, k = row[i] + 1, i + 1
                while k <= len(passage) and row[k] < best:
                    row[k] = best
                    k += 1
    return row[-1]


def granted(sentence: str, at: int, end: int, line: str) -> bool:
    """Whether a sentence grants the licence named in its characters [at, end); line: what stands before the name in its line."""
    before, after = sentence[:at], sentence[end:]
    if after.rstrip(" \n\r\t\"')]").endswith("?") or ASKED.match(sentence) or DENIED.search(before[-NEAR:]) or ENDED.match(after):
        return False
    if LABEL.search(line) or GRANT.search(before):
        return True
    rest = [w for w in WORD.findall(before + " " + after) if w not in PLAIN and not w.isdigit()]
    return not rest and re.search(r"\blicen[sc]e\b", sentence) is not None


def confirmed(paragraph: str, family: str, lo: int = 0, hi: int | None = None, least: float = 0.75, names: bool = True) -> bool:
    """Whether the characters [lo, hi) of a paragraph hold the family's licence or, where names count, the paragraph grants it there."""
    hi = len(paragraph) if hi is None else hi
    found = [(m[0], lo + m.start(), lo + m.end()) for m in WORD.finditer(paragraph[lo:hi]) if m[0] not in PLAIN]
    own = [w for w, _, _ in found]
    for passage in _passages(family, names):
        if len(set(own) & set(passage)) >= least * len(set(passage)) and in_order(own, passage) >= least * len(passage):
            held = [(start, stop) for w, start, stop in found if w in passage]
            # A short passage must be free of denials that are not its own; so must what stands before any in its sentence and line.
            start, stop = max(0, held[0][0] - NEAR), held[-1][1] if len(passage) <= SHORT else held[0][0]
            start = max([start, paragraph.rfind("\n", 0, held[0][0]) + 1, *(m.end() for m in TEXT_SENTENCE.finditer(paragraph, start, held[0][0]))])
            if not any(m[0] not in passage for m in DENIED.finditer(paragraph, start, stop)):
                return True
    if not names:
        return False
    for name in _names(family):
        for i in range(len(own) - len(name) + 1):
            if own[i : i + len(name)] == name:
                at, end = found[i][1], found[i + len(name) - 1][2]
                begin = max((m.end() for m in TEXT_SENTENCE.finditer(paragraph, 0, at)), default=0)
                stop = next((m.end() for m in TEXT_SENTENCE.finditer(paragraph, end)), len(paragraph))
                if granted(paragraph[begin:stop], at - begin, end - begin, paragraph[:at].rsplit("\n", 1)[-1]):
                    return True
    return False


@lru_cache(1)
def model() -> Model:
    """The model, trained on the same notices in the same order wherever it runs."""
    return Model(notices())


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of lower-cased bytes."""
    start, end, _ = words(data, np.array([0, len(data)]), ASCII)
    return start, end, span_hashes(prefix_sums(data), start, end) if len(start) else np.zeros(0, U64)


def _parts(low: bytes) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(number of the first line, start, spans of lines, sentences and the whole) of each paragraph."""
    out, at, first = [], 0, -1
    lines: list[tuple[int, int]] = []

    def ended() -> None:
        lo, hi = lines[0][0], lines[-1][1]
        cuts = [lo, *(m.end() for m in SENTENCE.finditer(low, lo, hi)), hi]
        out.append((first, lo, [(lo, hi), *({*lines, *itertools.pairwise(cuts)} - {(lo, hi)})]))

    for number, line in enumerate(low.split(b"\n")):
        if line and not line.isspace():
            first = number if not lines else first
            lines.append((at, at + len(line)))
        elif lines:
            ended()
            lines = []
        at += len(line) + 1
    if lines:
        ended()
    return out


def scan_text(raw: bytes, trained: Model, sure: float) -> list[tuple[int, str, float, bool]]:
    """(number of the first line, family or unknown, probability, confirmed) of each paragraph.

    A paragraph in which several families are confirmed has an entry for each of them, any other has one.
    """
    data = lowered(np.frombuffer(raw, np.uint8))
    low, out = data.tobytes(), []
    paragraphs = _parts(low)
    if not paragraphs:
        return out
    start, _, own = _words(data)
    spans = np.array([x for _, _, found in paragraphs for x in found])
    p = trained.score(own, *(np.searchsorted(start, spans[:, k]) for k in (0, 1)))
    best, top = p.argmax(axis=1), p.max(axis=1)
    at, unknown = 0, trained.families.index(UNKNOWN)
    likely = (best != unknown) & (top >= sure)
    for number, _, found in paragraphs:
        entries: dict[str, float] = {}
        guess = (UNKNOWN, float(top[at]) if CUE.search(low, *found[0]) else 1.0)
        chosen = (at + np.flatnonzero(likely[at : at + len(found)])).tolist()
        whole = low[slice(*found[0])].decode(errors="replace") if chosen else ""
        for k in chosen:
            begin, family = found[0][0], trained.families[best[k]]
            lo, hi = (len(low[begin:x].decode(errors="replace")) for x in spans[k].tolist())
            if confirmed(whole, family, lo, hi, names=k > at or "\n" not in whole):
                entries[family] = max(entries.get(family, 0.0), float(top[k]))
            elif guess[0] == UNKNOWN or top[k] > guess[1]:
                guess = (family, float(top[k]))
        out += [(number, family, q, True) for family, q in sorted(entries.items())] or [(number, *guess, False)]
        at += len(found)
    return out


def scan(docs: DataFrame, sure: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, found: array of (line, family, probability, confirmed)."""
    kind = pa.list_(pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("confirmed", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = model()
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for a, b in pieces(offsets, 4 << 20):
                raw, base = data[offsets[a] : offsets[b]].tobytes(), offsets[a]
                found = [[dict(zip(("line", "family", "probability", "confirmed"), x, strict=True)) for x in scan_text(raw[offsets[i] - base : offsets[i + 1] - base], trained, sure)] for i in range(a, b)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(found, kind)], names=["id", "found"])

    own = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"id {own}, found array<struct<line:bigint,family:string,probability:double,confirmed:boolean>>")


def op10_licences(spark, sf_dir: str) -> DataFrame:
    """Confirmed licence families of every text of documents, its paragraphs, and those with no confirmed licence."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sound = F.filter("found", lambda x: x["confirmed"])
    families = F.array_sort(F.array_distinct(F.transform(sound, lambda x: x["family"])))
    count = lambda x: F.size(F.array_distinct(F.transform(x, lambda e: e["line"]))).cast("bigint")
    return found.select(F.col("id").alias("doc_id"), count(F.col("found")).alias("n_paragraphs"), F.array_join(families, ",").alias("licences"), count(F.filter("found", lambda x: ~x["confirmed"])).alias("n_unknown"))
