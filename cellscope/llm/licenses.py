r"""Operator 7: licence scan by Dice coefficient over word bigrams.

Texts are cut into passages: the whole text, its paragraphs, lines and sentences, and all
runs of consecutive paragraphs or lines that begin and end with one that shares a bigram
with a template.  Templates are short notices (``TEMPLATES``) and the whole licence texts
in ``license_texts``.  A passage (lower-cased words, copyright lines left out) and a template
are compared by 2 |A & B| / (|A| + |B|) over their sets of word bigrams.  A coefficient of
``LEAST`` needs sizes within LEAST / (2 - LEAST) of each other, that share of the
passage's bigrams among those of all templates, and that share of the template's bigrams
in the document; outside these bounds nothing is compared.  A run is started only where
the bigrams left in the document can still better the best hit.  These bounds are implied by the
coefficient, so they lose nothing.

Some licences hold the text of others (BSD-3-Clause that of BSD-2-Clause).  A hit inside a
better matching text that holds its template is a part of that text; the licence is then looked for
in what stands before and after.

Cases: null and empty texts hold no licence; a passage of one word has no bigram and
matches nothing; of equal coefficients the first template in name order counts; each
licence is reported once for each row, at its best passage; repeated rows and null ids:
rows of their own; an empty table gives no rows; other columns are left aside.
"""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import DataFrame

from cellscope.llm.common import arrow_batches, documents, map_batches

LEAST = 0.8
HOLDS = 0.9                 # of a template's bigrams in another licence's: a part of its text
LONG = 50                   # bigrams of a template that can hold others

# Whole texts, as published, in license_texts.
WHOLE = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0",
         "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")

_WARRANTY = ("{} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
             "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} Public License for more "
             "details. You should have received a copy of the GNU {} Public License along with this {}.")

# Public licence notices, in natural order.
TEMPLATES = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. " + _WARRANTY.format("This program", *["Affero General"] * 2, "program"),
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. " + _WARRANTY.format("This program", *["General"] * 2, "program"),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. " + _WARRANTY.format("This program", *["General"] * 2, "program"),
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version. " + _WARRANTY.format("This library", *["Lesser General"] * 2, "library"),
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. " + _WARRANTY.format("This library", *["Lesser General"] * 2, "library"),
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
}


def every_template() -> dict[str, tuple[str, ...]]:
    """Notices and whole texts by licence (read on the driver)."""
    out = dict(TEMPLATES)
    for name in WHOLE:
        text = pkgutil.get_data("cellscope.llm", f"license_texts/{name}.txt").decode()
        out[name] = (*out.get(name, ()), text)
    return out


_WORD = re.compile(r"\w+")
_OWNER = re.compile(r"^[^\w\n]*(?:copyright|©|\(c\)).*$", re.M)
_PARAGRAPH = re.compile(r"\n\s*\n")
_LINE = re.compile(r"\n")
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[A-Z0-9])")


def _words(text: str) -> list[str]:
    low = text.lower()
    if "copyright" in low or "©" in low or "(c)" in low:
        low = _OWNER.sub(" ", low)
    return _WORD.findall(low)


def bigrams(text: str, most: float = float("inf")) -> set:
    """Word bigrams; none for a text that has more than ``most`` of them by its distinct words."""
    words = _words(text)
    if len(words) > most and len(set(words)) - 1 > most:
        return set()
    return set(zip(words, words[1:]))


class Templates:
    """Template bigrams by size."""

    def __init__(self, templates: dict[str, tuple[str, ...]], least: float):
        self.least = least
        self.sets = [(name, bigrams(t)) for name in sorted(templates) for t in templates[name]]
        self.every = set().union(*(s for _, s in self.sets)) if self.sets else set()
        ratio = least / (2 - least)
        self.share = ratio
        sizes = [len(s) for _, s in self.sets]
        self.smallest, self.largest = min(sizes, default=1) * ratio, max(sizes, default=0) / ratio
        self.by_size: dict[int, list] = {}
        self.holding: dict[tuple, list[int]] = {}
        for k, (_, grams) in enumerate(self.sets):
            for g in grams:
                self.holding.setdefault(g, []).append(k)
        # Templates held by a long one of another licence.
        self.parts = {(k, m) for k, (x, a) in enumerate(self.sets) for m, (y, b) in enumerate(self.sets)
                      if x != y and len(b) >= LONG and len(b) > len(a) and len(a & b) >= HOLDS * len(a)}

    def possible(self, text: str) -> list[int]:
        """Templates of whose bigrams the text holds the share that the least coefficient needs."""
        low = text.lower()
        words = _WORD.findall(low)
        grams = set(zip(words, words[1:]))
        if "copyright" in low or "©" in low or "(c)" in low:
            words = _WORD.findall(_OWNER.sub(" ", low))
            grams.update(zip(words, words[1:]))
        count: dict[int, int] = {}
        for g in grams & self.holding.keys():
            for k in self.holding[g]:
                count[k] = count.get(k, 0) + 1
        return sorted(k for k, c in count.items() if c + 1e-9 >= self.share * len(self.sets[k][1]))

    def candidates(self, n: int) -> list:
        """Templates whose size allows the least coefficient with a set of n bigrams."""
        got = self.by_size.get(n)
        if got is None:
            got = self.by_size[n] = [(k, s) for k, (_, s) in enumerate(self.sets)
                                     if self.share * n <= len(s) + 1e-9 and self.share * len(s) <= n + 1e-9]
        return got

    def best(self, grams: set) -> tuple[float, int] | None:
        """(coefficient, place) of the best template, or None below the least."""
        n = len(grams)
        if not self.smallest <= n <= self.largest or len(grams & self.every) + 1e-9 < self.share * n:
            return None
        best = None
        for k, s in self.candidates(n):
            dice = 2 * len(grams & s) / (n + len(s))
            if dice >= self.least and (best is None or dice > best[0]):
                best = dice, k
        return best


def passages(text: str):
    """(kind, first character, passage) for the whole text, paragraphs, lines and sentences."""
    yield "text", 0, text
    for kind, cut in (("paragraph", _PARAGRAPH), ("line", _LINE), ("sentence", _SENTENCE)):
        at = 0
        for m in cut.finditer(text):
            if m.start() > at:
                yield kind, at, text[at:m.start()]
            at = m.end()
        if 0 < at < len(text):
            yield kind, at, text[at:]


def _units(text: str, cut: re.Pattern) -> list[tuple[int, int, list[str]]]:
    """From, to and words of the paragraphs or lines that have words."""
    out, at = [], 0
    for lo, hi in [*(m.span() for m in cut.finditer(text)), (len(text), len(text))]:
        words = _words(text[at:lo])
        if words:
            out.append((at, lo, words))
        at = hi
    return out


def runs(text: str, templates: Templates, possible: list[int], found: dict[int, tuple]):
    """(template, dice, kind, from, to) of runs of two or more paragraphs or lines that better
    what is found."""
    sets = [(k, templates.sets[k][1]) for k in possible]
    most = max(len(s) for _, s in sets) / templates.share
    wanted = set().union(*(s for _, s in sets))
    for kind, cut in (("paragraphs", _PARAGRAPH), ("lines", _LINE)):
        units = _units(text, cut)
        n = len(units)
        if n < 2:
            continue
        # Bigrams of each unit, with the one that leads to it from the unit before.
        own = [list(zip(w, w[1:])) for _, _, w in units]
        lead = [None, *((a[2][-1], b[2][0]) for a, b in zip(units, units[1:]))]
        shares = [any(g in wanted for g in own[i]) for i in range(n)]
        # Distinct bigrams of each template from each unit on.
        left, seen = [None] * n, set()
        totals = [0] * len(sets)
        for i in range(n - 1, -1, -1):
            for g in (*own[i], lead[i + 1] if i + 1 < n else None):
                if g in wanted and g not in seen:
                    seen.add(g)
                    for t, (_, s) in enumerate(sets):
                        totals[t] += g in s
            left[i] = tuple(totals)
        for i in range(n - 1):
            if not shares[i] and lead[i + 1] not in wanted:
                continue
            grams: set = set()
            hits = [0] * len(sets)
            for j in range(i, n):
                touched = False
                for g in (lead[j], *own[j]) if j > i else own[j]:
                    if g in grams:
                        touched = touched or g in wanted
                        continue
                    grams.add(g)
                    if g in wanted:
                        touched = True
                        for t, (_, s) in enumerate(sets):
                            hits[t] += g in s
                # A longer run has at most the template's bigrams left from i on, and no fewer others.
                bounds = (2 * x / (x + len(grams) - h + len(s)) for x, h, (_, s) in zip(left[i], hits, sets))
                if len(grams) > most or not any(
                        top + 1e-9 >= templates.least and (k not in found or top > found[k][1])
                        for top, (k, _) in zip(bounds, sets)):
                    break
                if j == i or not touched:
                    continue
                best = None
                for (k, s), h in zip(sets, hits):
                    dice = 2 * h / (len(grams) + len(s))
                    if dice >= templates.least and (best is None or dice > best[0]):
                        best = dice, k
                if best and (best[1] not in found or best[0] > found[best[1]][1]):
                    yield best[1], best[0], kind, units[i][0], units[j][1]


def _found(text: str, templates: Templates) -> dict[int, tuple]:
    """By template, (template, dice, kind, from, to) of the best passage that it fits best."""
    found: dict[int, tuple] = {}
    possible = templates.possible(text)
    if not possible:
        return found
    for kind, at, passage in passages(text):
        hit = templates.best(bigrams(passage, templates.largest))
        if hit and (hit[1] not in found or hit[0] > found[hit[1]][1]):
            found[hit[1]] = (hit[1], hit[0], kind, at, at + len(passage))
    for hit in runs(text, templates, possible, found):
        found[hit[0]] = hit
    # Parts of another licence's text, from the longest on: a part can hold parts.
    for whole in sorted(found.values(), key=lambda x: x[3] - x[4]):
        inner = [x for x in found.values() if (x[0], whole[0]) in templates.parts and found.get(whole[0]) == whole
                 and whole[3] <= x[3] and x[4] <= whole[4] and x[3:] != whole[3:]]
        if not inner:
            continue
        outside = [(at, _found(part, templates)) for at, part in ((0, text[:whole[3]]), (whole[4], text[whole[4]:]))]
        for k, *_ in inner:
            found.pop(k)
            again = [(k, dice, kind, at + lo, at + hi) for at, got in outside if k in got
                     for _, dice, kind, lo, hi in (got[k],)]
            if again:
                found[k] = max(again, key=lambda x: x[1])
    return found


def scan(text: str, templates: Templates) -> list[tuple]:
    """(licence, dice, kind, from, to) of every licence found, each at its best passage."""
    best: dict[str, tuple] = {}
    for k, dice, *place in sorted(_found(text, templates).values()):
        name = templates.sets[k][0]
        if name not in best or dice > best[name][1]:
            best[name] = (name, dice, *place)
    return [best[k] for k in sorted(best)]


def license_scan(docs: DataFrame, templates=None, least: float = LEAST) -> DataFrame:
    """One row for each document and licence: doc_id, license, dice, passage, from_char, to_char."""
    sets = Templates(every_template() if templates is None else templates, least)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        import pyarrow as pa

        types = (pa.int64(), pa.string(), pa.float64(), pa.string(), pa.int64(), pa.int64())
        for batch in arrow_batches(batches, "text"):
            rows = [(i, *hit) for i, t in enumerate(batch.column("text").to_pylist()) for hit in scan(t or "", sets)]
            if rows:
                at, *cols = (pa.array(c, t) for c, t in zip(zip(*rows), types))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), *cols],
                    ["doc_id", "license", "dice", "passage", "from_char", "to_char"])

    return map_batches(docs.select("doc_id", "text"),
        run, f"doc_id {kind}, license string, dice double, passage string, from_char long, to_char long")


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
