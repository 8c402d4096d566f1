"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandlake.llm.chars import Words, blocks, mix

THRESHOLD = 0.8
SLOTS = 1 << 20
# Short notices by which texts and files declare a public licence; `known_templates` adds headers and whole texts.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-1.0": ["This work is licensed under the GNU General Public License, version 1."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-2.0": ["This work is licensed under the GNU Library General Public License, version 2."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD License."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

# Licences and versions of the GNU file headers.
GNU = {"GPL-1.0": ("General", "1"), "GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.0": ("Library General", "2"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3")}
GNU_HEADERS = [
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.",
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published by the Free Software Foundation; version {2} of the License.",
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} Public License version {2} as published by the Free Software Foundation.",
]
CREATIVE_COMMONS = {"CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-NC-4.0": "Attribution-NonCommercial", "CC-BY-ND-4.0": "Attribution-NoDerivatives", "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike", "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives"}
HEADERS = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
}
#: The terms of a licence without preamble, appendix or exhibits, which are often left out.
TERMS = re.compile(r"TERMS AND CONDITIONS.*(?=END OF TERMS AND CONDITIONS)|Creative Commons [\w-]+ 4\.0 International Public\s+License.*(?==========)|1\. Definitions.*(?=Exhibit A)", re.DOTALL)
TEXTS = Path(__file__).parent / "license_texts"


@lru_cache(maxsize=1)
def known_templates() -> dict[str, list[str]]:
    """TEMPLATES, file headers, and whole texts with and without what surrounds their terms. Read on the driver."""
    out = {name: list(texts) for name, texts in TEMPLATES.items()}
    for name, (family, version) in GNU.items():
        out[name] += [h.format(what, family, version) for h in GNU_HEADERS for what in ("program", "library")]
    for name, title in CREATIVE_COMMONS.items():
        out[name].append(f"This work is licensed under a Creative Commons {title} 4.0 International License.")
    for name, texts in HEADERS.items():
        out[name] += texts
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text("utf-8")
        terms = TERMS.search(text)
        out[path.stem.split("_")[0]] += [text, terms[0]] if terms else [text]
    return out


def bigrams(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) if len(words) > 1 else np.zeros(0, np.uint64)


class Scanner:
    def __init__(self, templates: dict[str, list[str]], threshold: float):
        self.threshold = threshold
        flat = sorted((name, text) for name, texts in templates.items() for text in texts)
        self.names = [n for n, _ in flat]
        words = Words([t for _, t in flat])
        hashes = [words.hashes[a:b] for a, b in zip(words.bounds, words.bounds[1:], strict=False)]
        self.lengths = [len(h) - 1 for h in hashes]
        sets = [np.unique(bigrams(h)) for h in hashes]
        self.sizes = np.array([len(s) for s in sets])
        self.known = np.unique(np.concatenate(sets))
        # Which templates hold each known bigram.
        self.held = np.zeros((len(self.known), len(sets)), bool)
        for t, mine in enumerate(sets):
            self.held[np.searchsorted(self.known, mine), t] = True
        self.slots = np.zeros(SLOTS, bool)
        self.slots[(self.known & np.uint64(SLOTS - 1)).astype(np.int64)] = True

    def compare(self, grams: np.ndarray, number: np.ndarray) -> dict[str, float]:
        """Best Dice of each licence over the windows of a text, if it reaches the threshold; number: of each bigram
        among the known ones, -1 for others. Of overlapping windows only the best counts, so that a notice is not taken
        for one of a similar licence too; a licence's header within its own text counts with the text.

        Sizes bound the coefficient: 2 min(a, b) / (a + b). A template is left out if the text has too few of its
        bigrams for any window to reach the threshold with it.
        """
        hit = np.flatnonzero(number >= 0)
        least = self.threshold / (2 - self.threshold) * self.sizes
        if len(hit) < least.min():
            return {}
        close = np.flatnonzero(self.held[np.unique(number[hit])].sum(0) >= least)
        if not len(close):
            return {}
        n = len(grams)
        order = np.argsort(grams, kind="stable")
        previous = np.full(n, -1)
        same = grams[order[1:]] == grams[order[:-1]]
        previous[order[1:][same]] = order[:-1][same]
        matches: list[tuple[float, str, int, int, int]] = []
        for t in close.tolist():
            name, length = self.names[t], self.lengths[t]
            inside = hit[self.held[number[hit], t]]
            # A window as long as the template, or as a text shorter than that, starts at each of its bigrams.
            some = np.searchsorted(inside, inside + length) - np.arange(len(inside))
            starts = inside[some >= least[t]]
            if not len(starts):
                continue
            shared, size = distinct(inside, previous, length, n)[starts], distinct(np.arange(n), previous, length, n)[starts]
            dice = 2 * shared / (size + self.sizes[t])
            good = np.flatnonzero(dice >= self.threshold)
            matches += [(d, name, a, min(a + length, n), t) for d, a in zip(dice[good].tolist(), starts[good].tolist(), strict=True)]
        out: dict[str, float] = {}
        # Template that took each place first, and places taken by each template.
        taken, own = np.full(n, -1), {t: np.zeros(n, bool) for t in {m[4] for m in matches}}
        alike = {t: np.array([self.names[t] == other for other in self.names] + [True]) for t in own}
        for dice, name, a, z, t in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if not own[t][a:z].any() and alike[t][taken[a:z]].all():
                own[t][a:z] = True
                taken[a:z] = np.where(taken[a:z] < 0, t, taken[a:z])
                out.setdefault(name, dice)
        return out

    def scan(self, texts: list[str]) -> list[dict[str, float]]:
        words = Words(texts)
        grams = bigrams(words.hashes)
        number = np.full(len(grams), -1, np.int64)
        maybe = np.flatnonzero(self.slots[(grams & np.uint64(SLOTS - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.known, grams[maybe]), len(self.known) - 1)
        good = self.known[place] == grams[maybe]
        number[maybe[good]] = place[good]
        out: list[dict[str, float]] = [{} for _ in texts]
        for i in np.unique(np.searchsorted(words.bounds, maybe[good], side="right") - 1).tolist():
            part = slice(words.bounds[i], max(words.bounds[i], words.bounds[i + 1] - 1))
            out[i] = self.compare(grams[part], number[part])
        return out


def distinct(at: np.ndarray, previous: np.ndarray, length: int, n: int) -> np.ndarray:
    """Distinct bigrams among those at the places `at`, for the window of `length` bigrams from each of n places."""
    # A bigram counts in the windows that hold it but not its last occurrence before.
    first = np.maximum(np.maximum(previous[at] + 1, at - length + 1), 0)
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(at + 1, minlength=n + 1))


def _scan(batches: Iterator[pa.RecordBatch], templates: dict, threshold: float) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(templates, threshold)
    for batch in batches:
        names, best, count = [], [], []
        for _, texts in blocks([t or "" for t in batch.column(1).to_pylist()]):
            for found in scanner.scan(texts):
                names.append(",".join(sorted(found)))
                best.append(round(max(found.values()), 6) if found else 0.0)
                count.append(len(found))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(names, pa.string()), pa.array(best, pa.float64())], ["id", "n_licenses", "licenses", "best_dice"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, n_licenses, licenses, best_dice) of each row: the licences some window of the text matches, in order, joined by commas.

    Text is normalised to lower-case words. Whole texts are scanned, in one pass without a shuffle. A null or empty
    text matches nothing; repeated rows and null ids stay; ties between templates of a licence do not matter; other columns are
    ignored; an empty table gives an empty table. The templates, `known_templates` if not given, are sent to every task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run = partial(_scan, templates=known_templates() if templates is None else templates, threshold=threshold)
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_licenses bigint, licenses string, best_dice double").withColumnRenamed("id", id_col)
