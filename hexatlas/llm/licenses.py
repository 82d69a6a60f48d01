"""License scans by conditional compression.

Candidate blocks are the words around any distinctive word of a template. Each block is compressed by zstandard alone and with every
template as a raw dictionary; templates are ranked by the bytes they save, and confirmed in that order by the exact differences in
wording: of the template's words at least COVERAGE must stand in the block in order, and no more others among them than may be missing.
The words that tell a license from its like (TELLING: names, clauses, versions) must all stand there, and no negation, version or
telling word of another license may stand among or before them: a license without a template is not named after a similar one.
A confirmed stretch is taken out and the rest is looked at again, so a block may hold several notices.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load

COVERAGE, LEVEL = 0.8, 3
#: Customary wordings of public notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                      "documentation files, to deal in the Software without restriction",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                      "following conditions are met",
}
TEMPLATES |= {
    "BSD": "Released under the BSD License.",
    "ISC": "Released under the ISC License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}
#: The words of a template without which it is another license or none.
TELLING = {
    "Apache-2.0": "apache 2.0", "MIT": "mit", "GPL-3.0": "gnu general public 3", "GPL-2.0": "gnu general public 2", "BSD": "bsd", "ISC": "isc",
    "LGPL-2.1": "lesser 2.1", "LGPL-3.0": "lesser 3", "AGPL-3.0": "affero 3", "MPL-2.0": "mozilla 2.0", "CC-BY-NC-4.0": "cc by-nc 4.0",
    "CC-BY-4.0": "creative attribution 4.0", "CC-BY-4.0-short": "cc by 4.0", "CC-BY-SA-4.0-short": "cc by-sa 4.0",
    "CC-BY-SA-4.0": "creative attribution-sharealike 4.0", "GPL-header": "gnu general public", "BSD-conditions": "redistribution source binary",
}
#: Words that turn a notice into another one.
TURNING = {"not", "never", "isn't", "without", "no", "library", "by-nd", "by-nc-sa", "by-nc-nd", "sharealike", "noncommercial", "noderivatives", "noderivs",
           "attribution-noncommercial", "attribution-noderivatives", "attribution-noncommercial-sharealike", "attribution-noncommercial-noderivatives"}
VERSION = re.compile(r"v?\d+(\.\d+)*")
EDGE = ".,;:!?()[]\"'`*<>"


def wording(text: str) -> list[str]:
    return [w for w in (x.strip(EDGE) for x in text.lower().split()) if w]


def distinctive(words: list[str]) -> set[str]:
    return {w for w in words if len(w) >= 6 or not w.isalpha()}


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE, level: int = LEVEL, telling: dict[str, str] | None = None):
        import ahocorasick
        import zstandard

        self.words = {name: wording(t) for name, t in templates.items()}
        self.coverage, self.reach = coverage, max(map(len, self.words.values()))
        self.telling = {name: set((TELLING if telling is None else telling).get(name, "").split()) for name in templates}
        common = {"public", "general", "source", "by"}  # telling beside others, but no license's own
        self.turning = TURNING | set().union(*self.telling.values()) - common
        self.cues, self.plain = ahocorasick.Automaton(), zstandard.ZstdCompressor(level=level)
        self.told: dict[str, object] = {}
        for name, words in self.words.items():
            cues = distinctive(words)
            if sum(w in cues for w in words) <= (1 - coverage) * len(words):
                raise ValueError(f"too few distinctive words in template {name}")
            for w in cues:
                self.cues.add_word(w, w)
            content = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.told[name] = zstandard.ZstdCompressor(level=level, dict_data=content)
        self.cues.make_automaton()
        self.cue_words = set().union(*map(distinctive, self.words.values()))

    def blocks(self, text: str | None) -> Iterator[tuple[int, list[str]]]:
        """(number of the first word, words): the words within reach of cues; long stretches in overlapping windows."""
        lower = (text or "").lower()
        if next(self.cues.iter(lower), None) is None:
            return
        words = wording(lower)
        hits = [i for i, w in enumerate(words) if w in self.cue_words]
        start = end = None
        spans = []
        for i in hits:
            if start is not None and i - self.reach <= end:
                end = i + self.reach
            else:
                if start is not None:
                    spans.append((start, end))
                start, end = max(0, i - self.reach), i + self.reach
        if start is not None:
            spans.append((start, end))
        size = 6 * self.reach
        for s, e in spans:
            e = min(e + 1, len(words))
            at = s
            while True:
                yield at, words[at:min(at + size, e)]
                if at + size >= e:
                    break
                at += size - 2 * self.reach

    def confirm(self, name: str, words: list) -> tuple[int, int, str] | None:
        """(first, last + 1, differences) of the template's wording in a block, or None; a similar license's wording is passed over."""
        left = list(words)
        while (got := self.best(name, left)) is not None:
            first, last, missing, extra = got
            near = [w for w in left[max(first - 1, 0):first] if w is not None and w in TURNING]
            turned = [w for w in extra if w in self.turning or VERSION.fullmatch(w)]
            if not self.telling[name] & set(missing) and not near and not turned:
                return first, last, " ".join([f"-{w}" for w in missing] + [f"+{w}" for w in extra])
            left[first:last] = [None] * (last - first)
        return None

    def best(self, name: str, words: list) -> tuple[int, int, list[str], list[str]] | None:
        """(first, last + 1, missing words, other words) of the stretch most like the template, or None."""
        want = self.words[name]
        pairs = [m for m in difflib.SequenceMatcher(None, want, words, autojunk=False).get_matching_blocks() if m.size]
        allowed = int((1 - self.coverage) * len(want))
        # the run of matches with most words whose gaps in the block are no longer than what may differ
        best: list = []
        for i in range(len(pairs)):
            run = [pairs[i]]
            for m in pairs[i + 1:]:
                if m.b - run[-1].b - run[-1].size > max(allowed, 1):
                    break
                run.append(m)
            if sum(m.size for m in run) > sum(m.size for m in best):
                best = run
        matched = sum(m.size for m in best)
        if not best or matched < self.coverage * len(want):
            return None
        first, last = best[0].b, best[-1].b + best[-1].size
        if last - first - matched > max(allowed, 1):
            return None
        # words that stand where the template's first or last words are missing count as their replacements
        for _ in range(best[0].a):
            first -= first > 0 and words[first - 1] is not None
        for _ in range(len(want) - best[-1].a - best[-1].size):
            last += last < len(words) and words[last] is not None
        here = set(range(len(want))) - {k for m in best for k in range(m.a, m.a + m.size)}
        extra = [str(words[k]) for k in range(first, last) if not any(m.b <= k < m.b + m.size for m in best)]
        return first, last, [want[k] for k in sorted(here)], extra

    def scan(self, text: str | None) -> list[tuple]:
        """(first word, license, bytes saved, share saved, differences) of each notice in a text, in order."""
        found: dict[tuple, tuple] = {}
        for at, words in self.blocks(text):
            left: list = list(words)
            while True:
                raw = " ".join(w for w in left if w is not None).encode()
                alone = len(self.plain.compress(raw))
                ranked = sorted(((alone - len(c.compress(raw)), name) for name, c in self.told.items()), key=lambda x: (-x[0], x[1]))
                hit = next(((saved, name, got) for saved, name in ranked if saved > 0 and (got := self.confirm(name, left))), None)
                if hit is None:
                    break
                saved, name, (first, last, differences) = hit
                found.setdefault((at + first, name), (at + first, name, saved, round(saved / alone, 4), differences))
                left[first:last] = [None] * (last - first)
        return [found[k] for k in sorted(found)]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per notice found: doc_id, notice (from 0), first_word, license, bytes_saved, share_saved, differences ("-" missing, "+" added).

    Null and empty texts hold none; repeated rows are reported as often as they stand; null doc_ids stay null. Whole texts are read,
    very long ones in overlapping windows of words.
    """
    chosen = dict(templates or TEMPLATES)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(chosen)
        for b in batches:
            rows = [(d, i, *hit) for d, t in zip(b["doc_id"], b["text"]) for i, hit in enumerate(scanner.scan(t))]
            yield pd.DataFrame(rows, columns=["doc_id", "notice", "first_word", "license", "bytes_saved", "share_saved", "differences"])

    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    shape = "doc_id string, notice int, first_word long, license string, bytes_saved long, share_saved double, differences string"
    return source.mapInPandas(each, shape).withColumn("doc_id", F.col("doc_id").cast("long"))


def op10_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(load(spark, sf_dir, "documents"))
