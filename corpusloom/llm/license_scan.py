"""Licence scan by a positional index of rare licence words.

Templates (grants, notices and short forms of well-known public licences) are indexed as word -> (template, position),
each by its rarest words alone: rarity is the inverse document frequency among *all* scanned documents, and function
words never count. Of a file's words those in the index are looked up, the rarest first; the postings of a template's
anchors are intersected by relative position, with some slack for words put in or left out; an alignment counts when
the template's mandatory key phrases stand in its window word for word and enough of the template's weight is found
there in order. Of alignments whose key phrase lies inside another's (cc by nc in cc by nc sa) the larger one stays.

Null and empty texts give zero words and no labels; repeated rows are scanned alike; a file of any length is scanned
whole; of equal scores any label's counts, as labels are a set; an empty table gives an empty result. Columns other
than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow import texts

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Phrases whose every place is reported.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Words that anchor nothing, however rare a corpus of other languages makes them.
FUNCTION_WORDS = frozenset(b"a an and any are as at be by for from in is it may not of on or that the this to under with you your without all its other such if no".split())


def _cc(code: str, name: str) -> list[tuple[str, str, list[str]]]:
    """Short and long form of a Creative Commons licence."""
    short, label = code.replace("-", " "), f"cc-{code}"
    return [(label, f"cc {short}", [f"cc {short}"]), (label, f"licensed under a creative commons {name} 4.0 international license", [f"creative commons {name.replace('-', ' ')}"])]


#: label, template, mandatory key phrases.
TEMPLATES = [
    *_cc("by", "attribution"),
    *_cc("by-sa", "attribution-sharealike"),
    *_cc("by-nc", "attribution-noncommercial"),
    *_cc("by-nd", "attribution-noderivatives"),
    *_cc("by-nc-sa", "attribution-noncommercial-sharealike"),
    *_cc("by-nc-nd", "attribution-noncommercial-noderivatives"),
    ("cc0", "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work", ["associated cc0 with"]),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to the public domain worldwide", ["to the public domain", "neighboring rights"]),
    ("cc0", "cc0 1.0", ["cc0 1 0"]),
    ("gpl", "gnu general public license", ["general public license"]),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ["general public license", "version 2"]),
    ("gpl-2.0", "gnu general public license version 2", ["general public license version 2"]),
    ("gpl-2.0", "gpl 2.0", ["gpl 2 0"]),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["general public license", "version 3"]),
    ("gpl-3.0", "gnu general public license version 3", ["general public license version 3"]),
    ("gpl-3.0", "gpl 3.0", ["gpl 3 0"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ["lesser general public license"]),
    ("lgpl", "gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "gnu affero general public license", ["affero general public license"]),
    ("mit", "mit license", ["mit license"]),
    ("mit", "licensed under mit", ["licensed under mit"]),
    ("mit", "spdx license identifier mit", ["license identifier mit"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ["granted free of charge"]),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", ["provided as is", "noninfringement"]),
    ("apache-2.0", "apache license version 2.0", ["apache license version 2 0"]),
    ("apache-2.0", "apache license 2.0", ["apache license 2 0"]),
    ("apache-2.0", "apache 2.0", ["apache 2 0"]),
    ("apache-2.0", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2.0", ["except in compliance with the license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ["must retain the above copyright notice"]),
    ("bsd", "bsd 3 clause", ["bsd 3 clause"]),
    ("bsd", "bsd 2 clause", ["bsd 2 clause"]),
    ("bsd", "bsd license", ["bsd license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not distributed with this file you can obtain one at", ["mozilla public license"]),
    ("mpl-2.0", "mozilla public license", ["mozilla public license"]),
    ("epl", "eclipse public license", ["eclipse public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["in no event will the authors be held liable"]),
    ("reserved", "all rights reserved", ["all rights reserved"]),
]


def _words(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def vocabulary(templates=TEMPLATES) -> frozenset[bytes]:
    return frozenset(w for _, t, _ in templates for w in _words(t))


class LicenceIndex:
    """word -> postings of the templates that it anchors; rarity is ``idf`` (word -> value, log of all documents over its own)."""

    def __init__(self, templates=TEMPLATES, idf: dict[bytes, float] | None = None, anchors: int = 4, coverage: float = 0.75):
        self.labels = [x[0] for x in templates]
        self.words = [_words(t) for _, t, _ in templates]
        self.phrases = [[_words(p) for p in x[2]] for x in templates]
        idf = idf or {}
        highest = max(idf.values(), default=1.0)
        self.idf = {w: max(idf.get(w, highest), 0.05) for t in self.words for w in t}
        self.coverage = coverage
        self.weight = [sum(self.idf[w] for w in t) for t in self.words]
        self.slack = [2 + len(t) // 5 for t in self.words]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.anchored: list[list[bytes]] = []
        for k, t in enumerate(self.words):
            rare = sorted(set(t) - FUNCTION_WORDS or set(t), key=lambda w: (-self.idf[w], w))[:anchors]
            self.anchored.append(rare)
            for q, w in enumerate(t):
                if w in rare:
                    self.postings[w].append((k, q))
        self.postings = dict(self.postings)
        # each base phrase is looked for around its rarest word
        self.pivots: dict[bytes, list[tuple[int, list[bytes], str]]] = defaultdict(list)
        for phrase, label in BASE.items():
            p = _words(phrase)
            at = max(range(len(p)), key=lambda i: (p[i] not in FUNCTION_WORDS, self.idf.get(p[i], highest), -i))
            self.pivots[p[at]].append((at, p, label))
        self.pivots = dict(self.pivots)
        self.anchors = set(self.postings) | set(self.pivots)

    def alignments(self, hits: dict[bytes, list[int]]) -> dict[int, list[int]]:
        """template -> shifts where all its anchors that must be there agree on the relative position."""
        shifts: dict[int, dict[bytes, list[int]]] = defaultdict(dict)
        for w in sorted(hits, key=lambda w: -self.idf.get(w, 0.0)):
            for k, q in self.postings.get(w, ()):
                shifts[k].setdefault(w, []).extend(i - q for i in hits[w])
        out = {}
        for k, by_word in shifts.items():
            anchors, slack = self.anchored[k], self.slack[k]
            need = len(anchors) if len(anchors) < 4 else len(anchors) - 1
            if len(by_word) < need:
                continue
            lists = sorted((sorted(s) for s in by_word.values()), key=len)
            # one anchor of long templates may be missing, so the two rarest may each open an alignment
            found = set()
            for first in lists[: 1 + len(anchors) - need]:
                for s in first:
                    if s not in found:
                        met = sum(1 for x in lists if (j := bisect_left(x, s - slack)) < len(x) and x[j] <= s + slack)
                        if met >= need:
                            found.add(s)
            if found:
                out[k] = sorted(found)
        return out

    def verified(self, k: int, shift: int, words: list[bytes]) -> tuple[float, int, int] | None:
        """Share of the template's weight found in order, and the span of its longest key phrase; None if a phrase is missing."""
        t, slack = self.words[k], self.slack[k]
        lo, hi = max(0, shift - slack), min(len(words), shift + len(t) + slack)
        window = words[lo:hi]
        span = (0, 0)
        for p in self.phrases[k]:
            at = [i for i in range(len(window) - len(p) + 1) if window[i : i + len(p)] == p]
            if not at:
                return None
            best = min(at, key=lambda i: abs(lo + i - shift))
            if len(p) > span[1] - span[0]:
                span = (lo + best, lo + best + len(p))
        places: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(window):
            places[w].append(i)
        # in order: each word at its next place, unless more than a few words stand between
        got, last = 0.0, -1
        for w in t:
            at = places.get(w)
            if at is None:
                continue
            j = bisect_left(at, last + 1)
            if j < len(at) and (last < 0 or at[j] - last <= 5):
                got, last = got + self.idf[w], at[j]
        share = got / self.weight[k]
        return (share, *span) if share >= self.coverage else None

    def scan(self, text: bytes) -> tuple[int, list[int], set[str], set[str], float, list[tuple[str, int, float]]]:
        """Words, starts of base phrases, base labels, all labels, score, verified places (label, start word, coverage)."""
        words = WORD.findall(text.lower())
        anchors = self.anchors
        hits: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in anchors:
                hits.setdefault(w, []).append(i)
        starts, base = [], set()
        if not hits:
            return len(words), starts, base, set(), 0.0, []
        for w, pivots in self.pivots.items():
            for i in hits.get(w, ()):
                for at, p, label in pivots:
                    if i >= at and words[i - at : i - at + len(p)] == p:
                        starts.append(i - at)
                        base.add(label)
        found = []
        for k, shifts in self.alignments(hits).items():
            for shift in shifts:
                got = self.verified(k, shift, words)
                if got is not None:
                    found.append((self.labels[k], *got))
        # a key phrase inside a larger one of another label says less than that one
        spans = sorted({(a, b) for _, _, a, b in found}, key=lambda s: (s[0], -s[1]))
        inside, reach = set(), (-1, -1)
        for a, b in spans:
            if b <= reach[1]:
                inside.add((a, b))
            else:
                reach = (a, b)
        best: dict[tuple[str, int], float] = {}
        for label, share, a, b in found:
            if (a, b) not in inside:
                best[label, a] = max(best.get((label, a), 0.0), share)
        labels = {label for label, _ in best} | base
        score = max([*best.values(), 1.0 if base else 0.0])
        return len(words), starts, base, labels, min(1.0, score), [(label, a, share) for (label, a), share in best.items()]


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<struct<label:string,word:long,coverage:double>>"
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("coverage", pa.float64())]))


def rarity(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, float]:
    """Inverse document frequency of the templates' words among all documents; a few hundred numbers, whatever the corpus."""
    known = vocabulary(templates)

    def run(batches):
        counts, n = Counter(), 0
        for batch in batches:
            for text in texts(batch.column(0)):
                n += 1
                counts.update(known.intersection(WORD.findall(text.lower())))
        rows = [(b"", n), *counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], type=pa.binary()), pa.array([k for _, k in rows], type=pa.int64())], names=["word", "n"])

    found = {bytes(r.word): r.n for r in docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    n = found.pop(b"", 0)
    return {w: math.log((n + 1) / (found.get(w, 0) + 0.5)) for w in known}


def scan_licences(docs: DataFrame, templates=None, idf: dict[bytes, float] | None = None) -> DataFrame:
    """doc_id and its licence findings, without a shuffle of texts; ``idf`` is taken from all of ``docs`` if not given."""
    templates = templates or TEMPLATES
    idf = rarity(docs, templates) if idf is None else idf

    def run(batches):
        index = LicenceIndex(templates, idf)
        for batch in batches:
            cols = [[] for _ in range(8)]
            for text in texts(batch.column(1)):
                n, starts, base, labels, score, places = index.scan(text)
                row = (n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, [{"label": a, "word": b, "coverage": c} for a, b, c in sorted(places, key=lambda x: (x[1], x[0]))])
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _PLACES]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
