"""License scans by template-markup matching.

A template is a license notice in the markup of public license lists: plain wording is
mandatory, ``<<beginOptional>> ... <<endOptional>>`` may be absent, and ``<<var;min=a;max=b>>``
stands for ``a`` to ``b`` words of any wording (1 to 3 where not given).  Each template
compiles to a token automaton: states between words, an edge per mandatory word, a skip edge
over an optional region and wildcard edges for a replaceable one.  A text is accepted at
a place when the automaton reaches its end from there, so every mandatory word matched
exactly, in order, without gaps.  ``TEMPLATES`` are short notices, ``license_texts.LICENSES`` whole
licenses; a text that continues a shorter license (X11 after MIT) is accepted as both.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import as_bytes, map_rows
from lineark.llm.license_texts import LICENSES

# Phrases whose places are counted, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License notices and their labels, as public license lists give them.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0"),
    ("mit", "released under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction"),
    ("gpl-notice", "<<beginOptional>>this<<endOptional>> <<var;min=0;max=3>> is licensed under the gnu general public license"
                   " <<beginOptional>>version<<endOptional>> <<var;min=0;max=1>>"),
    ("gpl-notice", "under the terms of the gnu general public license as published by the free software foundation"),
    ("cc-by-notice", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by"
                     " <<beginOptional>>nc<<endOptional>> <<beginOptional>>sa<<endOptional>> <<beginOptional>>nd<<endOptional>> <<var;min=0;max=2>>"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("reserved-notice", "copyright <<var;min=1;max=8>> all rights reserved"),
)

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARKUP = re.compile(r"<<beginOptional>>|<<endOptional>>|<<var[^>]*>>|[^<]+")


class Automaton:
    """Token automaton of one template: ``edges[state]`` lists (word or None for any, next state)."""

    def __init__(self, template: str):
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.mandatory = 0
        opened: list[int] = []
        at = 0
        for part in _MARKUP.findall(template):
            if part == "<<beginOptional>>":
                opened.append(at)
            elif part == "<<endOptional>>":
                self.skips[opened.pop()].append(at)
            elif part.startswith("<<var"):
                bounds = dict(x.split("=") for x in part[2:-2].split(";")[1:])
                low, high = int(bounds.get("min", 1)), int(bounds.get("max", 3))
                steps = [at := self._add(at, None) for _ in range(high)]
                first = self._start_of(steps, at)
                for k, s in enumerate([first, *steps][:-1]):
                    if k >= low:
                        self.skips[s].append(at)
            else:
                for word in _WORD.findall(part.encode("utf-8").lower()):
                    at = self._add(at, word)
                    self.mandatory += not opened
        self.end = at

    def _add(self, at: int, word: bytes | None) -> int:
        self.edges.append([])
        self.skips.append([])
        self.edges[at].append((word, len(self.edges) - 1))
        return len(self.edges) - 1

    @staticmethod
    def _start_of(steps: list[int], at: int) -> int:
        return steps[0] - 1 if steps else at

    def closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def first_words(self) -> set[bytes | None]:
        return {w for s in self.closed({0}) for w, _ in self.edges[s]}

    def anchor(self) -> bytes:
        """The longest mandatory word: a text without it is never accepted."""
        plain, deep = [], 0
        words, inside = set(), {x for s, to in enumerate(self.skips) for t in to for x in range(s, t)}
        for s, out in enumerate(self.edges):
            for w, _ in out:
                if w is not None and s not in inside:
                    words.add(w)
        return max(words, key=lambda w: (len(w), w))

    def match(self, words: list[bytes], at: int) -> int | None:
        """Where the longest accepted run that starts at ``at`` ends, or None."""
        states, best = self.closed({0}), None
        while True:
            if self.end in states:
                best = at
            if at >= len(words):
                return best
            states = self.closed({t for s in states for w, t in self.edges[s] if w is None or w == words[at]})
            if not states:
                return best
            at += 1


def license_scan(docs: DataFrame, templates=TEMPLATES + LICENSES, phrases=PHRASES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """License notices in every whole text.

    Words are runs outside ASCII non-alphanumerics, A-Z lower-cased, counted from 0.
    Returns one row per input row: the id column; ``n_words`` LONG; ``n_base`` LONG, all
    places where a phrase stands; ``first_word`` and ``last_word`` LONG, the smallest and
    largest start of those (null without any); ``base_labels`` and ``labels`` STRING,
    distinct, sorted and comma-joined (``labels`` also has those of accepted templates;
    empty without any); ``score`` DOUBLE: 1 where a template is accepted, else 0.5 where
    only a phrase stands, else 0; ``spans`` ARRAY<STRUCT<label, start, end>>, the accepted
    runs in words, ends exclusive.  A null or empty text has no words.  Repeated rows are
    scanned each; other columns are ignored.  No shuffle.
    """
    kind = dict(docs.dtypes)[id_col]

    def make():
        automata = [(label, a := Automaton(t), a.anchor(), a.first_words()) for label, t in templates]
        bases = [(p.encode("utf-8").split(), label) for p, label in phrases]

        def one(data: bytes):
            words = _WORD.findall(data.lower())
            base, labels, spans = [], set(), []
            joined = b" " + b" ".join(words) + b" "
            places: dict[bytes, list[int]] = {}

            def where(word: bytes) -> list[int]:
                if word not in places:
                    places[word] = [i for i, w in enumerate(words) if w == word]
                return places[word]

            for phrase, label in bases:
                if b" " + b" ".join(phrase) + b" " in joined:
                    n = len(phrase)
                    found = [i for i in where(phrase[0]) if words[i:i + n] == phrase]
                    base += found
                    labels.add(label)
            named = set(labels)
            for label, a, anchor, first in automata:
                if b" " + anchor + b" " not in joined:
                    continue
                starts = range(len(words)) if None in first else sorted({i for w in first for i in where(w)})
                done = -1
                for i in starts:
                    if i >= done and (end := a.match(words, i)) is not None and end > i:
                        spans.append({"label": label, "start": i, "end": end})
                        named.add(label)
                        done = end
            score = 1.0 if spans else 0.5 if base else 0.0
            return len(words), base, ",".join(sorted(labels)), ",".join(sorted(named)), score, spans

        def step(cols: dict) -> dict:
            out = [one(t) for t in cols["t"]]
            return {"k": cols["k"], "n_words": [x[0] for x in out], "n_base": [len(x[1]) for x in out],
                    "first_word": [min(x[1], default=None) for x in out], "last_word": [max(x[1], default=None) for x in out],
                    "base_labels": [x[2] for x in out], "labels": [x[3] for x in out], "score": [x[4] for x in out],
                    "spans": [x[5] for x in out]}
        return step

    df = docs.select(F.col(id_col).alias("k"), as_bytes(F.col(text_col)).alias("t"))
    return map_rows(df, make, f"k {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                    "labels string, score double, spans array<struct<label:string,start:long,end:long>>").withColumnRenamed("k", id_col)
