"""License scans by template-markup matching.

A license text is a template with markup in the style of the public license-list templates:
``<<beginOptional>>`` ... ``<<endOptional>>`` encloses wording that may be left out, and
``<<var;name=...;match=A-B>>`` stands for any A to B words. Everything else is mandatory and must
be matched word for word. A template is compiled to a token automaton: states stand between words,
optional regions add empty moves around them, replaceable regions become chains of any-word
moves. An occurrence is accepted from any word of a text on.

Search. Every accepted text passes the template's mandatory words. The longest of them is the
template's anchor, with its least and greatest distance from the start of a match, so runs of the
automaton start only at such distances before an anchor; elsewhere nothing can match. Texts are
whole, blocks of documents stay in their partition, nothing is shuffled.

Overlaps: of matches at one start, of one or several templates, the longest counts (ties all do), so a notice that
goes on with the clause of another one has the label of the other; matches at other starts all give labels.

Defined results: a null or empty text has no words, no labels and score 0; equal rows get equal
results; input columns travel in one struct and cannot clash; an empty table gives an empty table.
The score is 0 without a label, else 0.5 for a bare phrase and up to 1 for templates, by the
largest share of a template's words (with its optional ones) that a match in the text has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from placewise.llm.blocks import WORDS_ONLY, as_bytes, over_blocks, whole_text

#: Phrases of the base search and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Wording that two of the notices share.
BSD_CLAUSES = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
               "the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must "
               "retain the above copyright notice, this list of conditions and the following disclaimer. "
               "<<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, "
               "this list of conditions and the following disclaimer in the documentation and/or other materials provided "
               "with the distribution.")

#: Wording of public license notices with optional and replaceable regions.
TEMPLATES = (
    ("mit-notice", "<<beginOptional>>released<<endOptional>><<beginOptional>>licensed<<endOptional>> under the "
                   "<<beginOptional>>terms of the<<endOptional>> mit license"),
    ("apache-2.0-notice", "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0"),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                          "compliance with the License. You may obtain a copy of the License at "
                          "<<beginOptional>>http www apache org licenses LICENSE-2.0<<endOptional>> "
                          "<<beginOptional>>Unless required by applicable law or agreed to in writing, software distributed under "
                          "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
                          "express or implied. See the License for the specific language governing permissions and limitations "
                          "under the License.<<endOptional>>"),
    ("gpl-3.0-notice", "<<beginOptional>>this <<var;name=work;match=1-3>> is<<endOptional>> licensed under the "
                       "<<beginOptional>>gnu<<endOptional>> general public license <<beginOptional>>version<<endOptional>> 3"),
    ("gpl-notice", "<<var;name=work;match=1-4>> is free software: you can redistribute it and/or modify it under the terms of the GNU "
                   "<<beginOptional>>lesser<<endOptional>> General Public License as published by the Free Software Foundation, "
                   "either version <<var;name=version;match=1-2>> of the License, or (at your option) any later version."),
    ("cc-by-nc-4.0-notice", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> "
                            "cc by nc 4.0"),
    ("cc-notice", "licensed under <<beginOptional>>a<<endOptional>> cc by <<beginOptional>><<var;name=terms;match=0-2>><<endOptional>> "
                  "<<beginOptional>>4.0<<endOptional>><<beginOptional>>3.0<<endOptional>>"),
    ("cc-notice", "licensed under a creative commons attribution <<var;name=terms;match=0-4>> <<beginOptional>>international"
                  "<<endOptional>> license"),
    ("mit", "<<beginOptional>>MIT License<<endOptional>> <<beginOptional>>Copyright (c) <<var;name=holder;match=1-12>><<endOptional>> "
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included "
            "in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
            "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
            "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE <<var;name=holders;match=1-8>> BE LIABLE FOR ANY CLAIM, DAMAGES "
            "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
            "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc", "Permission to use, copy, modify, and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("bsd-2-clause", BSD_CLAUSES),
    ("bsd-3-clause", BSD_CLAUSES + " <<beginOptional>>3.<<endOptional>> Neither the name of <<var;name=owner;match=1-12>> may be used to "
                     "endorse or promote products derived from this software without specific prior written permission."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
FIELDS = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
          "score double, matches array<struct<label:string,first:bigint,words:bigint>>")
MAX_PHRASE_SCORE = 0.5


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORDS_ONLY).split()


@dataclass
class Automaton:
    """States are numbers; ``words`` moves by a given word, ``any`` by any word, ``empty`` by none."""

    label: str
    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    any: list[int | None] = field(default_factory=lambda: [None])
    empty: list[list[int]] = field(default_factory=lambda: [[]])
    accept: int = 0
    n_words: int = 0

    def state(self) -> int:
        self.words.append({})
        self.any.append(None)
        self.empty.append([])
        return len(self.words) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def step(self, states: set[int], word: bytes) -> set[int]:
        after = {self.words[s][word] for s in states if word in self.words[s]}
        after |= {self.any[s] for s in states if self.any[s] is not None}
        return self.closure(after)


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of a template; regions may nest."""
    auto, at, opened = Automaton(label), 0, []
    pos = 0

    def literal(text: str, at: int) -> int:
        for word in words_of(text.encode()):
            after = auto.state()
            auto.words[at][word] = after
            auto.n_words += 1
            at = after
        return at

    for mark in MARKUP.finditer(template):
        at, pos = literal(template[pos:mark.start()], at), mark.end()
        kind = mark[1]
        if kind == "beginOptional":
            start = auto.state()
            auto.empty[at].append(start)
            opened.append(at)
            at = start
        elif kind == "endOptional":
            after = auto.state()
            auto.empty[at].append(after)
            auto.empty[opened.pop()].append(after)
            at = after
        else:
            least, most = map(int, re.search(r"match=(\d+)-(\d+)", kind).groups())
            end = auto.state()
            for count in range(most):
                if count >= least:
                    auto.empty[at].append(end)
                after = auto.state()
                auto.any[at] = after
                at = after
            auto.empty[at].append(end)
            at = end
    auto.accept = literal(template[pos:], at)
    if opened:
        raise ValueError(f"template {label}: region not closed")
    return auto


class Scanner:
    """All templates and phrases over word lists."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.phrases = [(tuple(p.encode().split()), label) for p, label in phrases]
        self.automata = [compile_template(label, text) for label, text in templates]
        self.starts = [a.closure({0}) for a in self.automata]
        #: Per automaton: the words of one mandatory place that every match has, and their least and
        #: greatest distance from the match's start.
        self.anchors = [self._anchor(a) for a in self.automata]
        cues = {w for words, *_ in self.anchors for w in words} | {p[-1] for p, _ in self.phrases}
        self.cues = re.compile(b"|".join(sorted(map(re.escape, cues), key=len, reverse=True)))

    @staticmethod
    def _anchor(auto: Automaton) -> tuple[frozenset[bytes], int, int]:
        """The rarest-looking (longest) mandatory word: a state cut that every accepting run passes."""
        least, most = {0: 0}, {0: 0}
        changed = True  # shortest and longest ways to each state, relaxed until settled
        while changed:
            changed = False
            for s in list(least):
                moves = [(t, 0) for t in auto.empty[s]] + [(t, 1) for t in auto.words[s].values()]
                moves += [(auto.any[s], 1)] if auto.any[s] is not None else []
                for t, cost in moves:
                    low, high = least[s] + cost, most[s] + cost
                    if low < least.get(t, 1 << 30) or high > most.get(t, -1):
                        least[t], most[t] = min(low, least.get(t, low)), max(high, most.get(t, high))
                        changed = True
        choices = []
        for s in range(len(auto.words)):
            for word in auto.words[s]:
                if not Scanner._reaches(auto, without=s):
                    choices.append((len(word), -least[s], word, least[s], most[s]))
        if not choices:
            raise ValueError(f"template {auto.label} has no mandatory word")
        _, _, word, low, high = max(choices)
        return frozenset([word]), low, high

    @staticmethod
    def _reaches(auto: Automaton, without: int) -> bool:
        """Whether the accepting state can be reached without the word moves of one state."""
        todo, seen = [0], {0}
        while todo:
            s = todo.pop()
            after = list(auto.empty[s]) + ([auto.any[s]] if auto.any[s] is not None else [])
            after += [] if s == without else list(auto.words[s].values())
            for t in after:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return auto.accept in seen

    def longest(self, k: int, words: list[bytes], start: int) -> int:
        """Words of the longest match of automaton k from ``start`` on; 0 if none."""
        auto, states, best = self.automata[k], self.starts[k], 0
        for n, word in enumerate(words[start:], 1):
            states = auto.step(states, word)
            if not states:
                break
            if auto.accept in states:
                best = n
        return best

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(automaton, first word, words) of each accepted occurrence, the longest from each start."""
        places: dict[bytes, list[int]] = {}
        wanted = {w for own, *_ in self.anchors for w in own}
        for i, word in enumerate(words):
            if word in wanted:
                places.setdefault(word, []).append(i)
        for k, (own, low, high) in enumerate(self.anchors):
            starts = {at - d for w in own for at in places.get(w, ()) for d in range(low, high + 1) if at >= d}
            for start in sorted(starts):
                if n := self.longest(k, words, start):
                    yield k, start, n

    def base(self, words: list[bytes]) -> Iterator[tuple[int, str]]:
        """(start, label) of each place of a phrase."""
        firsts: dict[bytes, list[tuple[tuple[bytes, ...], str]]] = {}
        for phrase, label in self.phrases:
            firsts.setdefault(phrase[0], []).append((phrase, label))
        for i, word in enumerate(words):
            for phrase, label in firsts.get(word, ()):
                if tuple(words[i:i + len(phrase)]) == phrase:
                    yield i, label

    def scan(self, data: bytes) -> tuple:
        """The values of ``FIELDS`` for one text."""
        clean = data.translate(WORDS_ONLY)
        words = clean.split()
        if not self.cues.search(clean):
            return len(words), 0, None, None, "", "", 0.0, []
        places = list(self.base(words))
        found = list(self.matches(words))
        most: dict[int, int] = {}
        for _, start, n in found:
            most[start] = max(n, most.get(start, 0))
        found = [f for f in found if f[2] == most[f[1]]]
        base_labels = {label for _, label in places}
        score = MAX_PHRASE_SCORE if places else 0.0
        for k, _, n in found:
            score = max(score, MAX_PHRASE_SCORE + (1 - MAX_PHRASE_SCORE) * min(1.0, n / self.automata[k].n_words))
        labels = base_labels | {self.automata[k].label for k, *_ in found}
        starts = [i for i, _ in places]
        return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
                ",".join(sorted(labels)), score,
                [{"label": self.automata[k].label, "first": i, "words": n} for k, i, n in found])


_SCANNERS: dict[tuple, Scanner] = {}


def scanner(templates: tuple, phrases: tuple) -> Scanner:
    """Compiled once for each Python worker."""
    if (templates, phrases) not in _SCANNERS:
        _SCANNERS[templates, phrases] = Scanner(templates, phrases)
    return _SCANNERS[templates, phrases]


def scan_licenses(docs: DataFrame, text: str | Column = "text", templates: tuple = TEMPLATES, phrases: tuple = PHRASES,
                  row: list[str] | None = None) -> DataFrame:
    """Column ``row`` (the document) and the columns of ``FIELDS``. No shuffle."""

    def step(block: dict[str, pa.Array]) -> list:
        scan = scanner(templates, phrases).scan
        columns = list(zip(*[scan(x) for x in as_bytes(block["text"])]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
            [("label", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))]
        return [pa.array(c, kind) for c, kind in zip(columns, kinds)]

    return over_blocks(docs, {"text": whole_text(text)}, step, FIELDS, row)
