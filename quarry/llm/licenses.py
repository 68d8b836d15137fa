"""License scans by template-markup matching.

A template is license wording with markup: ``<<beginOptional>>`` ... ``<<endOptional>>`` may be left out, ``<<var;max=N>>`` stands for up
to N words of any kind, and ``<<oneOf;a|b c>>`` for one of the wordings. Each template is compiled into an automaton over
words; a text that has the mandatory wording exactly, with whatever stands in the other regions, is accepted. All templates share
one scan of the text: their first mandatory words say where an automaton begins.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import item_words, map_texts, table

# The base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Wording of licenses and notices, with markup.
TEMPLATES = {
    "mit": """
        <<beginOptional>>The MIT License (MIT)<<endOptional>> <<beginOptional>>Copyright <<var;max=40>><<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of <<oneOf;this software and associated documentation files|this software>>
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;max=20>> BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
        USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;max=20>> DISCLAIMS ALL WARRANTIES WITH
        REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;max=20>> BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        <<var;max=2>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<var;max=2>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.
        <<beginOptional>><<var;max=2>> Neither the name of <<var;max=20>> nor the names of its contributors may be used to endorse or promote products derived
        from this software without specific prior written permission.<<endOptional>>
        THIS SOFTWARE IS PROVIDED BY <<var;max=20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "apache-2": """
        Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not use <<oneOf;this file|these files|this work>> except in
        compliance with the License. You may obtain a copy of the License at <<var;max=12>>
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
        under the License.<<endOptional>>""",
    "gpl": """
        <<oneOf;licensed|released|distributed>> under the <<beginOptional>>terms of the<<endOptional>> GNU <<oneOf;General Public License|GPL>>
        <<beginOptional>><<oneOf;as published by the Free Software Foundation either|only>><<endOptional>> <<beginOptional>>version <<oneOf;2|3>> <<beginOptional>>0<<endOptional>><<endOptional>>""",
    "lgpl": """
        under the <<beginOptional>>terms of the<<endOptional>> GNU Lesser General Public License <<beginOptional>>version <<oneOf;2 1|3>><<endOptional>>""",
    "agpl": """
        under the <<beginOptional>>terms of the<<endOptional>> GNU Affero General Public License <<beginOptional>>version 3<<endOptional>>""",
    "mpl-2": """
        <<beginOptional>>This Source Code Form is<<endOptional>> subject to the terms of the Mozilla Public License, <<oneOf;v 2 0|v2 0|version 2 0>>""",
    "cc-by": """
        <<oneOf;licensed|released|available>> under <<oneOf;a|the|>> <<oneOf;CC BY|Creative Commons Attribution>> <<beginOptional>>International<<endOptional>> <<oneOf;1|2|3|4>> 0""",
    "cc-by-nc": """
        <<oneOf;licensed|released|available>> under <<oneOf;a|the|>> <<oneOf;CC BY NC|Creative Commons Attribution NonCommercial>> <<beginOptional>>International<<endOptional>> <<oneOf;1|2|3|4>> 0""",
    "cc0": """
        <<oneOf;dedicated to the public domain|released|available>> under <<oneOf;CC0|CC0 1 0|Creative Commons Zero>>""",
    "unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute
        this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "mit-notice": """
        <<oneOf;licensed|released|distributed|available>> under the <<beginOptional>>terms of the<<endOptional>> <<oneOf;MIT|Expat>> <<oneOf;license|licence>>""",
}

MARKUP = re.compile(r"<<(beginOptional|endOptional|var;max=\d+|oneOf;[^>]*)>>")


@dataclass
class Automaton:
    """States 0 .. n; in a state, a word or any word (None) leads on, and some lead on without a word."""

    moves: list[list[tuple[bytes | None, int]]]
    free: list[list[int]]
    accept: int

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return seen

    def firsts(self) -> set[bytes | None]:
        return {word for s in self.closure({0}) for word, _ in self.moves[s]}

    def match(self, words: list[bytes], start: int) -> int:
        """The end of the longest match that begins at ``start``; -1 if none does."""
        states, end, at = self.closure({0}), -1, start
        while states:
            if self.accept in states:
                end = at
            if at == len(words):
                break
            word = words[at]
            states = self.closure({to for s in states for wanted, to in self.moves[s] if wanted is None or wanted == word})
            at += 1
        return end


def compile_template(template: str) -> Automaton:
    """An automaton of the template without the optional wording at its front, which any text satisfies.

    ``Scanner`` asks that what is left begins with a mandatory word.
    """
    moves: list[list[tuple[bytes | None, int]]] = [[]]
    free: list[list[int]] = [[]]

    def new() -> int:
        moves.append([])
        free.append([])
        return len(moves) - 1

    def line(at: int, words: list[bytes | None]) -> int:
        for word in words:
            to = new()
            moves[at].append((word, to))
            at = to
        return at

    at, opened, mandatory = 0, [], False
    for i, part in enumerate(MARKUP.split(template)):
        if i % 2 == 0:
            words = item_words(part.encode())
            mandatory |= bool(words) and not opened
            at = line(at, words)
        elif part == "beginOptional":
            opened.append(at)
        elif part == "endOptional":
            to = new()
            free[at].append(to)
            if not opened[1:] and not mandatory:
                # Leading optional wording is looked at by no one: the match begins after it.
                moves, free, to = [[]], [[]], 0
            else:
                free[opened[-1]].append(to)
            opened.pop()
            at = to
        elif part.startswith("var;"):
            ends = [at]
            for _ in range(int(part.partition("=")[2])):
                ends.append(line(ends[-1], [None]))
            to = new()
            for end in ends:
                free[end].append(to)
            at = to
        else:
            to = new()
            for choice in part.partition(";")[2].split("|"):
                free[line(at, item_words(choice.encode()))].append(to)
            mandatory |= not opened
            at = to
    return Automaton(moves, free, at)


class Scanner:
    """Phrases and compiled templates over words."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        self.phrases = [(item_words(p.encode()), b" " + b" ".join(item_words(p.encode())) + b" ", label) for p, label in phrases.items()]
        self.starts: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, template in templates.items():
            automaton = compile_template(template)
            firsts = automaton.firsts()
            if None in firsts or automaton.accept in automaton.closure({0}):
                raise ValueError(f"the template {label} has no mandatory first word")
            for word in firsts:
                self.starts.setdefault(word, []).append((label, automaton))

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """The number of words; the places (start, end, label) of phrases, and those of templates."""
        words = item_words(text)
        if not words:
            return 0, [], []
        line = b" " + b" ".join(words) + b" "
        base = []
        for phrase, wanted, label in self.phrases:
            at, place, seen = line.find(wanted), 0, 0
            while at >= 0:
                place += line.count(b" ", seen, at)
                seen = at
                base.append((place, place + len(phrase), label))
                at = line.find(wanted, at + 1)
        found = []
        if not self.starts.keys().isdisjoint(words):
            for place, word in enumerate(words):
                for label, automaton in self.starts.get(word, ()):
                    if (end := automaton.match(words, place)) >= 0:
                        found.append((place, end, label.removesuffix("-notice")))
        return len(words), sorted(base), found


def _covered(spans: list[tuple[int, int, str]]) -> int:
    total = at = 0
    for start, end, _ in sorted(spans):
        total += max(0, end - max(start, at))
        at = max(at, end)
    return total


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, base (places of phrases: start, end, label), found (those of templates), score.

    Places count words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` from 0, ends exclusive. ``score`` is the share of the text's words that
    stand in a place. Null and empty texts have no words and score 0. One row for each row of ``docs``; no shuffle.
    """
    kept: list[Scanner] = []

    def run(_, texts):
        kept or kept.append(Scanner(phrases, templates))
        rows = [kept[0].scan(t) for t in texts]
        spans = lambda own: [{"start": a, "end": b, "label": label} for a, b, label in own]
        return {"n_words": [n for n, _, _ in rows], "base": [spans(b) for _, b, _ in rows], "found": [spans(f) for _, _, f in rows], "score": [_covered(b + f) / n if n else 0.0 for n, b, f in rows]}

    span = "array<struct<start:long,end:long,label:string>>"
    return map_texts(docs, run, f"n_words long, base {span}, found {span}, score double", id_col, text_col)


def op5_licenses(spark, sf_dir) -> DataFrame:
    """License places of all ``documents``."""
    found = find_licenses(table(spark, sf_dir, "documents"))
    labels = lambda *spans: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.col(f"{s}.label") for s in spans]))), ",")
    return found.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"), labels("base").alias("base_labels"), labels("base", "found").alias("labels"), "score")
