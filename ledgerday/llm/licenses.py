"""License scans by template markup.

A template is license wording with ``<<optional>> ... <<end>>`` regions (they
may nest) and replaceable regions ``<<var words="0-8" match="[0-9]+">>`` (so
many words, each matching the pattern in full); it starts with given words.  It is compiled into an
automaton over words; a place in a text is accepted if all mandatory wording
stands there exactly, in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import words

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license notices and texts as templates, by label.
TEMPLATES = {
    "apache-2.0-notice": """
        <<optional>>this work is<<end>> licensed under the apache license <<optional>>version 2.0
        <<optional>>the license you may not use this file except in compliance with the license<<end>><<end>>""",
    "cc-notice": """
        <<optional>>this work is<<end>> licensed under <<optional>>a<<end>> <<optional>>the<<end>>
        <<optional>>creative commons<<end>> <<optional>>cc<<end>> <<var words="1-3" match="by|nc|sa|nd|by-nc|by-sa|attribution|noncommercial|sharealike|noderivatives">>
        <<var words="2-2" match="[0-9]">> <<optional>>international license<<end>>""",
    "gpl-notice": """
        <<optional>>this work is<<end>> licensed under the gnu general public license
        <<optional>>version <<var words="1-2" match="[0-9]">> <<optional>>or any later version<<end>><<end>>""",
    "gpl-header": """
        this program is free software you can redistribute it and or modify it under the terms of the gnu
        general public license as published by the free software foundation either version
        <<var words="1-2" match="[0-9]">> of the license or <<optional>>at your option<<end>> any later version""",
    "isc-text": """
        permission to use copy modify and or distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies""",
    "mit-notice": """
        <<optional>>this work is<<end>> <<var words="1-1" match="released|licensed|distributed">> under the
        <<optional>>terms of the<<end>> mit license""",
    "mit-text": """
        permission is hereby granted free of charge to any person obtaining a copy of this software
        <<optional>>and associated documentation files the software<<end>> to deal in the software without
        restriction including without limitation the rights to use copy modify merge publish distribute
        sublicense and or sell copies of the software""",
}

# Wording that several whole license texts share.
_COPYRIGHT = """<<optional>>copyright <<optional>>c<<end>> <<var words="0-16" match="[0-9]{4}|[^0-9].*">>
    <<optional>>all rights reserved<<end>><<end>>"""
_AS_IS = """this software is provided by <<var words="1-8">> as is and any express or implied warranties including but not
    limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event
    shall <<var words="1-8">> be liable for any direct indirect incidental special exemplary or consequential damages
    including but not limited to procurement of substitute goods or services loss of use data or profits or business
    interruption however caused and on any theory of liability whether in contract strict liability or tort including
    negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""
_REDISTRIBUTION = """redistribution and use in source and binary forms with or without modification are permitted provided that
    the following conditions are met <<optional>><<var words="1-1" match="[1a]">><<end>> redistributions of source code must
    retain the above copyright notice this list of conditions and the following disclaimer <<optional>><<var words="1-1" match="[2b]">><<end>>
    redistributions in binary form must reproduce the above copyright notice this list of conditions and the following
    disclaimer in the documentation and or other materials provided with the distribution"""
_ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_WARRANTY = """the software is provided as is and <<var words="1-8">> disclaims all warranties with regard to this software including
    all implied warranties of merchantability and fitness in no event shall <<var words="1-8">> be liable for any special direct
    indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action
    of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"""

# Whole license texts as templates, by label.
TEMPLATES |= {
    "0bsd-whole": f"{_ISC} {_ISC_WARRANTY}",
    "bsd-2-clause-whole": f"{_REDISTRIBUTION} {_AS_IS}",
    "bsd-3-clause-whole": f"""{_REDISTRIBUTION} <<optional>><<var words="1-1" match="[3c]">><<end>> neither the name of
        <<var words="1-12">> nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission {_AS_IS}""",
    "bsl-1.0-whole": """
        permission is hereby granted free of charge to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license the software to use reproduce display distribute execute and
        transmit the software and to prepare derivative works of the software and to permit third parties to whom the
        software is furnished to do so all subject to the following""",
    "isc-whole": f"""{_ISC} provided that the above copyright notice and this permission notice appear in all copies {_ISC_WARRANTY}""",
    "mit-whole": f"""
        <<optional>><<optional>>the<<end>> mit license <<optional>>mit<<end>><<end>> {_COPYRIGHT}
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions the above copyright notice
        and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or
        substantial portions of the software the software is provided as is without warranty of any kind express or implied
        including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
        in no event shall <<var words="1-8">> be liable for any claim damages or other liability whether in an
        action of contract tort or otherwise arising from out of or in connection with the software or the use or other
        dealings in the software""",
    "unlicense-whole": """
        this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
        compile sell or distribute this software either in source code form or as a compiled binary for any purpose
        commercial or non commercial and by any means""",
    "zlib-whole": """
        this software is provided as is without any express or implied warranty in no event will the <<var words="1-4">> be
        held liable for any damages arising from the use of this software permission is granted to anyone to use this
        software for any purpose including commercial applications and to alter it and redistribute it freely subject to the
        following restrictions <<optional>>1<<end>> the origin of this software must not be misrepresented you must not claim
        that you wrote the original software if you use this software in a product an acknowledgment in the product
        documentation would be appreciated but is not required <<optional>>2<<end>> altered source versions must be plainly
        marked as such and must not be misrepresented as being the original software <<optional>>3<<end>> this notice may not
        be removed or altered from any source distribution""",
}

_MARKUP = re.compile(r"<<(.*?)>>|([^<]+)", re.DOTALL)
_ATTRIBUTE = re.compile(r'(\w+)="([^"]*)"')


class TemplateError(ValueError):
    """Markup that doesn't parse, or a template without mandatory wording."""


@dataclass(frozen=True)
class _Edge:
    """Takes one word: the given one, or one that the pattern matches."""

    to: int
    word: bytes | None = None
    pattern: re.Pattern | None = None
    mandatory: bool = False

    def takes(self, word: bytes) -> bool:
        return word == self.word if self.word is not None else bool(self.pattern.fullmatch(word))


class TemplateAutomaton:
    """A template's word automaton, run on sets of states that are worked out once."""

    def __init__(self, label: str, template: str):
        self.label = label
        self.edges: list[list[_Edge]] = [[]]
        self.free: list[list[int]] = [[]]  # moves that take no word
        at, opened = 0, []
        for markup, text in _MARKUP.findall(template):
            kind = markup.split()[0] if markup.split() else ""
            if text:
                for word in words(text):
                    at = self._after(at, word=word, mandatory=not opened)
            elif kind == "optional":
                opened.append(at)
            elif kind == "end" and opened:
                self.free[opened.pop()].append(at := self._join(at))
            elif kind == "var":
                given = dict(_ATTRIBUTE.findall(markup))
                low, _, high = given.get("words", "0-8").partition("-")
                pattern, skips = re.compile(given.get("match", ".*").encode()), []
                for i in range(int(high or low)):
                    if i >= int(low):
                        skips.append(at)
                    at = self._after(at, pattern=pattern, mandatory=not opened and i < int(low))
                at = self._join(at)
                for state in skips:
                    self.free[state].append(at)
            else:
                raise TemplateError(f"{label}: <<{markup}>>")
        self.n_mandatory = sum(e.mandatory for edges in self.edges for e in edges)
        if opened or not self.n_mandatory:
            raise TemplateError(f"{label}: {'an open region' if opened else 'no mandatory wording'}")
        self.last = at
        self.start = self._closed({0})
        self.start_words = {w for s in self.start for e in self.edges[s] for w in ([e.word] if e.word else e.pattern.pattern.split(b"|"))}
        if any(words(w.decode()) != [w] for w in self.start_words):
            raise TemplateError(f"{label}: any word at the start")
        self._next: dict[tuple[frozenset, bytes], frozenset] = {}
        self._before = self._mandatory_before()
        #: Wording that every accepted place has.
        self.needed = {e.word for edges in self.edges for e in edges if e.mandatory and e.word}
        self._wording = [(self._before[s], e.word) for s, edges in enumerate(self.edges) for e in edges if e.mandatory and e.word]

    def most(self, seen: set[bytes]) -> float:
        """The largest share of the mandatory wording that a text of these words can meet: that before the first word it lacks."""
        return next((before for before, word in self._wording if word not in seen), self.n_mandatory) / self.n_mandatory

    def _after(self, at: int, **taken) -> int:
        to = self._join(None)
        self.edges[at].append(_Edge(to, **taken))
        return to

    def _join(self, at: int | None) -> int:
        self.edges.append([])
        self.free.append([])
        if at is not None:
            self.free[at].append(len(self.edges) - 1)
        return len(self.edges) - 1

    def _closed(self, states: set[int]) -> frozenset:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return frozenset(states)

    def _mandatory_before(self) -> list[int]:
        # States are numbered in the template's order, so one pass in that order will do.
        before = [0] * len(self.edges)
        for s in range(len(self.edges)):
            for e in self.edges[s]:
                before[e.to] = max(before[e.to], before[s] + e.mandatory)
            for to in self.free[s]:
                before[to] = max(before[to], before[s])
        return before

    def at(self, text: list[bytes], start: int) -> tuple[int, float]:
        """The end of the longest accepted place at word ``start`` (-1: none), and the
        share of the mandatory wording that was met."""
        states, i, end, met = self.start, start, -1, 0
        while states:
            met = max(met, max(self._before[s] for s in states))
            if self.last in states:
                end = i
            if i == len(text):
                break
            key = (states, text[i])
            if key not in self._next:
                to = self._closed({e.to for s in states for e in self.edges[s] if e.takes(text[i])})
                if len(self._next) > 50_000:
                    self._next.clear()
                self._next[key] = to
            states, i = self._next[key], i + 1
        return end, met / self.n_mandatory


class LicenseScanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        self.given = (phrases, templates)
        self.phrases = [(tuple(words(p)), label) for p, label in phrases.items()]
        self.automata = [TemplateAutomaton(label, t) for label, t in templates.items()]
        #: Words that a template may start with.
        self.starters = frozenset(w for a in self.automata for w in a.start_words)

    def scan(self, text: str | None) -> dict:
        """Base places, accepted template places ``(label, first word, end word)`` and the score."""
        ws = words(text)
        seen = set(ws)
        base: list[tuple[int, str]] = []
        for phrase, label in self.phrases:
            if seen.issuperset(phrase):
                n = len(phrase)
                base += [(i, label) for i, w in enumerate(ws) if w == phrase[0] and tuple(ws[i : i + n]) == phrase]
        places, score = [], 0.5 if base else 0.0
        # The few places of words that templates start with serve all of them.
        starts_at = [(i, w) for i, w in enumerate(ws) if w in self.starters] if not seen.isdisjoint(self.starters) else []
        for a in self.automata if starts_at else ():
            # Without all the needed wording nothing is accepted, but part of it may be met.
            whole, most = a.needed <= seen, a.most(seen)
            if not whole and most <= score:
                continue
            i = 0
            for at, word in starts_at:
                if at < i or word not in a.start_words:
                    continue
                end, met = a.at(ws, at)
                score = max(score, met)
                if end > at:
                    places.append((a.label, at, end))
                    i = end
                if not whole and score >= most:
                    break
        return {"n_words": len(ws), "base": base, "places": places, "score": score}


def license_scan(
    docs: DataFrame, scanner: LicenseScanner | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score, places`` of every row.

    ``places`` lists the accepted template places (label, first word, word
    after the last).  ``score`` is the largest share of a template's mandatory
    wording met in order at one place, at least 0.5 where a base phrase stands;
    1 means that a template is accepted.  Places of one template don't overlap; of
    several ends at one start the longest counts.

    Null or empty text: no words, score 0, empty labels.  Null or repeated ids:
    a row for each.  Empty table: no rows.  Other columns are ignored.  No
    shuffle; the templates (fixed) are broadcast.
    """
    scanner = scanner or LicenseScanner()
    fields = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, places array<struct<label:string,first_word:long,end_word:long>>"
    )
    given = scanner.given

    @F.pandas_udf(fields)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = LicenseScanner(*given)
        for texts in batches:
            rows = []
            for text in texts:
                found = own.scan(text)
                starts = [i for i, _ in found["base"]]
                base = {label for _, label in found["base"]}
                rows.append((
                    found["n_words"], len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | {p[0] for p in found["places"]})),
                    found["score"], [dict(zip(("label", "first_word", "end_word"), p)) for p in found["places"]],
                ))
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(F.col(id_col), scan(F.col(text_col)).alias("found")).select(id_col, "found.*")
