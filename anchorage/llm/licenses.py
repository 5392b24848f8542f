"""License scans: phrases, and templates whose mandatory wording must match exactly.

A template is words with markup: ``[[ ... ]]`` is optional, ``{{a..b}}`` stands for a to b
words of any kind. It is compiled to an automaton over words, which is run from each
place of a text that has one of its first words.
"""

import re
from functools import cache

import pandas as pd
from pyspark.sql import functions as F

# fixed values: phrases and their labels
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# fixed values: wording of public licenses and of the notices that name them
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0 [[ the license ]]"),
    ("gpl-notice", "licensed under the [[ terms of the ]] gnu [[ lesser ]] general public license [[ as published by the free software foundation [[ either ]] ]] version {{1..1}}"),
    ("mit-notice", "[[ released ]] [[ licensed ]] under the [[ terms of the ]] mit license"),
    ("cc-by-notice", "licensed under [[ a ]] [[ the ]] [[ creative commons ]] cc by [[ nc ]] [[ sa ]] [[ nd ]] {{1..1}} 0"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [[ the software ]] to deal in the software without restriction"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("spdx-tag", "spdx license identifier {{1..4}}"),
    ("copyright-notice", "copyright [[ c ]] {{1..2}} [[ by ]] {{1..8}} all rights reserved"),
]

# fixed values: whole texts of public licenses and notices, in words; what holders fill in is replaceable
_MIT_LICENSE = """
permission is hereby granted free of charge to any person obtaining a copy of this software and
associated documentation files the software to deal in the software without restriction including
without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
of the software and to permit persons to whom the software is furnished to do so subject to the
following conditions the above copyright notice and this permission notice [[ including the next
paragraph ]] shall be included in all copies or substantial portions of the software the software is
provided as is without warranty of any kind express or implied including but not limited to the
warranties of merchantability fitness for a particular purpose and noninfringement in no event shall
{{1..8}} be liable for any claim damages or other liability whether in an action of contract tort or
otherwise arising from out of or in connection with the software or the use or other dealings in the
software
"""
_ISC_LICENSE = """
permission to use copy modify and [[ or ]] distribute this software for any purpose with or without fee
is hereby granted provided that the above copyright notice and this permission notice appear in all
copies the software is provided as is and {{1..6}} disclaims all warranties with regard to this software
including all implied warranties of merchantability and fitness in no event shall {{1..6}} be liable for
any special direct indirect or consequential damages or any damages whatsoever resulting from loss of
use data or profits whether in an action of contract negligence or other tortious action arising out of
or in connection with the use or performance of this software
"""
_APACHE_2_0_NOTICE = """
licensed under the apache license version 2 0 the license you may not use {{1..3}} except in compliance
with the license you may obtain a copy of the license at {{1..1}} www apache org licenses license 2 0
unless required by applicable law or agreed to in writing software distributed under the license is
distributed on an as is basis without warranties or conditions of any kind either express or implied see
the license for the specific language governing permissions and limitations under the license
"""
_GPL_FULL_NOTICE = """
free software you can redistribute it and or modify it under the terms of the gnu [[ lesser ]] [[ affero
]] general public license as published by the free software foundation [[ either ]] version {{1..1}} of
the license [[ or at your option any later version ]]
"""
_BSD_CONDITIONS = """
redistribution and use in source and binary forms with or without modification are permitted provided
that the following conditions are met [[ 1 ]] redistributions of source code must retain the above
copyright notice this list of conditions and the following disclaimer [[ 2 ]] redistributions in binary
form must reproduce the above copyright notice this list of conditions and the following disclaimer in
the documentation and or other materials provided with the distribution
"""
_BSD_NAMES = """
[[ 3 ]] neither the name of {{1..12}} nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission
"""
_BSD_DISCLAIMER = """
this software is provided by {{1..8}} as is and any express or implied warranties including but not
limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed
in no event shall {{1..8}} be liable for any direct indirect incidental special exemplary or
consequential damages including but not limited to procurement of substitute goods or services loss of
use data or profits or business interruption however caused and on any theory of liability whether in
contract strict liability or tort including negligence or otherwise arising in any way out of the use of
this software even if advised of the possibility of such damage
"""
WHOLE = [
    ("mit-license", _MIT_LICENSE),
    ("isc-license", _ISC_LICENSE),
    ("apache-2.0-notice", _APACHE_2_0_NOTICE),
    ("gpl-full-notice", _GPL_FULL_NOTICE),
    ("bsd-2-clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("bsd-3-clause", _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER),
]

# on bytes, A-Z are lower-cased alone, and every byte beyond ASCII is part of a word
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ANY = None


class Automaton:
    """States are numbers; ``steps``: state -> [(word or ANY, next)], ``free``: state -> [next]."""

    def __init__(self, template):
        self.steps, self.free, self.size = {}, {}, 1
        marks = re.findall(r"\[\[|\]\]|\{\{\d+\.\.\d+\}\}|[^\s\[\]{}]+", template.lower())
        self.end = self._sequence(marks, 0)
        if marks:
            raise ValueError(f"unbalanced markup in template: {template}")
        self.first = {w for s in self.closure({0}) for w, _ in self.steps.get(s, [])}
        if self.end in self.closure({0}) or ANY in self.first:
            raise ValueError(f"a template must begin with mandatory wording: {template}")

    def _new(self):
        self.size += 1
        return self.size - 1

    def _sequence(self, marks, at):
        while marks and marks[0] != "]]":
            mark = marks.pop(0)
            if mark == "[[":
                end = self._sequence(marks, at)
                if not marks:
                    raise ValueError("an optional part is not closed")
                marks.pop(0)
                self.free.setdefault(at, []).append(end)
                at = end
            elif mark.startswith("{{"):
                least, most = map(int, mark[2:-2].split(".."))
                ways = [at]
                for _ in range(most):
                    to = self._new()
                    self.steps.setdefault(ways[-1], []).append((ANY, to))
                    ways.append(to)
                end = self._new()
                for s in ways[least:]:
                    self.free.setdefault(s, []).append(end)
                at = end
            else:
                to = self._new()
                self.steps.setdefault(at, []).append((mark.encode(), to))
                at = to
        return at

    def closure(self, states):
        todo, out = list(states), set(states)
        while todo:
            for s in self.free.get(todo.pop(), []):
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def accepts(self, words, at):
        """The end of the longest match that begins at a word, or None."""
        states, found = self.closure({0}), None
        for k in range(at, len(words) + 1):
            if self.end in states:
                found = k
            if k == len(words):
                break
            word = words[k]
            states = self.closure({t for s in states for w, t in self.steps.get(s, []) if w is ANY or w == word})
            if not states:
                break
        return found


def words_of(text):
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def places(joined, phrase):
    """Starts, in words, of a phrase in words that spaces join (with one before and one after)."""
    found, at = [], joined.find(b" " + phrase + b" ")
    done = count = 0
    while at >= 0:
        count += joined.count(b" ", done, at)
        done = at
        found.append(count)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return found


@cache
def _automata(templates):
    return [(label, Automaton(t)) for label, t in templates]


def matches(words, templates):
    """(label, first word, end) of each template's matches."""
    have, found = set(words), []
    for label, automaton in _automata(templates):
        if have.isdisjoint(automaton.first):
            continue
        for k, w in enumerate(words):
            if w in automaton.first and (end := automaton.accepts(words, k)) is not None:
                found.append((label, k, end))
    return found


def scan(docs, id_col="doc_id", text_col="text", phrases=PHRASES, templates=(*TEMPLATES, *WHOLE)):
    """Phrases and template matches of every text.

    Columns: id, n_words, n_base (places of phrases), first_word, last_word (smallest and
    largest of them, else null), base_labels, labels (sorted, joined by commas), score (1 with
    a template, 0.5 with phrases alone, else 0) and ``spans``, the template matches as
    (label, from, to) in words. A null text counts as empty; repeated rows and null ids
    are kept.
    """
    phrases = [(p.encode(), label) for p, label in phrases]
    templates = tuple((label, t) for label, t in templates)

    def run(batches):
        for batch in batches:
            rows = []
            for i, text in zip(batch["_id"], batch["_text"]):
                words = words_of(text)
                joined = b" " + b" ".join(words) + b" "
                base = [(k, label) for p, label in phrases for k in places(joined, p)]
                spans = matches(words, templates)
                at = [k for k, _ in base]
                own = {label for _, label in base}
                rows.append(
                    (
                        i,
                        len(words),
                        len(base),
                        min(at, default=None),
                        max(at, default=None),
                        ",".join(sorted(own)),
                        ",".join(sorted(own | {s[0] for s in spans})),
                        1.0 if spans else 0.5 if base else 0.0,
                        [{"label": s[0], "from": s[1], "to": s[2]} for s in spans],
                    )
                )
            out = pd.DataFrame(rows, columns=NAMES)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.mapInPandas(run, f"_id {kind}, {FIELDS}").withColumnRenamed("_id", id_col)


NAMES = ["_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,from:long,to:long>>"
)
