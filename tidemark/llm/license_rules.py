"""License detection by ordered signature rules.

Texts are normalised to their words (lower-cased, joined by one space). Every rule is a regular expression
over that form with a priority, a label, a confidence and keywords; an Aho-Corasick pass over the text
finds the keywords, and only rules whose keywords all occur are tried. Detections are taken in order of
priority, then start, then length: one whose words lie inside an interval already taken is suppressed, so
"gnu lesser general public license" is never also "general public license".

Two sorts of rules: signatures written by hand on a license's own wording (``license_signatures``), and license
names times the ways a text refers to a name. One pass per partition, one
row out per row in. Null and word-less texts have no detections, empty labels and score 0; repeated rows
come out repeatedly; an empty table gives an empty result; very long texts take time in proportion to their length,
however often a phrase is repeated in them. Only the key and the text are read, so no other column can clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.llm.common import item_words, map_columns, worker_cache
from tidemark.llm.license_signatures import SIGNATURES

# The base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Label -> names as normalised words; longer, more specific names come first.
NAMES = {
    "agpl-3": ["gnu affero general public license version 3", "agpl v3", "agpl 3 0", "agplv3"],
    "agpl": ["gnu affero general public license", "affero general public license", "gnu agpl"],
    "lgpl-3": ["gnu lesser general public license version 3", "lgpl v3", "lgpl 3 0", "lgplv3"],
    "lgpl-2.1": ["gnu lesser general public license version 2 1", "lgpl v2 1", "lgpl 2 1", "lgplv2 1"],
    "lgpl": ["gnu lesser general public license", "gnu library general public license", "gnu lgpl"],
    "gpl-3": ["gnu general public license version 3", "gpl v3", "gpl 3 0", "gplv3"],
    "gpl-2": ["gnu general public license version 2", "gpl v2", "gpl 2 0", "gplv2"],
    "gpl": ["gnu general public license", "general public license", "gnu gpl"],
    "gfdl": ["gnu free documentation license", "gfdl 1 3"],
    "apache-2": ["apache license version 2", "apache license 2", "apache 2 0", "apache 2"],
    "apache-1.1": ["apache software license version 1 1", "apache 1 1"],
    "mit": ["mit", "expat"],
    "mit-0": ["mit 0", "mit no attribution"],
    "bsd-2-clause": ["bsd 2 clause", "simplified bsd", "freebsd"],
    "bsd-3-clause": ["bsd 3 clause", "new bsd", "modified bsd", "revised bsd"],
    "bsd-4-clause": ["bsd 4 clause", "original bsd"],
    "0bsd": ["0bsd", "bsd zero clause"],
    "isc": ["isc", "internet systems consortium"],
    "mpl-2": ["mozilla public license version 2", "mozilla public license 2 0", "mpl 2 0"],
    "mpl-1.1": ["mozilla public license version 1 1", "mpl 1 1"],
    "epl-2": ["eclipse public license version 2", "eclipse public license 2 0", "epl 2 0"],
    "epl-1": ["eclipse public license version 1", "eclipse public license 1 0", "epl 1 0"],
    "cddl": ["common development and distribution license", "cddl 1 0", "cddl 1 1"],
    "cpl": ["common public license"],
    "eupl": ["european union public licence", "eupl 1 2"],
    "osl-3": ["open software license version 3", "osl 3 0"],
    "afl-3": ["academic free license version 3", "afl 3 0"],
    "artistic-2": ["artistic license 2", "artistic 2 0"],
    "zlib": ["zlib", "zlib libpng"],
    "bsl-1": ["boost software license version 1 0", "boost software", "bsl 1 0"],
    "unlicense": ["the unlicense", "unlicense"],
    "wtfpl": ["do what the fuck you want to public license", "wtfpl"],
    "python-2": ["python software foundation license", "psf license"],
    "openssl": ["openssl"],
    "ms-pl": ["microsoft public license", "ms pl"],
    "cc0": ["cc0 1 0", "cc0", "creative commons zero"],
    "cc-by-nc-sa": ["cc by nc sa", "creative commons attribution noncommercial sharealike"],
    "cc-by-nc-nd": ["cc by nc nd", "creative commons attribution noncommercial noderivatives"],
    "cc-by-nc": ["cc by nc", "creative commons attribution noncommercial"],
    "cc-by-nd": ["cc by nd", "creative commons attribution noderivatives"],
    "cc-by-sa": ["cc by sa", "creative commons attribution sharealike"],
    "cc-by": ["cc by", "creative commons attribution"],
    "odbl": ["open database license", "odbl"],
    "pddl": ["public domain dedication and license", "pddl"],
    "elastic-2": ["elastic license 2 0", "elastic license"],
    "sspl": ["server side public license", "sspl"],
    "busl": ["business source license", "busl 1 1"],
    "ofl": ["sil open font license", "ofl 1 1"],
}

# How texts refer to a name - (confidence, keyword beside the name, expression around {n}).
REFERENCES = [
    (1.0, "spdx", r"spdx license identifier {n}"),
    (0.95, "terms", r"under the terms (?:and conditions )?of (?:the )?{n}(?: licen[cs]e)?"),
    (0.95, "under", r"(?:licen[cs]ed|released|distributed|available|published|provided|offered|redistributed) under (?:the |an? )?{n}(?: licen[cs]e)?"),
    (0.9, "under", r"under (?:the |an? )?{n} licen[cs]e"),
    (0.9, "licen", r"licen[cs]e (?:is |type )?(?:the )?{n}(?: licen[cs]e)?"),
    (0.8, "licen", r"{n} licen[cs]e(?: agreement| version [0-9]+(?: [0-9]+)?| v[0-9]+)?"),
]
#: Names that are unmistakable alone: three words or more.
ALONE = (0.7, "", r"{n}")
ALONE_WORDS = 3


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    confidence: float
    keywords: tuple[str, ...]
    pattern: re.Pattern


def rules() -> list[Rule]:
    """All rules in order: the signatures, then by kind of reference and the listed order of the names."""
    out = [Rule(i, label, confidence, keywords, re.compile(r"(?<![^ ])(?:" + form + r")(?![^ ])"))
           for i, (label, confidence, keywords, form) in enumerate(SIGNATURES)]
    for confidence, keyword, form in [*REFERENCES, ALONE]:
        for label, names in NAMES.items():
            for name in names:
                if form == ALONE[2] and len(name.split()) < ALONE_WORDS:
                    continue
                pattern = re.compile(r"(?<![^ ])" + form.format(n=name) + r"(?![^ ])")
                keywords = tuple(k for k in (name, keyword) if k)
                out.append(Rule(len(out), label, confidence, keywords, pattern))
    return out


class Detector:
    def __init__(self):
        import ahocorasick

        self.rules = rules()
        self.by_name: dict[str, list[Rule]] = {}
        for r in self.rules:
            self.by_name.setdefault(r.keywords[0], []).append(r)
        self.words = ahocorasick.Automaton()
        for k in {k for r in self.rules for k in r.keywords}:
            self.words.add_word(k, k)
        self.words.make_automaton()
        self.gates = ("licen", "spdx", "under", "terms", *(n for ns in NAMES.values() for n in ns if len(n.split()) >= ALONE_WORDS),
                      *(keywords[0] for _, _, keywords, _ in SIGNATURES))
        self.gate = ahocorasick.Automaton()
        for k in self.gates:
            self.gate.add_word(k, k)
        self.gate.make_automaton()

    def detect(self, joined: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule) in characters of the joined words, suppressed detections left out."""
        if not any(True for _ in self.gate.iter(joined)):
            return []
        present = {k for _, k in self.words.iter(joined)}
        found = []
        for name in present & self.by_name.keys():
            for r in self.by_name[name]:
                if present.issuperset(r.keywords):
                    found += [(r.priority, m.start(), -m.end(), r) for m in r.pattern.finditer(joined)]
        kept: list[tuple[int, int, Rule]] = []
        # spans kept so far that lie in no other kept span, by start: their ends ascend too
        starts: list[int] = []
        ends: list[int] = []
        for _, s, minus_end, r in sorted(found, key=lambda x: x[:3]):
            e = -minus_end
            i = bisect_right(starts, s)
            if i and ends[i - 1] >= e:
                continue
            kept.append((s, e, r))
            lo, hi = bisect_left(starts, s), bisect_right(ends, e)  # kept spans inside the new one
            starts[lo:max(lo, hi)] = [s]
            ends[lo:max(lo, hi)] = [e]
        return kept


def word_numbers(joined: str, places) -> dict[int, int]:
    """The number of the word at each of the character places, in one pass over the text."""
    out, at, n = {}, 0, 0
    for p in sorted(set(places)):
        n += joined.count(" ", at, p)
        out[p], at = n, p
    return out


def base_places(joined: str) -> list[tuple[int, str]]:
    """(first word, label) of every place where a base phrase's words stand in a row."""
    hay, out = f" {joined} ", []
    for phrase, label in BASE_PHRASES.items():
        at = hay.find(f" {phrase} ")
        n = hay.count(" ", 0, at)
        while at >= 0:
            out.append((n, label))
            after = hay.find(f" {phrase} ", at + 1)
            n += hay.count(" ", at, after)
            at = after
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_base, first_word, last_word, base_labels, labels, score (best confidence), detections."""
    names = (key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")

    def rows(batches):
        detector = worker_cache("license-detector", Detector)
        for b in batches:
            out: dict = {c: [] for c in names}
            for k, t in zip(b[key], b[text]):
                words = item_words(t)
                joined = b" ".join(words).decode("utf-8", "surrogatepass")
                base = base_places(joined)
                found = detector.detect(joined)
                labels = {x for _, x in base}
                first = word_numbers(joined, (s for s, _, _ in found))
                row = (k, len(words), len(base), min((p for p, _ in base), default=None),
                       max((p for p, _ in base), default=None), ",".join(sorted(labels)),
                       ",".join(sorted(labels | {r.label for _, _, r in found})),
                       1.0 if base else max((r.confidence for _, _, r in found), default=0.0),
                       [{"rule": r.priority, "label": r.label, "first": first[s],
                         "words": joined.count(" ", s, e) + 1} for s, e, r in found])
                for c, v in zip(names, row):
                    out[c].append(v)
            yield out

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"`{key}` {kind}, n_words bigint, n_base bigint, first_word bigint, "
                       "last_word bigint, base_labels string, labels string, score double, "
                       "detections array<struct<rule: int, label: string, first: bigint, words: bigint>>", rows)
