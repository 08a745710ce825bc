"""License scan by a positional index of rare words.

The templates are short licence notices. An index holds, for every word of a template, its postings: template and position. The rarity of the
words is their inverse document frequency over all documents, which Spark counts first. For each file, a template can only stand
in it if the words of its mandatory phrases do; of such templates the file's rarest licence words are looked up
in the index, and each place of a word votes for the place where the template would start. Places that several
words agree on, within a few words, are verified: every mandatory phrase must stand, word for word, where the template has
it, and the found words must weigh enough. All places of all templates are reported.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import map_texts

# Words by which the place of a template's word may differ in a file.
SLACK = 3
# Rarest words of a template, of those in the file, that are looked up; how many must agree.
RARE_WORDS = 6
AGREEING = 2
MIN_SCORE = 0.6

# Phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of public licences: label, text, mandatory phrases.
NOTICES = (
    ("mit", "The MIT License", ("mit license",)),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files, to deal in the Software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify", "with or without fee"),
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
        ("redistribution and use in source and binary forms", "with or without modification"),
    ),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    ("lgpl", "under the terms of the GNU Lesser General Public License", ("lesser general public license",)),
    ("agpl", "under the terms of the GNU Affero General Public License", ("affero general public license",)),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial License", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike License", ("creative commons attribution sharealike",)),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal", ("cc0 1 0",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "matches array<struct<label: string, start: long, length: long, score: double>>"
)

# Letters and digits of ASCII, A-Z lower-cased, and every byte beyond ASCII make words.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after lower-casing A-Z, as UTF-8."""
    return text.encode().translate(_LETTERS).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    # Mandatory phrases with their places.
    phrases: tuple[tuple[int, tuple[bytes, ...]], ...]

    @classmethod
    def of(cls, label: str, text: str, phrases: tuple[str, ...]) -> Template:
        words, found = tuple(words_of(text)), []
        for phrase in phrases:
            wanted = tuple(words_of(phrase))
            found.append((places_of(words, wanted)[0], wanted))
        return cls(label, words, tuple(found))

    def mandatory(self) -> frozenset[bytes]:
        return frozenset(w for _, phrase in self.phrases for w in phrase)


def places_of(words, phrase: tuple[bytes, ...]) -> list[int]:
    """Where the words of ``phrase`` stand one after another."""
    places, at, size = [], -1, len(phrase)
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if tuple(words[at : at + size]) == phrase:
                places.append(at)
    except ValueError:
        return places


class LicenseIndex:
    """Postings of the templates' words and the rarity of each."""

    def __init__(self, templates: list[Template], documents: int, with_word: dict[bytes, int]):
        self.templates = templates
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, template in enumerate(templates):
            for at, word in enumerate(template.words):
                self.postings[word].append((t, at))
        self.rarity = {w: 1 + log((documents + 1) / (with_word.get(w, 0) + 1)) for w in self.postings}
        self.vocabulary = frozenset(self.postings)
        self.mandatory = [template.mandatory() for template in templates]
        self.weights = [sum(self.rarity[w] for w in template.words) for template in templates]

    def matches(self, words: list[bytes], present: frozenset | set) -> list[tuple[str, int, int, float]]:
        """All places of all templates: ``(label, start, length, score)``; ``present`` are the licence words of the file."""
        able = [t for t, wanted in enumerate(self.mandatory) if wanted <= present]
        if not able:
            return []
        rarest = sorted(present, key=lambda w: (-self.rarity[w], w))
        chosen = {t: [w for w in rarest if w in set(self.templates[t].words)][:RARE_WORDS] for t in able}
        places: dict[bytes, list[int]] = {w: [] for ws in chosen.values() for w in ws}
        for at, word in enumerate(words):
            if word in places:
                places[word].append(at)
        found = []
        for t, lookups in chosen.items():
            votes: dict[int, set[bytes]] = defaultdict(set)
            for word in lookups:
                for of, at in self.postings[word]:
                    if of == t:
                        for place in places[word]:
                            votes[place - at].add(word)
            found += self._verified(t, votes, words, min(AGREEING, len(lookups)))
        return sorted(found, key=lambda m: (m[1], m[0], m[2]))

    def _verified(self, t: int, votes: dict[int, set[bytes]], words: list[bytes], agreeing: int) -> list:
        """Starts that enough rare words agree on and that pass all checks; of near ones the best."""
        near = {
            start: len(set().union(*(votes.get(start + k, ()) for k in range(-SLACK, SLACK + 1)))) for start in votes
        }
        passed, taken = [], set()
        for start in sorted((s for s, n in near.items() if n >= agreeing), key=lambda s: (-len(votes[s]), -near[s], s)):
            if start not in taken and self._has_phrases(t, start, words):
                score = self._score(t, start, words)
                if score >= MIN_SCORE:
                    size = len(self.templates[t].words)
                    first = max(start, 0)
                    passed.append((self.templates[t].label, first, min(start + size, len(words)) - first, score))
                    taken.update(range(start - SLACK, start + SLACK + 1))
        return passed

    def _has_phrases(self, t: int, start: int, words: list[bytes]) -> bool:
        for at, phrase in self.templates[t].phrases:
            low = max(start + at - SLACK, 0)
            if not places_of(words[low : start + at + SLACK + len(phrase)], phrase):
                return False
        return True

    def _score(self, t: int, start: int, words: list[bytes]) -> float:
        """Share, by rarity, of the template's words that stand near their places."""
        found = 0.0
        for at, word in enumerate(self.templates[t].words):
            if word in words[max(start + at - SLACK, 0) : max(start + at + SLACK + 1, 0)]:
                found += self.rarity[word]
        return found / self.weights[t]


def count_words(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """Documents, and documents that hold each word of ``vocabulary``: a row per word and task goes to the shuffle."""

    def make():
        counts: Counter = Counter()

        def apply(ids, texts):
            counts[b""] += len(texts)
            for text in texts:
                counts.update(vocabulary.intersection(words_of(text)))

        apply.finish = lambda: {"word": list(counts), "n": list(counts.values())}
        return apply

    rows = map_texts(docs, ["doc_id", "text"], make, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # At most one row per word of the templates.
    counted = {bytes(r["word"]): r["n"] for r in rows.collect()}
    return counted.pop(b"", 0), counted


def scan_licenses(docs: DataFrame, notices=NOTICES, phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """One row per document: its words, the places of the base phrases, and all places of all notices with their scores.

    A null or empty text has no words and no places; places are word numbers from 0; equal words at several
    places count each; rows that repeat are scanned each; an empty table gives no rows; other columns are ignored. Two
    passes over the texts without a shuffle of them: the first counts in how many documents each licence word stands.
    """
    templates = [Template.of(*notice) for notice in notices]
    wanted = [(tuple(words_of(p)), label) for p, label in phrases.items()]
    index = LicenseIndex(templates, *count_words(docs, frozenset(w for t in templates for w in t.words)))
    vocabulary = index.vocabulary | {w for phrase, _ in wanted for w in phrase}
    sent = docs.sparkSession.sparkContext.broadcast((index, vocabulary))

    def make():
        index, vocabulary = sent.value

        def scan(doc_id, text):
            words = words_of(text)
            present = vocabulary.intersection(words)
            base, labels = [], set()
            for phrase, label in wanted:
                if present.issuperset(phrase):
                    places = places_of(words, phrase)
                    base += places
                    if places:
                        labels.add(label)
            found = index.matches(words, present & index.vocabulary)
            matches = [dict(zip(("label", "start", "length", "score"), m)) for m in found]
            return doc_id, len(words), len(base), min(base, default=None), max(base, default=None), sorted(labels), matches

        names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "matches")
        return lambda ids, texts: dict(zip(names, zip(*map(scan, ids, texts))))

    return map_texts(docs, ["doc_id", "text"], make, SCAN)


def license_labels(docs: DataFrame) -> DataFrame:
    """Base phrases, all labels and the best score per document; a base phrase scores 1."""
    scan = scan_licenses(docs)
    labels = F.array_sort(F.array_union("base_labels", F.transform("matches", lambda m: m["label"])))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0))
    return scan.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(best, F.lit(1.0))).alias("score"), F.size("matches").cast("long").alias("n_matches"),
    )
