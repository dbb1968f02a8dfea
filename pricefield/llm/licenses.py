"""Licence notices found by a positional index of rare words."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Byte map of UTF-8 text: A-Z in lower case, ASCII characters between words to spaces.
PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))

#: Base phrases and their labels, fixed values.
PHRASES = (
    ("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"),
)


@dataclass(frozen=True)
class Template:
    """A notice and the phrases without which it is not that licence."""

    label: str
    text: str
    mandatory: tuple[str, ...]


#: Sentences of public licences and their usual short notices, fixed values.
TEMPLATES = (
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template(
        "gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation", ("gnu general public license as published by the free software foundation",),
    ),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit-notice", "released under the mit license", ("mit license",)),
    Template(
        "mit-permission", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template(
        "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("distribute this software for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met", ("redistribution and use in source and binary forms",),
    ),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    Template("cc0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
)
#: Rarest words of a template that are indexed, and how many of them must agree on a place.
ANCHORS = 4
AGREE = 2


def plain_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(PLAIN).split()


def _split(phrase: str) -> list[bytes]:
    return phrase.encode().split()


def places(words: list[bytes], spots: list[int], phrase: list[bytes]) -> list[int]:
    """Where the phrase stands; spots are the places of its first word."""
    return [i for i in spots if words[i : i + len(phrase)] == phrase]


@dataclass
class Index:
    """word -> (template, place) postings of each template's rarest words."""

    templates: tuple[Template, ...]
    idf: dict[bytes, float]
    words: list[list[bytes]] = field(default_factory=list)
    mandatory: list[list[list[bytes]]] = field(default_factory=list)
    postings: dict[bytes, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))
    needed: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        for t, template in enumerate(self.templates):
            words = _split(template.text)
            self.words.append(words)
            self.mandatory.append([_split(p) for p in template.mandatory])
            rare = sorted(set(words), key=lambda w: (-self.idf.get(w, math.inf), w))[:ANCHORS]
            for at, word in enumerate(words):
                if word in rare:
                    self.postings[word].append((t, at))
            self.needed.append(min(AGREE, len(rare)))

    def match(self, words: list[bytes], spots: dict[bytes, list[int]]) -> tuple[set[str], float]:
        """Labels of the verified templates, and the best share of a template's words found at one place.

        Postings of the rare words vote for the place where the template would begin; places with enough
        votes are compared with the whole template. A template counts if its mandatory phrases stand there.
        """
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for word, hits in spots.items():
            for t, at in self.postings.get(word, ()):
                for i in hits:
                    votes[t, i - at].add(word)
        found, best = set(), 0.0
        for (t, start), seen in votes.items():
            if len(seen) < self.needed[t]:
                continue
            template = self.words[t]
            same = sum(1 for k, w in enumerate(template) if 0 <= start + k < len(words) and words[start + k] == w)
            best = max(best, same / len(template))
            here = words[max(0, start) : start + len(template)]
            if all(any(here[i : i + len(p)] == p for i in range(len(here) - len(p) + 1)) for p in self.mandatory[t]):
                found.add(self.templates[t].label)
        return found, best


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> frozenset[bytes]:
    return frozenset(w for t in templates for w in _split(t.text))


def word_weights(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[bytes, float]:
    """Inverse document frequency of the licence words over all documents; one number per licence word."""
    wanted = vocabulary(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                seen.update(wanted.intersection(plain_words(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in seen] + [""]), pa.array([*seen.values(), rows], pa.int64())], names=["word", "n"]
        )

    counts = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r.word.encode(): r.n for r in counts}
    total = counts.pop(b"", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in sorted(wanted)}


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """docs(doc_id, text): one row each with the base phrases' counts and places, labels and score.

    Two passes: document frequencies of the licence words, then the scan. Documents are judged one by one, so
    long or repeated ones need no exchange. A null or empty text has no words, no labels and scores 0.
    """
    weights = word_weights(docs, templates)
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, weights)
        phrases = [(_split(p), label) for p, label in PHRASES]
        watched = frozenset(index.postings) | {p[0] for p, _ in phrases}
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = plain_words(text)
                spots: dict[bytes, list[int]] = {}
                for i, w in enumerate(words):
                    if w in watched:
                        spots.setdefault(w, []).append(i)
                base, at = set(), []
                for phrase, label in phrases:
                    if hits := places(words, spots.get(phrase[0], []), phrase):
                        base.add(label)
                        at += hits
                more, score = index.match(words, spots) if len(spots) > 0 else (set(), 0.0)
                rows.append((
                    len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | more)), score,
                ))
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(list(c), k) for c, k in zip(columns, kinds[1:])]], names=names
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
