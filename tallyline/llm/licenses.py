"""Licence scan with a positional index of rare licence words.

Templates (phrases and notice texts) are indexed by word: each word lists the templates and offsets where it stands. How many
documents hold each template word is counted over the whole corpus; a template is entered by the rarest word of its key phrases. As
these must stand word by word, no place is lost by that. A file's words are looked up in that index; where the key phrase of an entry
word stands, it fixes where the template begins. The template's words are then aligned with the file's, in order, each at most as many
words off its place as the template may miss; a place counts if enough of them are found. A template without a key phrase in its text
is entered by its rarest words, one more than may be missing.

The index has one entry per template word and is bounded by the templates, which are a parameter; only it reaches the tasks.

Base phrases are templates whose every word is mandatory, so all their places are found: each holds the phrase's rarest word.

Words: A-Z lowered, runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`, positions from 0. Defined results: null or empty text has no words, no
labels and score 0; repeated rows get equal results; a null doc_id is kept. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyline.llm.words import word_hashes


class Template(NamedTuple):
    """label; words in order; key phrases that must stand word by word; least share of words in place; base phrase or not."""

    label: str
    text: str
    keys: tuple[str, ...]
    share: float = 0.8
    base: bool = False


# fixed values: base phrases and their labels
BASE = (
    Template("gpl", "gnu general public license", ("gnu general public license",), 1.0, True),
    Template("apache", "apache license", ("apache license",), 1.0, True),
    Template("cc-by", "cc by", ("cc by",), 1.0, True),
    Template("mit", "mit license", ("mit license",), 1.0, True),
)
# fixed values: opening words of public licence notices
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc0-1.0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0 universal",)),
    Template("mit-notice", "released under the mit license", ("under the mit license",)),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ("permission is hereby granted free of charge",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify and or distribute this software",),
    ),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
#: Words by which a word may stand off its place in any notice; in long ones as many as the notice may miss.
SHIFT = 1


def _vocabulary(templates: Sequence[Template]) -> np.ndarray:
    return np.unique(np.concatenate([word_hashes(t.text.encode())[0] for t in templates]))


def document_frequencies(documents: DataFrame, templates: Sequence[Template]) -> dict[int, int]:
    """How many documents hold each template word, over all documents; at most one entry per template word."""
    vocabulary = _vocabulary(templates)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for text in batch["text"]:
                found = np.zeros(len(vocabulary) + 1, bool)
                hashes = word_hashes(text.encode())[0]
                at = np.searchsorted(vocabulary, hashes)
                found[at[vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes]] = True
                total += found[:-1]
        yield pd.DataFrame({"word": vocabulary.view(np.int64), "n": total})

    counted = documents.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(count, "word long, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"] % 2**64: r["n"] for r in rows}


def _places_of(phrase: np.ndarray, words: np.ndarray) -> list[int]:
    """All places where the phrase stands word by word."""
    return [i for i in range(len(words) - len(phrase) + 1) if np.array_equal(words[i : i + len(phrase)], phrase)]


class Index:
    """Templates ready for look-up: entry words, sorted, each with the templates and offsets it opens."""

    def __init__(self, templates: Sequence[Template], frequencies: dict[int, int]) -> None:
        self.templates = templates
        self.words = [word_hashes(t.text.encode())[0] for t in templates]
        self.keys = [[word_hashes(k.encode())[0] for k in t.keys] for t in templates]
        missing = [int(len(w) * (1 - t.share) + 1e-9) for t, w in zip(templates, self.words, strict=True)]
        self.missing = missing
        self.shift = [0 if t.base else max(SHIFT, m) for t, m in zip(templates, missing, strict=True)]
        # per entry word: template, offset of the word, offset and end of the key phrase around it (none: the word alone)
        entries: dict[int, list[tuple[int, int, int, int]]] = {}
        for n, words in enumerate(self.words):
            rank = {int(w): (frequencies.get(int(w), 0), int(w)) for w in words}
            placed = [(k, at) for k in self.keys[n] if len(k) and (at := _places_of(k, words))]
            if placed:
                word, key, at = min(((int(w), k, at) for k, at in placed for w in k), key=lambda x: rank[x[0]])
                inside = np.flatnonzero(key == np.uint64(word)).tolist()
                entries.setdefault(word, []).extend((n, i + k, i, i + len(key)) for i in at for k in inside)
            else:
                for i in sorted(range(len(words)), key=lambda i: (rank[int(words[i])], i))[: missing[n] + 1]:
                    entries.setdefault(int(words[i]), []).append((n, i, i, i))
        self.entry = np.array(sorted(entries), np.uint64)
        self.opens = [entries[int(w)] for w in self.entry]

    def starts(self, hashes: np.ndarray) -> dict[int, set[int]]:
        """Per template the places where one of its key phrases, or without one an entry word, says that it begins."""
        at = np.minimum(np.searchsorted(self.entry, hashes), len(self.entry) - 1)
        begin: dict[int, set[int]] = {}
        for place in np.flatnonzero(self.entry[at] == hashes).tolist():
            for template, offset, low, high in self.opens[at[place]]:
                start = place - offset
                if low == high:
                    shift = self.shift[template]
                    begin.setdefault(template, set()).update(range(start - shift, start + shift + 1))
                elif start + low >= 0 and np.array_equal(hashes[start + low : start + high], self.words[template][low:high]):
                    begin.setdefault(template, set()).add(start)
        return begin

    def share(self, hashes: np.ndarray, template: int, start: int) -> float:
        """Share of the template's words that stand in order from `start` on, each at most `shift` words off its place."""
        words, shift = self.words[template], self.shift[template]
        if start >= 0 and np.array_equal(hashes[start : start + len(words)], words):
            return 1.0
        low = start - shift
        near = hashes[max(0, low) : max(0, start + len(words) + shift)].tolist()
        low = max(0, low)
        # longest common subsequence within the band
        before = [0] * (len(near) + 1)
        for i, word in enumerate(words.tolist()):
            now = [0]
            for j, there in enumerate(near):
                most = max(before[j + 1], now[j])
                if there == word and abs(low + j - start - i) <= shift:
                    most = max(most, before[j] + 1)
                now.append(most)
            before = now
        return before[-1] / len(words)

    def has_keys(self, hashes: np.ndarray, template: int, start: int) -> bool:
        shift = self.shift[template]
        near = hashes[max(0, start - shift) : max(0, start + len(self.words[template]) + shift)]
        return all(bool(_places_of(k, near)) for k in self.keys[template])

    def places(self, hashes: np.ndarray) -> list[tuple[int, int, float]]:
        """(template, start, share) of all places, by template and start."""
        found = []
        for template, begin in sorted(self.starts(hashes).items()):
            for start in sorted(begin):
                share = self.share(hashes, template, start)
                if round(share * len(self.words[template])) >= len(self.words[template]) - self.missing[template] and self.has_keys(hashes, template, start):
                    found.append((template, start, share))
        return found


_PLACE = pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())])
COLUMNS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
    "labels": pa.string(), "score": pa.float64(), "matches": pa.list_(_PLACE),
}


def _report(index: Index, text: str) -> tuple:
    hashes = word_hashes(text.encode())[0]
    found = index.places(hashes) if len(hashes) else []
    label = [index.templates[t].label for t, _, _ in found]
    base = [start for t, start, _ in found if index.templates[t].base]
    base_labels = {index.templates[t].label for t, _, _ in found if index.templates[t].base}
    places = [{"label": name, "start": start, "share": share} for name, (_, start, share) in zip(label, found, strict=True)]
    return (
        len(hashes), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)),
        ",".join(sorted(set(label))), max((share for _, _, share in found), default=0.0), places,
    )


def scan_licenses(documents: DataFrame, templates: Sequence[Template] = BASE + NOTICES) -> DataFrame:
    """One row per input row: number of words, base phrases (all places, first and last), labels, score (largest share of a template's
    words found in place, else 0) and `matches`, every template place."""
    index = Index(templates, document_frequencies(documents, templates))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [_report(index, text) for text in batch.column("text").to_pylist()]
            values = [pa.array([t[k] for t in told], kind) for k, kind in enumerate(COLUMNS.values())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *values], ["doc_id", *COLUMNS])

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "matches array<struct<label: string, start: long, share: double>>"
    )
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(scan, schema)
