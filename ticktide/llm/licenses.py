"""License scans: phrases by consecutive words, and license notices by an exact set-similarity join.

The join finds every block of text that holds at least a threshold of a template's distinct words. Tokens are ordered by
how often they occur in the whole corpus, rare ones first. A template of n tokens of which k must be shared has one of its
n - k + 1 rarest in common with every block that qualifies (prefix filter); a block of fewer than k known tokens does not
qualify (length filter); and a shared prefix token at place i of the template and j of the block leaves at most
1 + min(n - i, size - j) - 1 shared ones (positional filter). What remains is counted exactly.

Blocks are windows of 2s words at every s-th word, s a power of two not below the template's length, so that any passage
as long as the template lies whole in one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktide.llm.tables import bounded
from ticktide.llm.words import Words, byte_flags, text_of, text_slices, words_of

THRESHOLD = 0.9
SMALLEST_BLOCK = 16
TEMPLATE_TOKENS = 100_000  # what all templates together may hold, because every task gets them

# The phrases of the base labels, and the usual wording of license notices.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the "
                 "license you may obtain a copy of the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license version"),
    ("agpl", "licensed under the gnu affero general public license version"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
            "this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any "
                   "form or by any means without the prior written permission of the publisher"),
]

_LETTERS = byte_flags(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def license_words(column: pa.Array) -> Words:
    """Runs of letters, digits and characters beyond ASCII, lower-cased (A-Z)."""
    return words_of(column, lower=True, separator=~_LETTERS)


class Vocabulary:
    """Numbers of known tokens; words are compared byte by byte, not by hash alone."""

    def __init__(self, tokens: list[str]):
        self.tokens = tokens
        found = license_words(pa.array([" ".join(tokens)], pa.large_string()))
        hashes = found.hashes()
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.sizes = found.end - found.start
        self.bytes = np.zeros((len(tokens), int(self.sizes.max(initial=0))), np.uint8)
        for at, token in enumerate(found.tokens()):
            self.bytes[at, :len(token)] = np.frombuffer(token, np.uint8)

    def numbers(self, words: Words) -> np.ndarray:
        """The number of each word, -1 for all others."""
        number = np.full(len(words.start), -1, np.int64)
        if not len(self.tokens) or not len(number):
            return number
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        token = self.order[at[hit]]
        start, size = words.start[hit], self.sizes[token]
        same = words.end[hit] - start == size
        for offset in range(self.bytes.shape[1]):
            inside = same & (offset < size)
            same[inside] = words.data[start[inside] + offset] == self.bytes[token[inside], offset]
        number[hit[same]] = token[same]
        return number


class Index:
    """Phrases and templates over a vocabulary whose numbers follow the corpus frequency, rare tokens first."""

    def __init__(self, phrases: list, templates: list, frequency: dict[str, int], threshold: float):
        texts = [text.split() for _, text in [*phrases, *templates]]
        tokens = sorted({token for words in texts for token in words}, key=lambda token: (frequency.get(token, 0), token))
        self.vocabulary = Vocabulary(tokens)
        number = {token: at for at, token in enumerate(tokens)}
        self.phrases = [(label, [number[word] for word in text.split()]) for label, text in phrases]
        self.labels = [label for label, _ in templates]
        sets = [np.unique([number[word] for word in text.split()]).astype(np.int64) for _, text in templates]
        self.sizes = np.array([len(members) for members in sets], np.int64)
        self.needed = np.array([math.ceil(threshold * len(members) - 1e-9) for members in sets], np.int64)
        self.steps = {}
        for at, (_, text) in enumerate(templates):
            step = max(SMALLEST_BLOCK, 1 << (len(text.split()) - 1).bit_length())
            self.steps.setdefault(step, []).append(at)
        # per step: token -> (template, place) of the prefixes, and of all members
        self.prefixes = {step: self._postings(sets, group, True) for step, group in self.steps.items()}
        self.members = {step: self._postings(sets, group, False) for step, group in self.steps.items()}
        # templates that hold enough of another one's tokens to be taken for it
        self.rivals = [{other for other, more in enumerate(sets) if other != at
                        and len(np.intersect1d(members, more)) >= self.needed[at]} for at, members in enumerate(sets)]

    def _postings(self, sets: list[np.ndarray], group: list[int], prefix: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = sorted((int(token), at, place) for at in group for place, token in enumerate(sets[at])
                      if not prefix or place <= self.sizes[at] - self.needed[at])
        table = np.array(rows, np.int64).reshape(-1, 3)
        return np.searchsorted(table[:, 0], np.arange(len(self.vocabulary.tokens) + 1)), table[:, 1], table[:, 2]

    def places(self, words: Words, number: np.ndarray) -> list[tuple[int, str, int, int]]:
        """(text, label, first word, words) of every place where a phrase's words stand one behind the other."""
        row, found = words.row, []
        for label, phrase in self.phrases:
            last = len(number) - len(phrase) + 1
            if last <= 0:
                continue
            hit = row[:last] == row[len(phrase) - 1:]
            for lead, token in enumerate(phrase):
                hit &= number[lead:lead + last] == token
            at = np.flatnonzero(hit)
            found += [(int(r), label, int(w), len(phrase)) for r, w in zip(row[at], at - words.first[row[at]])]
        return found

    def blocks(self, words: Words, number: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, template, first word, behind the last word, shared tokens) of every block that qualifies."""
        known = np.flatnonzero(number >= 0)
        row = words.row[known]
        place, size, token = known - words.first[row], np.diff(words.first), number[known]
        width = len(self.vocabulary.tokens)
        for step in self.steps:
            turn = place // step
            turns = int(turn.max(initial=0)) + 1
            texts, turn = np.concatenate([row, row]), np.concatenate([turn, turn - 1])
            real = (turn == 0) | ((turn > 0) & ((turn + 1) * step < size[texts]))
            block, tokens = (texts * turns + turn)[real], np.concatenate([token, token])[real]
            first, of, at = self.prefixes[step]
            opening = np.unique(block[first[tokens + 1] > first[tokens]])
            near = opening[np.minimum(np.searchsorted(opening, block), len(opening) - 1)] == block if len(opening) else []
            held = np.unique(block[near] * width + tokens[near]) if len(opening) else np.zeros(0, np.int64)
            block, tokens = held // width, held % width
            opening, begin, count = np.unique(block, return_index=True, return_counts=True)
            which = np.repeat(np.arange(len(opening)), count)
            rank = np.arange(len(block)) - begin[which]
            pair, posting = _expanded(first, tokens)
            template, behind = of[posting], self.sizes[of[posting]] - at[posting] - 1
            left = 1 + np.minimum(behind, count[which[pair]] - rank[pair] - 1)
            fits = (count[which[pair]] >= self.needed[template]) & (left >= self.needed[template])
            candidates = np.unique(which[pair][fits] * len(self.labels) + template[fits])
            first, of, _ = self.members[step]
            pair, posting = _expanded(first, tokens)
            shared, counts = np.unique(which[pair] * len(self.labels) + of[posting], return_counts=True)
            for code, overlap in zip(*(values[np.isin(shared, candidates)].tolist() for values in (shared, counts))):
                text, turn = divmod(int(opening[code // len(self.labels)]), turns)
                if overlap >= self.needed[code % len(self.labels)]:
                    yield text, code % len(self.labels), turn * step, min((turn + 2) * step, int(size[text])), overlap


def _expanded(first: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (row, posting) pairs of the tokens' posting lists."""
    counts = first[tokens + 1] - first[tokens]
    pair = np.repeat(np.arange(len(tokens)), counts)
    inside = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts)
    return pair, first[tokens][pair] + inside


def frequencies(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """How often each of the given tokens occurs in all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(tokens))

    def work(batches):
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                number = shared.value.numbers(license_words(text_of(part, "text")))
                total += np.bincount(number[number >= 0], minlength=len(tokens))
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(total)], ["token", "f"])

    counted = docs.select("text").mapInArrow(work, "token string, f long").groupBy("token").agg(F.sum("f").alias("f"))
    return {row["token"]: row["f"] for row in counted.collect()}


PLACE = "struct<label:string,first_word:bigint,n_words:bigint>"
BLOCK = "struct<label:string,template:int,first_word:bigint,end_word:bigint,shared:int,containment:double,text:string>"
SCAN = f"doc_id long, n_words long, places array<{PLACE}>, blocks array<{BLOCK}>"


def scanned(
    docs: DataFrame, phrases: list = PHRASES, templates: list = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: doc_id, n_words, the places of phrases and the blocks like a template.

    Phrases and templates are (label, words) with lower-case words between spaces. A place tells its label, first word
    and number of words; a block its template, first word, the word behind its end, shared tokens, their share of the
    template and its lower-cased text. Of similar templates in overlapping blocks the one that shares more tokens is
    reported. Null and empty texts have no words; repeated rows are reported each, null ids stay null and extra columns
    are ignored. An empty table gives an empty result.
    """
    bounded([token for _, text in [*phrases, *templates] for token in text.split()], TEMPLATE_TOKENS)
    tokens = sorted({token for _, text in [*phrases, *templates] for token in text.split()})
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = Index(phrases, templates, frequencies(narrow, tokens), threshold)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def work(batches):
        types = [pa.int64(), pa.int64(),
                 pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])),
                 pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
                                     ("end_word", pa.int64()), ("shared", pa.int32()), ("containment", pa.float64()),
                                     ("text", pa.string())]))]
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = license_words(text_of(part, "text"))
                places, blocks = found_in(shared.value, words)
                values = [part.column(0), np.diff(words.first), places, blocks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value, kind) for value, kind in zip(values, types)], ["doc_id", "n_words", "places", "blocks"])

    return narrow.mapInArrow(work, SCAN)


def found_in(index: Index, words: Words) -> tuple[list[list[dict]], list[list[dict]]]:
    """Places and blocks per text, in order of their words."""
    number = index.vocabulary.numbers(words)
    texts = len(words.first) - 1
    places, blocks = [[] for _ in range(texts)], [[] for _ in range(texts)]
    for row, label, first, size in sorted(index.places(words, number), key=lambda found: (found[2], found[1])):
        places[row].append({"label": label, "first_word": first, "n_words": size})
    found = [[] for _ in range(texts)]
    for row, *block in index.blocks(words, number):
        found[row].append(tuple(block))
    for row in range(texts):
        for template, first, end, overlap in sorted(found[row], key=lambda block: (block[1], block[0])):
            if any(other in index.rivals[template] and begin < end and first < stop and more > overlap
                   for other, begin, stop, more in found[row]):
                continue
            at = words.first[row]
            text = words.data[words.start[at + first]:words.end[at + end - 1]].tobytes().decode()
            blocks[row].append({
                "label": index.labels[template], "template": template, "first_word": first, "end_word": end,
                "shared": overlap, "containment": overlap / int(index.sizes[template]), "text": text})
    return places, blocks


def digest(found: DataFrame) -> DataFrame:
    """One row per scanned document: counts and places of the phrases, labels, and the best containment as score."""
    starts = F.col("places.first_word")
    base, others = F.col("places.label"), F.col("blocks.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, others)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"),
    )
