"""License scans, hard negatives and collocations against plain re-computations."""

import math
import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tests.llm.helpers import corpus, documents, empty
from ticktide.llm import collocations, hard_negatives, licenses


def lowered(text):
    return re.sub("[A-Z]+", lambda found: found.group().lower(), text or "")


# --- licenses ---

def license_rows(seed=3):
    """Texts of template words, whole templates with changes, long texts and awkward rows."""
    rng = random.Random(seed)
    known = [text.split() for _, text in licenses.TEMPLATES + licenses.PHRASES]
    every = sorted({word for words in known for word in words})
    texts = [None, "", "  \n", "...", "MIT", "Under the MIT License.", "CC BY-NC, cc by nc", "cc\nby, NC cc by", "Apache License, Version 2.0"]
    for at in range(150):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            words = list(rng.choice(known))
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(["été", "x9", *every])
            parts += words if rng.random() < 0.7 else rng.choices([*every, "zzz", "licences"], k=rng.randrange(60))
            parts += ["filler"] * rng.choice([0, 0, 3, 40])
        texts.append("".join(word.title() + rng.choice([" ", " ", ", ", "-", "\n"]) for word in parts))
    texts.append("word " * 3000 + "Released under the MIT License" + " word" * 3000)
    return [(at, text, "en", "s") for at, text in enumerate(texts)] + [(None, texts[5], None, None), (5, texts[5], "en", "s")]


def plain_scan(text, threshold):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    places = sorted((at, label) for label, phrase in licenses.PHRASES for at in range(len(words))
                    if words[at:at + len(phrase.split())] == phrase.split())
    found = set()
    for number, (_, template) in enumerate(licenses.TEMPLATES):
        members, step = set(template.split()), 16
        while step < len(template.split()):
            step *= 2
        for begin in range(0, max(len(words), 1), step):
            if begin and begin + step >= len(words):
                continue
            shared = len(members & set(words[begin:begin + 2 * step]))
            if shared >= math.ceil(threshold * len(members) - 1e-9):
                found.add((number, begin, min(begin + 2 * step, len(words)), shared))
    return len(words), places, found


@pytest.mark.parametrize("threshold", [0.9, 0.6])
def test_blocks_and_places_are_all_found(threshold):
    rows = license_rows()
    counts = Counter(word for _, text, *_ in rows for word in re.findall(r"\w+", lowered(text)))
    index = licenses.Index(licenses.PHRASES, licenses.TEMPLATES, counts, threshold)
    words = licenses.license_words(pa.array([text or "" for _, text, *_ in rows], pa.large_string()))
    number = index.vocabulary.numbers(words)
    places, blocks = [[] for _ in rows], [set() for _ in rows]
    for row, label, first, _ in index.places(words, number):
        places[row].append((first, label))
    for row, *block in index.blocks(words, number):
        blocks[row].add(tuple(block))
    for at, (_, text, *_) in enumerate(rows):
        assert (int(words.first[at + 1] - words.first[at]), sorted(places[at]), blocks[at]) == plain_scan(text, threshold)
    assert sum(map(len, blocks)) > 50


def test_license_scan_of_documents(spark):
    rows = license_rows()
    docs = documents(spark, rows).repartition(3)
    found = licenses.scanned(docs).collect()
    assert len(found) == len(rows)
    expected = {i: plain_scan(text, licenses.THRESHOLD) for i, text, *_ in rows}
    for row in found:
        n_words, places, blocks = expected[5 if row.doc_id is None else row.doc_id]
        assert row.n_words == n_words and [(p.first_word, p.label) for p in row.places] == places
        got = {(b.template, b.first_word, b.end_word, b.shared) for b in row.blocks}
        assert got <= blocks and bool(got) == bool(blocks)
        assert all(b.text and b.containment >= licenses.THRESHOLD for b in row.blocks)
    digest = {r.doc_id: r for r in licenses.digest(licenses.scanned(docs)).collect()}
    assert digest[5].base_labels == "mit" and digest[5].labels == "mit" and digest[5].score == 1.0 and digest[5].first_word == 0
    assert digest[0].n_words == 0 and digest[0].labels == "" and digest[0].score == 0.0 and digest[0].first_word is None
    assert digest[7].n_base == 1 and digest[7].first_word == 0 and digest[7].last_word == 0
    assert licenses.digest(licenses.scanned(empty(spark))).count() == 0


def test_wider_templates_and_clean_texts(spark):
    texts = ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
             "Licensed under the GNU Lesser General Public License, version 3.",
             "This work is licensed under the GNU General Public License, version 3.",
             "The public may use the work under any version of the general license."]
    rows = [(at, text, "en", "s") for at, text in enumerate(texts)]
    labels = {r.doc_id: r.labels for r in licenses.digest(licenses.scanned(documents(spark, rows))).collect()}
    assert labels == {0: "cc-by-sa", 1: "lgpl", 2: "gpl", 3: ""}


def test_frequencies_count_all_texts(spark):
    rows = [(at, "the the MIT\nlicense" if at % 2 else None, "en", "s") for at in range(40)]
    assert licenses.frequencies(documents(spark, rows).repartition(5), ["license", "mit", "the", "gnu"]) == {
        "license": 20, "mit": 20, "the": 40, "gnu": 0}


# --- hard negatives ---

VECTORS = "vec_id long, embedding array<double>, label int, score double, planes string"


def plain_negatives(rows):
    usable = []
    for at, (vec_id, vector, label, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        usable.append((at, vec_id, label, [math.floor(256 * x) for x in vector]))
    result = []
    for at, anchor, label, vector in usable:
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, other)), i is None, i or 0, l, i) for k, i, l, other in usable if k != at]
        scored.sort(key=lambda found: found[:3])
        for score, _, _, _, positive in [found for found in scored if found[3] == label][:5]:
            band = [f for f in scored if f[3] != label and 30 * -score <= 100 * -f[0] <= 90 * -score][:10]
            result += [(anchor, positive, rank, f[4], -score, -f[0]) for rank, f in enumerate(band, 1)]
    return sorted(map(repr, result))


def vector_rows(seed, scale):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 20))
    rows = []
    for at in range(900):
        label = int(rng.integers(0, 4))
        vector = (centres[label] + rng.normal(size=20)) * scale
        if at % 5 == 0:
            vector = np.round(vector, 0 if scale >= 1 else 1)  # ties
        rows.append((at, [float(x) for x in vector], label, 0.5, "x"))
    rows += [rows[100], rows[100], rows[333], (None, rows[7][1], 1, 0.5, "x"), (None, rows[7][1], 1, 0.5, "x"),
             (2000, None, 1, 0.5, "x"), (2100, [1.0, None], 1, 0.5, "x"), (2200, [float("nan")], 1, 0.5, "x"),
             (2300, [float("inf")], 1, 0.5, "x"), (2400, rows[3][1], None, 0.5, "x"), (-700, rows[3][1][:11], 9, 0.5, "x"),
             (2500, [], 2, 0.5, "x"), (2600, rows[4][1][:3], 2, 0.5, "x"), (1300, [0.0] * 20, 0, 0.5, "x")]
    return rows


@pytest.mark.parametrize("scale, block", [(0.2, 4096), (1.0, 4), (3000.0, 4096)])
def test_hard_negatives(spark, monkeypatch, scale, block):
    monkeypatch.setattr(hard_negatives, "SCORE_BYTES", 2000)
    monkeypatch.setattr(hard_negatives, "TABLE_BYTES", 20_000)
    rows = vector_rows(int(scale * 10), scale)
    found = hard_negatives.mined(spark.createDataFrame(rows, VECTORS).repartition(3), anchors_per_block=block)
    assert sorted(repr(tuple(row)) for row in found.collect()) == plain_negatives(rows)


def test_no_vectors(spark):
    assert hard_negatives.mined(spark.createDataFrame([], VECTORS)).count() == 0
    assert hard_negatives.mined(spark.createDataFrame([(100, [1.0], 1, 0.0, "")], VECTORS)).count() == 0


@pytest.mark.parametrize("largest", [1, 130, 70_000])
def test_bit_planes_and_subset_sums(largest):
    rng = np.random.default_rng(largest)
    rows, anchors = rng.integers(-largest, largest, (50, 13)), rng.integers(-largest, largest, (9, 16))
    planes, packs = hard_negatives.packed(rows)
    assert (hard_negatives.unpacked(planes, packs)[:, :13] == rows).all()
    got = hard_negatives.scores(hard_negatives.subset_sums(anchors, np.int64), packs)
    assert (got == rows @ anchors[:, :13].T).all()


def test_components_beyond_64_bits_are_refused(spark):
    with pytest.raises(ValueError):
        hard_negatives._integers(pa.array([[1e30]]))
    block = hard_negatives.Block([0], [0], [np.array([1 << 30] * 8)])
    with pytest.raises(ValueError):
        list(block.chunks(np.array([0]), 40))


# --- collocations ---

def plain_phrases(rows, width, least, top, within):
    counts, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, width + 1):
                for at in range(len(words) - size + 1):
                    counts[lang, tuple(words[at:at + size])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    found = {}
    for (lang, phrase), a in candidates.items():
        if any(other_lang == lang and len(other) > len(phrase) and 100 * f >= within * a
               and any(other[at:at + len(phrase)] == phrase for at in range(len(other)))
               for (other_lang, other), f in candidates.items()):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), a, l, r))
    return sorted(repr((lang, rank, p.decode(), a, l, r, sizes[lang], -s)) for lang, rows in found.items()
                  for rank, (s, _, p, a, l, r) in enumerate(sorted(rows)[:top], 1))


def phrase_rows(seed=9):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "été", "a", "b", "en", "es", "|", "東京"]
    texts = [None, "", " \t", ".,;", "new york city", "New York City " * 400]
    for _ in range(200):
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\t", " ", ". ", "\n", ", "]) for _ in range(rng.randrange(40))))
    return [(at, text, rng.choice(["en", "es", "en", None, "und", "été"]), "s") for at, text in enumerate(texts)] * 2 + [(None, "the the the", "en", "s")]


@pytest.mark.parametrize("width, held, partition_rows, top", [(3, 1_000_000, 1_500_000, 2000), (3, 7, 30, 5), (2, 0, 40, 40), (4, 1000, 20, 2000)])
def test_phrases(spark, monkeypatch, width, held, partition_rows, top):
    monkeypatch.setattr(collocations, "PARTITION_ROWS", partition_rows)
    monkeypatch.setattr(collocations, "SLICE_WINDOWS", 300)
    rows = phrase_rows() if width < 4 else phrase_rows(2)
    found = collocations.phrases(documents(spark, rows).repartition(3), width=width, least=5, top=top, held=held)
    assert sorted(repr(tuple(row)) for row in found.collect()) == plain_phrases(rows, width, 5, top, 50)


def test_phrases_of_the_awkward_corpus(spark):
    rows = corpus()
    found = collocations.phrases(documents(spark, rows))
    assert sorted(repr(tuple(row)) for row in found.collect()) == plain_phrases(rows, 3, 10, 2000, 50)
    assert collocations.phrases(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        collocations.phrases(empty(spark), width=1)


def test_scores_pass_64_bits(spark):
    a, l, r = 10 ** 13, 3 * 10 ** 13 + 7, 2 * 10 ** 13 + 1
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(collocations._score("l", "r").alias("s")).first()
    assert row.s == 1_000_000 * a * a // (l * r)


def test_windows_are_counted_once_and_summed_by_a_rollup(spark):
    docs = documents(spark, [(at, "new york city of the sea", "en", "s") for at in range(30)])
    held = collocations.lexicon(collocations.word_counts(docs), 10, 1000, 180)
    found = collocations.windows(docs, held, 3)
    assert found.agg({"c": "sum"}).first()[0] == 30 * 6
    text = collocations.folded(found, 3, 10, 4).rollup("w1", "w2", "w3").count()._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in text and "Exchange hashpartitioning(w1" in text


def test_a_task_of_windows_holds_little(monkeypatch):
    """Two million windows take under 60 bytes each in a task, and leave it in batches of a bounded size."""
    rng = np.random.default_rng(1)
    vocabulary = np.array([a + b + c for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"])
    texts = pa.array([" ".join(vocabulary[rng.integers(0, 512, 2000)]) for _ in range(1050)])
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), texts], ["lang", "text"])
    words = np.unique(np.concatenate([code for _, _, code in collocations._coded(batch)]))
    held = collocations.Lexicon(words, np.full(len(words), 4000), True, 5000)

    stand_in = SimpleNamespace(
        sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))),
        mapInArrow=lambda work, schema: work)
    monkeypatch.setattr(collocations, "_narrow", lambda docs: docs)
    work = collocations.windows(stand_in, held, 3)
    sizes, total = [], 0
    tracemalloc.start()
    try:
        for found in work([batch]):
            sizes.append(found.num_rows)
            total += pc.sum(found.column(found.schema.get_field_index("c"))).as_py()
            del found
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == 2_100_000
    assert max(sizes) <= 100_000
    assert peak < 60 * total, peak
