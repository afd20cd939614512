"""Each text operator on awkward rows against a plain re-computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.helpers import corpus, documents, empty, words
from ticktide.llm import cgk, crf_lang, gru_lm, html_paths, kneser_ney, mixing, pii, quality_rules, simhash, token_shards


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows).repartition(3).persist()


def labels_of(spark, rows):
    values = [(row[0], 1, 0) for row in rows[:50]] + [(3, 1, None), (None, 0, 0), (4, None, 0), (5, 0, 1)]
    return spark.createDataFrame(values, "doc_id long, quality int, toxic int")


# --- statistics and rules ---

def plain_counts(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(found, found[1:], found[2:]))
    covered = {k for at in range(len(found) - 2) if grams[tuple(found[at:at + 3])] > 1 for k in (at, at + 1, at + 2)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)


def test_statistics(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b", "é", " ", "\n", "#", "<", "a b a b"]) for _ in range(rng.randrange(30))) for _ in range(300)]
    found = quality_rules._counts(pa.array(texts, pa.large_string()))
    for at, text in enumerate(texts):
        assert tuple(int(value[at]) for value in found[:5]) == plain_counts(text)


def test_rules_find_planted_bad_rows_and_leave_clean_ones(spark, rows):
    rng = random.Random(5)
    bad = [(1000 + at, " ".join(w + "%%%" for w in row[1].split()), row[2], "s") for at, row in enumerate(rows[:40])]
    some = rows[:60] + bad
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in some if rng.random() < 0.8], "doc_id long, quality int, toxic int")
    judged = quality_rules.judged(documents(spark, some + rows[60:]), labels).collect()
    kept = {r.doc_id: r.kept for r in judged if not r.base_failed}
    assert all(kept[i] for i in range(60) if i in kept) and not any(kept[i] for i in range(1000, 1040) if i in kept)
    assert len(judged) == len(some) + len(rows) - 60
    assert [r.kept for r in judged if r.n_words == 0] == [False] * 3
    assert all(r.rule for r in judged if not r.kept and not r.base_failed)


def test_rules_without_labels_keep_what_passes_the_base(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept != r.base_failed for r in quality_rules.judged(docs, none).collect())
    assert quality_rules.judged(empty(spark), none).count() == 0


# --- fingerprints ---

def fingerprint(text):
    found = words((text or ""))
    found = [w.lower() for w in found]
    if not found:
        return 0
    size = min(3, len(found))
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[k:k + size]), 42) for k in range(len(found) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=2):
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for at, a in enumerate(prints):
        for b in prints[:at]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_near_duplicates(spark, docs, rows):
    found = simhash.near_duplicates(docs).collect()
    known = [(row[0], fingerprint(row[1])) for row in rows]
    root = plain_components({f for _, f in known})
    least = {}
    for doc_id, f in known:
        if doc_id is not None:
            least[root[f]] = min(least.get(root[f], doc_id), doc_id)
    expected = [(i, f"{f:016x}", least.get(root[f])) for i, f in known]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 48])
def test_links_in_sparse_and_crowded_cells_give_the_same_components(spark, limit):
    rng = random.Random(limit)
    centre = rng.getrandbits(64)
    prints = {rng.getrandbits(64) for _ in range(150)} | {0, centre}
    for _ in range(200):
        value = rng.choice(sorted(prints)) if rng.random() < 0.3 else centre
        prints.add(value ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.classes(spark.createDataFrame([(p,) for p in signed], "fp long"), 2, limit).collect()
    got = {}
    for row in found:
        got.setdefault(row.root, set()).add(row.fp % (1 << 64))
    expected = {}
    for p, r in plain_components(prints).items():
        expected.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_one_document_of_each_component_stays(spark, docs, rows):
    kept = simhash.one_per_component(docs).collect()
    root = plain_components({fingerprint(row[1]) for row in rows})
    assert sorted(root[fingerprint(r.text)] for r in kept) == sorted(set(root.values()))
    assert {r.doc_id for r in kept} <= {row[0] for row in rows} and 60 not in {r.doc_id for r in kept}
    assert kept[0].asDict().keys() == docs.limit(1).collect()[0].asDict().keys()


# --- mixing ---

def test_targets_add_up_and_respect_the_ceiling(spark, docs, rows):
    found = mixing.plan(docs).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    targets = {r.source: r.target for r in found}
    assert {r.source: r.source_size for r in found} == dict(sizes)
    assert math.isclose(sum(targets.values()), sum(sizes.values()), rel_tol=1e-9)
    assert all(targets[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    level = {s: targets[s] / w for s, w in zip(sorted(sizes, key=lambda s: (s is None, s)), (5, 2, 1, 5, 2))}
    free = [value for s, value in level.items() if targets[s] < 3 * sizes[s] * (1 - 1e-9)]
    assert max(free) - min(free) < 1e-6 * max(free)
    assert all(r.taken == r.copies * r.size and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in found)
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.plan(docs.repartition(2)).collect()))


def test_mixed_rows_follow_the_plan(spark, docs, rows):
    expected, rate = Counter(), {}
    for r in mixing.plan(docs).collect():
        expected[r.doc_id] += r.copies
        rate[r.doc_id] = r.rate
    found = mixing.mixed(docs)
    assert found.columns == docs.columns
    got, twice = Counter(r.doc_id for r in found.collect()), 3  # the row that stands twice has other coins here
    assert 2 * math.floor(rate[twice]) <= got.pop(twice, 0) <= 2 * math.floor(rate[twice]) + 2
    expected.pop(twice)
    assert got == +expected
    assert mixing.plan(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


def test_rows_without_or_with_one_id_have_coins_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(mixing.numbered, "__defaults__", (7,))
    rows = [(None, f"w{at} x y", "a", "a") for at in range(600)] + [(None, "same text here", "b", "b")] * 300 + [(5, "one two three", "c", "c")] * 300
    docs = documents(spark, [(i, text, lang, source) for i, text, lang, source in rows]).repartition(4)
    found = mixing.plan(docs).collect()
    assert len(found) == 1200 and found == found
    taken, target = Counter(), {}
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.15 * target[s] for s in "abc")
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.plan(docs.repartition(9)).collect()))
    mixed = Counter(r.source for r in mixing.mixed(docs).collect())
    assert all(abs(3 * mixed[s] - target[s]) < 0.15 * target[s] for s in "abc")


# --- token order ---

def test_permutation_is_a_bijection_that_depends_on_the_key():
    for size in (1, 2, 3, 5, 64, 65, 1000):
        assert sorted(token_shards.permute(np.arange(size), size, "a")) == list(range(size))
    assert list(token_shards.permute(np.arange(1000), 1000, "a")) != list(token_shards.permute(np.arange(1000), 1000, "b"))


def test_pieces_encode_as_whole_texts():
    rng = random.Random(6)
    signs = ["a", "b", "é", "1", " ", "  ", "\n", "\t", "\xa0", "\x1c", ".", "中", "'s", " x", "　"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(3000)]
    encoder = token_shards.Encoder(token_shards.TOKENIZER)
    plain = encoder.tokenizer.encode_ordinary
    for at in range(0, len(texts), 500):
        found = encoder.streams(pa.array(texts[at:at + 500], pa.large_string()))
        assert [stream.tolist() for stream in found] == [[*plain(t), token_shards.SEPARATOR] for t in texts[at:at + 500]]


def test_shards_hold_every_text_in_a_readable_order(spark, rows, tmp_path):
    stored = str(tmp_path / "docs")
    documents(spark, rows).repartition(3).write.parquet(stored)
    docs, path = spark.read.parquet(stored), str(tmp_path / "shards")
    manifest = token_shards.materialise(docs, path, length=64, shard_rows=50).orderBy("slot").collect()
    stream = list(token_shards.read(path))
    assert [r.slot for r in manifest] == list(range(len(stream)))
    assert [r.token_crc32 for r in manifest] == [zlib.crc32(s.tobytes()) for s in stream]
    assert [s.tolist() for s in token_shards.read(path, 77, 5)] == [s.tolist() for s in stream[77:82]]
    scanned = token_shards.scan(spark, path, 64, 50).orderBy("slot").collect()
    assert [bytes(r.tokens) for r in scanned] == [s.tobytes() for s in stream]
    joined = np.concatenate([stream[r.slot][:r.n_tokens] for r in sorted(manifest, key=lambda r: r.sequence)])
    decode = token_shards.encoding(token_shards.TOKENIZER).decode
    texts = [decode(part[:-1].tolist()) for part in np.split(joined, np.flatnonzero(joined == token_shards.SEPARATOR) + 1)[:-1]]
    assert sorted(texts) == sorted(row[1] or "" for row in rows)
    assert {i for r in manifest for i in r.doc_ids} == {row[0] for row in rows}
    assert token_shards.materialise(empty(spark), str(tmp_path / "none")).count() == 0


# --- personal data ---

def plain_spans(text):
    found = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in pii.CARD.finditer(text) if 13 <= len(pii._digits(m[0])) <= 19 and pii.luhn(pii._digits(m[0]))]
    return found + [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 9 <= len(pii._digits(m[0])) <= 15]


def test_base_spans():
    rng = random.Random(8)
    signs = "ab0123456789@@..--++() \né4111"
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text)


def card(rng):
    head = f"4{rng.randrange(10 ** 14):014}"
    return next(head + d for d in "0123456789" if pii.luhn(head + d))


def personal(rng):
    return rng.choice([
        lambda: f"{rng.choice('abcdef')}{rng.randrange(999)}@mail{rng.randrange(9)}.example.com",
        lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
        lambda: card(rng)])()


def test_added_spans_are_missed_forms_and_no_lookalikes(spark, rows):
    rng = random.Random(9)
    some = [(100 + at, " ".join(rng.choice([rows[at % 60][1][:40], personal(rng)]) for _ in range(8)), "en", "s") for at in range(300)]
    model = pii.fit(documents(spark, some))
    assert set(model.trees) == set(pii.KINDS)

    def added(text):
        return [kind for kind, _, _ in pii.added_spans(text, pii.base_spans(text), model)]

    assert added("call (415) 555-2671 today") == ["phone"]
    assert added("write to john.doe (at) example.com today") == ["email"]
    assert added("from 10[.]2[.]3[.]4 today") == ["ip"]
    for text in ("order 4111111111111112 of", "on 2024-01-02 the", "number 123456789 is", "the year 1999 and 2001", "at 12:30 (at) 5"):
        assert added(text) == []
    found = {r.doc_id: r for r in pii.found(documents(spark, some + rows), model).collect()}
    for doc_id, text, *_ in some:
        base = pii._joined(plain_spans(text))
        assert found[doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(found[doc_id].spans.split(","))
    assert found[62].spans == "" and found[62].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_numbers_side_by_side_are_proposed_each(spark, rows):
    def spans(text, kind):
        return {text[a:b] for k, a, b in pii.proposals(text) if k == kind}

    assert {"555-123-4567", "415-555-2671"} <= spans("call 555-123-4567 415-555-2671 now", "phone")
    assert "415-555-2671" in spans("2024-01-02 415-555-2671", "phone")
    assert "(415) 555-2671" in spans("12345 (415) 555-2671", "phone")
    assert {"4111 1111 1111 1111", "5500-0000-0000-0004"} <= spans("4111 1111 1111 1111 5500-0000-0000-0004", "card")
    for text in ("John (At) example.com", "john [aT] example [Dot] com"):
        assert spans(text, "email") == {text}
    assert len(pii.proposals("1 " * 5000)) < 20 * 5000
    rng = random.Random(9)
    some = [(100 + at, " ".join(rng.choice([rows[at % 60][1][:40], personal(rng)]) for _ in range(8)), "en", "s") for at in range(300)]
    model = pii.fit(documents(spark, some))

    def added(text):
        return [text[a:b] for _, a, b in sorted(pii.added_spans(text, pii.base_spans(text), model), key=lambda s: s[1])]

    assert added("call 555-123-4567 415-555-2671 now") == ["555-123-4567", "415-555-2671"]
    assert added("on 2024-01-02 415-555-2671 we") == ["415-555-2671"]


def test_forms_that_the_trees_were_not_shown(spark, rows):
    """Most of the forms that no example is made in are found, 11 of these 13 by trees of a small corpus; the cards with two
    signs are missed. Nothing is found in plain numbers."""
    rng = random.Random(12)
    some = [(100 + at, " ".join(rng.choice([rows[at % 60][1][:40], personal(rng)]) for _ in range(8)), "en", "s") for at in range(300)]
    model = pii.fit(documents(spark, some))
    forms = {"phone": ["0049 30 901820", "030/901820-44", "1-800-555-0199", "0043 1 58858", "0171/23 45 678"],
             "email": ["lee AT mailhost DOT org", "lee(at)mailhost.org", "a.b [At] mailhost.co.uk"],
             "card": ["4111. 1111. 1111. 1111", "41/1111 1111/1111/11", "4111/1111 1111/1111"], "ip": ["10 [.] 2 [.] 3 [.] 4", "8(.) 8(.) 4(.) 4"]}
    hits = []
    for kind, texts in forms.items():
        for form in texts:
            for _ in range(20):
                before, after = (" ".join(rng.choices(rows[0][1].split(), k=4)) for _ in range(2))
                text = f"{before} {form} {after}"
                hits.append((kind, len(before) + 1, len(before) + 1 + len(form)) in pii.added_spans(text, pii.base_spans(text), model))
    assert sum(hits) >= 0.8 * len(hits)
    for text in ("1,234,567.89 euros", "1.234.567 people", "from 1999-2004 on", "31.12.1999 was", "version 1.2.3.4567 of", "look at page dot 5",
                 "years 1999 2000 2001 2002 were", "pi is 3.14159265358979", "token f3a91b46405768150e0411590525cf889e"):
        assert pii.added_spans(text, pii.base_spans(text), model) == []
    beside = "Des +1 (826) 555-4081 190.137.223.204 du 7536784127813050 4845168114407329 et"
    found = pii.added_spans(beside, pii.base_spans(beside), model)
    assert {beside[a:b] for _, a, b in found} == {"+1 (826) 555-4081", "7536784127813050", "4845168114407329"}


def test_threshold_is_the_lowest_with_the_wanted_share():
    rng = np.random.default_rng(3)
    for _ in range(50):
        score = rng.integers(1, 40, 60) / 40
        good = (rng.random(60) < score).astype(float)
        cut = pii.threshold(score, good)
        shares = {c: good[score >= c].mean() for c in set(score.tolist()) if c >= 0.5}
        fit = [c for c, share in shares.items() if share >= pii.PRECISION]
        assert (score >= cut).sum() == (score >= min(fit, default=2)).sum()


def test_redaction(spark, docs, rows):
    assert pii.redact("a b@c.de x", [("email", 2, 8)]) == "a [EMAIL] x"
    assert sorted(map(repr, pii.redacted(docs).collect())) == sorted(map(repr, docs.collect()))
    assert pii.found(empty(spark)).count() == 0


# --- pages ---

PAGE = """<html><head><title>a<b</title><script>x("</p>")</script></head><body class="has-comments"><header><a href=/>Site</a></header>
<div id=menu><ul><li><a>x</a><li><a>y</a></ul></div><div class="layout"><div class="post-content"><h1>Title</h1>
<p>First part, with   some text. It goes on &eacute; and on&nbsp;here, yes?<p>Second <b>part</b> is long, with text; more of it.<ul><li>one<li>two</ul>
<form><input><label>Name</label></form><div class="cookie-notice">We use cookies.</div><!-- ad --></div>
<div class="sidebar">Other things, and more. And more text.</div><section id="comments"><p>I like this, a lot. Yes.</p></section></div><footer>c</footer>"""


def test_main_text(spark):
    expected = "Title\nFirst part, with some text. It goes on é and on here, yes?\nSecond part is long, with text; more of it.\none\ntwo"
    assert html_paths.main_text(PAGE) == expected
    broken = "<nav><a>m</a></nav><article><h1>T</h1><p><b>One &amp; a.<br><p>Two, b.</p></article><footer>f</footer>"
    pages = spark.createDataFrame([(1, "u", PAGE, 0), (2, None, broken, 0), (3, "u", None, 0), (None, "u", "", 0), (4, "u", "no  markup\nhere", 0),
                                   (5, "u", "<p>Hi</p>", 0), (6, "u", "<nav>only a menu</nav>", 0)], "page_id long, url string, html string, n_chars int")
    found = {r.page_id: r for r in html_paths.extracted(pages).collect()}
    assert {i: r.text for i, r in found.items()} == {
        1: expected, 2: "T\nOne & a.\nTwo, b.", 3: "", None: "", 4: "no markup here", 5: "Hi", 6: ""}
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_all_content_of_a_page_stays():
    intro, body = "What this is about, in short. It has a few signs.", " ".join(["A longer part of the text, with signs; and more."] * 7)
    page = f"<body><div class=intro><p>{intro}</p></div><div class=text><p>{body}</p></div></body>"
    assert html_paths.main_text(page) == f"{intro}\n{body}"
    listed = "<ul>" + "".join(f"<li><a href=x>Source {at}</a></li>" for at in range(4)) + "</ul>"
    page = f"<body><div class=post><p>{body}</p>{listed}<p>{body}</p></div>{listed}</body>"
    assert html_paths.main_text(page) == "\n".join([body, *(f"Source {at}" for at in range(4)), body])
    page = f"<body>{listed}<p>{body}</p><div><p>{body}</p></div></body>"
    assert html_paths.main_text(page) == f"{body}\n{body}"


def test_names_do_not_exclude_the_text_itself():
    text = " ".join(["A longer part of the text, with signs; and more."] * 7)
    aside = "<div class=sidebar><p>Other things, and more. And more.</p></div>"
    for opened in ('<div class="layout has-sidebar">', '<div id="page" class="with-sidebar">', '<div class="widget-post social-enabled">',
                   '<section class="search-article">', '<article><section class="search-article">', '<div class="hasSidebar no-comments">'):
        assert html_paths.main_text(f"<body>{opened}<p>{text}</p>{aside}") == text
    replies = f"<div id=comments>{'<p>I like this, a lot. Yes, I do; and so on.</p>' * 40}</div>"
    assert html_paths.main_text(f"<body><article><p>{text}</p></article>{replies}</body>") == text
    assert html_paths.main_text(f"<body><p>{text}</p>{aside}</body>") == text
    assert html_paths.main_text(f"<body><div class=widget-page><main><p>{text}</p></main></div><p>{'More, of it. ' * 90}</p>").startswith(text)


def test_paths_select_the_blocks():
    text = " ".join(["A longer part of the text, with signs; and more."] * 7)
    around = ("<div class=x1>menu</div>", "<div class=b7><p>Read our other story now, friends. Great deals, today.</p></div><div class=c9>Impressum</div>")
    assert html_paths.main_text(f"{around[0]}<div class=a1><p>{text}</p><p>{text}</p></div>{around[1]}") == f"{text}\n{text}"
    parts = "<div class=a1><h2>Head</h2><p>{0}</p><p>short</p></div><div class=z>in between</div><div class=a2><p>{0}</p><table><tr><td>1<td>2</table></div>"
    assert html_paths.main_text(f"{around[0]}<div class=t><h1>Title</h1></div>{parts.format(text)}{around[1]}") == "\n".join(
        ["Title", "Head", text, "short", "in between", text, "1", "2"])


def plain_path_scores(page):
    """Scores by the strings of the paths, block by block."""
    def path(element):
        return "" if element is None else f"{path(element.parent)}/{element.label}"

    blocks = html_paths.Page(page).blocks
    paths = [path(owner) for _, owner, _ in blocks]
    raw = {}
    for p in paths:
        own = [(t, linked) for q, (t, _, linked) in zip(paths, blocks) if q == p]
        size = sum(max(len(t) - linked, 0) for t, linked in own) / len(own)
        marks = sum(t.count(c) for t, _ in own for c in ".,;:!?") / len(own)
        raw[p] = math.log(1 + size) * math.log(1 + marks)
    smooth = {p: [] for p in paths}
    for at, p in enumerate(paths):
        near = [(raw[paths[at + k]], w) for k, w in zip((-2, -1, 0, 1, 2), (0.1, 0.2, 0.4, 0.2, 0.1)) if 0 <= at + k < len(paths)]
        smooth[p].append(sum(v * w for v, w in near) / sum(w for _, w in near))
    return [math.sqrt(raw[p] * sum(smooth[p]) / len(smooth[p])) for p in paths]


def test_path_scores_equal_plain_ones():
    rng = random.Random(4)
    for _ in range(60):
        page = "".join(rng.choice(["<div>", "</div>", "<p class=a>", "<p>", "<b>", "</b>", "<a>link, </a>", "<ul><li>", "</ul>", "Some words, here. ", "More! "])
                       for _ in range(60))
        blocks = html_paths.Page(page).blocks
        scores, paths = html_paths._scores(blocks, html_paths._tree(blocks))
        assert [scores[p] for p in paths] == pytest.approx(plain_path_scores(page))


def test_deep_pages_take_linear_time():
    assert html_paths.main_text("<div>x, y." * 20_000) == "\n".join(["x, y."] * 20_000)


# --- Kneser-Ney ---

def plain_token(word, vocabulary):
    """A frequent word's place, or the number of another word's shape."""
    if word in vocabulary:
        return ("word", word)
    def some(signs):
        return any(c in signs for c in word)
    length = sum(len(word) > limit for limit in (2, 3, 4, 6, 8, 11, 16))
    capitals = [65 <= c <= 90 for c in word]
    case = 0 if not any(capitals) else 1 if capitals[0] and sum(capitals) == 1 else 2
    return ("shape", length, case, some(range(48, 58)), some(rb"#*$%&|<>/\\@+=~^_{}[]"), some(range(128, 256)), word[-1] in b".,;:!?")


def plain_kneser_ney(texts, vocabulary):
    """Probability of a token behind another one, from the definition of the modified estimate."""
    pairs = Counter()
    for text in texts:
        tokens = ["start"] + [plain_token(word, vocabulary) for word in words(text)]
        pairs.update(zip(tokens, tokens[1:]))

    def discounted(counts):
        n = [sum(c == k for c in counts.values()) for k in range(5)]
        if not (n[1] and n[2] and n[3]):
            return lambda c: (0.5, 1, 1.5)[min(c, 3) - 1]
        y = n[1] / (n[1] + 2 * n[2])
        d = [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3)]
        return lambda c: d[min(c, 3) - 1]

    behind = Counter(second for _, second in pairs)
    d1, d2 = discounted(behind), discounted(pairs)
    left = sum(map(d1, behind.values())) / sum(behind.values())

    def alone(token):
        return (max(behind[token] - d1(behind[token]), 0) / sum(behind.values()) if behind[token] else 0) + left / kneser_ney.TOKENS

    def probability(before, token):
        own = {b: c for (a, b), c in pairs.items() if a == before}
        if not own:
            return alone(token)
        share = (own[token] - d2(own[token])) / sum(own.values()) if token in own else 0
        return share + sum(map(d2, own.values())) / sum(own.values()) * alone(token)

    return probability


def test_perplexities_equal_plain_ones(spark, rows):
    rng = random.Random(6)
    odd = ["A1 b%c Über ÄB. x", "rare, Rare RARE r2d2", "", None, "the the the of of"]
    texts = [row[1] for row in rows[:20]] + [" ".join(rng.choice(("the", "of", "A1", "b%c", "Über", "x,")) for _ in range(30)) for _ in range(9)] + odd
    frame = documents(spark, [(at, text, "en", "s") for at, text in enumerate(texts)])
    vocabulary = kneser_ney.frequent_words(frame)
    counted = Counter(word for text in texts for word in words(text))
    known = {word for word, n in counted.items() if n > 1}
    assert len(vocabulary) == len(known)
    learned = kneser_ney.model(kneser_ney.gram_counts(frame, vocabulary))
    assert np.allclose(np.exp(learned.table().reshape(kneser_ney.TOKENS, -1).astype(float)).sum(axis=1), 1, atol=1e-4)
    probability = plain_kneser_ney(texts, known)
    other = ["never seen words, of the X9 kind", *texts[:3], *odd]
    frame = documents(spark, [(at, text, "en", "s") for at, text in enumerate(other)])
    found = {r.doc_id: r for r in kneser_ney.with_perplexity(frame, vocabulary, learned).collect()}
    for at, text in enumerate(other):
        tokens = ["start"] + [plain_token(word, known) for word in words(text)]
        assert found[at].n_words == len(tokens) - 1
        if len(tokens) == 1:
            assert found[at].perplexity is None
        else:
            logs = [math.log(probability(a, b)) for a, b in zip(tokens, tokens[1:])]
            assert found[at].perplexity == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-4)


def plain_perplexity(text, known, probability):
    tokens = ["start"] + [plain_token(word, known) for word in words(text)]
    logs = [math.log(probability(a, b)) for a, b in zip(tokens, tokens[1:])]
    return math.exp(-sum(logs) / len(logs)) if logs else None


@pytest.mark.parametrize("words_held, pairs_held", [(1 << 22, 1 << 24), (1 << 22, 40), (1 << 22, 0), (20, 1 << 24), (20, 40), (0, 0)])
def test_perplexities_do_not_depend_on_what_tasks_hold(spark, rows, monkeypatch, words_held, pairs_held):
    """words and pairs that are not held are joined, not left out; also where all counts are tied."""
    monkeypatch.setattr(kneser_ney, "HELD_WORDS", words_held, raising=False)
    monkeypatch.setattr(kneser_ney, "HELD_PAIRS", pairs_held, raising=False)
    odd = ["A1 b%c Über ÄB. x", "rare, Rare RARE r2d2", "", None, "the the the of of"]
    texts = [row[1] for row in rows[:12]] + odd
    frame = documents(spark, [(at, text, "en", "s") for at, text in enumerate(texts)])
    known = {word for word, n in Counter(word for text in texts for word in words(text)).items() if n > 1}
    vocabulary = kneser_ney.frequent_words(frame)
    assert len(vocabulary) == len(known)
    learned = kneser_ney.model(kneser_ney.gram_counts(frame, vocabulary), vocabulary)
    other = ["never seen words, of the X9 kind", *texts[:2], *odd, texts[1] + " the never seen the"]
    probability = plain_kneser_ney(texts, known)
    # equal ids, as the texts are told apart by their rows
    found = kneser_ney.with_perplexity(documents(spark, [(1, text, str(at), "s") for at, text in enumerate(other)]), vocabulary, learned)
    found = {int(r.lang): r for r in found.collect()}
    for at, text in enumerate(other):
        assert found[at].n_words == len(words(text))
        expected = plain_perplexity(text, known, probability)
        assert found[at].perplexity == (expected and pytest.approx(expected, rel=1e-4))


def test_every_repeated_word_is_a_token(spark, monkeypatch):
    """of 5,000 words that occur twice none had been a token, and of more frequent ones 3,711."""
    texts = [" ".join(f"w{at}" for at in range(5_000)), " ".join(f"w{at}" for at in reversed(range(5_000)))]
    frame = documents(spark, [(at, text, "en", "s") for at, text in enumerate(texts)])
    vocabulary = kneser_ney.frequent_words(frame)
    assert len(vocabulary) == 5_000
    learned = kneser_ney.model(kneser_ney.gram_counts(frame, vocabulary), vocabulary)
    known = {word for word in words(texts[0])}
    monkeypatch.setattr(kneser_ney, "TOKENS", 1 + kneser_ney.SHAPES + 5_000)
    probability = plain_kneser_ney(texts, known)
    other = ["w7 w8 w9 w3 w2 w4000 unknown", "w4999 w4998 w1"]
    found = kneser_ney.with_perplexity(documents(spark, [(at, text, "en", "s") for at, text in enumerate(other)]), vocabulary, learned)
    assert [r.perplexity for r in sorted(found.collect(), key=lambda r: r.doc_id)] == pytest.approx(
        [plain_perplexity(text, known, probability) for text in other], rel=1e-4)


def test_pair_counts_are_those_of_the_texts(spark):
    texts = ["ab  c ab c", "", None, "\n\nab", "c"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    vocabulary = kneser_ney.frequent_words(frame)
    token = dict(zip(kneser_ney.words_of(pa.array(["ab c"], pa.large_string())).hashes().tolist(), ("ab", "c")))
    number = {token[h]: 1 + kneser_ney.SHAPES + at for at, h in enumerate(vocabulary.tolist())}
    expected = {(0, number["ab"]): 2, (number["ab"], number["c"]): 2, (number["c"], number["ab"]): 1, (0, number["c"]): 1}
    counts = kneser_ney.gram_counts(frame, vocabulary).collect()
    assert {divmod(r.gram, kneser_ney.TOKENS): r.n for r in counts} == expected


def test_strange_text_is_dropped_and_clean_text_stays(spark, rows):
    strange = [(2000 + at, "".join(c + "#|" for c in row[1][:300]), row[2], "s") for at, row in enumerate(rows[:5])]
    strange += [(2005 + at, " ".join([word] * 80), "en", "s") for at, word in enumerate(("Of", "Ostine", "Über."))]
    found = kneser_ney.classified(documents(spark, rows + strange), labels_of(spark, rows)).collect()
    kept = {r.doc_id: r.kept for r in found}
    assert len(found) == len(rows) + 8
    assert all(kept[i] for i in range(60)) and not any(kept[i] for i in range(2000, 2008)) and not kept[62] and not kept[63]
    trusted = {r.doc_id for r in found if r.trusted}
    assert trusted == set(range(50)) - {4, 5}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bare = kneser_ney.classified(documents(spark, rows), none).collect()
    assert all(r.low is None and r.high is None and r.kept == (r.perplexity is not None) for r in bare)
    assert kneser_ney.classified(empty(spark), none).count() == 0


# --- decontamination ---

def normal(text):
    return [w for w in (re.sub(rb"[^a-z0-9\x80-\xff]", b"", w.lower()) for w in words(text)) if w]


def edits_to(item, text):
    previous = [0] * (len(text) + 1)
    for at, word in enumerate(item, 1):
        current = [at]
        for k, other in enumerate(text, 1):
            current.append(min(previous[k] + 1, current[-1] + 1, previous[k - 1] + (word != other)))
        previous = current
    return min(previous)


def test_leaks(spark, rows):
    rng = random.Random(12)
    names = [f"{a}{b}" for a in "bcdfghklm" for b in ("ana", "eno", "iru", "oto", "uli", "ari")]
    items = [" ".join(rng.choice(names) for _ in range(size)) for size in (9, 15, 20, 33, 59, 40)]
    planted = []
    for at in range(60):
        item = items[at % 6].split()
        for _ in range(at % 4 * len(item) // 15):
            place, kind = rng.randrange(len(item)), rng.randrange(3)
            item[place:place + (kind != 0)] = [] if kind == 1 else [rng.choice(names)]
        planted.append((500 + at, rows[at][1] + " " + " ".join(item).upper() + ", " + rows[at][1], "en", "s"))
    benchmark = spark.createDataFrame(
        [*enumerate(items), (0, items[0]), (90, None), (91, ""), (92, "one"), (93, "of, the!")], "item_id long, text string")
    some = rows + planted
    found = cgk.matches(documents(spark, some), benchmark).collect()
    expected = {}
    for doc_id, text, *_ in planted:
        for item_id, item in enumerate(items):
            distance = edits_to(normal(item), normal(text))
            if distance <= len(normal(item)) // 5:
                expected[doc_id, item_id] = distance
    got = {(r.doc_id, r.item_id): r.edits for r in found if r.item_id < 90}
    assert got == expected and len(expected) > 50
    assert [(r.doc_id, r.item_id) for r in found if r.item_id >= 90] == [(67, 92)]
    clean = cgk.clean(documents(spark, some), benchmark)
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, documents(spark, [
        r for r in some if r[0] not in {d for d, _ in expected} | {67}]).collect()))
    assert cgk.clean(documents(spark, rows), benchmark.limit(0)).count() == len(rows)
    assert cgk.matches(empty(spark), benchmark).count() == 0


def test_alignment_and_embedding():
    rng = np.random.default_rng(1)
    regions, items = rng.integers(1, 5, (200, 14), dtype=np.uint64), rng.integers(1, 5, (200, 6), dtype=np.uint64)
    edits, start, end = cgk.align(regions, items)
    for region, item, e, a, b in zip(regions, items, edits, start, end):
        assert e == edits_to(list(item), list(region)) and e == edits_to(list(item), list(region[a:b]))
    same = cgk.embed(items, 3)
    assert same.shape == (200, 18) and (same == cgk.embed(items, 3)).all()


@pytest.mark.parametrize("size", [5, 8, 10, 16, 60])
def test_edited_items_are_found_in_texts(size):
    rng = random.Random(size)
    vocabulary = [f"w{at}" for at in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(size)] for _ in range(200)]
    index = cgk.build([(at, " ".join(item)) for at, item in enumerate(items)])
    texts = []
    for item in items:
        changed = list(item)
        for _ in range(size // 5):
            at, kind = rng.randrange(len(changed)), rng.randrange(3)
            changed[at:at + (kind != 0)] = [] if kind == 1 else [rng.choice(vocabulary)]
        around = [[rng.choice(vocabulary) for _ in range(rng.randrange(30))] for _ in range(2)]
        texts.append(" ".join([*around[0], *changed, *around[1]]))
    found = {(row, item) for row, item, *_ in cgk.search(index, pa.array(texts, pa.large_string()))}
    assert sum((at, at) in found for at in range(200)) >= (200 if size < 16 else 198)


# --- language model ---

def test_language_model_scores(spark, docs, rows):
    found = gru_lm.scored(docs).collect()
    tokens, counts = [], Counter()
    for doc_id, text, *_ in rows:
        tokens.append([w.lower() for w in words(text)] + [None])
        if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 != 2:
            counts.update(tokens[-1])
    total, types = sum(counts.values()), len(counts)
    expected = sorted((len(t), sum(counts[w] > 0 for w in t), total, round(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in t), 6))
                      for t in tokens)
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
    assert gru_lm.scored(empty(spark)).count() == 0


@pytest.mark.parametrize("lanes", [1, 3, 8])
def test_training_reads_every_text_in_whole(lanes):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 70, size) for size in (5, 0, 900, 24, 23, 1, 60, 300)]
    wanted = [[*text.tolist(), 71] for text in texts]
    going, found, before = [[] for _ in range(lanes)], [], np.full(lanes, 71)
    for inputs, outputs, live in gru_lm.lane_windows(iter(texts), lanes, 71):
        going, before = [going[lane] for lane in live], before[live]
        for lane in range(len(live)):
            assert inputs[0, lane] == before[lane]
            for t, number in enumerate(outputs[:, lane].tolist()):
                if number >= 0:
                    assert t == 0 or inputs[t, lane] == outputs[t - 1, lane]
                    going[lane].append(number)
                    if number == 71:
                        found.append(going[lane])
                        going[lane] = []
        before = outputs[-1]
    assert sorted(found) == sorted(wanted)
    known = gru_lm.Vocabulary(np.arange(1, 71, dtype=np.uint64), np.full(70, 5), np.arange(70), 70, np.full(70, 5), 1000, 200, 20)
    assert gru_lm.train_shard(gru_lm.Network(known), iter(texts), lanes) == sum(map(len, wanted))


def test_lanes_end_together():
    rng = np.random.default_rng(3)
    length = np.concatenate([rng.integers(1, 200, 4000), [3000, 2500, 2000], rng.integers(1, 200, 40), [9]])
    order = gru_lm.lane_order(length, 64)
    assert sorted(order.tolist()) == list(range(len(length)))
    texts = (np.zeros(length[at] - 1, np.int64) for at in order)
    live = [len(lanes) for _, _, lanes in gru_lm.lane_windows(texts, 64, 71)]
    assert len(live) < 1.1 * length.sum() / (64 * gru_lm.WINDOW)  # a third more in the order they are drawn in
    assert gru_lm.lane_order(np.array([50, 1, 1]), 64).tolist() == [0, 1, 2]
    assert gru_lm.lane_order(np.zeros(0, np.int64), 64).tolist() == []


def test_words_are_looked_up_by_leading_bits():
    rng = np.random.default_rng(4)
    words = np.unique(np.array([0, 1, 2 ** 64 - 1, *((5 << 44) + np.arange(40)), *rng.integers(0, 2 ** 63, 500)], np.uint64))
    number = rng.permutation(len(words)) % 101
    number[0] = 101  # the end
    known = gru_lm.Vocabulary(words, np.arange(len(words)) + 3, number, 100, np.full(100, 5), 1000, 200, 20)
    asked = np.concatenate([words, words[1:] + np.uint64(1), words[1:] - np.uint64(1), rng.integers(0, 2 ** 63, 500).astype(np.uint64)])
    place = {w: at for at, w in enumerate(words.tolist())}
    at = [place.get(w) for w in asked.tolist()]
    n, numbers, held = known.look_up(asked)
    assert n.tolist() == [0 if p is None else p + 3 for p in at]
    assert numbers.tolist() == known.numbers(asked).tolist() == [
        101 if w == 0 else 100 if p is None else number[p] for w, p in zip(asked.tolist(), at)]
    assert held.tolist() == [p is not None or w == 0 for w, p in zip(asked.tolist(), at)]
    nothing = gru_lm.Vocabulary(words[:0], number[:0], number[:0], 0, number[:0], 0, 0, 0)
    assert [part.tolist() for part in nothing.look_up(words[:2])] == [[0, 0], [1, 0], [True, False]]


def test_windows_with_few_lanes_step_less_far():
    known = gru_lm.Vocabulary(np.arange(1, 71, dtype=np.uint64), np.full(70, 5), np.arange(70), 70, np.full(70, 5), 1000, 200, 20)
    moved = []
    for lanes in (1, 64):
        network = gru_lm.Network(known)
        before = network.class_bias.copy()
        gru_lm.train_shard(network, iter([np.arange(10)]), lanes)
        moved.append(np.abs(network.class_bias - before).max())
    assert moved[1] < moved[0] / 32


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    known = gru_lm.Vocabulary(np.arange(1, 71, dtype=np.uint64), np.full(70, 5), np.arange(70), 70, np.full(70, 5), 1000, 200, 20)
    network = gru_lm.Network(known)
    for name in network.NAMES:
        value = getattr(network, name).astype(np.float64)
        setattr(network, name, value + rng.normal(0, 0.1, value.shape))
    network.word_bias[network.word_bias < -20] = -30
    inputs, outputs, start = rng.integers(0, 72, (5, 3)), rng.integers(0, 72, (5, 3)), rng.normal(0, 1, (3, gru_lm.HIDDEN))

    def loss():
        state, total = start, 0.0
        for t in range(5):
            state = np.where((inputs[t] == 71)[:, None], 0, state)
            state = network.step(inputs[t], state)
            total -= network.log_probability(state, outputs[t]).sum()
        return total / 15

    slopes, _ = network.window(inputs, outputs, start)
    for name, slope in zip(network.NAMES, slopes):
        place, value = np.unravel_index(np.abs(slope).argmax(), slope.shape), getattr(network, name)
        before = value[place]
        value[place] = before + 1e-4
        above = loss()
        value[place] = before - 1e-4
        below = loss()
        value[place] = before
        assert abs((above - below) / 2e-4 - slope[place]) < 1e-4 * max(1, abs(slope[place]))


def test_word_probabilities_add_up():
    known = gru_lm.Vocabulary(np.arange(1, 131, dtype=np.uint64), np.full(130, 5), np.arange(130), 130, np.full(130, 5), 1000, 200, 20)
    network = gru_lm.Network(known)
    state = np.random.default_rng(0).normal(0, 1, (1, gru_lm.HIDDEN)).astype(np.float32)
    total = np.exp(network.log_probability(np.repeat(state, 132, axis=0), np.arange(132))).sum()
    assert abs(total - 1) < 1e-4


# --- language ID ---

def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    lengths = [0, 1, 5, 6, 0]
    first, labels = np.concatenate([[0], np.cumsum(lengths)]), 3
    scores, transitions = rng.normal(size=(12, labels)), rng.normal(size=(labels, labels))
    found = crf_lang.Chain(first, labels).marginals(scores, transitions)
    for low, high in zip(first[:-1], first[1:]):
        if low == high:
            continue
        mass = np.zeros((high - low, labels))
        for path in np.ndindex(*[labels] * (high - low)):
            weight = np.exp(sum(scores[low + k, y] for k, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
            weight *= np.exp(transitions[:, path[0]]).sum()  # any state may stand before the first word
            for k, y in enumerate(path):
                mass[k, y] += weight
        assert np.allclose(mass / mass.sum(axis=1, keepdims=True), found[low:high])


def test_long_chains_equal_block_by_block_passes():
    rng = np.random.default_rng(3)
    scores, transitions, size = rng.normal(size=(500, 2)), rng.normal(size=(2, 2)), 500
    found = crf_lang.Chain(np.array([0, size]), 2).marginals(scores, transitions)
    step, ahead, state = np.exp(transitions), [], np.full(2, 0.5)
    for score in scores:
        state = (state @ step) * np.exp(score)
        state /= state.sum()
        ahead.append(state)
    back, expected = np.ones(2), np.empty((size, 2))
    for t in range(size - 1, -1, -1):
        expected[t] = ahead[t] * back / (ahead[t] * back).sum()
        back = step @ (np.exp(scores[t]) * back)
        back /= back.max()
    assert np.allclose(found, expected)


def test_languages(spark, docs, rows):
    found = crf_lang.predict(docs).collect()
    held = [r for r in found if r.held_out]
    truth = {row[0]: row[2] for row in rows[:60]}
    assert len(found) == len(rows) and held
    assert all(r.lang_pred == truth[r.doc_id] for r in found if r.doc_id in truth)
    assert {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id in (62, 63, 64, 66)} == dict.fromkeys((62, 63, 64, 66), ("und", 0.0))
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in found)
    model = crf_lang.fit(docs)
    mixed = rows[0][1].split()[:30] + rows[1][1].split()[:30]
    _, marginals, _ = crf_lang.word_marginals(model, pa.array([" ".join(mixed)], pa.large_string()))
    assert (marginals.argmax(axis=1) == [0] * 30 + [1] * 30).mean() > 0.9
    kept = {r.doc_id for r in crf_lang.accepted(docs).collect()}
    assert kept == {row[0] for row in rows} - {62, 63, 64, 66}


def test_text_that_switches_between_three_languages_stays(spark):
    rng = random.Random(4)
    own = {lang: [a + b for a in stems for b in ("la", "mi", "to")] for lang, stems in (
        ("aa", ["bak", "bod", "bif", "bur"]), ("bb", ["xen", "xoq", "xyl", "xav"]), ("cc", ["kuz", "kez", "kiz", "koz"]))}
    texts = [(at, " ".join(rng.choices(own[lang], k=60)), lang, "s") for at, lang in enumerate(["aa", "bb", "cc"] * 30)]
    switched = " ".join(" ".join(rng.choices(own[lang], k=size)) for lang, size in (("aa", 40), ("bb", 30), ("cc", 30)))
    kept = {r.doc_id for r in crf_lang.accepted(documents(spark, texts + [(500, switched, None, "s"), (501, "12 !", None, "s")])).collect()}
    assert kept == {*range(90), 500}


def test_language_without_labels_is_unknown(spark, docs):
    bare = docs.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r.lang_pred for r in crf_lang.predict(bare).collect()} == {"und"}
    assert crf_lang.predict(empty(spark)).count() == 0
