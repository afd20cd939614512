"""Personal data by candidate gradient boosting.

Fixed patterns give the base spans, which are always reported. Generators with high recall propose further,
overlapping spans: addresses written with words for signs, numbers in other groupings, without plus sign
or with digits that the patterns do not join. Boosted trees over the format and the context of a proposal
give its probability of being personal data; a threshold per kind, calibrated on rows that the trees have not
seen, selects what is reported beside the base.

There are no labels for personal data, so the trees learn from the text itself: base spans are good
examples, in their own form and rewritten into random groupings and signs that the patterns miss, alone or side by
side with other numbers. Bad ones are parts and extensions of those, things that only look alike, and proposals that
touch no base span, unless they are as valid as a base span.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktide.llm.tables import hashed_sample
from ticktide.llm.words import text_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 4_000     # documents with proposals from which the trees are fitted
SAMPLE_PER_DOC = 40     # proposals of one document that are used for fitting, evenly spread over it
FORMS = 6               # random forms that are made of every base span
TREES, DEPTH, RATE, BINS = 80, 5, 0.2, 32
PRECISION = 0.98        # of the best proposals that a threshold accepts in unseen examples
CONTEXT = 24

# Fixed patterns of the base spans.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
DATE = re.compile(r"(?:1[89]|20)[0-9]{2}[-./\x20]?[01]?[0-9][-./\x20]?[0-3]?[0-9]|[0-3]?[0-9][-./\x20][0-3]?[0-9][-./\x20](?:1[89]|20)?[0-9]{2}")

# Generators of proposals.
AT = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:\x20?@\x20?|\x20?[(\[]\x20?at\x20?[)\]]\x20?)"
                r"[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?[(\[]\x20?dot\x20?[)\]]\x20?)[A-Za-z0-9-]{1,64})+", re.I)
AT_NEEDS = re.compile(r"@|[(\[]\x20?at\x20?[)\]]", re.I)
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20at\x20[A-Za-z0-9-]{1,64}(?:\x20dot\x20[A-Za-z0-9-]{1,64}){0,8}"
                     r"\x20dot\x20[A-Za-z]{2,24}(?![A-Za-z0-9-])", re.I)
SPELLED_NEEDS = re.compile(r"\x20dot\x20", re.I)
NUMBER = re.compile(r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9])*")
GROUP = re.compile(r"[0-9]+")
QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\x20?\[\.\]\x20?|\x20?\(\.\)\x20?|\x20\.\x20)[0-9]{1,3}){3}(?![0-9])")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """The same matches as EMAIL.finditer, found from their signs instead of from every letter."""
    free, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        sign = text.find("@", max(sign + 1, free))


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start: leftmost and not overlapping within a kind, failing matches dropped."""
    found = [("email", a, b) for a, b in _emails(text)]
    if not DIGIT.search(text):
        return found
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = _digits(match[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= len(_digits(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


def proposals(text: str) -> list[Span]:
    """Spans that may be personal data; they overlap, and one span can be proposed as several kinds.

    Of a run of numbers every sequence of its groups of digits within the limits of length is proposed.
    """
    found = [("email", *m.span()) for m in AT.finditer(text)] if AT_NEEDS.search(text) else []
    if SPELLED_NEEDS.search(text):
        found += [("email", *m.span()) for m in SPELLED.finditer(text)]
    if not DIGIT.search(text):
        return found
    for match in NUMBER.finditer(text):
        if match.end() - match.start() < 7:
            continue
        groups = [m.span() for m in GROUP.finditer(text, *match.span())]
        for at, (start, _) in enumerate(groups):
            size, begin = 0, start - (start > match.start() and text[start - 1] in "+(")
            for low, end in groups[at:]:
                size += end - low
                if size > 19:
                    break
                if 7 <= size <= 15:
                    found.append(("phone", begin, end))
                if size >= 12:
                    found.append(("card", begin, end))
    return found + [("ip", *m.span()) for m in QUAD.finditer(text)]


def features(text: str, span: Span) -> list[float]:
    """Format of a proposal and of its surroundings, without the kind's own validity as a sole test."""
    kind, start, end = span
    inner = text[start:end]
    digits = _digits(inner)
    groups = [len(g) for g in re.findall(r"[0-9]+", inner)]
    parts = [int(g) for g in re.findall(r"[0-9]+", inner)[:8] if len(g) < 10]
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    words = re.findall(r"[^\W\d_]+", before.lower())
    return [
        float(len(inner)), float(len(digits)), float(sum(c.isalpha() for c in inner)), float(len(groups)),
        float(max(groups, default=0)), float(min(groups, default=0)), float(groups[0] if groups else 0),
        float(groups[-1] if groups else 0), float(luhn(digits)) if digits else 0.0, float(max(parts, default=0) <= 255),
        float(inner.count(".")), float(inner.count(" ")), float(inner.count("-")), float("(" in inner), float("+" in inner),
        float("@" in inner), float(len(set(digits))), float(len(inner.rsplit(".", 1)[-1])) if "." in inner else 0.0,
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in ("", " ", "\n")),
        float(after[:1] in ("", " ", "\n", ".", ",")), float(sum(c.isdigit() for c in before)),
        float(sum(c.isdigit() for c in after)), float(before.rstrip().endswith((":", "="))), float(len(words[-1]) if words else 0),
        float("/" in inner), float(bool(digits) and digits[0] == "0"),
        _joined_number(before[::-1]), _joined_number(after), float(13 <= len(digits) <= 19), float(9 <= len(digits) <= 15),
        float(len(set(groups)) <= 1), float(bool(DATE.fullmatch(inner))), float(inner[-1:].isalpha()),
    ]


def _joined_number(beyond: str) -> float:
    """What follows in reading direction: 2 a digit behind a sign, 1 a digit behind a space, 0 anything else."""
    if not beyond[1:2].isdigit():
        return 0.0
    return 2.0 if beyond[0] in ".-/" else float(beyond[0] == " ")


def rewritten(kind: str, inner: str, rng: random.Random) -> str:
    """A base span in a form that the base patterns miss, drawn at random."""
    digits = _digits(inner)
    if kind == "email":
        sign, dot = rng.choice(((" (at) ", "."), ("[at]", "[dot]"), (" @ ", "."), ("(at)", "(dot)"), (" at ", " dot ")))
        local, _, domain = inner.partition("@")
        return local + sign + domain.replace(".", dot)
    if kind == "ip":
        parts = rng.choice((inner.split("."), [str(rng.randrange(rng.choice((10, 100, 256)))) for _ in range(4)]))
        return rng.choice(("[.]", "(.)", " . ")).join(parts)
    if kind == "card":
        if rng.random() < 0.5:  # cards of other lengths
            digits = digits[:1] + "".join(rng.choice("0123456789") for _ in range(rng.choice((11, 12, 13, 13, 15, 17))))
            digits = next(digits + last for last in "0123456789" if luhn(digits + last))
        sizes = rng.choice(("{4}", "{4}", "{5}", "{6}", f"{{{rng.randrange(2, 8)},8}}"))
        return rng.choice(("/", ".", "  ", "- ", "--")).join(re.findall(f".{sizes}|.+", digits))
    # an area of 2 to 5 digits behind nothing, a zero or a country, then one to three groups
    number = digits[-rng.randrange(6, 9):]
    groups = rng.choice(([number], [number[:3], number[3:]], [number[:4], number[4:]], re.findall("..?", number)[:3] + [digits[:2]]))
    area = digits[1:1 + rng.choice((2, 3, 3, 3, 4))]
    area = rng.choice((area, area, "0" + area[:-1]))
    country = rng.choice(("", "", "", digits[:1] + " ", "00" + digits[:2] + "-"))
    opened, closed = rng.choice((("", " "), ("", "-"), ("", "."), ("", "/"), ("(", ") ")))
    return country + opened + area + closed + rng.choice((" ", "-", ".")).join(groups)


def beside(kind: str, inner: str, form: str, rng: random.Random) -> tuple[str, str]:
    """What stands before and behind a form: mostly nothing, else another number that makes one run with it."""
    if kind not in ("card", "phone") or rng.random() < 0.5:
        return "", ""
    digits = _digits(inner)
    date = f"{1950 + int(digits[-4:]) % 100}-{1 + int(digits[-6:-4]) % 12:02}-{1 + int(digits[-3:-1]) % 28:02}"
    address = ".".join(str(rng.randrange(256)) for _ in range(4))
    return rng.choice(((f"{date} ", ""), ("", f" {form}"), (f"{form} ", ""), (f"{digits[:5]} ", ""), ("", f" {date}"),
                       (f"{inner} ", ""), ("", f" {inner}"), ("", f" {address}"), (f"{address} ", "")))


def lookalikes(kind: str, inner: str, rng: random.Random) -> list[str]:
    """What only looks like a base span: dates, plain numbers, amounts, times, impossible addresses."""
    digits = _digits(inner) or "1"
    if kind == "email":
        local, low, high = inner.partition("@")[0], rng.randrange(90), rng.randrange(10, 90)
        return [f"{local} (at) {low}.{high}", f"{local} @ {low}.{high}", f"{local} at {low} dot {high}", f"{local} at {inner.rpartition('.')[2]} dot {high}"]
    if kind == "ip":
        parts = inner.split(".")
        parts[rng.randrange(4)] = str(rng.randrange(256, 999))
        return [".".join(parts), "[.]".join(parts), " . ".join(parts)]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 10)) % 10)
        return [] if luhn(wrong) else [wrong, *(sign.join(re.findall(".{1,4}", wrong)) for sign in ("/", " ", "."))]
    year, month, day = 1950 + int(digits[-4:]) % 100, 1 + int(digits[-6:-4]) % 12, 1 + int(digits[-3:-1]) % 28
    run, low = "".join(rng.choice("0123456789") for _ in range(rng.randrange(7, 16))), rng.randrange(99)
    amount = f"{int(run[:9]):,}".replace(",", rng.choice((".", " ")))
    return [rng.choice((f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month}/{day}/{year}", f"{year}{month:02}{day:02}",
                        f"{day:02}/{month:02}/{year}", f"{month}/{day}/{year} {day:02}:{month:02}", f"{year}-{month:02}-{day:02} {day:02}:{month:02}", f"{year}.{month:02}.{day:02}")),
            run, amount, f"{low}.{run}", rng.choice((f"{year}-{year + 1} {run[-3:]}", f"{year} {year + 1} {year + 3}", f"{year}-{year + 4}"))]


def valid(text: str, span: Span) -> bool:
    """Whether a proposal meets its kind's own test, so that nothing says that it is a bad one."""
    kind, start, end = span
    inner = text[start:end]
    digits = _digits(inner)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return inner[0] == "+" and 9 <= len(digits) <= 15
    if kind == "ip":
        return all(int(part) <= 255 for part in GROUP.findall(inner))
    return inner[-2:].isalpha()


@dataclass
class Trees:
    """Boosted regression trees of fixed depth over binned features, as arrays."""

    cuts: np.ndarray      # features x (BINS - 1)
    feature: np.ndarray   # trees x inner nodes
    cut: np.ndarray       # trees x inner nodes
    value: np.ndarray     # trees x leaves
    start: float

    def predict(self, rows: np.ndarray) -> np.ndarray:
        score = np.full(len(rows), self.start)
        at = np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(rows), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[at, feature[node]] > cut[node])
            score += value[node - (2 ** DEPTH - 1)]
        return 1 / (1 + np.exp(-score))


def boost(rows: np.ndarray, good: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss with histogram splits."""
    count, width = rows.shape
    cuts = np.stack([np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1]) for f in range(width)])
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], axis=1)
    share = np.clip(good.mean(), 1e-4, 1 - 1e-4)
    score = np.full(count, np.log(share / (1 - share)))
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    trees = Trees(cuts, np.zeros((TREES, inner), int), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves)), float(score[0]))
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-score))
        slope, curve = good - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(count, int)
        for level in range(DEPTH):
            above, nodes = 2 ** level - 1, 2 ** level
            cell = ((((node - above)[:, None] * width) + np.arange(width)) * BINS + binned).ravel()
            g, h = (np.bincount(cell, np.repeat(values, width), nodes * width * BINS).reshape(nodes, width, BINS).cumsum(axis=2)
                    for values in (slope, curve))
            G, H = g[:, :, -1:], h[:, :, -1:]
            gain = (g * g / (h + 1) + (G - g) ** 2 / (H - h + 1) - G * G / (H + 1))[:, :, :-1].reshape(nodes, -1)
            best = gain.argmax(axis=1)
            feature, at = np.divmod(best, BINS - 1)
            split = (gain[np.arange(nodes), best] > 1e-6) & (np.bincount(node - above, minlength=nodes) >= 10)
            trees.feature[tree, above:above + nodes] = np.where(split, feature, 0)
            trees.cut[tree, above:above + nodes] = np.where(split, cuts[feature, at], np.inf)
            node = 2 * node + 1 + (rows[np.arange(count), trees.feature[tree, node]] > trees.cut[tree, node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, curve, leaves) + 1)
        trees.value[tree] = value
        score += value[leaf]
    return trees


@dataclass
class Model:
    trees: dict[str, Trees]
    threshold: dict[str, float]


def _overlaps(a: int, b: int, taken: list[tuple[int, int]]) -> bool:
    return any(a < end and start < b for start, end in taken)


def examples(text: str, place: int) -> list[tuple[str, int, int, list[float]]]:
    """(kind, good, group, features) of the proposals in a text and of base spans, as they are or rewritten, in their places.

    Of the proposals over such a span those that share an edge with it are examples, since they are the most alike; they
    make one group, of which only the best would be reported.
    """
    rng = random.Random(place)
    base = base_spans(text)
    taken = [(a, b) for _, a, b in base]
    result, group = [], 0
    proposed = proposals(text)
    step = max(1, len(proposed) // SAMPLE_PER_DOC)
    for span in proposed[::step][:SAMPLE_PER_DOC]:
        if not _overlaps(span[1], span[2], taken) and not valid(text, span):
            result.append((span[0], 0, (group := group + 1), features(text, span)))
    for kind, a, b in base[:SAMPLE_PER_DOC]:
        inner, left, right = text[a:b], text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
        result.append((kind, 1, (group := group + 1), features(text, (kind, a, b))))
        forms = [(inner, 1)] + [(rewritten(kind, inner, rng), 1) for _ in range(FORMS)]
        for form, good in forms + [(form, 0) for form in lookalikes(kind, inner, rng)]:
            before, after = beside(kind, inner, form, rng) if good else ("", "")
            near, start = left + before + form + after + right, len(left) + len(before)
            group += 1
            for span in proposals(near):
                if span[1] == start or span[2] == start + len(form):
                    whole = span[0] == kind and near[span[1]:span[2]] in (form, inner)
                    if kind == "card" == span[0] and not whole and valid(near, span):
                        continue  # nothing tells a part with a right check digit by chance from a card
                    result.append((span[0], int(good and whole), group, features(near, span)))
    return result


EXAMPLE = "kind string, good int, place long, part int, features array<double>"


def fit(docs: DataFrame, seed: int = 7) -> Model:
    """Trees and thresholds from at most SAMPLE_DOCS documents that hold a digit or an at sign, by hash of id and text."""
    narrow = docs.where(F.col("text").rlike("[0-9@]")).select("doc_id", F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"))
    limit = hashed_sample(narrow, "draw", SAMPLE_DOCS).agg(F.max("draw").alias("top")).first()["top"]
    if limit is None:
        return Model({}, {})
    chosen = docs.select("doc_id", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw")).where(F.col("draw") <= limit)

    def work(batches):
        for batch in batches:
            places = batch.column(2).to_pylist()
            found = [(kind, good, place, part, values) for text, place in zip(text_of(batch, "text").to_pylist(), places)
                     for kind, good, part, values in examples(text, place)]
            columns = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.list_(pa.float64()))],
                ["kind", "good", "place", "part", "features"])

    known = chosen.mapInArrow(work, EXAMPLE).orderBy(F.xxhash64("place"), "place", "part", "features").limit(
        2 * SAMPLE_DOCS * 4).toPandas()
    model = Model({}, {})
    for kind in KINDS:
        own = known[known["kind"] == kind]
        rows, good = np.array(own["features"].tolist(), float), own["good"].to_numpy(float)
        unseen = (own["place"].to_numpy(np.int64) % 3 == 0) if len(own) else np.zeros(0, bool)
        if len(own) < 60 or good[~unseen].min(initial=1) == good[~unseen].max(initial=0) or not unseen.any():
            continue
        trees = boost(rows[~unseen], good[~unseen])
        score = trees.predict(rows[unseen])
        best = own[["place", "part"]][unseen].assign(score=score, good=good[unseen]).sort_values(
            "score", ascending=False, kind="stable").drop_duplicates(["place", "part"])
        model.trees[kind] = trees
        model.threshold[kind] = threshold(best["score"].to_numpy(), best["good"].to_numpy())
    return model


def threshold(score: np.ndarray, good: np.ndarray) -> float:
    """The lowest threshold, a half at least, above which the wanted share of the examples is good: half way to the next
    example that is not accepted."""
    order = np.argsort(-score, kind="stable")
    share, ranked = np.cumsum(good[order]) / np.arange(1, len(order) + 1), np.append(score[order], 0)
    enough = np.flatnonzero((share >= PRECISION) & (ranked[1:] < ranked[:-1]))
    return max(0.5, float(ranked[enough[-1]] + ranked[enough[-1] + 1]) / 2) if len(enough) else 1.1


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """The proposals that the trees accept, best first, none of which overlaps a base span or another one."""
    proposed = [span for span in proposals(text) if span[0] in model.trees] if model.trees else []
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken], int)
    reach = np.maximum.accumulate(np.array([b for _, b in taken], int)) if taken else starts

    def free(a: int, b: int) -> bool:
        at = int(np.searchsorted(starts, b))
        return at == 0 or reach[at - 1] <= a

    proposed = [span for span in proposed if free(span[1], span[2])]
    ranked = []
    for kind in KINDS:
        own = [span for span in proposed if span[0] == kind]
        if own:
            scores = model.trees[kind].predict(np.array([features(text, span) for span in own]))
            ranked += [(-score, *span) for score, span in zip(scores.tolist(), own) if score >= model.threshold[kind]]
    chosen: list[Span] = []
    used = bytearray(len(text)) if ranked else b""
    for _, kind, a, b in sorted(ranked):
        if not any(used[a:b]):
            used[a:b] = b"\x01" * (b - a)
            chosen.append((kind, a, b))
    return chosen


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def found(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, all
    spans as kind:start:end in code points by kind and start, and n_added, how many of them the trees added.

    Null and empty texts hold nothing. Repeated rows stay repeated, a null doc_id stays null, extra columns are
    ignored, an empty table gives an empty result. Without enough examples of a kind nothing is added to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs) if model is None else model)

    def work(batches):
        for batch in batches:
            rows = []
            for text in text_of(batch, "text").to_pylist():
                base = base_spans(text)
                added = added_spans(text, base, shared.value)
                counts = [sum(span[0] == kind for span in base) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + added), len(added)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, FOUND)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones together, replaced by its first kind in brackets."""
    result, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= done:
            result += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(result) + text[done:]


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with all found personal data replaced; null texts stay null, all columns are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def work(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for text in batch.column(at).to_pylist():
                if text is not None:
                    base = base_spans(text)
                    text = redact(text, base + added_spans(text, base, shared.value))
                texts.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(work, docs.schema)
