"""Small tables with the awkward rows that every text operator must take, and plain re-computations."""

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string"
ENGLISH = "the of and to in that is was for with on as by at from be this are or an which".split()
FRENCH = "le la les des une et dans pour que qui sur avec est par au ce pas plus ou mais".split()


def words(text):
    return WORD.findall((text or "").encode())


def prose(rng, vocabulary, size):
    stems = [a + b for a in vocabulary for b in ("", "ine", "ort")]
    return " ".join(rng.choice(stems) for _ in range(size))


def corpus(count=60, seed=1):
    """Rows (doc_id, text, lang, source): two languages, copies, near copies, nulls, empties, long and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for at in range(count):
        english = at % 2 == 0
        rows.append((at, prose(rng, ENGLISH if english else FRENCH, rng.randrange(60, 200)), "en" if english else "fr", f"s{at % 4}"))
    rows.append((count, rows[0][1], "en", "s0"))
    rows.append((count + 1, rows[1][1] + " et", "fr", "s1"))
    rows += [(count + 2, None, "en", None), (count + 3, "", None, "s2"), (count + 4, " \n\t ", "fr", "s2"), (None, rows[2][1], None, None),
             (count + 5, prose(rng, ENGLISH, 30_000), "en", "s3"), (count + 6, "…—。 12 !", None, "s3"), rows[3], (count + 7, "one", "en", "s0")]
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(*row, len(row[1] or ""), 0.5, "x") for row in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
