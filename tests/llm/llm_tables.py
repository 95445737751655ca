"""Small document tables with awkward rows, for all operators."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(seed=7):
    """Rows with nulls in every column, empty, blank, tiny and very long texts, repeated rows and near copies."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    edited = base.split()
    edited[60] = "changed"
    passage = sentence(rng, 70)
    rows = [
        (1, base, "en", "a", None),
        (2, " ".join(edited), "en", None, 5),
        (3, base.upper(), None, "a", 6),
        (4, base, "de", "b", 7),
        (4, base, "de", "b", 7),
        (5, "", "en", "a", 0),
        (6, None, "en", "a", None),
        (7, " \n\t ", None, None, None),
        (8, "One", "fr", "c", 3),
        (9, "one", "fr", "c", 3),
        (10, "two words", "fr", "c", 9),
        (11, f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}", "en", "a", 1),
        (12, f"{sentence(rng, 80)}\n{passage}", "en", "a", 1),
        (13, f"{passage} {sentence(rng, 15)} {passage}", "en", "a", 1),
        (14, sentence(rng, 30_000, 5000), "en", "a", 1),
        (15, " ".join(["same"] * 300), "en", "a", 1),
        (None, base, "en", "a", 1),
        (None, None, None, None, None),
        (16, "Größe é x — ñandú naïve 𝔘𝔫𝔦", "de", "a", 1),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def write_tables(spark, folder, rows, **others):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    for name, (data, schema) in others.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
