"""Small documents with every awkward case, shared by the tests."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "kept boolean, n long, score double, class_id long, spans string")


def words(text):
    return WORDS.findall(text or "")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, changes):
    rng, parts = random.Random(seed), text.split(" ")
    for i in rng.sample(range(len(parts)), changes):
        parts[i] = f"x{rng.randrange(10**6)}"
    return " ".join(parts)


def texts():
    base, other = prose(1, 300), prose(2, 120)
    shared = prose(3, 45)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, base), (7, base),
        (8, edited(base, 4, 3)), (9, edited(base, 5, 40)), (10, prose(6, 60) + "\n" + shared + " " + prose(7, 30)),
        (11, shared), (12, prose(8, 20) + " " + shared + " " + prose(9, 50) + " " + shared),
        (13, other), (13, prose(10, 80)), (None, other), (None, prose(11, 70)),
        (14, prose(12, 90)), (14, prose(12, 90)), (15, prose(13, 9000)), (16, "\x0bé ß\u00a0漢字\U0001F600 " * 40),
        (17, prose(14, 34)), (18, prose(15, 35)), (19, prose(15, 35)), (20, "same " * 200), (21, prose(16, 4)),
    ]
    return rows


def docs(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, [None, "en", "de"][k % 3], [None, "src0", "src1", "x"][k % 4], None, True, 5, 0.5, 7, "clash")
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
