"""Small tables with the awkward cases: nulls in any column, empty and very long texts, ties,
repeated rows, and an extra column whose name an operator may use itself."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_removed long, node long"


def prose(seed, n, words=None):
    rnd = random.Random(seed)
    words = words or ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    return " ".join(rnd.choice(words) for _ in range(n))


def documents():
    a, b, c = prose(1, 120), prose(2, 90), prose(3, 200)
    near = a.split(" ")
    near[7] = "changed"
    passage = prose(9, 30)
    rows = [
        (1, a, "en", "x"), (2, " ".join(near), "en", "x"), (3, a, "en", None), (4, b, "de", "y"),
        (5, b + " " + passage, "de", "y"), (6, c + "\n" + passage + "\n" + prose(4, 40), None, "z"),
        (7, "", "en", "x"), (8, None, "en", "x"), (9, "   \n\t ", "de", "x"), (10, "one two", "en", "y"),
        (11, "one two", "en", "y"), (12, "ONE\ttwo", "en", "y"), (13, prose(5, 20_000), "en", "x"),
        (14, "é漢字🙂 " * 40, "de", "y"), (15, "é漢字🙂 " * 40 + "end", "de", "y"), (16, "a" * 5000, "en", "z"),
        (17, "b" + "a" * 300, "en", "z"), (4, b, "de", "y"), (4, prose(6, 50), "de", "y"), (None, a, "en", "x"),
        (None, None, None, None), (18, "x' y's 12 ² \x1c\x85 --- !!", "en", "x"), (19, passage, "en", "x"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), 0.5, 7, 1) for i, t, lang, s in rows]


def frame(spark):
    return spark.createDataFrame(documents(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
