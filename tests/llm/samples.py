"""Texts with every oddity, for all tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, raw string, row string, size string, h string, doc string, rank string, block string, fp string, copies string, target string"


def prose(seed, n, words=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def cases():
    """Texts with every oddity: nulls, empty, blanks, very long, copies, near copies, shared passages, repeated rows."""
    base = [prose(k, 60 + 13 * k, 4000) for k in range(18)]
    shared = prose(99, 30, 4000)
    words = base[3].split(" ")
    near = " ".join([*words[:50], "changed", *words[51:]])
    texts = [*base, base[0], base[0], near, base[5] + " " + shared, shared + "\n" + base[6], "head " + shared + " tail", base[7][:200] + "é" * 9 + base[7][200:]]
    texts += [None, "", "   \n\t ", "one", "x" * 3000, "ab " * 2000, prose(5, 30_000, 9000), "Line\n" * 40, "　日本語 text — ß ﬁ <|endoftext|> don't  STOP", "mail a.b@c.org or 10.0.0.1, +1 (415) 555-2671; card 4539 1488 0343 6467 x"]
    texts += ["Released under the MIT License.\n" + base[8], base[9] + " licensed under the apache license version 2.0"]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(4, base[4]), (4, base[4]), (None, base[0]), (None, "no id here"), (None, None), (1000, base[1] + " more")]
    return rows


def frame(spark, rows):
    full = [(i, t, "en", ["s1", "s0", None, "é", "s2"][k % 5], len(t or ""), *["c"] * 10) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)
