"""Small documents with what real tables hold: nulls, blanks, copies, ties, long texts and clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, id long"


def texts(n=60, seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "ka lo mi nu re sa".split() for b in "ton ver lia pro ste".split()]
    return [" ".join(r.choice(words) for _ in range(r.randint(12, 60))).capitalize() + "." for _ in range(n)]


def rows():
    base = texts()
    near = base[0].split()
    out = [(i, t, "en", f"s{i % 3}", len(t), 0.5, 1, 7) for i, t in enumerate(base)]
    out += [
        (100, None, None, None, None, None, None, None), (101, "", "en", "s", 0, None, None, None), (102, " \t\n ", None, "s", 3, 1.0, 2, 3),
        (103, base[1], "en", "s", None, None, None, None), (104, base[1], "en", "s", None, None, None, None), (104, base[1], "en", "s", None, None, None, None),
        (None, base[2], "en", "s", None, None, None, None), (None, "a null id", None, None, None, None, None, None), (105, " ".join([*near[:-1], "extra"]), "en", "s", 1, 1.0, 1, 1),
        (106, "word " * 30_000, "en", "s", None, None, None, None), (107, "x" * 200_000, "en", "s", None, None, None, None),
        (108, "All rights reserved. CC-BY and GNU General Public License, version 3; cc by", "en", "s", None, None, None, None),
        (109, "Ünïcödé 漢字かな \u00a0\u2003 ½ ٣ 😀 'll I'm it's\r\n\r\n  end ", "de", "s", None, None, None, None),
        (110, "one two three", "en", "s", None, None, None, None), (111, "One two THREE", "en", "s", None, None, None, None),
    ]
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
