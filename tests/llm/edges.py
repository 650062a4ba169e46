"""A small table with every awkward row, and the plain versions the tests share."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __text string, text_2 string"
RUN = " ".join(f"w{i}" for i in range(30))


def rows():
    out = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One\nTWO\n one "), (6, RUN), (7, RUN), (8, "x " + RUN + " y"),
        (9, "a " * 200), (10, "b " * 30000), (None, RUN + " tail"), (None, "one\nline"), (11, "same text"), (11, "same text"),
        (11, "other text " + RUN), (-5, RUN.upper()), (12, "é É ß   x\x0by\x1cz\nÉ"), (13, RUN), (13, RUN), (14, "\n\n\n"),
    ]
    out += [(100 + i, f"Shared Line  \nown {i}\n\tshared line") for i in range(12)]
    return [(i, t, None if i == 3 else "en", "src", None, "clash", None) for i, t in out]


def frame(spark, some=None, parts=3):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def lower_words(text):
    """The words of the contract that lower-cases A-Z and keeps letters, digits and all beyond ASCII."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
