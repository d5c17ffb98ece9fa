"""Small documents with every odd case: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for their own columns
        T.StructField("shard", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("quality", T.StringType()),
        T.StructField("lines", T.StringType()),
        T.StructField("tie", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("unit", T.StringType()),
    ]
)


def prose(seed, n):
    """Invented words, the same for a seed."""
    parts, state = [], seed * 7919 + 17
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        word = ""
        for k in range(1 + state % 3):
            word += ["ba", "ke", "lo", "mi", "tu", "ran", "sel", "dor"][(state >> (3 * k + 5)) % 8]
        parts.append(word)
    return " ".join(parts)


LONG = "\n".join(prose(100 + i, 40) for i in range(60))

TEXTS = [
    (1, prose(1, 90)),
    (2, prose(1, 90)),  # a copy
    (3, prose(1, 89) + " other"),  # a near copy
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one"),
    (8, "One TWO\x0bthree\x0cfour \x85   five"),
    (9, "É ÄÖ ß 한국어 日本 🙂 é <|role|>\\l </turn> 12 a1b2 don't"),
    (10, LONG),
    (11, LONG.upper()),
    (12, "x" * 3000),
    (13, "same line here\nsame line here\n\nsame line here\n " + prose(5, 60)),
    (13, prose(6, 70)),  # another document of the same id
    (None, prose(7, 70)),
    (None, None),
    (14, prose(8, 60)),
    (14, prose(8, 60)),  # a repeated row
    (15, prose(9, 30) + "\n" + prose(10, 30) + "\n" + prose(9, 30)),
    (16, prose(9, 30) + " more\n" + prose(10, 29) + "\n" + prose(11, 55)),
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, None, "s", None, "a", "b", "c", "d", "e", "f", "g", "h") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
