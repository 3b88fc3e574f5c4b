"""Rows that every operator has to take: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "key body fp node part nth rank size shard slot score keep y k at label n windows text_score base spans wanted own_key row group bands band x a b length start piece contaminated u v m root component".split()
WORDS = "the quiet river runs past old stone mills and narrow bridges where people once carried grain to market every week before winter came".split()


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


def rows() -> list[tuple]:
    long = " ".join(sentence(s, 400) for s in range(60))
    plain = [(i, sentence(i, 40 + i), "en", "a", 100 + i) for i in range(12)]
    near = sentence(3, 200)
    return [
        *plain,
        (20, None, None, None, None),
        (21, "", "en", "a", 0),
        (22, " \n\t ", "en", None, 4),
        (None, "no key here at all", None, "b", 18),
        (23, long, "en", "b", len(long)),
        (24, "x" * 70_000, "en", "b", 70_000),
        (25, near, "en", "b", 900), (26, near, "fr", "c", 900), (27, near + " end", "en", "b", 904), (28, near.upper(), "en", "b", 900),
        (29, "one two", "en", "b", 7), (29, "one two", "en", "b", 7), (30, "word", "en", "b", 4), (30, "other", "en", "b", 5),
        (31, "Grüße – naïve ünïcode ﬁne 東京 ́ <|endoftext|> A. B", "de", "b", 40),
    ]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCUMENTS).repartition(3)


def crowded(df):
    """With other columns of every name that an operator might use inside."""
    return df.select("*", *[F.lit("other").alias(c) for c in CLASHING if c not in df.columns])


def same_rows(a, b) -> bool:
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
