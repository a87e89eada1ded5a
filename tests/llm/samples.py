"""Small document tables with the cases that every operator has to define."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that the operators use for columns of their own.
    *[T.StructField(n, T.StringType()) for n in ("key", "lost", "digest", "cls", "chunk", "row", "n_words", "grp", "n_lines", "hit")],
])
VOCABULARY = [a + b + c for a in ("th", "er", "ÉA", "ña", "x1", "Qu") for b in ("on", "ti", "") for c in ("s", "ing", "é")]
PASSAGE = " ".join(f"pass{i} Age{i}" for i in range(30))
LINE = "This line of boilerplate stands in a good many of the documents, word for word."


def table(spark, rows):
    """Documents from (doc_id, text) pairs."""
    full = [(i, t, "en" if i is None or i % 2 else None, f"src{0 if i is None else i % 3}", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame([(*r, *["z"] * 10) for r in full], SCHEMA).repartition(3, "doc_id")


def some_rows(seed=5, n=60):
    """Random texts, exact and near copies, shared lines and passages, odd white space, and the defined cases."""
    rng = random.Random(seed)

    def words(k):
        return [rng.choice(VOCABULARY) for _ in range(k)]

    rows = []
    base = words(80)
    for i in range(n):
        kind = i % 6
        if kind == 0:
            text = " ".join(words(rng.randint(1, 120)))
        elif kind == 1:
            near = list(base)
            for _ in range(rng.randint(0, 2)):
                near[rng.randrange(len(near))] = "edit" + str(rng.randint(0, 99))
            text = " ".join(near)
        elif kind == 2:
            text = "\n".join([" ".join(words(9)), ("  " + LINE + "\t") if i % 4 else LINE.upper(), " ".join(words(30))])
        elif kind == 3:
            text = " ".join(words(rng.randint(0, 20))) + "\t" + PASSAGE + "\x0b " + " ".join(words(15))
        elif kind == 4:
            text = " ".join(words(3) * rng.randint(1, 12))
        else:
            text = "\r\n".join(" ".join(words(rng.randint(0, 12))) for _ in range(4))
        rows.append((i * 7 % 101, text))
    rows += [(500, None), (501, ""), (502, " \n\t \x0c"), (503, "one"), (504, "one two three four"), (505, "one TWO three four")]
    rows += [(600, "same row " * 30), (600, "same row " * 30), (None, PASSAGE), (None, None), (-4, PASSAGE + " and more of it")]
    rows += [(700, " ".join(words(20_000))), (701, " 　 nbsp word   end " * 4), (702, "x" * 5000)]
    return rows
