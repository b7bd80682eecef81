"""Small awkward tables."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def documents(seed=0, n=60):
    """Nulls, empty and very long texts, copies, near copies, repeated rows, white space, other scripts."""
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.choice([1, 2, 3, 5, 30, 120]))) for i in range(n)]
    base = words(rng, 150).split()
    for k in range(40):  # a group of near copies
        near = list(base)
        for _ in range(rng.randrange(12)):
            near[rng.randrange(len(near))] = f"new{rng.randrange(10**6)}"
        rows.append((1000 + k, " ".join(near)))
    rows += [(2000 + k, "The very same text, word for word, again and again.") for k in range(30)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n\x0b\x0c\r "), (3003, "one"), (3004, "ONE"), (3005, "one two"), (3006, "Été K İx naïve \U0001f600"), (3007, "x " * 30_000), (3008, words(rng, 20_000))]
    rows += [rows[0], rows[0], rows[5]]  # repeated rows
    return rows


def frame(spark, rows, extra=True):
    """A documents table with columns whose names clash with those the operators use inside."""
    full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        for c in ("score", "n", "root", "unit", "part", "key", "kept", "findings", "blob", "_own", "shard", "slot", "spans", "length", "value"):
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)
