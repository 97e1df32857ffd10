"""Small frames with the hard cases, and plain versions of the operators to compare with."""

import hashlib
import random

#: Names that the operators use inside, as further columns of the input.
CLASHING = ("key", "doc", "h", "a", "b", "bucket", "label", "rank", "runs", "n_words", "score", "lines", "id", "own_id", "class")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def frame(spark, rows, clashing=False):
    """`rows`: (doc_id, text) or (doc_id, text, lang, source)."""
    rows = [(*r, "en", "s")[:4] if len(r) == 2 else r for r in rows]
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit(i) for i, name in enumerate(CLASHING)})
    return df.repartition(3)


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed, n=40, length=150):
    """Texts with copies, near copies, shared passages and the odd cases."""
    rng = random.Random(seed)
    shared = [words(rng, 80) for _ in range(3)]
    rows = []
    for i in range(n):
        own = words(rng, rng.randrange(5, length))
        if rng.random() < 0.5:
            at = rng.randrange(len(own))
            own[at:at] = rng.choice(shared)[rng.randrange(20) :]
        text = "".join(w + rng.choice([" ", " ", "\n", "\t", "  "]) for w in own)
        rows.append((i, text))
        if rng.random() < 0.2:
            rows.append((100 + i, text))
        if rng.random() < 0.3:
            near = list(own)
            near[rng.randrange(len(near))] = "changed"
            rows.append((200 + i, " ".join(near)))
    return [*rows, (500, None), (501, ""), (502, "   \n\t "), (503, None), (None, rows[0][1]), (504, "äö " * 300), (505, "x" * 3000), rows[3], rows[3]]
