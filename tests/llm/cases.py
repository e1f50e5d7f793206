"""Small tables with the awkward rows that every operator must handle."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "sha string, score double, key string, _id long, ids string, shard int, rid long, fp long, t long, h string, path string"
)


def prose(rng, n):
    return " ".join(rng.choice("the of and thing water stone river green light under over small great".split()) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


def texts(seed=5):
    rng = random.Random(seed)
    shared = prose(rng, 150)
    base = [prose(rng, rng.randint(3, 120)) for _ in range(30)]
    out = [None, "", " ", "\n\t ", "a", "Ünïcödé ñ 中文 🙂", "x" * 3000, "ab " * 700, shared, shared, shared, shared + " end", "start " + shared]
    out += [prose(rng, 30) + " " + shared + " " + prose(rng, 30) for _ in range(3)]
    out += base + base[:6] + [base[7].upper(), base[8] + "!"]
    out.append(prose(rng, 9000))  # a long one
    return out


def table(spark, rows=None):
    """``documents`` with extra columns whose names clash with those inside the operators."""
    if rows is None:
        rows = [(i, t) for i, t in enumerate(texts())]
        rows += [(3, rows[30][1]), rows[20], rows[20], (None, "no id here"), (None, None)]
    data = [(i, t, "en", "s", len(t or ""), "sha", 0.5, "k", 1, "ids", 3, 4, 5, 6, "h", "p") for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
