"""Small document tables with every odd case."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows, extra=False):
    """Rows of (doc_id, text, lang, source) as a documents table; ``extra``
    adds columns whose names the operators use themselves."""
    full = [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        df = df.selectExpr("*", "'x' as size", "1 as score", "2 as n", "'y' as batch", "3 as component_id", "'z' as target")
    return df


def sentence(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def corpus(seed=1, n=40):
    """Documents with shared passages, exact and near copies, blank, null,
    short and long texts, separators of every kind."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    shared = [sentence(rng, 60, vocabulary) for _ in range(3)]
    texts = [None, "", " \t\n ", "one two three", "a", "é ü 日本"]
    for _ in range(n):
        parts = [sentence(rng, rng.randint(3, 120), vocabulary) for _ in range(rng.randint(1, 3))]
        if rng.random() < 0.4:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        texts.append(rng.choice(["\n", " ", "\r\n", "\t"]).join(parts))
    for t in rng.sample([t for t in texts if t and len(t) > 300], 6):
        w = t.split(" ")
        texts += [t, " ".join(w[:-1]), " ".join([*w[:5], "X", *w[6:]]), t.upper()]
    texts.append("ab " * 400)
    texts.append("z" * 3000)
    texts.append(sentence(rng, 4000, vocabulary))
    rng.shuffle(texts)
    return [(i * 3 + 1, t, None, "src%d" % (i % 4) if i % 5 else None) for i, t in enumerate(texts)]
