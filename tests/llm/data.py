"""Small fixtures with the odd cases every operator must handle."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, __id string, score string, token string, n string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def odd_documents(seed=1, n=60):
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows, clashing column names."""
    rng = random.Random(seed)
    shared = words(rng, 120)
    texts = [words(rng, rng.randint(1, 200)) for _ in range(n)]
    texts += [texts[0], texts[0] + " ", texts[1].replace(" ", "\n\t"), None, "", " \n", "A", "a", "É", "x\x0by z"]
    texts += [f"{words(rng, 30)} {shared} {words(rng, 20)}" for _ in range(6)]
    base = texts[4].split() + words(rng, 150).split()
    for k in range(12):
        near = list(base)
        for _ in range(k % 5):
            near[rng.randrange(len(near))] = words(rng, 1)
        texts.append(" ".join(near))
    texts += ["ab " * 900, "z" * 5000, words(rng, 4000), "\x00" * 450, "mit license " * 30]
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, 0, "clash", "clash", "clash", "clash") for i, t in enumerate(texts)]
    rows.append(rows[3])  # a repeated row
    rows.append((None, "no id at all", None, None, None, None, None, None, None))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, DOCS).repartition(parts)
