"""Documents with the awkward rows every operator must take, and schemas to build them with."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WIDE = SCHEMA + ", id string, key long, n_words string, keep_id string, hub int, kept string, spans int, label int, row string"


def words(rng, n, size=400):
    return " ".join("".join(rng.choice("abdeilnorstu") for _ in range(2 + rng.randrange(6))) if rng.random() < 0.3 else f"w{rng.randrange(size)}" for _ in range(n))


def documents(seed=1, n=40):
    """Texts with copies, near copies, shared passages, null and empty texts, a long text, repeated rows and a null id."""
    rng = random.Random(seed)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(n)]
    passage = words(rng, 70)
    for k in range(0, n, 7):
        texts[k] = texts[k] + "\n" + passage + " " + words(rng, 5)
    for k in range(1, n, 9):
        w = texts[k].split()
        texts.append(" ".join(w[:-1] + ["changed"]))
        texts.append("  " + texts[k].replace(" ", "\t") + "\n")
    texts += [None, "", " \n\t", "one", "ünïcödé ©", words(rng, 9000), "x" * 5000, "ab" * 900, "", "\x00nul \x7f byte"]
    rows = [(k, t, rng.choice(["en", "de", None]), "src", 0 if t is None else len(t)) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + rows[:3] + [(None, texts[2], "en", "src", 1)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def wide(spark, rows):
    """The same with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "a", 1, "b", "c", 2, "d", 3, 4, "e") for r in rows], WIDE)


def table(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=repr)
