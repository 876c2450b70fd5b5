"""Documents with every awkward case: nulls, empty and long texts, copies, repeated rows, clashing columns."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, node string, kept string"


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def texts(seed=0):
    rng = random.Random(seed)
    base = prose(rng, 120)
    line = "This common line stands in very many documents 2024"
    out = [None, "", " \n\t\r\x0b\x0c ", "one", "Two words", "é▁  x　y  z\n", " ".join(prose(rng, 4000, 90))]
    for k in range(12):
        out.append(" ".join(base))
        edited = list(base)
        for _ in range(k):
            edited[rng.randrange(len(edited))] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(edited))
    passage = "\n".join(" ".join(prose(rng, 20)) for _ in range(4))
    for k in range(30):
        lines = [" ".join(prose(rng, rng.randrange(5, 30))) for _ in range(rng.randrange(1, 8))]
        if k % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), passage)
        if k % 2 == 0:
            lines.insert(0, line)
        out.append("\n".join(lines))
    out.append("\n".join([" ".join(prose(rng, 30))] * 5))
    out.append("a b c d e f g h " * 6 + "#*$%&|<>")
    return out


def rows(seed=0):
    out = [(i, t, "en", f"s{i % 4}" if i % 7 else None, None, "x", "y", "z", "k") for i, t in enumerate(texts(seed))]
    out += [out[8], out[8], (None, "one", None, None, 1, None, None, None, None),
            (None, "no id here", None, "s1", 1, None, None, None, None)]
    return out


def documents(spark, seed=0, parts=3):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")
