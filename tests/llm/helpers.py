"""Small inputs with every odd case, and brute-force reference versions."""

import random
import re
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, size string, score string, block string, text_ string"


def words(rng, n, vocabulary=400):
    return " ".join("".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
                    if rng.random() < 0.5 else f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_documents(spark, seed=1, n=60):
    """Random texts with copies, near copies, shared passages, nulls in any
    column, empty and long texts, repeated rows, a doc_id with two texts, and
    extra columns with names that the operators use inside."""
    rng = random.Random(seed)
    passage = words(rng, 70)
    texts = [words(rng, rng.randint(3, 120)) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1] + " more words", texts[2].replace("a", "A")]
    near = texts[3].split()
    for k in (1, 2, 5):
        t = list(near)
        for _ in range(k):
            t[rng.randrange(len(t))] = "changed"
        texts.append(" ".join(t))
    texts += [words(rng, 30) + " " + passage + " " + words(rng, 20) for _ in range(4)]
    texts += ["", "   \n\t ", "one", "one two three four", "ÉÀ ünï çödé " * 30, words(rng, 6000), "x" * 3000, "日本語のテキスト" * 40]
    rows = [(i * 3, t, "en", ("b", "a", "é", None)[i % 4], len(t), i, "s", "t", "u", "v") for i, t in enumerate(texts)]
    rows += [(None, texts[0], None, None, None, None, None, None, None, None), (None, None, "en", "a", 0, 1, "", "", "", ""),
             (10_000, None, None, "b", None, None, None, None, None, None)]
    rows += [rows[5], rows[5], (rows[6][0], texts[7], "en", "a", 5, 1, "", "", "", "")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCS)


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def shingle_set(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def held_out(doc_id, folds, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold
