"""Small tables with every awkward case, and what brute force makes of them."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns whose names operators might use themselves.
CLASH = "doc_id long, text string, source string, lang string, n_chars long, _d long, _t string, _id string, _text string, _key string, kept string, score string, piece string, slot string, label string, n_words string"


def words_of(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def table(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); the other columns clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else f"s{(r[0] or 0) % 3}", "en", len(r[1] or ""), 7, "t", "i", "x", "k", "no", "high", "p", "s", "l", "w") for r in rows]
    return spark.createDataFrame(full, CLASH).repartition(3)


def corpus(seed=1, n=60, vocabulary=200):
    """Texts with copies, near copies, shared passages and lines, odd white space, other scripts."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(vocabulary)] + ["Été", "straße", "日本", "don't", "a.b"]
    passage = [rng.choice(vocab) for _ in range(70)]
    line = "Common line of all."
    out = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 40, 90, 160]))]
        if i % 4 == 0:
            at = rng.randrange(len(words) + 1)
            cut = rng.randrange(0, 15)
            words[at:at] = passage[cut:]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\t"]) for w in words)
        if i % 5 == 0:
            text = f"{line}\nsecond {i % 2}\n" + text
        if i % 7 == 3 and out:
            text = rng.choice(out)[1]
        if i % 9 == 4 and out:
            old = rng.choice(out)[1].split(" ")
            old[len(old) // 2] = "changed"
            text = " ".join(old).upper() if i % 2 else " ".join(old)
        out.append((i * 3, text))
    return out


#: Nulls, empties, blanks, one word, a very long text, repeated rows.
AWKWARD = [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one"), (1004, "one two"), (1006, "long " * 30_000), (1007, "same text here\nand there"), (1007, "same text here\nand there"), (1009, "x" * 50_000)]
