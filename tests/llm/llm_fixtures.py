"""Small tables with odd rows, and plain word splitting."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def lower(text):
    return (text or "").translate(LOWER)


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, lang="en", source="s"):
    """Documents numbered from 0, with the columns of the table."""
    rows = [
        (i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENT)


def odd_texts(seed=0):
    """Null, empty, word-less and long texts, ties, repeats, and texts that share passages."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Ba", "né", "xu", "To", "ß") for b in "abcdefghij"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = [None, "", " \n\t ", "...", "one", "One", " ".join(passage), " ".join(passage)]
    for _ in range(30):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 13, 14, 60]))]
        if rng.random() < 0.5:
            at = rng.randrange(len(words))
            cut = rng.randrange(0, 25)
            words[at:at] = passage[cut : cut + rng.choice([5, 12, 13, 14, 20])]
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    texts += [texts[-1], texts[-2] + " more", "w " * 40_000]
    return texts
