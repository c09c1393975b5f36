"""Small texts with the edges every operator must take."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    folded = re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def prose(rng, n, names="abcdefgh"):
    return " ".join("".join(rng.choice(names) for _ in range(rng.randint(1, 6))) for _ in range(n))


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else "x" + w for w in text.split())


def documents(spark, texts, langs=None, sources=None):
    """doc_id from 0, unless a text is an (id, text) pair."""
    rows = []
    for k, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (k, text)
        lang = langs[k] if langs else "en"
        source = sources[k] if sources else f"s{k % 3}"
        rows.append((doc_id, text, lang, source, len(text) if text else None))
    return spark.createDataFrame(rows, SCHEMA)


def crowd(seed=3, groups=6):
    """Groups of edited copies, exact copies, short and empty texts, and a very long one."""
    rng = random.Random(seed)
    texts = [None, "", "  \n\t ", "One", "one", "two words", "Two  words", "a b c", "A B\nC"]
    for _ in range(groups):
        base = prose(rng, rng.randint(20, 120))
        texts += [base, base] + [edited(rng, base, rng.choice([0, 0.01, 0.02, 0.05])) for _ in range(8)]
    texts.append(prose(rng, 30_000))
    return texts
