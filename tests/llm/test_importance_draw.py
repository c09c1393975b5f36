import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from texts import documents, prose

from starquay.llm.importance_draw import draw, importance_weights


def tokens(text):
    folded = re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def features(text, order):
    words = tokens(text)
    return [" ".join(words[i : i + size]) for size in range(1, order + 1) for i in range(len(words) - size + 1)]


def brute_force(docs, target, order=1, buckets=10_000, min_words=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = Counter(bucket(f) for _, text in docs for f in features(text, order))
    aim = Counter(bucket(f) for text in target for f in features(text, order))
    S, T = own.total(), aim.total()
    rows = []
    for doc_id, text in docs:
        found = features(text, order)
        weight = sum(
            math.floor(1000 * math.log((aim[b] + 1) * (S + buckets) / ((own[b] + 1) * (T + buckets))))
            for b in map(bucket, found)
        )
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(tokens(text))])
    eligible = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return bag(tuple(r[:5]) for r in rows)


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def texts(seed=4):
    rng = random.Random(seed)
    lines = [prose(rng, rng.randint(0, 9)) for _ in range(12)] + ["Été É2 été", "--", "", "\r", "A-b_c 7"]
    return [
        None, "", "\n\n", "one", *("\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14))) for _ in range(80)),
        prose(rng, 20_000).replace(" a", "\na"),
    ]


def target(spark, found):
    return spark.createDataFrame(list(enumerate(found)), "item_id bigint, text string")


@pytest.mark.parametrize("order, buckets", [(1, 10_000), (1, 7), (2, 10_000), (3, 500)])
def test_brute_force(spark, order, buckets):
    given, aim = texts(), texts(9)[:20]
    found = draw(documents(spark, given), target(spark, aim), order, buckets, percent=30)
    assert bag(found.collect()) == brute_force(list(enumerate(given)), aim, order, buckets, percent=30)


def test_repeated_rows_ids_and_null_ids(spark):
    long = prose(random.Random(2), 40)
    given = [(5, long), (5, long), (5, long + "\nmore"), (None, long), (None, None), (6, long)]
    found = draw(documents(spark, given), target(spark, [long]), percent=70)
    assert bag(found.collect()) == brute_force(given, [long], percent=70)


def test_empty_tables_and_clashing_columns(spark):
    docs = documents(spark, texts())
    none = target(spark, [])
    assert draw(docs.limit(0), target(spark, ["a b"])).collect() == []
    assert bag(draw(docs, none).collect()) == brute_force(list(enumerate(texts())), [])
    clash = docs.selectExpr("*", "1 as rank", "2 as line", "3 as weight", "4 as copies", "5 as row_key", "6 as bucket")
    assert bag(draw(clash, none).collect()) == bag(draw(docs, none).collect())


def test_lines_are_counted_once(spark):
    """A line that many documents hold is one segment."""
    from starquay.llm.importance_draw import _segments

    line = "the same line of words"
    docs = documents(spark, [line + "\nown " + str(k) for k in range(30)] + [line])
    segments = {r.occurrences: r for r in _segments(docs, 1, 100).where("occurrences > 1").collect()}
    assert list(segments) == [31] and segments[31].n_words == 5
    weights = importance_weights(docs, target(spark, [line]))
    assert weights.where("n_words = 7").count() == 30
