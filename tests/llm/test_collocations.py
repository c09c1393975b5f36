import random
import re
from collections import Counter

import pytest
from texts import documents, prose

from starquay.llm import collocations as module
from starquay.llm.collocations import collocations, phrase_counts


def pieces(text):
    folded = re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def counted(rows, longest):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, totals


def brute_force(rows, longest=3, min_count=10, absorbed=(50, 100), top=2000):
    counts, totals = counted(rows, longest)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    found = {}
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        text = " ".join(words)
        longer = [
            b for (other, held), b in candidates.items()
            if other == lang and len(held) > len(words)
            and any(held[i : i + len(words)] == words for i in range(len(held) - len(words) + 1))
        ]
        if not any(absorbed[1] * b >= absorbed[0] * a for b in longer):
            found.setdefault(lang, []).append((-score, -a, text.encode(), a, left, right))
    return sorted(
        (lang, rank, text.decode(), a, left, right, totals[lang], -score)
        for lang, best in found.items()
        for rank, (score, _, text, a, left, right) in enumerate(sorted(best)[:top], 1)
    )


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cé", "ÉX", "d1", "é", "ee", "f\x01", "w" * 40, "漢字"]
    texts, langs = [], []
    for k in range(120):
        words = [rng.choice(vocabulary) if rng.random() < 0.7 else "New York City" for _ in range(rng.randint(0, 60))]
        texts.append("".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "?! "]) for w in words))
        langs.append(rng.choice(["en", "fr", None, ""]))
    return texts + [None, "", " \n. ", "lone"], langs + ["en", None, "fr", "de"]


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("longest, min_count", [(2, 3), (3, 3), (4, 2)])
def test_brute_force(spark, longest, min_count):
    texts, langs = corpus()
    docs = documents(spark, texts, langs)
    expected = brute_force(list(zip(texts, langs)), longest, min_count)
    assert expected and rows_of(collocations(docs, longest, min_count)) == expected


def test_counts_of_all_sizes(spark):
    texts, langs = corpus(8)
    counts, totals = counted(list(zip(texts, langs)), 3)
    found = phrase_counts(documents(spark, texts, langs), 3, 4).collect()
    assert {(r.lang, r.phrase): r.n for r in found if r.size} == {
        (lang, " ".join(words)): n for (lang, words), n in counts.items() if n >= 4
    }
    assert {r.lang: r.n for r in found if not r.size} == {k: n for k, n in totals.items() if n}


def test_small_chunks_ranges_and_hot_beginnings(spark, monkeypatch):
    """Chunks of a few texts and beginnings that are spread give the same rows."""
    texts, langs = corpus(2)
    texts = texts + ["so far " + w for w in prose(random.Random(1), 60).split()] * 3
    langs = langs + ["en"] * (len(texts) - len(langs))
    docs = documents(spark, texts, langs).repartition(5)
    expected = brute_force(list(zip(texts, langs)), 3, 3)
    monkeypatch.setattr(module, "CHUNK_BYTES", 200)
    monkeypatch.setattr(module, "_ranges", lambda size: 7)
    monkeypatch.setattr(module, "HOT_SHARE", 1 / 50)
    assert "en\tso\tfar" in module._hot_heads(docs, 3)
    assert rows_of(collocations(docs, 3, 3)) == expected


def test_ties_top_and_copies(spark):
    texts = ["x y. z q", "x y. z q"] * 10 + ["m n"] * 20
    found = rows_of(collocations(documents(spark, texts), top=2))
    assert found == [("en", 1, "m n", 20, 20, 20, 120, 1000000), ("en", 2, "x y", 20, 20, 20, 120, 1000000)]


def test_counts_beyond_64_bits_of_product(spark):
    score = spark.sql(
        "select (1000000BD * cast(a as decimal(16, 0)) * cast(a as decimal(16, 0)))"
        " div (cast(l as decimal(16, 0)) * cast(r as decimal(16, 0))) as s"
        " from values (3000000000001L, 3000000000007L, 3000000000009L) as t(a, l, r)"
    ).first().s
    assert score == 1000000 * 3000000000001**2 // (3000000000007 * 3000000000009)


def test_empty_and_clashing_columns(spark):
    docs = documents(spark, ["a b c"] * 12)
    assert collocations(docs.limit(0)).collect() == []
    assert collocations(documents(spark, [None, "", "a"])).collect() == []
    clash = docs.selectExpr("*", "1 as n", "2 as w1", "3 as spread", "4 as rank", "'p' as phrase")
    assert rows_of(collocations(clash)) == rows_of(collocations(docs)) != []


def test_heads_come_apart(spark):
    heads = spark.createDataFrame([("a\tb\tx\ty",), ("en\tw\t",), ("\tw\tv",)], "head string")
    found = heads.select(*module._apart(heads["head"], 3)).collect()
    assert [tuple(row) for row in found] == [("a\tb", "x", "y"), ("en", "w", None), ("", "w", "v")]


def test_one_exchange_of_windows(spark):
    """The counts of windows and of their heads come from one exchange by ranges."""
    docs = documents(spark, ["a b c"] * 12)
    windows = module.lead_windows(docs, 3).repartitionByRange(4, "head").groupBy("head", "last").sum("n")
    plan = windows.groupBy("head").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


@pytest.mark.parametrize("held", [1, 50, 1 << 22])
def test_ranges_added_up_in_parts(spark, monkeypatch, held):
    """A range of more windows than a task holds is added up in parts, and nothing rare in a part is lost."""
    texts, langs = corpus(4)
    docs = documents(spark, texts, langs).repartition(6)
    monkeypatch.setattr(module, "CHUNK_BYTES", 300)
    monkeypatch.setattr(module, "HELD_ROWS", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        assert rows_of(collocations(docs, 3, 3)) == brute_force(list(zip(texts, langs)), 3, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_windows_are_read_once(spark, monkeypatch):
    """One reader of the large exchange gives the counts of all sizes."""
    plans = []
    monkeypatch.setattr(module, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    module.phrase_counts(documents(spark, ["a b c"] * 12), 3)
    assert plans[0].count("REPARTITION_BY_NUM") == 1
