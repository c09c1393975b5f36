import random
import zlib

import numpy as np
import pyarrow as pa
import texts

from starquay.llm.language_mixture import Model, grams, identify_languages, predict, proportions, train

ALPHABETS = {"xx": "abcdeé", "yy": "efghij", "zz": "klmnoü"}


def corpus(spark, n=300, seed=1):
    rng = random.Random(seed)
    langs = [rng.choice(list(ALPHABETS)) for _ in range(n)]
    rows = [texts.prose(rng, rng.randint(8, 60), ALPHABETS[lang]) for lang in langs]
    return texts.documents(spark, rows, langs), langs


def test_held_out_accuracy_and_columns(spark):
    docs, langs = corpus(spark)
    rows = identify_languages(docs).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) == 1.0


def test_mixtures_are_estimated(spark):
    docs, _ = corpus(spark)
    model = train(docs)
    rng = random.Random(9)
    mixed = f"{texts.prose(rng, 300, ALPHABETS['xx'])} {texts.prose(rng, 100, ALPHABETS['zz'])}"
    _, slot, count = grams(pa.array([mixed]))
    p, kept = proportions(slot, count, model)
    assert [model.languages[k] for k in kept] == ["xx", "zz"]
    assert abs(p[model.languages.index("xx")] - 0.75) < 0.05


def test_em_reaches_the_most_likely_proportions():
    rng = np.random.default_rng(3)
    logs = np.log(rng.dirichlet(np.ones(8), 2).T)
    count = rng.integers(1, 50, 8)
    p, kept = proportions(np.arange(8), count, Model(["a", "b"], logs))
    grid = np.linspace(0, 1, 2001)
    fits = [(count * np.log(np.exp(logs) @ np.array([a, 1 - a]))).sum() for a in grid]
    assert len(kept) < 2 or abs(p[0] - grid[int(np.argmax(fits))]) < 0.02


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    docs, _ = corpus(spark, 80)
    held = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    turned = docs.selectExpr("doc_id", "text", f"case when {held} then 'qq' else lang end as lang", "'s' as source", "0 as n_chars")
    one, other = (sorted(map(tuple, identify_languages(x).collect())) for x in (docs, turned))
    assert one == other


def test_edges(spark):
    docs, _ = corpus(spark, 60)
    odd = texts.documents(
        spark, [(None, "abc"), (900, None), (901, ""), (902, "12 345 !?"), (903, "中文"), (904, "a"), (905, "abc ded " * 40_000), (905, "x")],
        [None, "xx", None, "yy", "yy", None, None, None],
    )
    both = docs.union(odd).selectExpr("*", "1 as lang_pred", "2 as score", "3 as held_out")
    rows = {(r.doc_id, k): r for k, r in enumerate(identify_languages(both).collect())}
    assert len(rows) == 68
    by_id = {i: r for (i, _), r in rows.items()}
    assert [(by_id[k].lang_pred, by_id[k].score) for k in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by_id[903].lang_pred in ALPHABETS and by_id[904].lang_pred in ALPHABETS


def test_nothing_to_learn_and_empty_table(spark):
    docs, _ = corpus(spark, 10)
    blank = docs.withColumn("lang", docs["lang"].substr(9, 1).cast("string")).selectExpr("doc_id", "text", "nullif(lang, '') as lang")
    assert {r.lang_pred for r in identify_languages(blank).collect()} == {"und"}
    assert identify_languages(docs.where("false")).count() == 0


def test_grams_stay_in_words_and_texts():
    row, slot, count = grams(pa.array(["ab", "AB", "a b", None, "É"]))
    by_row = [sorted(zip(slot[row == k], count[row == k])) for k in range(5)]
    assert by_row[0] == by_row[1] != by_row[2] and by_row[3] == []
    assert by_row[4] == sorted(zip(*grams(pa.array(["é"]))[1:]))
    assert predict(pa.array(["ab"]), Model([], np.zeros((1, 0))))[0] == ["und"]
