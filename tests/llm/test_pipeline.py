"""The pipeline on a small corpus, each stage against a plain version of what it decides."""

import random
import re
import sys
from pathlib import Path

import pytest
import texts

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def line(rng):
    return texts.prose(rng, rng.randint(4, 12), "abcdefghijk") + "."


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(folder, documents by id, quality by id, items)."""
    rng, root = random.Random(8), tmp_path_factory.mktemp("corpus")
    items = [texts.prose(rng, 30, "lmnopqrst") for _ in range(4)]
    docs, quality = {}, {}
    for k in range(300):
        docs[k] = "\n".join(line(rng) for _ in range(rng.randint(2, 8)))
        quality[k] = 1
        if k % 6 == 0:
            docs[k] = "\n".join(x.upper().replace(" ", "!!! $$$ ") for x in docs[k].split("\n"))
            quality[k] = 0
        elif k % 10 == 1:
            docs[k] += "\n" + rng.choice(items) + "."
        elif k % 10 == 2:
            docs[k] += f' token = "{rng.getrandbits(160):040x}" end.'
        elif k % 10 == 3 and k > 20:
            docs[k] = docs[k - 10] if k % 20 == 3 else docs[k - 10] + " more"
            quality[k] = quality[k - 10]
    docs[300], docs[301] = None, ""
    sources = ["hot" if k % 3 else f"s{k % 5}" for k in range(302)]
    texts.documents(spark, list(docs.items()), sources=sources).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, q, 0) for k, q in quality.items()], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), docs, quality, items


def step(spark, name, docs, root):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, root)


def by_id(df):
    rows = df.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def given(spark, root):
    return spark.read.parquet(f"{root}/documents.parquet")


def test_stages_and_their_order(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "decontamination", "secrets", "mixture"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality(spark, corpus):
    root, docs, quality, _ = corpus
    kept = step(spark, "quality", given(spark, root), root)
    assert kept.columns == COLUMNS
    ids = set(by_id(kept))
    wrong = [k for k in quality if (k in ids) != bool(quality[k])]
    assert len(wrong) <= 3


def test_near_copies(spark, corpus):
    root, docs, _, _ = corpus
    kept = step(spark, "near_copies", given(spark, root), root)
    assert kept.columns == COLUMNS

    def shingles(text):
        w = texts.words(text)
        return {tuple(w)} - {()} if len(w) < 5 else set(zip(*(w[k:] for k in range(5))))

    sets, root_of = {k: shingles(t) for k, t in docs.items()}, {k: k for k in docs}

    def find(k):
        while root_of[k] != k:
            k = root_of[k]
        return k

    for i in docs:
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((find(i), find(j)))
                root_of[high] = low
    assert set(by_id(kept)) == {k for k in docs if find(k) == k}


def test_decontamination(spark, corpus):
    root, docs, _, items = corpus
    kept = step(spark, "decontamination", given(spark, root), root)
    held = {k for k, t in docs.items() if t and any(i.lower() in re.sub(r"\s+", " ", t.lower()) for i in items)}
    assert kept.columns == COLUMNS and set(by_id(kept)) == set(docs) - held


def test_secrets(spark, corpus):
    root, docs, _, _ = corpus
    masked = by_id(step(spark, "secrets", given(spark, root), root))
    want = {k: t and re.sub(r'token = "[0-9a-f]{40}', "[secret]", t) for k, t in docs.items()}
    assert {k: r.text for k, r in masked.items()} == want
    assert all(r.n_chars == len(r.text) for r in masked.values() if r.text and "[secret]" in r.text)


def test_mixture_keeps_every_row_in_order(spark, corpus):
    root, docs, _, _ = corpus
    rows = step(spark, "mixture", given(spark, root), root).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    order = [(r.mix_slot, r.mix_place) for r in rows]
    assert order == sorted(order) and len(set(order)) == len(order)


def test_run_chains_the_stages(spark, corpus):
    root, docs, _, _ = corpus
    df = corpus_pipeline.run(spark, root)
    assert df.columns[:5] == COLUMNS
    current = given(spark, root)
    for _, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, root)
    assert sorted(map(str, df.collect())) == sorted(map(str, current.collect()))
    assert 100 < df.count() < len(docs)


def test_empty_documents(spark, corpus):
    root, *_ = corpus
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, given(spark, root).where("false"), root).count() == 0, name
