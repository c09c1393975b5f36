import random
import zlib

import numpy as np
import pyarrow as pa
import texts

from starquay.llm import line_quality
from starquay.llm.line_quality import line_features, score_quality, score_texts, train


def marginals(score, steps):
    """P(good) of each line by summing over all sequences of states."""
    n, good, total = len(score), np.zeros(len(score)), 0.0
    for code in range(2**n):
        states = [(code >> k) & 1 for k in range(n)]
        weight = np.exp(sum(score[k] * states[k] for k in range(n)) + sum(steps[a][b] for a, b in zip(states, states[1:])))
        total += weight
        good += weight * np.array(states)
    return good / total


def test_forward_backward_equals_all_sequences():
    rng = np.random.default_rng(1)
    offsets = np.array([0, 3, 3, 10, 11])
    score, steps = rng.normal(size=11), rng.normal(size=(2, 2))
    good, _ = line_quality._marginals(score, offsets, steps)
    for a, b in zip(offsets, offsets[1:]):
        assert np.allclose(good[a:b], marginals(score[a:b], steps))


def corpus(spark, n=400, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        lines = [texts.prose(rng, rng.randint(3, 12)) + "." for _ in range(rng.randint(1, 6))]
        good = rng.random() < 0.7
        if not good:
            lines = [rng.choice([" ".join([line.split()[0]] * 9), line.upper() + "!!! $$$ %%%"]) for line in lines]
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(good)))
    return texts.documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int"), dict(labels)


def test_held_out_documents_are_told_apart(spark):
    docs, labels, truth = corpus(spark)
    rows = score_quality(docs, labels).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels, truth = corpus(spark, 60)
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    one, other = (sorted(map(tuple, score_quality(docs, x).collect())) for x in (labels, turned))
    assert one == other


def test_edges(spark):
    _, labels, _ = corpus(spark, 60)
    docs, _, _ = corpus(spark, 60)
    long = "\n".join(f"line {k} of a long text." for k in range(20_000))
    odd = texts.documents(spark, [(None, "x"), (100, None), (101, ""), (102, "\n\n \n"), (103, long), (103, long)])
    both = docs.union(odd).selectExpr("*", "1 as score", "2 as predicted", "3 as held_out", "4 as quality")
    noisy = labels.union(labels).union(spark.createDataFrame([(None, 1), (5, None)], labels.schema))
    rows = score_quality(both, noisy).collect()
    assert len(rows) == 66 and all(0 <= r.score <= 1 for r in rows)
    kept = score_quality(both, noisy, keep=True)
    assert sorted(kept.columns) == sorted(both.columns)
    empty = {r.score for r in rows if r.doc_id in (100, 101)}
    assert len(empty) == 1


def test_empty_tables(spark):
    docs, labels, _ = corpus(spark, 20)
    assert score_quality(docs.where("false"), labels).count() == 0
    rows = score_quality(docs, labels.where("false")).collect()
    assert len(rows) == 20 and len({round(r.score, 6) for r in rows}) == 1


def test_neighbouring_lines_matter(spark):
    docs, labels, _ = corpus(spark)
    field = train(docs, labels)
    good = "some plain words of a sentence."
    bad = "SOME!!! $$$ %%% SOME!!! $$$"
    mild, harsh = score_texts(pa.array([f"{good}\n{good}\n{good}", f"{bad}\n{good}\n{bad}"]), field)
    assert mild > 0.8 and harsh < 0.3


def test_features_are_of_whole_lines():
    lines = line_features(pa.array(["A b\n\nA b", None, "x x x"]))
    assert lines.offsets.tolist() == [0, 2, 2, 3] and lines.size.tolist() == [3, 3, 5]
    assert lines.features[:, 10].tolist() == [0, 1, 0]  # the second line repeats the first
