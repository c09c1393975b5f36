import random

import pytest
import texts

from starquay.llm import jaccard_join
from starquay.llm.components import components
from starquay.llm.jaccard_join import jaccard_components, one_per_component


def shingles(text, size):
    w = texts.words(text)
    return {tuple(w)} - {()} if len(w) < size else set(zip(*(w[k:] for k in range(size))))


def brute(rows, size, num, den):
    """(id, set size) -> component by all pairs."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted((i, len(s), find(i)) for i, s in sets)


def found(df, *args, **parameters):
    rows = [tuple(r) for r in jaccard_components(df, *args, **parameters).collect()]
    return sorted(rows, key=lambda row: [(x is None, x or 0) for x in row])


@pytest.mark.parametrize("size, threshold", [(3, (9, 10)), (5, (4, 5)), (1, (1, 2))])
def test_equals_all_pairs(spark, size, threshold):
    rows = list(enumerate(texts.crowd()))
    df = texts.documents(spark, rows)
    assert found(df, size, threshold) == brute(rows, size, *threshold)


@pytest.mark.parametrize("sets", [2, 7])
def test_large_regions_are_cut_without_losing_a_link(spark, sets):
    rng = random.Random(1)
    base = texts.prose(rng, 80)
    rows = list(enumerate(texts.edited(rng, base, s / 400) for s in range(60)))
    df = texts.documents(spark, rows)
    assert found(df, region_sets=sets) == brute(rows, 3, 9, 10)


def test_regions_are_joined_by_rings(spark):
    """Chains of documents, each near the next only, in one region."""
    w = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(w[4 * k : 4 * k + 100])) for k in range(60)]
    assert found(texts.documents(spark, rows)) == brute(rows, 3, 9, 10)


def test_exactly_at_the_threshold(spark):
    """Sets of 19 and 19 with 18 in common have 18 / 20, with 17 in common less."""
    w = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(w[:21])), (2, " ".join([*w[:20], "z"])), (3, " ".join([*w[:19], "y", "z"]))]
    assert found(texts.documents(spark, rows)) == [(1, 19, 1), (2, 19, 1), (3, 19, 3)]
    assert found(texts.documents(spark, rows), 3, (91, 100)) == [(1, 19, 1), (2, 19, 2), (3, 19, 3)]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "x y z q"), (9, "x y z q"), (None, "a b c d"), (7, None)]
    df = texts.documents(spark, rows).selectExpr("*", "1 as n", "2 as rep", "3 as region", "text as keys")
    assert sorted(found(df), key=str) == sorted(
        [(5, 2, 5), (5, 2, 5), (5, 2, 5), (9, 2, 5), (None, 2, None), (7, 0, 7)], key=str
    )
    kept = one_per_component(df, 3, (9, 10))
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["5", "7", "None"]


def test_empty_table(spark):
    assert found(texts.documents(spark, [])) == []


def test_components_of_long_paths(spark):
    links = [(k + 1, k) for k in range(100, 160)] + [(7, 9), (9, 7), (3, 3), (None, 4)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == {**{k: 100 for k in range(100, 161)}, 7: 7, 9: 7}


def test_images_are_never_farther_than_the_sets():
    rng = random.Random(2)
    import numpy as np

    for size in (50, 3000):
        a = np.array([rng.getrandbits(64) for _ in range(size)], np.uint64)
        b = np.concatenate([a[size // 10 :], np.array([rng.getrandbits(64) for _ in range(size // 12)], np.uint64)])
        x, y = (jaccard_join._counts(jaccard_join._image((v >> np.uint64(55)).view(np.int64))) for v in (a, b))
        both = len(set(a.tolist()) & set(b.tolist()))
        assert np.minimum(x, y).sum() / np.maximum(x, y).sum() >= both / (len(a) + len(b) - both)
