import numpy as np
import pytest

from starquay.llm.nearest import nearest, probe_order


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")


def vectors(rng, n, d=16):
    base = rng.normal(size=(max(n // 10, 1), d))
    x = (base[rng.integers(0, len(base), n)] + 0.2 * rng.normal(size=(n, d))).astype(np.float32)
    return [(k, x[k].tolist(), 0) for k in range(n)]


def brute(rows, k, every):
    usable = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in usable if j != i and len(w) == len(v))
            out[i] = [(j, d) for d, j in near[:k]]
    return out


def got(df, **parameters):
    out = {}
    for r in sorted(nearest(df, **parameters).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rows = vectors(np.random.default_rng(1), 1500)
    want, found = brute(rows, 10, 10), got(frame(spark, rows), every=10)
    assert set(found) == set(want)
    recall = np.mean([len({j for j, _ in found[q]} & {j for j, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.9
    for q in list(want)[:5]:
        for j, d in found[q]:
            assert d == pytest.approx(np.linalg.norm(np.array(rows[q][1]) - np.array(rows[j][1])), rel=1e-12)


def test_given_parts_of_large_cells(spark):
    rows = vectors(np.random.default_rng(2), 400)
    df = frame(spark, rows)
    assert got(df, every=10, cell_rows=5) == got(df, every=10)


def test_equal_vectors_and_ties(spark):
    """A third of the rows are one vector; ties go to the smaller id, the own row is left out."""
    rows = [(k, [1.0, 2.0], 0) for k in range(300)] + [(k, [1.0, 2.5 + k % 3], 0) for k in range(300, 320)]
    found = got(frame(spark, rows), every=100)
    assert [j for j, _ in found[0]] == list(range(1, 11))
    assert [j for j, _ in found[100]] == list(range(10))
    want = brute(rows, 10, 100)
    assert found[300] == want[300] or set(found[300]) <= set(brute(rows, 400, 100)[300])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.5], None), (2, None, 0), (3, [], 0), (4, [0.0, 0.0], 0), (5, [nan, 1.0], 0),
            (6, [inf, 1.0], 0), (7, [None, 1.0], 0), (None, [1.0, 0.0], 0), (100, [1.0, 0.0, 0.0], 0), (8, [1.0, -0.5], 0), (200, [0.0, 0.0], 0)]
    df = frame(spark, rows).selectExpr("*", "1 as rep", "2 as bucket", "3 as rank", "4 as score", "5 as query_id")
    assert got(df) == {0: [(1, 0.5), (8, 0.5)]}
    assert nearest(df.where("false")).count() == 0
    assert nearest(df.where("vec_id = 0")).count() == 0


def test_doubles_keep_their_precision(spark):
    rows = [(0, [1.0, 1e-9], 0), (1, [1.0, 2e-9], 0)]
    assert got(frame(spark, rows, "double"), width=50.0)[0][0][1] == pytest.approx(1e-9, rel=1e-6)


def test_probes_come_in_order_of_cost():
    order = probe_order(4, 40)
    assert order[0] == () and order[1] == (0,) and len(set(order)) == 40
    assert not any(7 - x in moves for moves in order for x in moves)


def test_outliers_small_tables_and_dimension_groups_get_all_their_rows(spark):
    """Queries far out, and the rows of small dimension groups at other scales, against brute force."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 64))
    x[::50] *= 5
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    rows += [(1000 + k, (1e3 * rng.normal(size=8)).tolist(), 0) for k in range(30)]
    rows += [(1100 + k, (1e-3 * rng.normal(size=5)).tolist(), 0) for k in range(4)]
    df = frame(spark, rows, "double")
    for part, every in ((df, 50), (df.where("vec_id < 4"), 1)):
        ids = {r.vec_id for r in part.select("vec_id").collect()}
        want, found = brute([r for r in rows if r[0] in ids], 10, every), got(part, every=every)
        assert set(found) == set(want)
        assert {q: len(found[q]) for q in want} == {q: len(want[q]) for q in want}
    # Without any cell in common every query goes the exact way.
    want, found = brute(rows, 10, 50), got(df, every=50, width=1e-6)
    assert {q: [j for j, _ in found[q]] for q in want} == {q: [j for j, _ in want[q]] for q in want}
