import math
import random
from collections import Counter

import pytest
import texts

from starquay.llm.backoff_scores import _pack, _unpack, backoff_scores


def brute(rows):
    held = {}
    for i, text in rows:
        held.setdefault(i, []).append(texts.words(text))
    pairs = {i: Counter(p for w in ws if w for p in zip(["<s>", *w], [*w, "</s>"])) for i, ws in held.items()}
    firsts = {i: Counter(v for (v, _), n in p.items() for _ in range(n)) for i, p in pairs.items()}
    c_pair, c_first = sum(pairs.values(), Counter()), sum(firsts.values(), Counter())
    total = sum(n for v, n in c_first.items() if v != "<s>")
    out = {}
    for i, own in pairs.items():
        seen = lost = 0
        score = 0.0
        for (v, w), n in own.items():
            others = c_pair[v, w] - n
            if w == "</s>":
                continue
            if others:
                seen += n
                score += n * math.log(others / (c_first[v] - firsts[i][v]))
            else:
                lost += n
                score += n * math.log(0.4 * c_first[w] / total)
        out[i] = (seen + lost, seen, lost, score)
    return out


@pytest.mark.parametrize("partition_bytes", [1 << 24, 3000])
def test_equals_brute_force(spark, partition_bytes):
    rng = random.Random(2)
    rows = list(enumerate([*texts.crowd(groups=3), *("the the of and " + texts.prose(rng, 30, "ab") for _ in range(60))]))
    want = brute(rows)
    got = backoff_scores(texts.documents(spark, rows), partition_bytes=partition_bytes).collect()
    assert len(got) == len(want)
    for r in got:
        n, seen, lost, score = want[r.doc_id]
        assert (r.n_words, r.n_seen, r.n_backed_off) == (n, seen, lost)
        assert r.log_score == pytest.approx(score, rel=1e-9, abs=1e-9)
        assert r.mean_log_score == (pytest.approx(score / n) if n else None)


def test_edges(spark):
    rows = [(1, "a b c"), (1, "a b"), (2, "a b"), (3, None), (4, ""), (None, "a b"), (5, "a b " * 50_000)]
    df = texts.documents(spark, rows).selectExpr("*", "1 as place", "2 as docs", "3 as n_seen", "4 as log_sum")
    got = {r.doc_id: r for r in backoff_scores(df).collect()}
    want = brute([r for r in rows if r[0] is not None])
    assert set(got) == {1, 2, 3, 4, 5}
    assert all(got[i].log_score == pytest.approx(want[i][3]) for i in got)
    assert got[3].n_words == 0 and got[3].log_score == 0 and got[3].mean_log_score is None
    assert backoff_scores(df.where("false")).count() == 0


def test_packed_hashes():
    import numpy as np

    values = np.array([0, 1, (1 << 48) - 1, 123456789012345], np.uint64)
    assert _unpack(_pack(values)).tolist() == values.tolist() and len(_pack(values)) == 24
