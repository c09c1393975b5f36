from collections import Counter, defaultdict

import pytest
import texts

from starquay.llm.pfair_mix import mix_sources, period_slots, whole_weights


def edf(weights):
    """The schedule of one period, step by step."""
    period, done, order = sum(weights.values()), Counter(), []
    for t in range(period):
        ready = [
            (-(-(done[s] + 1) * period // w), s) for s, w in weights.items() if done[s] < w and done[s] * period // w <= t
        ]
        _, s = min(ready)
        order.append((s, done[s], t))
        done[s] += 1
    return sorted(order)


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 2, "c": 4}, {"a": 50, "b": 3, "c": 3, "d": 1, "": 7}])
def test_one_period_is_earliest_deadline_first(spark, weights):
    frame = spark.createDataFrame(list(weights.items()), "source string, weight bigint")
    got = period_slots(frame).select("source", "nth", "slot").collect()
    assert sorted(map(tuple, got)) == edf(weights)
    # Pfair: after every slot each source is within one block of its share.
    period, done = sum(weights.values()), Counter()
    for s, _, t in sorted(edf(weights), key=lambda r: r[2]):
        done[s] += 1
        assert all(abs(done[x] - w * (t + 1) / period) < 1 for x, w in weights.items())


def test_every_row_once_and_deviation_below_one_block(spark):
    sources = [*["hot"] * 3000, *["b"] * 900, *["c"] * 500, *[None] * 100]
    docs = texts.documents(spark, ["same"] * len(sources), sources=sources)
    weights = {"hot": 3, "b": 2, "c": 1}
    rows = mix_sources(docs, weights, block_rows=8, bucket_rows=100).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(sources)))
    assert len({(r.mix_slot, r.mix_place) for r in rows}) == len(rows)
    blocks = {}
    for r in rows:
        blocks.setdefault(r.mix_slot, set()).add((r.mix_source, r.mix_block))
    assert all(len(held) == 1 for held in blocks.values())
    sizes = Counter((r.mix_source, r.mix_block) for r in rows)
    last = {s: max(b for x, b in sizes if x == s) for s, _ in sizes}
    assert all(n == 8 for (s, b), n in sizes.items() if b < last[s])
    # As long as all sources last, shares are kept; slots are then without gaps.
    end = min(max(r.mix_slot for r in rows if r.mix_source == s) for s in last)
    done, share = Counter(), {"hot": 3 / 7, "b": 2 / 7, "c": 1 / 7, "": 1 / 7}
    for slot in range(end + 1):
        ((source, _),) = blocks[slot]
        done[source] += 1
        assert all(abs(done[s] - w * (slot + 1)) < 1 for s, w in share.items())


def test_a_hot_source_is_numbered_in_many_buckets(spark):
    docs = texts.documents(spark, ["x"] * 2000, sources=["hot"] * 2000)
    rows = mix_sources(docs, {"hot": 1}, block_rows=1, bucket_rows=50).collect()
    assert sorted(r.mix_block for r in rows) == list(range(2000))


def test_repeated_rows_clashing_columns_and_repeatable_order(spark):
    docs = texts.documents(spark, [(1, "a"), (1, "a"), (None, None), (2, "b")], sources=["s", "s", None, "t"])
    docs = docs.selectExpr("*", "'x' as mix_slot", "5 as weight", "6 as slot", "7 as nth", "8 as rows", "9 as period")
    twice = [
        sorted((str(r.doc_id), r.mix_source, r.mix_slot, r.mix_place) for r in mix_sources(docs).collect()) for _ in range(2)
    ]
    assert twice[0] == twice[1] and len(twice[0]) == 4
    assert mix_sources(docs).columns.count("mix_slot") == 1


def test_weights_and_empty_table(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 1)], "source string, rows bigint")
    got = {r.source: r.weight for r in whole_weights(sizes, 0.5, 100).collect()}
    assert got == {"a": 97, "b": 3}
    assert mix_sources(texts.documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    docs = texts.documents(spark, ["x"] * 20)
    plan = mix_sources(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_order_of_sources_follows_weights(spark):
    docs = texts.documents(spark, ["x"] * 400, sources=["a", "b"] * 200)
    rows = mix_sources(docs, {"a": 3, "b": 1}, block_rows=10).collect()
    first = defaultdict(int)
    for r in rows:
        if r.mix_slot < 8:
            first[r.mix_source] += 1
    assert dict(first) == {"a": 60, "b": 20}
