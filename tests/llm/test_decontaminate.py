import random

import pyarrow as pa
import texts

from starquay.llm import decontaminate
from starquay.llm.decontaminate import clean_documents, contaminated

QUESTION = "Well, the farmer Anna has 12 apples and sells 3 of them for 12 euros to Peter on a sunny morning."
OTHERS = "Well, the farmer Berta has 15 apples and sells 4 of them for 15 euros to Klaus on a sunny morning."
BROKEN = "Well, the farmer Berta has 15 apples and sells 4 of them for 7 euros to Berta on a sunny morning."


def items(spark, *rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def found(docs, benchmark, **parameters):
    return {(r.doc_id, r.item_id): r for r in contaminated(docs, benchmark, **parameters).collect()}


def test_copies_and_exchanged_values(spark):
    docs = texts.documents(spark, [(1, QUESTION), (2, f"Some words before. {OTHERS} And some after."), (3, BROKEN), (4, "no such text")])
    got = found(docs, items(spark, (9, QUESTION)), min_consistency=0.9)
    assert set(got) == {(1, 9), (2, 9)}
    assert not got[1, 9].reparameterised and got[1, 9].coverage == 1.0
    assert got[2, 9].reparameterised and got[2, 9].consistency == 1.0
    # Two values of the item became others in one place than in the next.
    assert (3, 9) in found(docs, items(spark, (9, QUESTION)), min_consistency=0.5)


def test_passages_inside_documents_are_found_and_no_others(spark):
    rng = random.Random(4)
    bench = [texts.prose(rng, rng.randint(9, 60)) for _ in range(12)]
    docs = [texts.prose(rng, rng.randint(1, 80)) for _ in range(80)]
    planted = {}
    for k in range(0, 80, 5):
        item = rng.randrange(12)
        cut = rng.randint(0, 30)
        w = docs[k].split()
        docs[k] = " ".join([*w[:cut], bench[item], *w[cut:]]).replace(" ", rng.choice([" ", "  ", "\n"]))
        planted[k] = item
    got = found(texts.documents(spark, docs), items(spark, *enumerate(bench)))
    assert set(got) == set(planted.items())


def test_capitals_around_a_passage(spark):
    passage = "Élan vital and the long way over those hills to that river in a cold spring of old"
    docs = texts.documents(spark, [f"it said {passage} then", passage.upper(), passage.lower()])
    assert set(found(docs, items(spark, (1, passage)))) == {(0, 1), (1, 1), (2, 1)}


def test_edges(spark):
    docs = texts.documents(
        spark, [(1, None), (2, ""), (None, QUESTION), (3, QUESTION), (3, QUESTION), (4, "two words"), (5, "..."), (6, QUESTION * 3000)]
    ).selectExpr("*", "1 as item_id", "2 as id", "text as slots", "3 as at")
    bench = items(spark, (8, None), (7, ""), (6, "Two words"), (5, QUESTION), (4, QUESTION), (None, QUESTION), (2, "..."))
    got = found(docs, bench)
    # Items of one text are the one of the smallest id; a repeated row gives one result.
    assert set(got) == {(3, 4), (4, 6), (6, 4)}
    clean = clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.select("doc_id").collect()) == ["1", "2", "5", "None"]


def test_empty_tables(spark):
    docs, bench = texts.documents(spark, [QUESTION]), items(spark, (1, QUESTION))
    assert contaminated(docs.where("false"), bench).count() == 0
    assert contaminated(docs, bench.where("false")).count() == 0


def test_questions_dense_in_values(spark):
    train = "A train travels 120 km in 2 hours and 180 km in 3 hours"
    docs = [
        "A train travels 90 km in 5 hours and 70 km in 4 hours", f"First. {train}. Then more.",
        "Say, a train travels 90 miles in 5 hours and 70 miles in 4 hours.", "A plane flies 120 km in 2 hours and 180 km in 3 hours",
        "12 km in 3 hours 14 km in 4 hours 15 km in 6 hours 19 km in 9 hours and on", "",
    ]
    got = found(texts.documents(spark, docs), items(spark, (1, train)))
    assert {0, 1, 2} <= {d for d, _ in got} and not {4, 5} & {d for d, _ in got}
    assert got[0, 1].reparameterised and not got[1, 1].reparameterised


def test_names_of_other_lengths_and_inserted_words(spark):
    item = "Yesterday the young farmer Anna sold 12 apples to the baker Peter for 30 euros at the old market near the river"
    docs = [
        item.replace("Anna", "Mary Jane").replace("Peter", "John Paul Smith"), item.replace("to the", "gladly to the"),
        item.replace("apples", "big red apples"), "Yesterday the young farmer went home",
    ]
    got = found(texts.documents(spark, docs), items(spark, (1, item)))
    assert {d for d, _ in got} == {0, 1, 2}


def test_items_of_one_template_are_one_class(spark):
    ask = "A shop sells {} red pens at {} euros each and gives back {} euros so how many pens does it sell".format
    bench = [(k + 5, ask(k + 2, 3 * k + 1, k + 100)) for k in range(40)]
    docs = [ask(k + 7000, k + 8000, k + 9000) for k in range(50)]
    got = contaminated(texts.documents(spark, docs), items(spark, *bench)).collect()
    assert sorted((r.doc_id, r.item_id, r.n_items) for r in got) == [(k, 5, 40) for k in range(50)]
    # Values that repeat in other places make another class.
    twice = items(spark, (1, ask(4, 4, 9)), (2, ask(4, 5, 9)), (3, ask(6, 6, 7)))
    got = {(r.item_id, r.n_items) for r in contaminated(texts.documents(spark, [ask(8, 8, 1)]), twice).collect()}
    assert (1, 2) in got


def test_items_with_few_words_keep_their_values(spark):
    bench = items(spark, (1, "What is 3 + 5"), (2, "12 km in 3 hours"))
    got = found(texts.documents(spark, ["So what is 3 + 5 then", "what is 4 + 5", "12 km in 3 hours", "13 km in 3 hours"]), bench)
    assert set(got) == {(0, 1), (2, 2)}


def brute_force(docs, bench, window=8, drift=4):
    """Pairs by looking at all pairs of windows of all documents and items."""

    def tokens(text):
        _, token, value, slot = decontaminate.template(pa.array([text]))
        return list(zip(token.tolist(), value.tolist(), slot.tolist()))

    pairs = set()
    for i, item in enumerate(bench):
        own = tokens(item)
        size = min(window, len(own))
        literal = [k for k, t in enumerate(own) if not t[2]]
        places = [a for a in range(len(own) - size + 1) if any(not t[2] for t in own[a : a + size])]
        for d, doc in enumerate(docs):
            held = tokens(doc)
            met = {}
            for b in range(len(held) - size + 1):
                part = held[b : b + size]
                if all(t[2] for t in part):
                    continue
                for a in places:
                    like = own[a : a + size]
                    same = [t[0] for t in part] == [t[0] for t in like]
                    lead = part[0][0] == int(decontaminate._NAME) and [part[0][1], *(t[0] for t in part[1:])] == [t[0] for t in like]
                    if same or lead:
                        values = {(x[1], y[1]) for x, y in zip(like, part) if x[2]}
                        at, seen = met.setdefault(b - a, (set(), set()))
                        at.add(a)
                        seen |= values
            groups = []
            for shift in sorted(met):
                if not groups or shift - groups[-1][0] > drift:
                    groups.append([shift, set(), set()])
                groups[-1][0] = shift
                groups[-1][1] |= met[shift][0]
                groups[-1][2] |= met[shift][1]
            for _, at, values in groups:
                covered = sum(any(a <= k < a + size for a in at) for k in literal)
                left = len({x for x, _ in values})
                even = not values or left / len(values) >= 0.8
                wide = len(at) + size - 1 >= 13 or len(at) / len(places) >= 0.5
                plain = all(x == y for x, y in values)
                if even and wide and covered >= min(5, len(literal)) and (len(literal) >= 5 or plain):
                    pairs.add((d, i))
    return pairs


def test_all_pairs_of_windows(spark):
    rng = random.Random(14)
    vocabulary = ["the", "Anna", "Peter", "Lee", "sold", "to", "km", "hours", "and", "12", "3", "7.5", "apples", "in", "red"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = sorted({text(rng.randint(3, 30)) for _ in range(25)})
    docs = []
    for _ in range(60):
        words = f"{text(rng.randint(0, 20))} {rng.choice(bench)} {text(rng.randint(0, 20))}".split()
        docs.append(" ".join(rng.choice(vocabulary) if rng.random() < 0.06 else w for w in words))
    # Items of one class would be found as one; these are all of their own.
    rows = contaminated(texts.documents(spark, docs), items(spark, *enumerate(bench))).collect()
    assert all(r.n_items == 1 for r in rows)
    assert {(r.doc_id, r.item_id) for r in rows} == brute_force(docs, bench)
