import hashlib
import random
import re

from texts import documents, prose

from starquay.llm.personal_data import KINDS, base_spans, bootstrap, find_personal_data, scan

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    values = [int(c) for c in digits[::-1]]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


def plain(text):
    """The stated patterns as they stand."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    keep = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": (CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [
        (kind, *m.span()) for kind, (pattern, ok) in keep.items() for m in re.finditer(pattern, text or "") if ok(m)
    ]


PARTS = (
    "a@b.c_d@e.f", "x@y@z.com", "a@b.c.", "@b.c", "é.ü@mail.de", "me+you%x@a-b.co.uk", "1.2.3.4.5.6.7.8", "256.1.1.1",
    "0001.2.3.4", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "4111  1111 1111 1111",
    "+1 (017) 555-7713", "+12", "+123456789012345678", "+1-234-567-89", "+1 2 3 4 5 6 7 8 .", "(555) 123-4567", "漢字", "::1",
    "fe80::1:2", "root@localhost", "-", ".", " ", "\n", "7", "12:30:45",
)


def test_base_spans_are_the_stated_patterns():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) + rng.choice(["", " ", " ", "\n", ".", "-"]) for _ in range(rng.randint(0, 12)))
        assert base_spans(text) == plain(text), text
    for _ in range(3000):
        text = "".join(rng.choice("0123456789.+-@ ()ab_é") for _ in range(rng.randint(0, 60)))
        assert base_spans(text) == plain(text), text


def test_long_runs_take_no_squared_time():
    for unit in ("a", "1", "1.", "1 ", "+1", "a@", "@", "(", "1:", "a.", "+1("):
        base_spans(unit * 200_000)


def planted(seed=1):
    """Seeds and unseen identifiers in the same phrases, and numbers in other places."""
    rng = random.Random(seed)
    texts, unseen = [], {}
    for k in range(60):
        number = f"{rng.randint(100, 999)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}"
        lead = prose(rng, 12) + "\nyou can reach my phone "
        if k % 3:
            texts.append(f"{lead}+1 {number} {prose(rng, 5)}")
        else:
            unseen[k] = ("phone", len(lead), len(lead) + len(number))
            texts.append(f"{lead}{number}, {prose(rng, 5)}")
    for k in range(60, 100):
        lead = prose(rng, 8) + " write an email to "
        name = f"user{k}@host{k % 7}" + (".example.org" if k % 2 else "")
        if k % 2 == 0:
            unseen[k] = ("email", len(lead), len(lead) + len(name))
        texts.append(lead + name + " or " + prose(rng, 9))
    texts += [f"order {rng.randint(10**7, 10**8)} of {prose(rng, 30)} the {rng.randint(10**9, 10**10)}" for _ in range(80)]
    return texts, unseen


def spans_of(row):
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in row.spans.split(",") if s)]


def test_unseen_identifiers_in_learned_contexts(spark):
    texts, unseen = planted()
    found = {r.doc_id: r for r in find_personal_data(documents(spark, texts)).collect()}
    assert len(found) == len(texts)
    for k, text in enumerate(texts):
        base = plain(text)
        row = found[k]
        told = ",".join(f"{kind}:{a}:{b}" for kind, a, b in base)
        assert row.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in KINDS] == [sum(s[0] == kind for s in base) for kind in KINDS]
        assert set(base) <= set(spans_of(row))
        assert set(spans_of(row)) - set(base) == ({unseen[k]} if k in unseen else set()), text


def test_confidence_counts_every_occurrence(spark):
    """A phrase that mostly precedes other words is no pattern; scores as by hand."""
    seeds = [f"call now +1 555 000 100{k}" for k in range(4)]
    docs = documents(spark, seeds + ["call now 555 000 2000"] + ["call now please"] * 20)
    patterns, added = bootstrap(docs, scan(docs))
    assert patterns.count() == 0 and added.count() == 0
    docs = documents(spark, seeds + ["call now 555 000 2000"] + ["call now please"] * 2)
    patterns, added = bootstrap(docs, scan(docs))
    told = {r.words: r for r in patterns.collect()}
    # Rounds: 4 / 7, then (4 + 4 / 7) / 7.
    assert set(told) == {"now", "call now"} and abs(told["call now"].confidence - (4 + 4 / 7) / 7) < 1e-9
    assert [(r.value, r.kind) for r in added.collect()] == [("5550002000", "phone")]


def test_added_identifiers_teach_further_patterns(spark):
    texts = [f"my phone is +1 555 000 10{k:02}" for k in range(8)]
    texts += [f"my phone is 555 000 20{k:02}\nring up 555 000 20{k:02}" for k in range(4)]
    texts += ["ring up 555 000 3000"]
    found = {r.doc_id: spans_of(r) for r in find_personal_data(documents(spark, texts)).collect()}
    assert found[12] == [("phone", 8, 20)]


def test_edges(spark):
    texts = [None, "", "a@b.co", (1, "a@b.co"), (1, "a@b.co"), (None, "é +1 (017) 555-7713"), "x" * 300_000 + " 1.2.3.4"]
    docs = documents(spark, texts)
    rows = find_personal_data(docs).collect()
    assert len(rows) == len(texts) and sum(r.n_email for r in rows) == 3
    assert [r.spans for r in rows if r.doc_id is None] == ["phone:2:19"]
    assert find_personal_data(docs.limit(0)).collect() == []
    clash = docs.selectExpr("*", "1 as row", "2 as mentions", "3 as kind", "4 as value", "5 as found")
    assert sorted(map(repr, find_personal_data(clash).collect())) == sorted(map(repr, rows))
