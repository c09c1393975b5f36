"""Personal data: fixed patterns as seeds, and contextual extraction bootstrapped from them.

The fixed patterns find e-mail addresses, IP addresses, card and phone numbers; these spans
always stay. What else looks like one of the kinds (a number without its +, an address
without a dot) is a candidate. The one to three words before a seed or a candidate on its line
are its lexical patterns. Patterns and identifiers are the two sides of a graph, which Spark
scores in rounds: a pattern is trusted as far as what follows it, wherever it occurs in the
corpus, is a trusted identifier of one kind; a candidate as far as its best pattern. Patterns
of high confidence so add identifiers, whose own contexts count in the next round, until no
pattern is added. Every mention of an added identifier is a span.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starquay.llm.filters import bloom, maybe_in
from starquay.llm.words import FOLD, chunks, hashes, mix, raw_bytes, runs
from starquay.staging import stage

# The kinds in order, and the patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAX_PART = 255
CARD_DIGITS = range(16, 20)
PHONE_DIGITS = range(8, 16)

# What may be an identifier although no fixed pattern says so.
_NUMBERS = re.compile(r"[0-9(][\x20().0-9/-]*")
_COLONS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]*+(?::[0-9A-Fa-f]*+){2,}+")
_AROUND = frozenset("<>()[]{}\"',;:!?.")
LIKE_PHONE = range(7, 16)
LIKE_CARD = range(12, 20)

CONTEXT_WORDS = 3
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.5
HELD_PATTERNS = 1 << 19

_U = np.uint64
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[:128] = False
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _WORD_BYTE[_low:_high] = True

Span = tuple[int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    """Goes from one @ to the next: nothing before an @ can match without what follows it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            first = at
            while first > free and text[first - 1] in _LOCAL:
                first -= 1
            if first < at:
                free = domain.end()
                found.append((first, free))
        at = text.find("@", at + 1)
    return found


def _ips(text: str) -> list[Span]:
    parts = lambda m: (p.lstrip("0") for p in m.group().split("."))
    return [m.span() for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= MAX_PART for p in parts(m))]


def _cards(text: str) -> list[Span]:
    found = ((m.span(), _digits(m.group())) for m in _CARD.finditer(text) if m.end() - m.start() >= CARD_DIGITS[0])
    return [span for span, digits in found if len(digits) in CARD_DIGITS and _luhn(digits)]


def _phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if len(_digits(m.group())) in PHONE_DIGITS]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    found = zip(KINDS, (_emails(text), _ips(text), _cards(text), _phones(text)))
    return [(kind, *span) for kind, spans in found for span in spans]


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int, list[str]]]:
    """(start, end, kinds it may be of) of what touches none of ``taken``, in order."""
    found = []
    for m in _NUMBERS.finditer(text):
        if m.end() - m.start() < LIKE_PHONE[0]:
            continue
        value = m.group().rstrip(" ().-/")
        start, end = m.start(), m.start() + len(value)
        if value.startswith("(") and ")" not in value:
            start += 1
        count = len(_digits(value))
        kinds = [kind for kind, like in (("card", LIKE_CARD), ("phone", LIKE_PHONE)) if count in like]
        if kinds:
            found.append((start, end, kinds))
    found += [(*m.span(), ["ip"]) for m in _COLONS.finditer(text) if _digits(m.group())]
    at, free = text.find("@"), 0
    while at >= 0:
        start, end = at, at + 1
        while start > free and not text[start - 1].isspace() and text[start - 1] not in _AROUND - {"."}:
            start -= 1
        while end < len(text) and not text[end].isspace() and text[end] not in _AROUND - {"."} and text[end] != "@":
            end += 1
        free = end
        while end > at + 1 and text[end - 1] in _AROUND:
            end -= 1
        if start < at < end - 1:
            found.append((start, end, ["email"]))
        at = text.find("@", free)
    found.sort()
    kept, last, spans, i = [], 0, sorted(taken), 0
    reach = 0
    for start, end, kinds in found:
        while i < len(spans) and spans[i][0] < end:
            reach = max(reach, spans[i][1])
            i += 1
        if start >= max(last, reach):
            kept.append((start, end, kinds))
            last = end
    return kept


class _Contexts:
    """The words of a few texts, and for each word the hashes of the 1 to CONTEXT_WORDS words
    of its line that end with it; ``valid`` tells which have as many."""

    def __init__(self, texts: pa.Array):
        data, self.offsets = raw_bytes(texts)
        self.data = FOLD[data]
        self.row, self.start, self.end = runs(_WORD_BYTE[self.data], self.offsets)
        self.breaks = np.concatenate([[0], np.cumsum(self.data == 10)])
        line = self.breaks[self.start] if len(self.start) else self.start
        word = hashes(self.data, self.start, self.end) if len(self.start) else np.zeros(0, _U)
        n = len(word)
        self.hash = np.zeros((CONTEXT_WORDS, n), _U)
        self.valid = np.zeros((CONTEXT_WORDS, n), bool)
        total = np.zeros(n, _U)
        for size in range(min(CONTEXT_WORDS, n)):
            total[size:] = mix(total[size:] * _U(3) + word[: n - size])
            self.hash[size] = mix(total + _U(size + 1))
            self.valid[size, size:] = (self.row[size:] == self.row[: n - size]) & (line[size:] == line[: n - size])

    def before(self, row: int, at: int) -> list[dict]:
        """The patterns that end right before byte ``at`` of the text ``row``."""
        place = self.offsets[row] + at
        j = int(np.searchsorted(self.end, place, "right")) - 1
        if j < 0 or self.row[j] != row or self.breaks[self.end[j]] != self.breaks[place]:
            return []
        if place > self.offsets[row] and _WORD_BYTE[self.data[place - 1]]:
            return []
        found = []
        for size in range(CONTEXT_WORDS):
            if self.valid[size, j]:
                words = [self.data[self.start[i] : self.end[i]].tobytes().decode() for i in range(j - size, j + 1)]
                found.append({"pattern": int(self.hash[size, j].view(np.int64)), "words": " ".join(words)})
        return found


_MENTION = (
    "struct<kind: string, fits: array<string>, first: int, last: int, value: string,"
    " contexts: array<struct<pattern: bigint, words: string>>>"
)
_MENTION_TYPE = pa.struct(
    [
        ("kind", pa.string()),
        ("fits", pa.list_(pa.string())),
        ("first", pa.int32()),
        ("last", pa.int32()),
        ("value", pa.string()),
        ("contexts", pa.list_(pa.struct([("pattern", pa.int64()), ("words", pa.string())]))),
    ]
)


def _mentions(text: str, row: int, contexts: _Contexts) -> list[dict]:
    base = base_spans(text)
    taken = [(start, end) for _, start, end in base]
    found = [(kind, [kind], start, end) for kind, start, end in base]
    found += [(None, kinds, start, end) for start, end, kinds in candidates(text, taken)]
    if not found:
        return []
    plain = text.isascii()
    if not plain:
        held = contexts.data[contexts.offsets[row] : contexts.offsets[row + 1]]
        at = np.append(np.flatnonzero((held & 0xC0) != 0x80), len(held))
    return [
        {
            "kind": kind, "fits": kinds, "first": start, "last": end,
            "value": "".join(c for c in text[start:end].lower() if c not in " ()-"),
            "contexts": contexts.before(row, start if plain else int(at[start])),
        }
        for kind, kinds, start, end in found
    ]


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, mentions) of every document, as a table in the shared folder: base spans
    and candidates with their lexical patterns. Tells rows with one doc_id apart by ``row``."""

    def read(batches):
        for batch in batches:
            texts = batch.column(2)
            for first, last in chunks(texts):
                part = texts.slice(first, last - first)
                contexts = _Contexts(part)
                found = [_mentions(t or "", i, contexts) for i, t in enumerate(part.to_pylist())]
                columns = [c.slice(first, last - first) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found, pa.list_(_MENTION_TYPE))], ["row", "doc_id", "mentions"]
                )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return stage(rows.mapInArrow(read, f"row bigint, doc_id {doc_id}, mentions array<{_MENTION}>"), "mentions")


def _occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each pattern occurs in all texts, whatever follows."""
    table = bloom(patterns)

    def told(pattern: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(n)], ["pattern", "total"])

    def count(batches):
        """Adds up over a task, and gives what it has when that is much."""
        pattern, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for first, last in chunks(batch.column(0)):
                contexts = _Contexts(batch.column(0).slice(first, last - first))
                held = contexts.hash[contexts.valid].view(np.int64)
                held = held[maybe_in(table, held)]
                pattern, spot = np.unique(np.concatenate([pattern, held]), return_inverse=True)
                ones = np.concatenate([n, np.ones(len(held), np.int64)])
                n = np.zeros(len(pattern), np.int64)
                np.add.at(n, spot, ones)
                if len(pattern) > HELD_PATTERNS:
                    yield told(pattern, n)
                    pattern, n = pattern[:0], n[:0]
        yield told(pattern, n)

    counted = docs.select("text").mapInArrow(count, "pattern bigint, total bigint")
    # Added up before the join, which then meets each pattern once and not once per chunk. A
    # semi join would be moved below the sum; patterns are distinct, so this gives the same.
    totals = counted.groupBy("pattern").agg(F.sum("total").alias("total"))
    return totals.join(patterns, "pattern")


def bootstrap(
    docs: DataFrame, scanned: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """The learned patterns (pattern, words, kind, confidence) and the identifiers they add
    (value, kind, trust).

    The confidence of a pattern in a kind is the trust in what follows it, summed over its
    occurrences, over all its occurrences in the corpus; it must follow at least
    ``min_support`` different trusted identifiers. Trust in a seed is 1, in a candidate that
    fits the kind the confidence of its best pattern of at least ``min_confidence``. Rounds
    end when no pattern is added. No seeds give no patterns.
    """
    mentions = scanned.select(F.explode("mentions").alias("m")).select("m.*")
    edges = stage(
        mentions.select("kind", "fits", "value", F.explode("contexts").alias("c"))
        .groupBy("c.pattern", "value")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("c.words").alias("words"), F.max("kind").alias("kind"),
            F.first("fits").alias("fits"),
        ),
        "pattern_edges",
    )
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") >= min_support)
    wide = stage(wide.select("pattern"), "patterns")
    totals = stage(_occurrences(docs, wide), "pattern_totals")
    graph = stage(edges.join(totals, "pattern"), "pattern_graph")
    seeds = mentions.where("kind is not null").select("value", "kind").distinct()
    trusted = stage(seeds.withColumn("trust", F.lit(1.0)), "trust")
    seen = -1
    while True:
        follows = graph.drop("kind").join(trusted, "value").groupBy("pattern", "kind", "total")
        patterns = follows.agg(
            F.sum(F.col("n") * F.col("trust")).alias("weight"),
            F.count(F.lit(1)).alias("support"), F.min("words").alias("words"),
        ).select("pattern", "words", "kind", "support", (F.col("weight") / F.col("total")).alias("confidence"))
        patterns = patterns.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
        patterns = stage(patterns.drop("support"), "confident_patterns")
        # A candidate may be of several kinds until the end, so trust never falls.
        added = (
            graph.where("kind is null").select("pattern", "value", "fits").join(patterns, "pattern")
            .where(F.array_contains("fits", F.col("kind")))
            .groupBy("value", "kind").agg(F.max("confidence").alias("trust"))
        )
        added = stage(added, "added_identifiers")
        found = patterns.count()
        if found == seen:
            break
        seen = found
        trusted = seeds.withColumn("trust", F.lit(1.0)).union(added)
    best = Window.partitionBy("value").orderBy(F.desc("trust"), _place(F.col("kind")))
    single = added.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")
    return patterns, single


def _place(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")


def _span(kind: Column, first: Column, last: Column) -> Column:
    return F.struct(_place(kind).alias("place"), first.alias("first"), last.alias("last"), kind.alias("kind"))


def _of_kind(kind: str) -> Column:
    return F.filter("base", lambda span: span["kind"] == kind)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document.

    The counts and the hash are of the base spans; ``spans`` holds the added ones as well,
    as kind:start:end by kind, then start, in code points. A null text is empty, and has no
    spans. Rows that repeat a doc_id, or are equal, are scanned each. No documents give no
    rows. Other columns are not read.
    """
    scanned = scan(docs)
    _, added = bootstrap(docs, scanned)
    open_mentions = scanned.select("row", F.explode("mentions").alias("m")).where("m.kind is null")
    found = open_mentions.select("row", "m.first", "m.last", "m.value").join(added, "value")
    found = found.groupBy("row").agg(
        F.collect_list(_span(F.col("kind"), F.col("first"), F.col("last"))).alias("found")
    )
    seeds = F.filter("mentions", lambda m: m["kind"].isNotNull())
    base = F.transform(seeds, lambda m: _span(m["kind"], m["first"], m["last"]))
    counts = [F.size(_of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    every = F.when(F.col("found").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "found")))
    return (
        scanned.select("row", "doc_id", base.alias("base")).join(found, "row", "left")
        .select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"))
    )
