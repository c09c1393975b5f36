"""Stupid-backoff scores of documents under the bigram counts of all other documents.

S(w | v) = c(v w) / c(v) if that bigram occurs in another document, else 0.4 * c(w) / N. Counts
of bigrams and of their first words leave the scored document out; c(w) and N are of the
whole corpus. A document begins with a start mark, so its first word has a context too.

The tables of counts are partitioned by the hash of the first word, which puts c(v w) and
c(v) into one partition, and the documents' bigrams are sent there. What is not found
goes on to the partition of its last word, where c(w) is. Words travel as 48-bit hashes,
packed into one row per document chunk and partition; a document's logs are summed in
every partition, and the sums are added up per document.

Words with a large share of the corpus are told by counts of words in hash slots. The
bigrams that begin with one are dealt to several places by their second word, so no
partition holds all of them. What c(v) takes off their scores is then asked for in the
partition of the word, where the counts of its places meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquay.llm.words import chunks, mix, words
from starquay.staging import stage

BACKOFF = 0.4
PARTITION_BYTES = 12 << 20
SLICES = 32
STRETCH = 1 << 18
SLOTS = 1 << 16  # in which words are counted

_U = np.uint64
_MASK = _U((1 << 48) - 1)
_START, _STOP = _U(0), _U(1)  # marks; hashes of words are 2 or more


def _pack(values: np.ndarray) -> bytes:
    """Six bytes each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(_U).ravel()


def _place(values: np.ndarray, parts: int) -> np.ndarray:
    return (mix(values) % _U(parts)).view(np.int64)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first row does."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _places_of(values: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """In how many places the bigrams of a first word are dealt."""
    return spread[(values & _U(len(spread) - 1)).view(np.int64)]


def _dealt_by(first: np.ndarray, second: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """What deals out a bigram: its first word, and if that is hot, one of its places."""
    places = _places_of(first, spread)
    return np.where(places > 1, mix(first * _U(3) + mix(second) % places), first)


_BIGRAMS = "place bigint, docs binary, firsts binary, first binary, seconds binary, second binary"


def _bigram_rows(
    ids: np.ndarray, row: np.ndarray, first: np.ndarray, second: np.ndarray, parts: int, spread: np.ndarray
):
    """A row per partition: documents, how many first words each has, the first words, how many
    second words each of those has, and the second words."""
    place = _place(_dealt_by(first, second, spread), parts)
    order = np.lexsort((second, first, row, place))
    place, row, first, second = (x[order] for x in (place, row, first, second))
    cuts = np.flatnonzero(_runs(place))
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(place)]):
        r, v = row[a:b], first[a:b]
        new_v = np.flatnonzero(_runs(r, v))
        new_d = np.flatnonzero(_runs(r[new_v]))
        out.append(
            (
                int(place[a]),
                _pack_ids(ids[r[new_v][new_d]]),
                np.diff([*new_d, len(new_v)]).astype("<u4").tobytes(),
                _pack(v[new_v]),
                np.diff([*new_v, b - a]).astype("<u4").tobytes(),
                _pack(second[a:b]),
            )
        )
    return out


def _column(table: pa.Table, name: str) -> list[bytes]:
    return table.column(name).to_pylist()


def _ints(parts: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _pack_ids(ids: np.ndarray) -> bytes:
    """As differences, which are small and compress well where ids are dense."""
    return np.diff(ids, prepend=np.int64(0)).tobytes()


def _ids(table: pa.Table) -> np.ndarray:
    parts = [np.cumsum(np.frombuffer(p, "<i8")) for p in _column(table, "docs")]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _hashes(table: pa.Table, name: str) -> np.ndarray:
    return _unpack(b"".join(_column(table, name)))


_SCORED = "place bigint, kind int, docs binary, counts binary, hashes binary, logs binary"
_SEEN, _ASKED, _KNOWN, _BEFORE = 0, 1, 2, 3


def _score_slice(doc: np.ndarray, v: np.ndarray, second: np.ndarray, spread: np.ndarray, sums):
    """Add the bigrams found elsewhere to ``sums``, their number and logs by document. Returns the
    last words of the others and their documents; the first words and their counts; and, of
    documents and hot first words, how many bigrams were found and how many there are."""
    names, v = np.unique(v, return_inverse=True)
    hot_name = _places_of(names, spread) > 1
    c_v = np.bincount(v, minlength=len(names))
    order = np.lexsort((doc, v))
    starts = np.flatnonzero(_runs(v[order], doc[order]))
    times = np.diff([*starts, len(v)])
    own_v = np.empty(len(v), np.int64)
    own_v[order] = np.repeat(times, times)
    group = np.empty(len(v), np.int64)
    group[order] = np.repeat(np.arange(len(starts)), times)
    pair = mix(mix(v.astype(_U)) * _U(3) + second)
    of_group = order[starts]
    order = np.lexsort((doc, pair))
    sorted_pair, sorted_doc = pair[order], doc[order]
    total_times = np.diff([*np.flatnonzero(_runs(sorted_pair)), len(pair)])
    c_pair = np.repeat(total_times, total_times)
    new = np.flatnonzero(_runs(sorted_pair, sorted_doc))
    own = np.diff([*new, len(pair)])
    at = order[new]  # one entry per document and distinct bigram, ``own`` times
    others = c_pair[new] - own
    scored = second[at] != _STOP
    seen = scored & (others > 0)
    below = np.where(hot_name[v[at]], 1, np.maximum(c_v[v[at]] - own_v[at], 1))
    logs = own[seen] * np.log(others[seen] / below[seen])
    found, total = sums
    found += np.bincount(doc[at][seen], own[seen], len(found)).astype(np.int64)
    total += np.bincount(doc[at][seen], logs, len(total))
    lost = scored & ~seen
    n_found = np.bincount(group[at][seen], own[seen], len(starts)).astype(np.int64)
    hot = hot_name[v[of_group]]
    return (
        np.repeat(second[at][lost], own[lost]),
        np.repeat(doc[at][lost], own[lost]),
        names,
        c_v,
        doc[of_group][hot],
        names[v[of_group][hot]],
        n_found[hot],
        times[hot],
    )


def _score_bigrams(parts: int, spread: np.ndarray):
    """In the partition of a bigram: sums of those found elsewhere, the second words of the
    others, the hot first words, and the counts of the first words, each by the partition
    of the word."""

    def score(table: pa.Table) -> pa.Table:
        ids, doc = np.unique(_ids(table), return_inverse=True)
        doc = np.repeat(doc.astype(np.int32), _ints(_column(table, "firsts"), "<u4"))
        first = _hashes(table, "first")
        entry = np.repeat(np.arange(len(first), dtype=np.int32), _ints(_column(table, "seconds"), "<u4"))
        second = _hashes(table, "second")
        del table
        sums = np.zeros(len(ids), np.int64), np.zeros(len(ids))
        # A slice of the bigrams at a time, those of one first word and place together,
        # which bounds the memory of the sorts.
        part = np.empty(len(second), np.uint8)
        for a in range(0, len(second), STRETCH):
            b = a + STRETCH
            part[a:b] = mix(_dealt_by(first[entry[a:b]], second[a:b], spread) + _U(9)) % _U(SLICES)
        slices = []
        for k in range(SLICES):
            at = np.flatnonzero(part == k)
            slices.append(_score_slice(doc[entry[at]], first[entry[at]], second[at], spread, sums))
        asked, who, names, c_v, hot_doc, hot_word, n_found, n_own = map(np.concatenate, zip(*slices))
        found, total = sums
        rows = []
        has = np.flatnonzero(found)
        for p, x in _split(has, _place(ids[has].view(_U), parts)):
            rows.append((p, _SEEN, _pack_ids(ids[x]), found[x].tobytes(), b"", total[x].tobytes()))
        for p, x in _split(np.arange(len(asked)), _place(asked, parts)):
            x = x[np.argsort(who[x], kind="stable")]
            cut = np.flatnonzero(_runs(who[x]))
            rows.append((p, _ASKED, _pack_ids(ids[who[x][cut]]), np.diff([*cut, len(x)]).tobytes(), _pack(asked[x]), b""))
        for p, x in _split(np.arange(len(names)), _place(names, parts)):
            rows.append((p, _KNOWN, b"", c_v[x].tobytes(), _pack(names[x]), b""))
        for p, x in _split(np.arange(len(hot_doc)), _place(hot_word, parts)):
            x = x[np.argsort(hot_doc[x], kind="stable")]
            cut = np.flatnonzero(_runs(hot_doc[x]))
            both = np.stack([n_found[x], n_own[x]]).astype("<u4").tobytes()
            n = np.diff([*cut, len(x)]).tobytes()
            rows.append((p, _BEFORE, _pack_ids(ids[hot_doc[x][cut]]), n, _pack(hot_word[x]), both))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*rows)) or [[]] * 6
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _SCORED.split(", ")])

    return score


def _split(values: np.ndarray, place: np.ndarray):
    """(place, values there)."""
    order = np.argsort(place, kind="stable")
    cuts = np.flatnonzero(_runs(place[order]))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(place[order[a]]), values[order[a:b]]


_PARTS = "place bigint, docs binary, n_seen binary, n_backed_off binary, log_sum binary"
_SUMS = "doc_id bigint, n_seen bigint, n_backed_off bigint, log_sum double"


def _score_words(table: pa.Table, parts: int) -> pa.Table:
    """In the partition of a word: its log count for every document that asks for it, and what
    its count takes off as the first word of a document's bigrams; by document, packed for
    the partitions of the documents."""
    kind = table.column("kind").to_numpy()
    of = {k: table.filter(pa.array(kind == k)) for k in (_SEEN, _ASKED, _KNOWN, _BEFORE)}
    known, asked, seen, before = of[_KNOWN], of[_ASKED], of[_SEEN], of[_BEFORE]
    names, at = np.unique(_hashes(known, "hashes"), return_inverse=True)
    counts = np.bincount(at, _ints(_column(known, "counts"), "<i8"), len(names))
    # Every word is the first of some bigram, at least of the one with the stop mark.
    wanted = _hashes(asked, "hashes")
    ids, n = _ids(asked), _ints(_column(asked, "counts"), "<i8")
    logs = np.log(counts[np.searchsorted(names, wanted)])
    lost = np.bincount(np.repeat(np.arange(len(ids)), n), logs, len(ids))
    # The places of a hot word told their parts of what a document has of it.
    before_ids = np.repeat(_ids(before), _ints(_column(before, "counts"), "<i8"))
    firsts = _hashes(before, "hashes")
    told = [np.frombuffer(b, "<u4").reshape(2, -1) for b in _column(before, "logs")]
    times, own = np.concatenate([np.zeros((2, 0)), *told], axis=1)
    order = np.lexsort((firsts, before_ids))
    firsts, before_ids = firsts[order], before_ids[order]
    cut = np.flatnonzero(_runs(firsts, before_ids))
    if len(cut):
        times, own = np.add.reduceat(times[order], cut), np.add.reduceat(own[order], cut)
    firsts, before_ids = firsts[cut], before_ids[cut]
    taken = -times * np.log(np.maximum(counts[np.searchsorted(names, firsts)] - own, 1))
    seen_ids = _ids(seen)
    n_seen, seen_logs = _ints(_column(seen, "counts"), "<i8"), _ints(_column(seen, "logs"), "<f8")
    docs, at = np.unique(np.concatenate([ids, seen_ids, before_ids]), return_inverse=True)
    a, b = len(ids), len(ids) + len(seen_ids)

    def by_doc(place: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bincount(place, values, len(docs))

    n_found, n_lost = by_doc(at[a:b], n_seen).astype("<u4"), by_doc(at[:a], n).astype("<u4")
    logs = by_doc(at[:a], lost) + by_doc(at[a:b], seen_logs) + by_doc(at[b:], taken)
    rows = [
        (p, _pack_ids(docs[x]), n_found[x].tobytes(), n_lost[x].tobytes(), logs[x].tobytes())
        for p, x in _split(np.arange(len(docs)), _place(docs.view(_U), parts))
    ]
    columns = list(zip(*rows)) or [[]] * 5
    kinds = [pa.int64()] + [pa.binary()] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _PARTS.split(", ")])


def _add_up(table: pa.Table) -> pa.Table:
    """In the partition of a document: the sums over all words."""
    docs, at = np.unique(_ids(table), return_inverse=True)
    columns = {"doc_id": docs.astype(np.int64)}
    for name, kind, out in (("n_seen", "<u4", np.int64), ("n_backed_off", "<u4", np.int64), ("log_sum", "<f8", float)):
        columns[name] = np.bincount(at, _ints(_column(table, name), kind), len(docs)).astype(out)
    return pa.table(columns)


def _spread(rows: DataFrame, parts: int) -> np.ndarray:
    """In how many places the words of each hash slot are dealt, by their share of all words: a
    table of fixed size. It only decides where bigrams go; no result depends on it."""

    def count(batches):
        held = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for i, j in chunks(batch.column(0)):
                found = words(batch.column(0)[i:j])
                named = np.maximum(found.hash & _MASK, _U(2))
                held += np.bincount((named & _U(SLOTS - 1)).view(np.int64), minlength=SLOTS)
                held[int(_START) & (SLOTS - 1)] += len(np.unique(found.row))
        # A slot below this share in a task may be left out: the others tell of it.
        slot = np.flatnonzero(held * (8 * parts) > held.sum())
        slots, n = np.append(slot, -1), np.append(held[slot], held.sum())
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n)], ["slot", "n"])

    counts = rows.select("text").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    found = {r.slot: r.n for r in counts.collect()}
    total = max(found.pop(-1, 0), 1)
    spread = np.ones(SLOTS, _U)
    for slot, n in found.items():
        spread[slot] = max(1, -(-4 * parts * n // total)) if 4 * parts * n > total else 1
    return spread


def backoff_scores(docs: DataFrame, backoff: float = BACKOFF, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, n_seen, n_backed_off, log_score, mean_log_score).

    One row per doc_id; rows that repeat an id are scored together, as one document. A null id
    is left out. Null and empty texts have 0 words, a log score of 0 and no mean. The
    number of partitions follows the size of the texts, so each holds about ``partition_bytes``
    of them. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // partition_bytes))
    spread = _spread(rows, parts)

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(1)):
                ids = batch.column(0)[i:j].to_numpy(zero_copy_only=False)
                found = words(batch.column(1)[i:j])
                if not len(found.row):
                    continue
                named = np.maximum(found.hash & _MASK, _U(2))
                begins = _runs(found.row)
                ends = np.append(begins[1:], True)
                first = np.concatenate([named, np.full(begins.sum(), _START, _U)])
                second = np.concatenate([np.where(ends, _STOP, np.append(named[1:], _STOP)), named[begins]])
                row = np.concatenate([found.row, found.row[begins]])
                columns = list(zip(*_bigram_rows(ids, row, first, second, parts, spread)))
                kinds = [pa.int64()] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _BIGRAMS.split(", ")]
                )

    bigrams = rows.mapInArrow(make, _BIGRAMS)
    scored = bigrams.groupBy("place").applyInArrow(_score_bigrams(parts, spread), _SCORED)
    packed = scored.groupBy("place").applyInArrow(lambda table: _score_words(table, parts), _PARTS)
    sums = packed.groupBy("place").applyInArrow(_add_up, _SUMS)
    every = rows.select("doc_id", F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0.0)).distinct()
    added = stage(
        sums.union(every).groupBy("doc_id").agg(
            F.sum("n_seen").alias("n_seen"), F.sum("n_backed_off").alias("n_backed_off"), F.sum("log_sum").alias("log_sum")
        ),
        "scores",
    )
    total = added.agg(F.sum(F.col("n_seen") + F.col("n_backed_off"))).first()[0] or 1
    score = F.col("log_sum") + F.col("n_backed_off") * (F.log(F.lit(backoff)) - F.log(F.lit(float(total))))
    n = F.col("n_seen") + F.col("n_backed_off")
    return added.select(
        "doc_id",
        n.alias("n_words"),
        "n_seen",
        "n_backed_off",
        score.alias("log_score"),
        F.when(n > 0, score / n).alias("mean_log_score"),
    )
