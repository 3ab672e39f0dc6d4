"""Removes byte strings that also start in a document with a smaller id, by buckets of q-grams that are refined.

This replaces bucket-pointer refinement: no bucket identifier of a later offset is read or updated in rounds. The order of all
suffixes is never built; what counts is which suffixes share their first 50 bytes. So only some suffixes take part: of the 35 q-grams of a 50-byte window the smallest by a hash is its
anchor, the same one wherever the window stands. Anchors are put in buckets by q-gram. A bucket is refined by the
name of its suffixes' later and earlier offsets, as far as the anchor's windows reach; where that leaves
one bucket, its smallest document is known. Only buckets that it splits are refined further, window by
window, on the bytes. The names of longer strings come from those of shorter ones at later offsets.

Documents are dealt into blocks of a few megabytes. A block sends each distinct q-gram, and each context that is
refined, once, with its smallest document, so what many documents share is sent by each block, not by each
document. A q-gram with very many contexts isn't refined in one task: its windows are dealt out by their hashes.
"""

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, text_or_empty, total_bytes

#: Bytes of a string that counts, of a q-gram, and the windows that an anchor may be in.
LENGTH, GRAM = 50, 16
REACH = LENGTH - GRAM + 1
#: Bytes before and after the start of an anchor that its windows may cover, and those of a stored context.
BEFORE, CONTEXT = REACH - 1, 88
#: Text bytes in a block, and those named at a time, which fit in a core's cache.
BLOCK_BYTES, PART_BYTES = 8 << 20, 128 << 10
#: Contexts of a q-gram up to which they are refined together; those of more common ones are dealt out by window.
COMMON = 50_000
#: Say that the contexts of a q-gram are refined further, together or by window.
SPLIT, DEALT = (1 << 63) - 1, (1 << 63) - 2

_BYTES = np.random.default_rng(5).integers(0, 1 << 32, 256, np.uint32)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: np.ndarray) -> np.ndarray:
    """A name of the q-gram at each byte, from the names of its halves."""
    name = _BYTES[data]
    for step in (1, 2, 4, 8):
        name = name[:-step] * np.uint32(0x9E3779B1) + name[step:] * np.uint32(0x85EBCA77)
        name ^= name >> np.uint32(15)
        name *= np.uint32(0x2C1B3C6D)
        name ^= name >> np.uint32(13)
    return name


def _least(name: np.ndarray) -> np.ndarray:
    """For each place the place of the first smallest of the next REACH names."""
    place, low, step = np.arange(len(name), dtype=np.int32), name, 1
    while 2 * step <= REACH:
        less = low[step:] < low[:-step]
        place = np.where(less, place[step:], place[:-step])
        low = np.where(less, low[step:], low[:-step])
        step *= 2
    rest = REACH - step
    return np.where(low[rest:] < low[:-rest], place[rest:], place[:-rest]) if rest else place


def _hash(words: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each row of 64-bit words."""
    value = np.full(len(words), seed, np.uint64)
    for k in range(words.shape[1]):
        value = (value ^ words[:, k]) * _MULTIPLIER
        value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


class Block:
    """The anchors of some documents.

    `start` is an anchor's place in `data`, `doc` its document, `near` and `far` the bytes by which the
    nearest and the farthest start of a window that it stands for come before it. `key` and `name` identify its
    q-gram and its context, `which` is the number of that pair among the distinct ones, which are sorted; `key_of` is that of a pair's q-gram.
    """

    def __init__(self, ids: np.ndarray, texts: list[bytes], parts: int):
        self.ids = ids
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        found = []
        first = 0
        while first < len(texts):
            last = first + 1
            while last < len(texts) and self.ends[last] - self.starts[first] <= PART_BYTES:
                last += 1
            found.append(self._anchors(first, last))
            first = last
        self.start, self.near, self.far, self.doc = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
        self._padded = np.concatenate([np.zeros(BEFORE, np.uint8), self.data, np.zeros(CONTEXT, np.uint8)])
        self.key = np.zeros(len(self.start), np.uint64)
        self.name = np.zeros(len(self.start), np.uint64)
        for a in range(0, len(self.start), 1 << 15):
            b = a + (1 << 15)
            grams = np.lib.stride_tricks.sliding_window_view(self._padded, GRAM)[self.start[a:b] + BEFORE]
            self.key[a:b] = _hash(np.ascontiguousarray(grams).view(np.uint64), 1)
            self.name[a:b] = _hash(self.contexts(np.arange(a, min(b, len(self.start)))).view(np.uint64), 2)
        # Distinct pairs, in order of their keys.
        order = np.lexsort((self.ids[self.doc], self.name, self.key))
        key, name = self.key[order], self.name[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])[: len(key)]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.one = order[new]  # an anchor of each pair, of its smallest document
        # Distinct keys, the pairs of each, and the part of the key range that they are sent to.
        keys = self.key[self.one]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
        self.key_of = np.cumsum(first) - 1
        self.first = np.flatnonzero(first)
        self.count = np.diff(np.append(self.first, len(keys)))
        self.cuts = np.searchsorted(_part(keys[self.first], parts), np.arange(parts + 1))

    def _anchors(self, first: int, last: int) -> tuple[np.ndarray, ...]:
        low, high = int(self.starts[first]), int(self.ends[last - 1])
        none = (np.zeros(0, np.int64),) * 4
        if high - low < LENGTH:
            return none
        place = _least(_grams(self.data[low:high]))
        doc = np.repeat(np.arange(first, last), self.ends[first:last] - self.starts[first:last])[: len(place)]
        window = np.flatnonzero(np.arange(low, low + len(place)) + LENGTH <= self.ends[doc])
        if not len(window):
            return none
        place, doc = place[window], doc[window]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])
        at = np.flatnonzero(new)
        until = np.append(at[1:], len(place)) - 1
        return place[at] + np.int64(low), place[at] - window[until], place[at] - window[at], doc[at]

    def contexts(self, chosen: np.ndarray) -> np.ndarray:
        """The bytes that the windows of anchors cover, others zero, and at the end `near` and `far`."""
        rows = np.lib.stride_tricks.sliding_window_view(self._padded, CONTEXT)[self.start[chosen]].copy()
        column = np.arange(CONTEXT)
        near, far = self.near[chosen, None], self.far[chosen, None]
        rows[(column < BEFORE - far) | (column >= BEFORE - near + LENGTH)] = 0
        rows[:, -2], rows[:, -1] = near[:, 0], far[:, 0]
        return rows


    def windows(self, pairs: np.ndarray) -> tuple[np.ndarray, ...]:
        """The windows of some pairs: the pair, how far before the anchor it starts, and two hashes; at last the distinct hashes' numbers."""
        context = self.contexts(self.one[pairs])
        found = []
        for back in range(REACH):
            has = np.flatnonzero((context[:, -2] <= back) & (back <= context[:, -1]))
            found.append((has, np.full(len(has), back), *_window_hashes(context[has], self.key[self.one[pairs[has]]], back)))
        row, back, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((self.ids[self.doc[self.one[pairs[row]]]], b, a))
        row, back, a, b = row[order], back[order], a[order], b[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]
        return pairs[row], back, a, b, new


def _window_hashes(context: np.ndarray, key: np.ndarray, back: int) -> tuple[np.ndarray, np.ndarray]:
    window = np.zeros((len(context), 56), np.uint8)
    window[:, :LENGTH] = context[:, BEFORE - back : BEFORE - back + LENGTH]
    words = window.view(np.uint64)
    return _hash(words, 3) ^ key, _hash(words, 4)


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    """The part of the key range that each key is in."""
    return (((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _block(rows: pa.Table, parts: int) -> Block:
    rows = rows.sort_by("place")
    return Block(rows.column("place").to_numpy(), rows.column("text").cast(pa.binary()).to_pylist(), parts)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: those that are mostly equal shrink when compressed."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), 8).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SENT = pa.schema([("part", pa.int64()), ("block", pa.int64()), *[(c, pa.binary()) for c in ("keys", "names", "docs", "counts")]])
_ANSWERS = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("which", pa.binary()), ("runs", pa.binary()), ("docs", pa.binary())])
_SENT_DDL = "part long, block long, keys binary, names binary, docs binary, counts binary"
_ANSWERS_DDL = "block long, part long, which binary, runs binary, docs binary"


def _send(rows: pa.Table, parts: int) -> pa.Table:
    """Each part of the key range gets the distinct q-grams of the block that are in it.

    With each its smallest document, its number of contexts, and the name of the context, 0 if it has several.
    """
    number, block = rows.column("block")[0].as_py(), _block(rows, parts)
    one = block.one[block.first]
    least = np.minimum.reduceat(block.ids[block.doc[block.one]], block.first) if len(one) else np.zeros(0, np.int64)
    name = np.where(block.count == 1, block.name[one] | np.uint64(1), 0).astype(np.uint64)
    sent = []
    for part in range(parts):
        x = slice(block.cuts[part], block.cuts[part + 1])
        if x.stop > x.start:
            sent.append((part, number, block.key[one][x].tobytes(), name[x].tobytes(), _planes(least[x]), _planes(block.count[x])))
    return _rows(_SENT, sent)


def _gathered(rows: pa.Table, columns: dict) -> tuple[np.ndarray, ...]:
    """The arrays of all rows one after another, the row that each element is of, and its number there."""
    found = [[read(x) for x in rows.column(c).to_pylist()] for c, read in columns.items()]
    sizes = [len(x) for x in found[0]]
    owner = np.repeat(np.arange(rows.num_rows), sizes)
    within = np.concatenate([np.arange(n) for n in sizes])
    return (*(np.concatenate(x) for x in found), owner, within)


def _answer(rows: pa.Table, answers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    blocks, parts = rows.column("block").to_pylist(), rows.column("part").to_pylist()
    return _rows(_ANSWERS, [(b, p, w.astype(np.int32).tobytes(), r.tobytes(), _planes(d)) for b, p, (w, r, d) in zip(blocks, parts, answers, strict=True) if len(w)])


def _told(rows: pa.Table, owner: np.ndarray, within: np.ndarray, value: np.ndarray) -> pa.Table:
    """Answers to the rows that elements came from: their numbers there and values."""
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(rows.num_rows + 1))
    value, within = value[order], within[order]
    return _answer(rows, [(within[a:b], np.zeros(0, np.uint8), value[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])


def _refine(rows: pa.Table, common: int) -> pa.Table:
    """Tells blocks of a smaller document that has a q-gram with the same context, or that contexts differ."""
    read = lambda x: np.frombuffer(x, np.uint64)
    key, name, doc, count, owner, within = _gathered(
        rows, {"keys": read, "names": read, "docs": _from_planes, "counts": _from_planes}
    )
    order = np.argsort(key, kind="stable")
    key, name, doc = key[order], name[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(new, len(key)))
    low = np.minimum.reduceat(name, new)
    split = (low != np.maximum.reduceat(name, new)) | (low == 0)
    state = np.where(np.add.reduceat(count[order], new) > common, DEALT, SPLIT)
    least = np.repeat(np.where(split, state, np.minimum.reduceat(doc, new)), sizes)
    told = np.repeat(split, sizes) | (least < doc)
    return _told(rows, owner[order][told], within[order][told], least[told])


def _states(block: Block, told: pa.Table) -> np.ndarray:
    """For each distinct q-gram of a block the smallest document elsewhere, or what happens to its contexts; else the largest number."""
    state = np.full(len(block.first), np.iinfo(np.int64).max - 2, np.int64)
    for part, which, docs in zip(*(told.column(c).to_pylist() for c in ("part", "which", "docs")), strict=True):
        state[block.cuts[part] + np.frombuffer(which, np.int32)] = _from_planes(docs)
    return state


def _split_pairs(block: Block, state: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose contexts are refined together, and where those of each part of the key range begin."""
    pairs = np.flatnonzero(state[block.key_of] == SPLIT)
    return pairs, np.searchsorted(_part(block.key[block.one[pairs]], parts), np.arange(parts + 1))


def _send_split(key: tuple, rows: pa.Table, told: pa.Table, parts: int) -> pa.Table:
    """Sends the bytes of contexts that are refined together, and the windows of those that are dealt out."""
    if not rows.num_rows:
        return _rows(_SENT, [])
    number, block = key[0].as_py(), _block(rows, parts)
    state = _states(block, told)
    pairs, cuts = _split_pairs(block, state, parts)
    sent = []
    for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        one = block.one[pairs[a:b]]
        if len(one):
            docs = _planes(block.ids[block.doc[one]])
            sent.append((part, number, block.key[one].tobytes(), block.contexts(one).tobytes(), docs, b""))
    dealt = np.flatnonzero(state[block.key_of] == DEALT)
    if len(dealt):
        pair, _, a, b, new = block.windows(dealt)
        docs, a, b = block.ids[block.doc[block.one[pair[new]]]], a[new], b[new]
        cuts = np.searchsorted(_part(a, parts), np.arange(parts + 1))
        for part, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if y > x:  # parts of windows come after those of keys
                sent.append((parts + part, number, a[x:y].tobytes(), b[x:y].tobytes(), _planes(docs[x:y]), b""))
    return _rows(_SENT, sent)


def _refine_windows(rows: pa.Table, parts: int) -> pa.Table:
    """For each context the smallest document of each of its windows, as runs of neighbouring windows.

    For windows that were dealt out, the smallest document of each.
    """
    read = lambda x: np.frombuffer(x, np.uint64)
    if rows.column("part")[0].as_py() >= parts:
        a, b, doc, owner, within = _gathered(rows, {"keys": read, "names": read, "docs": _from_planes})
        order = np.lexsort((b, a))
        new = np.flatnonzero(np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]))
        least = np.repeat(np.minimum.reduceat(doc[order], new), np.diff(np.append(new, len(a))))
        less = least < doc[order]
        return _told(rows, owner[order][less], within[order][less], least[less])
    shaped = lambda x: np.frombuffer(x, np.uint8).reshape(-1, CONTEXT)
    key, context, doc, owner, within = _gathered(rows, {"keys": read, "names": shaped, "docs": _from_planes})
    near, far = context[:, -2].astype(np.int64), context[:, -1].astype(np.int64)
    least = np.full((len(key), REACH), SPLIT, np.int64)
    for back in range(REACH):
        has = np.flatnonzero((near <= back) & (back <= far))
        if not len(has):
            continue
        a, b = _window_hashes(context[has], key[has], back)
        order = np.lexsort((b, a))
        new = np.flatnonzero(np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]))
        low = np.minimum.reduceat(doc[has][order], new)
        least[has[order], back] = np.repeat(low, np.diff(np.append(new, len(has))))
    # Runs of windows with the same smallest document.
    edge = np.ones((len(key), REACH), bool)
    edge[:, 1:] = least[:, 1:] != least[:, :-1]
    row, first = np.nonzero(edge)
    last = np.append(np.where(row[1:] == row[:-1], first[1:] - 1, REACH - 1), REACH - 1)[: len(row)]
    kept = least[row, first] != SPLIT
    row, first, last = row[kept], first[kept], last[kept]
    runs = np.stack([first, last], 1).astype(np.uint8)
    again = np.argsort(owner[row], kind="stable")
    row, runs, value = row[again], runs[again], least[row, first][again]
    cuts = np.searchsorted(owner[row], np.arange(rows.num_rows + 1))
    return _answer(rows, [(within[row[a:b]], runs[a:b], value[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _remove(key: tuple, rows: pa.Table, told: pa.Table, parts: int) -> pa.Table:
    """What is left of each document of a block."""
    if not rows.num_rows:
        return _rows(_RESULT, [])
    rows = rows.sort_by("place")
    block = _block(rows, parts)
    windows = np.array(told.column("windows").to_pylist(), bool)
    state = _states(block, told.filter(pa.array(~windows)))
    delta = np.zeros(len(block.data) + 1, np.int32)
    own = block.ids[block.doc]
    of_key = state[block.key_of][block.which]

    def remove(anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Marks the bytes of an anchor's windows that start from `first` to `last` bytes before it."""
        np.add.at(delta, block.start[anchor] - last, 1)
        np.add.at(delta, block.start[anchor] - first + LENGTH, -1)

    def expanded(anchors: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each anchor with each element of sorted `pair` that is its own."""
        a, b = (np.searchsorted(pair, block.which[anchors], side) for side in ("left", "right"))
        return np.repeat(anchors, b - a), np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())

    # Contexts that no bucket splits: the smallest document is known, here or elsewhere.
    least = np.minimum(block.ids[block.doc[block.one]], np.where(state < DEALT, state, SPLIT)[block.key_of])
    gone = np.flatnonzero((of_key < DEALT) & (least[block.which] < own))
    remove(gone, block.near[gone], block.far[gone])
    answers = told.filter(pa.array(windows))
    pairs, cuts = _split_pairs(block, state, parts)
    dealt = np.flatnonzero(state[block.key_of] == DEALT)
    if len(dealt):
        pair, back, a, _, new = block.windows(dealt)
        distinct = np.cumsum(new) - 1
        smallest = block.ids[block.doc[block.one[pair[new]]]].copy()
        deal_cuts = np.searchsorted(_part(a[new], parts), np.arange(parts + 1))
    by_windows = []
    for part, which, runs, docs in zip(*(answers.column(c).to_pylist() for c in ("part", "which", "runs", "docs")), strict=True):
        which, value = np.frombuffer(which, np.int32), _from_planes(docs)
        if part >= parts:
            smallest[deal_cuts[part - parts] + which] = value
        else:
            by_windows.append((pairs[cuts[part] + which], np.frombuffer(runs, np.uint8).reshape(-1, 2).astype(np.int64), value))
    if by_windows:
        pair_of, runs, value = (np.concatenate(x) for x in zip(*by_windows, strict=True))
        order = np.argsort(pair_of, kind="stable")
        pair_of, runs, value = pair_of[order], runs[order], value[order]
        anchor, run = expanded(np.flatnonzero(of_key == SPLIT), pair_of)
        gone = value[run] < own[anchor]
        remove(anchor[gone], runs[run[gone], 0], runs[run[gone], 1])
    if len(dealt):
        order = np.argsort(pair, kind="stable")
        pair_of, back, value = pair[order], back[order], smallest[distinct][order]
        anchor, window = expanded(np.flatnonzero(of_key == DEALT), pair_of)
        gone = value[window] < own[anchor]
        remove(anchor[gone], back[window[gone]], back[window[gone]])
    removed = np.cumsum(delta[:-1]) > 0
    result = []
    for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), block.starts, block.ends, strict=True):
        cut = removed[a:b]
        spans = int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum())
        result.append((doc_id, int(b - a), int(cut.sum()), spans, block.data[a:b][~cut].tobytes()))
    return _rows(_RESULT, result)


def remove_repeats(
    docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, common: int = COMMON
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) for each row of `docs`.

    A byte goes if a string of 50 bytes that covers it, in its own document, also starts in a document with a
    smaller doc_id. Strings are judged on the input, and never reach across documents. Rows with equal
    doc_id are one document in this and don't count for each other; a null id is smaller than any other. A
    null text is empty. Kept bytes may not be valid UTF-8.
    """
    lowest = -(1 << 63)
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(lowest)).alias("place"), text_or_empty(text).alias("text"))
    parts = max(1, ceil(total_bytes(rows) / block_bytes))
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(parts)))
    grouped = blocks.groupBy("block")
    sent = grouped.applyInArrow(lambda t: _send(t, parts), _SENT_DDL)
    told = materialize(sent.groupBy("part").applyInArrow(lambda t: _refine(t, common), _ANSWERS_DDL), "refined")
    split = grouped.cogroup(told.groupBy("block")).applyInArrow(lambda k, a, b: _send_split(k, a, b, parts), _SENT_DDL)
    windows = materialize(split.groupBy("part").applyInArrow(lambda t: _refine_windows(t, parts), _ANSWERS_DDL), "refined-windows")
    answers = told.withColumn("windows", F.lit(False)).unionByName(windows.withColumn("windows", F.lit(True)))
    return grouped.cogroup(answers.groupBy("block")).applyInArrow(
        lambda k, a, b: _remove(k, a, b, parts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )

