"""Language-model scores: hashed-context bit predictors, mixed online by gated logistic weights."""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import saved

# Tasks get the functions below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Symbols are the 256 bytes and the end of a text; words are closed by a space.
SPACE, END, SYMBOLS = 32, 256, 257
#: Each predictor's context is the last so many symbols, and its table has 2**bits slots, less by so many bits.
ORDERS, LESS = (3, 5, 6), (3, 1, 0)
CONTEXTS = len(ORDERS)
#: Largest table: a slot for so many training symbols, from 2**12 to 2**22 (what a task's memory holds).
SYMBOLS_PER_SLOT, MIN_BITS, MAX_BITS = 1, 12, 22
#: Contexts of two symbols that have a code of their own; after the others, the last symbol's code is used.
TREES = 1024
#: Smoothing of a slot's counts.
SMOOTH = 0.3
#: Weights of the contexts before any refinement. There is a set of them for each gate: letters of
#: the word so far, up to three.
WEIGHTS, GATES = (0.2, 0.3, 0.5), 4
#: Weights are refined after each ``STEP`` symbols of a text.
STEP, RATE = 128, 0.005
#: Symbols that a task counts and scores at a time, and those before them that give their contexts.
COUNTED, SCORED, BEFORE = 1 << 20, 1 << 18, max(ORDERS)
#: Table slots per merged row.
PART = 1 << 14
#: Words whose counts are sent to tasks; the others meet theirs in a join.
FREQUENT = 1 << 18
#: Documents that a task hands on at a time.
ROWS = 2000
#: Bytes whose words a task counts at a time.
WORDS = 1 << 25
#: Base scores are summed as whole numbers of this unit, so that their order does not matter.
UNIT = 1 << 36

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_POWER = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _huffman(weights: np.ndarray) -> list[list[tuple[int, int]]]:
    """Each symbol's path of decisions ``(number, bit)``.

    Numbers go by pieces of the tree, five levels deep, so that a piece lies in 32 slots of a context.
    """
    heap = [(float(n), s) for s, n in enumerate(weights)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    while len(heap) > 1:
        (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (n + m, SYMBOLS + len(children)))
        children.append((a, b))
    paths: list[list[tuple[int, int]]] = [[] for _ in range(SYMBOLS)]
    todo, pieces_so_far = [(heap[0][1], [], 0, 1)], 1
    while todo:
        at, path, piece, local = todo.pop()
        if at < SYMBOLS:
            paths[at] = path
            continue
        for bit, child in enumerate(children[at - SYMBOLS]):
            below = (piece, 2 * local + bit)
            if below[1] >= 32 and child >= SYMBOLS:
                below, pieces_so_far = (pieces_so_far, 1), pieces_so_far + 1
            todo.append((child, [*path, (32 * piece + local, bit)], *below))
    return paths


def _at(values: np.ndarray, index: np.ndarray) -> np.ndarray:
    """``values[index]`` for an index known to be in range: numpy checks no bounds then, which takes longer than the look-up."""
    return values.take(index.astype(np.intp, copy=False), mode="clip")


def _numbers(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... each as often as its size says; all sizes are at least 1."""
    ends = np.cumsum(sizes)
    numbers = np.zeros(ends[-1], dtype=np.intp)
    numbers[ends[:-1]] = 1
    return np.cumsum(numbers, out=numbers)


class Code:
    """Codes of the symbols, one after each last symbol and after the most frequent pairs.

    ``pairs`` counts ``(last symbol, symbol)``, and ``triples`` the symbols after some pairs, all
    plus one and 0 for nothing. Codes give likely symbols short paths, and every symbol some path.
    """

    def __init__(self, pairs: np.ndarray, triples: dict[tuple[int, int], np.ndarray]) -> None:
        # Unseen symbols count a little, those seen after the last symbol alone a little more.
        single = (pairs.sum(0) + 1) / (pairs.sum() + SYMBOLS)
        backed = pairs + single
        least = 2.0**-16  # of a code's symbols together: no path is much longer than 16
        self.tree = np.tile(np.arange(SYMBOLS + 1, dtype=np.int32), SYMBOLS + 1)
        weights = list(backed)
        for (before, last), counts in sorted(triples.items()):
            self.tree[before * (SYMBOLS + 1) + last] = len(weights)
            weights.append(counts + backed[last] / backed[last].sum())
        lengths, nodes, bits = [], [], []
        for w in weights:
            paths = _huffman(np.maximum(w, least * w.sum()))
            lengths.append(np.array([len(p) for p in paths], dtype=np.int32))
            nodes.append(np.array([node for p in paths for node, _ in p], dtype=np.uint16))
            bits.append(np.array([bit for p in paths for _, bit in p], dtype=np.uint8))
        self.length, self.node, self.bit = map(np.concatenate, (lengths, nodes, bits))
        self.start = (np.cumsum(self.length) - self.length).astype(np.int32)
        #: Numbers are below 32 * 257, so number and bit fit 16 bits together.
        self.decision = (self.node << np.uint16(1)) | self.bit

    def after(self, symbols: np.ndarray) -> np.ndarray:
        """Where the codes of each position begin, given the symbols before it (plus one, 0 between texts)."""
        last, before = np.zeros(len(symbols), dtype=np.int32), np.zeros(len(symbols), dtype=np.int32)
        last[1:], before[2:] = symbols[:-1], symbols[:-2]
        return self.below(last, before)

    def below(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where the codes after two symbols (plus one, 0 for nothing) begin; what they name is changed."""
        last[last == 0] = before[before == 0] = SPACE + 1
        before[last == SPACE + 1] = 0
        return _at(self.tree, before * (SYMBOLS + 1) + last) * SYMBOLS

    def decisions(self, path: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Some paths' lengths, and of all their decisions which path and twice the number plus the bit."""
        length = _at(self.length, path)
        of = _numbers(length)
        at = _at(_at(self.start, path) - (np.cumsum(length) - length), of)
        at += np.arange(len(of))
        return length, of, _at(self.decision, at)

    def shifts(self, bits: int) -> np.ndarray:
        """What a decision's number adds to its context's place; smaller tables take the lower bits."""
        number = np.arange(1 << 16, dtype=np.uint64)
        spread = ((number >> np.uint64(5)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
        spread[:32] = 0
        return (((spread << np.uint64(5)) | (number & np.uint64(31))) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _slot(key: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The table place of a context, from the sum of its symbols' products with powers."""
    mixed = key + np.uint64(order)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9FB21C651E98DF25)
    mixed >>= np.uint64(64 - bits + LESS[ORDERS.index(order)])
    return mixed.astype(np.uint32)


def places(symbols: np.ndarray, bits: int) -> list[np.ndarray]:
    """A table place per context and position: a hash of the symbols (plus one) before it.

    Zeros stand between texts; what lies before a text's start counts as zero. Places of the zeros mean nothing.
    """
    v, starts = symbols.astype(np.uint64), np.flatnonzero(symbols == 0)
    # The first symbols of a text, whose contexts would reach over its start.
    after = np.arange(1, max(ORDERS))
    near = starts[:, None] + after
    inside = near < np.append(starts[1:], len(v))[:, None]
    near, after = near[inside], np.broadcast_to(after, inside.shape)[inside]
    found, key = [], np.zeros(len(v), dtype=np.uint64)
    for back in range(1, max(ORDERS) + 1):
        power = np.uint64(pow(_POWER, back, 1 << 64))
        key[back:] += v[:-back] * power
        over = near[(after < back) & (near >= back)]
        key[over] -= v[over - back] * power
        if back in ORDERS:
            found.append(_slot(key, back, bits))
    return found


Part = tuple[int, int, np.ndarray, int]
"""Text, position of the first symbol, symbols plus one, and how many of them only give context."""


#: Bits of a symbol in a key of the symbol and those before it.
KEY = 9


def count(parts: list[Part], code: Code, bits: int, tables: list[np.ndarray]) -> None:
    """Add a stretch's decisions to the tables of counts; symbols with equal contexts are added up first.

    The sort key holds the symbol in its highest bits, then the last one before it, and so on: without its lowest
    symbols it is still in order, so one sort serves all contexts, and places are worked out once a context.
    """
    gap = np.zeros(BEFORE, dtype=np.uint16)
    flat = np.concatenate([x for _, _, symbols, _ in parts for x in (gap, symbols)]).astype(np.uint64)
    lengths = [n for _, _, symbols, skip in parts for n in (BEFORE + skip, len(symbols) - skip)]
    key = flat << np.uint64(KEY * BEFORE)
    for back in range(1, BEFORE + 1):
        key[back:] |= flat[:-back] << np.uint64(KEY * (BEFORE - back))
    key = key[np.repeat(np.tile([False, True], len(parts)), lengths)]
    key.sort()
    times, shifts, before = np.ones(len(key), dtype=np.int32), code.shifts(bits), BEFORE
    for order, less, table in reversed(list(zip(ORDERS, LESS, tables))):
        key >>= np.uint64(KEY * (before - order))
        before = order
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times, key = np.add.reduceat(times, first, dtype=np.int32), _at(key, first)
        found = [(key >> np.uint64(KEY * (order - back))) & np.uint64((1 << KEY) - 1) for back in range(order + 1)]
        hashed = sum(found[back] * np.uint64(pow(_POWER, back, 1 << 64)) for back in range(1, order + 1))
        symbol, last, earlier = (x.astype(np.int32) for x in found[:3])
        _, of, decision = code.decisions(code.below(last, earlier) + symbol - 1)
        slots = _at(_slot(hashed, order, bits), of) ^ (_at(shifts, decision >> 1) & np.uint32((1 << (bits - less)) - 1))
        np.add.at(table, ((slots << np.uint32(1)) | (decision & 1)).astype(np.intp), _at(times, of))


class Piece:
    """A stretch of texts: of each symbol its path of decisions, the places of its contexts, and its gate."""

    def __init__(self, parts: list[Part], code: Code, bits: int) -> None:
        gap = np.zeros(1, dtype=np.uint16)
        flat = np.concatenate([x for _, _, symbols, _ in parts for x in (gap, symbols)])
        self.code, self.bits, self.sizes = code, bits, np.array([len(symbols) - skip for _, _, symbols, skip in parts])
        lengths = [n for _, _, symbols, skip in parts for n in (1 + skip, len(symbols) - skip)]
        chosen = np.flatnonzero(np.repeat(np.tile([False, True], len(parts)), lengths))
        self.path = _at(code.after(flat) + flat - 1, chosen)
        self.places = [_at(place, chosen) for place in places(flat, bits)]
        letter, inside, gate = (flat != 0) & (flat != SPACE + 1), np.ones(len(flat), dtype=bool), np.zeros(len(flat), dtype=np.uint16)
        for back in range(1, GATES):
            inside[back:] &= letter[:-back]
            inside[:back] = False
            gate += inside
        self.gate = _at(gate, chosen)

    def in_steps(self, parts: list[Part]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, int]:
        """Bit and slots of every decision by step, text and gate; of each such run its key, begin and step."""
        begin = np.array([first for _, first, _, _ in parts])
        first_step, last_step = begin // STEP, (begin + self.sizes - 1) // STEP
        # A block is what a text has of a step.
        blocks = last_step - first_step + 1
        text = np.repeat(np.arange(len(parts)), blocks)
        step = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks - first_step, blocks)
        size = np.minimum((step + 1) * STEP, (begin + self.sizes)[text]) - np.maximum(step * STEP, begin[text])
        by_step = np.argsort(step, kind="stable")
        rank = np.empty(len(text), dtype=np.uint16 if GATES * len(text) <= 1 << 16 else np.int64)  # short keys sort faster
        rank[by_step] = np.arange(len(text))
        key = np.repeat(rank * rank.dtype.type(GATES), size) + self.gate
        order = np.argsort(key, kind="stable")
        length, of, decision = self.code.decisions(_at(self.path, order))
        shift = _at(self.code.shifts(self.bits), decision >> 1)
        slots = [
            _at(_at(place, order), of) ^ (shift & np.uint32((1 << (self.bits - less)) - 1)) for place, less in zip(self.places, LESS)
        ]
        key = _at(key, order)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        block, gate = by_step[key[first] // GATES], key[first] % GATES
        run = (step[block] * len(parts) + text[block]) * GATES + gate
        return decision & 1, slots, run, (np.cumsum(length) - length)[first], len(parts)


def pieces(texts: Iterator[tuple[int, bytes]], most: int) -> Iterator[list[Part]]:
    """Texts in lists of about ``most`` symbols; a longer one goes on in the next lists."""
    held, size = [], 0
    for text, data in texts:
        symbols = np.frombuffer(data + b" ", dtype=np.uint8).astype(np.uint16)
        symbols += 1
        symbols[-1] = END + 1
        for at in range(0, len(symbols), most):
            skip = min(at, BEFORE)
            held.append((text, at, symbols[at - skip : at + most], skip))
            size += len(held[-1][2])
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _stream(text: str | None) -> bytes:
    found = words(text)
    return b" ".join(found) + b" " if found else b""


def sizes(bits: int) -> list[int]:
    """Slots of each context's table."""
    return [1 << (bits - less) for less in LESS]


def _count(code: Code, bits: int):
    """Counts of a task's texts, as the used slots of each part of the tables."""

    def run(batches):
        import pyarrow as pa

        tables = [np.zeros(2 * size, dtype=np.int32) for size in sizes(bits)]
        texts = ((0, _stream(text.as_py())) for batch in batches for text in batch.column("text"))
        for parts in pieces(texts, COUNTED):
            count(parts, code, bits, tables)
        at = 0
        for table, size in zip(tables, sizes(bits)):
            part = min(PART, size)
            for first in range(0, size, part):
                own = table[2 * first : 2 * (first + part)].reshape(part, 2)
                used = np.flatnonzero(own.any(1))
                if len(used):
                    counts = own[used]
                    kind = next(t for t in (np.uint8, np.uint16, np.uint32) if counts.max() <= np.iinfo(t).max)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([at + first], pa.int64()),
                            pa.array([used.astype(np.uint16).tobytes()], pa.binary()),
                            pa.array([counts.astype(kind).tobytes()], pa.binary()),
                        ],
                        ["first", "used", "counts"],
                    )
            at += size

    return run


def _merge():
    """Sum the counts of each part of the tables; rows come in order of ``first``, one part at a time is held."""

    def run(batches):
        import pyarrow as pa

        def done(first: int, counts: np.ndarray):
            odds = np.log((counts[:, 1] + SMOOTH) / (counts[:, 0] + SMOOTH)).astype(np.float32)
            return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([odds.tobytes()])], ["first", "odds"])

        now, counts = None, np.zeros((PART, 2), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["first"] != now:
                    yield done(now, counts)
                    counts[:] = 0
                now = row["first"]
                used = np.frombuffer(row["used"], dtype=np.uint16)
                kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(row["counts"]) // len(used) // 2]
                counts[used] += np.frombuffer(row["counts"], dtype=kind).reshape(-1, 2)
        if now is not None:
            yield done(now, counts)

    return run


class Mixer:
    """Scores of some texts; every text starts with the given weights and refines its own."""

    def __init__(self, code: Code, bits: int, odds: list[np.ndarray]) -> None:
        self.code, self.bits, self.odds = code, bits, odds

    def score(self, texts: Iterator[tuple[int, bytes]]) -> dict[int, float]:
        """The natural logarithm of each text's probability."""
        total: dict[int, float] = {}
        kept: tuple[int | None, np.ndarray | None] = (None, None)  # weights of a text that goes on
        for parts in pieces(texts, SCORED):
            decisions = Piece(parts, self.code, self.bits).in_steps(parts)
            weights = np.tile(np.array(WEIGHTS, dtype=np.float32), (len(parts) * GATES, 1))
            if parts[0][0] == kept[0]:
                weights[:GATES] = kept[1]
            sums = self._mixed(*decisions, weights)
            for (name, *_), value in zip(parts, sums.tolist()):
                total[name] = total.get(name, 0.0) + value
            kept = (parts[-1][0], weights[-GATES:].copy())
        return total

    def _mixed(self, bit, slots, run, begin, texts: int, weights: np.ndarray) -> np.ndarray:
        """The logarithm of each text's probability; ``weights`` are refined."""
        sign = bit.astype(np.float32) * 2 - 1
        odds = [_at(table, own) for table, own in zip(self.odds, slots)]  # for the decision that was made
        for own in odds:
            own *= sign
        rows = [np.ascontiguousarray(weights[:, k]) for k in range(CONTEXTS)]
        ends, logs = np.append(begin, len(sign)), np.empty(len(run), dtype=np.float32)
        step, run = np.divmod(run, texts * GATES)
        borders = np.flatnonzero(np.diff(step, prepend=-1, append=-1)).tolist()
        for first, last in zip(borders, borders[1:]):
            here, own, size = slice(ends[first], ends[last]), run[first:last], np.diff(ends[first : last + 1])
            at, seen = ends[first:last] - ends[first], [x[here] for x in odds]
            t = np.repeat(rows[0][own], size)
            t *= seen[0]
            for k in range(1, CONTEXTS):
                more = np.repeat(rows[k][own], size)
                more *= seen[k]
                t += more
            np.clip(t, -16, 16, out=t)
            q = np.exp(t)
            q += 1
            for k in range(CONTEXTS):
                rows[k][own] += np.float32(RATE) * np.add.reduceat(np.divide(seen[k], q, out=more), at)
            t -= np.log(q, out=q)
            np.add.reduceat(t, at, out=logs[first:last])
        weights[:] = np.stack(rows, axis=1)
        return np.bincount(run // GATES, logs, minlength=texts)


def _all_words(streams: list[bytes]):
    """The words of some texts, each with the space behind it, as one array; and the text of each word."""
    import pyarrow as pa

    data = b"".join(streams)
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == SPACE) + 1
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return found, np.searchsorted(np.cumsum([len(stream) for stream in streams]), ends)


def _listed(found) -> list[bytes]:
    """An array of words, each with its space, as a list without the spaces; much faster than ``to_pylist``."""
    if not len(found):
        return []
    _, offsets, data = found.buffers()
    begin, end = np.frombuffer(offsets, dtype=np.int64)[[found.offset, found.offset + len(found)]]
    return memoryview(data)[begin:end].tobytes().split()


def _tokens(batches):
    """Counts of a task's words, some megabytes at a time; the empty word is the end of a text."""
    import pyarrow as pa

    def counted(streams: list[bytes]):
        values, counts = _all_words(streams)[0].value_counts().flatten()
        return pa.RecordBatch.from_arrays(
            [pa.array([*_listed(values), b""], pa.binary()), pa.array(np.append(counts.to_numpy(), len(streams)), pa.int64())],
            ["token", "c"],
        )

    held, size = [], 0
    for batch in batches:
        for text in batch.column("text"):
            held.append(_stream(text.as_py()))
            size += len(held[-1])
            if size >= WORDS:
                yield counted(held)
                held, size = [], 0
    if held:
        yield counted(held)


def _triples(batches):
    """How often each symbol follows two others within a word, from the counts of the words."""
    import pyarrow as pa

    for batch in batches:
        tokens, counts = batch.column("token").to_pylist(), batch.column("c").to_numpy()
        kept = [token for token in tokens if token]
        numbers = counts[[bool(token) for token in tokens]] if kept else counts[:0]
        data = np.frombuffer(b"".join(b" " + token + b" " for token in kept), dtype=np.uint8).astype(np.int64) + 1
        lengths = np.array([len(token) + 2 for token in kept], dtype=np.int64)
        first = np.zeros(len(data), dtype=bool)
        first[np.cumsum(lengths) - lengths] = True
        last, before = np.roll(data, 1), np.roll(data, 2)
        before[last == SPACE + 1] = 0
        key = ((before * (SYMBOLS + 1) + last) * (SYMBOLS + 1) + data)[~first]
        keys, at = np.unique(key, return_inverse=True)
        sums = np.bincount(at, np.repeat(numbers, lengths)[~first], minlength=len(keys)).astype(np.int64)
        end = sum(c for token, c in zip(tokens, counts.tolist()) if not token)
        keys = np.append(keys, (SPACE + 1) * (SYMBOLS + 1) + END + 1)
        sums = np.append(sums, end)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys // (SYMBOLS + 1) ** 2, pa.int32()),
                pa.array(keys // (SYMBOLS + 1) % (SYMBOLS + 1), pa.int32()),
                pa.array(keys % (SYMBOLS + 1), pa.int32()),
                pa.array(sums, pa.int64()),
            ],
            ["before", "last", "symbol", "n"],
        )


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_frequent long, frequent_units long, n_symbols long, "
    "score double, rare array<struct<token:binary,n:long>>"
)


def _score(mixer: Mixer, frequent: dict[bytes, int]):
    """A row per document: the model's score, the base score of frequent words, and the other words."""
    units = {word: round(math.log10(c + 0.5) * UNIT) for word, c in frequent.items()}

    def rows_of(part):
        import pyarrow as pa

        streams = [_stream(text.as_py()) for text in part.column("text")]
        found, text = _all_words(streams)
        coded = found.dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), [*_listed(coded.dictionary), b""]
        unit = np.array([units.get(word, 0) for word in distinct], dtype=np.int64)  # 0: not frequent, as no count gives 0
        # Every text ends once.
        codes = np.append(codes, np.full(len(streams), len(distinct) - 1))
        text = np.append(text, np.arange(len(streams)))
        order = np.argsort(text, kind="stable")
        own, begins = unit[codes[order]], np.searchsorted(text[order], np.arange(len(streams)))
        n_tokens = np.diff(begins, append=len(text))
        known, total = np.add.reduceat(own > 0, begins, dtype=np.int64), np.add.reduceat(own, begins)
        others = unit[codes] == 0
        pairs, numbers = np.unique(text[others] * len(distinct) + codes[others], return_counts=True)
        rare = pa.array(distinct, pa.binary()).take(pa.array(pairs % len(distinct)))
        ends = np.searchsorted(pairs, np.arange(len(streams) + 1) * len(distinct))
        # Texts of one length together, so that few steps are of few texts.
        order = sorted(range(len(streams)), key=lambda i: len(streams[i]))
        scores = mixer.score((i, streams[i]) for i in order)
        others = pa.StructArray.from_arrays([rare, pa.array(numbers, pa.int64())], ["token", "n"])
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("held_out"),
                *(pa.array(x, pa.int64()) for x in (n_tokens, known, total, [len(stream) + 1 for stream in streams])),
                pa.array([scores[i] / math.log(10) for i in range(len(streams))], pa.float64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), others),
            ],
            ["doc_id", "held_out", "n_tokens", "n_frequent", "frequent_units", "n_symbols", "score", "rare"],
        )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield rows_of(batch.slice(at, ROWS))

    return run


def train(texts: DataFrame, tokens: DataFrame) -> Mixer:
    """The codes and the tables, counted over all ``texts``; ``tokens`` are the counts of their words."""
    triples = saved(
        tokens.mapInArrow(_triples, "before int, last int, symbol int, n long")
        .groupBy("before", "last", "symbol")
        .agg(F.sum("n").alias("n"))
        .where("n > 0"),
        "triples",
    )
    pairs = np.zeros((SYMBOLS + 1, SYMBOLS), dtype=np.int64)
    for last, symbol, n in triples.groupBy("last", "symbol").agg(F.sum("n")).collect():  # 66,306 rows at most
        pairs[last, symbol - 1] = n
    often = triples.groupBy("before", "last").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "before", "last").limit(TREES)
    after: dict[tuple[int, int], np.ndarray] = {}
    for before, last, symbol, n in triples.join(often, ["before", "last"]).select("before", "last", "symbol", "n").collect():
        after.setdefault((before, last), np.zeros(SYMBOLS, dtype=np.int64))[symbol - 1] = n  # 257 rows a context
    code = Code(pairs, after)
    slots = max(1, int(pairs.sum()) // SYMBOLS_PER_SLOT)
    bits = min(max(slots.bit_length(), MIN_BITS), MAX_BITS)
    given = texts.sparkSession.sparkContext.broadcast((code, bits))
    counts = texts.select("text").mapInArrow(
        lambda batches: _count(*given.value)(batches), "first long, used binary, counts binary"
    )
    merged = counts.repartition("first").sortWithinPartitions("first").mapInArrow(_merge(), "first long, odds binary")
    odds = np.zeros(sum(sizes(bits)), dtype=np.float32)
    for first, values in saved(merged, "odds").toLocalIterator():  # at most 26 MB in all, whatever the corpus
        size = min(len(values) // 4, len(odds) - first)
        odds[first : first + size] = np.frombuffer(values, dtype=np.float32)[:size]
    return Mixer(code, bits, np.split(odds, np.cumsum(sizes(bits))[:-1]))


def _held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def lm_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``, a row per document.

    Texts are lower-cased (A-Z) and seen as their words and one end. ``base_score`` is the smoothed
    unigram log10 probability of these tokens. ``score`` is that of the mixed model for the words'
    bytes, a space after each word, and the end; ``bits_per_byte`` is its cost in bits per symbol.
    Rows with a crc32 of the id that leaves 1 modulo 5 are held out and teach nothing; a null id
    counts as an empty one. A null text is empty: its only token is the end. Repeated rows are rows
    of their own. If no row is left to learn from, counts are 0 and every decision is even. An empty
    table gives no rows; other columns are ignored.

    Each byte is a path of decisions in a code that gives the bytes likely after the last two short
    paths. For every decision, each context's hash names a slot with the counts seen in training. Counts are
    gathered over all training texts: tasks count on their own, and parts of the tables are
    summed. A text is scored by the slots' odds, weighted by a set of weights for each gate; after
    ``STEP`` symbols the text's weights move along the errors made. Texts do not influence each other, so
    a score depends on neither the order nor the partitions. Counts of frequent words are sent to
    tasks; all other words of a document meet theirs in a join.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _held_out(F.col("doc_id").cast("long")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    training = texts.where(~F.col("held_out"))
    tokens = saved(
        training.select("text").mapInArrow(_tokens, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")),
        "token_counts",
    )
    n, v = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = {bytes(t): c for t, c in tokens.orderBy(F.desc("c"), "token").limit(FREQUENT).toLocalIterator()}
    model = spark.sparkContext.broadcast((train(training, tokens), frequent))
    scored = saved(
        texts.mapInArrow(lambda batches: _score(*model.value)(batches), _SCORED).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "lm_scored",
    )
    units = lambda c: F.round(F.log10(c + 0.5) * UNIT).cast("long")
    rare = (
        scored.select("row", F.explode("rare").alias("r"))
        .select("row", "r.token", "r.n")
        .join(tokens, "token")
        .groupBy("row")
        .agg(F.sum("n").alias("n_rare"), F.sum(F.col("n") * units(F.col("c"))).alias("rare_units"))
    )
    known = F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))
    sums = F.col("frequent_units") + F.coalesce("rare_units", F.lit(0)) + (F.col("n_tokens") - known) * round(math.log10(0.5) * UNIT)
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (sums / UNIT - F.col("n_tokens") * math.log10(n + 0.5 * (v + 1))).alias("base_score"),
        "score",
        (F.col("score") * (-math.log2(10)) / F.col("n_symbols")).alias("bits_per_byte"),
    )
