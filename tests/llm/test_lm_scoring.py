"""Language-model scores against a plain model of one decision at a time."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from milepost.llm import lm_scoring as module
from milepost.llm.lm_scoring import END, GATES, ORDERS, RATE, SMOOTH, STEP, WEIGHTS, Code, lm_scores, places

SCHEMA = "doc_id long, text string, score string, row int"
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def symbols(text):
    return [*"".join(f"{w} " for w in words(text)).encode(), END]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def brute(rows):
    """Rows as the operator gives them, from dictionaries."""
    training = [text for doc_id, text in rows if not held_out(doc_id)]
    tokens = Counter(t for text in training for t in [*words(text), None])
    n, v = tokens.total(), len(tokens)
    after = lambda s, i: (0, 33) if not i or s[i - 1] == 32 else (s[i - 2] + 1 if i > 1 else 33, s[i - 1] + 1)
    pairs, triples = np.zeros((258, 257), int), defaultdict(lambda: np.zeros(257, int))
    for s in map(symbols, training):
        for i, x in enumerate(s):
            pairs[after(s, i)[1], x] += 1
            triples[after(s, i)][x] += 1
    often = sorted(triples, key=lambda c: (-triples[c].sum(), c))[: module.TREES]
    code = Code(pairs, {c: triples[c] for c in often})
    n_bits = max((int(pairs.sum()) // module.SYMBOLS_PER_SLOT).bit_length() if training else 0, module.MIN_BITS)
    shifts = [code.shifts(n_bits) & ((1 << (n_bits - less)) - 1) for less in module.LESS]

    def path(s, i):
        last, before = after(s, i)[1], after(s, i)[0]
        at = code.tree[before * 258 + last] * 257 + s[i]
        steps = slice(code.start[at], code.start[at] + code.length[at])
        return [([int(shift[node]) for shift in shifts], bit) for node, bit in zip(code.node[steps], code.bit[steps])]

    seen = [defaultdict(lambda: [0, 0]) for _ in ORDERS]

    def slots(s):
        """Slots of each position's contexts; different contexts may share one."""
        return [list(map(int, x[1:])) for x in places(np.array([0, *(x + 1 for x in s)], dtype=np.uint16), n_bits)]

    for text in training:
        s = symbols(text)
        at = slots(s)
        for i in range(len(s)):
            for shift, bit in path(s, i):
                for k in range(len(ORDERS)):
                    seen[k][at[k][i] ^ shift[k]][bit] += 1
    out = []
    for doc_id, text in rows:
        own = Counter([*words(text), None])
        base = sum(c * math.log10((tokens[t] + 0.5) / (n + 0.5 * (v + 1))) for t, c in own.items())
        weights = [list(WEIGHTS) for _ in range(GATES)]
        s, log = symbols(text), 0.0
        at = slots(s)
        for begin in range(0, len(s), STEP):
            gradient = np.zeros((GATES, len(ORDERS)))
            for i in range(begin, min(begin + STEP, len(s))):
                for shift, bit in path(s, i):
                    found = [seen[k].get(at[k][i] ^ shift[k], [0, 0]) for k in range(len(ORDERS))]
                    odds = [math.log((c[1] + SMOOTH) / (c[0] + SMOOTH)) for c in found]
                    gate = min(next((k for k in range(i) if s[i - 1 - k] == 32), i), 3)
                    t = (2 * int(bit) - 1) * sum(w * x for w, x in zip(weights[gate], odds))
                    t = min(max(t, -16), 16)
                    log -= math.log1p(math.exp(-t))
                    gradient[gate] += [(2 * int(bit) - 1) / (1 + math.exp(t)) * x for x in odds]
            weights = (np.array(weights) + RATE * gradient).tolist()
        known = sum(c for t, c in own.items() if tokens[t])
        out.append((doc_id, held_out(doc_id), own.total(), known, n, base, log / math.log(10), -log / math.log(2) / len(s)))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA).repartition(5)
    found = lm_scores(docs)
    assert found.columns == COLUMNS
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got, expected = sorted(map(tuple, found.collect()), key=key), sorted(brute(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected], rel=1e-9, abs=1e-9)
    for column in (6, 7):
        assert [r[column] for r in got] == pytest.approx([r[column] for r in expected], rel=5e-4)
    return got


def corpus(n, seed=3):
    rng = random.Random(seed)
    parts = ["an", "ber", "co", "du", "en", "fi", "go", "ha"]
    vocabulary = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(60)]
    return [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))) for i in range(n)]


def test_against_plain_model(spark, monkeypatch):
    monkeypatch.setattr(module, "FREQUENT", 20)
    monkeypatch.setattr(module, "TREES", 30)
    monkeypatch.setattr(module, "COUNTED", 1024)
    monkeypatch.setattr(module, "SCORED", 512)
    check(spark, corpus(120))


def test_nulls_ties_repeated_rows_and_other_bytes(spark):
    rows = corpus(40) + [(None, "AN ber\x00co \x85Äü x\n\n"), (None, None), (7, None), (41, ""), (42, " \t\n")]
    check(spark, rows + rows[:10])


def test_long_text_in_pieces_and_order_do_not_matter(spark, monkeypatch):
    rows = [*corpus(30), (50, "x" * 5_000), (51, " ".join(["an berco"] * 2_000))]
    whole = check(spark, rows)
    monkeypatch.setattr(module, "COUNTED", 256)
    monkeypatch.setattr(module, "SCORED", 256)
    cut = check(spark, rows[::-1])
    assert [r[6] for r in cut] == pytest.approx([r[6] for r in whole], rel=5e-4)


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(60) if held_out(i)]
    got = check(spark, [(i, "some words here") for i in ids])
    assert {(r[3], r[4]) for r in got} == {(0, 0)}
    assert lm_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_held_out_texts_cost_half_of_single_bytes(spark):
    """Bytes alone cost 4.4 bits in these tables; words of a few hundred texts give less still."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm_scores(docs).collect() if r.held_out and r.n_tokens > 50]
    assert sum(r.bits_per_byte for r in rows) / len(rows) < 2.3
    assert sum(r.score for r in rows) > 1.05 * sum(r.base_score for r in rows)


def test_codes_are_complete():
    pairs = np.zeros((258, 257), int)
    pairs[5, 7], pairs[5, 8], pairs[33] = 10, 90, np.arange(257)
    code = Code(pairs, {(3, 5): pairs[5] * 2})
    assert len(code.length) == 259 * 257 and code.tree[3 * 258 + 5] == 258 and code.tree[4 * 258 + 5] == 5
    for tree in (0, 5, 33, 258):
        paths = [
            tuple(zip(code.node[a : a + m].tolist(), code.bit[a : a + m].tolist()))
            for a, m in zip(code.start[tree * 257 :][:257], code.length[tree * 257 :][:257])
        ]
        assert sum(2.0 ** -len(p) for p in paths) == 1 and len(set(paths)) == 257
        assert len({node for p in paths for node, _ in p}) == 256
    assert code.length[5 * 257 + 8] == 1


def test_places_follow_the_last_symbols_alone():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 5, 3_000).astype(np.uint16)
    at = places(np.concatenate([[0], text, [0], text[:50]]).astype(np.uint16), 30)
    for k, order in enumerate(ORDERS):
        by_context = defaultdict(set)
        for i in range(len(text)):
            by_context[tuple(text[max(0, i - order) : i])].add(int(at[k][i + 1]))
        assert all(len(p) == 1 for p in by_context.values())
        assert len({p for own in by_context.values() for p in own}) > 0.99 * len(by_context)
        assert (at[k][len(text) + 2 :] == at[k][1:51]).all()


def test_counting_works_out_each_context_once(monkeypatch):
    """Places were hashed for every symbol and every context before equal ones were added up."""
    texts = [(i, b"an berco du ") for i in range(50)] + [(50, b""), (51, b"\x00 x ")]
    pairs = np.ones((258, 257), int)
    code, n_bits, hashed = Code(pairs, {(3, 5): pairs[5]}), 12, []
    slot = module._slot
    monkeypatch.setattr(module, "_slot", lambda key, *more: hashed.append(len(key)) or slot(key, *more))
    tables = [np.zeros(2 * size, dtype=np.int32) for size in module.sizes(n_bits)]
    (parts,) = module.pieces(iter(texts), 1 << 20)
    module.count(parts, code, n_bits, tables)
    assert sum(hashed) <= len(ORDERS) * 19  # symbols of the three different texts

    shifts = code.shifts(n_bits)
    expected = [np.zeros(2 * size, dtype=np.int32) for size in module.sizes(n_bits)]
    for _, text in texts:
        s = np.array([0, *(x + 1 for x in text), END + 1], dtype=np.uint16)
        for i, path in list(enumerate(code.after(s) + s.astype(int) - 1))[1:]:
            for at in range(code.start[path], code.start[path] + code.length[path]):
                for k, place in enumerate(places(s, n_bits)):
                    slot_of = int(place[i]) ^ (int(shifts[code.node[at]]) & ((1 << (n_bits - module.LESS[k])) - 1))
                    expected[k][2 * slot_of + int(code.bit[at])] += 1
    assert all((a == b).all() for a, b in zip(tables, expected))


def test_words_are_listed_with_their_texts(monkeypatch):
    import pyarrow as pa

    texts = ["AN ber\x00co \n an", None, "", "ber", "\u2028 \x85 an"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for most in (1, 1 << 25):
        monkeypatch.setattr(module, "WORDS", most)
        found = Counter()
        for part in module._tokens(iter([batch, batch.slice(0, 0)])):
            found.update(dict(zip(part.column("token").to_pylist(), part.column("c").to_pylist())))
        assert found == Counter([t.encode() for text in texts for t in words(text)] + [b""] * len(texts))
