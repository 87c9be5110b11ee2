"""Encoding against a quadratic search over all splits, and exact round trips."""

from __future__ import annotations

import random

from milepost.llm.sentencepiece import SPACE, Encoder, decode, encode, load

SMALL = (
    ("<unk>", 0.0, 2), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)),
    ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -4.0, 1), ("▁a", -4.0, 1), ("ba", -4.5, 1),
    ("▁▁", -5.0, 1), ("aba", -6.0, 1), ("é", -3.0, 1), ("▁ab", -6.0, 1), ("bbb", -7.5, 1),
)


def brute(pieces, text):
    """Best score of the whole text, and the split that ties choose."""
    value = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind in (1, 4)}
    unknown = min(s for s, _ in value.values()) - 10
    raw = SPACE + text.replace(" ", SPACE) if text else ""
    best = [(0.0, [])]
    for end in range(1, len(raw) + 1):
        ways = []
        for start in range(end):
            if raw[start:end] in value:
                s, i = value[raw[start:end]]
                ways.append((best[start][0] + s, best[start][1] + [i]))
        if raw[end - 1] not in value:
            ids = [1 + b if len(pieces) < 1000 else 3 + b for b in raw[end - 1].encode()]
            ways.append((best[end - 1][0] + unknown, best[end - 1][1] + ids))
        best.append(max(ways, key=lambda w: w[0]))
    return best[-1][1]


def test_small_model_against_all_splits():
    rng, encoder = random.Random(4), Encoder(SMALL)
    for _ in range(400):
        text = "".join(rng.choice("aabb  é\nß") for _ in range(rng.randrange(14)))
        assert encoder.encode(text) == brute(SMALL, text), text
        assert encoder.decode(encoder.encode(text)) == text


def test_public_model_against_all_splits():
    rng, pieces = random.Random(5), load()
    encoder = Encoder(pieces)
    for _ in range(60):
        text = "".join(rng.choice(["the ", "on", "tion", "É", "  ", "\n", "日", "😀", "x", "1"]) for _ in range(12))
        assert encoder.encode(text) == brute(pieces, text), text


def test_model_whose_pieces_cross_words():
    pieces = (*SMALL, ("a▁b", -1.0, 1))
    encoder = Encoder(pieces)
    for text in ("a b", "ba ba b", "a  b", "éa bß"):
        assert encoder.encode(text) == brute(pieces, text)


def test_round_trip_and_edges(spark):
    texts = [None, "", " ", "  a  ", "a\tb\r\n", "日本 😀", "word " * 100_000, "x" * 50_000, "same", "same"]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string")
    rows = decode(encode(docs)).collect()
    assert [r.decoded for r in sorted(rows, key=lambda r: r.doc_id)] == texts
    assert {r.doc_id: r.n_ids for r in rows if r.doc_id < 3} == {0: None, 1: 0, 2: rows[2].n_ids}
    assert encode(docs.limit(0)).collect() == []
