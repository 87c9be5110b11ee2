"""Removal of repeated 100-byte strings against a table of all strings."""

from __future__ import annotations

import hashlib
import random

import pytest

from milepost.llm import suffix_dedup
from milepost.llm.suffix_dedup import crowded, remove_repeats, repeated_windows

SCHEMA = "doc_id long, text string, low int, frag string"


def brute(rows):
    first: dict[bytes, tuple] = {}
    out = []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if first.setdefault(raw[s : s + 100], (doc_id, s)) != (doc_id, s):
                gone[s : s + 100] = b"\1" * 100
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "clash") for d, t in rows], SCHEMA).repartition(4)
    assert sorted(map(tuple, remove_repeats(docs).collect()), key=str) == brute(rows)


def prose(rng, n, alphabet="abcdefgh "):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_passages_in_other_texts(spark):
    rng = random.Random(1)
    passages = [prose(rng, n) for n in (99, 100, 101, 150, 400, 1_500)] + ["é" * 70]
    rows = []
    for d in range(60):
        parts = [prose(rng, rng.randrange(250))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            parts += [p if rng.random() < 0.5 else p[cut:] if rng.random() < 0.5 else p[:cut], prose(rng, rng.randrange(80))]
        rows.append((d, "".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    check(spark, rows)


def test_near_copies_periods_and_runs(spark):
    rng = random.Random(2)
    base = prose(rng, 3_000)
    rows = [(d, "".join(c if rng.random() > 0.004 else "#" for c in base)) for d in range(25)]
    rows += [(50, "ab" * 400), (51, "x" * 99), (52, "x" * 100), (53, "x" * 101), (54, "y" * 2_000), (55, "abc " * 300)]
    rows += [(60, None), (61, ""), (62, "short"), (None, base)]
    check(spark, rows)


def test_small_alphabet(spark):
    rng = random.Random(3)
    rows = [(d, prose(rng, 30, "ab") * rng.randrange(1, 12) + prose(rng, 100, "ab")) for d in range(40)]
    check(spark, rows)


def test_long_text_over_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    rng = random.Random(4)
    passage = prose(rng, 900)
    check(spark, [(1, prose(rng, 700) + passage + prose(rng, 300) + passage[100:]), (2, prose(rng, 20) + passage)])


def test_versions_of_one_id_and_repeated_rows(spark):
    rng = random.Random(5)
    a, b, c = (prose(rng, 300) for _ in range(3))
    rows = [(1, a), (1, a), (2, b + a), (2, c + a), (3, c)]
    docs = spark.createDataFrame([(d, t, 1, "") for d, t in rows], SCHEMA)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(docs).collect())
    assert got == [(1, 300, 0), (1, 300, 0), (2, 600, 300), (2, 600, 300), (3, 300, 300)]
    assert remove_repeats(docs.limit(0)).collect() == []


@pytest.mark.parametrize("fine", [12, 7, 2])
def test_crowded_cores_are_cut_finer(monkeypatch, fine):
    """The same windows come out, however small a group may be."""
    rng = random.Random(6)
    pieces = {}
    for i in range(300):
        left, right = rng.randrange(fine), rng.randrange(fine)
        left = max(left, fine - 1 - right)
        pieces.setdefault((prose(rng, left + right, "ab").encode(), left), (i, 0, rng.randrange(1000)))
    pieces = [(around, left, home) for (around, left), home in pieces.items()]

    def windows(runs):
        return sorted({(d, s) for d, _, low, high in runs for s in range(low, high + 1)})

    whole = suffix_dedup.covered_windows([(0, a, n) for a, n, _ in pieces], [h for *_, h in pieces], fine)
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    assert windows(crowded(pieces, fine)) == windows(whole)
    assert repeated_windows([]) == []
