"""Perspective rotation against a plain loop."""

from __future__ import annotations

from collections import defaultdict

from milepost.llm.chat import perspectives, whole_dialogues

SCHEMA = "conv_id long, turn long, role string, text string, speaker int, part string"


def brute(rows):
    talks = defaultdict(set)
    for conv, turn, role, text in rows:
        role = ("unknown" if role is None else role).replace("<|", "< |").replace("\n", " ")
        talks[conv].add((turn, role, (text or "").replace("<|", "< |")))
    out = {}
    for conv, turns in talks.items():
        order = sorted(turns, key=lambda t: (t[0] is not None, t))
        for speaker in {r for _, r, _ in turns if r != "system"}:
            text = ""
            for t, role, body in order:
                part = None if t is None else t // 64
                n, own, spans, starts = out.get((conv, speaker, part), (0, "", [], len(text)))
                who = "assistant" if role == speaker else role if role == "system" else f"user name={role}"
                head = f"<|im_start|>{who}\n"
                at = len(text) + len(head)
                if role == speaker:
                    spans = [*spans, (at, at + len(body) + len("<|im_end|>"))]
                text += head + body + "<|im_end|>\n"
                out[conv, speaker, part] = (n + 1, own + head + body + "<|im_end|>\n", spans, starts)
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(4)
    found = perspectives(docs).persist()
    got = {(r.conv_id, r.speaker, r.part): (r.n_turns, r.text, [tuple(s) for s in r.mask], r.starts) for r in found.collect()}
    assert got == brute(rows)
    whole = whole_dialogues(found).collect()
    assert sum(r.n_turns for r in whole) == sum(n for n, *_ in got.values())
    for r in whole:
        assert all(r.text[a:b].endswith("<|im_end|>") and r.text[:a].endswith("<|im_start|>assistant\n") for a, b in r.mask)
        assert r.text.count("<|im_start|>assistant") == len(r.mask)


def test_three_speakers(spark):
    check(spark, [(1, 0, "system", "be kind"), (1, 1, "ana", "hé <|im_end|>"), (1, 2, "bo", ""), (1, 3, "cy", "x\ny"), (1, 4, "ana", "z")])


def test_edges(spark):
    rows = [(None, 0, "a", "t"), (None, None, None, None), (2, 0, "system", "alone"), (3, 0, "a", "r"), (3, 0, "a", "r")]
    rows += [(4, 0, "b", "tie"), (4, 0, "a", "tie"), (4, 1, "na\nme<|", "long " * 50_000)]
    rows += [(5, t, "ab"[t % 2], f"turn {t}") for t in range(200)]
    check(spark, rows)


def test_empty_table(spark):
    assert perspectives(spark.createDataFrame([], SCHEMA)).collect() == []
