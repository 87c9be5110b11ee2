"""SentencePiece encoding by an Aho-Corasick automaton that drives a Viterbi search, and decoding."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Fixed values of the model format: kinds of pieces.
NORMAL, USER, BYTE = 1, 4, 6
#: How far below the worst piece a character scores that no piece holds.
UNKNOWN_PENALTY = 10.0
#: Encoded words a Python worker remembers before it forgets them all.
REMEMBERED = 400_000
#: Rows whose ids are Python objects at one time.
ROWS = 128


@lru_cache(maxsize=4)
def load(path: str = MODEL) -> tuple[tuple[str, float, int], ...]:
    """``(piece, score, kind)`` by id, from a model file."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return tuple((p.piece, p.score, p.type) for p in model.pieces)


class Encoder:
    """One worker's automaton, and the words it has encoded."""

    def __init__(self, pieces):
        import ahocorasick

        self.raw = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in pieces
        ]
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        text_pieces = [(i, p, s) for i, (p, s, kind) in enumerate(pieces) if kind in (NORMAL, USER)]
        self.unknown = min((s for _, _, s in text_pieces), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i, piece, score in text_pieces:
            self.automaton.add_word(piece, (len(piece), score, i))
        if text_pieces:
            self.automaton.make_automaton()
        letters = {c for _, p, _ in text_pieces for c in p} | {SPACE}
        known = "".join(map(re.escape, sorted(letters)))
        inner = "".join(map(re.escape, sorted(letters - {SPACE})))
        # No piece spans two parts if none has a space after another character: then the best
        # split of a text is the best split of each part.
        if any(SPACE in p.lstrip(SPACE) for _, p, _ in text_pieces):
            self.parts = re.compile(f"[{known}]+|[^{known}]")
        else:
            self.parts = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|[^{known}]" if inner else ".", re.DOTALL)
        self.single = {p for _, p, _ in text_pieces if len(p) == 1}
        self.seen: dict[str, list[int]] = {}

    def best(self, part: str) -> list[int]:
        """The ids of the best split; of equal ones that with the longest last piece, and so on back.

        One pass: at each position the automaton follows its output links and reports the pieces
        that end there, the longest first, and each relaxes the best score of the position. A
        character that is no piece may stand alone; it becomes its bytes.
        """
        n, low = len(part), float("-inf")
        score, last = [0.0] + [low] * n, [(1, -1)] * (n + 1)
        alone = [at for at, c in enumerate(part, 1) if c not in self.single]
        alone.reverse()
        for end, (length, value, i) in self.automaton.iter(part) if len(self.automaton) else ():
            while alone and alone[-1] <= end:
                self._relax_unknown(score, last, alone.pop())
            total = score[end + 1 - length] + value
            if total > score[end + 1]:
                score[end + 1], last[end + 1] = total, (length, i)
        while alone:
            self._relax_unknown(score, last, alone.pop())
        ids: list[int] = []
        at = n
        while at:
            length, i = last[at]
            if i < 0:
                ids.extend(self.byte_ids[b] for b in reversed(part[at - 1].encode()))
            else:
                ids.append(i)
            at -= length
        ids.reverse()
        return ids

    def _relax_unknown(self, score, last, at: int) -> None:
        total = score[at - 1] + self.unknown
        if total > score[at]:
            score[at], last[at] = total, (1, -1)

    def encode(self, text: str) -> list[int]:
        """The ids of a text: a space is put before it, and spaces become the space letter."""
        if not text:
            return []
        ids: list[int] = []
        seen = self.seen
        for part in self.parts.findall(SPACE + text.replace(" ", SPACE)):
            found = seen.get(part)
            if found is None:
                found = self.best(part)
                if len(part) <= 64:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[part] = tuple(found)
            ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes are joined before they are read, one leading space goes."""
        raw = b"".join([self.raw[i] for i in ids])
        return raw.decode("utf-8", "replace")[1:] if ids else ""


def _shared(docs: DataFrame, pieces):
    """The model as a broadcast, a bounded table. What a worker makes of it is kept beside it, from task to task."""
    return docs.sparkSession.sparkContext.broadcast({"pieces": pieces or load()})


def _encoder(kept: dict) -> Encoder:
    if "encoder" not in kept:
        kept["encoder"] = Encoder(kept["pieces"])
    return kept["encoder"]


def _lists(column) -> list[list[int] | None]:
    """Lists of an Arrow column; a value at a time would take many times as long."""
    bounds = column.offsets.to_pylist()
    values = column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]].tolist()
    missing, start = column.is_null().to_pylist(), bounds[0]
    return [
        None if none else values[a - start : b - start]
        for none, a, b in zip(missing, bounds, bounds[1:], strict=False)
    ]


def encode(docs: DataFrame, pieces=None) -> DataFrame:
    """Add ``ids`` (array of int), the SentencePiece ids of ``text``, and ``n_ids``.

    ``pieces`` is ``load(path)``, by default of the 32k model. Of all splits of the text into
    pieces that with the highest sum of the model's scores is taken; ties go to the longest
    last piece. A null text has null ids, an empty one none. Characters outside the model
    become byte ids. Columns named ``ids`` or ``n_ids`` are replaced, all others are kept; rows
    stay one to one, repeated rows too; an empty table stays empty. Texts are whole: a long one
    is a sequence of words, and no split crosses the start of a word.
    """
    shared = _shared(docs, pieces)
    kept = docs.select(*[c for c in docs.columns if c not in ("ids", "n_ids")])
    schema = T.StructType([*kept.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        import pyarrow as pa

        encoder = _encoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = [None if t is None else encoder.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, "ids"]
                )

    return kept.mapInArrow(run, schema).withColumn("n_ids", F.size("ids").cast("long"))


def decode(encoded: DataFrame, pieces=None) -> DataFrame:
    """Add ``decoded``, the text of ``ids``; null ids give null.

    Exact but for the space letter itself, which comes back as a space. A column named
    ``decoded`` is replaced.
    """
    shared = _shared(encoded, pieces)
    kept = encoded.select(*[c for c in encoded.columns if c != "decoded"])
    schema = T.StructType([*kept.schema, T.StructField("decoded", T.StringType())])

    def run(batches):
        import pyarrow as pa

        encoder = _encoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = [None if x is None else encoder.decode(x) for x in _lists(part.column("ids"))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"]
                )

    return kept.mapInArrow(run, schema)
