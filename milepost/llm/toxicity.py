"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

from collections import Counter
from dataclasses import astuple, dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of the labelled sample, so that the fit has one size: rows of each label, and the
#: longest text in bytes that it uses. Scoring has no such bounds.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_BYTES = 3_000, 5_000, 32_768
WINDOW_BYTES = 96
#: The trainer of the ordinary dictionary gets the sample texts whole, in pieces of so many bytes.
PIECE_BYTES = 4_096
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 8_192
#: Evidence (log-likelihood ratio) that a word needs to enter the toxic dictionary; the value
#: that separates the calibration rows best is taken.
EVIDENCE = (10.0, 20.0, 40.0, 80.0, 160.0)
LIMIT = 0.3


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the calibration of what they save."""

    ordinary: bytes
    toxic: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def _windows(text: bytes) -> list[bytes]:
    """The text in pieces of up to 96 bytes, cut at spaces where there are any."""
    out, at = [], 0
    while at < len(text):
        end = at + WINDOW_BYTES
        if end < len(text):
            space = text.rfind(b" ", at + WINDOW_BYTES // 2, end)
            end = space if space > 0 else end
        out.append(text[at:end])
        at = end
    return out


class Meter:
    """Compressed lengths of a text's windows with and without the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard

        settings = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=15, chain_log=15, search_log=3, min_match=4,
            strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
        )

        def compressor(content: bytes):
            if len(content) < 8:
                return zstandard.ZstdCompressor(compression_params=settings).compress
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=known, compression_params=settings).compress

        self.plain = compressor(ordinary)
        # The ordinary text stands last in both, so its matches cost the same in both: a
        # difference is what only toxic text explains.
        self.both = compressor(toxic + ordinary)

    def features(self, text: str | None):
        import numpy as np

        windows = _windows((text or "").lower().encode())
        saved = np.array([len(self.plain(w)) - len(self.both(w)) for w in windows] or [0], np.int32)
        n = max(1, len(windows))
        over = [int((saved >= k).sum()) for k in (2, 4, 6)]
        top = np.sort(saved)[-3:]
        return (
            min(int(saved.max()), 12), *np.log1p(over), *(k / n for k in over), saved.sum() / n, np.log1p(n), top.mean(),
        )


def _lines(texts: list[str]) -> tuple[Counter, int]:
    """In how many different lines each word stands: copies of a text count once."""
    seen, count = set(), Counter()
    for text in texts:
        for line in text.lower().split("\n"):
            if line not in seen:
                seen.add(line)
                count.update({w for w in line.split() if len(w) >= 4})
    return count, len(seen)


def _toxic_words(toxic: list[str], ordinary: list[str]) -> list[tuple[float, bytes]]:
    """Words with their evidence, the strongest last."""
    (a, n), (b, m) = _lines(toxic), _lines(ordinary)
    found = []
    for word, x in a.items():
        y = b[word]
        expected = (x + y) * n / (n + m)
        if x / n >= 8 * (y + 0.5) / m:
            evidence = 2 * (x * log(x / expected) + (y * log(y / (x + y - expected)) if y else 0.0))
            found.append((evidence, word.encode()))
    return sorted(found)


def _ordinary_content(texts: list[str]) -> bytes:
    import zstandard

    whole = [t.lower().encode() for t in texts]
    samples = [t[at : at + PIECE_BYTES] for t in whole for at in range(0, len(t), PIECE_BYTES)]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples for the trainer
        return b"\n".join(samples)[-ORDINARY_BYTES:]


def _separation(values, labels) -> float:
    """Probability that a toxic row has the larger value (area under the curve)."""
    import numpy as np

    order = np.unique(values)
    toxic, ordinary = np.sort(values[labels == 1]), np.sort(values[labels == 0])
    if not len(order) or not len(toxic) or not len(ordinary):
        return 0.5
    below = (np.searchsorted(ordinary, toxic, "left") + np.searchsorted(ordinary, toxic, "right")) / 2
    return float(below.mean() / len(ordinary))


def _logistic(x, y, weight):
    """Ridge-regularised weights of a logistic regression by Newton's method."""
    import numpy as np

    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p) * weight)[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(curve, x.T @ ((y - p) * weight) - 0.1 * w)
    return w


def _probability(features, model_mean, model_scale, weights):
    import numpy as np

    x = (np.asarray(features, float) - model_mean) / model_scale
    return 1 / (1 + np.exp(-np.clip(x @ np.asarray(weights[:-1]) + weights[-1], -30, 30)))


def fit_rows(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """Fit on two lists of texts; ``share`` is the share of toxic rows among all labelled ones.

    Three of four rows make the dictionaries, the others calibrate.
    """
    import numpy as np

    prior = min(max(share, 0.0), 1.0)
    if len(toxic) < 4 or len(ordinary) < 4:
        return Model(b"", b"", (), (), (), prior)
    learn = [[t for i, t in enumerate(rows) if i % 4] for rows in (toxic, ordinary)]
    check = [t for rows in (toxic, ordinary) for i, t in enumerate(rows) if i % 4 == 0]
    n_toxic = len(range(0, len(toxic), 4))
    y = np.array([1] * n_toxic + [0] * (len(check) - n_toxic))
    words, content = _toxic_words(*learn), _ordinary_content(learn[1])
    best = None
    for least in EVIDENCE:
        known = b" ".join(w for e, w in words if e >= least)[-TOXIC_BYTES:]
        if not known:
            break
        known = b" " + known + b" "
        meter = Meter(content, known)
        x = np.array([meter.features(t) for t in check], float)
        mean, scale = x.mean(0), x.std(0) + 1e-9
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        weight = np.where(y == 1, prior / max(1, n_toxic), (1 - prior) / max(1, len(check) - n_toxic)) * len(check)
        w = _logistic(z, y, weight)
        quality = _separation(z @ w, y)
        if best is None or quality > best[0]:
            best = quality, known, mean, scale, w
    if best is None:
        return Model(content, b"", (), (), (), prior)
    _, known, mean, scale, w = best
    return Model(content, known, tuple(mean), tuple(scale), tuple(w), prior)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out.

    The sample is the first rows in the order of a hash of ``doc_id``, per label; only it comes
    to the driver. The share of toxic rows is counted over all labels.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = texts.where(F.col("text").isNotNull() & (F.octet_length("text") <= SAMPLE_BYTES))
    rows = {}
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        # Ids first: the texts of the chosen rows only are gathered.
        some = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        found = usable.join(F.broadcast(some), "doc_id").select("doc_id", "text").distinct()
        rows[label] = [r.text for r in found.orderBy(F.xxhash64("doc_id"), "text").limit(most).collect()]
    return fit_rows(rows[1], rows[0], share)


_METERS: dict[int, Meter] = {}


def _meter(ordinary: bytes, toxic: bytes) -> Meter:
    key = hash((ordinary, toxic))
    if key not in _METERS:
        _METERS[key] = Meter(ordinary, toxic)
    return _METERS[key]


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The rows of ``docs`` with the score of the whole text, in 0 to 1, as column ``name``.

    A column of that name is replaced, all others stay as they are. A null text counts as empty;
    empty texts get the score of a text where nothing was saved, and without labels of both kinds
    every score is the share of toxic rows. Repeated rows come out repeated, an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))  # bounded: under 80 KB
    kept = docs.select(*[c for c in docs.columns if c != name])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ordinary, toxic, mean, scale, weights, prior = shared.value
        for batch in batches:
            if weights:
                meter, texts = _meter(ordinary, toxic), batch.column("text")
                x = np.array([meter.features(t.as_py()) for t in texts], float).reshape(-1, len(mean))
                score = _probability(x, np.array(mean), np.array(scale), weights)
            else:
                score = np.full(batch.num_rows, prior)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])

    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Each window of a text is compressed with a dictionary of ordinary text, and with one of
    toxic and ordinary text; what the second saves, summed up over all windows of the text, is
    calibrated to a probability. Only ``text`` enters a score. A null text counts as empty;
    empty texts have no windows and the score of a text where nothing was saved. Labels of
    unknown documents, null labels and held-out rows are not learned from; an id labelled
    twice counts as toxic if once labelled so. Without labels of both kinds every score is the
    share of toxic rows. Repeated rows come out repeated; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(texts, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )
