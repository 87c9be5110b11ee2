"""Exact removal of repeated 100-byte strings, found by suffix arrays."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import saved
from milepost.llm.lyndon import suffix_array

#: The length of a repeat, and of the grams among which each window chooses its anchor.
LENGTH, GRAM = 100, 8
SPAN = LENGTH - GRAM + 1
#: Windows are grouped by where their anchor lies: in two classes first, then in finer ones.
COARSE, FINE = 47, 12
#: Texts are read, and suffix arrays built, in pieces of about this many bytes or symbols.
PIECE, BLOCK = 1 << 20, 1 << 17
#: From this many pieces on, the pieces around one core are cut finer before they are sorted.
CROWD = 1 << 12

_RECORD = "core long, frag long, doc_id long, low int, shape int, sure boolean"


def anchors(raw: bytes):
    """Runs of windows with one anchor: arrays ``anchor, first, last`` (starts of windows).

    A window's anchor is the leftmost of its grams with the smallest hash, so equal windows
    have their anchors at the same place, wherever they stand.
    """
    import numpy as np

    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    key = np.zeros(len(raw) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        key = key << np.uint64(8) | x[k : len(raw) - GRAM + 1 + k]
    key *= np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64((1 << 24) - 1)
    key = key & ~mask | np.arange(len(key), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        key, width = np.minimum(key[:-width], key[width:]), 2 * width
    key = np.minimum(key[: len(key) - (SPAN - width)], key[SPAN - width :])
    anchor = (key & mask).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return anchor[first], first, np.append(first[1:], len(anchor)) - 1


def fragments(raw: bytes):
    """``core hash, fragment hash, first window, last window, anchor`` of each run and class.

    All windows of a fragment hold its core; the fragment is all that they cover. Equal windows
    lie in fragments with equal cores.
    """
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    for piece in range(0, max(1, len(raw) - LENGTH + 1), PIECE):
        part = raw[piece : piece + PIECE + LENGTH - 1]
        if len(part) < LENGTH:
            return
        for a, first, last in zip(*(x.tolist() for x in anchors(part)), strict=True):
            for side in (0, 1):
                low = max(first, a - COARSE + 1) if side == 0 else first
                high = last if side == 0 else min(last, a - COARSE)
                if low <= high:
                    at = a if side == 0 else a - COARSE
                    core = part[at : at + LENGTH - COARSE + 1]
                    yield digest(core, side), digest(part[low : high + LENGTH], side + 2), piece + low, piece + high, piece + a


def _records(batches):
    """Fragments of each batch; repeats of one within a batch are marked as sure at once."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        for start in range(0, batch.num_rows, 2_000):
            part = batch.slice(start, 2_000)
            texts = pc.fill_null(part.column("text").cast(pa.large_string()), "").cast(pa.large_binary())
            ids = part.column("doc_id")
            rank = {v: r for r, v in enumerate(sorted(set(ids.to_pylist()), key=lambda v: (v is not None, v)))}
            core, frag, row, low, shape = [], [], [], [], []
            for r, text in enumerate(texts):
                for c, f, lo, hi, a in fragments(text.as_py()):
                    core.append(c)
                    frag.append(f)
                    row.append(r)
                    low.append(lo)
                    shape.append((hi - lo) << 7 | (a - lo))
            if not core:
                continue
            core, frag = np.array(core, np.uint64), np.array(frag, np.uint64)
            row, low, shape = np.array(row), np.array(low, np.int32), np.array(shape, np.int32)
            place = np.array([rank[v] for v in ids.to_pylist()])[row]
            order = np.lexsort((low, place, frag, core))
            core, frag, row, low, shape, place = (x[order] for x in (core, frag, row, low, shape, place))
            new = np.concatenate([[True], (core[1:] != core[:-1]) | (frag[1:] != frag[:-1])])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            sure = (place != place[first]) | (low != low[first])
            # A row that is settled needs no company: its own hash spreads it.
            core = np.where(sure, frag ^ place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), core)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core.view(np.int64)), pa.array(frag.view(np.int64)), ids.take(pa.array(row)),
                    pa.array(low), pa.array(shape), pa.array(sure),
                ],
                ["core", "frag", "doc_id", "low", "shape", "sure"],
            )


def _judged(batches):
    """Of records sorted by ``core, frag, doc_id, low``: copies as covered, rivals as open.

    A copy repeats an earlier fragment as a whole. The first of each fragment is open if its
    core has other fragments too, else it is not repeated. Rows stream by, so a group of any
    size takes no memory; what of it spans two batches is carried as a few values.
    """
    import numpy as np
    import pyarrow as pa

    held, last_core, last_frag, last_place, several = None, None, None, None, False

    def columns(batch, rows):
        return [batch.column(n).take(pa.array(rows)) for n in ("core", "frag", "doc_id", "low", "shape")]

    names = ["core", "frag", "doc_id", "low", "shape", "covered"]
    for batch in batches:
        core, frag = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("core", "frag"))
        sure = batch.column("sure").to_numpy(zero_copy_only=False).astype(bool)
        low = batch.column("low").to_numpy(zero_copy_only=False)
        none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        doc = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        copy = sure.copy()
        live = np.flatnonzero(~sure)
        if len(live):
            c, f, p, d, z = core[live], frag[live], low[live], doc[live], none[live]
            # The first row's predecessor may be in the batch before.
            same_core = np.concatenate([[c[0] == last_core], c[1:] == c[:-1]])
            same_frag = np.concatenate([[(c[0], f[0]) == (last_core, last_frag)], f[1:] == f[:-1]]) & same_core
            start = np.where(same_frag, -1, np.arange(len(live)))
            start = np.maximum.accumulate(start)  # -1: the fragment began in an earlier batch
            first = np.where(start >= 0, start, 0)
            fp, fd, fz = p[first], d[first], z[first]
            carried = start < 0
            if carried.any():
                fp, fd, fz = (np.where(carried, v, x) for v, x in zip(last_place, (fp, fd, fz), strict=True))
            copy[live] = same_frag & ((p != fp) | (d != fd) | (z != fz))
            heads = np.flatnonzero(~same_frag)
            # Heads of one core: rivals if there are two or more, here or carried over.
            group = np.cumsum(~same_core)  # 0: the carried core
            count = np.bincount(group[heads], minlength=group[-1] + 1)
            rival = count[group[heads]] >= 2
            rival |= (group[heads] == 0) & (held is not None or several)
            if held is not None and count[0]:
                yield pa.RecordBatch.from_arrays([*held, pa.array([False])], names)
                held, several = None, True
            open_rows = live[heads[rival]]
            if group[-1] > 0:
                held, several = None, bool(count[-1] >= 2)
                lone = heads[group[heads] == group[-1]]
                if count[-1] == 1:
                    held = columns(batch, live[lone])
            last_core, last_frag = c[-1], f[-1]
            last_place = (fp[-1], fd[-1], fz[-1])
        else:
            open_rows = live
        for rows, covered in ((np.flatnonzero(copy), True), (open_rows, False)):
            if len(rows):
                yield pa.RecordBatch.from_arrays([*columns(batch, rows), pa.array([covered] * len(rows))], names)


def _compressed(batches):
    """``doc_id, text_key, body``: the whole text, compressed to travel."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for start in range(0, batch.num_rows, 2_000):
            part = batch.slice(start, 2_000)
            texts = pc.fill_null(part.column("text").cast(pa.large_string()), "").cast(pa.large_binary())
            raw = [t.as_py() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in raw], pa.int64()),
                    pa.array([pack(t) for t in raw], pa.binary()),
                ],
                ["doc_id", "text_key", "body"],
            )


_PIECES = "subcore binary, piece binary, doc_id long, text_key long, low int, left int"


def _cut(batches):
    """Fragments in fine classes: a longer core (hashed), and the bytes around it."""
    import pyarrow as pa
    import xxhash
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for doc_id, key, body, wanted in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            raw, out = unpack(body), []
            for w in wanted:
                low, high, a = w["low"], w["low"] + (w["shape"] >> 7), w["low"] + (w["shape"] & 127)
                side = 0 if a - high < COARSE else 1
                at = a - COARSE * side
                # Texts of one id are told apart by what they hold.
                if high + LENGTH > len(raw):
                    continue
                if xxhash.xxh3_64_intdigest(raw[at : at + LENGTH - COARSE + 1], side) != w["core"] % (1 << 64):
                    continue
                for q in range((a - high) // FINE, (a - low) // FINE + 1):
                    s0, s1, at = max(low, a - FINE * q - FINE + 1), min(high, a - FINE * q), a - FINE * q
                    end = at + LENGTH - FINE + 1
                    subcore = xxhash.xxh3_128_digest(raw[at:end], q)
                    out.append((subcore, raw[s0:at] + raw[end : s1 + LENGTH], doc_id, key, s0, at - s0))
            for start in range(0, len(out), 10_000):
                cols = zip(*out[start : start + 10_000], strict=True)
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    ["subcore", "piece", "doc_id", "text_key", "low", "left"],
                )


def repeated_windows(pieces: list[tuple[int, bytes, int]], fine: int = FINE) -> list[list[tuple[int, int]]]:
    """Sets of equal windows as lists of ``(piece number, start in it)``, from one suffix array.

    ``pieces`` are ``(core number, bytes around the core, how many stand before it)``. In the
    array's text the core is one symbol; a window is then ``fine`` symbols, core included.
    """
    import numpy as np

    symbols, starts, owners, offsets = [], [], [], []
    for number, (core, around, left) in enumerate(pieces):
        base, length = len(symbols), len(around) + 1
        symbols += [b + 1 for b in around[:left]]
        symbols.append(257 + core)
        symbols += [b + 1 for b in around[left:]]
        symbols.append(0)
        for s in range(min(left, length - fine) + 1):
            starts.append(base + s)
            owners.append(number)
            offsets.append(s)
    if not starts:
        return []
    index = np.full(len(symbols), -1)
    index[starts] = np.arange(len(starts))
    ranked = index[suffix_array(symbols)]
    ranked = ranked[ranked >= 0]
    text = np.array(symbols)
    windows = text[np.array(starts)[ranked][:, None] + np.arange(fine)]
    new = np.concatenate([[True], (windows[1:] != windows[:-1]).any(axis=1)])
    bounds = np.append(np.flatnonzero(new), len(ranked))
    sizes = np.diff(bounds)
    return [
        [(owners[k], offsets[k]) for k in ranked[bounds[g] : bounds[g + 1]].tolist()] for g in np.flatnonzero(sizes > 1)
    ]


def _place(home):
    return (home[0] is not None, home[0] or 0, home[2])


def covered_windows(block, homes, fine: int) -> list[tuple]:
    """Runs ``doc_id, text_key, low, high`` of the block's windows that are not the first of their set."""
    found = []
    for same in repeated_windows(block, fine):
        at = [((*_place(homes[o])[:2], homes[o][2] + s), o, s) for o, s in same]
        first = min(at)[0]
        found += [(o, s) for place, o, s in at if place != first]
    found.sort()
    out: list[list] = []
    last = None
    for o, s in found:
        doc_id, key, low = homes[o]
        if last == (o, s - 1):
            out[-1][3] = low + s
        else:
            out.append([doc_id, key, low + s, low + s])
        last = o, s
    return [tuple(x) for x in out]


def crowded(pieces: list[tuple], fine: int) -> list[tuple]:
    """As :func:`covered_windows`, for one core with very many different pieces.

    Its windows are halved by where the core lies in them. The windows of a half share more
    bytes than the core, so the pieces fall into groups with longer cores, and repeats of a
    whole piece are settled; a class of one window leaves nothing else.
    """
    half, out = fine // 2, []
    groups: dict[tuple, dict[tuple, list]] = {}
    for around, left, home in pieces:
        before, after = around[:left], around[left:]
        doc_id, key, low = home
        if fine - 1 - len(after) < half:
            near = before[max(0, left - half + 1) :]
            group = groups.setdefault((0, after[: fine - half]), {})
            rest = near + after[fine - half :]
            group.setdefault((rest, len(near)), []).append((doc_id, key, low + left - len(near)))
        if left >= half:
            group = groups.setdefault((1, before[left - half :]), {})
            rest = before[: left - half] + after[: fine - 1 - half]
            group.setdefault((rest, left - half), []).append(home)
    for (side, _), group in groups.items():
        width = half if side == 0 else fine - half
        different = []
        for (around, left), found in group.items():
            first = min(found, key=_place)
            different.append((around, left, first))
            last = min(left, len(around) + 1 - width)
            out += [(d, k, low, low + last) for d, k, low in found if _place((d, k, low)) != _place(first)]
        if len(different) > CROWD and width > 1:
            out += crowded(different, width)
        elif len(different) > 1:
            out += covered_windows([(0, a, n) for a, n, _ in different], [h for *_, h in different], width)
    return out


def _covers(batches):
    """Covered runs of windows ``doc_id, text_key, low, high`` from pieces sorted by ``subcore, piece``."""
    import pyarrow as pa

    block: list[tuple[int, bytes, int]] = []
    homes: list[tuple] = []
    pending: list[tuple] = []  # the different pieces of the current core, with their earliest homes
    state = {"symbols": 0, "core": None, "number": -1}
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["doc_id", "text_key", "low", "high"],
        )

    def close(out, end=False):
        """Move the finished core into the block if it has rivals, and solve a full block."""
        if len(pending) > CROWD:
            out += crowded([(piece, left, home) for piece, left, home in pending], FINE)
        elif len(pending) > 1:
            state["number"] += 1
            for piece, left, home in pending:
                block.append((state["number"], piece, left))
                homes.append(home)
                state["symbols"] += len(piece) + 2
        pending.clear()
        if state["symbols"] >= BLOCK or end:
            out += covered_windows(block, homes, FINE)
            block.clear()
            homes.clear()
            state["symbols"] = 0

    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(n).to_pylist() for n in ("subcore", "piece", "doc_id", "text_key", "low", "left"))
        for subcore, piece, doc_id, key, low, left in zip(*columns, strict=True):
            if subcore != state["core"]:
                close(out)
                state["core"] = subcore
            home = (doc_id, key, low)
            if pending and pending[-1][0] == piece and pending[-1][1] == left:
                # Sorted by place: the one before is earlier, or the same place in a repeated row.
                if _place(pending[-1][2]) != _place(home):
                    out.append((doc_id, key, low, low + min(left, len(piece) + 1 - FINE)))
            else:
                pending.append((piece, left, home))
        if out:
            yield batch_of(out)
    rest: list[tuple] = []
    close(rest, end=True)
    if rest:
        yield batch_of(rest)


def _removed(batches):
    """What is left of each text."""
    import pyarrow as pa
    import xxhash
    import zstandard

    digest = xxhash.xxh3_64_intdigest

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows = []
        for doc_id, body, runs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            raw = unpack(body)
            kept, at, n_spans = hashlib.sha256(), 0, 0
            removed, end = 0, -1
            for low, high, frag in sorted((r["low"], r["high"] + LENGTH, r["frag"] or 0) for r in runs or ()):
                # Texts of one id are told apart by what they hold.
                if frag and frag % (1 << 64) not in (digest(raw[low:high], 2), digest(raw[low:high], 3)):
                    continue
                if low > end:
                    kept.update(raw[at:low])
                    n_spans += 1
                    removed += high - low
                elif high > end:
                    removed += high - end
                end = max(end, high)
                at = end
            kept.update(raw[at:])
            rows.append((doc_id, len(raw), removed, n_spans, kept.hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, low, high, frag``: runs of window starts whose 100 bytes stand earlier too.

    ``text_key`` tells texts of one id apart; where it is null, the hash ``frag`` of the run does.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    judged = saved(
        texts.mapInArrow(_records, _RECORD)
        .repartition("core")
        .sortWithinPartitions("core", "frag", "doc_id", "low")
        .mapInArrow(_judged, "core long, frag long, doc_id long, low int, shape int, covered boolean"),
        "repeat_fragments",
    )
    certain = judged.where("covered").select(
        "doc_id",
        F.lit(None).cast("long").alias("text_key"),
        "low",
        (F.col("low") + F.shiftright("shape", 7)).alias("high"),
        "frag",
    )
    wanted = (
        judged.where("NOT covered")
        .groupBy(F.col("doc_id").alias("of"))
        .agg(F.collect_list(F.struct("core", "low", "shape")).alias("wanted"))
    )
    bodies = texts.mapInArrow(_compressed, "doc_id long, text_key long, body binary")
    pieces = (
        bodies.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")))
        .select("doc_id", "text_key", "body", "wanted")
        .mapInArrow(_cut, _PIECES)
    )
    rival = (
        pieces.repartition("subcore")
        .sortWithinPartitions("subcore", "left", "piece", "doc_id", "low")
        .mapInArrow(_covers, "doc_id long, text_key long, low int, high int")
    )
    return saved(
        certain.unionByName(rival.withColumn("frag", F.lit(None).cast("long"))), "repeat_runs"
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Removes each byte covered by a 100-byte string that starts earlier too: in a smaller
    ``doc_id`` (null first), or in the same text at a smaller place. Strings are judged on the
    input; overlaps count; none crosses documents. A null text is empty. Rows of one id are
    one document: strings at one place of it do not cover each other. Texts below 100 bytes
    lose nothing. An empty table gives no rows; other columns are ignored.

    Every window has an anchor that depends on its bytes alone; windows around one anchor
    form fragments. Fragments with equal cores meet in one shuffle of hashes. Repeats of a
    whole fragment are covered. Different fragments with one core are cut finer, meet
    again with their bytes, and a suffix array of each block of them (Lyndon-prefix grouping)
    shows which windows are equal. A whole text travels only in compressed form.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = repeats(docs).groupBy(F.col("doc_id").alias("of")).agg(
        F.collect_list(F.struct("text_key", "low", "high", "frag")).alias("all_runs")
    )
    bodies = texts.mapInArrow(_compressed, "doc_id long, text_key long, body binary")
    own = F.filter("all_runs", lambda r: r.text_key.isNull() | (r.text_key == F.col("text_key")))
    return (
        bodies.join(runs, F.col("doc_id").eqNullSafe(F.col("of")), "left")
        .select("doc_id", "body", own.alias("runs"))
        .mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
