"""Fill-in-the-middle transformation by displacement scatter.

The texts of a batch lie in one buffer of bytes. A scan marks the bytes at
which a unit starts (a run of ASCII letters, or any other code point) and finds
both cuts of every text. How far a segment moves is written once, as a
difference, at the byte where the segment starts; the cumulative sum of these
differences is the shift of every byte, and one scatter builds all outputs.
``restore`` finds the sentinels in the outputs and gathers every byte back by
the inverse shifts.

All passes over a buffer go in steps of ``STEP`` bytes, so that a very long
text needs a few bytes of memory for each of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import pick

SENTINELS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
FORMS = ("plain", "psm", "spm")
STEP = 1 << 20
GROUP_BYTES = 8 << 20              # texts taken together, or one longer text


def checked(sentinels: tuple[str, str, str]) -> list[np.ndarray]:
    """The sentinels' bytes. None may hold another, nor may the end of one be
    the beginning of another or of itself: then joining segments makes no
    further sentinel, and the outputs can be read back."""
    for i, a in enumerate(sentinels):
        for j, b in enumerate(sentinels):
            overlap = any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b))))
            if not a or overlap or (i != j and a in b):
                raise ValueError(f"sentinels {a!r} and {b!r} are empty or overlap")
    return [np.frombuffer(s.encode(), np.uint8) for s in sentinels]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of an Arrow array of strings without nulls."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[at[0]:at[-1]], at - at[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of the runs of rows that are taken together."""
    at, first = buffer_of(texts)[1], 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + GROUP_BYTES, "right")) - 1)
        yield first, last - first
        first = last


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte, whether a unit starts there."""
    letter = (data | 0x20) - np.uint8(97) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return starts


def counts_before(mask: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """How many bytes of the mask are set before each of ascending positions."""
    out, done, total = np.empty(len(positions), np.int64), 0, 0
    for w in range(0, len(mask) + 1, STEP):
        part = np.flatnonzero(mask[w:w + STEP])
        end = int(np.searchsorted(positions, w + STEP))
        out[done:end] = total + np.searchsorted(part, positions[done:end] - w)
        done, total = end, total + len(part)
    return out


def places(mask: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Where the set bytes of ascending ranks (from 0) are; the mask's end for
    a rank beyond the last."""
    out, done, total = np.full(len(ranks), len(mask), np.int64), 0, 0
    for w in range(0, len(mask), STEP):
        part = np.flatnonzero(mask[w:w + STEP])
        end = int(np.searchsorted(ranks, total + len(part)))
        out[done:end] = w + part[ranks[done:end] - total]
        done, total = end, total + len(part)
    return out


def displaced(size: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """In steps, every byte's place after its shift. ``starts``, ascending, are
    the bytes from which on each of the ``shifts`` holds."""
    change, done, carried = np.diff(shifts, prepend=0), 0, 0
    for w in range(0, size, STEP):
        own = np.zeros(min(STEP, size - w), np.int64)
        end = int(np.searchsorted(starts, w + len(own)))
        np.add.at(own, starts[done:end] - w, change[done:end])
        own[0] += carried
        shift = np.cumsum(own)
        done, carried = end, shift[-1]
        yield slice(w, w + len(own)), np.arange(w, w + len(own)) + shift


def occurrences(data: np.ndarray, offsets: np.ndarray, sentinel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, position) of each occurrence of a sentinel within a text."""
    n = len(sentinel)
    if len(data) < n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hit = data[:len(data) - n + 1] == sentinel[0]
    for i in range(1, n):
        hit &= data[i:len(data) - n + 1 + i] == sentinel[i]
    at = np.flatnonzero(hit)
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at + n <= offsets[text + 1]
    return text[inside], at[inside]


def scatter(data: np.ndarray, offsets: np.ndarray, draws: list[np.ndarray], marks: list[np.ndarray],
            plain_percent: int, spm_percent: int) -> tuple:
    """(units, form, prefix code points, middle code points, output bytes,
    output offsets) of texts and their four random numbers."""
    start, end = offsets[:-1], offsets[1:]
    mask = unit_starts(data, offsets)
    base = counts_before(mask, offsets)
    n = np.diff(base)
    x, y = draws[0] % (n + 1), draws[1] % (n + 1)
    first, second = places(mask, base[:-1] + np.minimum(x, y)), places(mask, base[:-1] + np.maximum(x, y))
    form = np.where(draws[3] % 100 < spm_percent, 2, 1)
    form[(start == end) | (draws[2] % 100 >= 100 - plain_percent)] = 0
    for mark in marks:
        form[occurrences(data, offsets, mark)[0]] = 0

    p, s, m = (len(mark) for mark in marks)
    prefix, suffix, cut = first - start, end - second, form > 0
    out = np.concatenate([[0], np.cumsum(end - start + cut * (p + s + m))])
    o, psm = out[:-1], form == 1
    mark_at = [np.where(psm, o, o + s + suffix), np.where(psm, o + p + prefix, o), o + p + s + prefix + suffix]
    to = np.stack([np.where(cut, mark_at[0] + p, o), np.where(cut, mark_at[2] + m, o + prefix),
                   np.where(cut, mark_at[1] + s, o + second - start)], axis=1)
    begins = np.stack([start, first, second], axis=1)
    built = np.empty(out[-1], np.uint8)
    for own, place in displaced(len(data), begins.ravel(), (to - begins).ravel()):
        built[place] = data[own]
    for mark, at in zip(marks, mark_at):
        for i in range(len(mark)):
            built[at[cut] + i] = mark[i]
    bounds = np.stack([start, first, second], axis=1)
    chars = np.diff(counts_before((data & 0xC0) != 0x80, bounds.ravel()).reshape(-1, 3), axis=1)
    return n, form, chars[:, 0], chars[:, 1], built, out


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, marks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that were made into these outputs."""
    start, end, cut = offsets[:-1], offsets[1:], form > 0
    at = []
    for mark in marks:
        text, position = occurrences(data, offsets, mark)
        text, position = text[cut[text]], position[cut[text]]
        if not np.array_equal(text, np.flatnonzero(cut)):
            raise ValueError("an output of another form than plain needs each sentinel once")
        places_ = start.copy()
        places_[text] = position
        at.append(places_)
    p, s, m = (len(mark) for mark in marks)
    psm = form == 1
    prefix_at, suffix_at, middle_at = at[0] + p, at[1] + s, at[2] + m
    prefix = np.where(cut, np.where(psm, at[1], at[2]) - prefix_at, end - start)
    middle = np.where(cut, end - middle_at, 0)
    out = np.concatenate([[0], np.cumsum(end - start - cut * (p + s + m))])
    r = out[:-1]
    begins = np.stack([r, r + prefix, r + prefix + middle], axis=1)
    source = np.stack([np.where(cut, prefix_at, start), middle_at, suffix_at], axis=1)
    built = np.empty(out[-1], np.uint8)
    for own, place in displaced(len(built), begins.ravel(), (source - begins).ravel()):
        built[own] = data[place]
    return built, out


def transform(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20,
              sentinels: tuple[str, str, str] = SENTINELS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): each text cut at two
    units drawn by a hash of seed and id, and put in the order of its form.

    n: the text's units. form: ``psm`` (prefix, suffix, middle), ``spm``
    (suffix, prefix, middle) or ``plain``, the text itself, for a share of the
    texts, for empty ones and for those that hold a sentinel; the lengths in
    code points are null there. A null text is empty. A null id draws as the
    empty id, equal ids draw alike, so repeated rows give repeated results; an
    empty table gives an empty one. A text of any length is cut as a whole.
    Other columns are ignored, whatever their names.
    """
    marks = checked(sentinels)
    own = pick(docs, **{id_col: "long", text_col: "string"})
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(key, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    own = own.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), *draws)

    def run(batches):
        for batch in batches:
            for first, rows in groups(batch.column(1)):
                part = batch.slice(first, rows)
                data, offsets = buffer_of(part.column(1))
                n, form, prefix, middle, built, out = scatter(
                    data, offsets, [c.to_numpy() for c in part.columns[2:]], marks, plain_percent, spm_percent)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(FORMS).take(pa.array(form)),
                     pa.array(prefix, mask=form == 0), pa.array(middle, mask=form == 0), strings(built, out)],
                    names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    return own.mapInArrow(
        run, f"`{id_col}` long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(coded: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """The frame with a column ``restored``: the text rebuilt from ``output``
    and ``form`` alone. A null output gives null; the other columns pass
    through. Raises where an output lacks a sentinel or repeats one."""
    marks = checked(sentinels)
    keep = [c for c in coded.columns if c != "restored"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.select(*keep).schema)

    def run(batches):
        for batch in batches:
            output = batch.column(keep.index("output"))
            full = output.fill_null("")
            for first, rows in groups(full):
                part, own = batch.slice(first, rows), full.slice(first, rows)
                form = part.column(keep.index("form")).to_pylist()
                form = np.array([FORMS.index(f) if f and len(x) else 0 for f, x in zip(form, own.to_pylist())])
                built, out = gather(*buffer_of(own), form, marks)
                back = strings(built, out)
                if output.null_count:
                    back = pa.array([t if known else None for t, known in zip(
                        back.to_pylist(), output.slice(first, rows).is_valid().to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, back], names=[*keep, "restored"])

    return coded.select(*keep).mapInArrow(run, f"{schema}, restored string")
