"""Best-fit packing of token sequences by exact-complement hashing.

Packing needs only the number of pieces of each length, at most ``limit``
numbers whatever the size of the corpus. The plan is made from that
histogram: for each length, longest first, single, pair and triple sums of
the lengths still available are looked up for the exact gap, and combinations
that fill it are consumed as often as the counts allow; what is left goes
best-fit, longest first (see ``make_plan``). A plan is a list of (lengths, times). Each step uses
up a length or an open kind of bin, so the plan doesn't grow with the corpus.

The pieces then take their places in Spark: the i-th piece of a length falls
into the slot of the plan that covers i.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import pick, stored
from bazaar.llm.vocab import load_ranks

ROWS_OUT = 512
KEPT_BACK = (0.0, 0.02, 0.05, 0.1, 0.2, 0.4)  # shares of each length kept back for best-fit, of which the best is taken


@functools.lru_cache(maxsize=2)
def coder(vocab: str, pattern: str):
    """One per Python worker."""
    import tiktoken

    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=load_ranks(vocab), special_tokens={})


def cut_documents(docs: DataFrame, vocab: str, pattern: str, limit: int = 2048, end_id: int = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): the tokens of each document followed by
    ``end_id``, cut only where they exceed ``limit``; then all pieces but the
    first hold ``limit`` tokens. ids: little-endian unsigned 32-bit. A text of
    any length is encoded whole; an empty table has no pieces.

    A null or empty text gives one piece of the end token. Repeated rows and
    null ids are cut like any other; other columns are ignored. ``vocab`` is
    a byte-level BPE tokenizer file readable on every executor.
    """
    schema = pa.schema([(id_col, pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        encode = coder(vocab, pattern).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                rows = []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.array(encode(text or "") + [end_id], dtype="<u4")
                    start, stop = 0, len(ids) % limit or limit
                    for piece in range(-(-len(ids) // limit)):
                        rows.append((key, piece, start, stop - start, ids[start:stop].tobytes()))
                        start, stop = stop, stop + limit
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return pick(docs, **{id_col: "long", text_col: "string"}).mapInArrow(
        run, f"{id_col} long, piece int, start long, length long, ids binary")


class _Lengths:
    """Availability counts, and combinations of them with a given sum."""

    def __init__(self, counts: np.ndarray):
        self.n = counts

    def take(self, lengths: tuple[int, ...], most: int | None = None) -> int:
        """Consume the combination as often as it is available."""
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        times = min(int(self.n[x]) // k for x, k in need.items())
        times = times if most is None else min(times, most)
        for x, k in need.items():
            self.n[x] -= k * times
        return times

    def pairs(self, total: int, top: int) -> np.ndarray:
        """The larger parts a <= top of available pairs a + b = total, largest first."""
        a = np.arange(min(total - 1, top), (total + 1) // 2 - 1, -1)
        return a[(self.n[a] > 0) & (self.n[total - a] > 0)]


def make_plan(histogram: Mapping[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, times): covers every piece of the histogram.

    Every plan consumes exact single, pair and triple sums. These can use up
    pieces that best-fit needs for the rest, so several plans are made, with
    different shares of each length kept back for best-fit. The plan of the
    fewest sequences is kept, the first of them on a tie.
    """
    return min((_plan(histogram, limit, kept) for kept in KEPT_BACK),
               key=lambda plan: sum(times for _, times in plan))


def _plan(histogram: Mapping[int, int], limit: int, kept: float) -> list[tuple[tuple[int, ...], int]]:
    counts = np.zeros(limit + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    back = np.ceil(counts * kept).astype(np.int64)
    back[limit] = 0
    counts -= back
    left, plan, residual = _Lengths(counts), [], []

    def use(lengths: tuple[int, ...]) -> None:
        if times := left.take(lengths):
            plan.append((lengths, times))

    for length in range(limit, 0, -1):
        gap = limit - length
        if gap == 0:
            use((length,))
            continue
        if gap <= length:
            use((length, gap))  # single sums
        for a in left.pairs(gap, length).tolist():  # pair sums
            if not counts[length]:
                break
            use((length, a, gap - a))
        if counts[length]:  # triple sums: a first part, and pairs for the rest
            for a in np.flatnonzero(counts[:min(gap - 1, length + 1)])[::-1].tolist():
                if 3 * a < gap or not counts[length]:
                    break
                for b in left.pairs(gap - a, a).tolist() if gap - a > 1 else ():
                    if not counts[length] or not counts[a]:
                        break
                    use((length, a, b, gap - a - b))
        if rest := int(counts[length] + back[length]):
            residual.append((length, rest))
        counts[length] = 0
    return plan + _best_fit(residual, limit)


def _best_fit(items: list[tuple[int, int]], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit of (length, pieces), longest first; bins of the same filling
    are handled together."""
    bins: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(limit + 1)]  # by gap
    some = np.zeros(limit + 1, bool)

    def put(filling: tuple[int, ...], times: int, gap: int) -> None:
        if times:
            bins[gap].append((filling, times))
            some[gap] = True

    for length, n in items:
        while n:
            fits = np.flatnonzero(some[length:])
            if len(fits):
                gap = length + int(fits[0])
                filling, times = bins[gap].pop()
                some[gap] = bool(bins[gap])
            else:
                gap, filling, times = limit, (), n
            each = min(gap // length, n)
            used = min(times, n // each)
            put(filling + (length,) * each, used, gap - each * length)
            if filling:
                put(filling, times - used, gap)
            n -= used * each
    return [x for kind in bins for x in kind]


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first, sequence, offset), sorted: from its ``first``-th
    piece on, a length falls into sequences from ``sequence`` on."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            rows.append((x, taken.get(x, 0), sequence, offset))
            taken[x] = taken.get(x, 0) + times
            offset += x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, limit: int = 2048, length_col: str = "length") -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: sequences hold at most
    ``limit`` tokens, gapless from offset 0, in as few sequences as the plan
    finds.

    Every row takes a place of its own, whatever its other columns hold, so
    repeated rows, nulls and ties need no rule; an empty table gives an empty
    result; lengths outside 1..limit raise. Keep long payloads out of the
    frame and join them to the result by key.
    """
    names = pieces.columns
    at = names.index(length_col)
    # stored before they are numbered: a chain of two Python steps would hold
    # two Python workers for each task
    wide = stored(pieces.toDF(*[f"c{i}_" for i in range(len(names))]), "pack-input")

    def number(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False)
            if len(lengths) and not (1 <= lengths.min() and lengths.max() <= limit):
                raise ValueError(f"piece lengths must be in 1..{limit}")
            order = np.argsort(lengths, kind="stable")
            _, first, n = np.unique(lengths[order], return_index=True, return_counts=True)
            nth = np.empty(len(lengths), np.int64)
            nth[order] = np.arange(len(lengths)) - np.repeat(first, n)
            nth += seen[lengths]
            np.add.at(seen, lengths, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(nth), part, np.int32)), pa.array(nth)],
                names=[*batch.schema.names, "part_", "nth_"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wide.schema)
    # stored: from here on a piece keeps its number, also if a task runs again
    numbered = stored(wide.mapInArrow(number, f"{schema}, part_ int, nth_ long"), "pack-pieces")
    length = f"c{at}_"
    counts = numbered.groupBy(length, "part_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(length).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("before_", F.coalesce(F.sum("n_").over(before), F.lit(0))), "pack-counts",
                    numbered.count())
    # at most ``limit`` rows
    histogram = {r[0]: r[1] for r in counts.groupBy(length).agg(F.sum("n_")).collect()}
    slots = _slots(make_plan(histogram, limit))
    top = 1 << 44

    def place(batches):
        keys = slots[:, 0] * top + slots[:, 1]
        for batch in batches:
            n, own = batch.num_columns, batch.column(at).to_numpy(zero_copy_only=False)
            nth = batch.column(n - 1).to_numpy(zero_copy_only=False)
            slot = np.searchsorted(keys, own * top + nth, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(slots[slot, 2] + nth - slots[slot, 1]), pa.array(slots[slot, 3])],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    placed = (numbered.join(counts.select(length, "part_", "before_"), [length, "part_"])
              .select(*wide.columns, (F.col("nth_") + F.col("before_")).alias("nth_"))
              .mapInArrow(place, f"{schema}, sequence_id long, offset long"))
    return placed.toDF(*names, "sequence_id", "offset")
