"""Edit-aware token counts.

Each document keeps a segment tree: its leaves are runs of whole pre-tokens
with their lengths in characters and in tokens, its inner nodes the sums of
their children. An edit finds its leaf by descending the tree, re-encodes from
that leaf's first character up to the first old leaf boundary that the new
pre-tokens meet again, and updates the sums above the leaves that changed. The
rest of the document is not encoded again.

Where a pre-token ends depends on no character later than one beyond its end,
and no pre-token depends on text before it. So re-encoding may start at the
leaf that holds the character two places before the edit, and may stop at any
old boundary after it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame

from bazaar.llm.bpe_transducer import MAX_MEMO, MEMO_CHARS, Transducer, split_pieces
from bazaar.llm.common import pick
from bazaar.llm.vocab import load_ranks

LEAF_CHARS = 128   # a leaf holds the pre-tokens that start within so many characters
CONTEXT = 2
BEYOND = 8         # characters read beyond a boundary, more than CONTEXT
ROWS_OUT = 512
EDIT = "struct<start:long,length:long,insert:string>"


class _Tokens(dict):
    """Token counts of short pre-tokens."""

    def __init__(self, run: Transducer):
        super().__init__()
        self.run = run

    def __missing__(self, piece: str) -> int:
        n = len(self.run.encode(piece.encode("utf-8")))
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MAX_MEMO:
                self.clear()
            self[piece] = n
        return n


class Counter:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.tokens = _Tokens(Transducer(ranks))

    def leaves(self, parts: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the leaves of successive pre-tokens."""
        chars, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for part in parts:
            if part:
                c = np.fromiter(map(len, part), np.int64, len(part))
                starts = np.cumsum(c) - c
                first = np.flatnonzero(np.diff(starts // LEAF_CHARS, prepend=-1))
                chars.append(np.add.reduceat(c, first))
                tokens.append(np.add.reduceat(np.fromiter(map(self.tokens.__getitem__, part), np.int64, len(part)), first))
        return np.concatenate(chars), np.concatenate(tokens)


@functools.lru_cache(maxsize=2)
def counter(vocab: str, pattern: str) -> Counter:
    """One per Python worker: its states and counts serve all its tasks."""
    return Counter(load_ranks(vocab), pattern)


class SegmentTree:
    """Sums of characters and tokens. Node 1 is the root, node i has the
    children 2i and 2i + 1, the leaves are the last half; unused leaves are
    empty."""

    def __init__(self, chars: Sequence[int], tokens: Sequence[int]):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.chars, self.tokens = ([0] * self.size + list(x) + [0] * (self.size - len(x)) for x in (chars, tokens))
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    @classmethod
    def of_nodes(cls, chars: list[int], tokens: list[int]) -> SegmentTree:
        tree = cls.__new__(cls)
        tree.size, tree.chars, tree.tokens = len(chars) // 2, chars, tokens
        return tree

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one at most), and
        that leaf's first character."""
        at, i, start = max(0, min(at, self.chars[1] - 1)), 1, 0
        while i < self.size:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def replace(self, first: int, stop: int, chars: list[int], tokens: list[int]) -> int:
        """Put new leaves in the place of ``first``..``stop``, and update the
        sums above; how many sums. If they are more than the old ones, the
        leaves are laid out anew, without encoding anything."""
        if len(chars) > stop - first:
            old = [x[self.size:] for x in (self.chars, self.tokens)]
            self.__init__(*([n for n, c in zip(x[:first] + y + x[stop:], old[0][:first] + chars + old[0][stop:]) if c]
                            for x, y in zip(old, (chars, tokens))))
            return self.size - 1
        for i in range(stop - first):
            self.chars[self.size + first + i] = chars[i] if i < len(chars) else 0
            self.tokens[self.size + first + i] = tokens[i] if i < len(tokens) else 0
        low, high, updated = self.size + first, self.size + stop - 1, 0
        while low > 1:
            low, high = low >> 1, high >> 1
            for i in range(low, high + 1):
                self._sum(i)
            updated += high - low + 1
        return updated


def apply_edit(text: str, tree: SegmentTree, run: Counter, start: int, length: int, insert: str) -> tuple[str, int]:
    """The edited text, and how many characters were encoded again. A start or
    an end outside of the text is moved to its nearest end."""
    start = max(0, min(start, len(text)))
    end = max(start, min(start + length, len(text)))
    new, shift = text[:start] + insert + text[end:], len(insert) - (end - start)
    first, begin = tree.find(start - CONTEXT)
    # the old boundary to meet: after leaf ``last``, in old characters
    last, old = first, begin + tree.chars[tree.size + first]
    while True:
        while old < end and last + 1 < tree.size:
            last += 1
            old += tree.chars[tree.size + last]
        stop = old + shift
        # beyond the boundary, as much as its pre-token can depend on
        pieces = run.pattern.findall(new, begin, min(len(new), stop + BEYOND))
        chars, tokens, c, n, at = [], [], 0, 0, begin
        for piece in pieces:
            if at >= stop:
                break
            k = len(piece)
            c, at, n = c + k, at + k, n + run.tokens[piece]
            if c >= LEAF_CHARS:
                chars.append(c)
                tokens.append(n)
                c = n = 0
        if c:
            chars.append(c)
            tokens.append(n)
        if at == stop or last + 1 == tree.size:
            tree.replace(first, last + 1, chars, tokens)
            return new, at - begin
        end = old + 1  # not met: the next boundary


def edited_counts(docs: DataFrame, edits: Column, vocab: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", state: bool = True) -> DataFrame:
    """Token counts before and after the edits of each document.

    ``edits``: array of ``EDIT``, applied in order, each to the text that the
    ones before it left. Returns (id, n_tokens, n_tokens_after,
    n_chars_after, reencoded_chars), and with ``state`` also the edited text
    and its tree (``tree_chars``, ``tree_tokens``). Fed such a result, the
    function takes the trees from it and encodes nothing but what the new edits
    touch; without them it builds them. One row per input row, no shuffle.

    A null text counts as empty, a null edit or list of edits as none, null
    numbers as 0 and a null insert as empty. Repeated rows and null ids are
    each answered; texts of any length are read whole; other columns are
    ignored; an empty table gives an empty one. A tree must belong to the text
    beside it.
    """
    kept = {"tree_chars", "tree_tokens"} <= set(docs.columns)
    types = {id_col: "long", text_col: "string"} | ({"tree_chars": "array<int>", "tree_tokens": "array<int>"} if kept else {})
    own = pick(docs.withColumn("edits_", edits), **types, edits_=f"array<{EDIT}>")
    ints = pa.list_(pa.int32())
    schema = pa.schema([(id_col, pa.int64()), ("n_tokens", pa.int64()), ("n_tokens_after", pa.int64()),
                        ("n_chars_after", pa.int64()), ("reencoded_chars", pa.int64())]
                       + [(text_col, pa.string()), ("tree_chars", ints), ("tree_tokens", ints)] * state)

    def one(run: Counter, key: int | None, text: str | None, chars: list | None, tokens: list | None, edits: list | None):
        text = text or ""
        tree = SegmentTree.of_nodes(chars, tokens) if chars else SegmentTree(
            *(x.tolist() for x in run.leaves(split_pieces(run.pattern, text))))
        before, again = tree.tokens[1], 0
        for e in edits or []:
            if e is not None:
                text, n = apply_edit(text, tree, run, e["start"] or 0, e["length"] or 0, e["insert"] or "")
                again += n
        row = (key, before, tree.tokens[1], len(text), again)
        return row + (text, tree.chars, tree.tokens) * state

    def rows(batches):
        run = counter(vocab, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = [c.to_pylist() for c in batch.slice(at, ROWS_OUT).columns]
                trees = part[2:4] if kept else [[None] * len(part[0])] * 2
                out = zip(*(one(run, *x) for x in zip(part[0], part[1], *trees, part[-1])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return own.mapInArrow(rows, f"{id_col} long, n_tokens long, n_tokens_after long, n_chars_after long, "
                          "reencoded_chars long" + f", {text_col} string, tree_chars array<int>, tree_tokens array<int>" * state)
