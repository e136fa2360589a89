"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges are compiled into a transducer whose paths are the segmentations
of a piece into tokens in which every two neighbours are stable: merging the
bytes of both gives just these two back. A piece has exactly one such path,
its BPE encoding. A deterministic state is the set of paths still alive after
the bytes read so far: the token before, the place in the token trie, and the
tokens not yet sure. What all live paths share is emitted at once, so a token
waits for no more bytes than the longest token has. States and transitions
are made when first met and kept in a bounded table.

Decoding streams token bytes through an incremental UTF-8 state machine.
"""

from __future__ import annotations

import functools
import itertools
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bazaar.llm.common import pick
from bazaar.llm.vocab import load_ranks

MAX_STATES = 250_000      # kept deterministic states; beyond, the table starts anew
MAX_MEMO = 800_000        # kept outputs of whole pieces
MEMO_CHARS = 48           # longer pieces run through the transducer each time
WHOLE_CHARS = 1 << 20     # longer texts are split into pieces in steps
ROWS_OUT = 512            # rows of an output batch


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The defining merge loop: the lowest rank first, the leftmost on ties."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {i: t for t, i in ranks.items()}
        # trie: (node << 8 | byte) -> node; the token that ends at a node
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.leaf: list[bool] = [True]
        for t, i in ranks.items():
            node = 0
            for b in t:
                key = node << 8 | b
                nxt = self.child.get(key)
                if nxt is None:
                    self.child[key] = nxt = len(self.token)
                    self.leaf[node] = False
                    self.token.append(-1)
                    self.leaf.append(True)
                node = nxt
            self.token[node] = i
        self._stable: dict[tuple[int, int], bool] = {}
        self.states: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.moves: dict[int, tuple[int, tuple]] = {}
        self.flush: list[tuple] = []
        self._reset()

    def _reset(self) -> None:
        self.states.clear()
        self.known.clear()
        self.moves.clear()
        self.flush.clear()
        self._state(((-1, 0, ()),))

    def _state(self, paths: tuple) -> int:
        s = self.known.get(paths)
        if s is None:
            s = self.known[paths] = len(self.states)
            self.states.append(paths)
            self.flush.append(next((p for _, node, p in paths if node == 0), ()))
        return s

    def stable(self, left: int, right: int) -> bool:
        """Do the two tokens stay apart (left < 0: is the token its own encoding)?"""
        key = (left, right)
        ok = self._stable.get(key)
        if ok is None:
            want = [self.bytes_of[t] for t in key if t >= 0]
            if len(self._stable) > 8 * self.max_states:
                self._stable.clear()
            ok = self._stable[key] = merge_bytes(b"".join(want), self.ranks) == want
        return ok

    def _move(self, state: int, byte: int) -> tuple[int, tuple]:
        paths = []
        for before, node, unsure in self.states[state]:
            nxt = self.child.get(node << 8 | byte)
            if nxt is None:
                continue
            t = self.token[nxt]
            if t >= 0 and self.stable(-1, t) and (before < 0 or self.stable(before, t)):
                paths.append((t, 0, unsure + (t,)))
            if not self.leaf[nxt]:
                paths.append((before, nxt, unsure))
        sure = 0
        for column in zip(*(p[2] for p in paths)):
            if column.count(column[0]) < len(column):
                break
            sure += 1
        out = paths[0][2][:sure]
        paths = tuple(sorted((b, n, u[sure:]) for b, n, u in paths))
        if len(self.states) >= self.max_states:
            self._reset()
            return self._state(paths), out  # the move itself is not kept: its origin is gone
        move = self.moves[state << 8 | byte] = (self._state(paths), out)
        return move

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, moves = 0, self.moves
        for b in piece:
            move = moves.get(state << 8 | b)
            if move is None:
                move = self._move(state, b)
            state, sure = move
            if sure:
                out += sure
        out += self.flush[state]
        return out


class _Memo(dict):
    """Outputs of short pieces, as little-endian unsigned 32-bit ids."""

    def __init__(self, run: Transducer):
        super().__init__()
        self.run = run

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.run.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MAX_MEMO:
                self.clear()
            self[piece] = ids
        return ids


def split_pieces(pattern: regex.Pattern, text: str) -> Iterator[list[str]]:
    """The matches of the pattern in lists of bounded size."""
    if len(text) <= WHOLE_CHARS:
        yield pattern.findall(text)
        return
    found = (m.group() for m in pattern.finditer(text))
    while part := list(itertools.islice(found, 1 << 16)):
        yield part


class Encoder:
    """Texts to ids: pieces by the pattern, each through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.memo = _Memo(Transducer(ranks))

    def encode(self, text: str) -> bytes:
        get = self.memo.__getitem__
        return b"".join(b"".join(map(get, part)) for part in split_pieces(self.pattern, text))


class Utf8Stream:
    """Incremental UTF-8 state machine: bytes in any cuts to text. The state
    is the begun character: its bytes so far and how many it needs."""

    def __init__(self):
        self.begun = b""

    @staticmethod
    def _need(lead: int) -> int:
        return 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        end = len(data)
        for back in range(1, min(3, end) + 1):
            b = data[end - back]
            if b & 0xC0 != 0x80:  # a lead byte, or a byte alone
                if self._need(b) > back:
                    end -= back
                break
        self.begun = data[end:]
        return data[:end].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {i: t for t, i in ranks.items()}

    def stream(self, ids: bytes, step: int = 1 << 16) -> Iterable[str]:
        get, utf8 = self.bytes_of.__getitem__, Utf8Stream()
        for at in range(0, len(ids), 4 * step):
            yield utf8.feed(b"".join(map(get, array("I", ids[at:at + 4 * step]))))
        yield utf8.close()

    def decode(self, ids: bytes) -> str:
        return "".join(self.stream(ids))


@functools.lru_cache(maxsize=2)
def coders(vocab: str, pattern: str) -> tuple[Encoder, Decoder]:
    """One of each per Python worker: the transducer's states and the memo
    serve all tasks of the worker."""
    ranks = load_ranks(vocab)
    return Encoder(ranks, pattern), Decoder(ranks)


def encode_texts(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", decode: bool = False) -> DataFrame:
    """(id, ids), and with ``decode`` also ``decoded``, the text that the ids
    give back: one row per input row, without a shuffle.

    ids: little-endian unsigned 32-bit token ids. A null text counts as empty
    (no ids, empty decoded text); repeated rows and null document ids are each
    answered; very long texts and pieces are read in steps; an empty table gives
    an empty one. Other columns are ignored. ``vocab`` must be readable on every executor.
    """
    fields = [(id_col, pa.int64()), ("ids", pa.binary())] + [("decoded", pa.string())] * decode
    schema = f"{id_col} long, ids binary" + ", decoded string" * decode

    def run(batches):
        encoder, decoder = coders(vocab, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = [encoder.encode(t or "") for t in part.column(1).to_pylist()]
                cols = [part.column(0), pa.array(ids, pa.binary())]
                if decode:
                    cols.append(pa.array(map(decoder.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(fields))

    return pick(docs, **{id_col: "long", text_col: "string"}).mapInArrow(run, schema)
