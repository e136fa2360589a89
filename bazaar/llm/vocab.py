"""Vocabulary files of byte-level BPE tokenizers, read by path."""

from __future__ import annotations

import base64
import functools
import json


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file
    of characters: bytes that print stand for themselves, the others take the
    code points from 256 on, in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, from a rank file (base64 and rank a line) or from a
    tokenizer's JSON with a byte-level BPE model whose ids follow its merges."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (model["type"] == "BPE" and not model.get("byte_fallback") and spec.get("normalizer") is None
                 and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space"))
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError(f"{path}: ids don't follow the order of the merges")
        alphabet = byte_alphabet()
        return {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()
                if all(c in alphabet for c in token)}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
