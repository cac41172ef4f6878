"""Token ids of a byte-level BPE vocabulary file, inside tasks."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable

import numpy as np

#: Fixed values of the byte-level scheme: its splitting pattern, and the bytes that stand for themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: White-space runs from this many characters on are left to ``tokenizers``: ``tiktoken`` fails on runs of a million.
LONG_RUN = 10_000
_RUNS = re.compile(r"\s\s+")

_encoders: dict[tuple[str, bool], Callable[[str], list[int]]] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str, ordinary: bool = True) -> Callable[[str], list[int]]:
    """Text to ids, nothing added. Loaded once per worker.

    Strings of the file's special tokens get the ids of those tokens, or those of ordinary text if ``ordinary``. Where the
    file's ids follow its merges, as in all files of this scheme, the ids come from the same vocabulary as ranks, which is four
    times as fast as reading the file with ``tokenizers``; any other file, any text with a white-space run of ``LONG_RUN`` and
    any text that holds an added token is read with ``tokenizers``.
    """
    if (path, ordinary) not in _encoders:
        _encoders[path, ordinary] = _ranked(path, ordinary) or _plain(path, ordinary)
    return _encoders[path, ordinary]


def array_encoder(path: str, ordinary: bool = True) -> Callable[[str], np.ndarray]:
    """As ``encoder``, into arrays: without a Python number per id where the ids come from ranks."""
    encode = encoder(path, ordinary)
    return getattr(encode, "arrays", None) or (lambda text: np.array(encode(text), np.uint32))


def _plain(path: str, ordinary: bool):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = ordinary
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def _ranked(path: str, ordinary: bool):
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    plain = (model.get("type") == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True)
             and not before.get("add_prefix_space") and not model.get("byte_fallback") and len(vocab) == 256 + len(merges)
             and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)))
    if not plain:
        return None
    import tiktoken

    others = [b for b in range(256) if b not in set(PRINTABLE)]
    to_byte = {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in vocab.items()}
    by_rank = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [t["content"] for t in spec.get("added_tokens") or [] if not (ordinary and t.get("special"))]
    slow: list[Callable[[str], list[int]]] = []  # loaded when a text needs it

    def is_plain(text: str) -> bool:
        return not _long_run(text) and not any(t in text for t in added)

    def other(text: str) -> list[int]:
        if not slow:
            slow.append(_plain(path, ordinary))
        return slow[0](text)

    def encode(text: str) -> list[int]:
        return by_rank.encode_ordinary(text) if is_plain(text) else other(text)

    def arrays(text: str) -> np.ndarray:
        return by_rank.encode_to_numpy(text, disallowed_special=()) if is_plain(text) else np.array(other(text), np.uint32)

    encode.arrays = arrays
    return encode


def _long_run(text: str) -> bool:
    return len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in _RUNS.finditer(text))


def pieces(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document of n tokens: whole, or cut into ``limit`` tokens with only the first piece shorter."""
    if n <= limit:
        return [(0, n)]
    first = n % limit
    return ([(0, first)] if first else []) + [(s, limit) for s in range(first, n, limit)]


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
