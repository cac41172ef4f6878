"""Byte-level BPE over whole partitions with an index of pair occurrences.

The words of a partition's texts are laid out in one chain of symbols. An index maps every pair that has a merge to all its
positions in the chain. Ranks that have positions are applied in ascending order: all occurrences of the pair are joined from
left to right, and the lists of the pairs that appear beside them are extended; positions that a merge has made stale are
recognised by their symbols when their own rank comes up. A word met before in the partition is not laid out again.

A merge can only make pairs of higher rank, because its token is a part of later merges alone (checked when a file is loaded),
so one ascending pass gives each word what merging its lowest pair again and again would give.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.llm.common import ship
from haulmark.llm.tokens import PATTERN, PRINTABLE

#: Characters of text laid out in one index, and words a partition remembers. Neither changes a result.
INDEX_CHARS = 2_000_000
KNOWN_RUNS = 250_000
#: From this many positions on a list is joined by array operations.
MANY = 48
#: White space of the splitting pattern.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

_loaded: dict[str, BytePairs] = {}


def byte_pairs(path: str) -> BytePairs:
    """The vocabulary of a file, read once per worker."""
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]


class BytePairs:
    """Merges, token bytes and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        _supported(spec, model)
        vocab: dict[str, int] = model["vocab"]
        others = [b for b in range(256) if b not in set(PRINTABLE)]
        to_byte = {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}
        self.base = np.zeros(256, np.int64)
        for char, byte in to_byte.items():
            self.base[byte] = vocab[char]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.gap = max(*vocab.values(), *self.added.values(), 0) + 1
        self.width = self.gap + 1
        self.tokens: dict[int, bytes] = {i: bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
                                         for token, i in vocab.items()}
        self.tokens |= {i: content.encode() for content, i in self.added.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self._check_order()
        self.rank_of = {a * self.width + b: r for r, (a, b, _) in enumerate(self.pairs)}
        by_key = sorted(self.rank_of.items())
        self.keys = np.array([k for k, _ in by_key] or [-1], np.int64)
        self.ranks = np.array([r for _, r in by_key] or [-1], np.int64)
        self.word = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.unsettled = _unsettled()
        self.known_runs: dict[str | int, bytes] = {}
        self.known_words: dict[str, bytes] = {}
        self._own = None
        self._path = path

    def _check_order(self) -> None:
        """A token may take part only in merges after every merge that makes it."""
        made, used = {}, {}
        for r, (a, b, new) in enumerate(self.pairs):
            made[new] = r
            for part in (a, b):
                used.setdefault(part, r)
        if any(used.get(t, r + 1) <= r for t, r in made.items()):
            raise ValueError("the file merges a token before it is made")

    # ------------------------------------------------------------ splitting
    def _sections(self, text: str) -> Iterator[str | int]:
        """Stretches of ordinary text and ids of added tokens."""
        at = 0
        for m in self.cut.finditer(text) if self.cut else ():
            if m.start() > at:
                yield text[at:m.start()]
            yield self.added[m.group()]
            at = m.end()
        if at < len(text):
            yield text[at:]

    def _runs(self, text: str) -> list[str | int]:
        """Runs without white space, each with a blank before it, and white space between: no word crosses their ends."""
        if not self.cut or not self.cut.search(text):
            return RUNS.findall(text)
        return [r for s in self._sections(text) for r in ([s] if isinstance(s, int) else RUNS.findall(s))]

    def _words(self, run: str) -> list[str]:
        """Words of a run; the file's library cuts runs with characters on whose class Unicode versions differ."""
        if self.unsettled.isdisjoint(run):
            return self.word.findall(run)
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_file(self._path).pre_tokenizer
        return [run[a:b] for _, (a, b) in self._own.pre_tokenize_str(run)]

    # ------------------------------------------------------------- encoding
    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        runs = [self._runs(t) for t in texts]
        if len(self.known_runs) > KNOWN_RUNS:
            self.known_runs.clear()
            self.known_words.clear()
        for i in self.added.values():
            self.known_runs[i] = np.array(i, "<u4").tobytes()
        new = list(set().union(*runs) - self.known_runs.keys())
        plain = self.unsettled.isdisjoint("".join(new))
        cut = list(map(self.word.findall if plain else self._words, new))
        words = list(set().union(*cut) - self.known_words.keys())
        known = self.known_words
        known.update(zip(words, self._merged(words)))
        self.known_runs.update((r, known[w[0]] if len(w) == 1 else b"".join([known[x] for x in w])) for r, w in zip(new, cut))
        return [b"".join(map(self.known_runs.__getitem__, r)) for r in runs]

    def _merged(self, words: list[str]) -> list[bytes]:
        """Ids of each word, all words in one chain. A gap before and behind each word keeps pairs inside it."""
        if not words:
            return []
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        of = np.repeat(np.arange(len(data)), sizes)
        place = np.arange(len(of)) + of + 1
        chain = np.full(len(of) + len(data) + 1, self.gap, np.int32)
        chain[place] = self.base[np.frombuffer(b"".join(data), np.uint8)]
        symbols = self._apply(chain)
        alive = symbols[place] >= 0
        flat = symbols[place[alive]].astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(of[alive], minlength=len(data))) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def ranks_at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where none merges it."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def _apply(self, chain: np.ndarray) -> np.ndarray:
        """The chain after all merges; positions swallowed by their left neighbour hold -1."""
        lists = _Lists(self, chain)
        while lists.active:
            rank = heapq.heappop(lists.active)
            a, b, new = self.pairs[rank]
            at = lists.index.pop(rank)
            if len(at) < MANY or a == b:  # of a run of one symbol every second place joins: only in order is it known which
                lists.join_few(sorted(at), a, b, new)
            else:
                lists.join_many(np.array(at, np.int32), a, b, new)
        return lists.symbols

    # ------------------------------------------------------------- decoding
    def decode(self, ids: bytes) -> str:
        """Text of ids; ids outside the vocabulary add nothing, bytes that are no UTF-8 become U+FFFD."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        try:
            return b"".join(map(self.tokens.__getitem__, numbers)).decode("utf-8", "replace")
        except KeyError:
            return b"".join(self.tokens.get(i, b"") for i in numbers).decode("utf-8", "replace")


class _Lists:
    """A chain of symbols, linked both ways, and the positions of each rank's pair in it."""

    def __init__(self, pairs: BytePairs, chain: np.ndarray):
        n = len(chain)
        self.pairs = pairs
        self._sym = array("i", chain.astype(np.int32).tobytes())
        self._next = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes())
        self._last = array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
        # The same memory, for single places and for many at once.
        self.symbols, self.following, self.before = (np.frombuffer(x, np.int32) for x in (self._sym, self._next, self._last))
        self.index: dict[int, array] = {}
        self.active: list[int] = []
        self._post(np.arange(n - 1), chain[:-1], chain[1:])

    def _post(self, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Add positions to the lists of the pairs that are there."""
        ranks = self.pairs.ranks_at(left, right)
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order].astype(np.int32), ranks[order]
        starts = np.flatnonzero(np.diff(ranks, prepend=-1))
        for rank, a, b in zip(ranks[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(at)]):
            self._list(rank).frombytes(at[a:b].tobytes())

    def _list(self, rank: int) -> array:
        if rank not in self.index:
            self.index[rank] = array("i")
            heapq.heappush(self.active, rank)
        return self.index[rank]

    def join_few(self, at: list[int], a: int, b: int, new: int) -> None:
        sym, following, before, rank_of, width = self._sym, self._next, self._last, self.pairs.rank_of.get, self.pairs.width
        for p in at:
            q = following[p]
            if sym[p] != a or sym[q] != b:
                continue  # an earlier merge took one of the two
            sym[p], sym[q] = new, -1
            right, left = following[q], before[p]
            following[p], before[right] = right, p
            rank = rank_of(sym[left] * width + new)
            if rank is not None:
                self._list(rank).append(left)
            rank = rank_of(new * width + sym[right])
            if rank is not None:
                self._list(rank).append(p)

    def join_many(self, at: np.ndarray, a: int, b: int, new: int) -> None:
        """As ``join_few`` for two different symbols, whose places never overlap."""
        sym, following, before = self.symbols, self.following, self.before
        at = np.sort(at[sym[at] == a])
        at = at[np.diff(at, prepend=-1) > 0]
        at = at[sym[following[at]] == b]
        taken = following[at]
        right = following[taken]
        sym[at], sym[taken] = new, -1
        following[at], before[right] = right, at
        left = before[at]
        left = left[sym[left] != new]  # a joined neighbour posts the pair as its own right one
        place = np.concatenate([left, at])
        self._post(place, sym[place], sym[following[place]])


def _supported(spec: dict, model: dict) -> None:
    before, after = spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    plain = (model.get("type") == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True)
             and not before.get("add_prefix_space") and after.get("type") == "ByteLevel"
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
             and not any(t.get(k) for t in spec.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip")))
    if not plain:
        raise ValueError("only byte-level BPE files without normalizer, prefix space or stripping tokens are read")


def _unsettled() -> set[str]:
    """Letters and numbers to ``regex`` that the older tables of this Python do not know: libraries may class them differently."""
    every = "".join(map(chr, (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)))
    return {c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"}


def _added(df: DataFrame, source: str, target: str, kind: T.DataType, run) -> DataFrame:
    """``df`` with column ``target`` made by ``run`` from batches and the place of column ``source``; other columns pass through.

    Columns go by their places, so that a name may hold dots or quotes.
    """
    names = df.columns
    at, to = names.index(source), names.index(target) if target in names else len(names)
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)]
    fields[to:to + 1] = [T.StructField(f"c{to}", kind)]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in run(batches, at):
            columns = list(batch.columns)
            columns[to:to + 1] = [values]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    made = df.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(put, T.StructType(fields))
    return made.toDF(*names[:to], target, *names[to + 1:])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with binary column ``ids``: the ids of whole texts as little-endian unsigned 32-bit integers, nothing added.

    ``path`` names the vocabulary file, the same on every machine. Strings of added tokens are those tokens. A null or empty
    text has no ids; blanks, runs of a million equal characters and any other text encode as the file's library does it. All
    other columns and repeated rows stay; a column named ``ids`` is replaced. Nothing is shuffled: every partition builds
    its own index, over about ``INDEX_CHARS`` characters of words it has not met at a time (a longer text by itself).
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        pairs = byte_pairs(path)
        waiting: list[tuple[pa.RecordBatch, list[str]]] = []
        chars = 0

        def flush() -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
            found = iter(pairs.encode(t for _, texts in waiting for t in texts))
            for batch, texts in waiting:
                yield batch, pa.array([next(found) for _ in texts], pa.binary())

        for batch in batches:
            for piece in _pieces(batch, at):
                texts = [(x.as_py() or b"").decode("utf-8", "replace") for x in piece.column(at).cast(pa.binary())]
                waiting.append((piece, texts))
                chars += sum(map(len, texts))
                if chars >= INDEX_CHARS:
                    yield from flush()
                    waiting, chars = [], 0
        yield from flush()
    return _added(df, text, ids, T.BinaryType(), run)


def _pieces(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``INDEX_CHARS`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at).cast(pa.binary())), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // INDEX_CHARS
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], len(sizes)]):
        yield batch.slice(a, b - a)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with string column ``text``: what the ids of column ``ids`` stand for, special tokens included.

    Null ids give a null text, no ids an empty one; ids outside the vocabulary add nothing. A column named ``text`` is replaced.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        pairs = byte_pairs(path)
        for batch in batches:
            yield batch, pa.array([None if x is None else pairs.decode(x) for x in batch.column(at).to_pylist()], pa.string())
    return _added(df, ids, text, T.StringType(), run)


def n_tokens(ids: str = "ids") -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them, for every row of ``docs``."""
    coded = encode(docs.select("doc_id", "text"), path).drop("text")
    return decode(coded, path).select("doc_id", n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                                      F.sha2("decoded", 256).alias("decoded_sha256"))
