"""Byte-level BPE encoding and decoding by prefix dynamic programming.

A text is cut into matches of the tokenizer's pattern, and each match is
encoded by itself. Within a match every byte prefix has exactly one valid
last token: the token that ends there, starts where another prefix ends, and
would not be merged across that border by BPE. Storing this last token per
prefix gives the encoding by walking back from the end, makes appends exact
(earlier entries never change) and limits a re-encoding after an edit to the
bytes near it.

Whether BPE leaves a border between two tokens standing is decided from their
merge histories alone (``Vocabulary.border_holds``).

Defined results: a null or empty text has no tokens and decodes to no bytes;
repeated rows are encoded alike; an empty table gives an empty result; other
columns are passed through or not read. Any byte string of the vocabulary's
bytes can be encoded, of any length.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import range_hashes, text_chunks, whole_rows, with_row

NEVER = 1 << 62
CACHE = 1 << 17        # encoded matches of a generation; a worker remembers two (about 50 MB)
ROWS = 512             # texts decoded at a time
TEXT = 1 << 20         # bytes of text encoded at a time


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines ``base64(token) rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class Vocabulary:
    """Tokens with their merge histories."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        self.usable = dict(ranks)            # without tokens that merges never reach
        for t in ranks:
            if len(t) > 1:
                parts = self._merge(t, ranks[t])
                if len(parts) == 2:
                    self.halves[t] = (parts[0], parts[1])
                else:
                    del self.usable[t]
        # lengths of the usable tokens that end with given bytes, long ones first: by
        # the last four bytes, and for others the length three or less
        by_tail: dict[bytes, set] = {}
        for t in self.usable:
            if len(t) > 3:
                by_tail.setdefault(t[-4:], {2, 1} | ({3} if t[-3:] in self.usable else set())).add(len(t))
        self.lengths = {t: tuple(sorted(n, reverse=True)) for t, n in by_tail.items()}
        self.threes = {t for t in self.usable if len(t) == 3}
        self.matches = Encoded(self)         # kept by a worker from task to task
        self._left: dict[int, list] = {}
        self._right: dict[int, list] = {}
        self.holds: dict[int, bool] = {}

    def _merge(self, data: bytes, below: int) -> list[bytes]:
        """Plain BPE with the merges of lower rank than ``below``."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], below)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts of a token that touch its right (1) or left (0) border, from
        a single byte to the whole, each with the rank of the merge that ends it."""
        out, t, end = [], self.tokens[token], NEVER
        while True:
            out.append((t, end))
            if len(t) == 1:
                return out[::-1]
            end = self.ranks[t]
            t = self.halves[t][side]

    def border_holds(self, left: int, right: int) -> bool:
        """Whether BPE never merges across the border between two tokens.

        At any time one part of either token touches the border. The two
        would merge if their joint rank comes before the merge that takes
        either of them away (of equal merges the one further left goes first).
        """
        key = left << 32 | right
        if key in self.holds:
            return self.holds[key]
        a = self._left.get(left)
        if a is None:
            a = self._left[left] = self._spine(left, 1)
        b = self._right.get(right)
        if b is None:
            b = self._right[right] = self._spine(right, 0)
        rank, i, j, holds = self.ranks.get, 0, 0, True
        while True:
            x, x_end = a[i]
            y, y_end = b[j]
            r = rank(x + y)
            if r is not None and r < x_end and r <= y_end:
                holds = False
                break
            if x_end == NEVER and y_end == NEVER:
                break
            if x_end <= y_end:
                i += 1
            else:
                j += 1
        if len(self.holds) > 2 * CACHE:
            self.holds.clear()
        self.holds[key] = holds
        return holds


class PrefixTable:
    """The unique valid last token of every prefix of one match."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, data: bytes, last: list[int], end: int) -> None:
        """Add the entries of the prefixes up to ``end``, longest last token first
        (which one is tried first is only a matter of speed)."""
        v = self.v
        rank, known, lengths, threes = v.usable.get, v.holds.get, v.lengths.get, v.threes
        for e in range(len(last), end + 1):
            of = lengths(data[e - 4:e]) if e > 3 else None
            if of is None:
                of = (3, 2, 1) if e > 2 and data[e - 3:e] in threes else (2, 1)
            for n in of:
                if n > e:
                    continue
                start = e - n
                t = rank(data[start:e])
                if t is None:
                    continue
                if start:
                    holds = known(last[start] << 32 | t)
                    if holds is None:
                        holds = v.border_holds(last[start], t)
                    if not holds:
                        continue
                last.append(t)
                break
            else:
                raise ValueError(f"no token for byte {data[e - 1]}")

    def append(self, more: bytes) -> None:
        """Extend the match; no earlier entry changes."""
        self.data += more
        self._fill(self.data, self.last, len(self.data))

    def become(self, data: bytes) -> PrefixTable:
        """Turn into the table of another match; entries of shared prefixes stay."""
        k, n, old = 0, min(len(data), len(self.data)), self.data
        while k < n and data[k] == old[k]:
            k += 1
        del self.last[k + 1:]
        self.data = data
        self._fill(data, self.last, len(data))
        return self

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes ``start:end``; returns how many entries were computed.
        Entries after the edit are kept from where a whole token length of
        them came out as before."""
        old, shift = self.last, len(new) - (end - start)
        data = self.data[:start] + new + self.data[end:]
        last = old[:start + 1]
        same, done, at = 0, 0, start + len(new)
        for e in range(start + 1, len(data) + 1):
            self._fill(data, last, e)
            done += 1
            same = same + 1 if e > at and last[e] == old[e - shift] else 0
            if same >= self.v.longest:
                last += old[e - shift + 1:]
                break
        self.data, self.last = data, last
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            t = self.last[end]
            out.append(t)
            end -= len(self.v.tokens[t])
        return out[::-1]


class Encoded(dict):
    """Native int32 ids of a match, encoded on first sight."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        self.old: dict[bytes, bytes] = {}    # the generation before

    def __reduce__(self):                    # travels empty
        return Encoded, (self.v,)

    def _keep(self, match: bytes, ids: bytes) -> None:
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        if len(match) <= 64:
            self[match] = ids

    def __missing__(self, match: bytes) -> bytes:
        return self.many([match])[0]

    def many(self, matches: list[bytes]) -> list[bytes]:
        """The ids of different matches. New ones are taken in sorted order, so
        that each begins with the prefixes that it shares with the one before."""
        out = [self.get(m) for m in matches]
        new = []
        for i, m in enumerate(matches):
            if out[i] is None:
                out[i] = self.old.get(m)
                if out[i] is None and (whole := self.v.ranks.get(m)) is not None:
                    out[i] = array("i", [whole]).tobytes()
                if out[i] is None:
                    new.append((m, i))
                else:
                    self._keep(m, out[i])
        table = PrefixTable(self.v)
        for m, i in sorted(new):
            out[i] = array("i", table.become(m).ids()).tobytes()
            self._keep(m, out[i])
        return out


# ------------------------------------------------------- pattern matches ----
# Byte classes for texts whose characters beyond ASCII are all letters:
# 0 white space, 1 letter, 2 digit, 3 other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[0x30:0x3A] = 2
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 1
# Fixed value: the endings that the pattern takes together with an apostrophe.
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def match_starts(data: np.ndarray) -> np.ndarray:
    """Where the pattern's matches start in a text of the simple kind above."""
    n = len(data)
    kind = _CLASS[data]
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    # a single space goes with what follows; another last white space stands alone
    p = np.flatnonzero(start[1:] & (kind[:-1] == 0)) + 1
    start[p - 1] = True
    start[p[data[p - 1] == 32]] = False
    p = np.flatnonzero((data == 39) & start)
    for ending in ENDINGS if len(p) else ():
        m = len(ending)
        q = p[p + m < n]
        for i, c in enumerate(ending):
            q = q[data[q + 1 + i] == c]
        start[q + 1] = False
        if m == 2:
            start[q + 2] = False
        start[q[q + 1 + m < n] + 1 + m] = True
    return np.flatnonzero(start)


class Matches:
    """Cut UTF-8 texts into matches of the pattern."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.letters: dict[str, bool] = {}

    def _simple(self, text: bytes) -> bool:
        if text.isascii():
            return True
        for c in set(text.decode()):
            if c > "\x7f":
                ok = self.letters.get(c)
                if ok is None:
                    ok = self.letters[c] = regex.fullmatch(r"\p{L}", c) is not None
                if not ok:
                    return False
        return True

    def starts(self, text: bytes) -> np.ndarray:
        """Where the matches of a text begin; each ends where the next one begins."""
        if not text:
            return np.zeros(0, np.int64)
        if not self._simple(text):
            sizes = [len(m.encode()) for m in self.pattern.findall(text.decode())]
            return np.cumsum([0, *sizes[:-1]])
        return match_starts(np.frombuffer(text, np.uint8))

    def __call__(self, text: bytes) -> list[bytes]:
        cut = self.starts(text).tolist()
        return [text[a:b] for a, b in zip(cut, [*cut[1:], len(text)])]


# Fixed value: the pattern that the rules of ``match_starts`` state.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _take(values: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``values[at[i]:at[i] + n[i]]`` of all i, one after the other."""
    end = np.cumsum(n)
    return values[np.arange(end[-1] if len(end) else 0) + np.repeat(at - (end - n), n)]


def _distinct(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each distinct match, number of the distinct match of each):
    matches meet by their hashes, and the bytes decide."""
    _, first, of = np.unique(range_hashes(data, start, start + size), return_index=True, return_inverse=True)
    same = size == size[first[of]]
    at = np.flatnonzero(same)
    if len(at):
        own, n = start[at], size[at]
        same[at] = np.logical_and.reduceat(_take(data, own, n) == _take(data, start[first[of[at]]], n), np.cumsum(n) - n)
    odd = np.flatnonzero(~same)              # other matches of the same hash stand for themselves
    of[odd] = len(first) + np.arange(len(odd))
    first = np.concatenate((first, odd))
    return first, of


def _encode_batches(shared, pattern: str):
    """Each distinct match of ``TEXT`` bytes of texts is looked up once; its ids go to all its places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, cut = shared.value.matches, Matches(pattern)
        for whole in batches:
            if not whole.num_rows:
                continue
            for lo, hi, data, offs in text_chunks(whole.column(0), TEXT):
                raw, starts, per_text = data.tobytes(), [np.zeros(0, np.int64)], []
                for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    own = cut.starts(raw[a:b]) + a
                    starts.append(own)
                    per_text.append(len(own))
                start = np.concatenate(starts)
                size = np.diff(start, append=len(data))
                first, of = _distinct(data, start, size)
                found = encoded.many([raw[a:a + n] for a, n in zip(start[first].tolist(), size[first].tolist())])
                ids = np.frombuffer(b"".join(found), np.int32)
                n = np.array([len(x) // 4 for x in found], np.int64)
                per_match = n[of]
                done = np.concatenate(([0], np.cumsum(per_match)))
                sizes = done[np.concatenate(([0], np.cumsum(per_text)))].astype(np.int32)
                out = _take(ids, (np.cumsum(n) - n)[of], per_match)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(sizes), pa.array(out)), whole.column(1).slice(lo, hi - lo)], names=["tokens", "row"])
    return run


def _decode_batches(shared):
    """Task over (tokens, row) in parts of a few hundred rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value.tokens
        blob = np.frombuffer(b"".join(tokens), np.uint8)
        size = np.array([len(t) for t in tokens], np.int64)
        at = np.concatenate(([0], np.cumsum(size)))[:-1]
        for whole in batches:
            for lo in range(0, max(1, whole.num_rows), ROWS):
                batch = whole.slice(lo, ROWS)
                col, out = batch.column(0), []
                for own in col:
                    own = own.values.to_numpy(zero_copy_only=False) if own.is_valid else []
                    if len(own):
                        n = size[own]
                        end = np.cumsum(n)
                        where = np.arange(end[-1]) + np.repeat(at[own] - (end - n), n)
                        out.append(blob[where].tobytes())
                    else:
                        out.append(b"")
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), col, batch.column(1)],
                                                 names=["bytes", "tokens", "row"])
    return run


def _vocabulary(docs: DataFrame, vocabulary: Vocabulary, pattern: str):
    if pattern != PATTERN:
        raise ValueError("only the byte-level pattern of PATTERN is known here")
    return docs.sparkSession.sparkContext.broadcast(vocabulary)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text",
           columns: list[str] | None = None, pattern: str = PATTERN) -> DataFrame:
    """(tokens array<int>, row): the ids of every text, and ``columns`` of it
    (all by default) as a struct. The vocabulary, of fixed size, is broadcast."""
    src = whole_rows(docs, text, columns)
    return src.mapInArrow(_encode_batches(_vocabulary(docs, vocabulary, pattern), pattern),
                          with_row("tokens array<int>", src))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(bytes, tokens, row): the bytes that the ids stand for."""
    return encoded.select("tokens", "row").mapInArrow(
        _decode_batches(_vocabulary(encoded, vocabulary, PATTERN)), with_row("bytes binary, tokens array<int>", encoded))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text",
               columns: list[str] | None = None, pattern: str = PATTERN) -> DataFrame:
    """``decode(encode(docs))`` in one pass of the tasks."""
    src = whole_rows(docs, text, columns)
    shared = _vocabulary(docs, vocabulary, pattern)
    there, back = _encode_batches(shared, pattern), _decode_batches(shared)
    return src.mapInArrow(lambda batches: back(there(batches)), with_row("bytes binary, tokens array<int>", src))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) with the ranks of ``path``."""
    v = Vocabulary(load_ranks(path))
    return round_trip(docs, v, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: ids and decoded bytes of every document."""
    import public_tokenizers
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                   public_tokenizers.path("byte_bpe_50k.tiktoken"))
