"""Byte-pair encoding as a streaming transducer with bounded lookahead, and incremental decoding.

A text is cut at special tokens, then into pretokens, and the merges run inside each pretoken. A pretoken of any length is
encoded through a window: tokens that end at least ``lookahead`` bytes before the window's end can no longer change, whatever
follows, so they are emitted and the window moves on. The lookahead is computed from the merge list (``sufficient_lookahead``).
Working memory is one window, one batch of pretokens and a bounded cache, whatever the length of the text. Decoding feeds the
tokens' bytes through a UTF-8 state machine that holds at most one unfinished character.

Encoding works row by row without a shuffle. Null and empty texts give no tokens. Special tokens in a text become their ids.
"""

from __future__ import annotations

import codecs
import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed: the pattern that cuts a text into pretokens before the merges.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters and tokens handled at a time, cached pretokens, and the length in characters up to which one is cached.
PART, BATCH, CACHED, CACHED_CHARS = 32_768, 8192, 400_000, 48
#: Bytes up to which pairs are looked through instead of ordered.
SHORT = 48


def byte_alphabet() -> dict[str, int]:
    """Printable characters stand for themselves in vocabulary files, other bytes for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which no later input can change a token.

    Later input can only change a merge through a chain: a merge that takes place (or no longer does) at the right changes the
    token that the next merge of the chain, one of higher rank, needs as its right part. So each link reaches further left
    by its own left part, ranks rise along the chain, and the right part of a link starts with the left part of the link
    before. The longest such chain, found in one pass by rank, and one token that straddles the end bound the effect.
    """
    reach: dict[bytes, int] = {}
    longest = 0
    for left, right in merges:
        before = max((reach.get(right[:n], 0) for n in range(1, len(right) + 1)), default=0)
        here = len(left) + before
        longest = max(longest, here)
        reach[left] = max(reach.get(left, 0), here)
    return longest + max((len(a) + len(b) for a, b in merges), default=1)


class Codec:
    """A vocabulary file with its merges, ready to encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.made = [vocab[a + b] for a, b in pairs]
        self.never = len(pairs)
        self.single = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        self.bytes_of = {i: raw(s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.lookahead = sufficient_lookahead([(raw(a), raw(b)) for a, b in pairs])
        self.window = 4 * self.lookahead
        self.between = regex.compile(r"\S \S")
        self.pretoken = regex.compile(PRETOKEN)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def merged_short(self, data: bytes) -> list[int]:
        """``merged`` for a few bytes, where looking through all pairs is faster than keeping them in order."""
        ids = [self.single[b] for b in data]
        get, never, made = self.ranks.get, self.never, self.made
        found = [get(pair, never) for pair in zip(ids, ids[1:])]
        while found and (best := min(found)) < never:
            k = found.index(best)
            ids[k] = made[best]
            del ids[k + 1], found[k]
            if k:
                found[k - 1] = get((ids[k - 1], ids[k]), never)
            if k < len(found):
                found[k] = get((ids[k], ids[k + 1]), never)
        return ids

    def merged(self, data: bytes) -> list[int]:
        """Tokens of one window: the merge of lowest rank first, the leftmost of equals."""
        if len(data) <= SHORT:
            return self.merged_short(data)
        ids: list[int | None] = [self.single[b] for b in data]
        n, get = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, k) for k in range(n - 1) if (rank := get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] is None or nxt >= n or get((ids[k], ids[nxt])) != rank:
                continue
            ids[k], ids[nxt] = self.made[rank], None
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right < n and (again := get((ids[left], ids[right]))) is not None:
                    heapq.heappush(heap, (again, left))
        return [i for i in ids if i is not None]

    def stable(self, data: bytes) -> Iterator[list[int]]:
        """Tokens of a pretoken of any length, emitted as soon as they are stable."""
        at = 0
        while len(data) - at > self.window:
            end, out = at + self.window, []
            for token in self.merged(data[at:end]):
                width = len(self.bytes_of[token])
                if at + width > end - self.lookahead:
                    break
                out.append(token)
                at += width
            yield out
        yield self.merged(data[at:])

    def packed(self, pretoken: str) -> bytes:
        data = pretoken.encode("utf-8")
        pieces = self.stable(data) if len(data) > self.window else [self.merged(data)]
        out = b"".join([struct.pack(f"<{len(ids)}I", *ids) for ids in pieces])
        if len(pretoken) <= CACHED_CHARS:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[pretoken] = out
        return out

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids as little-endian unsigned 32-bit integers, piece by piece."""
        for k, piece in enumerate(self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]):
            if k % 2:
                yield struct.pack("<I", self.special[piece])
                continue
            get, cache = self.packed, self.cache
            for part in self.parts(piece):
                yield b"".join([cache.get(p) or get(p) for p in self.pretoken.findall(part)])

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts of about ``PART`` characters, cut before a blank between two other characters that are not white
        space: a pretoken always begins there."""
        at = 0
        while len(text) - at > PART:
            cut = self.between.search(text, at + PART)
            if not cut:
                break
            yield text[at : cut.start() + 1]
            at = cut.start() + 1
        yield text[at:]

    def decode(self, ids: bytes) -> Iterator[str]:
        """The text of packed ids, piece by piece; broken sequences become U+FFFD."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        step = 4 * BATCH
        for at in range(0, len(ids), step):
            part = ids[at : at + step]
            yield state.decode(b"".join(map(self.bytes_of.__getitem__, struct.unpack(f"<{len(part) // 4}I", part))))
        yield state.decode(b"", final=True)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per worker and file."""
    return Codec(path)


def _mapped(df: DataFrame, column: str, name: str, kind: T.DataType, make) -> DataFrame:
    """``df`` with ``column`` replaced by ``name`` = ``make(value)``.

    Only that column goes to Python, pickled by the hundred rows; Arrow batches would take all columns both ways by the ten thousand,
    which long values make large. Marked as not deterministic so that no plan evaluates it twice.
    """
    kept = [c for c in df.columns if c != column and c != name]
    made = F.udf(make, kind, useArrow=False).asNondeterministic()
    return df.select(*[F.col(f"`{c}`") for c in kept], made(F.col(f"`{column}`")).alias(name))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the text replaced by its packed token ids (binary)."""
    return _mapped(df, text, ids, T.BinaryType(), lambda v: b"".join(codec(path).encode(v or "")))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with packed token ids replaced by the text they stand for."""
    return _mapped(df, ids, text, T.StringType(), lambda v: "".join(codec(path).decode(v or b"")))
