"""Byte-level BPE by merge replay over the words of many texts at once.

The distinct words of a lot of texts (``tokens.BATCH_BYTES``, some thousand
documents) form one corpus. An inverted index from token pair to the positions
where the pair stands is built once; merges are then taken in rank order, each
at all its positions at once, and only the pairs that touch a merged position
are looked up again. Words in which an earlier merge becomes possible on the way
are merged one by one. A worker keeps the ids of the word pieces it has met most,
so that a frequent word is merged once per worker. Words are not gathered across
workers: that would shuffle every distinct word of every lot, about the size of
the texts, to spare work that is less than the shuffle.

Defined cases: a null or empty text has no ids and decodes to no bytes; any
byte sequence can be encoded, since all 256 bytes have an id; rows that repeat
an id are encoded one by one; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import Encoder, gathered, lots

#: Unicode white space, which the pattern of the rank files means by \s.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, which is also their id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def pattern(text: str) -> regex.Pattern:
    """The split pattern with its white space spelled out."""
    spelled = text.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
    return regex.compile(spelled)


class Replay:
    """Merges by one rank file."""

    def __init__(self, rank_of: dict[bytes, int]):
        self.rank_of = rank_of
        self.byte_ids = np.array([rank_of[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = []
        for token, rank in rank_of.items():
            for k in range(1, len(token)):
                left, right = rank_of.get(token[:k]), rank_of.get(token[k:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, rank))
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], dtype=np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids, -1 where there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words, merged together, one after another, and the number of each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        n = len(ids)
        follow, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        follow[ends - 1] = -1
        before[starts] = -1
        rank = np.full(n, -1)
        inner = np.flatnonzero(follow >= 0)
        rank[inner] = self._ranks(ids[inner], ids[inner + 1])
        # The inverted index: rank of a pair -> positions of its left token.
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, p in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts)):
                held = index.get(r)
                if held is None:
                    index[r] = [p]
                    heapq.heappush(heap, r)
                else:
                    held.append(p)

        able = np.flatnonzero(rank >= 0)
        if len(able):
            post(able, rank[able])
        alive = np.ones(n, dtype=bool)
        odd: list[np.ndarray] = []
        while heap:
            now = heapq.heappop(heap)
            held = index.pop(now)
            p = held[0] if len(held) == 1 else np.concatenate(held)
            p = p[rank[p] == now]
            if not len(p):
                continue
            if len(p) > 1:
                p.sort()  # a position between two merges may have been posted twice
                p = p[np.concatenate(([True], p[1:] != p[:-1]))]
                # Of pairs that share a token, the first, the third and so on are merged.
                shared = follow[p[:-1]] == p[1:]
                if shared.any():
                    run = np.concatenate(([True], ~shared))
                    first = np.flatnonzero(run)
                    p = p[(np.arange(len(p)) - first[np.cumsum(run) - 1]) % 2 == 0]
            gone = follow[p]
            after = follow[gone]
            # One by one, the merge at p comes before that of the token after it: is there a lower one in between?
            beside = np.flatnonzero((after >= 0) & (rank[after] == now))
            if len(beside):
                between = self._ranks(np.full(len(beside), now), ids[after[beside]])
                odd.append(np.searchsorted(ends, p[beside[(between >= 0) & (between < now)]], side="right"))
            ids[p], rank[p], rank[gone], follow[p], alive[gone] = now, -1, -1, after, False
            inside = after >= 0
            before[after[inside]] = p[inside]
            left = before[p]
            # Only the pairs that touch a merged token are looked up again.
            touched = np.concatenate([p[inside], left[left >= 0]])
            if not len(touched):
                continue
            made = self._ranks(ids[touched], ids[follow[touched]])
            rank[touched] = made
            some = made >= 0
            if some.any():
                touched, made = touched[some], made[some]
                if made.min() < now:  # an earlier merge has become possible: such words are done one by one
                    odd.append(np.searchsorted(ends, touched[made < now], side="right"))
                post(touched, made)
        counts = np.add.reduceat(alive.astype(np.int64), starts) if n else np.zeros(0, np.int64)
        out = ids[alive]
        if any(map(len, odd)):
            parts = np.split(out, np.cumsum(counts)[:-1])
            for k in np.unique(np.concatenate(odd)).tolist():
                parts[k] = np.array(self.one_by_one(words[k]), dtype=np.int64)
            out = np.concatenate(parts)
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
        return out.astype(np.uint32), counts

    def one_by_one(self, word: bytes) -> list[int]:
        """Ids of one word by its lowest merge each time."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.rank_of.get(a + b, len(self.rank_of)) for a, b in zip(parts, parts[1:])]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k] == len(self.rank_of):
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.rank_of[x] for x in parts]


class ReplayEncoder(Encoder):
    """Whole texts by ``Replay``, with the remembered pieces of ``Encoder``."""

    def __init__(self, path: str, split: str):
        self.replay = Replay(ranks(path))
        self.split = pattern(split)
        self._forget()

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        listed = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        own = np.fromiter(map(self.replay.rank_of.get, listed, repeat(-1)), np.int64, len(listed))
        todo = np.flatnonzero(own < 0)
        sizes = np.ones(len(listed), dtype=np.int64)
        if not len(todo):
            return own.astype(np.uint32), sizes
        flat, sizes[todo] = self.replay.merge([listed[k] for k in todo.tolist()])
        merged = np.repeat(own < 0, sizes)
        ids = np.empty(len(merged), dtype=np.uint32)
        ids[merged], ids[~merged] = flat, own[own >= 0]
        return ids, sizes

    def _split(self, piece: str) -> list[str]:
        return self.split.findall(piece)

    def _texts(self, texts: list[str]) -> list[list[int]]:
        parts = [self.split.findall(t) for t in texts]
        words = pa.array([w for own in parts for w in own], pa.string()).dictionary_encode()
        flat, sizes = self._words(words.dictionary)
        ids, each = gathered(flat, np.concatenate(([0], np.cumsum(sizes))), words.indices.to_numpy())
        stops = np.concatenate(([0], np.cumsum(each)))[np.cumsum([len(p) for p in parts])]
        return np.split(ids, stops[:-1])


@lru_cache(maxsize=2)
def replay_encoder(path: str, split: str) -> ReplayEncoder:
    """One encoder per worker process and rank file."""
    return ReplayEncoder(path, split)


def _encoding(rank_file: str, split: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = replay_encoder(rank_file, split)
        for b in it:
            for at, n in lots(b.column("text")):
                part = b.slice(at, n)
                ids, ends = own.encode(part.column("text"))
                offsets = np.concatenate(([0], ends)) * 4
                values = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(ids.astype("<u4"))]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), values], ["doc_id", "ids"])

    return run


def _decoding(rank_file: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [t for t, _ in sorted(ranks(rank_file).items(), key=lambda x: x[1])]
        for whole in it:
            for at, n in lots(whole.column("ids")):
                b = whole.slice(at, n)
                texts = [b"".join(map(table.__getitem__, np.frombuffer(x.as_buffer() or b"", "<u4").tolist())) for x in b.column("ids")]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, rank_file: str, split: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, ids``: the ids of each text as little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_encoding(rank_file, split), "doc_id long, ids binary")


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids of each row stand for; null ids stand for none."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoding(rank_file), "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, rank_file: str, split: str = public_tokenizers.PATTERN) -> DataFrame:
    """``decode(encode(docs))`` in one Python worker, so that the ids cross to it only once."""
    encoding, decoding = _encoding(rank_file, split), _decoding(rank_file)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda it: decoding(encoding(it)), "doc_id long, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 of the ids and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
