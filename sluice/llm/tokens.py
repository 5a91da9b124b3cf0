"""Encoding of many whole texts by a byte-level tokenizer file of the tokenizers library.

A text is cut before its single spaces and line ends. The library's own split
never joins characters across a space or line end that stands before a visible
character, so the ids of such pieces are the ids of the whole text. Pieces
repeat a lot: Arrow finds the distinct ones of a batch, only those that are not
remembered are encoded, and the ids of the texts are gathered from that table.
For Latin pieces the library's model is called on the words of the public split
pattern, many at once; other pieces go through the whole library, and so do
texts with other runs of white space.

A worker remembers at most ``MEMORY`` pieces, those that it has met most often;
that bounds its memory and changes no result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

WORDS = regex.compile(public_tokenizers.PATTERN)

#: Pieces that one worker remembers, and the longest of them; bounds its memory only.
MEMORY = 400_000
LONGEST = 64
#: Bytes of text that are encoded at once.
BATCH_BYTES = 8 << 20

#: Letters below U+0250: pieces of these are split into words here.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_LATIN = "ɐ"
_ONE = f"^[ \\n]?[{_LETTERS}]+$"
_ONE_AND_MARK = f"^[ \\n]?[{_LETTERS}]+[.,]$"
_OTHER_SPACE = r"\t\r\f\x0b\x1c-\x1f \p{Z}\x{85}"
#: Texts with white space of which more than one may stand in one word of the pattern.
_IRREGULAR = rf"[{_OTHER_SPACE}][{_OTHER_SPACE}\n]|\n[{_OTHER_SPACE}]|\n\n\n|\x00|^[{_OTHER_SPACE}\n]|[{_OTHER_SPACE}\n]$"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary of byte-level tokenizers."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


def lots(texts: pa.Array, size: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """``(first row, rows)`` of consecutive slices of about ``size`` bytes, a row at least."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size, side="right")))
        yield at, stop - at
        at = stop
        pa.default_memory_pool().release_unused()


def _true(mask) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False)


def gathered(flat: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the rows of a table one after another, and the number of each; row k is ``flat[ends[k]:ends[k + 1]]``."""
    sizes = np.diff(ends)[rows]
    stop = np.cumsum(sizes)
    total = int(stop[-1]) if len(stop) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    stop -= sizes
    at = np.repeat((ends[rows] - stop).astype(kind), sizes)
    at += np.arange(total, dtype=kind)
    return flat[at], sizes


class Encoder:
    """Encodes lists of texts with the tokenizer file at ``path``."""

    memory = MEMORY

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # bytes of each token
        for token, k in vocabulary.items():
            self.width[k] = len(token)
        self.letters = np.array([ord(c) if b else 0 for b, c in sorted(_byte_letters().items())], dtype="<u2")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}  # pieces, by their row in the table
        self.ids = np.zeros(0, dtype=np.uint32)
        self.ends = np.zeros(2, dtype=np.int64)
        self.met = np.zeros(1, dtype=np.int32)  # how often each piece was met

    def _texts(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts of any kind."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of the split pattern one after another, and the number of each."""
        found = []
        for at in range(0, len(words), 5000):
            part = words.slice(at, 5000)
            joined = pc.binary_join(pa.ListArray.from_arrays([0, len(part)], part), "\0")[0].as_buffer()
            joined = self.letters[np.frombuffer(joined, np.uint8)].tobytes().decode("utf-16-le")
            found.append(np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.uint32))
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        # Which ids are whose follows from the bytes that each id stands for.
        done = np.cumsum(self.width[ids])
        wanted = np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64))
        ends = np.searchsorted(done, wanted) + 1
        if len(words) and (done[-1] != wanted[-1] or (done[ends - 1] != wanted).any()):
            raise ValueError("the ids of a word do not cover it")
        return ids, np.diff(ends, prepend=0)

    def _split(self, piece: str) -> list[str] | None:
        """Words of a piece, or None if only ``_texts`` knows."""
        body = piece[1:] if piece[:1] == "\n" else piece
        if body and max(body) < _LATIN and min(body) >= " ":
            return (["\n"] if body is not piece else []) + WORDS.findall(body)
        return None

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces with the space or line end before them, and the number of each."""
        marked = _true(pc.match_substring_regex(pieces, _ONE_AND_MARK))
        plain = np.flatnonzero(marked | _true(pc.match_substring_regex(pieces, _ONE)))
        other = np.setdiff1d(np.arange(len(pieces)), plain, assume_unique=True)
        # Pieces of one word, perhaps with a line end before and a mark after it.
        words, marked = pieces.take(pa.array(plain)), marked[plain]
        lined = _true(pc.starts_with(words, "\n"))
        if lined.any():
            words = pc.if_else(pa.array(lined), pc.utf8_slice_codeunits(words, 1), words)
        comma = _true(pc.ends_with(words, ",")) if marked.any() else marked
        if marked.any():
            words = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(words, 0, -1), words)
        listed = pieces.take(pa.array(other)).to_pylist()
        split = [self._split(piece) for piece in listed]
        more = [w for own in split for w in own or ()]
        every = pa.concat_arrays([words, pa.array(["\n", ".", ",", *more], pa.string())]).dictionary_encode()
        index = every.indices.to_numpy()
        line_end, stop = index[len(words)], index[len(words) + 1 + comma]
        counts = np.zeros(len(pieces), dtype=np.int64)
        counts[plain] = 1 + lined + marked
        counts[other] = [len(own or ()) for own in split]
        at = np.cumsum(counts) - counts
        rows = np.empty(int(counts.sum()), dtype=np.int64)
        rows[at[plain[lined]]] = line_end
        rows[at[plain] + lined] = index[: len(words)]
        rows[(at[plain] + lined + 1)[marked]] = stop[marked]
        n = counts[other]
        rows[np.repeat(at[other] - np.cumsum(n) + n, n) + np.arange(len(more))] = index[len(words) + 3 :]
        flat, sizes = self._words(every.dictionary)
        ids, each = gathered(flat, np.concatenate(([0], np.cumsum(sizes))), rows)
        stops = np.concatenate(([0], np.cumsum(each)))[np.cumsum(counts)]
        sizes = np.diff(stops, prepend=0)
        unknown = [(k, piece) for k, piece, own in zip(other.tolist(), listed, split) if own is None]
        if unknown:
            parts = np.split(ids, stops[:-1])
            for (k, _), own in zip(unknown, self._texts([piece for _, piece in unknown])):
                parts[k] = np.array(own, dtype=np.uint32)
            ids = np.concatenate(parts)
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, sizes

    def _remember(self, names: list[str], ids: np.ndarray, ends: np.ndarray, chosen: np.ndarray, met: np.ndarray) -> None:
        """Add the chosen pieces to the table, after leaving out those met least if it is full."""
        chosen = chosen[: self.memory // 2]
        if len(self.known) + len(chosen) > self.memory:
            stay = np.sort(np.argsort(-self.met[1:], kind="stable")[: self.memory // 2] + 1)
            stay = np.concatenate(([0], stay))
            kept = list(self.known)
            self.known = {kept[k]: j for j, k in enumerate(stay.tolist())}
            self.ids, own = gathered(self.ids, self.ends, stay)
            self.ends = np.concatenate(([0], np.cumsum(own)))
            self.met = self.met[stay] >> 1
        at = len(self.known)
        self.known.update(zip(map(names.__getitem__, chosen.tolist()), range(at, at + len(chosen))))
        own, sizes = gathered(ids, ends, chosen)
        self.ids = np.concatenate([self.ids, own])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.met = np.concatenate([self.met, met[chosen]])

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: all ids in order, and for each text where its ids end."""
        texts = pc.fill_null(texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        irregular = _true(pc.match_substring_regex(texts, _IRREGULAR))
        whole = np.flatnonzero(irregular)
        apart = self._texts(texts.take(pa.array(whole)).to_pylist()) if len(whole) else []
        if apart:
            texts = pc.if_else(pa.array(irregular), "", texts)
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        flat, first = parts.flatten(), parts.offsets.to_numpy()[:-1]
        is_first = np.zeros(len(flat), dtype=bool)
        is_first[first] = True
        heads = flat.take(pa.array(first))
        coded = pc.if_else(pa.array(is_first), "", flat).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = coded.indices.to_numpy()
        row = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(row < 0)
        spelled = coded.dictionary.take(pa.array(new))
        spelled = pc.binary_join_element_wise(pc.if_else(pc.starts_with(spelled, "\n"), "", " "), spelled, "")
        ids, sizes = self._pieces(spelled)
        head_ids, head_sizes = self._pieces(heads)
        row[new] = len(self.known) + np.arange(len(new))
        rows = row[index]
        rows[first] = len(self.known) + len(new) + np.arange(len(first))
        table = np.concatenate([self.ids, ids, head_ids])
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate([sizes, head_sizes]))])
        times = np.bincount(index, minlength=len(names)).astype(np.int32)
        old = np.flatnonzero(row < len(self.known))
        self.met[row[old]] += times[old]
        short = _true(pc.less_equal(pc.utf8_length(spelled), LONGEST)) & (times[new] > 1)
        chosen = np.flatnonzero(short)
        self._remember(list(map(names.__getitem__, new.tolist())), ids, np.concatenate(([0], np.cumsum(sizes))), chosen, times[new])
        ids, each = gathered(table, ends, rows)
        stops = np.cumsum(np.add.reduceat(each, first))
        if apart:
            own = np.split(ids, stops[:-1])
            for k, found in zip(whole.tolist(), apart):
                own[k] = np.array(found, dtype=np.uint32)
            ids = np.concatenate(own)
            stops = np.cumsum([len(x) for x in own])
        return ids, stops


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
