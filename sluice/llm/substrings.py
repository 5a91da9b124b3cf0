"""Passages that recur across documents, located by sharded Aho-Corasick automata and removed.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a window is ``WINDOW`` consecutive
words of one document. A word goes if a window over it also starts in a document
with a smaller id. Windows are judged on the input, not on what is left.

1. A window's anchor is the least hash among its ``GRAM``-word runs, so equal
   windows have equal anchors and a text has one anchor in five words. An anchor
   in two documents or more recurs; its owner is the smallest such document.
2. The windows of a document under recurring anchors, as passages by owner, are
   streamed through the automaton of that owner: pyahocorasick over all windows
   that the owner has under these anchors. What matches recurs.
3. Windows that their owner does not have may still recur elsewhere (an edited
   copy that was copied itself). These few are confirmed by a digest of their
   words, and go through the automaton of the first document that has them.

The anchors only say which documents go through which automaton: every link is a
match of words. Owners with many recurring anchors are several automata, and
passages for a much-copied owner are dealt over several tasks, each of which
builds the owner's automaton, so neither memory nor time of a task grows with
the number of copies. An anchor that many texts of one batch have is dealt over
``SALTS`` groups, each with an owner of its own: the first document of a batch
is in all of them, so every other one meets a smaller owner. Texts and anchors
are shuffled once (what joins them uses one exchange).

Defined cases: a null text has no words; a document without ``WINDOW`` words
loses none; rows with a null id are returned as they are and make nothing
recur; rows that repeat an id are no smaller than each other, so what only they
share stays, and each is judged by its own text (ids are taken to be mostly
distinct: the anchors of all texts of one id meet in a row); extra columns,
whatever their names, are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

WINDOW, GRAM = 13, 6
#: Recurring keys (anchors or windows) of an owner in one automaton; keys of other documents streamed through it by one task.
PATTERNS, STREAM = 25_000, 10_000
#: Rows, and bytes of text, of a batch that a task hands on.
ROWS, BYTES = 20_000, 4_000_000
#: An anchor of more documents of one batch than this is dealt over so many groups.
HOT, SALTS = 256, 64
#: Bytes of a text that are hashed at a time.
PIECE = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x100000001B3
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_blank = re.compile(rb"[ \t-\r]")

_ROUTED = "owner long, shard long, lot int, is_stream boolean, doc_id long, tag long, at long, words binary"
_REST = "key binary, doc_id long, tag long, at long"
_KEPT = "doc_id long, n_words long, n_removed long, kept binary"
_FOUND = "doc_id long, tag long, is_cover boolean, first long, last long, words binary"


class Words:
    """Where the words of a text are, and a 64-bit hash of each, without taking the text apart."""

    _power, _inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, text: bytes | None):
        self.text = text or b""
        starts, ends, hashes, at = [], [], [], 0
        while at < len(self.text):
            cut = at + PIECE
            if cut < len(self.text):  # not within a word
                blank = _blank.search(self.text, cut)
                cut = blank.start() if blank else len(self.text)
            s, e, h = self._hashed(np.frombuffer(self.text, np.uint8, min(cut, len(self.text)) - at, at))
            starts.append(s + at), ends.append(e + at), hashes.append(h)
            at = cut
        none = np.empty(0, np.int64)
        self.starts, self.ends = np.concatenate([none, *starts]), np.concatenate([none, *ends])
        self.hashes = np.concatenate([np.empty(0, np.uint64), *hashes])

    @classmethod
    def _hashed(cls, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A word's hash is the sum of its bytes times the powers of a base, from differences of running sums."""
        n = len(raw)
        if len(cls._power) <= n:
            size = 1 << n.bit_length()
            for name, base in (("_power", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(cls, name, np.cumprod(table))
        blank = np.ones(n + 2, np.int8)
        blank[1:-1] = _BLANK[raw]
        edge = np.diff(blank)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * cls._power[:n], out=sums[1:])
        return starts, ends, (sums[ends] - sums[starts]) * cls._inverse[starts]

    def __len__(self) -> int:
        return len(self.hashes)

    def passage(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last``, joined by one space."""
        return b" ".join(self.text[self.starts[first] : self.ends[last]].split())

    def anchors(self) -> np.ndarray:
        """The anchor of each window."""
        if len(self) < WINDOW:
            return np.empty(0, np.uint64)
        n = len(self) - GRAM + 1
        grams = self.hashes[:n].copy()
        for k in range(1, GRAM):
            grams *= _FACTOR
            grams += self.hashes[k : k + n]
        grams ^= grams >> np.uint64(29)
        grams *= _MIX
        grams ^= grams >> np.uint64(32)
        least, span = grams, 1
        while span < WINDOW - GRAM + 1:  # minima over spans that double; the last step may overlap
            step = min(span, WINDOW - GRAM + 1 - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        return least


def anchors(docs: DataFrame) -> DataFrame:
    """``(anchor, salt, doc_id, spare)``: the distinct anchors of every text.

    ``salt`` is 0 but for anchors that many documents of a batch have. Of these
    the smallest document stays in group 0 and stands in all other groups as a
    ``spare``: it may own them, and is not looked for in them.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [np.unique(Words(text.as_py()).anchors()) for text in b.column(1)]
            ids = np.repeat(b.column(0).to_numpy(), [len(own) for own in found])
            flat = np.concatenate([np.empty(0, np.uint64), *found])
            salt, spare = np.zeros(len(flat), np.int32), np.zeros(len(flat), bool)
            values, place, count = np.unique(flat, return_inverse=True, return_counts=True)
            if (count > HOT).any():
                least = np.full(len(values), np.iinfo(np.int64).max)
                np.minimum.at(least, place, ids)
                hot = count[place] > HOT
                moved = hot & (ids != least[place])
                salt[moved] = 1 + ((ids[moved].astype(np.uint64) * _FACTOR) >> np.uint64(40)) % np.uint64(SALTS)
                often = np.flatnonzero(count > HOT)
                flat = np.concatenate([flat, np.repeat(values[often], SALTS)])
                ids = np.concatenate([ids, np.repeat(least[often], SALTS)])
                salt = np.concatenate([salt, np.tile(np.arange(1, SALTS + 1, dtype=np.int32), len(often))])
                spare = np.concatenate([spare, np.ones(SALTS * len(often), bool)])
            columns = [pa.array(flat.view(np.int64)), pa.array(salt), pa.array(ids), pa.array(spare)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "salt", "doc_id", "spare"])

    return docs.select("doc_id", "text").mapInArrow(run, "anchor long, salt int, doc_id long, spare boolean")


def _with_lots(keys: DataFrame, names: list[str]) -> DataFrame:
    """Recurring ``keys(*names, owner, n)`` with the automaton (``shard``) of each and the tasks (``lots``) it is dealt to."""
    weight = keys.groupBy("owner").agg(
        F.ceil(F.count("*") / PATTERNS).cast("long").alias("shards"), F.sum("n").alias("total")
    ).filter(f"shards > 1 or total > {STREAM}")
    lots = F.ceil(F.col("total") / (F.col("shards") * STREAM)).cast("int")
    return keys.join(weight, "owner", "left").select(
        *names, "owner",
        F.coalesce(F.pmod(F.xxhash64(names[0]), F.col("shards")), F.lit(0).cast("long")).alias("shard"),
        F.coalesce(F.greatest(lots, F.lit(1)), F.lit(1)).alias("lots"),
    )


def _chains(doc_id: int, tag: int, passage: Callable[[int, int], bytes], at: np.ndarray, owner: np.ndarray, shard: np.ndarray, lots: np.ndarray) -> Iterator[tuple]:
    """Rows of ``_ROUTED`` for the windows ``at`` (ascending, none twice) of a text; ``passage`` gives its words."""
    breaks = np.flatnonzero((at[1:] - at[:-1] > 1) | (owner[1:] != owner[:-1]) | (shard[1:] != shard[:-1]) | (lots[1:] != lots[:-1])) + 1
    for s, e in zip([0, *breaks.tolist()], [*breaks.tolist(), len(at)]):
        first, o, n = int(at[s]), int(owner[s]), int(lots[s])
        words = passage(first, int(at[e - 1]) + WINDOW - 1)
        for lot in range(n) if o == doc_id else (tag % n,):
            yield o, int(shard[s]), lot, o != doc_id, doc_id, tag, first, words


def _passages(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of windows whose anchors have one owner and shard, with their words."""
    for b in it:
        rows: list[tuple] = []
        size = 0
        for doc_id, tag, text, keys in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
            words = Words(text.as_py())
            own = words.anchors()
            if not len(own):
                continue
            anchor, *route = (x.to_numpy() for x in keys.values.flatten())
            anchor = anchor.view(np.uint64)
            mine = route[0] == doc_id
            # What others look for in this text, and what it looks for in others.
            for part in (np.flatnonzero(mine), np.flatnonzero(~mine)):
                if not len(part):
                    continue
                known, first = np.unique(anchor[part], return_index=True)
                place = np.searchsorted(known, own)
                place[place == len(known)] = 0
                at = np.flatnonzero(known[place] == own)
                if len(at):
                    took = part[first[place[at]]]
                    rows.extend(_chains(doc_id, tag, words.passage, at, *(r[took] for r in route)))
            size += len(words.text)
            if size > BYTES:
                yield _batch(rows, _ROUTED)
                rows, size = [], 0
        yield _batch(rows, _ROUTED)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, names)], [n for n, _ in names])


class Phrases:
    """An Aho-Corasick automaton over the windows of passages; each distinct word is one letter."""

    def __init__(self, passages: list[bytes]):
        self.letter: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for passage in passages:
            words = passage.split()
            for w in words:
                if w not in self.letter:
                    n = len(self.letter) + 1
                    self.letter[w] = chr(n if n < 0xD800 else n + 0x800)
            spelt = "".join(map(self.letter.__getitem__, words))
            for i in range(len(spelt) - WINDOW + 1):
                self.automaton.add_word(spelt[i : i + WINDOW])
        self.automaton.make_automaton()

    def starts(self, words: list[bytes]) -> np.ndarray:
        """Where the windows of a text begin that are among the phrases."""
        get = self.letter.get
        ends = [end for end, _ in self.automaton.iter("".join([get(w, "\0") for w in words]))]
        return np.array(ends, np.int64) - (WINDOW - 1)


def _stretches(at: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each stretch of consecutive numbers."""
    if len(at) and at[-1] - at[0] == len(at) - 1:
        return [(int(at[0]), int(at[-1]))]
    breaks = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.concatenate(([0], breaks + 1))].tolist(), at[np.concatenate((breaks, [len(at) - 1]))].tolist())) if len(at) else []


def _stream(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages through the automaton of their owner: the words covered by matches, and the windows without one."""
    key, passages, phrases = None, [], None
    for b in it:
        rows: list[tuple] = []
        size = 0
        heads = zip(*(b.column(k).to_pylist() for k in range(3)))
        for head, is_stream, doc_id, tag, at, passage in zip(heads, *(b.column(k).to_pylist() for k in range(3, 8))):
            if head != key:
                key, passages, phrases = head, [], None
            if not is_stream:
                passages.append(passage)
                continue
            if phrases is None:
                phrases, passages = Phrases(list(dict.fromkeys(passages))), []
            words = passage.split()
            hit = phrases.starts(words)
            for first, last in _stretches(hit):
                rows.append((doc_id, tag, True, at + first, at + last + WINDOW, None))
            if len(hit) == len(words) - WINDOW + 1:
                continue
            missed = np.ones(len(words) - WINDOW + 1, bool)
            missed[hit] = False
            for first, last in _stretches(np.flatnonzero(missed)):
                rows.append((doc_id, tag, False, at + first, at + last + WINDOW, b" ".join(words[first : last + WINDOW])))
                size += len(rows[-1][-1])
            if size > BYTES or len(rows) > ROWS:
                yield _batch(rows, _FOUND)
                rows, size = [], 0
        yield _batch(rows, _FOUND)


def locate(routed: DataFrame) -> DataFrame:
    """Every row of ``_ROUTED`` through the automaton of its owner and shard, as rows of ``_FOUND``."""
    dealt = routed.repartition("owner", "shard", "lot")
    return dealt.sortWithinPartitions("owner", "shard", "lot", "is_stream").mapInArrow(_stream, _FOUND)


def _covers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        yield b.filter(b.column("is_cover")).select(["doc_id", "tag", "first", "last"])


def _unmatched(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the windows without a match, one a row."""
    for b in it:
        b = b.filter(pc.invert(b.column("is_cover")))
        rows: list[tuple] = []
        for doc_id, tag, first, passage in zip(*(b.column(c).to_pylist() for c in ("doc_id", "tag", "first", "words"))):
            words = passage.split()
            for i in range(len(words) - WINDOW + 1):
                rows.append((xxhash.xxh3_128_digest(b" ".join(words[i : i + WINDOW])), doc_id, tag, first + i))
            if len(rows) > ROWS:
                yield _batch(rows, _REST)
                rows = []
        yield _batch(rows, _REST)


def _again(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the windows without a match those that recur, as passages by the first document that has them."""
    for b in it:
        rows: list[tuple] = []
        for doc_id, tag, is_cover, start, end, passage, keys in zip(*(b.column(k).to_pylist() for k in range(6)), b.column(6)):
            if is_cover or not keys.is_valid:
                continue
            keys = keys.values
            at = keys.field(1).to_numpy()
            inside = np.flatnonzero((keys.field(0).to_numpy() == tag) & (at >= start) & (at + WINDOW <= end))
            if len(inside):
                at, first = np.unique(at[inside], return_index=True)
                words = passage.split()
                part = lambda a, z: b" ".join(words[a - start : z + 1 - start])  # noqa: B023,E731  used before the next row
                rows.extend(_chains(doc_id, tag, part, at, *(keys.field(k).to_numpy()[inside[first]] for k in (2, 3, 4))))
        yield _batch(rows, _ROUTED)


def _kept(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        rows: list[tuple] = []
        size = 0
        for doc_id, tag, text, covers in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
            words = (text.as_py() or b"").split()
            n = len(words)
            if covers.is_valid:
                gone = np.zeros(n + 1, np.int64)
                for c in covers.as_py():
                    if c["tag"] == tag:
                        gone[c["first"]] += 1
                        gone[c["last"]] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            rows.append((doc_id, n, n - len(words), b" ".join(words)))
            size += len(rows[-1][-1])
            if size > BYTES:
                yield _batch(rows, _KEPT)
                rows, size = [], 0
        yield _batch(rows, _KEPT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept`` (its other words, joined by one space, in UTF-8)."""
    # An alias that changes nothing would be kept in one of the two uses of the texts only, and part their exchanges.
    doc_id = F.col("doc_id") if docs.schema["doc_id"].dataType == LongType() else F.col("doc_id").cast("long").alias("doc_id")
    whole = docs.select(doc_id, F.col("text").cast("binary").alias("text"))
    named = whole.filter("doc_id is not null")
    # One exchange as well: all three uses take all columns, and find the filter that their joins would add.
    each = anchors(named).filter("anchor is not null and salt is not null and doc_id is not null").repartition("anchor", "salt")
    shared = each.groupBy("anchor", "salt").agg(F.min("doc_id").alias("owner"), F.count("spare").alias("n")).filter("n > 1")
    keys = (
        each.join(_with_lots(shared, ["anchor", "salt"]).hint("shuffle_hash"), ["anchor", "salt"])
        .filter("not spare or owner = doc_id")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("anchor", "owner", "shard", "lots")).alias("keys"))
    )
    # Both joins with the texts use this exchange.
    texts = named.select("doc_id", F.xxhash64("text").alias("tag"), "text").repartition("doc_id")
    routed = texts.join(keys, "doc_id").select("doc_id", "tag", "text", "keys").mapInArrow(_passages, _ROUTED)
    # What the automata say is dealt by document once, and read for the matches and for the rest. (A left join below,
    # as an inner one would filter before the exchange, which then would not be the same.)
    found = locate(routed).repartition("doc_id")
    covers = found.mapInArrow(_covers, "doc_id long, tag long, first long, last long")
    rest = found.mapInArrow(_unmatched, _REST).filter("key is not null and doc_id is not null")
    again = rest.groupBy("key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other"), F.count("*").alias("n"))
    again = _with_lots(again.filter("owner < other and n > 1"), ["key"])
    again = rest.join(again, "key").groupBy("doc_id").agg(F.collect_list(F.struct("tag", "at", "owner", "shard", "lots")).alias("keys"))
    second = found.join(again, "doc_id", "left").select(*found.columns, "keys").mapInArrow(_again, _ROUTED)
    covers = covers.unionByName(locate(second).mapInArrow(_covers, "doc_id long, tag long, first long, last long"))
    covers = covers.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "first", "last")).alias("covers"))
    judged = texts.join(covers, "doc_id", "left").select("doc_id", "tag", "text", "covers")
    unnamed = whole.filter("doc_id is null").select("doc_id", F.xxhash64("text").alias("tag"), "text", F.lit(None).cast(judged.schema["covers"].dataType).alias("covers"))
    return judged.unionByName(unnamed).mapInArrow(_kept, _KEPT)


def digest(kept: DataFrame) -> DataFrame:
    """``remove_repeats`` with the digest of the kept words in their place."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
