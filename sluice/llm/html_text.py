"""Main text of HTML pages: page structure, and what the pages of a host repeat.

A page's elements tell most of it: what an ``article`` or ``main`` element
holds is main text; menus, headers, footers, sidebars, adverts, forms, scripts
and comments are not. The host's pages decide the rest.

Runs: the token streams outside the marked main text of all pages of a host are
searched for substrings of at least ``RUN`` tokens that stand on ``PAGES``
different pages. Tokens of open blocks (the page marks no main text, or a class
name begins like boilerplate and may name a subject: ``search-theory``) and of
doubtful ones (class names such as ``notice`` or ``share-box``), in marked text
too, that such a run covers are boilerplate, unique runs stay. On hosts with
fewer pages open blocks stay and doubtful ones are left out. Two suffixes of a suffix array share a
substring of ``RUN`` tokens exactly if their first ``RUN`` tokens agree, so the
array is kept by a hash of those tokens: suffixes are grouped by host and hash
with map-side combination, and a host of any size is never sorted in one task.

Sure blocks of marked main text are left alone, whatever the host repeats:
passages that articles share are content, and so are sentences that adverts and
footers of other pages quote.

Pages count as different by all their words; of pages with open blocks near copies
(``similar``) count once, or copies of one text would look like boilerplate.

Defined cases: a null page has an empty text; a null url belongs to the host of
the empty name; pages that repeat an id are extracted one by one, a page that is
there twice counts once as evidence; other columns of ``pages`` are not read; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import DOUBTFUL, OPEN, SURE, divide
from .scratch import cut
from .similar import near_copies

RUN, PAGES = 8, 3
_PARSED = (
    "page_id long, url string, texts array<string>, states array<int>, words array<string>, owner array<int>, "
    "suffixes array<long>, page long"
)


def _hash(text: str) -> int:
    x = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


def _spans(owner: list[int]) -> list[tuple[int, int, int]]:
    """``(first word, words, block)`` of each run of words of one block that may be main text."""
    out = []
    k = 0
    while k < len(owner):
        stop = k + 1
        while stop < len(owner) and owner[stop] == owner[k]:
            stop += 1
        if owner[k] >= 0:
            out.append((k, stop - k, owner[k]))
        k = stop
    return out


def runs(words: list[str], owner: list[int], run: int) -> list[tuple[int, int]]:
    """``(first word, words)`` of what is searched for: every run of ``run`` words, and shorter blocks as a whole."""
    every = [(k, run) for k in range(len(words) - run + 1)]
    return every + [(k, n) for k, n, _ in _spans(owner) if n < run]


def parse(pages: DataFrame, run: int = RUN) -> DataFrame:
    """Each page's blocks, and its words outside sure ones with the hashes of their runs."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                rows = []
                for html in part.column("html").to_pylist():
                    texts, states, words, owner = divide(html)
                    suffixes = [_hash(" ".join(words[k : k + n])) for k, n in runs(words, owner, run)]
                    page = _hash("\n".join(texts) + "\0" + " ".join(words))
                    some = any(state != SURE for state in states)
                    rows.append((texts, states, words if some else [], owner if some else [], suffixes, page))
                words_, numbers, longs = pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64())
                kinds = (words_, numbers, words_, numbers, longs, pa.int64())
                made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                names = ["page_id", "url", "texts", "states", "words", "owner", "suffixes", "page"]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), *made], names)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(task, _PARSED)


def _unique(run: int, least_pages: int):
    """Task that leaves out covered words of open and doubtful blocks and joins the rest."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            columns = ("texts", "states", "words", "owner", "hits", "pages")
            for texts, states, words, owner, hits, pages in zip(*(b.column(k).to_pylist() for k in columns)):
                searched = runs(words, owner, run)
                covered = {k for h in hits or () for k in range(searched[h][0], sum(searched[h]))}
                rest: dict[int, list[str]] = {}
                for k, n, block in _spans(owner):
                    if states[block] == OPEN or (pages or 0) >= least_pages:
                        rest[block] = [words[j] for j in range(k, k + n) if j not in covered]
                kept = [text if state == SURE else " ".join(rest.get(k, ())) for k, (text, state) in enumerate(zip(texts, states))]
                out.append("\n".join(t for t in kept if t))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    return task


def extract(pages: DataFrame, run: int = RUN, least_pages: int = PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    parsed = parse(pages, run).withColumn("row", F.monotonically_increasing_id())
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    some = lambda state: F.exists("states", lambda x: x == state)
    parsed = parsed.withColumn("host", host).withColumn("unmarked", some(OPEN)).withColumn("undecided", some(OPEN) | some(DOUBTFUL))
    parsed = cut(parsed, "pages")
    evidence = _evidence(parsed)
    undecided = parsed.filter("undecided")
    enough = F.col("pages") >= least_pages
    repeated = evidence.select("host", "body", F.explode("suffixes").alias("suffix")).distinct()
    repeated = repeated.groupBy("host", "suffix").agg(F.count(F.lit(1)).alias("pages")).filter(enough)
    hits = (
        undecided.select("row", "host", F.posexplode("suffixes").alias("at", "suffix"))
        .join(repeated.select("host", "suffix"), ["host", "suffix"])
        .groupBy("row")
        .agg(F.collect_list("at").alias("hits"))  # at most one per word of the page and block
    )
    sizes = evidence.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    marked = parsed.filter("not undecided").select("page_id", "url", F.array_join("texts", "\n").alias("text"))
    judged = undecided.join(hits, "row", "left").join(sizes, "host", "left")
    judged = judged.select("page_id", "url", "texts", "states", "words", "owner", "hits", "pages")
    rest = judged.mapInArrow(_unique(run, least_pages), "page_id long, url string, text string")
    return marked.unionByName(rest).withColumn("n_chars", F.length("text").cast("long"))


def _evidence(parsed: DataFrame) -> DataFrame:
    """``parsed`` with ``body``: what tells different pages apart."""
    unmarked = parsed.filter("unmarked").select(F.col("row").alias("doc_id"), F.array_join("texts", " ").alias("text"))
    if unmarked.isEmpty():
        return parsed.withColumn("body", F.col("page"))
    first = near_copies(unmarked).select(F.col("doc_id").alias("row"), "component_id")
    joined = parsed.join(cut(first, "bodies"), "row", "left")
    return joined.withColumn("body", F.coalesce(F.xxhash64(F.lit("copies"), "component_id", F.when(F.col("component_id").isNull(), F.col("page")))))
