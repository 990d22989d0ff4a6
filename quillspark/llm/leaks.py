"""Evaluation passages inside a training corpus.

The normalised word n-grams of all test passages form a sorted hash set, which is broadcast
behind a check of its size. One scan over the corpus hashes the words of whole texts in array
kernels, looks every window up in the set, and counts hits by (document, passage). Pairs with
enough hits are verified: the hits must follow each other in both texts and cover a continuous
piece of the passage, where only a few words at a time may differ and other text may stand in between.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspark.durable import save
from quillspark.llm.kernels import Words, folded, slices

#: The set of grams a scan may broadcast. Larger test sets are scanned in several passes.
MAX_GRAMS = 4_000_000


def passage(text: str | None) -> str:
    """The item's own passage: the middle of the blocks parted by blank lines.

    Texts of two blocks lose the first (an instruction), texts of one block stay whole.
    """
    blocks = [b for b in re.split(r"\n\s*\n", text or "") if b.strip()]
    if len(blocks) >= 3:
        return "\n\n".join(blocks[1:-1])
    return blocks[-1] if blocks else ""


@dataclass
class GramSet:
    """Sorted distinct gram hashes; for gram i the places ``at[i]:at[i+1]`` in ``item`` and ``place``."""

    n: int
    grams: np.ndarray
    at: np.ndarray
    item: np.ndarray
    place: np.ndarray
    ids: list
    lengths: np.ndarray

    @classmethod
    def build(cls, ids: list, texts: list[str], n: int) -> "GramSet":
        w = Words([folded(t) for t in texts])
        g = w.grams(n)
        keep = np.flatnonzero(g)
        keep = keep[np.argsort(g[keep], kind="stable")]
        grams, at = np.unique(g[keep], return_index=True)
        doc = w.doc[keep]
        return cls(n, grams, np.r_[at, len(keep)].astype(np.int64), doc.astype(np.int32),
                   (keep - w.first[doc]).astype(np.int32), ids, np.diff(w.first))


def pieces(place: np.ndarray, at: np.ndarray, n: int, gap: int, least: int, share: float,
           hits: int) -> tuple[int, int, int] | None:
    """The longest continuous piece of a passage that hits cover, as (first word, words, words matched).

    ``place`` are places of hit grams in the passage and ``at`` their places in the document. A
    chain goes on to a later place in both; it may skip up to ``gap`` words of the passage but any
    number of words of the document. A piece counts from ``least`` words with ``share`` of them matched
    and ``hits`` grams hit: sentences of one pattern share short runs, leaked ones long runs.
    """
    order = np.lexsort((at, place))
    best = None
    chains: list[list[int]] = []  # passage start, passage end, words matched, document end, grams hit
    for p, d in zip(place[order].tolist(), at[order].tolist()):
        to, grown = None, 0
        for c in chains:
            if p + n > c[1] and d + n > c[3] and p - c[1] <= gap:
                new = p + n - max(p, c[1])
                # overlapping grams must overlap in the document alike
                if p < c[1] and d - (c[3] - n) != p - (c[1] - n):
                    continue
                if to is None or c[2] + new > grown:
                    to, grown = c, c[2] + new
        if to is None:
            chains = [c for c in chains if p - c[1] <= gap]
            chains.append([p, p + n, n, d + n, 1])
            to = chains[-1]
        else:
            to[1], to[2], to[3], to[4] = p + n, grown, d + n, to[4] + 1
        size = to[1] - to[0]
        if size >= least and to[4] >= hits and to[2] >= max(share * size, 0.9 * least) and (best is None or size > best[1]):
            best = (to[0], size, to[2])
    return best


def scan(batches, tests: GramSet, least: int, gap: int, share: float, hits: int):
    """Rows ``(doc_id, eval_id, first_word, words, matched)`` for each leaked item of each document."""
    names = ["doc_id", "eval_id", "first_word", "words", "matched"]
    for batch, texts in slices(batches, "text"):
        w = Words([folded(t or "") for t in texts])
        g = w.grams(tests.n)
        out: list[tuple] = []
        if len(g) and len(tests.grams):
            found = np.searchsorted(tests.grams, g)
            found[found == len(tests.grams)] = 0
            win = np.flatnonzero((tests.grams[found] == g) & (g != 0))
            gram = found[win]
            k = tests.at[gram + 1] - tests.at[gram]
            win_r = np.repeat(win, k)
            ref = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(tests.at[gram], k)
            item, place, doc = tests.item[ref], tests.place[ref], w.doc[win_r]
            pair = doc.astype(np.int64) * len(tests.ids) + item
            order = np.argsort(pair, kind="stable")
            pair, place, win_r = pair[order], place[order], win_r[order]
            at = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
            ids = batch.column("doc_id").to_pylist()
            for a, b in zip(at, np.r_[at[1:], len(pair)]):
                if b - a < min(hits, 2):
                    continue
                d, e = divmod(int(pair[a]), len(tests.ids))
                whole = int(tests.lengths[e])
                need = min(least, whole)
                got = pieces(place[a:b], win_r[a:b] - w.first[d], tests.n, gap, need, share,
                             min(hits, max(1, whole - tests.n + 1)))
                if got:
                    out.append((ids[d], tests.ids[e], *got))
        yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(
            [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()])], names=names)


def leaked(documents: DataFrame, tests: DataFrame, doc_id: str = "doc_id", text: str = "text",
           eval_id: str = "eval_id", eval_text: str = "text", n: int = 5, least: int = 20, gap: int = 4,
           share: float = 0.75, hits: int = 6,
           max_grams: int = MAX_GRAMS) -> DataFrame:
    """``(doc_id, eval_id, first_word, words, matched)``: the test items whose passages stand in a document.

    A piece of at least ``least`` words (or the whole of a shorter passage of n words or more) counts if
    ``share`` of its words match and no more than ``gap`` words in a row differ. Case, accents, punctuation,
    layout and markup make no difference. Null or empty texts and ids give no rows; identical rows count
    once; other columns are ignored. The tests are held-out material of bounded size: their grams are
    counted first, and sets above ``max_grams`` are scanned in several passes over the corpus, one after the other.
    """
    rows = (tests.select(F.col(eval_id).cast("bigint").alias("e"), F.col(eval_text).alias("t"))
            .where("e is not null and t is not null").distinct())
    words = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    docs = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where(
        "doc_id is not null and text is not null")
    schema = "doc_id bigint, eval_id bigint, first_word int, words int, matched int"
    passes = 1 + int(words // (4 * max_grams))
    out = None
    for part in range(passes):
        some = rows.where(F.pmod(F.xxhash64("e"), F.lit(passes)) == part).orderBy("e").collect() if passes > 1 else \
            rows.orderBy("e").collect()
        grams = GramSet.build([r["e"] for r in some], [passage(r["t"]) for r in some], n)
        box = documents.sparkSession.sparkContext.broadcast(grams)
        one = docs.mapInArrow(lambda b, box=box: scan(b, box.value, least, gap, share, hits), schema)
        if passes > 1:
            # one pass at a time holds its grams; its hits are kept as a table
            one = save(one)
            box.unpersist(blocking=True)
        out = one if out is None else out.union(one)
    return out.groupBy("doc_id", "eval_id").agg(F.max(F.struct("words", "matched", "first_word")).alias("m")).select(
        "doc_id", "eval_id", "m.first_word", "m.words", "m.matched")


def without_leaks(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that hold no test passage, all columns kept."""
    bad = found.select(F.col("doc_id").alias("_leaked")).distinct()
    return documents.join(bad, documents[doc_id] == bad["_leaked"], "left_anti")
