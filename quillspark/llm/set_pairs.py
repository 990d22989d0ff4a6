"""All similar pairs between set-valued records: an exact pigeonhole join.

The token universe is split into segments, more of them for longer sets. Two sets whose
symmetric difference is at most H agree on at least one of any H + 1 segments of budget 0, or
differ by at most one token in a segment of budget 1; budgets b count as b + 1. The longer set
of a pair probes: it takes its rarest segments until the budgets reach H + 1, and joins on the
segment's hash, or, for budget 1, also on the hashes of its one-deletions. The shorter set is
indexed under its segments, and under their one-deletions only where a probing set could need
them. A 64-bit outline of each set then drops most false candidates, and the rest are verified
on the tokens themselves. Sets that are equal are joined once, as a class.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspark.durable import save
from quillspark.llm.kernels import mix

SIGNATURES = "key bigint, id bigint, n int, bits bigint"
SALTS = 16


@dataclass
class SimilarSets:
    """Pairs of class representatives, and the class of every record."""

    pairs: DataFrame  #: (rep_a, rep_b, shared, united) with rep_a < rep_b
    members: DataFrame  #: (id, rep, n)

    def record_pairs(self) -> DataFrame:
        """``(id_a, id_b)`` with id_a < id_b: the class pairs with both classes written out."""
        m = self.members
        own = m.select(F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b"))
        own = own.groupBy("rep_a", "rep_b").agg(F.count("*").alias("k")).where("k > 1").drop("k")
        both = self.pairs.select("rep_a", "rep_b").union(own)
        a = m.select(F.col("rep").alias("rep_a"), F.col("id").alias("x"))
        b = m.select(F.col("rep").alias("rep_b"), F.col("id").alias("y"))
        return (both.join(a, "rep_a").join(b, "rep_b").where("x <> y and (rep_a <> rep_b or x < y)")
                .select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")))

    def link_counts(self) -> DataFrame:
        """``(id, rep, links)``: one row per record with the number of records it is similar to."""
        size = self.members.groupBy("rep").agg(F.count("*").alias("size"))
        ends = self.pairs.select(F.col("rep_a").alias("rep"), F.col("rep_b").alias("other")).union(
            self.pairs.select(F.col("rep_b").alias("rep"), F.col("rep_a").alias("other")))
        far = (ends.join(size.withColumnRenamed("rep", "other"), "other").groupBy("rep")
               .agg(F.sum("size").alias("far")))
        return (self.members.join(size, "rep").join(far, "rep", "left")
                .select("id", "rep", (F.col("size") - 1 + F.coalesce("far", F.lit(0))).cast("bigint").alias("links")))


class Plan:
    """The segment schemes for a threshold: length buckets, segment counts, and the bounds H.

    All figures are integer vectors over the lengths up to the longest set; with t = p / q, two sets of a and b tokens
    share at least ceil(p (a + b) / (p + q)).
    """

    def __init__(self, threshold: float, least: int, most: int, per_token: int):
        t = Fraction(str(threshold))
        p, q = t.numerator, t.denominator
        lows = [max(1, least)]
        while lows[-1] <= max(most, lows[0]):
            lows.append(max(lows[-1] + 1, ceil(lows[-1] / t)))
        self.t, self.lows, self.highs = t, np.array(lows), np.array(lows[1:]) - 1
        self.segments = (per_token * self.highs).astype(np.uint64)
        sizes = np.arange(most + 1)
        self.bucket = np.clip(np.searchsorted(self.lows, sizes, "right") - 1, 0, len(self.highs) - 1)
        #: bounds[back][s]: the largest symmetric difference of a set of s tokens with a shorter or equal one
        #: from the bucket ``back`` places below its own; -1 where there is none.
        self.bounds = np.full((2, most + 1), -1)
        #: need[l]: an indexed set of l tokens may lose to a probing set up to this many filled segments.
        self.need = np.zeros(most + 1, np.int64)
        for back in (0, 1):
            g = self.bucket - back
            low = np.maximum(self.lows[np.maximum(g, 0)], -(-p * sizes // q))
            high = np.minimum(self.highs[np.maximum(g, 0)], sizes)
            there = (sizes >= lows[0]) & (g >= 0) & (low <= high)
            for x in (np.maximum(high - i, low) for i in range(17)):
                both = sizes + x
                self.bounds[back] = np.where(there, np.maximum(self.bounds[back], both + 2 * (-p * both // (p + q))), -1)
            # an indexed length x meets the probing lengths s of its bucket, or of the next, from x to x q / p
            worth = np.where(there, self.bounds[back] * (p + q) - p * sizes, np.iinfo(np.int64).min // 2)
            home = self.bucket + back
            known = (home < len(self.highs)) & (sizes >= lows[0])
            home = np.minimum(home, len(self.highs) - 1)
            start = np.maximum(sizes, self.lows[home])
            end = np.minimum.reduce([sizes * q // p, self.highs[home], np.full(most + 1, most)])
            known &= start <= end
            x = sizes[known]
            top = _range_max(worth, start[known], end[known])
            self.need[x] = np.maximum(self.need[x], x + (top - p * x) // (p + q))


def _range_max(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The greatest of values[start .. end], ends included, for many ranges: a table of maxima over powers of two."""
    out = np.full(len(start), np.iinfo(np.int64).min // 2)
    if not len(start):
        return out
    level, step, width = values, 1, end - start + 1
    while True:
        now = (width >= step) & (width < 2 * step)
        out[now] = np.maximum(level[start[now]], level[end[now] - step + 1])
        if 2 * step > width.max():
            return out
        level = np.maximum(level, np.r_[level[step:], np.repeat(level[-1:], step)])
        step *= 2


def _segments(plan: Plan, tokens: np.ndarray, rec: np.ndarray, bucket: np.ndarray, hot: np.ndarray):
    """Tokens sorted by record and segment, and each filled segment's place, sum of hashes, size and heat."""
    scheme = bucket[rec].astype(np.uint64)
    with np.errstate(over="ignore"):
        h = mix(tokens + (scheme + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    seg = ((h >> np.uint64(11)) % plan.segments[bucket[rec]]).astype(np.int64)
    order = np.lexsort((seg, rec))
    r, s, h, hot = rec[order], seg[order], h[order], hot[order]
    at = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1])]) if len(r) else np.zeros(0, np.int64)
    size = np.diff(np.r_[at, len(r)])
    if not len(at):
        return h, np.zeros(0, np.int64), at, at, np.zeros(0, np.uint64), size, np.zeros(0, bool), hot
    with np.errstate(over="ignore"):
        total = np.add.reduceat(h, at)
    return h, np.repeat(np.arange(len(at)), size), r[at], s[at], total, size, np.logical_and.reduceat(hot, at), hot


def _keys(total, rec, seg, bucket, kind: int):
    with np.errstate(over="ignore"):
        place = mix((bucket[rec].astype(np.uint64) << np.uint64(40)) + seg.astype(np.uint64)
                    + np.uint64(kind) * np.uint64(0xD6E8FEB86659FD93))
        return mix(total ^ place)


def signature_rows(batches, plan: Plan, hot_tokens: np.ndarray, probe: bool):
    """Rows ``(key, id, n, bits)`` under which sets are indexed, or with which they probe."""
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        lists = batch.column("hashes")
        tokens = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        n = np.diff(lists.offsets.to_numpy()) if lists.offset == 0 else np.array([len(x) for x in lists.to_pylist()])
        rec = np.repeat(np.arange(len(ids)), n)
        hot = np.isin(tokens, hot_tokens)
        bits = np.zeros(len(ids), np.uint64)
        np.bitwise_or.at(bits, rec, np.uint64(1) << (mix(tokens) >> np.uint64(58)))
        keys, owners = [], []

        def emit(key, owner, warm, salted=probe):
            """A key that only hot tokens make is split: the index side by record, the probing side repeated."""
            cold = ~warm
            keys.append(key[cold])
            owners.append(owner[cold])
            k, o = key[warm], owner[warm]
            with np.errstate(over="ignore"):
                if salted:
                    for salt in range(SALTS):
                        keys.append(mix(k + np.uint64(salt + 1)))
                        owners.append(o)
                else:
                    keys.append(mix(k + mix(ids[o].astype(np.uint64)) % np.uint64(SALTS) + np.uint64(1)))
                    owners.append(o)

        for back in (0, 1) if probe else (0,):
            bucket = np.maximum(plan.bucket[n] - back, 0)
            h, of, r, s, total, size, warm, hot_t = _segments(plan, tokens, rec, bucket, hot)
            filled = np.bincount(r, minlength=len(ids))
            twice = np.bincount(r, np.minimum(size, 2), len(ids)).astype(np.int64)
            seg_key = _keys(total, r, s, bucket, 1)
            with np.errstate(over="ignore"):
                less = total[of] - h
            # what a deletion leaves is hot if all of it is; a segment of one token leaves nothing
            hots = np.bincount(of, hot_t, len(size)).astype(np.int64)
            warm_less = hots[of] - hot_t == size[of] - 1
            gone = size[of] == 1
            if not probe:
                emit(seg_key, r, warm)
                few = filled <= plan.need[n]
                pick = few[r[of]] & ~gone
                emit(_keys(less[pick], r[of][pick], s[of][pick], bucket, 2), r[of][pick], warm_less[pick])
                # sets so crowded that budgets of 1 might not do: one key a token
                pick = (twice <= plan.need[n])[r[of]]
                emit(_keys(h[pick], r[of][pick], np.zeros(pick.sum(), np.int64), bucket, 3), r[of][pick], hot_t[pick])
                continue
            want = plan.bounds[back][n] + 1
            order = np.lexsort((-size, warm, r))
            first = np.r_[0, np.cumsum(filled)][r[order]]
            rank = np.empty(len(r), np.int64)
            rank[order] = np.arange(len(r)) - first
            use = rank < want[r]
            emit(seg_key[use], r[use], warm[use])
            lack = np.maximum(want - filled, 0)
            lack[want <= 0] = 0
            if lack.any():
                big = size >= 2
                order = np.lexsort((warm, ~big, r))
                first = np.r_[0, np.cumsum(filled)][r[order]]
                rank[order] = np.arange(len(r)) - first
                raised = big & (rank < lack[r])
                emit(_keys(total[raised], r[raised], s[raised], bucket, 2), r[raised], warm[raised])
                pick = raised[of]
                emit(_keys(less[pick], r[of][pick], s[of][pick], bucket, 1), r[of][pick], warm_less[pick])
                short = (twice < want) & (want > 0)
                pick = short[r[of]]
                emit(_keys(h[pick], r[of][pick], np.zeros(pick.sum(), np.int64), bucket, 3), r[of][pick], hot_t[pick])
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(ids[owner].astype(np.int64)),
                               pa.array(n[owner].astype(np.int32)), pa.array(bits[owner].view(np.int64))],
                              names=["key", "id", "n", "bits"])


def similar_sets(records: DataFrame, id: str, tokens: str, threshold: float = 0.6, min_size: int = 1,
                 hot_share: float = 0.005, segments_per_token: int = 4, side: str | None = None) -> SimilarSets:
    """Pairs of records whose token sets have a Jaccard similarity of at least ``threshold``.

    ``id`` is a bigint column, ``tokens`` an array of strings. Nulls and repeats inside a set are
    ignored; records with a null id, a null set or fewer than ``min_size`` distinct tokens take no
    part; identical rows count once; other columns are ignored. With ``side`` (a column) only pairs
    of records from two different sides are of interest: keep them from ``record_pairs``. No bound
    on partners: the result is exact. Tokens in more than ``hot_share`` of the classes are probed last;
    there are at most (mean set size / hot_share) of them, so their list is small at any scale.
    """
    base = (records.select(F.col(id).cast("bigint").alias("id"),
                           F.array_sort(F.array_distinct(F.array_compact(F.col(tokens)))).alias("tokens"))
            .where(f"id is not null and size(tokens) >= {max(1, int(min_size))}"))
    base = base.select("id", "tokens", F.xxhash64("tokens").alias("h1"),
                       F.xxhash64(F.lit("second"), "tokens").alias("h2"))
    classes = save(base.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("tokens").alias("tokens"))
                   .select("h1", "h2", "id", "tokens",
                           F.transform("tokens", lambda x: F.xxhash64(x)).alias("hashes")))
    members = (base.select("id", "h1", "h2", F.size("tokens").alias("n")).distinct()
               .join(classes.select("h1", "h2", F.col("id").alias("rep")), ["h1", "h2"]).select("id", "rep", "n"))
    sizes = classes.agg(F.count("*").alias("k"), F.max(F.size("tokens")).alias("most")).first()
    most = sizes["most"] or 1
    plan = Plan(threshold, max(1, int(min_size)), most, segments_per_token)
    floor = max(50, int(hot_share * sizes["k"]))
    hot = (classes.select(F.explode("hashes").alias("t")).groupBy("t").agg(F.count("*").alias("k"))
           .where(F.col("k") >= floor).select("t"))
    hot_tokens = np.sort(np.array([r[0] for r in hot.collect()], np.int64).view(np.uint64))
    sets = classes.select("id", "hashes")
    # the plan has a few numbers for each length, the hot tokens are bounded as said above
    box = records.sparkSession.sparkContext.broadcast((plan, hot_tokens))
    index = sets.mapInArrow(lambda b: signature_rows(b, *box.value, False), SIGNATURES)
    probe = sets.mapInArrow(lambda b: signature_rows(b, *box.value, True), SIGNATURES)
    p, q = plan.t.numerator, plan.t.denominator
    x, y = probe.alias("x"), index.alias("y")
    united = F.expr(f"x.n + y.n - 2 * cast(ceil({p} * (x.n + y.n) / {p + q}) as int)")
    found = (x.join(y, F.expr("x.key = y.key")).where(
        F.expr(f"y.n <= x.n and {q} * y.n >= {p} * x.n and (y.n < x.n or y.id < x.id)")
        & (F.bit_count(F.expr("x.bits ^ y.bits")) <= united))
        .select(F.expr("x.id").alias("a"), F.expr("y.id").alias("b")).distinct())
    left = classes.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    right = classes.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    pairs = (found.join(left, "a").join(right, "b")
             .select("a", "b", F.size(F.array_intersect("ta", "tb")).alias("shared"),
                     (F.size("ta") + F.size("tb")).alias("total"))
             .select(F.least("a", "b").alias("rep_a"), F.greatest("a", "b").alias("rep_b"), "shared",
                     (F.col("total") - F.col("shared")).alias("united"))
             .where(F.col("shared") * q >= F.col("united") * p))
    return SimilarSets(pairs, members)
