"""Mixing sources to target weights.

Each source gets a rate, its mean number of repeats, such that its tokens approach its share of the
total; a rate is at most the source's cap, and what a capped source can't fill goes to the others by
weight. Each record's count is Poisson distributed about the rate: the distribution (cut at the cap,
its mean kept) is inverted at a uniform number hashed from seed and id. Counts are exploded and the
copies are spread over partitions and ordered by a hash, a global shuffle without sampling.
"""

from __future__ import annotations

import base64
import math
import os
from dataclasses import dataclass

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspark.durable import save

#: Most rows of a table of targets; it is collected to plan the rates.
MAX_SOURCES = 10_000


def default_vocabulary() -> str:
    """Where the public tokenizer's ranks lie on the driver, unless a path is given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def shipped(spark: SparkSession, path: str) -> str:
    """Sends a file to all executors; the name by which a task finds its own copy."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _encoding(name: str, pattern: str):
    import tiktoken

    with open(SparkFiles.get(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(batches, vocabulary: str, pattern: str, text: str, names: list[str]):
    enc = None
    for batch in batches:
        enc = enc or _encoding(vocabulary, pattern)
        n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(text).to_pylist()]
        cols = [batch.column(c) for c in names]
        yield pa.record_batch([*cols, pa.array(n, pa.int64())], names=[*names, "n_tokens"])


def source_name(c: Column) -> Column:
    """One spelling of a source label: trimmed, lower case, words joined by underscores; null if blank."""
    x = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-_]+", "_")
    return F.when(x != "", x)


def cut_poisson(rate: float, cap: int) -> list[float]:
    """Cumulative probabilities of 0 .. cap - 1 repeats: Poisson, cut at ``cap``, with mean ``rate``."""
    if rate >= cap:
        return [0.0] * cap
    if rate <= 0:
        return [1.0] * cap

    def masses(lam: float) -> list[float]:
        p, out = math.exp(-lam), []
        for k in range(cap):
            out.append(p)
            p *= lam / (k + 1)
        return out + [max(0.0, 1 - sum(out))]

    lo, hi = 0.0, max(4.0 * cap, 4.0)
    while sum(k * p for k, p in enumerate(masses(hi))) < rate and hi < 600:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        if sum(k * p for k, p in enumerate(masses(mid))) < rate:
            lo = mid
        else:
            hi = mid
    total, out = 0.0, []
    for p in masses(hi)[:cap]:
        total += p
        out.append(min(1.0, total))
    return out


@dataclass
class Share:
    source: str
    weight: float
    cap: int
    tokens: int
    target: float
    rate: float


def plan_rates(rows: list[tuple[str, float, int, int]], total: float | None = None) -> list[Share]:
    """Rates for ``(source, weight, cap, tokens)``; shares are of the weights of sources that have tokens.

    ``total`` is the size wanted, by default all tokens of the sources named. It is filled as far as the caps
    allow: the most the sources can give is the sum of cap times tokens.
    """
    live = [r for r in rows if r[3] > 0 and r[1] > 0 and r[2] > 0]
    whole = sum(r[1] for r in live)
    size = sum(r[3] for r in live) if total is None else total
    give: dict[str, float] = {}
    open_ = list(live)
    left = min(size, sum(r[2] * r[3] for r in live))
    while open_:
        w = sum(r[1] for r in open_)
        full = [r for r in open_ if left * r[1] / w >= r[2] * r[3]]
        if not full:
            give |= {r[0]: left * r[1] / w for r in open_}
            break
        for r in full:
            give[r[0]] = float(r[2] * r[3])
        left -= sum(r[2] * r[3] for r in full)
        open_ = [r for r in open_ if r not in full]
    return [Share(s, w, c, n, w / whole if (s, w, c, n) in live and whole else 0.0, give.get(s, 0.0) / n if n else 0.0)
            for s, w, c, n in rows]


@dataclass
class Mixture:
    selection: DataFrame  #: one row per copy: doc_id, copy, source, n_tokens (and text)
    shares: DataFrame  #: source, target_share, rate, docs, copies, tokens, share


def mix_sources(documents: DataFrame, targets: DataFrame, vocabulary: str | None = None, pattern: str | None = None, total: float | None = None,
                seed: int = 7, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                with_text: bool = True) -> Mixture:
    """Records repeated so that each source approaches its target share of the tokens.

    ``targets`` has ``source``, ``weight`` and ``max_repeats``; labels are compared in one spelling, and of
    repeated targets the largest weight counts. Records of other sources, without an id or with a null
    source are left out; null and empty texts count 0 tokens and are left out; identical rows count once.
    Equal seeds give equal results on any cluster. ``vocabulary`` is a file of token ranks on the driver, which is sent
    to the executors, and ``pattern`` the expression that parts a text into words for it.
    """
    spark = documents.sparkSession
    ranks, pattern = shipped(spark, vocabulary or default_vocabulary()), pattern or default_pattern()
    wanted = (targets.select(source_name(F.col("source")).alias("source"), F.col("weight").cast("double").alias("weight"),
                             F.col("max_repeats").cast("int").alias("cap"))
              .where("source is not null and weight > 0 and cap > 0")
              .groupBy("source").agg(F.max(F.struct("weight", "cap")).alias("m")).select("source", "m.weight", "m.cap")
              .limit(MAX_SOURCES + 1).collect())
    if len(wanted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    docs = (documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                             source_name(F.col(source)).alias("source"))
            .where("doc_id is not null and text <> ''").where(F.col("source").isin([r["source"] for r in wanted])))
    counted = save(docs.mapInArrow(lambda b: token_counts(b, ranks, pattern, "text", ["doc_id", "source"]),
                                   "doc_id bigint, source string, n_tokens bigint")
                   .groupBy("doc_id", "source").agg(F.max("n_tokens").alias("n_tokens")))
    sizes = {r["source"]: r["n"] for r in counted.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    plan = plan_rates([(r["source"], r["weight"], r["cap"], sizes.get(r["source"], 0)) for r in
                       sorted(wanted, key=lambda r: r["source"])], total)
    rates = spark.createDataFrame([(p.source, p.target, p.rate, cut_poisson(p.rate, p.cap)) for p in plan],
                                  "source string, target_share double, rate double, cdf array<double>")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("count"), "doc_id"), 11).cast("double") / F.lit(float(1 << 53)))
    picked = (counted.join(F.broadcast(rates), "source").withColumn("u", u)
              .select("doc_id", "source", "n_tokens", F.size(F.filter("cdf", lambda c: c <= F.col("u"))).alias("times"))
              .where("times > 0"))
    if with_text:
        texts = docs.select("doc_id", "text", F.col("source").alias("s")).dropDuplicates(["doc_id", "s"])
        picked = picked.join(texts, (picked["doc_id"] == texts["doc_id"]) & (picked["source"] == texts["s"])).select(
            picked["doc_id"], "source", "n_tokens", "times", "text")
    copies = picked.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")
    place = F.xxhash64(F.lit(seed), F.lit("place"), "doc_id", "copy")
    selection = copies.withColumn("place", place).repartition("place").sortWithinPartitions("place", "doc_id", "copy")
    got = (picked.groupBy("source").agg(F.count("*").alias("docs"), F.sum("times").cast("bigint").alias("copies"),
                                        F.sum(F.col("n_tokens") * F.col("times")).alias("tokens")))
    whole = got.agg(F.sum("tokens").alias("whole"))
    shares = (rates.join(got, "source", "left").crossJoin(F.broadcast(whole))
              .select("source", "target_share", "rate", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in
                                                          ("docs", "copies", "tokens")),
                      F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)).alias("share")))
    return Mixture(selection, shares)
