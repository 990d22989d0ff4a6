"""Vocabularies: surfaces of terms, exact and fuzzy matching, scans of texts, aliases, mining of phrases."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillspark.durable import save
from quillspark.functions.text import squeeze
from quillspark.operators.merge import lcs_ratio

#: Most surfaces of a vocabulary that is sent to the tasks.
MAX_SURFACES = 200_000
#: Most hashes of common runs that are sent to the tasks; more are joined by a shuffle.
MAX_COMMON = 2_000_000


def surface(c: Column) -> Column:
    """A term in one spelling: lower case, hyphens and underscores as spaces."""
    return squeeze(F.regexp_replace(F.lower(c), "[-_]", " "))


def flattened(families: DataFrame) -> DataFrame:
    """``(surface, id, label, parent, place)`` of families ``(place, id, label, terms array<struct<id,label,aliases>>)``: of equal
    surfaces the first counts, in the order of families, terms and aliases. Blank surfaces are dropped."""
    own = families.select("place", F.lit(-1).alias("at"), F.lit(0).alias("k"), F.col("label").alias("surface"), "id", "label", F.lit(None).cast("string").alias("parent"))
    t = families.select("place", F.col("id").alias("parent"), F.posexplode("terms").alias("at", "t"))
    names = F.concat(F.array("t.label"), F.coalesce("t.aliases", F.array().cast("array<string>")))
    terms = t.select("place", "at", F.posexplode(names).alias("k", "surface"), F.col("t.id").alias("id"), F.col("t.label").alias("label"), "parent")
    rows = own.unionByName(terms).withColumn("surface", surface(F.col("surface"))).where("surface <> ''")
    first = rows.groupBy("surface").agg(F.min_by(F.struct("id", "label", "parent"), F.struct("place", "at", "k")).alias("m"), F.min(F.struct("place", "at", "k")).alias("place"))
    return first.select("surface", "m.id", "m.label", "m.parent", "place")


def matched(terms: DataFrame, term: str, vocabulary: DataFrame, least: float = 88.0, most_surfaces: int = MAX_SURFACES) -> DataFrame:
    """``(term, id, confidence)`` of the distinct terms: 1 for an equal surface; else the most similar surface's share of common letters
    in order, from ``least`` per cent on (of equals the first by ``place``); null id and 0 without one.

    Surfaces (``surface``, ``id``, ``place``) go to the tasks behind a check of their number; only terms without an equal surface
    are compared, after bounds by length and letters.
    """
    t = terms.select(F.col(term).alias("term")).where("trim(term) <> ''").distinct().withColumn("s", surface(F.col("term")))
    v = vocabulary.select(F.col("surface").alias("s"), "id")
    exact = t.join(v, "s", "left")
    n = vocabulary.count()
    if n > most_surfaces:
        raise ValueError(f"more than {most_surfaces} surfaces")
    rows = [(r["surface"], r["id"], Counter(r["surface"])) for r in vocabulary.orderBy("place").select("surface", "id").collect()]
    box = terms.sparkSession.sparkContext.broadcast(rows)

    def fuzzy(batches):
        for b in batches:
            ids, scores = [], []
            for s in b["s"]:
                best, of, have = least, None, Counter(s)
                for w, i, letters in box.value:
                    whole = len(s) + len(w)
                    if 200 * min(len(s), len(w)) < best * whole or 200 * (have & letters).total() < best * whole:
                        continue
                    r = lcs_ratio(s, w)
                    if r > best or (r == best and of is None):
                        best, of = r, i
                ids.append(of)
                scores.append(round(best / 100, 4) if of is not None else 0.0)
            yield pd.DataFrame({"term": b["term"], "id": ids, "confidence": scores})

    rest = exact.where("id is null").select("term", "s").mapInPandas(fuzzy, "term string, id string, confidence double")
    return exact.where("id is not null").select("term", "id", F.lit(1.0).alias("confidence")).union(rest)


def scan(texts: DataFrame, key: str, text: Column, vocabulary: DataFrame, most_surfaces: int = MAX_SURFACES) -> DataFrame:
    """``(key, id, confidence)``: surfaces that stand in a text as whole words.

    ``vocabulary`` has ``surface`` (in the spelling of ``surface``) and ``id``; surfaces under three letters don't count. Confidence
    grows with the words of the longest surface found. The distinct words of each text meet the first words of surfaces by a hash join,
    and what meets is looked up in the text. Surfaces go to the tasks behind a check of their number, so a text is neither shuffled nor
    kept for each of its words; more surfaces are joined by shuffles, and the texts once more by key. The joins are named by hints:
    by its own estimate, far too low for compressed texts and their words, Spark would send these through the driver.
    """
    plain = F.concat(F.lit(" "), squeeze(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", " ")), F.lit(" "))
    v = vocabulary.where("length(surface) >= 3").select(F.split_part("surface", F.lit(" "), F.lit(1)).alias("first"), "surface", "id")
    x = texts.select(key, plain.alias("x"))
    word = F.explode(F.array_distinct(F.split(F.trim("x"), " "))).alias("first")
    if v.count() <= most_surfaces:
        met = x.select(key, "x", word).where("first <> ''").join(F.broadcast(v), "first")
    else:
        met = x.select(key, word).where("first <> ''").join(v.hint("merge"), "first").select(key, "surface", "id").join(x.hint("merge"), key)
    hits = met.where(F.contains(F.col("x"), F.concat(F.lit(" "), "surface", F.lit(" "))))
    return hits.groupBy(key, "id").agg(F.max(F.least(F.lit(0.95), 0.6 + 0.02 * F.size(F.split("surface", " ")))).alias("confidence"))


def without_version(c: Column) -> Column:
    """A term without a version at its end ("yolo v5", "net-2.1"); null if it has none."""
    base = F.trim(F.regexp_extract(c, r"^(.*?[^\s\d#.v-])[\s#-]*v?\d+(?:\.\d+)*$", 1))
    return F.when(base != "", base)


def mined(texts: DataFrame, key: str, text: Column, stop, lengths=(2, 3), least: int = 3) -> DataFrame:
    """``(phrase, n)``: word runs of the given lengths, without a stop word at either end, that stand in at least ``least`` texts."""
    ends = F.array(*map(F.lit, stop))
    w = F.filter(F.split(squeeze(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", " ")), " "), lambda x: x != "")
    def runs_of(n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))
        kept = F.filter(every, lambda g: ~F.array_contains(ends, F.get(g, 0)) & ~F.array_contains(ends, F.get(g, n - 1)))
        return F.when(F.size("w") >= n, kept).otherwise(F.array().cast("array<array<string>>"))

    runs = F.flatten(F.array(*map(runs_of, lengths)))
    g = texts.select(key, w.alias("w")).select(key, F.explode(F.array_distinct(F.transform(runs, lambda r: F.array_join(r, " ")))).alias("phrase")).distinct()
    return g.groupBy("phrase").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def shared_runs(docs: DataFrame, key: str, text: str, words: int = 8, least: int = 5, most_common: int = MAX_COMMON) -> DataFrame:
    """``(shingle, docs)``: runs of ``words`` words, parted by single spaces, that stand in at least ``least`` documents. Texts of one
    document (rows with one key) count once.

    Documents are counted by the hash of the run first: only hashes and counts are shuffled, added up in the tasks before. The words
    of runs with a common hash are then counted as they are, so equal hashes of different runs do no harm. No row holds a text for
    each of its runs; texts are shuffled only where documents have several rows.
    """
    x = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    several = x.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    d = x.groupBy("k").agg(F.collect_set("t").alias("ts")) if several else x.select("k", F.array_compact(F.array("t")).alias("ts"))
    ws = F.filter(F.transform("ts", lambda t: F.split(t, " ")), lambda w: F.size(w) >= words)
    runs = F.transform(ws, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (words - 1)), lambda i: F.array_join(F.slice(w, i, words), " ")))
    r = d.select(F.explode(F.array_distinct(F.flatten(runs))).alias("shingle")).withColumn("h", F.xxhash64("shingle"))
    common = save(r.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("h"))
    met = r.join(F.broadcast(common) if common.count() <= most_common else common, "h", "left_semi")
    return met.groupBy("shingle").agg(F.count("*").alias("docs")).where(F.col("docs") >= least)


#: The words of a run and where it begins.
RUN = T.StructType([T.StructField("words", T.IntegerType()), T.StructField("at", T.IntegerType())])


def longest_run(a: list[str], b: list[str]) -> tuple[int, int]:
    """``(words, start in a)`` of the longest run of words that both lists have; the earliest of equals."""
    best, at, before = 0, 0, {}
    where: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        where.setdefault(w, []).append(j)
    for i, w in enumerate(a):
        now = {j: before.get(j - 1, 0) + 1 for j in where.get(w, ())}
        for n in now.values():
            if n > best:
                best, at = n, i - n + 1
        before = now
    return best, at


@F.pandas_udf(RUN)
def longest_common_run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """The longest run of words that two texts share; 0 words for a null or empty text."""
    return pd.DataFrame([longest_run((x or "").lower().split(), (y or "").lower().split()) for x, y in zip(a, b)], columns=["words", "at"])


