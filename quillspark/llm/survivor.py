"""Best representative of each duplicate group.

Records that share an identifier, directly or through others, form a group. Field by field one
record survives. For texts, values that are damaged in themselves (placeholders, notices, markup,
cut ends) are set aside; the rest of a group vote token by token: values are aligned progressively,
weighted by the records that bear them, each column keeps its heaviest token, and the value closest
to that consensus survives. Wordings within ``tolerance`` of the closest are equals, of which the
latest record is taken.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillspark.durable import save
from quillspark.functions.ids import bare_segment, key_rank, paper_keys
from quillspark.llm.kernels import groups
from quillspark.operators.components import connected_components

#: Texts that stand for a missing abstract (fixed values, lower case, letters only).
PLACEHOLDERS = ("n/a", "na", "none", "null", "abstract", "no abstract", "no abstract available", "abstract not available",
                "abstract not provided", "not available", "abstract unavailable", "tba", "tbd", "see full text", "withheld")

#: Phrases of publishers and portals around an abstract (fixed values, lower case).
NOTICES = ("all rights reserved", "©", "copyright", "terms of use", "sign in", "log in to", "subscribe to this",
           "buy a licence", "buy a license", "recommend it to your library", "cookies", "download citation",
           "download pdf", "share this article", "keywords:", "key words:", "this content is made available",
           "full text of this article", "view full text", "read more", "click here", "creative commons",
           "published by elsevier", "the publisher.", "not provided by publisher", "abstract not provided",
           "this article is available", "purchase access", "get access", "request permissions", "author's copy")


def whole_text(c: Column, min_sentences: int = 2, min_words: int = 15) -> Column:
    """Whether a text is whole and free of anything else, as far as the text itself tells.

    False for null, blank and placeholder texts, publishers' notices, markup or character references, texts
    that don't end as a sentence does, and those of fewer than ``min_sentences`` sentences (a lead, no abstract)
    or ``min_words`` words.
    """
    low = F.lower(F.trim(c))
    notice = F.lit(False)
    for n in NOTICES:
        notice = notice | low.contains(n)
    bare = F.regexp_replace(low, r"[^a-z/ ]", "")
    ok = (~notice & ~F.trim(bare).isin(*PLACEHOLDERS)
          & ~low.rlike(r"</?[a-z][^<>]*>|&(lt|gt|amp|nbsp|quot|apos|#\d+|#x[0-9a-f]+);")
          & low.rlike(r"[.!?][\"'”’)\]]*$") & ~low.rlike(r"(\.\.\.|…|\[[^\]]*\])\W*$")
          & (F.size(F.split(low, r"[.!?][\"'”’)\]]*(\s+|$)")) > min_sentences)
          & (F.size(F.split(low, r"\s+")) >= min_words))
    return F.coalesce(ok, F.lit(False))


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Global alignment of two token lists: pairs of places, -1 for a gap. Common ends are matched at once, the
    middle by the fewest insertions and deletions (greedy diagonals), so near-equal texts cost near-linear time."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ha, hb = len(a), len(b)
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
    head = [(i, i) for i in range(lo)]
    tail = [(ha + i, hb + i) for i in range(len(a) - ha)]
    x, y = a[lo:ha], b[lo:hb]
    if not x or not y:
        middle = [(lo + i, -1) for i in range(len(x))] + [(-1, lo + i) for i in range(len(y))]
        return head + middle + tail
    n, m = len(x), len(y)
    reach, trace = {1: 0}, []
    for d in range(n + m + 1):
        trace.append(dict(reach))
        done = False
        for k in range(-d, d + 1, 2):
            i = reach.get(k + 1, -1) if k == -d or (k != d and reach.get(k - 1, -1) < reach.get(k + 1, -1)) else reach[k - 1] + 1
            j = i - k
            while i < n and j < m and x[i] == y[j]:
                i, j = i + 1, j + 1
            reach[k] = i
            if i >= n and j >= m:
                done = True
                break
        if done:
            break
    out, i, j = [], n, m
    for d in range(len(trace) - 1, -1, -1):
        at = trace[d]
        k = i - j
        k0 = k + 1 if k == -d or (k != d and at.get(k - 1, -1) < at.get(k + 1, -1)) else k - 1
        i0 = at.get(k0, 0)
        j0 = i0 - k0
        while i > max(i0, 0) and j > max(j0, 0) and d > 0 and i - 1 >= i0 and j - 1 >= j0 and x[i - 1] == y[j - 1]:
            i, j = i - 1, j - 1
            out.append((lo + i, lo + j))
        if d == 0:
            while i > 0 and j > 0:
                i, j = i - 1, j - 1
                out.append((lo + i, lo + j))
            break
        if i == i0:
            j -= 1
            out.append((-1, lo + j))
        else:
            i -= 1
            out.append((lo + i, -1))
    return head + out[::-1] + tail


class Consensus:
    """Columns of weighted votes, grown by progressive alignment, heaviest value first."""

    def __init__(self):
        self.columns: list[dict] = []
        self.weight = 0.0

    def add(self, tokens: list, weight: float) -> None:
        heads = [max(c, key=lambda t: (c[t], t is not None, t or "")) for c in self.columns]
        solid = [i for i, t in enumerate(heads) if t is not None]
        pairs = aligned([heads[i] for i in solid], tokens)
        columns, at = [], 0
        inside = [p for p, (_, j) in enumerate(pairs) if j >= 0]
        first, last = (inside[0], inside[-1]) if inside else (0, -1)
        for p, (i, j) in enumerate(pairs):
            if i >= 0:
                while at < solid[i]:
                    self.columns[at][None] = self.columns[at].get(None, 0) + weight
                    columns.append(self.columns[at])
                    at += 1
                c = self.columns[at]
                at += 1
            else:
                # a column that the consensus leaves out may already hold this token
                k = at
                while k < len(self.columns) and heads[k] is None and tokens[j] not in self.columns[k]:
                    k += 1
                if k < len(self.columns) and heads[k] is None:
                    for c in self.columns[at:k]:
                        c[None] = c.get(None, 0) + weight
                        columns.append(c)
                    c, at = self.columns[k], k + 1
                else:
                    c = {None: self.weight}
            if j >= 0:
                c[tokens[j]] = c.get(tokens[j], 0) + weight
            elif first <= p <= last:  # a value that ends early doesn't vote on what lies beyond its ends
                c[None] = c.get(None, 0) + weight
            columns.append(c)
        columns.extend(self.columns[at:])
        self.columns, self.weight = columns, self.weight + weight

    def tokens(self) -> list:
        out = []
        for c in self.columns:
            t = max(c, key=lambda t: (c[t], t is not None, t or ""))
            if t is not None:
                out.append(t)
        return out


def distance(a: list, b: list) -> float:
    """Insertions and deletions between two token lists, as a share of their lengths together."""
    if not a and not b:
        return 0.0
    gaps = sum(1 for i, j in aligned(a, b) if i < 0 or j < 0)
    return gaps / (len(a) + len(b))


def lacking(text: list, whole: list) -> float:
    """Share of the tokens of ``whole`` that ``text`` lacks."""
    return sum(1 for i, j in aligned(text, whole) if i < 0) / max(1, len(whole))


def tokens_of(text: str) -> list[str]:
    return text.lower().split()


def _consensus_rows(batches):
    for group, rows in groups(batches, "part"):
        c = Consensus()
        for r in sorted(rows, key=lambda r: (-r["weight"], r["text"])):
            c.add(tokens_of(r["text"]), r["weight"])
        yield pa.record_batch([pa.array([rows[0]["g"]]), pa.array([" ".join(c.tokens())]), pa.array([float(c.weight)])],
                              names=["g", "text", "weight"])


def _sorted_parts(df: DataFrame) -> DataFrame:
    return df.repartition("part").sortWithinPartitions("part")


def consensus(values: DataFrame, fan: int = 64) -> DataFrame:
    """``(g, consensus)`` for ``(g, text, weight)``: distinct weighted values of each group.

    Large groups are reduced in a tree: parts of about ``fan`` values are aligned apart, then their
    consensus texts, until one is left, so no task holds an unbounded group.
    """
    schema = "g bigint, text string, weight double"
    level = values.select("g", "text", F.col("weight").cast("double").alias("weight"))
    while True:
        sizes = level.groupBy("g").agg(F.count("*").alias("k"))
        parts = level.join(sizes, "g").withColumn(
            "part", F.concat_ws(":", "g", F.pmod(F.xxhash64("text"), F.ceil(F.col("k") / fan)))).select("g", "part", "text", "weight")
        level = save(_sorted_parts(parts).mapInArrow(_consensus_rows, schema))
        if level.groupBy("g").count().where("count > 1").limit(1).count() == 0:
            return level.select("g", F.col("text").alias("consensus"))


def _distances(batches):
    for b in batches:
        both = [(tokens_of(t), tokens_of(c)) for t, c in zip(b.column("text").to_pylist(), b.column("consensus").to_pylist())]
        yield pa.record_batch([b.column("g"), b.column("text"), pa.array([distance(*x) for x in both], pa.float64()),
                               pa.array([lacking(*x) for x in both], pa.float64())], names=["g", "text", "far", "lack"])


def closest_text(records: DataFrame, tolerance: float = 0.1, missing: float = 0.12) -> DataFrame:
    """``(g, id)``: of each group of ``(g, id, text, at)`` the record whose text is closest to the consensus.

    Texts within ``tolerance`` of the closest are equals unless they lack more of the consensus, by ``missing``, than the
    one of them that lacks least; of the records of equals the latest ``at`` is taken, then the smallest id. Only groups with several distinct texts are aligned.
    """
    best = F.max(F.struct(F.col("at"), (-F.col("id")).alias("neg")))
    values = records.groupBy("g", "text").agg(F.count("*").alias("weight"), best.alias("best"))
    kinds = values.groupBy("g").agg(F.count("*").alias("kinds"))
    counted = save(values.join(kinds, "g"))
    one = counted.where("kinds = 1").select("g", "best")
    several = counted.where("kinds > 1")
    held = consensus(several.select("g", "text", "weight"))
    far = (several.select("g", "text").join(held, "g").select("g", "text", "consensus")
           .mapInArrow(_distances, "g bigint, text string, far double, lack double"))
    near = far.groupBy("g").agg(F.min("far").alias("least"))
    near = far.join(near, "g").where(F.col("far") <= F.col("least") + tolerance)
    full = near.groupBy("g").agg(F.min("lack").alias("full"))
    picked = (several.join(near, ["g", "text"]).join(full, "g").where(F.col("lack") <= F.col("full") + missing)
              .groupBy("g").agg(F.max("best").alias("best")))
    return one.union(picked.select("g", "best")).select("g", (-F.col("best.neg")).alias("id"))


def paper_groups(keyed: DataFrame) -> DataFrame:
    """``(id, g)`` for ``(id, keys)``: records that share a key, directly or through others; g is the smallest id.

    Records alone in their group are left out. Null ids and null or empty keys link nothing.
    """
    holders = keyed.select("id", F.explode("keys").alias("k")).where("id is not null").distinct()
    low = holders.groupBy("k").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = holders.join(low, "k").where("id <> low").select("id", "low")
    return connected_components(edges, "id", "low").select(F.col("node").alias("id"), F.col("component").alias("g"))


def item_keys(items: DataFrame) -> DataFrame:
    """``(id, keys)`` of paper records: identifiers in work_key, ids and the landing page, in one spelling."""
    return items.select(F.col("item_id").alias("id"), paper_keys(
        F.col("work_key"), F.col("ids.arxiv"), F.col("ids.doi"), F.col("ids.openalex"),
        F.col("bibliography.primary_location.landing_page_url")).alias("keys"))


def survivors(items: DataFrame, sources: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """``(first_item_id, field, best_item_id)`` for each group of two or more records and each field with a value
    worth keeping: abstract, primary_location, work_key.

    A place needs a source id and a landing page; sources named journals come before repositories, those before
    unknown ones. Keys rank arXiv, DOI, OpenAlex. The latest ``collected_at`` decides among equals (null last),
    then the smallest id. Identical rows count once; an empty table gives no rows; extra columns are ignored.
    """
    g = save(paper_groups(item_keys(items)))
    loc = F.col("bibliography.primary_location")
    rows = items.select(
        F.col("item_id").alias("id"), F.col("work_key"), F.col("bibliography.abstract").alias("text"),
        bare_segment(loc["source_id"]).alias("source"), F.trim(loc["landing_page_url"]).alias("url"),
        F.col("provenance.collected_at").alias("at"))
    rows = rows.join(g, "id").select("g", "id", "work_key", F.when(whole_text(F.col("text")), F.trim("text")).alias("text"),
                                     "source", "url", "at").dropDuplicates(["id"])
    rows = save(rows)
    latest = F.struct(F.col("at"), (-F.col("id")).alias("neg"))
    kind = sources.select(bare_segment(F.col("source_id")).alias("source"),
                          F.when(F.lower(F.trim("source_type")) == "journal", 2)
                          .when(F.lower(F.trim("source_type")) == "repository", 1).otherwise(0).alias("kind")
                          ).groupBy("source").agg(F.max("kind").alias("kind"))
    place = (rows.where("source is not null and url <> ''").join(kind, "source", "left")
             .groupBy("g").agg(F.max(F.struct(F.coalesce("kind", F.lit(0)).alias("kind"), latest.alias("l"))).alias("m"))
             .select("g", F.lit("primary_location").alias("field"), (-F.col("m.l.neg")).alias("best")))
    key = (rows.where(F.col("work_key").rlike(r"^(arxiv|doi|openalex):\S"))
           .groupBy("g").agg(F.max(F.struct((-key_rank(F.col("work_key"))).alias("rank"), latest.alias("l"))).alias("m"))
           .select("g", F.lit("work_key").alias("field"), (-F.col("m.l.neg")).alias("best")))
    text = closest_text(rows.where("text is not null").select("g", "id", "text", "at"), tolerance).select(
        "g", F.lit("abstract").alias("field"), F.col("id").alias("best"))
    return place.union(key).union(text).select(F.col("g").alias("first_item_id"), "field", F.col("best").alias("best_item_id"))
