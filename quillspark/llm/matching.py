"""Matching records of two sources without a common key.

Candidates come from MinHash blocking across attributes: a band joins a minimum over title words
with a minimum over pieces of author surnames, so records meet only if both attributes overlap.
Each candidate gets similarity features; a logistic model is fitted to weak labels (rules that vote on
clear cases), its scores are calibrated on candidates held out from fitting, and pairs above one half
are matches. Records of the first source that are known to be one paper share their matches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillspark.durable import save
from quillspark.llm.kernels import edit_distances, mix
from quillspark.llm.survivor import item_keys, paper_groups

#: Most candidates that the classifier is fitted and calibrated on.
MAX_TRAINING = 8_000
#: Rows of the right table from which the pairs of a blocking key are spread over cells, and the most keys that may be listed for it.
FULL_KEY, MAX_FULL_KEYS = 256, 2_000_000
#: Parts into which either side of such a key is divided: a cell is the join of two parts.
PARTS = 8
#: Regularisation of the classifier: strong ones keep a single decisive feature, such as a notice, from deciding.
RIDGE = 0.1

#: Letters with accents and their plain forms, place by place (fixed values).
_ACCENTED = "àáâãäåāăąçćčďđèéêëēęěğìíîïīįıłñńňòóôõöøōőřśşšťùúûüūůűýÿźżž"
_PLAIN = "aaaaaaaaacccddeeeeeeegiiiiiiilnnnoooooooorssstuuuuuuuyyzzz"

#: Words of a title without weight for blocking (fixed values).
STOP = ("the", "of", "and", "in", "for", "from", "a", "an", "to", "with", "on", "by", "through", "around", "what", "who", "how",
        "can", "s", "towards", "amp")

#: A notice about another paper, a reply to it, or a further part (matched on normalised titles).
NOTICE = (r"^(correction|corrections|corrigend\w*|errat\w*|comments?|reply|replies|response|rejoinder|retraction|retracted|addendum|"
          r"publisher correction|author correction|editorial note)\b( (to|on|for|of)\b)?|\b(reply|response|rejoinder) to\b|"
          r"\bcomments? on\b|\bpart (one|two|three|four|five|\d+|ii|iii|iv|v|i)\b|\bfollow ?up( study)?\b|\bsequel\b|\brevisited$|"
          r"\b(ii|iii)$")


def _ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def normalised(c: Column) -> Column:
    """Lower-case words parted by single spaces: no markup, accents or punctuation, "&" as "and", hyphens closed up."""
    x = F.regexp_replace(F.lower(c), r"</?[a-z][^<>]*>", " ")
    x = F.regexp_replace(x, r"&(amp;)+", " and ")
    x = F.regexp_replace(x, r"&[a-z]{2,6};", " ")
    x = F.regexp_replace(x, "&", " and ")
    x = F.regexp_replace(F.translate(x, _ACCENTED, _PLAIN), r"\p{M}|['’]", "")
    x = F.regexp_replace(F.regexp_replace(x, "ß", "ss"), r"(?<=[\p{L}\p{N}])[-\u2010\u2011](?=[\p{L}\p{N}])", "")
    x = F.regexp_replace(x, r"[^\p{L}\p{N}]+", " ")
    # the same for ASCII without markup, as most texts are
    plain = F.regexp_replace(F.replace(F.lower(c), F.lit("'"), F.lit("")), r"-(?<=[a-z0-9]-)(?=[a-z0-9])", "")
    plain = F.regexp_replace(plain, r"[^a-z0-9]+", " ")
    return F.trim(F.when(_ascii(c) & ~c.contains("<") & ~c.contains("&"), plain).otherwise(x))


def name_words(c: Column) -> Column:
    """The plain words of a person's name, and its commas."""
    name = F.regexp_replace(F.regexp_replace(c, r"-\s+|(?i:\b(?:prof|dr|phd|jr|sr|et al)\b\.?)", ""), r"(?<=[a-z]{2})(?=[A-Z])", " ")
    low = F.when(_ascii(c), F.lower(name)).otherwise(F.translate(F.lower(name), _ACCENTED, _PLAIN))
    plain = F.regexp_replace(low, r"\p{M}|['’\-]|(?<=[aou])e(?=[^aeiou]|$)", "")
    return F.filter(F.split(F.regexp_replace(plain, r"[^\p{L}\p{N},]+|(?=,)|(?<=,)", " "), " +"), lambda w: w != "")


def person(words: Column) -> Column:
    """A person's name, given as ``name_words``, as struct (s, i): the plain surname and the first letters of all words.

    The surname is the longest word, of those before a comma if there is one; empty without letters.
    """
    comma = F.array_position(words, ",")
    family = F.when(comma > 1, F.slice(words, F.lit(1), F.greatest(comma - 1, F.lit(1)).cast("int"))).otherwise(words)
    return F.struct(F.aggregate(family, F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a)).alias("s"),
                    F.array_join(F.transform(F.filter(words, lambda w: w != ","), lambda w: F.substring(w, 1, 1)), "").alias("i"))


def bibliography(df: DataFrame, id: Column, title: Column, authors: Column, date: Column, other_date: Column,
                 venue: Column, references: Column) -> DataFrame:
    """Records in the form that blocking and features use. Authors: an array of names."""
    names = F.filter(F.coalesce(authors, F.array().cast("array<string>")),
                     lambda a: a.isNotNull() & ~((F.length(a) < 10) & F.lower(a).rlike(r"^\W*et\.? al\W*$")))
    out = df.select(id.cast("bigint").alias("id"), normalised(title).alias("title"),
                    F.regexp_like(title, F.lit(r"(\.\.\.|…)\s*(</?\w+>)?\s*$")).alias("cut"), names.alias("names"),
                    date.cast("date").alias("d1"), other_date.cast("date").alias("d2"), normalised(venue).alias("venue"),
                    references.cast("int").alias("refs")).where("id is not null").dropDuplicates(["id"])
    # the words in a transform of their own: a lambda computes what it names again at each use
    out = out.withColumn("people", F.filter(F.transform(F.transform("names", name_words), person), lambda p: F.length(p["s"]) >= 2))
    out = out.withColumn("words", F.filter(F.array_distinct(F.split("title", " ")), lambda w: (w != "") & ~w.isin(*STOP))).drop("names")
    heads = F.array_join(F.transform(F.filter(F.split("venue", " "), lambda w: ~w.isin("and", "of", "the", "for")),
                                     lambda w: F.substring(w, 1, 1)), "")
    return out.select("*", F.coalesce(F.col("title").rlike(NOTICE), F.lit(False)).alias("notice"), heads.alias("heads"),
                      outline(F.col("words")).alias("bits")).drop("venue")


def outline(words: Column) -> Column:
    """64 bits, of which each word sets one."""
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda a, w: a.bitwiseOR(
        F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(w), F.lit(64)).cast("int"))))


def _minima(values: np.ndarray, n: np.ndarray, seeds) -> np.ndarray:
    """For each seed the least seeded hash of each record's values; records without values have none below the largest number."""
    out = np.full((len(seeds), len(n)), np.iinfo(np.uint64).max, np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        at = np.r_[0, np.cumsum(n)[:-1]][some]
        for row, seed in zip(out, seeds):
            with np.errstate(over="ignore"):
                row[some] = np.minimum.reduceat(mix(values + np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15)), at)
    return out


def _joined(tag: int, *parts: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.full(len(parts[0]), tag, np.uint64)
        for p in parts:
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + p)
    return h


def blocking_keys(words, n_words, surnames, n_surnames, halves, full: np.ndarray, left: bool, bands: int = 8, half_bands: int = 8, more: int = 3) -> list:
    """Blocking keys of each record as pairs of an array of keys and a mask of the records that have them.

    Across attributes: a minimum over title words with a minimum over surnames, and, for surnames written in two ways,
    three minima over title words with either half of the first author's surname. By title alone: all words of a title
    of four or more, and, for pairs in which a record has no authors, four minima over them, three times. The latter keys
    come in two sets, one in which records without authors of the ``left`` table meet all of the other, one for the reverse.
    """
    t = _minima(words, n_words, range(max(bands, 3 * half_bands, 12)))
    s = _minima(surnames, n_surnames, range(100, 100 + bands))
    both, titled = (n_words > 0) & (n_surnames > 0), n_words >= 4
    keys = [(_joined(j, t[j], s[j]), both) for j in range(bands)]
    for k in (0, 1):
        keys += [(_joined(50 + k, *t[3 * j: 3 * j + 3], halves[k::2]), both) for j in range(half_bands)]
    whole = np.zeros(len(n_words), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(whole, np.repeat(np.arange(len(n_words)), n_words), mix(words))
    nobody = titled & (n_surnames == 0)
    for tag, fit in ((71, nobody if left else titled), (74, titled & ~nobody if left else nobody)):
        keys += [(_joined(tag + j, *t[4 * j: 4 * j + 4]), fit) for j in range(3)]
    if len(full):
        # an over-full key gives way to ``more`` keys that hold a further minimum each: this drops pairs, so ``candidates`` passes none
        further = _minima(words, n_words, range(300, 300 + more))
        split = []
        for k, fit in keys:
            over = fit & np.isin(k, full)
            split += [(k, fit & ~over), *((_joined(80 + j, k, further[j]), over) for j in range(more))]
        keys = split
    return [(_joined(70, whole), titled), *keys]


def _cells(made: list, hot: np.ndarray, ids: np.ndarray, left: bool) -> list:
    """The keys of ``blocking_keys``, the ``hot`` ones as one key a cell: a left record stands in a row of cells, a right one in
    a column, so every pair under a hot key meets in exactly one of them."""
    part, out = mix(ids) % np.uint64(PARTS), []
    for k, fit in made:
        over = fit & np.isin(k, hot)
        out.append((k, fit & ~over))
        if over.any():
            for j in range(PARTS):
                cell = part * np.uint64(PARTS) + np.uint64(j) if left else np.uint64(j * PARTS) + part
                out.append((_joined(90, k, cell), over))
    return out


def _key_rows(batches, id: str, bits: str, full: np.ndarray, left: bool, hot: np.ndarray):
    def lists(c):
        return c.flatten().to_numpy(zero_copy_only=False).view(np.uint64), c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

    for b in batches:
        made = blocking_keys(*lists(b.column("words")), *lists(b.column("surnames")), lists(b.column("halves"))[0], full, left)
        if len(hot):
            made = _cells(made, hot, b.column("id").to_numpy(zero_copy_only=False).view(np.uint64), left)
        at = pa.array(np.concatenate([np.flatnonzero(fit) for _, fit in made]))
        yield pa.record_batch([b.column("id").take(at), b.column("bits").take(at), pa.array(np.concatenate([k[fit] for k, fit in made]).view(np.int64))], names=[id, bits, "k"])


def keyed(records: DataFrame, id: str, bits: str, left: bool, full=None, hot=None) -> DataFrame:
    """``(id, bits, k)``: one row for each key of each record. Words and names are hashed on the JVM, minima taken on arrays.
    ``hot`` is a broadcast sorted array of keys whose pairs are spread over cells, all of them kept; ``full`` one of keys to split
    by further minima, which drops pairs."""
    first = F.coalesce(F.get("people", 0)["s"], F.lit(""))
    half = F.ceil(F.length(first) / 2).cast("int")
    r = records.select("id", "bits", F.transform("words", lambda w: F.xxhash64(w)).alias("words"), F.transform("people", lambda p: F.xxhash64(p["s"])).alias("surnames"),
                       F.array(F.xxhash64(F.substring(first, F.lit(1), half)), F.xxhash64(F.substring(first, -half, half))).alias("halves"))
    r = r.select("id", "bits", *(F.coalesce(c, F.array().cast("array<bigint>")).alias(c) for c in ("words", "surnames", "halves")))
    held = lambda box: box.value if box else np.zeros(0, np.uint64)
    return r.mapInArrow(lambda b: _key_rows(b, id, bits, held(full), left, held(hot)), f"{id} bigint, {bits} bigint, k bigint")


def over_full(keys: DataFrame, least: int = FULL_KEY, most: int = MAX_FULL_KEYS):
    """The keys under which more than ``least`` rows stand, as a broadcast sorted array, or None. The bound rises with the table
    such that no more than ``most`` keys can pass it: the array holds 8 bytes a key. Keys below the bound are joined as they are."""
    held = save(keys.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > least))
    n = held.agg(F.sum("n")).first()[0]
    if not n:
        return None
    bound = max(least, n // most)
    rows = held.where(F.col("n") > bound).select("k").toArrow().column("k").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(np.sort(rows.view(np.uint64)))


def candidates(left: DataFrame, right: DataFrame, least_held: float = 0.4) -> DataFrame:
    """Distinct ``(left_id, right_id)`` that share a key and, by the outlines of their titles, about ``least_held``
    of the words of the shorter title: a band also joins the many papers of one author, whose titles differ.

    The pairs under keys that many right records share, say of an author on a third of all of them, are spread over cells; none is left out."""
    hot = over_full(keyed(right, "right_id", "y", False))
    x, y = keyed(left, "left_id", "x", True, hot=hot), keyed(right, "right_id", "y", False, hot=hot)
    return (x.join(y, "k").where(F.bit_count(F.col("x").bitwiseAND(F.col("y"))) >= least_held * F.least(F.bit_count("x"), F.bit_count("y")))
            .select("left_id", "right_id").distinct())


FEATURES = ("title", "held", "left_new", "right_new", "swapped", "authors", "initials", "first", "nobody", "days", "no_date", "venue",
            "no_venue", "refs", "no_refs", "notice")


def _edits(x: pa.Array, y: pa.Array) -> pa.Array:
    """As ``levenshtein``, but for a whole batch at once: on the JVM it took most of the time of all features."""
    return pa.array(edit_distances(x.fill_null("").to_pylist(), y.fill_null("").to_pylist()),
                    mask=x.is_null().to_numpy(zero_copy_only=False) | y.is_null().to_numpy(zero_copy_only=False))


def features(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Similarity features of candidate pairs, each between 0 and 1. Computed on JVM expressions, but for the edits of titles."""
    a = left.select(*(F.col(c).alias("a_" + c) for c in left.columns))
    b = right.select(*(F.col(c).alias("b_" + c) for c in right.columns))
    j = pairs.join(a, F.col("left_id") == F.col("a_id")).join(b, F.col("right_id") == F.col("b_id"))
    short, long = F.least(F.length("a_title"), F.length("b_title")), F.greatest(F.length("a_title"), F.length("b_title"))
    # a cut title is compared with as much of the other
    size = F.when(F.col("b_cut") | F.col("a_cut"), short).otherwise(long)
    j = j.withColumn("edit", F.arrow_udf(_edits, "int")(F.substring("a_title", F.lit(1), size), F.substring("b_title", F.lit(1), size)))
    # spellings of one word: two edits at most, of which one end of the word is spared
    near = lambda v, w: ((F.abs(F.length(v) - F.length(w)) <= 2)
                         & ((F.substring(v, 1, 1) == F.substring(w, 1, 1)) | (F.substring(v, -1, 1) == F.substring(w, -1, 1)))
                         & (F.levenshtein(v, w, 2) >= 0))
    match = lambda p, q: (p["s"] == q["s"]) | ((F.length(p["s"]) >= 5) & near(p["s"], q["s"]))
    # the generator keeps these from being computed again at each use
    j = j.select("*", F.inline(F.array(F.struct(
        F.array_except("a_words", "b_words").alias("left_rest"),
        F.array_except(F.when(F.col("b_cut"), F.slice("b_words", F.lit(1), F.greatest(F.size("b_words") - 1, F.lit(0)))).otherwise(F.col("b_words")),
                       "a_words").alias("right_rest"),
        F.transform("b_people", lambda q: F.struct(q.alias("q"), F.filter("a_people", lambda p: match(p, q)).alias("all"))).alias("met")))))
    hit = F.size(F.filter("met", lambda m: F.size(m["all"]) > 0))
    given = lambda q: F.when(F.substring(q["i"], 1, 1) == F.substring(q["s"], 1, 1), F.substring(q["i"], -1, 1)).otherwise(
        F.substring(q["i"], 1, 1))
    ini = F.size(F.filter("met", lambda m: F.exists(m["all"], lambda p: (F.substring(p["i"], 1, 2).contains(given(m["q"])))
                                                    | (F.substring(p["i"], -1, 1) == given(m["q"])))))
    people = F.least(F.size("a_people"), F.size("b_people"))
    days = F.least(*(F.abs(F.datediff("b_d1", c)) for c in ("a_d1", "a_d2")))
    both_venue = (F.col("a_heads") != "") & (F.col("b_heads") != "")
    left_words, right_words = F.col("a_words"), F.col("b_words")
    # words of one title that the other has in no spelling: only words not shared are compared
    far = lambda x, y: F.size(F.filter(x, lambda w: (F.length(w) < 4) | ~F.exists(y, lambda v: near(v, w))))
    left_new, right_new = far(F.col("left_rest"), F.col("right_rest")), far(F.col("right_rest"), F.col("left_rest"))
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    j = j.select(
        "left_id", "right_id",
        zero(1 - F.col("edit") / F.greatest(size, F.lit(1))).alias("title"),
        zero(F.size(F.array_intersect(left_words, right_words)) / F.greatest(F.least(F.size(left_words), F.size(right_words)), F.lit(1))).alias("held"),
        F.least(left_new / 6, F.lit(1.0)).alias("left_new"), F.least(right_new / 3, F.lit(1.0)).alias("right_new"),
        ((left_new > 0) & (right_new > 0)).cast("double").alias("swapped"),
        zero(F.least(hit / F.greatest(people, F.lit(1)), F.lit(1))).alias("authors"),
        zero(F.least(ini / F.greatest(people, F.lit(1)), F.lit(1))).alias("initials"),
        zero((F.size("a_people") > 0) & (F.size("b_people") > 0) & match(F.get("a_people", 0), F.get("b_people", 0))).alias("first"),
        (people <= 0).cast("double").alias("nobody"),
        zero(F.least(F.log1p(days) / 7, F.lit(1.0))).alias("days"), days.isNull().cast("double").alias("no_date"),
        zero(both_venue & (F.col("a_heads") == F.col("b_heads"))).alias("venue"),
        F.coalesce(~both_venue, F.lit(True)).cast("double").alias("no_venue"),
        zero(F.abs(F.col("a_refs") - F.col("b_refs")) / F.greatest("a_refs", "b_refs", F.lit(1))).alias("refs"),
        (F.col("a_refs").isNull() | F.col("b_refs").isNull() | (F.col("a_refs") <= 0)).cast("double").alias("no_refs"),
        (F.col("a_notice") != F.col("b_notice")).cast("double").alias("notice"),
        (F.size("b_words")).alias("n_words"), (F.col("a_title") == F.col("b_title")).alias("same_title"))
    return j.withColumn("refs", F.when(F.col("no_refs") == 1, 0.0).otherwise(F.col("refs")))


def weak_label() -> Column:
    """1 or 0 where the rules agree on a clear case, else null."""
    c = F.col
    same_people = (c("authors") == 1) & (c("initials") >= 0.5)
    yes = (c("notice") == 0) & (((c("title") >= 0.9) & (c("right_new") == 0) & same_people)
                                | ((c("right_new") == 0) & (c("n_words") >= 3) & same_people)
                                | ((c("nobody") == 1) & (c("title") >= 0.97) & (c("n_words") >= 5)))
    no = ((c("notice") == 1) | ((c("authors") == 0) & (c("nobody") == 0)) | ((c("swapped") == 1) & (c("title") < 0.9))
          | ((c("title") < 0.55) & (c("held") < 0.7)) | ((c("nobody") == 1) & (c("title") < 0.85)))
    return F.when(yes & ~no, 1).when(no & ~yes, 0)


@dataclass
class Matcher:
    """A logistic model and the two numbers that calibrate its score."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    fitted: bool = True

    def probability(self) -> Column:
        z = F.lit(float(self.bias))
        for name, w in zip(FEATURES, self.weights):
            z = z + F.col(name) * float(w)
        return 1 / (1 + F.exp(-(z * float(self.scale) + float(self.shift))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, steps: int = 60) -> np.ndarray:
    """Newton steps for a regularised logistic regression; the last column of x is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * weight) + ridge * w
        h = (x * (p * (1 - p) * weight)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_matcher(rows: np.ndarray, y: np.ndarray, held_out: np.ndarray) -> Matcher:
    """Fit on the weak labels, calibrate (a logistic curve over the score) on the part held out.

    With labels of one kind or none there is nothing to learn from: fixed weights on titles, authors and notices serve, and
    the model says so in ``fitted``.
    """
    if not len(y) or y.min() == y.max():
        w = np.array([{"title": 8.0, "held": 4.0, "authors": 4.0, "initials": 2.0, "notice": -12.0}.get(f, 0.0) for f in FEATURES])
        return Matcher(w, -13.0, fitted=False)
    x = np.c_[rows, np.ones(len(rows))]
    use = ~held_out if (~held_out).any() and len(set(y[~held_out])) == 2 else np.ones(len(y), bool)
    share = np.bincount(y[use], minlength=2) / use.sum()
    w = _logistic(x[use], y[use].astype(float), (0.5 / share)[y[use]], RIDGE)
    m = Matcher(w[:-1], float(w[-1]))
    if held_out.any() and len(set(y[held_out])) == 2:
        # clear cases only: targets a little inside 0 and 1 keep the curve from steepening without end
        n1, n0 = int(y[held_out].sum()), int((1 - y[held_out]).sum())
        t = np.where(y[held_out] == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        c = _logistic(np.c_[x[held_out] @ w, np.ones(held_out.sum())], t, np.where(y[held_out] == 1, 0.5 / n1, 0.5 / n0) * len(t), 1e-3)
        m.scale, m.shift = float(c[0]), float(c[1])
    return m


def _drawn(f: DataFrame, most: int) -> list:
    """At most ``most`` of the labelled candidates, those with the lowest hash of their ids. A bound on the hash, derived
    from their number, is applied before anything leaves the tasks, so that about ``most`` rows reach the driver."""
    labelled = f.where("label is not null")
    n = labelled.count()
    whole = 1 << 40
    h = F.xxhash64("left_id", "right_id")
    if n > most:
        labelled = labelled.where(F.pmod(h, F.lit(whole)) < int(whole * min(1.0, (most + 5 * most ** 0.5) / n)))
    rows = labelled.select(*FEATURES, "label", F.pmod(h, F.lit(whole)).alias("h"), "left_id", "right_id").collect()
    return sorted(rows, key=lambda r: (r["h"], r["left_id"], r["right_id"]))[:most]


def trained(f: DataFrame, most_training: int = MAX_TRAINING) -> Matcher:
    """A model fitted on ``features`` with their weak ``label``; a quarter of those drawn, by hash, is held out to calibrate it."""
    drawn = _drawn(f, most_training)
    rows = np.array([[r[c] for c in FEATURES] for r in drawn], float).reshape(len(drawn), len(FEATURES))
    return fit_matcher(rows, np.array([r["label"] for r in drawn], int), np.array([(r["h"] >> 3) % 4 == 0 for r in drawn], bool))


def scored_pairs(left: DataFrame, right: DataFrame, most_training: int = MAX_TRAINING) -> DataFrame:
    """``(left_id, right_id, probability, fitted, ...)`` of all candidate pairs of two ``bibliography`` frames, which are
    read several times: pass saved ones.

    The classifier is fitted on at most ``most_training`` candidates, drawn by hash; everything else covers all pairs.
    ``fitted`` is false where the tables gave no labels of both kinds and fixed weights served.
    """
    f = save(features(candidates(left, right), left, right).withColumn("label", weak_label()))
    m = trained(f, most_training)
    return f.withColumn("probability", m.probability()).withColumn("fitted", F.lit(m.fitted))


def item_records(items: DataFrame) -> DataFrame:
    b = F.col("bibliography")
    return bibliography(items, F.col("item_id"), b["title"], F.transform(b["authors"], lambda a: a["name"]), b["publication_date"],
                        F.col("first_published"), F.coalesce(F.col("publication_status.journal"), b["primary_location"]["source_name"]),
                        F.size("graph.referenced_works"))


def listing_records(listings: DataFrame) -> DataFrame:
    return bibliography(listings, F.col("listing_id"), F.col("title"), F.col("authors"), F.col("publication_date"),
                        F.lit(None).cast("date"), F.col("venue"), F.col("n_references"))


def match_items_listings(items: DataFrame, listings: DataFrame, least: float = 0.5) -> DataFrame:
    """``(item_id, listing_id, probability, fitted)``: records of ``items`` and ``listings`` that describe one paper.

    Records that share an identifier are one paper: they share matches, and those without authors the byline. Nulls in any field make the features of that field neutral; identical
    rows count once; records with a null id are ignored; empty tables give no rows.
    """
    left, right = item_records(items), listing_records(listings)
    left = save(left)
    members = save(paper_groups(item_keys(items)))
    # records without authors take those of their paper
    byline = (left.join(members, "id").where(F.size("people") > 0).groupBy("g")
              .agg(F.max_by("people", F.struct(F.size("people"), F.col("id"))).alias("byline")))
    of_paper = members.join(byline, "g").select("id", "byline")
    left = (left.join(of_paper, "id", "left")
            .withColumn("people", F.when(F.size("people") > 0, F.col("people")).otherwise(F.coalesce("byline", "people"))).drop("byline"))
    hits = save(scored_pairs(save(left), save(right)).where(F.col("probability") >= least).select("left_id", "right_id", "probability", "fitted"))
    by_paper = (hits.join(members, F.col("left_id") == F.col("id")).groupBy("g", "right_id", "fitted").agg(F.max("probability").alias("probability"))
                .join(members, "g").select(F.col("id").alias("left_id"), "right_id", "probability", "fitted"))
    return (hits.union(by_paper).groupBy(F.col("left_id").alias("item_id"), F.col("right_id").alias("listing_id"))
            .agg(F.max("probability").alias("probability"), F.first("fitted").alias("fitted")))
