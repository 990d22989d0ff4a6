"""Variant spellings of names of people and organisations.

A name is taken apart by rules that hold for names at large (titles, initials, order, accents,
damaged encodings, nicknames, abbreviations of organisation words). The words that are left
(surnames, given names, places) are compared within two edits by one pigeonhole segment join over
their distinct values, and names meet by equi-joins on similar surnames and similar given names.
Rows are then linked by evidence, never by all pairs of a block: rows of one identifier or of one
full name at one organisation form clusters, and rows whose name or place of work is less complete
join a cluster only if exactly one fits.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillspark.durable import save
from quillspark.llm.similar_strings import similar_strings
from quillspark.operators.components import connected_components

#: Short forms of given names (fixed values): each line is a name and its short forms.
NICKNAMES = """
alexander alex sasha xander|alexandra sandra alexa|andrew andy drew|anthony tony|benjamin ben benny|catherine cathy cath
katherine kate kathy katie kat|charles charlie chuck|christopher chris kit|christina chris tina|daniel dan danny
deborah deb debbie|dorothy dot dolly|edward ed eddie ted ned|elizabeth liz beth betty lizzie eliza|eleanor ellie nell
frederick fred freddy|francis frank|gabriela gaby gabi|gabriel gabe|george georgie|gregory greg|harold harry hal
henry harry hank|isabella bella izzy isa|jacob jake|james jim jimmy jamie|jennifer jen jenny|jonathan jon|john jack johnny
joseph joe joey|joshua josh|kenneth ken kenny|lawrence larry|leonard len leo|margaret meg peggy maggie greta|matthew matt
michael mike mick micky|nathaniel nate nathan|nicholas nick nicky|patricia pat patty trish|patrick pat paddy
penelope penny|peter pete|philip phil|rebecca becky becca|richard dick rick rich richie|robert bob rob bobby robbie bert
ronald ron|samuel sam sammy|samantha sam|stephen steve|susan sue susie|susanna sue susie|theodore ted teddy|theodora thea dora|theresa terry tess
teresa terry tess tessa|thomas tom tommy|timothy tim|victoria vicky vic tori|vincent vince|walter walt|william bill will billy liam
zachary zach|valentina val tina|johanna jo hanna|amelia amy millie|amelie amy|alfred alf fred|abigail abby|barbara barb babs
"""

_TITLE = re.compile(r"\b(?:prof(?:essor)?|dr|mr|mrs|ms|sir|dame|ph\.?\s?d|m\.?d|m\.?sc|b\.?sc|jr|sr|junior|senior|esq|ii|iii|iv)\b\.?", re.I)
_UMLAUT = re.compile(r"(?<=[aou])e(?=[^aeiou]|$)")
_LETTERS = str.maketrans({"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ß": "ss", "æ": "a", "Æ": "A",
                          "œ": "o", "Œ": "O", "ð": "d", "þ": "th", "ı": "i", "\u2019": "'", "\u00ad": ""})


def _nickname_table() -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for line in NICKNAMES.replace("\n", "|").split("|"):
        full, *short = line.split() or [""]
        for s in short:
            out.setdefault(plain(s), set()).add(plain(full))
    return out


def repaired(text: str) -> str:
    """UTF-8 that was read as Latin-1 is read again."""
    if re.search("[\u00c2-\u00c5\u00d0\u00d1][\u0080-\u00bf\u0152-\u0161\u0178-\u017e\u0192\u02c6\u2013-\u2122]", text):
        for codec in ("latin-1", "cp1252"):
            try:
                return text.encode(codec).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
    return text


def plain(text: str) -> str:
    """Lower case without accents; ae, oe, ue written for umlauts count as a, o, u."""
    text = unicodedata.normalize("NFKD", text.translate(_LETTERS))
    return _UMLAUT.sub("", "".join(c for c in text if not unicodedata.combining(c)).lower())


def person_parts(name: str) -> list[tuple[str, tuple[str, ...]]]:
    """Readings of a name as (surname, given names): one if commas or initials tell, else both orders.

    Given names are plain tokens; initials are single letters. No letters, no readings.
    """
    s = re.sub(r"-\s+|\s+-(?=\w)", "", repaired(name))
    # a lost space: "MariaLopez"; prefixes such as Mc and Mac stay
    s = re.sub(r"(?<![^\W\d_])(?!Mac[A-Z])([^\W\d_][a-zà-öø-ÿ]{2,})(?=[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ])", r"\1 ", s)
    s = _TITLE.sub(" ", s).replace("_", " ")
    s = re.sub(r"\s*,(?:\s*,)*\s*$", "", s.strip())

    def tokens(part: str, initials: bool = True) -> list[str]:
        out = []
        for t in re.findall(r"[^\W\d_](?:[\w'\-]*\w)?\.?", part):
            dot = t.endswith(".")
            t = t.rstrip(".")
            low = plain(t).replace("'", "")
            if initials and (dot and len(t) <= 2 or len(t) <= 3 and t.isupper() and not part.isupper() and "-" not in t):
                out.extend(c for c in low if c.isalpha())
            elif initials and len(t) <= 3 and t.isupper() and all(len(x) <= 3 for x in re.findall(r"\w+", part)):
                out.extend(low)
            elif low:
                out.append(low)
        return out

    if "," in s:
        family, given = s.split(",", 1)
        f = tokens(family, False)
        return [(" ".join(f), tuple(tokens(given)))] if f else []
    t = tokens(s)
    full = [i for i, x in enumerate(t) if len(x) > 1]
    if not full:
        return []
    if len(full) == 1:
        i = full[0]
        return [(t[i], tuple(t[:i] + t[i + 1:]))]
    if len(t[0]) == 1:
        return [(t[full[-1]], tuple(t[:full[-1]] + t[full[-1] + 1:]))]
    if len(t[-1]) == 1:
        # "Surname Given X" or "Surname X"
        return [(t[0], tuple(t[1:])), (t[full[-1]], tuple(t[:full[-1]] + t[full[-1] + 1:]))]
    return [(t[-1], tuple(t[:-1])), (t[0], tuple(t[1:]))]


def near(a: str, b: str, k: int) -> bool:
    """Whether two words are within k edits, a swap of neighbours counting as one (banded)."""
    if abs(len(a) - len(b)) > k:
        return False
    if a == b:
        return True
    before, row = [], list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        lo, hi = max(1, i - k), min(len(b), i + k)
        new = [k + 1] * (len(b) + 1)
        new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                new[j] = min(new[j], before[j - 2] + 1)
        if min(new[lo - 1: hi + 1]) > k:
            return False
        before, row = row, new
    return row[len(b)] <= k


_short: dict[str, set[str]] | None = None


def _full_forms(name: str) -> set[str]:
    global _short
    if _short is None:
        _short = _nickname_table()
    return _short.get(name, set()) | {name}


def given_fit(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """How two lists of given names agree: 0 they conflict, 1 by an initial (or one is missing), 2 by full names."""
    if not a or not b:
        return 1

    def one(x: str, y: str) -> int:
        if len(x) == 1 or len(y) == 1:
            forms = _full_forms(y if len(x) == 1 else x)
            return 1 if any(f[0] == (x if len(x) == 1 else y)[0] for f in forms) else 0
        if x == y or _full_forms(x) & _full_forms(y):
            return 2
        k = 2 if min(len(x), len(y)) >= 7 else 1
        if min(len(x), len(y)) >= 4 and near(x, y, k):
            return 2
        return 2 if any(min(len(f), len(g)) >= 4 and near(f, g, 1) for f in _full_forms(x) for g in _full_forms(y)) else 0

    first = one(a[0], b[0])
    if not first:
        return 0
    if len(a) > 1 and len(b) > 1 and not one(a[1], b[1]):
        return 0
    return first


#: Words of organisation names, by language and abbreviation, and what they stand for (fixed values).
ORG_WORDS = {
    "university": "university universitat universite universita universidad universidade universiteit univ uni u",
    "technology": "technology technol tech technical technische technological technique technion tecnologia",
    "polytechnic": "polytechnic polytechnical polytechnique politecnico politecnica polytech poly polytechnics",
    "institute": "institute institut inst instituto istituto",
    "state": "state st",
    "urban": "urban urbaines urbaine urbanas urbani urb",
    "studies": "studies study etudes stud estudios studi",
    "planning": "planning plan plann",
    "agency": "agency agcy agence agencia agenzia",
    "college": "college coll",
    "academy": "academy acad akademie academie",
    "laboratory": "laboratory lab laboratoire",
    "centre": "centre center ctr centro zentrum",
    "national": "national natl nacional nationale nazionale",
    "council": "council cncl",
    "research": "research rsch recherche forschung",
    "science": "science sciences sci",
    "school": "ecole",
}
#: Acronyms of organisation kinds (fixed values).
ORG_ACRONYMS = {"tu": ("technology", "university"), "ut": ("technology", "university"), "ius": ("institute", "studies", "urban"),
                "su": ("state", "university"), "it": ("institute", "technology")}
#: Words without weight in organisation names (fixed values).
ORG_STOP = set("the of for and de di del della des du d l la le der die das fur und et e y at in a city ville stadt town".split())
#: Parts of organisations; a leading or trailing part of a name that begins with one is dropped (fixed values).
ORG_PARTS = ("department", "dept", "faculty", "school", "college", "division", "section", "chair", "laboratory", "lab", "group",
             "fac", "div", "unit", "program", "programme")

_org_words = {w: k for k, ws in ORG_WORDS.items() for w in ws.split()}


def org_parts(name: str) -> tuple[str, str]:
    """An organisation's name as (kind, place): the sorted words of its kind, and the rest.

    "Dept. of Geography, Univ. of Technology, Exville, XA" gives ("technology university", "exville").
    """
    text = repaired(name)
    text = re.sub(r",\s*[A-Z]{2}\s*$", "", text.strip())
    segments = [s for s in re.split(r"\s*,\s*|\s+-\s+", text) if s.strip()]

    def words(s: str) -> list[str]:
        return re.findall(r"[^\W\d_]+", plain(s).replace("'", " "))

    def part_of(s: str) -> bool:
        w = words(s)
        return bool(w) and (w[0] in ORG_PARTS or any(near(w[0], p, 1) for p in ORG_PARTS if len(p) > 5))

    if len(segments) > 1:
        kept = [s for s in segments if not part_of(s)]
        segments = kept or segments
    kinds, rest = [], []
    for w in words(" ".join(segments)):
        if w in ORG_STOP:
            continue
        if w in _org_words:
            kinds.append(_org_words[w])
        elif w in ORG_ACRONYMS:
            kinds.extend(ORG_ACRONYMS[w])
        else:
            hit = next((k for f, k in _org_words.items() if len(f) >= 4 and len(w) >= 3 and near(w, f, 2 if len(f) >= 9 else 1)), None)
            if hit:
                kinds.append(hit)
            elif not (len(w) <= 4 and any(near(w, x, 1) for x in ORG_STOP if len(x) > 1)):
                rest.append(w)
    kinds = sorted(set(kinds))
    if "polytechnic" in kinds:
        kinds = [k for k in kinds if k not in ("school", "university")]
    return " ".join(kinds), " ".join(rest)


def _orgs(batches):
    for b in batches:
        parts = [org_parts(n) for n in b.column("name").to_pylist()]
        yield pa.record_batch([b.column("name"), pa.array([p[0] for p in parts], pa.string()),
                               pa.array([p[1] for p in parts], pa.string())], names=["name", "kind", "place"])


#: Edits that similar words may differ by, by their length; equal words always count.
SURNAME = "edits <= case when least(length(a), length(b)) >= 8 then 2 when least(length(a), length(b)) >= 5 then 1 else 0 end"
GIVEN = ("edits = 0 or (least(length(a), length(b)) >= 4 and (edits = 1 or least(length(a), length(b)) >= 7 "
         "or array_sort(split(a, '')) = array_sort(split(b, ''))))")
PLACE = "edits = 0 or (edits <= if(least(length(a), length(b)) >= 8, 2, 1) and least(length(a), length(b)) >= 4)"


def similar_words(words: DataFrame, k: int = 2) -> DataFrame:
    """``(a, b, edits)`` of all words ``word`` within ``k`` edits, in both orders and each with itself."""
    words = save(words.where("word <> ''").distinct())
    found = similar_strings(words, "word", k)
    return save(found.select("a", "b", "edits").union(found.select("b", "a", "edits"))
                .union(words.select(F.col("word").alias("a"), F.col("word").alias("b"), F.lit(0).alias("edits"))))


def parsed_organisations(names: DataFrame) -> DataFrame:
    """``(name, kind, place, key)`` of the distinct names; names without a word of weight are left out."""
    return save(names.select("name").where("trim(name) <> ''").distinct()
                .mapInArrow(_orgs, "name string, kind string, place string").where("kind <> '' or place <> ''")
                .withColumn("key", F.xxhash64("kind", "place")))


def organisations(parsed: DataFrame, similar: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``(name, org)`` of ``parsed_organisations``: spellings of one organisation share ``org``.

    Kinds must agree; places may differ by two edits, by one if they have fewer than eight letters. Names
    of ``rows`` (``name``, ``ror``) with one ror id are one organisation too.
    """
    keys = parsed.select("kind", "place", "key").distinct()
    x = keys.select("kind", F.col("place").alias("a"), F.col("key").alias("x"))
    y = keys.select("kind", F.col("place").alias("b"), F.col("key").alias("y"))
    edges = x.join(similar.where(PLACE), "a").join(y, ["kind", "b"]).where("x < y").select("x", "y")
    if rows is not None:
        held = rows.where("ror <> ''").join(parsed, "name").select("ror", "key").distinct()
        low = held.groupBy("ror").agg(F.min("key").alias("low"), F.count("*").alias("n")).where("n > 1")
        edges = edges.union(held.join(low, "ror").select("key", "low"))
    linked = connected_components(edges, "x", "y")
    return save(parsed.join(linked, F.col("key") == F.col("node"), "left").select("name", F.coalesce("component", "key").alias("org")))


def cluster_pairs(members: DataFrame) -> DataFrame:
    """``(id_a, id_b)``, id_a < id_b, of members ``(id, cluster)``."""
    a = members.select("cluster", F.col("id").alias("id_a"))
    b = members.select("cluster", F.col("id").alias("id_b"))
    return a.join(b, "cluster").where("id_a < id_b").select("id_a", "id_b").distinct()


def institution_rows(institutions: DataFrame, id: str = "inst_id", name: str = "display_name", ror: str = "ror") -> DataFrame:
    """``(id, name, ror)``, each id once, the ror id in one spelling."""
    return save(institutions.select(F.col(id).cast("bigint").alias("id"), F.col(name).alias("name"),
                                    F.lower(F.regexp_extract(F.regexp_replace(F.trim(F.col(ror)), "/+$", ""), r"([^/]+)$", 1)).alias("ror")
                                    ).where("id is not null").dropDuplicates(["id"]))


def _institution_clusters(rows: DataFrame, known: DataFrame) -> DataFrame:
    named = rows.join(known, "name", "left")
    by_ror = named.where("ror <> ''").groupBy("ror").agg(F.min("org").alias("of_ror"))
    # rows without a readable name stand with those of their ror id
    held = named.join(by_ror, "ror", "left").select("id", F.coalesce("org", "of_ror", F.when(F.col("ror") != "", F.xxhash64("ror"))).alias("org"))
    low = held.where("org is not null").groupBy("org").agg(F.min("id").alias("low"))
    return held.join(low, "org", "left").select("id", F.coalesce("low", "id").alias("cluster"))


def institution_clusters(institutions: DataFrame, id: str = "inst_id", name: str = "display_name", ror: str = "ror") -> DataFrame:
    """``(id, cluster)`` of organisation rows: one cluster an organisation, by name or a shared ror id.

    Rows without a name stand alone unless they share a ror id; identical rows count once.
    """
    rows = institution_rows(institutions, id, name, ror)
    parsed = parsed_organisations(rows)
    return _institution_clusters(rows, organisations(parsed, similar_words(parsed.select(F.col("place").alias("word"))), rows))


def _people(batches):
    for b in batches:
        out = []
        for i, name in zip(b.column("id").to_pylist(), b.column("name").to_pylist()):
            for s, g in person_parts(name or ""):
                forms = sorted(_full_forms(g[0])) if g and len(g[0]) > 1 else []
                out.append((i, s, " ".join(g), forms, sorted({f[0] for f in forms or g[:1]})))
        cols = list(zip(*out)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())))],
                              names=["id", "surname", "given", "forms", "letters"])


def parsed_people(rows: DataFrame) -> DataFrame:
    """``(id, surname, given, forms, letters)``: the readings of each name. ``forms`` are the full forms of the first
    given name, none for an initial; ``letters`` their first letters."""
    return save(rows.select("id", "name").where("name is not null").mapInArrow(
        _people, "id bigint, surname string, given string, forms array<string>, letters array<string>"))


def with_fit(pairs: DataFrame) -> DataFrame:
    """Adds ``fit``, the agreement of the given names ``ga`` and ``gb``."""
    def fits(batches):
        held: dict = {}
        for b in batches:
            fit = []
            for k in zip(b.column("ga").to_pylist(), b.column("gb").to_pylist()):
                if k not in held:
                    if len(held) > 200_000:
                        held.clear()
                    held[k] = given_fit(tuple(k[0].split()), tuple(k[1].split()))
                fit.append(held[k])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fit, pa.int32())], names=[*b.schema.names, "fit"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.mapInArrow(fits, kinds + ", fit int")


def author_rows(authors: DataFrame, id: str = "author_id", name: str = "display_name", orcid: str = "orcid", institutions: str = "institutions") -> DataFrame:
    """``(id, name, orcid, orgs)``, each id once, the ORCID as 16 characters or empty."""
    code = F.regexp_extract(F.regexp_replace(F.upper(F.col(orcid)), "[^0-9X]", ""), r"([0-9]{15}[0-9X])$", 1)
    return save(authors.select(F.col(id).cast("bigint").alias("id"), F.col(name).alias("name"), F.coalesce(code, F.lit("")).alias("orcid"),
                               F.transform(F.col(institutions), lambda i: i["name"]).alias("orgs")).where("id is not null").dropDuplicates(["id"]))


_STRONG = "size(forms) > 0"


def _state(looks: DataFrame) -> DataFrame:
    """Looks of clusters with the ORCID of the cluster, and whether any of it names an organisation."""
    held = looks.groupBy("cluster").agg(F.min(F.col("code")).alias("code"), F.max(F.col("org").isNotNull()).alias("placed"))
    return save(looks.drop("code", "placed").distinct().join(held, "cluster"))


def _weak_keys(of_need: bool) -> Column:
    """Keys by which a name of initials, or none, meets others: never two names in full."""
    letters, strong, empty = F.col("letters"), F.expr(_STRONG), F.col("given") == ""
    s, w = F.transform(letters, lambda c: F.concat(F.lit("s"), c)), F.transform(letters, lambda c: F.concat(F.lit("w"), c))
    if of_need:
        return F.when(empty, F.array(F.lit("all"))).when(strong, F.concat(w, F.array(F.lit("none")))).otherwise(F.concat(s, w, F.array(F.lit("none"))))
    return F.concat(F.when(empty, F.array(F.lit("none"))).when(strong, s).otherwise(w), F.array(F.lit("all")))


def _joins(hits: DataFrame) -> DataFrame:
    """``(x, y)``: the one cluster that each cluster of ``hits`` fits best, if no second fits as well.

    Exact surnames come before similar ones, full names before initials; different ORCIDs keep clusters apart. A row of
    ``hits`` stands for ``n`` clusters, of which it names the smallest and the largest.
    """
    hits = with_fit(hits.where("not (lo = cluster and hi = cluster) and (own is null or code is null or own = code)")).where("fit > 0")
    hits = hits.select("cluster", F.least("edits", F.lit(1)).alias("e"), (-F.col("fit")).alias("f"), "n", F.explode(F.array("lo", "hi")).alias("to")).where("`to` <> cluster")
    ranked = hits.groupBy("cluster", "e", "f").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.max("n").alias("n"))
    best = ranked.groupBy("cluster").agg(F.min_by(F.struct("lo", "hi", "n"), F.struct("e", "f")).alias("m"))
    return best.where("m.lo = m.hi and m.n <= 2").select(F.col("cluster").alias("x"), F.col("m.lo").alias("y"))


def _goal(state: DataFrame, *by) -> DataFrame:
    return state.groupBy(*by, "code").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi"), F.countDistinct("cluster").alias("n"))


def _initials(state: DataFrame, surnames: DataFrame) -> DataFrame:
    """Clusters known by initials at an organisation and the one full name there; those of equal initials are one."""
    here = state.where("org is not null")
    weak = here.where("size(forms) = 0")
    goal = _goal(here.where(_STRONG).select("org", F.col("surname").alias("b"), F.explode(F.concat("letters", F.array(F.lit("")))).alias("c"), F.col("given").alias("gb"), "cluster", "code"),
                 "org", "b", "c", "gb")
    need = weak.select("cluster", "org", F.col("surname").alias("a"), F.substring("given", 1, 1).alias("c"), F.col("given").alias("ga"), F.col("code").alias("own")).distinct()
    hits = need.join(surnames, "a").join(goal, ["org", "b", "c"]).select("cluster", "ga", "gb", "edits", "own", "code", "lo", "hi", "n")
    alike = weak.groupBy("org", "surname", F.substring("given", 1, 1).alias("c")).agg(
        F.coalesce(F.min(F.when(F.col("code").isNull(), F.col("cluster"))), F.min("cluster")).alias("low"), F.countDistinct("code").alias("codes"))
    same = (weak.withColumn("c", F.substring("given", 1, 1)).join(alike, ["org", "surname", "c"]).where("codes <= 1 or code is null")
            .select(F.col("cluster").alias("x"), F.col("low").alias("y")))
    return _joins(hits).union(same)


def _elsewhere(state: DataFrame, surnames: DataFrame, givens: DataFrame) -> DataFrame:
    """Clusters without organisation and the one cluster of that name, wherever."""
    need = state.where(~F.col("placed")).select("cluster", F.col("surname").alias("a"), F.col("given").alias("ga"), F.col("code").alias("own"), "forms", "letters", "given").distinct()
    need = need.join(surnames, "a")
    full = _goal(state.where(_STRONG).select(F.col("surname").alias("b"), F.explode("forms").alias("g"), F.col("given").alias("gb"), "cluster", "code"), "b", "g", "gb")
    weak = _goal(state.select(F.col("surname").alias("b"), F.explode(_weak_keys(False)).alias("c"), F.col("given"), "cluster", "code")
                 .select("b", "c", F.when(F.col("c") == "all", "").otherwise(F.col("given")).alias("gb"), "cluster", "code"), "b", "c", "gb")
    of = ("cluster", "ga", "gb", "edits", "own", "code", "lo", "hi", "n")
    hits = need.where(_STRONG).select("*", F.explode("forms").alias("f")).join(givens, "f").join(full, ["b", "g"]).select(*of)
    return _joins(hits.union(need.select("*", F.explode(_weak_keys(True)).alias("c")).join(weak, ["b", "c"]).select(*of)))


def _author_clusters(rows: DataFrame, names: DataFrame, known: DataFrame, similar: DataFrame) -> DataFrame:
    orgs = rows.select("id", F.explode("orgs").alias("name")).join(known, "name").select("id", "org").distinct()
    surnames = similar.where(SURNAME)
    givens = similar.where(GIVEN).select(F.col("a").alias("f"), F.col("b").alias("g"))
    full = save(names.join(rows.select("id", "orcid"), "id").join(orgs, "id", "left"))

    # one node for all profiles that look alike
    look = ("surname", "given", "orcid")
    nodes = save(full.where("org is not null or orcid <> ''").groupBy(*look, F.coalesce("org", F.lit(0)).alias("at"))
                 .agg(F.min("id").alias("node"), F.first("forms").alias("forms")))
    alike = full.join(nodes.drop("forms"), [*(full[c] == nodes[c] for c in look), F.coalesce(full["org"], F.lit(0)) == nodes["at"]]).where("id <> node").select(
        F.col("id").alias("x"), F.col("node").alias("y"))
    here = nodes.where(F.col("at") != 0).where(_STRONG)
    left = here.select("at", F.col("surname").alias("a"), F.col("given").alias("ga"), F.col("orcid").alias("oa"), F.col("node").alias("x"), F.explode("forms").alias("f"))
    right = here.select("at", F.col("surname").alias("b"), F.col("given").alias("gb"), F.col("orcid").alias("ob"), F.col("node").alias("y"), F.explode("forms").alias("g"))
    there = right.select("at", "b").distinct()
    met = (left.join(surnames, "a").join(there, ["at", "b"], "left_semi").join(givens, "f").join(right, ["at", "b", "g"]).where("x < y and (oa = ob or oa = '' or ob = '')")
           .select("x", "y", "ga", "gb"))
    by_orcid = rows.where("orcid <> ''").groupBy("orcid").agg(F.min("id").alias("low"))
    one_orcid = rows.join(by_orcid, "orcid").where("id <> low").select(F.col("id").alias("x"), F.col("low").alias("y"))
    strong = connected_components(alike.union(with_fit(met).where("fit = 2").select("x", "y")).union(one_orcid), "x", "y")
    cluster = save(rows.select("id").join(strong, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("cluster")))

    state = _state(full.join(cluster, "id").select("cluster", "surname", "given", "forms", "letters", "org", F.nullif("orcid", F.lit("")).alias("code")))
    first = connected_components(_initials(state, surnames), "x", "y")
    moved = state.join(first, F.col("cluster") == F.col("node"), "left").withColumn("cluster", F.coalesce("component", "cluster")).drop("node", "component")
    second = connected_components(_elsewhere(_state(moved), surnames, givens), "x", "y")
    for links in (first, second):
        cluster = cluster.join(links, F.col("cluster") == F.col("node"), "left").select("id", F.coalesce("component", "cluster").alias("cluster"))
    return cluster


def author_clusters(authors: DataFrame, id: str = "author_id", name: str = "display_name", orcid: str = "orcid", institutions: str = "institutions") -> DataFrame:
    """``(id, cluster)`` of author profiles: one cluster a person.

    Strong links: one ORCID, or similar surnames, agreeing full given names and one organisation.
    Profiles with initials only or without organisation join the one strong cluster that fits them; if
    several fit, they stay apart. Different ORCIDs, conflicting given names and different known
    organisations keep profiles apart. Rows with a null id are ignored; a name without letters links by ORCID only.
    """
    rows = author_rows(authors, id, name, orcid, institutions)
    names, parsed = parsed_people(rows), parsed_organisations(rows.select(F.explode("orgs").alias("name")))
    similar = similar_words(_words(names, parsed))
    return _author_clusters(rows, names, organisations(parsed, similar), similar)


def _words(people: DataFrame, orgs: DataFrame) -> DataFrame:
    return people.select(F.explode(F.concat(F.array("surname"), "forms")).alias("word")).union(orgs.select("place"))


def all_clusters(authors: DataFrame, institutions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``author_clusters`` and ``institution_clusters``, with the words and the organisations of both compared once."""
    people, rows = author_rows(authors), institution_rows(institutions)
    names = parsed_people(people)
    parsed = parsed_organisations(people.select(F.explode("orgs").alias("name")).union(rows.select("name")))
    similar = similar_words(_words(names, parsed))
    known = organisations(parsed, similar, rows)
    return _author_clusters(people, names, known, similar), _institution_clusters(rows, known)
