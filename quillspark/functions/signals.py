"""What a text says about itself: code, data, samples, periods, genres, and lines that may not be published."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillspark.functions.text import blank_to_null

# Patterns of statements about code, data, samples and periods.
CODE_URL = r"(?i)https?://(?:www\.)?(?:github\.com|gitlab\.com|bitbucket\.org|codeberg\.org)/[A-Za-z0-9_.\-]+/[A-Za-z0-9_.\-]+"
CODE_PHRASE = r"(?i)\b(code|implementation|source code)\s+(is\s+)?(publicly\s+)?(available|released)\b"
NO_RELEASE = r"(?i)\bneither\s+the\s+data\s+nor\s+the\s+code\b|\bnot\s+publicly\s+(available|released)\b"
DATA_PHRASE = r"(?i)\b(data|dataset|datasets)\s+(is|are)?\s*(publicly\s+)?(available|released|open)\b"
DATA_RELEASE = r"(?i)\bwe\s+(release|publish|make\s+available)\b[^.]{0,60}\bdata"
SAMPLE_UNITS = ("images records trips observations respondents users cities areas households points samples papers tweets posts segments "
                "buildings sensors stations trajectories").split()
SAMPLE = rf"(?i)\b(\d[\d,.]*\s*(?:k|m|b|million|billion|thousand)?\s*(?:{'|'.join(SAMPLE_UNITS)}))\b"
N_EQUALS = r"(?i)\bn\s*=\s*\d[\d,]*"
PERIOD_RANGE = r"(?i)\b(?:19|20)\d{2}\s*(?:-|–|—|to|through|and)\s*(?:19|20)\d{2}\b"
PERIOD = r"(?i)\b(?:from|between|since)\s+(?:19|20)\d{2}\b|\b\d+\s+(?:years|months|weeks)\s+of\b"

# Openings of book reviews and of notices, and the kinds that an index gives them.
GENRE = r"(?i)^\s*(book\s+review|review\s+essay|reviews?\s*:)|^\s*review\s+of\s+[A-Z\"“<]"
BY_AUTHOR = r",\s*by\s+[A-Z][\w'’.\-]+"
TITLE_MARKUP = r"(?i)</?(i|scp|em)>"
REVIEW_KINDS = ("book-review",)
NOTICE = (r"(?i)^\s*[\"'“‘(\[]*\s*(corrigendum|erratum|errata|correction|retraction|withdrawal|addendum|publisher'?s? note|"
          r"editorial expression of concern)\b")
NOTICE_KINDS = ("erratum", "correction", "retraction")

# Words that a published line must not have.
BANNED = ("breakthrough first-ever revolutionary game-chang\\w* unprecedented finally landmark groundbreaking ground-breaking revolutioni[sz]es? transforms? cracks? solves? "
          "unlocks? disrupts? redefines? you your here'?s\\swhy what\\sif").split()
QUANTITIES = ("wave flurry surge spate burst cluster\\sof slew raft host\\sof several many numerous multiple various dozens? most majority handful plenty abundance "
              "trend trending trends momentum dominat\\w* prolifera\\w* abound\\w*").split()
RELATIONS = ("converg\\w* diverg\\w* contradict\\w* corroborat\\w* echo(es|ing)? mirror(s|ing)? parallel(s|ing)? builds?\\son follows?\\sup in\\sresponse\\sto at\\sodds\\swith "
             "all\\spoint\\w* together\\s(they|these) taken\\stogether complement(s|ing|ary)? reinforc\\w*").split()
QUESTIONS = "can could will would should does do did is are was were has have why how what when where who which".split()
NUMBER_WORDS = ("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty "
                "sixty seventy eighty ninety hundred thousand million").split()
FIRST = r"(?i)\bfirst\b(?!\s*[-–]\s*(mile|order|come|hand|person|author|stage|principle))"

SCOPES = ("single_city", "multi_city", "national", "global", "not_applicable")
SIGNAL = "struct<value:boolean,confidence:string,detail:string>"


def _signal(value: bool, confidence: str, detail: Column | None = None) -> Column:
    return F.struct(F.lit(value).alias("value"), F.lit(confidence).alias("confidence"), (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return blank_to_null(F.regexp_extract(text, pattern, group))


def code_signal(text: Column, comment: Column | None = None) -> Column:
    """Whether code is out: a denial decides, then an address, a phrase, and an address in a comment. The address is the detail."""
    address = lambda c: F.rtrim(_found(c, CODE_URL), F.lit(".,);"))
    out = F.when(F.coalesce(text, F.lit("")).rlike(NO_RELEASE), _signal(False, "high")).when(text.rlike(CODE_URL), _signal(True, "high", address(text))).when(
        text.rlike(CODE_PHRASE), _signal(True, "medium"))
    if comment is not None:
        out = out.when(comment.rlike(CODE_URL), _signal(True, "high", address(comment)))
    return out.otherwise(_signal(False, "medium"))


def data_signal(text: Column, deposits: Column) -> Column:
    """Whether data are out: a denial decides, then a deposit (an array of addresses), then a phrase."""
    return (F.when(F.coalesce(text, F.lit("")).rlike(NO_RELEASE), _signal(False, "high")).when(F.size(deposits) > 0, _signal(True, "high", F.get(deposits, 0)))
            .when(text.rlike(DATA_RELEASE) | text.rlike(DATA_PHRASE), _signal(True, "medium")).otherwise(_signal(False, "low")))


def _first_of(text: Column, *patterns: str) -> Column:
    hit = F.coalesce(*(_found(text, p) for p in patterns))
    return F.when(hit.isNotNull(), _signal(True, "high", F.trim(hit))).otherwise(_signal(False, "medium"))


def sample_signal(text: Column) -> Column:
    """Whether a sample size is given, with its words."""
    return _first_of(text, SAMPLE, N_EQUALS)


def period_signal(text: Column) -> Column:
    """Whether a period is given, a range of years before a looser wording."""
    return _first_of(text, PERIOD_RANGE, PERIOD)


def badges(code: Column, data: Column, state: Column) -> Column:
    return F.array_compact(F.array(F.when(code["value"], "code"), F.when(data["value"], "data"), F.when(state == "published", "published").otherwise("preprint")))


def scope(value: Column) -> Column:
    """One of the five scopes, else null."""
    return F.when(value.isin(*SCOPES), value)


def book_review(title: Column, kind: Column) -> Column:
    """Four signs of a book review and whether they suffice: a genre phrase or the kind alone, or markup with ", by X"."""
    t = F.coalesce(title, F.lit(""))
    markup, by, genre, typed = t.rlike(TITLE_MARKUP), t.rlike(BY_AUTHOR), t.rlike(GENRE), F.coalesce(F.lower(kind).isin(*REVIEW_KINDS), F.lit(False))
    return F.struct(markup.alias("markup"), by.alias("by_author"), genre.alias("genre"), typed.alias("typed"), (genre | typed | (markup & by)).alias("review"))


def correction(title: Column, kind: Column) -> Column:
    """Two signs of a notice and whether one of them is there."""
    phrase, typed = F.coalesce(title, F.lit("")).rlike(NOTICE), F.coalesce(F.lower(kind).isin(*NOTICE_KINDS), F.lit(False))
    return F.struct(phrase.alias("phrase"), typed.alias("typed"), (phrase | typed).alias("notice"))


def demotion(*flags: Column) -> Column:
    """0 if any flag is up, else 1: such rows rank last and are never dropped."""
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return F.when(out, 0.0).otherwise(1.0)


def _words(words) -> str:
    return r"(?i)\b(" + "|".join(words) + r")\b"


def line_violation(line: Column, material: Column, most_words: int = 12) -> Column:
    """``(rule, detail)`` of the first rule that a headline line breaks, null if it breaks none.

    Rules in order: empty, lines, words, ending, quotes, banned, first, question, quantity, relation, number. Numbers, in digits
    or in words, must stand in the material.
    """
    text = F.trim(F.coalesce(line, F.lit("")))
    low = F.lower(F.coalesce(material, F.lit("")))
    n = F.size(F.split(text, r"\s+"))
    hit = lambda pattern: _found(text, pattern)
    lost = F.get(F.filter(F.concat(F.regexp_extract_all(text, F.lit(r"\d[\d,.]*"), F.lit(0)), F.regexp_extract_all(text, F.lit(_words(NUMBER_WORDS)), F.lit(0))),
                          lambda x: ~F.contains(low, F.lower(x))), 0)
    rule = lambda name, when, detail=None: F.when(when, F.struct(F.lit(name).alias("rule"), (F.lit(None) if detail is None else detail).cast("string").alias("detail")))
    return F.coalesce(
        rule("empty", text == ""), rule("lines", text.contains("\n")), rule("words", n > most_words, n), rule("ending", text.rlike(r"[.!?]$")), rule("quotes", text.rlike("^[\"'“]")),
        rule("banned", hit(_words(BANNED)).isNotNull(), F.lower(hit(_words(BANNED)))), rule("first", text.rlike(FIRST)), rule("question", text.rlike(rf"(?i)^({'|'.join(QUESTIONS)})\b")),
        rule("quantity", hit(_words(QUANTITIES)).isNotNull(), F.lower(hit(_words(QUANTITIES)))), rule("relation", hit(_words(RELATIONS)).isNotNull(), F.lower(hit(_words(RELATIONS)))),
        rule("number", lost.isNotNull(), lost))


def repository_addresses(addresses: Column, hosts) -> Column:
    """The addresses that contain one of the hosts, in order, each once."""
    return F.array_distinct(F.filter(addresses, lambda a: a.isNotNull() & F.exists(F.array(*map(F.lit, hosts)), lambda h: F.contains(F.lower(a), h))))
