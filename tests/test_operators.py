import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from quillspark.functions import ids as I, text as T
from quillspark.operators import citations as C, graph as G, merge as X, metrics as M, ranking as K
from quillspark.operators.components import connected_components


def one(spark, column, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(column(F.col("v"))).collect()]


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)] + [(2000, 2001 + i) for i in range(50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_ids(spark):
    assert one(spark, I.doi, "https://doi.org/10.1/A", "doi:10.2/x", " ", None) == ["10.1/a", "10.2/x", None, None]
    assert one(spark, I.arxiv_id, "https://a.org/abs/2608.01234v2", "10.48550/arxiv.2608.01234", "math.GT/0309136", "12608.012345", None) == [
        "2608.01234", "2608.01234", "math.gt/0309136", None, None]
    assert one(spark, I.bare_segment, "https://x/w12/", "openalex:W5", "", None) == ["W12", "W5", None, None]
    keys = one(spark, lambda c: I.paper_keys(c), "10.48550/arXiv.2608.01234", "arXiv:2608.01234v3", "https://x/abs/2608.01234v1", "https://x/W77", "https://j.example/article/0-12", None)
    assert keys == [["arxiv:2608.01234"], ["arxiv:2608.01234"], ["arxiv:2608.01234"], ["openalex:W77"], [], []]


def test_text(spark):
    assert one(spark, T.strip_markup, "H<sub>2</sub>O &amp; <scp>C</scp> : x", "<jats:p>One.</jats:p><jats:p>Two.</jats:p>", "<p></p>", None) == [
        "H2O & C: x", "One. Two.", None, None]
    assert one(spark, T.last_name, "Jane Q. Doe", "Doe, Jane", "", None) == ["doe", "doe", "", None]
    assert one(spark, T.singular, "cities", "boxes", "glass", "gas", "trees") == ["city", "box", "glass", "gas", "tree"]
    assert one(spark, lambda c: c.rlike(T.keyword_pattern(["land use", "commut*"])), "Land-use", "commuters", "island used") == [True, True, False]
    assert one(spark, lambda c: T.first_sentences(c, 20), "short", "One two three. Four five six.", "x" * 30) == ["short", "One two three.", "x" * 20 + "…"]
    assert one(spark, T.json_block, '```json\n{"a": 1}\n```', 'so {"b": 2} it is', "none") == ['{"a": 1}', '{"b": 2}', None]
    m = spark.createDataFrame([({"b": [1], "a": [0, 2]},), ({},), (None,)], "m map<string,array<int>>")
    assert [r[0] for r in m.select(T.from_inverted_index(F.col("m"))).collect()] == ["a b a", None, None]


def edges(spark, rows):
    return spark.createDataFrame([(k, r, date(2026, 1, d)) for k, refs, d in rows for r in refs], "k string, r string, d date")


def test_coupling_floor_window_and_neighbours(spark):
    e = edges(spark, [("a", "129", 1), ("b", "128", 2), ("c", "123", 2)])
    assert C.coupling(e, "k", "r", "d", 3).count() == 0
    p = C.coupling(e, "k", "r", "d", 2)
    assert {(r.a, r.b, r.shared, r.jaccard) for r in p.collect()} == {("a", "b", 2, 0.5), ("a", "c", 2, 0.5), ("b", "c", 2, 0.5)}
    assert C.coupling(e, "k", "r", "d", 2, window_days=0).count() == 1
    assert {(r.item, r.other) for r in C.neighbours(p, 1).collect()} == {("a", "b"), ("b", "a"), ("c", "a")}


def test_accumulate_and_internal_edges(spark):
    e = edges(spark, [("a", "1", 1), ("b", "12", 31)])
    got = {r.ref: (r.raw, r.recent) for r in C.accumulate(e, "r", "d", half_life=30).collect()}
    assert got == {"1": (2, 2), "2": (1, 1)}
    w = spark.createDataFrame([("a", "2"), ("b", "1"), ("z", None)], "k string, own string")
    assert {tuple(r) for r in C.internal_edges(e, w, "k", "r", "own").collect()} == {("b", "a"), ("a", "b")}


def test_graph(spark):
    t = spark.createDataFrame([(1, x) for x in "abc"] + [(2, "a"), (2, "b"), (2, "b"), (3, None)], "i int, t string").withColumn("d", F.lit(date(2026, 1, 1)))
    assert {tuple(r) for r in G.projection(t, "i", "t").collect()} == {("a", "b", 2), ("a", "c", 1), ("b", "c", 1)}
    assert {tuple(r)[:2] for r in G.first_meetings(t, "i", "t", "d").collect()} == {("a", "b"), ("a", "c"), ("b", "c")}
    star = spark.createDataFrame([("h", f"n{i}") for i in range(4)], "a string, b string")
    assert {r.node: r.score for r in G.betweenness(star, 1).collect()}["h"] == pytest.approx(1.0)


def test_merge(spark):
    assert X.lcs_ratio("kitten sitting", "sitting kitten") == pytest.approx(2 * 9 / 28 * 100, abs=15)
    assert X.lcs_ratio("abcd", "abd") == pytest.approx(600 / 7)
    r = spark.createDataFrame([(1, "x", "deep learning of city form"), (2, "x", "deep learning of city forms"), (3, "y", "deep learning of city form"), (4, None, None)], "i long, b string, t string")
    assert [(p.a, p.b) for p in X.fuzzy_pairs(r, "i", "b", "t").collect()] == [(1, 2)]
    old = spark.createDataFrame([("a", 1, 10), ("b", 1, 10), ("c", 1, 10)], "k string, v int, s int")
    new = spark.createDataFrame([("a", 1, 20), ("b", 2, 20), ("d", 5, 20)], "k string, v int, s int")
    assert {tuple(x) for x in X.upsert(old, new, "k", ["v"], "s").collect()} == {("a", 1, 10, "same"), ("b", 2, 20, "changed"), ("c", 1, 10, "kept"), ("d", 5, 20, "added")}
    k = spark.createDataFrame([(1, ["p"]), (2, ["p", "q"]), (3, ["q", None]), (4, [])], "i long, k array<string>")
    assert {tuple(x) for x in X.identity_groups(k, "i", "k").collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_ranking(spark):
    df = spark.createDataFrame([("d1", i, i < 2, 10 - i) for i in range(8)] + [("d2", 20 + i, False, i) for i in range(6)], "day string, k int, first boolean, v int")
    got = K.lent_slots(df, "day", F.col("first"), [F.desc("v")], 3, [F.desc("v")], 2, 4).groupBy("day", "path").count().collect()
    assert {tuple(r) for r in got} == {("d1", "first", 2), ("d1", "other", 3), ("d2", "other", 4)}
    a = [r.k for r in K.hash_sample(df, ["day"], ["k"], 2).orderBy("k").collect()]
    assert a == [r.k for r in K.hash_sample(df.repartition(7), ["day"], ["k"], 2).orderBy("k").collect()] and len(a) == 4
    assert K.day_spine(spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 4),)], "d date"), "d").count() == 4
    assert K.day_spine(spark.createDataFrame([], "d date"), "d").count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, False), (3.0, True), (3.0, False), (4.0, True), (None, True)], "s double, p boolean")
    assert M.auc(df, "s", "p").first()[0] == pytest.approx((0 + 1 + 0.5 + 2) / 6, abs=1e-6)
    many = spark.range(4000).select((F.xxhash64("id") % 1000).cast("double").alias("s"), (F.col("id") % 3 == 0).alias("p"))
    rows = many.collect()
    pos, neg = [r.s for r in rows if r.p], sorted(r.s for r in rows if not r.p)
    import bisect
    want = sum(bisect.bisect_left(neg, x) + (bisect.bisect_right(neg, x) - bisect.bisect_left(neg, x)) / 2 for x in pos) / len(pos) / len(neg)
    assert M.auc(many, "s", "p").first()[0] == pytest.approx(want, abs=1e-6)
    t = spark.createDataFrame([(3, 1, 1, 3)], "a int, b int, c int, d int")
    assert t.select(M.fisher_exact("a", "b", "c", "d")).first()[0] == pytest.approx(0.4857, abs=1e-3)
    assert M.mann_whitney(df, "s", "p").first()["p"] is None


def test_researcher_projection_keeps_hot_references_and_single_shares(spark):
    from itertools import combinations
    from quillspark.plans.citing import researcher_projection

    rng = random.Random(5)
    works = [(i, [{"openalex": f"https://x/a{rng.randrange(40)}"} for _ in range(2)] + [{"openalex": None}], ["HOT"] * (i < 60) + [f"W{rng.randrange(30)}"]) for i in range(70)]
    by_ref: dict = {}
    for _, authors, refs in works:
        for r in refs:
            by_ref.setdefault(r, set()).update(a["openalex"][-3:].strip("/").upper() for a in authors if a["openalex"])
    want: dict = {}
    for people in by_ref.values():
        for p in combinations(sorted(people), 2):
            want[p] = want.get(p, 0) + 1
    df = spark.createDataFrame(works, "item_id long, authors array<struct<openalex:string>>, refs array<string>")
    assert {(r.a, r.b): r.weight for r in researcher_projection(df).collect()} == want
    tags = spark.createDataFrame([(r, p) for r, people in by_ref.items() for p in people], "r string, p string")
    assert {(r.a, r.b): r.weight for r in G.salted_projection(tags, "r", "p", 4).collect()} == want


def _shuffled_rows(spark, run):
    """What ``run`` gives, and the rows that its jobs wrote to shuffles."""
    sc = spark.sparkContext
    sc.setJobGroup("shuffled rows", "")
    try:
        got = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store, tracker = sc._jsc.sc().statusStore(), sc.statusTracker()
    ran = {s for j in tracker.getJobIdsForGroup("shuffled rows") for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)}
    return got, sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in ran)


def test_salted_projection_shuffles_tags_and_not_their_pairs(spark):
    tags = spark.range(400).select(F.explode(F.array(*map(F.lit, "xyz"))).alias("i"), F.concat(F.lit("t"), "id").alias("t"))
    pairs, rows = _shuffled_rows(spark, lambda: G.salted_projection(tags, "i", "t").collect())
    assert len({(r.a, r.b) for r in pairs}) == len(pairs) == 400 * 399 // 2 and {r.weight for r in pairs} == {3} and all(r.a < r.b for r in pairs)
    assert 0 < rows < 400 * 3 * 2 + 400 * 12


def test_salted_projection_shuffles_no_more_for_more_blocks(spark):
    """A block is shuffled once, not once for each of the others; the pairs stay the same."""
    tags = spark.range(600).select(F.explode(F.array(*map(F.lit, "xyz"))).alias("i"), F.concat(F.lit("t"), "id").alias("t"))
    (_, before), (few, rows), (many, more) = (_shuffled_rows(spark, lambda n=n: n and {tuple(r) for r in G.salted_projection(tags, "i", "t", n).collect()}) for n in (0, 3, 24))
    assert few == many and len(few) == 600 * 599 // 2 and more - rows < rows - before + 600  # the helper's counts run on


def test_cells_are_counted_alike_in_steps_of_any_size():
    import numpy as np
    rng = np.random.default_rng(3)
    for sides, n, items in (([0], 40, 9), ([-1, 1], 60, 300), ([-1, 1], 50, 5), ([1], 9, 4), ([-1], 9, 4), ([0], 1, 4)):
        side = rng.choice(sides, n)
        sets = [set(rng.integers(0, items, rng.integers(0, 12)).tolist()) for _ in range(n)]
        want = {(min(u, v), max(u, v)): len(sets[u] & sets[v]) for u in range(n) for v in range(n) if u != v and sides != [1] and sides != [-1]
                and (side[u] == 0 or side[u] < side[v]) and sets[u] & sets[v]}
        for most in (1, 7, 50, 10_000):
            parts = list(G._counted(side, np.array([len(x) for x in sets]), np.array([i for x in sets for i in x], dtype=np.int32), most))
            got = [(min(u, v), max(u, v), w) for p in parts for u, v, w in zip(*(x.tolist() for x in p))]
            assert len({g[:2] for g in got}) == len(got) and {g[:2]: g[2] for g in got} == want


def test_researcher_projection_of_papers_as_they_come(spark, tmp_path):
    """Repeated records, records without a key, authors without an id, no authors or references, and references that differ by their form only."""
    from quillspark.plans.citing import a7_researcher_projection

    works = ["https://openalex.org/W1", "w1", "W2", None, " "]
    rows = [(1, [(a,) for a in ("https://x/a1", "A2", None)], works), (1, [(a,) for a in ("https://x/a1", "A2", None)], works), (2, [("a3",), ("A2",)], ["W2"]),
            (3, None, ["W2"]), (4, [("A4",)], None), (None, [("A5",)], ["W1", "W2"]), (5, [("A6",)], ["W9"])]
    shape = "item_id long, bibliography struct<authors:array<struct<openalex:string>>>, graph struct<referenced_works:array<string>>"
    spark.createDataFrame([(k, (a,), (w,)) for k, a, w in rows], shape).write.parquet(f"{tmp_path}/items.parquet")
    assert {tuple(r) for r in a7_researcher_projection(spark, str(tmp_path)).collect()} == {("A1", "A2", 2), ("A1", "A3", 1), ("A2", "A3", 1)}


PAPER = ("item_id long, work_key string, arxiv string, doi string, openalex string, url string, abstract string, cited long, state string, "
         "collectors array<string>, title string, day date, authors array<struct<name:string,orcid:string>>, refs array<string>, source_name string, collected_at long, "
         "categories array<string>, topics array<struct<id:string>>")


def paper_rows(spark, *rows):
    base = {"collectors": ["c"], "cited": 0, "authors": [], "refs": [], "collected_at": 0, "categories": [], "topics": []}
    names = [x.split()[0] for x in PAPER.split(", ")]
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in rows], PAPER)


def test_collapse_joins_by_all_keys_and_keeps_singletons(spark):
    from quillspark.plans.records import collapse, identity_keys

    p = paper_rows(spark, {"item_id": 1, "work_key": "doi:10.1000/a", "doi": "https://doi.org/10.1000/A", "abstract": " ", "cited": 4, "collectors": ["x"]},
                   {"item_id": 2, "work_key": "openalex:W5", "openalex": "https://x/w5", "doi": "10.1000/a", "abstract": "Text", "state": "published"},
                   {"item_id": 3, "work_key": "arxiv:2608.00001v2", "openalex": "W5", "url": "https://x/abs/2608.00001v1"},
                   {"item_id": 4, "work_key": "other:4", "url": "https://x/abs/2608.00001"}, {"item_id": 5, "work_key": "other:5"},
                   {"item_id": 6, "work_key": "doi:10.48550/arXiv.math/0309136", "arxiv": "math/0309136", "doi": "10.48550/arXiv.math/0309136"})
    keys = {r.item_id: r["keys"] for r in identity_keys(p).collect()}
    assert keys == {1: ["doi:10.1000/a"], 2: ["doi:10.1000/a", "openalex:W5"], 3: ["arxiv:2608.00001", "openalex:W5"], 4: ["arxiv:2608.00001"], 5: [],
                    6: ["arxiv:math/0309136"]}
    got = {r.root: r for r in collapse(p).collect()}
    assert {k: r.members for k, r in got.items()} == {1: 4, 5: 1, 6: 1}
    r = got[1]
    assert (r.work_key, r.abstract, r.cited, r.published, r.collectors) == ("arxiv:2608.00001v2", "Text", 4, "published", ["c", "x"])
    assert r.member_keys == ["arxiv:2608.00001v2", "doi:10.1000/a", "openalex:W5", "other:4"]


def test_collapse_fills_authors_and_keeps_the_order_of_categories(spark):
    from quillspark.plans.records import collapse

    p = paper_rows(spark, {"item_id": 1, "work_key": "openalex:W1", "authors": [("A", None), (None, "o2")], "categories": ["x", "y", None], "topics": [("T1",)]},
                   {"item_id": 2, "work_key": "openalex:W1", "authors": [("Z", "o1"), ("B", "o9")], "categories": ["z", "y"]}, {"item_id": 3, "work_key": "openalex:W1", "authors": [("one", "o")]})
    (r,) = collapse(p).collect()
    assert (r.authors, r.categories, r.topics, r.members) == (["A|o1", "B|o2"], ["x", "y", "z"], ["T1"], 3)


def test_supplier_components_use_lines_of_any_quantity(spark):
    from quillspark.plans.citing import supplier_components

    rng = random.Random(7)
    rows = [(rng.randrange(60), rng.randrange(90), float(rng.randrange(1, 51))) for _ in range(70)] + [(100, 200, 50.0), (101, 200, 1.0), (101, 201, 2.0), (102, 201, 50.0)]
    group = {s: {s} for s, _, _ in rows}
    for s, p, _ in rows:
        for t, q, _ in rows:
            if p == q and group[s] is not group[t]:
                group[s] |= group[t]
                for x in group[t]:
                    group[x] = group[s]
    got = dict(map(tuple, supplier_components(spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_quantity double")).collect()))
    assert got == {s: min(g) for s, g in group.items() if len(g) > 1} and got[102] == 100


def test_paper_components_match_union_find(spark):
    from quillspark.plans.records import paper_components

    rng = random.Random(11)
    rows = [{"item_id": i, "work_key": f"doi:10.1000/{rng.randrange(90)}", "openalex": f"W{rng.randrange(90)}" if i % 2 else None,
             "url": f"https://x/abs/2608.{rng.randrange(90):05d}" if i % 3 == 0 else None} for i in range(80)]
    parent = {r["item_id"]: r["item_id"] for r in rows}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a in rows:
        for b in rows:
            if any(a.get(k) and a.get(k) == b.get(k) for k in ("work_key", "openalex", "url")):
                x, y = find(a["item_id"]), find(b["item_id"])
                parent[max(x, y)] = min(x, y)
    assert dict(map(tuple, paper_components(paper_rows(spark, *rows)).collect())) == {i: find(i) for i in parent}


def test_demand_queue_is_whole_and_in_order(spark):
    from quillspark.plans.citing import demand_queue

    rng = random.Random(13)
    cited = [f"W{int(rng.paretovariate(0.7)) % 3000}" for _ in range(4000)]
    own = {"W1", "W17", "W18"}
    count: dict = {}
    for r in cited:
        count[r] = count.get(r, 0) + 1
    want = sorted(((r, n) for r, n in count.items() if r not in own), key=lambda x: (-x[1], x[0]))
    got = demand_queue(spark.createDataFrame([(r,) for r in cited], "ref string"), spark.createDataFrame([*((r,) for r in own), (None,)], "ref string"))
    assert len(want) > 200 and sorted((r.place, r.ref, r.demand) for r in got.collect()) == [(i, r, n) for i, (r, n) in enumerate(want, 1)]
    assert K.places(spark.createDataFrame([], "v int"), [F.desc("v")]).count() == 0


def test_silent_sources_know_every_kind(spark, tmp_path):
    from datetime import datetime
    from quillspark.plans.daily import st4_silent_sources

    rows = [(datetime(2026, 1, 1, 5, 30), f"k{i}") for i in range(1100)] + [(datetime(2026, 1, 1, 9, 1), "k7")]
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = st4_silent_sources(spark, str(tmp_path)).collect()
    assert {(r.hour.hour, r.event_type) for r in got} == {(9, f"k{i}") for i in range(1100) if i != 7} and len(got) == 1099


def test_reference_base_and_index_add_unclaimed_raw_works(spark):
    import json
    from quillspark.operators.references import first_claims
    from quillspark.plans.records import base_rows, index_rows

    rng = random.Random(17)
    keys = [(i, [f"k{rng.randrange(60)}" for _ in range(rng.randrange(1, 4))]) for i in range(60)] + [(100, ["a"]), (101, ["a", "b"]), (102, ["b"])]
    claimed, want = set(), set()
    for i, ks in keys:
        if not claimed & set(ks):
            claimed |= set(ks)
            want.add(i)
    assert {r.id for r in first_claims(spark.createDataFrame(keys, "i long, k array<string>"), "i", "k").collect()} == want and 102 in want
    p = paper_rows(spark, {"item_id": 1, "work_key": "openalex:W1", "openalex": "W1", "doi": "10.1000/one", "refs": ["W9", "W8"], "title": "One", "collected_at": 5},
                   {"item_id": 2, "work_key": "openalex:w1", "refs": ["W7"], "title": "Old", "collected_at": 4},
                   {"item_id": 3, "work_key": "openalex:W3", "openalex": "W3", "title": "Three"})
    work = lambda **x: json.dumps({"referenced_works": ["w5", "https://x/W4", "w5"], "display_name": "T"} | x)
    raw = [work(id="https://x/W1"), work(id="W77", doi="https://doi.org/10.1000/ONE"), work(id="W3"), work(id="W20", publication_date="2026-01-02",
           authorships=[{"author": {"display_name": n}} for n in "abcdef"]), work(id="W20"), work(id="W21", doi="10.1000/z"), work(id="W22", doi="10.1000/Z"),
           work(id="W30", referenced_works=[]), work(display_name="no id"), "{broken"]
    r = spark.createDataFrame(list(enumerate(raw)), "record_id long, payload string")
    got = {x.work_key: x for x in base_rows(p, r).collect()}
    assert {k: (x.from_raw, x.refs) for k, x in got.items()} == {"openalex:W1": (False, ["W8", "W9"]), "openalex:W20": (True, ["W4", "W5"]), "doi:10.1000/z": (True, ["W4", "W5"])}
    index = {x.work_key: x for x in index_rows(p, r).collect()}
    assert {k: (x.from_raw, x.title) for k, x in index.items()} == {"openalex:W1": (False, "One"), "openalex:W3": (False, "Three"), "openalex:W20": (True, "T"),
                                                                    "doi:10.1000/one": (True, "T"), "doi:10.1000/z": (True, "T")}
    assert index["openalex:W20"].first_authors == list("abcde") and index["openalex:W20"].year == 2026 and index["doi:10.1000/z"].doi == "10.1000/z"


def joins(p):
    kids = p.children()
    return (p.nodeName() == "Join") + sum(joins(kids.apply(i)) for i in range(kids.size()))


def test_neighbours_compute_their_pairs_once(spark):
    from quillspark.plans.citing import j7_paper_coupling, w12_paper_neighbours
    d = "/root/testdata/sf0.001"
    n = [joins(f(spark, d)._jdf.queryExecution().optimizedPlan()) for f in (j7_paper_coupling, w12_paper_neighbours)]
    assert n[0] == n[1] > 0


def test_coupling_where_references_share_bits(spark):
    """Numbers of references that differ by a multiple of 64 share a bit; the pairs are those of brute force."""
    rng = random.Random(12)
    works = [(i, rng.sample(range(150), rng.randrange(1, 40)), 1 + i % 28) for i in range(120)]
    works += [(200 + i, [1000 + 64 * j for j in range(6)] + list(range(2000 + 200 * i, 2100 + 200 * i)), 3) for i in range(6)]
    e = spark.createDataFrame([(k, r, date(2026, 1, d)) for k, refs, d in works for r in refs], "k int, r int, d date")
    for least, days in ((1, 3), (3, 10), (4, None)):
        want = {}
        for a, ra, da in works:
            for b, rb, db in works:
                n = len(set(ra) & set(rb))
                if (da, a) < (db, b) and n >= least and (days is None or db - da <= days):
                    want[a, b] = n
        assert {(r.a, r.b): r.shared for r in C.coupling(e, "k", "r", "d", least, days).collect()} == want and want


def test_coupling_order_computes_its_pairs_once(spark, monkeypatch):
    """What ``places`` reads twice is a saved table."""
    from quillspark.plans import measure
    given = []
    monkeypatch.setattr(measure.K, "places", lambda df, *a: given.append(df) or df)
    measure.so8_coupling_order(spark, "/root/testdata/sf0.001")
    assert joins(given[0]._jdf.queryExecution().optimizedPlan()) == 0
