"""Replays, queues, vocabularies, signals and figures against brute force."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quillspark.functions import signals as S
from quillspark.operators import citations as C, graph as G, metrics as M, nested as N, queues as Q, replay, vocabulary as V


def test_growing_archive_matches_a_loop_over_days(spark):
    rng = random.Random(5)
    rows = [(i, date(2026, 1, 1) + timedelta(rng.randrange(12)), rng.choice([0.2, 0.35, 0.45, 0.6]), [f"t{rng.randrange(25)}" for _ in range(rng.randrange(5))]) for i in range(150)]
    seen, want = set(), {}
    for day in sorted({r[1] for r in rows}):
        took = set()
        for i, d, rel, tags in rows:
            if d == day:
                own = set(tags)
                nov = sum(t not in seen for t in own) / len(own) if own else 0.0
                score = round(rel + 0.2 * nov, 6)
                want[i] = (round(nov, 6), score, score >= 0.5)
                if score >= 0.5:
                    took |= own
        seen |= took
    p = spark.createDataFrame(rows + [(900, None, 0.9, ["t1"]), (901, date(2026, 1, 3), None, None)], "item_id long, day date, relevance double, tags array<string>")
    got = {r.item_id: (r.novelty, r.score, r.taken) for r in replay.growing_archive(p).collect()}
    assert got == want | {901: (0.0, 0.0, False)}
    assert replay.growing_archive(p.where("item_id < 0")).count() == 0


def test_window_stability(spark):
    rng = random.Random(2)
    rows = [(i, f"t{rng.randrange(9)}", date(2026, 3, 31) - timedelta(rng.randrange(100))) for i in range(150) for _ in range(3)]
    got = replay.window_stability(spark.createDataFrame(rows, "item_id long, topic string, day date"), top=5, min_degree=1).collect()
    assert [(r.shorter, r.longer) for r in got] == [(30, 60), (30, 90), (60, 90)] and all(r.rho is None or -1 <= r.rho <= 1 for r in got)


def brute_betweenness(arcs, nodes):
    out = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        for t in nodes:
            if s == t:
                continue
            paths, frontier = [], [[s]]
            while frontier and not paths:
                paths = [p for p in frontier if p[-1] == t]
                frontier = [p + [v] for p in frontier for v in arcs.get(p[-1], ()) if v not in p]
            for p in paths:
                for v in p[1:-1]:
                    out[v] += 1 / len(paths)
    n = len(nodes)
    return {v: x / ((n - 1) * (n - 2)) for v, x in out.items()}


@pytest.mark.parametrize("directed", [False, True])
def test_betweenness_against_all_paths(spark, directed):
    rng = random.Random(8)
    pairs = {tuple(sorted(rng.sample(range(9), 2))) for _ in range(13)}
    pairs = {(b, a) if directed and rng.random() < 0.4 else (a, b) for a, b in pairs}
    arcs: dict = {}
    for a, b in pairs:
        arcs.setdefault(a, []).append(b)
        if not directed:
            arcs.setdefault(b, []).append(a)
    df = spark.createDataFrame(sorted(pairs), "a int, b int")
    got = {r.node: r.score for r in G.betweenness(df, 1, directed=directed).collect()}
    want = brute_betweenness(arcs, sorted({x for p in pairs for x in p}))
    assert got == pytest.approx(want, abs=1e-8)
    assert set(G.betweenness(df, 1, directed=directed, sources=3).columns) == {"node", "score"} and G.betweenness(df.where("a < 0"), 1).count() == 0
    with pytest.raises(ValueError):
        G.betweenness(df, 1, max_edges=2)


def test_coupling_keys_spare_the_common_references(spark):
    """A third of all works cite three works that everyone cites; the pairs are those of a plain count."""
    rng = random.Random(4)
    works = [(k, date(2026, 1, 1) + timedelta(rng.randrange(60)), {f"r{rng.randrange(60)}" for _ in range(rng.randrange(1, 6))} | ({"hot1", "hot2"} if k % 3 == 0 else set())) for k in range(120)]
    want = set()
    for a, da, ra in works:
        for b, db, rb in works:
            if (da, a) < (db, b) and (db - da).days <= 20 and len(ra & rb) >= 3:
                want.add((a, b, len(ra & rb)))
    e = spark.createDataFrame([(k, r, d) for k, d, rs in works for r in rs] + [(1, None, date(2026, 1, 1)), (None, "x", None)], "k int, r string, d date")
    assert {(r.a, r.b, r.shared) for r in C.coupling(e, "k", "r", "d", 3, 20).collect()} == want and len(want) > 20
    assert C.coupling(e.where("k < 0"), "k", "r", "d").count() == 0


def test_values_at_and_cumulated(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(30)) for g in ["a"] * 40 + ["b"] * 5 + [None] * 4] + [("a", None)]
    got = {r.g: (r.m, r.p) for r in M.values_at(spark.createDataFrame(rows, "g string, v int"), ["g"], "v", {"m": M.upper_half, "p": M.nearest(0.9)}).collect()}
    for g in ("a", "b", None):
        v = sorted(x for h, x in rows if h == g and x is not None)
        assert got[g] == (v[len(v) // 2], v[int(0.9 * (len(v) - 1) + 0.5)])


def test_rank_tests_against_enumeration(spark):
    from math import comb, erfc, sqrt
    rng = random.Random(7)
    rows = [(float(rng.randrange(12)), rng.random() < 0.4) for _ in range(60)]
    u, p = M.mann_whitney(spark.createDataFrame(rows, "s double, k boolean"), "s", "k").first()
    pos, neg = [s for s, k in rows if k], [s for s, k in rows if not k]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    n1, n0, n = len(pos), len(neg), len(rows)
    ties = sum(c ** 3 - c for c in Counter(s for s, _ in rows).values())
    z = (want - n1 * n0 / 2) / sqrt(n1 * n0 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert u == pytest.approx(want) and p == pytest.approx(erfc(abs(z) / sqrt(2)))
    a, b, c, d = 7, 2, 3, 9
    like = lambda i: comb(a + b, i) * comb(c + d, a + c - i) / comb(a + b + c + d, a + c)
    exact = sum(like(i) for i in range(max(0, a - d), min(a + b, a + c) + 1) if like(i) <= like(a) * (1 + 1e-9))
    assert spark.createDataFrame([(a, b, c, d)], "a int, b int, c int, d int").select(M.fisher_exact("a", "b", "c", "d")).first()[0] == pytest.approx(exact)


def test_queues(spark):
    s = spark.createDataFrame([("a", 1, "pending"), ("b", 2, "pending"), ("c", 1, "resolved")], "k string, attempts int, state string")
    t = spark.createDataFrame([("a", 1, True), ("b", 1, False), ("c", 5, False), ("d", 1, False), ("e", 4, None)], "k string, attempts int, hit boolean")
    assert {tuple(r) for r in Q.advance(s, t, "k", 3).collect()} == {("a", 2, "resolved"), ("b", 3, "parked"), ("c", 1, "resolved"), ("d", 1, "pending"), ("e", 4, "parked")}
    q = spark.createDataFrame([("a", 1), ("b", 0), ("c", 7), ("d", 3), ("e", 1)], "k string, attempts int")
    assert {(r.k, r.open, r.place) for r in Q.queue_places(q, "k", 3).collect()} == {("b", True, 1), ("a", True, 2), ("e", True, 3), ("d", False, 1), ("c", False, 2)}
    assert [r.k for r in Q.due(q, "k", 3, 2).collect()] == ["b", "a"]


def test_vocabulary_against_brute_force(spark):
    rng = random.Random(3)
    surfaces = ["planning quarterly", "transport analytics", "street studies", "journal of settlement science", "urban letters"]
    damage = lambda s: "".join(c for c in s if rng.random() > 0.06)
    terms = [damage(rng.choice(surfaces)).title() for _ in range(40)] + ["Urban-Letters", "nothing alike", "", None]

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    want = {}
    for t in {t for t in terms if t and t.strip()}:
        s = " ".join(t.lower().replace("-", " ").split())
        r, i = max((200 * lcs(s, w) / (len(s) + len(w)), -n) for n, w in enumerate(surfaces))
        want[t] = (f"v{-i}", round(r / 100, 4)) if r >= 88 else (None, 0.0)
    v = spark.createDataFrame([(s, f"v{n}", n) for n, s in enumerate(surfaces)], "surface string, id string, place int")
    got = {r.term: (r.id, round(r.confidence, 4)) for r in V.matched(spark.createDataFrame([(t,) for t in terms], "t string"), "t", v).collect()}
    assert got == want
    with pytest.raises(ValueError):
        V.matched(v, "surface", v, most_surfaces=2)


def test_longest_run_and_versions(spark):
    rng = random.Random(9)
    for _ in range(40):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(9))] for _ in range(2))
        n = max((k for k in range(1, 10) for i in range(len(a) - k + 1) for j in range(len(b) - k + 1) if a[i:i + k] == b[j:j + k]), default=0)
        words, at = V.longest_run(a, b)
        assert words == n and (not n or any(b[j:j + n] == a[at:at + n] for j in range(len(b))))
    df = spark.createDataFrame([("yolo v5",), ("net-2.1",), ("plain",), ("Brand#12",), (None,)], "t string")
    assert [r[0] for r in df.select(V.without_version(F.lower("t"))).collect()] == ["yolo", "net", None, "brand", None]
    r = spark.createDataFrame([("a b c d", "x b c d"), (None, "a"), ("", "")], "a string, b string").select(V.longest_common_run("a", "b").alias("r")).select("r.*").collect()
    assert [tuple(x) for x in r] == [(3, 1), (0, 0), (0, 0)]


def test_signals_and_lines(spark):
    df = spark.createDataFrame([("Code: https://github.com/a/b.). Data are available, 12,000 trips, from 2019-2023", None), ("neither the data nor the code is given", "https://gitlab.com/x/y"), ("n = 40 since 2020", "see https://gitlab.com/x/y."), (None, None)], "t string, c string")
    none = F.array().cast("array<string>")
    code = [r[0] for r in df.select(S.code_signal(F.col("t"), F.col("c"))).collect()]
    assert [(c.value, c.confidence, c.detail) for c in code] == [(True, "high", "https://github.com/a/b"), (False, "high", None), (True, "high", "https://gitlab.com/x/y"), (False, "medium", None)]
    assert [r[0] for r in df.select(S.data_signal(F.col("t"), none)["confidence"]).collect()] == ["medium", "high", "low", "low"]
    assert [r[0] for r in df.select(S.sample_signal(F.col("t"))["detail"]).collect()] == ["12,000 trips", None, "n = 40", None]
    assert [r[0] for r in df.select(S.period_signal(F.col("t"))["detail"]).collect()] == ["2019-2023", None, "since 2020", None]
    lines = [(" ", ""), ("a\nb", ""), ("w " * 13, ""), ("Done.", ""), ("'Quoted'", ""), ("Trams unlock cities, unlocks", ""), ("A first look", ""), ("First-mile trips", ""), ("How trams run", ""), ("Several trams", ""), ("Trams echo buses", ""),
             ("Trams in 12 towns", "twelve"), ("Trams in two towns", "Two towns"), (None, None)]
    got = spark.createDataFrame(lines, "l string, m string").select(S.line_violation(F.col("l"), F.col("m"))["rule"]).collect()
    assert [r[0] for r in got] == ["empty", "lines", "words", "ending", "quotes", "banned", "first", None, "question", "quantity", "relation", "number", None, "empty"]


def test_json_paths(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": [1, "x", null, {"c": true}]}, "d": {}, "e": 2.5}'), (2, "{"), (3, None), (4, '"s"')], "k int, j string")
    assert {tuple(r) for r in N.json_paths(df, "k", "j").collect()} == {(1, "$.a.b[0]", "1"), (1, "$.a.b[1]", "x"), (1, "$.a.b[3].c", "true"), (1, "$.e", "2.5"), (4, "$", "s")}


def test_shared_runs_against_brute_force(spark):
    """Documents of several rows count once; blanks, short and null texts; few and many common runs."""
    rng = random.Random(11)
    line = [f"w{i}" for i in range(12)]
    rows = [(i % 25 or None, " ".join(rng.choice([line[rng.randrange(4):], line[:9] + ["x"] + line, ["", *line, ""]])) * rng.choice([1, 1, 2])) for i in range(60)]
    rows += [(90, None), (91, ""), (92, "a b c")]
    of = {}
    for k, t in rows:
        w = (t or "").split(" ")
        of.setdefault(k, set()).update(" ".join(w[i:i + 8]) for i in range(len(w) - 7))
    want = {g: n for g, n in Counter(g for gs in of.values() for g in gs).items() if n >= 5}
    for r in (rows, list({k: (k, t) for k, t in rows}.values())):
        held = want if r is rows else None
        got = [{x.shingle: x.docs for x in V.shared_runs(spark.createDataFrame(r, "doc_id long, text string"), "doc_id", "text", most_common=m).collect()} for m in (10_000, 0)]
        assert got[0] == got[1] and len(got[0]) > 10 and (held is None or got[0] == held)


def test_shared_runs_join_no_words_of_documents(spark):
    """No join carries the list of words once for each run of a document."""
    from quillspark.plans.vocabulary import s39_shared_runs

    def joins(p):
        kids = p.children()
        return [*([p] if p.nodeName() == "Join" else []), *(j for i in range(kids.size()) for j in joins(kids.apply(i)))]

    found = joins(s39_shared_runs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan())
    kinds = [out.apply(i).dataType().simpleString() for j in found for out in (j.left().output(), j.right().output()) for i in range(out.size())]
    assert kinds and not [k for k in kinds if k.startswith("array")]


def test_scan_sends_only_the_vocabulary_to_the_driver(spark, tmp_path):
    """However little Spark takes texts to hold, none are broadcast, nor their words; both ways to join give what a loop over texts gives."""
    rng = random.Random(8)
    said = ["space", "syntax", "random", "forests", "Space-Time", "prisms,", "of", "gnn", "x"]
    texts = [(i, " ".join(rng.choice(said) for _ in range(rng.randrange(30)))) for i in range(200)] + [(200, None), (201, ""), (202, "Space Syntax")]
    surfaces = [("space syntax", "s"), ("syntax", "s"), ("random forests", "f"), ("space time prisms", "p"), ("gnn", "g"), ("of", "short"), ("forests of random", "f")]
    want = {}
    for i, t in texts:
        plain = " " + " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()) + " "
        for s, of in surfaces:
            if len(s) >= 3 and f" {s} " in plain:
                want[i, of] = max(want.get((i, of), 0), min(0.95, 0.6 + 0.02 * len(s.split())))
    spark.createDataFrame(texts, "k long, t string").write.parquet(f"{tmp_path}/texts")
    df, v = spark.read.parquet(f"{tmp_path}/texts"), spark.createDataFrame(surfaces, "surface string, id string")
    for most, broadcasts in ((10, 1), (2, 0)):
        hits = V.scan(df, "k", F.col("t"), v, most_surfaces=most)
        assert hits._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") == broadcasts
        assert {(r.k, r.id): r.confidence for r in hits.collect()} == pytest.approx(want)
