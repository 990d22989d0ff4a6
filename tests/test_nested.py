import json

from quillspark.operators.nested import child_rows, flat_tables, still_wrapped

FULL = {"id": "https://works.example/W1", "display_name": "T", "publication_date": "2026-01-02", "cited_by_count": 3,
        "authorships": [{"author": {"id": "A1", "display_name": "X"}, "institutions": [{"ror": "https://r.example/9a/"}, {"ror": None, "display_name": None},
                                                                                   {"display_name": "Uni  B"}]},
                        {"author": {"id": "A2"}, "institutions": {"display_name": "Lone"}}, {"author": None, "institutions": None}],
        "referenced_works": ["w5", "", None, "https://works.example/W6", "w5"], "topics": ["T1", {"id": "x/t2", "score": 0.5}, {}],
        "primary_location": {"source": {"id": "x/s9"}, "landing_page_url": "u"}}
EXPECTED = {("institution", 1, 1, "9a"), ("institution", 1, 3, "Uni  B"), ("institution", 2, 1, "Lone"), ("reference", 0, 1, "W5"),
            ("reference", 0, 4, "W6"), ("reference", 0, 5, "W5"), ("topic", 0, 1, "T1"), ("topic", 0, 2, "T2"), ("location", 0, 1, "S9")}


def rows(spark, payloads, **more):
    data = [(i, p, "clash", 1) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(data, "record_id long, payload string, child string, pos int")
    return {tuple(r) for r in child_rows(df).collect()}


def test_children_of_every_layout(spark):
    inner = json.dumps(FULL)
    nested = {"bibliography": {"authors": FULL["authorships"], "primary_location": FULL["primary_location"]},
              "graph": {"referenced_works": FULL["referenced_works"]}, "entities": {"topics": FULL["topics"]}}
    payloads = [inner, json.dumps({"results": [FULL]}), json.dumps({"data": {"work": FULL}}), json.dumps({"payload": inner}), json.dumps(nested)]
    got = rows(spark, payloads)
    for i in range(len(payloads)):
        assert {r[1:] for r in got if r[0] == i} == EXPECTED


def test_text_references_and_address(spark):
    p = [json.dumps({"referenced_works": "w1; openalex:W2|w3 w4", "primary_location": {"source": None, "landing_page_url": "https://a.b/C"}}), json.dumps({"referenced_works": " "})]
    assert rows(spark, p) == {(0, "reference", 0, 1, "W1"), (0, "reference", 0, 2, "W2"), (0, "reference", 0, 3, "W3"), (0, "reference", 0, 4, "W4"),
                              (0, "location", 0, 1, "https://a.b/C")}


def test_bad_and_empty_input(spark):
    assert rows(spark, [None, "", "{", '{"authors": 3, "topics": "x", "primary_location": []}', "[1]", "7", "null"]) == set()
    empty = spark.createDataFrame([], "record_id long, payload string")
    assert child_rows(empty).count() == 0
    twice = spark.createDataFrame([(1, json.dumps(FULL))] * 2, "record_id long, payload string")
    assert child_rows(twice).count() == len(EXPECTED)


def test_long_list(spark):
    assert len(rows(spark, [json.dumps({"topics": [f"t{i}" for i in range(20000)]})])) == 20000


def test_flat_tables_keep_parents(spark):
    df = spark.createDataFrame([(4, json.dumps(FULL))], "record_id long, payload string")
    t = flat_tables(df)
    assert t["works"].first()["title"] == "T"
    assert [(r.author_pos, r.openalex) for r in t["authors"].orderBy("author_pos").collect()] == [(1, "A1"), (2, "A2"), (3, None)]
    assert {(r.author_pos, r.pos) for r in t["institutions"].collect()} == {(1, 1), (1, 2), (1, 3), (2, 1)}
    assert t["references"].count() == 5 and t["topics"].count() == 3 and t["locations"].first()["source_id"] == "S9"


def test_result_lists_and_many_envelopes(spark):
    three = json.dumps({"results": [FULL, {"topics": ["T7"]}, 5, {"data": {"work": {"topics": ["T8"]}}}]})
    four = json.dumps({"payload": json.dumps({"data": {"work": {"payload": json.dumps({"results": [FULL]})}}})})
    got = rows(spark, [three, four])
    assert {r[1:] for r in got if r[0] == 0} == EXPECTED | {("topic", 0, 1, "T7"), ("topic", 0, 1, "T8")}
    assert {r[1:] for r in got if r[0] == 1} == EXPECTED
    df = spark.createDataFrame([(0, three), (1, four), (2, None), (3, "{")], "record_id long, payload string")
    works = flat_tables(df)["works"].select("record_id", "result").collect()
    assert sorted(map(tuple, works)) == [(0, 1), (0, 2), (0, 3), (1, 1)]
    assert still_wrapped(df).count() == 0 and [tuple(r) for r in still_wrapped(df, depth=2).collect()] == [(1, 1)]
