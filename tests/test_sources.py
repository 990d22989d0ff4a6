from datetime import date

import pytest
from pyspark.sql import functions as F

from quillspark.sources import feedsource, store
from quillspark.sources.feeds import atom_entries, json_lines

FEED = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:x="urn:example"><entry><title>Trams
 and   trees</title><id>https://archive.example/abs/2511.00042v7</id><x:primary_category term="econ.GN"/><category term="stat.AP"/><category term="econ.GN"/>
<author><name> Eva E </name></author><author><name>Finn F</name></author><published>2025-11-03T09:30:00Z</published><summary>Of <i>streets</i>.</summary></entry>
<entry><id>https://archive.example/abs/2511.00077v1</id><published>last week</published><title>Second</title><x:doi>10.9/ABC</x:doi></entry>
<entry><title>Without a key</title><id>urn:none</id></entry></feed>"""


def test_atom(spark):
    df = spark.createDataFrame([(FEED,), (None,), ("<feed",), ("",)], "x string")
    a, b = atom_entries(df, "x").orderBy("work_key").collect()
    assert (a.work_key, a.title, a.abstract, a.authors, a.categories, a.published, a.doi) == (
        "arxiv:2511.00042", "Trams and trees", "Of streets.", ["Eva E", "Finn F"], ["econ.GN", "stat.AP"], date(2025, 11, 3), "10.48550/arxiv.2511.00042")
    assert (b.doi, b.published, b.authors) == ("10.9/abc", None, [])


def page(ids, total):
    return f"<feed><totalResults>{total}</totalResults>" + "".join(f"<entry><id>https://archive.example/abs/{i}</id><title>T {i}</title></entry>" for i in ids) + "</feed>"


def test_feed_pages_by_window(spark, tmp_path):
    for window, pages in {"2026-01-01_2026-01-07": [page(["2601.00001", "2601.00002"], 3), page(["2601.00003"], 3), page(["2601.00009"], 3)], "2026-01-08_2026-01-14": [page([], 0)],
                          "2026-01-15_2026-01-16": [page(["2601.00004", "2601.00005"], 9), page(["2601.00006", "2601.00007"], 9), page(["2601.00008"], 9)]}.items():
        (tmp_path / window).mkdir()
        for i, text in enumerate(pages):
            (tmp_path / window / f"page-{i}.xml").write_text(text)
    feedsource.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    df = spark.read.format("feed_pages").option("root", str(tmp_path)).option("start", "2026-01-01").option("end", "2026-01-16").option("most", "4").load()
    assert sorted((r.window_from.day, r.page, r.offset, r.entries, r.truncated) for r in df.collect()) == [(1, 0, 0, 2, False), (1, 1, 2, 1, False), (15, 0, 0, 2, False), (15, 1, 2, 2, True)]
    late = df.where(F.col("window_from") > F.lit("2026-01-07").cast("date"))
    assert {r.work_key for r in atom_entries(late, "xml").collect()} == {f"arxiv:2601.0000{i}" for i in (4, 5, 6, 7)}
    assert late.rdd.getNumPartitions() == 2


def test_windows_and_query_text():
    assert feedsource.windows(date(2026, 1, 1), date(2026, 1, 3)) == [(date(2026, 1, 1), date(2026, 1, 3))] and feedsource.windows(date(2026, 1, 2), date(2026, 1, 1)) == []
    assert feedsource.range_query(["a.B", "c"], date(2026, 1, 1), date(2026, 1, 3)) == "(cat:a.B OR cat:c) AND submittedDate:[202601010000 TO 202601032359]"


def test_store(spark, tmp_path):
    path = str(tmp_path / "issues")
    rows = lambda *r: spark.createDataFrame(list(r), "day date, work_key string")
    store.write_issues(rows((date(2026, 1, 1), "a"), (date(2026, 1, 2), "b")), path)
    store.write_issues(rows((date(2026, 1, 2), "c")), path)
    assert [r.work_key for r in store.read_issue(spark, path, "2026-01-02").collect()] == ["c"] and spark.read.parquet(path).count() == 2
    assert [r.value for r in store.json_line(spark.createDataFrame([(1, "x\u2028y")], "b int, a string")).collect()] == ['{"a":"x\\u2028y","b":1}']
    labels = spark.createDataFrame([(1, "day"), (2, "day")], "doc int, sampling string")
    store.append_labels(labels, str(tmp_path / "labels"), "day")
    with pytest.raises(Exception, match="another sampling"):
        store.append_labels(labels.withColumn("sampling", F.lit("week")), str(tmp_path / "labels"), "day")
    assert spark.read.parquet(str(tmp_path / "labels")).count() == 2
    x = spark.createDataFrame([(date(2026, 1, 1), "k", 1), (date(2026, 1, 1), "j", None)], "day date, key string, grade int")
    bundle = store.export_bundle(x)
    assert sorted(map(tuple, store.import_bundle(bundle, "grade int, key string").select("day", "key", "grade").collect())) == sorted(map(tuple, x.collect()))
    with pytest.raises(Exception, match="bundle of version"):
        store.import_bundle(bundle, "grade int, key string", version=2).collect()
    feed = store.newest_feed(spark.createDataFrame([(date(2026, 1, i), f"a < b {i}") for i in range(1, 6)], "day date, title string"), 2).collect()
    assert len(feed) == 2 and all("a &lt; b" in r.xml for r in feed)


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2, "b": 3}\nnot json\n{"a": \n')
    good, bad = json_lines(spark, str(tmp_path), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2] and bad.count() == 2
