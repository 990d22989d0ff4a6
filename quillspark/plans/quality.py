"""Queries that measure: precision, distributions, calibration, samples, selections."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from quillspark.operators import metrics as M, ranking as K
from quillspark.plans.common import PP, PT, collection, papers, topics
from quillspark.sources.tables import table

query, QUERIES, SQL = collection()

#: Judgements: labelled documents; a day is the label's day, the rank is by length within it, grade 3 and 4 is kept.
_J = """l AS (SELECT DISTINCT doc_id, grade, rater, labelled_at, corrected_from FROM level_labels),
  v AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY labelled_at DESC, grade) AS rn FROM l),
  j AS (SELECT v.doc_id, grade, rater, labelled_at::DATE AS day, grade >= 3 AS keep, dd.n_chars, row_number() OVER (PARTITION BY rater ORDER BY dd.n_chars DESC, v.doc_id) AS rank
        FROM v JOIN (SELECT DISTINCT doc_id, n_chars FROM documents) dd ON dd.doc_id = v.doc_id WHERE rn = 1)"""


def judged(spark, d):
    v = K.latest(table(spark, d, "level_labels").distinct(), ["doc_id"], [F.desc("labelled_at"), F.col("grade")])
    j = v.join(table(spark, d, "documents").select("doc_id", "n_chars").distinct(), "doc_id").select(
        "doc_id", "grade", "rater", F.col("labelled_at").cast("date").alias("day"), (F.col("grade") >= 3).alias("keep"), "n_chars")
    return j.withColumn("rank", F.row_number().over(Window.partitionBy("rater").orderBy(F.desc("n_chars"), "doc_id")).cast("bigint"))


@query(f"WITH {_J} SELECT doc_id, grade, rater, day FROM j")
def w1_latest_wins(spark, d):
    return judged(spark, d).select("doc_id", "grade", "rater", "day")


@query(f"""WITH {_J}, x AS (SELECT rater, avg(keep::INT) AS p, count(*) AS n FROM j WHERE rank <= 10 GROUP BY rater HAVING count(*) >= 8)
SELECT count(*) AS days, round(avg(p), 6) AS precision FROM x""")
def a18_precision_at_10(spark, d):
    return M.precision_at_k(judged(spark, d), "rater", "rank", "keep")


@query(f"""WITH {_J}, x AS (SELECT rater, rank, avg(keep::INT) OVER (PARTITION BY rater ORDER BY rank ROWS UNBOUNDED PRECEDING) AS p FROM j)
SELECT rank AS depth, round(avg(p), 6) AS precision, count(*) AS raters FROM x WHERE rank <= 20 GROUP BY rank""")
def w6_precision_by_depth(spark, d):
    w = Window.partitionBy("rater").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    x = judged(spark, d).withColumn("p", F.avg(F.col("keep").cast("int")).over(w)).where("rank <= 20")
    return x.groupBy(F.col("rank").alias("depth")).agg(F.round(F.avg("p"), 6).alias("precision"), F.count("*").alias("raters"))


_BANDS = "(VALUES (0, 800), (800, 1200), (1200, 1800), (1800, NULL)) b(lo, hi)"


@query(f"WITH {_J} SELECT lo, hi, count(*) AS n, round(avg(keep::INT), 6) AS keep_rate FROM j JOIN {_BANDS} ON n_chars >= lo AND (hi IS NULL OR n_chars < hi) GROUP BY lo, hi")
def a50_score_bands(spark, d):
    cuts = [0, 800, 1200, 1800, None]
    c = F.col("n_chars")
    band = F.coalesce(*(F.when((c >= lo) & (F.lit(True) if hi is None else c < hi), F.struct(F.lit(lo).alias("lo"), F.lit(hi).cast("int").alias("hi"))) for lo, hi in zip(cuts, cuts[1:])))
    return (judged(spark, d).withColumn("b", band).where("b is not null").groupBy("b.lo", "b.hi")
            .agg(F.count("*").alias("n"), F.round(F.avg(F.col("keep").cast("int")), 6).alias("keep_rate")))


@query(f"WITH {_J} SELECT CASE WHEN day >= DATE '2026-09-20' THEN 'after' ELSE 'before' END AS side, count(*) AS n, round(avg(keep::INT), 6) AS keep_rate, count(*) >= 30 AS readable FROM j GROUP BY 1")
def a19_f25_rate_by_standard(spark, d):
    side = F.when(F.col("day") >= F.lit("2026-09-20").cast("date"), "after").otherwise("before")
    return judged(spark, d).groupBy(side.alias("side")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("keep").cast("int")), 6).alias("keep_rate"), (F.count("*") >= 30).alias("readable"))


@query(f"""WITH {_J}, g AS (SELECT rater, count(*) AS n, sum(keep::INT) AS k FROM j GROUP BY rater)
SELECT rater, n, k::BIGINT AS kept, round((k / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS upper,
  round(pow(0.05, 1.0 / n), 6) AS exact_lower FROM g""")
def a39_a49_intervals(spark, d):
    g = judged(spark, d).groupBy("rater").agg(F.count("*").alias("n"), F.sum(F.col("keep").cast("int")).alias("kept"))
    return g.select("rater", "n", "kept", F.round(M.wilson_upper(F.col("kept"), F.col("n")), 6).alias("upper"), F.round(F.pow(F.lit(0.05), 1 / F.col("n")), 6).alias("exact_lower"))


@query(f"""WITH {_J}, x AS (SELECT a.n_chars AS p, b.n_chars AS q FROM j a, j b WHERE a.keep AND NOT b.keep)
SELECT round(avg(CASE WHEN p > q THEN 1.0 WHEN p = q THEN 0.5 ELSE 0.0 END), 6)::DOUBLE AS auc FROM x""")
def a46_auc(spark, d):
    return M.auc(judged(spark, d), "n_chars", "keep")


@query()
def a47_mann_whitney(spark, d):
    return M.mann_whitney(judged(spark, d), "n_chars", "keep")


@query(f"""WITH {_J}, x AS (SELECT n_chars >= 1200 AS long_, keep FROM j)
SELECT count(*) FILTER (WHERE long_ AND keep) AS a, count(*) FILTER (WHERE long_ AND NOT keep) AS b, count(*) FILTER (WHERE NOT long_ AND keep) AS c, count(*) FILTER (WHERE NOT long_ AND NOT keep) AS d FROM x""")
def a58_two_by_two(spark, d):
    x = judged(spark, d).withColumn("long_", F.col("n_chars") >= 1200)
    return x.agg(F.count_if(F.col("long_") & F.col("keep")).alias("a"), F.count_if(F.col("long_") & ~F.col("keep")).alias("b"),
                 F.count_if(~F.col("long_") & F.col("keep")).alias("c"), F.count_if(~F.col("long_") & ~F.col("keep")).alias("d"))


@query(f"""WITH {_J}, x AS (SELECT n_chars >= 1200 AS long_, keep FROM j), t AS (SELECT count(*) FILTER (WHERE long_ AND keep) AS a, count(*) FILTER (WHERE long_ AND NOT keep) AS b, count(*) FILTER (WHERE NOT long_ AND keep) AS c, count(*) FILTER (WHERE NOT long_ AND NOT keep) AS d FROM x),
  k AS (SELECT t.*, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS i FROM t),
  q AS (SELECT *, exp(lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(i + 1) - lgamma(a + b - i + 1) - lgamma(a + c - i + 1) - lgamma(d - a + i + 1) - lgamma(a + b + c + d + 1)) AS w FROM k), s AS (SELECT w AS seen FROM q WHERE i = a)
SELECT any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, any_value(d) AS d, least(1.0, sum(w)) AS p FROM q, s WHERE w <= seen * (1 + 1e-9)""")
def a48_fisher(spark, d):
    return a58_two_by_two(spark, d).select("a", "b", "c", "d", M.fisher_exact("a", "b", "c", "d").alias("p"))


@query(f"WITH {_J} SELECT rater, round(quantile_cont(n_chars, 0.25), 4) AS q1, round(quantile_cont(n_chars, 0.5), 4) AS q2, round(quantile_cont(n_chars, 0.75), 4) AS q3, "
       "list_sort(list(n_chars))[(len(list(n_chars)) // 2 + 1)] AS upper_median, list_sort(list(n_chars))[(floor(0.9 * (count(*) - 1) + 0.5) + 1)::BIGINT] AS p90 FROM j GROUP BY rater")
def s34_s35_quantiles(spark, d):
    j = judged(spark, d)
    g = j.groupBy("rater").agg(F.percentile("n_chars", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    places = M.values_at(j, ["rater"], "n_chars", {"upper_median": M.upper_half, "p90": M.nearest(0.9)})
    return g.join(places, "rater").select("rater", *(F.round(F.get("q", i), 4).alias(f"q{i + 1}") for i in range(3)), "upper_median", "p90")


_DAYS = """s AS (SELECT unnest(range(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day FROM events),
  c AS (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1), f AS (SELECT s.day, coalesce(c.n, 0) AS n FROM s LEFT JOIN c ON c.day = s.day)"""


def daily(spark, d):
    """Events of every day between the first and the last, 0 where there are none."""
    e = table(spark, d, "events")
    c = e.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return K.day_spine(e, "ts").join(c, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"WITH {_DAYS} SELECT count(*) AS days, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, min(n) AS least, max(n) AS most, sum(n)::BIGINT AS total FROM f")
def a10_daily_distribution(spark, d):
    return daily(spark, d).agg(F.count("*").alias("days"), *(F.percentile("n", q).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)),
                               F.min("n").alias("least"), F.max("n").alias("most"), F.sum("n").alias("total"))


@query("""WITH d AS (SELECT DISTINCT ts::DATE AS day FROM events), fl AS (SELECT unnest([10.0, 25.0, 50.0, 75.0, 90.0])::DOUBLE AS floor_),
  n AS (SELECT floor_, d.day, count(e.value) FILTER (WHERE e.value >= floor_) AS n FROM fl, d JOIN events e ON e.ts::DATE = d.day GROUP BY 1, 2)
SELECT floor_, quantile_cont(n, 0.5) AS median_n, count(*) FILTER (WHERE n < 100) AS short_days FROM n GROUP BY floor_""")
def a11_candidates_by_floor(spark, d):
    e = table(spark, d, "events").select(F.col("ts").cast("date").alias("day"), "value")
    n = e.groupBy("day").agg(*(F.count_if(F.col("value") >= f).alias(f"f{int(f)}") for f in (10.0, 25.0, 50.0, 75.0, 90.0)))
    long = n.select("day", F.explode(F.array(*(F.struct(F.lit(f).alias("floor_"), F.col(f"f{int(f)}").alias("n")) for f in (10.0, 25.0, 50.0, 75.0, 90.0)))).alias("x")).select("day", "x.*")
    return long.groupBy("floor_").agg(F.percentile("n", 0.5).alias("median_n"), F.count_if(F.col("n") < 100).alias("short_days"))


@query("SELECT strftime(ts, '%Y-%m') AS month, event_type, round(avg(value), 4) AS mean_value, count(*) AS n FROM events GROUP BY 1, 2")
def a12_mean_by_month(spark, d):
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM").alias("month"), "event_type").agg(F.round(F.avg("value"), 4).alias("mean_value"), F.count("*").alias("n"))


@query("""WITH v AS (SELECT event_type, round(value) AS v, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, count(*) AS kinds, first(v ORDER BY n DESC, v) AS modal_value, round(max(n) / sum(n), 6) AS modal_share FROM v GROUP BY event_type""")
def a13_mode_audit(spark, d):
    v = table(spark, d, "events").groupBy("event_type", F.round("value").alias("v")).agg(F.count("*").alias("n"))
    return v.groupBy("event_type").agg(F.count("*").alias("kinds"), F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v"))).alias("modal_value"),
                                       F.round(F.max("n") / F.sum("n"), 6).alias("modal_share"))


@query("""WITH t AS (SELECT o_orderdate::DATE AS day, round(max(o_totalprice), -3) AS v FROM orders GROUP BY 1), n AS (SELECT v, count(*) AS n FROM t GROUP BY v),
  r AS (SELECT v, sum(n) OVER (ORDER BY v DESC) / sum(n) OVER () AS rate FROM n)
SELECT v AS value, round(rate, 6) AS rate, row_number() OVER (ORDER BY CASE WHEN rate BETWEEN 0.3 AND 0.5 THEN 0 ELSE 1 END, round(abs(rate - 0.4), 9), v) = 1 AS chosen FROM r""")
def a15_calibration(spark, d):
    tops = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.round(F.max("o_totalprice"), -3).alias("v"))
    return M.calibration(tops, "v")


@query("""WITH b AS (SELECT least(19, floor(value / 5)) AS bucket, count(*) AS n FROM events GROUP BY 1) SELECT s::DOUBLE AS bucket, coalesce(n, 0) AS n FROM (SELECT unnest(range(20)) AS s) LEFT JOIN b ON bucket = s""")
def so15_histogram(spark, d):
    b = table(spark, d, "events").groupBy(F.least(F.lit(19), F.floor(F.col("value") / 5)).cast("double").alias("bucket")).agg(F.count("*").alias("n"))
    return spark.range(20).select(F.col("id").cast("double").alias("bucket")).join(b, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


@query(PP + """, x AS (SELECT item_id, source_id, cited, cume_dist() OVER (PARTITION BY source_id ORDER BY cited) AS share FROM p WHERE source_id IS NOT NULL AND cited IS NOT NULL) SELECT item_id, source_id, round(share, 6) AS share FROM x""")
def a44_percentile_rank(spark, d):
    x = papers(spark, d).where("source_id is not null and cited is not null")
    return x.select("item_id", "source_id", F.round(F.cume_dist().over(Window.partitionBy("source_id").orderBy("cited")), 6).alias("share"))


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def a45_pearson(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"), F.count("*").alias("n"))


@query(PP + """, x AS (SELECT collectors[1] AS collector, date_diff('day', day, collected_at::DATE) AS lag FROM p WHERE day IS NOT NULL)
SELECT collector, count(*) AS n, list_sort(list(lag))[(floor(0.5 * (count(*) - 1) + 0.5) + 1)::BIGINT] AS p50, list_sort(list(lag))[(floor(0.9 * (count(*) - 1) + 0.5) + 1)::BIGINT] AS p90,
  count(*) FILTER (WHERE lag < 0) AS negative, round(avg(CASE WHEN lag <= 7 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS within_week FROM x GROUP BY collector""")
def a37_lags(spark, d):
    x = papers(spark, d).where("day is not null").select(F.get("collectors", 0).alias("collector"), F.datediff(F.col("collected_at").cast("date"), "day").cast("bigint").alias("lag"))
    g = x.groupBy("collector").agg(F.count("*").alias("n"), F.count_if(F.col("lag") < 0).alias("negative"), F.round(F.avg(F.when(F.col("lag") <= 7, 1.0).otherwise(0.0)), 6).alias("within_week"))
    places = M.values_at(x, ["collector"], "lag", {"p50": M.nearest(0.5), "p90": M.nearest(0.9)})
    return g.join(places.withColumnRenamed("collector", "c"), F.col("collector").eqNullSafe(F.col("c")), "left").select("collector", "n", "p50", "p90", "negative", "within_week")


@query(PP + """, n AS (SELECT source_id, count(*) AS n FROM p WHERE source_id IS NOT NULL GROUP BY 1), x AS (SELECT *, row_number() OVER (ORDER BY n DESC, source_id) AS rn FROM n)
SELECT count(*) AS sources, quantile_cont(n, 0.5) AS median_n, max(n) AS most, round(sum(n) FILTER (WHERE rn <= 10) / sum(n), 6) AS top_share, count(*) FILTER (WHERE n < 5) AS small FROM x""")
def a63_composition(spark, d):
    n = papers(spark, d).where("source_id is not null").groupBy("source_id").agg(F.count("*").alias("n"))
    top = n.orderBy(F.desc("n"), "source_id").limit(10).agg(F.sum("n").alias("top"))
    return n.agg(F.count("*").alias("sources"), F.percentile("n", 0.5).alias("median_n"), F.max("n").alias("most"), F.sum("n").alias("all"),
                 F.count_if(F.col("n") < 5).alias("small")).crossJoin(top).select("sources", "median_n", "most", F.round(F.col("top") / F.col("all"), 6).alias("top_share"), "small")


_SLOT = """q AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day, o_orderpriority IN ('1-URGENT') AS first_, o_totalprice AS v FROM orders),
  f AS (SELECT k, day, 'first' AS path, row_number() OVER (PARTITION BY day ORDER BY v DESC, k) AS rank FROM q WHERE first_ QUALIFY rank <= 3),
  u AS (SELECT day, count(*) AS used FROM f GROUP BY day),
  o AS (SELECT k, q.day, 'other' AS path, row_number() OVER (PARTITION BY q.day ORDER BY v DESC, k) AS rank, least(4, 2 + greatest(0, 3 - coalesce(used, 0))) AS lim FROM q LEFT JOIN u ON u.day = q.day WHERE NOT first_ QUALIFY rank <= lim)"""


@query(f"WITH {_SLOT} SELECT k, day, path, rank FROM f UNION ALL SELECT k, day, path, rank FROM o")
def w3_lent_slots(spark, d):
    q = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderpriority") == "1-URGENT").alias("first_"), F.col("o_totalprice").alias("v"))
    order = [F.desc("v"), F.col("k")]
    return K.lent_slots(q, "day", F.col("first_"), order, 3, order, 2, 4).select("k", "day", "path", F.col("rank").cast("bigint").alias("rank"))


@query("""WITH r AS (SELECT o_orderdate::DATE AS day, o_orderkey AS k, o_totalprice AS v FROM orders) SELECT day, max({'v': v, 'k': k}).k AS best, max(v) AS score, CASE WHEN max(v) >= 400000 THEN 'lead' ELSE 'day' END AS form FROM r GROUP BY day""")
def so1_so2_headline(spark, d):
    """The best of each day; of equals the larger key; the form depends on a threshold."""
    return (table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("best"), F.max("o_totalprice").alias("score"),
        F.when(F.max("o_totalprice") >= 400000, "lead").otherwise("day").alias("form")))


@query("""WITH x AS (SELECT p_partkey, p_brand, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn, greatest(1, count(*) OVER (PARTITION BY p_brand) // 10) AS step FROM part),
 y AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY rn) AS at_ FROM x WHERE (rn - 1) % step = 0) SELECT p_brand, p_partkey FROM y WHERE at_ <= 10""")
def w19_stride_sample(spark, d):
    return K.stride(table(spark, d, "part"), ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 10).select("p_brand", "p_partkey")


@query(PP + ", x AS (SELECT item_id, source_id, row_number() OVER (PARTITION BY source_id ORDER BY md5('42:' || item_id), item_id) AS draw FROM p) SELECT * FROM x WHERE draw <= 2")
def w13_w14_hash_sample(spark, d):
    return K.hash_sample(papers(spark, d).select("item_id", "source_id"), ["source_id"], ["item_id"], 2)


@query(PP + """, s AS (SELECT source_id, count(*) AS size FROM p WHERE source_id IS NOT NULL GROUP BY 1), x AS (SELECT p.item_id, p.source_id, row_number() OVER (PARTITION BY p.source_id ORDER BY md5('42:' || p.item_id), p.item_id) AS turn, size FROM p JOIN s ON s.source_id = p.source_id)
SELECT source_id, item_id, turn, size FROM x ORDER BY turn, size DESC, source_id LIMIT 100""")
def w18_round_robin(spark, d):
    return K.round_robin(papers(spark, d).where("source_id is not null").select("item_id", "source_id"), "source_id", "item_id", 100)


@query(PP + """, x AS (SELECT source_id, item_id, row_number() OVER (PARTITION BY source_id ORDER BY cited DESC NULLS LAST, item_id) AS rn, count(*) OVER (PARTITION BY source_id) AS n FROM p WHERE source_id IS NOT NULL)
SELECT source_id, item_id, n < 5 AS below_floor FROM x WHERE rn <= 40""")
def w21_floor_ceiling(spark, d):
    x = papers(spark, d).where("source_id is not null").withColumn("n", F.count("*").over(Window.partitionBy("source_id")))
    return K.top_in_group(x, ["source_id"], [F.desc_nulls_last("cited"), F.col("item_id")], 40).select("source_id", "item_id", (F.col("n") < 5).alias("below_floor"))


@query(f"""WITH {_DAYS}, x AS (SELECT day, n, n < avg(n) OVER () AS low FROM f), g AS (SELECT day, day - (row_number() OVER (ORDER BY day))::INT AS g FROM x WHERE low)
SELECT min(day) AS first, max(day) AS last, count(*) AS days FROM g GROUP BY g""")
def a36_streaks(spark, d):
    x = daily(spark, d)
    low = x.crossJoin(F.broadcast(x.agg(F.avg("n").alias("mean")))).where("n < mean").select("day").withColumn("one", F.lit(1))
    return K.runs(low, ["one"], "day").drop("one")


@query(f"""WITH {_DAYS} SELECT day, n, CASE WHEN n = 0 THEN 12 ELSE greatest(8, round(100.0 * n / max(n) OVER ()))::INT END AS height, lag(day) OVER (ORDER BY day) AS previous, lead(day) OVER (ORDER BY day) AS next FROM f""")
def w16_w17_bars_and_neighbours(spark, d):
    w = Window.orderBy("day")
    x = daily(spark, d)
    most = x.agg(F.max("n").alias("most"))
    return x.crossJoin(F.broadcast(most)).select("day", "n", F.when(F.col("n") == 0, 12).otherwise(F.greatest(F.lit(8), F.round(100.0 * F.col("n") / F.col("most")).cast("int"))).alias("height"),
                                                 F.lag("day").over(w).alias("previous"), F.lead("day").over(w).alias("next"))


@query("""SELECT label, count(*) AS n, round(avg(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)))), 5) AS mean_norm FROM embeddings GROUP BY label""")
def u5_vector_norms(spark, d):
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(norm), 5).alias("mean_norm"))


@query("""WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings), s AS (SELECT label, i, sum(x) AS s, count(*) AS n FROM e GROUP BY 1, 2),
 c AS (SELECT e.vec_id, e.label, sum(e.x * (s.s - e.x)) AS dot, sqrt(sum(e.x * e.x)) AS a, sqrt(sum((s.s - e.x) * (s.s - e.x))) AS b FROM e JOIN s ON s.label = e.label AND s.i = e.i WHERE s.n > 1 GROUP BY 1, 2)
SELECT vec_id, label, round(dot / (a * b), 4) AS cosine FROM c""")
def u5_leave_one_out_cosine(spark, d):
    """Cosine of each vector with the mean of the others of its label."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    s = e.groupBy("label").agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("x")))).alias("s"), F.count("*").alias("n")).where("n > 1")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)
    c = e.join(s, "label").withColumn("rest", F.zip_with("s", "x", lambda a, b: a - b))
    return c.select("vec_id", "label", F.round(dot("x", "rest") / F.sqrt(dot("x", "x") * dot("rest", "rest")), 4).alias("cosine"))


@query()
def u2_logistic_regression(spark, d):
    """A regularised, class-weighted model of label 0 against the rest, with AUC on vectors held out by hash."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    e = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), (F.col("label") == 0).cast("double").alias("y"))
    held = F.pmod(F.xxhash64("vec_id"), F.lit(4)) == 0
    train = e.where(~held)
    share = train.agg(F.avg("y")).first()[0] or 0.5
    train = train.withColumn("w", F.when(F.col("y") == 1, 0.5 / max(share, 1e-6)).otherwise(0.5 / max(1 - share, 1e-6)))
    model = LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", regParam=0.01, maxIter=50).fit(train)
    test = model.transform(e.where(held))
    score = BinaryClassificationEvaluator(labelCol="y").evaluate(test)
    return test.agg(F.count("*").alias("tested"), F.round(F.avg((F.col("prediction") == F.col("y")).cast("double")), 4).alias("accuracy")).withColumn("auc", F.lit(round(score, 4)))


@query("SELECT c_mktsegment, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((c_mktsegment, n_name), (c_mktsegment), ())")
def a17_grouping_sets(spark, d):
    """Figures pooled and by side in one pass."""
    table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).createOrReplaceTempView("quill_customers")
    return spark.sql("SELECT c_mktsegment, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM quill_customers GROUP BY GROUPING SETS ((c_mktsegment, n_name), (c_mktsegment), ())")
