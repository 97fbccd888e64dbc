"""Registered recommendation queries (REC*, and the joins/sources/scalars they use)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import recsys as rs
from ..operators.aggregates import drop_duplicate_rows
from ..operators.filters import successful_only
from ..operators.joins import enrich_ranked_list, join_items_interactions, lookup_title, restrict_to_requests
from ..operators.mapping import split_fields
from ..operators.sampling import bernoulli_sample, repartition_for_join
from ..operators.similar import similar_items
from ..session import cut_lineage
from ..sources.readers import read_recommendations, read_requests, scratch_path
from .registry import register
from .views import items, ratings, table, with_views

K = 25
SAMPLE = 0.5
RID = ["userId", "movieId", "timestamp"]


# ---- Spark pipeline ----------------------------------------------------------------------------
def prepared(spark, sf, fraction=1.0):
    return rs.prepare_interactions(items(spark, sf), ratings(spark, sf), fraction=fraction, stable_id=RID)


def interactions(spark, sf):
    return prepared(spark, sf)["interactions"]


def with_context(spark, sf):
    """Interactions carrying the order priority as the request context."""
    r = ratings(spark, sf)
    return r.select(F.col("movieId").alias("ITEM_ID"), F.col("userId").alias("USER_ID"),
                    F.col("timestamp").alias("TIMESTAMP"), "context").dropDuplicates()


def split(spark, sf):
    return rs.evaluate_split(interactions(spark, sf))


def popular_for_test_users(spark, sf, k=K):
    s = split(spark, sf)
    return rs.recommend_popular(s["train"].unionByName(s["test_input"]), s["test_truth"], k)


def all_user_recs(spark, sf):
    inter = interactions(spark, sf)
    return rs.recommend_popular(inter, inter, K)


def results(spark, sf):
    reqs = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("userId"))
    return rs.to_result_records(all_user_recs(spark, sf), reqs)


# ---- SQL twins -----------------------------------------------------------------------------------
def _inter_sql(fraction=None):
    where = ""
    if fraction is not None and fraction < 1:
        from ..operators.sampling import fraction_threshold
        where = (f"WHERE substr(md5('0:' || concat_ws(':', userId, movieId, \"timestamp\")), 1, 8) "
                 f"< '{fraction_threshold(fraction)}'")
    return with_views(f"""SELECT DISTINCT r.movieId AS ITEM_ID, r.userId AS USER_ID, r."timestamp" AS "TIMESTAMP"
FROM items i JOIN (SELECT * FROM ratings {where}) r ON i.movieId = r.movieId""", "ratings", "items")


INTER_SQL = _inter_sql()
SPLIT_SQL = f"""
WITH i AS ({INTER_SQL}),
t AS (SELECT *, row_number() OVER (PARTITION BY USER_ID ORDER BY "TIMESTAMP", ITEM_ID) AS rk,
             count(*) OVER (PARTITION BY USER_ID) AS n
      FROM i WHERE substr(md5('0:' || CAST(USER_ID AS VARCHAR)), 1, 8) < '19999999')"""
TRAIN_SQL = f"""SELECT * FROM ({INTER_SQL}) i WHERE NOT (substr(md5('0:' || CAST(USER_ID AS VARCHAR)), 1, 8) < '19999999')"""
TEST_INPUT_SQL = SPLIT_SQL + " SELECT ITEM_ID, USER_ID, \"TIMESTAMP\" FROM t WHERE rk <= floor(n * 0.9)"
TEST_TRUTH_SQL = SPLIT_SQL + " SELECT ITEM_ID, USER_ID, \"TIMESTAMP\" FROM t WHERE rk > floor(n * 0.9)"


def _popular_sql(history: str, users: str, k=K) -> str:
    return f"""
WITH h AS ({history}),
pop AS (SELECT ITEM_ID, count(*) / sum(count(*)) OVER () AS score FROM h GROUP BY 1),
top AS (SELECT ITEM_ID, score, row_number() OVER (ORDER BY score DESC, ITEM_ID) AS rank FROM pop ORDER BY score DESC, ITEM_ID LIMIT {k}),
u AS (SELECT DISTINCT USER_ID FROM ({users}) x)
SELECT u.USER_ID, CAST(top.rank AS INTEGER) AS rank, top.ITEM_ID, top.score FROM u, top"""


POP_TEST_SQL = _popular_sql(f"SELECT * FROM ({TRAIN_SQL}) a UNION ALL SELECT * FROM ({TEST_INPUT_SQL}) b", TEST_TRUTH_SQL)
ALL_RECS_SQL = _popular_sql(INTER_SQL, INTER_SQL)
RESULTS_SQL = f"""
WITH r AS ({ALL_RECS_SQL}),
g AS (SELECT USER_ID, list(ITEM_ID ORDER BY rank) AS items, list(score ORDER BY rank) AS scores FROM r GROUP BY 1),
q AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS req FROM customer)
SELECT struct_pack(userId := q.req) AS input,
       CASE WHEN g.items IS NOT NULL THEN struct_pack(recommendedItems := list_transform(g.items, lambda x: CAST(x AS VARCHAR)),
                                                       scores := g.scores) END AS output,
       CASE WHEN g.items IS NULL THEN 'Unknown user: ' || q.req END AS error
FROM q LEFT JOIN g ON q.req = CAST(g.USER_ID AS VARCHAR)"""


# ---- registrations ---------------------------------------------------------------------------------
@register("rec1_prepare_interactions", _inter_sql(SAMPLE))
def q_prep_inter(spark, sf):
    return prepared(spark, sf, SAMPLE)["interactions"]


@register("rec1_prepare_metadata", with_views(f"""
SELECT DISTINCT i.title AS TITLE, i.genres AS GENRES, r.movieId AS ITEM_ID
FROM items i JOIN (SELECT * FROM ratings WHERE substr(md5('0:' || concat_ws(':', userId, movieId, "timestamp")), 1, 8) < '80000000') r
  ON i.movieId = r.movieId""", "ratings", "items"))
def q_prep_meta(spark, sf):
    return prepared(spark, sf, SAMPLE)["metadata"]


@register("prj8_split_fields", with_views("""
SELECT r.userId, r.rating, r."timestamp", r.context, i.movieId FROM items i JOIN ratings r ON i.movieId = r.movieId""",
                                          "ratings", "items"))
def q_split_fields(spark, sf):
    it, r = items(spark, sf), ratings(spark, sf).withColumnRenamed("movieId", "(right) movieId")
    j = it.join(r, it["movieId"] == r["`(right) movieId`"])
    return split_fields(j, rs.METADATA_FIELDS)["rest"]


@register("prj8_split_fields_selected", with_views("""
SELECT i.genres, i.title, r.movieId AS "(right) movieId" FROM items i JOIN ratings r ON i.movieId = r.movieId""", "ratings", "items"))
def q_split_fields_selected(spark, sf):
    it, r = items(spark, sf), ratings(spark, sf).withColumnRenamed("movieId", "(right) movieId")
    return split_fields(it.join(r, it["movieId"] == r["`(right) movieId`"]), rs.METADATA_FIELDS)["selected"]


@register("joi1_join_items_interactions", with_views("""
SELECT r.*, i.movieId AS ITEM_KEY, i.title, i.genres FROM ratings r JOIN items i ON r.movieId = CAST(i.movieId AS BIGINT)""",
                                                     "ratings", "items"))
def q_join_items(spark, sf):
    it = items(spark, sf).withColumn("ITEM_KEY", F.col("movieId").cast("string")).drop("movieId")
    return join_items_interactions(it, ratings(spark, sf), "ITEM_KEY", "movieId").withColumn(
        "ITEM_KEY", F.col("ITEM_KEY"))


@register("agg3_drop_duplicate_rows", with_views(
    "SELECT DISTINCT userId, movieId, context FROM ratings", "ratings"))
def q_dedupe(spark, sf):
    return drop_duplicate_rows(ratings(spark, sf).select("userId", "movieId", "context"))


@register("smp3_bernoulli_sample_hash", with_views("""
SELECT * FROM ratings WHERE substr(md5('7:' || concat_ws(':', userId, movieId, "timestamp")), 1, 8) < '0ccccccd'""",
                                                   "ratings"))
def q_bernoulli_hash(spark, sf):
    return bernoulli_sample(ratings(spark, sf), 0.05, seed=7, id_col=RID)


@register("smp3_bernoulli_sample_random")
def q_bernoulli_random(spark, sf):
    return bernoulli_sample(ratings(spark, sf), 0.05, seed=0)


@register("prt1_repartition_for_join", with_views("""
SELECT r.userId, r.movieId, i.title FROM ratings r JOIN items i ON r.movieId = i.movieId""", "ratings", "items"))
def q_repartition(spark, sf):
    r = repartition_for_join(ratings(spark, sf), 16, "movieId")
    it = repartition_for_join(items(spark, sf), 16, "movieId")
    return r.join(it, "movieId").select("userId", "movieId", "title")


@register("rec10_popularity_count", f"""
SELECT ITEM_ID, CAST(count(*) AS BIGINT) AS events, count(*) / sum(count(*)) OVER () AS score FROM ({INTER_SQL}) i GROUP BY 1""")
def q_popularity(spark, sf):
    return rs.popularity_count(interactions(spark, sf))


@register("rec10_recommend_popular", ALL_RECS_SQL)
def q_rec_popular(spark, sf):
    return all_user_recs(spark, sf)


CTX_SQL = with_views("""SELECT DISTINCT movieId AS ITEM_ID, userId AS USER_ID, "timestamp" AS "TIMESTAMP", context
FROM ratings""", "ratings")


@register("rec5_normalise_scores", f"""
WITH p AS (SELECT ITEM_ID, count(*) AS events FROM ({INTER_SQL}) i GROUP BY 1),
e AS (SELECT ITEM_ID, events, exp(ln(events) - max(ln(events)) OVER ()) AS ex FROM p)
SELECT ITEM_ID, events, ex / sum(ex) OVER () AS score FROM e""")
def q_normalise(spark, sf):
    return rs.normalise_scores(rs.popularity_count(interactions(spark, sf)).withColumn("score", F.log("events")))


@register("rec5_normalise_by_context", f"""
WITH c AS ({CTX_SQL}), p AS (SELECT context, ITEM_ID, count(*) AS n FROM c GROUP BY 1, 2),
e AS (SELECT context, ITEM_ID, exp(n - max(n) OVER (PARTITION BY context)) AS ex FROM p)
SELECT context, ITEM_ID, ex / sum(ex) OVER (PARTITION BY context) AS score FROM e""")
def q_normalise_context(spark, sf):
    c = with_context(spark, sf).groupBy("context", "ITEM_ID").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return rs.normalise_scores(c, key="context")


SIMILAR_SQL = f"""
WITH c AS (SELECT USER_ID AS u, ITEM_ID AS i, count(*) AS c FROM ({INTER_SQL}) s GROUP BY 1, 2),
n AS (SELECT i, sum(c * c) AS n FROM c GROUP BY 1),
p AS (SELECT a.i AS x, b.i AS y, sum(a.c * b.c) AS dot FROM c a JOIN c b ON a.u = b.u AND a.i <> b.i GROUP BY 1, 2),
s AS (SELECT x, y, CAST(dot AS DOUBLE) / sqrt(CAST(nx.n AS DOUBLE) * CAST(ny.n AS DOUBLE)) AS score
      FROM p JOIN n nx ON nx.i = x JOIN n ny ON ny.i = y)
SELECT x AS ITEM_ID, CAST(rank AS INTEGER) AS rank, y AS SIMILAR_ITEM, score FROM
  (SELECT *, row_number() OVER (PARTITION BY x ORDER BY score DESC, y) AS rank FROM s) r WHERE rank <= 10"""


@register("rec9_similar_items", SIMILAR_SQL)
def q_similar(spark, sf):
    return similar_items(interactions(spark, sf), k=10)


@register("rec9_similar_items_heavy", SIMILAR_SQL)
def q_similar_heavy(spark, sf):
    """Most users count as heavy: their pairs pass through the bounds."""
    return similar_items(interactions(spark, sf), k=10, light=24)


@register("rec8_rerank_in_context", f"""
WITH c AS ({CTX_SQL}), r AS ({ALL_RECS_SQL}),
n AS (SELECT ITEM_ID, context, count(*) AS n FROM c GROUP BY 1, 2),
sh AS (SELECT ITEM_ID, context, n / sum(n) OVER (PARTITION BY ITEM_ID) AS share FROM n),
s AS (SELECT q.USER_ID, q.context, r.ITEM_ID, r.score * coalesce(sh.share, 0.0) AS score
      FROM (SELECT DISTINCT USER_ID, context FROM c) q JOIN r USING (USER_ID) LEFT JOIN sh ON sh.ITEM_ID = r.ITEM_ID AND sh.context = q.context)
SELECT USER_ID, context, ITEM_ID, score, CAST(rank AS INTEGER) AS rank FROM
  (SELECT *, row_number() OVER (PARTITION BY USER_ID, context ORDER BY score DESC, ITEM_ID) AS rank FROM s) x WHERE rank <= 10""")
def q_rerank_context(spark, sf):
    c = with_context(spark, sf)
    return rs.rerank_in_context(all_user_recs(spark, sf), c, c, "context", 10)


@register("rec8_recommend_with_context", f"""
WITH c AS ({CTX_SQL}),
cp AS (SELECT context, ITEM_ID, count(*) / sum(count(*)) OVER (PARTITION BY context) AS score FROM c GROUP BY context, ITEM_ID),
ct AS (SELECT *, row_number() OVER (PARTITION BY context ORDER BY score DESC, ITEM_ID) AS rank FROM cp),
rq AS (SELECT DISTINCT USER_ID, context FROM c)
SELECT rq.USER_ID, rq.context, CAST(ct.rank AS INTEGER) AS rank, ct.ITEM_ID, ct.score FROM rq JOIN ct USING (context) WHERE ct.rank <= {K}""")
def q_context(spark, sf):
    c = with_context(spark, sf)
    return rs.recommend_with_context(c, c.select("USER_ID", "context").distinct(), "context", K)


@register("rec7_explore", f"""
WITH i AS ({INTER_SQL}),
c AS ({_popular_sql(INTER_SQL, INTER_SQL, 2 * K)}),
f AS (SELECT ITEM_ID, min("TIMESTAMP") AS first_ts FROM i GROUP BY 1),
nw AS (SELECT ITEM_ID FROM f WHERE first_ts >= (SELECT max("TIMESTAMP") FROM i) - 30 * 86400),
b AS (SELECT c.USER_ID, c.ITEM_ID, 0.7 * c.score + CASE WHEN nw.ITEM_ID IS NOT NULL THEN 0.3 ELSE 0.0 END AS score
      FROM c LEFT JOIN nw USING (ITEM_ID)
      UNION ALL SELECT u.USER_ID, nw.ITEM_ID, 0.3 FROM (SELECT DISTINCT USER_ID FROM c) u, (SELECT ITEM_ID FROM nw ORDER BY 1 LIMIT {4 * K}) nw
      WHERE NOT EXISTS (SELECT 1 FROM c x WHERE x.USER_ID = u.USER_ID AND x.ITEM_ID = nw.ITEM_ID)),
r AS (SELECT *, row_number() OVER (PARTITION BY USER_ID ORDER BY score DESC, ITEM_ID) AS rank FROM b)
SELECT USER_ID, ITEM_ID, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {K}""")
def q_explore(spark, sf):
    inter = cut_lineage(interactions(spark, sf))             # six passes read it: joined and sorted out once
    cands = rs.recommend_popular(inter, inter, 2 * K)
    return rs.explore(cands, inter, 0.3, 30, K)


@register("rec11_split_train", TRAIN_SQL)
def q_split_train(spark, sf):
    return split(spark, sf)["train"]


@register("rec11_split_test_input", TEST_INPUT_SQL)
def q_split_input(spark, sf):
    return split(spark, sf)["test_input"]


@register("rec11_split_test_truth", TEST_TRUTH_SQL)
def q_split_truth(spark, sf):
    return split(spark, sf)["test_truth"]


def _metrics_sql(recs_sql: str, truth_sql: str, ks=(5, 10, 25)) -> str:
    kmax = max(ks)
    idcg = lambda k: f"list_sum(list_transform(range(1, least(nt, {k}) + 1), lambda i: 1.0 / ln(1.0 + i)))"
    return f"""
WITH r AS ({recs_sql}), t AS (SELECT DISTINCT USER_ID, ITEM_ID FROM ({truth_sql}) x),
tc AS (SELECT USER_ID, count(*) AS nt FROM t GROUP BY 1),
h AS (SELECT r.USER_ID, r.rank FROM r JOIN t USING (USER_ID, ITEM_ID) WHERE r.rank <= {kmax}),
p AS (SELECT USER_ID, min(rank) AS first_hit,
        {", ".join(f"sum(CASE WHEN rank <= {k} THEN 1.0 / ln(1.0 + rank) END) AS dcg{k}, count(*) FILTER (WHERE rank <= {k}) AS h{k}" for k in ks)}
      FROM h GROUP BY 1),
u AS (SELECT * FROM tc LEFT JOIN p USING (USER_ID))
SELECT avg(coalesce(1.0 / first_hit, 0.0)) AS mrr_at_{kmax},
       {", ".join(f"avg(coalesce(dcg{k}, 0.0) / {idcg(k)}) AS ndcg_at_{k}, avg(coalesce(h{k}, 0) / {float(k)}) AS precision_at_{k}" for k in ks)}
FROM u"""


_SEG = f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY USER_ID ORDER BY "TIMESTAMP", ITEM_ID) AS rk, count(*) OVER (PARTITION BY USER_ID) AS n
FROM ({INTER_SQL}) i) SELECT ITEM_ID, USER_ID, "TIMESTAMP" FROM t WHERE rk {{}} floor(n * 0.8)"""


@register("rec11_segmentation_train", _SEG.format("<="))
def q_segmentation_train(spark, sf):
    return rs.segmentation_split(interactions(spark, sf))["train"]


@register("rec11_segmentation_truth", _SEG.format(">"))
def q_segmentation_truth(spark, sf):
    return rs.segmentation_split(interactions(spark, sf))["truth"]


@register("rec11_split_keeps_context", f"""
WITH c AS ({CTX_SQL}), t AS (SELECT *, row_number() OVER (PARTITION BY USER_ID ORDER BY "TIMESTAMP", ITEM_ID, context) AS rk, count(*) OVER (PARTITION BY USER_ID) AS n
FROM c WHERE substr(md5('0:' || CAST(USER_ID AS VARCHAR)), 1, 8) < '19999999')
SELECT context, CAST(count(*) AS BIGINT) AS events FROM t GROUP BY 1""")
def q_split_context(spark, sf):
    s = rs.evaluate_split(with_context(spark, sf))
    return s["test_input"].unionByName(s["test_truth"]).groupBy("context").agg(F.count(F.lit(1)).cast("bigint").alias("events"))


@register("rec13_15_ranking_metrics", _metrics_sql(POP_TEST_SQL, TEST_TRUTH_SQL))
def q_metrics(spark, sf):
    return rs.ranking_metrics(popular_for_test_users(spark, sf), split(spark, sf)["test_truth"])


@register("rec12_coverage", f"""
SELECT (SELECT count(DISTINCT ITEM_ID) FROM ({ALL_RECS_SQL}) r) / (SELECT count(DISTINCT ITEM_ID) FROM
  (SELECT ITEM_ID FROM ({INTER_SQL}) i UNION ALL SELECT movieId FROM ({with_views('SELECT * FROM items', 'items')}) it) c) AS coverage""")
def q_coverage(spark, sf):
    it = items(spark, sf).select(F.col("movieId").alias("ITEM_ID"))
    return rs.coverage(all_user_recs(spark, sf), interactions(spark, sf), it)


@register("rec16_result_records", RESULTS_SQL)
def q_results(spark, sf):
    return results(spark, sf)


@register("flt5_successful_only", f"SELECT * FROM ({RESULTS_SQL}) r WHERE error IS NULL")
def q_successful(spark, sf):
    return successful_only(results(spark, sf))


_ENRICH_SQL = f"""
WITH r AS ({RESULTS_SQL}), it AS ({with_views('SELECT * FROM items', 'items')}),
e AS (SELECT CAST(r.input.userId AS BIGINT) AS userId, u.pos, u.item
      FROM r, unnest(r.output.recommendedItems) WITH ORDINALITY AS u(item, pos) WHERE r.error IS NULL),
j AS (SELECT e.userId, e.pos, it.title || ' (' || split_part(it.genres, '|', 1) || ')' AS v
      FROM e LEFT JOIN it ON CAST(e.item AS BIGINT) = it.movieId)"""


@register("rec17_transform_results", _ENRICH_SQL + """
SELECT userId, array_to_string(list_filter(list(v ORDER BY pos), lambda x: x IS NOT NULL), ' | ') AS Recommendations,
       CAST(count(*) FILTER (WHERE v IS NULL) AS INTEGER) AS unknown_items FROM j GROUP BY 1""")
def q_transform(spark, sf):
    return rs.transform_results(results(spark, sf), items(spark, sf))


@register("joi3_enrich_ranked_list", _ENRICH_SQL + " SELECT userId, list(v ORDER BY pos) AS titles FROM j GROUP BY 1")
def q_enrich(spark, sf):
    ok = successful_only(results(spark, sf)).select(F.col("input.userId").cast("bigint").alias("userId"),
                                                    F.col("output.recommendedItems").alias("items"))
    it = items(spark, sf)
    return enrich_ranked_list(ok, "userId", "items", it, "movieId", sc.title_with_first_genre(F.col("title"), F.col("genres")),
                              out="titles")


@register("joi4_restrict_to_requests", f"""
SELECT * FROM ({ALL_RECS_SQL}) r WHERE USER_ID IN (SELECT USER_ID FROM ({TEST_TRUTH_SQL}) t)""")
def q_restrict(spark, sf):
    return restrict_to_requests(all_user_recs(spark, sf), split(spark, sf)["test_truth"], "USER_ID")


@register("joi2_lookup_title", f"""
WITH p AS (SELECT ITEM_ID, count(*) AS events FROM ({INTER_SQL}) i GROUP BY 1)
SELECT p.ITEM_ID, p.events, it.title, it.genres FROM p LEFT JOIN ({with_views('SELECT * FROM items', 'items')}) it
  ON p.ITEM_ID = it.movieId""")
def q_lookup(spark, sf):
    p = interactions(spark, sf).groupBy("ITEM_ID").agg(F.count(F.lit(1)).alias("events"))
    return lookup_title(p, items(spark, sf), "ITEM_ID")


@register("src6_read_requests", "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS userId, CAST(NULL AS VARCHAR) AS itemId FROM customer")
def q_read_requests(spark, sf):
    path = scratch_path(spark, "requests")
    table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("userId")).distinct() \
        .write.json(path)
    return read_requests(spark, path)


@register("src7_read_recommendations", RESULTS_SQL)
def q_read_recs(spark, sf):
    path = scratch_path(spark, "results")
    results(spark, sf).write.option("ignoreNullFields", "false").json(path)
    r = read_recommendations(spark, path)
    return r.select(F.struct(F.col("input.userId").alias("userId")).alias("input"),
                    F.when(F.col("output").isNotNull(), F.struct("output.recommendedItems", "output.scores")).alias("output"),
                    "error")


# ---- scalar expressions over the catalogue / pages / events -----------------------------------------
@register("sca1_sca3_title_genre_year", with_views("""
SELECT movieId, title || ' (' || split_part(genres, '|', 1) || ')' AS label, string_split(genres, '|') AS genre_list,
       CAST(NULLIF(regexp_extract(title, '\\((\\d{4})\\)\\s*$', 1), '') AS INTEGER) AS release_year FROM items""", "items"))
def q_sca_titles(spark, sf):
    it = items(spark, sf)
    return it.select("movieId", sc.title_with_first_genre(F.col("title"), F.col("genres")).alias("label"),
                     sc.genres_array(F.col("genres")).alias("genre_list"), sc.release_year(F.col("title")).alias("release_year"))


@register("sca2_explode_genres", with_views("SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM items", "items"))
def q_explode_genres(spark, sf):
    return items(spark, sf).select("movieId", F.explode(sc.genres_array(F.col("genres"))).alias("genre"))


@register("sca4_sca6_url_parts", r"""
SELECT page_id, regexp_replace(url, '^[a-z][a-z0-9+.-]*://[^/]+/?', '') AS path,
       string_split(url_decode(url), '/')[-1] AS file_name,
       regexp_replace(url_decode(url), '/[^/]*$', '') AS folder,
       split_part(url, '/', -1) AS last_part
FROM pages""")
def q_url_parts(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", sc.strip_uri_prefix(F.col("url")).alias("path"), sc.key_file_name(F.col("url")).alias("file_name"),
                    sc.key_folder(F.col("url")).alias("folder"), sc.last_path_part(F.col("url")).alias("last_part"))


@register("sca9_sca10_event_fields", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_event_fields(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", sc.ts_to_epoch(F.col("ts")).alias("epoch_s"), sc.iso_z(F.col("ts")).alias("iso"),
                    sc.json_config(F.col("props"), "k int")["k"].alias("k"))


@register("sca7_round_to_json", """
SELECT event_id, '{"value":' || CAST(round(value, 2) AS VARCHAR) || '}' AS rounded FROM events""")
def q_round_to_json(spark, sf):
    return table(spark, sf, "events").select("event_id", sc.round_to_json(F.col("value"), 2).alias("rounded"))


@register("sca9_parse_times", """
SELECT event_id, date_trunc('second', ts) AS from_epoch, date_trunc('second', ts) AS from_iso FROM events""")
def q_parse_times(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", sc.epoch_to_ts(sc.ts_to_epoch(F.col("ts"))).cast("timestamp_ntz").alias("from_epoch"),
                    sc.parse_iso(sc.iso_z(F.col("ts"))).cast("timestamp_ntz").alias("from_iso"))


# ---- ALS (rows-only) ---------------------------------------------------------------------------------
def _als(spark, sf, inter=None):
    return rs.train_recommender(inter if inter is not None else interactions(spark, sf), rank=8, max_iter=5)


@register("rec2_rec4_als_recommend")
def q_als(spark, sf):
    s = split(spark, sf)
    model, uid, iid = _als(spark, sf, s["train"].unionByName(s["test_input"]))
    return rs.recommend_batch(model, uid, iid, s["test_truth"], K)


@register("rec5_normalise_als")
def q_probabilities(spark, sf):
    s = split(spark, sf)
    model, uid, iid = _als(spark, sf, s["train"].unionByName(s["test_input"]))
    return rs.recommend_probabilities(model, uid, iid, s["test_truth"], K)


@register("rec6_als_segment_users")
def q_segment(spark, sf):
    inter = interactions(spark, sf)
    model, uid, iid = _als(spark, sf, inter)
    asked = rs.segmentation_split(inter)["truth"].select("ITEM_ID")          # the request table: items of the held-back events
    return rs.segment_users(model, uid, iid, asked, K)


@register("rec3_tune")
def q_tune(spark, sf):
    s = split(spark, sf)
    grid = [{"rank": 4, "max_iter": 3}, {"rank": 8, "max_iter": 3}]
    return rs.tune(s["train"], s["test_input"], s["test_truth"], grid, k=10)


@register("rec_als_metrics")
def q_als_metrics(spark, sf):
    s = split(spark, sf)
    model, uid, iid = _als(spark, sf, s["train"].unionByName(s["test_input"]))
    return rs.ranking_metrics(rs.recommend_batch(model, uid, iid, s["test_truth"], K), s["test_truth"])
