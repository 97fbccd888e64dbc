"""Recommendations (REC1-REC17): implicit-feedback training, top-k, ranking metrics and
result enrichment. Candidate tables are ``(user, item, score)``; top-k per user is a
``row_number() <= k`` filter, which Spark cuts per map task before the shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ensure_checkpoint_dir
from .aggregates import drop_duplicate_rows
from .joins import enrich_ranked_list, salt_of, salted
from .mapping import apply_mapping, split_fields
from .ranking import dense_index, rank_within_group
from .sampling import bernoulli_sample, fraction_threshold, repartition_for_join, stable_hash

USER, ITEM, TSC = "USER_ID", "ITEM_ID", "TIMESTAMP"

# ---- fixed values -----------------------------------------------------------------------
# Ratings columns -> join keys; interactions and metadata columns after the split.
RATING_MAPPINGS = [("userId", "bigint", "userId", "long"), ("movieId", "bigint", "(right) movieId", "long"),
                   ("rating", "double", "rating", "double"), ("timestamp", "bigint", "timestamp", "long")]
INTERACTION_MAPPINGS = [("movieId", "string", "ITEM_ID", "long"), ("userId", "string", "USER_ID", "long"),
                        ("timestamp", "string", "TIMESTAMP", "long")]
METADATA_MAPPINGS = [("title", "string", "TITLE", "string"), ("genres", "string", "GENRES", "string"),
                     ("(right) movieId", "string", "ITEM_ID", "long")]
METADATA_FIELDS = ["genres", "title", "(right) movieId"]
DEFAULT_K = 25
#: Counts in a block of a fit: a task holds a block's counts in memory, several times over while it sorts them.
BLOCK_COUNTS, LEAST_BLOCKS = 4_000_000, 10
#: Items of a ball, the least that a search takes or leaves.
BALL = 512
#: Queries whose bounds are taken at a time, that meet a ball at a time, and pairs of a query and a ball held at a time.
QUERY_ROWS, MEET_ROWS, MET = 4096, 2048, 1 << 18
# ------------------------------------------------------------------------------------------


def prepare_interactions(items: DataFrame, ratings: DataFrame, fraction: float = 0.05, seed: int = 0,
                         partitions: int | None = None, stable_id: str | None = None,
                         all_items: bool = False) -> dict[str, DataFrame]:
    """REC1. Ratings sampled, joined to items, split into ``interactions(ITEM_ID, USER_ID,
    TIMESTAMP)`` and ``metadata(TITLE, GENRES, ITEM_ID)``, both de-duplicated. The star value
    is dropped: feedback is implicit (Q10). Metadata holds only items with a sampled rating
    (Q11) unless ``all_items``. ``stable_id`` switches to the hash sample."""
    r = bernoulli_sample(ratings, fraction, seed, id_col=stable_id) if fraction < 1 else ratings
    if partitions:
        r = repartition_for_join(r, partitions)
    r = apply_mapping(r, RATING_MAPPINGS)
    j = items.join(r, items["movieId"] == r["`(right) movieId`"], "inner")
    parts = split_fields(j, METADATA_FIELDS)
    inter = drop_duplicate_rows(apply_mapping(parts["rest"], INTERACTION_MAPPINGS))
    meta = drop_duplicate_rows(apply_mapping(parts["selected"], METADATA_MAPPINGS))
    if all_items:
        meta = items.select(F.col("title").alias("TITLE"), F.col("genres").alias("GENRES"),
                            F.col("movieId").cast("bigint").alias("ITEM_ID"))
    return {"interactions": inter, "metadata": meta}


def implicit_counts(interactions: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Events per (user, item): the implicit-feedback strength (partial aggregation)."""
    return interactions.groupBy(user, item).agg(F.count(F.lit(1)).cast("double").alias("strength"))


# ---- model (Spark ML ALS) -----------------------------------------------------------------

def train_recommender(interactions: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                      alpha: float = 1.0, seed: int = 0, user: str = USER, item: str = ITEM):
    """REC2. Implicit ALS over dense int ids (built in parallel). Returns (model, user_ids, item_ids).
    The number of blocks follows the counts (Spark ML's own number for small tables), so a task's share
    stays bounded; each iteration writes the item factors and frees the shuffle behind them."""
    from pyspark.ml.recommendation import ALS

    # written once: the counts feed both indexes and the fit, the indexes every later request
    counts = cut_lineage(implicit_counts(interactions, user, item))
    uid = cut_lineage(dense_index(counts, user, "__u"))
    iid = cut_lineage(dense_index(counts, item, "__i"))
    # a popular item, or a busy user, has many rows: they are dealt by the other key
    data = counts.withColumn("__salt", salt_of(item)).join(salted(uid), [user, "__salt"])
    data = cut_lineage(data.withColumn("__salt", salt_of(user)).join(salted(iid), [item, "__salt"]).drop("__salt"))
    blocks = max(LEAST_BLOCKS, -(-data.count() // BLOCK_COUNTS))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True, userCol="__u",
              itemCol="__i", ratingCol="strength", coldStartStrategy="drop", seed=seed, nonnegative=False,
              numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1)
    return als.fit(data), uid, iid


def recommend_batch(model, uid: DataFrame, iid: DataFrame, users: DataFrame, k: int = DEFAULT_K,
                    user: str = USER, item: str = ITEM) -> DataFrame:
    """REC4. Top-k items for the requested users -> ``(user, rank, item, score)``; users the
    model does not know yield no rows (REC16 turns them into error records)."""
    req = users.select(user).distinct().join(uid, user).select(F.col("__u").alias("id"))
    e = block_top(model.userFactors.join(req, "id", "left_semi"), model.itemFactors, k, single=True)
    return e.join(uid, F.col("u") == F.col("__u")).join(iid, F.col("i") == F.col("__i")) \
        .select(user, "rank", item, "score")


def segment_users(model, uid: DataFrame, iid: DataFrame, items: DataFrame, n: int = DEFAULT_K,
                  user: str = USER, item: str = ITEM) -> DataFrame:
    """REC6. Top-n users for each requested item, descending score."""
    req = items.select(item).distinct().join(iid, item).select(F.col("__i").alias("id"))
    e = block_top(model.itemFactors.join(req, "id", "left_semi"), model.userFactors, n, single=True)
    return e.join(iid, F.col("u") == F.col("__i")).join(uid, F.col("i") == F.col("__u")) \
        .select(item, "rank", user, "score")


def tune(train: DataFrame, holdout_input: DataFrame, holdout_truth: DataFrame, grid, k: int = 10) -> DataFrame:
    """REC3. Fit one model per grid point, score NDCG@k on the holdout; a small driver loop
    over a parameter grid (each fit is a distributed job)."""
    rows = []
    for params in grid:
        model, uid, iid = train_recommender(train.unionByName(holdout_input), **params)
        recs = recommend_batch(model, uid, iid, holdout_truth, k)
        m = ranking_metrics(recs, holdout_truth, ks=(k,)).first()
        rows.append((str(params), float(m[f"ndcg_at_{k}"] or 0.0)))
    spark = train.sparkSession
    return spark.createDataFrame(rows, "params string, ndcg double").withColumn(
        "best", F.col("ndcg") == F.max("ndcg").over(Window.partitionBy()))


# ---- deterministic recommenders ----------------------------------------------------------------

def popularity_count(interactions: DataFrame, item: str = ITEM) -> DataFrame:
    """REC10. Events per item, with the catalogue share (scores sum to 1). The total comes from
    the counts in the same plan: one scalar subquery over the grouped rows."""
    c = interactions.groupBy(item).agg(F.count(F.lit(1)).cast("bigint").alias("events"))
    total = c.agg(F.sum("events").alias("__total"))
    return c.withColumn("score", F.col("events") / total.scalar())


def top_k(cands: DataFrame, k: int, user: str = USER, item: str = ITEM, score: str = "score") -> DataFrame:
    """Top-k per user by score (item id breaks ties) with a 1-based rank."""
    w = Window.partitionBy(user).orderBy(F.col(score).desc(), F.col(item))
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def recommend_popular(interactions: DataFrame, users: DataFrame, k: int = DEFAULT_K, user: str = USER,
                      item: str = ITEM) -> DataFrame:
    """REC10 as a recommender: the k most popular items for every requested user. The k
    items (bounded by ``k``) are fetched once and attached to each user as a literal list."""
    pop = popularity_count(interactions, item).orderBy(F.col("score").desc(), F.col(item)).limit(k).collect()
    it = interactions.schema[item].dataType
    arr = F.array(*[F.struct(F.lit(r[item]).cast(it).alias(item), F.lit(float(r["score"])).alias("score")) for r in pop])
    e = users.select(user).distinct().select(user, F.posexplode(arr).alias("__pos", "__r"))
    return e.select(user, (F.col("__pos") + 1).alias("rank"), F.col("__r")[item].alias(item),
                    F.col("__r.score").alias("score"))


def context_popularity(interactions: DataFrame, context: str, item: str = ITEM) -> DataFrame:
    """Share of each item's events within each context value (scores sum to 1 per context).
    Per-context totals are a grouped aggregate (one row per context) joined back."""
    c = interactions.groupBy(context, item).agg(F.count(F.lit(1)).alias("__n"))
    t = interactions.groupBy(context).agg(F.count(F.lit(1)).alias("__t"))
    return c.join(t, context).withColumn("score", F.col("__n") / F.col("__t")).drop("__n", "__t")


def recommend_with_context(interactions: DataFrame, requests: DataFrame, context: str, k: int = DEFAULT_K,
                           user: str = USER, item: str = ITEM) -> DataFrame:
    """REC8. Each request carries a context value (e.g. device, time of day); items are ranked
    by their popularity within that context, and ``k`` always applies (Q18). The per-context
    top-k table has #contexts x k rows."""
    ctx_top = top_k(context_popularity(interactions, context, item), k, user=context, item=item)
    lists = ctx_top.groupBy(context).agg(F.array_sort(F.collect_list(F.struct("rank", item, "score"))).alias("__list"))   # at most k each
    return requests.select(user, context).join(lists, context).select(user, context, F.inline("__list"))


def rerank_in_context(cands: DataFrame, interactions: DataFrame, requests: DataFrame, context: str, k: int = DEFAULT_K,
                      user: str = USER, item: str = ITEM) -> DataFrame:
    """REC8. The user's own scores re-weighted by the request's context: score x the share of the
    item's events that fall into that context (0 for an item never seen in it), the top ``k`` of
    each (user, context). ``cands`` holds each user's scored candidates."""
    seen = interactions.groupBy(item, context).agg(F.count(F.lit(1)).alias("__n"))
    share = seen.join(seen.groupBy(F.col(item).alias("__it")).agg(F.sum("__n").alias("__t")), F.col(item) == F.col("__it")) \
        .select(F.col(item).alias("__it"), F.col(context).alias("__ctx"), (F.col("__n") / F.col("__t")).alias("__share"))
    asked = requests.select(user, context).distinct().join(cands.select(user, item, "score"), user)
    scored = asked.join(salted(share), (F.col(item) == F.col("__it")) & (F.col(context) == F.col("__ctx")) & (salt_of(user) == F.col("__salt")), "left") \
        .select(user, context, item, (F.col("score") * F.coalesce("__share", F.lit(0.0))).alias("score"))
    w = Window.partitionBy(user, context).orderBy(F.col("score").desc(), F.col(item))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def explore(cands: DataFrame, interactions: DataFrame, weight: float = 0.3, age_cutoff_days: int = 30,
            k: int = DEFAULT_K, user: str = USER, item: str = ITEM, ts: str = TSC) -> DataFrame:
    """REC7. Blend ``(1-w) score + w bonus`` and take the top-k again. New items (first event
    within ``age_cutoff_days`` of the latest event) have bonus 1 and are candidates of their own,
    with score 0 where a user's list lacks them. All new items tie in a user's blend but for that
    score, so of those a list lacks only the first k by id can win a slot: a list of at most
    ``k`` plus the list's length is laid beside each user, and no item is a join key."""
    first = interactions.groupBy(item).agg(F.min(ts).alias("__first"))
    latest = interactions.agg((F.max(ts) - age_cutoff_days * 86400).alias("__cutoff"))
    new = first.where(F.col("__first") >= latest.scalar())
    it = interactions.schema[item].dataType
    longest = cands.groupBy(user).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]    # one scalar: the length of a list
    # new items a list lacks: among the first (k + longest) ids at least k are not in it
    head = [r[0] for r in new.orderBy(item).limit(k + longest).select(item).collect()]
    fresh = F.array(*[F.lit(x).cast(it) for x in head]) if head else F.array().cast(T.ArrayType(it))
    # users share their candidates: few new items are among them, so the rows mostly stay where they are
    own_new = new.join(cands.select(F.col(item).alias("__i")).distinct(), F.col(item) == F.col("__i"), "left_semi")
    marked = cands.join(own_new.select(F.col(item).alias("__new")), F.col(item) == F.col("__new"), "left")
    own = marked.groupBy(user).agg(F.collect_list(F.struct(F.col(item).alias("i"), F.col("score").cast("double").alias("s"),
                                                           F.col("__new").isNotNull().alias("n"))).alias("__own"))
    blend = F.transform("__own", lambda c: F.struct(((1 - weight) * c["s"] + F.when(c["n"], F.lit(float(weight))).otherwise(0.0)).alias("score"), c["i"].alias("i")))
    extra = F.transform(F.array_except(fresh, F.transform("__own", lambda c: c["i"])), lambda x: F.struct(F.lit(float(weight)).alias("score"), x.alias("i")))
    e = own.select(user, F.inline(F.concat(blend, extra))).withColumnRenamed("i", item)
    return top_k(e, k, user, item)


def normalise_scores(catalogue: DataFrame, score: str = "score", key: str | None = None, user: str = USER) -> DataFrame:
    """REC5. Softmax over the whole catalogue, before any top-k: each score in [0, 1], the sum 1
    for each user, or per ``key`` (e.g. a segment); a table without the user column is one
    catalogue. The maximum and the sum are aggregates, so no task has to hold a catalogue."""
    if key is None and user in catalogue.columns:
        key = user
    if key is None:
        top = catalogue.agg(F.max(score).alias("__m"))
        e = catalogue.withColumn("__e", F.exp(F.col(score) - top.scalar()))
        return e.withColumn(score, F.col("__e") / e.agg(F.sum("__e").alias("__s")).scalar()).drop("__e")
    top = catalogue.groupBy(F.col(key).alias("__k")).agg(F.max(score).alias("__m"))
    e = catalogue.join(top, F.col(key).eqNullSafe(F.col("__k"))).withColumn("__e", F.exp(F.col(score) - F.col("__m"))).drop("__k", "__m")
    total = e.groupBy(F.col(key).alias("__k")).agg(F.sum("__e").alias("__s"))
    return e.join(total, F.col(key).eqNullSafe(F.col("__k"))).withColumn(score, F.col("__e") / F.col("__s")).drop("__e", "__k", "__s")


def factor_blocks(factors: DataFrame, size: int, prefix: str) -> DataFrame:
    """Rows of (id, features), dense ids from 0, as one row for each ``size`` of them: the block, its
    ids and its factors in a row (bounded by ``size``)."""
    rows = F.array_sort(F.collect_list(F.struct("id", F.col("features").cast("array<double>").alias("f"))))
    packed = factors.groupBy(F.expr(f"id div {size}").cast("int").alias(f"{prefix}_block")).agg(rows.alias("rows"))
    return packed.select(f"{prefix}_block", F.transform("rows", lambda r: r["id"]).alias(f"{prefix}_ids"),
                         F.flatten(F.transform("rows", lambda r: r["f"])).alias(f"{prefix}_flat"))


def _block_products(users: DataFrame, items: DataFrame, k: int, user_block: int, item_block: int) -> DataFrame:
    """(u, top, blocks): every block of users meets every block of items in one product; what leaves
    it is, for each user, the largest score, the sum of exponentials relative to it, and the ``k``
    best items of the block, never the scores themselves."""
    import numpy as np
    import pyarrow as pa

    packed = cut_lineage(factor_blocks(items, item_block, "i"))
    n_blocks = packed.agg(F.coalesce(F.max("i_block") + 1, F.lit(0))).first()[0]
    asked = factor_blocks(users, user_block, "u").withColumn("i_block", F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks - 1, 0)))))

    def product(batches):
        for b in batches:
            for r in range(b.num_rows):
                u_ids, u, i_ids, i = (b.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(4))
                score = u.reshape(len(u_ids), -1) @ i.reshape(len(i_ids), -1).T
                top = score.max(axis=1)
                total = np.exp(score - top[:, None]).sum(axis=1)
                kept = min(k, len(i_ids))
                least = np.partition(score, len(i_ids) - kept, axis=1)[:, len(i_ids) - kept]      # a sort only of what reaches the k-th best
                row, col = np.nonzero(score >= least[:, None])
                order = np.lexsort((col, -score[row, col], row))                  # ids ascend in a block
                row, col = row[order], col[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                row, col = row[place < kept], col[place < kept]
                best = pa.ListArray.from_arrays(np.arange(len(u_ids) + 1, dtype=np.int32) * kept, pa.StructArray.from_arrays(
                    [pa.array(i_ids[col].astype(np.int32)), pa.array(score[row, col])], names=["i", "s"]))
                yield pa.RecordBatch.from_arrays([pa.array(u_ids.astype(np.int32)), pa.array(top), pa.array(total), best], names=["u", "top", "total", "best"])

    # a given number of tasks: the blocks are few and small, their products are not
    tasks = 2 * max(n_blocks, 1)
    parts = asked.repartition(tasks, "i_block").join(packed.repartition(tasks, "i_block").hint("merge"), "i_block").select("u_ids", "u_flat", "i_ids", "i_flat") \
        .mapInArrow(product, "u int, top double, total double, best array<struct<i: int, s: double>>")
    # at most k items of each block: no user's catalogue is gathered
    return parts.groupBy("u").agg(F.max("top").alias("top"), F.collect_list(F.struct("top", "total", "best")).alias("blocks"))


def _best_of_blocks(k: int):
    flat = F.flatten(F.transform("blocks", lambda x: F.transform(x["best"], lambda y: F.struct((-y["s"]).alias("s"), y["i"].alias("i")))))
    return F.slice(F.array_sort(flat), 1, k)


def block_softmax(users: DataFrame, items: DataFrame, k: int, user_block: int = 2048, item_block: int = 8192) -> DataFrame:
    """(u, rank, i, score): for each user the ``k`` items of the highest probability, where a user's
    probabilities, exp(user . item) over all items, sum to one. ``users`` and ``items`` hold (id,
    features). Maxima and sums of a user's blocks are merged; equal scores go to the smaller id."""
    merged = _block_products(users, items, k, user_block, item_block)
    total = F.aggregate("blocks", F.lit(0.0), lambda acc, x: acc + x["total"] * F.exp(x["top"] - F.col("top")))
    return merged.select("u", "top", total.alias("total"), F.posexplode(_best_of_blocks(k)).alias("pos", "x")) \
        .select("u", (F.col("pos") + 1).alias("rank"), F.col("x.i").alias("i"), (F.exp(-F.col("x.s") - F.col("top")) / F.col("total")).alias("score"))


def _balls(vectors, size: int):
    """Rows of ``vectors`` in groups of at most ``size`` that lie close together: halved across the
    direction in which they differ most."""
    import numpy as np

    todo, groups = [np.arange(len(vectors))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            groups.append(rows)
            continue
        x = vectors[rows] - vectors[rows].mean(axis=0)
        half = len(rows) // 2
        order = np.argpartition(x @ np.linalg.eigh(x.T @ x)[1][:, -1], half)
        todo += [rows[order[half:]], rows[order[:half]]]
    return groups


def _ball_blocks(size: int, kind):
    """A block of items -> one row: their ids and factors ball by ball, and the balls' sizes, centres and radii."""
    import numpy as np
    import pyarrow as pa

    def run(table):
        ids, x = table.column("id").to_numpy(), _matrix(table.column("features").combine_chunks(), table.num_rows, np.float64)
        order = np.argsort(ids)
        ids, x = ids[order], x[order]
        groups = _balls(x, size)
        rows = np.concatenate(groups)
        centres = np.stack([x[g].mean(axis=0) for g in groups])
        radii = np.array([np.sqrt(((x[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centres)])
        parts = (ids[rows].astype(np.int32), x[rows].astype(kind), np.array([len(g) for g in groups], np.int32), centres, radii)
        return pa.table({n: pa.array([a.tobytes()], pa.binary()) for n, a in zip(("ids", "factors", "sizes", "centres", "radii"), parts)})
    return run


def _matrix(lists, rows: int, kind):
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, -1)


def _ball_rows(folder: str, columns=None):
    """The rows of :func:`_ball_blocks` in the shared folder, one after the other, always in the same order."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(folder)
    for f in sorted(x.path for x in where.get_file_info(fs.FileSelector(inner)) if x.base_name.endswith(".parquet")):
        with where.open_input_file(f) as source:
            for batch in pq.ParquetFile(source, buffer_size=1 << 20).iter_batches(batch_size=1, columns=columns):
                yield from batch.to_pylist()


class _BestOf:
    """The ``k`` best (score, id) of each of ``n`` queries, filled as items pass by."""

    def __init__(self, n: int, k: int):
        import numpy as np

        self.k, self.scores, self.ids = k, np.full((n, k), -np.inf), np.zeros((n, k), np.int32)
        self.least = np.full(n, -np.inf)                         # the k-th best so far

    def add(self, rows, ids, scores) -> None:
        """``rows`` lie in runs, one for each query."""
        import numpy as np

        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        counts = np.diff(np.append(first, len(rows)))
        touched, group = rows[first], np.repeat(np.arange(len(first)), counts)
        place = self.k + np.arange(len(rows)) - first[group]
        held_scores, held_ids = (np.concatenate([a[touched], np.full((len(first), counts.max()), none, a.dtype)], axis=1)
                                 for a, none in ((self.scores, -np.inf), (self.ids, 0)))
        held_scores[group, place], held_ids[group, place] = scores, ids
        order = np.lexsort((held_ids, -held_scores), axis=-1)[:, :self.k]
        self.scores[touched], self.ids[touched] = (np.take_along_axis(a, order, axis=1) for a in (held_scores, held_ids))
        self.least[touched] = self.scores[touched, self.k - 1]


def _search(queries, folder: str, kind, k: int, single: bool = False) -> _BestOf:
    """A query's product with an item of a ball is at most its product with the centre and its length
    times the radius. Where that stays below the query's k-th best so far, no item is looked at. The
    balls of all blocks are asked for their bounds first, and a query begins with the one that
    promises most: its k-th best is then nearly the last one before any other ball is looked at.
    Products that may reach it are taken once more in double precision or, if asked, added up one by
    one in single precision, as Spark ML does for its models."""
    import numpy as np

    def product_of(a, b):
        if not single:
            return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64))
        total = np.zeros(len(a), np.float32)
        for j in range(a.shape[1]):
            total += a[:, j].astype(np.float32) * b[:, j].astype(np.float32)
        return total.astype(np.float64)

    best, wide, narrow = _BestOf(len(queries), k), queries.astype(np.float64), queries.astype(kind)
    length = np.sqrt((wide ** 2).sum(axis=1))
    error = (wide.shape[1] + 2) * 2 * float(np.finfo(np.float32 if single else kind).eps)
    slices = [slice(a, a + QUERY_ROWS) for a in range(0, len(queries), QUERY_ROWS)]

    def balls_of(block):
        radii = np.frombuffer(block["radii"])
        centres = np.frombuffer(block["centres"]).reshape(len(radii), -1)
        return centres, radii, np.sqrt((centres ** 2).sum(axis=1)) + radii      # no item of a ball is longer

    def bounds(rows, centres, radii, reach):
        return wide[rows] @ centres.T + length[rows, None] * (radii + error * reach)

    most, nearest, before = np.full(len(queries), -np.inf), np.zeros(len(queries), np.int64), 0
    for block in _ball_rows(folder, ["centres", "radii"]):
        balls = balls_of(block)
        for rows in slices:
            bound = bounds(rows, *balls)
            ball = bound.argmax(axis=1)
            bound = bound[np.arange(len(ball)), ball]
            more = bound > most[rows]
            most[rows], nearest[rows] = np.where(more, bound, most[rows]), np.where(more, before + ball, nearest[rows])
        before += len(balls[1])

    def meet(rows, part, ids, reach):
        slack = error * length[rows] * reach
        product, least = narrow[rows] @ part.T, best.least[rows] - slack
        many = np.flatnonzero((product >= least[:, None]).sum(axis=1) > k)
        if len(many):                                            # not below the k-th best of the ball either
            least[many] = np.partition(product[many], len(part) - k, axis=1)[:, len(part) - k] - 2 * slack[many]
        r, c = np.nonzero(product >= least[:, None])
        if len(r):
            exact = product_of(queries[rows[r]], part[c])
            enough = exact >= best.least[rows[r]]
            if enough.any():
                best.add(rows[r[enough]], ids[c[enough]], exact[enough])

    def meet_all(block, reach, row, ball, bound):
        """Queries and balls, ball by ball, where the bound still reaches the k-th best."""
        ids, ends = np.frombuffer(block["ids"], np.int32), np.cumsum(np.frombuffer(block["sizes"], np.int32))
        factors = np.frombuffer(block["factors"], kind).reshape(len(ids), -1)
        order = np.argsort(ball, kind="stable")
        row, ball, bound = row[order], ball[order], bound[order]
        cuts = np.append(np.flatnonzero(np.append(True, ball[1:] != ball[:-1])), len(ball))
        for a, b in zip(cuts[:-1], cuts[1:]):
            x = ball[a]
            begin, end = int(ends[x - 1]) if x else 0, int(ends[x])
            for at in range(a, b, MEET_ROWS):
                rows = row[at:min(at + MEET_ROWS, b)]
                rows = rows[bound[at:min(at + MEET_ROWS, b)] >= best.least[rows]]
                if len(rows):
                    meet(rows, factors[begin:end], ids[begin:end], reach[x])

    by_ball, before = np.argsort(nearest, kind="stable"), 0
    ascending = nearest[by_ball]
    for block in _ball_rows(folder):                             # first the ball that promises most
        reach = balls_of(block)[2]
        a, b = np.searchsorted(ascending, [before, before + len(reach)])
        if b > a:
            meet_all(block, reach, by_ball[a:b], ascending[a:b] - before, most[by_ball[a:b]])
        before += len(reach)
    before = 0
    for block in _ball_rows(folder):                             # then all others that can reach the list
        balls, held = balls_of(block), []
        for at, rows in enumerate(slices):
            bound = bounds(rows, *balls)
            row, ball = np.nonzero(bound >= best.least[rows, None])
            other = nearest[rows][row] != before + ball
            row, ball = row[other], ball[other]
            held.append((row + rows.start, ball, bound[row, ball]))
            if held and (at + 1 == len(slices) or sum(len(x[0]) for x in held) > MET):
                together = [np.concatenate(x) for x in zip(*held)]
                if len(together[0]):
                    meet_all(block, balls[2], *together)
                held = []
        before += len(balls[1])
    return best


def block_top(users: DataFrame, items: DataFrame, k: int, user_block: int = 65536, item_block: int = 65536, single: bool = False) -> DataFrame:
    """(u, rank, i, score): for each user the ``k`` items of the largest product; equal ones go to the
    smaller id. Exact, but not all products are taken: the items of a block lie in balls of like
    ones, and most balls can't reach a user's list (:func:`_search`). The blocks of items are written
    to the shared folder, where every block of users reads them one by one, holding one block of each
    and ``k`` items for each user, so neither products nor lists of single blocks are shuffled."""
    import numpy as np
    import pyarrow as pa

    kind = np.float32 if items.schema["features"].dataType.elementType == T.FloatType() else np.float64
    folder = f"{ensure_checkpoint_dir(users.sparkSession).rstrip('/')}/balls-{uuid.uuid4().hex}"
    items.select("id", "features", F.expr(f"id div {item_block}").alias("block")).groupBy("block") \
        .applyInArrow(_ball_blocks(BALL, kind), "ids binary, factors binary, sizes binary, centres binary, radii binary") \
        .write.parquet(folder)
    asked = cut_lineage(users.select("id", "features"))
    n = asked.count()
    # few requests still occupy all cores
    tasks = max(1, -(-n // user_block), min(users.sparkSession.sparkContext.defaultParallelism, n // QUERY_ROWS))

    def search(batches):
        def out(ids, held):
            queries = np.concatenate(held)
            best = _search(queries, folder, kind, k, single)
            ids = np.concatenate(ids).astype(np.int32)
            for at in range(0, len(ids), QUERY_ROWS):
                row, place = np.nonzero(best.scores[at:at + QUERY_ROWS] > -np.inf)
                row += at
                yield from pa.table([pa.array(ids[row]), pa.array((place + 1).astype(np.int32)),
                                     pa.array(best.ids[row, place]), pa.array(best.scores[row, place])], names=["u", "rank", "i", "score"]).to_batches()

        ids, held = [], []
        for b in batches:
            for at in range(0, b.num_rows, user_block):
                part = b.slice(at, user_block)
                if held and sum(map(len, held)) + part.num_rows > 2 * user_block:
                    yield from out(ids, held)
                    ids, held = [], []
                ids.append(part.column(0).to_numpy())
                held.append(_matrix(part.column(1), part.num_rows, kind))
        if held:
            yield from out(ids, held)

    return asked.repartition(tasks, "id").mapInArrow(search, "u int, rank int, i int, score double")


def recommend_probabilities(model, uid: DataFrame, iid: DataFrame, users: DataFrame, k: int = DEFAULT_K,
                            user: str = USER, item: str = ITEM) -> DataFrame:
    """REC5 with REC4. Top-k items for the requested users, with probabilities over the whole
    catalogue -> ``(user, rank, item, score)``; users the model does not know yield no rows."""
    req = users.select(user).distinct().join(uid, user).select(F.col("__u").alias("id"))
    e = block_softmax(model.userFactors.join(req, "id", "left_semi"), model.itemFactors, k)
    return e.join(uid, F.col("u") == F.col("__u")).join(iid, F.col("i") == F.col("__i")).select(user, "rank", item, "score")


# ---- evaluation -------------------------------------------------------------------------------

def evaluate_split(interactions: DataFrame, test_fraction: float = 0.1, input_fraction: float = 0.9,
                   seed: int = 0, user: str = USER, item: str = ITEM, ts: str = TSC) -> dict[str, DataFrame]:
    """REC11. ``test_fraction`` of users (md5 bucket) are held out; for each of them the oldest
    ``input_fraction`` of events is model input and the newest rest is the truth. Positions
    inside a user come from the skew-safe ``rank_within_group``."""
    held = F.substring(stable_hash(user, seed), 1, 8) < F.lit(fraction_threshold(test_fraction))
    train = interactions.filter(~held)
    test = rank_within_group(interactions.filter(held), user, [ts, item])
    cut = F.col("__rank") <= F.floor(F.col("__size") * input_fraction)
    return {"train": train,
            "test_input": test.filter(cut).drop("__rank", "__size"),
            "test_truth": test.filter(~cut).drop("__rank", "__size")}


def segmentation_split(interactions: DataFrame, train_fraction: float = 0.8, seed: int = 0, user: str = USER,
                       item: str = ITEM, ts: str = TSC) -> dict[str, DataFrame]:
    """REC11 for segmentation (REC6): the oldest ``train_fraction`` of each user's events train,
    the newest rest are the truth."""
    ranked = rank_within_group(interactions, user, [ts, item])
    cut = F.col("__rank") <= F.floor(F.col("__size") * train_fraction)
    return {"train": ranked.filter(cut).drop("__rank", "__size"), "truth": ranked.filter(~cut).drop("__rank", "__size")}


def ranking_metrics(recs: DataFrame, truth: DataFrame, ks=(5, 10, 25), user: str = USER,
                    item: str = ITEM) -> DataFrame:
    """REC13-REC15. MRR@max(k), NDCG@k (weight 1/log(1+position)) and precision@k, averaged
    over the users that have truth; users without recommendations score 0."""
    kmax = max(ks)
    t = truth.select(user, item).distinct()
    tcount = t.groupBy(user).agg(F.count(F.lit(1)).alias("__nt"))
    hits = recs.filter(F.col("rank") <= kmax).join(t, [user, item], "inner").select(user, "rank")
    per = hits.groupBy(user).agg(
        F.min("rank").alias("__first"),
        *[F.sum(F.when(F.col("rank") <= k, 1.0 / F.log(1.0 + F.col("rank")))).alias(f"__dcg{k}") for k in ks],
        *[F.count_if(F.col("rank") <= k).alias(f"__h{k}") for k in ks])
    u = tcount.join(per, user, "left")

    def idcg(k):
        m = F.least(F.col("__nt"), F.lit(k))
        return F.aggregate(F.sequence(F.lit(1), m.cast("int")), F.lit(0.0), lambda acc, i: acc + 1.0 / F.log(1.0 + i))

    cols = [F.avg(F.coalesce(1.0 / F.col("__first"), F.lit(0.0))).alias(f"mrr_at_{kmax}")]
    for k in ks:
        cols.append(F.avg(F.coalesce(F.col(f"__dcg{k}"), F.lit(0.0)) / idcg(k)).alias(f"ndcg_at_{k}"))
        cols.append(F.avg(F.coalesce(F.col(f"__h{k}"), F.lit(0)) / float(k)).alias(f"precision_at_{k}"))
    return u.agg(*cols)


def coverage(recs: DataFrame, interactions: DataFrame, items: DataFrame | None = None,
             item: str = ITEM) -> DataFrame:
    """REC12. Distinct recommended items / distinct items in interactions (and items)."""
    cat = interactions.select(item)
    if items is not None:
        cat = cat.unionByName(items.select(item))
    a = recs.agg(F.count_distinct(item).alias("__r"))
    b = cat.agg(F.count_distinct(item).alias("__c"))
    return _ratio(a, b)


def _ratio(a: DataFrame, b: DataFrame) -> DataFrame:
    # both sides are single-row aggregates: combine them by union + aggregate (no join)
    u = a.select(F.col("__r").alias("__r"), F.lit(None).cast("bigint").alias("__c")).unionByName(
        b.select(F.lit(None).cast("bigint").alias("__r"), F.col("__c")))
    return u.agg((F.max("__r") / F.max("__c")).alias("coverage"))


# ---- results ------------------------------------------------------------------------------------

def to_result_records(recs: DataFrame, requests: DataFrame, user: str = USER, item: str = ITEM,
                      req_user: str = "userId") -> DataFrame:
    """REC16. One ``{input, output, error}`` record per request; scores descending; requests
    the model cannot serve get an error text and no output."""
    g = recs.groupBy(user).agg(F.array_sort(F.collect_list(F.struct("rank", item, "score"))).alias("__l"))
    req = requests.select(F.col(req_user).alias("__req")).distinct()
    j = req.join(g, F.col("__req") == F.col(user).cast("string"), "left")
    out = F.struct(F.transform("__l", lambda s: s[item].cast("string")).alias("recommendedItems"),
                   F.transform("__l", lambda s: s["score"]).alias("scores"))
    return j.select(
        F.struct(F.col("__req").alias("userId")).alias("input"),
        F.when(F.col("__l").isNotNull(), out).alias("output"),
        F.when(F.col("__l").isNull(), F.concat(F.lit("Unknown user: "), F.col("__req"))).alias("error"))


def transform_results(results: DataFrame, metadata: DataFrame, item_key: str = "movieId") -> DataFrame:
    """REC17. Successful records -> ``(userId long, Recommendations 'Title (FirstGenre) | ...')``.
    Unknown items keep their slot as ``null`` title (Q12, not a failure); userId is a long (Q13)."""
    from ..functions.scalar import title_with_first_genre

    ok = results.filter(F.col("error").isNull()).select(
        F.col("input.userId").cast("bigint").alias("userId"), F.col("output.recommendedItems").alias("__items"))
    e = enrich_ranked_list(ok, "userId", "__items", metadata, item_key,
                           title_with_first_genre(F.col("title"), F.col("genres")), out="__titles")
    return e.select("userId", F.array_join(F.col("__titles"), " | ").alias("Recommendations"),
                    F.size(F.filter("__titles", lambda x: x.isNull())).alias("unknown_items"))
