"""Registered queries: ML (logistic regression) and embeddings / vector search."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lakeloom.operators import clusters, ml
from lakeloom.operators import metric_join as mj
from lakeloom.operators import text_embedding as te
from lakeloom.operators import vector as vx
from lakeloom.operators import vector_index as vi
from lakeloom.plans.catalog_io import CUSTOMER_DAY_SQL, customer_day_from_events
from lakeloom.plans.registry import query
from lakeloom.plans.tables import Tables
from lakeloom.session import cut_lineage, shared_dir, stored

NUMERIC = ["earlier_total_events", "earlier_total_spent"]
CATEGORICAL = ["nation", "segment"]
CUT = "2024-01-20"
REG_PARAM = 0.01  # a separable fit without it has no stable answer
SMOOTHING = 20.0

#: Customer-days with what was known the evening before, the customer's nation and segment, and the label.
FEATURES_SQL = f"""
SELECT g.customer_id, g.event_date,
       round(ln(1 + coalesce(sum(CAST(g.total_events AS DOUBLE)) OVER b, 0)), 6) AS earlier_total_events,
       round(ln(1 + coalesce(sum(g.total_spent) OVER b, 0)), 6) AS earlier_total_spent,
       n.n_name AS nation, c.c_mktsegment AS segment, CAST(g.total_purchases > 1 AS DOUBLE) AS label
FROM ({CUSTOMER_DAY_SQL}) g JOIN customer c ON g.customer_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WINDOW b AS (PARTITION BY g.customer_id ORDER BY g.event_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _gold_features(spark, sf):
    t = Tables(spark, sf)
    gold = ml.earlier_days(customer_day_from_events(t.events), "customer_id", "event_date", ["total_events", "total_spent"])
    who = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return ml.features(gold.join(who, "customer_id"), NUMERIC, F.col("total_purchases") > 1,
                       keep=["customer_id", "event_date", *CATEGORICAL])


@query("features_label", oracle=FEATURES_SQL)
def q_features_label(spark, sf):
    return _gold_features(spark, sf)


@query("split_by_time", oracle=f"""
SELECT customer_id, event_date, CASE WHEN event_date < DATE '{CUT}' THEN 'train' ELSE 'test' END AS split
FROM ({FEATURES_SQL})""")
def q_split_by_time(spark, sf):
    train, test = ml.split_time(_gold_features(spark, sf), "event_date", CUT)
    return (train.select("customer_id", "event_date", F.lit("train").alias("split"))
            .unionByName(test.select("customer_id", "event_date", F.lit("test").alias("split"))))


#: What a session's queries share: one fitted model and one index for each folder of tables.
_STORED: dict[tuple[str, str, str], str] = {}


def _once(spark, sf, name, make):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        _STORED[key] = make()
    return _STORED[key]


def _fit(spark, sf):
    train, _ = ml.split_time(_gold_features(spark, sf), "event_date", CUT)
    train = cut_lineage(train)
    share = train.agg(F.avg("label")).first()[0]  # a day counts as predicted when it is likelier than the average day
    path = shared_dir(spark, "model")
    ml.train(train, NUMERIC, CATEGORICAL, reg_param=REG_PARAM, max_iter=500, path=path, encoder="target", smoothing=SMOOTHING,
             threshold=share, tol=1e-13)
    return path


def _model(spark, sf):
    """The model, fitted and stored by the first query that asks, loaded by all."""
    return ml.load(_once(spark, sf, "return-model", lambda: _fit(spark, sf)))


def _fit_sql(steps=600):
    """The same fit in SQL: standardised features, one Newton step a coordinate and round until nothing moves."""
    z = ["z1", "z2", "z3", "z4"]
    margin = "b + v1 * z1 + v2 * z2 + v3 * z3 + v4 * z4"
    moves = ", ".join(f"CASE WHEN step % 5 = {i} THEN v{i} - g{i} / h{i} ELSE v{i} END" for i in range(1, 5))
    sums = ", ".join(f"avg((p - label) * z{i}) + {REG_PARAM} * v{i} AS g{i}, avg(p * (1 - p) * z{i} * z{i}) + {REG_PARAM} AS h{i}" for i in range(1, 5))
    rate = lambda c: (f"{c}s AS (SELECT {c}, count(*) / (count(*) + {SMOOTHING}) * avg(label) + {SMOOTHING} / (count(*) + {SMOOTHING}) "  # noqa: E731
                      f"* any_value(share) AS rate FROM train, base GROUP BY {c})")
    x = ["earlier_total_events", "earlier_total_spent", "n.rate", "s.rate"]
    return f"""
WITH RECURSIVE feats AS MATERIALIZED ({FEATURES_SQL}),
train AS (SELECT * FROM feats WHERE event_date < DATE '{CUT}'), base AS (SELECT avg(label) AS share FROM train),
{rate("nation")}, {rate("segment")},
x AS MATERIALIZED (
    SELECT f.*, {x[0]} AS x1, {x[1]} AS x2, coalesce({x[2]}, share) AS x3, coalesce({x[3]}, share) AS x4
    FROM feats f LEFT JOIN nations n ON f.nation = n.nation LEFT JOIN segments s ON f.segment = s.segment, base),
m AS MATERIALIZED (SELECT {", ".join(f"avg(x{i}) AS m{i}, stddev_samp(x{i}) AS s{i}" for i in range(1, 5))} FROM x WHERE event_date < DATE '{CUT}'),
zs AS MATERIALIZED (SELECT x.*, {", ".join(f"(x{i} - m{i}) / s{i} AS z{i}" for i in range(1, 5))} FROM x, m),
zt AS MATERIALIZED (SELECT label, {", ".join(z)} FROM zs WHERE event_date < DATE '{CUT}'),
fit(step, b, v1, v2, v3, v4) AS (
    SELECT 0, CAST(ln(share / (1 - share)) AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM base
    UNION ALL
    SELECT step + 1, CASE WHEN step % 5 = 0 THEN b - g0 / h0 ELSE b END, {moves}
    FROM (SELECT step, b, v1, v2, v3, v4, avg(p - label) AS g0, avg(p * (1 - p)) AS h0, {sums}
          FROM (SELECT fit.*, zt.*, 1 / (1 + exp(-({margin}))) AS p FROM fit, zt)
          GROUP BY step, b, v1, v2, v3, v4)
    WHERE step < {steps}),
w AS MATERIALIZED (SELECT * FROM fit WHERE step = {steps}),
scored AS MATERIALIZED (
    SELECT zs.*, 1 / (1 + exp(-({margin}))) AS p, CAST(1 / (1 + exp(-({margin}))) > share AS DOUBLE) AS predicted FROM zs, w, base)
"""


FIT_SQL = _fit_sql()


@query("train_logreg", oracle=f"""{FIT_SQL}
SELECT unnest(['earlier_total_events', 'earlier_total_spent', 'nation', 'segment', 'intercept']) AS feature,
       unnest([round(v1 / s1, 4), round(v2 / s2, 4), round(v3 / s3, 4), round(v4 / s4, 4),
               round(b - v1 * m1 / s1 - v2 * m2 / s2 - v3 * m3 / s3 - v4 * m4 / s4, 4)]) AS coefficient
FROM w, m""")
def q_train_logreg(spark, sf):
    model = _model(spark, sf)
    return ml.coefficients(model, NUMERIC + CATEGORICAL).select("feature", F.round("coefficient", 4).alias("coefficient"))


@query("eval_logreg", oracle=f"""{FIT_SQL},
t AS (SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS place FROM scored WHERE event_date >= DATE '{CUT}'),
c AS (SELECT count(*) FILTER (predicted = 1 AND label = 1) AS tp, count(*) FILTER (predicted = 1 AND label = 0) AS fp,
             count(*) FILTER (predicted = 0 AND label = 0) AS tn, count(*) FILTER (predicted = 0 AND label = 1) AS fn,
             avg(-(label * ln(p) + (1 - label) * ln(1 - p))) AS log_loss,
             (sum(place) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
                 / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc FROM t)
SELECT round(tp / (tp + fp), 5) AS precision, round(tp / (tp + fn), 5) AS recall, round((tp + tn) / (tp + tn + fp + fn), 5) AS accuracy,
       round(2 * tp / (2 * tp + fp + fn), 5) AS f1_score, round(log_loss, 5) AS log_loss, round(auc, 5) AS roc_auc FROM c""")
def q_eval_logreg(spark, sf):
    _, test = ml.split_time(_gold_features(spark, sf), "event_date", CUT)
    x = ml.evaluate(_model(spark, sf), test, bins=0)
    return x.select(*[F.round(c, 5).alias(c) for c in x.columns])


@query("predict_logreg", oracle=f"""{FIT_SQL}
SELECT customer_id, event_date, nation, segment, label, predicted AS will_return, round(p, 3) AS probability FROM scored""")
def q_predict_logreg(spark, sf):
    out = ml.predict(_model(spark, sf), _gold_features(spark, sf), "will_return")
    return out.select("customer_id", "event_date", "nation", "segment", "label", "will_return", F.round("probability", 3).alias("probability"))


@query("predict_agg", oracle=f"""{FIT_SQL}
SELECT customer_id, sum(predicted) AS total_predicted FROM scored GROUP BY customer_id ORDER BY total_predicted DESC, customer_id LIMIT 10""")
def q_predict_agg(spark, sf):
    return ml.predicted_by(ml.predict(_model(spark, sf), _gold_features(spark, sf)), "customer_id", 10)


@query("agg_predicted_by_key", oracle=f"""{FIT_SQL}
SELECT nation, sum(predicted) AS total_predicted FROM scored GROUP BY nation ORDER BY total_predicted DESC, nation LIMIT 10""")
def q_agg_predicted_by_key(spark, sf):
    return ml.predicted_by(ml.predict(_model(spark, sf), _gold_features(spark, sf)), "nation", 10)


# --- vectors -----------------------------------------------------------------------------------------

CENTROIDS_SQL = """
(SELECT label AS query_id, list(x ORDER BY pos) AS q FROM (
   SELECT label, pos, AVG(CAST(v AS DOUBLE)) AS x FROM (
     SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY label, pos)
 GROUP BY label)"""
EXACT_SQL = f"""
SELECT query_id, vec_id, rank FROM (
  SELECT c.query_id, e.vec_id,
         ROW_NUMBER() OVER (PARTITION BY c.query_id
                            ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.q) DESC, e.vec_id) AS rank
  FROM embeddings e, {CENTROIDS_SQL} c)
WHERE rank <= 5"""


def _exact(spark, sf):
    e = Tables(spark, sf).embeddings
    return vx.vector_search(e, vx.label_centroids(e), 5)


@query("vector_search", oracle=EXACT_SQL)
def q_vector_search(spark, sf):
    return _exact(spark, sf).select("query_id", "vec_id", "rank")


@query("join_knn", oracle=EXACT_SQL)
def q_join_knn(spark, sf):
    """Same search through the blocked (non-broadcast) path: queries × base blocks."""
    e = Tables(spark, sf).embeddings
    q = vx.label_centroids(e).select("query_id", F.col("embedding").alias("vec"), F.lit(0).alias("list_id"))
    b = e.select("vec_id", F.col("embedding").alias("vec"), F.lit(0).alias("list_id"))
    return vx.blocked_search(q, b, 5).select("query_id", "vec_id", "rank")


@query("topk_vector", oracle=EXACT_SQL)
def q_topk_vector(spark, sf):
    return _exact(spark, sf).select("query_id", "vec_id", "rank")


def _num_lists(n: int) -> int:
    # the sample index used 500 lists for 200,000 rows: about 400 rows a list, and some lists to choose from at any size
    return max(16, math.ceil(n / 400))


def _bases(embeddings):
    """The table as it was when the index was built and at its first refresh: later loads (labels) not there yet, at first with
    the rows of label 1 still unmended and those of label 0 there twice."""
    first = embeddings.where("label < 7").withColumn("embedding", F.when(F.col("label") == 1, F.reverse("embedding")).otherwise(F.col("embedding")))
    twice = embeddings.where("label = 0").withColumn("vec_id", -1 - F.col("vec_id"))
    return first.unionByName(twice), embeddings.where("label < 9")


def _index(spark, sf):
    """One index for all queries: built once, refreshed twice without a new fit, the last time over the whole table."""
    e = Tables(spark, sf).embeddings

    def make():
        built, later = _bases(e)
        path = vi.build_index(built, shared_dir(spark, "index"), _num_lists(built.count()), "2024-01-01 06:00:00")
        vi.refresh_index(later, path, "2024-01-02 06:00:00")
        vi.refresh_index(e, path, "2024-01-03 06:00:00")
        return path

    return e, _once(spark, sf, "index", make)


@query("vector_index_ivf", oracle="""
WITH n AS (SELECT count(*) FILTER (label < 7) AS a, count(*) FILTER (label = 0) AS zero, count(*) FILTER (label = 1) AS one,
                  count(*) FILTER (label IN (7, 8)) AS more, count(*) FILTER (label = 9) AS last, count(*) AS every FROM embeddings)
SELECT 0 AS refresh, TIMESTAMP '2024-01-01 06:00:00' AS refreshed_at, a + zero AS base_rows, a + zero AS added, 0 AS removed, a + zero AS in_lists FROM n
UNION ALL SELECT 1, TIMESTAMP '2024-01-02 06:00:00', a + more, one + more, one + zero, one + more FROM n
UNION ALL SELECT 2, TIMESTAMP '2024-01-03 06:00:00', every, last, 0, last FROM n""")
def q_vector_index_ivf(spark, sf):
    """The index's history, each refresh with the rows that its lists hold."""
    _, path = _index(spark, sf)
    lists = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    held = lists.groupBy("refresh").agg(F.count(F.lit(1)).alias("in_lists"))
    made = vi.manifest(spark, path).withColumn("refreshed_at", F.col("refreshed_at").cast("timestamp_ntz"))
    return made.join(held, "refresh").select("refresh", "refreshed_at", "base_rows", "added", "removed", "in_lists")


@query("vector_search_ivf", oracle="""
SELECT query_id, vec_id, rank FROM (
  SELECT q.vec_id AS query_id, e.vec_id,
         ROW_NUMBER() OVER (PARTITION BY q.vec_id
                            ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) DESC, e.vec_id) AS rank
  FROM embeddings q, embeddings e)
WHERE rank <= 5""")
def q_vector_search_ivf(spark, sf):
    """Every embedding's five nearest by the index: lists that the angle bound rules out aren't read, and the result is exact."""
    e, path = _index(spark, sf)
    return vi.search(spark, path, e, 5, query_id="vec_id").hits.select("query_id", "vec_id", "rank")


@query("vector_index_status", oracle="""
WITH n AS (SELECT count(*) AS every, count(*) FILTER (label < 7 AND label <> 1) AS first, count(*) FILTER (label < 9) AS second,
                  count(*) FILTER (label IN (0, 1)) AS stale FROM embeddings),
s AS (SELECT 0 AS refreshes, TIMESTAMP '2024-01-01 06:00:00' AS last_refresh_time, every AS base_rows, first AS indexed_rows, stale AS stale_rows FROM n
      UNION ALL SELECT 1, TIMESTAMP '2024-01-02 06:00:00', every, second, 0 FROM n
      UNION ALL SELECT 2, TIMESTAMP '2024-01-03 06:00:00', every, every, 0 FROM n)
SELECT refreshes, last_refresh_time, base_rows, indexed_rows, base_rows - indexed_rows AS pending_rows, stale_rows,
       indexed_rows * 100.0::DOUBLE / base_rows AS coverage_percentage, 'READY' AS index_status FROM s""")
def q_vector_index_status(spark, sf):
    """How far each version of the index is behind the whole table."""
    e, path = _index(spark, sf)
    parts = [vi.status(e, path, upto) for upto in range(3)]
    x = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return x.withColumn("last_refresh_time", F.col("last_refresh_time").cast("timestamp_ntz"))


SEMANTIC_SQL = """
SELECT a.vec_id AS id_a, b.vec_id AS id_b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.35"""


@query("join_semantic", oracle=SEMANTIC_SQL)
def q_join_semantic(spark, sf):
    e = Tables(spark, sf).embeddings
    return mj.similar_pairs(e, "vec_id", "embedding", max_dist=0.65).select("id_a", "id_b")


@query("join_semantic_examined")
def q_join_semantic_examined(spark, sf):
    """The pairs that the similarity join compared, as a share of all pairs, at three distances."""
    e = Tables(spark, sf).embeddings
    out = [mj.examined(mj.dealt_cells(e, "vec_id", "embedding", d)).withColumn("max_dist", F.lit(d)) for d in (0.05, 0.2, 0.65)]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("dedupe_semantic", oracle=r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS shingle
    FROM (SELECT *, unnest(range(greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2)
    JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE shared >= 0.8 * (na.n + nb.n - shared)),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS id, doc_id AS seen FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a)
SELECT id AS doc_id, min(seen) AS cluster FROM r GROUP BY id""")
def q_dedupe_semantic(spark, sf):
    """Every document with the least id of its near-duplicate cluster, for review."""
    found = clusters.near_duplicate_clusters(Tables(spark, sf).documents, "doc_id", "text", 0.8,
                                             partitions=spark.sparkContext.defaultParallelism)
    return found.select(F.col("id").alias("doc_id"), "cluster")


EMBEDDING_WORDS = 512


@query("embed_text", oracle=rf"""
WITH w AS (SELECT doc_id AS id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), '\W+'), lambda x: x <> '')) AS w FROM documents),
q AS (SELECT item_id AS id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), '\W+'), lambda x: x <> '')) AS w FROM benchmark),
v AS (SELECT w, ln(((SELECT count(*) FROM documents) + 1.0) / (count(DISTINCT id) + 1.0)) AS idf FROM w GROUP BY w
      ORDER BY count(DISTINCT id) DESC, w LIMIT {EMBEDDING_WORDS}),
dx AS (SELECT id, w, count(*) * any_value(idf) AS x FROM w JOIN v USING (w) GROUP BY id, w HAVING any_value(idf) <> 0),
qx AS (SELECT id, w, count(*) * any_value(idf) AS x FROM q JOIN v USING (w) GROUP BY id, w HAVING any_value(idf) <> 0),
dn AS (SELECT id, sqrt(sum(x * x)) AS n FROM dx GROUP BY id),
qn AS (SELECT id, sqrt(sum(x * x)) AS n FROM qx GROUP BY id),
s AS (SELECT qx.id AS query_id, dx.id, round(sum(qx.x * dx.x) / (any_value(qn.n) * any_value(dn.n)), 9) AS score
      FROM qx JOIN dx USING (w) JOIN qn ON qn.id = qx.id JOIN dn ON dn.id = dx.id GROUP BY qx.id, dx.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
SELECT query_id, id, text AS content, rank FROM r JOIN documents ON doc_id = id WHERE rank <= 5""")
def q_embed_text(spark, sf):
    """Text to neighbours: benchmark questions embedded by the stored model, and the five documents nearest to each."""
    t = Tables(spark, sf)

    def make():
        path = shared_dir(spark, "embedder")
        te.store(te.fit(t.documents, "text", EMBEDDING_WORDS), f"{path}/model")
        te.embed(te.load(f"{path}/model"), t.documents, "doc_id", "text").write.parquet(f"{path}/documents")
        return path

    path = _once(spark, sf, "embedder", make)
    out = te.similar_texts(te.load(f"{path}/model"), spark.read.parquet(f"{path}/documents"), t.benchmark, "item_id", "text")
    return out.select("query_id", "id", "content", "rank")


@query("vector_search_ivf_recall")
def q_vector_search_ivf_recall(spark, sf):
    """Recall@5 of the index with the number of probes tuned for 0.97 on a sample of queries, and the share of lists it reads;
    the same for the exact mode. Every embedding is a query."""
    e, path = _index(spark, sf)
    queries = e.select(F.col("vec_id").alias("query_id"), "embedding")
    # the hits are read three times: they are searched once
    once = lambda f: f._replace(hits=stored(f.hits, "hits"))
    exact = once(vi.search(spark, path, queries, 5))
    lists = vi.lists(spark, path).count()
    probes = vi.tune_probes(spark, path, queries, 5, recall=0.97)
    tuned = once(vi.search(spark, path, queries, 5, nprobe=probes))
    truth = stored(vx.vector_search(e, queries, 5, blocked=True), "truth")
    out = [vx.recall_at_k(f.hits, truth).crossJoin(vi.probed_share(f, queries, lists)).withColumn("mode", F.lit(m))
           for m, f in (("exact", exact), ("tuned", tuned))]
    return out[0].unionByName(out[1]).select("mode", F.lit(lists).alias("lists"), "recall", "lists_read")
