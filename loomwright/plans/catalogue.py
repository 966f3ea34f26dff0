"""Queries over the driver's tables, one for each operator, with SQL that gives the same rows."""

from __future__ import annotations

import uuid
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwright.functions import latex, markers, scalars
from loomwright.operators import dedup, folds, quality, relational, states
from loomwright.operators.growing import Components, MetricIndex
from loomwright.plans import stages, standins, texts
from loomwright.plans.registry import ORACLES, QUERIES, query
from loomwright.plans.standins import BITS_SQL, CODES_SQL, PAGES_SQL, POLICY_SQL, RANKED_SQL, SCORES_SQL
from loomwright.session import dealt, settled, shared_folder, table
from loomwright.sources.tables import descending_months

#: How many bits near codes may differ by.
RADIUS = dedup.PHASH_BITS


# Exact and near duplicates


@query("SELECT sha256(text) AS digest, arg_max(doc_id, (n_chars, doc_id)) AS keep_id, count(*) AS copies, max(n_chars) AS n_chars FROM documents GROUP BY 1")
def exact_dedup_argmax(spark, d):
    rows = table(spark, d, "documents").select(F.sha2("text", 256).alias("digest"), F.col("doc_id").alias("keep_id"), "n_chars")
    return dedup.best_of_group(rows, "digest", ["n_chars", "keep_id"])


@query("""SELECT format('cluster_{:06d}', row_number() OVER (ORDER BY least)) AS cluster_id, size, least, keep
FROM (SELECT count(*) AS size, min(doc_id) AS least, max(doc_id) AS keep FROM documents GROUP BY text) QUALIFY size > 1""")
def dup_cluster_report(spark, d):
    groups = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("g")).agg(F.count("*").alias("size"), F.min("doc_id").alias("least"), F.max("doc_id").alias("keep"))
    return dedup.numbered(groups, "least").filter("size > 1").select("cluster_id", "size", "least", "keep")


@query(f"WITH {BITS_SQL} SELECT vec_id, phash FROM codes")
def hash_bits(spark, d):
    return standins.bits_of_vectors(spark, d).select("vec_id", "phash")


@query(f"WITH {CODES_SQL} SELECT a.k AS left_k, b.k AS right_k, CAST(bit_count(xor(a.code, b.code)) AS INT) AS distance FROM codes a JOIN codes b ON a.k < b.k AND bit_count(xor(a.code, b.code)) <= {RADIUS}")
def hamming_band_join(spark, d):
    return dedup.hamming_pairs(standins.codes(spark, d), "k", "code", RADIUS).select("left_k", "right_k", "distance")


_REACH_SQL = f"""{CODES_SQL}, e AS (SELECT a.k AS u, b.k AS v FROM codes a JOIN codes b ON a.k <> b.k AND bit_count(xor(a.code, b.code)) <= {RADIUS}),
reach AS (SELECT u AS node, u AS other FROM e UNION SELECT reach.node, e.v FROM reach JOIN e ON e.u = reach.other)"""


@query(f"WITH {CODES_SQL} SELECT a.k AS left_k, b.k AS right_k, CAST(bit_count(xor(a.code, b.code)) AS INT) AS distance FROM codes a JOIN codes b ON a.k < b.k AND bit_count(xor(a.code, b.code)) <= {RADIUS}")
def metric_index_batches(spark, d):
    """Codes that come in five batches, each of which meets those before it through the index."""
    codes = settled(standins.codes(spark, d).select(F.col("k").alias("key"), "code"), "codes")
    index = MetricIndex(spark, f"{shared_folder(spark)}/index-{uuid.uuid4().hex}", RADIUS)
    found = [index.add(codes.filter(F.col("key") % 5 == i), i) for i in range(5)]
    return reduce(DataFrame.unionByName, found).select(F.col("left_key").alias("left_k"), F.col("right_key").alias("right_k"), "distance")


@query(f"WITH RECURSIVE {_REACH_SQL} SELECT node, min(other) AS component FROM reach GROUP BY node")
def growing_components(spark, d):
    """Links that come in five batches, each of which contracts the components so far."""
    links = settled(hamming_band_join(spark, d), "links")
    parts = Components(spark, f"{shared_folder(spark)}/components-{uuid.uuid4().hex}")
    for i in range(5):
        parts.add(links.filter((F.col("left_k") + F.col("right_k")) % 5 == i), "left_k", "right_k")
    return parts.labels()


@query(f"WITH RECURSIVE {_REACH_SQL} SELECT node, min(other) AS component FROM reach GROUP BY node")
def near_dup_components(spark, d):
    return dedup.connected(hamming_band_join(spark, d), "left_k", "right_k")


@query(f"""WITH RECURSIVE {_REACH_SQL}, part AS (SELECT k, code, coalesce(m, k) AS component FROM codes LEFT JOIN (SELECT node, min(other) AS m FROM reach GROUP BY 1) ON node = k),
o AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY k DESC) AS place FROM part),
f AS (SELECT component, 1::BIGINT AS place, [{{'k': k, 'code': code, 'c': 0::BIGINT}}] AS placed FROM o WHERE place = 1 UNION ALL
  SELECT f.component, o.place, list_append(placed, {{'k': o.k, 'code': o.code, 'c': coalesce(list_filter(range(0, 1 + list_max(list_transform(placed, lambda p: p.c))),
    lambda c: len(list_filter(placed, lambda p: p.c = c AND bit_count(xor(p.code, o.code)) > {RADIUS})) = 0)[1], 1 + list_max(list_transform(placed, lambda p: p.c)))}}) FROM f JOIN o ON o.component = f.component AND o.place = f.place + 1)
SELECT component, p.k AS k, p.c AS clique FROM (SELECT component, unnest(placed) AS p FROM f QUALIFY place = max(place) OVER (PARTITION BY component))""")
def complete_linkage(spark, d):
    pairs = hamming_band_join(spark, d).select("left_k", "right_k")
    label = dedup.connected(pairs, "left_k", "right_k")
    rows = standins.codes(spark, d).select("k").join(label.withColumnRenamed("node", "k"), "k", "left").select("k", F.coalesce("component", "k").alias("part"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(F.desc("k"))))
    return dedup.cliques(rows, pairs, "part", "k", "place").select("k", F.col("part").alias("component"), "clique")


# Keys, states, joins


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_wins_distinct(spark, d):
    return relational.first_wins(table(spark, d, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("""SELECT user_id, event_id, value FROM (SELECT *, event_type = 'purchase' AS is_new FROM events WHERE event_type IN ('signup', 'purchase'))
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY is_new DESC, event_id DESC) = 1""")
def last_wins_upsert(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "value", "event_type")
    return relational.upsert(e.filter("event_type = 'signup'"), e.filter("event_type = 'purchase'"), "user_id", "event_id").drop("event_type")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max((ts, event_id))[2] AS event_id FROM events GROUP BY user_id")
def latest_state(spark, d):
    return relational.latest(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def resume_anti_join(spark, d):
    done = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.pending(table(spark, d, "orders").select("o_orderkey", "o_custkey"), done, "o_orderkey")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def text_semi_join(spark, d):
    return relational.present(table(spark, d, "documents").select("doc_id", "n_chars"), table(spark, d, "labels").filter("quality = 1"), "doc_id")


@query("""SELECT c_custkey, coalesce(s.category, r.category, 'unknown') AS category FROM customer
LEFT JOIN (SELECT s_nationkey AS k, max(s_name) AS category FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON c_nationkey = s.k
LEFT JOIN (SELECT n_nationkey AS k, r_name AS category FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA') r ON c_nationkey = r.k""")
def lookup_fallback_left_join(spark, d):
    first = table(spark, d, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.max("s_name").alias("category"))
    region = table(spark, d, "region").filter("r_name != 'ASIA'")
    second = table(spark, d, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("category"))
    return relational.with_fallback(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "category", first, second, F.lit("unknown")).select("c_custkey", "category")


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def missing_score_anti_join(spark, d):
    return relational.missing(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("""SELECT doc_id, n_chars, quality, toxic, (quality - toxic) >= 1 AS selection_keep, CASE WHEN (quality - toxic) >= 1 THEN '' ELSE 'siglip_margin_below_threshold' END AS selection_reject_reason
FROM documents JOIN labels USING (doc_id)""")
def score_merge_join(spark, d):
    scores = table(spark, d, "labels").withColumn("at", F.col("doc_id"))
    merged = relational.merge_scores(table(spark, d, "documents").select("doc_id", "n_chars"), scores, "doc_id", "at").withColumn("model_margin", (F.col("quality") - F.col("toxic")).cast("double"))
    keep, why = quality.selection(1.0)
    return merged.select("doc_id", "n_chars", "quality", "toxic", keep.alias("selection_keep"), why.alias("selection_reject_reason"))


@query("""SELECT o_orderkey, n, coalesce(old_scale >= n, false) AS reused FROM (SELECT l_orderkey AS o_orderkey, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1)
LEFT JOIN (SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) / 50000 AS old_scale FROM orders GROUP BY 1) ON k = o_orderkey""")
def reuse_join_residual(spark, d):
    tasks = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").cast("double").alias("n"))
    old = table(spark, d, "orders").select(F.col("o_custkey").alias("o_orderkey"), (F.col("o_totalprice") / 50000).alias("scale"), F.col("o_orderkey").alias("at"))
    return relational.reuse(tasks, old, ["o_orderkey"], "at", "n").select("o_orderkey", "n", "reused")


@query("""SELECT doc_id, i AS page_number, CASE WHEN i <= len(parts) THEN parts[i] ELSE '' END AS body, CASE WHEN i <= len(parts) THEN '' ELSE 'page index ' || i || ' outside source page count ' || len(parts) END AS mapping_error
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents), (SELECT unnest([1, 2, 5]) AS i)""")
def page_explode_ordinal_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("parts"))
    pages = docs.select("doc_id", F.posexplode("parts").alias("i", "body")).select("doc_id", (F.col("i") + 1).alias("page_number"), "body")
    figures = docs.select("doc_id", F.explode(F.array(*map(F.lit, (1, 2, 5)))).alias("page_number"))
    return stages.pages_of_figures(figures, pages, ["doc_id"]).select("doc_id", "page_number", F.coalesce("body", F.lit("")).alias("body"), "mapping_error")


@query("SELECT user_id, event_type FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 2 = 0 UNION SELECT DISTINCT user_id, event_type FROM events WHERE value > 50)")
def union_manifests(spark, d):
    e = table(spark, d, "events")
    return e.filter("event_id % 2 = 0").select("user_id", "event_type").unionByName(e.filter("value > 50").select("user_id", "event_type")).distinct()


@query("""SELECT coalesce(a.k, b.k) AS o_custkey, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unexpected' ELSE 'repeated' END AS problem
FROM (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0) a FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR n > 1""")
def set_equality_audit(spark, d):
    expected = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return relational.set_audit(expected, table(spark, d, "orders").select("o_custkey"), ["o_custkey"])


@query("SELECT p_brand || '/' || p_size AS name, count(DISTINCT p_type) AS sources FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def asset_mapping_conflicts(spark, d):
    return relational.conflicts(table(spark, d, "part").select(F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("name"), "p_type"), "name", "p_type")


# Counts and states


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def status_counts(spark, d):
    return relational.status_counts(table(spark, d, "events").withColumnRenamed("event_type", "status"))


@query("SELECT c_custkey, coalesce(s, 'pending') AS status FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, arg_max(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY 1) USING (c_custkey)")
def consolidate_manifest(spark, d):
    states = relational.latest(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderstatus").alias("status")), "c_custkey", ["o_orderkey"]).drop("o_orderkey")
    return relational.consolidated(table(spark, d, "customer").select("c_custkey"), states, "c_custkey").select("c_custkey", "status")


@query("""SELECT l_orderkey, tasks, done, failed, failed = 0 AND tasks = done AND done > 0 AS complete FROM (SELECT l_orderkey, count(*) AS tasks,
CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS done, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM lineitem GROUP BY 1)""")
def completeness_bool(spark, d):
    return relational.complete(table(spark, d, "lineitem"), "l_orderkey", F.lit(1), F.col("l_linestatus") == "F", F.col("l_returnflag") == "R")


@query("""SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'failed' WHEN user_id % 7 = 1 OR user_id % 7 = 4 THEN 'failed' WHEN purchases = 0 AND errors > 0 THEN 'failed' WHEN purchases = 0 THEN 'rejected' WHEN user_id % 7 = 3 THEN 'failed' ELSE 'accepted' END AS status,
CASE WHEN user_id % 7 = 0 THEN 'missing_source_package' WHEN user_id % 7 = 1 THEN 'unpack_failed' WHEN user_id % 7 = 4 THEN 'batch_exception' WHEN purchases = 0 AND errors > 0 THEN 'drawio_recovery_failed' WHEN purchases = 0 THEN 'no_valid_drawio_recovered' WHEN user_id % 7 = 2 THEN 'existing_output' WHEN user_id % 7 = 3 THEN 'unexpected_existing_output' ELSE 'valid_drawio_recovered' END AS reason, purchases AS drawio_files FROM
(SELECT user_id, CAST(count_if(event_type = 'error' AND value > 90) AS BIGINT) AS errors, CAST(count_if(event_type = 'purchase' AND value > 80) AS BIGINT) AS purchases FROM events GROUP BY 1)""")
def recovery_status_case(spark, d):
    e, u = table(spark, d, "events"), F.col("package")
    papers = e.select(F.col("user_id").alias("package")).distinct()
    failures = e.filter("event_type = 'error' and value > 90").select(F.col("user_id").alias("package"), F.lit("x").alias("name"), F.lit(True).alias("command_failed"))
    diagrams = e.filter("event_type = 'purchase' and value > 80").select(F.col("user_id").alias("package"))
    outputs = papers.filter((u % 7).isin(2, 3)).withColumn("has_record", u % 7 == 2)
    out = stages.recovery_states(papers, diagrams, diagrams, papers.filter(u % 7 == 1), papers.filter(u % 7 == 0), failures, outputs, papers.filter(u % 7 == 4))
    return out.select(u.alias("user_id"), "status", "reason", "drawio_files")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'skipped' ELSE 'collision' END WHEN n IS NULL OR n > 5 THEN 'not_ready' WHEN o_orderkey % 11 = 1 THEN 'failed' ELSE 'imported' END AS status FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def import_status(spark, d):
    papers, k = table(spark, d, "orders").select(F.col("o_orderkey").alias("arxiv_id")), F.col("arxiv_id")
    ready = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("arxiv_id")).agg((F.count("*") <= 5).alias("ready"))
    there = papers.filter(k % 5 == 0).withColumn("valid", k % 2 == 0)
    return states.imports(papers, ready, there, papers.filter(k % 11 == 1)).withColumnRenamed("arxiv_id", "o_orderkey")


@query("""WITH p AS (SELECT doc_id, text, n_chars, lang = 'en' AS is_cs, contains(text, chr(10)) AS valid, doc_id % 3 = 0 AS is_main, length(text) - length(replace(text, 'e', '')) AS elements FROM documents)
SELECT count(*) AS all_pages, count_if(valid)::BIGINT AS valid_pages, count_if(is_cs)::BIGINT AS cs_pages, count_if(is_cs AND valid)::BIGINT AS valid_cs_pages, count_if(is_main)::BIGINT AS main_pages, count_if(elements = 0)::BIGINT AS zero_elements,
count(DISTINCT CASE WHEN is_cs AND valid THEN text END) AS unique_pages, count_if(is_cs AND valid)::BIGINT - count(DISTINCT CASE WHEN is_cs AND valid THEN text END) AS duplicates_removed FROM p""")
def count_if_stats(spark, d):
    p = table(spark, d, "documents").select(F.col("doc_id").alias("png"), F.sha2("text", 256).alias("sha256"), (F.col("lang") == "en").alias("is_cs"), F.contains("text", F.lit("\n")).alias("valid"), (F.col("doc_id") % 3 == 0).alias("is_main"), scalars.count_of(F.col("text"), "e").alias("elements"))
    return quality.run_stats(p, dedup.best_of_group(p.filter("is_cs and valid"), "sha256", ["elements", "png"]), ["elements"])


@query("""SELECT vec_id, CASE WHEN n = 0 THEN 640.0 ELSE greatest(1.0, list_max(list_transform(range(0, n), lambda i: i * 10 + greatest(w - i, 0))) + 20.0) END::DOUBLE AS width, CASE WHEN n = 0 THEN 800.0 ELSE 20.0 + 5 END::DOUBLE AS height
FROM (SELECT vec_id, vec_id % 5 AS n, vec_id % 7 - 2 AS w FROM embeddings)""")
def bbox_agg(spark, d):
    from loomwright.functions.xml_pages import page_size

    # widths fall below zero, one geometry is no number, and the size of a nested model does not count
    shapes = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.concat(F.lit('<mxGeometry y="3" x="'), (i * 10).cast("string"), F.lit('" width="'), (F.col("w") - i).cast("string"), F.lit('" height="5"/>')))
    body = F.concat(F.lit('<root pageWidth="640"><mxGraphModel pageWidth="1"/><mxGeometry x="a"/>'), F.when(F.col("n") > 0, F.array_join(shapes, "")).otherwise(""), F.lit("</root>"))
    rows = table(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 5).cast("int").alias("n"), (F.col("vec_id") % 7 - 2).cast("int").alias("w"))
    return rows.select("vec_id", page_size(body).alias("b")).select("vec_id", "b.width", "b.height")


# Pages, policy, scores, ranks


@query(f"WITH {PAGES_SQL} SELECT png, verts, edges, elements, boxes, images, texts FROM page_index")
def page_metrics(spark, d):
    return standins.pages(spark, d).select("png", "verts", "edges", "elements", "boxes", "images", "texts")


_FIELDS = ("elements", "verts", "edges", "texts", "pixels", "aspect", "ink_ratio", "gray_std")


@query(f"WITH {PAGES_SQL} " + " UNION ALL ".join(f"SELECT '{f}' AS field, p AS point, round(v, 6) AS value FROM (SELECT unnest({list(quality.POINTS)}) AS p, unnest(quantile_cont({f}::DOUBLE, {[p / 100 for p in quality.POINTS]})) AS v FROM page_index)" for f in _FIELDS))
def quantile_profile(spark, d):
    return quality.quantile_profile(standins.pages(spark, d), _FIELDS)


@query(f"WITH {PAGES_SQL}, {POLICY_SQL} SELECT * FROM policy")
def policy_derive(spark, d):
    return quality.derived_policy(standins.pages(spark, d))


FROZEN = quality.Policy(20, 12, 9, 400_000, 40, 3.5, min_elements=8)


_FROZEN_SQL = "policy AS (SELECT " + ", ".join(f"{v}::DOUBLE AS {k}" for k, v in asdict(FROZEN).items()) + ")"


@query(f"WITH {PAGES_SQL}, {_FROZEN_SQL}, {SCORES_SQL} SELECT png, reasons, round(structure_score, 6) AS structure_score FROM scores")
def policy_override(spark, d):
    """Pages by a recorded policy in place of the derived one."""
    pages = standins.pages(spark, d)
    scores = quality.scored(pages, quality.recorded_or(FROZEN, pages))
    return scores.select("png", F.array_join("structural_reject_reasons", ",").alias("reasons"), F.round("structure_score", 6).alias("structure_score"))


def _scores(spark, d):
    pages = standins.pages(spark, d)
    return quality.scored(pages, quality.derived_policy(pages))


@query(f"WITH {PAGES_SQL}, {POLICY_SQL}, {SCORES_SQL} SELECT png, reasons FROM scores")
def hard_rules_reasons(spark, d):
    return _scores(spark, d).select("png", F.array_join("structural_reject_reasons", ",").alias("reasons"))


@query(f"WITH {PAGES_SQL}, {POLICY_SQL}, {SCORES_SQL} SELECT png, round(structure_score, 6) AS structure_score, edge_vertex_ratio FROM scores")
def structure_score(spark, d):
    return _scores(spark, d).select("png", F.round("structure_score", 6).alias("structure_score"), "edge_vertex_ratio")


@query(f"WITH {PAGES_SQL}, {POLICY_SQL}, {SCORES_SQL}, {RANKED_SQL} SELECT png, coarse_rank, structure_percentile FROM chosen")
def coarse_topk_fraction(spark, d):
    return quality.coarse_selection(_scores(spark, d), 0.6)[0].select("png", F.col("coarse_rank").cast("long").alias("coarse_rank"), "structure_percentile")


@query(f"""WITH {PAGES_SQL}, {POLICY_SQL}, {SCORES_SQL}, {RANKED_SQL} SELECT png, CASE WHEN reasons <> '' THEN reasons ELSE 'below_structure_cutoff' END AS reasons FROM scores WHERE png NOT IN (SELECT png FROM chosen)""")
def coarse_rejects(spark, d):
    return quality.coarse_selection(_scores(spark, d), 0.6)[1].select("png", F.array_join("structural_reject_reasons", ",").alias("reasons"))


@query(f"WITH {PAGES_SQL}, {POLICY_SQL}, {SCORES_SQL}, {RANKED_SQL} SELECT png, row_number() OVER (ORDER BY structure_score DESC, elements DESC, texts DESC, png DESC) AS final_rank FROM chosen QUALIFY final_rank <= 50")
def final_rank_structure(spark, d):
    return quality.final_rank(quality.coarse_selection(_scores(spark, d), 0.6)[0], "structure", 50).select("png", F.col("final_rank").cast("long").alias("final_rank"))


@query(f"""WITH {PAGES_SQL}, {POLICY_SQL}, {SCORES_SQL}, {RANKED_SQL} SELECT png, row_number() OVER (ORDER BY m DESC NULLS LAST, structure_score DESC, elements DESC, png DESC) AS final_rank
FROM (SELECT *, CASE WHEN png_bytes % 5 = 0 THEN NULL ELSE (png_bytes % 17) / 4.0 END AS m FROM chosen)""")
def final_rank_margin(spark, d):
    chosen = quality.coarse_selection(_scores(spark, d), 0.6)[0].withColumn("model_margin", F.when(F.col("png_bytes") % 5 != 0, (F.col("png_bytes") % 17) / 4.0))
    return quality.final_rank(chosen, "model").select("png", F.col("final_rank").cast("long").alias("final_rank"))


@query(f"""WITH {PAGES_SQL}, {POLICY_SQL}, {SCORES_SQL}, {RANKED_SQL}, f AS (SELECT *, row_number() OVER (ORDER BY structure_score DESC, elements DESC, texts DESC, png DESC) AS r FROM chosen)
SELECT arxiv_id, string_agg(png, ',' ORDER BY r) AS figures, count(*) AS n FROM f WHERE structure_score >= 0.7 GROUP BY 1""")
def threshold_group_bundle(spark, d):
    final = quality.final_rank(quality.coarse_selection(_scores(spark, d), 0.6)[0])
    return quality.bundles(final, 0.7).select("arxiv_id", F.array_join(F.transform("figures", lambda f: f["png"]), ",").alias("figures"), F.size("figures").cast("long").alias("n"))


@query("SELECT page_id, round(least(2.0, 4096.0 / greatest(w, h), sqrt(20000000.0 / (w * h))), 6) AS most, CASE WHEN m >= 2.0 THEN 2.0::DOUBLE WHEN m >= 1.5 THEN 1.5::DOUBLE WHEN m >= 1.25 THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END AS scale FROM (SELECT *, least(2.0, 4096.0 / greatest(w, h), sqrt(20000000.0 / (w * h))) + 1e-9 AS m FROM (SELECT page_id, strlen(html)::DOUBLE AS w, length(url)::DOUBLE * 60 AS h FROM pages))")
def adaptive_scale(spark, d):
    p = table(spark, d, "pages").select("page_id", F.octet_length("html").cast("double").alias("w"), (F.length("url").cast("double") * 60).alias("h"))
    most = F.least(F.lit(2.0), 4096.0 / F.greatest("w", "h"), F.sqrt(20e6 / (F.col("w") * F.col("h"))))
    return p.select("page_id", F.round(most, 6).alias("most"), scalars.adaptive_scale(F.col("w"), F.col("h")).alias("scale"))


@query("""WITH s AS (SELECT page_id, CASE WHEN m >= 2.0 THEN 2.0::DOUBLE WHEN m >= 1.5 THEN 1.5::DOUBLE WHEN m >= 1.25 THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END AS scale
FROM (SELECT *, least(2.0, 4096.0 / greatest(w, h), sqrt(20000000.0 / (w * h))) + 1e-9 AS m FROM (SELECT page_id, strlen(html)::DOUBLE AS w, length(url)::DOUBLE * 60 AS h FROM pages)))
SELECT scale, count(*) AS n, min(page_id) AS first_page FROM s GROUP BY scale""")
def scale_groups(spark, d):
    return stages.scale_groups(adaptive_scale(spark, d).withColumnRenamed("page_id", "key")).withColumnRenamed("first_key", "first_page")


@query("""WITH l AS (SELECT vec_id, list_transform(embedding[1:8], lambda x: x::DOUBLE * 10) AS p, list_transform(embedding[9:19], lambda x: x::DOUBLE * 10) AS n FROM embeddings),
m AS (SELECT vec_id, list_max(p) + ln(list_sum(list_transform(p, lambda x: exp(x - list_max(p))))) - ln(8) AS pos, list_max(n) + ln(list_sum(list_transform(n, lambda x: exp(x - list_max(n))))) - ln(11) AS neg FROM l)
SELECT vec_id, round(pos, 6) AS positive_logit, round(neg, 6) AS negative_logit, round(pos - neg, 6) AS model_margin, pos - neg > -2.3 AS model_keep FROM m""")
def log_mean_exp_margin(spark, d):
    logits = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 10)
    e = table(spark, d, "embeddings").select("vec_id", scalars.log_mean_exp(F.slice(logits, 1, 8)).alias("positive_logit"), scalars.log_mean_exp(F.slice(logits, 9, 11)).alias("negative_logit"))
    return quality.with_margin(e).select("vec_id", *[F.round(c, 6).alias(c) for c in ("positive_logit", "negative_logit", "model_margin")], "model_keep")


@query("""SELECT vec_id % 50 AS image, i AS prompt, round(avg(embedding[i]::DOUBLE), 6) AS logit FROM embeddings, (SELECT unnest(range(1, 20)) AS i) GROUP BY 1, 2""")
def mean_over_views(spark, d):
    views = table(spark, d, "embeddings").select((F.col("vec_id") % 50).alias("image"), F.posexplode(F.slice("embedding", 1, 19)).alias("i", "x"))
    views = views.select("image", (F.col("i") + 1).cast("long").alias("prompt"), F.col("x").alias("logit"))
    return quality.mean_views(views, "image", "prompt", "logit").withColumn("logit", F.round("logit", 6))


# Folds and slices


#: Next-fit in SQL goes from the first row of a bin to the first row of the next.
_NEXT_FIT = """WITH RECURSIVE w AS ({rows}), s AS (SELECT *, sum(n) OVER (ORDER BY i) AS upto FROM w),
nx AS (SELECT a.i, min(b.i) AS nxt FROM (SELECT i, upto - n + {cap} AS most, unnest(range(i + 1, i + {reach})) AS j FROM s) a JOIN s b ON b.i = a.j WHERE b.upto > a.most GROUP BY 1),
steps AS MATERIALIZED (SELECT list(coalesce(nxt, 0) ORDER BY i) AS step FROM s LEFT JOIN nx USING (i)),
f AS (SELECT 1::BIGINT AS i, 0::BIGINT AS bin UNION ALL SELECT step[i], bin + 1 FROM f, steps WHERE step[i] > 0),
packed AS (SELECT w.*, last_value(bin IGNORE NULLS) OVER (ORDER BY i) AS bin FROM w LEFT JOIN f USING (i))"""


@query(_NEXT_FIT.format(cap=48, reach=50, rows="SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS i, greatest(1, coalesce(m, 0)) AS n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey") + " SELECT k AS o_orderkey, n::BIGINT AS weight, bin AS batch FROM packed")
def next_fit_batches(spark, d):
    n = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    w = table(spark, d, "orders").select("o_orderkey").join(n, "o_orderkey", "left").select("o_orderkey", F.greatest(F.lit(1), F.coalesce("n", F.lit(0))).cast("long").alias("weight"))
    return folds.pack_next_fit(w, ["o_orderkey"], F.col("weight"), 48, "batch")


@query(_NEXT_FIT.format(cap=65536, reach=66, rows="SELECT page_id AS k, row_number() OVER (ORDER BY page_id) AS i, CAST(512 + ceil(strlen(html) / 512) * 512 AS BIGINT) AS n FROM pages") + " SELECT k AS page_id, n AS bytes, bin AS shard FROM packed")
def shard_plan(spark, d):
    p = table(spark, d, "pages").select("page_id", folds.tar_size(F.octet_length("html")).cast("long").alias("bytes"))
    return folds.pack_next_fit(p, ["page_id"], F.col("bytes"), 65536, "shard")


@query("SELECT s_suppkey, CAST(floor((row_number() OVER (ORDER BY s_suppkey) - 1) / 50) AS BIGINT) AS chunk FROM supplier")
def fixed_chunks(spark, d):
    return folds.fixed_chunks(table(spark, d, "supplier").select("s_suppkey"), [F.col("s_suppkey")], 50)


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_name DESC, c_custkey LIMIT 25 OFFSET 10")
def ordered_slice(spark, d):
    return folds.slice_rows(table(spark, d, "customer").select("c_custkey", "c_name"), [F.desc("c_name"), F.col("c_custkey")], 10, 25)


@query("""WITH f AS (SELECT source AS arxiv_id, 'd' || doc_id || '/' || CASE doc_id % 5 WHEN 0 THEN 'Main.tex' WHEN 1 THEN 'supp.tex' WHEN 2 THEN 'x.sty' ELSE 'part.tex' END AS path, CASE doc_id % 4 WHEN 0 THEN '\\documentclass' WHEN 1 THEN '\\title' ELSE '' END || text AS text FROM documents),
s AS (SELECT *, CASE WHEN contains(text, '\\documentclass') THEN 1000 ELSE 0 END + CASE WHEN contains(text, '\\begin{document}') THEN 1000 ELSE 0 END + CASE WHEN contains(text, '\\title') THEN 100 ELSE 0 END
 + CASE WHEN path LIKE '%/Main.tex' THEN 200 ELSE 0 END - CASE WHEN path LIKE '%/supp.tex' THEN 100 ELSE 0 END + least(length(text), 1000000) / 1000000 AS score FROM f WHERE path LIKE '%.tex')
SELECT arxiv_id, path FROM s QUALIFY row_number() OVER (PARTITION BY arxiv_id ORDER BY score DESC, path) = 1""")
def main_file_choice(spark, d):
    k = F.col("doc_id")
    name = F.when(k % 5 == 0, "Main.tex").when(k % 5 == 1, "supp.tex").when(k % 5 == 2, "x.sty").otherwise("part.tex")
    mark = F.when(k % 4 == 0, "\\documentclass").when(k % 4 == 1, "\\title").otherwise("")
    files = table(spark, d, "documents").select(F.col("source").alias("arxiv_id"), F.concat(F.lit("d"), k.cast("string"), F.lit("/"), name).alias("path"), F.concat(mark, F.col("text")).alias("text"))
    return texts.main_files(files).select("arxiv_id", "path")


# Scalars, text, detection


@query("SELECT doc_id, substr(CASE WHEN c = '' THEN 'diagram' ELSE c END, 1, 24) AS name FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS c FROM documents)")
def slug_names(spark, d):
    return table(spark, d, "documents").select("doc_id", scalars.slug(F.col("text"), 24).alias("name"))


@query("SELECT page_id, substr(CASE WHEN c = '' THEN 'diagram' ELSE c END, 1, 20) || '_' || substr(sha1(url || '/page/' || (page_id % 7)), 1, 12) AS key FROM (SELECT *, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS c FROM pages)")
def task_key_sha1(spark, d):
    return table(spark, d, "pages").select("page_id", scalars.task_key(F.col("url"), F.lit("page"), F.col("page_id") % 7).alias("key"))


@query("""WITH o AS (SELECT o_orderkey, date_trunc('month', o_orderdate + INTERVAL 10 YEAR)::TIMESTAMP AS m FROM orders)
SELECT strftime(s.m, '%y%m') AS month, count(o_orderkey) AS orders FROM (SELECT unnest(generate_series((SELECT min(m) FROM o), (SELECT max(m) FROM o), INTERVAL 1 MONTH)) AS m) s LEFT JOIN o ON o.m = s.m GROUP BY 1""")
def months_desc(spark, d):
    """Orders by the month ten years after them, from the newest back to the oldest, months without any included."""
    orders = table(spark, d, "orders").select(F.date_format(F.add_months("o_orderdate", 120), "yyMM").alias("month"), "o_orderkey")
    ends = orders.agg(F.max("month").alias("start"), F.min("month").alias("stop")).first()
    return descending_months(spark, ends.start, ends.stop).join(orders, "month", "left").groupBy("month").agg(F.count("o_orderkey").alias("orders"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS title, regexp_replace('2401.' || doc_id || 'v' || (doc_id % 4), 'v[0-9]+$', '') AS arxiv_id FROM documents")
def title_normalise(spark, d):
    name = F.concat(F.lit("2401."), F.col("doc_id").cast("string"), F.lit("v"), (F.col("doc_id") % 4).cast("string"))
    return table(spark, d, "documents").select("doc_id", scalars.title(F.col("text")).alias("title"), scalars.without_version(name).alias("arxiv_id"))


@query("SELECT o_orderkey, list_has_any(c, ['cs.AI', 'cs.LG']) AS is_cs FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN ['cs.AI', 'math.CO'] WHEN o_orderkey % 5 = 1 THEN ['math.CO'] WHEN o_orderkey % 5 = 2 THEN ['stat.ML', 'cs.LG'] ELSE [] END AS c FROM orders)")
def category_exists(spark, d):
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "cs.AI math.CO").when(k == 1, "math.CO").when(k == 2, "stat.ML cs.LG").otherwise("")
    return table(spark, d, "orders").select("o_orderkey", scalars.starts_category(F.split(text, r"\s+")).alias("is_cs"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad' ELSE '' END = '' AND value >= 0 AS valid FROM events")
def row_valid(spark, d):
    messages = F.when(F.col("event_type") == "error", "bad"), F.when(F.col("value") < 0, "negative")
    return table(spark, d, "events").select("event_id", scalars.all_empty(*messages).alias("valid"))


@query("""SELECT page_id, CASE WHEN k = 'drawio' AND regexp_matches(html, '<article\\b|<nav\\b') THEN 'direct_drawio_xml' WHEN k IN ('svg', 'png', 'pdf') AND (contains(html, 'mxfile') OR contains(html, 'mxGraphModel') OR contains(html, 'mxgraph') OR contains(html, 'diagrams.net') OR contains(html, '/drawio')) THEN 'embedded_marker_' || k END AS reason
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'drawio' WHEN 1 THEN 'svg' WHEN 2 THEN 'png' ELSE 'txt' END AS k, CASE WHEN page_id % 3 = 0 THEN html || '<mxGraphModel>' ELSE html END AS html FROM pages)""")
def marker_detect(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("drawio", "svg", "png", "txt"))), (F.col("page_id") % 4 + 1).cast("int"))
    html = F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit("<mxGraphModel>"))).otherwise(F.regexp_replace("html", r"<(article|nav)\b", "<diagram "))
    body = F.when(kind == "drawio", F.concat(html, F.lit("<mxfile "))).otherwise(html)
    return table(spark, d, "pages").select("page_id", markers.reason(F.concat(F.lit("a/b."), kind), body.cast("binary")).alias("reason"))


@query("SELECT page_id, ((page_id * 7919) % 4000 + 1)::INT AS png_w, ((page_id * 104729) % 3000 + 1)::INT AS png_h, true AS valid FROM pages")
def png_header(spark, d):
    word = lambda x: F.unhex(F.lpad(F.hex(x), 8, "0"))
    w, h = (F.col("page_id") * 7919) % 4000 + 1, (F.col("page_id") * 104729) % 3000 + 1
    content = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), word(w), word(h), F.encode(F.rpad(F.lit("x"), 100, "x"), "UTF-8"))
    pw, ph = scalars.png_size(F.col("content"))
    return table(spark, d, "pages").select("page_id", content.alias("content")).select("page_id", pw.alias("png_w"), ph.alias("png_h"), ((pw > 0) & (ph > 0) & (F.length("content") > 100)).alias("valid"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(raw, '[ \t]+', ' ', 'g'), '\n[ \t]+', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS markdown
FROM (SELECT doc_id, '# First ' || doc_id || chr(10) || chr(10) || ' ' || replace(regexp_replace(text, '[\\{}%~]', ' ', 'g'), chr(13), '') || ' 100% ' || chr(10) || ' ' || chr(10) || '-  one two three a b  {c} d' AS raw FROM documents)""")
def latex_to_markdown(spark, d):
    text = F.regexp_replace("text", r"[\\{}%~]", " ")
    head, tail = r"\documentclass{a} \begin{document} \section{First ", r"\begin{figure} x \end{figure} \item one \emph{two \textit{three}} a~b \label{x} {c} \cite[p. 3]{d} \end{document}"
    source = F.concat(F.lit(head), F.col("doc_id").cast("string"), F.lit(r"} \textbf{"), text, F.lit("} 100\\% % gone\n" + tail))
    return table(spark, d, "documents").select("doc_id", latex.to_markdown(source).alias("markdown"))


@query("SELECT doc_id, strlen(text) >= 1000 AND NOT contains(lower(substr(text, 1, 500)), '<html') AND NOT contains(lower(substr(text, 1, 500)), '<!doctype html') AS download_ok, length(text) >= 1000 AS conversion_ok FROM documents")
def text_acceptance(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", latex.acceptable_download(t).alias("download_ok"), latex.acceptable_conversion(t).alias("conversion_ok"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max((ts, event_id))[2] AS event_id FROM events GROUP BY user_id")
def incremental_upsert_stream(spark, d):
    from loomwright.streaming.incremental import latest_by_stream

    return latest_by_stream(spark, f"{d}/events.parquet", "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS hour_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def hourly_events(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.unix_timestamp("w.start").alias("hour_start"), "event_type", "n", "total")


@query("SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS hour_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def hourly_events_stream(spark, d):
    """The same from a stream of files, which come one after the other without regard to time."""
    from loomwright.streaming.incremental import hourly_by_stream

    folder = f"{shared_folder(spark)}/events-{uuid.uuid4().hex}"
    table(spark, d, "events").repartition(6, "event_id").write.parquet(folder)
    hours, late = hourly_by_stream(spark, folder, late="100 years", files_per_batch=2)
    if late:
        raise RuntimeError(f"{late} events are late")
    return hours.select("hour_start", "event_type", "n", F.round("total", 4).alias("total"))


# Documents, packages and pictures made from the driver's rows, so that SQL knows what must come out


def _documents(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    cells = F.concat(F.repeat(F.lit('<mxCell vertex="1" value="x"><mxGeometry x="5" y="7" width="30" height="20"/></mxCell>'), (k % 5).cast("int")), F.repeat(F.lit('<mxCell edge="1"/>'), (k % 3).cast("int")))
    page = F.concat(F.lit('<diagram name="P"><mxGraphModel pageWidth="850" pageHeight="1100"><root>'), cells, F.lit("</root></mxGraphModel></diagram>"))
    whole = F.concat(F.lit("<mxfile>"), F.repeat(page, (k % 4).cast("int")), F.lit("</mxfile>"))
    return dealt(table(spark, d, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.when(k % 11 == 0, "<mxfile").otherwise(whole).cast("binary").alias("content"))


@query("""SELECT c_custkey, CAST(i AS INT) AS page_number, CASE WHEN bad OR c_custkey % 4 = 0 THEN 'Page-1' ELSE 'P' END AS page_name, CAST(CASE WHEN bad OR c_custkey % 4 = 0 THEN 0 ELSE c_custkey % 5 END AS INT) AS verts,
CAST(CASE WHEN bad OR c_custkey % 4 = 0 THEN 0 ELSE c_custkey % 3 END AS INT) AS edges, CAST(CASE WHEN bad OR c_custkey % 4 = 0 THEN 0 ELSE c_custkey % 5 END AS INT) AS texts
FROM (SELECT c_custkey, c_custkey % 11 = 0 AS bad, unnest(range(1, CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE greatest(1, c_custkey % 4) + 1 END)) AS i FROM customer)""")
def xml_pages_lenient(spark, d):
    from loomwright.functions.xml_pages import lenient_pages

    pages = _documents(spark, d).select("c_custkey", F.explode(lenient_pages("content")).alias("p")).select("c_custkey", "p.*")
    m = scalars.page_metrics(F.col("body"))
    return pages.select("c_custkey", "page_number", "page_name", m["verts"].alias("verts"), m["edges"].alias("edges"), m["texts"].alias("texts"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 5 + c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 4 END AS pages,
CASE WHEN c_custkey % 11 = 0 THEN 'parse' WHEN c_custkey % 4 = 0 OR c_custkey % 5 + c_custkey % 3 = 0 THEN 'empty' ELSE '' END AS problem FROM customer""")
def xml_pages_strict(spark, d):
    from loomwright.functions.xml_pages import strict_pages

    r = _documents(spark, d).select("c_custkey", strict_pages("content").alias("r")).select("c_custkey", F.size("r.pages").cast("long").alias("pages"), "r.error")
    problem = F.when(F.col("error").startswith("ParseError"), "parse").when(F.col("error").isNotNull(), "empty").otherwise("")
    return r.select("c_custkey", "pages", problem.alias("problem"))


@query("""SELECT s_suppkey, CASE WHEN n > 0 THEN (n - 1) * 10.0 + 50 ELSE 850.0 END::DOUBLE AS width, CASE WHEN n > 0 THEN 40.0 ELSE 1100.0 END::DOUBLE AS height FROM (SELECT s_suppkey, s_suppkey % 6 AS n FROM supplier)""")
def page_bounding_box(spark, d):
    from loomwright.functions.xml_pages import page_size

    boxes = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.concat(F.lit('<mxGeometry y="3" x="'), (i * 10).cast("string"), F.lit('" width="30" height="20"/>'))), "")
    body = F.concat(F.lit('<mxGraphModel pageWidth="850" pageHeight="1100">'), F.when(F.col("n") > 0, boxes).otherwise(""), F.lit("</mxGraphModel>"))
    rows = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 6).cast("int").alias("n"))
    return rows.select("s_suppkey", page_size(body).alias("b")).select("s_suppkey", "b.width", "b.height")


def _packages(spark: SparkSession, d: str) -> DataFrame:
    """Packages of four kinds: archive with a diagram and an image, archive without, one file, broken."""

    def build(batches):
        import gzip
        import io
        import tarfile

        import pyarrow as pa

        for batch in batches:
            out = []
            for k in batch.column(0).to_pylist():
                if k % 4 > 1:
                    out.append(gzip.compress(b"%PDF mxfile" if k % 4 == 2 else b"plain") if k % 8 != 7 else b"broken")
                    continue
                data = io.BytesIO()
                with tarfile.open(fileobj=data, mode="w:gz") as t:
                    for name, body in ((f"a/{k}.drawio", b"<mxfile>"), ("b.svg", b"see diagrams.net")) if k % 4 == 0 else (("c.tex", b"mxfile"),):
                        info = tarfile.TarInfo(name)
                        info.size = len(body)
                        t.addfile(info, io.BytesIO(body))
                out.append(data.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([f"2401.{k:05d}.gz" for k in batch.column(0).to_pylist()]), pa.array(out, pa.binary())], ["path", "content"])

    return table(spark, d, "supplier").select("s_suppkey").mapInArrow(build, "path string, content binary")


@query("""SELECT format('2401.{:05d}', s_suppkey) AS arxiv_id, CASE WHEN s_suppkey % 4 = 0 THEN 'direct_drawio_xml,embedded_marker_svg' WHEN s_suppkey % 4 = 2 THEN 'single_payload_drawio_marker' WHEN s_suppkey % 8 = 7 THEN 'invalid_source_package' ELSE '' END AS reasons, s_suppkey % 2 = 0 AS matched FROM supplier""")
def package_detection(spark, d):
    from loomwright.plans.stages import collect

    return collect(_packages(spark, d), "2401").select("arxiv_id", F.array_join("reasons", ",").alias("reasons"), "matched")


@query("SELECT '2401' AS month, count(*) AS papers_seen, CAST(count_if(s_suppkey % 8 = 7) AS BIGINT) AS invalid_packages, CAST(count_if(s_suppkey % 2 = 0) AS BIGINT) AS matches FROM supplier")
def scan_counters(spark, d):
    from loomwright.plans.stages import collect, scan_counts

    return scan_counts(collect(_packages(spark, d), "2401"))


def _pictures(spark: SparkSession, d: str) -> DataFrame:
    """Pages with one of seven drawings each."""

    def draw(batches):
        import struct
        import zlib

        import numpy as np
        import pyarrow as pa

        def png(seed):
            rng, out = np.random.default_rng(seed), np.full((100, 100), 255, np.uint8)
            for x, y, w, h, c in rng.integers([5, 5, 10, 10, 0], [60, 60, 40, 40, 200], (12, 5)).tolist():
                out[y : y + h, x : x + w] = c
            chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
            raw = b"".join(b"\0" + r.tobytes() for r in out)
            return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 100, 100, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")

        made = [png(i) for i in range(7)]
        for batch in batches:
            keys = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([f"p{k:06d}" for k in keys]), pa.array([made[k % 7] for k in keys], pa.binary())], ["png", "content"])

    return dealt(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey").mapInArrow(draw, "png string, content binary")


@query("""SELECT format('p{:06d}', max(s_suppkey)) AS png, format('cluster_{:06d}', row_number() OVER (ORDER BY min(s_suppkey))) AS dedup_cluster, count(*) AS dedup_cluster_size, 1::BIGINT AS dedup_exact_variants FROM supplier GROUP BY s_suppkey % 7""")
def page_dedup(spark, d):
    from loomwright.plans.stages import index_pages

    pictures = _pictures(spark, d)
    figures = pictures.select(F.substring("png", 1, 4).alias("arxiv_id"), F.lit("d").alias("drawio_path"), F.lit(1).alias("page_number"), "png")
    documents = spark.createDataFrame([("d", b'<mxfile><diagram><mxGraphModel><mxCell vertex="1"/></mxGraphModel></diagram></mxfile>')], "drawio_path string, content binary")
    papers = figures.select("arxiv_id", F.lit(True).alias("is_cs")).distinct()
    return dedup.unique_pages(index_pages(figures, documents, pictures, papers))[0].select("png", "dedup_cluster", "dedup_cluster_size", "dedup_exact_variants")


@query("""WITH m(name, size) AS (SELECT 'sh-' || (o_orderkey % 9) || '/' || o_orderstatus, count(*) FROM orders GROUP BY 1) SELECT name, size, CAST(sum(size) OVER () AS BIGINT) AS total FROM m""")
def shard_totals(spark, d):
    name = F.concat(F.lit("sh-"), (F.col("o_orderkey") % 9).cast("string"), F.lit("/"), F.col("o_orderstatus"))
    m = table(spark, d, "orders").groupBy(name.alias("name")).agg(F.count("*").alias("size"))
    return m.crossJoin(F.broadcast(m.agg(F.sum("size").alias("total"))))


from loomwright.plans import catalogue_files, catalogue_states  # noqa: E402, F401  they register their queries
