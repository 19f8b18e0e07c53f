"""Queries over the relational model: counts, search joins, persons, validation, votes, health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import flags
from ..functions.vectors import dot
from ..operators import identity, legacy, loading
from ..operators.intervals import micro
from ..sources.adapters import SEGMENTS_SQL, diarization, segments, table, transcript
from .registry import query

_ALL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "conversations", "labels")


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _ALL))
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return loading.counts({t: table(spark, d, t) for t in _ALL})


@query("db_summary", "SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS sessions, (SELECT count(*) FROM conversations) AS turns, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey IS NOT NULL) AS persons, (SELECT count(*) FROM embeddings) AS vectors")
def db_summary(spark: SparkSession, d: str) -> DataFrame:
    talks = table(spark, d, "conversations").agg(F.countDistinct("conv_id").alias("sessions"), F.count("*").alias("turns"))
    people = table(spark, d, "orders").filter("o_custkey is not null").agg(F.countDistinct("o_custkey").alias("persons"))
    vectors = table(spark, d, "embeddings").agg(F.count("*").alias("vectors"))
    return talks.crossJoin(F.broadcast(people)).crossJoin(F.broadcast(vectors))  # one row each


@query(
    "people_by_kind",
    """SELECT coalesce(c_mktsegment, 'unknown') AS kind, count(DISTINCT o_orderkey) AS turns, count(DISTINCT c_custkey) AS people FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1
    ORDER BY CASE WHEN coalesce(c_mktsegment, 'unknown') = 'unknown' THEN 1 ELSE 0 END, turns DESC, kind""",
)
def people_by_kind(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    out = rows.groupBy(F.coalesce("c_mktsegment", F.lit("unknown")).alias("kind")).agg(F.countDistinct("o_orderkey").alias("turns"), F.countDistinct("c_custkey").alias("people"))
    return out.orderBy(F.when(F.col("kind") == "unknown", 1).otherwise(0), F.desc("turns"), "kind")


@query(
    "semantic_search_joined",
    """WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, label, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])), 6) AS score FROM embeddings, q)
    SELECT s.vec_id, s.score, n.n_name AS person, r.r_name AS session FROM s JOIN nation n ON n.n_nationkey = s.label LEFT JOIN region r ON r.r_regionkey = n.n_regionkey ORDER BY s.score DESC, s.vec_id LIMIT 5""",
)
def semantic_search_joined(spark: SparkSession, d: str) -> DataFrame:
    """Scores are ranked before the joins that only add names; the label join keeps the rows that have a turn."""
    vectors = table(spark, d, "embeddings")
    asked = vectors.filter("vec_id = 0").select(F.col("embedding").alias("v")).limit(1)
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    scored = vectors.crossJoin(F.broadcast(asked)).select("vec_id", "label", F.round(dot(F.col("embedding"), F.col("v")), 6).alias("score"))
    top = scored.join(nation, F.col("label") == F.col("n_nationkey")).orderBy(F.desc("score"), "vec_id").limit(5)
    return top.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("vec_id", "score", F.col("n_name").alias("person"), F.col("r_name").alias("session"))


@query("turn_detail", "SELECT o.o_orderkey AS turn_id, o.o_orderstatus AS source, c.c_name AS person, n.n_name AS session FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE o.o_orderkey = 42")
def turn_detail(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "orders").filter("o_orderkey = 42")
    rows = one.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(F.col("o_orderkey").alias("turn_id"), F.col("o_orderstatus").alias("source"), F.col("c_name").alias("person"), F.col("n_name").alias("session"))


@query("first_session", "SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id ORDER BY conv_id LIMIT 1")
def first_session(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns")).orderBy("conv_id").limit(1)


@query("missing_refs_anti", "SELECT DISTINCT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND doc_id IS NOT NULL")
def missing_refs_anti(spark: SparkSession, d: str) -> DataFrame:
    return loading.missing(table(spark, d, "documents"), table(spark, d, "labels"), ("doc_id",), ("doc_id",))


@query("existing_refs_semi", "SELECT DISTINCT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def existing_refs_semi(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "orders").filter("o_orderstatus = 'F'")
    return table(spark, d, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey").distinct()


@query("duplicate_guard", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_guard(spark: SparkSession, d: str) -> DataFrame:
    return loading.duplicates(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("orphan_union", "SELECT o_custkey AS id FROM orders WHERE o_totalprice > 400000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def orphan_union(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("id"))
    return a.union(table(spark, d, "customer").filter("c_acctbal < 0").select("c_custkey")).distinct()


@query(
    "person_dimension",
    """WITH p AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'x' || (c_custkey % 50) END AS id, 'Person ' || (c_custkey % 50) AS name, c_mktsegment AS role, 'k' || (c_custkey % 2) AS kind FROM customer)
    SELECT lower(name) AS normalized_name, kind, arg_min(name, ord) AS name, min(id) AS external_id, arg_min(role, ord) AS role FROM p GROUP BY lower(name), kind""",
)
def person_dimension(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(k.alias("ord"), F.when(k % 3 != 0, F.concat(F.lit("x"), k % 50)).alias("id"), F.concat(F.lit("Person "), k % 50).alias("name"), F.col("c_mktsegment").alias("role"), F.concat(F.lit("k"), k % 2).alias("kind"))
    return loading.persons(rows).drop("ord")


@query("person_upsert", "SELECT coalesce(a.n_nationkey, b.s_nationkey) AS k, coalesce(a.n_name, b.name) AS name FROM nation a FULL JOIN (SELECT s_nationkey, min(s_name) AS name FROM supplier GROUP BY 1) b ON a.n_nationkey = b.s_nationkey")
def person_upsert(spark: SparkSession, d: str) -> DataFrame:
    new = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.min("s_name").alias("name"))
    old = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("old"))
    return old.join(new, "k", "full").select("k", F.coalesce("old", "name").alias("name"))


_VOTES = "v AS (SELECT conv_id, role, length(text) % 4 AS person, 1 + (length(text) % 2) AS weight, turn AS ord FROM conversations), g AS (SELECT conv_id, role, person, sum(weight) AS votes, min(ord) AS seen FROM v GROUP BY ALL), r AS (SELECT *, sum(votes) OVER (PARTITION BY conv_id, role) AS total, row_number() OVER (PARTITION BY conv_id, role ORDER BY votes DESC, seen) AS n FROM g)"


def _votes(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("text")
    return table(spark, d, "conversations").select("conv_id", "role", (n % 4).cast("long").alias("person"), (1 + n % 2).alias("weight"), F.col("turn").alias("ord"))


@query("vote_matrix", f"WITH {_VOTES} SELECT conv_id, role, person, CAST(votes AS BIGINT) AS votes FROM g")
def vote_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _votes(spark, d).groupBy("conv_id", "role", "person").agg(F.sum("weight").alias("votes"))


@query("vote_matrix_purity", f"WITH {_VOTES} SELECT conv_id, role, person, CAST(votes AS BIGINT) AS votes, CAST(total AS BIGINT) AS total_votes, round(votes / total, 6) AS purity FROM r WHERE n = 1")
def vote_matrix_purity(spark: SparkSession, d: str) -> DataFrame:
    return identity.voted(_votes(spark, d), ["conv_id", "role"]).withColumn("purity", F.round("purity", 6))


_AHEAD = ", ".join(f"CASE WHEN lead(role, {k}) OVER w <> role THEN lead(turn, {k}) OVER w END" for k in range(1, 6))


@query("lookahead_speaker", f"SELECT conv_id, turn, role, coalesce({_AHEAD}, lead(turn) OVER w, -1) AS predicted_turn_id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def lookahead_speaker(spark: SparkSession, d: str) -> DataFrame:
    rows = identity.looked_ahead(table(spark, d, "conversations"), "turn", "role", ("conv_id",))
    return rows.select("conv_id", "turn", "role", F.coalesce("predicted_turn_id", F.lit(-1)).alias("predicted_turn_id"))


@query("mentioned_distinct", "WITH w AS (SELECT conv_id, turn, unnest(string_split(lower(text), ' ')) AS word, generate_subscripts(string_split(lower(text), ' '), 1) AS ord FROM conversations), f AS (SELECT conv_id, turn, word, min(ord) AS o FROM w WHERE length(word) > 9 GROUP BY ALL) SELECT conv_id, turn, string_agg(word, ' ' ORDER BY o) AS words FROM f GROUP BY conv_id, turn")
def mentioned_distinct(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split(F.lower("text"), " ")).alias("ord", "word")).filter(F.length("word") > 9)
    first = rows.groupBy("conv_id", "turn", "word").agg(F.min("ord").alias("o"))
    words = F.transform(F.array_sort(F.collect_list(F.struct("o", "word"))), lambda x: x["word"])
    return first.groupBy("conv_id", "turn").agg(F.array_join(words, " ").alias("words"))


@query(
    "cluster_majority",
    f"""WITH {SEGMENTS_SQL}, e AS (SELECT session_id, speaker_id, segment_id % 7 AS person_key, sum(end_seconds - start_seconds) AS s FROM di GROUP BY ALL), t AS (SELECT session_id, speaker_id, sum(end_seconds - start_seconds) AS speech FROM seg GROUP BY ALL),
    r AS (SELECT *, sum(s) OVER (PARTITION BY session_id, speaker_id) AS all_s, row_number() OVER (PARTITION BY session_id, speaker_id ORDER BY s DESC) AS n FROM e)
    SELECT t.session_id, t.speaker_id, round(speech, 3) AS speech_seconds, person_key, round(s / all_s, 6) AS evidence_purity, round(s / speech, 6) AS absolute_purity FROM t LEFT JOIN r ON t.session_id = r.session_id AND t.speaker_id = r.speaker_id AND n = 1""",
)
def cluster_majority(spark: SparkSession, d: str) -> DataFrame:
    proof = diarization(spark, d).select("session_id", "speaker_id", (F.col("segment_id") % 7).alias("person_key"), (F.col("end_seconds") - F.col("start_seconds")).alias("seconds"))
    rows = identity.cluster_majorities(proof, segments(spark, d))
    return rows.select("session_id", "speaker_id", F.round("speech_seconds", 3).alias("speech_seconds"), "person_key", *[F.round(c, 6).alias(c) for c in ("evidence_purity", "absolute_purity")])


@query(
    "turn_identity_priority",
    """WITH t AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations), e AS (SELECT conv_id, turn, 'P' || (n % 3) AS p FROM t WHERE n % 5 = 0),
    g AS (SELECT t.conv_id, t.role, e.p, count(*) AS v, min(t.turn) AS seen FROM e JOIN t USING (conv_id, turn) GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY v DESC, seen) AS k FROM g)
    SELECT t.conv_id, t.turn, coalesce(e.p, c.p) AS person, CASE WHEN e.p IS NOT NULL THEN 'probable_next_speaker' WHEN c.p IS NOT NULL THEN 'propagated_from_speaker_cluster' ELSE 'unknown' END AS source
    FROM t LEFT JOIN e USING (conv_id, turn) LEFT JOIN c ON c.conv_id = t.conv_id AND c.role = t.role AND c.k = 1""",
)
def turn_identity_priority(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("session_id"), F.col("turn").alias("turn_id"), F.col("role").alias("speaker_id"), "text")
    n = F.length("text")
    person = F.struct(F.lit("raw_per").alias("kind"), F.lit(None).cast("string").alias("id"), F.concat(F.lit("P"), n % 3).alias("name"))
    proof = turns.filter(n % 5 == 0).select("session_id", F.col("turn_id").alias("ord"), F.col("turn_id").alias("target_turn_id"), F.col("speaker_id").alias("target_speaker_id"), F.lit("probable_next_speaker").alias("source"), person.alias("person"), F.lit(1).alias("weight"))
    rows = identity.turn_identities(turns, proof)
    return rows.select(F.col("session_id").alias("conv_id"), F.col("turn_id").alias("turn"), F.col("current_person.name").alias("person"), "source")


@query("logprob_histogram", f"WITH {SEGMENTS_SQL} SELECT CAST(trunc(avg_logprob / 0.05) AS BIGINT) AS bin, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM tr GROUP BY 1")
def logprob_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = transcript(spark, d).groupBy(legacy.truncated_bin(F.col("avg_logprob"), 0.05).alias("bin")).agg(F.count("*").alias("n"))
    return rows.select("bin", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2).alias("percent"))


@query("cross_table_ratios", f"WITH {SEGMENTS_SQL} SELECT round((SELECT count(*) FROM tr) / (SELECT count(*) FROM di), 6) AS transcript_per_diarization, round((SELECT count(*) FROM conversations) / (SELECT count(DISTINCT conv_id) FROM conversations), 6) AS turns_per_session")
def cross_table_ratios(spark: SparkSession, d: str) -> DataFrame:
    a = transcript(spark, d).agg(F.count("*").alias("t"))
    b = diarization(spark, d).agg(F.count("*").alias("d"))
    c = table(spark, d, "conversations").agg(F.count("*").alias("n"), F.countDistinct("conv_id").alias("s"))
    row = a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(c))  # one row each
    return row.select(F.round(F.col("t") / F.col("d"), 6).alias("transcript_per_diarization"), F.round(F.col("n") / F.col("s"), 6).alias("turns_per_session"))


@query(
    "logprob_local_zscore",
    f"""WITH {SEGMENTS_SQL}, w AS (SELECT session_id, segment_id, avg_logprob AS x, count(*) OVER a - 1 AS n, sum(avg_logprob) OVER a - avg_logprob AS s, sum(avg_logprob * avg_logprob) OVER a - avg_logprob * avg_logprob AS q, avg_logprob - lag(avg_logprob) OVER o AS change FROM tr
      WINDOW a AS (PARTITION BY session_id ORDER BY segment_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING), o AS (PARTITION BY session_id ORDER BY segment_id))
    SELECT session_id, segment_id, round(change, 6) AS change, round(s / n, 6) AS local_mean, round(sqrt(greatest(0, q / n - (s / n) * (s / n))), 5) AS local_std FROM w""",
)
def logprob_local_zscore(spark: SparkSession, d: str) -> DataFrame:
    rows = legacy.local_z(transcript(spark, d), "avg_logprob", "segment_id")
    return rows.select("session_id", "segment_id", F.round("change", 6).alias("change"), F.round("local_mean", 6).alias("local_mean"), F.round("local_std", 5).alias("local_std"))


@query("near_multiple_boundary", f"WITH {SEGMENTS_SQL} SELECT session_id, segment_id, abs(start_seconds - round_even(start_seconds / 30, 0) * 30) <= 0.15 AS near FROM seg")
def near_multiple_boundary(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("session_id", "segment_id", legacy.near_multiple(F.col("start_seconds")).alias("near"))


@query("global_quality_score", f"WITH {SEGMENTS_SQL}, m AS (SELECT avg(value) AS a, stddev_samp(value) AS s FROM tr) SELECT session_id, segment_id, round((value - a) / (s + 1e-9), 5) AS z_value FROM tr, m")
def global_quality_score(spark: SparkSession, d: str) -> DataFrame:
    return legacy.global_z(transcript(spark, d), "value").select("session_id", "segment_id", F.round("z_value", 5).alias("z_value"))


@query(
    "other_speaker_overlaps",
    f"WITH {SEGMENTS_SQL} SELECT a.session_id, a.segment_id AS a_id, b.segment_id AS b_id, round(least(a.end_seconds, b.end_seconds) - greatest(a.start_seconds, b.start_seconds), 6) AS overlap_seconds FROM di a JOIN di b ON a.session_id = b.session_id AND a.speaker_id <> b.speaker_id AND a.segment_id <> b.segment_id AND least(a.end_seconds, b.end_seconds) - greatest(a.start_seconds, b.start_seconds) >= 0.2",
)
def other_speaker_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return legacy.other_overlaps(diarization(spark, d)).select("session_id", "a_id", "b_id", micro(F.col("overlap_seconds")).alias("overlap_seconds"))


_GAPS = "gp AS (SELECT session_id, lag(end_seconds) OVER w AS s, start_seconds AS e, segment_id AS next_id FROM di WINDOW w AS (PARTITION BY session_id ORDER BY start_seconds, segment_id))"


@query(
    "gap_audit",
    f"""WITH {SEGMENTS_SQL}, {_GAPS}, x AS (SELECT t.session_id, t.segment_id, g.next_id, least(t.end_seconds, g.e) - greatest(t.start_seconds, g.s) AS o, (t.start_seconds + t.end_seconds) / 2 AS m, s, e FROM tr t JOIN gp g ON t.session_id = g.session_id AND g.e > g.s AND t.start_seconds < g.e AND g.s < t.end_seconds)
    SELECT CASE WHEN m - s <= 0.25 THEN 'near_prev' WHEN e - m <= 0.25 THEN 'near_next' ELSE 'deep_gap' END AS place, count(*) AS n, round(sum(o), 4) AS seconds FROM x WHERE o > 0 GROUP BY 1""",
)
def gap_audit(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.intervals import gaps

    left = transcript(spark, d).select("session_id", "segment_id", F.col("start_seconds").alias("a_start"), F.col("end_seconds").alias("a_end"))
    right = gaps(diarization(spark, d)).select("session_id", "next_id", F.col("gap_start").alias("b_start"), F.col("gap_end").alias("b_end"))
    return legacy.token_gap_overlaps(left, right).groupBy("place").agg(F.count("*").alias("n"), F.round(F.sum("overlap_seconds"), 4).alias("seconds"))


@query("context_midpoints", f"WITH {SEGMENTS_SQL} SELECT session_id, segment_id, round((start_seconds + coalesce(lead(end_seconds) OVER (PARTITION BY session_id ORDER BY start_seconds, segment_id), end_seconds)) / 2, 4) AS middle_seconds FROM tr")
def context_midpoints(spark: SparkSession, d: str) -> DataFrame:
    return legacy.context_middle(transcript(spark, d)).select("session_id", "segment_id", F.round("middle_seconds", 4).alias("middle_seconds"))


@query("describe_values", "SELECT count(value) AS n, round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS std, min(value) AS min, " + ", ".join(f"round(quantile_cont(value, {p}), 5) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75)) + ", max(value) AS max FROM events")
def describe_values(spark: SparkSession, d: str) -> DataFrame:
    row = legacy.described(table(spark, d, "events"), "value")
    return row.select("n", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), "min", *[F.round(f"p{p}", 5).alias(f"p{p}") for p in (25, 50, 75)], "max")


@query("value_counts_topk", "SELECT props, count(*) AS n FROM events GROUP BY props ORDER BY n DESC, props LIMIT 10")
def value_counts_topk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("props").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "props").limit(10)


@query("fixed_bins", "SELECT CASE WHEN value > 0 AND value <= 10 THEN '(0, 10]' WHEN value > 10 AND value <= 50 THEN '(10, 50]' WHEN value > 50 AND value <= 500 THEN '(50, 500]' END AS bin, count(*) AS n FROM events GROUP BY 1")
def fixed_bins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(legacy.binned(F.col("value"), [0, 10, 50, 500]).alias("bin")).agg(F.count("*").alias("n"))


@query("ranking_export_order", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 300")
def ranking_export_order(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(300)


@query("sql_functions", "SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 5) AS self, CASE WHEN (vec_id & 2) <> 0 THEN 1 ELSE 0 END AS dense, 0 AS none FROM embeddings")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The functions by their SQL names."""
    flags.register_sql(spark)
    table(spark, d, "embeddings").createOrReplaceTempView("embeddings_sql")
    return spark.sql("SELECT vec_id, round(dot_product(embedding, embedding), 5) AS self, has_flag_name(vec_id, 'INFORMATION_RATE_TOO_HIGH') AS dense, has_flag_name(vec_id, 'NO_SUCH_FLAG') AS none FROM embeddings_sql")


_PEOPLE = [("1", "Alice Dupont", "deputy"), ("2", "Laurent Marcangeli", "minister"), ("3", "Bernard Chaix", "deputy"), ("4", "Élodie Martin", "deputy")]
_ASKED = ["alice dupond", "laurent marcangelli", "bernard chex", "zzzzzz", "fleuristes", "Elodie MARTIN"]


@query("fuzzy_person_match", "SELECT * FROM (VALUES ('alice dupond', 'Alice Dupont', 'deputy'), ('laurent marcangelli', 'Laurent Marcangeli', 'minister'), ('bernard chex', 'Bernard Chaix', 'deputy'), ('zzzzzz', 'zzzzzz', 'raw_per'), ('fleuristes', 'fleuristes', 'raw_per'), ('Elodie MARTIN', 'Élodie Martin', 'deputy')) AS v(name, resolved_name, kind)")
def fuzzy_person_match(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame([(i, n, None, k, int(i)) for i, n, k in _PEOPLE], "id string, name string, role string, kind string, src_order long")
    names = spark.createDataFrame([(n,) for n in _ASKED], "name string")
    return identity.resolved_names(names, known).select("name", "resolved_name", "kind")


@query(
    "segment_cluster_keys",
    f"WITH {SEGMENTS_SQL}, c AS (SELECT session_id, speaker_id, row_number() OVER (PARTITION BY session_id ORDER BY speaker_id) AS cluster_id FROM (SELECT DISTINCT session_id, speaker_id FROM seg)) SELECT session_id, segment_id, speaker_id, CAST(cluster_id AS BIGINT) AS cluster_id FROM di JOIN c USING (session_id, speaker_id)",
)
def segment_cluster_keys(spark: SparkSession, d: str) -> DataFrame:
    labels = segments(spark, d).select("session_id", F.col("speaker_id").alias("label")).distinct()
    rows = diarization(spark, d).select("session_id", "segment_id", "speaker_id")
    return loading.with_clusters(rows, loading.numbered(labels, "cluster_id", ["label"]))


@query(
    "turn_person_keys",
    """WITH p AS (SELECT DISTINCT lower(n_name) AS name FROM nation), k AS (SELECT name, row_number() OVER (ORDER BY name) AS person_id FROM p)
    SELECT c_custkey, CAST(CASE WHEN c_custkey % 7 > 0 THEN person_id ELSE -1 END AS BIGINT) AS person_id FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN k ON lower(n_name) = k.name""",
)
def turn_person_keys(spark: SparkSession, d: str) -> DataFrame:
    """Persons by name and kind; every seventh row names nobody."""
    nation = table(spark, d, "nation")
    listed = nation.select(F.lower("n_name").alias("normalized_name"), F.lit("raw_per").alias("kind"), F.lit(0).alias("one")).distinct()
    people = loading.numbered(listed, "person_id", ["normalized_name"], ("one",))
    who = F.when(F.col("c_custkey") % 7 > 0, F.struct(F.concat(F.lit(" "), "n_name").alias("name"), F.lit("raw_per").alias("kind")))
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", who.alias("current_person"))
    return loading.with_persons(rows, people).select("c_custkey", F.coalesce("person_id", F.lit(-1).cast("long")).alias("person_id"))
