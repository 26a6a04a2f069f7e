"""Queries: streaming jobs run over the whole table as a closed input."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollforge.catalog.groups_eval import REWARDED_SQL
from rollforge.catalog.registry import q, query, rounded
from rollforge.operators import rewards as R
from rollforge.plans.storage import materialize, scratch_path
from rollforge.sources import tables as T
from rollforge.streaming import jobs as S
from rollforge.streaming.groups import group_results_to


def _orders(spark, sf):
    return S.read_table(spark, sf, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp"))


def _scored(spark, sf):
    return S.score(T.rollouts_of(_orders(spark, sf), "ts"), R.STANDARD)


def _events(spark, sf):
    events = S.read_table(spark, sf, "events")
    return events.select(F.col("user_id").alias("run_id"), F.col("ts").cast("timestamp").alias("ts"),
                         F.col("event_type").alias("name"), "value")


@query("stream_score", uses=["rollouts"], ctes=REWARDED_SQL,
       sql=f"SELECT run_id, step, prompt_id, sample_idx, {q('reward', 'reward')} FROM rewarded")
def _(spark, sf):
    scored = _scored(spark, sf).select("run_id", "step", "prompt_id", "sample_idx", "reward")
    return S.run_append(scored, "score").withColumn("reward", rounded("reward"))


def _windows(name: str, slide: int | None) -> None:
    if slide is None:
        starts = "SELECT time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS start, name, value FROM metrics"
    else:
        starts = (f"SELECT time_bucket(INTERVAL {slide} MINUTE, ts, TIMESTAMP '1970-01-01') - to_minutes(k * {slide}) AS start, name, value"
                  f" FROM metrics CROSS JOIN (SELECT unnest(range({10 // slide})) AS k)")

    @query(name, uses=["metrics"], ctes=f"w AS ({starts})", sql=f"""
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, name, {q('avg(value)', 'avg')}, {q('min(value)', 'min')},
 {q('max(value)', 'max')}, count(value) AS n FROM w GROUP BY w.start, name""")
    def _(spark, sf):
        stream = S.metric_windows(_events(spark, sf), slide=f"{slide} minutes" if slide else None)
        out = S.run_update(stream, "windows", ["start", "end", "name"])
        return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "name",
                          rounded("avg"), rounded("min"), rounded("max"), "n")


_windows("stream_metric_windows", None)
_windows("stream_metric_windows_sliding", 5)


# Arrivals in four waves, each a run of the stream that continues the last: samples 0, 3, 6 ... on day 0,
# samples 1, 4, 7 ... on day 1, the others half an hour later or, of every fourth prompt, too late; every tenth
# prompt comes as a whole on day 10, which lets the groups that still wait expire.
WAVE = "CASE WHEN prompt_id % 10 = 9 THEN 3 ELSE sample_idx % 3 END"
ARRIVAL = (
    "timestamp'2024-01-01 00:00:00' + make_dt_interval(CASE wave WHEN 0 THEN 0 WHEN 3 THEN 10 "
    "WHEN 2 THEN CASE WHEN prompt_id % 4 = 0 THEN 0 ELSE 1 END ELSE 1 END, "
    "CASE WHEN wave = 2 AND prompt_id % 4 = 0 THEN 2 ELSE 0 END, CASE WHEN wave = 2 AND prompt_id % 4 <> 0 THEN 30 ELSE 0 END)"
)
GROUP = ["run_id", "step", "prompt_id"]


def _group_results(spark, sf):
    """Results of the four waves, from one stream whose state outlives each run."""
    scored = R.combine(R.score(T.rollouts_of(T._orders(spark, sf)), R.STANDARD), R.STANDARD)
    waves = scored.select(*GROUP, "n", "reward", F.expr(WAVE).alias("wave"))
    waves = materialize(waves.withColumn("ts", F.expr(ARRIVAL)), "arrivals")
    base = scratch_path(spark, "groups")
    schema = waves.drop("wave").schema
    for wave in range(4):
        waves.where(F.col("wave") == wave).drop("wave").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        group_results_to(stream, f"{base}/out", f"{base}/state", GROUP).awaitTermination()
    return spark.read.parquet(f"{base}/out")


_OPEN = "prompt_id % 10 <> 9 AND prompt_id % 4 = 0 AND count(*) >= 3"


@query("stream_group_stats", uses=["rollouts"], ctes=REWARDED_SQL, sql=f"""
SELECT run_id, step, prompt_id, {q('avg(reward)', 'mean')}, {q('stddev_samp(reward)', 'std')}, count(*) AS seen
FROM rewarded GROUP BY run_id, step, prompt_id HAVING NOT ({_OPEN})""")
def _(spark, sf):
    out = _group_results(spark, sf).where("kind = 'complete'")
    return out.select(*GROUP, rounded("mean"), rounded("std"), "seen")


_LEFT_SQL = f"""{REWARDED_SQL}, w AS (SELECT *, sample_idx % 3 = 2 AS late FROM rewarded),
 g AS (SELECT run_id, step, prompt_id, count(*) AS expected, count(*) FILTER (WHERE NOT late) AS seen,
  count(*) FILTER (WHERE late) AS n_late, avg(reward) FILTER (WHERE NOT late) AS mean,
  stddev_samp(reward) FILTER (WHERE NOT late) AS std FROM w GROUP BY run_id, step, prompt_id HAVING {_OPEN})"""


@query("stream_group_leftovers", uses=["rollouts"], ctes=_LEFT_SQL, sql=f"""
SELECT run_id, step, prompt_id, 'expired' AS kind, seen, expected, {q('mean', 'mean')}, {q('std', 'std')} FROM g
UNION ALL SELECT run_id, step, prompt_id, 'late', n_late, NULL, NULL, NULL FROM g""")
def _(spark, sf):
    out = _group_results(spark, sf).where("kind <> 'complete'")
    return out.select(*GROUP, "kind", "seen", "expected", rounded("mean"), rounded("std"))


@query("stream_running_moments", uses=["metrics"], sql=f"""
SELECT run_id, count(value) AS n, {q('sum(value)', 'sum')}, {q('sum(value * value)', 'sum_sq')}, {q('avg(value)', 'mean')}
FROM metrics GROUP BY run_id""")
def _(spark, sf):
    out = S.run_update(S.running_moments(_events(spark, sf), "run_id", "value"), "moments", ["run_id"])
    return out.select("run_id", "n", rounded("sum"), rounded("sum_sq"), rounded("mean"))


@query("stream_tokens_seen", uses=["rollouts"], sql="""
SELECT run_id, CAST(sum(length(response)) AS BIGINT) AS tokens_seen FROM rollouts GROUP BY run_id""")
def _(spark, sf):
    r = T.rollouts_of(_orders(spark, sf)).select("run_id", F.length("response").alias("n"))
    return S.run_update(S.tokens_seen(r, "run_id", "n"), "tokens", ["run_id"])


@query("stream_unique_prompts", uses=["rollouts"], sql="""
SELECT prompt, min(sample_idx) AS sample_idx, CAST(1 AS BIGINT) AS times FROM rollouts GROUP BY prompt""")
def _(spark, sf):
    """Each sample number of a prompt arrives in a run of its own, months apart."""
    r = T.rollouts_of(T._orders(spark, sf)).select("prompt", "sample_idx", "response")
    r = materialize(r.withColumn("ts", F.expr("timestamp'2024-01-01 00:00:00' + make_ym_interval(0, sample_idx)")), "completions")
    base = scratch_path(spark, "unique")
    for part in (r.where("sample_idx % 2 = 0"), r.where("sample_idx % 2 = 1")):
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(r.schema).parquet(f"{base}/in")
        S.unique_to(stream, f"{base}/out", f"{base}/state", order=("ts", "response")).awaitTermination()
    out = spark.read.schema(r.schema).parquet(f"{base}/out")
    return out.groupBy("prompt").agg(F.min("sample_idx").alias("sample_idx"), F.count(F.lit(1)).alias("times"))
