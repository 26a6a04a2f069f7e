"""Queries: sampling, sequence preparation, set operations and previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollforge.catalog.groups_eval import REWARDED_SQL
from rollforge.catalog.registry import q, query, rounded, sql_ids, sql_tokens
from rollforge.catalog.text_rewards import SQL_REWARD
from rollforge.functions import tokens as K
from rollforge.operators import prep as P
from rollforge.operators import reports as V
from rollforge.operators import rewards as R
from rollforge.operators import sampling as S
from rollforge.plans.storage import materialize, scratch_path
from rollforge.schemas import RECORD
from rollforge.sources import records
from rollforge.sources import tables as T


def _md5_order(key: str, seed: int = 42, group: str = "") -> str:
    over = f"PARTITION BY {group} " if group else ""
    return f"row_number() OVER ({over}ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR)), {key}) - 1"


# ------------------------------------------------------- sources and sinks

@query("scan_split", sql="SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def _(spark, sf):
    path = scratch_path(spark, "split")
    docs = T.read(spark, sf, "documents").select("doc_id", "lang", F.col("lang").alias("split"))
    docs.write.partitionBy("split").parquet(path)
    return T.read_split(spark, path, "fr").select("doc_id", "lang")


_REC = "SELECT question AS prompt, CAST(prompt_id AS VARCHAR) AS answer, '' AS instruction, '' AS input FROM problems"


def _records(spark, sf):
    return T.problems(spark, sf).select(
        F.col("question").alias("prompt"), F.col("prompt_id").cast("string").alias("answer"), "prompt_id")


@query("scan_json_records", uses=["problems"], sql=_REC)
def _(spark, sf):
    path = scratch_path(spark, "records")
    records.write_arrays(_records(spark, sf), path, "prompt_id", 5000, ["prompt", "answer"])
    return records.scan(spark, path, RECORD, recursive=True, pattern="*.txt").select(*RECORD.fieldNames())


@query("write_json_records", uses=["problems"], sql=_REC)
def _(spark, sf):
    path = scratch_path(spark, "records")
    records.write_lines(_records(spark, sf).drop("prompt_id"), path)
    return records.scan(spark, path, RECORD, lines=True).select(*RECORD.fieldNames())


@query("scan_json_props", sql="SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return records.parse_column(T.read(spark, sf, "events"), "props", "k bigint").select("event_id", "k")


@query("head_limit", sql="SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 50")
def _(spark, sf):
    return S.head_limit(T.read(spark, sf, "documents").select("doc_id", "source"), ["source", "doc_id"], 50)


@query("replicate_to_n", sql="SELECT item_id, CAST(unnest(range(20)) AS INT) AS copy, text FROM benchmark")
def _(spark, sf):
    return S.replicate(T.read(spark, sf, "benchmark").select("item_id", "text"), 20)


@query("replicate_cycle", ctes="""
b AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx, count(*) OVER () AS size FROM benchmark),
n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row FROM orders)""",
       sql="SELECT n.row, b.item_id FROM n JOIN b ON n.row % b.size = b.idx")
def _(spark, sf):
    n = T.read(spark, sf, "orders").count()
    return S.cycle_to_n(T.read(spark, sf, "benchmark").select("item_id"), "item_id", n).select("row", "item_id")


# ----------------------------------------------------------------- sampling

@query("seeded_split", uses=["problems"], sql=f"""
SELECT prompt_id, CASE WHEN p < 20 THEN 'test' ELSE 'train' END AS split, p AS position
FROM (SELECT prompt_id, {_md5_order('prompt_id')} AS p FROM problems) WHERE p < 50""")
def _(spark, sf):
    return S.seeded_split(T.problems(spark, sf).select("prompt_id"), "prompt_id", train=30, test=20).select(
        "prompt_id", "split", "position")


@query("seeded_split_large", sql=f"""
SELECT event_id, CASE WHEN p < 5000 THEN 'test' ELSE 'train' END AS split, p AS position
FROM (SELECT event_id, {_md5_order('event_id')} AS p FROM events) WHERE p < 20000""")
def _(spark, sf):
    return S.seeded_split(T.read(spark, sf, "events").select("event_id"), "event_id", train=15000, test=5000).select(
        "event_id", "split", "position")


@query("seeded_sample", sql=f"""
SELECT doc_id FROM (SELECT doc_id, {_md5_order('doc_id', 1)} AS p FROM documents) WHERE p < 100""")
def _(spark, sf):
    return S.seeded_sample(T.read(spark, sf, "documents").select("doc_id"), "doc_id", 100, seed=1).select("doc_id")


_SLOT = "CAST('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT)"


@query("fraction_split", sql=f"""
SELECT doc_id, CASE WHEN {_SLOT} < {round(0.05 * 2**32)} THEN 'test' WHEN {_SLOT} < {round(0.15 * 2**32)} THEN 'valid' ELSE 'train' END AS split FROM documents""")
def _(spark, sf):
    shares = {"test": 0.05, "valid": 0.10, "train": 0.85}
    return S.fraction_split(T.read(spark, sf, "documents").select("doc_id"), "doc_id", shares)


@query("random_k", sql=f"SELECT vec_id FROM (SELECT vec_id, {_md5_order('vec_id')} AS p FROM embeddings) WHERE p < 64")
def _(spark, sf):
    return S.random_k(T.read(spark, sf, "embeddings").select("vec_id"), "vec_id", 64)


@query("bootstrap_sample", ctes=f"""
r AS (SELECT vec_id, label < 5 AS desirable, {_md5_order('vec_id', 42, 'label < 5')} AS position FROM embeddings),
s AS (SELECT desirable, count(*) AS size FROM r GROUP BY desirable),
d AS (SELECT desirable, size, unnest(range(least(512, size))) AS draw FROM s),
p AS (SELECT desirable, draw, CAST('0x' || substr(md5('42:' || CAST(desirable AS VARCHAR) || ':' || CAST(draw AS VARCHAR)), 1, 15)
  AS BIGINT) % size AS position FROM d)""",
       sql="SELECT p.desirable, p.draw, r.vec_id FROM p JOIN r ON p.desirable = r.desirable AND p.position = r.position")
def _(spark, sf):
    e = T.read(spark, sf, "embeddings").select("vec_id", (F.col("label") < 5).alias("desirable"))
    return S.bootstrap_sample(e, "vec_id", "desirable", 512)


@query("rollout_schedule", uses=["problems"], ctes=f"""
o AS (SELECT prompt_id, {_md5_order('prompt_id')} AS p, count(*) OVER () AS n FROM problems),
k AS (SELECT prompt_id, p // 8 AS batch, p % 8 AS slot FROM o WHERE p < n // 8 * 8),
r AS (SELECT *, unnest(range(4)) AS replay FROM k), s AS (SELECT *, unnest(range(4)) AS sample_idx FROM r)""", sql="""
SELECT batch * 4 + replay AS step, batch, CAST(replay AS INT) AS replay, slot, CAST(sample_idx AS INT) AS sample_idx, prompt_id FROM s""")
def _(spark, sf):
    return S.rollout_schedule(T.problems(spark, sf), "prompt_id", generations=4, generation_batch=32, iterations=2,
                              steps_per_generation=2)


@query("kl_mismatch_pairs", uses=["unpaired"], ctes=f"""
o AS (SELECT row_id, completion, {_md5_order('row_id')} AS p, count(*) OVER () AS n FROM unpaired),
b AS (SELECT *, least(p // 8, greatest(0, (n - 2) // 8)) AS batch FROM o)""", sql="""
SELECT row_id, batch, md5(coalesce(lag(completion) OVER (PARTITION BY batch ORDER BY p),
 last_value(completion) OVER (PARTITION BY batch ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))) AS kl_completion
FROM b""")
def _(spark, sf):
    u = T.unpaired(spark, sf).select("row_id", "completion")
    return S.kl_mismatch_pairs(u, "row_id", 8).select("row_id", "batch", F.md5("kl_completion").alias("kl_completion"))


# ---------------------------------------------------------- set operations

@query("label_partition", uses=["unpaired"], sql="""
SELECT row_id, CASE WHEN label THEN 'desirable' ELSE 'undesirable' END AS part FROM unpaired""")
def _(spark, sf):
    good, bad = P.label_partition(T.unpaired(spark, sf).select("row_id", "label"))
    return good.select("row_id", F.lit("desirable").alias("part")).unionByName(
        bad.select("row_id", F.lit("undesirable").alias("part")))


@query("unpair", uses=["pairs"], sql="""
SELECT pair_id, md5(chosen) AS completion, true AS label FROM pairs UNION ALL
SELECT pair_id, md5(rejected), false FROM pairs""")
def _(spark, sf):
    return P.unpair(T.pairs(spark, sf)).select("pair_id", F.md5("completion").alias("completion"), "label")


_PREP_SQL = f"""tk AS (SELECT pair_id, pair_id % 8 AS step, {sql_tokens('prompt')} AS p,
 list_append({sql_tokens('chosen')}, 2) AS c, list_append({sql_tokens('rejected')}, 2) AS r FROM pairs)"""


def _last(a: str, n: int) -> str:
    return f"list_slice({a}, greatest(1, len({a}) - {n - 1}), len({a}))"


@query("stack_pairs", uses=["pairs"], ctes=f"""{_PREP_SQL},
s AS (SELECT pair_id, step, 'chosen' AS side, c[1:64] AS ids FROM tk UNION ALL
 SELECT pair_id, step, 'rejected', r[1:64] FROM tk),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY step) AS longest FROM s)""", sql=f"""
SELECT pair_id, side, array_to_string(list_concat(ids, list_transform(range(longest - len(ids)), lambda x: 0)), ',') AS ids,
 len(ids) AS real FROM m""")
def _(spark, sf):
    prepared = P.prep_pairs(T.pairs(spark, sf), max_prompt=32, max_completion=64).withColumn("step", F.col("pair_id") % 8)
    return P.stack_pairs(prepared, ["step"]).select(
        "pair_id", "side", K.as_text(F.col("completion_ids")).alias("ids"),
        F.expr("cast(aggregate(attention_mask, 0, (a, x) -> a + x) as bigint)").alias("real"))


# -------------------------------------------------------------- preparation

@query("build_vocab_ids", ctes=f"""
w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS token,
 generate_subscripts(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), 1) AS pos FROM documents),
v AS (SELECT token, row_number() OVER (ORDER BY md5('7:' || token), token) + 3 AS token_id FROM (SELECT DISTINCT token FROM w))""",
       sql="""SELECT d.doc_id, md5(coalesce(string_agg(CAST(token_id AS VARCHAR), ',' ORDER BY pos), '')) AS ids, count(token_id) AS n
FROM documents d LEFT JOIN (w JOIN v ON w.token = v.token) ON d.doc_id = w.doc_id GROUP BY d.doc_id""")
def _(spark, sf):
    docs = T.documents(spark, sf)
    coded = P.encode(docs, P.build_vocab(docs), "doc_id")
    return coded.select("doc_id", F.md5(K.as_text(F.col("input_ids"))).alias("ids"),
                        F.size("input_ids").cast("bigint").alias("n"))


@query("prep_pairs", uses=["pairs"], ctes=_PREP_SQL, sql=f"""
SELECT pair_id, {sql_ids(_last('list_append(list_prepend(1, p), 2)', 24))} AS prompt_ids, {sql_ids('c[1:48]')} AS chosen_ids,
 {sql_ids('r[1:48]')} AS rejected_ids FROM tk""")
def _(spark, sf):
    p = P.prep_pairs(T.pairs(spark, sf), max_prompt=24, max_completion=48, add_special=True)
    return p.select("pair_id", *[K.as_text(F.col(c)).alias(c) for c in ("prompt_ids", "chosen_ids", "rejected_ids")])


def _joint_query(mode: str) -> None:
    cut = "p[1:16]" if mode == "keep_start" else _last("p", 16)
    neg = "list_transform(p2, lambda x: -100)"

    @query("prep_pairs_joint" if mode == "keep_end" else "prep_pairs_joint_start", uses=["pairs"], ctes=f"""{_PREP_SQL},
b AS (SELECT pair_id, list_prepend(1, p) AS p, c, r, greatest(len(c), len(r)) AS longer FROM tk),
f AS (SELECT *, CASE WHEN len(p) + longer > 80 THEN {cut} ELSE p END AS p2 FROM b),
g AS (SELECT *, CASE WHEN len(p2) + longer > 80 THEN c[1:64] ELSE c END AS c2,
 CASE WHEN len(p2) + longer > 80 THEN r[1:64] ELSE r END AS r2 FROM f)""", sql=f"""
SELECT pair_id, {sql_ids('p2')} AS prompt_ids, {sql_ids('list_concat(p2, c2)')} AS chosen_ids,
 {sql_ids(f'list_concat({neg}, c2)')} AS chosen_labels, {sql_ids('list_concat(p2, r2)')} AS rejected_ids,
 {sql_ids(f'list_concat({neg}, r2)')} AS rejected_labels FROM g""")
    def _(spark, sf):
        p = P.prep_pairs_joint(T.pairs(spark, sf), max_length=80, max_prompt=16, mode=mode)
        return p.select("pair_id", *[K.as_text(F.col(c)).alias(c) for c in p.columns if c != "pair_id"])


for _mode in ("keep_end", "keep_start"):
    _joint_query(_mode)


@query("length_filter", uses=["pairs"], ctes=_PREP_SQL,
       sql="SELECT pair_id FROM tk WHERE len(c) <= 60 AND len(r) <= 60")
def _(spark, sf):
    return P.length_filter(P.prep_pairs(T.pairs(spark, sf)), 60).select("pair_id")


@query("length_filter_report", uses=["pairs"], ctes=_PREP_SQL, sql="""
SELECT count(*) FILTER (WHERE len(c) <= 60 AND len(r) <= 60) AS kept,
 count(*) FILTER (WHERE NOT (len(c) <= 60 AND len(r) <= 60)) AS dropped FROM tk""")
def _(spark, sf):
    return P.length_filter_report(P.prep_pairs(T.pairs(spark, sf)), 60)


@query("bos_if_missing", uses=["token_rows"], ctes="""
t AS (SELECT seq_id, list(CASE WHEN pos = 0 AND seq_id % 3 = 0 THEN 1 ELSE token_id END ORDER BY pos) AS ids
 FROM token_rows GROUP BY seq_id)""", sql="""
SELECT seq_id, array_to_string(CASE WHEN ids[1] = 1 THEN ids ELSE list_prepend(1, ids) END, ',') AS ids FROM t""")
def _(spark, sf):
    ids = F.expr("transform(token_ids, (x, i) -> if(i = 0 and seq_id % 3 = 0, 1L, x))")
    return T.sequences(spark, sf).select("seq_id", K.as_text(K.ensure_bos(ids)).alias("ids"))


_STEP_PROMPTS = "(SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY conv_id)"


def _steps_query(last_only: bool) -> None:
    label = "CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN CAST(label AS BIGINT) ELSE -100 END" if last_only else "CAST(label AS BIGINT)"

    @query("prep_steps_last" if last_only else "prep_steps", uses=["steps"], ctes=f"""
e AS (SELECT conv_id, turn, list_append({sql_tokens('step_text')}, 3) AS ids, {label} AS lab FROM steps),
l AS (SELECT *, list_append(list_transform(range(len(ids) - 1), lambda x: CAST(-100 AS BIGINT)), lab) AS labs FROM e),
j AS (SELECT conv_id, flatten(list(ids ORDER BY turn))[1:200] AS ids, flatten(list(labs ORDER BY turn))[1:200] AS labs FROM l GROUP BY conv_id),
w AS (SELECT conv_id, list_prepend(1, {sql_tokens('prompt')}) AS p0 FROM {_STEP_PROMPTS}),
k AS (SELECT conv_id, {_last('p0', 20)} AS p FROM w)""", sql="""
SELECT j.conv_id, array_to_string(list_concat(p, ids)[1:210], ',') AS input_ids,
 array_to_string(list_concat(list_transform(p, lambda x: -100), labs)[1:210], ',') AS labels
FROM j JOIN k ON j.conv_id = k.conv_id""")
    def _(spark, sf):
        turns = T.read(spark, sf, "conversations").where(F.col("role") == "user")
        prompts = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt"))
        s = P.prep_steps(T.steps(spark, sf), prompts, "conv_id", [3], max_length=210, max_prompt=20,
                         max_completion=200, last_step_only=last_only)
        return s.select("conv_id", K.as_text(F.col("input_ids")).alias("input_ids"),
                        K.as_text(F.col("labels")).alias("labels"))


for _flag in (False, True):
    _steps_query(_flag)


@query("prep_texts", sql=f"""
SELECT doc_id, md5(array_to_string(ids[1:256], ',')) AS ids, least(256, len(ids)) AS n FROM
 (SELECT doc_id, {sql_tokens('text')} AS ids FROM documents)""")
def _(spark, sf):
    p = P.prep_texts(T.documents(spark, sf), "text", 256)
    return p.select("doc_id", F.md5(K.as_text(F.col("input_ids"))).alias("ids"),
                    F.size("input_ids").cast("bigint").alias("n"))


def _truncate_query(mode: str) -> None:
    def cut(a):
        return f"{a}[1:70]" if mode == "keep_start" else _last(a, 70)

    @query("truncate_total" if mode == "keep_start" else "truncate_total_end", uses=["pairs"], ctes=f"""{_PREP_SQL},
a AS (SELECT pair_id, list_concat(p, c) AS ids, list_concat(list_transform(p, lambda x: 0), list_transform(c, lambda x: 1)) AS m FROM tk)""",
           sql=f"SELECT pair_id, {sql_ids(cut('ids'))} AS input_ids, {sql_ids(cut('m'))} AS loss_mask FROM a")
    def _(spark, sf):
        p = P.prep_pairs(T.pairs(spark, sf)).select("pair_id", "prompt_ids", "chosen_ids")
        t = P.truncate_total(p, "prompt_ids", "chosen_ids", 70, mode)
        return t.select("pair_id", K.as_text(F.col("input_ids")).alias("input_ids"),
                        K.as_text(F.col("loss_mask")).alias("loss_mask"))


for _mode in ("keep_start", "keep_end"):
    _truncate_query(_mode)

_IDS_SQL = "ids AS (SELECT seq_id, run_id, step, list(token_id ORDER BY pos) AS a FROM token_rows GROUP BY seq_id, run_id, step)"


@query("pad_sequences", uses=["token_rows"], ctes=f"""{_IDS_SQL},
m AS (SELECT *, max(len(a)) OVER (PARTITION BY run_id, step) AS longest FROM ids),
p AS (SELECT seq_id, list_concat(list_transform(range(longest - len(a)), lambda x: 0), a) AS a FROM m)""", sql="""
SELECT seq_id, array_to_string(a, ',') AS ids,
 array_to_string(list_transform(a, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), ',') AS mask FROM p""")
def _(spark, sf):
    s = T.sequences(spark, sf).select("seq_id", "run_id", "step", "token_ids")
    p = P.pad_sequences(s, "token_ids", ["run_id", "step"], "left")
    return p.select("seq_id", K.as_text(F.col("token_ids")).alias("ids"), K.as_text(F.col("attention_mask")).alias("mask"))


@query("left_pack", uses=["token_rows"], ctes=f"""{_IDS_SQL},
l AS (SELECT seq_id, list_concat([0, 0], a) AS a FROM ids)""", sql="""
SELECT seq_id, array_to_string(list_concat(list_filter(a, lambda x: x <> 0), list_filter(a, lambda x: x = 0)), ',') AS ids FROM l""")
def _(spark, sf):
    return T.sequences(spark, sf).select(
        "seq_id", K.as_text(K.pads_last(F.concat(K.ids(0, 0), "token_ids"))).alias("ids"))


@query("completion_mask", uses=["token_rows"], ctes=f"""{_IDS_SQL},
p AS (SELECT *, list_concat(list_transform(range(seq_id % 4), lambda x: 0), a) AS b FROM ids),
l AS (SELECT *, len(list_filter(b[1:len(b) - 4], lambda x: x = 0)) AS pads, b[len(b) - 3:len(b)] AS tail FROM p),
w AS (SELECT *, max(pads) OVER (PARTITION BY run_id, step) AS widest FROM l)""", sql="""
SELECT seq_id, array_to_string(list_transform(range(len(tail)), lambda i: CASE WHEN i >= widest - pads AND tail[i + 1] <> 0
 THEN 1 ELSE 0 END), ',') AS mask FROM w""")
def _(spark, sf):
    s = T.sequences(spark, sf).select(
        "seq_id", "run_id", "step",
        F.concat(K.repeat(0, F.col("seq_id") % 4), "token_ids").alias("ids"))
    return P.completion_masks(s, "ids", 4, ["run_id", "step"]).select(
        "seq_id", K.as_text(F.col("completion_mask")).alias("mask"))


@query("first_stop_truncate", uses=["token_rows"], ctes="""
f AS (SELECT seq_id, min(pos) FILTER (WHERE token_id = 2) AS stop FROM token_rows GROUP BY seq_id)""", sql="""
SELECT t.seq_id, string_agg(CASE WHEN stop IS NULL OR pos <= stop THEN CAST(token_id AS VARCHAR) END, ',' ORDER BY pos) AS ids,
 string_agg(CASE WHEN stop IS NOT NULL AND pos <= stop THEN '1' ELSE '0' END, ',' ORDER BY pos) AS mask
FROM token_rows t JOIN f ON t.seq_id = f.seq_id GROUP BY t.seq_id""")
def _(spark, sf):
    a = F.col("token_ids")
    return T.sequences(spark, sf).select(
        "seq_id", K.as_text(K.until_stop(a)).alias("ids"),
        K.as_text(K.stop_mask(a, drop_unfinished=True)).alias("mask"))


@query("response_length", uses=["token_rows"], sql="""
SELECT seq_id, CAST(count(*) FILTER (WHERE token_id NOT IN (0, 2)) AS INT) AS length FROM token_rows GROUP BY seq_id""")
def _(spark, sf):
    return T.sequences(spark, sf).select("seq_id", K.count_real(F.col("token_ids")).alias("length"))


@query("position_ids", uses=["token_rows"], sql="""
SELECT seq_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS ids FROM token_rows GROUP BY seq_id""")
def _(spark, sf):
    return T.sequences(spark, sf).select("seq_id", K.as_text(K.positions(F.col("token_ids"))).alias("ids"))


@query("shift_labels", uses=["token_rows"], sql="""
SELECT seq_id, pos, lead(token_id) OVER (PARTITION BY seq_id ORDER BY pos) AS label FROM token_rows""")
def _(spark, sf):
    shifted = T.sequences(spark, sf).select("seq_id", K.next_tokens(F.col("token_ids")).alias("labels"))
    return shifted.select("seq_id", F.posexplode("labels").alias("pos", "label"))


@query("pack_sequences", ctes=f"""
n AS (SELECT greatest(1, CAST(ceil(count(*) / 400e0) AS BIGINT)) AS shards FROM documents),
t AS (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % shards AS shard,
 {sql_tokens('text')} AS ids FROM documents CROSS JOIN n),
u AS (SELECT shard, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM t),
o AS (SELECT shard, id, row_number() OVER (PARTITION BY shard ORDER BY doc_id, pos) - 1 AS spot FROM u)""", sql="""
SELECT shard, spot // 512 AS block, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY spot)) AS ids, count(*) AS n
FROM o GROUP BY shard, spot // 512""")
def _(spark, sf):
    docs = T.read(spark, sf, "documents")
    ids = P.prep_texts(T.documents(spark, sf), "text", None)
    packed = P.pack_wrapped(ids, "doc_id", "input_ids", 512, P.shard_count(docs, 400))
    return packed.select("shard", "block", F.md5(K.as_text(F.col("input_ids"))).alias("ids"),
                         F.size("input_ids").cast("bigint").alias("n"))


@query("pack_sequences_bfd")
def _(spark, sf):
    ids = P.prep_texts(T.documents(spark, sf), "text", None)
    packed = P.pack_best_fit(ids, "doc_id", "input_ids", 512)
    return packed.select("block", F.md5(K.as_text(F.col("input_ids"))).alias("ids"), F.size("input_ids").cast("bigint").alias("n"))


# ----------------------------------------------------------------- previews

@query("sample_table", uses=["rollouts"], ctes=f"""{REWARDED_SQL},
k AS (SELECT *, row_number() OVER (PARTITION BY run_id, step ORDER BY prompt_id, sample_idx) AS rank FROM rewarded)""", sql="""
SELECT run_id, step, 'Sample ' || CAST(rank AS VARCHAR) AS sample,
 CASE WHEN length(prompt) > 100 THEN substr(prompt, 1, 100) || '...' ELSE prompt END AS prompt,
 CASE WHEN length(response) > 200 THEN substr(response, 1, 200) || '...' ELSE response END AS response,
 printf('%.4f', reward) AS reward FROM k WHERE rank <= 5""")
def _(spark, sf):
    top = V.top_rows(T.rollouts(spark, sf), ["run_id", "step"], ["prompt_id", "sample_idx"], 5)
    return V.sample_table(R.combine(R.score(top, R.STANDARD), R.STANDARD), ["run_id", "step"])


_ROW = "run_id, step, prompt_id, sample_idx"
KEYS = ["run_id", "step", "prompt_id", "sample_idx"]
NAMES = [s.name for s in R.STANDARD]


@query("completions_table", uses=["rollouts"], ctes=REWARDED_SQL, sql=f"""
SELECT {_ROW}, {', '.join(q(SQL_REWARD[f], n) for n, f in [('correctness', 'correctness'), ('digit', 'digit'),
 ('format', 'format_partial'), ('marks', 'marks')])},
 {q('''(reward - avg(reward) OVER g) / (CASE WHEN stddev_samp(reward) OVER g = 0 THEN 1e0 ELSE stddev_samp(reward) OVER g END + 1e-8)''', 'advantage')}
FROM rewarded WINDOW g AS (PARTITION BY run_id, step, prompt_id)""")
def _(spark, sf):
    scored = R.combine(R.score(T.rollouts(spark, sf), R.STANDARD), R.STANDARD)
    kept = materialize(scored.select(*KEYS, "reward", *[f"reward_{n}" for n in NAMES]), "scored")
    t = V.completions_table(kept, KEYS, NAMES)
    return t.select(*KEYS, *[rounded(n) for n in NAMES], rounded("advantage"))


@query("completions_table_long", uses=["rollouts"], sql=f"""
SELECT {_ROW}, {', '.join(q(SQL_REWARD[f], n) for n, f in [('correctness', 'correctness'), ('digit', 'digit'),
 ('format', 'format_partial'), ('marks', 'marks')])} FROM rollouts""")
def _(spark, sf):
    long = R.long_rewards(R.score(T.rollouts(spark, sf), R.STANDARD), R.STANDARD, KEYS)
    return V.pivot_rewards(long, KEYS, NAMES).select(*KEYS, *[rounded(n) for n in NAMES])


@query("unique_prompts", uses=["rollouts"], sql="""
SELECT prompt, prompt_id, sample_idx FROM (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY prompt_id, sample_idx) AS k
 FROM rollouts) WHERE k = 1""")
def _(spark, sf):
    r = T.rollouts(spark, sf).select("prompt", "prompt_id", "sample_idx")
    return V.first_rows(r, ["prompt"], ["prompt_id", "sample_idx"])


@query("unique_documents", sql="SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(spark, sf):
    named = T.read(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("name"))
    return V.first_rows(named, ["name"], ["doc_id"]).select("doc_id")


@query("game_log", uses=["pairs"], ctes=f"""
g AS (SELECT pair_id, prompt, chosen, rejected, {_md5_order('pair_id')} AS p FROM pairs)""", sql="""
SELECT pair_id, md5(prompt) AS prompt, md5(chosen) AS policy, md5(rejected) AS reference FROM g WHERE p < 25""")
def _(spark, sf):
    p = T.pairs(spark, sf).select("pair_id", "prompt", F.concat("prompt", "chosen").alias("policy"),
                                  F.concat("prompt", "rejected").alias("reference"))
    return V.game_log(p, "pair_id", 25).select(
        "pair_id", *[F.md5(c).alias(c) for c in ("prompt", "policy", "reference")])


_SC, _SR = "length(chosen) % 13 / 4e0", "length(rejected) % 11 / 4e0"


def _scored_pairs(spark, sf):
    return T.pairs(spark, sf).withColumns({
        "score_chosen": F.length("chosen") % 13 / F.lit(4.0), "score_rejected": F.length("rejected") % 11 / F.lit(4.0)})


@query("scored_pair_preview", uses=["pairs"], sql=f"""
SELECT pair_id, md5(chosen) AS chosen, md5(rejected) AS rejected, round(1 / (1 + exp({_SR} - {_SC})), 4) AS p_chosen,
 round(1 / (1 + exp({_SC} - {_SR})), 4) AS p_rejected FROM pairs ORDER BY pair_id LIMIT 20""")
def _(spark, sf):
    return V.scored_pair_preview(_scored_pairs(spark, sf), "pair_id", 20).select(
        "pair_id", F.md5("chosen").alias("chosen"), F.md5("rejected").alias("rejected"), "p_chosen", "p_rejected")


@query("scored_query_preview", uses=["token_rows"], ctes="""
f AS (SELECT seq_id, min(pos) FILTER (WHERE token_id = 2) AS stop FROM token_rows GROUP BY seq_id)""", sql=f"""
SELECT t.seq_id, string_agg(CASE WHEN is_prompt = 1 THEN CAST(token_id AS VARCHAR) END, ',' ORDER BY pos) AS query,
 string_agg(CASE WHEN stop IS NULL OR pos <= stop THEN CAST(token_id AS VARCHAR) END, ',' ORDER BY pos) AS response,
 {q('max(score)', 'score')} FROM token_rows t JOIN f ON t.seq_id = f.seq_id GROUP BY t.seq_id ORDER BY t.seq_id LIMIT 5""")
def _(spark, sf):
    s = T.sequences(spark, sf).select(
        "seq_id", K.as_text(F.expr("filter(token_ids, (x, i) -> is_prompts[i] = 1)")).alias("query"),
        K.as_text(K.until_stop(F.col("token_ids"))).alias("response"), "score")
    return V.scored_query_preview(s, "seq_id", 5).withColumn("score", rounded("score"))
