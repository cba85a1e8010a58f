"""The registered queries of this subpackage: thin callers of its operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import chat, decontaminate, idfiles, packing, periodic, pieces, quality, shards, simhash, syncmers, toxicity, unigram, whitening
from cardlake.llm.common import id_remainder, stored
from cardlake.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scored(result: DataFrame, n: int, held: int) -> DataFrame:
    return result.select("doc_id", (id_remainder("doc_id", n) == held).alias("held_out"), "score", "predicted")


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(_table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _scored(toxicity.scores(docs, toxicity.trained(docs, _table(spark, sf_dir, "labels"))), 5, 0)


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard(_table(spark, sf_dir, "documents"), scratch_dir(spark, "slot-map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"))


def op5_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "id-files")
    idfiles.write(_table(spark, sf_dir, "documents"), path)
    return idfiles.read(spark, path, ids=False)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    windows = stored(chat.windows_of(given.unionByName(extra)), "chat-windows")
    turns = F.array_sort(F.flatten(F.collect_list("turns")))  # by place in the conversation
    return chat.turns_from(windows).groupBy("conv_id").agg(turns.alias("t"), F.sum("chars").alias("formatted_chars")) \
        .select("conv_id", F.size("t").cast("long").alias("n_turns"),
                F.sha2(F.array_join(F.transform("t", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
                F.array_join("t.loss", "").alias("loss"), "formatted_chars") \
        .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _scored(quality.scores(docs, quality.trained(docs, _table(spark, sf_dir, "labels"))), 3, 1)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(_table(spark, sf_dir, "documents"), keep=())


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


#: The query's own rule: of a tenth of the documents, words from a on repeat the p words that begin there.
_REPEATED = _let(r"regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0)", "w",
                 "if(size(w) = 0, '', " + _let("cast(g % size(w) as int)", "a", _let(
                     "cast(1 + (size(w) - a) div (3 + g % 8) as int)", "p",
                     "array_join(transform(w, (x, i) -> if(i >= a, get(w, a + (i - a) % p), x)), ' ')")) + ")")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h")).withColumn("g", F.expr("h div 10"))
    found = periodic.periodic_runs(docs.withColumn("text", F.when(F.expr("h % 10 = 0"), F.expr(_REPEATED)).otherwise(F.col("text"))))
    best = F.expr("array_min(transform(runs, r -> struct(-r.length as l, r.start as start, r.period as period)))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.select("*", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * -best.l div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.pieces(_table(spark, sf_dir, "documents"))) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fitted, error = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    share = F.array(*[F.lit(x).cast("double") for x in fitted.explained()]) if fitted else F.array().cast("array<double>")
    each = F.posexplode("whitened").alias("at", "whitened")
    return rows.select("vec_id", F.expr("try_cast(deviation as bigint)").alias("deviation"), share.alias("share"), each).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n if fitted else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get("share", F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_syncmers": op1_syncmers,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_virtual_slots": op4_virtual_slots,
    "op5_id_files": op5_id_files,
    "op6_simhash": op6_simhash,
    "op7_chat_windows": op7_chat_windows,
    "op8_winnowing": op8_winnowing,
    "op9_quality": op9_quality,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_best_fit": op12_best_fit,
    "op13_whitening": op13_whitening,
}

#: The windows' contents need no SQL of their own: what is read back is the conversations' turns; only the formatted
#: length depends on the windows, so they are built here as well.
CHAT_SQL = """
with recursive given as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
turns as (
    select *, ceil((strlen(role) + strlen(text)) / 4.0)::bigint + 4 as tokens,
           row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as seq,
           length(role) + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) + 24 as chars from given),
heads as (select conv_id, tokens as system_tokens, chars as system_chars from turns where seq = 1 and role = 'system'),
body as (
    select t.*, coalesce(system_tokens, 0) as system_tokens,
           sum(tokens) over (partition by t.conv_id order by seq) - tokens as before,
           sum(tokens) over (partition by t.conv_id) as total,
           2048 - 256 - coalesce(system_tokens, 0) as reach, floor(coalesce(turn, -1) / 1024) as block,
           row_number() over (partition by t.conv_id order by seq) as n
    from turns t left join heads h on t.conv_id = h.conv_id where not (seq = 1 and role = 'system')),
walk as (
    select conv_id, n, block, tokens as used, n as win from body where n = 1
    union all
    select b.conv_id, b.n, b.block, b.tokens + case when b.block = w.block and w.used + b.tokens <= b.reach then w.used else 0 end,
           case when b.block = w.block and w.used + b.tokens <= b.reach then w.win else b.n end
    from walk w join body b on b.conv_id = w.conv_id and b.n = w.n + 1),
dealt as (
    select b.*, win, max(before + b.tokens) over (partition by b.conv_id, win) as stop
    from body b join walk w on b.conv_id = w.conv_id and b.n = w.n),
lengths as (
    select conv_id, sum(chars) + sum(case when stop < total and stop - before <= 256 then chars else 0 end) as chars,
           count(distinct win) as wins from dealt group by conv_id),
said as (
    select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by seq) as turns,
           coalesce(string_agg(text, '' order by seq) filter (where role = 'assistant'), '') as loss from turns group by conv_id)
select s.conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       (coalesce(l.chars, 0) + coalesce(system_chars, 0) * coalesce(l.wins, 1))::bigint as formatted_chars
from said s left join lengths l on s.conv_id = l.conv_id left join heads h on s.conv_id = h.conv_id
"""

ORACLE_SQL: dict[str, str] = {"op7_chat_windows": CHAT_SQL}
