"""Chat formatting in budgeted windows, in DataFrame operations.

A conversation's turns are put into windows of at most ``BUDGET`` tokens that
begin and end with a turn. Prefix sums of the turns' tokens choose the spans: a
turn joins the window of the turn before it while the window's own turns fit
beside system turn and history, and begins the next window otherwise. So only
a single turn that does not fit beside the system turn makes a window exceed
the budget; it is marked ``over_budget``, since turns are never cut.

Every window begins with the conversation's system turn (its first turn, if
of role ``system``) and repeats up to ``HISTORY`` tokens of the turns before
it, unless it would exceed the budget with them. Assistant texts are training targets once: the mask (``spans``) has no
target in a repeated turn.

The template is ``<|im_start|>role`` + line end + text + ``<|im_end|>`` + line
end. In texts, ``\\`` is doubled and then ``<|`` becomes ``<\\|``, which is
undone in the reverse order; so no text can contain a control string. A role's
line ends become ``<|nl|>``.

Tokens are counted as a quarter of the UTF-8 bytes of role and text, rounded
up, and 4 for the template; ``tokens`` takes another expression.

Prefix sums run in blocks of ``BLOCK`` turn numbers and over blocks, and a
block begins with a window of its own, so a conversation with a large share of
all rows is many tasks' work. A block of more rows than that (repeated turn
numbers, as of rows without a conversation) is cut by turn, role and ranges of
the text's MD5; only rows alike in all of these stay together.

Defined cases: NULL texts and roles count as empty; very long texts are turns
like others; turns are ordered by turn (NULL first), role, the text's MD5; repeated rows are turns of their own; extra columns
are ignored; NULL conversation ids are one conversation; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY, BLOCK = 2048, 256, 1024
OPEN, CLOSE, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def turns_of(conversations: DataFrame, tokens: Column | None = None) -> DataFrame:
    """Turns with tokens, their conversation's key (``conv_id`` without NULL), their block, and place and tokens so far in it.

    Counts the rows of the blocks first: only if there are full ones, these are cut.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    tokens = tokens if tokens is not None else F.ceil((F.octet_length(role) + F.octet_length(text)) / 4) + 4
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    t = conversations.select("conv_id", key.alias("key"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                             tokens.cast("long").alias("tokens")) \
        .withColumn("of", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK)).withColumn("md5", F.md5("text"))
    full = t.groupBy("key", "of").agg(F.ceil(F.count("*") / BLOCK).alias("ranges")).where("ranges > 1")
    t = t.withColumn("ranges", F.lit(None).cast("long")) if full.isEmpty() else t.join(full, ["key", "of"], "left")
    cut = F.col("ranges").isNotNull()
    place = F.floor(F.conv(F.substring("md5", 1, 8), 16, 10).cast("long") * F.col("ranges") / (1 << 32))
    t = t.select("conv_id", "key", "turn", "role", "text", "tokens", "md5", F.struct(
        "of", F.when(cut, F.col("turn")).alias("turn"), F.when(cut, F.col("role")).alias("role"), F.when(cut, place).alias("range")).alias("block"))
    in_block = Window.partitionBy("key", "block").orderBy("turn", "role", "md5")
    return t.withColumn("place", F.row_number().over(in_block)) \
        .withColumn("upto", F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))


#: The places in a block that begin a window: turns are added to a window while they fit into what the budget leaves them.
_STARTS = """aggregate(turns, named_struct('used', 0L, 'starts', cast(array() as array<int>)),
    (a, x) -> if(size(a.starts) = 0 or a.used + x.tokens > reach,
                 named_struct('used', x.tokens, 'starts', concat(a.starts, array(x.place))),
                 named_struct('used', a.used + x.tokens, 'starts', a.starts)),
    a -> a.starts)"""


def blocks_of(turns: DataFrame, reach: int) -> DataFrame:
    """key, block: tokens before it, the places that begin a window, and the number of its first window; of the
    conversation the tokens of the system turn and of all others."""
    blocks = turns.groupBy("key", "block").agg(
        F.sum("tokens").alias("sum"), F.count("*").alias("n"),
        F.max(F.when((F.col("place") == 1) & (F.col("role") == "system"), F.col("tokens"))).alias("system"),
        F.array_sort(F.collect_list(F.struct("place", "tokens"))).alias("turns"))
    over = Window.partitionBy("key").orderBy("block")
    past, whole = over.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("key")
    sums = blocks.drop("turns").select(
        "key", "block", F.coalesce(F.sum("sum").over(past), F.lit(0)).alias("sum_before"), F.coalesce(F.sum("n").over(past), F.lit(0)).alias("n_before"),
        F.coalesce(F.first("system").over(over), F.lit(0)).alias("system_tokens"), F.first("system").over(over).isNotNull().alias("has_head"),
        F.sum("sum").over(whole).alias("sum_all"), F.sum("n").over(whole).alias("n_all"))
    b = blocks.select("key", "block", "turns").join(sums, ["key", "block"]) \
        .withColumn("first", F.col("has_head") & (F.col("n_before") == 0)) \
        .withColumn("turns", F.expr("if(first, slice(turns, 2, size(turns)), turns)")) \
        .withColumn("reach", F.lit(reach) - F.col("system_tokens")).withColumn("starts", F.expr(_STARTS)).drop("turns")
    # a system turn alone is a window too
    b = b.withColumn("windows", F.when(F.col("n_all") == 1, 1).otherwise(F.size("starts")))
    opened = b.select("key", "block", F.coalesce(F.sum("windows").over(past), F.lit(0)).alias("window_before"))
    return b.join(opened, ["key", "block"])


def windows_of(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """conv_id, window, text, tokens, over_budget, and the spans of the turns in the text.

    A span has the turn's place (``seq``), the 1-based start and the length in
    code points of role and text, ``repeated`` and ``target``.
    """
    if history * 4 > budget:
        raise ValueError("history is limited to a quarter of the budget")
    turns = turns_of(conversations, tokens)
    blocks = blocks_of(turns, budget - history)
    head = F.col("first") & (F.col("place") == 1)
    t = turns.join(blocks, ["key", "block"]).select(
        "conv_id", "key", (F.col("n_before") + F.col("place")).alias("seq"), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(LINE)).alias("role"),
        escaped(F.col("text")).alias("text"), (F.col("role") == "assistant").alias("assistant"), "tokens", head.alias("head"),
        (F.col("sum_before") + F.col("upto") - F.col("tokens") - F.col("system_tokens")).alias("before"),
        (F.col("sum_all") - F.col("system_tokens")).alias("total"),
        F.expr("window_before + size(filter(starts, s -> s <= place)) - 1").alias("window"))
    own = t.where("NOT head").withColumn("end", F.max(F.col("before") + F.col("tokens")).over(Window.partitionBy("key", "window")))
    recalled = (F.col("end") < F.col("total")) & (F.col("end") - F.col("before") <= history)
    # each turn once as itself and, near a window's end, once as the next window's history; the system turn in every window
    itself, again = (F.struct((F.col("window") + k).alias("window"), F.lit(k > 0).alias("repeated")) for k in (0, 1))
    columns = ["conv_id", "key", "window", "repeated", "seq", "role", "text", "tokens", "assistant", "head"]
    rows = own.withColumn("u", F.explode(F.when(recalled, F.array(itself, again)).otherwise(F.array(itself)))) \
        .withColumn("window", F.col("u.window")).withColumn("repeated", F.col("u.repeated")).select(columns)
    every = blocks.where("has_head AND windows > 0").select("key", F.explode(F.expr(
        "sequence(window_before, window_before + windows - 1)")).alias("window")).withColumn("repeated", F.col("window") > 0)
    heads = t.where("head").select(*(c for c in columns if c not in ("window", "repeated")))
    rows = rows.unionByName(every.join(heads, "key").select(columns))
    # history is left out of a window that would exceed the budget with it
    full = F.sum("tokens").over(Window.partitionBy("key", "window"))
    rows = rows.withColumn("full", full).where(~F.col("repeated") | F.col("head") | (F.col("full") <= budget)).drop("full")
    piece = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(CLOSE))
    in_window = Window.partitionBy("key", "window").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("piece", piece).withColumn("at", F.coalesce(F.sum(F.length("piece")).over(in_window), F.lit(0)) + len(OPEN) + 1)
    span = F.struct("seq", "piece", F.col("at").cast("int").alias("role_at"), F.length("role").alias("role_length"),
                    (F.col("at") + F.length("role") + 1).cast("int").alias("text_at"), F.length("text").alias("text_length"),
                    "repeated", (F.col("assistant") & ~F.col("repeated")).alias("target"))
    built = rows.groupBy("key", "window").agg(
        F.max("conv_id").alias("conv_id"), F.sort_array(F.collect_list(span)).alias("x"), F.sum("tokens").alias("tokens"),
        F.max(~F.col("repeated")).alias("own"))
    return built.where("own").select(
        "conv_id", "window", F.array_join("x.piece", "").alias("text"), "tokens", (F.col("tokens") > budget).alias("over_budget"),
        F.transform("x", lambda s: s.dropFields("piece")).alias("spans"))


def turns_from(windows: DataFrame) -> DataFrame:
    """conv_id and its turns (seq, role, text, loss: the text under the mask or NULL) read back from formatted windows, each once."""
    cut = F.transform(
        F.filter("spans", lambda s: ~s.repeated),
        lambda s: F.struct(
            s.seq.alias("seq"), unescaped(F.replace(F.substring("text", s.role_at, s.role_length), F.lit(LINE), F.lit("\n"))).alias("role"),
            unescaped(F.substring("text", s.text_at, s.text_length)).alias("text"),
            F.when(s.target, unescaped(F.substring("text", s.text_at, s.text_length))).alias("loss")))
    return windows.select("conv_id", "window", F.length("text").alias("chars"), cut.alias("turns"))
