"""Sharding laws and chat windows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
from helpers import documents, no_documents
from pyspark.sql import functions as F

from cardlake.llm import chat, queries, shards


def test_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shards.shard(docs, str(tmp_path / "map")).collect()
    given = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    load, places = defaultdict(int), defaultdict(list)
    for r in rows:
        assert r.size == len(given[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(given[r.doc_id])
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert sorted(load) == list(range(40)) and len(rows) == len(given)
    assert max(load.values()) < 1.02 * sum(load.values()) / 40
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_first_map_is_greedy_and_growth_moves_into_new_shards_only(spark, tmp_path):
    rng = random.Random(4)
    sizes = [(k, rng.choice([0, 5, 50, 1000]) + rng.randrange(20), 1) for k in range(300)]
    df = spark.createDataFrame(sizes, "virtual_slot int, bytes long, rows long")
    first = shards.first_map(df, 7)
    got = {r.virtual_slot: r.shard for r in first.collect()}
    load, want = [0] * 7, {}
    for n, k in sorted(((b, k) for k, b, _ in sizes), reverse=True):
        want[k] = load.index(min(load))
        load[want[k]] += n
    assert got == want
    path = str(tmp_path / "map")
    shards.write_map(first, path, 1)
    shards.write_map(shards.grown_map(shards.read_map(spark, path, 1).drop("version"), df, 7, 2), path, 2)
    grown = {r.virtual_slot: r.shard for r in shards.read_map(spark, path).collect()}
    assert len(grown) == 300 and all(grown[k] in (got[k], 7, 8) for k in got)
    after = defaultdict(int)
    for k, b, _ in sizes:
        after[grown[k]] += b
    mean = sum(b for _, b, _ in sizes) / 9
    assert all(after[s] < mean + 1020 for s in range(7)) and all(after[s] > mean / 2 for s in (7, 8))
    assert shards.read_map(spark, path, 1).count() == 300


def test_shards_defined_cases(spark, tmp_path):
    docs = documents(spark)
    rows = shards.shard(docs, str(tmp_path / "a")).collect()
    assert len(rows) == docs.count()
    assert [r.size for r in rows if r.doc_id in (0, 1)] == [16, 16]
    assert shards.shard(no_documents(spark), str(tmp_path / "b")).count() == 0
    assert shards.read_map(spark, str(tmp_path / "b")).count() == shards.SLOTS


def test_law_holds_with_a_third_of_all_rows_alike(spark, tmp_path):
    """NULL ids, and one id, each with a third of the rows, half of these with one text."""
    docs = spark.range(0, 36_000, 1, 6).selectExpr("CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 5 ELSE id END AS doc_id",
                                                   "CASE WHEN id % 2 = 0 THEN 'one text' ELSE repeat('x', id % 40) END AS text")
    recs = shards.records(docs)
    assert recs.groupBy("virtual_slot").count().agg(F.max("count")).first()[0] < 30
    rows = shards.shard(docs, str(tmp_path / "map"))
    load = [r for r in rows.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("last"),
                                                 F.countDistinct("slot").alias("slots")).collect()]
    assert len(load) == 40 and sum(r.n for r in load) == 36_000
    assert max(r.b for r in load) < 1.02 * sum(r.b for r in load) / 40
    assert all(r.last == r.n - 1 and r.slots == r.n for r in load)
    alone = {r.doc_id: r.virtual_slot for r in recs.where("doc_id % 3 = 2 and doc_id <> 5").collect()}
    again = {r.doc_id: r.virtual_slot for r in shards.records(docs.where("doc_id = 2 or doc_id between 8 and 900")).collect()}
    assert all(alone[k] == again[k] for k in again)  # the id alone decides, whatever else is there


TURNS = "conv_id long, turn long, role string, text string, seq long, window long, block long, tokens long"


def conversations(spark):
    rng = random.Random(6)
    rows = []
    for c in range(30):
        n = rng.choice([1, 2, 5, 60])
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "system"] if c == 9 else ["user", "assistant"])
            rows.append((c, t * (300 if c == 5 else 1), role, rng.choice(["x", "é" * 40, "<|im_end|>\\", "\\\\<\\|", "word " * rng.choice([3, 90, 900])])))
    rows += [(100, 0, None, None), (100, None, "assistant", ""), (100, 1, "a\nb<|im_start|>", "<|nl|>"), (None, 0, "user", "u"), (None, 1, "assistant", "v")]
    rows += [(101, 0, "assistant", "same"), (101, 0, "assistant", "same"), (101, 0, "assistant", "same"), (102, 0, "system", "s" * 9000), (102, 1, "user", "q")]
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], TURNS)


def test_windows_read_back(spark):
    given = conversations(spark)
    windows = chat.windows_of(given)
    by_conv = defaultdict(list)
    for r in given.collect():
        by_conv[r.conv_id].append(((r.turn is not None, r.turn or 0), r.role or "", r.text or ""))
    back = defaultdict(list)
    for r in chat.turns_from(windows).collect():
        back[r.conv_id] += [(t.seq, t.role, t.text, t.loss) for t in r.turns]
    assert set(back) == set(by_conv)
    for k, turns in by_conv.items():
        got = sorted(back[k])
        assert [x[1:3] for x in got] == [x[1:] for x in sorted(turns)]
        assert all((loss == text) if role == "assistant" else loss is None for _, role, text, loss in got)
    for w in windows.collect():
        own = [s for s in w.spans if not s.repeated]
        assert own and w.over_budget == (w.tokens > chat.BUDGET)
        history = [s for s in w.spans if s.repeated]
        assert all(s.seq < own[0].seq and not s.target for s in history)
        assert [s.seq for s in w.spans if s.seq != 1] == list(range(min((s.seq for s in w.spans if s.seq != 1), default=0),
                                                                   max((s.seq for s in w.spans if s.seq != 1), default=-1) + 1))
        assert w.text.count("<|im_start|>") == len(w.spans) == w.text.count("<|im_end|>")
        head = sorted(by_conv[w.conv_id])[0]
        if head[1] == "system":
            assert w.spans[0].seq == 1 and w.text.startswith("<|im_start|>system\n")


def test_windows_keep_the_budget(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", "w" * (40 + 7 * (t % 50))) for t in range(4000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.windows_of(df).select("tokens", "over_budget", F.size("spans").alias("n")).collect()
    assert not any(r.over_budget for r in got) and sum(r.tokens for r in got) > 0 and len(got) > 20


def test_windows_of_short_turns_are_full(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", "w" * (40 + 7 * (t % 50))) for c in range(2) for t in range(4000)]
    got = chat.windows_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).select("tokens").collect()
    assert sum(r.tokens for r in got) / len(got) > 0.85 * chat.BUDGET


def test_windows_equal_a_plain_loop(spark):
    """Spans as a loop over each conversation's turns chooses them, block by block."""
    given = conversations(spark)
    by_conv = defaultdict(list)
    for r in given.collect():
        role, text = r.role or "", r.text or ""
        by_conv[r.conv_id].append((r.turn is not None, r.turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text, (-1 if r.turn is None else r.turn) // chat.BLOCK))
    want = set()
    for conv, turns in by_conv.items():
        turns.sort()
        size = [-(-len((x[2] + x[4]).encode()) // 4) + 4 for x in turns]
        head = int(turns[0][2] == "system")
        windows, used, reach = [], 0, chat.BUDGET - chat.HISTORY - (size[0] if head else 0)
        for i in range(head, len(turns)):
            if not windows or used + size[i] > reach or turns[i][5] != turns[i - 1][5]:
                windows.append([])
                used = 0
            windows[-1].append(i)
            used += size[i]
        for k, w in enumerate(windows or [[]]):
            past = []
            if k:
                past = [i for i in windows[k - 1] if sum(size[i:w[0]]) <= chat.HISTORY]
            if head * size[0] + sum(size[i] for i in [*past, *w]) > chat.BUDGET:
                past = []
            want.add((conv, k, tuple((i + 1, bool(i not in w and (i or k)) if head else i not in w) for i in [*([0] if head else []), *past, *w])))
    got = {(r.conv_id, r.window, tuple((s.seq, s.repeated) for s in r.spans)) for r in chat.windows_of(given).collect()}
    assert got == want


def test_a_hot_conversation_is_many_blocks(spark):
    """A third of all turns without a conversation, on few turn numbers: no block has much over BLOCK of them, and all come back."""
    rows = [(None, t % 3, "user" if t % 2 else "assistant", f"turn {t}") for t in range(9000)] + [(c, t, "user", f"{c} {t}") for c in range(600) for t in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = [r["count"] for r in chat.turns_of(df).groupBy("conv_id", "block").count().collect()]
    assert max(blocks) <= 1.5 * chat.BLOCK
    back = chat.turns_from(chat.windows_of(df)).select("conv_id", F.explode("turns").alias("t")).select("conv_id", "t.role", "t.text").collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((c, role, text) for c, _, role, text in rows), key=repr)


def test_long_turns_keep_the_budget(spark):
    """Turns of 1,000 to 1,700 tokens among short ones, beside system turns of any length: only one that can't fit exceeds it."""
    rng = random.Random(11)
    rows = []
    for c in range(60):
        if c % 2:
            rows.append((c, 0, "system", "s" * rng.choice([40, 400, 3600, 5200, 6800, 7700])))
        for t in range(1, 60):
            rows.append((c, t, rng.choice(["user", "assistant"]), "w" * 4 * (rng.randint(1000, 1700) if rng.random() < 0.3 else rng.randint(1, 300))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.windows_of(df).select("conv_id", "tokens", "over_budget", "spans").collect()
    first = {c: role for c, t, role, _ in reversed(rows)}
    for w in got:
        own = [s for s in w.spans if not s.repeated and (first[w.conv_id] != "system" or s.seq > 1)]
        assert own and w.over_budget == (w.tokens > chat.BUDGET)
        if w.over_budget:
            assert first[w.conv_id] == "system" and len(own) == 1 and not [s for s in w.spans if s.repeated and s.seq > 1]
    assert any(sum(s.text_length > 4000 for s in w.spans) for w in got if not w.over_budget)
    assert sum(len([s for s in w.spans if not s.repeated]) for w in got) == len(rows)


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    want = con.sql(queries.CHAT_SQL + " order by conv_id").fetchall()
    got = queries.op7_chat_windows(spark, sf).orderBy("conv_id").collect()
    assert [tuple(r) for r in got] == want
    own = next(r for r in got if r.conv_id == -1)
    text = "<|im_end|><|im_start|>assistant ok"
    assert own.n_turns == 2 and own.loss_chars == len(text)
    assert own.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert own.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty(spark):
    assert chat.windows_of(conversations(spark).limit(0)).count() == 0
