"""Tokenizers against their libraries; token-id files as exact round trips."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import documents, no_documents, texts

from cardlake.llm import idfiles, pieces, unigram

SYMBOLS = ["a", "b", "the", "ing", "er", " ", "  ", "    ", "\n", "\n\n", "\t", "é", "ü", "<s>", "<|endoftext|>", "▁", "漢", "😀", "\x00", "1", "23",
           "!!", "'s", "'", "\x1c", "\x85", "\xa0", "ª", "²", "½", "http://", "        ", "ﬁ"]


def mixed(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(SYMBOLS, k=rng.randint(0, 25))) for _ in range(n)] + [t or "" for t in texts()]


def test_sentencepiece_equals_the_library():
    import sentencepiece

    path = pieces.default_model()
    own, sp = pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    names = [sp.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    some = mixed(1500) + ["".join(rng.choices(names, k=rng.randint(1, 6))) for _ in range(1500)] \
        + ["".join(rng.choices("abehtinorsl", k=rng.randint(50, 700))) for _ in range(60)]
    for t in some:
        ids = sp.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(own.encode(t), "<u4").tolist() == ids, repr(t[:80])
        assert own.decode(own.encode(t)) == sp.decode(ids)
    for _ in range(500):  # ids that no text gives
        ids = rng.choices(range(0, 300), k=8) + rng.choices(range(0, 32000), k=3)
        assert own.decode(np.array(ids, "<u4").tobytes()) == sp.decode(ids)


def test_backtracking_equals_merging():
    own = pieces.Pieces(pieces.default_model())
    rng = random.Random(9)
    for _ in range(800):
        t = "▁" + "".join(rng.choices("abcdehiorst", k=rng.randint(1, 40)))
        assert own.walk(t) == own.merge(t)


def test_sentencepiece_operator(spark):
    rows = pieces.encoded(documents(spark)).collect()
    assert len(rows) == len(texts()) + 3
    by_id = {r.doc_id: r for r in rows}
    for k, t in enumerate(texts()):
        r = by_id[k]
        assert r.n_tokens * 4 == len(r.ids) and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()
        assert r.decoded == (t or "").replace("▁", " ") and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert by_id[0].n_tokens == by_id[1].n_tokens == 2
    assert pieces.encoded(no_documents(spark), keep=()).count() == 0


def unigram_library(scores, path):
    import sentencepiece

    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = pb.ModelProto()
    m.ParseFromString(open(path, "rb").read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type == 1:
            p.score = scores[p.piece]
    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(m.SerializeToString())
    return sp


@pytest.mark.parametrize("kind", ["rank", "ties", "floats"])
def test_unigram_counts_equal_the_library(kind):
    path = pieces.default_model()
    rng = random.Random(8)
    scores = unigram.rank_scores(path)
    if kind != "rank":
        scores = {p: -float(rng.randint(1, 4)) if kind == "ties" else float(np.float32(-rng.random() * 12 - 1)) for p in scores}
    sp, own = unigram_library(scores, path), unigram.Counter(scores)
    for t in mixed(1200, 3):
        if kind != "floats" or len(t) < 5000:
            assert own.count(t) == len(sp.encode(t)), repr(t[:80])


def test_unigram_operator(spark):
    rows = unigram.token_counts(documents(spark)).collect()
    assert len(rows) == len(texts()) + 3
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1)} == {0}
    assert unigram.token_counts(no_documents(spark)).count() == 0


def test_id_encoder_equals_the_library():
    from tokenizers import Tokenizer

    own, t = idfiles.Encoder(idfiles.default_tokenizer()), Tokenizer.from_file(idfiles.default_tokenizer())
    some = mixed(4000, 6)
    for text, ids in zip(some, own.encode(some), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text[:80])


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, idfiles.BLOCK, idfiles.BLOCK + 1, 3 * idfiles.BLOCK - 5])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    payload, index = idfiles.pack(ids, bits)
    assert len(payload) == sum(index)
    assert (idfiles.unpack(payload, index, n, bits) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_id_files(spark, tmp_path, bits):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(idfiles.default_tokenizer())
    docs = documents(spark)
    idfiles.write(docs, str(tmp_path / "set"), bits=bits)
    rows = sorted(idfiles.read(spark, str(tmp_path / "set")).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in docs.collect())
    assert [r.doc_id for r in rows] == [k[1] if k[0] else None for k, _ in want]
    at = 0
    for r, (_, text) in zip(rows, want, strict=True):
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        assert r.ids == ids and r.start == at and r.n_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    idfiles.write(no_documents(spark), str(tmp_path / "none"))
    assert idfiles.read(spark, str(tmp_path / "none")).count() == 0


def test_id_files_say_how_they_are_read(spark, tmp_path):
    docs, path = documents(spark), str(tmp_path / "set")
    digest = idfiles.digest_of(idfiles.default_tokenizer())
    idfiles.write(docs, path, bits=True, end=9)
    assert idfiles.format_of(spark, path) == {"version": idfiles.VERSION, "planes": "bit", "block": idfiles.BLOCK, "end": 9, "tokenizer": digest}
    assert idfiles.read(spark, path, planes="bit", end=9, tokenizer=digest).count() == docs.count()
    for wrong in ({"planes": "byte"}, {"end": 0}, {"tokenizer": "0" * 64}, {"block": 1}):
        with pytest.raises(ValueError, match=next(iter(wrong))):
            idfiles.read(spark, path, **wrong)
    spark.read.parquet(f"{path}/chunks").write.parquet(str(tmp_path / "half/chunks"))  # a writer that was lost
    with pytest.raises(ValueError, match="not a finished set"):
        idfiles.read(spark, str(tmp_path / "half"))
    spark.read.parquet(f"{path}/format").selectExpr("99 as version", "planes", "block", "end", "tokenizer").write.parquet(str(tmp_path / "half/format"))
    with pytest.raises(ValueError, match="version 99"):
        idfiles.read(spark, str(tmp_path / "half"))
    payload, index = idfiles.pack(np.arange(10, dtype=np.uint32), False)
    for broken in ((payload[:-1], index, 10), (payload, index * 2, 10), (payload, index, idfiles.BLOCK + 1)):
        with pytest.raises(ValueError, match="index"):
            idfiles.unpack(*broken, False)


def test_rows_alike_are_cut_into_ranges(spark, tmp_path):
    docs = spark.range(0, 6000, 1, 8).selectExpr("if(id % 3 = 0, null, id) as doc_id", "if(id % 3 = 0, 'one text', 'text ' || id) as text")
    path = str(tmp_path / "set")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else ranges as small as these become one
    try:
        idfiles.write(docs, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = spark.read.parquet(f"{path}/chunks").selectExpr("part", "size(counts) as n").groupBy("part").sum("n").collect()
    assert max(r[1] for r in parts) < 2 * 6000 / len(parts) and len(parts) == 8
    rows = idfiles.read(spark, path, ids=False).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None] * 2000 + [k for k in range(6000) if k % 3]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:], strict=False))
