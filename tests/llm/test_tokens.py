import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import token_files as tf
from strata.llm.packing import OpenBins, pack
from strata.llm.tokens import default_path, encoder

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
DOCS = "/root/testdata/sf0.001/documents.parquet"


def whole(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path(name))
    return [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def texts():
    rng = random.Random(5)
    bits = ["a", "B", "é", "ß", " ", " ", "\n", "\t", "  ", "\n\n", "'s", "'", "12", "…", "Σ", "ñ", "日本", ".", "!!", " ", "́", "\x1c", "İ", "<|endoftext|>", "word", " ", "\r\n", "😀", "x's don't"]
    return ["", " ", "\n", " a", "a ", "a\nb", "\na", "a\n", "a  b", "a \n b", "a\t\n\tb", "a\n \nb", "= . ̸x", "a,́b c", "a <|startoftext|> b", "x<|endoftext|>y", "<|EndOfText|>", "<| <|endoftext|>.", "w" * 5000, "1.2,3 a<|b c"] + ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(3000)]


@pytest.mark.parametrize("name", NAMES)
def test_word_cache_gives_the_ids_of_whole_texts(name):
    t = texts()
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder(default_path(name)).encode(t)]
    want = whole(name, t)
    bad = [(repr(x), g, w) for x, g, w in zip(t, got, want, strict=True) if g != w]
    assert not bad, bad[:3]


@pytest.mark.parametrize("name", NAMES)
def test_real_texts(spark, name):
    t = [r["text"] for r in spark.read.parquet(DOCS).collect()]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder(default_path(name)).encode(t)] == whole(name, t)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000, 70_001])
def test_rank_coding_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 2**32 if n % 2 else 300_000, n).astype("<u4")
    ranked, control, data = tf.encode_ranks(ids)
    assert len(control) == -(-n // 4)
    assert (tf.decode_ranks(ranked, control, data, n) == ids).all()


def test_token_files_round_trip(spark, tmp_path):
    rows = [(5, "five words here"), (1, None), (3, ""), (2, "two\nlines " * 400), (2, "again"), (None, "no id"), (9, "x " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"part": F.lit(1), "ids": F.lit("x")})
    tf.write_token_files(df, str(tmp_path / "t"), default_path(NAMES[0]), parts=3, segment_ids=500)
    got = tf.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (doc, text) in zip(got, rows, strict=True):
        ids = whole(NAMES[0], [text or ""])[0] + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist()) == (doc, at, len(ids), ids)
        at += len(ids)
    empty = df.limit(0)
    tf.write_token_files(empty, str(tmp_path / "e"), default_path(NAMES[0]), parts=2)
    assert tf.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_open_bins_take_the_best_fit_and_close_the_fullest():
    b = OpenBins(10, 2)
    assert b.place(6) == (0, 0) and b.place(8) == (1, 0)
    assert b.place(2) == (1, 8)  # fills bin 1
    assert b.place(5) == (2, 0)
    assert b.place(9) == (3, 0)  # bin 0, the fullest of two, has closed
    assert b.open() == {2, 3}


def test_pack_keeps_all_tokens_in_gapless_sequences(spark):
    rows = [(i, "word " * (i * 37 % 900)) for i in range(120)] + [(None, "null id"), (300, None), (300, None), (301, "long " * 9000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumns({"piece": F.lit(1), "open": F.lit(0)})
    got = pack(df, default_path(NAMES[1]), size=256, open_bins=8).collect()
    by_doc = {}
    seqs = {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and r["start"] == 256 * r["piece"]
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["ids"]))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    for doc, text in rows:
        if doc != 300:
            ids = np.frombuffer(b"".join(x for _, x in sorted(by_doc[doc])), "<u4").tolist()
            assert ids == whole(NAMES[1], [text or ""])[0] + [0]
    assert [x for _, x in by_doc[300]] == [b"\0\0\0\0"] * 2
    total = sum(r["length"] for r in got)
    assert len(seqs) <= 1.1 * total / 256 + 9
    assert pack(df.limit(0), default_path(NAMES[1])).count() == 0


def test_pack_ties_other_id_types_and_clashing_names(spark):
    import datetime

    day = datetime.date(2024, 1, 1)
    df = spark.createDataFrame([(day, "same words"), (day, "same words"), (None, "other")], "doc_id date, text string").withColumns({c: F.lit("x") for c in ("sequence_id", "offset", "start", "length", "ids")})
    got = pack(df, default_path(NAMES[1]), size=8).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["2024-01-01", "2024-01-01", "None"] and len({(r["sequence_id"], r["offset"]) for r in got}) == 3
    by_text = spark.createDataFrame([("a", "x y"), ("b", None)], "doc_id string, text string")
    assert {r["doc_id"] for r in pack(by_text, default_path(NAMES[1])).collect()} == {"a", "b"}


def test_token_files_take_columns_of_any_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "doc_id int, text string").withColumns({c: F.lit("x") for c in ("n_tokens", "start", "seq", "control")})
    tf.write_token_files(df, str(tmp_path / "t"), default_path(NAMES[0]))
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in tf.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()] == [(1, 0, 2), (1, 2, 2)]
