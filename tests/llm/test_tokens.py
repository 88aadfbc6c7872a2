import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortsieve.llm import suffix_match as S
from cohortsieve.llm import token_counts as C
from cohortsieve.llm.pieces import Pieces, broadcast_model, default_model, pretokens
from cohortsieve.llm.registry import QUERIES

EDGES = ["", "  ", " ", "a", "  a  b <s> ▁x \t\n é😀 ", "\x00x", "aaaaaaaaaaa", "▁▁▁▁", "日本語テキスト ok", "x" * 3000, "<0x0A> </s> <unk>",
         "the the  the   the    the", " lead", "trail ", "\n\n", "\r\n\t", "word " * 20000]


@pytest.fixture(scope="module")
def pieces():
    with open(default_model(), "rb") as f:
        return Pieces(f.read())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return EDGES + ["".join(rng.choice("abthe eni ▁\n.😀é <>01_-=*#") for _ in range(rng.randrange(60))) for _ in range(3000)]


def test_counts_as_the_library(pieces, texts):
    counter = C.Counter(pieces)
    assert len(counter.whole) > 10_000
    want = [len(x) for x in pieces.sp.encode(texts)]
    assert counter.count(texts) == want and counter.count(texts) == want


def test_counts_with_a_small_memo(pieces, texts, monkeypatch):
    monkeypatch.setattr(C, "MEMO", 20_000)
    assert C.Counter(pieces).count(texts) == [len(x) for x in pieces.sp.encode(texts)]


def test_pretokens_join_again():
    for t in EDGES:
        assert ("" if not t else " ".join([""] + pretokens(t))) .replace(" ", "") == t.replace("▁", " ").replace(" ", "")


def test_ids_as_the_library(pieces, texts, monkeypatch):
    monkeypatch.setattr(S, "INDEX_CHARS", 3000)
    matcher = S.Matcher(pieces)
    for part in (texts[:40], texts):
        assert [np.frombuffer(x, np.int32).tolist() for x in matcher.encode(part)] == pieces.sp.encode(part)


def test_decoding_as_the_library(pieces, texts):
    decoder, rng = S.Decoder(pieces), random.Random(4)
    ids = pieces.sp.encode(texts) + [[rng.choice([rng.randrange(32000), rng.randrange(300)]) for _ in range(rng.randrange(9))] for _ in range(3000)]
    want = [pieces.sp.decode(x) for x in ids]
    assert [decoder.decode(x) for x in ids] == want
    assert list(decoder.decode_all(pa.array([*ids, None], pa.list_(pa.int32())))) == [*want, ""]
    with pytest.raises(IndexError):
        decoder.decode([40000])
    with pytest.raises(ValueError):
        decoder.decode([-1])


def test_queries(spark, folder, pieces):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(3, "a"), (None, "x y"), (99, None)]
    path = folder(documents=[(i, t, "en", "s", 0) for i, t in rows])
    got = QUERIES["op1_token_counts"](spark, path).collect()
    want = sorted((str(i), len((t or "").encode()), n := len(pieces.sp.encode(t or "")), n > 4096) for i, t in rows)
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == want
    got = QUERIES["op5_sentencepiece"](spark, path).collect()
    assert sorted((str(r["doc_id"]), list(r["token_ids"])) for r in got) == sorted((str(i), pieces.sp.encode(t or "")) for i, t in rows)
    assert all(r["round_trip"] for r in got if r["doc_id"] is None or "▁" not in (dict(rows)[r["doc_id"]] or ""))


def test_names_and_empty_tables(spark):
    model = broadcast_model(spark)
    df = spark.createDataFrame([(1, "a b", "x")], "doc_id bigint, text string, Token_Ids string")
    both = S.decode(S.encode(df, model), model, ids="token_ids_")
    assert both.columns == ["doc_id", "text", "Token_Ids", "token_ids_", "decoded"]
    assert both.select("decoded").first()[0] == "a b"
    assert S.encode(df.limit(0), model).count() == 0 == C.count_tokens(df.filter(F.lit(False)), model).count()
