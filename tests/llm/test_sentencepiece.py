import os
import random

import pytest
from pyspark.sql import functions as F

from meterflow.llm.queries import op1_sentencepiece, tokenizer_path
from meterflow.llm.sentencepiece_codec import Model, decode_column, encode_documents

from .util import SF, docs_of, documents

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return Model(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def ids_of(model, texts):
    ids, first = model.encode(texts)
    return [ids[first[i] : first[i + 1]].tolist() for i in range(len(texts))]


def random_texts():
    rng = random.Random(11)
    letters = "abcdefghij etainosrhl  ETA.,!?0123456789\n\t-_()[]{}<>=+/\\'\"éèçñüß日本語ゼ梦𝟙😀 ▁"
    parts = ["the", "ing", " ", "tion", "  ", "in", "th", "er", "re", "0", "aa", "a", "!!", "...", "==", "\n\n", "    "]
    out = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(1500)]
    out += ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(1500)]
    out += ["a" * n for n in range(1, 60)] + [" " * n for n in range(1, 70)] + ["x" + " " * n + "y" for n in range(1, 40)]
    return out + ["the" * 100, "ab" * 20_000, " " * 5000, ""]


def test_ids_are_the_librarys(model, library):
    texts = random_texts()
    assert ids_of(model, texts) == library.encode(texts)


def test_unigram_trellis_finds_the_librarys_best_path(model, tmp_path):
    """The same pieces, read as a unigram model: scores add up along the path."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    with open(tokenizer_path(), "rb") as f:
        spec.ParseFromString(f.read())
    spec.trainer_spec.model_type = 1
    rng = random.Random(2)
    for p in spec.pieces:
        if p.type == pb.ModelProto.SentencePiece.NORMAL:
            p.score = -rng.uniform(3, 14)
    path = tmp_path / "unigram.model"
    path.write_bytes(spec.SerializeToString())
    mine, lib = Model(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["the quick brown fox", "internationalisation", "a  b", "日本語 text", "", "thethethe ingtion"] + random_texts()[:200]
    assert ids_of(mine, texts) == lib.encode(texts)


def test_round_trip_and_cases(spark, model):
    pairs = [(1, None), (2, ""), (3, " lead and trail \n"), (4, "é😀\u0000\t"), (4, "é😀\u0000\t"), (None, "x"), (5, "w" * 100_000), (6, "▁")]
    out = encode_documents(docs_of(spark, pairs), model).withColumn("back", decode_column(spark, model, F.col("ids"))).collect()
    assert sorted(str((r.doc_id, r.back)) for r in out) == sorted(str((i, (t or "").replace("▁", " "))) for i, t in pairs)
    assert encode_documents(docs_of(spark, []), model).collect() == []


def test_unknown_ids_raise(model):
    with pytest.raises(IndexError):
        model.decode([len(model.pieces) + 5])


def test_query_equals_the_library(spark, library):
    text = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = op1_sentencepiece(spark, SF).collect()
    assert len(rows) == len(text) and all(r.round_trip and list(r.ids) == library.encode(text[r.doc_id]) and r.n_ids == len(r.ids) for r in rows)


def test_no_model_in_the_repository():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert not [f for d, _, names in os.walk(root) for f in names if f.endswith((".model", ".tiktoken"))]
