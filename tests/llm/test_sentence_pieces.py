import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from lectern.llm.sentence_pieces import BLANK, Pieces, boundary_states, decode, encode, joined, score_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    """The public library's own best path over the same pieces and scores."""
    m = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = m.trainer_spec.UNIGRAM
    rank = 0
    for p in m.pieces:
        if p.type == p.NORMAL:
            p.score = score_of(rank)
            rank += 1
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def texts():
    rng = random.Random(2)
    words = ["the", "corpus", "Été", "naïve", "漢字", "🎉🎉", "x" * 40, "don't", "1234567", "\n", "\t", "  ", "   ", "=" * 33, "Straße", "ﬀ", "́", "internationalization"]
    yield from ("", " ", "  ", "a", " a", "a ", "\n\n", "é", "🎉", "▁", "a▁b", "x" * 999, " " * 100, "ab" * 400)
    for _ in range(60):
        yield rng.choice(["", " ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(1, 120)))


@pytest.mark.parametrize("chunk", [20, 64, 65536])
def test_pieces_equal_the_librarys_and_decode(spark, library, chunk):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())] + [(None, None, None, None), (3, "a", "y", 2)]
    out = encode(spark.createDataFrame(rows, "doc_id long, text string, rid string, ids int"), MODEL, chunk=chunk)
    got = out.select("row", out.ids.alias("found"), "n_chunks", decode("ids", spark, MODEL).alias("decoded")).collect()
    assert len(got) == len(rows)
    with open(MODEL, "rb") as f:
        pieces = Pieces(f.read())
    score = lambda ids: sum(pieces.scores.get(pieces.names[i], pieces.unknown) for i in ids)
    for r in got:
        want = library.encode(r.row.text or "")
        assert score(r.found) == score(want) and len(r.row.text or "") > chunk or list(r.found) == want, r.row.text
        assert r.decoded == (r.row.text or "").replace(BLANK, " ")
        assert r.n_chunks == max(1, (len(r.row.text or "") // chunk + 1) if len(r.row.text or "") > chunk else 1)


@pytest.mark.parametrize(("chunk", "fan"), [(20, 64), (20, 2), (64, 3), (100, 64)])
def test_pieces_do_not_depend_on_chunks(spark, library, chunk, fan):
    """Ties too: long runs of one letter have many best paths of equal sums."""
    rng = random.Random(chunk)
    some = [*texts(), "a" * 300, "." * 300, "a" * 299 + " " + "." * 301, "=-" * 200, "x" * 997, " " * 333, "ab" * 111 + "漢" * 90, "the" * 99, "é" * 150]
    some += ["".join(rng.choice(["a", "aa", ".", "..", " ", "é", "=", "漢"]) for _ in range(rng.randrange(60, 500))) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r.row.doc_id: r.ids for r in encode(rows, MODEL, chunk=chunk, fan=fan).collect()}
    assert len(got) == len(some)
    for i, t in enumerate(some):
        assert list(got[i]) == library.encode(t), t


def test_transfer_matrices_combine_associatively():
    with open(MODEL, "rb") as f:
        pieces = Pieces(f.read())
    s = BLANK + (f"no{BLANK}blank" + "y" * 30 + "漢") * 8
    ms = [pieces.transfer(s[i : i + 50 + pieces.longest], min(50, len(s) - i)) for i in range(0, len(s), 50)]
    left = right = None
    for m in ms:
        left = m if left is None else joined(left, m)
    for m in reversed(ms):
        right = m if right is None else joined(m, right)
    assert (left == right).all()
    assert left[0, 0] == pieces.forward(s, 0, len(s))[0][len(s)]
    assert boundary_states(ms)[0] == boundary_states(ms)[-1] == 0
    assert np.array_equal(joined(joined(ms[0], ms[1]), ms[2]), joined(ms[0], joined(ms[1], ms[2])))


def test_empty_table(spark):
    assert encode(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
