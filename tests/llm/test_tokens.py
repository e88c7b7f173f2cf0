import random

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from stratalake.llm import pieces, sentencepiece_codec, token_counts
from stratalake.llm.queries import TOKENIZER

TEXTS = ["", " ", "  two  spaces ", "a\n\nb\tc", "中文🤣 x\u0000y", "é́" * 40, "x" * 3000, "thing " * 500, "the and of"]


def words(n=4000):
    random.seed(5)
    parts = ["th", "ing", "er", "on", "é", "ñ", "sch", "ß", "The", ".", ",", "42", "*"]
    return ["".join(random.choices(parts, k=random.randint(1, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def model(tmp_path_factory):
    """The public vocabulary as a unigram model for the library. Its runs of spaces score
    -1e9, beside which the library's single precision loses all other scores."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(TOKENIZER, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.type == 1 and piece.score < -1e8:
            piece.score = -40000.0
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def test_equal_to_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    encoder = sentencepiece_codec.Encoder(pieces.load(model))
    all_words = words()
    assert [list(p) for p in encoder.encode(all_words)] == library.encode(all_words)


def brute(vocabulary, unit):
    """Best path over all pieces, earliest start first."""
    known = {t: (s, i) for t, s, i in zip(vocabulary.texts, vocabulary.scores, vocabulary.ids)}
    best = [(0.0, [])] + [(float("-inf"), [])] * len(unit)
    for end in range(1, len(unit) + 1):
        for start in range(max(0, end - 16), end):
            part = unit[start:end]
            if part in known:
                step = known[part][0], [known[part][1]]
            elif end - start == 1:
                step = vocabulary.unknown, [vocabulary.byte_ids[b] for b in part.encode()]
            else:
                continue
            total = best[start][0] + step[0]
            if total > best[end][0]:
                best[end] = total, best[start][1] + step[1]
    return best[-1][1]


def test_equal_to_brute_force():
    vocabulary = pieces.load(TOKENIZER)
    encoder, counter = sentencepiece_codec.Encoder(vocabulary), token_counts.Counter(vocabulary)
    texts = [*TEXTS, *words(300), " ".join(words(400))]
    want = [[i for u in pieces.units(t) for i in brute(vocabulary, u)] for t in texts]
    coded = encoder.encode(texts)
    assert [list(p) for p in coded] == want
    assert [encoder.decode(p) for p in coded] == texts
    assert [counter.text(t) for t in texts] == [len(w) for w in want]


def test_tables(spark):
    rows = spark.createDataFrame(
        [(1, "the  and", 7, "q"), (1, "the  and", 7, "q"), (None, None, None, None), (2, "", 0, ""), (3, "a▁b", 1, "")],
        "doc_id long, text string, pieces int, row string",
    )
    vocabulary = pieces.load(TOKENIZER)
    coded = sentencepiece_codec.encode(rows, vocabulary)
    found = coded.collect()
    assert [r.n_pieces for r in found][2:4] == [None, 0] and found[0] == found[1]
    assert [r.round_trip for r in found] == [True, True, None, True, False]
    back = [r.text for r in sentencepiece_codec.decode(coded, vocabulary).collect()]
    assert back == ["the  and", "the  and", None, "", "a b"]
    counted = token_counts.count_tokens(rows.withColumnRenamed("row", "n_tokens"), vocabulary).collect()
    assert [r.n_tokens for r in counted] == [r.n_pieces for r in found]
    assert sentencepiece_codec.encode(rows.limit(0), vocabulary).count() == 0
    assert token_counts.count_tokens(rows.limit(0), vocabulary).count() == 0
