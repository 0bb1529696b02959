import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("hot", [400_000, 5])
def test_counts_match_the_library(odd, texts, rows, hot):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, _ in texts]
    assert rows(tc.count_tokens(odd, PATH, hot_entries=hot)) == sorted(want, key=repr)


def test_empty_table(empty):
    assert tc.count_tokens(empty, PATH).count() == 0


def test_pretokens_add_up_on_odd_text():
    import re
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = re.compile(tc.boundary_pattern(PATH)).findall
    for t in ["  two  blanks ", "\n\n x\n", "x.y,z;  (a)", "don't  stop_it", "²³½ x²y", "<s> </s> <0x0A>", "\t\ttab\r\n", "日本語 text", "▁ mark", "á é."]:
        assert sum(tc.count_pieces(model, p) for p in found(" " + t)) == len(model.encode(t)), t


def test_random_strings_over_blanks_and_their_sign():
    import random
    import re
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found, r, count = re.compile(tc.boundary_pattern(PATH)).findall, random.Random(3), {}
    texts = ["".join(r.choice("\u2581\u2581  \n.,-_ab1é") for _ in range(r.randint(1, 9))) for _ in range(50_000)]
    for t, want in zip(texts, map(len, model.encode(texts))):
        pieces = found(tc.opened(t))
        for p in pieces:
            if p not in count:
                count[p] = tc.count_pieces(model, p)
        assert sum(count[p] for p in pieces) == want, t


def test_long_and_common_pretokens_are_joined(spark, rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [(i, "x" * 300 + f" common {i % 7}") for i in range(200)] + [(200, None), (201, "\u2581 \u2581 x")]
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in texts]
    assert rows(tc.count_tokens(spark.createDataFrame(texts, "doc_id long, text string"), PATH)) == sorted(want, key=repr)
