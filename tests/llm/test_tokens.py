import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm import tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "the", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "é", "ß", "日本", "12", "3a", ",", ".", "!!",
    "'s", "'ll", "don't", "<|endoftext|>", "<|end", "|>", "​", "_", "***", "%%%", "&&&", "#", "🙂", "oftext|>",
]


def whole(texts):
    return [len(e) for e in tokens.load_tokenizer(FILE).encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), max_size=5), st.integers(1, 40))
def test_cut_texts_have_the_tokens_of_whole_ones(texts, budget):
    counter = tokens.LengthCounter(tokens.load_tokenizer(FILE), remembered=20)
    assert counter.count(texts, budget) == whole(texts)


def test_rows(clashing):
    rows = [(1, "Hello world"), (None, "x"), (3, None), (4, ""), (4, ""), (5, "né " * 3000), (6, "y" * 5000)]
    found = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(clashing(rows), FILE).collect()}
    texts = [t or "" for _, t in rows]
    expected = {
        (i, len(t.encode()), n, n > 1024) for (i, _), t, n in zip(rows, texts, whole(texts))
    }
    assert found == expected


def test_empty_table(docs):
    assert tokens.token_counts(docs([]), FILE).collect() == []


def test_groups_are_balanced_and_complete():
    texts = ["a" * n for n in (5, 5, 50, 1, 1, 1)]
    assert list(tokens.by_size(texts, 10)) == [(0, 2), (2, 3), (3, 6)]
    # Bytes count, not characters: two, three and four of them a letter.
    assert list(tokens.by_size(["éé", "日日", "🙂", "ab", "🙂"], 8)) == [(0, 1), (1, 2), (2, 4), (4, 5)]


def test_a_cut_inside_an_added_token_is_refused(tmp_path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(FILE)
    own.add_special_tokens(["<two words>"])
    own.save(str(tmp_path / "own.json"))
    with pytest.raises(ValueError):
        tokens.load_tokenizer(str(tmp_path / "own.json"))
