import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docquarry.llm import token_counts as TC

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LETTERS = "aaabcdeinorst  \n\t'.,!019éüñßçĞİΣσς中文字ア😀🇩́ ​\x1c\x85#*-_<|>"


def wanted(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=80))
def test_counts_equal_the_library(text):
    assert TC.counter(PATH).count(text) == wanted(text)


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|>", "a<|startoftext|>b<|endoftext|>", "x" * 5000, "don't we'll", "ab" * 700 + "<|endoftext"])
def test_hard_texts(text):
    assert TC.counter(PATH).count(text) == wanted(text)


def test_chunks_compose(monkeypatch):
    text = "the quick brown fox's tail is jumpingoverthelazydog 12,5 " * 20
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(TC, "CHUNK", size)
        assert TC.counter(PATH).count(text) == wanted(text)


def test_states_are_dropped(monkeypatch):
    monkeypatch.setattr(TC, "MOST_STATES", 50)
    monkeypatch.setattr(TC, "MOST_WORDS", 20)
    made = TC.TokenCounter(PATH)
    text = " ".join(f"word{i}ing{'xyz' * (i % 40)}" for i in range(200))
    assert made.count(text) == wanted(text)


def test_rows(spark):
    rows = [(1, "a b", "n"), (1, "a b", "n"), (None, None, "n"), (3, "", "n"), (4, "word " * 3000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(TC.token_counts(df, PATH).collect(), key=str)
    assert [tuple(r) for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))] == [(1, 3, 2, False), (1, 3, 2, False), (3, 0, 0, False), (4, 15000, 3000, True), (None, 0, 0, False)]
    assert TC.token_counts(df.limit(0), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["'", "'s", "'ll", "'re", "'v", "'d", "'l", "ab", "é", "中", "12", "!?", " ", "\n", "x", "\x1c", "<|endoftext|>"]), max_size=30).map("".join), st.integers(1, 9), st.integers(0, 5))
def test_state_maps_compose_at_any_border(text, chunk, behind):
    old = TC.CHUNK, TC.BEHIND
    TC.CHUNK, TC.BEHIND = chunk, behind
    try:
        assert TC.counter(PATH).count(text) == wanted(text)
    finally:
        TC.CHUNK, TC.BEHIND = old


@pytest.mark.parametrize("unit", ["ab", "é", "中文", "don't", "1a!", "''s", "x"])
def test_long_texts_without_a_gap_are_read_chunk_by_chunk(monkeypatch, unit):
    monkeypatch.setattr(TC, "CHUNK", 50)
    text = unit * 400
    made = TC.TokenCounter(PATH)
    assert made.count(text) == wanted(text)
    assert max(map(len, made.words), default=0) < 60  # no border is undone by joining texts


def test_a_map_holds_for_each_entry_place():
    made = TC.counter(PATH)
    parts = made.parts("ingthehouse")
    for head in ("", "stand", "x1", "it'", "!'l"):
        entry, before = made.read(TC.START, head)
        one = TC.StateMap(made, parts, {TC.START})
        place, count = one(entry)
        assert before + count + made.close(place) == wanted(head + "ingthehouse") and TC.START in one.known
