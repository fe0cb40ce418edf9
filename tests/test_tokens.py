import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from jobweave.config import JobConfig, Sampling
from jobweave.functions.tokens import ROWS, SubwordCounter, _encoding, rows_of
from jobweave.operators.chunking import chunk_recursive, count_words, split_text
from jobweave.operators.generation import generate
from jobweave.operators.retrieval import label_chunks

COUNTER = SubwordCounter(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_counts_are_those_of_the_plain_encoder(spark):
    encoder = _encoding(COUNTER.ranks_file, COUNTER.pattern)
    assert isinstance(encoder, tiktoken.Encoding)
    texts = ["", "one", "unbelievably long words", "naïve\n\n東京", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    counts = {r["i"]: r["n"] for r in rows.select("i", COUNTER.token_column(rows.t).alias("n")).collect()}
    assert counts == {i: None if t is None else len(encoder.encode_ordinary(t)) for i, t in enumerate(texts)}


@settings(max_examples=60, deadline=None)
@given(st.text("ab é.\n zq", max_size=400), st.integers(8, 40), st.integers(0, 6))
def test_chunks_are_within_their_size(text, size, overlap):
    for count in (COUNTER, count_words):
        assert all(count(chunk) <= size for chunk in split_text(text, size, overlap, count=count))


def test_the_label_index_is_cut_by_tokens(spark):
    labels = spark.createDataFrame(
        [("2221", "Nurses", "incomprehensibilities " * 60, 0)], "code string, label string, description string, pos int")
    by_words = label_chunks(labels, JobConfig(chunk_tokens=64)).count()
    chunks = label_chunks(labels, JobConfig(chunk_tokens=64, count_tokens=COUNTER)).collect()
    assert by_words == 1 and len(chunks) > 1 and max(COUNTER(r["chunk"]) for r in chunks) <= 64


@pytest.mark.parametrize("count", [None, COUNTER.token_column])
def test_the_length_guard(spark, count):
    sampling = Sampling(context_tokens=9, max_tokens=3, count_tokens=count)
    rows = spark.createDataFrame([(1, "one two three"), (2, "incomprehensibilities unbelievably antidisestablishmentarianism")], "i int, p string")
    sent = {r["i"]: r["long"] for r in generate(rows, "p", "a", lambda: lambda x: x, sampling, too_long="long").collect()}
    assert sent == {1: False, 2: count is not None}


def test_a_batch_is_worked_on_some_rows_at_a_time(spark):
    texts = [None if i % 7 == 0 else "one two three. " * (i % 5) for i in range(2 * ROWS + 3)]
    parts = list(rows_of(iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert [len(p) for p in parts] == [ROWS, ROWS, 3] and sum(parts, []) == texts
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = {}
    for r in chunk_recursive(df, "t", 4, 0).orderBy("i", "chunk_no").collect():
        got.setdefault(r["i"], []).append(r["chunk"])
    assert got == {i: c for i, t in enumerate(texts) if (c := split_text(t or "", 4, 0))}
    counts = {r["i"]: r["n"] for r in df.select("i", COUNTER.token_column(df.t).alias("n")).collect()}
    assert counts == {i: None if t is None else COUNTER(t) for i, t in enumerate(texts)}
