import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import bpe, chunking

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder.parse(open(f"{bpe.TOKENIZER_DIR}/{bpe.BYTE_BPE}", "rb").read())


@pytest.fixture(scope="module")
def library(encoder):
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


HARD = ["", " ", "²①Ⅳ_a_b\x1c x​가²", "a" * 3000, " " * 3000 + "x", "١٢ नमस्ते é́", "it's  we'll\n\n  x\t　y", "ªº一二三 ㊀〇", "<|endoftext|> x", "\r\n \r\n", "🖨️👩‍👩‍👧"]


def test_hard_texts(encoder, library):
    for text in HARD:
        assert encoder.encode(text) == library.encode_ordinary(text)
        assert encoder.decode(encoder.encode(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(encoder, library, text):
    assert encoder.encode(text) == library.encode_ordinary(text)
    assert encoder.decode(encoder.encode(text)) == text


def test_stale_entries_and_ties(encoder, library):
    rng = random.Random(9)
    for _ in range(150):
        text = "".join(rng.choices("aeinost", k=rng.randint(1, 60)))
        assert encoder.merge(text.encode()) == library.encode_ordinary(text)


def test_corpus(spark, library):
    rows = [(1, "a text"), (2, None), (3, ""), (None, "x"), (1, "a text"), (4, HARD[2])]
    df = spark.createDataFrame([(i, t, "k", 0) for i, t in rows], "doc_id long, text string, key string, ids int").repartition(3)
    out = bpe.encode_corpus(df)
    assert out.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    got = sorted(((r.doc_id or 0, list(r.ids)) for r in out.collect()))
    assert got == sorted((i or 0, library.encode_ordinary(t or "")) for i, t in rows)
    back = sorted(((r.doc_id or 0, r.text) for r in bpe.decode_corpus(out).collect()))
    assert back == sorted((i or 0, t or "") for i, t in rows)
    assert bpe.encode_corpus(df.limit(0)).count() == 0


PARAGRAPHS = [f"Sentence {i} has some words in it. Another one follows here, number {i * 7}." for i in range(900)]


def checked(encoder, text, most=300, overlap=30):
    pieces = chunking.chunk(encoder, text, most, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for a, b, n, _ in pieces:
        assert encoder.count(text[a:b]) == n <= most
    for (_, b, _, _), (c, d, _, again) in zip(pieces, pieces[1:]):
        assert c <= b < d and again <= overlap and encoder.count(text[c:b]) == again
    return pieces


def test_pieces(encoder):
    text = "\n\n".join(PARAGRAPHS)
    pieces = checked(encoder, text)
    assert len(pieces) > 10 and all(text[b - 1].isspace() or text[b - 1] == "." for _, b, _, _ in pieces[:-1])
    assert all(again > 0 for *_, again in pieces[1:])
    for text in ("a" * 9000, "日本語" * 900, " " * 5000, "\n" * 4000, "é" * 4000, "# H\n" + "x " * 3000):
        checked(encoder, text)
    assert chunking.chunk(encoder, None) == chunking.chunk(encoder, "") == []
    assert chunking.chunk(encoder, "short") == [(0, 5, 1, 0)]


def test_an_edit_moves_only_the_cuts_near_it(encoder):
    text = "\n\n".join(PARAGRAPHS)
    other = text[:5000] + "An edit. " + text[5000:]
    a = {text[x:y] for x, y, _, _ in chunking.chunk(encoder, text, 300, 30)}
    b = {other[x:y] for x, y, _, _ in chunking.chunk(encoder, other, 300, 30)}
    assert len(a - b) <= 4


def test_oversized(spark, encoder):
    long = " ".join(["word"] * 2001)
    rows = [(1, long), (2, " ".join(["word"] * 2000)), (3, None), (4, ""), (5, "x" * 2001), (6, long), (6, long)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, pieces int")
    assert sorted(r.doc_id for r in chunking.oversized(df).collect()) == [1, 6, 6]
    pieces = chunking.chunk_corpus(df).where("doc_id = 1").orderBy("piece_no").collect()
    assert [p.n_tokens for p in pieces] == [encoder.count(p.piece_text) for p in pieces] and pieces[0].pieces == len(pieces) > 1
    assert chunking.chunk_corpus(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chunking.chunk_corpus(df, max_tokens=100, overlap=60)


def test_headings_near_a_landmark_are_preferred(encoder):
    parts = []
    for i, p in enumerate(PARAGRAPHS * 2):
        parts += ([f"# Heading {i}"] if i % 2 else []) + [p]
    text = "\n\n".join(parts)
    pieces = checked(encoder, text, 500, 40)
    at_heading = sum(text[b:].lstrip().startswith("# Heading") for _, b, _, _ in pieces[:-1])
    assert at_heading >= 0.8 * (len(pieces) - 1)
