"""Texts made to collide under a polynomial hash modulo a power of two."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard, quality, token_files, textblocks
from tidemark.llm.textblocks import NOT_SPACE, Block


def parity_word(n, one="a", other="b"):
    """Letters by the parity of the bits of their place."""
    return "".join(other if i.bit_count() % 2 else one for i in range(n))


@pytest.fixture(scope="module", params=[1024, 2048, 4096])
def pair(request):
    return parity_word(request.param), parity_word(request.param, "b", "a")


def span_hashes(*texts):
    block = Block(pa.array(texts))
    starts, ends, _ = block.words(NOT_SPACE)
    return block.hashes(starts, ends).tolist()


def test_hashes_tell_the_words_apart(pair):
    x, y = pair
    a, b, c, d, e = span_hashes(x, y, f"{y} {x}", "z")
    assert a != b and (a, b) == (d, c) and e not in (a, b)


def test_equal_spans_hash_alike_wherever_they_stand():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdé語", k=rng.randint(1, 40))) for _ in range(300)]
    alone = span_hashes(*words)
    assert len(set(alone)) == len(set(words))
    assert span_hashes(" ".join(words)) == alone
    assert span_hashes(" " * 5000 + "\n".join(words)) == alone


def test_hashes_of_a_very_long_text_and_kept_powers():
    text = "wörd " * 2_000_000  # over ten megabytes: terms are reduced before they are summed
    assert len(text.encode()) > textblocks._SUM_BYTES
    assert set(span_hashes(text)) == set(span_hashes("wörd"))
    assert all(len(x) <= textblocks._KEPT_POWERS for x in textblocks._POWERS.values())


def test_jaccard_of_colliding_words(spark, pair):
    x, y = pair
    docs = spark.createDataFrame([(1, x), (2, y), (3, f"{x} p q r s"), (4, f"{y} p q r s"), (5, x)], "doc_id long, text string")
    rows = jaccard.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_quality_counts_of_colliding_lines(pair):
    x, y = pair
    window = "one two three four five six seven"
    got = quality.counts(Block(pa.array([f"{x}\n{y}", f"{x}\n{x}", f"{window} {x} {window} {y}", f"{window} {x} {window} {x}"])))
    assert got["n_dup_lines"].tolist() == [0, 1, 0, 0]
    assert got["n_repeat_words"].tolist() == [0, 0, 0, 16]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def test_token_ids_of_colliding_words(spark, pair, tokenizer):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)
    rows = [(i, t) for i, t in enumerate([*pair, f"{pair[1]} {pair[0]}"])]
    got = token_files.encode_and_read(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    for r in got:
        ids = [*whole.encode(rows[r.doc_id][1], add_special_tokens=False).ids, 2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


@pytest.mark.parametrize("same", [0, 1])
def test_pieces_with_one_hash_are_told_apart_by_their_bytes(monkeypatch, tokenizer, same):
    """In one block, and against pieces that were learned before."""
    texts = ["alpha beta", "gamma delta alpha", None, "", "beta. x"]
    want = [x.tolist() for t in texts for x in token_files.encode_texts(pa.array([t], pa.string()), tokenizer)]
    monkeypatch.setattr(token_files, "_STATE", {})
    monkeypatch.setattr(Block, "hashes", lambda self, s, e: (e - s).astype(np.uint64) * np.uint64(same))
    for column in (texts, texts[::-1], *([t] for t in texts)):
        got = [x.tolist() for x in token_files.encode_texts(pa.array(column, pa.string()), tokenizer)]
        assert got == [want[texts.index(t)] for t in column]
