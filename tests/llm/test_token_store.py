import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rawfold.llm.token_store import DacReader, PieceEncoder, open_shard, shard_bytes, token_store, write_tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000), max_size=2000))
def test_code_round_trip_and_random_access(ids):
    a = np.array(ids, np.uint32)
    r = DacReader(b"".join(shard_bytes([7, None], [len(a) // 2, len(a) - len(a) // 2], a)))
    assert (r.tokens(0, len(a)) == a).all() and r.n_docs == 2
    for i in range(0, len(a), 7):
        assert r.token(i) == a[i]
        assert (r.tokens(i, min(len(a), i + 13)) == a[i:i + 13]).all()
    assert r.doc_ids.tolist() == [7, 0] and r.null_ids[0] == 2


def test_code_over_many_rank_blocks():
    a = np.random.default_rng(0).integers(0, 50_257, 40_000).astype(np.uint32)
    r = DacReader(b"".join(shard_bytes([1], [len(a)], a)))
    assert all(r.token(i) == a[i] for i in range(0, 40_000, 371))
    assert (r.tokens(12_345, 33_333) == a[12_345:33_333]).all()


TEXTS = ["", " ", "a b", " lead", "trail ", "two  spaces", "tab\tand \t mixed \n\n lines", "it's we'll  don't", "é ñ x 　 y",
         "12 345 ,. !? --", "x<|endoftext|>y <|endoftext|> z", "日本 語 ", "a​ b \x1c c", "😀 ok", "wor d" * 2000, "a   b", "\x85 a \x0b b"]


@pytest.mark.parametrize("limit", [300_000, 3])
def test_pieces_give_the_ids_of_whole_texts(tokenizer, limit):
    e = PieceEncoder(PATH, limit)
    for t in TEXTS * 2:
        assert e.encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sé1 \t\n  \x1c.,<|>")), max_size=40))
def test_pieces_give_the_ids_of_any_text(text):
    from tokenizers import Tokenizer
    t = test_pieces_give_the_ids_of_any_text.__dict__.setdefault("t", Tokenizer.from_file(PATH))
    e = test_pieces_give_the_ids_of_any_text.__dict__.setdefault("e", PieceEncoder(PATH))
    assert e.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def expected(tokenizer, rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_read_back(make_docs, tokenizer, words):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(200 - i, words(i * 3, i)) for i in range(60)]
    rows += [(77, None), (77, ""), (78, "same"), (78, "same"), (None, "null id"), (-5, "negative"), (300, words(40_000, 1))]
    d = make_docs(rows).selectExpr("*", "1 as part", "2 as start", "3 as n_tokens")
    got = sorted((tuple(r) for r in token_store(d, PATH).select("doc_id", "start", "n_tokens", "ids_crc32").collect()),
                 key=lambda r: r[1])
    assert got == expected(tokenizer, rows)


def test_shards_are_whole_files_in_order_of_ids(make_docs, tmp_path, tokenizer):
    rows = [(i, f"text {i}") for i in range(50)]
    manifest = write_tokens(make_docs(rows), PATH, str(tmp_path), shards=4)
    assert sorted(os.listdir(tmp_path)) == [m["file"] for m in manifest]  # no file of an attempt is left
    ids = []
    for m in manifest:
        r = open_shard(f"{tmp_path}/{m['file']}")
        ids += r.doc_ids.tolist()
        assert r.n_tokens == m["tokens"]
        assert r.token(int(r.starts[1]) - 1) == 2
    assert ids == list(range(50))


def test_empty_table(make_docs):
    assert token_store(make_docs([]), PATH).count() == 0
