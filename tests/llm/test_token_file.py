import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.llm import token_file
from aerolake.llm.queries import public_tokenizer


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, (1 << 32) - 1), max_size=200))
def test_packing_round_trip(bits, ids):
    ids = np.array([i & ((1 << bits) - 1) for i in ids], np.uint32)
    raw = token_file.pack(ids, bits)
    assert len(raw) % 8 == 0 and len(raw) < len(ids) * bits / 8 + 8
    assert token_file.unpack(raw, bits, len(ids)).tolist() == ids.tolist()


def test_bits():
    assert [token_file.bits_for(n) for n in (1, 2, 3, 4, 5, 49408, 65536, 65537)] == [1, 1, 2, 2, 3, 16, 16, 17]


@pytest.mark.parametrize("vocab", [49408, 70000])
def test_files_hold_the_library_s_ids(spark, make_docs, tricky, tmpdir_str, vocab):
    from tokenizers import Tokenizer
    path = public_tokenizer("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [r for r in tricky if r[0] is not None or r[1] == tricky[0][1]]  # a null id comes first
    rows += [(40, "x <|endoftext|> y"), (41, "é é naïve ΣΑΣ don't 3.14"), (-5, "first")]
    token_file.write_tokens(make_docs(rows), tmpdir_str, path, 1, vocab)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_file.read_tokens(spark, tmpdir_str, 3).collect())
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_random_access(spark, make_docs, tmpdir_str, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_IDS", 8)
    writer = token_file.ShardWriter(tmpdir_str, 11)
    docs = [np.arange(n, dtype=np.uint32) * 7 % 2048 for n in (1, 30, 8, 7, 1)]
    for k, d in enumerate(docs):
        writer.add(np.array([k * 10]), d, np.array([len(d)]))
    name, n_docs, n_ids = writer.close()
    shard = token_file.Shard(tmpdir_str, name)
    assert (n_docs, n_ids) == (5, 47) and shard.doc_ids(1, 4).tolist() == [10, 20, 30]
    flat = np.concatenate(docs)
    for a in range(0, 47, 5):
        for b in range(a, 48, 4):
            assert shard.ids(a, b).tolist() == flat[a:b].tolist()
    assert [shard.doc(i).tolist() for i in range(5)] == [d.tolist() for d in docs]
    monkeypatch.setattr(token_file, "_READ_IDS", 9)
    assert shard.crcs(0, 5) == [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]


def test_empty_table(spark, make_docs, tmpdir_str):
    token_file.write_tokens(make_docs([]), tmpdir_str, public_tokenizer("word_bpe_49k.json"), 1, 49408)
    assert token_file.read_tokens(spark, tmpdir_str).collect() == []


def test_every_letter_with_punctuation():
    """Each letter alone, in a word, and with ASCII punctuation before and behind."""
    import sys
    from tokenizers import Tokenizer
    path = public_tokenizer("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), token_file.Encoder(path, 1)
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()]
    # The ideographs and syllables without a normal form of their own are all alike: every seventh.
    letters = [c for k, c in enumerate(letters) if ord(c) < 0x3400 or 0xF900 <= ord(c) < 0x17000 or k % 7 == 0]
    texts = [f"{c} a{c}b, ({c} {c}, x{c}. {c}_" for c in letters]
    want = [e.ids + [1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    flat, sizes = encoder.encode([t.encode() for t in texts])
    ends = np.cumsum(sizes)
    wrong = [c for c, a, b, w in zip(letters, ends - sizes, ends, want) if flat[a:b].tolist() != w]
    assert wrong == []


def test_many_words_are_normalised_in_one_call():
    """Ids equal to the library's, without a call of the normaliser for every word."""
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), token_file.Encoder(path, 1)
    calls = []

    class Counted:
        def __init__(self, held):
            self.held = held

        def __getattr__(self, name):
            value = getattr(self.held, name)
            if name == "normalize_str":
                calls.append(1)
            return Counted(value) if name == "normalizer" else value

    encoder.tokenizer = Counted(encoder.tokenizer)
    words = [chr(0xE0 + i % 20) + "é" * (i % 3) + f"{'abcdefghij'[i // 20 % 10]}{'klmnopqrst'[i // 200 % 10]}" for i in range(2000)]
    texts = [" ".join(words), " " + ",\t".join(words[:50]) + "!? \n", "", "x́y क़ " + words[3] + "...",]
    flat, sizes = encoder.encode([t.encode() for t in texts])
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert flat.tolist() == [i for ids in want for i in ids] and sizes.tolist() == list(map(len, want))
    assert len(calls) < 20
