from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import idcoder
from ledgerloom.llm.token_files import END, Encoder, encode_and_read, read_token_files, tokenizer_path, write_token_files

TEXTS = ["", "Hello world", "hello  WORLD\n\tfoo's bar", "naïve café Ünïcode", "<|endoftext|> x <|ENDOFTEXT|>", "a b c",
         "é ́x", "日本語 テスト 123,456", "don't I'll we've", "\x0b\x0c\x1c\x1dq", "ΣΑΣ Σ", "x" * 5000]


def plain(texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    return [coder.encode(t or "", add_special_tokens=False).ids + [END] for t in texts]


def expected(rows):
    start, out = 0, []
    for key, text in rows:
        ids = np.array(plain([text])[0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_pieces_encode_as_whole_texts():
    from ledgerloom.llm.common import text_buffer
    import pyarrow as pa

    data, offsets = text_buffer(pa.array(TEXTS))
    coder = Encoder(tokenizer_path())
    for _ in range(2):  # the second time from the cache
        ids, counts = coder.encode(data, offsets, END)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == plain(TEXTS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.integers(1, 40))
def test_round_trip(ids, block):
    data = idcoder.write_ids(np.array(ids, np.int64), b"rows", block)
    back, rows = idcoder.read_ids(data)
    assert back.tolist() == ids and rows == b"rows"


@pytest.mark.parametrize("top", [1, 300, 49408])
def test_round_trip_of_many_blocks(top):
    ids = np.random.default_rng(1).integers(0, top, 30_011)
    back, _ = idcoder.read_ids(idcoder.write_ids(ids, b"", 512))
    assert (back == ids).all()


def test_repetition_is_learnt_and_damage_is_found():
    ids = np.tile(np.random.default_rng(0).integers(0, 5000, 64), 200)
    data = idcoder.write_ids(ids, b"")
    assert len(data) < 0.2 * 2 * len(ids)
    broken = bytearray(data)
    broken[-20] ^= 1
    with pytest.raises(ValueError):
        idcoder.read_ids(bytes(broken))
    with pytest.raises(ValueError):
        idcoder.read_ids(data[:-9])


def test_documents_in_ascending_order(docs):
    rows = [(i * 7 % 31, TEXTS[i % len(TEXTS)]) for i in range(31)] + [(40, None)]
    found = sorted(tuple(r) for r in encode_and_read(docs(rows)).collect())
    assert found == expected(sorted(rows, key=lambda r: r[0]))


def test_null_ids_repeated_rows_and_empty_table(docs):
    found = encode_and_read(docs([(3, "a b"), (None, "c"), (3, "a b")])).collect()
    assert sorted((r.doc_id is not None, r.start) for r in found) == [(False, 0), (True, 2), (True, 5)]
    assert encode_and_read(docs([(1, "a")]).limit(0)).count() == 0


def test_files_are_named_in_the_manifest(docs, tmp_path):
    manifest = write_token_files(docs([(i, f"text {i}") for i in range(50)]), str(tmp_path))
    for row in manifest.collect():
        assert os.path.getsize(row.path) == row.bytes
    assert read_token_files(manifest).count() == 50


def whole(texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    return [x.ids + [END] for x in coder.encode_batch_fast(texts, add_special_tokens=False)]


def pieced(texts):
    import pyarrow as pa

    from ledgerloom.llm.common import text_buffer

    data, offsets = text_buffer(pa.array(texts))
    ids, counts = Encoder(tokenizer_path()).encode(data, offsets, END)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_every_letter_in_ten_contexts():
    import unicodedata

    contexts = ["{}.", "a{}.", "({})", "~{}$", "{}1", "a{}b", "{0}{0}!", "{} {}-", "x.{}", "9{}́,"]
    letters = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)]) if unicodedata.category(c)[0] in "LM"]
    for first in range(0, len(letters), 5000):
        texts = [x.format(c, c) for c in letters[first:first + 5000] for x in contexts]
        wrong = [t for t, a, b in zip(texts, pieced(texts), whole(texts)) if a != b]
        assert not wrong, wrong[:5]


def test_random_texts_with_odd_letters():
    import random

    rng = random.Random(5)
    signs = list("İıſßŉǅǰẞ.,()~$'<>|1a Bé̇́‍٠")
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(20_000)]
    wrong = [t for t, a, b in zip(texts, pieced(texts), whole(texts)) if a != b]
    assert not wrong, wrong[:5]


def test_long_texts_and_clashing_columns(spark):
    rows = [(2, "Word1 çé. " * 40_000, 5, "p"), (1, "x" * 300_000, 6, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, file int, path string")
    found = sorted(tuple(r) for r in encode_and_read(df).collect())
    assert found == expected(sorted((r[:2] for r in rows)))
