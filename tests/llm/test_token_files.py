import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from metaloom.llm import rans, token_files
from metaloom.llm.store import new_folder, read_random
from tests.llm import awkward


def brute(rows, end=2):
    """doc_id, start, n, crc in order of ids, ties by nothing that shows."""
    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    out = []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 100_001])
def test_block_round_trip(n):
    r = np.random.default_rng(n)
    ids = r.zipf(1.2, n) % 50_000
    symbols, counts = np.unique(ids, return_counts=True)
    table = rans.Table.from_bytes(rans.Table.of(symbols.tolist(), counts.tolist()).to_bytes())
    data = rans.encode(ids, table, lanes=32, checkpoint_steps=16)
    assert (rans.decode(data, table) == ids).all()
    for _ in range(20):
        a, b = sorted(r.integers(0, n + 1, 2).tolist())
        assert (rans.decode(data, table, a, b) == ids[a:b]).all()


def test_size_is_near_the_entropy():
    r = np.random.default_rng(1)
    ids = np.minimum(r.geometric(0.02, 300_000), 2000)
    symbols, counts = np.unique(ids, return_counts=True)
    p = counts / len(ids)
    assert len(rans.encode(ids, rans.Table.of(symbols.tolist(), counts.tolist()), lanes=128, checkpoint_steps=4096)) < 1.03 * -(p * np.log2(p)).sum() * len(ids) / 8


def test_damage_is_found():
    ids = np.arange(5000) % 7
    table = rans.Table.of(list(range(7)), [10] * 7)
    data = bytearray(rans.encode(ids, table))
    for at in (0, 30, 200, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(rans.Corrupt):
            rans.decode(bytes(bad), table)
    with pytest.raises(rans.Corrupt):
        rans.decode(bytes(data[:-4]), table)
    raw = bytearray(table.to_bytes())
    raw[9] ^= 1
    with pytest.raises(rans.Corrupt):
        rans.Table.from_bytes(bytes(raw))


def test_pieces_that_come_again_stay_remembered(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 8)
    encoder, asked = token_files.Encoder(token_files.default_tokenizer(), "<u2"), []
    word = encoder.word
    monkeypatch.setattr(encoder, "word", lambda text: asked.append(text) or word(text))
    text = " ".join(f"the {a}{b}" for a in "abcdef" for b in "xyz")
    assert encoder.ids(text) == encoder.encode(text) and asked.count(" the") == 1


def test_letters_are_parted_from_the_marks_after_them(monkeypatch):
    encoder, asked = token_files.Encoder(token_files.default_tokenizer(), "<u2"), []
    encode, text = encoder.encode, "we so$$$ we$$$ go$$$ no.!! so.!! no$'s\nno.!!"
    want = encode(text)
    monkeypatch.setattr(encoder, "encode", lambda text: asked.append(text) or encode(text))
    assert encoder.ids(text) == want and sorted(asked) == [" no$'s", "$$$", ".!!"]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab1.'s \n\t\xa0 é!\x1c\x85")), max_size=14))
def test_pieces_are_encoded_as_the_whole(text):
    encoder = token_files._encoder(token_files.default_tokenizer(), "<u2")
    assert not encoder.whole and encoder.ids(text) == encoder.encode(text)


def test_other_tokenizers_are_encoded_whole():
    parts = token_files.Encoder.parts
    base = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "normalizer": None, "added_tokens": []}
    assert parts(base)
    assert not parts(base | {"normalizer": {"type": "NFC"}}) and not parts(base | {"pre_tokenizer": {"type": "Whitespace"}})
    assert not parts(base | {"added_tokens": [{"content": "a b"}]}) and not parts(base | {"added_tokens": [{"content": "x", "lstrip": True}]})


def test_files_hold_the_documents_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder = new_folder(spark, "tokens")
    files = token_files.write_token_files(docs.repartition(3), folder, file_ids=20_000, block=3000)
    manifest = files.orderBy("start").collect()
    assert len(manifest) > 3
    got = token_files.read_token_files(spark, files, folder, T.LongType()).collect()
    want = brute(sorted((r.doc_id, r.text) for r in docs.collect()))
    start, expected = 0, {}
    for doc_id, n, crc, ids in want:
        expected[doc_id] = (start, n, crc, ids)
        start += n
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32, r.tokens) for r in got} == expected
    # Any range of a file, from the checkpoint before it.
    with read_random(f"{folder}/table.bin") as f:
        table = rans.Table.from_bytes(f.read())
    every = [i for _, _, _, ids in want for i in ids]
    one = manifest[1]
    with read_random(one.path) as f:
        assert token_files.read_range(f, table, 2900, 9100).tolist() == every[one.start + 2900 : one.start + 9100]


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    got = token_files.round_trip(spark, docs).collect()
    want = brute([(r[0], r[1]) for r in awkward.rows()])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted((w[:3] for w in want), key=repr)
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id is None for r in order] == [True, True] + [False] * (len(order) - 2)
    assert [r.start for r in order] == np.cumsum([0] + [r.n_tokens for r in order[:-1]]).tolist()
    again = token_files.round_trip(spark, docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert token_files.round_trip(spark, awkward.nothing(spark)).count() == 0


def test_foreign_files_are_refused(spark):
    table = rans.Table.of([1], [1])
    import pyarrow as pa
    for data in (b"", b"x" * 100, token_files.MAGIC * 8):
        with pytest.raises(rans.Corrupt):
            list(token_files.read_file(pa.PythonFile(io.BytesIO(data), "r"), table))
