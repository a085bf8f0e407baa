import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=3000), st.sampled_from([50.0, 90.0, 95.0, 100.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, dtype=np.uint32)
    blocks = token_files.encode_blocks(ids, percentile)
    assert token_files.decode_blocks(len(ids), blocks).tolist() == values


def test_block_index_reaches_the_middle():
    ids = np.random.default_rng(3).zipf(1.3, 5000).clip(0, 2**31).astype(np.uint32)
    blocks = token_files.encode_blocks(ids)
    assert len(blocks["patch_at"]) > 0
    assert token_files.decode_blocks(len(ids), blocks, 2, 4).tolist() == ids[2048:4096].tolist()
    assert token_files.decode_blocks(len(ids), blocks, 4).tolist() == ids[4096:].tolist()


def brute(rows, end_id=1):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted((r[0], r[1], r[2], zlib.crc32(r[3])) for r in df.select("doc_id", "start", "n_tokens", "token_ids").collect())


def test_documents_match_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.repartition(3).collect())
    assert got(token_files.token_files(docs.repartition(3), PATH)) == sorted(brute(rows))


def test_edge_rows(spark):
    texts = [None, "", " \n", "don't <|endoftext|>x 's''s", "Σ İ é é 한\x00y a\x1cb\x85c d", "w " * 300_000, "ok"]
    rows = list(enumerate(texts, start=-2))
    df = spark.createDataFrame([(i, t, 5, "b") for i, t in rows], "doc_id long, text string, shard int, id string")
    assert got(token_files.token_files(df, PATH)) == sorted(brute(rows))
    assert got(token_files.token_files(df.limit(0), PATH)) == []
    same = spark.createDataFrame([(7, "a b"), (7, "a b"), (None, "c")], "doc_id long, text string")
    read = token_files.token_files(same, PATH).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens) for r in read), key=str) == [(7, 2, 3), (7, 5, 3), (None, 0, 2)]


@pytest.mark.parametrize("cache", [3, 500_000])
def test_cache_size_changes_nothing(cache):
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files._Encoder(f.read(), cache)
    tokenizer = Tokenizer.from_file(PATH)
    for text in ["one two three four", "five Ône six.", "one two!! a-b ÿ'll x÷y,", "" , "ß ʼn ǅ Ω. ÀÉ,"] * 3:
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_the_corpus_match_the_library(sf_dir):
    import pyarrow.parquet as pq

    with open(PATH, encoding="utf-8") as f:
        encoder = token_files._Encoder(f.read())
    assert encoder.by_word
    tokenizer = Tokenizer.from_file(PATH)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([t.encode() for t in texts])] == want


class Counted(dict):
    """A cache that counts its lookups."""

    asked = 0

    def get(self, key, default=None):
        Counted.asked += 1
        return super().get(key, default)


def test_each_distinct_word_of_many_texts_is_looked_up_once():
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files._Encoder(f.read())
    texts = [f"the words the texts, The TEXTS, it's {i % 7}".encode() for i in range(120)]
    encoder.encode(texts)
    assert encoder.by_word
    encoder.young, Counted.asked = Counted(encoder.young), 0
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t.decode() for t in texts], add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert 0 < Counted.asked <= 13  # the, words, texts, a comma, no mark, it's and seven digits; 960 words


@pytest.mark.parametrize("cache", [0, 2, 500_000])
def test_words_of_one_batch_match_the_library(cache):
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files._Encoder(f.read(), cache)
    texts = [
        b"", b" ", b"\x0b\x0ca\x0bb\x0cc\r\n", b"... a... ... A,", "é É e\u0301 É, \u0301a \x1cb\x85c".encode(),
        b"abc<|endoftext|> abc.<|startoftext|> don't", b"caf\xe9 x\xc3 \xe2\x82 \xff", b"x" * 3000 + b" 12" * 1000,
    ]
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t.decode(errors="replace"), add_special_tokens=False).ids for t in texts]
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
        assert len(encoder.young) <= cache and len(encoder.old) <= cache
    assert encoder.encode([]) == []


def test_groups_hold_every_row_in_order():
    texts = ["aaa", None, "b" * 30, "", "cccccc", "dddd", "e", None]
    batch = pa.RecordBatch.from_pydict({"id": [None, *range(7)], "text": pa.array(texts, pa.string())})
    groups = list(token_files._groups([batch, batch.slice(0, 0), batch], 10))
    assert [i for ids, _ in groups for i in ids] == [None, *range(7)] * 2
    assert [x for _, some in groups for x in some] == [(t or "").encode() for t in texts] * 2
    assert len(groups) > 3 and all(sum(map(len, some[:-1])) < 10 for _, some in groups)


def test_other_tokenizers_get_whole_texts():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = token_files._Encoder(f.read())
    assert not encoder.by_word
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(encoder.encode([b" two  words\n"])[0], "<u4").tolist() == tokenizer.encode(" two  words\n", add_special_tokens=False).ids


def test_bytes_that_are_not_utf8_are_replacement_characters(spark):
    """Such texts count as what a decoder makes of them: U+FFFD for what is not UTF-8."""
    raw = [b"good words, Here", b"caf\xe9 au lait\xff", b"\xff\xfe", b"x\xc3", b"\xe2\x82 word"]
    df = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(raw)], "doc_id long, b binary").selectExpr("doc_id", "cast(b as string) as text")
    tokenizer = Tokenizer.from_file(PATH)
    found = {r.doc_id: list(np.frombuffer(r.token_ids, "<u4")) for r in token_files.token_files(df, PATH, end_id=1).collect()}
    assert found == {i: tokenizer.encode(t.decode(errors="replace"), add_special_tokens=False).ids + [1] for i, t in enumerate(raw)}


def test_the_manifest_starts_no_workers_of_its_own(spark, tmp_path, monkeypatch):
    def refused(*args, **kwargs):
        raise AssertionError("a list of rows is read by other Python workers")

    docs = spark.range(300).selectExpr("id as doc_id", "concat('some words ', id) as text")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    for name, table in (("some", docs), ("none", docs.where("doc_id < 0"))):
        manifest = token_files.write_token_files(table, f"{tmp_path}/{name}", PATH)
        rows = sorted(manifest.collect())
        assert manifest.columns == ["shard", "n_values", "base"] and [t for _, t in manifest.dtypes] == ["int", "bigint", "bigint"]
        assert [r.base for r in rows] == [sum(x.n_values for x in rows[:i]) for i in range(len(rows))]
        assert bool(rows) == (name == "some")


def test_a_new_encoder_holds_no_more_than_the_tokenizer():
    code = f"""
import re
from barloom.llm import token_files

def held():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\\nAnonymous:\\s+(\\d+)", f.read())[1]) / 1024

with open({PATH!r}, encoding="utf-8") as f:
    spec = f.read()
ends = token_files._word_ends(spec)
token_files.give_back()
before = held()
token_files._encoder(spec, ends, 1000)
assert held() - before < 30, (before, held())  # 40 with what parsing frees
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60, cwd=Path(token_files.__file__).parents[2])


def test_an_idle_worker_gives_memory_back():
    code = """
import re, time
from barloom.llm import _spark

def held():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\\nAnonymous:\\s+(\\d+)", f.read())[1]) / 1024

_spark.IDLE_SECONDS = 0.2
before, cache = held(), {}
with _spark.in_use(cache):
    cache.update((i, bytes(1000)) for i in range(100_000))
    last = bytes(1000)  # above them all: only what lies at the end goes back by itself
    full = held()
time.sleep(2)
assert not cache and full - before > 80, (before, full)
assert held() - before < 40, (before, full, held())
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60, cwd=Path(token_files.__file__).parents[2])
