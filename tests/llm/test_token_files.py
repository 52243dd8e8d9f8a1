import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import common, token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, start string, n_tokens string"
ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n b", "a \nb", "x y z", "tab\t tab", "it's  we'll 'tis",
    "<|endoftext|> in <|endoftext|> text", "é   wide", "emoji 😀 😀😀 end ", "\x1c a \x85 b", "1 2  33 ,. !!  ",
    "fin​ ally", "日本 語 テキスト", "﻿ bom", " leading and trailing  \n\n ", "a" * 3000,
]


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [tf.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_encode_like_whole_texts():
    encoder, tokenizer = tf.Encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(4)
    alphabet = ["a", "b", "Z", "é", " ", "  ", "\n", "\t", " ", "　", "\x1d", "'s", "7", ".", "!?", "😀"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("sequence", [16, 2048])
def test_round_trip(spark, tmp_path, sequence):
    rng = random.Random(sequence)
    rows = [(i * 7, t) for i, t in enumerate(ODD)] + [(1000 + i, " ".join(rng.choices(["ab", "c", "def."], k=rng.randrange(300))))
                                                      for i in range(200)] + [(5000, None), (-3, "negative id")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)
    folder = str(tmp_path / "tokens")
    manifest = tf.write(docs.select("doc_id", "text"), folder, PATH, sequence=sequence)
    found = sorted(map(tuple, tf.read(spark, folder).collect()))
    assert found == expected(rows)
    files = manifest.orderBy("part").collect()
    assert [f.start for f in files] == np.cumsum([0, *(f.n_tokens for f in files)])[:-1].tolist()
    assert sum(f.n_docs for f in files) == len(rows)
    # random access gives the same ids as reading in order, without a copy
    tokenizer = Tokenizer.from_file(PATH)
    whole = np.concatenate([tokenizer.encode(t or "", add_special_tokens=False).ids + [tf.END_ID]
                            for _, t in sorted(rows, key=lambda r: r[0])])
    for f in files:
        reader = tf.opened(f.path)
        allocated = pa.total_allocated_bytes()
        for number in range(f.n_sequences):
            ids, mask = tf.sequence(reader, number)
            real = mask.true_count
            at = f.start + number * sequence
            assert len(ids) == sequence and ids[:real].tolist() == whole[at:at + real].tolist()
            assert not ids[real:].any() and (real == sequence or number == f.n_sequences - 1)
        assert pa.total_allocated_bytes() - allocated < 64 * 1024


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(2, "b", None, None), (2, "b", None, None), (None, "last", None, None), (1, None, None, None)], DOCS)
    found = sorted(tf.report(docs, PATH).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [1, 2, 2, None]
    assert [r.start for r in found] == [0, 1, 3, 5]


def test_empty(spark):
    assert tf.report(spark.createDataFrame([], DOCS), PATH).collect() == []


def test_whole_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    found = sorted(map(tuple, tf.report(docs, PATH).collect()))
    assert found == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])
