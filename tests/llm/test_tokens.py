"""Token files (2), token counts (5) and piece codec (10) against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyspark.llm import piece_codec, token_counts, token_files
from surveyspark.llm.catalog import PIECE_BPE, WORD_BPE, op2_token_files, op5_token_counts, op10_piece_codec
from tests.llm.conftest import DOCS, docs_of

SF = "/root/testdata/sf0.001"
PARTS = ["a", "b", " ", "  ", "\n", "é", "the", "▁", "<s>", "</s>", "<0x0A>", "中", "\U0001f600", "́", "ing", "\t", "=====", "0", "ا", "\x00", "aaaa", "'", "ﬁ",
         "<|endoftext|>", "don't", "I'll", "ß.", "\xa0", "\x1c", "\x85", "’s", "the.", "é,", "\ue000", "<|ENDOFTEXT|>", "THE.", "It'S", "É", "End.,", "x.y", "E\u0301,"]
EDGE = [(7, None), (3, ""), (5, " "), (5, " "), (9, "x"), (1, "The end.\nThe end"), (None, "no id"), (4, "中" * 500), (2, "word " * 3000 + "w" * 3000)]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def piece():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_BPE))


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(public_tokenizers.path(WORD_BPE))


def test_backtracking_equals_library(piece):
    encoder = piece_codec.BacktrackingEncoder(public_tokenizers.path(PIECE_BPE))
    for t in [*random_texts(3000), "a" * 5000, "".join(random.Random(2).choice("abcdef") for _ in range(5000))]:
        assert encoder.encode(t)[0] == piece.encode(t), repr(t)


def test_word_encoder_equals_library(word):
    encoder = token_files.WordEncoder(public_tokenizers.path(WORD_BPE))
    texts = random_texts(3000, 3)
    for t, got in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == word.encode(t, add_special_tokens=False).ids, repr(t)


def check_files(word, rows, got):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, by_id = 0, {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, by_id.values())) == len(rows)
    total = 0
    for doc_id, text in rows:
        ids = word.encode(text or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert any(r.n_tokens == len(ids) and r.ids_crc32 == crc for r in by_id[doc_id])
        if len(by_id[doc_id]) == 1:
            assert by_id[doc_id][0].start == total
        total += len(ids)
    return start


def test_token_files_query(spark, word):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_files(word, rows, op2_token_files(spark, SF).collect())


def test_token_files_edge_cases(spark, word):
    docs = docs_of(spark, EDGE).withColumn("part", F.lit("clash")).withColumn("start", F.lit(1))
    files = token_files.write_token_files(docs, public_tokenizers.path(WORD_BPE), shard_bytes=100)
    check_files(word, EDGE, token_files.read_token_files(spark, files).collect())
    empty = token_files.write_token_files(spark.createDataFrame([], DOCS), public_tokenizers.path(WORD_BPE))
    assert token_files.read_token_files(spark, empty).collect() == []


def test_read_single_document(spark, word):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    files = token_files.write_token_files(docs, public_tokenizers.path(WORD_BPE), dictionary_bytes=4096)
    dictionary = bytes(spark.read.parquet(files.dictionary).first().dictionary)
    assert dictionary
    shard = spark.read.parquet(files.shards).orderBy("part", "shard").first()
    index, _ = token_files.parse_shard(bytes(shard.data), dictionary)
    k = len(index) // 2
    text = docs.where(F.col("doc_id") == int(index["doc_id"][k])).first().text
    assert token_files.read_document(bytes(shard.data), dictionary, k).tolist() == word.encode(text, add_special_tokens=False).ids + [1]
    with pytest.raises(ValueError, match="dictionary"):
        token_files.read_document(bytes(shard.data), b"other", k)


def test_counts_query(spark, piece):
    want = {r.doc_id: (len(r.text.encode()), len(piece.encode(r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op5_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


@pytest.mark.parametrize("overlap", [2, 16, 64])
def test_counts_by_chunks(spark, piece, overlap):
    rng = random.Random(overlap)
    texts = [*("".join(rng.choice(PARTS) for _ in range(400)) for _ in range(12)), "a" * 1000, "中" * 700, "=" * 900, "word " * 300, " " * 500, "ab" * 400]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1]), (3, None), (4, "")]
    docs = docs_of(spark, rows).withColumn("hash", F.lit("clash")).withColumn("size", F.lit(0))
    got = token_counts.token_counts(docs, public_tokenizers.path(PIECE_BPE), huge_chars=64, chunk_chars=128, overlap=overlap).collect()
    want = sorted(((i if i is not None else -1), len((t or "").encode()), len(piece.encode(t or ""))) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got) == want


def test_counts_of_texts_that_agree_in_id_and_size(spark, piece):
    """Huge texts of one doc_id and one size, counted whole where no seam can be proven: a row each, each its own count."""
    texts = [("a" * 900), ("b" * 450 + "c" * 450), ("ab" * 450), ("xyz" * 300), ("q" * 899 + "r"), ("long" * 225)]
    rows = [(7, t) for t in texts] + [(None, t) for t in texts[:3]] + [(7, texts[0]), (8, texts[0])]
    got = token_counts.token_counts(docs_of(spark, rows), public_tokenizers.path(PIECE_BPE), huge_chars=200, chunk_chars=130, overlap=2).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == sorted((i or -1, 900, len(piece.encode(t))) for i, t in rows)


def test_chunks_of_long_texts_in_linear_time(spark, piece):
    """A text of several million characters, of more than one byte each, is cut in one pass."""
    text = " ".join(f"wört{k % 9973} año" for k in range(250_000))
    got = token_counts.token_counts(docs_of(spark, [(1, text)]), public_tokenizers.path(PIECE_BPE)).collect()
    assert [(r.n_bytes, r.n_tokens) for r in got] == [(len(text.encode()), len(piece.encode(text)))]


def test_counts_empty(spark):
    assert token_counts.token_counts(spark.createDataFrame([], DOCS), public_tokenizers.path(PIECE_BPE)).collect() == []


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_codec_query(spark, piece):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {(r.doc_id, len(ids := piece.encode(r.text)), sha(",".join(map(str, ids))), sha(piece.decode(ids))) for r in rows}
    got = op10_piece_codec(spark, SF).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(rows)


def test_codec_edge_cases(spark, piece):
    docs = docs_of(spark, EDGE).withColumn("ids", F.lit("clash"))
    got = piece_codec.encode_decode(docs, public_tokenizers.path(PIECE_BPE)).collect()
    assert len(got) == len(EDGE)
    for r in got:
        texts = [t or "" for i, t in EDGE if i == r.doc_id]
        assert any(r.ids == piece.encode(t) and r.decoded == (piece.decode(piece.encode(t)) if t else "") for t in texts)
    assert piece_codec.encode_decode(spark.createDataFrame([], DOCS), public_tokenizers.path(PIECE_BPE)).collect() == []


def test_piece_encoder_keeps_few_words_and_backtracks_as_the_library():
    """What is kept is bounded after each text, whatever the batch, and the ids stay those of the library."""
    import random

    import public_tokenizers

    from surveyspark.llm.piece_codec import BacktrackingEncoder

    rng = random.Random(5)
    letters = "abcdeilnorstuhg\u00e9\u00ea\u00f1%&.,;\u4e2d\u6587"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(120)) for _ in range(60)]
    texts += ["x" * 200 + "\u00e9" * 90 + "the" * 60, "", "a", "  b  ", "\ue000 x", "\u2581\u2581a"]
    encoder = BacktrackingEncoder(public_tokenizers.path("piece_bpe_32k.model"), limit=300)
    for t in texts:
        ids, name = encoder.encode(t)
        assert ids == encoder.pieces.sp.encode(t) and name == ",".join(map(str, ids))
        assert max(len(m) for m in (encoder.run_ids, encoder.run_ids.before, encoder.part_ids)) <= 300 + 2 * 120 + 2
    assert BacktrackingEncoder(public_tokenizers.path("piece_bpe_32k.model")).run_ids.limit <= 150_000


def test_latin_words_and_marks_are_encoded_as_pieces():
    """Small Latin-1 words go to the model at once, a mark after one is cut off, and the ids are the library's."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = token_files.WordEncoder(path), Tokenizer.from_file(path)
    split, calls = encoder.split, []
    encoder.split = lambda text: calls.append(text) or split(text)
    texts = ["été, forêt. ñandú; straße! là: où?", "øre ÿ ß ã­b", "mentoiê.été", "a.b é.b É.b ß.É", "×. ÷, ª. º."]
    got = encoder.encode([t.encode() for t in texts[:1]])
    assert not [c for c in calls if c[:1].isalpha()] and "été".encode() in encoder and "forêt".encode() in encoder
    got += encoder.encode([t.encode() for t in texts[1:]])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_piece_runs_without_marks():
    """A word with one word mark is kept by its bare text; texts with several marks side by side are cut as before."""
    import public_tokenizers

    encoder = piece_codec.BacktrackingEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    assert encoder._runs("one two, two") == ["one", "two", ",", "two"]
    for text in ("one two, two", " a b", "a  b", "a b ", " ", "a,  b. ", "é, ê.\n\nx", "▁a ▁ b", " a, b", "x" * 90 + ", y", "a\n b\n\n", ",", "né. ▁"):
        assert encoder.encode(text)[0] == encoder.pieces.sp.encode(text), text


def test_new_words_are_encoded_in_runs(monkeypatch):
    """Words of small letters cost one call of the library for many, each distinct word is looked up once, and the ids are the library's."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_BPE)
    encoder, library, calls = token_files.WordEncoder(path), Tokenizer.from_file(path), []
    model = encoder.model
    encoder.model = lambda piece: calls.append(piece) or model(piece)
    texts = [" ".join(f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'éßàíüøñçþÿ'[k // 100 + j]}" for k in range(900)) for j in range(2)]
    got = encoder.encode([t.encode() for t in texts])
    assert calls == [] and len(encoder) == 1000
    # marks are cut off words, but not where a special token may stand
    texts += ["THE. <|endoftext|> The.", "the%%% été#, x&y ×% É* 中. ,", "a.", "", ".", "\n", "a <| b. c.", "b. c. d", "x" * 70 + ". " + "é" * 40, "\u00e0 \u00ed\u0301 \u00df"]
    for chunk in (1, 20, 1 << 20):
        monkeypatch.setattr(token_files, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(token_files, "BLOCK_BYTES", min(chunk, 30))
        for limit in (0, 5, 100_000):
            encoder = token_files.WordEncoder(path, limit)
            for _ in range(2):
                got = encoder.encode([t.encode() for t in texts])
                assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.encode([]) == []


def test_new_words_one_by_one_where_ends_do_not_show(monkeypatch):
    """A model whose ids do not tell where words end, or not all of them, gets its words one by one: the same ids."""
    encoder = token_files.WordEncoder(public_tokenizers.path(WORD_BPE))
    texts = [t.encode() for t in random_texts(200, 9)] + ["forêt été naïve".encode()]
    want = encoder.encode(texts)
    for at_once, ends in ((False, encoder.ends), (True, np.zeros_like(encoder.ends))):
        other = token_files.WordEncoder(public_tokenizers.path(WORD_BPE))
        other.at_once, other.ends = at_once, ends
        assert other.encode(texts) == want


def test_texts_reach_the_encoder_in_small_batches(spark, monkeypatch):
    """No Arrow batch holds 10,000 whole texts, and the session's settings are as before."""
    from surveyspark.llm import common

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, stored = spark.conf.get(name), [], token_files.stored
    monkeypatch.setattr(token_files, "stored", lambda df, to: seen.append(spark.conf.get(name)) or stored(df, to))
    rows = [(i, f"text {i}.") for i in range(50)]
    files = token_files.write_token_files(docs_of(spark, rows), public_tokenizers.path(WORD_BPE))
    assert token_files.read_token_files(spark, files).count() == 50
    assert seen == ["250", "250"] and spark.conf.get(name) == before
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        1 / 0
    assert spark.conf.get(name) == before
