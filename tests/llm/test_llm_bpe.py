"""BPE encoding, decoding and counting against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm import bpe, queries, token_count
from pageloom.llm.bpe_model import BpeModel, PrefixEncoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = [
    "", "  ", "a\x1cb\x1f c", "x\x85y z  　q᠎​", "ΑΣ ΟΔΟΣ Σ İstanbul ǅ", "é ́x ①²½ 12345 ٣",
    "<|endoftext|>abc<|startoftext|> d<|endoftext", "it's WE'RE they'll 'service don't", "😀😀 👩‍👩‍👧 ﬁ Å ẞ", "a" * 3000,
    "the" * 99, "\n\n x \n  y\t\tz  ", " '", "''''", "\x00\x01 \x7f", "한국어 日本語テキスト ไทย" * 50, " ́a", "ab" * 400,
]


def _random_texts():
    rnd = random.Random(1)
    letters = "aabcde \n'<|>endoftxstr019é😀́\x1e\x85Σ"
    return ["".join(rnd.choice(letters) for _ in range(60)) for _ in range(500)]


@pytest.fixture(scope="module", params=FILES)
def file(request):
    return public_tokenizers.path(request.param)


def test_same_ids_and_text_as_library(spark, file, texts):
    library = Tokenizer.from_file(file)
    cases = ODD + _random_texts() + list(texts.values())
    df = spark.createDataFrame(list(enumerate(cases)), "n int, text string").repartition(3)
    rows = {r.n: r for r in bpe.encode(df, file, decoded=True).collect()}
    back = {r.n: r.decoded for r in bpe.decode(bpe.encode(df, file), file).collect()}
    for n, text in enumerate(cases):
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[n].ids == ids
        assert rows[n].decoded == back[n] == library.decode(ids, skip_special_tokens=False)


def test_same_counts_as_library(spark, file, texts):
    library = Tokenizer.from_file(file)
    cases = ODD + _random_texts() + list(texts.values())
    df = spark.createDataFrame(list(enumerate(cases)), "n int, text string")
    for r in token_count.count_tokens(df, file).collect():
        assert r.n_tokens == len(library.encode(cases[r.n], add_special_tokens=False).ids)


def test_whole_tokens_are_those_the_library_keeps_whole(file):
    model, library = BpeModel(open(file, "rb").read()), Tokenizer.from_file(file)
    whole = token_count.whole_tokens(model)
    plain = [t for t in sorted(whole) if t.isascii() and t.isalpha()][:3000]
    assert plain and all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in plain if t.islower())


def test_every_prefix_has_one_last_token(file):
    encoder = PrefixEncoder(BpeModel(open(file, "rb").read()))
    for word in ("thereafter", "aaaaaaa", "ththth"):
        ids = encoder.encode_word(word)
        assert "".join(encoder.model.tokens[i] for i in ids).removesuffix(encoder.model.suffix) == word


def test_odd_rows(spark, odd, none, file):
    got = bpe.encode(odd, file, decoded=True)
    assert got.count() == odd.count() and set(odd.columns) - {"text"} <= set(got.columns)
    assert [len(r.ids) for r in got.where("doc_id = 1 OR doc_id = 2").collect()] == [0, 0]
    clash = odd.selectExpr("*", "1 AS ids", "'x' AS n_tokens")
    assert bpe.encode(clash, file).schema["ids"].dataType.simpleString() == "array<int>"
    assert token_count.count_tokens(clash, file).where("n_tokens IS NULL").count() == 0
    assert bpe.encode(none, file).count() == token_count.count_tokens(none, file).count() == 0
    assert bpe.decode(spark.createDataFrame([(None,), ([1, None, 10**6],)], "ids array<int>"), file).count() == 2


def _hex(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_queries(spark, sf_dir, texts):
    words, pieces = (Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES)
    for r in queries.op2_bpe_round_trip(spark, sf_dir).collect():
        ids = words.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), _hex(" ".join(map(str, ids))))
        assert r.decoded_sha256 == _hex(words.decode(ids, skip_special_tokens=False))
    for r in queries.op9_token_counts(spark, sf_dir).collect():
        n = len(pieces.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
