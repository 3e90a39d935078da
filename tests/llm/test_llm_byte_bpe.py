"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from pageloom.llm import byte_bpe, queries
from pageloom.llm.byte_bpe import RankBitmap, RankModel

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
ODD = [
    "", "  ", "a\x1cb\x1f c", "x\x85y z  　q᠎​", "ΑΣ ΟΔΟΣ Σ İstanbul ǅ", "é ́x ①²½ 12345 ٣", "<|endoftext|>abc", "it's WE'RE they'll 'service",
    "😀😀 👩‍👩‍👧 ﬁ Å ẞ", "a" * 100_000, "ab" * 20_000, "abc" * 5000 + "日本語" * 3000, "the" * 99, "\n\n x \n  y\t\tz  ", "''''", "\x00\x01 \x7f",
    "한국어 日本語テキスト ไทย" * 50, " " * 5000, "=" * 3000,
]


def _library(file):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(file, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=FILES)
def file(request):
    return public_tokenizers.path(request.param)


def _cases(texts):
    rnd = random.Random(2)
    made = ["".join(rnd.choice("aabcde \n'<|>st019é😀́\x1e\x85Σ") for _ in range(60)) for _ in range(500)]
    return ODD + made + list(texts.values())


def test_same_ids_and_bytes_as_library(spark, file, texts):
    library, cases = _library(file), _cases(texts)
    df = spark.createDataFrame(list(enumerate(cases)), "n int, text string").repartition(3)
    coded = byte_bpe.encode(df, file, public_tokenizers.PATTERN, outputs=("ids", "packed", "decoded"))
    back = {r.n: r.decoded for r in byte_bpe.decode(coded.select("n", "ids"), file, public_tokenizers.PATTERN).collect()}
    for r in coded.collect():
        ids = library.encode_ordinary(cases[r.n])
        assert r.ids == ids and bytes(r.packed) == struct.pack(f"<{len(ids)}I", *ids)
        assert bytes(r.decoded) == bytes(back[r.n]) == cases[r.n].encode()


def _merged_plainly(ranks, piece):
    parts = [bytes([b]) for b in piece]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_vocabularies_in_any_order():
    """Also where a token has a lower rank than its parts, so that the queue goes back."""
    rnd = random.Random(7)
    for _ in range(30):
        more = {bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(2, 6))) for _ in range(25)}
        tokens = [bytes([b]) for b in range(256)] + sorted(more)
        rnd.shuffle(tokens)
        model = RankModel(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
        pieces = [bytes(rnd.choice(b"abcd") for _ in range(rnd.randrange(0, 300))) for _ in range(20)]
        for piece, ids in zip(pieces, model.merged(pieces)):
            assert list(struct.unpack(f"<{len(ids) // 4}i", ids)) == _merged_plainly(model.ranks, piece)


def test_bitmap():
    rnd, bitmap, held = random.Random(3), RankBitmap(300_000), set()
    for _ in range(3000):
        rank = rnd.randrange(300_000)
        if rnd.random() < 0.6:
            bitmap.add(rank)
            held.add(rank)
        elif held:
            bitmap.remove(min(held))
            held.remove(min(held))
        assert bitmap.first() == min(held, default=-1)


def test_odd_rows(spark, odd, none, file):
    clash = odd.selectExpr("*", "1 AS ids", "'x' AS packed", "2 AS decoded")
    got = byte_bpe.encode(clash, file, public_tokenizers.PATTERN, outputs=("ids", "decoded"))
    assert got.schema["ids"].dataType.simpleString() == "array<int>" and got.count() == odd.count()
    assert {r.packed for r in got.collect()} == {"x"} and set(odd.columns) - {"text"} <= set(got.columns)
    assert {len(r.ids) for r in got.where("doc_id IN (1, 2)").collect()} == {0}
    assert byte_bpe.encode(none, file, public_tokenizers.PATTERN).count() == 0
    ids = spark.createDataFrame([(None,), ([64, None, -1, 10**6],)], "ids array<int>")
    assert [len(r.decoded) for r in byte_bpe.decode(ids, file, public_tokenizers.PATTERN).collect()] == [0, 1]
    with pytest.raises(ValueError):
        RankModel(b"YQ== 0\n")


def test_query(spark, sf_dir, texts):
    library = _library(public_tokenizers.path(FILES[0]))
    rows = queries.op13_byte_bpe_round_trip(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()
