"""Token shards: the permutation and an exact round trip from the files."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from pageloom.llm import token_shards
from pageloom.llm.shared import stored

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    order = token_shards.Permutation(size, 7)
    slots = order.slots(np.arange(size))
    assert sorted(slots) == list(range(size))
    assert (order.indexes(slots) == np.arange(size)).all()
    if size > 100:
        assert (slots != np.arange(size)).mean() > 0.9
        assert (token_shards.Permutation(size, 8).slots(np.arange(size)) != slots).any()


def _written(spark, df, length=64, records=100):
    root, manifest = token_shards.write_shards(df, FILE, public_tokenizers.PATTERN, 42, length=length, shard_records=records)
    rows = {r.slot: r for r in manifest.collect()}
    read = {r.slot: bytes(r.tokens) for r in token_shards.read_slots(spark, root, length, records).collect()} if rows else {}
    return root, rows, read


def test_round_trip(spark, documents, texts):
    root, rows, read = _written(spark, stored(documents.repartition(3), "in"))
    assert sorted(rows) == sorted(read) == list(range(len(rows)))
    assert all(hashlib.sha256(read[s]).hexdigest() == r.sha256 and r.byte_offset == s % 100 * 128 for s, r in rows.items())
    slots = token_shards.Permutation(len(rows), 42).slots(np.arange(len(rows))).tolist()
    stream = np.concatenate([np.frombuffer(read[s], np.uint16)[: rows[s].n_tokens] for s in slots])
    encoding = token_shards.encoding_of(open(FILE, "rb").read(), public_tokenizers.PATTERN)
    ends = np.flatnonzero(stream == 50256)
    decoded = [encoding.decode(stream[a:b].tolist()) for a, b in zip([0, *(ends[:-1] + 1)], ends)]
    assert sorted(decoded) == sorted(texts.values())
    owners = [d for s in slots for d in rows[s].doc_ids]
    assert set(owners) == set(texts)
    for s in slots[:-1]:
        assert len(rows[s].doc_ids) in (np.count_nonzero(np.frombuffer(read[s], np.uint16)[: rows[s].n_tokens] == 50256) + k for k in (0, 1))
    later = token_shards.read_slots(spark, root, 64, 100, start=150)
    assert {r.slot for r in later.collect()} == set(range(150, len(rows)))


def test_same_bytes_again(spark, documents):
    table = stored(documents.limit(50).repartition(2), "in")
    assert _written(spark, table)[2] == _written(spark, table)[2]


def test_odd_rows(spark, odd, none):
    _, rows, read = _written(spark, odd)
    assert {d for r in rows.values() for d in r.doc_ids} == {None, 1, 2, 3, 4, 5, 6, 7, 8}
    assert len(rows) == len(read)
    assert _written(spark, none)[1] == {}
