"""SimHash near-duplicates and exact deduplication against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
import xxhash

from pageloom.llm import exact_dedup, queries, simhash
from pageloom.llm.components import components


def signed(x):
    return int(np.uint64(x).view(np.int64))


def brute_components(prints):
    every = sorted(set(prints))
    values, root = np.array(every, np.uint64), list(range(len(every)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(every)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return {x: every[find(i)] for i, x in enumerate(every)}


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("compared", [4096, 4])
def test_no_link_is_lost(spark, compared):
    rnd, prints = random.Random(3), {0, 1, 7, 15, 1 << 63, (1 << 64) - 1}
    for _ in range(20):
        center = rnd.getrandbits(64)
        for _ in range(50):
            x = center
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    df = spark.createDataFrame([(signed(x),) for x in prints], "print long").repartition(3)
    root = {r.node: r.root for r in components(simhash.links(df, compared)).collect()}
    groups = {}
    for x in prints:
        groups.setdefault(root.get(signed(x), signed(x)), set()).add(x)
    wanted = {}
    for x, r in brute_components(prints).items():
        wanted.setdefault(r, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in components(links).collect()} == {0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _expected(rows):
    prints = [brute_print(t) for _, t in rows]
    root, least = brute_components(prints), {}
    for (i, _), p in zip(rows, prints):
        least[root[p]] = min(x for x in (least.get(root[p]), i) if x is not None) if (i is not None or root[p] in least) else None
    return sorted(((i, f"{p:016x}", least[root[p]]) for (i, _), p in zip(rows, prints)), key=repr)


def test_query(spark, sf_dir, texts):
    got = sorted((tuple(r) for r in queries.op4_simhash_near_dedup(spark, sf_dir).collect()), key=repr)
    assert got == _expected(list(texts.items()))


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = simhash.near_duplicates(odd).collect()
    assert sorted(((r.doc_id, f"{r.print & (1 << 64) - 1:016x}", r.component_id) for r in got), key=repr) == _expected(rows)
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.root for r in got})
    assert simhash.near_duplicates(none).count() == simhash.drop_near_duplicates(none).count() == 0


def _groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return groups


def test_dedup_of_odd_rows(spark, odd, none):
    wanted = []
    for text, ids in _groups((r.doc_id, r.text) for r in odd.collect()).items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        wanted += [(i, keep, len(ids), i == keep, digest) for i in ids]
    got = exact_dedup.mark_duplicates(odd).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == len(_groups((r.doc_id, r.text) for r in odd.collect()))
    assert exact_dedup.mark_duplicates(none).count() == exact_dedup.drop_duplicates(none).count() == 0


def test_small_tables_split_buckets_again(spark, documents):
    keys = exact_dedup.keyed(documents, "doc_id", "text")
    assert sorted(exact_dedup.groups(documents, keys, table_bytes=5000).collect()) == sorted(exact_dedup.groups(documents, keys).collect())


def test_equal_hashes_are_compared_in_full():
    table = exact_dedup.OpenTable()
    for i in range(3000):
        table.add(i % 7, b"text %d" % (i % 500), i, 1, 0)
    assert len(table.rows) == len({(i % 7, i % 500) for i in range(3000)})
    assert sum(r[3] for r in table.rows) == 3000


def test_a_table_counts_its_rows():
    """What a table of short texts takes in memory is within what it counts."""
    tracemalloc.start()
    table = exact_dedup.OpenTable()
    before, _ = tracemalloc.get_traced_memory()
    for i in range(60_000):
        table.add(i * 2654435761 % (1 << 62), b"%d" % i, i + 10**6, 1, i % 7 + 10**6)
    after, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert after - before < table.bytes < 2 * (after - before)
