"""Periodic runs against a search of all periods, and the query against plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from pageloom.llm import periodic_runs, queries


def _brute(words, least=24, times=3):
    """(start, length, period) of all runs: for each period the stretches of equal words at that distance."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - start
            if size >= max(least, times * q) and not any(words[start + p : start + size] == words[start : start + size - p] for p in range(1, q)):
                found.append((start, size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _made_up(rnd):
    n = rnd.randrange(150)
    if rnd.random() < 0.3:
        return [rnd.choice("ab") for _ in range(n)]
    if rnd.random() < 0.3:
        a, b = "a", "ab"
        while len(b) < n:
            a, b = b, b + a
        return list(b[:n])
    words = []
    while len(words) < n:
        part = [rnd.choice("abc"[: rnd.randrange(1, 4)]) for _ in range(rnd.randrange(1, 14))] * rnd.randrange(1, 9)
        words += part[: rnd.randrange(1, len(part) + 1)]
    return words


@pytest.mark.parametrize(("least", "times"), [(24, 3), (3, 3), (8, 5)])
def test_runs_of_made_up_texts(spark, least, times):
    rnd = random.Random(least)
    texts = [_made_up(rnd) for _ in range(600)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "n int, text string").repartition(3)
    for r in periodic_runs.find_runs(df, least=least, times=times).collect():
        wanted = _brute(texts[r.n], least, times)
        assert [(x.start, x.length, x.period) for x in r.runs] == wanted
        assert r.n_words == len(texts[r.n]) and r.collapsed == _collapsed(texts[r.n], wanted)


def test_query(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    some = 0
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = _brute(words) if n < 3000 or h % 10 == 0 else None
        r = rows[doc_id]
        if runs is None:
            continue
        some += bool(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(_collapsed(words, runs).encode()).hexdigest()
    assert some > 5


def test_longest_run_is_exact(spark):
    big = 3 * 10**8
    runs = [[(5, big + 1, 10**8), (9, big, 10**8), (10, 30, 10)], [(0, 24, 8), (3, 30, 10)], [], None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(runs)], f"i int, runs {periodic_runs.RUNS}")
    got = {r.i: r.best and tuple(r.best) for r in df.select("i", periodic_runs.longest_run().alias("best")).collect()}
    assert got == {0: (5, big + 1, 10**8), 1: (0, 24, 8), 2: None, 3: None}


def test_odd_rows(spark, odd, none):
    clash = odd.selectExpr("*", "1 AS runs", "'x' AS n_words", "2 AS collapsed", "3 AS start")
    for df in (odd, clash):
        got = periodic_runs.find_runs(df).collect()
        assert len(got) == odd.count()
        long = [r for r in got if r.doc_id == 6]
        assert [(tuple(x), r.collapsed) for r in long for x in r.runs] == [((0, 30_000, 1), "word")]
        assert {(r.n_words, r.collapsed, len(r.runs)) for r in got if r.doc_id in (1, 2, 3)} == {(0, "", 0)}
    assert set(odd.columns) - {"text"} <= set(periodic_runs.find_runs(odd).columns)
    assert periodic_runs.find_runs(none).count() == 0
    split = spark.createDataFrame([("no break space\x85 \x1c" * 30,)], "text string")
    assert periodic_runs.find_runs(split, keep_text=True).first().n_words == 31
    with pytest.raises(ValueError):
        periodic_runs.find_runs(odd, times=2)


def test_long_texts(spark):
    a, b = "a ", "a b "
    while len(b) < 100_000:
        a, b = b, b + a
    texts = ["x y z " * 200_000, "v " * 500_000, b, "one " * 23, "one " * 24]
    got = {r.n: r for r in periodic_runs.find_runs(spark.createDataFrame(list(enumerate(texts)), "n int, text string")).collect()}
    assert [tuple(x) for x in got[0].runs] == [(0, 600_000, 3)] and [tuple(x) for x in got[1].runs] == [(0, 500_000, 1)]
    words = b.split()
    for r in got[2].runs:
        part = words[r.start : r.start + r.length]
        assert part[: -r.period] == part[r.period :] and r.length >= 3 * r.period
    assert [len(got[n].runs) for n in (3, 4)] == [0, 1]
