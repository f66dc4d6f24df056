"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from test_llm import ODD, frame

from lexquarry.llm import periodic


def brute(word, least=6, times=4):
    """Every period, every stretch."""
    found = {}
    for q in range(1, len(word) // times + 1):
        at = 0
        while at + q < len(word):
            end = at
            while end + q < len(word) and word[end] == word[end + q]:
                end += 1
            if end > at and end + q - at >= max(least, times * q):
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def odd_words(r):
    word, letters = [], r.randrange(1, 5)
    for _ in range(r.randrange(1, 9)):
        word += [r.randrange(letters) for _ in range(r.randrange(1, 7))] * r.choice([1, 1, 2, 5, 9])
        if r.random() < 0.3:
            at = r.randrange(len(word))
            word += word[at : at + r.randrange(1, 60)]
    return word


def test_runs_against_brute_force():
    r = random.Random(4)
    for _ in range(600):
        word = odd_words(r)
        for least, times in ((6, 4), (2, 2), (4, 3)):
            want = brute(word, least, times)
            assert periodic.runs(word, least, times) == want
            assert periodic.text_runs(np.array(word), least, times) == want


def test_factors_are_the_longest_that_began_before():
    r = random.Random(9)
    for _ in range(200):
        word = odd_words(r)
        at = 0
        for start, end, source in periodic.factors(word):
            assert start == at and (source == -1) == (word[start] not in word[:start])
            at = end
            if source >= 0:
                assert source < start and word[source : source + end - start] == word[start:end]
                assert end == len(word) or not any(word[s : s + end + 1 - start] == word[start : end + 1] for s in range(start))
        assert at == len(word)


def test_running_text_leaves_little():
    r = random.Random(2)
    words = np.array([r.randrange(4000) for _ in range(20_000)])
    words[500:520] = words[900:920]
    words[7000:7040] = np.tile(words[7000:7008], 5)
    assert periodic.stretches(words) == [(7000, 7040)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = sorted((-Fraction(length, q), s, q, length) for s, length, q in found)[:1]
    most = (best[0][1], best[0][3], best[0][2], 1000 * best[0][3] // best[0][2]) if best else (None,) * 4
    listed, left = "".join("%d,%d,%d\n" % x for x in found), " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *most, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def texts():
    r = random.Random(6)
    made = [" ".join(f"w{x}" for x in odd_words(r)) for _ in range(150)]
    return [*(x for x in ODD), *made, "a b " * 9 + "\x85 \xa0 " * 5, "no\nno\tno\x0bno\x0cno\rno"]


def test_query_against_brute_force(spark, tmp_path):
    docs = frame(spark, texts())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op12_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got), key=key) == sorted((expected(x["doc_id"], x["text"]) for x in docs.collect()), key=key)


def test_texts_without_repeats(spark):
    docs = spark.createDataFrame([(1, "on and " * 8 + "off", "x"), (2, None, "y"), (3, " as  it is ", "z")], "doc_id long, text string, n_runs string")
    assert sorted(periodic.without_repeats(docs).collect()) == [(1, "on and off", "x"), (2, None, "y"), (3, " as  it is ", "z")]
