"""The adaptive prefix join against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from test_llm import BIG, ODD, frame

from lexquarry.llm import adaptive


def bag(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def expected(rows):
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            linked = rows[i][0] == rows[j][0] or (bags[i] and bags[j] and 100 * len(bags[i] & bags[j]) >= 80 * len(bags[i] | bags[j]))
            if linked and None not in (rows[i][0], rows[j][0]) and bags[i] and bags[j]:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        members[find(i)].append(doc)
    return Counter((doc, len(bags[i]), None if doc is None else min(members[find(i)])) for i, (doc, _) in enumerate(rows))


def copies(r, words, base, n, most):
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randrange(0, most)):
            at = r.randrange(len(copy))
            copy[at : at + 1] = r.choice([[], [r.choice(words)], [copy[at], r.choice(words)]])
        yield " ".join(copy)


def test_components_against_brute_force(spark):
    r = random.Random(5)
    words, texts = [f"w{i}" for i in range(300)], list(ODD)
    passage = [r.choice(words) for _ in range(40)]  # many texts share it
    for i in range(40):
        base = [r.choice(words) for _ in range(r.choice([3, 5, 9, 30, 120, 400]))] + (passage if i % 2 else [])
        texts += copies(r, words, base, r.choice([1, 2, 4, 12]), max(2, len(base) // 25))
    docs = frame(spark, texts)
    got = adaptive.similar_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want = expected([(x["doc_id"], x["text"]) for x in docs.collect()])
    assert Counter(map(tuple, got.collect())) == want and len({x[2] for x in want}) < len(texts) - 40


@pytest.mark.parametrize("pairs, levels, check", [(1 << 21, adaptive.LEVELS, 0.01), (300, adaptive.LEVELS, 0.01), (2000, (2, 32), 40.0)])
def test_any_level_gives_the_same_links(spark, monkeypatch, pairs, levels, check):
    """Copies of texts at similarities from 0.2 to 1, with light and heavy shingles, short and long prefixes."""
    monkeypatch.setattr(adaptive, "PAIRS", pairs)
    monkeypatch.setattr(adaptive, "LEVELS", levels)
    monkeypatch.setattr(adaptive, "CHECK", check)
    r = random.Random(11)
    words = [f"w{i}" for i in range(80)]
    texts = [x for n in (40, 150) for x in copies(r, words, [r.choice(words) for _ in range(n)], 90, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, adaptive.similar_components(docs).collect())) == expected(list(enumerate(texts)))


def test_prefixes_are_lengthened_where_shingles_are_common(spark):
    from lexquarry.llm.neardup import SETS

    common = list(range(1000, 1100))
    sets = [(i, i, [*range(i * 200, i * 200 + 5), *common]) for i in range(60)] + [(90, 90, [7 * 10**6, *range(200, 205), *range(8 * 10**6, 8 * 10**6 + 60)])]
    got = adaptive.prefixes(spark.createDataFrame([(i, d, [x + 10**7 if x in common else x for x in c]) for i, d, c in sets], SETS), 80).collect()
    levels = {x["id"]: x["level"] for x in got}
    assert levels and min(levels.values()) > 1 and all(x["level"] + 105 - 84 > x["seat"] for x in got if x["id"] != 90)


def test_rounds_grow_slower_than_unlike_documents(spark, monkeypatch):
    """Texts of common passages only, unlike each other: each round takes twice as many of a heavy shingle's classes."""
    passages = [" ".join(f"p{i}x{j}" for j in range(12)) for i in range(10)]
    texts = [" ".join(x) for x in combinations(passages, 6)]
    monkeypatch.setattr(adaptive, "PAIRS", 500)
    monkeypatch.setattr(adaptive, "LEADERS", 2)
    rounds, staged = [], adaptive.staged
    monkeypatch.setattr(adaptive, "staged", lambda df, name: (rounds.append(name), staged(df, name))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, adaptive.similar_components(docs).collect())) == expected(list(enumerate(texts)))
    assert 1 < rounds.count("mains") <= 9


def test_large_ids_and_clashing_columns(spark):
    rows = [(BIG[0], "a b c d e f g", 1, "x"), (BIG[1], "a b c d e f g", 2, "y"), (None, "a b c d e f g", 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, token string").coalesce(1)
    assert {tuple(x) for x in adaptive.similar_components(docs).collect()} == {(BIG[0], 3, BIG[0]), (BIG[1], 3, BIG[0]), (None, 3, None)}
