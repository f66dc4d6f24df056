"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from test_llm import ODD, frame

from lexquarry.llm import variants


def neighbours(word, alphabet):
    n = range(len(word) + 1)
    near = {word[:i] + word[i + 1 :] for i in n[:-1]} | {word[:i] + c + word[i + 1 :] for i in n[:-1] for c in alphabet} | {word[:i] + c + word[i:] for i in n for c in alphabet}
    return near - {word}


def test_edits_are_all_and_distinct(monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choice("abcé") for _ in range(r.randrange(3, 12))) for _ in range(60)] + ["aaaaaa", "ab" * 40]
    alphabet = np.array(sorted(map(ord, "abcéz")), np.uint64)
    everything = np.full(1 << (variants.BITS - 6), np.iinfo(np.uint64).max, np.uint64)
    for block in (variants.BLOCK, 64):  # long words are taken in pieces
        monkeypatch.setattr(variants, "BLOCK", block)
        found = Counter(x for near, of in variants.edits(words, alphabet, everything, 3) for x in zip(of, near))
        assert found == Counter((w, x) for w in words for x in neighbours(w, "abcéz") if len(x) >= 3)


def test_filter_holds_every_word():
    r = random.Random(4)
    words = sorted({"".join(r.choice("abcd") for _ in range(r.randrange(3, 7))) for _ in range(2000)})
    bits = np.zeros(1 << (variants.BITS - 6), np.uint64)
    for x in variants._filter_rows(iter([pa.RecordBatch.from_pydict({"word": words})])):
        bits[x["slot"].to_numpy()] |= x["bits"].to_numpy().view(np.uint64)
    alphabet = np.array(sorted(map(ord, "abcd")), np.uint64)
    found = [x for near, of in variants.edits(words, alphabet, bits, 3) for x in zip(of, near)]
    want = {(w, x) for w in words for x in neighbours(w, "abcd") if x in set(words)}
    assert want <= set(found) and len(found) < len(want) + 50


def test_long_texts_are_cut_between_words():
    text = "Éclair ABCdefghé, xyz " * 40 + "a" * 500
    for size in (1, 7, 64):
        assert variants.text_words(text, None, size) == Counter(re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))


def expected(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    alphabet, form, out = set("".join(n)), {}, set()
    near = {w: [x for x in neighbours(w, alphabet) if x in n] for w in n if len(w) < 100}
    for w, k in n.items():
        best = min(near.get(w, []), key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * k else None
    for w, k in n.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, k, len(near.get(w, [])), n[form[w]] if form[w] else None))
    return out


def test_query_against_brute_force(spark, tmp_path):
    r = random.Random(8)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randrange(5, 10))) for _ in range(30)]

    def slip(w):
        i = r.randrange(len(w))
        return r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abcÉ×") + w[i + 1 :], w[:i] + r.choice("abcÉ") + w[i:], w.upper()])

    texts = [*ODD, "reference " * 300, "referense " * 25, "Referensee " * 2]
    for _ in range(120):
        picked = [w if r.random() < 0.9 else slip(w) if r.random() < 0.8 else slip(slip(w)) for w in r.choices(words, [1 / (i + 1) for i in range(30)], k=200)]
        texts.append("; ".join(picked))
    docs = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = variants.op11_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = {tuple(x) for x in got.collect()}
    want = expected([(x["doc_id"], x["text"]) for x in docs.collect()])
    assert rows == want and got.count() == len(want)
    assert any(form and root != form for _, form, root, *_ in want) and any(near and not form for _, form, _, _, near, _ in want)
