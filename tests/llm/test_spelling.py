import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from reelsift.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(n):
    words = sorted(n)
    close = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(v, w)] for w in words}
    form = {}
    for w in words:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return out


def made(seed, rows, letters="abcdéß×", n=300):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(4, 9))) for _ in range(40)]
    docs = []
    for i in range(rows):
        words = []
        for _ in range(r.randint(0, n)):
            w = r.choice(base[: r.randint(1, 40)])
            k = r.randrange(len(w))
            w = r.choice([w, w, w, w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1 :], w.upper()])
            words.append(w)
        docs.append((r.choice([i, i, None]), r.choice([" ", "-", "ă", "9", "¿"]).join(words)))
    return docs


def check(spark, docs, **sizes):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = counted(docs)
    assert {(r.word, r.n) for r in spelling.word_counts(df).collect()} == set(want.items())
    got = sorted(tuple(r) for r in spelling.spelling_groups(df).collect())
    assert got == sorted(grouped(want))
    return want


def test_against_brute_force(spark):
    want = check(spark, made(1, 120))
    assert sum(1 for x in grouped(want) if x[1] and x[2] != x[1]) > 0  # chains of forms


def test_few_letters_make_one_large_block(spark):
    check(spark, made(2, 80, "ab"))


def test_tiles_agree(spark):
    want = counted(made(3, 150, "abg"))
    words = spark.createDataFrame(list(want.items()), "word string, n long")
    whole = sorted(map(tuple, spelling.near_words(words).collect()))
    for tile_words, tile_bytes in ((2, 1 << 20), (50, 1 << 20), (4096, 30)):
        assert sorted(map(tuple, spelling.near_words(words, tile_words, tile_bytes).collect())) == whole
    assert {(w, c) for w, c, _, _ in whole} == {(x[0], x[4]) for x in grouped(want) if x[4]}


def test_checksums_of_long_and_short_runs():
    texts = ["a" * 200 + " bcd", "", "é" * 40 + " x" + "yz " * 50]
    w, _ = spelling._letters(*spelling.buffers(pa.array(texts)))
    prefix = np.array([zlib.crc32(b"%d:" % i) for i in range(3)], np.uint32)
    want = [zlib.crc32(f"{i}:{run}".encode()) for i, t in enumerate(texts) for run in RUN.findall(t)]
    assert spelling.checksums(w, prefix).tolist() == want


def test_edits_one_by_one():
    words = ["abcde", "abcdf", "abcd", "bcde", "abXcde", "aabcde", "abced", "abcdeé", "xbcdf", "abcdef", "ab"]
    for a in words:
        for b in words:
            one, other = (spelling._Side(pa.array([x.encode("latin-1")]), np.array([1])) for x in (a, b))
            assert bool(spelling.one_edit(one.codes, one.size, other.codes, other.size)[0]) == near(a, b), (a, b)
            assert bool(len(spelling.near_pairs(one, other, False)[0])) == near(a, b), (a, b)


def test_very_long_words_and_odd_rows(spark, odd, odd_rows, none):
    long = "ab" * 1500
    docs = [(1, f"{long} {long}c {long[:-1]} {long[:700]}z{long[701:]} {long[::-1]}")] * 3 + [(None, None), (2, "")]
    check(spark, docs)
    got = sorted(tuple(r) for r in spelling.spelling_groups(odd).collect())
    assert got == sorted(grouped(counted([(r[0], r[1]) for r in odd_rows])))
    assert spelling.spelling_groups(none).count() == 0
