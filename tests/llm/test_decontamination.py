import hashlib
import random

import pytest

from reelsift.llm import decontamination as dec


def tokens(text):
    out, word = [], ""
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out + ([word] if word else [])


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        w, hit, met = tokens(text), set(), set()
        for item_id, item in items:
            t = tokens(item)
            n = min(window, len(t))
            grams = {tuple(t[i : i + n]) for i in range(len(t) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    met.add("" if item_id is None else str(item_id))
        sha = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(met), sha, bool(hit)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def made(seed, n_docs=60, n_items=12):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "B", "cc", "ü", "7", "Dé", "x-y", "é.", "long"])
    items = [(i, " ".join(word() for _ in range(r.choice([0, 1, 2, 5, 9, 10, 11, 30])))) for i in range(n_items)]
    items += [(2, items[5][1]), (40, items[7][1]), (None, "only null"), (50, None), (51, "...")]
    docs = []
    for i in range(n_docs):
        text = " ".join(word() for _ in range(r.randint(0, 40)))
        if i % 3 == 0:
            text += " zz " + (r.choice(items)[1] or "")
        docs.append((i % 50, text))
    return docs + [(None, "only, NULL!"), (None, None), (7, ""), (8, "\x00\x01"), (9, items[3][1])], items


@pytest.mark.parametrize(("seed", "window", "block"), [(1, 10, 1 << 20), (2, 3, 1 << 20), (3, 3, 60), (4, 1, 40)])
def test_against_brute_force(spark, seed, window, block):
    r = random.Random(seed)
    docs, items = made(seed)
    if seed in (2, 3):
        items = [x for x in items if x[1] is None or len(tokens(x[1])) != 1]
    docs = [(i, t if t is None or r.random() < 0.9 else t * 40) for i, t in docs]
    d, b = frames(spark, docs, items)
    got = sorted((tuple(x) for x in dec.contamination(d, b, window, block).collect()), key=repr)
    assert got == brute(docs, items, window)
    bad = {(x[0], x[1]) for x, y in zip(docs, [brute([y], items, window)[0] for y in docs], strict=True) if y[5]}
    kept = dec.decontaminated(d.withColumn("row", d.doc_id * 2), b, window, block)
    assert kept.columns == ["doc_id", "text", "row"]
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=repr) == sorted([x for x in docs if x not in bad], key=repr)


def test_small_shards_agree(spark, monkeypatch):
    docs, items = made(8, 200)
    monkeypatch.setattr(dec, "SHARD_PLACES", 3)
    d, b = frames(spark, docs, items)
    got = sorted((tuple(x) for x in dec.contamination(d, b, 4).collect()), key=repr)
    assert got == brute(docs, items, 4)


def test_longest_matches_and_places(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, f"zero zero {item} zero"), (2, "two three four five six seven eight nine ten eleven no one two"), (3, "five six seven"), (4, f"{item} {item}")]
    d, b = frames(spark, docs, [(5, item), (6, f"x {item}"), (7, "zero zero")])
    got = sorted(tuple(r) for r in dec.longest_matches(d, b).collect())
    assert got == sorted([
        (1, "5", 2, 0, 12), (1, "6", 2, 1, 12), (1, "7", 0, 0, 2),
        (2, "5", 0, 1, 10), (2, "6", 0, 2, 10),
        (4, "5", 0, 0, 12), (4, "5", 12, 0, 12), (4, "6", 0, 1, 12), (4, "6", 12, 1, 12),
    ])


def test_odd_rows_and_empty_tables(spark, odd, odd_rows, none):
    items = [(1, odd_rows[1][1]), (2, None), (None, "one two")]
    b = spark.createDataFrame([(*x, 9, "s") for x in items], "item_id long, text string, doc_id long, row string")
    got = sorted((tuple(x) for x in dec.contamination(odd, b).collect()), key=repr)
    assert got == brute([(r[0], r[1]) for r in odd_rows], items, 10)
    assert dec.contamination(none, b).count() == 0 and dec.decontaminated(none, b).count() == 0 and dec.longest_matches(none, b).count() == 0
    empty = b.limit(0)
    assert dec.contamination(odd, empty).where("contaminated").count() == 0
    assert dec.decontaminated(odd, empty).count() == len(odd_rows)
