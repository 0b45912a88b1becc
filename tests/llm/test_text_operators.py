import hashlib
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from llm_helpers import prose, split
from pyspark.sql import functions as F

from reelsift.llm import chat_format, isolation_rules, linking, minhash, minmax_dedup, packing, quality_classifier, tag_paths, textkit, toxicity
from reelsift.llm.subword import labelled_sample


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- words and shingles -------------------------------------------------------


def test_words_and_hashes(odd_rows):
    texts = [r[1] for r in odd_rows]
    w = textkit.words(pa.array(texts, pa.string()))
    assert w.count.tolist() == [len(split(t)) for t in texts]
    flat = [x for t in texts for x in split(t)]
    h = textkit.hash_spans(w).tolist()
    by = {}
    for a, b in zip(flat, h, strict=True):
        assert by.setdefault(a, b) == b
    assert len(set(by.values())) == len(by)
    sliced = pa.array(["zz", *texts], pa.string()).slice(1)
    assert textkit.hash_spans(textkit.words(sliced)).tolist() == h
    low = textkit.hash_spans(w, lower=True).tolist()
    assert all(low[i] == low[j] for i, j in [(flat.index("one"), flat.index("One"))])


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_shingles_are_word_runs(odd_rows, k):
    texts = [r[1] for r in odd_rows]
    w = textkit.words(pa.array(texts, pa.string()))
    s, off = textkit.distinct_sets(*textkit.shingles(textkit.hash_spans(w), w.off, k))
    for i, t in enumerate(texts):
        x = split(t)
        want = {tuple(x[j : j + k]) for j in range(len(x) - k + 1)} if len(x) >= k else {tuple(x)} if x else set()
        assert off[i + 1] - off[i] == len(want)


# ---- op1 ----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{color:red}</style><script>var a = "</p><article>no</article>";</script></head>
<body class="page"><header><a href=/>Site</a> <p>Slogan of the site, long enough, with commas, and so on.</p></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies, you know, for many, many things.</div>
<div id="wrap"><%s class="post">
<h1>Short &lt;head&gt;</h1><div class="ad-box">Buy this, now, it is cheap.</div>
<p>First   paragraph,\nwith <b>bold</b>&nbsp;text, commas, and <a href="x">a link</a>.<br>Next line.
<p>Second &quot;one&quot;: unclosed, like the first.<script>bad()</script>
<ul><li>item one, here</li><li>item two</li></ul><!-- <p>comment</p> -->
<form><p>Your name, please.</p><input></form>
<p>Ok.</p></%s>
<aside><p>Other stories, by others, for others, all of them long.</p></aside>
<div id="comments"><p>Reader one says, well, this and that, at length.</p></div></div>
<footer><p>Imprint, all rights reserved, somewhere.</p></footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_main_text(tag):
    want = ["Short <head>", "First paragraph, with bold text, commas, and a link. Next line.", 'Second "one": unclosed, like the first.', "item one, here", "item two", "Ok."]
    assert tag_paths.main_text(PAGE % (tag, tag)) == "\n\n".join(want)


def test_main_text_of_broken_pages():
    for page in (None, "", "   ", "<html><body></body></html>", "<script>never closed", "<!-- never closed", "<p", "<nav>x</nav>"):
        assert tag_paths.main_text(page) == ""
    assert tag_paths.main_text("just text, 3 < 4 &amp; so on") == "just text, 3 < 4 & so on"
    assert tag_paths.main_text("<article><p>a<p>b</article><footer>c") == "a\n\nb"
    assert tag_paths.main_text("<body>" + "<div>" * 3000 + "<p>deep, it is.</p>") == "deep, it is."


@pytest.mark.parametrize("attr", ['href="/hidden-costs"', 'title="The hidden cost"', 'data-hidden="false"', 'data-url="/posts/hidden-gems"', 'data-id="menu"', 'href="/news?id=share"', "title='a class=ad b'", "data-x=id=menu", 'aria-hidden="false"', 'title = "hidden"', 'data-role="menu" x'])
def test_attributes_are_read_by_their_own_names(attr):
    assert tag_paths.main_text(f"<article><p>One, <a {attr}>two</a>.</p></article>") == "One, two."
    assert tag_paths.main_text(f"<article {attr}><p>One, two.</p></article>") == "One, two."


@pytest.mark.parametrize("attr", ["hidden", "HIDDEN", 'hidden=""', 'x="1" hidden', 'x="1"hidden', 'x=1 id="menu"', "x class=ad", "class = 'b ad'", 'role="menu"', 'aria-hidden="true"', 'style="display: none"'])
def test_hidden_and_named_elements_are_left_out(attr):
    assert tag_paths.main_text(f"<article><p>One, <span {attr}>two</span>.</p></article>") == "One, ."


@pytest.mark.parametrize("mark", ['<svg class="i"/>', "<svg/>", '<math a=">" />', '<svg a="/"><title>t</title><path d="x"/></svg>', "<svg><path/></svg>", "<svg-icon></svg-icon>", "<title-bar></title-bar>"])
def test_text_after_pictures_stays(mark):
    assert tag_paths.main_text(f"<article><p>a</p>{mark}<p>b text</p></article>") == "a\n\nb text"


BODY = "".join(f"<p>Paragraph {i} of the article, which is long enough, has commas, and ends with a stop.</p>" for i in range(6))
BLOCKS = [f"Paragraph {i} of the article, which is long enough, has commas, and ends with a stop." for i in range(6)]


@pytest.mark.parametrize("wrap", ['class="content with-sidebar"', 'class="page no-sidebar has-comments"', 'class="main sidebar-right"', 'id="related-work"', 'class="share-buybacks"'])
def test_wrappers_of_the_article_stay(wrap):
    want = "\n\n".join(["Title", *BLOCKS])
    assert tag_paths.main_text(f"<body><div {wrap}><article><h1>Title</h1>{BODY}</article></div></body>") == want
    assert tag_paths.main_text(f"<body><div {wrap}><h1>Title</h1>{BODY}</div></body>") == want


@pytest.mark.parametrize("part", ['<h2 id="share-price-falls">X</h2>', '<h2 id="related-work">X</h2>', '<p id="menu-of-options">X</p>', '<p id="menu">X</p>', '<section id="share-buybacks"><p>X</p></section>',
                                  "<ul><li>X</li></ul>", "<table><tr><td>X</td></tr></table>", "<p>X</p>", '<h3 class="c">X</h3>', '<p class="plain"><a href="x">X</a> and a sentence, which is long, with marks, and more.</p>'])
def test_short_parts_of_the_article_stay(part):
    text = tag_paths.main_text(f"<article><h1>T</h1>{BODY}{part}{BODY}</article>").split("\n\n")
    assert text[7].startswith("X") and text[:7] == ["T", *BLOCKS] and text[8:] == BLOCKS


@pytest.mark.parametrize("part", ['<div class="partner-offer">Buy now</div>', '<ul class="more-links"><li><a href="x">One</a></li><li><a href="y">Two</a></li></ul>', '<ul><li><a href="x">One</a></li><li><a href="y">Two</a></li></ul>',
                                  '<h3>See more</h3><ul class="x"><li><a href="x">One</a></li></ul><h2>Part</h2>', '<div class="user-opinions"><p>I think, as a reader, that this is right.</p></div>', '<article class="comment"><p>I think so, too.</p></article>'])
def test_parts_that_are_not_the_article_leave(part):
    text = tag_paths.main_text(f"<article><h1>T</h1>{BODY}{part}{BODY}</article>").split("\n\n")
    assert [t for t in text if t != "Part"] == ["T", *BLOCKS, *BLOCKS]


def test_ratios_decide(monkeypatch):
    page = f'<article>{BODY}<div class="partner-offer">Buy now</div>{BODY}</article>'
    assert "Buy now" not in tag_paths.main_text(page)
    monkeypatch.setattr(tag_paths, "WITHIN", 0.0)
    assert "Buy now" in tag_paths.main_text(page)


def test_ratios_against_a_plain_sum():
    nodes = tag_paths.parse(f'<article>{BODY}<div class="x">Buy now</div><p>Short.</p></article>')
    chars, share, links = tag_paths.content_nodes(nodes)
    text = [t for _, t, _ in nodes]
    kind = ["x" if t == "Buy now" else "p" for t in text]
    per = {}
    for k in set(kind):
        own = [t for t, o in zip(text, kind, strict=True) if o == k]
        per[k] = sum(map(len, own)) / len(own) * (1 + sum(c in ".,;:!?" for t in own for c in t) / len(own))
    ratio = [per[k] for k in kind]
    smooth = [(ratio[max(i - 1, 0)] + 2 * ratio[i] + ratio[min(i + 1, len(ratio) - 1)]) / 4 for i in range(len(ratio))]
    mean = sum(smooth) / len(smooth)
    assert chars.tolist() == [len(t) for t in text] and not links.any()
    assert np.allclose(share, [s / mean for s in smooth])


def test_extracted_rows(spark):
    rows = [(1, "u", PAGE % ("article", "article"), "x"), (1, "u", PAGE % ("article", "article"), "y"), (None, None, None, None), (2, None, "", "t")]
    got = tag_paths.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.n_chars, len(r.text)) for r in got) == sorted((r[0] or 0, len(tag_paths.main_text(r[2])), len(tag_paths.main_text(r[2]))) for r in rows)
    assert tag_paths.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---- op2 ----------------------------------------------------------------------


def slow_statistics(text):
    text = text or ""
    w = split(text)
    win = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if split(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rule_statistics(odd_rows):
    texts = [r[1] for r in odd_rows] + ["a b c\na b c\n\n\na b c \na b c", "x x x x x", "\n\n\n", "p|q <r> #s\r\np|q <r> #s\r\n", "é\nü\né"]
    got = isolation_rules.statistics(pa.array(texts, pa.string()))
    assert [tuple(int(got[c][i]) for c in isolation_rules.COUNTS) for i in range(len(texts))] == [slow_statistics(t) for t in texts]


def test_forest_isolates_and_threshold_follows_labels():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.1, (1000, 4)), rng.normal(4, 0.3, (30, 4))])
    score = isolation_rules.Forest(x).score(x)
    good = np.arange(1030) < 1000
    cut = isolation_rules.threshold(score, good)
    assert (score[~good] > cut).mean() > 0.95 and (score[good] > cut).mean() <= 0.005
    assert isolation_rules.threshold(score, np.ones(1030, bool)) == np.inf
    same = isolation_rules.Forest(np.zeros((50, 4)))
    assert len(set(same.score(np.zeros((5, 4))))) == 1
    assert len(isolation_rules.Forest(np.zeros((0, 4))).score(np.ones((3, 4)))) == 3


def test_excess_is_nothing_within_the_range_of_good_rows():
    rng = np.random.default_rng(1)
    good = rng.normal(0.5, 0.05, (5000, len(isolation_rules.RATIOS)))
    x = isolation_rules.Excess(good)
    assert (x(good) > 0).any(axis=1).mean() < 0.03 and x(good).shape == (5000, len(isolation_rules.RATIOS) + 1)
    low, high = np.quantile(good, 0.001, axis=0), np.quantile(good, 0.999, axis=0)
    far = x(np.stack([high + (high - np.median(good, axis=0)), low - (np.median(good, axis=0) - low)]))
    assert np.allclose(far[0, :-1], np.log(2)) and far[0, -1] == 0
    assert np.allclose(far[1, :-1], 0) and np.isclose(far[1, -1], np.log(2))
    assert np.isfinite(isolation_rules.Excess(np.zeros((0, len(isolation_rules.RATIOS))))(good)).all()


def slow_score(forest, row):
    total = 0.0
    for t in range(len(forest.feature)):
        at = 0
        while not np.isnan(forest.split[t, at]):
            at = 2 * at + 1 + int(row[forest.feature[t, at]] >= forest.split[t, at])
        total += forest.length[t, at]
    return 2.0 ** (-total / len(forest.feature) / forest.norm)


def test_verdict_follows_the_forest(spark):
    """Kept rows are those whose path through a forest walked in plain Python is long enough."""
    docs, marked = [], []
    for i in range(600):
        text = prose(i, 120)
        if i % 12 == 0:  # symbols of differing number
            text = " ".join(w + "%" * (3 + i % 7) if j % (2 + i % 3) == 0 else w for j, w in enumerate(text.split(" ")))
        docs.append((i, text))
        marked.append((i, int(i % 12 != 0)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame([m for m in marked if m[0] <= 500], "doc_id long, quality int")
    got = {r.doc_id: r for r in isolation_rules.quality_rules(frame, known).collect()}
    stats = isolation_rules.statistics(pa.array([t for _, t in docs], pa.string()))
    x = np.stack([stats[c] for c in isolation_rules.RATIOS], axis=1)
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i, _ in docs])
    use = np.array([not got[i].base_failed for i, _ in docs])
    train = use & (fold != 0) & (np.arange(600) <= 500)
    quality = np.array([q for _, q in marked])
    measure = isolation_rules.Excess(x[train & (quality == 1)])
    out = measure(x)
    score = np.array([got[i].anomaly for i, _ in docs])
    drawn = [r.doc_id for r in frame.orderBy(F.xxhash64("doc_id", F.lit(isolation_rules.SEED))).select("doc_id").collect()]
    forest = isolation_rules.Forest(out[[i for i in drawn if use[i]]])
    assert np.allclose(score[:60], [slow_score(forest, r) for r in out[:60]])
    cut = isolation_rules.threshold(score[train], quality[train] == 1)
    assert [got[i].kept for i, _ in docs] == [bool(u and s <= cut) for u, s in zip(use, score, strict=True)]
    held = use & (fold == 0)
    assert not any(got[i].kept for i in np.flatnonzero(held & (quality == 0)))


def test_paths_decide_between_slight_and_strong_excess():
    rng = np.random.default_rng(3)
    x = np.zeros((4000, 9))
    slight, strong = np.arange(4000) % 20 == 0, np.arange(4000) % 20 == 1
    x[slight, rng.integers(0, 9, slight.sum())] = rng.uniform(0.01, 0.3, slight.sum())
    for c in range(3):
        x[strong, c] = rng.uniform(1, 3, strong.sum())
    score = isolation_rules.Forest(x[::2]).score(x)
    cut = isolation_rules.threshold(score, ~strong)
    assert (score[strong] > cut).mean() > 0.95 and (score[slight] <= cut).mean() > 0.9


def test_repeated_labelled_ids_do_not_depend_on_the_layout(spark):
    rows = [(i % 40, prose(i, 80) + (" ###" * 40 if i % 7 == 0 else "")) for i in range(200)]
    known = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, quality int")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    a = sorted((r.doc_id, r.n_symbols, r.anomaly, r.kept) for r in isolation_rules.quality_rules(frame.coalesce(1), known, labelled_rows=30).collect())
    b = sorted((r.doc_id, r.n_symbols, r.anomaly, r.kept) for r in isolation_rules.quality_rules(frame.repartition(6), known, labelled_rows=30).collect())
    assert a == b


def test_quality_rules(spark, odd, odd_rows, none, labels):
    got = isolation_rules.quality_rules(odd, labels).collect()
    assert len(got) == len(odd_rows)
    want = Counter((r[0], *slow_statistics(r[1])) for r in odd_rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert isolation_rules.quality_rules(none, labels).count() == 0
    assert isolation_rules.quality_rules(odd, labels.limit(0)).where("not base_failed and not kept").count() == 0


# ---- op4 and op8 --------------------------------------------------------------


def classified(n=400):
    rows = []
    for i in range(n):
        t = prose(1000 + i, 60)
        junk, toxic = i % 4 == 0, i % 3 == 0
        if junk:
            t = t.upper().replace(" ", "!! ")
        if toxic:
            w = t.split(" ")
            w[10 + i % 40] = "zzidiot" + "xyzq"[i % 4]
            t = " ".join(w)
        rows.append((t, int(not junk), int(toxic)))
    return rows


def test_quality_classifier_learns():
    rows = classified()
    f, b = quality_classifier.train([r[0] for r in rows[:300]], np.array([r[1] for r in rows[:300]]))
    s = quality_classifier.score_texts(pa.array([r[0] for r in rows[300:]]), f, b)
    assert ((s >= 0.5) == [r[1] for r in rows[300:]]).mean() > 0.97
    again = quality_classifier.train([r[0] for r in rows[:300]], np.array([r[1] for r in rows[:300]]))
    assert np.array_equal(f, again[0]) and b == again[1]


def test_toxicity_learns_unseen_spellings():
    rows = classified(900)
    f, b = toxicity.train([r[0] for r in rows[:700]], np.array([r[2] for r in rows[:700]]))
    s = toxicity.score_texts(pa.array([r[0] for r in rows[700:]]), f, b)
    assert ((s >= 0.5) == [r[2] for r in rows[700:]]).mean() > 0.95
    clean = next(r[0] for r in rows[700:] if not r[2])
    long = " ".join([clean] * 200)
    assert toxicity.score_texts(pa.array([long, long + " zzidiotw"]), f, b)[1] > 0.5 > toxicity.score_texts(pa.array([long]), f, b)[0]


@pytest.mark.parametrize("module, run", [(quality_classifier, "quality_scores"), (toxicity, "toxicity_scores")])
def test_scores_of_odd_rows(spark, odd, odd_rows, none, labels, module, run):
    got = getattr(module, run)(odd, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= module.THRESHOLD)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    same = {}
    for r in got:
        if r.doc_id in (0, 1):
            same.setdefault("x", set()).add(r.score)
    assert len(same["x"]) == 1  # equal texts, equal scores
    assert getattr(module, run)(none, labels).count() == 0
    assert getattr(module, run)(odd, labels.limit(0)).count() == len(odd_rows)


def test_repeated_ids_teach_their_smallest_text(spark):
    docs = [(i % 8, f"text {i:03d}") for i in range(400)] + [(3, None), (None, "x")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    seen = set()
    for parts in (1, 7):
        texts, label = labelled_sample(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts), labels, "quality", 1_500, 200_000, 41)
        seen.add((tuple(texts), tuple(label)))
    [(texts, label)] = seen
    learnt = [i for i in range(8) if zlib.crc32(str(i).encode()) % 5]
    assert list(texts) == ["" if i == 3 else f"text {i:03d}" for i in learnt] and list(label) == [i % 2 for i in learnt]


def slow_word_features(word, lower):
    """Hash buckets of a word and its 3 to 5 character windows with edge marks, by arithmetic on Python integers."""
    low = "".join(chr(ord(c) + 32) if lower and "A" <= c <= "Z" else c for c in word)
    marked = f"<{low}>"
    out = [int(textkit.hash_spans(textkit.words(pa.array([word], pa.large_string())), lower)[0])]
    for k in (3, 4, 5):
        for i in range(len(marked) - k + 1):
            acc = 0
            for c in marked[i : i + k]:
                acc = int(textkit.mix(np.array([(acc * 0x9E3779B97F4A7C15 + ord(c)) % 2**64], np.uint64))[0])
            out.append((acc + k) % 2**64)
    return [x % quality_classifier.BUCKETS for x in out]


def test_scores_equal_plain_averages():
    """Both classifiers' scores against averages of the folded table, taken word by word."""
    r = np.random.default_rng(1)
    folded = r.standard_normal(quality_classifier.BUCKETS + quality_classifier.REPEATS)
    texts = ["", " ", "One two three", "a bb a bb a bb ccc", "same same same word", "ß é🙂 Word, again\tand again and again", "w" * 40, " ".join(f"Term{i} of" for i in range(40))]
    value = lambda w, lower: float(np.mean([folded[f] for f in slow_word_features(w, lower)]))
    quality, toxic = [], []
    for t in texts:
        w = split(t)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        total = 0.0
        for i, x in enumerate(w):
            total += value(x, False)
            total += folded[quality_classifier.BUCKETS] * (i > 0 and w[i - 1] == x)
            total += folded[quality_classifier.BUCKETS + 1] * any(windows[tuple(w[j : j + 3])] > 1 for j in range(max(0, i - 2), min(i, len(w) - 3) + 1))
        quality.append(1 / (1 + math.exp(-(total / max(len(w), 1) + 0.25))))
        runs = [x for i, x in enumerate(w) if not i or lower(w[i - 1]) != lower(x)]
        bags = [runs[i : i + toxicity.BAG] for i in range(0, len(runs), toxicity.BAG)]
        toxic.append(max((1 / (1 + math.exp(-(np.mean([value(x, True) for x in b]) + 0.25))) for b in bags), default=0.0))
    column = pa.array(texts, pa.large_string())
    assert np.allclose(quality_classifier.score_texts(column, folded, 0.25), quality, atol=1e-9)
    assert np.allclose(toxicity.score_texts(column, folded[: toxicity.BUCKETS], 0.25), toxic, atol=1e-9)


def test_held_out_labels_are_not_learnt(spark, odd, labels):
    from pyspark.sql import functions as F

    from reelsift.llm.subword import labelled_sample

    ids = odd.join(labels.select("doc_id", "quality"), "doc_id")
    texts, y = labelled_sample(odd, labels, "quality", 5, 10**6, 1)
    assert 0 < len(texts) and (y == 0).sum() <= 3 * 5 and (y == 1).sum() <= 3 * 5  # repeated rows of an id come along
    only = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    assert ids.count() and labelled_sample(odd, only, "quality", 5, 10**6, 1)[0] == []


# ---- op5 ----------------------------------------------------------------------


def test_chat_round_trip(spark, odd_rows):
    nasty = ["\\", "\\\\###", "####", "</turn>", "\\</turn>\n### user: x</turn>\n", "</tur", "n>", "###", chat_format.EXTRA, "", None, "é🙂", "a: b"]
    turns = [(c, t, r, x, "w") for c in range(4) for t, (r, x) in enumerate(zip(["user", "assistant", "sys:tem", "###\\", None] * 3, nasty, strict=False))]
    turns += [(9, i, "assistant" if i % 2 else "user", f"turn {i}", "w") for i in range(300)] + [(None, 0, "user", "x", None), (None, None, "assistant", "y", None)]
    turns += [turns[0]]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, formatted string").repartition(5)
    got = {r.conv_id: r for r in chat_format.chat_digests(spark, frame).collect()}
    by = {}
    for c, t, r, x, _ in [*turns, (-7, 0, "user", chat_format.EXTRA, None), (-7, 1, "assistant", chat_format.EXTRA, None)]:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, rows in by.items():
        rows.sort()
        loss = "".join(x for _, r, x in rows if r == "assistant")
        assert got[c].n_turns == len(rows)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in rows).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    parts = chat_format.formatted(frame).orderBy("task", "seq").collect()
    whole = {}
    for p in parts:
        whole[p.conv_id] = whole.get(p.conv_id, b"") + bytes(p.formatted)
    for c, data in whole.items():
        assert [(r.decode(), x.decode()) for r, x in chat_format.parse(data)] == [(r, x) for _, r, x in sorted(by[c])]
        assert got[c].formatted_chars == len(data.decode())
    assert chat_format.formatted(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat_format.parse(b"### user: x")


# ---- op6 ----------------------------------------------------------------------


def test_fingerprints(spark, odd, odd_rows, none):
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    got = minhash.fingerprints_with_edit(odd.repartition(7)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, r in enumerate(rows):
        a, b = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        want[(r[0], len(a), hashlib.sha256((a[: len(a) - len(a) // 2] + b[: len(a) // 2]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by[0] == by[1] and by[3] == by[5] == {""} and by[0] != by[2]
    assert minhash.fingerprints_with_edit(none).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    assert minhash.fingerprints_with_edit(one).first().near_next == 1.0


def test_fingerprint_ranges_do_not_change_the_result(spark, monkeypatch):
    rows = [(i * 7, f"text {i} " + "w " * (i % 9), None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(6)
    one = sorted(tuple(r) for r in minhash.fingerprints_with_edit(docs).collect())
    monkeypatch.setattr(minhash, "PART_ROWS", 9)
    assert sorted(tuple(r) for r in minhash.fingerprints_with_edit(docs).collect()) == one


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(3)
    w = [f"w{x}" for x in rng.integers(0, 10**6, 600)]
    a, b = " ".join(w[:400]), " ".join(w[100:500])
    sa, sb = ({tuple(x.split()[i : i + 5]) for i in range(len(x.split()) - 4)} for x in (a, b))
    f = minhash.fingerprint(pa.array([a, b]))
    assert abs(minhash.likeness(f[:1], f[1:])[0] - len(sa & sb) / len(sa | sb)) < 0.15


# ---- op6 and op9: near-duplicate groups ----------------------------------------


def slow_groups(rows, k, percent, fold):
    sets = {}
    for d, t in rows:
        x = split(lower(t) if fold else t)
        sets[d] = {tuple(x[j : j + k]) for j in range(len(x) - k + 1)} if len(x) >= k else {tuple(x)} if x else set()
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def edited(seed, n=60, families=6):
    import random

    r = random.Random(seed)
    rows, i = [], 0
    for f in range(families):
        base = [f"f{f}w{j}" for j in range(40 + 10 * f)]
        for _ in range(n // families):
            x = list(base)
            for _ in range(r.randint(0, 9)):
                x[r.randrange(len(x))] = r.choice(["the", "of", f"n{r.randrange(30)}"])
            if r.random() < 0.2:
                x = x[: int(len(x) * r.uniform(0.6, 1))]
            rows.append((i, " ".join(x)))
            i += 1
    return rows


@pytest.mark.parametrize("module, k, fold", [(minmax_dedup, 2, True), (minhash, 5, False)])
def test_groups_match_brute_force(spark, module, k, fold):
    rows = edited(1, 120) + [(900, "one"), (901, "ONE"), (902, "one two"), (903, "One two"), (904, ""), (905, None), (906, " \n"), (907, "a b"), (908, "a b c")]
    rows = [(3 * d, t) for d, t in rows]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n long").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in module.near_duplicates(docs).collect()}
    assert got == slow_groups(rows, k, 80, fold)


def test_families_under_the_threshold_make_no_pairs(spark):
    """Sets of one core and own shingles: no pair at Jaccard 0.78, and with sizes around the threshold
    little but links; no link is left out, whatever else the sets share."""
    core = list(range(89))
    same = {i: core + [1000 + 100 * i + j for j in range(12)] for i in range(300)}
    r = random.Random(3)
    sizes = {i: core + [1000 + 100 * i + j for j in range(r.randint(6, 20) if i else 0)] for i in range(300)}
    mixed = {i: s + r.sample(range(500, 520), 6) for i, s in sizes.items()}
    some = {i: r.sample(range(30), r.randint(1, 30)) for i in range(300)}
    for sets in (same, sizes, mixed, some):
        rows = spark.createDataFrame([(0, i, i, i > 0) for i in sets], "main long, id long, comp long, minor boolean")
        table = spark.createDataFrame([(i, s) for i, s in sets.items()], "id long, shingles array<long>")
        got = {(p.a, p.b) for p in linking._prefix_pairs(rows, table, 80).collect()}
        whole = {i: set(s) for i, s in sets.items()}
        want = {(a, b) for a in sets for b in sets if a < b and 100 * len(whole[a] & whole[b]) >= 80 * len(whole[a] | whole[b])}
        assert want <= got
        assert sets not in (same, sizes) or len(got) <= 1.1 * len(want)


def test_families_around_the_threshold_are_not_compared_in_full(spark, monkeypatch):
    """Copies that missed their leader: rounds of few pairs link most of them, with the groups of all pairs."""
    r, rows = random.Random(5), []
    for fam in range(2):
        core = [f"w{fam}x{i}" for i in range(150)]
        for _ in range(200):
            t = list(core)
            for _ in range(r.randint(0, 9)):
                t[r.randrange(150)] = f"z{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(t)))
    compared, verified = [], linking._verified
    monkeypatch.setattr(linking, "_verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in minmax_dedup.near_duplicates(docs).collect()}
    assert got == slow_groups(rows, 2, 80, True)
    assert sum(compared) < 10_000  # all pairs of rows apart: about 20,000


def test_groups_of_odd_rows(spark, odd, odd_rows, none):
    got = minmax_dedup.near_duplicates(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    want = slow_groups([(r[0], r[1]) for r in odd_rows if r[0] is not None], 2, 80, True)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert minmax_dedup.near_duplicates(none).count() == 0
    left = minmax_dedup.keep_one(odd).collect()
    assert sorted(r.doc_id for r in left if r.doc_id is not None) == sorted({t for _, t in want.values()})
    assert sum(r.doc_id is None for r in left) == 2 and minmax_dedup.keep_one(none).count() == 0
    clean = odd.where("doc_id >= 100")
    assert [r.doc_id for r in minmax_dedup.keep_one(clean).collect()] == [100]


def test_components(spark):
    from reelsift.llm.graph import components, jump

    path = [(i, i + 1) for i in range(50)] + [(100, 103), (103, 101), (7, 7)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {100: 100, 101: 100, 103: 100}
    tree = spark.createDataFrame([(i, i - 1) for i in range(1, 40)], "id long, comp long")
    assert {r.comp for r in jump(tree).collect()} == {0}


# ---- op7 ----------------------------------------------------------------------


def test_packing(spark, odd, odd_rows, none, monkeypatch):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for r in odd_rows:
        ids.setdefault(r[0], []).append([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0])
    for part in (packing.PART_TOKENS, 20_000):
        monkeypatch.setattr(packing, "PART_TOKENS", part)
        monkeypatch.setattr(packing, "BLOCK_TOKENS", 1000)
        got = packing.packed(odd, with_ids=True).collect()
        assert sum(r.length for r in got) == sum(len(x) for v in ids.values() for x in v)
        seqs = {}
        for r in got:
            assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
            seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
            if len(ids[r.doc_id]) == 1:
                whole = ids[r.doc_id][0]
                assert r.doc_tokens == len(whole) and np.frombuffer(bytes(r.ids), "<u4").tolist() == whole[r.start : r.start + r.length]
        assert sorted(seqs) == list(range(len(seqs)))
        for pieces in seqs.values():
            at = 0
            for o, n in sorted(pieces):
                assert o == at
                at += n
            assert at <= 1024 and at & (at - 1) == 0
        for d, whole in ids.items():
            if len(whole) == 1:
                spans = sorted((r.start, r.length) for r in got if r.doc_id == d)
                assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()]
    assert packing.packed(none).count() == 0


def test_added_tokens_inside_texts(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, f"a{end}", f"a {end}  b", f"{end}{end}x", f" \n {end} \n ", f"<|{end}|>", "<|endoftext|", "<|ENDOFTEXT|>", f"é{end}🙂", f"don{end}'t"]
    got = packing.tokenized(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "'s' as source", "text")).collect()
    for r in got:
        assert np.frombuffer(bytes(r.ids), "<u2").tolist() == [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 0] and r.n == len(r.ids) // 2
    assert len(got) == len(texts)


def test_deal_keeps_the_mixture():
    amounts = np.array([50_000, 30_000, 15_000, 4_999, 1, 0])
    got = np.zeros(6, np.int64)
    for i, take in enumerate(packing.deal(amounts, 4096)):
        got += take
        assert (take >= 0).all() and (i < 24) == (take.sum() == 4096)
        assert (abs(got - amounts * got.sum() / amounts.sum()) <= 2).all()  # what is owed is carried, not lost
    assert (got == amounts).all()
    assert packing.tail(2 * 1024 + 7, 1024) == [1024, 1024, 4, 2, 1]
    assert packing.tail(0, 1024) == []


def test_quantiles_of_all_rows_equal_numpys(spark):
    rng = np.random.default_rng(4)
    rows = pd.DataFrame({"a": rng.normal(size=4000), "b": np.where(rng.random(4000) < 0.9, 0.0, rng.random(4000)), "c": np.ones(4000)})
    qs = [0.001, 0.5, 0.999]
    for n in (1, 2, 330, 4000):
        got = isolation_rules.exact_quantiles(spark.createDataFrame(rows[:n]).repartition(5), list("abc"), qs)
        assert (got == np.quantile(rows[:n].to_numpy(), qs, axis=0)).all()


def test_trees_draw_rows_of_their_own_and_labels_are_not_bounded():
    import inspect

    x = np.arange(200 * isolation_rules.TREE_ROWS, dtype=float)[:, None]
    seen = []
    grow = isolation_rules.Forest._grow

    class Watched(isolation_rules.Forest):
        def _grow(self, rng, t, node, level, part):
            if not level:
                seen.append(part[:, 0])
                return grow(self, rng, t, node, self.depth, part)

    Watched(x)
    assert len(seen) == 200 and len(np.unique(np.concatenate(seen))) == len(x)
    options = inspect.signature(isolation_rules.quality_rules).parameters
    assert "sample_rows" not in options and options["labelled_rows"].default is None


def test_models_are_trained_in_a_task_and_not_in_the_driver(spark, monkeypatch):
    """Neither the sample's texts nor the training come to the driver; the model is that of ``train`` over the sample."""
    from reelsift.llm import quality_classifier
    from reelsift.llm.subword import labelled_sample, trained

    rows = [(i, f"good plain words number {i % 7}" if i % 2 else f"buy buy cheap {i % 5} now now", i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    sample = (docs, labels, "quality", 20, 1000, 41)
    folded, bias = quality_classifier.train(*labelled_sample(*sample))
    got, got_bias = trained(quality_classifier.train, *sample)
    assert np.array_equal(got, folded.astype(np.float32)) and got_bias == bias
    assert trained(quality_classifier.train, docs, labels.limit(0), *sample[2:])[1] == 0.0
    here = os.getpid()

    def elsewhere(texts, label):
        return np.array([float(os.getpid() != here)]), float(len(texts))

    assert trained(elsewhere, *sample)[0][0] == 1.0
