import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import prose
from tokenizers import Tokenizer

from reelsift.llm import token_alignment as ta


@pytest.fixture(scope="module")
def both():
    return ta.coders(ta.vocabularies())


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in visible}
    shown |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in shown)}
    back = {c: b for b, c in shown.items()}
    return t, m, back


def tokens(libraries, text):
    t, m, back = libraries
    if not text:
        return [], []
    a = [(i, bytes(back[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in m.encode(text):
        p = m.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def spans(ts):
    out, at = [], 0
    for i, x in ts:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(libraries, docs):
    seen = []
    for doc_id, text in docs:
        a, b = (spans(x) for x in tokens(libraries, text))
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, _, e in a if low < e <= c) + "|" + ",".join(str(i) for i, _, e in b if low < e <= c))
            low = c
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        seen.append((doc_id, len(a), len(b), len(groups), links, sha))
    n = Counter(p for *_, links, _ in seen for p in set(links))
    top = defaultdict(int)
    for (i, _), c in n.items():
        top[i] = max(top[i], c)
    return sorted([(d, x, y, g, len(ls), sum(n[p] == top[p[0]] for p in ls), sum(n[p] for p in ls), sha) for d, x, y, g, ls, sha in seen], key=repr)


ODD = ["", None, " ", "a", "  two  spaces ", "x▁y", "<|endoftext|> <s> <unk> <0x41>", "ﬁ ½ é \U0001f600", "tab\tnew\r\nline\x00\x1c z", "ends in space ", "a" * 700, "漢字かな交じり文" * 30, "1234567890 12,5%"]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_against_the_libraries(spark, libraries):
    docs = list(enumerate(ODD)) + [(20 + i, prose(i, 30)) for i in range(8)] + [(20, prose(0, 30)), (None, "null id"), (None, None)]
    want = brute(libraries, docs)
    df = frame(spark, docs)
    got = ta.alignment(df)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == want
    # every text in ranges of a few bytes, put together over several levels; counts joined by a shuffle
    cut = ta.alignment(df, long_bytes=0, range_bytes=7, broadcast_rows=0)
    assert sorted(map(tuple, cut.collect()), key=repr) == want


def whole(both, text):
    return ta.fragment(both.tokens(text), 0, 1 << 40, both)


def same(x, y):
    fields = lambda f: [getattr(getattr(f, side), c).tolist() for side in ("prefix", "suffix") for c in ta.FIELDS]
    m = lambda f: (f.middle.n_a, f.middle.n_b, f.middle.groups, f.middle.links, f.middle.text, f.middle.pairs.tolist(), f.middle.times.tolist())
    return fields(x) == fields(y) and m(x) == m(y) and (x.cut, x.bad) == (y.cut, y.bad)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 40])
def test_fragments_compose_associatively(both, size):
    r = random.Random(size)
    for text in [x for x in ODD if x and "▁" not in x] + [prose(3, 20), "unbelievably internationalisation " * 3]:
        parts = [ta.fragment(both.tokens(piece, start), low, high, both) for _, low, high, start, piece in ta.ranges(text, size)]
        full = whole(both, text)
        assert not len(full.prefix.a) and not len(full.suffix.a) and full.cut
        assert same(ta.compose(parts, both), full)
        while len(parts) > 1:  # any bracketing
            i = r.randrange(len(parts) - 1)
            parts[i : i + 2] = [ta.compose([parts[i], ta.EMPTY, parts[i + 1]], both)]
        assert same(parts[0], full)


def test_open_parts_of_a_range(both):
    t = both.tokens("hello unbelievable")
    f = ta.fragment(t, 3, 12, both)  # begins and ends inside words
    assert f.cut and len(f.prefix.a) + len(f.prefix.b) and f.prefix.a_end.max() == f.prefix.b_end.max() == 6
    assert f.middle.groups == len(set(t.a_end[(t.a_end > 6) & (t.a_end <= 12)].tolist()) & set(t.b_end.tolist()))
    assert ta.fragment(None, 0, 5, both).bad and same(ta.compose([], both), ta.EMPTY)


def test_pieces_are_cut_where_no_token_crosses():
    text = "word " * 50 + "x" * 90 + " tail  two"
    for n, low, high, start, piece in ta.ranges(text, 32):
        assert low == 32 * n and start <= low and (" " + text).startswith(" " + piece, start)
        assert len(piece) < 32 + 100 and start + 1 + len(piece) >= high
    assert [p for *_, p in ta.ranges(text, 1000)] == [text]


def test_odd_rows_and_empty_table(spark, libraries, odd, odd_rows, none):
    rows = [r for r in odd_rows if not r[1] or len(r[1]) < 5000]
    got = ta.alignment(spark.createDataFrame(rows, odd.schema))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(libraries, [(r[0], r[1]) for r in rows])
    assert ta.alignment(none).count() == 0
    long = odd.where("length(text) >= 5000")
    assert sorted(map(tuple, ta.alignment(long).collect())) == sorted(map(tuple, ta.alignment(long, long_bytes=1 << 30).collect()))
