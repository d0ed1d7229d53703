"""Counting, the search with one error, and forms and roots, against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from emberlink.llm import spelling as sp
from emberlink.llm.fm_index import Index, near_words, sort_suffixes

LETTERS = sp._LETTERS.decode("latin-1")


def _near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


WORDS = st.sets(st.binary(min_size=1, max_size=9).map(lambda b: bytes(1 + x % 2 for x in b)), min_size=1, max_size=40)


@settings(max_examples=60, deadline=None)
@given(WORDS)
def test_suffixes_are_sorted_by_word_then_place(words):
    text = np.frombuffer(b"\0" + b"".join(w + b"\0" for w in sorted(words)), np.uint8)
    raw = text.tobytes()
    suffix = lambda i: raw[i : raw.index(0, i)]
    assert sort_suffixes(text).tolist() == sorted(range(len(raw)), key=lambda i: (suffix(i), raw.index(0, i)))


@settings(max_examples=120, deadline=None)
@given(WORDS, WORDS)
def test_one_error_after_an_exact_half(words, asked):
    """The index of both directions finds what all pairs find, each pair once and direction."""
    words, asked = sorted(words), sorted(asked)
    for turn in (1, -1):
        index = Index([w[::turn] for w in words], 3)
        queries = [a[::turn] for a in asked]
        exact = np.array([len(q) // 2 for q in queries])
        got = [(q, index.words[w]) for qs, ws in near_words(index, queries, exact, together=7) for q, w in zip(qs.tolist(), ws.tolist())]
        want = {
            (i, w) for i, q in enumerate(queries) for w in index.words
            if _near(q, w) and w[len(w) - len(q) // 2 :] == q[len(q) - len(q) // 2 :]
        }
        assert len(got) == len(set(got)) and set(got) == want


def _brute(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    form, near = {}, {}
    for w in words:
        near[w] = [x for x in words if _near(w, x)]
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return rows


def _docs():
    rng = random.Random(11)
    base = ["".join(rng.choice("aéb") for _ in range(rng.randint(5, 9))) for _ in range(60)]

    def vary(w):
        i, kind = rng.randrange(len(w)), rng.randrange(6)
        return [w, w, w, w[:i] + w[i + 1 :], w[:i] + rng.choice("abÿ") + w[i + 1 :], w[:i] + rng.choice("abÀ") + w[i:]][kind]

    texts = [" ".join(vary(rng.choice(base[: rng.randint(1, 60)])) for _ in range(200)) for _ in range(40)]
    long = "z" * 3_000
    return [
        *enumerate(texts),
        *[(100 + i, f"{long} Word-WORDS ÀÉÎÕÜ ÀÉÎÕÜ {long[1:]} straße×straße ıdotless 日本 \x00tabs\ttabs") for i in range(4)],
        (104, None), (105, ""), (106, "123 !"), (None, "nulls nulls nulls nulled nulled nulled"), (0, texts[0]), (0, texts[0]),
    ]


@pytest.mark.parametrize("index_chars", [sp.INDEX_CHARS, 600, 150])
def test_against_all_pairs(spark, index_chars):
    """Also with indexes so small that every key is cut, into several parts."""
    docs = spark.createDataFrame(_docs(), "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "'x' AS tile")
    got = [tuple(r) for r in sp.variants(sp.count_words(docs), index_chars=index_chars).collect()]
    want = _brute(_docs())
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(r[1] is not None for r in want) > 30 and any(r[1] not in (None, r[2]) for r in want)


def test_each_pair_of_like_halves_meets_once(spark):
    words = spark.createDataFrame([(w, 3) for w in ("aaaab", "aaaac", "aaaad", "baaad", "caaad", "aaaaab")], "word string, n long")
    rows = sp.dealt_out(words, index_chars=10).collect()
    for a in {r["word"] for r in rows}:
        for b in {r["word"] for r in rows} - {a}:
            tiles = [{r["tile"] for r in rows if r["word"] == w and r[flag]} for w, flag in ((a, "asks"), (b, "indexed"))]
            assert len(tiles[0] & tiles[1]) == (a[:2] == b[:2]) + (a[-3:] == b[-3:])


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sp.variants(sp.count_words(docs)).collect() == []


def test_letters():
    assert [ord(c) for c in LETTERS] == [*range(97, 123), *range(0xC0, 0x100)] and len(set(sp._TO_SYMBOL)) == len(LETTERS) + 1
