"""Vector codes, license scans and spelling variants against brute force, edge cases included."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from playlake.llm import license_scan, spelling, vector_codes
from tests.llm.conftest import prose

# ---------------------------------------------------------------- vector codes

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType()),
                        T.StructField("ints", T.LongType()), T.StructField("dim", T.LongType())])


def brute_codes(rows, parts, entries, rounds):
    """vec_id, code, error, label of the rows that can be coded, and the codebooks."""
    ok = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(ok[0][1]) // parts
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in ok[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        groups = [[[] for _ in book] for book in books]
        for _, v, _ in ok:
            for p, x in enumerate(cut(v)):
                groups[p][near(x, books[p])[1]].append(x)
        books = [[[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(gs, book)]
                 for gs, book in zip(groups, books)]
    out = []
    for i, v, lab in ok:
        found = [near(x, books[p]) for p, x in enumerate(cut(v))]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
    return out, books


def check_codes(spark, rows, kept, rest=(), parts=4, entries=8, rounds=2):
    """``kept``: the rows of ``rows`` that are coded; ``rest``: (vec_id, label) of those kept without a code."""
    df = spark.createDataFrame([(i, v, lab, "c", 1, 2) for i, v, lab in rows], VECTORS).repartition(3)
    done, books = vector_codes.compress(df, parts, entries, rounds)
    want, want_books = brute_codes(kept, parts, entries, rounds)
    sums = Counter()
    for _, _, e, lab in want:
        sums[lab] += e
    got = sorted(map(tuple, done.collect()), key=repr)
    assert got == sorted([(i, lab, c, e, sums[lab]) for i, c, e, lab in want]
                         + [(i, lab, None, None, sums[lab] if lab in sums else None) for i, lab in rest], key=repr)
    assert books.tolist() == want_books
    text = ",".join(str(x) for book in want_books for e in book for x in e)
    assert vector_codes.books_sha256(books) == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", range(3))
def test_codes_match_brute_force(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, .2) for x in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(400)]
    check_codes(spark, rows, rows, entries=16, rounds=3)


def test_codes_ties_repeats_and_coarse_values(spark):
    rng = random.Random(5)
    rows = [(i % 90, [rng.choice([-1, 0, 1]) / 256 for _ in range(8)], 1) for i in range(150)]
    check_codes(spark, rows + rows[:20], rows + rows[:20])


def test_codes_of_unusual_vectors(spark):
    rng = random.Random(6)
    good = [(None if i < 3 else i, [rng.uniform(-2, 2) for _ in range(8)], i % 3 or None) for i in range(60)]
    far = [(700, [300.0 * k for k in range(8)], 1), (701, [-(2.0 ** 20)] * 8, 1)]
    dropped = [(800, None, 1), (801, [1.0, None] * 4, 1), (802, [float("nan")] * 8, 1), (803, [float("inf")] * 8, 1)]
    uncoded = [(900, [1.0] * 4, 5), (901, [], 1), (902, [1e300] * 8, 2), (903, [1.0] * 7, None)]
    check_codes(spark, good + far + dropped + uncoded, good + far, [(i, lab) for i, _, lab in uncoded])


def test_codes_of_few_or_no_vectors(spark):
    check_codes(spark, [(3, [.5] * 8, 1)], [(3, [.5] * 8, 1)])
    empty = spark.createDataFrame([], VECTORS)
    done, books = vector_codes.compress(empty)
    assert done.collect() == [] and books.size == 0
    done, _ = vector_codes.compress(spark.createDataFrame([(1, [1.0] * 3, 1, "", 0, 0)], VECTORS))
    assert [tuple(r) for r in done.collect()] == [(1, 1, None, None, None)]


def test_bounds_hold_and_leave_out_distances():
    rng = np.random.default_rng(1)
    centres = rng.integers(-900, 900, (20, 4))
    x = centres[rng.integers(0, 20, 3000)] + rng.integers(-40, 40, (3000, 4))
    book = x[:20].copy()
    code, _, upper, near, low, outer = vector_codes.track_all(x, book, 5)
    measured = []
    for _ in range(4):
        new = np.array([x[code == k].sum(axis=0) // max(1, (code == k).sum()) if (code == k).any() else book[k]
                        for k in range(len(book))])
        moves = np.sqrt(((new - book) ** 2).sum(axis=1).astype(float)) * (1 + 1e-9)
        book = new
        code, squared, upper, near, low, outer, depth = vector_codes.track_again(x, book, moves, code, upper, near, low, outer)
        d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (code == d.argmin(axis=1)).all()
        real = np.sqrt(d)
        assert (upper >= real.min(axis=1)).all()
        assert (low <= np.take_along_axis(real, near.astype(int), 1) + 1e-9).all()
        assert (np.diff(low.astype(float), axis=1) >= 0).all()
        others = real.copy()
        np.put_along_axis(others, near.astype(int), np.inf, 1)
        others[np.arange(len(x)), code] = np.inf
        assert (outer <= others.min(axis=1)).all()
        measured.append((depth > 0).mean())
    assert measured[-1] < 0.2


# ---------------------------------------------------------------- license scans


def brute_licenses(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for t in license_scan.PHRASES:
        p = t.markup.split()
        places += [(s, t.label, len(p)) for s in range(len(words)) if words[s:s + len(p)] == p]
    own = [(t.label, license_scan.mandatory_words(t.markup)) for t in license_scan.TEMPLATES
           if re.search(license_scan.as_regex(t.markup), " " + " ".join(words) + " ")]
    starts = [s for s, _, _ in places]
    longest = max([z for _, _, z in places] + [z for _, z in own], default=0)
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({lab for _, lab, _ in places})),
            ",".join(sorted({lab for _, lab, _ in places} | {lab for lab, _ in own})), longest / len(words) if words else 0.0)


def filled(rng, markup):
    """A wording that the markup accepts."""
    def of(items):
        for x in items:
            if isinstance(x, list):
                if rng.random() < .5:
                    yield from of(x)
            elif isinstance(x, license_scan.Any):
                yield from (rng.choice(["acme", "inc", "the", "software", "ñandú"]) for _ in range(rng.randint(x.low, x.high)))
            else:
                yield x if rng.random() < .7 else x.upper()
    return rng.choice([" ", ", ", "\n"]).join(of(license_scan.parse(markup)))


def check_licenses(make_docs, pairs):
    got = license_scan.license_report(make_docs(pairs)).drop("matches").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *brute_licenses(t)) for i, t in pairs], key=repr)


def test_licenses_match_brute_force(make_docs):
    rng = random.Random(3)
    texts = [prose(rng, 20)]
    for t in license_scan.PHRASES + license_scan.TEMPLATES:
        good = filled(rng, t.markup)
        words = good.split(" ")
        del words[len(words) // 2]
        texts += [good, prose(rng, 5) + " " + good + ". " + prose(rng, 5), good + " " + good, " ".join(words), good[:-1]]
    texts += ["under the MIT under the MIT License", "CC BY-NC 4.0 cc-by-nc", "all all rights rights reserved", "licensed under the apache license version 2.0"]
    check_licenses(make_docs, list(enumerate(texts)))


def test_licenses_of_unusual_texts(make_docs):
    notice = "Licensed under the Apache License, Version 2.0."
    long = "x" * 3_000_000 + " " + notice + " " + "lorem ipsum " * 200_000 + notice
    pairs = [(1, None), (2, ""), (3, " \n\x00\t-"), (None, notice), (5, notice), (5, notice), (6, long), (7, "ÉCOLE under the mit license é")]
    check_licenses(make_docs, pairs)
    check_licenses(make_docs, [])


def test_license_matches_have_their_spans(make_docs):
    row = license_scan.license_report(make_docs([(1, "so: Licensed under the terms of the MIT License, ok")])).first()
    assert {(m["label"], m["name"], m["first"], m["last"]) for m in row["matches"]} == {("mit", "short notice", 1, 8)}
    row = license_scan.license_report(
        make_docs([(1, "a b c d c d e")]), [], [license_scan.Template("l", "n", "a [b] c {0,1} d e")]).first()
    assert [(m["first"], m["last"]) for m in row["matches"]] == []
    row = license_scan.license_report(
        make_docs([(1, "a b c d c d e")]), [], [license_scan.Template("l", "n", "a [b [x]] c {0,3} d [c] e")]).first()
    assert [(m["first"], m["last"]) for m in row["matches"]] == [(0, 6)]


def test_markup_must_close_and_end_with_words():
    for bad in ("a [b", "[a] b", "a {1,2}", ""):
        with pytest.raises(ValueError):
            license_scan.parse(bad)


# ---------------------------------------------------------------- spelling variants


def brute_words(pairs, every=97):
    n = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(n, ratio=2):
    links = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if near(a, b):
            links[a].append(b)
            links[b].append(a)
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def variants(words, **options):
    return sorted(tuple(r) for r in spelling.spelling_variants(words, **options).collect())


def test_words_and_variants_of_documents_match_brute_force(make_docs):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    pairs = [(rng.choice([None, 1, 2, 3, k]), " ".join(rng.choice(base + [w[:-1] + "z" for w in base] + ["Ébcde", "abc"])
              for _ in range(60)) + rng.choice(["", " ABCDE", "; x_fooBAR9 ×÷abcd"])) for k in range(40)] + [(5, None), (6, "")]
    found = spelling.frequent_words(spelling.noisy_words(make_docs(pairs), every=7))
    n = brute_words(pairs, every=7)
    assert {r["word"]: r["n"] for r in found.collect()} == n
    assert variants(found) == brute_variants(n)


@pytest.mark.parametrize("block_words", [5_000, 40])
def test_variants_match_brute_force_over_many_blocks(spark, block_words, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(spelling, "SAMPLE", 300)
    n = {"".join(rng.choice("abcd") for _ in range(rng.randint(5, 8))): rng.randint(3, 400) for _ in range(1200)}
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    assert variants(words, block_words=block_words) == brute_variants(n)


def test_variants_of_words_that_share_all_their_letters(spark):
    n = {"".join(p): 3 for p in itertools.permutations("abcdef")}
    n |= {"a" * 300: 9, "a" * 301: 30, "a" * 299 + "b": 4, "abcdeg": 50, "abcde": 200}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = variants(words, block_words=50)
    assert got == brute_variants(n)
    assert dict((w, r) for w, _, r, *_ in got)["abcdef"] == "abcde"


def test_a_long_chain_of_forms_has_one_root(spark):
    n = {"a" * k: 3 * 2 ** k for k in range(5, 40)}
    got = variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert got == brute_variants(n) and {r[2] for r in got} == {"a" * 39}


def test_no_words_no_rows(make_docs):
    none = spelling.frequent_words(spelling.noisy_words(make_docs([])))
    assert variants(none) == [] and variants(spelling.frequent_words(spelling.noisy_words(make_docs([(1, None)])))) == []
