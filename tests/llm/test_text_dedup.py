"""Substring dedup, exact dedup and SimHash near-duplicates against brute force on small inputs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from playlake.llm import hash_index, simhash, substring_dedup
from playlake.llm.components import connected_components
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed, n=60):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(0, 120)) for _ in range(n)]
    passage, line = prose(rng, 55), prose(rng, 21)
    for i in range(0, n, 3):
        texts[i] = f"{prose(rng, 9)}\n{passage}\t{texts[i]}"
    for i in range(0, n, 4):
        texts[i] += "\x0b " + line + "  " + line
    texts[5] = texts[11] = texts[17] = texts[8]
    texts[20] = "same " * 90
    texts[21] = "same " * 30
    texts[22] = None
    texts[23] = ""
    texts[24] = " \n\t "
    texts[25] = " ".join([passage] * 40)
    return [(1000 - 7 * i, t) for i, t in enumerate(texts)]


def plain_removal(pairs, length):
    seen, out = set(), {}
    for k, (i, text) in sorted(enumerate(pairs), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[1][1] or "")):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - length + 1):
            w = tuple(words[s:s + length])
            if w in seen:
                gone[s:s + length] = [True] * length
            seen.add(w)
        out[k] = (i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return sorted(out.values(), key=repr)


def test_different_words_of_one_rolling_hash_are_told_apart(make_docs):
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    rest = " ".join(f"w{i}" for i in range(19))
    pairs = [(1, f"{thue} {rest}"), (2, f"{thue.translate(str.maketrans('ab', 'ba'))} {rest}"), (3, f"{thue} {rest}")]
    rows = substring_dedup.remove_repeated_windows(make_docs(pairs), min_words=20).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {1: 0, 2: 0, 3: 20}
    with pytest.raises(ValueError):
        substring_dedup.remove_repeated_windows(make_docs(pairs), min_words=2000)


@pytest.mark.parametrize("length", [20, 14, 9])
def test_cover_brings_any_two_places_together(length):
    period, cover, anchor = substring_dedup.cover_for(length)
    assert anchor + period - 1 == length
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


@pytest.mark.parametrize("length,options", [(20, {}), (20, {"group_chars": 900, "range_words": 200}), (9, {})])
def test_repeated_windows_equal_brute_force(make_docs, length, options):
    pairs = [*corpus(1), (1000, "a second row with the id of another " * 5), (7, prose(random.Random(9), 30)),
             (None, prose(random.Random(9), 30) + " more")]
    rows = substring_dedup.remove_repeated_windows(make_docs(pairs, parts=5), length, **options).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=repr) == plain_removal(pairs, length)


def test_rows_of_one_doc_id_are_spread_over_groups(make_docs):
    rng = random.Random(13)
    text = prose(rng, 30)
    pairs = [(5, prose(rng, 40) + " " + text) for _ in range(60)] + [(5, text)] * 40
    pairs += [(None, text + " and more")] * 40 + [(i, prose(rng, 12)) for i in range(6, 26)]
    rng.shuffle(pairs)
    docs = make_docs(pairs, parts=5)
    sizes = defaultdict(int)
    for r in substring_dedup.grouped_rows(docs, 32).collect():
        sizes[r["doc_id"] in range(6, 26), r["g"]] += 1
    assert sum(sizes.values()) == len(pairs) and max(sizes.values()) < 20
    rows = substring_dedup.remove_repeated_windows(docs, 20).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=repr) == plain_removal(pairs, 20)


def test_repeated_windows_carry_columns_and_empty_tables(make_docs):
    docs = make_docs([(1, prose(random.Random(1), 30)), (2, prose(random.Random(1), 30)), (3, None)])
    rows = substring_dedup.remove_repeated_windows(docs, 20, carry=docs.columns).collect()
    assert {r["doc_id"]: (r["n_removed"], r["carried"]["g"], r["carried"]["kept"]) for r in rows} == {
        1: (0, 7, "k"), 2: (30, 7, "k"), 3: (0, 7, "k")}
    assert substring_dedup.remove_repeated_windows(make_docs([])).count() == 0


def test_very_long_words_and_texts(make_docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "_SLICE", 64)
    rng = random.Random(5)
    passage = " ".join(["x" * 700, prose(rng, 25), "é" * 300])
    pairs = [(1, passage + " end"), (2, prose(rng, 400) + " " + passage), (3, "y" * 5000)]
    rows = substring_dedup.remove_repeated_windows(make_docs(pairs), 20).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=repr) == plain_removal(pairs, 20)


# ---------------------------------------------------------------- exact copies

def plain_groups(pairs):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(pairs):
        groups[WORD_FREE.sub("", t or "")].append((-len(t or ""), i is None, i or 0, k))
    keep = {}
    for g in groups.values():
        for m in g:
            keep[m[3]] = (pairs[min(g)[3]][0], len(g))
    return keep


WORD_FREE = re.compile(r"[\x20\x09-\x0D]")


def test_exact_dedup_equals_brute_force(make_docs):
    pairs = [*corpus(2), (1, "a b"), (2, "ab "), (3, " a\nb"), (4, "ab"), (5, "a b"), (6, "A b"), (None, "ab"),
             (9, "tie1"), (8, "ti e"), (9, "tie1"), (9, "tie1")]
    rows = hash_index.exact_dedup(make_docs(pairs), hash_index.IndexOptions(capacity=8, max_depth=5)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in rows), key=repr) == sorted(
        ((pairs[k][0], *v) for k, v in plain_groups(pairs).items()), key=repr)
    kept = defaultdict(int)
    for r in rows:
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}


def test_dropped_copies_keep_all_columns(make_docs):
    pairs = [(1, "a b"), (2, "ab"), (3, "c"), (3, "c"), (None, None), (7, ""), (8, "long  c")]
    docs = make_docs(pairs)
    kept = hash_index.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"], r["h"], r["_id"], r["an odd.name"]) for r in kept.collect()) == [
        (1, "a b", 1, 9, "o"), (3, "c", 1, 9, "o"), (7, "", 1, 9, "o"), (8, "long  c", 1, 9, "o")]
    assert hash_index.exact_dedup(make_docs([])).count() == hash_index.drop_copies(make_docs([])).count() == 0


def test_documents_are_found_through_the_directory(spark, make_docs):
    docs = make_docs([(i, f"text {i // 2}") for i in range(400)] + [(999, "long " * 200_000)])
    index = hash_index.build_index(docs, hash_index.IndexOptions(capacity=10))
    assert index.depth == 9 and index.directory.count() == 1 << 9
    assert hash_index.lookup(index, docs).count() == 401
    # a directory that names another bucket for half of the cells loses the documents of those
    wrong = index.directory.withColumn("bucket", F.when(F.col("cell") % 2 == 0, F.col("bucket")).otherwise(-1))
    lost = hash_index.HashIndex(index.rows, wrong, index.entries, index.depth)
    assert 0 < hash_index.lookup(lost, docs).count() < 350
    chains = index.entries.groupBy("bucket", "h").agg(F.max("chain").alias("c"), F.count("*").alias("n"))
    assert chains.filter("c <> n").count() == 0 and index.entries.count() == 201


def test_directory_splits_overfull_buckets(spark, make_docs):
    options = hash_index.IndexOptions(capacity=10, max_depth=7)
    index = hash_index.build_index(make_docs([(i, f"text {i}") for i in range(300)]), options)
    cells = index.directory.collect()
    assert len(cells) == 1 << 7
    assert max(c["depth"] for c in cells) > 3
    assert all(c["entries"] <= 10 or c["depth"] == 7 for c in cells)
    sizes = {r["bucket"]: r["count"] for r in index.entries.groupBy("bucket").count().collect()}
    assert sum(sizes.values()) == 300
    assert sizes == {c["bucket"]: c["entries"] for c in cells if c["entries"]}
    found = hash_index.lookup(index, make_docs([(1, "te xt 5"), (2, "no such")])).collect()
    assert [(r["doc_id"], r["keep_id"]) for r in found] == [(1, 5)]


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(values, bits):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash_components_equal_brute_force(make_docs):
    rng = random.Random(6)
    pairs = corpus(3)
    base = prose(rng, 400)
    pairs += [(2000 + i, base.replace("fir", "fir" + "s" * (i % 3), 1 + i % 4).upper() if i % 2 else base) for i in range(20)]
    pairs += [(3000, None), (3001, "zz"), (3001, "zz yy"), (None, base)]
    rows = simhash.near_duplicates(make_docs(pairs), 3, 2, shard_size=10, leaf_size=4).collect()
    values = [plain_fingerprint(t) for _, t in pairs]
    roots = plain_components(values, 2)
    ids = defaultdict(list)
    for (i, _), r in zip(pairs, roots):
        ids[r] += [i] if i is not None else []
    want = [(i, f"{v - (1 << 64) if v >> 63 else v}", min(ids[r], default=None)) for (i, _), v, r in zip(pairs, values, roots)]
    assert sorted(((r["doc_id"], str(r["fp"]), r["component_id"]) for r in rows), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_links_of_dense_fingerprints(spark, bits):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(25):
            v = c
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    fps = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp bigint").repartition(3)
    links = simhash.near_links(fps, bits, shard_size=40, leaf_size=6)
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    want = defaultdict(list)
    for s, r in zip(signed, plain_components(values, bits)):
        want[r].append(s)
    mine = defaultdict(list)
    for s in signed:
        mine[got.get(s, s)].append(s)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_one_of_each_group_stays(make_docs):
    base = prose(random.Random(8), 300)
    docs = make_docs([(5, base), (3, base), (3, base), (9, base.upper()), (1, "other text here"), (2, None), (4, "")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3]
    assert simhash.keep_one(make_docs([])).count() == 0


def test_unrelated_rows_stay_whatever_their_ids(make_docs):
    rng = random.Random(10)
    texts = [prose(rng, 80) for _ in range(9)]
    pairs = [(None, t) for t in texts[:4]] + [(7, texts[4]), (7, texts[5]), (1, texts[6])]
    # linked: without any id, one with an id, and a copy under the repeated id
    pairs += [(None, texts[0].upper()), (None, texts[7]), (8, texts[7].upper()), (7, texts[4]), (7, texts[8]), (7, texts[8].upper())]
    values = [plain_fingerprint(t) for t in (p[1] for p in pairs)]
    want = defaultdict(list)
    for (i, t), r in zip(pairs, plain_components(values, 2)):
        want[r].append((i is None, i or 0, xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63, i, t))
    assert len(want) == 9
    kept = simhash.keep_one(make_docs(pairs)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted((min(g)[3:] for g in want.values()), key=repr)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(5000, 5000 + i) for i in range(1, 300)] + [(9, 9), (7000, 6999)]
    rows = connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    got = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(got) == 201 + 300 + 2
    assert all(got[i] == 0 for i in range(201)) and all(got[5000 + i] == 5000 for i in range(300))
    assert got[7000] == got[6999] == 6999
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
