"""Sharding, web archive, embeddings and language ID on small inputs, edge cases included."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.llm import embedding_dedup, langid, slots, warc
from tests.llm.conftest import prose

# ---------------------------------------------------------------- sharding


def check_shards(rows, pairs, shards):
    assert len(rows) == len(pairs)
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == sorted(
        ((i, size(t), zlib.crc32((t or "").encode())) for i, t in pairs), key=repr)
    places = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_have_near_equal_bytes(make_docs):
    rng = random.Random(1)
    pairs = [(i, prose(rng, rng.randint(0, 60))) for i in range(2000)]
    rows = slots.shard_documents(make_docs(pairs), 8).collect()
    check_shards(rows, pairs, 8)
    loads = defaultdict(int)
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert max(loads.values()) <= 1.01 * sum(loads.values()) / 8


def test_shards_of_odd_rows(make_docs):
    pairs = [(1, None), (2, ""), (None, "x"), (None, "x"), (3, "é" * 9), (3, "é" * 9), (4, "z" * 100_000)]
    check_shards(slots.shard_documents(make_docs(pairs), 4, slots=16).collect(), pairs, 4)
    assert slots.shard_documents(make_docs([]), 4, slots=16).count() == 0


def test_rebalancing_moves_little(spark, tmp_path):
    rng = random.Random(2)
    sums = spark.createDataFrame([(i, rng.randint(500, 1500)) for i in range(256)], "vslot int, bytes bigint")
    v1 = slots.store_map(slots.rebalance(sums, slots.first_map(spark, 8, 256), 8), f"file://{tmp_path}/map", 1)
    again = slots.rebalance(sums, v1.select("vslot", "shard"), 8)
    assert again.filter("moved").count() < 40
    grown = slots.rebalance(sums, v1.select("vslot", "shard"), 9)
    rows = grown.collect()
    loads = defaultdict(int)
    for r in rows:
        loads[r["shard"]] += r["bytes"]
    assert sorted(loads) == list(range(9)) and max(loads.values()) <= 1.05 * sum(loads.values()) / 9
    assert sum(r["moved"] for r in rows) < 70
    slots.store_map(grown, f"file://{tmp_path}/map", 2)
    versions = spark.read.parquet(f"file://{tmp_path}/map").groupBy("version").count().collect()
    assert {(r["version"], r["count"]) for r in versions} == {(1, 256), (2, 256)}


def test_a_slot_depends_on_the_record_alone(make_docs):
    others = [(i, f"text {i}") for i in range(300)]
    copies = [(500, "hot")] * 40 + [(None, "none")] * 7

    def slots_of(pairs, parts):
        found = defaultdict(list)
        for r in slots.measured(make_docs(pairs, parts=parts)).collect():
            found[r["doc_id"], r["text_crc32"]].append(r["vslot"])
        return {k: sorted(v) for k, v in found.items()}

    one, three = slots_of(others + copies, 1), slots_of(copies + others, 3)
    assert one == three and len(set(one[500, zlib.crc32(b"hot")])) > 30
    alone, twice = slots_of([(7, "x")], 2), slots_of([(7, "x"), (7, "x")], 2)
    assert set(alone[7, zlib.crc32(b"x")]) < set(twice[7, zlib.crc32(b"x")])


def test_the_first_map_is_stored(spark, make_docs, tmp_path):
    path = f"file://{tmp_path}/map"
    rows = slots.shard_documents(make_docs([(i, "a" * (i % 50)) for i in range(500)] + [(900, "b" * 2_000_000)]), 4, slots=64, path=path)
    assert rows.count() == 501
    stored = spark.read.parquet(path)
    zero = {r["vslot"]: r["shard"] for r in stored.filter("version = 0").collect()}
    assert zero == {k: k % 4 for k in range(64)} and stored.filter("version = 1").count() == 64


def test_copies_of_one_row_are_spread_over_shards(make_docs):
    pairs = [(7, "one copy of many")] * 300 + [(None, "no id")] * 300 + [(i, f"text {i} " * 3) for i in range(300, 600)]
    rows = slots.shard_documents(make_docs(pairs), shards=8).collect()
    check_shards(rows, pairs, 8)
    for i in (7, None):
        own = [r["vslot"] for r in rows if r["doc_id"] == i]
        assert max(own.count(v) for v in set(own)) < 10
    loads = defaultdict(int)
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert max(loads.values()) < 1.05 * sum(loads.values()) / 8


# ---------------------------------------------------------------- web archive

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("digest", T.LongType())])


def test_archive_keeps_every_record(spark, tmp_path):
    long = "<p>" + "é" * 200
    pages = [(9, "http://a/9", long), (4, "http://a/4", long), (7, None, long), (1, "http://a/\r\nx", "short"),
             (2, "http://a/2", "short"), (3, "http://a/3", None), (5, "http://a/5", ""), (6, "u", "x" * 100),
             (8, "u", "x" * 100), (10, "u", "y" * 99), (11, "u", "y" * 99), (None, "u", long), (4, "again", long)]
    df = spark.createDataFrame([(*p, 1) for p in pages], PAGES).repartition(4)
    path = warc.write_archive(df, f"file://{tmp_path}/a")
    rows = warc.read_archive(spark, path).collect()
    assert len(rows) == len(pages)
    firsts = {long: 4, "x" * 100: 6}
    count = defaultdict(int)
    for r in rows:
        html = next(h or "" for i, _, h in pages if i == r["page_id"])
        data = html.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        count[(html, r["record_type"])] += 1
        assert r["refers_to"] == (firsts[html] if r["record_type"] == "revisit" else None)
        if html not in firsts:
            assert r["record_type"] == "response"
        elif r["record_type"] == "response":
            assert r["page_id"] == firsts[html]
    assert count[(long, "response")] == count[("x" * 100, "response")] == 1
    assert {r["page_id"]: r["url"] for r in rows}[1] == "http://a/%0D%0Ax"
    # payloads are stored once, and records are whole
    assert spark.read.parquet(f"{path}/contents").count() == len({h or "" for _, _, h in pages})
    for r in warc.export_records(spark, path).collect():
        head, _, block = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
        assert block[length:] == b"\r\n\r\n" and block.startswith(b"HTTP/1.1 200 OK")


def test_damaged_contents_are_noticed(spark, tmp_path):
    path = warc.write_archive(spark.createDataFrame([(1, "u", "a" * 300, 1)], PAGES), f"file://{tmp_path}/a")
    spark.read.parquet(f"{path}/contents").withColumn("payload", F.lit(b"other")).write.parquet(f"{tmp_path}/c")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{tmp_path}/h")
    (tmp_path / "b").mkdir()
    spark.read.parquet(f"{tmp_path}/c").write.parquet(f"{tmp_path}/b/contents")
    spark.read.parquet(f"{tmp_path}/h").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archive(spark, f"{tmp_path}/b").collect()


def test_empty_archive(spark, tmp_path):
    path = warc.write_archive(spark.createDataFrame([], PAGES), f"file://{tmp_path}/a")
    assert warc.read_archive(spark, path).count() == 0


# ---------------------------------------------------------------- embeddings

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("size", T.LongType())])


def plain_links(rows, threshold):
    ok = [x is not None and label is not None and len(x) > 0 and all(v is not None and np.isfinite(v) for v in x)
          and any(x) for _, x, label in rows]
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            (_, x, a), (_, y, b) = rows[i], rows[j]
            if ok[i] and ok[j] and a == b and len(x) == len(y):
                x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    ids = defaultdict(list)
    for i in range(n):
        ids[find(i)] += [rows[i][0]] if rows[i][0] is not None else []
    return sorted(((rows[i][0], links[i], min(ids[find(i)], default=None)) for i in range(n)), key=repr)


@pytest.mark.parametrize("options", [{}, {"block_rows": 7, "rows_at_once": 5}])
@pytest.mark.parametrize("threshold", [0.93, 0.5])
def test_embedding_links_equal_brute_force(spark, options, threshold):
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1, 2):
        centres = rng.normal(size=(6, 20)) * np.geomspace(3, 0.2, 20)
        for k in range(40):
            rows.append((1000 - len(rows), (centres[k % 6] + rng.normal(size=20) * rng.choice([0.05, 0.3])).astype(np.float32).tolist(), label))
    x = rows[0][1]
    rows += [(2000, x, 0), (2001, x, 0), (2002, x, 1), (2003, [2 * v for v in x], 0), (2004, x, None), (2005, None, 0),
             (2006, [0.0] * 20, 0), (2007, [None, *x[1:]], 0), (2008, [float("nan"), *x[1:]], 0),
             (2009, [float("inf"), *x[1:]], 0), (2010, x[:5], 0), (2011, x[:5], 0), (2012, [], 0), (None, x, 0), (2001, x, 0)]
    df = spark.createDataFrame([(*r, 5) for r in rows], VECTORS).repartition(5)
    got = embedding_dedup.link_vectors(df, threshold, **options).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == plain_links(rows, threshold)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_links_of_very_small_and_very_large_components(spark):
    x = [3.0, 4.0, 0.5, -1.0]
    rows = [(i, [v * s for v in x], 0) for i, s in enumerate((1.0, 1e-200, 1e200, 1e307, 5e-324 / 0.5))] + [
        (9, [1e200, -1e200, 1e199, 1e180], 0), (10, [-3e-300, 4e-300, 1e-310, 0.0], 0)]
    schema = T.StructType([VECTORS["vec_id"], T.StructField("embedding", T.ArrayType(T.DoubleType())), VECTORS["label"]])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link_vectors(spark.createDataFrame(rows, schema)).collect()}
    assert got[0] == got[1] == got[2] == got[3] and got[0][0] >= 3 and got[0][1] == 0 and got[9] == (0, 9) and got[10] == (0, 10)


def test_pruning_gives_up_pairs_early_and_loses_none():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(50, 64)) * np.geomspace(4, 0.01, 64)
    a[25:] = a[:25] + rng.normal(size=(25, 64)) * 0.2
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    i, j = embedding_dedup.close_pairs(a, a, a, a, 0.93, True)
    want = {(p, q) for p in range(50) for q in range(p + 1, 50) if a[p] @ a[q] >= 0.93}
    assert set(zip(i.tolist(), j.tolist())) == want and want


def test_no_vectors(spark):
    assert embedding_dedup.link_vectors(spark.createDataFrame([], VECTORS)).count() == 0


# ---------------------------------------------------------------- language ID

NORTH, SOUTH = "skog fjell bjørk strand vinter snø".split(), "olivo campo viñedo playa verano sol".split()


def labelled(rng, n=120):
    return [(i, " ".join(rng.choice(NORTH if i % 2 else SOUTH) for _ in range(rng.randint(3, 40))),
             "no" if i % 2 else "es") for i in range(n)]


def test_languages_are_told_apart(make_docs):
    rng = random.Random(5)
    rows = labelled(rng)
    odd = [(500, None), (501, ""), (502, "123 !? 45"), (503, "bjørk"), (504, "PLAYA!!! sol 12"), (505, "学 习 中 文"),
           (506, "skog " * 200_000), (None, "vinter snø")]
    docs = make_docs([(i, t) for i, t, _ in rows] + odd, [x for _, _, x in rows] + [None] * len(odd))
    filters = langid.learn(docs.filter(~langid.held_out()))
    assert filters.languages == ["es", "no"]
    got = langid.predict(docs, filters, docs.columns).select("carried.*", "lang_pred", F.col("score").alias("s"))
    got = langid.predict(docs, filters, docs.columns).collect()
    by_id = {r["carried"]["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(rows) + len(odd)
    assert all(by_id[i][0] == lang for i, _, lang in rows)
    assert by_id[500] == by_id[501] == by_id[502] == ("und", 0.0)
    assert (by_id[503][0], by_id[504][0], by_id[506][0], by_id[None][0]) == ("no", "es", "no", "no")
    assert by_id[505][1] == 0.0
    assert all(0 <= s <= 1 for _, s in by_id.values())
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in by_id if i not in (500, 501, 502, 505)}


def test_labels_of_held_out_documents_never_teach(make_docs):
    rows = labelled(random.Random(6))
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    docs = make_docs([(i, t) for i, t, _ in rows], [x if i not in held else "zz" for i, _, x in rows])
    assert {r["doc_id"] for r in docs.filter(langid.held_out()).collect()} == held
    assert langid.learn(docs.filter(~langid.held_out())).languages == ["es", "no"]


def test_labels_with_the_same_trigrams_reject_no_document(make_docs):
    rng = random.Random(12)
    labels = ["en-au", "en-gb", "en-in", "en-nz", "en-us", "en-za"]
    rows = [(i, prose(rng, 120), labels[i % 6]) for i in range(240)]
    # one more language with words of its own, some of them English
    other = ["vann", "fjord", "kveld", "blå", "skog", "ingen", "natt", "elm", "oak"]
    rows += [(i, " ".join(rng.choices(other, k=120)), "no") for i in range(240, 300)]
    docs = make_docs([(i, t) for i, t, _ in rows], [x for _, _, x in rows])
    filters = langid.learn(docs.filter(~langid.held_out()))
    got = {r["carried"]["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, filters, docs.columns).collect()}
    assert all(got[i][0] == "no" if x == "no" else got[i][0] in labels for i, _, x in rows)
    assert min(s for _, s in got.values()) > 0.8
    assert langid.keep_known(docs).count() == len(rows)
    # a trigram is in the filters of all languages that have it
    code = next(langid.trigrams(["oak"]))[0]
    assert (filters.masks(code)[:, 0] & np.uint64(127) == 127).all()


def plain_languages(taught, texts, min_part, min_share=0.3):
    """The same decision with plain sets: no filter, no false positive."""
    def grams(text):
        found = set()
        for codes, _ in langid.trigrams([text]):
            found |= set(codes.tolist())
        return found
    parts = {}
    for lang in sorted({x for _, x in taught}):
        n = Counter(g for t, x in taught if x == lang for g in grams(t))
        parts[lang] = {g: c / sum(n.values()) for g, c in n.items()}
    own = {lang: {g for g, v in p.items() if v >= min_part} for lang, p in parts.items()}
    top = Counter()
    for p in parts.values():
        for g, v in p.items():
            top[g] = max(top[g], v)
    marks = {lang: {g for g in own[lang] if parts[lang][g] >= (parts[lang][g] + top[g]) * min_share} for lang in own}
    out = []
    for t in texts:
        g = grams(t)
        found = {lang: len(g & marks[lang]) / len(g) for lang in own}
        best = max(own, key=lambda k: (found[k], [-ord(c) for c in k]))
        mass = max(0.05, sum(parts[best][x] for x in own[best]))
        out.append((found, best, min(1.0, len(g & own[best]) / len(g) / mass)))
    return out


def zipf_han(rng, n):
    return "".join(chr(0x4E00 + min(5999, int(rng.paretovariate(0.6)))) for _ in range(n))


def test_languages_equal_plain_sets_and_rare_trigrams_lower_no_score(make_docs):
    rng = random.Random(21)
    rows = labelled(rng, 90) + [(1000 + i, zipf_han(rng, 150), "zh") for i in range(60)]
    rows += [(2000 + i, " ".join(rng.choices(NORTH + SOUTH + ["mixed", "words"], k=30)), "mix") for i in range(40)]
    docs = make_docs([(i, t) for i, t, _ in rows], [x for _, _, x in rows])
    for min_part in (1e-5, 4e-4):
        filters = langid.learn(docs, min_part=min_part, entries_a_gram=200)
        got = {r["carried"]["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, filters, ["doc_id"]).collect()}
        want = plain_languages([(t, x) for _, t, x in rows], [t for _, t, _ in rows], min_part)
        for (i, _, _), (found, best, score) in zip(rows, want):
            second = max(v for k, v in found.items() if k != best)
            if found[best] - second > 0.02:
                assert got[i][0] == best and abs(got[i][1] - score) < 0.03
        assert min(got[i][1] for i, _, x in rows if x == "zh") > 0.4
        assert langid.keep_known(docs, min_part=min_part).count() == len(rows)


def test_nothing_learned_and_empty_tables(make_docs):
    filters = langid.learn(make_docs([]))
    assert langid.predict(make_docs([]), filters, ["doc_id"]).count() == 0
    rows = langid.predict(make_docs([(1, "text")]), filters, ["doc_id"]).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]


def test_filters_hold_every_taught_trigram_and_few_others():
    rng = np.random.default_rng(7)
    codes = {f"l{k:02d}": np.unique(rng.integers(0, 1 << 60, 900).astype(np.uint64)) for k in range(70)}
    filters = langid.build_filters(codes)
    for k, lang in enumerate(filters.languages):
        bit = np.uint64(1 << (k % 64))
        assert (filters.masks(codes[lang])[:, k // 64] & bit).all()
        others = rng.integers(0, 1 << 60, 4000).astype(np.uint64)
        seen = ((filters.masks(others)[:, k // 64] & bit) != 0).mean()
        assert abs(seen - filters.rates[k]) < 0.02


def test_slices_give_the_same_trigrams(monkeypatch):
    texts = ["ab cd-éf", "", None, "x" * 30 + " yz", "ß"]

    def pairs():
        return [p for codes, number in langid.trigrams(texts) for p in zip(number.tolist(), codes.tolist())]
    whole = pairs()
    assert len(set(whole)) == len(whole)
    # " ab", "ab ", " cd", "cd ", " éf", "éf "; " xx", "xxx", "xx ", " yz", "yz "; " ß "
    assert [sum(n == i for n, _ in whole) for i in range(5)] == [6, 0, 0, 5, 1]
    monkeypatch.setattr(langid, "SLICE", 4)
    assert set(pairs()) == set(whole)
