"""Pre-tokens, library ids, the pair-index BPE, token archives and packing against the library itself."""

import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playlake.llm import bpe, packing, pretoken, token_archive, tokens
from tests.llm.conftest import prose

PATH = tokens.default_tokenizer()
ODD = ["", " ", "a", "'s", "it's we'll 'tis '", "  two  blanks ", "a\n\nb\t c", "été ñandú ß", "日本語 テキスト", "😀 x 1²3",
       "a<|endoftext|>b", "<|endoftext|>", "\x00\x1c\x85\xa0", "x" * 3000, "aaaa" * 50, "don't" * 40 + "'" * 41, None]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def le(ids):
    return np.array(ids, "<u4").tobytes()


@given(st.text(alphabet="abs'trevlmd  \n\t1²é-!Жẞ\x1c\x85", min_size=40, max_size=120))
@settings(max_examples=300, deadline=None)
def test_split_follows_the_pattern(text):
    assert [w.decode() for w in pretoken.split(text)] == pretoken._COMPILED.findall(text)


@given(st.lists(st.text(alphabet="ab'srel  \n\t1é-!Жẞ\xa0日😀\u2003\x00", max_size=40), min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_texts_split_together_as_they_do_alone(texts):
    data = [t.encode() for t in texts]
    found = pretoken.split_utf8(b"".join(data), np.cumsum([len(d) for d in data]))
    assert [[w.decode() for w in words] for words in found] == [pretoken._COMPILED.findall(t) for t in texts]


@given(st.lists(st.text(alphabet=st.sampled_from(list("abcdeé ' \n12日😀-tion")), max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_both_encoders_equal_the_library(texts):
    want = [le(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]
    assert bpe.encode_texts(texts, bpe.pair_table(PATH)) == want
    assert [tokens.encoder(PATH).ids(t) for t in texts] == want


def test_cache_generations_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 5)
    enc, lib = tokens.Encoder(PATH), library()
    rng = random.Random(1)
    for _ in range(20):
        text = prose(rng, 30)
        assert enc.ids(text) == le(lib.encode(text, add_special_tokens=False).ids)


def test_decode_of_cut_ids_equals_the_library():
    lib, table = library(), bpe.pair_table(PATH)
    for text in ODD:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        for cut in (ids, ids[1:], ids[:-1]):
            assert bpe.decode_ids(le(cut), table) == lib.decode(cut, skip_special_tokens=False)


def test_encode_and_decode_documents(make_docs):
    docs = make_docs([*enumerate(ODD), (3, "a"), (None, "no id")])
    done = bpe.decode_documents(bpe.encode_documents(docs, PATH, chunk_chars=500), PATH).collect()
    assert len(done) == len(ODD) + 2
    lib = library()
    by_id = {(r["doc_id"], r["text"]): r for r in done}
    for i, text in enumerate(ODD):
        ids = lib.encode(text or "", add_special_tokens=False).ids
        row = by_id[(i, lib.decode(ids, skip_special_tokens=False))]
        assert (row["n_tokens"], bytes(row["ids"])) == (len(ids), le(ids))
    assert bpe.decode_documents(bpe.encode_documents(make_docs([]), PATH), PATH).count() == 0


@pytest.mark.parametrize("shard_chars", [1 << 30, 2000])
def test_archive_round_trip(spark, make_docs, tmp_path, shard_chars):
    rng = random.Random(2)
    pairs = [*enumerate(ODD), *((100 + i, prose(rng, rng.randint(1, 200))) for i in range(150)), (7, "again"), (None, "x")]
    path = token_archive.write_archive(make_docs(pairs), f"file://{tmp_path}/{uuid.uuid4().hex}", PATH, end_id=2,
                                       shard_chars=shard_chars, part_bytes=4000)
    rows = sorted(token_archive.read_archive(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((p[0] for p in pairs), key=lambda i: (i is not None, i or 0))
    lib, at, want = library(), 0, {}
    for i, t in pairs:
        want.setdefault(i, []).append(lib.encode(t or "", add_special_tokens=False).ids + [2])
    for r in rows:
        assert r["ids"] in want[r["doc_id"]]
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(le(r["ids"]))
        at += r["n_tokens"]
    found = token_archive.read_document(spark, path, 120)
    assert [x.tolist() for x in found] == want[120]
    assert token_archive.read_document(spark, path, 10**9) == []


def test_archive_spreads_ids_that_fill_shards(spark, make_docs, tmp_path):
    rng = random.Random(4)
    pairs = [(None, prose(rng, 20)) for _ in range(400)] + [(77, prose(rng, 20)) for _ in range(400)] + [
        (k, prose(rng, 20)) for k in range(400)] + [(5, "y" * 200_000)]
    chars = sum(len(t) for _, t in pairs[:1200])
    path = token_archive.write_archive(make_docs(pairs), f"file://{tmp_path}/hot", PATH, shard_chars=chars // 12)
    files = spark.read.parquet(f"{path}/manifest").orderBy("shard", "part").collect()
    assert max(f.n_docs for f in files) < 300 and sum(f.n_docs for f in files) == len(pairs)
    lib, want = library(), Counter()
    for i, t in pairs:
        want[i, zlib.crc32(le(lib.encode(t, add_special_tokens=False).ids + [2]))] += 1
    rows = sorted(token_archive.read_archive(spark, path).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in rows) == want
    assert [r["doc_id"] for r in rows] == sorted((p[0] for p in pairs), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows]).tolist()[:-1]]
    assert len(token_archive.read_document(spark, path, 77)) == 401


def test_archive_of_nothing(spark, make_docs, tmp_path):
    path = token_archive.write_archive(make_docs([]), f"file://{tmp_path}/none", PATH)
    assert token_archive.read_archive(spark, path).count() == 0


def test_damaged_dictionary_is_noticed(spark, make_docs, tmp_path):
    path = token_archive.write_archive(make_docs([(1, "some text here")]), f"file://{tmp_path}/bad", PATH)
    (name,) = (tmp_path / "bad").glob("dictionary-*.zdict")
    name.write_bytes(name.read_bytes() + b"x")
    with pytest.raises(ValueError, match="hash"):
        token_archive.read_document(spark, path, 1)


def plain_sum_of_squares(lengths, size):
    """The rule, spelled out over all bins."""
    gaps, out = [], []
    for s in lengths:
        def cost(rest):
            count = {}
            for g in rest:
                if g:
                    count[g] = count.get(g, 0) + 1
            return sum(v * v for v in count.values())
        choices = [(cost([*gaps[:b], g - s, *gaps[b + 1:]]), 0, g, b) for b, g in enumerate(gaps) if g >= s]
        choices.append((cost([*gaps, size - s]), 1, size, len(gaps)))
        best = min(choices)[:3]
        b = max(c[3] for c in choices if c[:3] == best)
        if b == len(gaps):
            gaps.append(size)
        gaps[b] -= s
        out.append((best[0], gaps[b]))
    return out, sorted(gaps)


def test_sum_of_squares_follows_the_rule():
    rng = np.random.default_rng(3)
    for size in (10, 16):
        lengths = rng.integers(1, size + 1, 60)
        placed = packing.sum_of_squares(lengths, size)
        filled = np.bincount(placed, weights=lengths)
        assert filled.max() <= size
        assert sorted(size - filled.astype(int)) == plain_sum_of_squares(lengths.tolist(), size)[1]


def check_packing(rows, pairs, size):
    lib = library()
    want = {}
    for i, t in pairs:
        want.setdefault(i, []).append(lib.encode(t or "", add_special_tokens=False).ids + [0])
    places = {}
    for r in rows:
        assert any(zlib.crc32(le(ids[r["start"]:r["start"] + r["length"]])) == r["ids_crc32"] for ids in want[r["doc_id"]])
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    assert sum(r["length"] for r in rows) == sum(len(x) for v in want.values() for x in v)
    return len(places)


def test_packing_places_every_piece(make_docs):
    rng = random.Random(4)
    pairs = [*enumerate(ODD), *((100 + i, prose(rng, rng.randint(1, 60))) for i in range(300)), (5, "twice"), (None, "x")]
    total = None
    for options in ({}, {"group_pieces": 40, "keep_fill": 0.99}):
        rows = packing.pack_documents(make_docs(pairs), PATH, size=64, **options).collect()
        n = check_packing(rows, pairs, 64)
        total = sum(r["length"] for r in rows)
        assert n <= 1.03 * -(-total // 64) + 2
    whole = [r for r in rows if r["doc_id"] == 13]
    assert sorted(r["piece"] for r in whole) == list(range(len(whole)))
    assert all(r["length"] == 64 for r in whole if r["piece"])
    assert packing.pack_documents(make_docs([]), PATH).count() == 0


def test_rows_of_one_doc_id_are_packed_in_many_groups(make_docs):
    rng = random.Random(14)
    text = prose(rng, 20)
    pairs = [(7, text)] * 150 + [(None, prose(rng, rng.randint(1, 30))) for _ in range(150)]
    rows = packing.pack_documents(make_docs(pairs), PATH, size=64, group_pieces=30).collect()
    check_packing(rows, pairs, 64)
    groups = {}
    for r in rows:
        groups[r["sequence_id"] >> 32] = groups.get(r["sequence_id"] >> 32, 0) + 1
    # 600 pieces at most, 30 a group on average
    assert max(groups.values()) < 80


def test_packing_reads_only_ids_and_texts(make_docs):
    docs = make_docs([(1, "a b"), (2, None)]).withColumn("length", F.lit(-1)).withColumn("sequence_id", F.lit("z"))
    assert sorted(r["length"] for r in packing.pack_documents(docs, PATH).collect()) == [1, 3]
