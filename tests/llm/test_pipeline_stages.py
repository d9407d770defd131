"""The corpus pipeline stage by stage against brute force."""

import importlib
import random

import corpus_pipeline
from playlake.llm.common import DOCUMENT_COLUMNS
from tests.llm.conftest import prose
from tests.llm.test_text_dedup import WORD_FREE, plain_components, plain_fingerprint, plain_removal
from tests.llm.test_tokens import PATH, check_packing


def test_stages_in_turn(spark, make_docs, tmp_path):
    rng = random.Random(11)
    passage = prose(rng, 60)
    pairs = [(i, prose(rng, rng.randint(30, 90)) + (" " + passage if i % 4 == 0 else "")) for i in range(40)]
    pairs += [(50, pairs[3][1].replace(" ", "\n")), (51, pairs[5][1]), (52, pairs[7][1].upper()), (53, passage),
              (54, None), (55, "12 !!"), (56, ""), (57, "学习中文")]
    docs = make_docs(pairs, ["en"] * 44 + [None] * 4).select(*DOCUMENT_COLUMNS)
    text = dict(pairs)

    want = set(text) - {54, 55, 56, 57}
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_dedup", "substring_dedup", "best_fit_packing"]

    def stored(name, df):
        out = stage[name](spark, df, "")
        if name != "best_fit_packing":
            assert out.columns == DOCUMENT_COLUMNS and out.schema == df.schema
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    docs = stored("language_id", docs)
    assert {r["doc_id"] for r in docs.collect()} == want

    groups = {}
    for i in want:
        groups.setdefault(WORD_FREE.sub("", text[i]), []).append((-len(text[i]), i))
    want = {min(g)[1] for g in groups.values()}
    docs = stored("exact_dedup", docs)
    assert {r["doc_id"] for r in docs.collect()} == want
    assert not {50, 51} & want

    order = sorted(want)
    roots = plain_components([plain_fingerprint(text[i]) for i in order], 2)
    want = {order[r] for r in roots}
    docs = stored("simhash_dedup", docs)
    assert {r["doc_id"] for r in docs.collect()} == want
    assert 52 not in want

    expected = {i: (t if gone else text[i]) for i, n, gone, t in plain_removal([(i, text[i]) for i in want], 20) if gone < n or not n}
    docs = stored("substring_dedup", docs)
    rows = docs.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert 53 not in expected and len(expected) == len(want) - 1

    packed = stored("best_fit_packing", docs).collect()
    check_packing(packed, list(expected.items()), 2048)
    assert PATH


def through(spark, docs, folder):
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        yield name, docs


def test_stages_on_repeated_rows_and_ids_and_nulls(spark, make_docs, tmp_path):
    rng = random.Random(12)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    odd = [(7, a), (7, a), (7, b), (None, c), (None, c), (None, d), (8, None), (None, None), (9, "")]
    plain = [(100 + i, prose(rng, 50)) for i in range(30)] + [(500, prose(rng, 40_000))]
    docs = make_docs(odd + plain).select(*DOCUMENT_COLUMNS)
    stages = dict(through(spark, docs, tmp_path))
    want = sorted([7, 7, None, None] + [i for i, _ in plain], key=repr)
    for name in ("exact_dedup", "simhash_dedup"):
        assert sorted((r["doc_id"] for r in stages[name].collect()), key=repr) == want
    kept = [(r["doc_id"], r["text"]) for r in stages["substring_dedup"].collect()]
    assert sorted((i for i, _ in kept), key=repr) == want and {a, b, c, d} <= {t for _, t in kept}
    check_packing(stages["best_fit_packing"].collect(), kept, 2048)


def test_stages_on_an_empty_table(spark, make_docs, tmp_path):
    assert all(df.count() == 0 for _, df in through(spark, make_docs([]).select(*DOCUMENT_COLUMNS), tmp_path))


def test_run_is_registered(spark):
    import __spark_entry__

    importlib.reload(__spark_entry__)
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    names = [q for q in __spark_entry__.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
