"""The corpus pipeline stage by stage, and the registered queries."""

import random

import __spark_entry__ as entry
import corpus_pipeline
from helpers import documents
from test_dedup import brute_components, brute_fingerprint, brute_lines
from test_search_pack_urls import brute_hits, check_packing

SF = "/root/testdata/sf0.001"


def test_names_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup",
                                                      "benchmark decontamination", "best-fit packing"]
    qs, sql = entry.queries(), entry.oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in qs} and "pipeline" in qs
    assert {"op4_line_dedup", "op5_decontamination", "op9_substring_dedup"} <= set(sql)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fns = dict(corpus_pipeline.STAGES)
    kept = fns["quality rules"](spark, docs, SF)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.orderBy("doc_id").collect()]
    assert 0.5 * docs.count() < len(rows) < docs.count()

    clean = fns["line dedup"](spark, kept, SF)
    want = brute_lines(rows)
    expected = {i: want[k] for k, (i, _) in enumerate(rows) if want[k].strip(" \t\n\x0b\x0c\r")}
    got = clean.orderBy("doc_id").collect()
    assert {r.doc_id: r.text for r in got} == expected and all(r.n_chars == len(r.text) for r in got)

    unique = fns["simhash near-dedup"](spark, clean, SF)
    ids, texts = [r.doc_id for r in got], [r.text for r in got]
    comp = brute_components([brute_fingerprint(t, 3) for t in texts], ids, 2)
    assert sorted(r.doc_id for r in unique.collect()) == sorted({c for c in comp})

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = fns["benchmark decontamination"](spark, unique, SF)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(
        r.doc_id for r in unique.collect() if not brute_hits(r.text, bench, 10)[1])

    packed = fns["best-fit packing"](spark, left, SF).collect()
    check_packing(packed, sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in packed), 4096)
    assert {r.doc_id for r in packed} == {r.doc_id for r in left.select("doc_id").collect()}


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, fn in corpus_pipeline.STAGES:
        docs = fn(spark, docs, SF)
    same = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, same.collect())) == sorted(map(str, docs.collect()))


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, fn in corpus_pipeline.STAGES[:-1]:
        docs = fn(spark, docs, SF)
        assert docs.count() == 0 and {"doc_id", "text", "n_chars"} <= set(docs.columns)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_stages_take_a_very_long_text(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    line = lambda: " ".join(rng.choice(words) for _ in range(14)).capitalize() + "."
    long = "\n".join(line() for _ in range(4000))
    docs = documents(spark, [long, long, "\n".join(line() for _ in range(5)), None], [4, 5, 6, 7])
    for name, fn in corpus_pipeline.STAGES[:-1]:
        docs = fn(spark, docs, SF)
        left = {r.doc_id: r.text for r in docs.collect()}
        assert left[4] == long and 6 in left and 7 not in left, name
    assert set(left) == {4, 6}     # the copy lost all its lines
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    n = sorted(r.piece for r in packed if r.doc_id == 4)
    assert n == list(range(len(n))) and len(n) > 20 and all(r.length == 4096 for r in packed if r.doc_id == 4 and r.piece < len(n) - 1)


def test_stages_take_odd_rows(spark):
    docs = documents(spark, [None, "", "word " * 30, None, "A full sentence, with words enough to pass, one two three four five six seven eight nine ten eleven twelve."],
                     [None, 1, 2, 2, 3], clashes=True)
    for _, fn in corpus_pipeline.STAGES[:-1]:
        docs_out = fn(spark, docs, SF)
        assert docs_out.columns == docs.columns
        docs = docs_out
    assert [r.doc_id for r in docs.collect()] == [3]
    assert [(r.doc_id, r.piece, r.offset) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()] == [(3, 0, 0)]
