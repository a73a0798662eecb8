import hashlib
import re

import pytest
from pyspark.sql import functions as F

from transitlake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in {len(g) for g in grams}:
                g = tuple(w[i : i + n])
                if len(g) == n and g in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[g]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, "The quick, brown FOX jumps over the lazy dog and runs!"), (2, "one"), (3, None), (4, ""), (5, "the way is far"), (1, "ipsum dolor sit amet lorem"), (11, "É ß 漢 😀"), (None, "no id"), (2, "one")]


@pytest.mark.parametrize("items", [ITEMS, ITEMS[:1], [], [(3, None)]])
@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_equals_brute_force(spark, docs, items, limit, monkeypatch):
    got = D.contamination(docs, bench(spark, items), broadcast_windows=limit)
    got = got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), F.col("n_hit") > 0)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want


def test_large_benchmarks_are_broadcast_as_bits(spark, docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, ITEMS)
    for words, most in ((1, 1 << 28), (4, 1 << 28), (1 << 20, 10)):
        monkeypatch.setattr(D, "FILTER_WORDS", words)
        monkeypatch.setattr(D, "BROADCAST_BYTES", most)
        found = D.contamination(docs, bench(spark, ITEMS), broadcast_windows=0 if most > 10 else 10**6)
        got = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), F.col("n_hit") > 0)
        assert sorted([tuple(r) for r in got.collect()], key=repr) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_case_is_that_of_ascii_alone(spark):
    docs = spark.createDataFrame([(1, "ÉCOLE a b"), (2, "école A B"), (3, "K b c"), (4, "İx y z")], "doc_id long, text string")
    for item in ("école a b", "ÉCOLE A b", "k b c", "İX Y Z"):
        want = brute([tuple(r) for r in docs.collect()], [(1, item)])
        assert sorted([tuple(r) for r in D.report(docs, bench(spark, [(1, item)])).collect()], key=repr) == want


def test_removal(spark, docs, empty):
    items = bench(spark, ITEMS[:1] + [(5, "the way is far")])
    kept = D.remove_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 3, 4, 6, 6, None, 8, 9, 10], key=str)
    cut = {r.doc_id: r.text for r in D.remove_contaminated(docs.withColumn("n_chars", F.length("text")), items, "span").collect()}
    assert cut[1] == "far away from here" and cut[7] == "É ß 漢 😀 the Straße is long and " and cut[2] is None and cut[4].startswith("lorem")
    assert D.remove_contaminated(empty, items).count() == D.report(empty, items).count() == 0
    assert D.remove_contaminated(docs, items.limit(0)).count() == docs.count()
    with pytest.raises(ValueError, match="action"):
        D.remove_contaminated(docs, items, "x")


def test_main_path_is_native(spark, docs):
    plan = D.report(docs, bench(spark, ITEMS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_shared_folders_are_released(spark):
    import os

    from transitlake.llm import shared

    folder = shared.shared_dir(spark)
    assert shared.staged(spark.range(3), folder, "x").count() == 3 and os.path.isdir(folder.removeprefix("file://"))
    shared.release(spark)
    assert not os.path.exists(folder.removeprefix("file://")) and not shared._FOLDERS


def test_scratch_folders_go_and_others_stay(spark):
    import os

    from transitlake.llm import shared

    shared.release(spark)
    keep = shared.shared_dir(spark)
    shared.staged(spark.range(3), keep, "x")
    with shared.scratch(spark):
        inner = shared.shared_dir(spark)
        shared.staged(spark.range(3), inner, "x")
    assert os.path.isdir(keep.removeprefix("file://")) and not os.path.exists(inner.removeprefix("file://")) and shared._FOLDERS == [keep]
    shared.release(spark)


def test_few_partitions_are_dealt_out(spark, tmp_path):
    from transitlake.llm.shared import spread

    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert df.rdd.getNumPartitions() == 1 and spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(df).count() == 100
    wide = spark.range(100).repartition(9)
    assert spread(wide) is wide
