import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlake.llm import components as C
from transitlake.llm import jaccard as J

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def classes(sets, t):
    n = len(sets)
    root, links = list(range(n)), [0] * n

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            both = sets[i] & sets[j]
            if both and len(both) / len(sets[i] | sets[j]) >= t:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)], links


def brute(docs, t=0.8):
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    tops, links = classes([shingles(x) for _, x in docs], t)
    return sorted([(d, docs[k][0], n) for (d, _), k, n in zip(docs, tops, links, strict=True)], key=repr)


@pytest.fixture(scope="module")
def families(prose):
    """Families of near copies, a few to a hundred, chained by edits so that not all of a family are alike."""
    r, out = random.Random(11), []
    for f, size in enumerate([2, 3, 5, 8, 40, 100]):
        w = prose(f, 120).split()
        for _ in range(size):
            w = list(w) if r.random() < 0.6 else prose(f, 120).split()
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"n{r.randrange(50)}"
            out.append(" ".join(w) if r.random() < 0.8 else " ".join(w).upper() + "!")
    out += [prose(1000 + i, r.randrange(1, 80)) for i in range(80)] + ["a b c", "a b c", "A, b c?"]
    return list(enumerate(out, 1))


@pytest.mark.parametrize(("shingle_limit", "node_limit", "dense"), [(1_000_000, 1024, 24), (2_000, 10, 3)])
@pytest.mark.parametrize(("fetch", "whole"), [(500_000, 8192), (0, 8192), (500_000, 4), (500_000, 0)])
def test_equals_brute_force(spark, families, monkeypatch, shingle_limit, node_limit, dense, fetch, whole):
    monkeypatch.setattr(J, "WHOLE_NODES", whole)
    monkeypatch.setattr(J, "BLOCK_SHINGLES", shingle_limit)
    monkeypatch.setattr(J, "BLOCK_NODES", node_limit)
    monkeypatch.setattr(J, "PART_NODES", node_limit // 2)
    monkeypatch.setattr(J, "DENSE", dense)
    monkeypatch.setattr(J, "BROADCAST_ROWS", fetch)
    df = spark.createDataFrame(families, "doc_id long, text string").repartition(3)
    got = J.jaccard_classes(df).select("doc_id", "class_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(families)


def test_edge_cases(spark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = J.jaccard_classes(docs).select("doc_id", "class_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows)
    assert J.jaccard_classes(empty).count() == J.drop_near_duplicates(empty).count() == 0


def test_one_of_each_class_stays(spark, docs, families):
    kept = J.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 6, None, 7, 8, 9, 10], key=str)
    df = spark.createDataFrame(families, "doc_id long, text string")
    assert sorted(r.doc_id for r in J.drop_near_duplicates(df).collect()) == sorted({c for _, c, _ in brute(families)})
    nulls = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert J.drop_near_duplicates(nulls).count() == len({c for _, c, _ in brute(families)})


@pytest.mark.parametrize(("t", "recall"), [(0.8, 0.9999), (0.5, 0.95), (0.95, 0.999), (1.0, 0.9)])
def test_bands_reach_the_recall(t, recall):
    bands, rows = J.choose_bands(t, recall)
    assert bands * rows <= J.HASHES and 1 - (1 - t**rows) ** bands >= recall - 1e-12


def test_bands_that_cannot():
    with pytest.raises(ValueError, match="do not reach"):
        J.choose_bands(0.1, 0.9999, 20)


def test_shingles_that_hash_alike_are_told_apart(spark):
    from .test_substrings import thue_morse

    one, two = thue_morse(2048)
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}"), (4, one), (5, two), (6, one.upper())]
    (a, _), (b, _) = J.shingle_sets(J.pa.array([one, two]), 5)
    assert (a == b).all()
    got = J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows)


def test_chance_components_are_taken_apart(spark, monkeypatch, prose):
    # texts that share a half with the next one: strung together by bands of one row, never linked
    monkeypatch.setattr(J, "WHOLE_NODES", 3)
    rows = [(i, prose(i, 40, 5000) + " " + prose(i + 1, 40, 5000)) for i in range(60)] + [(100 + i, prose(i, 40, 5000) + " " + prose(i + 1, 40, 5000) + " end") for i in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.jaccard_classes(df, recall=0.9999999999, hashes=20).select("doc_id", "class_id", "n_links").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows)


@pytest.mark.parametrize("band", range(-1, 4))
def test_a_pair_meets_in_its_first_band(band):
    r = np.random.default_rng(3)
    bands = r.integers(0, 3, (40, 4))
    want = np.array([[next((k for k in range(4) if a[k] == b[k]), None) for b in bands] for a in bands], object)
    assert (J._met(bands, band) == (want != None if band < 0 else want == band)).all()  # noqa: E711


def test_minhash_agrees_with_jaccard():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 300).astype(np.uint64)
    other = np.concatenate([base[:240], r.integers(0, 2**63, 60).astype(np.uint64)])
    a, b = J._signatures([np.unique(base), np.unique(other)], 2000, 1)
    assert abs((a == b).mean() - 240 / 360) < 0.04


@pytest.mark.parametrize("limit", [500_000, 0])
def test_components(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(C, "BROADCAST_ROWS", limit)
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(400, 400), (7, 6)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {x.node: x.root for x in C.components(df, str(tmp_path), "t").collect()}
    assert got == {x: top(x) for x in root}
    assert C.components(df.limit(0), str(tmp_path), "e").count() == 0
