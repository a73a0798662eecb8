import hashlib
import re
from collections import Counter

import pytest

from transitlake.llm import spotsigs as S

COMMON = {w for v in S.ANCHORS.values() for w in v}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def sigs(text):
    w = WORD.findall((text or "").lower())
    content = [x for x in w if x not in COMMON]
    if not content:
        return {tuple(w)} if w else set()
    out, n = {("^", *content[:2])}, 0
    for x in w:
        if x not in COMMON:
            n += 1
        elif n < len(content):
            out.add((x, *content[n : n + 2]))
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    docs = sorted(((d, t or "") for d, t in docs), key=lambda x: -x[0])
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(docs)
    for k, (doc, text) in enumerate(docs):
        after, n, r = docs[(k + 1) % len(docs)][1], len(text) // 2, got[doc]
        edited = text[: len(text) - n] + after[:n]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(sigs(text), sigs(edited))) and r.near_next == pytest.approx(jaccard(sigs(text), sigs(after)))
        assert len(r.fingerprint) == 8 * len(sigs(text)) and len(r.edited_fingerprint) == 8 * len(sigs(edited))
    by_text = {}
    for doc, text in docs:
        assert by_text.setdefault(text, got[doc].fingerprint) == got[doc].fingerprint


@pytest.mark.parametrize("n", [1, 2, 7, 90])
def test_equals_brute_force(spark, prose, n):
    rows = [(3 * i, "É😀 " * (i % 3) + prose(i % 50, 5 * (i % 9))) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(S.edited_fingerprints(df).collect(), rows)


def test_edge_cases(spark, docs, empty):
    got = S.edited_fingerprints(docs).collect()
    assert sorted([str(r.doc_id) for r in got]) == sorted(str(r.doc_id) for r in docs.collect())
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[5].fingerprint and by_id[2].fingerprint == "" and by_id[2].n_chars == 0 and by_id[2].near_edited == 1.0
    distinct = [(r.doc_id, r.text) for r in docs.where("doc_id IS NOT NULL AND doc_id <> 6").collect()]
    check(S.edited_fingerprints(docs.where("doc_id <> 6")).collect(), distinct)
    assert S.edited_fingerprints(empty).collect() == []


def test_search_loses_nothing(spark, prose):
    texts = {}
    for i in range(120):
        w = prose(i % 12, 60).split()
        for k in range(i // 12):
            w[(7 * k + i) % 60] = f"x{i}{k}"
        texts[i] = " ".join(w)
    texts |= {500: "", 501: None, 502: "the of", 503: "the of", 504: texts[0]}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {i: sigs(t) for i, t in texts.items()}
    for t in (0.3, 0.8, 1.0):
        got = {(r.query_id, r.doc_id): r.likeness for r in S.search(df, df.where("doc_id % 4 = 0"), t).collect()}
        want = {(i, j): jaccard(a, b) for i, a in sets.items() for j, b in sets.items() if i % 4 == 0 and a and b and jaccard(a, b) >= t}
        assert got == pytest.approx(want)
    with pytest.raises(ValueError, match="threshold"):
        S.search(df, df, 0)


def test_main_path_is_native(docs):
    for df in (S.edited_fingerprints(docs), S.search(docs, docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def whole_sigs(text):
    w = WORD.findall((text or "").lower())
    content = [x for x in w if x not in COMMON]
    out, bounds = sigs(text), [0, *[i - n for n, i in enumerate(k for k, x in enumerate(w) if x in COMMON)], len(content)]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        if hi - lo > (4 if len(bounds) > 2 else 0):
            out |= {("~", *content[k : k + 2]) for k in range(lo, hi)}
    return out


def test_texts_without_anchors_are_seen_whole(spark, docs, prose):
    lists = {i: "alpha beta " + " ".join(f"item{i}x{k}" for k in range(40)) for i in range(5)} | {5: "alpha beta gamma", 6: "alpha beta delta", 7: "one", 8: "the of", 9: ""}
    mixed = {100 + i: prose(i, 30) + " " + lists[i % 5] + " " + prose(i + 50, 10) for i in range(20)}
    rows = list((lists | mixed).items())
    for r, (doc, text) in zip(sorted(S.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), whole=True).collect(), key=lambda r: r.doc_id), rows, strict=True):
        after = dict(rows)[max((d for d, _ in rows if d < doc), default=119)]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert r.doc_id == doc and len(r.fingerprint) == 8 * len(whole_sigs(text)) and len(r.edited_fingerprint) == 8 * len(whole_sigs(edited))
        assert r.near_edited == pytest.approx(jaccard(whole_sigs(text), whole_sigs(edited))) and r.near_next == pytest.approx(jaccard(whole_sigs(text), whole_sigs(after)))
        if doc in (1, 2, 3, 4):
            assert 0.2 < r.near_edited < 0.8 and r.near_next < 0.1
    assert len({r.fingerprint for r in S.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect() if r.doc_id < 7}) == 7


def test_the_query_sees_texts_whole(spark, tmp_path):
    from transitlake.llm.queries import op4_document_fingerprints

    spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha beta other words")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    a, b = op4_document_fingerprints(spark, str(tmp_path)).collect()
    assert a.fingerprint != b.fingerprint and a.near_next < 0.5


def test_search_with_a_very_common_signature(spark, prose):
    # all texts share their opening, most of them little else
    texts = {i: "the common opening " + prose(i % 40, 30 + i % 7) + (" of late" if i % 3 else "") for i in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {i: sigs(t) for i, t in texts.items()}
    assert set.intersection(*sets.values())
    got = {(r.query_id, r.doc_id): r.likeness for r in S.search(df, df.where("doc_id % 5 = 0"), 0.8).collect()}
    assert got == pytest.approx({(i, j): jaccard(a, b) for i, a in sets.items() for j, b in sets.items() if i % 5 == 0 and jaccard(a, b) >= 0.8})


def test_commonest_signatures_go_last(spark, prose):
    df = spark.createDataFrame([(i, f"the common opening {prose(i, 40)}") for i in range(50)], "doc_id long, text string")
    rows = S.with_signatures(df, "text", "sigs")
    top = S._commonest(rows)
    n = Counter(x for r in rows.collect() for x in r.sigs)
    assert len(top) == min(S.MOST_COMMON, len(n)) and {x for x, k in n.items() if k == 50} <= set(top[-3:])
    assert S._commonest(rows.limit(0)) == []


def test_the_search_query_equals_brute_force(spark, prose, tmp_path):
    from transitlake.llm.queries import spotsigs_search

    texts = {i: " ".join(prose(i % 30, 50).split()[: 50 - i // 100]) for i in range(0, 700, 5)} | {1: "", 2: None, 900: "", 800: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sets = {i: frozenset(whole_sigs(t)) for i, t in texts.items() if t}
    classes = {}
    for i in sorted(sets):
        classes.setdefault(sets[i], []).append(i)
    want = {(i, ids[0]): (len(ids), jaccard(sets[i], c)) for i in sets if i % 100 == 0 for c, ids in classes.items() if jaccard(sets[i], c) >= 0.8}
    got = spotsigs_search(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(r.query_id, r.class_id): (r.n_docs, pytest.approx(r.likeness)) for r in got} == want
    assert any(i != j for i, j in want) and any(n > 1 for n, _ in want.values())


def test_search_edge_cases(spark, docs, empty):
    assert S.search(empty, docs).collect() == [] and S.search(docs, empty, expand=False).collect() == []
    got = {(r.query_id, r.doc_id) for r in S.search(docs, docs).collect()}
    assert {(1, 5), (5, 1), (9, 9), (None, None), (4, 4)} <= got and not {2, 3, 6, 8, 10} & {i for pair in got for i in pair}


def test_one_id_or_null_with_a_third_of_the_rows(spark, prose):
    # the order is total but for equal rows: ids downwards, null last, then by the text's hash
    rows = [(i, prose(i, 12)) for i in range(40)] + [(7, prose(100 + i, 12)) for i in range(40)] + [(None, prose(200 + i, 12)) for i in range(40)] + [(None, "same")] * 9
    rows += [(-(1 << 63), prose(300 + i, 9)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashes = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    want = Counter((d, t, order[(k + 1) % len(order)][1]) for k, (d, t) in enumerate(order))
    got = S.with_next(df, sigs=False)
    assert Counter((r.doc_id, r.text, r.next_text) for r in got.collect()) == want
    _, slices = S._bounds(df, 32)
    assert slices[0] >= 8 and sum(x >= 4 for x in slices[1:]) >= 2


def test_bits_rule_no_like_pair_out(spark):
    import random

    rng = random.Random(5)
    sets = []
    for n in (0, 1, 3, 60, 64, 65, 130, 900, 6000):
        one = [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
        sets += [one, one[n // 10 :], one[n // 3 :] + [rng.getrandbits(63) for _ in range(n // 4)], [rng.getrandbits(63) for _ in range(n)]]
    df = spark.createDataFrame([(i, sorted(set(s))) for i, s in enumerate(sets)], "i int, sigs array<bigint>").withColumn("bits", S.parities("sigs"))
    assert {r.i: len(r.bits) for r in df.collect() if r.i in (0, 4, 16, 20, 24, 28, 32)} == {0: 0, 4: 1, 16: 1, 20: 2, 24: 4, 28: 16, 32: 64}
    pairs = df.crossJoin(df.selectExpr("i AS j", "bits AS other")).select("i", "j", S.differing("bits", "other").alias("d")).collect()
    for r in pairs:
        assert r.d <= len(set(sets[r.i]) ^ set(sets[r.j])) and (r.i != r.j or r.d == 0)
    told = {(r.i, r.j): r.d for r in pairs}
    assert all(told[k, k + 3] > 2 / 9 * len(sets[k]) for k in (12, 16, 20, 24, 28, 32))
