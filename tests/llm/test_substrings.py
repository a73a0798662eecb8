import random
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from transitlake.llm import bytewords as B
from transitlake.llm import substrings as S

SPLIT = " \t\n\r\x0b\x0c"


def words(text):
    for c in SPLIT[1:]:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(docs, window):
    count = Counter()
    for _, text in docs:
        w = words(text)
        count.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc, text in docs:
        w = words(text)
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def copied(prose):
    """Texts that share passages, with themselves too, and whole copies."""
    r = random.Random(3)
    passages = [prose(100 + i, n).split() for i, n in enumerate([35, 36, 34, 60, 120])]
    out = []
    for i in range(60):
        w = prose(i, r.randrange(0, 200), 5000).split()
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(passages)
        out.append((i, r.choice([" ", "\n", " \t", "\x0b"]).join(w)))
    return [*out, *[(1000 + i, out[0][1]) for i in range(5)], (2000, "same " * 50), (2001, out[3][1]), (2001, out[3][1])]


@pytest.mark.parametrize("shape", [None, S.Shape(1, 0, 16), S.Shape(3, 5, 7001)])
@pytest.mark.parametrize("batch_words", [50, 2_000_000])
def test_equals_brute_force(spark, copied, shape, batch_words, monkeypatch):
    monkeypatch.setattr(S, "BATCH_WORDS", batch_words)
    monkeypatch.setattr(S, "SETTLED_ROW", 7)
    df = spark.createDataFrame(copied, "doc_id long, text string").repartition(3)
    got = sorted([tuple(r) for r in S.remove_repeats(df, 35, shape).collect()], key=repr)
    assert got == brute(copied, 35)


@pytest.mark.parametrize("window", [1, 3])
def test_edge_cases(spark, docs, empty, window):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted([tuple(r) for r in S.remove_repeats(docs, window).collect()], key=repr) == brute(rows, window)
    assert S.remove_repeats(empty, window).collect() == []


def thue_morse(n):
    """Two words of n letters that every polynomial hash modulo 2^64 with an odd base takes for one another, if n is 1,024 or more."""
    bits = [i.bit_count() % 2 for i in range(n)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def test_words_that_hash_alike_are_told_apart(spark):
    one, two = thue_morse(2048)
    ((_, _, data, offsets),) = B.chunks(pa.array([one, two]))
    words = B.words_of(B.SPACED[data], offsets)
    assert len(set(B.Hasher(7).words(B.SPACED[data], words).tolist())) == 1
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"x {one} {rest} y"), (4, "a\x00b " * 40), (5, "a\x00c " * 40)]
    got = sorted(tuple(r) for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), 35).collect())
    assert got == brute(rows, 35) and got[1][2] == 0 and got[0][2] == 35


def test_the_sketch_lets_few_single_windows_through(spark, prose):
    df = spark.createDataFrame([(i, -i, prose(i, 400, 10**6)) for i in range(60)], "_k1 long, _k2 long, text string").coalesce(1)
    rows = [pa.RecordBatch.from_pylist([r.asDict() for r in df.collect()], schema=pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("text", pa.string())]))]
    shape = S.choose_shape(sum(len(r["text"]) for r in rows[0].to_pylist()), 4)
    said = {(r.number, r.digest, r.shard): (r.n, bytes(r.bits)) for r in S.sketch(df, shape).collect()}
    (batch,) = S._batches(iter(rows), 35, False)
    share = S._estimated(batch, shape, said).mean()
    assert len(batch.doc) == 60 * 366 and share < 0.1
    assert S._estimated(batch, shape, {}).all()  # without answers nothing is lost
    batch.doc = batch.doc[::-1].copy()
    assert S._estimated(batch, shape, said).all()  # nor with those of other batches


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), max_size=50).map(sorted))
def test_gaps_round_trip(cells):
    cells = np.array(cells, np.int64)
    assert (S.decode_gaps(S.encode_gaps(cells)) == cells).all() and len(S.decode_gaps(S.encode_gaps(cells))) == len(cells)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAÉ漢😀 \n\t\x0b\x0c\r\x1c\x00.!1_"), max_size=30), max_size=8), st.integers(1, 20))
def test_words_of_bytes(texts, size):
    for table, split in ((B.SPACED, words), (B.PLAIN, lambda t: "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in t).replace("\x1c", " ").replace("\x00", " ").split(" "))):
        got = []
        for at, to, data, offsets in B.chunks(pa.array(texts, pa.string()), size):
            classed = table[data]
            w = B.words_of(classed, offsets)
            for k in range(to - at):
                got.append([classed[a:b].tobytes().decode() for a, b in zip(w.start[w.first[k] : w.first[k + 1]], w.end[w.first[k] : w.first[k + 1]], strict=True)])
                run = np.arange(w.first[k], max(w.first[k], w.first[k + 1] - 1))
                assert [x.tobytes() for x in B.joined(classed, w).digests(run, 2)] == [blake2b(f"{a} {b}".encode(), digest_size=16).digest() for a, b in zip(got[-1], got[-1][1:], strict=False)]
        assert got == [[x for x in split(t) if x] for t in texts]


def test_hashes_tell_words_and_runs_apart():
    r = random.Random(0)
    texts = [" ".join("".join(r.choice("ab") for _ in range(r.randrange(1, 8))) for _ in range(200)) for _ in range(50)]
    ((_, _, data, offsets),) = B.chunks(pa.array(texts))
    classed = B.SPACED[data]
    w = B.words_of(classed, offsets)
    h = B.Hasher(5)
    plain = [x for t in texts for x in t.split()]
    hashes = h.words(classed, w)
    assert len(set(zip(plain, hashes.tolist(), strict=True))) == len(set(plain)) == len(set(hashes.tolist()))
    runs = h.runs(hashes, 3).tolist()
    tuples = [tuple(plain[i : i + 3]) for i in range(len(plain) - 2)]
    assert len(set(zip(tuples, runs, strict=True))) == len(set(tuples)) == len(set(runs))
