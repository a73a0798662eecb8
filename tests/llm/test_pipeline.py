import random

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from transitlake.llm import pii, tokens
from transitlake.llm.oracle import ORACLE_SQL
from transitlake.llm.queries import QUERIES

from .test_decontaminate import brute as contaminated
from .test_jaccard import brute as classes
from .test_tokens import check_packing
from transitlake.llm.pack import Limits

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, prose, tmp_path_factory):
    """Good prose, junk, near copies, passages of the benchmark, personal data, nulls: tables as files."""
    r, rows = random.Random(9), []
    items = [(i, " ".join(f"b{i}x{j}" for j in range(15))) for i in range(4)]
    for i in range(150):
        w = prose(i, 60 + i % 60, 3000).replace("w", "word").split()
        if i % 10 == 1:
            w = prose(i - 1, 60 + (i - 1) % 60, 3000).replace("w", "word").split()
            w[3] = "changed"
        if i % 10 == 4:
            w[20:20] = items[i % 4][1].split()
        if i % 10 == 7:
            w[10:10] = ["ann.b@mail.org", "and", "10.0.0.1,", "joe", "[at]", "mail", "[dot]", "org"]
        rows.append((i, " ".join(w) + "."))
    rows += [(1000 + i, r.choice(["!!! ".join(prose(i, 50).upper().split()), f"x{i} " * 70])) for i in range(50)]
    rows += [(2000, None), (2001, ""), (2002, rows[0][1])]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows if i < 2000], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_every_stage_equals_brute_force(spark, tables):
    folder, rows, items = tables
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"] and P.ORACLE_SQL is None
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    at = {}
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == COLUMNS
        at[name] = {r.doc_id: r for r in docs.collect()}
    text = dict(rows)
    scored = {r.doc_id for r in QUERIES["op5_quality_classifier"](spark, folder).where("predicted = 1").collect()}
    assert set(at["quality"]) == scored and len(scored & set(range(150))) > 145 and len(scored & set(range(1000, 1050))) <= 3
    first = {c for _, c, _ in classes([(i, text[i]) for i in at["quality"]])}
    assert set(at["near_duplicates"]) == first and not {2002} & first
    clean = {d for d, *_, bad in contaminated([(i, text[i]) for i in first], items) if not bad}
    assert set(at["decontamination"]) == clean and len(clean) < len(first)
    masked = {i: text[i] if text[i] is None else pii.masked_text(text[i]) for i in clean}
    assert {i: r.text for i, r in at["pii"].items()} == masked and any("<EMAIL> and <IP>, <EMAIL>" in (x or "") for x in masked.values())
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in at["pii"].values())
    t = Tokenizer.from_file(tokens.default_tokenizer())
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in masked.items()}
    packed = P.STAGES[-1][1](spark, docs, folder).collect()
    check_packing(packed, ids, Limits())
    assert all(list(r.ids) == ids[r.doc_id][r.start : r.start + r.length] for r in packed)
    whole = P.run(spark, folder).collect()
    assert sum(r.length for r in whole) == sum(map(len, ids.values())) and {r.doc_id for r in whole} == clean


def test_empty_documents(spark, tables):
    folder, *_ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF), con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_queries_cover_whole_tables(spark):
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages")}
    for name, rows in (("op2_token_id_output", n["documents"]), ("op5_quality_classifier", n["documents"]), ("op8_ngram_jaccard_join", n["documents"]), ("op9_warc_derivatives", 2 * n["pages"]), ("op10_url_filter", n["pages"])):
        assert QUERIES[name](spark, SF).count() == rows
    own = [k for k in QUERIES if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in own) == list(range(1, 11)) and set(QUERIES) - set(own) == {"pack_conversations", "spotsigs_search"}
