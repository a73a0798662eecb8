"""Benchmark decontamination in DataFrame operations.

The windows of the benchmark, hashed, make a broadcast hash set. Every word position of the documents probes it inside one
generated-code stage, and only hits and one row per document leave that stage. A hash says "maybe": each hit is held against
the window's own words. A benchmark too large for that is broadcast as bits, two for each window in a table of fixed size;
positions that find both go into a shuffled join with the windows, all others stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import held, lower_ascii, row_key, words

WINDOW = 10
#: Windows of a benchmark that are broadcast at most, and bytes that they, their words and their items take.
BROADCAST_WINDOWS, BROADCAST_BYTES = 1_000_000, 256 << 20
#: Words, of 64 bits, of the table of bits; about 40 bytes each where it is broadcast.
FILTER_WORDS = 1 << 20


def _hash(tokens: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(tokens, start + j) for j in range(length)])


def _hashed(tokens: Column) -> Column:
    # lower() is coarser than A-Z alone: equal windows hash alike, and the check that follows is exact
    return F.transform(tokens, lambda w: F.xxhash64(F.lower(w)))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per window: ``_h``, ``_len``, ``_words`` and the array ``_items`` of the items that have it.

    An item of fewer than ``window`` words is one window, one without words none; a null id counts as the empty string.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("raw")).where(F.size("raw") > 0)
    items = items.select("item", "raw", _hashed(F.col("raw")).alias("low"), F.least(F.size("raw"), F.lit(window)).alias("len"))
    cut = items.select("item", "len", "raw", "low", F.explode(F.sequence(F.lit(1), F.size("raw") - F.col("len") + 1)).alias("i"))
    part = cut.select("item", "len", lower_ascii(F.array_join(F.slice("raw", F.col("i"), F.col("len")), " ")).alias("words"), F.slice("low", F.col("i"), F.col("len")).alias("low"))
    hashes = F.lit(None).cast("long")
    for n in range(1, window + 1):
        hashes = F.when(F.col("len") == n, _hash(F.col("low"), F.lit(0), n)).otherwise(hashes)
    return part.groupBy(hashes.alias("_h"), F.col("len").alias("_len"), F.col("words").alias("_words")).agg(F.collect_set("item").alias("_items"))


def _is_few(table: DataFrame, most: int) -> bool:
    """Whether the windows are few and small enough to be broadcast, items included."""
    found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(100 + F.octet_length("_words") + F.aggregate("_items", F.lit(0), lambda s, x: s + 24 + F.octet_length(x))).alias("bytes")).first()
    return found["n"] <= most and (found["bytes"] or 0) <= BROADCAST_BYTES


def _bits(hashes: Column) -> Column:
    """Two bits of 64, by a hash's upper twelve."""
    one, two = F.shiftrightunsigned(hashes, 52).bitwiseAND(63), F.shiftrightunsigned(hashes, 58)
    return F.call_function("shiftleft", F.lit(1).cast("long"), one.cast("int")).bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), two.cast("int")))


def _probed(at: DataFrame, table: DataFrame) -> DataFrame:
    """The positions whose hash ``_at`` may be that of a window: a table of at most ``FILTER_WORDS`` rows tells."""
    words = table.select(F.pmod("_h", F.lit(FILTER_WORDS)).alias("_w"), _bits(F.col("_h")).alias("_b")).groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    mine = _bits(F.col("_at"))
    return at.where("_at IS NOT NULL").join(F.broadcast(words), (F.pmod("_at", F.lit(FILTER_WORDS)) == F.col("_w")) & (F.col("_b").bitwiseAND(mine) == mine)).drop("_w", "_b")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Per document: ``_k1``, ``_k2`` (its row key), doc_id, n_words, n_hit, n_items, items, spans.

    ``spans``: the runs of hit words, as (first, last), counted from 1. A null or empty text has no words and no hits.
    Rows that repeat come out as often as they went in; other columns are ignored, whatever their names.
    """
    table = benchmark_windows(benchmark, window)
    lengths = sorted(r[0] for r in table.select("_len").distinct().collect()) or [window]  # at most `window` numbers
    few = _is_few(table, broadcast_windows)
    docs = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    docs = docs.select("_id", *row_key(F.col("_id"), F.col("_text")), words(F.col("_text")).alias("_raw")).withColumn("_low", _hashed(F.col("_raw")))
    i, n = F.col("_i"), F.size("_raw")
    at = docs.select("*", F.explode(F.sequence(F.lit(0), n)).alias("_i"))
    if len(lengths) > 1:
        at = at.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("_k")).where((i > 0) | (F.col("_k") == lengths[0]))
    else:
        at = at.withColumn("_k", F.lit(lengths[0]))
    k, hashes = F.col("_k"), F.lit(None).cast("long")
    for m in lengths:
        hashes = F.when((k == m) & (i >= 1) & (i + m - 1 <= n), _hash(F.col("_low"), i - 1, m)).otherwise(hashes)
    at, said = at.withColumn("_at", hashes), lower_ascii(F.array_join(F.slice("_raw", F.greatest(i, F.lit(1)), k), " "))
    # no higher-order function and no array of a whole text leaves the generated code that walks the positions
    span = F.struct(i.alias("a"), (i + k - 1).alias("b"))
    if few:
        met = at.join(F.broadcast(table), (F.col("_at") == F.col("_h")) & (k == F.col("_len")) & (F.col("_words") == said), "left")
        met = met.where((i == 0) | F.col("_h").isNotNull())
        met = met.select("_id", "_k1", "_k2", "_i", n.alias("_n"), F.when(i > 0, span).alias("_span"), "_items")
    else:
        probed = _probed(at, table).select("_id", "_k1", "_k2", "_i", n.alias("_n"), "_k", "_at", said.alias("_said"))
        hits = probed.join(table, (F.col("_at") == F.col("_h")) & (F.col("_words") == F.col("_said"))).select("_id", "_k1", "_k2", "_i", "_n", span.alias("_span"), "_items")
        none = F.lit(None)
        met = hits.union(docs.select("_id", "_k1", "_k2", F.lit(0), n, none.cast("struct<a:int,b:int>"), none.cast("array<string>")))
    per = met.groupBy("_id", "_k1", "_k2").agg(
        F.count(F.when(i == 0, 1)).alias("_copies"), F.max("_n").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("_span")).alias("_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"),
    )
    runs = F.aggregate(
        "_spans", F.array().cast("array<struct<a:int,b:int>>"),
        lambda done, x: F.when((F.size(done) > 0) & (x["a"] <= F.get(done, F.size(done) - 1)["b"] + 1), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.get(done, F.size(done) - 1)["a"].alias("a"), F.greatest(F.get(done, F.size(done) - 1)["b"], x["b"]).alias("b"))))).otherwise(F.concat(done, F.array(F.struct(x["a"].alias("a"), x["b"].alias("b"))))),
    )
    per = per.withColumn("spans", runs).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"] + 1)
    return per.select("_k1", "_k2", F.col("_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, action: str = "document", window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents (``action="document"``), or with the hit words cut out (``"span"``).

    All columns stay; in a text that loses words, each lost word goes with the separators that follow it, and ``n_chars``
    (if there) is counted anew. Null and empty texts stay as they are. Clashing column names are safe: keys are private.
    """
    if action not in ("document", "span"):
        raise ValueError(f"action is document or span, not {action!r}")
    keyed = held(docs, *row_key(F.col("doc_id"), F.col("text")))
    hit = contamination(docs, benchmark, window).where("n_hit > 0").select("_k1", "_k2", F.col("spans").alias("_spans")).dropDuplicates(["_k1", "_k2"])
    if action == "document":
        return keyed.join(hit, ["_k1", "_k2"], "left_anti").select("_row.*")
    out, text = keyed.join(hit, ["_k1", "_k2"], "left"), F.col("_row.text")
    raw, gaps = words(text), F.split(text, r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")
    kept = F.transform(raw, lambda w, i: F.when(F.exists("_spans", lambda s: (i + 1 >= s["a"]) & (i + 1 <= s["b"])), F.lit("")).otherwise(F.concat(w, F.get(gaps, i + 1))))
    cut = F.when(F.col("_spans").isNull(), text).otherwise(F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, "")))
    out = out.select("_row", "_spans", cut.alias("_text"))
    new = {"text": F.col("_text"), "n_chars": F.when(F.col("_spans").isNull(), F.col("_row.n_chars")).otherwise(F.length("_text")) if "n_chars" in docs.columns else None}
    return out.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if new.get(c) is not None else F.col("_row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The digest of ``contamination``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(docs, benchmark, window)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
