"""Document fingerprints in DataFrame operations: SpotSigs.

An anchor is a very common word; its signature is the anchor and the next ``CHAIN`` content words after it (words that are
no anchors), so that signatures follow the prose and not lists, menus or marks. Where anchors are missing or too far apart
(texts in other languages, lists, tables), ``whole`` lets every content word there begin a signature of its own, so that at
least half of any part of a text is seen. A document's fingerprint is the set of its
signatures. Sets are compared by Jaccard; a pair whose lengths alone rule the threshold out is never looked at.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, row_key, shared_dir, small, staged, words

# Very common words of four languages, the anchors.
ANCHORS = {
    "en": "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their there they this to was we were which will with would you".split(),
    "de": "als auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat ich im in ist mit nach nicht noch sich sie sind so und von war werden wie wird zu zum zur über".split(),
    "fr": "au aux avec ce ces cette dans de des du elle en est et eux il je la le les leur mais ne nous ou par pas pour qu que qui sa se ses son sur un une vous".split(),
    "es": "al como con de del el ella en es esta este la las lo los más me mi no nos o para pero por que se si sin sobre su sus un una y ya".split(),
}
CHAIN = 2
#: Content words from one anchor to the next, beyond which ``whole`` takes all chains between them.
STRETCH = 2 * CHAIN
THRESHOLD = 0.8
#: Signatures that go last in a prefix, and how many a sketch of them tracks.
MOST_COMMON, TRACKED = 256, 10_000
#: Words of 64 bits that a set's parity bits take at most; beyond that they tell longer sets less well apart.
MOST_WORDS = 64
#: Sets that are like a query by their bits, 16 bytes each, beyond which their keys are shuffled and not broadcast.
MOST_FOUND = 1_000_000
#: Buckets a partition of the ordered documents gets, on average, so that hashing spreads them evenly.
BUCKETS_PER_PARTITION = 8
#: Runs of ids at most; their bounds, some numbers each, are part of the plan.
MOST_RUNS = 50_000


def signatures(text: Column, chain: int = CHAIN, anchors: dict[str, list[str]] = ANCHORS, whole: bool = False) -> list[tuple[str, Column]]:
    """Steps of columns, to be added one after another; the last is ``_sigs``, the sorted distinct 64-bit signatures.

    Words are in lower case. The text's start is an anchor too. A chain that the text's end cuts short counts as it is,
    one without any content word does not. A text with words but without signatures has one, of all its words; null and
    empty texts have none. With ``whole``, all chains of content words count too where more than ``STRETCH`` of them have no
    anchor between, and everywhere in a text without anchors.
    """
    common = sorted({w for ws in anchors.values() for w in ws})
    at, low = F.col("_anchor"), F.col("_low")
    # before the anchor at p, the r-th, there are p - r content words
    one = F.transform(at, lambda p, r: F.when(F.get("_content", p - r).isNotNull(), F.xxhash64(F.get(low, p), *[F.get("_content", p - r + j) for j in range(chain)])))
    start = F.when(F.size("_content") > 0, F.xxhash64(F.lit("^"), *[F.get("_content", F.lit(j)) for j in range(chain)]))
    found = F.array_compact(F.concat(F.array(start), one))
    # the r-th bound has as many content words before it; the first is the text's start, the last its end
    bounds = F.concat(F.array(F.lit(0)), F.transform(at, lambda p, r: p - r), F.array(F.size("_content")))
    far = F.transform("_bounds", lambda x, r: F.when(F.get("_bounds", r + 1) - x > F.when(F.size(at) > 0, STRETCH).otherwise(0), F.sequence(x, F.get("_bounds", r + 1) - 1)).otherwise(F.array().cast("array<int>")))
    more = F.transform("_far", lambda k: F.xxhash64(F.lit("~"), *[F.get("_content", k + j) for j in range(chain)]))
    every = F.when(F.size(low) > 0, F.array(F.xxhash64(F.array_join(low, " ")))).otherwise(F.array().cast("array<bigint>"))
    return [
        ("_low", words(F.lower(text))),
        ("_content", F.filter("_low", lambda w: ~w.isin(common))),
        ("_anchor", F.array_compact(F.transform("_low", lambda w, i: F.when(w.isin(common), i)))),
        *([("_bounds", bounds), ("_far", F.flatten(far))] if whole else []),
        ("_sigs", F.array_sort(F.array_distinct(F.when(F.size("_content") > 0, F.concat(found, more) if whole else found).otherwise(every)))),
    ]


def with_signatures(df: DataFrame, text: str, name: str, whole: bool = False) -> DataFrame:
    """``df`` and the column ``name``, the signatures of ``text``; none for a null or empty one. Rows that repeat have the same."""
    keep = df.columns
    for step, column in signatures(F.coalesce(F.col(text), F.lit("")), whole=whole):
        df = df.withColumn(step, column)
    return df.select(*keep, F.col("_sigs").alias(name))


def fingerprint(sigs: Column) -> Column:
    """The signatures' upper 32 bits in hex, in order, without separators; empty for none."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(F.shiftrightunsigned(s, 32))), 8, "0")), "")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard index of two signature sets; 0 where their sizes alone keep it below ``threshold``; two empty sets: 1."""
    least, most = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = F.when(most == 0, F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))
    return F.when((most > 0) & (least < most * threshold), F.lit(0.0)).otherwise(exact).cast("double") if threshold else exact.cast("double")


def _commonest(rows: DataFrame) -> list[int]:
    """The signatures that most rows hold, rarest first: a sketch of bounded size over all rows, merged on the way.

    They only settle an order, so that an estimate loses nothing.
    """
    found = rows.select(F.explode("sigs").alias("sig")).agg(F.expr(f"approx_top_k(sig, {MOST_COMMON}, {TRACKED})").alias("top")).first()["top"]
    return [x["item"] for x in sorted(found or [], key=lambda x: (x["count"], x["item"]))]


def parities(sigs: str) -> Column:
    """Bits of a signature set, about one a signature: each tells whether an odd number of signatures falls on it; none for an empty set.

    Two sets differ in at least as many signatures as in bits, so that bits can rule a pair out, never in.
    """
    # a width is a power of two, so that a wider array folds to a narrower one
    width = f"shiftleft(1, cast(greatest(0, least({MOST_WORDS.bit_length() - 1}, ceil(log2(size({sigs}) / 64.0D)))) as int))"
    word = f"(i, w) -> aggregate({sigs}, 0L, (a, s) -> if((s & (w - 1)) = i, a ^ shiftleft(1L, cast(shiftright(s, 8) & 63 as int)), a))"
    return F.expr(f"if(size({sigs}) > 0, zip_with(sequence(0, {width} - 1), array_repeat({width}, {width}), {word}), cast(array() as array<bigint>))")


def differing(a: str, b: str) -> Column:
    """In how many bits two columns of ``parities`` differ, the wider folded to the narrower's width."""
    least = f"least(size({a}), size({b}))"
    fold = "if(size({0}) = {1}, {0}, transform(sequence(0, {1} - 1), i -> aggregate(filter({0}, (x, j) -> j % {1} = i), 0L, (s, x) -> s ^ x)))"
    return F.expr(f"if({least} = 0, 0, aggregate(zip_with({fold.format(a, least)}, {fold.format(b, least)}, (x, y) -> bit_count(x ^ y)), 0, (s, n) -> s + n))")


def search(docs: DataFrame, queries: DataFrame, threshold: float = THRESHOLD, whole: bool = False, expand: bool = True) -> DataFrame:
    """(query_id, doc_id, likeness) of every query and document whose likeness is at least ``threshold``, above 0.

    Equal signature sets are compared once; with ``expand`` unset they are not spread over their documents again, and the
    columns are query_id, class_id (the least doc_id with that set), n_docs and likeness. Sets are partitioned by length:
    runs of lengths so that like sets lie in the same run or in neighbours. A set's prefix, of its signatures in an order that
    puts the commonest last, is long enough that like sets share a signature of their prefixes; these meet in a shuffle, and
    are compared in full where their lengths, the places of that signature and their bits (``parities``) allow it. Texts without words are like one another only, and are left out. Null
    ids can match like others; extra columns are ignored; a query that repeats gives its rows as often. Both sides' sets
    and the pairs that meet are written to the shared folder once.
    """
    if not 0 < threshold <= 1:
        raise ValueError("a threshold lies above 0 and is 1 at most")

    def rows(df: DataFrame) -> DataFrame:
        # a filter on the signatures would be pushed below their steps and repeat them; this one is on the text
        full = with_signatures(df.select("doc_id", "text").where(F.col("text").rlike(WORD)), "text", "sigs", whole)
        return full.select("doc_id", "sigs", *row_key(F.col("sigs")), parities("sigs").alias("bits"))

    def sets(full: DataFrame) -> DataFrame:
        return full.groupBy("_k1", "_k2").agg(F.any_value("sigs").alias("sigs"), F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_docs"))

    folder = shared_dir(docs.sparkSession)
    full, asked = staged(rows(docs), folder, "signatures"), staged(rows(queries), folder, "queries")
    common = _literals(_commonest(full))

    def prefixes(df: DataFrame, reach: int) -> DataFrame:
        # entries hold no sets, so that a common signature's are short
        n = F.size("sigs")
        run = F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / min(threshold, 0.999)))).cast("int")
        ordered = F.concat(F.array_except("sigs", common), F.array_intersect(common, "sigs"))
        head = F.slice(ordered, F.lit(1), F.least(n, n - F.ceil(n * threshold - 1e-9).cast("int") + 1))
        out = df.select("_k1", "_k2", n.alias("n"), F.posexplode(head).alias("at", "sig"), run.alias("run"))
        return out.withColumn("run", F.explode(F.sequence(F.col("run") - reach, F.col("run") + reach))) if reach else out

    mine = sets(asked)
    a = prefixes(mine, 1).select("sig", "run", F.col("_k1").alias("q1"), F.col("_k2").alias("q2"), F.col("n").alias("m"), F.col("at").alias("q_at"))
    # equal sets have equal entries; these become one before the join, so that no set is shuffled
    met = a.join(prefixes(full, 0).distinct(), ["sig", "run"]).where(F.least("m", "n") >= threshold * F.greatest("m", "n") - 1e-9)
    # from their first common signature on, sets have no more in common than the shorter rest holds
    met = met.where(F.least(F.col("m") - F.col("q_at"), F.col("n") - F.col("at")) >= threshold / (1 + threshold) * (F.col("m") + F.col("n")) - 1e-6)
    # a pair that shares several signatures of its prefixes is compared once; bits rule most pairs out before sets are sent to them
    met = met.select("q1", "q2", "_k1", "_k2", "m", "n").distinct()
    met = met.join(asked.select(F.col("_k1").alias("q1"), F.col("_k2").alias("q2"), F.col("bits").alias("q_bits")).distinct(), ["q1", "q2"])
    met = met.join(full.select("_k1", "_k2", "bits").distinct(), ["_k1", "_k2"])
    met = met.where(differing("q_bits", "bits") <= (1 - threshold) / (1 + threshold) * (F.col("m") + F.col("n")) + 1e-6)
    met = staged(met.select("q1", "q2", "_k1", "_k2"), folder, "pairs")
    found = sets(full.join(small(met.select("_k1", "_k2").distinct(), MOST_FOUND), ["_k1", "_k2"], "left_semi"))
    met = met.join(mine.select(F.col("_k1").alias("q1"), F.col("_k2").alias("q2"), F.col("sigs").alias("q")), ["q1", "q2"]).join(found, ["_k1", "_k2"])
    met = met.select("q1", "q2", "_k1", "_k2", "class_id", "n_docs", likeness(F.col("q"), F.col("sigs"), threshold).alias("likeness")).where(F.col("likeness") >= threshold)
    if expand:
        met = met.join(full.select("doc_id", "_k1", "_k2"), ["_k1", "_k2"])
    ids = asked.select(F.col("doc_id").alias("query_id"), F.col("_k1").alias("q1"), F.col("_k2").alias("q2"))
    return met.join(ids, ["q1", "q2"]).select("query_id", *(["doc_id"] if expand else ["class_id", "n_docs"]), "likeness")


def _bounds(docs: DataFrame, n: int) -> tuple[list[int], list[int]]:
    """Some document ids, ascending, that cut the documents into about ``n`` even runs; and into how many slices each run is cut, null ids' run first.

    A run has more than one slice only where it is of a single id, which holds as many runs' share.
    """
    found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("b"), F.count(F.lit(1)).alias("all"), F.count("doc_id").alias("ids")).first()
    times = Counter(found["b"] or [])
    bounds = sorted({*times, *(v - 1 for v, k in times.items() if k > 1 and v > -(1 << 63))})
    nulls = -(-n * (found["all"] - found["ids"]) // max(found["all"], 1))
    return bounds, [max(x, 1) for x in (nulls, *(times[v] for v in bounds), 1)]


def with_next(docs: DataFrame, sigs: bool = True, whole: bool = False) -> DataFrame:
    """(doc_id, text, [sigs,] next_text, [next_sigs,]): each document beside the next one in descending order of doc_id; the last beside the first.

    Documents are dealt into runs of ids; each run gets a copy of the first document of the run below, so that no run needs
    another. Equal ids go by text's hash, then text, null ids come last; where one id, or null, has very many documents, their
    run is cut into slices by that hash. A single document's next one is itself.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = min(MOST_RUNS, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds, slices = _bounds(docs, n)  # at most 2 n numbers
    # a run holds the ids above a bound, up to and with the next; slices count downwards, as their hashes go up
    most = max(slices)
    size = F.get(_literals(slices), F.col("_place") + 1)
    part = F.least(F.floor((F.xxhash64("text").cast("double") / 2.0**64 + 0.5) * size), size - 1)
    dealt = _placed(docs, bounds, "_place").withColumn("_run", (F.col("_place") + 1).cast("long") * most + most - 1 - part).drop("_place").withColumn("_ghost", F.lit(0))
    order = [F.col("_ghost").asc(), F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc(), F.col("text").asc()]
    # which documents begin a run, in descending order: a row a slice, at most 3 n + 2
    runs = sorted((r["_run"], r["top"], r["h"]) for r in dealt.groupBy("_run").agg(F.max("doc_id").alias("top"), F.min_by(F.xxhash64("text"), F.struct(F.bitwise_not("doc_id"), F.xxhash64("text"))).alias("h")).collect())
    # beside each run the one above it, which its first document closes; above the uppermost one comes the lowest again
    above = [(run, runs[(i + 1) % len(runs)][0], top, h) for i, (run, top, h) in enumerate(runs)]
    above = F.broadcast(spark.createDataFrame(above, "_run long, _above long, _top long, _h long"))
    heads = dealt.join(above, "_run").where(F.col("doc_id").eqNullSafe(F.col("_top")) & (F.xxhash64("text") == F.col("_h")))
    first = Window.partitionBy("_run").orderBy(F.col("text").asc())
    ghosts = heads.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("doc_id", "text", F.col("_above").alias("_run"), F.lit(1).alias("_ghost"))
    both = dealt.unionByName(ghosts)
    w = Window.partitionBy("_run").orderBy(*order)
    out = both.withColumn("next_text", F.lead("text").over(w))
    if sigs:
        out = with_signatures(out, "text", "sigs", whole).withColumn("next_sigs", F.lead("sigs").over(w))
    return out.where("_ghost = 0").drop("_run", "_ghost")


def _literals(values: list[int]) -> Column:
    """An array of numbers: one expression of literals, which is folded to one, however many."""
    return F.expr(f"array({', '.join(f'{x}L' if x > -(1 << 63) else 'bigint(-9223372036854775808)' for x in values)})").cast("array<bigint>")


def _placed(docs: DataFrame, bounds: list, name: str) -> DataFrame:
    """With ``name``: how many of the ascending ``bounds`` lie below doc_id, by halving; -1 for a null one."""
    values, n = _literals(bounds), len(bounds)
    docs = docs.withColumn(name, F.lit(0))
    for step in [1 << i for i in reversed(range(n.bit_length()))]:
        docs = docs.withColumn(name, F.when((F.col(name) + step <= n) & (F.get(values, F.col(name) + step - 1) < F.col("doc_id")), F.col(name) + step).otherwise(F.col(name)))
    # a filter on the place would be pushed below its steps and grow with each of them; it stops at the explode
    place = F.explode(F.array(F.when(F.col("doc_id").isNull(), -1).otherwise(F.col(name)))).alias(name)
    return docs.select(*[c for c in docs.columns if c != name], place)


def edited_fingerprints(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text keeps the first half (rounded up) and takes as many characters from the next document's start as it
    lost, or all of it. A null text is empty; extra columns are ignored. ``whole`` is that of
    ``signatures``.
    """
    out = with_next(docs, whole=whole).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    out = out.withColumn("_edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring("next_text", F.lit(1), half)))
    out = with_signatures(out.select("doc_id", "n_chars", "sigs", "next_sigs", "_edited"), "_edited", "edited_sigs", whole)
    return out.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )
