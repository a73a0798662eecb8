"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets decide.

1. One pass hashes each text's word shingles and writes its MinHash bands. Texts of the same words become one node.
2. A shuffle on band hashes finds the buckets of more than one node. Every pair that shares a bucket is verified, once, on
   full sets of shingles, which are told by 128 bits of BLAKE2b over their words.
3. Where it is verified: edges from each node to the least one of its buckets, as many as members, give components. A small
   component is verified as a whole, so that its sets travel once. A large one, which chance pairs can string together, is
   taken apart into its buckets; a pair counts in the first band that it shares. Groups of many nodes go in blocks against
   blocks. Groups are dealt to tasks by their places in the order of all groups, not by a hash, so that tasks are even.
4. Only one row per node and group leaves a task: its links and the least node that they lead to. Components of these, of
   verified links only, are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import PLAIN, Hasher, U, chunks, joined, mixed, seeds, string_array, words_of
from .components import components
from .shared import drop, held, row_key, shared_dir, small, staged

SHINGLE, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.9999, 192
#: Shingles and nodes of a block; two blocks meet in a task.
BLOCK_SHINGLES, BLOCK_NODES = 500_000, 1024
#: A group of more nodes than PART_NODES is cut in up to PARTS blocks even where one would hold it, for more tasks.
PARTS, PART_NODES = 8, 128
#: Shingles and nodes of a candidate component that is verified as a whole; larger ones are verified bucket by bucket.
WHOLE_SHINGLES, WHOLE_NODES = 4_000_000, 8192
#: Candidate rows that are broadcast to fetch their texts, about 150 bytes each, or to name their classes; beyond, both sides are shuffled.
BROADCAST_ROWS = 250_000
#: A shingle in more texts of a block than this is counted by matrix products, others pair by pair.
DENSE = 24
#: Shingles that a worker hashes at a time.
LOT = 1 << 17


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, hence the fewest false candidates, that reach the recall at the threshold within so many hashes."""
    best = None
    for rows in range(1, hashes + 1):
        bands = 1 if threshold >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"{hashes} hashes do not reach a recall of {recall} at {threshold}")
    return best


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """Of each text the sorted distinct shingle hashes, and a digest of its words; a text of fewer words, but not none, has one shingle of them all."""
    hasher = Hasher(8)
    for _, _, data, offsets in chunks(texts):
        classed = PLAIN[data]
        words = words_of(classed, offsets)
        hashes = hasher.words(classed, words)
        runs, plain = hasher.runs(hashes, shingle), joined(classed, words)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            said = blake2b(plain.data[plain.start[a] : plain.end[b - 1]] if b > a else b"", digest_size=16).digest()
            if b - a >= shingle:
                yield np.unique(runs[a : b - shingle + 1]), said
            else:
                yield hasher.runs(hashes[a:b], b - a) if b > a else np.zeros(0, U), said


def shingle_digests(texts: pa.Array, shingle: int) -> Iterator[bytes]:
    """The distinct digests, 16 bytes each, of each text's shingles."""
    for _, _, data, offsets in chunks(texts):
        classed = PLAIN[data]
        words = words_of(classed, offsets)
        plain = joined(classed, words)
        start, end, text = plain.start.tolist(), plain.end.tolist(), plain.data
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            n = min(shingle, b - a)
            yield b"".join({blake2b(text[x:y], digest_size=16).digest() for x, y in zip(start[a : b - n + 1], end[a + n - 1 : b], strict=True)} if n else ())


def _lots(texts: pa.Array, shingle: int) -> Iterator[tuple[int, list[tuple[np.ndarray, bytes]]]]:
    """``shingle_sets`` in lots of about ``LOT`` shingles, each with the row that it begins at."""
    lot, size, at = [], 0, 0
    for x in shingle_sets(texts, shingle):
        lot.append(x)
        size += len(x[0])
        if size >= LOT:
            yield at, lot
            at += len(lot)
            lot, size = [], 0
    if lot:
        yield at, lot


def _signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes, one line per set; no set is empty."""
    every, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    flips, factors = seeds(bands * rows, 31), seeds(bands * rows, 32) | U(1)
    out = np.empty((len(sets), bands), U)
    for band in range(bands):
        h = np.full(len(sets), band + 1, U)
        for k in range(band * rows, (band + 1) * rows):
            h = mixed(h ^ np.minimum.reduceat((every ^ flips[k]) * factors[k], starts))
        out[:, band] = h
    return out


def _sign(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, _k1, _k2, d1, d2, n, bands): the digest of a text's words, null if it has none, its distinct shingles and band hashes."""
    names = ["doc_id", "_k1", "_k2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, lot in _lots(string_array(batch.column("text")), shingle):
                full = [i for i, (x, _) in enumerate(lot) if len(x)]
                digests, bits = np.frombuffer(b"".join(d for _, d in lot), np.int64).reshape(-1, 2), [None] * len(lot)
                if full:
                    for i, line in zip(full, _signatures([lot[i][0] for i in full], bands, rows).view(np.int64), strict=True):
                        bits[i] = line
                sizes = np.array([len(x) for x, _ in lot], np.int64)
                columns = [batch.column(n).slice(at, len(lot)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(digests[:, i], mask=sizes == 0) for i in (0, 1)), pa.array(sizes), pa.array(bits, pa.list_(pa.int64()))], [*names, "d1", "d2", "n", "bands"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _k1 long, _k2 long, d1 long, d2 long, n long, bands array<long>")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets, of digests in two columns, share."""
    n, owner = len(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    every = np.concatenate(sets)
    order = np.argsort(every[:, 0], kind="stable")
    one, two = every[order, 0], every[order, 1]
    if ((one[1:] == one[:-1]) & (two[1:] != two[:-1])).any():  # hardly ever
        order = np.lexsort((every[:, 1], every[:, 0]))
        one, two = every[order, 0], every[order, 1]
    owner = owner[order]
    starts = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
    counts = np.diff(np.concatenate([starts, [len(every)]]))
    out = np.zeros((n, n), np.float32)
    dense = np.flatnonzero(counts > DENSE)
    for i in range(0, len(dense), 2048):
        columns = dense[i : i + 2048]
        hits = np.zeros((n, len(columns)), np.float32)
        for j, c in enumerate(columns.tolist()):
            hits[owner[starts[c] : starts[c] + counts[c]], j] = 1
        out += hits @ hits.T
    flat = out.reshape(-1)
    for d in range(2, min(DENSE, n) + 1):
        columns = starts[counts == d]
        if len(columns):
            who = owner[columns[:, None] + np.arange(d)]
            for x in range(d):
                for y in range(x + 1, d):
                    cell, times = np.unique(who[:, x] * n + who[:, y], return_counts=True)
                    flat[cell] += times
    return np.maximum(out, out.T)


def _linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    sizes = np.array([len(x) for x in sets], float)
    common = _common(sets).astype(float)
    np.fill_diagonal(common, 0)
    return common / (sizes[:, None] + sizes[None, :] - common) >= threshold


def _parts(linked: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _met(bands: np.ndarray, band: int) -> np.ndarray:
    """Which two lines of band hashes share a bucket; with a ``band`` from 0 on, the first that they share is that one."""
    out = np.zeros((len(bands), len(bands)), bool)
    for k in range(bands.shape[1] if band < 0 else band):
        out |= bands[:, k, None] == bands[None, :, k]
    return out if band < 0 else ~out & (bands[:, band, None] == bands[None, :, band])


#: A group's key: its band, or -1 for a component; the bucket or the component; the two blocks that meet.
_GROUP = ["band", "g", "i", "j"]


def _verified(sets: DataFrame, threshold: float) -> DataFrame:
    """From (_GROUP, block, last, node, m, bands, shingles), sorted by group and node in each partition: (node, links, part, last).

    ``part`` is the least node of the group that links lead to; ``last`` says that the group holds all of a component.
    """

    def given(key: tuple, rows: list[tuple]) -> tuple:
        band, _, i, j = key
        node, m, block, last, bands, blobs = zip(*rows, strict=True)
        linked = _linked([np.frombuffer(x, U).reshape(-1, 2) for x in blobs], threshold) & _met(np.array(bands), band)
        if i != j:
            side = np.array(block)
            linked &= side[:, None] != side[None, :]
        nodes = np.array(node, np.int64)
        return nodes, linked @ np.array(m, np.int64), nodes[_parts(linked)], np.array(last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out, size = None, [], [], 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["node", "links", "part", "last"])

        for batch in batches:
            keys = zip(*(batch.column(n).to_pylist() for n in _GROUP), strict=True)
            lists = batch.column("bands")
            at, bands = lists.offsets.to_numpy(), lists.values.to_numpy()
            rest = zip(*(batch.column(n).to_pylist() for n in ("node", "m", "block", "last")), strict=True)
            for r, (new, mine) in enumerate(zip(keys, rest, strict=True)):
                if new != key:
                    if len(rows) > 1:
                        out.append(given(key, rows))
                        size += len(rows)
                    key, rows = new, []
                    if size >= 10_000:
                        yield flush()
                        size = 0
                elif mine[0] == rows[-1][0]:
                    continue  # a row that repeats another, from another task
                rows.append((*mine, bands[at[r] : at[r + 1]].copy(), batch.column("shingles")[r].as_py()))
        if len(rows) > 1:
            out.append(given(key, rows))
        if out:
            yield flush()

    return sets.mapInArrow(run, "node long, links long, part long, last boolean")


def _blocks(nodes: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(shingles / BLOCK_SHINGLES), F.ceil(nodes / BLOCK_NODES), F.least(F.lit(PARTS), F.ceil(nodes / PART_NODES)), F.lit(1)).cast("int")


def _places(wanted: DataFrame, nodes: DataFrame, partitions: int) -> DataFrame:
    """(node, part, _GROUP, block, last): in which groups each node is compared, and in which of so many partitions.

    ``wanted``: (node, comp, n). Of a large component's buckets with the same members only that of the first band is kept.
    """
    sizes = wanted.groupBy("comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    marked = wanted.select("node", "comp", "n").join(sizes, "comp")
    whole = (F.col("c") <= WHOLE_NODES) & (F.col("s") <= WHOLE_SHINGLES)
    ones = marked.where(whole).select("node", F.lit(-1).alias("band"), F.col("comp").alias("g"), _blocks(F.col("c"), F.col("s")).alias("nb"))
    large = marked.where(~whole).select("node", "n").join(nodes.select("node", "bands"), "node").select("node", "n", F.posexplode("bands").alias("band", "g"))
    buckets = large.groupBy("band", "g").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"), F.min("node").alias("hub"), F.bit_xor(F.xxhash64("node")).alias("mark")).where("c > 1")
    first = buckets.groupBy("hub", "c", "mark").agg(F.min(F.struct("band", "g", "s")).alias("b")).select("b.band", "b.g", _blocks(F.col("c"), F.col("b.s")).alias("nb"))
    many = large.join(first, ["band", "g"]).select("node", "band", "g", "nb")
    groups = ones.union(many).withColumn("block", F.pmod(F.xxhash64("node", "band"), F.col("nb")).cast("int"))
    each = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("x"))
    each = each.select("node", "band", "g", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"), "block", ((F.col("band") < 0) & (F.col("nb") == 1)).alias("last"))
    return each.repartitionByRange(partitions, *_GROUP).withColumn("part", F.spark_partition_id())


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, recall: float = RECALL, hashes: int = HASHES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: (doc_id, class_id, n_links, root, _k1, _k2).

    Two documents are linked if the Jaccard index of their sets of ``shingle``-word shingles is at least ``threshold``;
    ``n_links`` counts the other documents linked to this one, copies included; ``class_id`` is the least document id
    among those that links lead to. Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower
    case. A text with fewer words has one shingle of them all; one without words, or null, has no links and is its own
    class. Rows that repeat are copies like any other; null ids never name a class unless it has no other. Texts and
    shingles are equal if 128 bits of BLAKE2b over their words are. ``root`` names the class where ids
    may be null or repeat, and is null for a text without words; ``_k1`` and ``_k2`` name the row by id and text.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/jaccard"
    bands, rows = choose_bands(threshold, recall, hashes)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.select("doc_id", "text", *row_key(F.col("doc_id"), F.col("text")))
    signed = staged(_sign(docs, shingle, bands, rows), folder, "signed")
    members = signed.where("d1 IS NOT NULL").select("doc_id", "_k1", "_k2", "d1", "d2")
    # nodes are numbered as they are written, so that a number of 64 bits stands for a digest of 128
    nodes = signed.where("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("m"), F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.min(F.struct("_k1", "_k2")).alias("k"), F.first("bands").alias("bands"))
    nodes = staged(nodes.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "m", "rep", "n", "k._k1", "k._k2", "bands"), folder, "nodes")
    at = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    hubs = at.groupBy("band", "h").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("band", "h", "hub")
    edges = at.join(hubs, ["band", "h"]).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    comps = components(edges, folder, "candidates")
    wanted = staged(comps.withColumnRenamed("root", "comp").join(nodes.select("node", "n", "m", "_k1", "_k2"), "node"), folder, "wanted")
    placed = staged(_places(wanted, nodes, partitions), folder, "placed")
    places = placed.groupBy("node").agg(F.collect_list(F.struct("part", *_GROUP, "block", "last")).alias("places"))  # as many as blocks that meet its own
    fetched = wanted.select("node", "m", "_k1", "_k2").join(places, "node")
    texts = docs.join(small(staged(fetched, folder, "fetched"), BROADCAST_ROWS), ["_k1", "_k2"]).select("node", "m", "places", F.coalesce("text", F.lit("")).alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = [r for r, x in enumerate(batch.column("node").to_pylist()) if not (x in seen or seen.add(x))]
            batch = batch.take(pa.array(fresh, pa.int64()))
            own = string_array(batch.column("text"))
            for start, lot in _lots(own, shingle):
                signed = _signatures([x for x, _ in lot], bands, rows).view(np.int64)
                full = list(shingle_digests(pa.concat_arrays([own.slice(start, len(lot))]), shingle))
                rest = [batch.column(n).slice(start, len(lot)) for n in ("node", "m", "places")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(list(signed), pa.list_(pa.int64())), pa.array(full, pa.binary())], ["node", "m", "places", "bands", "shingles"])

    kind = "array<struct<part:int,band:int,g:long,i:int,j:int,block:int,last:boolean>>"
    full = texts.mapInArrow(sets, f"node long, m long, places {kind}, bands array<long>, shingles binary")
    met = full.select("node", "m", F.explode("places").alias("p"), "bands", "shingles").select("p.*", "node", "m", "bands", "shingles")
    met = met.repartitionById(partitions, F.col("part")).sortWithinPartitions(*_GROUP, "node")
    found = staged(_verified(met, threshold), folder, "verified")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = found.where("last").select("node", F.col("part").alias("root"))
    split = components(found.where("NOT last").select(F.col("node").alias("a"), F.col("part").alias("b")), folder, "linked")
    roots = small(whole.union(split), BROADCAST_ROWS)
    known = nodes.select("node", "d1", "d2", "m", "rep").join(roots, "node", "left").join(links, "node", "left").select("node", "d1", "d2", "m", "rep", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    known = staged(known, folder, "known")
    drop(spark, *[f"{folder}/{x}" for x in ("nodes", "wanted", "placed", "fetched", "verified")])
    classes = known.groupBy("root").agg(F.min("rep").alias("class_id"))
    known = known.join(classes, "root").select("d1", "d2", "root", "class_id", (F.col("links") + F.col("m") - 1).alias("n_links"))
    some = members.join(known, ["d1", "d2"]).select("doc_id", "class_id", "n_links", "root", "_k1", "_k2")
    none = signed.where("d1 IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("root"), "_k1", "_k2")
    return some.union(none)


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id, then the least row key; all columns stay.

    Documents without words stay as they are, but for rows that repeat id and text.
    """
    keyed = held(docs, *row_key(F.col("doc_id"), F.col("text")))
    rows = jaccard_classes(docs, threshold, shingle)
    none = rows.where("root IS NULL").select("_k1", "_k2")
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_k1", "_k2")).alias("least"))
    kept = least.select("least._k1", "least._k2").union(none)
    first = keyed.join(kept, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return first.select("_row.*")
