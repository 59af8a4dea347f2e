"""N-gram Jaccard join by vertical partitioning.

Equal sets are one class, known by a 64-bit fingerprint of the set; classes are what is joined. The global order of
shingles (by class count, then hash) is cut into fragments by hash. Each fragment counts on its own, in one task, how
many classes hold each of its shingles, and hands back to every class the part of its set that occurs elsewhere too.
Shingles that very many sets hold are found beforehand from the counts of each task; they are in every fragment's place
in the order by those counts, and their holders are dealt out by class rather than met in one task.
Summed over fragments, that bounds what any partner can share: only classes above the threshold go on. Candidate pairs
come from the rare end of the order, their overlaps are again counted fragment by fragment and summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_PARTITIONS, SLICE_BYTES, dropped, hashed_words, mix, text_slices, window_hashes, written
from .components import smallest_reachable

# Shingles that a fragment's task holds on average.
FRAGMENT_ROWS = 1_500_000
# Fragments of the second counting, of candidate pairs.
PAIR_FRAGMENTS = 4
# Shingles that this many sets hold are not counted in one task; a task reports those that its sets hold OFTEN times, and
# at most HOT_MOST of them are sent to the tasks.
HOT_ROWS, OFTEN, HOT_MOST = FRAGMENT_ROWS // 8, 16, 1_000_000
# Parts in which the members of one component are looked up.
SALTS = 16


def shingle_sets(column: pa.Array, width: int, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each text); fewer words than `width`: the whole sequence."""
    for first, data, at in text_slices(column, slice_bytes):
        words, owner = hashed_words(data, at)
        bounds = np.searchsorted(owner, np.arange(len(at)))
        windows = window_hashes(words, width)
        sets = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo >= width:
                sets.append(np.unique(windows[lo : hi - width + 1]))
            elif hi > lo:
                sets.append(mix(window_hashes(words[lo:hi], hi - lo) + np.uint64(hi - lo)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, sets


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """The class of each set: a hash of its size and of its members in any order."""
    one = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
    two = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
    return mix(mix(one + np.array([len(s) for s in sets], np.uint64)) ^ two)


def set_sizes(docs: DataFrame, width: int) -> DataFrame:
    """rid, n (set size) and key (its class) of every row.

    Besides, rows with `held`: key is a shingle that sets of a task hold again and again, and held counts them.
    """

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rid", "n", "key", "held"]
        again: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), width):
                n, keys = np.array([len(s) for s in sets], np.int64), fingerprints(sets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), pa.array(n), pa.array(keys.view(np.int64)), pa.nulls(len(sets), pa.int64())], names=names)
                _, once = np.unique(keys, return_index=True)
                shingle, held = np.unique(np.concatenate([sets[k] for k in once.tolist()]), return_counts=True)
                again.append((shingle[held > 1], held[held > 1]))
        if again:
            shingle, which = np.unique(np.concatenate([s for s, _ in again]), return_inverse=True)
            held = np.bincount(which, weights=np.concatenate([h for _, h in again]), minlength=len(shingle)).astype(np.int64)
            often = held >= OFTEN
            n = int(often.sum())
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(shingle[often].view(np.int64)), pa.array(held[often])], names=names)

    return docs.mapInArrow(per_partition, "rid long, n long, key long, held long")


def hot_shingles(sizes: DataFrame, hot_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that about hot_rows sets or more hold, in order, and the counts known of them; the bound rises until HOT_MOST is kept."""
    found = sizes.where("held IS NOT NULL").groupBy("key").agg(F.sum("held").alias("held"))
    while found.where(F.col("held") >= hot_rows).limit(HOT_MOST + 1).count() > HOT_MOST:
        hot_rows *= 4
    rows = found.where(F.col("held") >= hot_rows).collect()
    shingle, held = np.array([r["key"] for r in rows], np.int64).view(np.uint64), np.array([r["held"] for r in rows], np.uint32)
    order = np.argsort(shingle)
    return shingle[order], held[order]


def run_starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal items of a non-empty array begin, and its length at the end."""
    return np.append(np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))), len(x))


def class_sets(docs: DataFrame, width: int, percent: int, fragments: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """rid (a class), n, hashes and counts (bytes): shingles found in other classes too, of classes that could reach the threshold.

    Pieces travel as arrays, one row for each slice of texts and fragment, then for each fragment and bucket of classes.
    Hot shingles go to the bucket of their holder at once, with the counts that are known of them (fragment -1 - bucket).
    """
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def place_of(hashes: np.ndarray, owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
        fragment = ((hashes >> np.uint64(32)) % np.uint64(fragments)).astype(np.int64)
        table = sent.value[0]
        if len(table):
            is_hot = table[np.minimum(np.searchsorted(table, hashes), len(table) - 1)] == hashes
            fragment[is_hot] = -1 - (keys[owner[is_hot]] % np.uint64(fragments)).astype(np.int64)
        return fragment

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0), width, 2 * SLICE_BYTES):
                keys, once = np.unique(fingerprints(sets), return_index=True)
                sets = [sets[k] for k in once.tolist()]
                whole = np.array([len(s) for s in sets], np.uint32)
                hashes = np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets), dtype=np.uint16 if len(sets) < 65536 else np.uint32), whole)
                fragment = place_of(hashes, owner, keys)
                order = np.argsort(fragment, kind="stable")
                if not len(order):
                    continue
                bounds = run_starts(fragment[order])
                rows = fragment[order][bounds[:-1]]
                take = [order[lo:hi] for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                held = [np.unique(owner[t], return_counts=True) for t in take]
                columns = [[keys[u].tobytes() for u, _ in held], [whole[u].tobytes() for u, _ in held], [c.astype(np.uint32).tobytes() for _, c in held], [hashes[t].tobytes() for t in take]]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["fragment", "owners", "wholes", "sizes", "hashes"])

    def joined(group: pd.DataFrame) -> tuple[np.ndarray, ...]:
        kinds = {"owners": np.uint64, "wholes": np.uint32, "sizes": np.uint32, "hashes": np.uint64}
        return tuple(np.concatenate([np.frombuffer(x, kind) for x in group[name]]) for name, kind in kinds.items())

    def count(group: pd.DataFrame) -> pd.DataFrame:
        owners, wholes, sizes, hashes = joined(group)
        fragment = int(group["fragment"].iloc[0])
        del group
        # All copies of a set are here with the same shingles: one of them counts.
        _, once = np.unique(owners, return_index=True)
        first = np.zeros(len(owners), bool)
        first[once] = True
        hashes = hashes[np.repeat(first, sizes)]
        owners, wholes, sizes = owners[first], wholes[first], sizes[first]
        if fragment < 0:
            table, known = sent.value
            found = known[np.searchsorted(table, hashes)]
        else:
            order = np.argsort(hashes)
            begin = run_starts(hashes[order])
            n = np.diff(begin)
            found = np.empty(len(hashes), np.uint32)
            found[order] = np.repeat(n, n)
            del order
        common = found > 1
        owner = np.repeat(np.arange(len(owners), dtype=np.uint32), sizes)[common]
        if not len(owner):
            return pd.DataFrame({"bucket": [], "owners": [], "wholes": [], "sizes": [], "hashes": [], "counts": []}).astype({"bucket": "int32"})
        bucket = (owners % np.uint64(fragments)).astype(np.int32)
        order = np.argsort(bucket[owner], kind="stable")
        owner, hashes, found = owner[order], hashes[common][order], found[common][order]
        edge = run_starts(owner)
        who, held = owner[edge[:-1]], np.diff(edge).astype(np.uint32)
        part = run_starts(bucket[who])
        spans = list(zip(part[:-1].tolist(), part[1:].tolist(), strict=True))
        return pd.DataFrame({
            "bucket": bucket[who[part[:-1]]],
            "owners": [owners[who[a:b]].tobytes() for a, b in spans], "wholes": [wholes[who[a:b]].tobytes() for a, b in spans], "sizes": [held[a:b].tobytes() for a, b in spans],
            "hashes": [hashes[edge[a] : edge[b]].tobytes() for a, b in spans], "counts": [found[edge[a] : edge[b]].tobytes() for a, b in spans],
        })

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        owners, wholes, sizes, hashes = joined(group)
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"]])
        del group
        keys, where, which = np.unique(owners, return_index=True, return_inverse=True)
        mine = np.repeat(which, sizes)
        # A partner must share percent of the set, so a set with fewer shingles that occur elsewhere has none.
        n = wholes[where].astype(np.int64)
        able = 100 * np.bincount(mine, minlength=len(keys)) >= percent * n
        order = np.argsort(mine, kind="stable")
        bounds = np.searchsorted(mine[order], np.arange(len(keys) + 1))
        take = [order[bounds[k] : bounds[k + 1]] for k in np.flatnonzero(able).tolist()]
        return pd.DataFrame({"rid": keys[able].view(np.int64), "n": n[able], "hashes": [hashes[t].tobytes() for t in take], "counts": [counts[t].tobytes() for t in take]})

    pieces = docs.select("text").mapInArrow(cut, "fragment int, owners binary, wholes binary, sizes binary, hashes binary")
    # As many partitions as fragments, up to what a driver can schedule; beyond, a partition takes several fragments one after the other.
    partitions = min(fragments, MOST_PARTITIONS)
    shared = pieces.repartition(partitions, "fragment").groupBy("fragment").applyInPandas(count, "bucket int, owners binary, wholes binary, sizes binary, hashes binary, counts binary")
    return shared.repartition(partitions, "bucket").groupBy("bucket").applyInPandas(gather, "rid long, n long, hashes binary, counts binary")


def exploded(reps: DataFrame, percent: int) -> DataFrame:
    """token, rid, n, place, weight: the shared shingles in the prefix of each set, rarest first.

    Shingles found in one row only come first in the order; they use up the prefix but match nothing. weight is the
    mean logarithm of the counts of the set's shingles: high for the texts that others were copied from.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for rid, n, raw, cnt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes, where = np.unique(np.frombuffer(raw, np.uint64), return_index=True)
                counts = np.frombuffer(cnt, np.uint32)[where]
                alone = n - len(hashes)
                length = n - (percent * n + 99) // 100 + 1 - alone
                if length <= 0:
                    continue
                head = np.lexsort((hashes, counts))[:length]
                out[0].append(hashes[head].view(np.int64))
                out[1].append(np.full(len(head), rid))
                out[2].append(np.full(len(head), n))
                out[3].append(alone + np.arange(len(head)))
                out[4].append(np.full(len(head), int(1e6 * np.log(counts).sum() / n)))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["token", "rid", "n", "place", "weight"])

    return reps.select("rid", "n", "hashes", "counts").mapInArrow(per_batch, "token long, rid long, n long, place long, weight long")


def overlaps(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted in each fragment apart and summed per pair."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for rid, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.unique(np.frombuffer(raw, np.uint64))
                part = (hashes >> np.uint64(20)) % np.uint64(PAIR_FRAGMENTS)
                for k in range(PAIR_FRAGMENTS):
                    out[0].append(rid)
                    out[1].append(n)
                    out[2].append(k)
                    out[3].append(hashes[part == k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["rid", "n", "k", "seg"])

    cut = reps.select("rid", "n", "hashes").mapInArrow(segments, "rid long, n long, k int, seg binary")
    left = cut.select(F.col("rid").alias("a"), F.col("n").alias("na"), "k", F.col("seg").alias("sa"))
    right = cut.select(F.col("rid").alias("b"), F.col("n").alias("nb"), "k", F.col("seg").alias("sb"))
    met = pairs.select("a", "b").join(left, "a").join(right, ["b", "k"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(same, pa.int64())], names=["a", "b", "na", "nb", "same"])

    counted = met.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(partial, "a long, b long, na long, nb long, same long")
    summed = counted.groupBy("a", "b", "na", "nb").agg(F.sum("same").alias("same"))
    return summed.where(f"100 * same >= {percent} * (na + nb - same)").select("a", "b")


def hub_pairs(postings: DataFrame, percent: int, roots: DataFrame | None = None) -> DataFrame:
    """Each posting list's members with one hub of their size class: at most as many pairs as members.

    First the hub is the text that most looks like an original. Once roots (components so far) are given, each list
    draws its hub by a hash, so that a member of many lists meets many hubs, and members of the hub's component rest.
    """
    # Sets within one class of sizes may link; the classes are geometric with the threshold as their step.
    sized = postings.withColumn("size_class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))))
    rank = F.col("weight") if roots is None else F.xxhash64("token", "rid")
    if roots is not None:
        sized = sized.join(roots.select(F.col("node").alias("rid"), "root"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    else:
        sized = sized.withColumn("root", F.col("rid"))
    hubs = sized.groupBy("token", "size_class").agg(F.max(F.struct(rank.alias("rank"), "rid", "n", "root")).alias("hub"))
    near = f"100 * least(n, hub.n) >= {percent} * greatest(n, hub.n)"
    met = sized.join(hubs, ["token", "size_class"]).where(f"root <> hub.root AND {near}")
    return met.select(F.least("rid", "hub.rid").alias("a"), F.greatest("rid", "hub.rid").alias("b")).distinct()


def cross_pairs(postings: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs of a posting list whose members are not yet in one component, by size and place filters."""
    labelled = postings.join(roots.select(F.col("node").alias("rid"), "root"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    mixed = labelled.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("token")
    left = labelled.join(mixed, "token")
    right = left.select("token", F.col("rid").alias("rid2"), F.col("n").alias("n2"), F.col("place").alias("place2"), F.col("root").alias("root2"))
    # A pair that links has a first shared shingle; from there on, both sets must hold what the overlap needs.
    bound = "least(n - place, n2 - place2)"
    near = left.join(right, "token").where(f"root <> root2 AND (n < n2 OR (n = n2 AND rid < rid2)) AND 100 * n >= {percent} * n2")
    near = near.where(f"(100 + {percent}) * ({bound}) >= {percent} * (n + n2)")
    return near.select(F.least("rid", "rid2").alias("a"), F.greatest("rid", "rid2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", links: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """id, n_shingles, component_id and (where `links`) n_links of every row.

    component_id is the smallest id reachable by links (Jaccard of shingle sets of percent/100 or more), the row's
    own included. Texts without words link with nothing; a null id gets a null component. Rows that repeat an id are
    one node, of which every row is returned. Texts are taken whole, however long; an empty table gives no rows. hot_rows
    (how many sets make a shingle hot) changes how work is dealt, not the result. n_links counts verified links of the row's set to other sets; sets
    equal to each other are one, and links within a known component are not all looked for. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("text"))
    found = written(set_sizes(source, width), "set-sizes")
    sizes = found.where("held IS NULL").drop("held")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    fragments = int(max(1, -(-total // FRAGMENT_ROWS)))
    reps = written(class_sets(source.where("rid IS NOT NULL"), width, percent, fragments, hot_shingles(found, hot_rows)), "class-sets")
    postings = written(exploded(reps, percent), "postings")
    found_links = [written(overlaps(hub_pairs(postings, percent), reps, percent), "hub-links")]
    roots = smallest_reachable(found_links[0])
    for meet in (lambda r: hub_pairs(postings, percent, r), lambda r: cross_pairs(postings, r, percent)):
        more = written(overlaps(meet(roots), reps, percent), "more-links")
        if more.limit(1).count():
            last, roots = roots, smallest_reachable(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
            dropped(last)
            found_links.append(more)
        else:
            dropped(more)
    dropped(reps, postings)
    every = found_links[0]
    for more in found_links[1:]:
        every = every.unionByName(more)
    if not links:
        dropped(*found_links)
    # Rows of one id are one node: where their sets differ, the classes are one component.
    held = sizes.where("rid IS NOT NULL AND n > 0")
    torn = held.groupBy("rid").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("rid", "a")
    tied = written(held.select("rid", F.col("key").alias("b")).join(torn, "rid").where("a <> b").select("a", "b").distinct(), "tied-classes")
    if tied.limit(1).count():
        last, roots = roots, smallest_reachable(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(tied))
        dropped(last)
    dropped(tied)
    classes = held.groupBy("key").agg(F.min("rid").alias("rep")).join(roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    # One component may have very many classes: each looks up its lowest id in one of several places.
    lowest = classes.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("n")).where("n > 1")
    lowest = lowest.select("root", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = classes.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    labelled = salted.join(lowest, ["root", "salt"], "left").select("key", F.coalesce("component_id", "rep").alias("component_id"))
    # Few classes hold very many rows: a class is one row here, and AQE splits the other side.
    out = sizes.join(labelled, "key", "left")
    component = F.when(F.col("rid").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("rid")))
    columns = [F.col("rid").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")]
    if links:
        degree = every.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links"))
        out = out.join(degree, "key", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return out.select(*columns)


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is their component's smallest, columns as they were; rows with a null id stay."""
    found = near_duplicates(docs, width, percent, id_col, text_col, links=False)
    gone = found.where(f"component_id <> {id_col}").select(F.col(id_col).alias("gone_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
