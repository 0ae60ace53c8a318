"""Documents whose five-word shingles agree: a Jaccard self-join by chosen paths.

Documents with the same set of shingles form a class and are compared once. A class's MinHash signature turns Jaccard
similarity into the share of equal places. A path is a list of places: every run starts one by sampling a place, and puts
classes with the same token there into a bucket. Two classes of similarity s meet in a run with probability s, and runs are
repeated until the chance to miss a pair is below 1 - ``RECALL``. A bucket that is too large is not compared. Its members go on to
the next level, where paths have one place more, and whole runs are repeated as often as the pair's lower chance to meet, s to the
power of the path's length, demands for the same recall. A run puts a class into one bucket, so no level makes
more than its runs times the classes that still need it. A bucket whose members mostly agree would not get smaller by that;
it is compared block against block, spread over tasks.

Small buckets are compared by brute force, first on signatures, to learn which classes need their shingles at all, then
exactly. A pair belongs to the first run of the first level in which it meets, or, where that bucket was left to the next level, to the first run
there; so each link counts once and no pair leaves its bucket: results are link counts per class and one edge to a bucket's local group.
Groups are the connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.lookup import lookup_join
from kpi_shift.functions.stage import stage
from kpi_shift.llm.buckets import by_bucket, each_bucket
from kpi_shift.llm.text import SPACED, hashed_words, mix, packed, rolling, texts_of, unpacked

WORDS = 5
SIMILARITY = 0.8
PLACES = 64
RECALL = 0.99999
LEAF = 1024
#: Shingles of a leaf: fewer members if their texts are long.
LEAF_SHINGLES = 8 << 20
DEPTH = 4
DENSE = 0.3
_U = np.uint64
_FACTORS = (mix(np.arange(101, 101 + PLACES, dtype=_U)) >> _U(32)).astype(np.uint32)[:, None] | np.uint32(1)


def runs(similarity: float, recall: float = RECALL) -> int:
    """Repetitions after which a pair of this similarity has met with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity)))


def levels(similarity: float, recall: float = RECALL, depth: int = DEPTH) -> list[list[tuple[int, ...]]]:
    """The paths of each level's runs: one place on the first, one more on each that follows. The first two levels share no place."""
    draw = np.random.default_rng(11)
    unused = draw.permutation(PLACES).tolist()
    out = []
    for size in range(1, depth + 1):
        paths = []
        for _ in range(runs(similarity**size, recall)):
            taken = [unused.pop() for _ in range(size)] if len(unused) >= size else draw.choice(PLACES, size, replace=False).tolist()
            paths.append(tuple(taken))
        out.append(paths)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A text of fewer words than a shingle is one shingle; without words, none."""
    words, _, _, counts = hashed_words(data, offsets, SPACED)
    ends = np.cumsum(counts)
    out = []
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        own = words[end - n : end]
        found = rolling(own, WORDS) if n >= WORDS else rolling(own, n) if n else own
        found.sort()
        out.append(found[np.concatenate(([True], found[1:] != found[:-1]))] if n else found)
    return out


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    small = (found >> _U(32)).astype(np.uint32)
    least = np.full(PLACES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(small), 1 << 14):
        np.minimum(least, (small[at : at + (1 << 14)] * _FACTORS).min(axis=1), out=least)
    return least.view(np.int32)


def _set_key(found: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return np.array([found.sum(dtype=_U), mix(found).sum(dtype=_U) ^ _U(len(found))], "<u8").tobytes()


def _describe(with_signature: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, signatures, sizes = [], [], []
            for _, _, data, offsets in texts_of(batch.column(batch.schema.get_field_index("text"))):
                for found in shingle_sets(data, offsets):
                    keys.append(_set_key(found) if len(found) else None)
                    if with_signature:
                        signatures.append(signature(found) if len(found) else np.zeros(0, np.int32))
                        sizes.append(len(found))
            if not with_signature:
                yield batch.append_column("key", pa.array(keys, pa.binary()))
                continue
            cuts = np.concatenate(([0], np.cumsum([len(s) for s in signatures]))).astype(np.int32)
            flat = np.concatenate(signatures) if signatures else np.zeros(0, np.int32)
            places = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))
            told = batch.drop_columns(["text"]).append_column("key", pa.array(keys, pa.binary()))
            yield told.append_column("places", places).append_column("size", pa.array(sizes, pa.int64()))

    return run


def _allowed(places: np.ndarray, rows: pa.Table, plan: list[list[tuple[int, ...]]]) -> np.ndarray:
    """Pairs (row before column) that belong to this bucket: neither compared on an earlier level nor met in an earlier run of this one."""
    n, run = len(places), rows.column("run")[0].as_py()
    pairs = np.triu(np.ones((n, n), bool), 1)
    if rows.column("cross")[0].as_py():
        side = rows.column("side").to_numpy()
        pairs &= side[:, None] != side[None, :]

    def agree(path: tuple[int, ...]) -> np.ndarray:
        out = places[:, path[0]][:, None] == places[:, path[0]][None, :]
        for place in path[1:]:
            out &= places[:, place][:, None] == places[:, place][None, :]
        return out

    first, left = 0, rows.column("left").to_pylist()
    for paths in plan:
        if run < first + len(paths):
            for path in paths[: run - first]:
                pairs &= ~agree(path)
            return pairs
        undecided = pairs.copy()
        for number, path in enumerate(paths, first):
            met = undecided & agree(path)
            compared = np.array([number not in passed for passed in left])
            pairs &= ~(met & compared[:, None])
            undecided &= ~met
        first += len(paths)
    return pairs


def _candidates(similarity: float, plan: list[list[tuple[int, ...]]]):
    """Members of a bucket whose signature is near another's."""
    spread = 5 * math.sqrt(similarity * (1 - similarity) / PLACES)
    least = math.floor((similarity - spread) * PLACES)

    def run(rows: pa.Table) -> pa.Table | None:
        n = rows.num_rows
        places = np.asarray(rows.column("places").combine_chunks().flatten()).reshape(n, PLACES)
        pairs = _allowed(places, rows, plan)
        near = np.zeros(n, bool)
        for at in range(0, n, 64):
            equal = (places[at : at + 64, None, :] == places[None, :, :]).sum(axis=2, dtype=np.int16)
            hit = (equal >= least) & pairs[at : at + 64]
            near[at : at + 64] |= hit.any(axis=1)
            near |= hit.any(axis=0)
        return rows.filter(pa.array(near)).drop_columns(["places"]) if near.any() else None

    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.concatenate(([True], flat[1:] != flat[:-1]))
    token = np.cumsum(first) - 1
    shared = np.bincount(token) > 1
    number = np.cumsum(shared) - 1
    keep = shared[token]
    token, owner = number[token[keep]], owner[keep]
    total = np.zeros((n, n), np.int32)
    for at in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(token, [at, at + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[owner[a:b], token[a:b] - at] = 1
        total += np.rint(part @ part.T).astype(np.int32)
    return total


def _local_groups(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric relation the least row of its component."""
    label = np.arange(len(links))
    while True:
        lowest = np.where(links, label[None, :], len(links)).min(axis=1)
        new = np.minimum(label, lowest)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _exact(similarity: float, plan: list[list[tuple[int, ...]]]):
    share = Fraction(similarity).limit_denominator(10_000)

    def run(rows: pa.Table) -> pa.Table | None:
        sets = [np.frombuffer(b, "<u8") for b in rows.column("shingles").to_pylist()]
        places = np.array([signature(s) for s in sets])
        pairs = _allowed(places, rows, plan)
        common, size = _common(sets), np.array([len(s) for s in sets])
        # |A n B| / (|A| + |B| - |A n B|) >= p / q, in integers
        links = pairs & (common.astype(np.int64) * (share.denominator + share.numerator) >= share.numerator * (size[:, None] + size[None, :]))
        links |= links.T
        linked = np.flatnonzero(links.any(axis=1))
        if not len(linked):
            return None
        copies = rows.column("copies").to_numpy()
        keys = rows.column("key").to_pylist()
        root = _local_groups(links)
        return pa.table(
            {
                "key": pa.array([keys[i] for i in linked], pa.binary()),
                "other": pa.array([keys[root[i]] for i in linked], pa.binary()),
                "n_texts": pa.array(links[linked].sum(axis=1), pa.int64()),
                "n_links": pa.array((links[linked] * copies[None, :]).sum(axis=1), pa.int64()),
            }
        )

    return run


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the texts that have the key they were chosen for; ids may repeat."""
    for batch in batches:
        keys, copies, out = batch.column(1).to_pylist(), batch.column(2).to_pylist(), [[], [], []]
        for first, _, data, offsets in texts_of(batch.column(0)):
            for i, found in enumerate(shingle_sets(data, offsets)):
                if len(found) and _set_key(found) == keys[first + i]:
                    for column, v in zip(out, (keys[first + i], copies[first + i], found.astype("<u8").tobytes()), strict=True):
                        column.append(v)
        types = (pa.binary(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["key", "copies", "shingles"])


def _counted(rows: DataFrame, leaf: int) -> DataFrame:
    """Memberships of buckets with at least two members, with their size ``n`` in members; members of long texts count for more."""
    weight = F.ceil(F.sum("size") * leaf / LEAF_SHINGLES)
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("m"), F.greatest(F.count("*"), weight).alias("n")).where("m > 1").drop("m")
    return lookup_join(rows.drop("size"), sizes, ["bucket"], summarised=True)


def _started(classes: DataFrame, paths: list[tuple[int, ...]], first: int) -> DataFrame:
    """(key, size, bucket, run): each class in one bucket of each run; runs are numbered from ``first``."""
    starts = [
        F.struct(F.xxhash64(F.lit(run), *[F.element_at("places", place + 1) for place in path]).alias("bucket"), F.lit(run).alias("run"))
        for run, path in enumerate(paths, first)
    ]
    return classes.select("key", "size", F.explode(F.array(*starts)).alias("start")).select("key", "size", "start.bucket", "start.run")


def _dense(rows: DataFrame, plan: list[list[tuple[int, ...]]]) -> DataFrame:
    """Large buckets whose members mostly agree: the share of pairs that agree in one more place is high."""
    paths = F.array(*[F.array(*[F.lit(c) for c in path]) for level in plan for path in level])
    others = F.array_except(F.array(*[F.lit(c) for c in range(PLACES)]), F.element_at(paths, F.col("run") + 1))
    place = F.element_at(others, F.pmod(F.xxhash64("bucket", F.lit(-1)), F.size(others)).cast("int") + 1)
    same = rows.groupBy("bucket", F.element_at("places", place + 1).alias("token")).agg(F.count("*").alias("m"))
    share = F.sum(F.col("m") * F.col("m")) / (F.sum("m") * F.sum("m"))
    return same.groupBy("bucket").agg(share.alias("share")).where(F.col("share") >= DENSE).select("bucket")


_MEMBER = ["bucket", "side", "cross", "run", "left", "key", "places"]


def _blocks(rows: DataFrame, leaf: int) -> DataFrame:
    """Members of a dense bucket in the buckets of all pairs of blocks of the size of a leaf."""
    n_blocks = F.ceil(F.col("n") / leaf).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit(9)), F.col("n_blocks")).cast("int")
    out = rows.withColumn("n_blocks", n_blocks).withColumn("own", own)
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    pair = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    cross = F.col("own") != F.col("other")
    return out.withColumns({"side": F.col("own"), "cross": cross, "bucket": pair}).select(*_MEMBER)


def leaves(classes: DataFrame, plan: list[list[tuple[int, ...]]], leaf: int = LEAF) -> DataFrame:
    """Buckets that brute force can handle: (bucket, side, cross, run, left, key, places), two members at least in each.

    ``left`` are the earlier runs in which the class's bucket was left to the next level; ``cross`` says that only members of
    different ``side`` are to be compared.
    """
    done, first = None, 0
    going = classes.select("key", "size", "places", F.array().cast("array<int>").alias("left"))
    for paths in plan:
        met = _counted(_started(going, paths, first), leaf)
        rows = met.join(going.select("key", "places", "left"), "key").withColumns({"side": F.lit(0), "cross": F.lit(False)})
        rows = stage(rows.select(*_MEMBER, "n"), "buckets")
        small = rows.where(F.col("n") <= leaf).select(*_MEMBER)
        done = small if done is None else done.unionByName(small)
        large = rows.where(F.col("n") > leaf)
        first += len(paths)
        if large.isEmpty():
            return done
        if paths is plan[-1]:
            return done.unionByName(_blocks(large, leaf))
        dense = stage(_dense(large, plan), "dense")
        done = done.unionByName(_blocks(large.join(dense, "bucket", "left_semi"), leaf))
        # one row per class; a class has no more large buckets than the level has runs
        passed = large.join(dense, "bucket", "left_anti").groupBy("key").agg(F.first("left").alias("before"), F.collect_list("run").alias("now"))
        still = passed.select("key", F.concat("before", "now").alias("left"))
        going = stage(classes.select("key", "size", "places").join(still, "key"), "going")
    return done


def components(edges: DataFrame) -> DataFrame:
    """The least ``key`` of the component (``root``) of each key of the pairs (key, other)."""
    both = stage(edges.select("key", "other").unionByName(edges.select(F.col("other").alias("key"), F.col("key").alias("other"))).where("key <> other").distinct(), "edges")
    labels = stage(both.groupBy("key").agg(F.least(F.col("key"), F.min("other")).alias("root")), "labels")
    while True:
        around = both.join(labels.select(F.col("key").alias("other"), "root"), "other").groupBy("key").agg(F.min("root").alias("near"))
        nearer = labels.join(around, "key").select("key", "root", F.least("root", "near").alias("new"))
        onward = labels.select(F.col("key").alias("new"), F.col("root").alias("onward"))
        moved = nearer.join(onward, "new").select("key", F.col("root").alias("old"), F.least("new", "onward").alias("root"))
        moved = stage(moved, "labels")
        labels = moved.select("key", "root")
        if moved.where("root <> old").isEmpty():
            return labels


def similar_classes(documents: DataFrame, similarity: float = SIMILARITY, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key), and per key ``copies``, its group's ``root`` and ``class_id`` (least doc_id), ``n_texts`` and ``n_links``."""
    plan = levels(similarity)
    described = documents.select("doc_id", "text").mapInArrow(_describe(True), f"doc_id {_id_type(documents)}, key binary, places array<int>, size bigint")
    described = stage(described, "signatures")
    classes = described.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("places").alias("places"), F.first("size").alias("size")
    )
    classes = stage(classes, "classes")
    near = by_bucket(leaves(classes, plan, leaf))
    near = near.mapInArrow(each_bucket(_candidates(similarity, plan)), "bucket bigint, side int, cross boolean, run int, left array<int>, key binary")
    near = stage(near, "candidates")
    wanted = near.select("key").distinct().join(classes.select("key", "copies", "first_id"), "key")
    texts = documents.select("doc_id", "text").join(wanted, documents.doc_id.eqNullSafe(wanted.first_id)).select("text", "key", "copies")
    sets = stage(texts.mapInArrow(_with_sets, "key binary, copies bigint, shingles binary").dropDuplicates(["key"]), "shingles")
    compared = by_bucket(near.join(sets, "key").select("bucket", "side", "cross", "run", "left", "key", "copies", "shingles"))
    found = compared.mapInArrow(each_bucket(_exact(similarity, plan)), "key binary, other binary, n_texts bigint, n_links bigint")
    found = stage(found, "links")
    counts = found.groupBy("key").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_links").alias("n_links"))
    told = classes.select("key", "first_id", "copies").join(components(found), "key", "left").join(counts, "key", "left")
    told = told.withColumns({"root": F.coalesce("root", "key"), "n_texts": F.coalesce("n_texts", F.lit(0)), "n_links": F.coalesce("n_links", F.lit(0))})
    told = stage(told, "groups")
    least = told.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return described.select("doc_id", "key"), lookup_join(told, least, ["root"], summarised=True).select("key", "root", "copies", "class_id", "n_texts", "n_links")


def _id_type(documents: DataFrame) -> str:
    return documents.schema["doc_id"].dataType.simpleString()


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY, leaf: int = LEAF) -> DataFrame:
    """Per document: ``class_id``, the least doc_id of the group that links connect it to; ``n_links``, other documents of at
    least ``similarity``, copies included; ``n_texts``, other sets of shingles among them.

    Words are what stands between white space, unchanged. A null or empty text, and one of blanks, has no shingles and is
    its own class; so is any text without a link. Repeated rows are copies of each other. An empty table gives an empty
    result; further columns are not read.
    """
    rows, told = similar_classes(documents, similarity, leaf)
    joined = rows.join(told.where("copies > 1 or n_links > 0"), "key", "left")
    return joined.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("n_links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
    )


def keep_one_of_each(documents: DataFrame, similarity: float = SIMILARITY, leaf: int = LEAF) -> DataFrame:
    """The documents, with all columns, without all but the first (least doc_id) of each group; texts without words stay."""
    _, told = similar_classes(documents, similarity, leaf)
    grouped = told.where("copies > 1 or n_links > 0").select("key", "root", "class_id")
    rows = packed(documents)
    keyed = rows.mapInArrow(_describe(False), f"row {rows.schema['row'].dataType.simpleString()}, text string, key binary").select("row", "key")
    joined = keyed.join(grouped, "key", "left")
    single = joined.where("root is null").select("row")
    same = F.col(f"row.c{documents.columns.index('doc_id')}").eqNullSafe(F.col("class_id"))
    first = joined.where(F.col("root").isNotNull() & same).dropDuplicates(["root"]).select("row")
    return single.unionByName(first).select(*unpacked(documents.columns))
