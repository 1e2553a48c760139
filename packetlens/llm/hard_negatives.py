"""Hard negatives: rows of another label that score a little below an anchor's positives.

Candidates are ordered along a Hilbert curve and written as Parquet rows of ``BLOCK`` vectors
each, with the least and greatest value of every dimension (a zone map). By interval arithmetic
these bound the score of an anchor with any row of a block, so an anchor reads only blocks that
can hold one of its positives, and then only blocks that can reach into one of its windows.

Anchors travel in groups of up to ``GROUP``. Zone maps lie in pages; each group meets each page
once, and sends the anchors that need a block to it. A block's task keeps the best rows of each
anchor over all blocks it sees, so few rows reach the last ranking. Nothing is broadcast.

* Components become floor(``SCALE`` * x). A row's score is its integer inner product with the
  anchor; higher scores come first, ties by smaller vec_id. Shorter vectors count as padded by
  zeros. Scores are exact as long as they fit into 63 bits.
* Rows with a null vec_id, label or vector, or a null or non-finite component, take no part.
* An anchor's positives are its first ``POSITIVES`` other rows of its label. Its negatives for a
  positive are the first ``NEGATIVES`` rows of other labels whose score is at least ``LOW`` and
  at most ``HIGH`` hundredths of the positive's score.
* Other rows are rows of another vec_id. Equal rows count once; rows that share a vec_id but
  differ stand each for itself. Extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetlens.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
# Rows of a block, anchors of a group, zone maps of a page.
BLOCK, GROUP, PAGE = 1024, 128, 1024
# Bits of a dimension on the curve.
BITS = 3
# Best rows that a task keeps before it hands them on.
HELD = 400_000
EXACT = float(1 << 53)
NONE = -(1 << 62)


def hilbert_keys(grid: np.ndarray, bits: int) -> list[bytes]:
    """The places of grid points (rows, dimensions; each below 2^bits) along a Hilbert curve,
    as bytes in curve order."""
    x = grid.astype("u4").T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(n):
            # A set bit mirrors the lower bits of the first axis; a clear one swaps them.
            bit = (x[i] & np.uint32(q)) != 0
            swap = np.where(bit, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(bit, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], "u4")
    q = top
    while q > 1:
        flip ^= np.where(x[n - 1] & np.uint32(q), np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= flip
    planes = [(x[i] >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1) for i in range(n)]
    packed = np.packbits(np.array(planes, "u1").T, axis=1)
    return [r.tobytes() for r in packed]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner products of all rows of ``a`` with all of ``b``."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype("f8") @ b.astype("f8").T).astype("i8")
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score that each row of ``a`` can have with rows in each box, as
    floating point, widened by more than its error."""
    plus, minus = np.maximum(a, 0).astype("f8"), np.minimum(a, 0).astype("f8")
    low, high = low.astype("f8"), high.astype("f8")
    least, most = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    size = (plus - minus) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = size * 1e-12
    return least - slack, most + slack


def first_of(slot: np.ndarray, score: np.ndarray, rest: tuple, ids: np.ndarray, k: int):
    """Of each slot the k rows with the highest scores, ties by smaller id; ``rest`` are more
    columns."""
    order = np.lexsort((ids, -score, slot))
    ordered = slot[order]
    head = np.flatnonzero(np.diff(ordered, prepend=-1))
    place = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
    order = order[place < k]
    return slot[order], score[order], tuple(r[order] for r in rest), ids[order]


def _vector(column: str, dims: int) -> Column:
    """The scaled components, padded to ``dims``."""
    scaled = F.transform(column, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return F.concat(scaled, F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size(column)))


def _valid(rows: DataFrame, anchor: Column) -> DataFrame:
    # NaN is the greatest value, so no comparison with infinity holds for it.
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding",
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), "i8").reshape(-1, dims)


def _matrix_of(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(-1, dims)


def blocks_of(rows: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """Candidate blocks in Hilbert order: ids, labels and vectors, their zone map, and for their
    anchors the least score that one of the first positives can have."""
    # One row: the range of every dimension.
    edges = rows.select(F.posexplode("v")).groupBy("pos").agg(F.min("col").alias("a"), F.max("col").alias("b"))
    edge = {r["pos"]: (r["a"], r["b"]) for r in edges.collect()}
    low = np.array([edge[i][0] for i in range(dims)], "i8")
    span = np.array([edge[i][1] for i in range(dims)], "f8") - low
    # Wide dimensions come first, where the curve separates best.
    axes = np.argsort(-span, kind="stable")
    names = ["vec_id", "label", "v", "anchor"]

    def keyed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = (_matrix(batch["v"], dims) - low) / np.maximum(span, 1)
            grid = np.minimum((x * (1 << BITS)).astype("i8"), (1 << BITS) - 1)[:, axes]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(hilbert_keys(grid, BITS), pa.binary())], [*names, "place"])

    kinds = "vec_id bigint, label bigint, v array<bigint>, anchor boolean"
    placed = rows.select(*names).mapInArrow(keyed, f"{kinds}, place binary")
    # An id beside the place: copies of one vector spread over tasks as well.
    ordered = placed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id", "label", "v")

    def built(batches: Iterator[pa.RecordBatch]):
        number, held, last = TaskContext.get().partitionId() << 32, [], None

        def block_row(part):
            nonlocal number
            ids, labels, anchor = (np.asarray(part[c].to_numpy(zero_copy_only=False)) for c in ("vec_id", "label", "anchor"))
            v = _matrix(part["v"], dims)
            number += 1
            at = np.flatnonzero(anchor)
            scores = products(v, v[at])
            fits = (labels[:, None] == labels[at]) & (ids[:, None] != ids[at])
            k = len(ids) - POSITIVES
            own = np.where(fits, scores, NONE)
            floor = np.partition(own, k, axis=0)[k] if k >= 0 and len(at) else np.full(len(at), NONE)
            return (number, ids.tobytes(), labels.tobytes(), v.tobytes(), v.min(0).tobytes(), v.max(0).tobytes(),
                    np.unique(labels).tobytes(), ids[at].tobytes(), labels[at].tobytes(), v[at].tobytes(),
                    floor.astype("i8").tobytes())

        def batch_of(row):
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]]), *(pa.array([x], pa.binary()) for x in row[1:])], BLOCK_NAMES)

        for batch in batches:
            if not batch.num_rows:
                continue
            # Equal rows are neighbours.
            v, place = _matrix(batch["v"], dims), batch["place"]
            ids, labels = (batch[c].to_numpy() for c in ("vec_id", "label"))
            same = np.zeros(len(ids), bool)
            same[1:] = (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1]) & (v[1:] == v[:-1]).all(1)
            same[0] = last is not None and last[:2] == (ids[0], labels[0]) and (last[2] == v[0]).all()
            last = (ids[-1], labels[-1], v[-1])
            held.append(batch.filter(pa.array(~same)))
            while sum(b.num_rows for b in held) >= block:
                whole = pa.concat_batches(held)
                yield batch_of(block_row(whole.slice(0, block)))
                held = [whole.slice(block)]
        if sum(b.num_rows for b in held):
            yield batch_of(block_row(pa.concat_batches(held)))

    return ordered.mapInArrow(built, "block bigint, " + ", ".join(f"{n} binary" for n in BLOCK_NAMES[1:]))


BLOCK_NAMES = ["block", "ids", "labels", "vectors", "low", "high", "has", "a_ids", "a_labels", "a_vectors", "a_floor"]


def anchors_of(blocks: DataFrame, group: int = GROUP) -> DataFrame:
    """Groups of anchors, neighbours on the curve: ids, labels, vectors and floors."""
    names = ["a_ids", "a_labels", "a_vectors", "a_floor"]

    def grouped(batches: Iterator[pa.RecordBatch]):
        number, held, n = TaskContext.get().partitionId() << 32, [b""] * 4, 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in names), strict=True):
                held = [x + y for x, y in zip(held, row, strict=True)]
                n += len(row[0]) // 8
                while n >= group:
                    number += 1
                    width = [len(x) // n * group for x in held]
                    yield _one(["grp", *names], number, [x[:w] for x, w in zip(held, width, strict=True)])
                    held, n = [x[w:] for x, w in zip(held, width, strict=True)], n - group
        if n:
            yield _one(["grp", *names], number + 1, held)

    return blocks.select(*names).mapInArrow(grouped, "grp bigint, " + ", ".join(f"{c} binary" for c in names))


def _one(names: list[str], number: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([d], pa.binary()) for d in data)], names)


def _needs(groups: DataFrame, blocks: DataFrame, pages: int, dims: int, wanted) -> DataFrame:
    """(block, grp, members): the anchors of a group that must read a block. ``wanted`` gets the
    group's row, the score bounds (anchor, block) and each block's labels."""
    page = F.pmod(F.xxhash64("block"), F.lit(pages))
    zones = blocks.select("block", "low", "high", "has").groupBy(page.alias("page")).agg(
        F.collect_list(F.struct("block", "low", "high", "has")).alias("zones"))
    met = groups.withColumn("page", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(pages - 1).cast("bigint"))))

    def choose(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                zones = row["zones"]
                low, high = (_matrix_of(b"".join(z[c] for z in zones), dims) for c in ("low", "high"))
                least, most = bounds(_matrix_of(row["a_vectors"], dims), low, high)
                need = wanted(row, least, most, [np.frombuffer(z["has"], "<i8") for z in zones])
                out = [(z["block"], row["grp"], np.flatnonzero(n).astype("<i4").tobytes())
                       for z, n in zip(zones, need.T, strict=True) if n.any()]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                        ["block", "grp", "members"])

    return met.join(zones, "page").mapInArrow(choose, "block bigint, grp bigint, members binary")


def _best(needs: DataFrame, blocks: DataFrame, groups: DataFrame, dims: int, k: int, found) -> DataFrame:
    """The best k rows of every slot over the blocks that its anchor reads: (grp, slot, score,
    id). ``found`` gives slot, score and id of the rows of one block for the members of a group."""
    joined = needs.join(blocks.select("block", "ids", "labels", "vectors"), "block").join(groups, "grp")

    def search(batches: Iterator[pa.RecordBatch]):
        held, size = {}, 0

        def given():
            for grp, parts in held.items():
                slot, score, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
                slot, score, _, ids = first_of(slot, score, (), ids, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), grp)), *(pa.array(x.astype("i8")) for x in (slot, score, ids))],
                    ["grp", "slot", "score", "id"])

        for batch in batches:
            for row in batch.to_pylist():
                members = np.frombuffer(row["members"], "<i4")
                ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
                scores = products(_matrix_of(row["vectors"], dims), _matrix_of(row["a_vectors"], dims)[members])
                slot, score, _, own = first_of(*found(row, members, ids, labels, scores), k)
                held.setdefault(row["grp"], []).append((slot, score, own))
                size += len(slot)
                if size > HELD:
                    for grp, parts in held.items():
                        slot, score, own = (np.concatenate(x) for x in zip(*parts, strict=True))
                        slot, score, _, own = first_of(slot, score, (), own, k)
                        held[grp] = [(slot, score, own)]
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > HELD // 2:
                        yield from given()
                        held, size = {}, 0
        yield from given()

    rows = joined.mapInArrow(search, "grp bigint, slot bigint, score bigint, id bigint")
    order = Window.partitionBy("grp", "slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _entries(mask: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where ``mask`` holds, the rows of each column that can be among its k highest scores."""
    if len(mask) > k:
        held = np.where(mask, scores, NONE)
        mask = mask & (scores >= np.partition(held, len(mask) - k, axis=0)[len(mask) - k])
    return np.nonzero(mask)


def mine(rows: DataFrame, anchor: Column, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score. ``rows``
    has vec_id, embedding and label; ``anchor`` tells which of them are anchors."""
    valid = _valid(rows, anchor)
    dims = valid.agg(F.max(F.size("embedding"))).first()[0] or 0
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    if not dims:
        kinds = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], kinds)
    ready = valid.select("vec_id", "label", "anchor", _vector("embedding", dims).alias("v"))
    blocks = stored(blocks_of(ready, dims, block), "candidate-blocks")
    groups = stored(anchors_of(blocks, group), "anchor-groups")
    pages = blocks.count() // PAGE + 1

    def may_hold_positive(row, least, most, has):
        labels, floor = (np.frombuffer(row[c], "<i8") for c in ("a_labels", "a_floor"))
        held = np.array([np.isin(labels, h) for h in has]).T
        return held & (most >= floor[:, None])

    def positives_in(row, members, ids, labels, scores):
        own, own_labels, floor = (np.frombuffer(row[c], "<i8")[members] for c in ("a_ids", "a_labels", "a_floor"))
        mask = (labels[:, None] == own_labels) & (ids[:, None] != own) & (scores >= floor)
        at, column = _entries(mask, scores, POSITIVES)
        return members[column].astype("i8"), scores[at, column], (), ids[at]

    needs = _needs(groups, blocks, pages, dims, may_hold_positive)
    positives = _best(needs, blocks, groups, dims, POSITIVES, positives_in)
    # Rows of a group: at most its anchors times their positives.
    kept = positives.groupBy("grp").agg(F.collect_list(F.struct("slot", "rank", "id", "score")).alias("positives"))
    windows = stored(groups.join(kept, "grp"), "anchor-windows")

    def limits(row):
        """The scores that bound each window, by anchor and positive; none where low > high."""
        n = len(row["a_ids"]) // 8
        low, high = np.full((n, POSITIVES), 1 << 62), np.full((n, POSITIVES), -(1 << 62))
        for p in row["positives"]:
            at = p["slot"], p["rank"] - 1
            low[at], high[at] = -(-LOW * p["score"] // 100), HIGH * p["score"] // 100
        return low, high

    def may_hold_negative(row, least, most, has):
        labels = np.frombuffer(row["a_labels"], "<i8")
        low, high = limits(row)
        other = np.array([[len(h) > 1 or h[0] != own for h in has] for own in labels])
        meets = [(most >= low[:, [i]]) & (least <= high[:, [i]]) & (low <= high)[:, [i]] for i in range(POSITIVES)]
        return other & np.any(meets, axis=0)

    def negatives_in(row, members, ids, labels, scores):
        own_labels = np.frombuffer(row["a_labels"], "<i8")[members]
        low, high = (x[members] for x in limits(row))
        other, out = labels[:, None] != own_labels, []
        for i in range(POSITIVES):
            at, column = _entries(other & (scores >= low[:, i]) & (scores <= high[:, i]), scores, NEGATIVES)
            out.append((members[column].astype("i8") * POSITIVES + i, scores[at, column], ids[at]))
        slot, score, own = (np.concatenate(x) for x in zip(*out, strict=True))
        return slot, score, (), own

    needs = _needs(windows, blocks, pages, dims, may_hold_negative)
    negatives = _best(needs, blocks, windows, dims, NEGATIVES, negatives_in).withColumnRenamed("id", "negative_id")

    def with_ids(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["a_ids"], "<i8")
                at = [(row["grp"], p["slot"] * POSITIVES + p["rank"] - 1, int(own[p["slot"]]), p["id"], p["score"])
                      for p in row["positives"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*at, strict=True)],
                    ["grp", "slot", "anchor_id", "positive_id", "positive_score"])

    named = windows.select("grp", "a_ids", "positives").mapInArrow(
        with_ids, "grp bigint, slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    result = negatives.join(named, ["grp", "slot"]).withColumnRenamed("score", "negative_score")
    return result.select(*names[:2], F.col("rank").cast("int").alias("rank"), *names[2:])
