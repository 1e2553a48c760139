"""Similarity join on word n-grams: a MinHash LSH forest, then exact Jaccard.

Texts are sets of five-word runs. Equal texts form one node, known by their digest. A node's
signature gives each of ``TREES`` prefix tries a label of ``LONGEST`` minima. Sorted labels are
the trie: nodes that share a prefix stand together as a run.

The forest is walked from its longest prefixes to shorter ones (``depths``). At each depth a
text meets the others of its runs in every trie. It goes on to shorter prefixes until its
target recall is reached: until a partner as dissimilar as the least similar one it has met
would have been met with probability ``RECALL`` by now. A text that has met nobody goes on to
the depth at which that holds for two texts at the threshold; so does a run as long as one of
its texts goes on. Texts in groups of close copies stop at long prefixes, where runs hold copies.

Nodes that meet are gathered in candidate groups: along a run, leaders stand for the texts like
them, and a text joins every leader whose estimated similarity leaves a link to one of the
leader's texts possible. A run of more than ``HOT`` nodes is dealt over tasks, whose leaders then
meet. Groups are closed over trees and cut into blocks; every pair of blocks of a group is
verified on the exact sets, so no pair is emitted as a row, and a link between texts of one
group is never missed.

* A text that is null or has no word is alone and has no link. A text of fewer than five
  words is one run of all its words.
* Words are runs of characters other than space and \\t to \\r, as they stand.
* Repeated rows and equal texts share a class. ``class_id`` is the least doc_id of the class
  (null only if all are null); ``n_links`` counts the different texts that are linked.
* Extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packetlens.llm.common import fresh, map_texts, slices, stored
from packetlens.llm.components import components
from packetlens.llm.words import mixed, shingles, word_hashes

WORDS = 5
THRESHOLD = 0.8
TREES = 16
LONGEST = 7
RECALL = 0.999
# Nodes of a run that one task goes through.
HOT = 20_000
# Signature bytes from which similarity is estimated, and its allowance of error.
ESTIMATE = 100
ALLOWANCE = 0.2
# Texts and set elements of one block, on average in a group of several.
BLOCK_TEXTS = 256
BLOCK_ELEMENTS = 500_000
# Elements of a dense matrix that a block pair works on at a time.
DENSE = 4_000_000
BLOOM_BITS = 1 << 24


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST,
                  recall: float = RECALL) -> int:
    """Shorten the prefix until a pair at the threshold is found with probability ``recall``."""
    length = longest
    while length > 1 and met(threshold, length, trees) < recall:
        length -= 1
    return length


def met(similarity: float, length: int, trees: int = TREES) -> float:
    """The probability that two texts share a prefix of so many minima in some trie."""
    return 1 - (1 - similarity ** length) ** trees


def depths() -> list[int]:
    """Prefix lengths in the order they are walked."""
    last = prefix_length()
    return [*range(LONGEST, last, -2), last]


def signer(n: int = TREES * LONGEST):
    """A function from texts to their set sizes (with repeats) and signatures."""
    multipliers = np.random.default_rng(20_11).integers(1, 1 << 63, n, dtype="u8") | np.uint64(1)

    def sign(texts: list[str | None]) -> tuple[np.ndarray, list[bytes | None]]:
        h, text = shingles(*word_hashes([t or "" for t in texts]), WORDS)
        sizes = np.bincount(text, minlength=len(texts))
        filled = np.flatnonzero(sizes)
        first = (np.cumsum(sizes) - sizes)[filled]
        out = np.zeros((len(filled), n), "<u4")
        # Texts are signed in runs whose hashes stay in the processor's cache.
        start = 0
        while start < len(filled):
            stop = max(start + 1, int(np.searchsorted(first, first[start] + (1 << 16))))
            begin = first[start]
            end = first[stop] if stop < len(filled) else len(h)
            own, at = h[begin:end], first[start:stop] - begin
            for k in range(n):
                out[start:stop, k] = np.minimum.reduceat((own * multipliers[k]) >> np.uint64(32), at)
            start = stop
        signatures: list[bytes | None] = [None] * len(texts)
        for row, t in enumerate(filled.tolist()):
            signatures[t] = out[row].tobytes()
        return sizes, signatures

    return sign


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, node (digest of the text, null without words) and its signature."""

    def make():
        sign = signer()
        return lambda texts: {"signature": sign(texts)[1]}

    rows = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("digest"))
    signed = map_texts(rows, "text", make, "signature binary", ["doc_id", "digest"])
    node = F.when(F.col("signature").isNotNull(), F.col("digest"))
    return signed.select("doc_id", node.alias("node"), "signature")


def _group_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect each run as far as its texts are alike: (a, b, like, least), ``like``
    the estimated similarity of both and ``least`` that of the least similar partner which ``a``
    has met. Rows come sorted by run; a run may span batches, and only its leaders are held.
    ``same`` tells which leaders are connected already, so a text adds one edge and joins groups
    once. The leaders of a run that is a part of another are given out as well: (a, estimate,
    prefix)."""
    run, part, leaders, names, same = None, False, None, [], None
    floor = THRESHOLD - (1 - THRESHOLD) - ALLOWANCE
    made = ["a", "b", "like", "least", "prefix"]
    kinds = [pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()]

    def table(rows):
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], made)

    def given():
        if part:
            yield table([(n, e.tobytes(), None, None, run[0]) for n, e in zip(names, leaders, strict=True)])

    for batch in batches:
        out = []
        columns = (batch[c].to_pylist() for c in ("prefix", "salt", "part", "node", "estimate"))
        for prefix, salt, is_part, node, sign in zip(*columns, strict=True):
            own = np.frombuffer(sign, "u1")
            if (prefix, salt) != run:
                yield from given()
                run, part, leaders, names, same = (prefix, salt), is_part, own[None, :], [node], np.zeros(1, "i8")
                continue
            like = (leaders == own).mean(1)
            hits = np.flatnonzero(like >= floor)
            if len(hits):
                partners = like[like >= THRESHOLD]
                least = float(partners.min()) if len(partners) else None
                groups, first = np.unique(same[hits], return_index=True)
                for k in hits[first].tolist():
                    out.append((node, names[k], float(like[k]), least, None))
                same[np.isin(same, groups)] = groups[0]
            if like.max() < THRESHOLD:
                leaders = np.concatenate([leaders, own[None, :]])
                names.append(node)
                same = np.append(same, groups[0] if len(hits) else len(same))
        yield table(out)
    yield from given()


_RUN_SCHEMA = "a binary, b binary, like double, least double, prefix bigint"


def _met_at(nodes: DataFrame, length: int) -> DataFrame:
    """The edges between nodes that share a prefix of ``length`` minima in some trie. ``nodes``
    has node, signature, estimate and ``waiting``; runs in which nobody waits are left out."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    label = F.substring("signature", F.col("tree") * (4 * LONGEST) + 1, F.lit(4 * length))
    placed = nodes.select("node", "signature", "waiting", tree.alias("tree")).select(
        "node", "waiting", F.xxhash64("tree", label).alias("prefix"))
    runs = placed.groupBy("prefix").agg(F.count("*").alias("n"), F.max("waiting").alias("w")).where(
        (F.col("n") > 1) & F.col("w"))
    salts = F.ceil(F.col("n") / F.lit(HOT))
    found = placed.select("node", "prefix").join(runs.select("prefix", salts.alias("salts")), "prefix").select(
        "node", "prefix", F.pmod(F.xxhash64("node"), "salts").alias("salt"), (F.col("salts") > 1).alias("part"))
    rows = found.join(nodes.select("node", "estimate"), "node")

    def walked(rows):
        return rows.repartition("prefix", "salt").sortWithinPartitions("prefix", "salt", "node").mapInArrow(
            _group_runs, _RUN_SCHEMA)

    parts = stored(walked(rows), "runs")
    # Leaders of the parts of a long run meet as a run of their own.
    heads = parts.where(F.col("prefix").isNotNull()).select(
        "prefix", F.lit(0).cast("bigint").alias("salt"), F.lit(False).alias("part"),
        F.col("a").alias("node"), F.col("b").alias("estimate"))
    return parts.where(F.col("prefix").isNull()).union(walked(heads)).drop("prefix")


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """(node, root): nodes that may be linked, by group. ``nodes`` has node and signature."""
    # One byte of each minimum is enough to estimate similarity.
    estimate = F.unhex(F.regexp_replace(F.hex("signature"), "(..)......", "$1"))
    nodes = nodes.withColumn("estimate", F.substring(estimate, 1, ESTIMATE))
    edges, over = None, None
    for length in depths():
        if over is None:
            going = nodes.withColumn("waiting", F.lit(True))
        else:
            going = nodes.join(over.withColumn("over", F.lit(True)), "node", "left").withColumn(
                "waiting", F.col("over").isNull()).drop("over")
        found = stored(_met_at(going, length), "edges")
        edges = found if edges is None else edges.union(found)
        if length == depths()[-1]:
            break
        # Whom a text has met so far, the least similar of them, and whether that is enough.
        pairs = edges.select("a", "least").union(edges.select("b", "like").where(F.col("like") >= THRESHOLD))
        least = pairs.toDF("node", "least").groupBy("node").agg(F.min("least").alias("least"))
        enough = 1 - F.pow(1 - F.pow("least", F.lit(length)), F.lit(TREES)) >= RECALL
        over = stored(least.where(enough).select("node"), "over")
    return components(edges.select("a", "b"), "candidates")


def bloom_places(keys: list[bytes], ids: list[int | None]) -> np.ndarray:
    both = np.frombuffer(b"".join(k[:8] for k in keys), "<u8") if keys else np.zeros(0, "u8")
    h = mixed(both ^ np.array([i or 0 for i in ids], "i8").astype("u8"))
    return np.stack([(h >> np.uint64(s)) % np.uint64(BLOOM_BITS) for s in (0, 20, 40)], 1).astype("i8")


def bloom(members: DataFrame) -> np.ndarray:
    """A bit for each of a fixed number of places, set for (node, rep)."""

    def run(batches):
        bits = np.zeros(BLOOM_BITS, bool)
        for batch in batches:
            bits[bloom_places(batch["node"].to_pylist(), batch["rep"].to_pylist())] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()])], ["bits"])

    parts = members.select("node", "rep").coalesce(8).mapInArrow(run, "bits binary").toArrow()["bits"]
    found = np.zeros(BLOOM_BITS // 8, "u1")
    for part in parts.to_pylist():
        found |= np.frombuffer(part, "u1")
    return np.unpackbits(found).astype(bool)


def text_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, elements): the distinct runs of each member's text, sorted. Texts are read once
    more and only members' leave the scan; a filter of fixed size lets a few others pass."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom(members))

    def run(batches):
        bits = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                keys, ids = part["node"].to_pylist(), part["doc_id"].to_pylist()
                hit = bits[bloom_places(keys, ids)].all(1)
                part = part.filter(pa.array(hit))
                if not part.num_rows:
                    continue
                h, text = shingles(*word_hashes(part["text"].to_pylist()), WORDS)
                ends = np.cumsum(np.bincount(text, minlength=part.num_rows))
                sets = [np.unique(x) for x in np.split(h, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [part["node"], part["doc_id"], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "rep", "size", "elements"])

    rows = docs.where(F.col("text").isNotNull()).select(
        F.unhex(F.md5("text")).alias("node"), F.col("doc_id"), "text")
    sets = rows.mapInArrow(run, "node binary, rep bigint, size bigint, elements binary")
    same = sets["rep"].eqNullSafe(members["rep"]) & (sets["node"] == members["node"])
    return sets.join(members, same).select(
        members["node"], members["root"], "size", "elements").dropDuplicates(["node"])


def _verify(group: pa.Table) -> pa.Table:
    """Links inside a block or between two: for each text how many, and its least partner."""
    p, q = group["p"][0].as_py(), group["q"][0].as_py()
    nodes, block = group["node"].to_pylist(), group["block"].to_numpy()
    sets = [np.frombuffer(x, "u8") for x in group["elements"].to_pylist()]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    column_of = np.cumsum(common) - 1
    keep = common[column]
    column, owner = column_of[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    shared = np.zeros((len(sets), len(sets)), "f8")
    step, n = max(1, DENSE // len(sets)), int(common.sum())
    for start in range(0, n, step):
        a, b = np.searchsorted(column, [start, start + step])
        part = np.zeros((len(sets), min(step, n - start)), "f4")
        part[owner[a:b], column[a:b] - start] = 1
        shared += part @ part.T
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= THRESHOLD * union - 1e-9 * union
    np.fill_diagonal(linked, False)
    if p != q:
        linked &= block[:, None] != block[None, :]
    least = np.arange(len(sets))
    while True:
        reach = np.where(linked, least[None, :], len(sets)).min(1, initial=len(sets))
        after = np.minimum(least, reach)
        after = after[after]
        if (after == least).all():
            break
        least = after
    return pa.table({
        "node": pa.array(nodes, pa.binary()), "links": pa.array(linked.sum(1), pa.int64()),
        "partner": pa.array([nodes[i] for i in least.tolist()], pa.binary()),
    })


def verified(sets: DataFrame) -> DataFrame:
    """(node, links, partner) by pairs of blocks of each group."""
    # Texts are dealt to blocks by their digests, so that no task numbers a whole group.
    last = sets.groupBy("root").agg(F.greatest(
        F.floor((F.count("*") - 1) / BLOCK_TEXTS), F.floor(F.sum("size") / BLOCK_ELEMENTS)).alias("last"))
    # Elements meet their block by node, so a large group's are not shuffled under one key.
    blocks = sets.select("node", "root").join(last, "root").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("last") + 1))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))
    rows = (
        blocks.join(sets.select("node", "elements"), "node")
        .select("root", "node", "elements", "block", other.alias("other"))
        .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    )
    return rows.groupBy("root", "p", "q").applyInArrow(_verify, "node binary, links bigint, partner binary")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, node, class_id, n_links, n_copies of every row."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = stored(signatures(docs), "signatures")
    nodes = stored(rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"),
        F.max("signature").alias("signature")), "nodes")
    groups = stored(candidate_groups(nodes.select("node", "signature")), "groups")
    members = nodes.select("node", "rep").join(groups, "node").select("node", "rep", "root")
    sets = stored(text_sets(docs, members), "sets")
    links = stored(verified(sets), "links")
    linked = components(links.select(F.col("node").alias("a"), F.col("partner").alias("b")), "classes")
    named = nodes.select("node", "rep", "n_copies").join(linked, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    found = named.join(ids, "root").join(counts, "node", "left").select(
        "node", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    return rows.select("doc_id", "node").join(found, "node", "left").select(
        "doc_id", "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class is kept: the row of the
    least doc_id and, among those, the least digest. Rows without words all stay."""
    found = stored(classes(docs), "classes")
    first = found.where(F.col("node").isNotNull()).groupBy("class_id").agg(
        F.min(F.when(F.col("doc_id").eqNullSafe(F.col("class_id")), F.col("node"))).alias("first_node"))
    id_of = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    node, number, place, chosen = (fresh(docs.columns, x) for x in ("node", "number", "place", "chosen"))
    keyed = docs.withColumn(node, F.unhex(F.md5("text"))).withColumn(number, id_of)
    first = first.select(
        F.col("first_node").alias(node),
        F.coalesce(F.col("class_id"), F.lit(-(1 << 63))).alias(number), F.lit(True).alias(chosen))
    # The numbering finds its rows where the join has put them.
    order = F.row_number().over(Window.partitionBy(node, number).orderBy(node))
    kept = keyed.join(first, [node, number]).withColumn(place, order).where(F.col(place) == 1)
    blank = docs.where(F.coalesce(F.length(F.regexp_replace("text", r"[\x20\t-\r]+", "")), F.lit(0)) == 0)
    return kept.select(*[f"`{c}`" for c in docs.columns]).union(blank)
