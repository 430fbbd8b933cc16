"""Near-duplicates by a signature-coordinate inverted join.

Every document's set of five-word shingles gets a signature of 64 minima.  Documents are posted
under each coordinate-value pair.  Two documents that agree on at least ``matches`` coordinates
share one of the ``64 - matches + 1`` rarest postings of either, so only that prefix is merged, and
a document with fewer than ``matches`` shared postings is skipped.  Inside a posting list, agreeing
coordinates are counted; pairs at the threshold join candidate clusters.  Links are then confirmed on
the full sets inside each cluster and connected into components.

``matches`` follows the wanted similarity: a pair at that similarity falls below it with a probability
of at most ``MISSED``.  That makes 40 of 64 at 0.85 and 35 at 0.80.

Scale: documents with equal sets are one node from the start, so exact copies are never paired.  A
list of over ``LONG_LIST`` nodes is not merged but hung on its least node, which only makes a
candidate cluster wider.  A cluster is confirmed in chunks of about ``CHUNK`` nodes or ``CHUNK_SHINGLES``
shingles, each with ``HUBS`` nodes of the whole cluster, so a group of copies becomes one part in work that
grows with its size.  Only nodes that this leaves outside their cluster's largest part meet the other
chunks, in pairs of chunks.  A task holds two chunks at most and returns a spanning forest of its links,
never the pairs.  Texts are shuffled once, and only narrow rows otherwise; joins on a cluster are salted.

Defined results: a null text is empty; an empty text has no shingles, is its own component and is
linked with nothing; fewer than five words make one shingle; rows that share an id are one document
with the links of all its texts; a row without an id links to nothing, has no component and is kept;
other columns are ignored, and :func:`one_of_each_group` returns them as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import drop_materialized, materialize, packed, remembered, salted_join, whole_texts

WORDS = 5
COORDINATES = 64
#: Chance that a pair at the wanted similarity is no candidate.
MISSED = 2.5e-6
LONG_LIST = 256
CHUNK = 1024
CHUNK_SHINGLES = 2_000_000
#: Nodes of a cluster that each of its chunks is confirmed with.
HUBS = 4
#: Words whose hashes a worker remembers; others are hashed each time.
REMEMBERED = 150_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def matches_for(percent: int) -> int:
    """The most agreeing coordinates that a pair at ``percent`` misses with a chance of at most ``MISSED``."""
    p, below, k = percent / 100, 0.0, 0
    while k < COORDINATES:
        below += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if below > MISSED:
            break
        k += 1
    return max(k, 1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    hashes: dict[bytes, int] = remembered("word hashes", dict)
    known = hashes.get
    out = []
    add = out.append
    for w in words:
        h = known(w)
        if h is None:
            h = xxhash.xxh3_64_intdigest(w)
            if len(hashes) < REMEMBERED:
                hashes[w] = h
        add(h)
    return np.array(out, dtype=np.uint64)


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; ``bytes`` splits and lowers by ASCII alone."""
    h = word_hashes(text.lower().split())
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    width = min(words, len(h))
    s = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        s = (s ^ h[k : k + n]) * _MIX
        s ^= s >> np.uint64(31)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(29)
    return np.unique(s)


_rng = np.random.Generator(np.random.PCG64(20))
_A = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of 64 hash functions over a set, in slices so that long texts need no more memory."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(s), 2048):
        np.minimum(low, (s[i : i + 2048, None] * _A + _B).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), 2000):
            part = batch.slice(at, 2000)
            n, fp, sig = [], [], []
            for t in part.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(t)
                n.append(len(s))
                fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig.append(signature(s) if len(s) else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.list_(pa.int32()))], names=["doc_id", "n", "fp", "sig"])


def _rooted(parent: dict, x):
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _merge_lists(matches: int):
    """Rows ``(token, node, sketch)`` sorted by token: edges between nodes that agree often enough.

    A sketch holds a byte of each coordinate, so its agreements are never fewer than the real ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        held: tuple[int | None, list[int], list[bytes]] = (None, [], [])

        def close(nodes: list[int], sketches: list[bytes]) -> None:
            if len(nodes) < 2:
                return
            m = np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(nodes), COORDINATES)
            for i in range(1, len(nodes)):
                for j in np.flatnonzero((m[:i] == m[i]).sum(axis=1) >= matches):
                    a, b = _rooted(parent, nodes[i]), _rooted(parent, nodes[j])
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        edges.append((nodes[i], nodes[j]))

        def flush() -> pa.RecordBatch:
            a, b = [x for x, _ in edges], [y for _, y in edges]
            edges.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["id_a", "id_b"])

        token, nodes, sketches = held
        for batch in batches:
            for t, n, s in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if t != token:
                    close(nodes, sketches)
                    token, nodes, sketches = t, [], []
                nodes.append(n)
                sketches.append(s)
            if len(parent) > 1_000_000:  # forgetting only repeats an edge
                parent.clear()
            yield flush()
        close(nodes, sketches)
        yield flush()

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the set, as sorted integers, in place of the text, which is the last column."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), 500):
            part = batch.slice(at, 500)
            sets = pa.array([shingle_set(t).tobytes() for t in part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], sets], names=[*part.schema.names[:-1], "shingles"])


def confirmed_links(nodes: list[int], sides: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links: ``100 * intersection >= percent * union``.

    Overlaps are counted through an inverted index.  With two sides, only pairs across them count.
    """
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    owners = owner[order]
    ends = np.cumsum(np.bincount(inverse))
    starts = ends - np.bincount(inverse)
    side = np.array(sides)
    across = len(set(sides)) > 1
    label = np.arange(len(sets))
    out = []
    at = np.concatenate([[0], np.cumsum(size)])
    for i in range(1, len(sets)):
        if across and side[i] == side.min():
            continue
        ids = inverse[at[i] : at[i + 1]]
        reach = np.concatenate([owners[starts[k] : ends[k]] for k in ids]) if len(ids) else np.zeros(0, int)
        overlap = np.bincount(reach, minlength=len(sets))
        ok = 100 * overlap >= percent * (size + size[i] - overlap)
        ok &= (side != side[i]) if across else (np.arange(len(sets)) < i)
        for old in np.unique(label[ok]):
            if old != label[i]:
                j = int(np.flatnonzero(ok & (label == old))[0])
                out.append((nodes[i], nodes[j]))
                label[label == old] = label[i]
    return out


def _confirm(percent: int):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(set(zip(group.column("side").to_pylist(), group.column("node").to_pylist(), group.column("shingles").to_pylist())))
        edges = confirmed_links([r[1] for r in rows], [r[0] for r in rows], [np.frombuffer(r[2], dtype=np.uint64) for r in rows], percent)
        return pa.table({"id_a": pa.array([a for a, _ in edges], pa.int64()), "id_b": pa.array([b for _, b in edges], pa.int64())})

    return run


def _sketch(sig: Column) -> Column:
    return F.unhex(F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(255))), 2, "0")), ""))


def candidate_edges(nodes: DataFrame, matches: int, label: str = "posts") -> DataFrame:
    """Edges that connect every pair of nodes with ``matches`` agreeing coordinates."""
    token = F.shiftleft(F.col("coordinate").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posts = nodes.select("node", F.posexplode("sig").alias("coordinate", "value")).select("node", token.alias("token"))
    lists = posts.groupBy("token").agg(F.count("*").alias("df"), F.min("node").alias("hub")).where("df > 1")
    shared = posts.join(lists, "token").groupBy("node").agg(F.collect_list(F.struct("df", "token", "hub")).alias("posted"))
    spare = COORDINATES - matches + 1 - (COORDINATES - F.size("posted"))
    prefix = F.slice(F.array_sort("posted"), 1, F.greatest(spare, F.lit(0)))
    prefixes = materialize(shared.where(spare > 0).select("node", F.explode(prefix).alias("p")).select("node", "p.*"), label)
    merged = prefixes.where(F.col("df") <= LONG_LIST).join(nodes.select("node", _sketch(F.col("sig")).alias("sketch")), "node").select("token", "node", "sketch")
    merged = merged.repartition("token").sortWithinPartitions("token", "node").mapInArrow(_merge_lists(matches), "id_a long, id_b long")
    hung = prefixes.where((F.col("df") > LONG_LIST) & (F.col("node") != F.col("hub"))).select(F.col("node").alias("id_a"), F.col("hub").alias("id_b"))
    return merged.unionAll(hung).distinct()


_EDGE = "id_a long, id_b long"


def dealt_clusters(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``cluster, node, chunks, chunk, hubs`` of every node in a cluster of the candidate graph (written)."""
    clusters = connected_components(edges).select(F.col("component").alias("cluster"), F.col("id").alias("node"))
    clusters = materialize(clusters.join(nodes.select("node", "n"), "node"), "clusters")
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int")
    hubs = F.array(*[F.min_by("node", F.xxhash64(F.lit(k), "node")) for k in range(HUBS)])
    sizes = clusters.groupBy("cluster").agg(chunks.alias("chunks"), hubs.alias("hubs"))
    placed = salted_join(clusters, sizes, ["cluster"], ["node"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    placed = materialize(placed.select("cluster", "node", "chunks", "chunk", F.when(F.col("chunks") > 1, F.array_contains("hubs", F.col("node"))).otherwise(False).alias("hub")), "placed")
    drop_materialized(clusters)
    return placed


def confirmed_edges(placed: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Edges that connect what the links inside the clusters connect (written)."""
    texts = docs.select(F.col("doc_id").alias("node"), "text")
    kinds = "cluster long, node long, chunks int, chunk int, hub boolean, shingles binary"
    sets = materialize(placed.join(texts, "node").select("cluster", "node", "chunks", "chunk", "hub", "text").mapInArrow(_sets, kinds), "sets")
    row = ["cluster", "chunk", F.lit(0).alias("side"), "node", "shingles"]
    everywhere = sets.where("hub").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    groups = sets.select(*row).unionAll(everywhere.select(*row)).groupBy("cluster", "chunk")
    links = materialize(groups.applyInArrow(_confirm(percent), _EDGE), "links")
    large = placed.where("chunks > 1")
    if not large.isEmpty():
        parts = materialize(connected_components(links.join(large.select(F.col("node").alias("id_a")), "id_a", "left_semi")), "parts")
        named = large.join(parts.withColumnRenamed("id", "node"), "node", "left").select("cluster", "node", F.coalesce("component", "node").alias("part"))
        named = materialize(named, "named")
        most = named.groupBy("cluster", "part").agg(F.count("*").alias("size")).groupBy("cluster").agg(F.max(F.struct("size", "part")).alias("m"))
        apart = salted_join(named, most.select("cluster", F.col("m.part").alias("main")), ["cluster"], ["node"]).where("part <> main").select("cluster", "node")
        apart = materialize(apart, "apart")
        blocks = materialize(apart.groupBy("cluster").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("blocks")), "blocks")
        if not blocks.isEmpty():
            alone = sets.join(apart.select("node"), "node", "left_semi")
            alone = salted_join(alone, blocks, ["cluster"], ["node"]).withColumn("block", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks")).cast("int"))
            alone = alone.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            rest = salted_join(sets.where("chunks > 1"), blocks, ["cluster"], ["node"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            both = alone.select("cluster", "chunk", "block", F.lit(1).alias("side"), "node", "shingles").unionAll(rest.select("cluster", "chunk", "block", F.lit(0).alias("side"), "node", "shingles"))
            more = materialize(both.groupBy("cluster", "chunk", "block").applyInArrow(_confirm(percent), _EDGE), "links")
            links = links.unionAll(more)
        drop_materialized(parts, named, apart, blocks)
    drop_materialized(sets)
    return links


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row per row of ``docs``."""
    docs = whole_texts(docs)
    signed = materialize(docs.mapInArrow(_sign, "doc_id long, n long, fp binary, sig array<int>"), "signed")
    live = signed.where("n > 0 and doc_id is not null")
    nodes = materialize(live.groupBy("fp").agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("n").alias("n")), "nodes")
    wide = materialize(candidate_edges(nodes, matches_for(percent)), "candidates")
    placed = dealt_clusters(wide, nodes.groupBy("node").agg(F.max("n").alias("n")))
    links = confirmed_edges(placed, docs, percent)
    # An id whose rows differ in text ties its nodes together.
    named = live.join(nodes.select("fp", "node"), "fp")
    ties = named.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("doc_id")
    ties = named.join(ties, "doc_id", "left_semi").select(F.col("doc_id").alias("id_a"), F.col("node").alias("id_b"))
    found = materialize(connected_components(links.unionAll(ties)), "components")
    drop_materialized(wide, placed)
    by_fp = nodes.select("fp", "node").join(found.withColumnRenamed("id", "node"), "node", "left").select("fp", F.coalesce("component", "node").alias("of"))
    out = signed.join(by_fp, "fp", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("of")).cast("long")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: Dropped ids up to which they are broadcast; a row is one integer.
BROADCAST_IDS = 200_000


def one_of_each_group(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that represent their group, with all their columns.

    Of rows that share an id, the least by all columns stays.  Rows without an id all stay.
    """

    def side(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    rows = packed(docs, F.col("doc_id").cast("long").alias("id"))
    dropped = materialize(near_duplicates(docs, percent).where("not kept").select(F.col("doc_id").alias("id")).distinct(), "dropped")
    left = rows.join(side(dropped), "id", "left_anti")
    repeated = rows.where("id is not null").groupBy("id").count().where("count > 1").select("id")
    again = materialize(repeated, "again")
    if again.isEmpty():
        return left.select("row.*")
    again = side(again)
    one = left.join(again, "id", "left_semi").groupBy("id").agg(F.min("row").alias("row"))
    return left.join(again, "id", "left_anti").select("row.*").unionByName(one.select("row.*"))
