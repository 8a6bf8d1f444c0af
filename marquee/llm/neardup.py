"""Near duplicates by a signature-coordinate inverted join: MinHash postings, prefix and skip merging, exact links.

A text's shingles are hashed to 64 bits; texts with the same set are one node. Every node is
posted under its ``COORDS`` (coordinate, value) pairs. A pair with Jaccard similarity of 0.8
agrees in about 77 of 96 coordinates and in fewer than 56 with a probability of 3.5e-7 (``MISSED``).
The number of ``matches`` asked for follows from the similarity, at most that probability for all.
Nodes that share a rare list meet in clusters, where only signatures travel: collisions are counted
by merging the shorter lists and skipping into the longer ones. Full sets are fetched for nodes of
pairs that agree in ``matches`` or more, and confirm them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import blank_words, map_batches, perhaps_in, stage, texts, with_columns
from marquee.llm.graph import components

COORDS = 96
BLOCK = 512  # nodes of one side of a block pair
REMEMBERED = 100_000  # word hashes that a batch's shingler remembers
_U = np.uint64
_SCALES = np.random.default_rng(20240101).integers(0, 1 << 63, COORDS, dtype=np.uint64) * _U(2) + _U(1)


def missed(matches: int, percent: int) -> float:
    """Probability that a pair of this similarity agrees in fewer than ``matches`` coordinates."""
    return sum(comb(COORDS, k) * (percent / 100) ** k * (1 - percent / 100) ** (COORDS - k) for k in range(matches))


MISSED = missed(56, 80)


def matches_for(percent: int) -> int:
    """The most coordinates to ask for so that a pair at ``percent`` is missed with at most ``MISSED``."""
    fit = [m for m in range(1, COORDS + 1) if missed(m, percent) <= MISSED] if 0 <= percent <= 100 else []
    if not fit:
        raise ValueError(f"no number of matches finds pairs of {percent} percent with the same certainty")
    return fit[-1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Sorted distinct 64-bit shingles of ``n`` words; a shorter text is one shingle."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = blank_words(text)
        if not words:
            return np.zeros(0, _U)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        x = np.fromiter(map(known.__getitem__, words), _U, len(words))
        n = min(self.n, len(x))
        out = np.full(len(x) - n + 1, n, _U)
        for k in range(n):
            out = _mix(out * _U(0x9E3779B97F4A7C15) + x[k:len(x) - n + 1 + k])
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of ``COORDS`` hashes of the shingles, 32 bits each."""
    least = np.full(COORDS, 0xFFFFFFFF, _U)
    for at in range(0, len(shingles), 2048):
        part = (_SCALES[:, None] * shingles[None, at:at + 2048]) >> _U(32)
        np.minimum(least, part.min(axis=1), out=least)
    return least.astype(np.uint32)


def node_of(shingles: np.ndarray) -> int | None:
    """One number for a set; none for an empty one."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


def shingled(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """``docs`` with ``node`` (null: no words), ``n_shingles`` and ``signature``."""

    def run(batch):
        shingler = Shingler(n)
        sets = [shingler(t) for t in texts(batch, text)]
        return {"node": [node_of(s) for s in sets], "n_shingles": [len(s) for s in sets],
                "signature": [signature(s).tobytes() if len(s) else None for s in sets]}

    return with_columns(docs, {"node": "bigint", "n_shingles": "bigint", "signature": "binary"}, run)


def postings(nodes: DataFrame) -> DataFrame:
    """(key, node): a node under each coordinate and its value."""

    def run(batches):
        place = np.arange(COORDS, dtype=np.int64) << 32
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDS).astype(np.int64)
            node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), COORDS)
            yield pa.RecordBatch.from_arrays([pa.array((values + place).ravel()), pa.array(node)], names=["key", "node"])

    return map_batches(nodes.select("node", "signature"), "key bigint, node bigint", run)


def hub_clusters(nodes: DataFrame, matches: int) -> DataFrame:
    """(hub, node): every pair that agrees in ``matches`` coordinates meets under at least one hub.

    Only nodes on ``matches`` lists with two or more nodes can have a partner. The prefix of a node
    are its rarest lists, all but ``matches - 1``: a partner shares one of them. A list's hub is its
    node with the longest lists in all; its nodes meet there once, however many lists they share.
    """
    lists = postings(nodes)
    counts = lists.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = lists.join(counts, "key").select("key", "node", "n")
    rarest = Window.partitionBy("node").orderBy("n", "key")  # at most COORDS rows
    whole = Window.partitionBy("node")
    prefix = (shared.select("key", "node", F.row_number().over(rarest).alias("place"), F.count("*").over(whole).alias("on"), F.sum("n").over(whole).alias("weight"))
              .where(F.col("place") <= F.col("on") - (matches - 1)).select("key", "node", "weight"))
    prefix = stage(prefix, "prefix-lists")
    hubs = prefix.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top"), F.count("*").alias("n")).where("n > 1")
    return stage(prefix.join(hubs.select("key", F.col("top.node").alias("hub")), "key").select("hub", "node").distinct(), "clusters")


class Lists:
    """The postings of a block of nodes, merged for one probe at a time."""

    def __init__(self, signatures: np.ndarray):
        self.signatures = signatures
        place = np.arange(COORDS, dtype=np.int64)[:, None] << 32
        keys = signatures.T.astype(np.int64) + place
        order = np.argsort(keys, axis=1, kind="stable")
        self.keys, self.posted = np.take_along_axis(keys, order, 1).ravel(), order.ravel()

    def collisions(self, probes: np.ndarray, matches: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per probe (nodes, counts): those of the block that agree in ``matches`` coordinates or more.

        A probe's shorter lists, all but ``matches - 1``, are merged and counted; the longer ones are
        skipped, and looked into only for the nodes that the merge met.
        """
        wanted = probes.astype(np.int64) + (np.arange(COORDS, dtype=np.int64) << 32)
        low, high = (np.searchsorted(self.keys, wanted, side) for side in ("left", "right"))
        lengths = high - low
        nothing = np.zeros(0, np.int64)
        for probe, start, n in zip(probes, low, lengths):
            if np.count_nonzero(n) < matches:
                yield nothing, nothing
                continue
            order = np.argsort(n, kind="stable")
            short, long = order[:COORDS - matches + 1], order[COORDS - matches + 1:]
            n = n[short]
            at = np.arange(n.sum()) + np.repeat(start[short] - (np.cumsum(n) - n), n)
            met, counts = np.unique(self.posted[at], return_counts=True)
            counts = counts + (self.signatures[met][:, long] == probe[long]).sum(axis=1)
            yield met[counts >= matches], counts[counts >= matches]


def sets_in(docs: DataFrame, wanted: DataFrame, n: int, once: bool) -> DataFrame:
    """The rows of ``wanted`` (node, doc_id, ``groups``), one per group, with the node's ``shingles`` from the texts of these documents.

    ``once`` says that no id repeats, so that an id's text is its node's only one.
    """
    rows = perhaps_in(docs, wanted, "doc_id").where("_perhaps").select(F.col("doc_id").alias("_id"), "text")
    some = rows.join(wanted.withColumnRenamed("node", "_node"), F.col("_id").eqNullSafe(F.col("doc_id"))).drop("_id", "doc_id")

    def run(batch):
        shingler = Shingler(n)
        sets = [shingler(t) for t in texts(batch, "text")]
        return {"node": [node_of(s) for s in sets], "shingles": [s.tobytes() for s in sets]}

    made = with_columns(some, {"node": "bigint", "shingles": "binary"}, run).where("node = _node").drop("text", "_node")
    if not once:
        made = made.dropDuplicates(["node"])
    return made.withColumn("_group", F.explode("groups")).select("_group.*", *[c for c in made.columns if c != "groups"])


def grouped(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``wanted`` of :func:`sets_in`: a row per node of ``members``, with its document and all its other columns as ``groups``."""
    others = [c for c in members.columns if c != "node"]
    return members.groupBy("node").agg(F.collect_list(F.struct(*others)).alias("groups")).join(classes, "node")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (small + large - common)


class Forest:
    """Union-find over the rows of one task."""

    def __init__(self, start):
        self.parent = {x: x for x in start}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a, b) -> None:
        self.parent[self.find(a)] = self.find(b)


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, COORDS)


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, _U) for x in table.column("shingles").to_pylist()]


def _links(rows: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in rows], pa.int64()), "b": pa.array([b for _, b in rows], pa.int64())})


def _dealt(stars: DataFrame) -> DataFrame:
    """(hub, part, node): the nodes of a hub over many tasks if there are many, the hub itself in each of them."""
    sizes = stars.groupBy("hub").agg(F.count("*").alias("n"))
    dealt = stars.where("hub <> node").join(sizes, "hub").select(
        "hub", "node", F.pmod(F.xxhash64("node"), F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1))).alias("part"))
    return dealt.unionByName(dealt.select("hub", "part").distinct().withColumn("node", F.col("hub")))


def star_pairs(clusters: DataFrame, signatures: DataFrame, matches: int) -> DataFrame:
    """(hub, node): the nodes that agree with their hub in ``matches`` coordinates."""

    def run(key, table):
        nodes, sigs = table.column("node").to_numpy(), _signatures(table)
        same = (sigs == sigs[np.flatnonzero(nodes == key[0].as_py())[0]]).sum(axis=1)
        near = nodes[(same >= matches) & (nodes != key[0].as_py())]
        return pa.table({"hub": pa.array(np.full(len(near), key[0].as_py(), np.int64)), "node": pa.array(near)})

    return _dealt(clusters).join(signatures, "node").groupBy("hub", "part").applyInArrow(run, "hub bigint, node bigint")


def star_links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of a hub and a node that the full sets (hub, part, node, shingles) confirm."""

    def run(key, table):
        nodes, sets_ = table.column("node").to_pylist(), _sets(table)
        hub = nodes.index(key[0].as_py())
        return _links([(nodes[hub], node) for node, s in zip(nodes, sets_) if node != nodes[hub] and similar(sets_[hub], s, percent)])

    return sets.groupBy("hub", "part").applyInArrow(run, "a bigint, b bigint")


PLACED = "hub bigint, node bigint, label bigint, own int, left int, right int"


def open_nodes(clusters: DataFrame, signatures: DataFrame, labels: DataFrame, matches: int) -> DataFrame:
    """``PLACED`` rows of the nodes that agree in ``matches`` coordinates with one of another component.

    Only clusters whose nodes are not yet one component are looked at. They are cut into blocks;
    every pair of blocks is one task that counts collisions and names the nodes, not their pairs.
    """
    known = clusters.join(labels, "node", "left").select("hub", "node", F.coalesce("label", "node").alias("label"))
    sizes = known.groupBy("hub").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = known.join(sizes, "hub").select("hub", "node", "label", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = other.select("hub", "node", "label", "own", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"))
    names = [x.split()[0] for x in PLACED.split(", ")]

    def run(key, table):
        used = np.zeros(table.num_rows, bool)
        for i, js, _ in _apart(key, table, matches):
            used[i] = True
            used[js] = True
        return table.select(names).filter(pa.array(used))

    return pairs.join(signatures, "node").groupBy("hub", "left", "right").applyInArrow(run, PLACED)


def _apart(key, table: pa.Table, matches: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, rows, counts): a node of the left block and those of the right that collide often enough, labelled otherwise."""
    sigs, own = _signatures(table), table.column("own").to_numpy()
    labels = table.column("label").to_numpy()
    left, right = (np.flatnonzero(own == key[k].as_py()) for k in (1, 2))
    if not len(left) or not len(right):
        return
    for i, (js, counts) in zip(left.tolist(), Lists(sigs[right]).collisions(sigs[left], matches)):
        js = right[js]
        ok = (labels[js] != labels[i]) & ((js > i) | (key[1].as_py() != key[2].as_py()))
        if ok.any():
            yield i, js[ok], counts[ok]


def pair_links(sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """(a, b): links that join different components; the closest are confirmed first and pairs already joined are skipped.

    ``sets`` are ``PLACED`` rows with signatures and full sets.
    """

    def run(key, table):
        nodes, sets_, label = table.column("node").to_pylist(), _sets(table), table.column("label").to_pylist()
        forest, out = Forest(set(label)), []
        found = [(-n, i, j) for i, js, counts in _apart(key, table, matches) for n, j in zip(counts.tolist(), js.tolist())]
        for _, i, j in sorted(found):
            if forest.find(label[i]) != forest.find(label[j]) and similar(sets_[i], sets_[j], percent):
                forest.join(label[i], label[j])
                out.append((nodes[i], nodes[j]))
        return _links(out)

    return sets.groupBy("hub", "left", "right").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, n: int = 2, percent: int = 80) -> DataFrame:
    """Per document row: ``doc_id node n_shingles component_id kept``.

    Two texts are linked if the Jaccard similarity of their sets of ``n``-word shingles is at
    least ``percent``; ``component_id`` is the smallest doc id reachable over links, ``kept``
    says whether that is the row's own. A text with fewer words is one shingle; null, empty and
    blank texts have none, are linked with nothing and kept. Repeated rows share their result.
    Null ids take part; they never are the smallest id unless all ids of a component are null.
    An empty table gives no rows. Other columns are not read. A ``percent`` too low for the
    signature's coordinates is refused.
    """
    matches = matches_for(percent)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = stage(shingled(docs, n).drop("text"), "signatures")
    filled = rows.where("node IS NOT NULL")
    classes = stage(filled.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "classes")
    nodes = filled.select("node", "signature").dropDuplicates(["node"])
    clusters = hub_clusters(nodes, matches)
    held = stage(nodes.join(clusters.select("node").distinct(), "node", "left_semi"), "cluster-signatures")
    pairs = stage(star_pairs(clusters, held, matches), "star-pairs")
    once = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    ends = stage(grouped(_dealt(pairs), classes), "star-ends")
    star = stage(star_links(sets_in(docs, ends, n, once), percent), "star-links")
    placed = open_nodes(clusters, held, components(star), matches)
    opened = stage(grouped(placed, classes).join(held, "node"), "open-nodes")
    rest = stage(pair_links(sets_in(docs, opened, n, once), percent, matches), "pair-links")
    labels = components(star.union(rest))
    lowest = labels.join(classes, "node").groupBy("label").agg(F.min("doc_id").alias("low"))
    of_node = classes.join(labels.join(lowest, "label").select("node", "low"), "node", "left").select(
        "node", F.coalesce("low", "doc_id").alias("component_id"))
    linked = filled.select("doc_id", "node", "n_shingles").join(of_node, "node")
    alone = rows.where("node IS NULL").select("doc_id", "node", "n_shingles", F.col("doc_id").alias("component_id"))
    both = linked.select("doc_id", "node", "n_shingles", "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 1), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach(root, doc_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.root, l.b FROM reach r JOIN link l ON l.a = r.doc_id),
comp AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)"""
