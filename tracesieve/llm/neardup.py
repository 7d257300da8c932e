"""Near-duplicates by ProbMinHash.

A text is the multiset of its five-word shingles (words split by white space, A-Z in lower case;
a text of one to four words is a single shingle). Every shingle is a Poisson process whose rate is
its count, seeded by its hash; its arrivals fall into random registers, each register keeps the
shingle that arrives first, and a shingle stops once its next arrival is later than all registers'
firsts. Two texts agree in a register with their probability Jaccard similarity. Registers are
joined in bands; documents that share a band are candidates, and a pair is linked if its exact
probability Jaccard similarity (plain Jaccard where no shingle repeats) reaches THRESHOLD.

A distinct text is a node, named by a hash (checked by a second one). Nodes are first compared with
a hub, the smallest of their buckets; those outside their buckets' largest components then with a
few members of these; and at last, in buckets of any size, with all members that they are still
apart from, in tiles of bounded size. Spared are only pairs of one component, whose link changes
nothing. So the classes are those of all links between texts that share a band.
Links stay distributed; classes are found by large and small stars.

Empty and null texts have no shingles: they are copies of texts that are exactly equal, nothing
else. Rows of one id with different texts are documents of their own, and only if these are
similar are they in one class. Rows without an id are in no class (class_id null). Empty tables:
no rows. Very long texts are read whole. The smallest id names the class. Other columns are
ignored by `classes` and kept by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tracesieve.llm.common import byte_view, cut, mix64, slices, span_hashes, texts, trim, word_spans

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band once in 1,500.
BANDS, ROWS = 40, 8
#: Shingles of a bucket's texts in a side of a tile; members of the largest components that a node
#: outside of them is compared with first; most keys that are looked up by a broadcast.
TOGETHER, OTHERS, FREQUENT = 200_000, 4, 500
#: Members of a tile that all others are compared with before the rest.
FIRST = 64
_BLOCK = 2_000_000
#: Rows of an Arrow batch that carry texts or vectors.
BATCH = 1_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text, by text and hash: text, hash, count."""
    data, offsets = byte_view(column)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, at = word_spans(data, offsets)
    keys, n = span_hashes(data, starts, ends), np.diff(at)
    size = np.minimum(n, words)
    owner = np.repeat(np.arange(len(n)), n)
    first = np.flatnonzero(np.arange(len(keys)) + np.repeat(size, n) <= np.repeat(at[1:], n))
    rolled, length = np.zeros(len(first), np.uint64), size[owner[first]]
    with np.errstate(over="ignore"):
        for j in range(words):
            use = length > j
            rolled[use] = mix64(rolled[use] * np.uint64(31) + keys[first[use] + j] + np.uint64(j))
    owner = owner[first]
    order = np.lexsort((rolled, owner))
    owner, rolled = owner[order], rolled[order]
    new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (rolled[1:] != rolled[:-1])]) if len(owner) else np.empty(0, np.int64)
    return owner[new], rolled[new], np.diff(np.r_[new, len(owner)])


def signatures(owner: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """(n, registers): the shingle that arrives first in each register; 0 for texts without any."""
    when = np.full(n * registers, np.inf)
    which = np.zeros(n * registers, np.uint64)
    owner, keys, rate = owner.astype(np.int64), keys.copy(), counts.astype(float)
    clock, step = np.zeros(len(keys)), 0
    with np.errstate(over="ignore"):
        while len(keys):
            ahead = int(max(1, min(64, 200_000 // len(keys))))
            place = np.arange(step, step + ahead, dtype=np.uint64)
            random = mix64(keys[:, None] + (place[None, :] + np.uint64(1)) * _GOLDEN)
            wait = -np.log(((random >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate[:, None]
            arrival = clock[:, None] + np.cumsum(wait, axis=1)
            slot = owner[:, None] * registers + (mix64(random ^ _GOLDEN) % np.uint64(registers)).astype(np.int64)
            clock, step = arrival[:, -1], step + ahead
            early = arrival < when[slot]
            x, s = arrival[early], slot[early]
            np.minimum.at(when, s, x)
            won = when[s] == x
            which[s[won]] = np.broadcast_to(keys[:, None], early.shape)[early][won]
            last = when.reshape(n, registers).max(1)
            on = clock < last[owner]
            owner, keys, rate, clock = owner[on], keys[on], rate[on], clock[on]
    return which.reshape(n, registers)


def bands(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(texts with shingles, BANDS) keys, and the distinct shingles of every text."""
    owner, keys, counts = shingles(column)
    size = np.bincount(owner, minlength=len(column))
    some, own = np.unique(owner, return_inverse=True)
    which = signatures(own, keys, counts, len(some)).reshape(len(some), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), which.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for j in range(ROWS):
            out = mix64(out * np.uint64(31) + which[:, :, j])
    return out.view(np.int64), size


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two (sorted hashes, counts)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    if a[1].max() == 1 and b[1].max() == 1:
        both = len(np.intersect1d(a[0], b[0], assume_unique=True))
        return both / (len(a[0]) + len(b[0]) - both)
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    ratio, which = np.unique(x[both] / y[both], return_inverse=True)
    whole = np.array([np.maximum(x, r * y).sum() for r in ratio]) if len(ratio) < 64 else _many(x, y, ratio)
    return float((x[both] / whole[which]).sum())


def _many(x: np.ndarray, y: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Sum of max(x, r * y) for many r at once: x counts where x / y > r, r * y elsewhere."""
    with np.errstate(divide="ignore"):
        own = np.where(y > 0, x / y, np.inf)
    order = np.argsort(own)
    at = np.searchsorted(own[order], ratio, "right")
    xs, ys = np.r_[0, np.cumsum(x[order])], np.r_[0, np.cumsum(y[order])]
    return xs[-1] - xs[at] + ratio * ys[at]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column("text"), _BLOCK):
            part = batch.slice(a, b - a)
            keys, size = bands(part.column("text"))
            at = np.r_[0, np.cumsum(size > 0)] * BANDS
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "node", "check")), pa.array(size, pa.int32()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys.ravel()))], ["doc_id", "node", "check", "size", "bands"])
        trim()


def _similarities(hub: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
    """Similarities of pairs of texts; where the hub is that of the row before, so is its text."""
    out, ids = np.zeros(len(hub)), hub.to_numpy()
    for a, b in slices(right, _BLOCK):
        new = np.r_[True, ids[a + 1 : b] != ids[a : b - 1]]
        which = np.cumsum(new) - 1
        ones = left.slice(a, b - a).filter(pa.array(new))
        # a block's hubs in parts too: their texts may be the longer ones
        parts = [_split(ones.slice(x, y - x)) for x, y in slices(ones, _BLOCK)]
        hubs = [v for part in parts for v in part]
        for i, own in enumerate(_split(right.slice(a, b - a))):
            out[a + i] = similarity(hubs[which[i]], own)
    trim()
    return pa.array(out)


_similarities.__annotations__ = {"hub": pa.Array, "left": pa.Array, "right": pa.Array, "return": pa.Array}


def _split(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted hashes, counts) of each text."""
    owner, keys, counts = shingles(column)
    at = np.searchsorted(owner, np.arange(len(column) + 1))
    return [(keys[x:y], counts[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]


def _verified(pairs: DataFrame, pool: DataFrame) -> DataFrame:
    """(a, b) of the pairs (a, b, parts) whose similarity was computed, with it as s. The text of a
    document with many partners stands in as many parts as its pairs name, so that no task gets
    them all; the joins have one form at every size."""
    hubs = pairs.groupBy("a").agg(F.max("parts").alias("parts")).hint("merge").join(pool.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    left = hubs.select("a", "left", F.explode(F.sequence(F.lit(1), "parts")).alias("part"))
    right = pairs.hint("merge").join(pool.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    right = right.select("a", (F.pmod(F.xxhash64("b", F.lit(3)), "parts") + 1).cast("int").alias("part"), "b", "right")
    both = left.hint("merge").join(right, ["a", "part"])
    return cut(both.select("a", "b", F.arrow_udf(_similarities, "double")("a", "left", "right").alias("s")), BATCH)


def components(edges: DataFrame, passes: int | None = None) -> DataFrame:
    """(node, root) of every node that an edge (a, b) connects with a smaller one; root is the
    smallest of all. Each pass hangs every node's larger neighbours, then its smaller ones, on the
    smallest of them, until nothing changes. After fewer passes a node can have several roots, which are
    all connected with it."""
    star, seen = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).filter("node != root"), None
    while True:
        ends = star.union(star.select("root", "node")).toDF("root", "other")
        top = ends.groupBy("root").agg(F.least("root", F.min("other")).alias("top"))
        large = star.join(top, "root").select("node", F.col("top").alias("root"))
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        joined = large.join(low, "node").select(F.when(F.col("root") == F.col("low"), F.col("node")).otherwise(F.col("root")).alias("node"), F.col("low").alias("root"))
        found = Observation()
        mark = F.bit_xor(F.xxhash64("node", "root"))
        star = cut(joined.distinct().observe(found, F.count(F.lit(1)).alias("n"), mark.alias("mark")))
        now = tuple(found.get.values())
        passes = passes and passes - 1
        if now == seen or passes == 0:
            return star
        seen = now


_VECTOR = "node long, keys binary, counts binary"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to _VECTOR: sorted hashes of the shingles, and their counts where any repeats."""
    for batch in batches:
        for a, b in slices(batch.column("text"), _BLOCK):
            found = _split(batch.column("text").slice(a, b - a))
            counts = [c.astype(np.uint32).tobytes() if c.max(initial=1) > 1 else None for _, c in found]
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), pa.array([k.tobytes() for k, _ in found], pa.binary()), pa.array(counts, pa.binary())], ["node", "keys", "counts"])
        trim()


class Side(NamedTuple):
    members: np.ndarray
    size: np.ndarray
    starts: np.ndarray
    place: np.ndarray
    shares: np.ndarray


class Many:
    """Vectors of several texts, laid one after the other; place: of each shingle among all."""

    def __init__(self, keys: list[bytes], counts: list[bytes | None]) -> None:
        own = [np.frombuffer(k, np.uint64) for k in keys]
        self.at = np.r_[0, np.cumsum([len(k) for k in own])].astype(np.int64)
        self.single = np.array([c is None for c in counts], bool)
        self.counts = np.concatenate([np.empty(0), *(np.ones(len(k)) if c is None else np.frombuffer(c, np.uint32) for k, c in zip(own, counts, strict=True))])
        self.keys, self.place = np.unique(np.concatenate([np.empty(0, np.uint64), *own]), return_inverse=True)
        size = np.diff(self.at)
        total = np.add.reduceat(self.counts, self.at[:-1]) if len(own) else np.empty(0)
        self.size, self.shares = size, (self.counts / np.repeat(total, size)).astype(np.float32)

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.at[i], self.at[i + 1])
        return self.keys[self.place[part]], self.counts[part]

    def side(self, members: np.ndarray) -> Side:
        """The shingles of the members in a row."""
        size = self.size[members]
        starts = np.r_[0, np.cumsum(size)[:-1]]
        flat = np.repeat(self.at[members] - starts, size) + np.arange(size.sum())
        return Side(members, size, starts, self.place[flat], self.shares[flat])

    def plain(self, i: int, side: Side, threshold: float) -> np.ndarray:
        """Which of the side reach the threshold with i by plain Jaccard similarity."""
        mark = np.zeros(len(self.keys), np.uint8)
        mark[self.place[self.at[i] : self.at[i + 1]]] = 1
        both = np.add.reduceat(mark[side.place], side.starts, dtype=np.int64)
        return both / (side.size + self.size[i] - both) >= threshold

    def bounded(self, i: int, side: Side, threshold: float) -> np.ndarray:
        """Which of the side may reach the threshold with i by probability Jaccard similarity: a common
        shingle adds the lesser of its shares at most."""
        own = slice(self.at[i], self.at[i + 1])
        share = np.zeros(len(self.keys), np.float32)
        share[self.place[own]] = self.shares[own]
        return np.add.reduceat(np.minimum(share[side.place], side.shares), side.starts) >= threshold - 1e-4

    def links(self, outer: np.ndarray, inner: np.ndarray, threshold: float, root: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Each of outer with the members of inner that reach the threshold with it. With root (the
        components, joined on the way): only with those that it is apart from when they are reached, so that pairs
        which a former link connects are spared; the FIRST of inner come first."""
        for part in [inner] if root is None else np.split(inner, [FIRST]):
            sides = [self.side(part[self.single[part] == x]) for x in (True, False)]
            for i in outer:
                yield i, np.array([j for side in sides for j in self._reached(i, side, threshold, root)], np.int64)

    def _reached(self, i: int, side: Side, threshold: float, root: np.ndarray | None) -> list[int]:
        apart = np.ones(len(side.members), bool) if root is None else root[side.members] != root[i]
        if not apart.any():
            return []
        if apart.sum() * 2 < len(apart):  # laid out anew only where that spares most of it
            side = self.side(side.members[apart])
        plain = self.single[i] and self.single[side.members[0]]
        out = []
        for j in side.members[(self.plain if plain else self.bounded)(i, side, threshold)]:
            if (root is None or root[i] != root[j]) and (plain or similarity(self.of(i), self.of(j)) >= threshold):
                out.append(j)
                if root is not None:
                    root[root == root[j]] = root[i]
        return out


_TILED = "band long, i int, j int, outer boolean, node long, root long, main boolean, keys binary, counts binary"


def _tiles(threshold: float):
    """Rows of _TILED by (band, i, j) to the links (a, b) between nodes of a tile that are apart; of
    links that connect the same, the first."""

    def tile(rows: pa.Table) -> pa.RecordBatch | None:
        outer, node, root, main = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("outer", "node", "root", "main"))
        if outer.all() or not outer.any():
            return None
        many = Many(rows.column("keys").to_pylist(), rows.column("counts").to_pylist())
        _, root = np.unique(root, return_inverse=True)
        inner = np.flatnonzero(~outer & (many.size > 0))
        found = many.links(np.flatnonzero(outer & (many.size > 0)), inner, threshold, root)
        out = [(node[x], node[y]) for x, others in found for y in others]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"]) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("band", "i", "j")], axis=1)
            edges = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)]) if len(keys) else []
            for s, e in zip(edges, [*edges[1:], len(keys)], strict=True):
                if key != tuple(keys[s]) and held:
                    found = tile(pa.Table.from_batches(held))
                    held = []
                    if found is not None:
                        yield found
                key = tuple(keys[s])
                held.append(batch.slice(s, e - s))
        if held:
            found = tile(pa.Table.from_batches(held))
            if found is not None:
                yield found
        trim()

    return run


def _keyed(docs: DataFrame, salt: int) -> DataFrame:
    """doc_id, node (a hash of the text), check (another), text."""
    digest = F.sha2("text", 256)
    return texts(docs).select("doc_id", _node(digest, salt).alias("node"), F.xxhash64(F.lit("check"), digest).alias("check"), "text")


def _node(digest: Column, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), digest)


def _open(shared: DataFrame, star: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component: band, node, members (their shingles),
    root, main (whether in the largest one), outside (the shingles of those that aren't)."""
    star = star.groupBy("node").agg(F.min("root").alias("root"))  # some passes may be open
    named = shared.join(star, "node", "left").withColumn("root", F.coalesce("root", "node"))
    each = named.groupBy("band", "root").agg(F.sum(_size()).alias("n"))
    largest = each.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("all")).filter(F.col("all") > F.col("most"))
    joined = named.hint("merge").join(largest, "band")
    return cut(joined.select("band", "node", "members", "root", (F.col("root") == F.col("largest")).alias("main"), (F.col("all") - F.col("most")).alias("outside")))


def _parts() -> Column:
    return F.ceil(F.col("members") / TOGETHER).cast("int")


def _size() -> Column:
    return F.col("size") + 50  # a short text isn't for free


def _some_of_main(open_: DataFrame) -> DataFrame:
    """Pairs (a, b, parts) of every node outside its bucket's largest component with members of
    that, OTHERS at most, by random orders."""
    picked = open_.filter("main").groupBy("band").agg(*(F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"a{k}") for k in range(2)))
    rows = open_.filter("not main").hint("merge").join(picked, "band").select(F.explode(F.array("a0", "a1")).alias("a"), F.col("node").alias("b"), _parts().alias("parts"))
    each = rows.groupBy("b").agg(F.max("parts").alias("parts"), F.array(*(F.min_by("a", F.xxhash64("a", "b", F.lit(k))) for k in range(OTHERS))).alias("a"))
    return each.select(F.explode(F.array_distinct("a")).alias("a"), "b", "parts")


def _rest(open_: DataFrame, pool: DataFrame, threshold: float) -> DataFrame:
    """The links (a, b) between nodes of a bucket that are apart. A tile is a block of a bucket's
    nodes outside its largest component with a block of its members; blocks are bounded by the
    shingles of their texts."""
    vectors = cut(pool.join(open_.select("node").distinct(), "node", "left_semi").mapInArrow(_vectors, _VECTOR), BATCH)
    rows = open_.hint("merge").join(vectors, "node")
    i = F.ceil(F.col("outside") / TOGETHER).cast("int")
    deal = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), n).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rest = ["node", "root", "main", "keys", "counts"]
    outer = rows.filter("not main").select("band", deal(i, 4).alias("i"), spread(_parts()).alias("j"), F.lit(True).alias("outer"), *rest)
    inner = rows.select("band", spread(i).alias("i"), deal(_parts(), 5).alias("j"), F.lit(False).alias("outer"), *rest)
    tiled = outer.union(inner).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return cut(tiled.mapInArrow(_tiles(threshold), "a long, b long"), BATCH)


def _links(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, int]:
    """signed (doc_id, node, ...: a row for each of docs), the star (node, root) of the linked
    nodes, and the salt of the nodes' hash."""
    salt = 0
    while True:
        signed = cut(_keyed(docs, salt).mapInArrow(_sign, "doc_id long, node long, check long, size int, bands array<long>"), BATCH)
        known = signed.filter("doc_id is not null")
        if known.groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y")).filter("x != y").isEmpty():
            break
        salt += 1  # two texts have one hash
    once = known.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands"), F.any_value("size").alias("size"))
    entries = once.select(F.explode("bands").alias("band"), "node", "doc_id", "size")
    buckets = entries.groupBy("band").agg(F.sum(_size()).alias("members"), F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub != last").drop("last")
    shared = cut(entries.hint("merge").join(buckets, "band"))
    involved = shared.select("node", "doc_id").distinct()
    # by the node and the id of its first document: exact copies don't meet in one task
    pool = _keyed(docs, salt).select("node", "doc_id", "text").hint("merge").join(involved, ["node", "doc_id"], "left_semi")
    pool = cut(pool.dropDuplicates(["node", "doc_id"]).select("node", "text"))

    links = lambda pairs: pairs.filter(F.col("s") >= threshold).select(F.col("a").alias("node"), F.col("b").alias("root"))
    # these only tell which pairs are spared; the last of them makes the classes, from all links
    grown = lambda star, pairs: components(star.union(links(pairs)).toDF("a", "b"), 2)
    hubs = shared.filter("node != hub").groupBy(F.col("node").alias("b")).agg(F.min("hub").alias("a"), F.max(_parts()).alias("parts"))
    star = components(links(_verified(hubs, pool)).toDF("a", "b"), 1)
    star = grown(star, _verified(_some_of_main(_open(shared, star)), pool))
    found = _rest(_open(shared, star), pool, threshold)
    star = components(star.toDF("a", "b").union(found))
    return signed, star, salt


def _named(docs: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """doc_id, node, class_id, keeper (the node that stands for the class): a row for each of
    docs; and the salt of the nodes' hash."""
    signed, star, salt = _links(docs, threshold)
    known = signed.select("doc_id", "node").filter("doc_id is not null")
    nodes = known.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    rooted = cut(nodes.hint("merge").join(star, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("least"), F.count("*").alias("n"))
    of_node = _looked_up(rooted.select("root", "node", F.col("n").alias("rows")), least, "root").select("node", "least", F.col("rows").alias("n"))
    found = _looked_up(known, cut(of_node), "node")
    out = found.select("doc_id", "node", F.col("least.doc_id").alias("class_id"), F.col("least.node").alias("keeper"))
    none = F.lit(None).cast("long")
    return out.union(signed.filter("doc_id is null").select("doc_id", "node", none, none)), salt


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows with the column `least` of the table (key, least, n), whose n tells how many of the rows
    have the key. Keys that stand in one of FREQUENT rows or more, which are FREQUENT at most, are
    broadcast; the others go by a shuffle."""
    total = table.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * FREQUENT >= total
    joined = rows.join(F.broadcast(table.filter(often).select(key, F.col("least").alias("often"))), key, "left")
    few = joined.filter("often is null").drop("often").hint("merge").join(table.filter(~often).select(key, "least"), key)
    return joined.filter("often is not null").withColumnRenamed("often", "least").unionByName(few)


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the smallest id of its class): a row for each row of docs."""
    return _named(docs, threshold)[0].select("doc_id", "class_id")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one document of each class (the smallest id), all columns as they are; rows
    without an id stay."""
    named, salt = _named(docs, threshold)
    named = cut(named.filter("doc_id is not null"))
    node = _node(F.sha2(F.coalesce("text", F.lit("")), 256), salt)
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), node.alias("node"))
    gone = named.filter("doc_id != class_id or node != keeper").select("doc_id", "node").distinct()
    out = packed.hint("merge").join(gone, ["doc_id", "node"], "left_anti")
    repeated = named.groupBy("doc_id", "node").count().filter("count > 1")
    if not repeated.isEmpty():
        out = out.filter("doc_id is not null").dropDuplicates(["doc_id", "node"]).unionByName(out.filter("doc_id is null"))
    return out.select("row.*")
