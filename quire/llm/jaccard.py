"""N-gram Jaccard join with count-vector R-trees.

A document's set is its distinct shingles; equal sets are one class from the start. Two classes are compared if they
share a token: one of TOKENS values, each the smallest of a set's shingles in an order of its own. A pair at the
threshold t fails to share any with probability (1 - t) ** TOKENS, 4e-15 at 0.75, and less above. The classes of a token
are a block. Shingles are hashed to groups, and a class is the point of its group counts: as many groups as a power of
two needs to reach half of the set's size, so that long sets' counts stay small. A block's points, folded to COARSE
groups, stand in an R-tree. The overlap of two sets is at most the sum of the smaller counts, group by group; of a node,
with its largest counts. Pairs that pass the tree's bound are bounded again by the finer of the groups that both have.
Only pairs that may reach t by both bounds survive, and only they are verified, on whole sets.

Blocks hold unrelated documents that share a common line, or large groups of near copies. The bounds drop the former.
For the latter, blocks of more than SMALL classes first compare each member to a few pivots (the points nearest to the
block's median, and the smallest number; in blocks of the first STARS tokens), links are verified and components formed;
then all surviving pairs of different components are compared. So links within a component needn't all be listed, and
none between different ones is lost. A pair that shares several tokens is compared in the block of the first one only.
Blocks of more than CHUNK classes are dealt out by pairs of chunks, so no task holds more than two chunks.

Defined results: null texts and texts without words have empty sets and link with nothing; with fewer words than a
shingle the whole sequence is the one shingle; rows of equal id and different texts are documents of their own; a row
without an id links like any other, and is never named as a component (of rows without an id alone it is null).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quire.llm.common import LOWER, free, gram_hashes, lean, materialize, mix, slices, utf8, word_hashes, words
from quire.llm.links import components

TOKENS, COARSE, SMALL, CHUNK, PIVOTS, STARS, LEAF = 24, 64, 16, 4096, 3, 4, 32
#: Shingles in a chunk of sets, of which a task that verifies holds two: half a MB each, or one larger set.
TILE = 1 << 16
_rng = np.random.default_rng(20240229)
FLIP = _rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
ODD = _rng.integers(0, 1 << 62, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    low = LOWER[data]
    start, end, at = words(low, off)
    hashes = word_hashes(low, start, end)
    grams = gram_hashes(hashes, k)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(grams[a : b - k + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif b > a:
            yield gram_hashes(hashes[a:b], b - a) + np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def tokens(u: np.ndarray) -> np.ndarray:
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(u), 2000):
        np.minimum(least, ((u[i : i + 2000, None] ^ FLIP) * ODD).min(0), out=least)
    return mix(least + np.arange(TOKENS, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def point(u: np.ndarray) -> tuple[bytes, int]:
    """Group counts, two to a byte and each 15 at most, and the sum of what exceeds that. Groups go by the hashes' first bits."""
    bits = max(COARSE.bit_length(), ((len(u) + 1) // 2 - 1).bit_length())
    counts = np.bincount((u >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    held = np.minimum(counts, 15).astype(np.uint8)
    return (held[::2] | held[1::2] << 4).tobytes(), int(counts.sum() - held.sum(dtype=np.int64))


def folded(x: np.ndarray, groups: int) -> np.ndarray:
    """The counts of packed points (along the last axis) in fewer groups, or as many."""
    if 2 * x.shape[-1] == groups:
        return np.stack([x & 15, x >> 4], -1).reshape(*x.shape[:-1], groups).astype(np.int32)
    return ((x & 15).astype(np.int32) + (x >> 4)).reshape(*x.shape[:-1], groups, -1).sum(-1, dtype=np.int32)


def smaller(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Sums of the smaller counts of the packed points a (one a row) and p, in the groups that both have."""
    if a.shape[1] == len(p):
        return np.minimum(a & 15, p & 15).sum(1, dtype=np.int64) + np.minimum(a >> 4, p >> 4).sum(1, dtype=np.int64)
    groups = 2 * min(a.shape[1], len(p))
    return np.minimum(folded(a, groups), folded(p, groups)).sum(1, dtype=np.int64)


def sketches(docs: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
    """Columns uid (a hash of id and text), id, n (set size), digest (of the set; null: empty), tokens, point, slack."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, off = utf8(batch, 2)
            for a, b in slices(off):
                n, digest, sig, points, slack = [], [], [], [], []
                for u in shingle_sets(data[off[a] : off[b]], off[a : b + 1] - off[a], k):
                    n.append(len(u))
                    digest.append(hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None)
                    sig.append(tokens(u).view(np.int64) if len(u) else None)
                    p, s = point(u) if len(u) else (None, 0)
                    points.append(p)
                    slack.append(s)
                made = [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.list_(pa.int64())), pa.array(points, pa.binary()), pa.array(slack, pa.int64())]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:2]), *made], ["uid", "id", "n", "digest", "tokens", "point", "slack"])

    return numbered(docs, key, text).mapInArrow(lean(run), f"uid long, id {kind}, n long, digest binary, tokens array<long>, point binary, slack long")


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(uid_of(docs, key, text).alias("uid"), docs[key].alias("id"), docs[text].alias("text"))


def uid_of(docs: DataFrame, key: str, text: str):
    return F.xxhash64(docs[key], F.coalesce(docs[text], F.lit("")))


class Tree:
    """An R-tree of two levels over a block's points, packed by set size and then by the heaviest coordinates."""

    def __init__(self, n: np.ndarray, packed: list[bytes], slack: np.ndarray):
        self.at = [np.frombuffer(p, np.uint8) for p in packed]
        self.coarse = np.stack([folded(p, COARSE) for p in self.at])
        first = self.coarse[:, int(self.coarse.astype(np.float32).var(0).argmax())]
        self.order = np.lexsort((first, n))
        self.n, self.points, self.slack = n[self.order], self.coarse[self.order], slack[self.order]
        self.size = np.array([len(p) for p in self.at])
        edge = np.arange(0, len(n), LEAF)
        self.low, self.high = np.minimum.reduceat(self.n, edge), np.maximum.reduceat(self.n, edge)
        self.box = np.maximum.reduceat(self.points, edge, axis=0)
        self.loose = np.maximum.reduceat(self.slack, edge)

    def near(self, q: int, n: int, slack: int, num: int, den: int) -> np.ndarray:
        """Members that may reach num / den with member q, of size n: overlap bound * (num + den) >= num * (n + n')."""
        p = self.coarse[q]
        fits = (self.low * num <= n * den) & (n * num <= self.high * den)
        leaf = np.flatnonzero(fits)
        bound = np.minimum(self.box[leaf], p).sum(1, dtype=np.int64) + self.loose[leaf] + slack
        leaf = leaf[bound * (num + den) >= num * (n + self.low[leaf])]
        if not len(leaf):
            return leaf
        own = (leaf[:, None] * LEAF + np.arange(LEAF)).ravel()
        own = own[own < len(self.n)]
        bound = np.minimum(self.points[own], p).sum(1, dtype=np.int64) + self.slack[own] + slack
        return self.order[own[bound * (num + den) >= num * (n + self.n[own])]]

    def nearer(self, q: int, some: np.ndarray, n: np.ndarray, slack: np.ndarray, num: int, den: int) -> np.ndarray:
        """Those of some members that may reach num / den with member q by their own groups. n, slack: of all members."""
        bound, size = np.zeros(len(some), np.int64), self.size[some]
        for s in np.unique(size).tolist():
            of = np.flatnonzero(size == s)
            step = max(1, (1 << 22) // s)
            for i in range(0, len(of), step):
                part = of[i : i + step]
                bound[part] = smaller(np.stack([self.at[x] for x in some[part].tolist()]), self.at[q])
        return some[(bound + slack[some] + slack[q]) * (num + den) >= num * (n[q] + n[some])]


def pairs_in(block: dict, num: int, den: int, first: bool) -> Iterator[tuple[int, int]]:
    """Surviving pairs of a block's rows. first: pivots with the rest in large blocks of the first tokens, all pairs in small
    ones; else pairs of different components. All pairs are left to the block of their first common token."""
    n, slack, chunk, comp, sig = (block[k] for k in ("n", "slack", "chunk", "component", "tokens"))
    pivots = first and int(block["size"][0]) > SMALL
    if pivots and int(block["at"][0]) >= STARS or not first and (comp[0] == comp).all():
        return
    tree = Tree(n, block["point"], slack)
    rare = np.ones(len(n), bool)
    if pivots:
        far = np.abs(tree.coarse - np.median(tree.coarse, axis=0)).sum(1)
        queries = {*np.argsort(far, kind="stable")[:PIVOTS].tolist(), int(block["cls"].argmin())}
    else:
        if not first:  # one of each pair isn't of the most common component
            _, which, times = np.unique(comp, return_inverse=True, return_counts=True)
            rare = which != times.argmax()
        queries = np.flatnonzero(rare).tolist()
    split = chunk.min() != chunk.max()
    for q in queries:
        near = tree.near(q, int(n[q]), int(slack[q]), num, den)
        if pivots:
            near = near[near != q]
        else:
            near = near[(near > q) | ~rare[near]]
            near = near[comp[near] != comp[q]]
            if split:
                near = near[chunk[near] != chunk[q]]
            near = near[~(sig[near] == sig[q]).any(1)]
        for r in tree.nearer(q, near, n, slack, num, den).tolist():
            yield q, r


def blocks(batches, columns: list[str]) -> Iterator[dict]:
    """Runs of rows with equal token, at, i and j, across batches."""
    held: list[pa.RecordBatch] = []

    def made() -> dict:
        t = pa.Table.from_batches(held).combine_chunks()
        out = {c: t.column(c).to_numpy(zero_copy_only=False) for c in columns if c not in ("point", "tokens")}
        out["tokens"] = t.column("tokens").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) if out["at"][0] else np.zeros((t.num_rows, 0), np.int64)
        out["point"] = t.column("point").to_pylist()
        return out

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "at", "i", "j")])
        edge = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            now = tuple(key[:, a].tolist())
            if held and now != last:
                yield made()
                held.clear()
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield made()


def survivors(rows: DataFrame, points: DataFrame, num: int, den: int, first: bool) -> DataFrame:
    """Distinct pairs a < b that the blocks' bounds leave. rows: token, at (its number), i, j, chunk, size, cls, component."""
    whole = rows.join(points, "cls").withColumn("tokens", F.slice("tokens", 1, F.col("at")))  # the earlier tokens show which pairs were met before
    dealt = whole.repartition("token", "at", "i", "j").sortWithinPartitions("token", "at", "i", "j")
    columns = whole.columns

    def run(batches):
        a, b = [], []
        for block in blocks(batches, columns):
            ids = block["cls"]
            if len(ids) < 2:
                continue
            for q, r in pairs_in(block, num, den, first):
                x, y = int(ids[q]), int(ids[r])
                a.append(min(x, y))
                b.append(max(x, y))
                if len(a) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                    a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(lean(run), "a long, b long").distinct()


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """Pairs whose sets meet the threshold. Only the texts of classes in a pair are taken again.

    Pairs are dealt by the components that they form, and components of more than TILE shingles by pairs of chunks; a set
    travels once to each tile that has a pair of it, not with each pair, and a task holds two chunks of sets at most.
    """
    groups = components(pairs).withColumnRenamed("node", "cls").join(classes.select("cls", "n"), "cls")
    sizes = groups.groupBy("component").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("chunks"))
    placed = materialize(groups.join(sizes, "component").select("cls", "component", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int").alias("chunk")), "placed")
    tile = [F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")]
    asked = pairs.join(placed.select(F.col("cls").alias("a"), "component", F.col("chunk").alias("x")), "a").join(placed.select(F.col("cls").alias("b"), F.col("chunk").alias("y")), "b")
    asked = materialize(asked.select("component", *tile, "a", "b"), "asked")
    need = asked.select("component", "i", "j", F.explode(F.array("a", "b")).alias("cls")).distinct()
    own = texts.select("uid", "text").join(need.join(classes.select("cls", "uid", "digest"), "cls"), "uid").select("component", "i", "j", "cls", "digest", "text")

    def sets(batches):
        for batch in batches:
            data, off = utf8(batch, 5)
            want = batch.column(4)
            for a, b in slices(off):
                made = [u.tobytes() for u in shingle_sets(data[off[a] : off[b]], off[a : b + 1] - off[a], k)]
                ok = [a + x for x, u in enumerate(made) if hashlib.blake2b(u, digest_size=16).digest() == want[a + x].as_py()]  # a hash of id and text may meet another's
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(ok, pa.int64())) for c in batch.columns[:4]), pa.array([made[x - a] for x in ok], pa.binary())], ["component", "i", "j", "a", "shingles"])

    held = own.mapInArrow(lean(sets), "component long, i int, j int, a long, shingles binary").select("component", "i", "j", "a", F.lit(None).cast("long").alias("b"), "shingles")
    asked_rows = asked.select("component", "i", "j", "a", "b", F.lit(None).cast("binary").alias("shingles"))
    both = held.unionByName(asked_rows).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", F.asc_nulls_first("b"))

    def check(batches):
        now, found = None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(5)]
            raw, left, right = batch.column(5), [], []
            for n, (c, i, j, a, b) in enumerate(zip(*columns, strict=True)):
                if (c, i, j) != now:
                    now, found = (c, i, j), {}
                if b is None:
                    found[a] = np.frombuffer(raw[n].as_py(), np.uint64)
                else:
                    u, v = sorted((found[a], found[b]), key=len)
                    at = np.searchsorted(v, u)
                    common = int((v[np.minimum(at, len(v) - 1)] == u).sum())
                    if den * common >= num * (len(u) + len(v) - common):
                        left.append(a)
                        right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    links = materialize(both.mapInArrow(lean(check), "a long, b long").distinct(), "links")
    free(placed, asked)
    return links


def linked(docs: DataFrame, key: str, text: str, num: int, den: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (row, uid, id, n, digest), classes (digest, cls, n, and uid and id of the first row), and components of classes (node, component)."""
    drawn = materialize(sketches(docs, key, text, k).withColumn("row", F.monotonically_increasing_id()), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid", "row", "n")).alias("first")
    classes = drawn.where("digest is not null").groupBy("digest").agg(first)
    # written once, so that the numbers of rows and classes are the same wherever they are read
    classes = materialize(classes.select("digest", F.monotonically_increasing_id().alias("cls"), "first.id", "first.uid", "first.row", "first.n"), "classes")
    points = materialize(drawn.select("row", "n", "tokens", "point", "slack").join(classes.select("row", "cls"), "row").drop("row"), "points")
    # tokens travel without their points until it is known which are shared
    light = points.select("cls", F.posexplode("tokens").alias("at", "token"))
    sizes = light.groupBy("token", "at").agg(F.count("*").alias("size")).where("size > 1")
    rows = light.join(sizes, ["token", "at"]).withColumn("chunks", F.ceil(F.col("size") / CHUNK).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("token", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "at", "size", "cls")
    rows = materialize(rows, "blocks")
    texts = numbered(docs, key, text)
    starred = rows.where((F.col("size") <= SMALL) | (F.col("at") < STARS)).withColumn("component", F.col("cls"))
    near = materialize(survivors(starred, points, num, den, True), "pairs")
    links = verified(near, classes, texts, num, den, k)
    labels = components(links)
    large = rows.where(F.col("size") > SMALL).join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    second = materialize(survivors(large, points, num, den, False).join(near, ["a", "b"], "left_anti"), "pairs")
    if second.limit(1).count():
        more = verified(second, classes, texts, num, den, k)
        wider = components(links.union(more))
        free(labels, more)
        labels = wider
    free(points, rows, near, second, links)
    return drawn.select("row", "uid", "id", "n", "digest"), classes, labels


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = 75, den: int = 100, k: int = 5) -> DataFrame:
    """Columns key, n_shingles, component_id: the smallest id that links of Jaccard >= num / den lead to. A row a document."""
    drawn, classes, labels = linked(docs, key, text, num, den, k)
    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = classes.select("digest", "cls", "id").join(named.select("cls", "component").join(least, "component").drop("component"), "cls", "left")
    named = named.select("digest", F.coalesce("component_id", "id").alias("component_id"))
    out = drawn.select("id", "n", "digest").join(named, "digest", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = 75, den: int = 100, k: int = 5) -> DataFrame:
    """One document of each component: the one of the smallest id; one without an id only where no other is.

    Of rows of equal id and text one stays; documents without words stay.
    """
    drawn, classes, labels = linked(docs, key, text, num, den, k)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("first")
    of_linked = classes.join(labels.withColumnRenamed("node", "cls"), "cls").groupBy("component").agg(first).select("first.uid")
    alone = classes.join(labels.select(F.col("node").alias("cls")), "cls", "left_anti").select("uid")
    keep = of_linked.union(alone).union(drawn.where("digest is null").select("uid"))
    repeated = drawn.groupBy("uid").agg(F.count("*").alias("times")).where("times > 1").select("uid")
    keep = materialize(keep.distinct().join(repeated.withColumn("repeated", F.lit(True)), "uid", "left").select(F.col("uid").alias("__keep"), F.coalesce("repeated", F.lit(False)).alias("__repeated")), "kept")
    whole = docs.withColumn("__uid", uid_of(docs, key, text))
    some = lambda once: whole.join(keep.where(F.col("__repeated") != once), F.col("__uid") == F.col("__keep"), "left_semi")
    return some(True).drop("__uid").unionByName(some(False).dropDuplicates(["__uid"]).drop("__uid"))
