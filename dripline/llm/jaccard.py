"""N-gram Jaccard join by token-combination prefixes.

A document is its set of distinct 5-word shingles (64-bit hashes). Two documents link when
``100 * |x & y| >= 75 * |x | y|``. All links between different sets are found:

* Documents with equal sets share one node, the least doc_id of them.
* Shingles in many documents are *frequent*. Every set is ordered rare ones first, then by
  hash. A set of n may lack at most ``n // 4`` of its shingles in a partner, so when that many
  and one more are rare, that rare prefix is indexed by single shingles.
* Otherwise the prefix is extended into the frequent class, which is indexed by pairs of
  neighbours in the order. Dropping a shingle breaks two pairs, a foreign one between breaks
  one; with r rare shingles the first ``n // 2 - 2r + 2`` frequent ones keep a pair whole.
* In a large group each node is first compared with the group's least one; while a group holds
  several components, it is compared with some more by seeded choice; then the pairs across the
  components that are left. Pairs inside a component can't change the result.
* A pair is first compared by bitmaps: each shingle flips one bit, so two sets differ by at
  least as many shingles as bits. What may still link is verified on whole texts.

Rare shingles travel as packed arrays, so a group of them is bounded by the frequency limit.
Pairs of frequent shingles are rows and Spark splits their skewed joins. A task sends one node
for equal sets that it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.llm.common import land, map_rows, mix, rows, texts, word_hashes, words
from dripline.llm.components import components

WIDTH = 5
#: Shingles in at least so many documents are frequent; raised so that at most FREQUENT_MOST are.
FREQUENT_LEAST, FREQUENT_MOST = 100, 1 << 20
#: A chunk of so many shingles reports those it holds at least so often.
CHUNK, SEEN = 1_000_000, 4
#: Groups up to this size give all their pairs at once.
SMALL_GROUP = 6
#: Rounds in which large groups that hold several components get another centre.
ROUNDS = 1
#: Members of a group that meet in one block.
MEMBERS = 2000
#: Signatures that one bucket of the index is to hold.
BUCKET = 1_000_000
#: Entries of a bucket that are sorted and paired at once; rows that a task builds at once from what it holds.
PIECE, ROWS = 1 << 18, 1 << 16
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
#: Bits of a set's bitmap for each of its shingles at least, in the long and in the brief form, and of any bitmap.
BITS, BRIEF, LEAST_BITS = 4, 1, 2048
ENTRY = np.dtype([("sig", "<u8"), ("node", "<i8"), ("n", "<i4")])


def shingle_set(found: list[bytes], memo) -> np.ndarray:
    """Sorted distinct shingle hashes of a word list; fewer than five words make one shingle."""
    if not found:
        return np.empty(0, np.uint64)
    h = np.frombuffer(memo.joined(found), "<u8")
    width = min(WIDTH, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        total += h[k : len(h) - width + 1 + k] * _C[k]
        total = total * _C[4] ^ (total >> np.uint64(29))
    return np.unique(mix(total))


def _profiles(docs: DataFrame) -> DataFrame:
    """Per document its set's size and digest; in rows of their own, what chunks hold often."""

    def make():
        from hashlib import blake2b

        memo, held, count = word_hashes(), [], 0

        def often() -> pa.RecordBatch:
            tokens, times = np.unique(np.concatenate(held), return_counts=True)
            many = times >= SEEN
            pairs = np.stack([tokens[many].view(np.int64), times[many]]).astype("<i8")
            return rows(
                doc_id=pa.array([None], pa.int64()),
                n=pa.array([0], pa.int64()),
                digest=pa.array([None], pa.binary()),
                often=pa.array([pairs.tobytes()], pa.binary()),
            )

        def step(batch):
            nonlocal count
            if batch is None:
                if held:
                    yield often()
                return
            sizes, digests = [], []
            for text in texts(batch):
                s = shingle_set(words(text), memo)
                sizes.append(len(s))
                digests.append(blake2b(s.tobytes(), digest_size=16).digest())
                if len(s) > 2:
                    held.append(s)
                    count += len(s)
            yield rows(
                doc_id=batch.column("doc_id").cast(pa.int64()),
                n=pa.array(sizes, pa.int64()),
                digest=pa.array(digests, pa.binary()),
                often=pa.nulls(len(sizes), pa.binary()),
            )
            if count >= CHUNK:
                yield often()
                held.clear()
                count = 0

        return step

    return map_rows(docs, make, "doc_id long, n long, digest binary, often binary", last=True)


def _frequent(profiles: DataFrame) -> np.ndarray:
    """Sorted frequent shingles; by the limit's arithmetic at most FREQUENT_MOST."""

    def make():
        def step(batch):
            for blob in batch.column("often").to_pylist():
                tokens, times = np.frombuffer(blob, "<i8").reshape(2, -1)
                yield rows(token=pa.array(tokens), times=pa.array(times))

        return step

    counts = land(
        map_rows(profiles.where("often is not null").select("often"), make, "token long, times long")
        .groupBy("token")
        .agg(F.sum("times").alias("times")),
        "often",
    )
    total = counts.agg(F.sum("times")).first()[0] or 0
    limit = max(FREQUENT_LEAST, -(-total // FREQUENT_MOST))
    found = counts.where(F.col("times") >= limit).select("token").toArrow()
    return np.sort(found.column(0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def prefix(s: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single signatures of the rare prefix, and pair signatures of the extended one."""
    n, none = len(s), np.empty(0, np.uint64)
    if n < 3:
        return none, none
    at = np.searchsorted(frequent, s)
    common = np.zeros(n, bool)
    inside = at < len(frequent)
    common[inside] = frequent[at[inside]] == s[inside]
    rare = s[~common]
    if len(rare) > n // 4:
        return rare[: n // 4 + 1], none
    f = s[common][: n // 2 - 2 * len(rare) + 2]
    return rare, mix(f[:-1] * _C[0] + f[1:])


def bitmap(s: np.ndarray, each: int = BITS) -> bytes:
    """Parity of the shingles by the low bits of their hash; as many bits as the size asks for."""
    bits = max(LEAST_BITS, 1 << (each * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ; the longer one is folded to the other's length."""
    a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    size = min(len(a), len(b))
    for_each = lambda v: np.bitwise_xor.reduce(v.reshape(-1, size), axis=0)
    return int(np.bitwise_count(for_each(a) ^ for_each(b)).sum())


SENT = "bucket long, data binary, sig long, node long, other long, n long, bits binary, brief binary"


def _sent(size: int, **columns) -> pa.RecordBatch:
    kinds = {"bucket": pa.int64(), "data": pa.binary(), "sig": pa.int64(), "node": pa.int64(), "other": pa.int64(), "n": pa.int64(), "bits": pa.binary(), "brief": pa.binary()}
    return rows(**{c: pa.array(columns[c], k) if c in columns else pa.nulls(size, k) for c, k in kinds.items()})


def _signatures(docs: DataFrame, frequent, buckets: int) -> DataFrame:
    """Packed single signatures by bucket; as rows pair signatures, and the bitmaps of nodes."""

    def make():
        from hashlib import blake2b

        memo, common = word_hashes(), frequent.value
        held: dict[bytes, list] = {}
        count = 0

        def out():
            nodes, sets = [h[0] for h in held.values()], [h[1] for h in held.values()]
            size = np.array([len(s) for s in sets], np.int64)
            singles = []
            for a, b in _runs(size, ROWS):
                some, of = sets[a:b], np.array(nodes[a:b], np.int64)
                yield _sent(b - a, bucket=(mix(of) & np.uint64(0x3FFFFFFF)).view(np.int64), node=of, n=size[a:b], bits=[bitmap(s) for s in some], brief=[bitmap(s, BRIEF) for s in some])
                found = [prefix(s, common) for s in some]
                sig, per = np.concatenate([f[1] for f in found]), [len(f[1]) for f in found]
                if len(sig):
                    yield _sent(len(sig), bucket=sig.view(np.int64) & 0x3FFFFFFF, sig=sig.view(np.int64), node=np.repeat(of, per), n=np.repeat(size[a:b], per))
                sig, per = np.concatenate([f[0] for f in found]), [len(f[0]) for f in found]
                singles.append(e := np.empty(len(sig), ENTRY))
                e["sig"], e["node"], e["n"] = sig, np.repeat(of, per), np.repeat(size[a:b], per)
            held.clear()
            sets.clear()
            e = np.concatenate(singles)
            singles.clear()
            if len(e):
                bucket = (e["sig"] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                e, bucket = e[order], bucket[order]
                starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                ends = np.r_[starts[1:], len(e)]
                yield _sent(len(starts), bucket=bucket[starts], data=[e[a:b].tobytes() for a, b in zip(starts, ends)])

        def step(batch):
            nonlocal count
            if batch is None:
                if held:
                    yield from out()
                return
            for text, doc in zip(texts(batch), batch.column("doc_id").to_pylist()):
                s = shingle_set(words(text), memo)
                if len(s) < 3:
                    continue
                one = held.setdefault(blake2b(s.tobytes(), digest_size=16).digest(), [doc, s])
                one[0] = min(one[0], doc)
                count += len(s)
                if count >= 2 * CHUNK:
                    yield from out()
                    count = 0

        return step

    return map_rows(docs.where("doc_id is not null"), make, SENT, last=True)


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """First and last place (exclusive) of runs that add up to about that much, one at least."""
    ends = np.flatnonzero(np.diff(np.cumsum(sizes) // most, append=-1)) + 1
    return zip([0, *ends[:-1].tolist()], ends.tolist())


def _near_sizes(n, m):
    """Sizes that allow a similarity of 0.75."""
    return (4 * n >= 3 * m) & (4 * m >= 3 * n)


def _groups(signatures: DataFrame, buckets: int) -> DataFrame:
    """Nodes that share a single signature: pairs of small groups, members of large ones.

    Pair signatures and bitmaps pass through.
    """

    def make():
        blobs: dict[int, list[bytes]] = {}

        def one(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
            e = np.frombuffer(b"".join(parts), ENTRY)
            parts.clear()
            pieces = len(e) // PIECE + 1
            # Entries with one signature share a piece: a bucket holds one remainder by ``buckets``.
            piece = (e["sig"] // np.uint64(buckets) % np.uint64(pieces)).astype(np.int32)
            for k in range(pieces):
                if len(some := e[piece == k]):
                    yield from among(some)

        def among(e: np.ndarray) -> Iterator[pa.RecordBatch]:
            e = e[np.lexsort((e["node"], e["sig"]))]
            fresh = np.r_[True, (e["sig"][1:] != e["sig"][:-1]) | (e["node"][1:] != e["node"][:-1])]
            e = e[fresh]
            starts = np.flatnonzero(np.r_[True, e["sig"][1:] != e["sig"][:-1]])
            size = np.diff(np.r_[starts, len(e)])
            own = np.repeat(size, size)
            few = e[(own > 1) & (own <= SMALL_GROUP)]
            nodes, at = np.unique(few["node"], return_inverse=True)
            pairs = np.empty(0, np.int64)  # both ends' places among the nodes, as one number
            for gap in range(1, SMALL_GROUP):
                i = np.flatnonzero(few["sig"][gap:] == few["sig"][:-gap])
                i = i[_near_sizes(few["n"][i].astype(np.int64), few["n"][i + gap].astype(np.int64))]
                pairs = np.union1d(pairs, at[i] * len(nodes) + at[i + gap])
            for part in np.array_split(pairs, -(-len(pairs) // ROWS)) if len(pairs) else ():
                a, b = np.divmod(part, len(nodes))
                yield _sent(len(part), node=nodes[a], other=nodes[b])
            large = e[own > SMALL_GROUP]
            for k in range(0, len(large), ROWS):
                part = large[k : k + ROWS]
                yield _sent(len(part), sig=part["sig"].view(np.int64), node=part["node"].copy(), n=part["n"].astype(np.int64))

        def step(batch):
            if batch is None:
                while blobs:
                    yield from one(blobs.popitem()[1])
                return
            packed = batch.column("data").is_valid()
            part = batch.filter(packed)
            for bucket, data in zip(*(part.column(c).to_pylist() for c in ("bucket", "data"))):
                blobs.setdefault(bucket, []).append(data)
            yield batch.filter(pa.compute.invert(packed))

        return step

    # A task takes one bucket of packed signatures; by a hash it would now and then be several.
    dealt = signatures.repartitionById(buckets, F.pmod("bucket", F.lit(buckets)).cast("int"))
    return map_rows(dealt, make, SENT, last=True).drop("bucket", "data")


def _plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose bitmaps allow the similarity: at most a seventh of both sizes may differ."""

    def make():
        def step(batch):
            if not batch.num_rows:
                return
            apart = np.array([bits_apart(x, y) for x, y in zip(*(batch.column(c).to_pylist() for c in ("xa", "xb")))])
            sizes = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(7 * apart <= sizes))

        return step

    of = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias("n" + c), F.col("bits").alias("x" + c))
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "na", "nb", "xa", "xb")
    return map_rows(both, make, "a long, b long")


def _folded(bits: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Bitmaps by length in words: their places in the list, and the bitmaps as a matrix."""
    sizes = np.array([len(b) // 8 for b in bits])
    return {
        int(w): (at := np.flatnonzero(sizes == w), np.frombuffer(b"".join(bits[k] for k in at), "<u8").reshape(len(at), -1))
        for w in np.unique(sizes)
    }


def likely_pairs(node, n, of, bits, side) -> Iterator[np.ndarray]:
    """Pairs of different components whose bitmaps allow the similarity, among rows of one group.

    ``side`` is 0, 1 or 2 (both): only pairs of a row of side 0 and one of side 1 are compared.
    Most pairs of a block may be likely, so they are given in parts of about ROWS.
    """
    out, count, by = [], 0, _folded(bits)
    for w, (at, x) in by.items():
        for v in (w, 2 * w):
            if v not in by:
                continue
            to, y = by[v]
            y = np.bitwise_xor.reduce(y.reshape(len(y), -1, w), axis=1)
            for k in range(len(at)):
                i = at[k]
                meet = (of[to] != of[i]) & _near_sizes(n[to], n[i]) & ((side[to] != side[i]) | (side[i] == 2))
                meet &= node[to] > node[i] if v == w else True
                j = np.flatnonzero(meet)
                if len(j):
                    apart = np.bitwise_count(y[j] ^ x[k]).sum(1).astype(np.int64)
                    j = to[j[7 * apart <= n[to[j]] + n[i]]]
                    out.append(np.stack([np.minimum(node[j], node[i]), np.maximum(node[j], node[i])], 1))
                    count += len(j)
                    if count >= ROWS:
                        yield np.concatenate(out)
                        out, count = [], 0
    if count:
        yield np.concatenate(out)


def _within_groups(rest: DataFrame, nodes: DataFrame) -> DataFrame:
    """Likely pairs across the components of each group, compared block by block.

    Near copies meet in a group for each signature that they share; a task sends a pair once.
    """
    count = rest.groupBy("sig").agg(((F.count("*") - 1) / MEMBERS).cast("int").alias("more"))
    own = F.pmod(F.xxhash64("node"), F.col("more") + 1).cast("int")
    dealt = rest.join(nodes.select("node", "brief"), "node").join(count, "sig").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), "more"))).select(
        "sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "n", "of", "brief",
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).cast("long").alias("side"),
    )
    # A block of the pair (i, j) with i < j holds the members of i as side 0 and of j as side 1.
    key = ["sig", "i", "j"]

    def make():
        held: list[pa.Table] = []
        sent: set[tuple[int, int]] = set()

        def pairs(group: pa.Table) -> Iterator[pa.RecordBatch]:
            node, n, of, side = (group.column(c).to_numpy() for c in ("node", "n", "of", "side"))
            for found in likely_pairs(node, n, of, group.column("brief").to_pylist(), side):
                fresh = [pair for pair in map(tuple, found.tolist()) if pair not in sent]
                if len(sent) > ROWS:
                    sent.clear()  # what is sent again is dropped later
                sent.update(fresh)
                if fresh:
                    yield rows(**dict(zip("ab", map(pa.array, zip(*fresh)))))

        def step(batch):
            if batch is not None:
                held.append(pa.Table.from_batches([batch]))
            if not held:
                return
            all_ = pa.concat_tables(held).combine_chunks()
            k = np.stack([all_.column(c).to_numpy() for c in key], 1)
            edges = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)])
            ends = np.r_[edges[1:], len(k)]
            held.clear()
            if batch is not None:  # the last group may go on in the next batch
                held.append(all_.slice(int(edges[-1])))
                edges, ends = edges[:-1], ends[:-1]
            for a, b in zip(edges, ends):
                yield from pairs(all_.slice(int(a), int(b - a)))

        return step

    return map_rows(dealt.repartition(*key).sortWithinPartitions(*key), make, "a long, b long", last=True).distinct()


def _verified(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose whole texts reach the similarity, compared as exact sets."""

    def make():
        memo, kept = word_hashes(), {}

        def of(node: int, text: str) -> np.ndarray:
            if node not in kept:
                kept.clear()  # rows come sorted by this node
                kept[node] = shingle_set(words(text), memo)
            return kept[node]

        def step(batch):
            good = []
            for a, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "ta", "tb"))):
                s, t = of(a, x), shingle_set(words(y), memo)
                at = np.minimum(np.searchsorted(s, t), len(s) - 1)
                both = int((s[at] == t).sum()) if len(s) else 0
                good.append(100 * both >= 75 * (len(s) + len(t) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        return step

    of = lambda c: found.select(F.col("doc_id").alias(c), F.col("text").alias("t" + c))
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "ta", "tb")
    return map_rows(both, make, "a long, b long")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``doc_id, text``.

    A null or blank text has no shingles, links with nothing and is a class of its own, also
    beside other blank ones. Rows with a null doc_id keep a null component. A doc_id given
    twice with one text gives two equal rows. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = land(_profiles(docs), "profiles")
    total = profiles.agg(F.sum("n")).first()[0] or 0
    found = _frequent(profiles) if total else np.empty(0, np.uint64)
    own = profiles.where("often is null").select("doc_id", "n", "digest")
    sets = land(own.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("node"), F.max("n").alias("n")), "sets")
    alias = land(
        own.where("n > 2").join(sets.select("digest", "node"), "digest").where("doc_id <> node")
        .select(F.col("doc_id").alias("copy"), F.col("node").alias("least")).distinct(),
        "copies",
    )

    def least(df: DataFrame, column: str) -> DataFrame:
        """Replace a node by the least document with the same set."""
        named = df.join(alias.withColumnRenamed("copy", column), column, "left")
        return named.withColumn(column, F.coalesce("least", column)).drop("least")

    buckets = int(max(32, total // 4 // BUCKET))
    shared = docs.sparkSession.sparkContext.broadcast(found)
    groups = land(_groups(_signatures(docs, shared, buckets), buckets), "groups")
    nodes = groups.where("bits is not null").select("node", "n", "bits", "brief").dropDuplicates(["node"])
    large = land(least(groups.where("sig is not null").select("sig", "node", "n"), "node").distinct(), "large")
    pairs = groups.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    centre = large.groupBy("sig").agg(
        F.min_by(F.struct("node", "n"), "node").alias("c"), F.count("*").alias("size")
    ).where("size > 1").select("sig", F.col("c.node").alias("a"), F.col("c.n").alias("m"))
    stars = large.join(centre, "sig").where("node <> a").where(_near_sizes(F.col("n"), F.col("m")))
    met = least(least(pairs.distinct(), "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    first = land(met.union(stars.select("a", F.col("node").alias("b"))).distinct(), "pairs")
    seen = land(_plausible(first, nodes), "likely")

    def linked(likely: DataFrame) -> DataFrame:
        ends = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
        return land(_verified(likely, land(docs.join(ends, "doc_id", "left_semi"), "texts")), "verified")

    def split(labels: DataFrame) -> DataFrame:
        """Members of the groups that hold several components, with their component."""
        named = large.join(labels, "node", "left").withColumn("of", F.coalesce("component", "node")).drop("component")
        several = named.groupBy("sig").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo < hi")
        return land(named.join(several.select("sig"), "sig", "left_semi").select("sig", "node", "n", "of"), "split")

    def centred(rest: DataFrame, k: int) -> DataFrame:
        """Likely pairs of a group's chosen member with those of other components."""
        other = rest.select("sig", F.col("node").alias("a"), F.col("n").alias("m"), F.col("of").alias("to"))
        chosen = other.groupBy("sig").agg(F.min_by(F.struct("a", "m", "to"), F.xxhash64(F.lit(k), "sig", "a")).alias("c"))
        met = rest.join(chosen.select("sig", "c.*"), "sig").where("of <> to").where(_near_sizes(F.col("n"), F.col("m")))
        pairs = met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        return _plausible(pairs.join(seen, ["a", "b"], "left_anti"), nodes)

    links = linked(seen)
    labels = land(components(links), "labels")
    rest = split(labels)
    for k in range(ROUNDS + 1):
        if rest.isEmpty():
            break
        likely = land(centred(rest, k) if k < ROUNDS else _plausible(_within_groups(rest, nodes).join(seen, ["a", "b"], "left_anti"), nodes), "likely")
        more = linked(likely)
        seen = seen.union(likely)
        if not more.isEmpty():
            links = links.union(more)
            labels = land(components(links), "labels")
            rest = split(labels)
    classes = sets.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("class"))
    return own.join(classes, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("doc_id")).alias("component_id"),
    )
