"""Removal of repeated 100-byte strings by bucket-pointer refinement of a sparse suffix table.

Every byte covered by a string of LENGTH bytes that also starts earlier goes. Suffixes are not
all sorted: each LENGTH-byte string is represented by an *anchor*, the place of the least
hash among its Q-grams (leftmost of equals). Equal strings have their anchors at the same
place inside, so their anchors fall into the same Q-gram bucket.

1. Anchors are bucketed by their Q-gram. An anchor *owns* a run of starts; anchors of a bucket
   that agree on all bytes they own (64 bits beside the bucket's 48) are copies, and all but the first are removed.
2. Buckets with different surroundings are refined: the starts they own get the bucket ids of
   q bytes, then of 2q from the ids at offsets i and i + q, then of 4q from those, reusing the
   ids of the last round. Starts with one final id (96 bits) are equal strings, and all but
   the first of them are removed.

A task keeps one entry of each (bucket, surroundings) it meets, so large groups of copies
shrink before the shuffle. A bucket that is mixed within one task is refined in any case; its
entries are dealt by surroundings, with two witnesses for other tasks, so a frequent Q-gram
does not gather in one task. Buckets have keys that deal each to a task of its own: Spark sends
a task's rows to Python in one batch, held several times over, so several buckets cost memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.llm.common import land, map_rows, mix, per_process, rows, texts

LENGTH, Q = 100, 36
WINDOW = LENGTH - Q + 1
#: Bytes of a text taken at a time, so that 16 bits hold a place; entries a task gathers; entries of a bucket.
SEGMENT, CHUNK, BUCKET = 48_000, 500_000, 400_000
ENTRY = np.dtype([("g", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("first", "<i4"), ("last", "<i4")])
COPY, MIXED = 0, 1
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_K = [np.uint64(c) for c in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0x94D049BB133111EB)]


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the first base and of its inverse, and a random value for each byte."""
    return per_process(("powers", SEGMENT), _new_powers)


def _new_powers():
    size, mask = SEGMENT + 2 * LENGTH, (1 << 64) - 1
    up = np.full(size, _BASES[0], np.uint64)
    down = np.full(size, pow(_BASES[0], -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down), mix(np.arange(256, dtype=np.uint64) * _K[0] + np.uint64(mask >> 3))


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, surroundings, first and last owned start of each anchor of one segment."""
    up, down, code = _powers()
    n = len(raw)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(code[raw] * up[:n], out=total[1:])
    gram = mix((total[Q:] - total[:-Q]) * down[: n - Q + 1])
    key = (gram >> np.uint64(16) << np.uint64(16)) | np.arange(len(gram), dtype=np.uint64)
    width, least = 1, key
    while width * 2 <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = WINDOW - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & np.uint64(0xFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    own = (total[last + LENGTH] - total[first]) * down[first]
    place = (at[first] - first) * 256 + last - first
    return gram[at[first]] >> np.uint64(16), mix(own * _K[1] + place.astype(np.uint64)), first, last


def final_ids(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two parts, of 64 and 32 bits, of the id of the LENGTH-byte string at each start of one segment."""
    up, down, code = _powers()
    n, q = len(raw), LENGTH // 4
    value = code[raw]
    out = []
    for lane in (0, 2):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((value if lane else value ^ _K[3]) * up[:n], out=total[1:])
        ids, width = mix((total[q:] - total[:-q]) * down[: n - q + 1]), q
        while width < LENGTH:
            ids = mix(ids[:-width] * _K[lane] + ids[width:] * _K[lane + 1])
            width *= 2
        out.append(ids)
    return out[0], out[1] >> np.uint64(32)


def _first_of_each(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries sorted by (g, c, place), and which is the first of its (g, c); equal rows go."""
    e = e[np.lexsort((e["first"], e["doc"], e["c"], e["g"]))]
    new = np.r_[True, (e["g"][1:] != e["g"][:-1]) | (e["c"][1:] != e["c"][:-1])]
    again = np.r_[False, ~new[1:] & (e["doc"][1:] == e["doc"][:-1]) & (e["first"][1:] == e["first"][:-1])]
    return e[~again], new[~again]


def _mixed(e: np.ndarray) -> np.ndarray:
    """Of entries sorted by (g, c): whether their g has more than one c."""
    starts = np.flatnonzero(np.r_[True, e["g"][1:] != e["g"][:-1]])
    ends = np.r_[starts[1:], len(e)]
    return np.repeat(e["c"][starts] != e["c"][ends - 1], ends - starts)


OUT = "bucket long, data binary, doc_id long, first long, last long, kind long"


def _marks(e: np.ndarray, kind: int) -> pa.RecordBatch:
    n = len(e)
    return rows(
        bucket=pa.array(mix(e["doc"]).view(np.int64) & 0x3FFFFFFF), data=pa.nulls(n, pa.binary()), doc_id=pa.array(e["doc"].copy()),
        first=pa.array(e["first"].astype(np.int64)), last=pa.array(e["last"].astype(np.int64)), kind=pa.array(np.full(n, kind, np.int64)),
    )


def _runs(e: np.ndarray) -> np.ndarray:
    """Owned starts of one document that touch or overlap as one entry; what they cover is the same."""
    if not len(e):
        return e
    e = e[np.lexsort((e["first"], e["doc"]))].copy()
    reach = np.maximum.accumulate(e["last"].astype(np.int64) + (np.unique(e["doc"], return_inverse=True)[1] << 33)) & 0x1FFFFFFFF
    new = np.r_[True, (e["doc"][1:] != e["doc"][:-1]) | (e["first"][1:] > reach[:-1] + LENGTH)]
    at = np.flatnonzero(new)
    out = e[at]
    out["last"] = reach[np.r_[at[1:], len(e)] - 1]
    return out


def pack(e: np.ndarray) -> bytes:
    """Entries by document and place, byte plane by byte plane: all but g and c nearly vanish when compressed."""
    e = e[np.lexsort((e["first"], e["doc"]))]
    e["last"] -= e["first"]
    return np.ascontiguousarray(e.view(np.uint8).reshape(len(e), ENTRY.itemsize).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    e = np.frombuffer(data, np.uint8).reshape(ENTRY.itemsize, -1).T.copy(order="C").view(ENTRY)[:, 0]
    e["last"] += e["first"]
    return e


def even_keys(spark: SparkSession, buckets: int) -> np.ndarray:
    """A key for each bucket; ``repartition`` to as many partitions deals each to one of its own.

    Only evenness hangs on it: the keys differ in any case.
    """
    at = F.pmod(F.hash("id"), F.lit(buckets)).alias("at")
    keys = -1 - np.arange(buckets)
    for r in spark.range(30 * buckets).select("id", at).groupBy("at").agg(F.min("id").alias("key")).collect():
        keys[r["at"]] = r["key"]
    return keys


def _packed(e: np.ndarray, bucket: np.ndarray, told: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket and whether its entries are told to be mixed."""
    key = bucket.astype(np.int64) * 2 + told
    order = np.argsort(key, kind="stable")
    e, key = e[order], key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    n = len(starts)
    return rows(
        bucket=pa.array(keys[key[starts] >> 1]),
        data=pa.array([pack(e[a:b]) for a, b in zip(starts, np.r_[starts[1:], len(e)])], pa.binary()),
        doc_id=pa.nulls(n, pa.int64()), first=pa.nulls(n, pa.int64()), last=pa.nulls(n, pa.int64()), kind=pa.array(key[starts] & 1),
    )


def _gathered(df: DataFrame, entries, keys: np.ndarray, refine: bool) -> DataFrame:
    """Entries of each batch, shrunk per task; copies within the task come out as marks.

    With ``refine`` g and c are the two halves of one final id, so no bucket is mixed.
    """
    buckets = len(keys)

    def make():
        held, count = [], 0

        def out():
            e = np.concatenate(held)
            held.clear()
            e, first = _first_of_each(e)
            if (~first).any():
                yield _marks(_runs(e[~first]), COPY)
            e = e[first]
            if refine:
                yield _packed(e, e["g"] % np.uint64(buckets), np.zeros(len(e), bool), keys)
                return
            many = _mixed(e)
            edge = many & (np.r_[True, e["g"][1:] != e["g"][:-1]] | np.r_[e["g"][1:] != e["g"][:-1], True])
            witness = e[edge].copy()
            witness["doc"] = -1
            witness["first"] = -1
            spread = np.where(many, mix(e["c"] ^ e["g"]), e["g"]) % np.uint64(buckets)
            bucket = np.r_[spread, witness["g"] % np.uint64(buckets)]
            yield _packed(np.r_[e, witness], bucket, np.r_[many, np.zeros(len(witness), bool)], keys)

        def step(batch):
            nonlocal count
            if batch is None:
                if held:
                    yield from out()
                return
            for e in entries(batch):
                held.append(e)
                count += len(e)
                if count >= CHUNK:
                    yield from out()
                    count = 0

        return step

    return map_rows(df, make, OUT, last=True)


def _reduced(gathered: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, first, last, kind``: owned starts that are copies, or that need refinement."""

    def make():
        blobs: dict[int, list[tuple[bytes, int]]] = {}

        def one(parts):
            found = [unpack(data) for data, _ in parts]
            told = np.repeat(np.array([kind == MIXED for _, kind in parts]), [len(f) for f in found])
            e = np.concatenate(found)
            order = np.lexsort((e["first"], e["doc"], e["c"], e["g"]))
            e, told = e[order], told[order]
            many = _mixed(e) | told
            real = e["first"] >= 0
            e, many = e[real], many[real]
            if not len(e):
                return
            new = np.r_[True, (e["g"][1:] != e["g"][:-1]) | (e["c"][1:] != e["c"][:-1])]
            lead = np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
            copy = (e["doc"] != e["doc"][lead]) | (e["first"] != e["first"][lead])
            for found, kind in ((_runs(e[copy]), COPY), (e[new & many], MIXED)):
                if len(found):
                    yield _marks(found, kind).select(["doc_id", "first", "last", "kind"])

        def step(batch):
            if batch is None:
                while blobs:
                    yield from one(blobs.popitem()[1])
                return
            for bucket, data, kind in zip(*(batch.column(c).to_pylist() for c in ("bucket", "data", "kind"))):
                if data is not None:
                    blobs.setdefault(bucket, []).append((data, kind))
            marks = batch.filter(batch.column("doc_id").is_valid())
            if marks.num_rows:
                yield marks.select(["doc_id", "first", "last", "kind"])

        return step

    return map_rows(gathered.repartition(buckets, "bucket"), make, "doc_id long, first long, last long, kind long", last=True)


def _anchor_entries(batch):
    for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        for k in range(0, len(raw) - LENGTH + 1, SEGMENT):
            g, c, first, last = anchors(raw[k : k + SEGMENT + LENGTH - 1])
            e = np.empty(len(g), ENTRY)
            e["g"], e["c"], e["doc"], e["first"], e["last"] = g, c, doc, first + k, last + k
            yield e


def _start_entries(batch):
    """Entries of the starts to refine. Pieces of many documents are joined, as they are short."""
    held: list[tuple[int, int, np.ndarray]] = []

    def entries():
        g, c = final_ids(np.concatenate([p for _, _, p in held]))
        size = np.array([len(p) for _, _, p in held])
        count = size - LENGTH + 1
        at = np.repeat(np.cumsum(size) - size, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        e = np.empty(len(at), ENTRY)
        e["g"], e["c"], e["doc"] = g[at], c[at], np.repeat(np.array([d for d, _, _ in held], np.int64), count)
        e["first"] = at - np.repeat(np.cumsum(size) - size, count) + np.repeat([f for _, f, _ in held], count)
        e["last"] = e["first"]
        held.clear()
        return e

    joined = 0
    for doc, text, runs in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("runs").to_pylist()):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        spans: list[list[int]] = []
        for first, last in sorted((r["first"], r["last"]) for r in runs):
            if spans and first == spans[-1][1] + 1:
                spans[-1][1] = last
            else:
                spans.append([first, last])
        for first, last in spans:
            for k in range(first, last + 1, SEGMENT // 2):
                piece = raw[k : min(last + 1, k + SEGMENT // 2) + LENGTH - 1]
                if len(piece) < LENGTH:
                    continue
                if joined + len(piece) > SEGMENT:
                    yield entries()
                    joined = 0
                held.append((doc, k, piece))
                joined += len(piece)
    if held:
        yield entries()


def _by_document(marks: DataFrame) -> DataFrame:
    return marks.groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def removed_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs``: starts (``first`` to ``last``) of strings that also start earlier."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(32, 2 * size // WINDOW // BUCKET))
    keys = even_keys(docs.sparkSession, buckets)
    marks = land(_reduced(_gathered(docs, _anchor_entries, keys, False), buckets), "marks")
    unclear = docs.join(_by_document(marks.where(F.col("kind") == MIXED)), "doc_id")
    starts = int(marks.where(F.col("kind") == MIXED).agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] or 0)
    buckets = max(32, starts // BUCKET)
    keys = even_keys(docs.sparkSession, buckets)
    more = land(_reduced(_gathered(unclear, _start_entries, keys, True), buckets), "starts")
    return _by_document(marks.where(F.col("kind") == COPY).union(more.where(F.col("kind") == COPY)))


def covered(runs, size: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for a, b in sorted((r["first"], r["last"] + LENGTH) for r in runs or []):
        b = min(b, size)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        elif a < b:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for each row of ``doc_id, text``.

    ``kept`` is the rest of the text's UTF-8 bytes; a cut may fall inside a character. A null
    text is empty. Rows with a null doc_id have no place in the order: they keep all bytes and
    count for no other row. Repeated rows of one doc_id with one text count as one document.
    """

    def make():
        def step(batch):
            out = []
            for text, runs in zip(texts(batch), batch.column("runs").to_pylist()):
                raw = (text or "").encode()
                cuts = covered(runs, len(raw))
                edges = [0, *(x for c in cuts for x in c), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(raw), len(raw) - len(kept), len(cuts), kept))
            size, gone, spans, kept = zip(*out) if out else ((), (), (), ())
            yield rows(
                doc_id=batch.column("doc_id"), n_bytes=pa.array(size, pa.int64()), n_removed=pa.array(gone, pa.int64()),
                n_spans=pa.array(spans, pa.int64()), kept=pa.array(kept, pa.binary()),
            )

        return step

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = own.join(removed_runs(own), "doc_id", "left")
    return map_rows(joined, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Sizes and spans of what goes, and the digest of what stays."""
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )



