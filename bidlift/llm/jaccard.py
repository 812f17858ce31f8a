"""Exact n-gram Jaccard join by a token-group matrix.

A document is the set of its distinct word shingles (64-bit hashes); equal sets
are one class. Shingles are ordered by how often a fixed-size table of counters
saw them, rarest first. The prefix of a set of ``n`` is its first ``n - ceil(s * n) + l(n)``
shingles; two similar sets share as many of their prefixes' shingles as the
smaller ``l``, here a tenth of a set at 0.9. Only classes that share so many of
their prefix with others go on.

Similar classes form a group: each takes the prefix shingle that most classes
share, and such a list is cut into groups of about ``MEMBERS``. The matrix holds
each group's union of prefix shingles with the range of set sizes behind each.
A class queries every group of whose union, within the sizes that could be
similar, its prefix holds enough shingles, its own group among them. A task then gets one group: it builds
the union of the members' whole sets, bounds a query's overlap with the union,
and only if that reaches the least overlap opens the group, that is counts the
overlap with each member. A group with many queries is cut into blocks. A task
gives a spanning set of links and each query's number of links, never all pairs.
Components of the links are found by Spark joins.

Defined results: a text without words (or NULL) has the empty set, links with
nothing and is its own component; with fewer words than a shingle, its words are
one shingle. NULL ids do not name a component that has another id. Repeated rows
give a row each. No rows give no rows. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, unwrapped, whole_text, wrapped

WORDS, PERCENT = 3, 90
MEMBERS, QUERIES = 512, 2048
SLOTS, CHUNKS = 1 << 21, 32
PARTS = 256  # of the first level in which counters are added
U = np.uint64
MIX = U(0xD6E8FEB86659FD93)
MOST_WORDS = 400_000
_HASHES: dict[bytes, int] = {}


def _word_hash(word: bytes) -> int:
    if len(_HASHES) > MOST_WORDS:
        _HASHES.clear()
    return _HASHES.setdefault(word, xxhash.xxh3_64_intdigest(word))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * MIX
    return (x ^ (x >> U(29))) * MIX


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes. ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at the six ASCII spaces."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, U)
    codes = np.array([_HASHES.get(w) or _word_hash(w) for w in found], U)
    size = min(words, len(found))
    out = np.full(len(found) - size + 1, U(size), U)
    for k in range(size):
        out = _mixed(out + codes[k : len(codes) - size + 1 + k])
    return np.unique(out ^ (out >> U(32)))


def least_overlap(n, percent: int):
    """Of a set of n, what a similar set must share: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    """n - a + l: sets that share a or more shingles share l or more of so many first ones."""
    alpha = least_overlap(n, percent)
    return n - alpha + min(n - alpha + 1, alpha)


def needed(n: Column, percent: int) -> Column:
    """Shared prefix shingles that a set of n needs: l of the smallest set it could be similar to."""
    smallest = -F.floor(-(percent * n) / 100)
    alpha = -F.floor(-(percent * smallest) / 100)
    return F.least(smallest - alpha + 1, alpha)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, [shingles(t or "", words) for t in batch.column("text").to_pylist()]


def _class_id(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


PACKED = "bucket int, payload binary"
INDEX = "doc_id bigint, rk bigint, cid binary, n bigint"
COUNTED = f"{INDEX}, chunk int, part int, seen binary"


def index(docs: DataFrame, words: int) -> DataFrame:
    """In one pass, (doc_id, rk, cid, n), the class and set size of every row, and a task's table of counters.

    The counters are rows with a ``chunk``: how often the task's shingles fall
    into each slot of the chunk, compressed, under one of ``PARTS`` numbers.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in COUNTED.split(", ")]
        seen = np.zeros(SLOTS, np.int64)
        for batch, sets in _sets(batches, words):
            for s in sets:
                np.add.at(seen, (s & U(SLOTS - 1)).astype(np.int64), 1)
            size = len(sets)
            columns = [
                batch.column("doc_id"), batch.column("rk"), pa.array([_class_id(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
        part = TaskContext.get().partitionId() % PARTS
        data = [_counters_out(p) for p in seen.reshape(CHUNKS, -1)]
        none = [pa.nulls(CHUNKS, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array(range(CHUNKS), pa.int32()), pa.array([part] * CHUNKS, pa.int32()), pa.array(data, pa.binary())], names
        )

    return docs.mapInArrow(make, COUNTED)


def _counters_out(counts: np.ndarray) -> bytes:
    return zlib.compress(np.minimum(counts, (1 << 31) - 1).astype("<i4").tobytes(), 1)


def _counters_in(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<i4").astype(np.int64)


def counters(counted: DataFrame) -> np.ndarray:
    """How often each slot's shingles occur: a table of fixed size, added up in two levels, so that no group grows with the tasks alone."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SLOTS // CHUNKS, np.int64)
        for data in table.column("seen"):
            total += _counters_in(data.as_py())
        return pa.table({"chunk": table.column("chunk")[:1], "seen": pa.array([_counters_out(total)], pa.binary())})

    schema = "chunk int, seen binary"
    parts = counted.where(F.col("chunk").isNotNull()).select("chunk", "part", "seen")
    sums = parts.groupBy("chunk", "part").applyInArrow(add, schema).groupBy("chunk").applyInArrow(add, schema)
    out = np.zeros((CHUNKS, SLOTS // CHUNKS), np.int32)
    for r in sums.collect():  # CHUNKS rows, 4 * SLOTS bytes at most
        out[r["chunk"]] = _counters_in(r["seen"])
    return out.ravel()


def prefixes(docs: DataFrame, seen, words: int, percent: int, buckets: int) -> DataFrame:
    """Prefix shingles by bucket, packed: shingles and the number of the class in a table of (cid, n)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = seen.value
        for _, sets in _sets(batches, words):
            classes: dict[bytes, int] = {}
            tokens, owner, sizes = [], [], []
            for s in sets:
                cid = _class_id(s)
                if len(s) and cid not in classes:
                    classes[cid] = len(classes)
                    order = np.lexsort((s, count[(s & U(SLOTS - 1)).astype(np.int64)]))
                    first = s[order[: prefix_length(len(s), percent)]]
                    tokens.append(first)
                    owner.append(np.full(len(first), classes[cid], np.int64))
                    sizes.append(len(s))
            if not tokens:
                continue
            t, o = np.concatenate(tokens), np.concatenate(owner)
            cids = np.frombuffer(b"".join(classes), "S16")
            size = np.array(sizes, "<i8")
            to = ((t >> U(24)) % U(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            rows = []
            for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                own, at = np.unique(o[part], return_inverse=True)
                head = len(own).to_bytes(4, "little") + cids[own].tobytes() + size[own].tobytes()
                rows.append((int(to[part[0]]), head + t[part].astype("<u8").tobytes() + at.astype("<u2" if len(own) < 65536 else "<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows])], ["bucket", "payload"])

    return docs.select("text").mapInArrow(make, PACKED)


SHARED = "token bigint, cid binary, n bigint, listed bigint"


def shared_tokens(packed: DataFrame) -> DataFrame:
    """(token, cid, n, listed) of the prefix shingles that ``listed`` > 1 classes have."""

    def sort(table: pa.Table) -> pa.Table:
        tokens, cids, sizes = [], [], []
        for data in table.column("payload").to_pylist():
            c = int.from_bytes(data[:4], "little")
            width = 2 if c < 65536 else 4
            ids = np.frombuffer(data, "V16", c, 4)
            size = np.frombuffer(data, "<i8", c, 4 + 16 * c)
            k = (len(data) - 4 - 24 * c) // (8 + width)
            tokens.append(np.frombuffer(data, "<u8", k, 4 + 24 * c))
            at = np.frombuffer(data, f"<u{width}", k, 4 + 24 * c + 8 * k)
            cids.append(ids[at])
            sizes.append(size[at])
        t, c, n = np.concatenate(tokens), np.concatenate(cids), np.concatenate(sizes)
        # Most shingles stand alone; only the others are told apart by class.
        _, inverse, times = np.unique(t, return_inverse=True, return_counts=True)
        more = times[inverse] > 1
        t, c, n = t[more], c[more], n[more]
        halves = np.frombuffer(c.tobytes(), ">u8").reshape(-1, 2)
        order = np.lexsort((halves[:, 1], halves[:, 0], t))
        t, c, n, halves = t[order], c[order], n[order], halves[order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (halves[1:] != halves[:-1]).any(axis=1)
        t, c, n = t[new], c[new], n[new]
        _, inverse, times = np.unique(t, return_inverse=True, return_counts=True)
        listed = times[inverse] if len(t) else np.zeros(0, np.int64)
        some = listed > 1
        return pa.table({
            "token": pa.array(t[some].view(np.int64), pa.int64()), "cid": pa.array([x.tobytes() for x in c[some]], pa.binary()),
            "n": pa.array(n[some], pa.int64()), "listed": pa.array(listed[some], pa.int64()),
        })

    return packed.groupBy("bucket").applyInArrow(sort, SHARED)


def requests(shared: DataFrame, percent: int) -> DataFrame:
    """(cid, gt, gc, block, role): members (role 0) and queries (role 1) of every group, from the written table ``shared``."""
    most = F.max(F.struct("listed", F.col("token").alias("t")))
    own = shared.groupBy("cid").agg(most.alias("m"), F.first("n").alias("n"), F.count(F.lit(1)).alias("held"))
    chunks = F.ceil(F.col("m.listed") / MEMBERS)
    own = own.where(F.col("held") >= needed(F.col("n"), percent))
    own = materialize(own.select("cid", F.col("m.t").alias("gt"), F.pmod(F.xxhash64("cid"), chunks).alias("gc")), "own")
    placed = materialize(shared.drop("listed").join(own.hint("merge"), "cid"), "placed")
    matrix = placed.groupBy("token", "gt", "gc").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("members"))
    rows = placed.select("token", "cid", "n", F.col("gt").alias("ot"), F.col("gc").alias("oc")).join(matrix, "token")
    near = (100 * F.col("high") >= percent * F.col("n")) & (percent * F.col("low") <= 100 * F.col("n"))
    mine = (F.col("gt") == F.col("ot")) & (F.col("gc") == F.col("oc"))
    # A class's own shingles are in its own group's union; there another member must have them too.
    bound = rows.where(near & (~mine | (F.col("members") > 1))).groupBy("cid", "gt", "gc").agg(
        F.count(F.lit(1)).alias("met"), F.first("n").alias("n"), F.first(mine).alias("mine")
    )
    bound = materialize(bound.where(F.col("met") >= needed(F.col("n"), percent)).select("cid", "gt", "gc", "mine"), "bound")
    asks = bound.where(~F.col("mine"))
    blocks = asks.groupBy("gt", "gc").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("blocks"))
    # A group that others query needs all members; else those that may link within it.
    paired = own.join(bound.where("mine").select("cid", "mine"), "cid", "left").join(blocks, ["gt", "gc"], "left")
    members = paired.where(F.col("mine").isNotNull() | F.col("blocks").isNotNull()).select(
        "cid", "gt", "gc", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("blocks", F.lit(1).cast("bigint")) - 1)).alias("block"), F.lit(0).alias("role")
    )
    queries = asks.join(blocks, ["gt", "gc"]).select("cid", "gt", "gc", F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block"), F.lit(1).alias("role"))
    return members.unionByName(queries)


def class_sets(docs: DataFrame, active: DataFrame, words: int) -> DataFrame:
    """(cid, items): the sets of the rows ``active`` (doc_id, rk, cid) names. Always by a shuffle, as their number grows with the documents."""
    wanted = active.select(F.col("rk").alias("_rk"), "cid")
    texts = docs.join(wanted.hint("merge"), F.col("rk") == F.col("_rk")).select("cid", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, words):
            # Rows whose key collides with a wanted one are of another class.
            keep = [k for k, (s, c) in enumerate(zip(sets, batch.column("cid").to_pylist())) if _class_id(s) == c]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("cid")[k].as_py() for k in keep], pa.binary()), pa.array([sets[k].tobytes() for k in keep], pa.binary())], ["cid", "items"]
            )

    return texts.mapInArrow(make, "cid binary, items binary")


LINKS = "cid binary, root binary, links bigint"


def open_groups(asked: DataFrame, percent: int) -> DataFrame:
    """(cid, root, links) from rows (gt, gc, block, role, cid, items): a spanning set of links, and links counted per query."""

    def open_one(table: pa.Table) -> pa.Table:
        role = np.array(table.column("role").to_pylist())
        cids = table.column("cid").to_pylist()
        sets = [np.frombuffer(b, U) for b in table.column("items").to_pylist()]
        block = table.column("block")[0].as_py()
        members = list({cids[i]: i for i in np.flatnonzero(role == 0)}.values())
        queries = list({cids[i]: i for i in np.flatnonzero(role == 1)}.values())
        sizes = np.array([len(sets[i]) for i in members], np.int64)
        flat = np.concatenate([sets[i] for i in members]) if members else np.zeros(0, U)
        owner = np.repeat(np.arange(len(members)), sizes)
        order = np.argsort(flat, kind="stable")
        union, start, times = np.unique(flat[order], return_index=True, return_counts=True)
        owner = owner[order]
        label = np.arange(len(members))
        out: list[tuple] = []
        # The members ask their own group once, in its first block.
        asking = (list(enumerate(members)) if block == 0 else []) + [(None, i) for i in queries]
        for k, i in asking:
            mine = sets[i]
            at = np.searchsorted(union, mine)
            at = at[at < len(union)]
            at = at[union[at] == mine[: len(at)]] if len(at) else at
            if not len(union) or len(at) < least_overlap(len(mine), percent):
                continue
            size = times[at]
            ends = np.cumsum(size)
            posting = owner[np.repeat(start[at] - (ends - size), size) + np.arange(ends[-1])]
            overlap = np.bincount(posting, minlength=len(members))
            linked = 100 * overlap >= percent * (sizes + len(mine) - overlap)
            if k is not None:
                linked[k] = False
            met = np.flatnonzero(linked)
            if not len(met):
                continue
            groups = np.unique(label[met]) if k is None else np.unique(np.append(label[met], label[k]))
            label[np.isin(label, groups)] = groups[0]
            out.append((cids[i], cids[members[groups[0]]], len(met)))
        for k in range(len(members)):
            if label[k] != k:
                out.append((cids[members[k]], cids[members[label[k]]], 0))
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"cid": pa.array(columns[0], pa.binary()), "root": pa.array(columns[1], pa.binary()), "links": pa.array(columns[2], pa.int64())})

    return asked.groupBy("gt", "gc", "block").applyInArrow(open_one, LINKS)


def components(links: DataFrame) -> DataFrame:
    """(cid, label): the least class id that the written links (cid, root) reach, by label passing and pointer jumping."""
    pairs = links.where("cid <> root").select("cid", "root")
    both = materialize(pairs.union(pairs.select("root", "cid")).toDF("u", "v").distinct(), "edges")
    labels = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    while True:
        told = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("near")), "v").groupBy("u").agg(F.min("near").alias("near"))
        new = labels.join(told, "u").select("u", "label", F.least("label", "near").alias("best"))
        jump = labels.select(F.col("u").alias("best"), F.col("label").alias("far"))
        new = new.join(jump, "best").select("u", F.least("best", "far").alias("next"), (F.least("best", "far") != F.col("label")).alias("moved"))
        new = materialize(new, "labels")
        labels = new.select("u", F.col("next").alias("label"))
        if new.where("moved").isEmpty():
            return labels.withColumnRenamed("u", "cid")


def row_key(id: Column, text: Column) -> Column:
    return F.xxhash64(id, text)


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document row: doc_id, rk (key of id and text), n_shingles, component_id, n_links (different sets it links with)."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrow_rows(spark, 1000)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    rows = rows.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("rk"), "text")
    counted = materialize(index(rows, words), "index")
    known = counted.where(F.col("chunk").isNull()).select("doc_id", "rk", "cid", "n")
    seen = spark.sparkContext.broadcast(counters(counted))
    shared = materialize(shared_tokens(prefixes(rows, seen, words, percent, buckets)), "shared")
    asked = materialize(requests(shared, percent), "asked")
    classes = materialize(known.groupBy("cid").agg(F.min("doc_id").alias("least"), F.min("rk").alias("rk")), "classes")
    active = asked.select("cid").distinct()
    sets = class_sets(rows, classes.join(active, "cid", "left_semi"), words).dropDuplicates(["cid"])
    links = materialize(open_groups(asked.join(sets.hint("merge"), "cid"), percent), "links")
    seen.unpersist()
    labels = components(links)
    count = links.groupBy("cid").agg(F.sum("links").alias("n_links"))
    joined = classes.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    verdict = materialize(
        joined.join(least, "label").join(count, "cid", "left").select("cid", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "verdict"
    )
    empty = F.col("n") == 0
    return known.join(verdict, "cid").select(
        "doc_id", "rk", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document row of each component, the one of the least id (of equal ids, of the least key); all columns stay.

    Rows equal in id and text are one document. Texts without words stay, one
    for each id.
    """
    found = link_documents(docs, words, percent, id, text)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rk")
    # Components without any id, and texts without words, are told apart by the row's own key.
    alone = (F.col("n_shingles") == 0) | F.col("component_id").isNull()
    best = found.groupBy(F.col("component_id"), F.when(alone, F.col("rk")).alias("own")).agg(F.min(place).alias("p"))
    best = materialize(best.select("p.rk").distinct(), "best")
    keyed = wrapped(docs, rk=row_key(F.col(id).cast("bigint"), whole_text(text)))
    kept = keyed.join(best.hint("merge"), "rk", "left_semi").dropDuplicates(["rk"])
    return unwrapped(kept, docs.columns)
