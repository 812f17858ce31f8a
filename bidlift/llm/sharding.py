"""Sharding by balanced label propagation.

Equal texts are linked through their group. Linked documents start in the shard
of their row's hash; in each round a group looks at how many of its members each
shard holds and names its home, the fullest shard that still has room; a group
larger than a shard names as many, the fullest ones, as it needs. Members in
shards that hold less of the group ask to move to a home. Requests from shard a to b
are met up to a quota: as many as go the other way, plus a share of b's room,
so a shard never grows past its capacity by moves. Groups larger than a shard go
first, the others after them into what is left. Rounds go on while the links
within shards (the sum of squares of a group's members per shard) grow. Then shards above their capacity give up the members with the fewest
companions there, and these and the unlinked documents fill the rest, so that
the numbers of documents differ by at most one (law ``rows``).

Only matrices of shards x shards numbers reach the driver. Ranks, which quotas,
surplus and slots need, are counted in two steps, so that a group or shard that
holds a third of all rows is spread over many tasks.

Defined results: a NULL text counts 8 bytes, has the checksum of no bytes and
is grouped with the empty text. NULL and repeated ids are rows like any other.
No rows give no rows. Only the id and the text are read.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ranked, text_key, whole_text

SHARDS, OVERHEAD = 24, 8


def _buckets(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _by_shard(values: list[int], shard: str = "shard") -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), F.col(shard) + 1)


def quotas(requests: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the requests from a to b are met, for at most shards x shards numbers."""
    met = {(a, b): min(n, requests.get((b, a), 0)) for (a, b), n in requests.items()}
    for b in range(len(room)):
        left = room[b]
        for a in range(len(room)):
            more = min(left, requests.get((a, b), 0) - met.get((a, b), 0))
            if more > 0:
                met[a, b] += more
                left -= more
    return met


def _homes(capacity: list[int]) -> Column:
    """A group's homes from its array of (open, here, luck, shard): one, or as many as a group larger than a shard fills, fullest first."""
    needed = F.ceil(F.col("n") / max(1, *capacity)).cast("int")
    fullest = F.array_sort("shards", lambda a, b: F.when((a["here"] > b["here"]) | ((a["here"] == b["here"]) & (a["luck"] > b["luck"])), -1).otherwise(1))
    return F.slice(F.when(needed > 1, fullest).otherwise(F.sort_array("shards", asc=False)), 1, F.greatest(needed, F.lit(1)))


def _round(state: DataFrame, capacity: list[int], least: int) -> tuple[DataFrame, int]:
    """One round over the written table ``state`` (row columns, group, n, shard), and the links before it.

    The state is returned as it is where its links are no more than ``least``
    or no move is granted.
    """
    shards = len(capacity)
    size = _sizes(state)
    room = [max(0, capacity[j] - size.get(j, 0)) for j in range(shards)]
    held = materialize(state.groupBy("group", "n", "shard").agg(F.count(F.lit(1)).alias("here")), "held")
    links = int(held.agg(F.coalesce(F.sum(F.col("here").cast("decimal(38,0)") * F.col("here")), F.lit(0))).first()[0])
    if links <= least:
        return state, links
    open_ = (_by_shard(room) > 0).cast("int")
    # Equal counts are told apart by a hash, so that two shards never just swap members.
    one = F.struct(open_.alias("open"), "here", F.xxhash64("group", "shard").alias("luck"), "shard")
    homes = held.groupBy("group", "n").agg(F.collect_list(one).alias("shards")).select("group", _homes(capacity).alias("homes"))
    # Nobody leaves a shard that holds more of the group than its homes do.
    luck = F.xxhash64("group", "shard")
    better = F.forall("homes", lambda h: (h["here"] > F.col("here")) | ((h["here"] == F.col("here")) & (h["luck"] > luck)))
    wish = held.join(homes, "group").where(better).select("group", "shard", F.transform("homes", lambda h: h["shard"]).alias("homes"))
    wish = materialize(wish, "wish")
    pick = F.element_at("homes", F.pmod(F.xxhash64("row_id"), F.size("homes")).cast("int") + 1)
    asked = materialize(state.join(wish, ["group", "shard"], "left").withColumn("target", pick).drop("homes"), "asked")
    movers = asked.where("target is not null")
    requests = {(r["shard"], r["target"]): r["count"] for r in movers.groupBy("shard", "target").count().collect()}
    met = quotas(requests, room)
    if not any(met.values()):
        return state, links
    spark = state.sparkSession
    table = F.broadcast(spark.createDataFrame([(a, b, n) for (a, b), n in met.items()], "shard int, target int, quota long"))
    # A group's members stand together where it is small; a hot group is spread by rows.
    buckets = _buckets(state)
    hot = F.col("n") * buckets > sum(size.values())
    spread = F.pmod(F.when(hot, F.xxhash64("row_id")).otherwise(F.xxhash64("group")), F.lit(buckets))
    turn = ranked(movers, ["shard", "target"], [F.col("group"), F.col("row_id")], spread, "turn", buckets)
    gone = turn.join(table, ["shard", "target"]).select(
        *[c for c in state.columns if c != "shard"], F.when(F.col("turn") < F.col("quota"), F.col("target")).otherwise(F.col("shard")).alias("shard")
    )
    stay = asked.where("target is null").drop("target")
    return materialize(stay.unionByName(gone), "state"), links


def _upto(value: Column, ends: list[int]) -> Column:
    """The first shard whose end lies above the value, else the last."""
    shard = F.lit(len(ends) - 1)
    for j in reversed(range(len(ends))):
        shard = F.when(value < ends[j], F.lit(j)).otherwise(shard)
    return shard.cast("int")


def propagate(linked: DataFrame, capacity: list[int]) -> DataFrame:
    """Rounds from a start in which every shard holds rows in proportion to its capacity."""
    start = _upto(F.pmod(F.xxhash64("row_id"), F.lit(max(1, sum(capacity)))), list(accumulate(capacity)))
    state = materialize(linked.withColumn("shard", start), "state")
    before, links = state, -1
    while True:
        after, now = _round(state, capacity, links)
        if now <= links:  # the last round gained nothing: the state before it stays
            return before
        if after is state:
            return state
        before, state, links = state, after, now


def _sizes(state: DataFrame) -> dict[int, int]:
    return {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}  # a row per shard


def shard_documents(docs: DataFrame, shards: int = SHARDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, group, shard, slot of every document row."""
    whole = whole_text(text)
    rows = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"), F.col(id).alias("doc_id"),
            (F.octet_length(whole) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"), text_key(whole).alias("group"),
        ),
        "rows",
    )
    total = rows.count()
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    groups = materialize(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
    known = materialize(rows.join(groups, "group", "left"), "known")
    linked = known.where("n is not null").select("row_id", "doc_id", "size", "text_crc32", "group", "n")
    # Groups larger than a shard settle first, else smaller ones would hold their places.
    large = linked.where(F.col("n") > min(capacity))
    state = propagate(large, capacity)
    taken = _sizes(state)
    left = [max(0, c - taken.get(j, 0)) for j, c in enumerate(capacity)]
    state = materialize(state.unionByName(propagate(linked.where(F.col("n") <= min(capacity)), left)), "state")
    # Above capacity, those with the fewest companions leave.
    buckets = _buckets(rows)
    by_row = F.pmod(F.xxhash64("row_id"), F.lit(buckets))
    size = _sizes(state)
    full = [j for j in range(shards) if size.get(j, 0) > capacity[j]]
    placed, loose = state, known.where("n is null").drop("n")
    if full:
        here = state.where(F.col("shard").isin(full)).groupBy("group", "shard").agg(F.count(F.lit(1)).alias("here"))
        tight = materialize(state.where(F.col("shard").isin(full)).join(here, ["group", "shard"]), "tight")
        few = [F.col("here").desc(), F.col("group"), F.col("row_id")]
        # Buckets by companions keep the order over the whole shard: the most companions first.
        level = F.least(F.length(F.bin("here")), F.lit(40))
        order = (40 - level) * buckets + by_row
        turn = materialize(ranked(tight, ["shard"], few, order, "turn", 41 * buckets), "turn")
        over = F.col("turn") >= _by_shard(capacity)
        placed = state.where(~F.col("shard").isin(full)).unionByName(turn.where(~over).select(*state.columns))
        loose = loose.unionByName(turn.where(over).select(*loose.columns))
        size = {j: min(size.get(j, 0), capacity[j]) for j in range(shards)}
    loose = materialize(loose.withColumn("all", F.lit(0)), "loose")
    filled = ranked(loose, ["all"], [F.col("row_id")], by_row, "turn", buckets)
    shard = _upto(F.col("turn"), list(accumulate(capacity[j] - size.get(j, 0) for j in range(shards))))
    columns = ["row_id", "doc_id", "size", "text_crc32", "group"]
    settled = placed.select(*columns, "shard").unionByName(filled.select(*columns, shard.alias("shard")))
    settled = materialize(settled, "settled")
    return ranked(settled, ["shard"], [F.col("row_id")], by_row, "slot", buckets).drop("row_id")


def sharded(docs: DataFrame, **options) -> DataFrame:
    """The rows with the law that holds."""
    return shard_documents(docs, **options).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "group",
    )
