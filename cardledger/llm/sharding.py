"""Sharding by balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked. Shards are labels; each round the documents of a group move
to the shard that holds most of their neighbours, as far as documents of that shard want to go the
other way or its quota has room, so that fewer links are cut while no shard outgrows its quota.
Documents of one group in one shard are interchangeable, so a round works on counts per (group,
shard), one row each, however many copies there are. Documents without links have nothing to gain
anywhere; they fill the shards up at the end, which makes the law exact: row counts at most one apart.

A round's moves into a shard are admitted in order of the mover's gain through running sums that no
single task holds (`ranks.with_running`). A group only moves towards strictly more neighbours, so the
number of cut links falls every round and the rounds end.

Defined cases: a null text has no bytes and is equal to an empty text. Repeated rows are rows of
their own. Fewer documents than shards leave shards empty. An empty table gives no rows. Equal texts
are told apart by length, CRC-32 and a 64-bit hash together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardledger.llm.ranks import with_rank, with_running
from cardledger.sources.scratch import saved

SHARDS = 24
MAX_ROUNDS = 12  # a bound on the work; stopping early costs cut links, never balance

GROUP = ["_hash", "text_crc32", "size"]


def _of_shard(values: list[int], shard: Column) -> Column:
    """values[shard], for a handful of shards."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), shard + 1)


def limits(demand: dict[tuple[int, int], int], room: list[int]) -> list[list[int]]:
    """How many documents may go from shard a to shard b: as many as want to go the other way, which
    leaves both sizes as they are, and what room b has besides."""
    shards = len(room)
    out = [[0] * shards for _ in range(shards)]
    left = list(room)
    for (a, b), n in sorted(demand.items(), key=lambda d: (-d[1], d[0])):
        swapped = min(n, demand.get((b, a), 0))
        more = min(n - swapped, max(left[b], 0))
        left[b] -= more
        out[a][b] = swapped + more
    return out


def propagate(state: DataFrame, quota: list[int], rounds: int = MAX_ROUNDS) -> DataFrame:
    """The counts per group and shard after label propagation under `quota`."""
    shards = len(quota)
    n_rows = state.count()
    only_open = False  # the shard of most neighbours, or of most among those that have room
    for _ in range(rounds):
        load = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [quota[s] - load.get(s, 0) for s in range(shards)]
        mine = F.struct("n", F.xxhash64(*GROUP, "shard").alias("tie"), "shard")
        best = state.groupBy(*GROUP).agg(
            F.max(F.when(_of_shard(room, F.col("shard")) > 0, mine) if only_open else mine).alias("_best")
        )
        best = best.select(*[F.col(c).alias(f"_b{c}") for c in GROUP], "_best")
        wish = saved(
            state.join(best, [F.col(c) == F.col(f"_b{c}") for c in GROUP])
            .where(F.col("_best") > mine)
            .select(
                *GROUP,
                "shard",
                "n",
                F.col("_best.shard").alias("target"),
                (-F.least(F.floor(F.log2(F.col("_best.n")) * 4), F.lit(160))).cast("int").alias("gain"),
            ),
            "wishes",
        )
        asked = wish.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()  # shards squared
        allowed = limits({(r.shard, r.target): r.n for r in asked}, room)
        if not any(map(any, allowed)):
            if only_open:
                break
            only_open = True
            continue
        only_open = False
        flat = [n for row in allowed for n in row]
        wish = with_running(wish, ["shard", "target"], GROUP, n_rows, F.col("n"), "_before", F.col("gain"))
        free = _of_shard(flat, F.col("shard") * shards + F.col("target")) - F.col("_before")
        moves = saved(
            wish.withColumn("go", F.greatest(F.lit(0), F.least(F.col("n"), free))).where("go > 0"), "moves"
        )
        changed = moves.select(*GROUP, "shard", (-F.col("go")).alias("n")).union(
            moves.select(*GROUP, F.col("target").alias("shard"), F.col("go").alias("n"))
        )
        state = saved(
            state.union(changed).groupBy(*GROUP, "shard").agg(F.sum("n").alias("n")).where("n > 0"), "labels"
        )
    return state


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = MAX_ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of `docs`."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("_hash"),
    )
    copies = slim.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_copies"))
    copies = copies.select(*[F.col(c).alias(f"_c{c}") for c in GROUP], "_copies")
    slim = saved(slim.join(copies, [F.col(c) == F.col(f"_c{c}") for c in GROUP]).select(*slim.columns, "_copies"), "documents")
    total = slim.count()
    linked, single = slim.where("_copies > 1").drop("_copies"), slim.where("_copies = 1").drop("_copies")
    order = ["doc_id", *GROUP]
    quota = [total // shards + (s < total % shards) for s in range(shards)]

    start = with_rank(linked, [], order, total, "_rank").withColumn("shard", F.pmod("_rank", F.lit(shards)).cast("int"))
    state = saved(start.groupBy(*GROUP, "shard").agg(F.count(F.lit(1)).alias("n")), "labels")
    state = propagate(state, quota, rounds)

    # A group's documents, numbered, take the group's shards in turn.
    upto = Window.partitionBy(*GROUP).orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ranges = state.withColumn("_high", F.sum("n").over(upto)).select(
        *[F.col(c).alias(f"_r{c}") for c in GROUP], "shard", (F.col("_high") - F.col("n")).alias("_low"), "_high"
    )
    placed = with_rank(linked, GROUP, order, total, "_rank").join(
        ranges,
        [F.col(c) == F.col(f"_r{c}") for c in GROUP] + [F.col("_rank") >= F.col("_low"), F.col("_rank") < F.col("_high")],
    )
    # The others fill what the quotas leave.
    load = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    edge, high = [], 0
    for s in range(shards):
        high += quota[s] - load.get(s, 0)
        edge.append(high)
    filled = with_rank(single, [], order, total, "_rank").withColumn(
        "shard", F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in edge]), lambda e: e <= F.col("_rank"))).cast("int")
    )
    columns = ["doc_id", "size", "text_crc32", "_hash", "shard"]
    both = saved(placed.select(columns).union(filled.select(columns)), "shards")
    return with_rank(both, ["shard"], order, total, "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_links(sharded: DataFrame) -> DataFrame:
    """(groups, spread): how many groups of equal texts there are, and how many shards they take in all."""
    groups = sharded.groupBy("text_crc32", "size").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("shard").alias("s"))
    return groups.where("n > 1").agg(F.count(F.lit(1)).alias("groups"), F.sum("s").alias("spread"))
