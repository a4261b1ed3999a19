"""Sharding by balanced label propagation.

Documents of equal text are linked; a shard is a label. Linked documents start spread evenly.
A placement is kept as members per (group, shard), never as rows: a group has at most
as many entries as there are shards, however hot it is. In every round

* members of a group wish to move to the shard where it is strongest, ties falling anew
  each round; groups larger than a shard wish for the shards laid out for them at the
  start, which they fill one after the other;
* groups that are whole in one shard may be exchanged: moving them cuts nothing;
* per pair of shards the wishes and exchanges are added up, and from these sums the driver
  grants as many as keep every shard at or below its capacity. Opposite moves and longer
  circles need no room; where more come in than go out, whole groups leave in exchange.

Granted moves are picked exactly, by running sums in the order of a hash. A granted wish of a
group that fits a shard joins at least as many neighbours as it leaves, and one of a larger
group comes nearer to its layout, so rounds cannot repeat themselves; they end when ``IDLE``
rounds in a row grant nothing. Then rows take the places of their group in order, and unlinked documents
fill what is left, so that counts are at most one apart (law ``rows``) and slots are gapless.

Only sums per pair of shards and hash bin, and the groups larger than a shard (fewer than
there are shards), reach the driver.

Defined results: NULL text is empty and equal to empty. Repeated rows are placed each.
Ties go by hash. An empty table gives no rows; further columns, and texts of any length, do
not matter.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.llm.common import numbered, runs_for
from panelkit.staging import stage

SHARDS = 24
IDLE = 3  # rounds without a granted move, each with other ties, after which rounds end
BINS = 64  # hash bins of the sums per pair of shards
RUNS = 256  # hash runs of a group's rows

ENTRIES = "group binary, shard int, n long"


def measured(docs: DataFrame) -> DataFrame:
    """Narrow table: row, doc_id, size, crc and the digest that links equal texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
    )


def number_list(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


# --- what groups want -----------------------------------------------------------


def laid_out(entries: DataFrame, caps: list[int]) -> dict[bytes, list[int]]:
    """Members per shard that groups larger than a shard shall have: the largest first, shard after shard."""
    sizes = entries.groupBy("group").agg(F.sum("n").alias("n")).filter(F.col("n") > min(caps))
    ends = list(accumulate(caps, initial=0))
    out, at = {}, 0
    for r in sorted(sizes.collect(), key=lambda r: (-r.n, bytes(r.group))):  # fewer groups than shards
        out[bytes(r.group)] = [max(0, min(b, at + r.n) - max(a, at)) for a, b in zip(ends, ends[1:])]
        at += r.n
    return out


def ranked_entries(entries: DataFrame, free: list[int], turn: int) -> DataFrame:
    """Entries with their group's size and the place of the shard in the group's order."""
    has_room = F.get(number_list(free), F.col("shard")) > 0
    tie = F.xxhash64("group", "shard", F.lit(turn))
    order = Window.partitionBy("group").orderBy(F.desc(has_room), F.desc("n"), tie, "shard")
    return entries.withColumns({"size": F.sum("n").over(Window.partitionBy("group")), "place": F.row_number().over(order)})


def small_moves(ranked: DataFrame, quota: int, turn: int) -> DataFrame:
    """group, source, target, n, bin: wishes of groups that fit a shard; target -1: whole, may be exchanged."""
    home = F.first("shard").over(Window.partitionBy("group").orderBy("place"))
    seen = ranked.filter(F.col("size") <= quota).withColumn("home", home)
    whole = (F.col("place") == 1) & (F.col("n") == F.col("size"))
    target = F.when(whole, F.lit(-1)).otherwise(F.col("home"))
    bin_ = F.pmod(F.xxhash64("group", F.lit(turn)), F.lit(BINS)).cast("int").alias("bin")
    return seen.filter(whole | (F.col("place") > 1)).select("group", F.col("shard").alias("source"), target.alias("target"), "n", bin_)


def large_moves(entries: DataFrame, plan: dict[bytes, list[int]]) -> list[tuple[bytes, int, int, int]]:
    """(group, source, target, n): members beyond what is laid out for a shard go where some are missing."""
    if not plan:
        return []
    held = {group: [0] * len(own) for group, own in plan.items()}
    for r in entries.filter(F.col("group").isin([bytearray(g) for g in plan])).collect():  # fewer groups than shards
        held[bytes(r.group)][r.shard] = r.n
    out = []
    for group, own in plan.items():
        over = [h - w for h, w in zip(held[group], own)]
        missing = [[s, -d] for s, d in enumerate(over) if d < 0]
        for s, d in enumerate(over):
            for place in missing:
                taken = min(d, place[1])
                if taken > 0:
                    out.append((group, s, place[0], taken))
                    place[1] -= taken
                    d -= taken
    return out


# --- grants ---------------------------------------------------------------------


def exchanges(wished: np.ndarray, room: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Members of whole groups to move from each shard to each other, if all wishes are granted."""
    surplus = wished.sum(axis=0) - wished.sum(axis=1) - room
    out = np.zeros_like(wished)
    need, space = np.minimum(np.maximum(surplus, 0), whole), np.maximum(-surplus, 0)
    for t in np.argsort(-need, kind="stable"):
        for s in np.argsort(-space, kind="stable"):
            moved = min(need[t], space[s])
            out[t, s] += moved
            need[t] -= moved
            space[s] -= moved
    return out


def planned_flows(wished: np.ndarray, room: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(wishes, exchanges) that fit together: wishes into a shard that has too few whole groups to give are cut."""
    kept = wished.copy()
    while True:
        surplus = kept.sum(axis=0) - kept.sum(axis=1) - room
        out = exchanges(kept, room, whole)
        unmet = surplus - out.sum(axis=1)
        t = int(unmet.argmax())
        if unmet[t] <= 0:
            return kept, out
        rest = unmet[t]
        for s in np.argsort(surplus, kind="stable"):  # first from sources that have space
            cut = min(rest, kept[s, t])
            kept[s, t] -= cut
            rest -= cut


def feasible(wished: np.ndarray, room: np.ndarray, exchanged: np.ndarray) -> np.ndarray | None:
    """The wishes less as many as keep every shard at or below its room.

    Wishes into an overfull shard are cut; their sources keep those members, so that the
    next cut may fall there. Every step cuts something, so the loop ends. None if exchanges
    overfill a shard that no wish enters; without exchanges there is always an answer.
    """
    kept = wished.copy()
    moved = exchanged.sum(axis=0) - exchanged.sum(axis=1)
    while True:
        over = kept.sum(axis=0) - kept.sum(axis=1) + moved - room
        t = int(over.argmax())
        if over[t] <= 0:
            return kept
        # cut first where the source has most space left
        rest = over[t]
        for s in np.argsort(over, kind="stable"):
            cut = min(rest, kept[s, t])
            kept[s, t] -= cut
            rest -= cut
        if rest == over[t]:
            return None


def bin_starts(spark: SparkSession, sums: dict[tuple[int, int], list[int]]) -> DataFrame:
    """source, target, bin, before: running sums at the start of the bins."""
    rows = [(s, t, b, before) for (s, t), own in sums.items() for b, before in enumerate(accumulate(own[:-1], initial=0))]
    return spark.createDataFrame(rows, "source int, target int, bin int, before long")


def with_running(moves: DataFrame, starts: DataFrame) -> DataFrame:
    """Moves with the sum of those before them of the same source and target."""
    inside = Window.partitionBy("source", "target", "bin").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    local = moves.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = local.join(F.broadcast(starts), ["source", "target", "bin"])  # shards^2 x BINS rows at most
    return joined.withColumn("running", F.col("before") + F.col("inside")).drop("before", "inside")


def picked_exchanges(moves: DataFrame, planned: np.ndarray, parts: bool) -> DataFrame:
    """group, source, target, n of whole groups that fit into the planned exchanges.

    With ``parts`` a group at the border of two targets is cut there, so that the plan is
    met to the member: at most one group per pair of shards, for the sake of a larger one.
    """
    spark, shards = moves.sparkSession, len(planned)
    rows = []
    for s in range(shards):
        ends = list(accumulate(planned[s].tolist(), initial=0))
        rows += [(s, t, a, b) for t, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
    plan = spark.createDataFrame(rows, "source int, to int, start long, stop long")
    n = F.least("stop", F.col("running") + F.col("n")) - F.greatest("start", "running")
    fits = n > 0 if parts else n == F.col("n")
    joined = moves.join(F.broadcast(plan), "source").filter(fits)
    return joined.select("group", "source", F.col("to").alias("target"), n.alias("n"))


def picked_wishes(moves: DataFrame, granted: np.ndarray) -> DataFrame:
    """group, source, target, n of the wishes granted; the last one of a pair of shards may be granted in part."""
    shards = len(granted)
    limit = F.get(number_list(granted.ravel().tolist()), F.col("source") * shards + F.col("target"))
    n = F.least(F.col("n"), limit - F.col("running")).alias("n")
    return moves.select("group", "source", "target", n).filter("n > 0")


def moved_entries(entries: DataFrame, moves: DataFrame) -> DataFrame:
    """Entries after moves."""
    out = moves.select("group", F.col("source").alias("shard"), (-F.col("n")).alias("n"))
    in_ = moves.select("group", F.col("target").alias("shard"), "n")
    whole = entries.select("group", "shard", "n").unionByName(out).unionByName(in_)
    return whole.groupBy("group", "shard").agg(F.sum("n").alias("n")).filter("n > 0")


def one_round(entries: DataFrame, caps: list[int], held: list[int], plan: dict[bytes, list[int]], turn: int) -> tuple[DataFrame, list[int], int]:
    """(entries, members per shard, wishes granted) after a round."""
    spark, shards = entries.sparkSession, len(caps)
    free = [c - sum(own[s] for own in plan.values()) for s, c in enumerate(caps)]
    small = stage(small_moves(ranked_entries(entries, free, turn), min(caps), turn), "moves")
    large = large_moves(entries, plan)
    sums: dict[tuple[int, int], list[int]] = {}
    for r in small.groupBy("source", "target", "bin").agg(F.sum("n").alias("n")).collect():  # shards^2 x BINS rows
        sums.setdefault((r.source, r.target), [0] * BINS)[r.bin] = r.n
    wished, whole = np.zeros((shards, shards), dtype=np.int64), np.zeros(shards, dtype=np.int64)
    for (s, t), own in sums.items():
        if t < 0:
            whole[s] = sum(own)
        else:
            wished[s, t] = sum(own)
    by_small = wished.copy()
    for _, s, t, n in large:
        wished[s, t] += n
    if not wished.any():
        return entries, held, 0
    room = np.array(caps) - np.array(held)
    running = with_running(small, bin_starts(spark, sums))
    kept, planned = planned_flows(wished, room, whole)
    swapped, exchanged = None, np.zeros_like(wished)
    if planned.any():
        swapped = stage(picked_exchanges(running.filter("target < 0"), planned, bool(large)), "exchanges")
        for r in swapped.groupBy("source", "target").agg(F.sum("n").alias("n")).collect():  # shards^2 rows
            exchanged[r.source, r.target] = r.n
    granted = feasible(kept, room, exchanged)
    if granted is None:
        swapped, exchanged = None, np.zeros_like(wished)
        granted = feasible(wished, room, exchanged)
    if not granted.any():
        return entries, held, 0
    first = np.minimum(granted, by_small)
    rest, parts = granted - first, []
    for group, s, t, n in large:
        taken = int(min(n, rest[s, t]))
        rest[s, t] -= taken
        if taken:
            parts.append((bytearray(group), s, t, taken))
    moves = picked_wishes(running.filter("target >= 0"), first)
    if swapped is not None:
        moves = moves.unionByName(swapped)
    if parts:
        moves = moves.unionByName(spark.createDataFrame(parts, "group binary, source int, target int, n long"))
    flow = granted + exchanged
    after = [int(h) for h in np.array(held) + flow.sum(axis=0) - flow.sum(axis=1)]
    return stage(moved_entries(entries, moves), "entries"), after, int(granted.sum())


def propagate(entries: DataFrame, caps: list[int], held: list[int]) -> DataFrame:
    """Members per group and shard when no more wish can be granted."""
    plan, turn, idle = laid_out(entries, caps), 0, 0
    while idle < IDLE:
        entries, held, granted = one_round(entries, caps, held, plan, turn)
        idle = 0 if granted else idle + 1
        turn += 1
    return entries


# --- rows -----------------------------------------------------------------------


def placed_rows(linked: DataFrame, entries: DataFrame) -> DataFrame:
    """row, shard: the rows of a group take its members' places in order."""
    run = linked.select("row", "group", F.pmod(F.xxhash64("row"), F.lit(RUNS)).cast("int").alias("run"))
    earlier = Window.partitionBy("group").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = run.groupBy("group", "run").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("group", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    places = entries.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("places"))
    known = stage(starts.join(places, "group"), "starts")  # a written side lets Spark split a hot group
    local = run.withColumn("local", F.row_number().over(Window.partitionBy("group", "run").orderBy("row")) - 1)
    at = F.col("before") + F.col("local")
    step = lambda a, p: F.struct((a["left"] - p["n"]).alias("left"), F.when(a["left"] >= 0, p["shard"]).otherwise(a["shard"]).alias("shard"))
    found = F.reduce("places", F.struct(at.alias("left"), F.lit(-1).alias("shard")), step)
    return local.join(known, ["group", "run"]).select("row", found["shard"].alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = stage(measured(docs), "measured")
    total = rows.count()
    groups = stage(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "groups")
    linked = rows.join(groups, "group").select("row", "group")
    even = numbered(linked.withColumn("all", F.lit(0)), "all", ["row"], "place", runs_for(total))
    begun = even.select("group", (F.col("place") % shards).cast("int").alias("shard"))
    entries = stage(begun.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n")), "entries")
    found = {r.shard: r.n for r in entries.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    held = [found.get(s, 0) for s in range(shards)]
    fullest = sorted(range(shards), key=lambda s: (-held[s], s))
    caps = [total // shards + (fullest.index(s) < total % shards) for s in range(shards)]
    entries = propagate(entries, caps, held) if any(held) else entries
    placed = stage(placed_rows(linked, entries), "placed")
    found = {r.shard: r.n for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends = list(accumulate(caps[s] - found.get(s, 0) for s in range(shards)))
    single = numbered(rows.join(groups, "group", "left_anti").select("row", F.lit(0).alias("all")), "all", ["row"], "place", runs_for(total))
    filled = single.select("row", F.size(F.filter(number_list(ends), lambda e: e <= F.col("place"))).alias("shard"))
    everyone = stage(placed.unionByName(filled), "shards")
    slots = numbered(everyone, "shard", ["row"], "slot", runs_for(total // shards))
    return rows.join(slots, "row").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
