"""Weighted list ranking: for every element of a linked list the sums of all weights before it.

Elements are dealt into pieces of PIECE neighbouring ids. A task follows the links inside its piece by pointer
jumping and keeps of every chain its first element, with the chain's sums and the link that leaves it. While more than one
piece is left, a splice takes out of the list every element whose coin shows 0 and whose predecessor's shows 1 (a
quarter of them on average, however the ids lie), and the pieces are formed anew. Every round is written and shorter
than the one before, so the work is in proportion to the list; the way back adds each element's sum to its head's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import ordered
from mercato.llm.tables import written
from mercato.session import discard

#: Elements that one task follows.
PIECE = 100_000


def chains(ids: np.ndarray, nexts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ascending ``ids`` linked by ``nexts`` (-1: end): each element's head, and the sums before it in its chain;
    and the place of each element's chain's last element."""
    size = len(ids)
    at = np.searchsorted(ids, nexts)
    inside = (at < size) & (ids[np.minimum(at, size - 1)] == nexts)
    back = np.full(size, -1)
    back[at[inside]] = np.flatnonzero(inside)
    head = np.where(back < 0, np.arange(size), back)
    before = np.where(back[:, None] < 0, 0, weights[head])
    while True:
        further = head[head]
        if (further == head).all():
            break
        before += before[head]
        head = further
    last = np.empty(size, dtype=np.int64)
    last[head[~inside]] = np.flatnonzero(~inside)
    return head, before, last[head]


def ranked(links: DataFrame, names: list[str]) -> DataFrame:
    """id and, under ``names``, the sums over all elements before it. ``links`` is one list: id (longs from 0 without
    gaps), next (null at its end) and the weights ``names``. An empty list gives no rows."""
    sums = ", ".join(f"{n} long, {n}_all long" for n in names)
    schema = f"id long, next long, head long, {sums}"

    def contract(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table.column("id").to_numpy()
        nexts = table.column("next").fill_null(-1).to_numpy()
        weights = np.stack([table.column(n).to_numpy() for n in names], axis=1)
        head, before, last = chains(ids, nexts, weights)
        total = before[last] + weights[last]
        left = pa.array(nexts[last], mask=nexts[last] < 0)
        columns = {"id": ids, "next": left, "head": ids[head]}
        for i, n in enumerate(names):
            columns |= {n: before[:, i], f"{n}_all": total[:, i]}
        return pa.table(columns)

    rounds = []
    rest = links.select("id", "next", *names, F.floor(F.col("id") / PIECE).alias("piece"))
    while True:
        made = written(rest.groupBy("piece").applyInArrow(contract, schema), "list-chains")
        rounds.append(made)
        heads = made.filter("id = head").select("id", "next", *[F.col(f"{n}_all").alias(n) for n in names])
        left = heads.count()
        if left <= 1:
            break
        if left > PIECE:
            kept, taken = _spliced(heads, names, len(rounds))
            rounds.append(taken)
            heads = kept
        ranges = ordered.dealt(heads, ["id"], "list-heads")
        numbered = ordered.running(ranges, [], ["id"], "place", {})
        rest = numbered.withColumn("piece", F.floor((F.col("place") - 1) / PIECE)).drop("place")
    sums_of = lambda made: made.select("id", "head", *names)
    held = rounds.pop()
    known = sums_of(held)
    while rounds:
        made = rounds.pop()
        above = known.select(F.col("id").alias("head"), *[F.col(n).alias(f"__{n}") for n in names])
        below = sums_of(made).filter("id <> head").join(above, "head")
        added = below.select("id", "head", *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in names])
        fresh = written(known.unionByName(added), "list-sums")
        discard(*[table for table in (held, made) if hasattr(table, "written_to")])
        known = held = fresh
    return known.drop("head")


def _spliced(heads: DataFrame, names: list[str], turn: int) -> tuple[DataFrame, DataFrame]:
    """The shorter list, and what was taken out of it: id, the element before it as head, and that one's sums."""
    coin = F.xxhash64("id", F.lit(turn)) % 2 == 0
    tossed = heads.withColumn("__coin", coin)
    after = tossed.filter(~F.col("__coin")).select(
        F.col("id").alias("next"), F.col("next").alias("__next"), *[F.col(n).alias(f"__{n}") for n in names]
    )
    pairs = written(tossed.filter("__coin").join(after, "next", "left").withColumn("__met", F.col(f"__{names[0]}").isNotNull()), "list-pairs")
    joined = [(F.col(n) + F.coalesce(f"__{n}", F.lit(0))).alias(n) for n in names]
    grown = pairs.select("id", F.when(F.col("__met"), F.col("__next")).otherwise(F.col("next")).alias("next"), *joined)
    taken = pairs.filter("__met").select(F.col("next").alias("id"), F.col("id").alias("head"), *names)
    others = tossed.filter(~F.col("__coin")).select("id", "next", *names).join(taken.select("id"), "id", "left_anti")
    return grown.unionByName(others), taken
