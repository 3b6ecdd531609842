"""Order statistics without a single-task sort: exact quantiles, running totals, NTILE, numbering.

Every function first shrinks rows to counts per distinct value, then works on two levels. A value
belongs to a *slot*, a monotone logarithmic bucket whose width is about 0.3 % of the value, so there
are a few thousand slots whatever the range. Values far from zero share few slots, so each slot is cut
once more into *parts* of equal width between its own least and greatest value, about one part per
``PART_VALUES`` distinct values. Prefix sums run over slots and over the parts of a slot; only the values
of one part are sorted together. All of it is one lazy, deterministic plan, so a lost executor recomputes
to the same answer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULLS_LAST = 1e300  # stands for NULL in an ascending order with NULLs last
PART_VALUES = 256  # distinct values that a part should hold
MOST_PARTS = 1 << 16  # of one slot
RADIX_BYTES = 3  # of a text behind the prefix that all texts share
MAX_NUMBERED_GROUP = 1_000_000  # rows of one key that a single task may number


def slot_of(value: Column, unit: float = 1.0, per_octave: int = 256) -> Column:
    """Monotone bucket number of a numeric value; ``unit`` is where buckets start to widen."""
    x = value.cast("double") / unit
    return (F.signum(x) * F.floor(F.log2(F.abs(x) + 1) * per_octave)).cast("long")


def _part_of(value: Column, low: Column, high: Column, values: Column) -> Column:
    """Monotone number of the part of [low, high] that holds ``value``; ``values`` is how many lie between."""
    x, a, b = (c.cast("double") for c in (value, low, high))
    parts = F.least(F.ceil(values / PART_VALUES), F.lit(MOST_PARTS))
    place = F.least(F.floor((x - a) / (b - a) * parts), parts - 1)
    return F.when(b > a, place).otherwise(0).cast("long")


def _shared_bytes(low: Column, high: Column) -> Column:
    """How many leading bytes two texts share."""
    short = F.least(F.octet_length(low), F.octet_length(high))
    at = F.sequence(F.lit(1), F.greatest(short, F.lit(1)))
    one = F.lit(1)
    other = F.filter(at, lambda i: F.substring(low, i, one) != F.substring(high, i, one))
    return F.least(F.coalesce(F.get(other, F.lit(0)) - 1, short), short)


def _tie_part(kind: T.DataType, tie: Column, low: Column, high: Column, rows: Column) -> Column:
    """Monotone bucket of an id between ``low`` and ``high``: text by the bytes after their common prefix."""
    if isinstance(kind, T.StringType):
        low, high, raw = (F.encode(c, "UTF-8") for c in (low, high, tie))
        return F.substring(raw, _shared_bytes(low, high) + 1, F.lit(RADIX_BYTES))
    return _part_of(tie, low, high, rows)


def _group_key(by: Sequence[str]) -> Column:
    # fields of a struct compare NULL = NULL, so NULL groups survive the joins below
    return F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))


def _restore(by: Sequence[str]) -> list[Column]:
    return [F.col(f"_k.{name}").alias(name) for name in by]


def _pick(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    targets: Callable[[Column], list[tuple[str, Column]]],
    unit: float,
    count: Column | None = None,
) -> DataFrame:
    """Values at given 0-based positions of the ascending order, per group.

    ``targets`` maps the group size to (label, position) pairs. Returns ``_k, _label, _v`` plus
    ``_rest``, the position inside the rows that share the value, and the group size ``_total``.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(_group_key(by).alias("_k"), F.col(value).alias("_v"))
        .agg((F.count(F.lit(1)) if count is None else count).alias("_n"))
        .withColumn("_slot", slot_of(F.col("_v"), unit))
    )
    group = Window.partitionBy("_k")
    pairs = targets(F.col("_total"))
    wanted = F.explode(
        F.array(*[F.struct(F.lit(label).alias("label"), pos.cast("long").alias("pos")) for label, pos in pairs])
    )
    slots = (
        counts.groupBy("_k", "_slot")
        .agg(
            F.sum("_n").alias("_n"),
            F.min("_v").alias("_low"),
            F.max("_v").alias("_high"),
            F.count(F.lit(1)).alias("_values"),
        )
        .withColumn("_total", F.sum("_n").over(group))
        .withColumn("_upto", F.sum("_n").over(group.orderBy("_slot")))
        .withColumn("_target", wanted)
        .withColumn("_rest", F.col("_target.pos") - (F.col("_upto") - F.col("_n")))
        .where("_rest >= 0 AND _target.pos < _upto")
        .select("_k", "_slot", "_total", F.col("_target.label").alias("_label"), "_rest", "_low", "_high", "_values")
    )
    aimed = counts.join(slots, ["_k", "_slot"]).withColumn(
        "_part", _part_of(F.col("_v"), F.col("_low"), F.col("_high"), F.col("_values"))
    )
    parts = (
        aimed.groupBy("_k", "_label", "_part")
        .agg(F.sum("_n").alias("_n"), F.max("_rest").alias("_rest"))
        .withColumn("_upto", F.sum("_n").over(Window.partitionBy("_k", "_label").orderBy("_part")))
        .withColumn("_rest", F.col("_rest") - (F.col("_upto") - F.col("_n")))
        .where("_rest >= 0 AND _rest < _n")
        .select("_k", "_label", "_part", "_rest")
    )
    inside = Window.partitionBy("_k", "_label").orderBy("_v")
    return (
        aimed.select("_k", "_label", "_part", "_v", "_n", "_total")
        .join(parts, ["_k", "_label", "_part"])
        .withColumn("_upto", F.sum("_n").over(inside))
        .withColumn("_rest", F.col("_rest") - (F.col("_upto") - F.col("_n")))
        .where("_rest >= 0 AND _rest < _n")
        .select("_k", "_label", "_v", "_rest", "_total")
    )


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    unit: float = 1.0,
    count: Column | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``probs``.

    ``count`` replaces the row count when rows already carry multiplicities.
    """

    def targets(size: Column) -> list[tuple[str, Column]]:
        found = []
        for name, p in probs.items():
            at = (size - 1) * F.lit(float(p))
            found += [(f"{name}:lo", F.floor(at)), (f"{name}:hi", F.ceil(at))]
        return found

    def at(label: str) -> Column:
        return F.max(F.when(F.col("_label") == label, F.col("_v").cast("double")))

    picked = _pick(df, by, value, targets, unit, count).groupBy("_k").agg(
        F.max("_total").alias("_total"),
        *[at(f"{n}:{end}").alias(f"_{n}_{end}") for n in probs for end in ("lo", "hi")],
    )
    columns = []
    for name, p in probs.items():
        place = (F.col("_total") - 1) * F.lit(float(p))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        columns.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return picked.select(*_restore(by), *columns)


def positioned(
    df: DataFrame, by: Sequence[str], value: str, position: Callable[[Column], Column], name: str, unit: float = 1.0
) -> DataFrame:
    """The value at a 0-based ascending position that depends on the group size; no row if out of range."""
    picked = _pick(df, by, value, lambda size: [("at", position(size))], unit)
    return picked.select(*_restore(by), F.col("_v").alias(name))


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    weights: Mapping[str, Column],
    descending: bool = False,
    unit: float = 1.0,
) -> DataFrame:
    """Per distinct value: each weight, its running total ``<w>_upto`` and group total ``<w>_total``."""
    per_value = (
        df.where(F.col(value).isNotNull())
        .groupBy(_group_key(by).alias("_k"), F.col(value).alias("_v"))
        .agg(*[w.alias(name) for name, w in weights.items()])
        .withColumn("_slot", slot_of(F.col("_v"), unit))
        # always so; said here, the joins below infer nothing that would make three shuffles of one
        .where("_slot IS NOT NULL")
    )
    direction = F.desc if descending else F.asc
    group = Window.partitionBy("_k")
    ends = [F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count(F.lit(1)).alias("_values")]
    slots = per_value.groupBy("_k", "_slot").agg(*[F.sum(w).alias(w) for w in weights], *ends)
    slots = slots.select(
        "_k",
        "_slot",
        *("_low", "_high", "_values"),
        *[F.sum(w).over(group).alias(f"{w}_total") for w in weights],
        *[(F.sum(w).over(group.orderBy(direction("_slot"))) - F.col(w)).alias(f"_{w}_before") for w in weights],
    )
    placed = per_value.join(slots, ["_k", "_slot"]).withColumn(
        "_part", _part_of(F.col("_v"), F.col("_low"), F.col("_high"), F.col("_values"))
    )
    in_slot = Window.partitionBy("_k", "_slot").orderBy(direction("_part"))
    parts = placed.groupBy("_k", "_slot", "_part").agg(*[F.sum(w).alias(w) for w in weights])
    parts = parts.select(
        *("_k", "_slot", "_part"), *[(F.sum(w).over(in_slot) - F.col(w)).alias(f"_{w}_inner") for w in weights]
    )
    inside = Window.partitionBy("_k", "_slot", "_part").orderBy(direction("_v"))
    return (
        placed.join(parts, ["_k", "_slot", "_part"])
        .select(
            *_restore(by),
            F.col("_v").alias(value),
            *weights,
            *[
                (F.col(f"_{w}_before") + F.col(f"_{w}_inner") + F.sum(w).over(inside)).alias(f"{w}_upto")
                for w in weights
            ],
            *[f"{w}_total" for w in weights],
        )
    )


def mid_ranks(
    df: DataFrame,
    value: str,
    weights: Mapping[str, Column] | None = None,
    count: Column | None = None,
    unit: float = 1.0,
    few: bool = False,
) -> DataFrame:
    """Distinct values with their count ``n``, mid-rank ``rank`` and population size ``n_total``.

    ``count`` replaces the row count when rows already carry multiplicities. ``few`` says that the values have a
    small domain, such as averages of a five-point score: their counts then go through one plain window.
    """
    counts = {"n": F.count(F.lit(1)) if count is None else count, **(weights or {})}
    if few:
        per_value = df.where(F.col(value).isNotNull()).groupBy(value).agg(*[w.alias(name) for name, w in counts.items()])
        upto, whole = Window.orderBy(value), Window.partitionBy()
        ranked = per_value.withColumns(
            {f"{w}_upto": F.sum(w).over(upto) for w in counts} | {f"{w}_total": F.sum(w).over(whole) for w in counts}
        )
    else:
        ranked = running_totals(df, (), value, counts, unit=unit)
    return ranked.withColumn("rank", F.col("n_upto") - F.col("n") + (F.col("n") + 1) / 2)


def ntile(df: DataFrame, value: str, tie: str, tiles: int, name: str, unit: float = 1.0) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY value NULLS LAST, tie)`` as a new column."""
    return ntiles(df, {name: value}, tie, tiles, unit)


def ntiles(df: DataFrame, values: Mapping[str, str], tie: str, tiles: int, unit: float = 1.0) -> DataFrame:
    """A new column of ``NTILE(tiles) OVER (ORDER BY value NULLS LAST, tie)`` for each name and value of ``values``.

    Only the ``tiles - 1`` boundary keys of every value are searched for, all in one pass over the long form;
    rows then compare against them in place, so the rows themselves are neither sorted nor shuffled.
    """
    sorted_by = {name: F.coalesce(F.col(v).cast("double"), F.lit(NULLS_LAST)) for name, v in values.items()}
    wide = df.select(F.col(tie).alias("_tie"), *[v.alias(name) for name, v in sorted_by.items()])
    keyed = wide.unpivot("_tie", list(values), "_c", "_v")

    def last_of_tile(size: Column) -> list[tuple[str, Column]]:
        whole, extra = F.floor(size / tiles), size % tiles
        return [(str(j), whole * j + F.least(F.lit(j), extra) - 1) for j in range(1, tiles)]

    edges = _pick(keyed, ["_c"], "_v", last_of_tile, unit).select(*_restore(["_c"]), "_label", "_v", "_rest")
    # edges, bounds and tie parts hold one row per boundary, at most (tiles - 1) * values
    tied = keyed.join(F.broadcast(edges), ["_c", "_v"])
    one = ["_c", "_label"]
    bounds = tied.groupBy(*one).agg(F.min("_tie").alias("_low"), F.max("_tie").alias("_high"), F.count(F.lit(1)).alias("_rows"))
    kind = keyed.schema["_tie"].dataType
    tied = tied.join(F.broadcast(bounds), one).withColumn(
        "_part", _tie_part(kind, F.col("_tie"), F.col("_low"), F.col("_high"), F.col("_rows"))
    )
    label = Window.partitionBy(*one)
    tie_parts = (
        tied.groupBy(*one, "_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_rest").alias("_rest"))
        .withColumn("_upto", F.sum("_n").over(label.orderBy("_part")))
        .withColumn("_rest", F.col("_rest") - (F.col("_upto") - F.col("_n")))
        .where("_rest >= 0 AND _rest < _n")
        .select(*one, "_part", "_rest")
    )
    found = (
        tied.select(*one, "_part", "_v", "_tie")
        .join(F.broadcast(tie_parts), [*one, "_part"])
        .withColumn("_at", F.row_number().over(label.orderBy("_tie")) - 1)
        .where("_at = _rest")
    )

    def cut(name: str, j: int) -> Column:
        return F.max(F.when((F.col("_c") == name) & (F.col("_label") == str(j)), F.struct("_v", "_tie")))

    cuts = found.agg(F.struct(*[F.array(*[cut(n, j) for j in range(1, tiles)]).alias(n) for n in values]).alias("cuts"))
    df = df.withColumn("_cuts", cuts.scalar())
    for name, v in sorted_by.items():
        own = F.struct(v.alias("_v"), F.col(tie).alias("_tie"))
        place = F.lit(1)
        for j in range(tiles - 1):
            place = place + (own > F.col("_cuts")[name][j]).cast("int")
        df = df.withColumn(name, place)
    return df.drop("_cuts")


def numbered(
    df: DataFrame, key: str, order_by: Sequence[str], name: str, group_limit: int = MAX_NUMBERED_GROUP
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order_by)`` that survives a hot key.

    Keys above ``group_limit`` rows are cut along the first two order columns and numbered piecewise
    with offsets. At most rows / group_limit keys are hot, which bounds the broadcast sides.
    """
    first, second = order_by[0], order_by[1]
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > group_limit)
    marked = df.join(F.broadcast(hot.select(key, F.lit(True).alias("_hot"))), key, "left")
    sliced = marked.withColumn("_cut", F.when(F.col("_hot"), F.struct(F.col(first), slot_of(F.col(second)).alias("s"))))
    pieces = sliced.where("_hot").groupBy(key, "_cut").agg(F.count(F.lit(1)).alias("_n"))
    in_key = Window.partitionBy(key).orderBy("_cut")
    offsets = pieces.select(key, "_cut", (F.sum("_n").over(in_key) - F.col("_n")).alias("_offset"))
    piece = Window.partitionBy(key, "_cut").orderBy(*order_by)
    return (
        sliced.withColumn("_row", F.row_number().over(piece))
        .join(offsets, [key, "_cut"], "left")
        .withColumn(name, (F.col("_row") + F.coalesce("_offset", F.lit(0))).cast("int"))
        .drop("_hot", "_cut", "_row", "_offset")
    )
