"""Running counts, sums and maxima over groups of any size.

A plain window puts a whole group into one task. Here a group is cut into
chunks of the order column. The totals of the earlier chunks enter each chunk
as one extra row in front, and every chunk is scanned on its own. The rows are
shuffled once and nothing is joined. The order column must be an integer; with
a unique one a chunk holds at most 2**bits rows.

Where values lie far apart (sparse ids, nanoseconds) there are nearly as many
totals as rows. The totals of earlier chunks are therefore running sums of the
same kind, one level up: they are cut into chunks of 2**UPPER chunks, and so on
until a group has at most 2**UPPER chunks over the whole range of the type. No
task sorts more than that of one group on any level. Upper levels carry the
order and the sums only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 18
UPPER = 23
# Bits of a place in a log: counted from 0 without large gaps, so one level is enough.
PLACES = 41


# Bits of the integer types.
SPANS = {"byte": 8, "short": 16, "integer": 32, "long": 64}


def chunk_of(column: str | Column, bits: int = CHUNK_BITS) -> Column:
    """Chunk number of an integer order column."""
    return F.shiftright(F.col(column) if isinstance(column, str) else column, bits)


def running(
    df: DataFrame,
    group: list[str],
    order: list[str],
    specs: dict[str, tuple[str, Column | None]],
    *,
    bits: int = CHUNK_BITS,
    lead: list[str] | None = None,
    descending: bool = False,
    exclusive: bool = False,
    upper: int = UPPER,
    span: int | None = None,
) -> DataFrame:
    """Add running aggregates per ``group`` in ``order``.

    ``specs`` maps an output column to ``(kind, value)`` with kind ``count``,
    ``sum`` or ``max`` up to the row, or ``total`` for the sum of the whole
    group. ``lead`` names order columns that come before the chunked one and
    are few (a partition number). ``exclusive`` leaves the current row out; a
    count or sum is then 0 and a max null on the first row. ``span`` is the
    number of bits the order column can use, by default those of its type.
    """
    span = span or SPANS.get(df.schema[order[0]].dataType.typeName(), 64)
    chunk = f"__chunk{span}"  # one name per level
    keys = [*group, *(lead or []), chunk]
    inputs = [
        (name, kind, f"__v{i}", F.lit(1).cast("long") if kind == "count" else value)
        for i, (name, (kind, value)) in enumerate(specs.items())
    ]

    def directed(names):
        return [F.col(n).desc() if descending else F.col(n).asc() for n in names]

    def aggregate(kind, column):
        return F.max(column) if kind == "max" else F.sum(column)

    rows = df.select(
        "*", chunk_of(order[0], bits).alias(chunk), F.lit(1).alias("__row"), *[v.alias(c) for _, _, c, v in inputs]
    )
    totals = rows.groupBy(*keys).agg(*[aggregate(k, c).alias(c) for _, k, c, _ in inputs])
    if span - bits > upper:
        # Counts of chunks are sums one level up.
        sums = {c: ("sum" if k == "count" else k, F.col(c)) for _, k, c, _ in inputs}
        renamed = totals.withColumnsRenamed({c: f"{c}_{span}" for c in sums})
        sums = {c: (k, F.col(f"{c}_{span}")) for c, (k, _) in sums.items()}
        above = running(renamed, group, [chunk], sums, bits=upper, lead=lead, descending=descending, exclusive=True,
                        upper=upper, span=span - bits)
        heads = above.select(*keys, F.lit(0).alias("__row"), *sums)
    else:
        earlier = Window.partitionBy(*group).orderBy(*directed(keys[len(group) :])).rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*group)
        heads = totals.select(
            *keys,
            F.lit(0).alias("__row"),
            *[aggregate(k, c).over(whole if k == "total" else earlier).alias(c) for _, k, c, _ in inputs],
        )
    last = -1 if exclusive else Window.currentRow
    scan = Window.partitionBy(*keys).orderBy("__row", *directed(order)).rowsBetween(Window.unboundedPreceding, last)
    outs = []
    for name, kind, c, _ in inputs:
        if kind == "total":
            outs.append(F.first(c).over(scan).alias(name))
        elif kind == "max":
            outs.append(F.max(c).over(scan).alias(name))
        else:
            outs.append(F.coalesce(F.sum(c).over(scan), F.lit(0)).alias(name))
    both = rows.unionByName(heads, allowMissingColumns=True)
    return both.select(*df.columns, "__row", *outs).filter("__row = 1").drop("__row")


def row_numbers(
    df: DataFrame, group: list[str], order: list[str], name: str = "rn", **options
) -> DataFrame:
    """Dense numbers from 1 per group in order, for groups of any size."""
    return running(df, group, order, {name: ("count", None)}, **options)
