"""Exact global row numbers and order statistics without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row into one
task. Instead ``global_row_number``:

1. range-partitions the rows on the full sort order (Spark samples the keys and cuts
   the key space into P contiguous ranges; a heavy tie on the first sort column is
   split by the later columns, so no range holds a hot group), sorts each range and
   tags every row with its partition and position (``monotonically_increasing_id``:
   partition in the high bits, position in the low 33 bits);
2. writes that as a table in the shared folder, so that the two consumers below read
   the very same tags, also after an executor is lost;
3. counts rows per partition (P rows) and turns the counts into offsets with a running
   sum over those P rows; the offsets are broadcast (size bounded by P);
4. row number = offset of the partition + position inside the partition.

``rows_at`` finds the rows at a few positions of total orders (cut points of quantiles,
medians) without ranking or shuffling rows, by radix selection on a composite key. One
aggregation finds the range of every order column; with it each column becomes whole
numbers from 0 of known width that sort as the column does (``key_fields``), and the columns of an
order one behind the other are a bit string. Every further step counts, in one aggregation
for all positions of all orders, rows by the next ``DIGIT`` bits within the brackets (equal
bits so far) that hold a position, until a bracket has at most ``BRACKET_ROWS`` rows; a last one
reads those. So ``df`` is read once per digit, however many positions there are; what
reaches the driver is at most 2 ** ``DIGIT`` counts per open bracket.

The same plan runs at every size. The order must be total (end it with a unique key);
ties would otherwise be broken by whatever order the ranges are read in.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               StringType, TimestampNTZType, TimestampType)

from clientele.session import cut_lineage, shuffle_partitions

_PID = "_rank_pid"
_MID = "_rank_mid"

DIGIT = 12
COMPARED = 5  # digits compared together: as many as a long holds
BRACKET_ROWS = 256


def default_partitions(df: DataFrame) -> int:
    return shuffle_partitions(df.sparkSession)


def global_row_number(df: DataFrame, order: Sequence[Column], rank_col: str = "row_number",
                      count_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1..n in the given total order; optionally ``count_col`` = n."""
    p = partitions or default_partitions(df)
    ranged = df.repartitionByRange(p, *order).sortWithinPartitions(*order)
    located = cut_lineage(ranged.select("*", F.spark_partition_id().alias(_PID),
                                        F.monotonically_increasing_id().alias(_MID)))
    sizes = located.groupBy(_PID).agg(F.count(F.lit(1)).alias("_rank_size"))
    running = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(
        _PID,
        (F.sum("_rank_size").over(running) - F.col("_rank_size")).alias("_rank_offset"),
        F.sum("_rank_size").over(Window.partitionBy()).alias("_rank_total"),
    )
    out = located.join(F.broadcast(offsets), _PID)
    position = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    out = out.withColumn(rank_col, F.col("_rank_offset") + position + F.lit(1))
    if count_col:
        out = out.withColumn(count_col, F.col("_rank_total"))
    return out.drop(_PID, _MID, "_rank_offset", "_rank_total")


Order = Sequence[tuple[str, bool]]  # column, ascending


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).asc() if ascending else F.col(c).desc() for c, ascending in order]


def sql_literal(value) -> str:
    """SQL text of a value collected from an order column."""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return f"{value}L" if value >= 0 else f"(-{-value}L)"
    if isinstance(value, Decimal):
        return f"CAST('{value}' AS DECIMAL(38, {max(0, -value.as_tuple().exponent)}))"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def at_or_before(order: Order, values: Sequence) -> str:
    """SQL condition: does a row stand at or before ``values`` in the order?

    Text, because hundreds of these conditions are counted in one aggregation."""
    (column, ascending), value = order[-1], sql_literal(values[-1])
    met = f"`{column}` {'<=' if ascending else '>='} {value}"
    for (column, ascending), value in list(zip(order, map(sql_literal, values)))[-2::-1]:
        met = f"`{column}` {'<' if ascending else '>'} {value} OR (`{column}` = {value} AND ({met}))"
    return f"({met})"


Field = tuple[Column, int]  # whole numbers from 0, bits


def _limits(df: DataFrame, column: str) -> list[Column]:
    """What ``key_fields`` has to know of a column: smallest and largest value, or byte length."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, StringType):
        return [F.lit(0), F.coalesce(F.max(F.octet_length(c)), F.lit(0))]
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        size = F.abs(c.cast("double"))
        return [F.min(F.when(size > 0, size)), F.max(size)]
    return [F.min(c), F.max(c)]


def key_fields(column: str, kind: DataType, low, high) -> list[Field]:
    """Fields that sort, one after the other, as the column's values from low to high do.
    (For fractions: as values of that size, for texts: of that many bytes, at most.)

    Finite numbers, dates, timestamps, booleans and texts (by bytes)."""
    c = F.col(column)
    if isinstance(kind, StringType):
        data, fields = c.cast("binary"), []
        for at in range(0, high, 7):  # seven bytes in a field, missing ones as 0, then the length
            part = F.rpad(F.substring(data, at + 1, 7), 7, F.lit(b"\0"))
            fields.append((F.conv(F.hex(part), 16, 10).cast("long"), 56))
        return [*fields, (F.octet_length(c).cast("long"), int(high).bit_length())]
    if isinstance(kind, (DoubleType, FloatType)):
        c = c.cast("double")
        if not high:
            return []
        top, bottom = math.frexp(high)[1], math.frexp(low)[1] - 53  # binary places of all values
        size, fields = F.abs(c), []
        for end in range(top - 52, bottom - 52, -52):  # 52 places each; all steps are exact
            rest = size if end + 52 >= top else size % F.lit(math.ldexp(1.0, end + 52))
            for factor in (end // 2, end - end // 2):  # 2 ** end may be no number
                rest = rest / F.lit(math.ldexp(1.0, factor))
            fields.append((F.signum(c).cast("long") * F.floor(rest).cast("long") + F.lit(1 << 52), 54))
        return fields
    if isinstance(kind, DecimalType):
        steps = (c - F.lit(low)).cast(f"decimal(38,{kind.scale})") * _power_of_ten(kind.scale)
        size = int((high - low).scaleb(kind.scale))
        if size.bit_length() <= 62:
            return [(steps.cast("long"), size.bit_length())]
        whole, fields = steps.cast("decimal(38,0)"), []
        for at in (30, 15, 0):
            rest = whole % _power_of_ten(at + 15) if at < 30 else whole
            below = rest % _power_of_ten(at) if at else F.lit(0).cast("decimal(38,0)")
            fields.append((F.call_function("div", (rest - below).cast("decimal(38,0)"), _power_of_ten(at)).cast("long"), 50))
        return fields
    if isinstance(kind, BooleanType):
        return [(c.cast("long"), 1)]
    if isinstance(kind, DateType):
        epoch = datetime.date(1970, 1, 1)
        c, low, high = F.unix_date(c).cast("long"), (low - epoch).days, (high - epoch).days
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        return [(F.unix_micros(c.cast("timestamp")) + F.lit(1 << 61), 62)]
    else:
        c = c.cast("long")
    if (high - low).bit_length() <= 62:
        return [(c - F.lit(low), (high - low).bit_length())]
    return [(F.shiftright(c, 32) + F.lit(1 << 31), 32), (c.bitwiseAND(F.lit((1 << 32) - 1)), 32)]


def _power_of_ten(n: int) -> Column:
    return F.lit(str(10 ** n)).cast("decimal(38,0)")


def _digit(fields: Sequence[Field], start: int, width: int) -> Column:
    """Bits ``start`` to ``start + width`` of the fields' bit string."""
    out, at = F.lit(0).cast("long"), 0
    for value, bits in fields:
        first, last = max(start, at), min(start + width, at + bits)
        if first < last:
            part = F.shiftright(value, at + bits - last).bitwiseAND(F.lit((1 << (last - first)) - 1).cast("long"))
            out = F.shiftleft(out, last - first) + part
        at += bits
    return out


def rows_at(df: DataFrame, n: int, wanted: dict[str, tuple[Order, Sequence[int]]]
            ) -> dict[str, dict[int, tuple]]:
    """Per name, the order columns of the rows at 1-based positions of an order.

    ``n`` is the number of rows of ``df``; no order column may be null. ``df`` is read once
    for the columns' ranges, once per digit for all orders together, and once for the rows.
    """
    if not any(positions for _, positions in wanted.values()):
        return {name: {} for name in wanted}
    columns = list(dict.fromkeys(c for order, _ in wanted.values() for c, _ in order))
    keys = df.select(*columns)
    limits = keys.agg(*(limit.alias(f"{c}_{i}") for c in columns for i, limit in enumerate(_limits(keys, c)))).first()
    fields: dict[str, list[Field]] = {}
    for name, (order, _) in wanted.items():
        fields[name] = []
        for c, ascending in order:
            for value, bits in key_fields(c, keys.schema[c].dataType, limits[f"{c}_0"], limits[f"{c}_1"]):
                if bits:
                    fields[name].append((value if ascending else F.lit((1 << bits) - 1) - value, bits))
    total = {name: sum(bits for _, bits in own) for name, own in fields.items()}

    # position -> (digits of its bracket, rows before it, rows in it)
    state = {(name, p): ((), 0, n) for name, (_, positions) in wanted.items() for p in positions}

    def bracket_of(name: str, brackets: Sequence[tuple]) -> Column:
        """Number of the bracket that a row is in, null outside of all."""
        out = F.when(F.lit(False), F.lit(0))
        for i, digits in enumerate(brackets):
            met = F.lit(True)
            for at in range(0, len(digits), COMPARED):  # several digits as one number
                width, value = 0, 0
                for k in range(at, min(at + COMPARED, len(digits))):
                    value = value << _width(name, k) | digits[k]
                    width += _width(name, k)
                met = met & (_digit(fields[name], at * DIGIT, width) == F.lit(value))
            out = out.when(met, F.lit(i))
        return out

    def _width(name: str, k: int) -> int:
        return min(DIGIT, total[name] - k * DIGIT)

    def marked(brackets: dict[str, list[tuple]], with_digit: bool) -> DataFrame:
        """One row for every bracket of any order that a row is in."""
        marks = []
        for i, (name, own) in enumerate(brackets.items()):
            if own:
                k = len(own[0])
                digit = _digit(fields[name], k * DIGIT, _width(name, k)) if with_digit else F.lit(0).cast("long")
                marks.append(F.struct(F.lit(i).alias("order"), bracket_of(name, own).alias("bracket"),
                                      digit.alias("digit")))
        seen = keys.select(*columns, F.explode(F.array(*marks)).alias("_mark"))
        return seen.where(F.col("_mark.bracket").isNotNull())

    names = list(wanted)
    while True:
        brackets: dict[str, list[tuple]] = {
            name: sorted({digits for (other, _), (digits, _, size) in state.items()
                          if other == name and size > BRACKET_ROWS and len(digits) * DIGIT < total[name]})
            for name in names}
        if not any(brackets.values()):
            break
        counted: dict[tuple, list[tuple[int, int]]] = {}
        for row in marked(brackets, True).groupBy("_mark").count().collect():
            mark = row["_mark"]
            own = names[mark["order"]]
            counted.setdefault((own, brackets[own][mark["bracket"]]), []).append((mark["digit"], row["count"]))
        for key, (digits, before, size) in list(state.items()):
            name, p = key
            if (name, digits) in counted:
                for digit, rows in sorted(counted[name, digits]):
                    if before + rows >= p:
                        state[key] = ((*digits, digit), before, rows)
                        break
                    before += rows
    # brackets of one order may have ended after different numbers of digits
    ends: dict[tuple[str, int], list[tuple]] = {}
    for (name, _), (digits, _, _) in state.items():
        ends.setdefault((name, len(digits)), []).append(digits)
    marks = [F.struct(F.lit(i).alias("end"), bracket_of(name, sorted(set(own))).alias("bracket"))
             for i, ((name, _), own) in enumerate(ends.items())]
    last = keys.select(*columns, F.explode(F.array(*marks)).alias("_mark")).where(F.col("_mark.bracket").isNotNull())
    held: dict[tuple, list] = {}
    for row in last.groupBy("_mark", *columns).count().collect():  # equal rows come once, with their number
        key = list(ends)[row["_mark"]["end"]]
        digits = sorted(set(ends[key]))[row["_mark"]["bracket"]]
        held.setdefault((key[0], digits), []).append(
            (tuple(row[c] for c, _ in wanted[key[0]][0]), row["count"]))
    out: dict[str, dict[int, tuple]] = {name: {} for name in wanted}
    for (name, p), (digits, before, _) in state.items():
        own = dict(held[name, digits])
        for values in sort_rows(list(own), wanted[name][0]):
            before += own[values]
            if before >= p:
                out[name][p] = values
                break
    return out


def sort_rows(rows: list[tuple], order: Order) -> list[tuple]:
    for k in reversed(range(len(order))):
        rows = sorted(rows, key=lambda r: r[k], reverse=not order[k][1])
    return rows


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows in ``order`` (make it total) with a 1-based ``Rank`` column (BIGINT).

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: every task keeps its k best
    rows and only those are merged, so no task sees more than k rows per input task.
    The Rank window then runs over the k survivors only.
    """
    top = df.orderBy(*order).limit(k)
    return top.withColumn("Rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
