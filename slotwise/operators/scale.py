"""Building blocks that keep ordered work spread over many tasks.

A window over one big group runs in one task. The helpers here cut every group
into *buckets* that follow the wanted order, do the ordered work per bucket and
join the small per-bucket totals back. Results are exact whatever the share of
rows a single group holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.session import settle, written


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be NULL; the right copies of the keys are dropped."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"__r_{key}")
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"__r_{key}" for key in keys])


def one_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str] = (), last: bool = False) -> DataFrame:
    """One row of every key, the first (or last) in ``order``; rows equal there go by their content, so the winner is always the same."""
    content = F.to_json(F.struct(*[c for c in frame.columns if c not in keys] or [F.lit(1)]))
    pick = F.max_by if last else F.min_by
    values = F.struct(*frame.columns)
    return frame.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(pick(values, F.struct(*order, content)).alias("__v")).select("__v.*")


def running(
    frame: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence,
    sums: dict[str, Column],
) -> DataFrame:
    """Running totals within ``keys`` in ``order``; ``bucket`` must not decrease along it.

    Each (keys, bucket) cell is one window partition. The cells' totals, one row per
    cell, carry the amount that precedes the cell.
    """
    keys = list(keys)
    cells = frame.withColumn("__bucket", bucket)
    for name, value in sums.items():
        cells = cells.withColumn(f"__v_{name}", value)
    totals = cells.groupBy(*keys, "__bucket").agg(
        *[F.sum(f"__v_{name}").alias(f"__t_{name}") for name in sums]
    )
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *keys,
        "__bucket",
        *[F.coalesce(F.sum(f"__t_{name}").over(earlier), F.lit(0)).alias(f"__b_{name}") for name in sums],
    )
    inside = (
        Window.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = cells.select("*", *[F.sum(f"__v_{name}").over(inside).alias(f"__l_{name}") for name in sums])
    joined = join_null_safe(local, before, [*keys, "__bucket"])
    kept = frame.columns
    return joined.select(*kept, *[(F.col(f"__l_{n}") + F.col(f"__b_{n}")).alias(n) for n in sums])


def ranked(
    frame: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence, out: str = "rank"
) -> DataFrame:
    """1-based position of each row within ``keys``; the order must be total."""
    result = running(frame, keys, bucket, order, {out: F.lit(1).cast("bigint")})
    return result.withColumn(out, F.col(out).cast("bigint"))


def neighbour(
    frame: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    value: Column,
    out: str,
    following: bool = False,
) -> DataFrame:
    """``value`` of the previous (or following) row within ``keys`` across buckets."""
    keys, order = list(keys), list(order)
    cells = frame.withColumn("__bucket", bucket).withColumn("__value", F.struct(value.alias("v")))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy("__bucket")
    position = F.struct(*order)
    if following:
        local = F.lead("__value").over(inside)
        edge, shift = F.min_by("__value", position), F.lead
    else:
        local = F.lag("__value").over(inside)
        edge, shift = F.max_by("__value", position), F.lag
    edges = cells.groupBy(*keys, "__bucket").agg(edge.alias("__edge"))
    edges = edges.select(*keys, "__bucket", shift("__edge").over(across).alias("__far"))
    joined = join_null_safe(cells.withColumn("__near", local), edges, [*keys, "__bucket"])
    return joined.select(*frame.columns, F.coalesce("__near", "__far")["v"].alias(out))


#: Cells of an octave in the first pass, parts of a cell in later ones, rows of a cell that are ordered together.
OCTAVE_CELLS = 256
CELL_PARTS = 4096
SMALL_CELL = 100_000
#: Cells of wanted ranks that are sent to all executors; more are joined by shuffle.
SENT_CELLS = 20_000


def octave_cell(value: Column) -> Column:
    """Whole number that never falls when the value rises: its magnitude in 256ths of an octave."""
    x = value.cast("double")
    size = F.least(F.floor(F.log2(F.abs(x) + 1) * OCTAVE_CELLS), F.lit(1 << 20))
    return F.when(F.isnan(x), F.lit(1 << 21)).when(x < 0, -1 - size).otherwise(size).cast("bigint")


def _spots(count: Column, requests: dict[str, tuple[float, str]]) -> dict[str, tuple[Column, Column]]:
    """0-based places in the sorted group that a request needs: one, or the two it lies between."""
    last, out = count - 1, {}
    for name, (p, method) in requests.items():
        if method == "nearest":
            low = F.least(last, F.rint(last * F.lit(p)).cast("bigint"))
            out[name] = (low, low)
        elif method == "upper":
            low = F.least(last, F.floor(count * F.lit(p)))
            out[name] = (low, low)
        elif method == "linear":
            out[name] = (F.floor(last * F.lit(p)), F.ceil(last * F.lit(p)))
        elif method == "whole":
            at = last.cast("decimal(28,0)") * _hundredths(p)
            out[name] = (F.floor(at / 100).cast("bigint"), F.ceil(at / 100).cast("bigint"))
        else:
            raise ValueError(f"unknown quantile method {method}")
    return out


def _hundredths(p: float) -> int:
    out = round(p * 100)
    if abs(out - p * 100) > 1e-9:
        raise ValueError(f"whole-number quantiles need a whole percentage, not {p}")
    return out


def _with_starts(cells: DataFrame, within: Sequence[str], order: str, before: Column) -> DataFrame:
    """Cells with ``__start``, the number of rows of the group that precede them."""
    earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("__start", before + F.coalesce(F.sum("__n").over(earlier), F.lit(0)))


def _wanted(cells: DataFrame, requests: dict[str, tuple[float, str]]) -> DataFrame:
    """The cells that hold a place some request needs; at most two a request and group."""
    hit = F.lit(False)
    for low, high in _spots(F.col("__count"), requests).values():
        for spot in (low, high):
            hit = hit | ((F.col("__start") <= spot) & (spot < F.col("__start") + F.col("__n")))
    return cells.where(hit)


def exact_quantiles(
    frame: DataFrame,
    by: Sequence[str],
    value: str,
    requests: dict[str, tuple[float, str]],
    keep_stats: bool = False,
) -> DataFrame:
    """Exact quantiles per group by selection: rows are counted by cells of magnitude, and only cells that hold a wanted
    rank are looked into again.

    The first pass counts every group's rows in cells of 1/256 octave, before any shuffle. A cell of one value is
    settled, whatever its size. Rows of the other wanted cells are counted by 4,096 parts of their cell, and so on until
    no open cell has more than ``SMALL_CELL`` rows; only those are put in order. ``nearest`` takes the value at
    round-half-even((n-1)*p), ``upper`` the value at floor(n*p), ``linear`` interpolates in doubles, ``whole``
    interpolates whole numbers exactly and truncates toward zero (p in whole hundredths). With ``keep_stats`` the columns
    ``count`` and ``total`` come from the first pass.
    """
    by = list(by)
    x = F.col("__x")
    rows = written(frame.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__x")), "quantile-values")
    rows = rows.withColumn("__cell", octave_cell(x))
    sizes = [F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi")]
    group = Window.partitionBy(*by)
    total = F.sum("__x") if keep_stats else F.lit(None).cast("long")
    cells = rows.groupBy(*by, "__cell").agg(*sizes, total.alias("__sum"))
    cells = cells.withColumns({"__count": F.sum("__n").over(group), "__total": F.sum("__sum").over(group)})
    wanted = written(_wanted(_with_starts(cells, by, "__cell", F.lit(0)), requests), "quantile-cells")

    shared = [*by, "__count", "__total"]
    settled = wanted.where("__lo = __hi").select(*shared, "__start", "__n", F.col("__lo").alias("__x"))
    while True:
        open_cells = wanted.where("__lo < __hi")
        size = open_cells.agg(F.count(F.lit(1)).alias("cells"), F.max("__n").alias("most")).first()
        if not size.cells:
            break
        side = open_cells.select(*by, "__cell", "__start", "__lo", "__hi", "__count", "__total")
        side = F.broadcast(side) if size.cells <= SENT_CELLS else side
        inside = join_null_safe(rows.select(*by, "__cell", "__x"), side, [*by, "__cell"])
        if size.most <= SMALL_CELL:
            values = inside.groupBy(*shared, "__start", "__x").agg(F.count(F.lit(1)).alias("__n"))
            values = values.withColumnRenamed("__start", "__first")
            values = _with_starts(values, [*by, "__first"], "__x", F.col("__first"))
            settled = settled.unionByName(values.drop("__first"))
            break
        part = F.floor((x - F.col("__lo")).cast("double") / (F.col("__hi") - F.col("__lo")).cast("double") * CELL_PARTS)
        part = F.coalesce(F.least(part, F.lit(CELL_PARTS - 1)), F.lit(CELL_PARTS)).cast("bigint")
        rows = written(inside.select(*shared, F.col("__start").alias("__first"), "__x", (F.col("__start") * (CELL_PARTS + 1) + part).alias("__cell")), "quantile-values")
        cells = rows.groupBy(*shared, "__first", "__cell").agg(*sizes)
        cells = _with_starts(cells, [*by, "__first"], "__cell", F.col("__first"))
        wanted = written(_wanted(cells, requests).drop("__first"), "quantile-cells")
        settled = settled.unionByName(wanted.where("__lo = __hi").select(*shared, "__start", "__n", F.col("__lo").alias("__x")))

    def at(spot: Column) -> Column:
        return F.max(F.when((F.col("__start") <= spot) & (spot < F.col("__start") + F.col("__n")), x))

    picks, outputs = [], []
    for name, (low, high) in _spots(F.col("__count"), requests).items():
        p, method = requests[name]
        picks.append(at(low).alias(f"__low_{name}"))
        if method in ("nearest", "upper"):
            outputs.append(F.col(f"__low_{name}").alias(name))
            continue
        picks.append(at(high).alias(f"__high_{name}"))
        if method == "linear":
            part = (F.col("__count") - 1) * F.lit(p)
            part = part - F.floor(part)
            a, b = F.col(f"__low_{name}").cast("double"), F.col(f"__high_{name}").cast("double")
            outputs.append(F.when(part == 0.5, (a + b) / 2).otherwise(a + (b - a) * part).alias(name))
        else:
            rest = F.pmod((F.col("__count") - 1).cast("decimal(28,0)") * _hundredths(p), F.lit(100)).cast("bigint")
            a, b = F.col(f"__low_{name}").cast("decimal(24,0)"), F.col(f"__high_{name}").cast("decimal(24,0)")
            outputs.append(F.call_function("div", a * 100 + (b - a) * rest, F.lit(100).cast("decimal(24,0)")).alias(name))
    result = settled.groupBy(*by).agg(F.max("__count").alias("__count"), F.max("__total").alias("__total"), *picks)
    if keep_stats:
        outputs += [F.col("__count").alias("count"), F.col("__total").alias("total")]
    return result.select(*by, *outputs)


#: Cells of an interval that one row lists.
CELL_BLOCK = 4096


def interval_lookup(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point: str,
    low: str,
    high: str,
    span: str,
    bins: str,
    how: str = "inner",
) -> DataFrame:
    """Join each point to the interval [low, high) that holds it, as an equi-join.

    Points and bounds count the same units on [0, span). ``span`` and ``bins`` (columns
    of both sides, constant per key) cut the range into about as many cells as there are
    intervals. An interval is repeated for every cell it touches, at most intervals +
    cells rows in all; a point has one cell, so a wide interval spreads over many cells.
    Cells are listed in blocks, so no row lists all cells of a wide interval.
    """
    keys = list(keys)

    def cell(value: Column) -> Column:
        part = value.cast("double") / F.col(span).cast("double")
        return F.least(F.col(bins) - 1, F.floor(part * F.col(bins)))

    spread = intervals.where(F.col(low) < F.col(high))
    spread = spread.withColumns({"__first": cell(F.col(low)), "__last": cell(F.col(high))})
    block = lambda c: F.floor(F.col(c) / CELL_BLOCK)
    spread = spread.withColumn("__block", F.explode(F.sequence(block("__first"), block("__last"))))
    start = F.col("__block") * CELL_BLOCK
    cells = F.sequence(F.greatest("__first", start), F.least("__last", start + (CELL_BLOCK - 1)))
    spread = spread.withColumn("__cell", F.explode(cells)).drop("__first", "__last", "__block")
    shared = [c for c in (span, bins) if c in points.columns]
    spread = spread.drop(*shared).withColumnsRenamed({name: f"__r_{name}" for name in [*keys, "__cell"]})
    placed = points.withColumn("__cell", cell(F.col(point)))
    condition = (F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))
    for name in [*keys, "__cell"]:
        condition = condition & F.col(name).eqNullSafe(F.col(f"__r_{name}"))
    return placed.join(spread, condition, how).drop("__cell", *[f"__r_{name}" for name in [*keys, "__cell"]])


def key_ranges(frame: DataFrame, order: Sequence[str], rows: int = 100_000) -> DataFrame:
    """The frame with ``__range``: a bucket that follows the order, of about ``rows`` rows.

    Rows are range partitioned once and written to the checkpoint folder, so that later
    steps see the same ranges, also after a lost executor.
    """
    least = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-frame.count() // rows))
    return settle(frame.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()))


def global_position(frame: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """0-based position of each row in a total order over the whole frame.

    Only one count per range of rows is ordered together.
    """
    ranged = key_ranges(frame, order)
    result = running(ranged, [], F.col("__range"), list(order), {out: F.lit(1).cast("bigint")})
    return result.withColumn(out, (F.col(out) - 1).cast("bigint")).drop("__range")


def heavy_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    total: int,
    parts: int = 1024,
) -> DataFrame:
    """Join facts to a table with one row per key when some keys are very frequent.

    A key with more than total/parts facts is heavy; there are fewer than ``parts`` of
    them, whatever the data, so that slice is broadcast. All other keys are shuffled.
    ``weight`` is the lookup column with the number of facts of the key.
    """
    limit = max(1, total // parts)
    values = [name for name in lookup.columns if name not in (key, weight)]
    heavy = lookup.where(F.col(weight) > limit).select(key, F.struct(*values).alias("__heavy"))
    light = lookup.where(F.col(weight) <= limit).select(key, F.struct(*values).alias("__light"))
    marked = facts.join(F.broadcast(heavy), key, "left")
    fast = marked.where(F.col("__heavy").isNotNull()).select(*facts.columns, F.col("__heavy").alias("__hit"))
    slow = (
        marked.where(F.col("__heavy").isNull())
        .drop("__heavy")
        .join(light, key, "inner")
        .select(*facts.columns, F.col("__light").alias("__hit"))
    )
    return fast.unionByName(slow).select(*facts.columns, "__hit.*")


#: Numbers of one row that are listed together, and rows that one task should make.
NUMBER_CHUNK, TASK_ROWS = 65_536, 2_000_000
CHUNK = "__chunk"


def numbered_rows(frame: DataFrame, count: str, out: str, factor: int = 1) -> DataFrame:
    """Every row once for each number from 0 below its ``count``, with the number as ``out``.

    A small table may stand for very many rows, so rows are cut to chunks of numbers and dealt before they are listed, to as
    many tasks as the whole needs (``factor``: what each number becomes later). ``CHUNK`` keeps the first number of the chunk:
    grouping by it and all columns of the frame needs no further shuffle.
    """
    whole = frame.agg(F.sum(F.greatest(F.col(count), F.lit(0)).cast("decimal(38,0)"))).first()[0] or 0
    top, step = F.col(count).cast("bigint"), max(1, NUMBER_CHUNK // factor)
    starts = F.sequence(F.lit(0).cast("bigint"), top - 1, F.lit(step).cast("bigint"))
    chunks = frame.where(F.col(count) > 0).withColumn(CHUNK, F.explode(starts))
    parts = max(1, -(-int(whole) * factor // TASK_ROWS))
    dealt = chunks.repartition(parts, *frame.columns, CHUNK)
    return dealt.withColumn(out, F.explode(F.sequence(F.col(CHUNK), F.least(F.col(CHUNK) + step, top) - 1)))


def hash_prefix_bucket(digest: Column, hex_digits: int = 3) -> Column:
    """Bucket that follows the order of a hex digest: its leading digits."""
    return F.substring(digest, 1, hex_digits)
