"""File layout from measured bytes, clustered by two columns (L1, L2).

``file_count``       files so that each has about ``target`` bytes: from a written sample
``write_clustered``  rows along a Z-order curve over two columns, so that a range filter on
                     either of them skips files by their statistics
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions import qcol
from tablekit.session import remove_dir, shared_dir

#: Bits of each column in the curve, and rows of the sample at most.
CURVE_BITS, SAMPLE_ROWS = 6, 200_000
#: Places of the curve a file has at least for its ends to follow blocks of the curve, and by
#: which share of a file's rows such an end may lie beside an equal share.
PLACES_PER_FILE, SHIFT = 16, 0.15


def file_count(df: DataFrame, target: int, sample_rows: int = SAMPLE_ROWS) -> int:
    """How many Parquet files of about ``target`` bytes the rows make.

    One count, and a sample that is written and measured, as only the writer knows how well
    the columns are encoded.  Every task samples its own part of the rows; only the sample
    goes to the one task that writes it.
    """
    spark, n = df.sparkSession, df.count()
    if not n:
        return 1
    path = shared_dir(spark, "layout-sample")
    try:
        df.sample(min(1.0, sample_rows / n), seed=7).repartition(1).write.parquet(path)
        size = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length")).first()[0]
        rows = spark.read.parquet(path).count()
    finally:
        remove_dir(spark, path)
    return max(1, round(n * (size or 0) / max(1, rows) / target))


def _rank(column: Column, bounds: list[float]) -> Column:
    """Between which of the sorted bounds a value lies, by halving; nulls first."""
    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column > bounds[middle], below(middle + 1, high)).otherwise(below(low, middle))

    return F.when(column.isNull(), F.lit(0)).otherwise(below(0, len(bounds)))


def curve(df: DataFrame, first: str, second: str, bits: int = CURVE_BITS) -> Column:
    """The place of a row on a Z-order curve over the ranks of two numeric or time columns.

    Nulls have their share of the ranks, below all values, so that a block of the curve has
    about the rows of any other.
    """
    values = [qcol(c).cast("timestamp").cast("double") if df.schema[c].dataType.simpleString() in ("date", "timestamp", "timestamp_ntz")
              else qcol(c).cast("double") for c in (first, second)]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    bounds = df.select(*[F.coalesce(v, F.lit(float("-inf"))).alias(str(k)) for k, v in enumerate(values)]).approxQuantile(["0", "1"], shares, 0.25 / (1 << bits))
    out = F.lit(0)
    for k, (value, cut) in enumerate(zip(values, bounds)):
        rank = _rank(value, cut)
        for bit in range(bits):
            out = out + F.shiftright(rank, bit) % 2 * (1 << (2 * bit + 1 - k))
    return out


def _ends(counts: list[tuple[int, int]], files: int) -> list[int] | None:
    """The places with which a new file starts, near equal shares of the rows: the start of the largest block of
    the curve there, as a file that ends inside a block shares it with the next one.  None if a place has too many rows."""
    share = sum(n for _, n in counts) / files
    if max(n for _, n in counts) > SHIFT * share:
        return None
    starts, before = [], 0
    for place, n in sorted(counts):
        starts.append((place, before / share))
        before += n
    out = []
    for k in range(1, files):
        near = [(place & -place, -abs(at - k), place) for place, at in starts if abs(at - k) <= SHIFT]
        out.append(max(near)[2])
    return out


def write_clustered(df: DataFrame, path: str, first: str, second: str, target: int, mode: str = "errorifexists") -> int:
    """Write about ``target`` bytes a file, clustered by both columns; the number of files asked for.

    Few files end where blocks of the curve end; many, or with many rows at one place, anywhere in the order.
    """
    files, place = file_count(df, target), "__tk_curve"
    placed = df.withColumn(place, curve(df, first, second))
    order = [F.col(place), qcol(first), qcol(second)]
    ends = None
    if 1 < files <= (1 << 2 * CURVE_BITS) // PLACES_PER_FILE:
        ends = _ends([tuple(r) for r in placed.groupBy(place).count().collect()], files)
    dealt = placed.repartitionById(files, _rank(F.col(place), [p - 1 for p in ends])) if ends else placed.repartitionByRange(files, *order)
    dealt.sortWithinPartitions(*order).drop(place).write.mode(mode).parquet(path)
    return files
