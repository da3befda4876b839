"""CSV feeds whose files have headers of their own, and runs that remember what they have read.

``header_catalogue``  one row for each file: its size, time and header, from the first lines
``read_feed``         every file under its own header; columns are matched by name
``ingest_run``        audited ingest of the files that no earlier run has published

A catalogue task reads the first lines of one file split and stops, so its cost follows
the number of files, not of rows.  Files with the same header are a layout.  A layout is
one scan under one schema; what a column is called decides where its values go, not where
it stands.  Without a schema the types of each layout are inferred and joined over the
type lattice (``joined``), and then every layout is parsed with the joined types, so that
``007`` stays text where another file has letters.

A run writes its rows and its manifest (a row for each file: path, length, time, rows) to
a hidden folder and publishes both by one rename.  A run that ends before the rename has
published nothing; one that ends after it has published all.  The next run compares paths,
lengths and times with the manifests and opens only files that are not there.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions import qcol
from tablekit.operators.ingest import _BLK, add_file_seq_id
from tablekit.session import publish_dir, remove_dir, shared_dir

#: Layouts in one feed; each is a scan of its own.
MAX_LAYOUTS = 200
_FILE = "path string, source_file string, length long, modificationTime timestamp"


def list_files(spark: SparkSession, src: str, glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """(path, source_file, length, modificationTime) of the files under ``src``; none of them is opened.

    ``source_file`` is the path as the rows of a scan name it.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", recursive).load(src).select(
        "path", F.col("_metadata.file_path").alias("source_file"), "length", "modificationTime")


def header_catalogue(spark: SparkSession, files: Sequence[str], sep: str = ",", quote: str = '"') -> DataFrame:
    """(path, header): the column names of each file that has a line."""
    # One file split in a task, so that a task can stop after its first lines.
    own = spark.newSession()
    for key, value in (("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes")),
                       ("spark.sql.execution.arrow.maxRecordsPerBatch", "64")):
        own.conf.set(key, value)
    lines = own.read.text(list(files)).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start"))

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and batch.column("start")[0].as_py():
                return                              # not the beginning of a file
            for value, name in zip(batch.column("value").to_pylist(), batch.column("source_file").to_pylist()):
                if value.strip():
                    header = next(csv.reader([value.removeprefix("\ufeff")], delimiter=sep, quotechar=quote))
                    yield pa.RecordBatch.from_pydict({"path": [unquote(name)], "header": [[c.strip() for c in header]]},
                                                     pa.schema([("path", pa.string()), ("header", pa.list_(pa.string()))]))
                    return

    found = lines.mapInArrow(first_lines, "path string, header array<string>")
    # Small splits of one file may begin with blank lines each; the file's first one counts.
    return found.groupBy("path").agg(F.first("header").alias("header"))


def joined(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both, text if nothing narrower does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    ladders = ([T.IntegerType, T.LongType, T.DecimalType, T.DoubleType], [T.DateType, T.TimestampNTZType, T.TimestampType])
    for ladder in ladders:
        kinds = [type(x) for x in (a, b)]
        if all(k in ladder for k in kinds):
            if T.DecimalType in kinds:
                return _decimals(a, b)
            return max((a, b), key=lambda x: ladder.index(type(x)))
    return T.StringType()


def _decimals(a: T.DataType, b: T.DataType) -> T.DataType:
    digits = {T.IntegerType: (10, 0), T.LongType: (20, 0)}
    if any(isinstance(x, T.DoubleType) for x in (a, b)):
        return T.DoubleType()
    sizes = [(x.precision, x.scale) if isinstance(x, T.DecimalType) else digits[type(x)] for x in (a, b)]
    scale, whole = max(s for _, s in sizes), max(p - s for p, s in sizes)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


class Layout:
    """Files that share a header."""

    def __init__(self, header: Sequence[str], files: Sequence[str]):
        self.header, self.files = list(header), sorted(files)
        self.names = [c.lower() for c in header]
        if len(set(self.names)) < len(self.names):
            raise ValueError(f"{self.files[0]} names a column twice: {header}")

    def read(self, spark: SparkSession, kinds: dict[str, T.DataType] | None, **options) -> DataFrame:
        reader = spark.read.option("header", "true").options(**{k: str(v) for k, v in options.items()})
        if kinds is None:
            reader = reader.option("inferSchema", "true")
        else:   # by position under the file's own names; names that are not asked for are text
            reader = reader.schema(T.StructType([
                T.StructField(c, kinds.get(c.lower(), T.StringType())) for c in self.header]))
        return reader.csv(self.files)


def layouts(spark: SparkSession, files: Sequence[str], sep: str = ",", quote: str = '"') -> list[Layout]:
    """The layouts of the files, the one with the smallest path first."""
    rows = (header_catalogue(spark, files, sep, quote).groupBy("header")
            .agg(F.collect_list("path").alias("files"), F.min("path").alias("first")).orderBy("first"))
    out = [Layout(r.header, r.files) for r in rows.limit(MAX_LAYOUTS + 1).collect()]
    if len(out) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different headers")
    return out


def feed_schema(spark: SparkSession, found: Sequence[Layout], **options) -> T.StructType:
    """All columns of all layouts, in the order in which they first appear, with joined types.

    Inference calls a column without a value text; such a column takes the others' type.
    """
    names: dict[str, str] = {}
    kinds: dict[str, list[tuple[Layout, str, T.DataType]]] = {}
    for layout in found:
        for name, field in zip(layout.header, layout.read(spark, None, **options).schema):
            names.setdefault(name.lower(), name)
            kinds.setdefault(name.lower(), []).append((layout, name, field.dataType))
    mixed = {key for key, uses in kinds.items() if len({k for _, _, k in uses}) > 1}
    empty: set[tuple[int, str]] = set()
    for layout in found:
        asked = [n for n in layout.header for at, _, k in kinds[n.lower()]
                 if n.lower() in mixed and at is layout and isinstance(k, T.StringType)]
        if asked:
            rows = layout.read(spark, {}, **options)
            counts = rows.agg(*[F.count(qcol(n)).alias(n) for n in asked]).first()
            empty |= {(id(layout), n) for n in asked if not counts[n]}
    fields = []
    for key, uses in kinds.items():
        kind: T.DataType = T.NullType()
        for layout, name, own in uses:
            kind = joined(kind, T.NullType() if (id(layout), name) in empty else own)
        fields.append(T.StructField(names[key], T.StringType() if isinstance(kind, T.NullType) else kind))
    return T.StructType(fields)


def read_feed(spark: SparkSession, files: Sequence[str], schema: T.StructType | str | None = None, sep: str = ",",
              quote: str = '"', **options) -> DataFrame:
    """The rows of all files, each under its own header, with ``source_file`` and the split's start.

    ``schema`` names the columns to return (compared without case); a file that lacks one
    gives NULL there, and columns that it does not name are left out.  Without one, every
    column of every file is returned with its joined type.
    """
    settings = {"sep": sep, "quote": quote, **options}
    found = layouts(spark, files, sep, quote)
    if schema is None:
        schema = feed_schema(spark, found, **settings)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    kinds = {f.name.lower(): f.dataType for f in schema}
    parts = []
    for layout in found:
        rows = layout.read(spark, kinds, **settings)
        columns = [qcol(layout.header[layout.names.index(f.name.lower())]).alias(f.name) if f.name.lower() in layout.names
                   else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        parts.append(rows.select(*columns, F.col("_metadata.file_path").alias("source_file"),
                                 F.col("_metadata.file_block_start").alias(_BLK)))
    if not parts:
        extra = [T.StructField("source_file", T.StringType()), T.StructField(_BLK, T.LongType())]
        return spark.createDataFrame([], T.StructType([*schema, *extra]))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionAll(more)
    return out


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def published(spark: SparkSession, out: str, what: str) -> list[str]:
    """The ``rows`` or ``files`` folders of the published runs."""
    fs, _ = _fs(spark, out)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/run=*/{what}"))
    return sorted(str(x.getPath()) for x in found or [])


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """(path, source_file, length, modificationTime, rows, job_id) of every file that a run has published."""
    folders = published(spark, out, "files")
    schema = f"{_FILE}, rows long, job_id string"
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all published runs; columns that a run did not have are NULL."""
    found = [spark.read.parquet(p) for p in published(spark, out, "rows")]
    if not found:
        raise ValueError(f"no run has been published in {out}")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows


def ingest_run(spark: SparkSession, src: str, out: str, schema: T.StructType | str | None = None,
               job_id: str | None = None, glob: str = "*.csv", **options) -> int:
    """Ingest the files under ``src`` that no run has published yet; how many they were.

    Every row gets ``job_id`` (one for the run), ``source_file`` and ``seq_id`` (1, 2, ...
    in file order).  A known path whose length or time has changed is an error: its rows
    are published already.  The driver holds the new files' paths, as Spark's own listing does.
    """
    job = job_id or str(uuid.uuid4())
    out = out.rstrip("/")
    there = list_files(spark, src, glob).join(
        read_manifest(spark, out).select("path", F.col("length").alias("known"), F.col("modificationTime").alias("since")),
        "path", "left")
    changed = there.where((F.col("known") != F.col("length")) | (F.col("since") != F.col("modificationTime")))
    if odd := [r.path for r in changed.select("path").limit(5).collect()]:
        raise ValueError(f"files have changed since they were ingested: {odd}")
    new = there.where("known IS NULL").select("path", "source_file", "length", "modificationTime").toArrow()
    if not new.num_rows:
        return 0
    scratch, hidden = shared_dir(spark, "ingest-run"), f"{out}/_run-{job}"
    try:
        feed = read_feed(spark, new.column("path").to_pylist(), schema, **options)
        numbered = add_file_seq_id(feed, path=scratch)
        columns = [c for c in numbered.columns if c not in ("source_file", "seq_id", _BLK)]
        numbered.select(*map(qcol, columns), F.lit(job).alias("job_id"), "source_file", "seq_id").write.mode(
            "overwrite").parquet(f"{hidden}/rows")
        counts = spark.read.parquet(f"{hidden}/rows").groupBy("source_file").agg(F.count("*").alias("rows"))
        manifest = spark.createDataFrame(new).join(counts, "source_file", "left")
        manifest.select("path", "source_file", "length", "modificationTime", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
                        F.lit(job).alias("job_id")).write.mode("overwrite").parquet(f"{hidden}/files")
        publish_dir(spark, hidden, f"{out}/run={job}")
    finally:
        remove_dir(spark, scratch)
        remove_dir(spark, hidden)
    return new.num_rows
