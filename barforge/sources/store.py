"""Bar storage: CSV scan bound by header (S1), CSV sink (S10), partitioned
Parquet store (S11) and snapshot manifests (S15).

Layout on disk is ``asset_class=<c>/interval=<i>/`` with ``ticker`` as a
column and files range-partitioned by (ticker, ts) - never one directory
per ticker, which would create one small file per series. Imported trees in
the per-ticker file layout ``<class>/<interval>/<TICKER>.csv`` are read by
:func:`read_bar_csv`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.schema import CONTROL_FILES
from barforge.session import stored_table

# column header in bar CSV files -> store column
HEADER_NAMES = {"Datetime": "ts", "Date": "ts", "Open": "open", "High": "high", "Low": "low",
                "Close": "close", "Adj Close": "adj_close", "Volume": "volume",
                "Dividends": "dividends", "Stock Splits": "stock_splits", "Ticker": "ticker"}
PRICE_FORMAT = "%.10f"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxx"
_FILE_LAYOUT = r"([^/=]+)/([^/=]+)/([^/]+)\.csv$"


def read_partitioned(spark: SparkSession, root: str, fmt: str = "parquet", keys=("asset_class", "interval"),
                     **options) -> DataFrame:
    """A key=value tree with its partition columns read as text. Spark would
    otherwise infer their types from the directory names, and ``1d`` or ``5d``
    parse as the doubles 1.0 and 5.0. The files' own columns come from their
    footers or headers, read without partition discovery; Parquet footers are
    merged, so a column that only some files carry is always there."""
    if fmt == "parquet":
        options = {"mergeSchema": "true", **options}
    own = spark.read.format(fmt).options(**options).option("recursiveFileLookup", "true").load(root).schema
    fields = [f for f in own.fields if f.name not in keys]
    schema = T.StructType([*fields, *(T.StructField(k, T.StringType()) for k in keys)])
    return spark.read.format(fmt).options(**options).schema(schema).load(root)


def parse_ts(c) -> F.Column:
    """Instants as written by the sink, by pandas or by hand: ISO-8601 with a
    blank or a T, an offset with or without colon or Z, a fraction, or none of
    these (then UTC, the session clock); unparseable text -> null."""
    s = F.regexp_replace(c, " ", "T")
    return F.coalesce(F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssxx")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssxxx")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd")),
                      F.try_to_timestamp(F.trim(c)))


#: Header lines of this many bytes in all are sent to every task; more are joined.
HEADER_BYTES = 32 << 20


def _bar_header(line: F.Column) -> F.Column:
    """Whether a line is a bar file's header: it names its time and its close."""
    return line.rlike(r"(^|,)\s*(Datetime|Date)\s*(,|$)") & line.rlike(r"(^|,)\s*Close\s*(,|$)")


def file_headers(text: DataFrame) -> DataFrame:
    """(path, header, names, width) per file with a bar header, written once."""
    heads = text.where(_bar_header(F.col("value"))).groupBy("path").agg(F.min("value").alias("header"))
    names = F.transform(F.split("header", ","), lambda n: F.trim(n))
    return stored_table(heads.select("path", "header", names.alias("names"), F.size(names).alias("width")), "csv-headers")


def read_bar_csv(spark: SparkSession, root: str, glob: str = "*/*/*.csv"):
    """Scan a per-ticker CSV tree, binding columns by header name.

    The tree is read as text, however many different headers it has: one pass
    finds each file's header line, the other reads the rows and binds each by
    the names of its own file's header, so a file whose columns are in another
    order is never mis-bound. The headers (one small row per file) meet the rows
    by path; they are broadcast only if their measured size allows. A header
    names its time column ``Datetime`` or ``Date`` anywhere in the line, and
    unknown columns are left out. Returns (bars, quarantine): files without a
    bar header (corrupt or empty) and rows whose time does not parse are
    reported, not read. Optional columns that no file has are left out."""
    pattern = f"{root.rstrip('/')}/{glob}"
    text = spark.read.text(pattern).select(F.col("_metadata.file_path").alias("path"), "value")
    heads = file_headers(text)
    # every file of the tree from the file listing alone (binaryFile with only
    # the path selected does not read contents); those without a header are bad
    all_files = spark.read.format("binaryFile").load(pattern).select("path")
    bad_files = all_files.join(heads, "path", "left_anti").withColumn("reason", F.lit("no header"))
    size = heads.agg(F.max("width").alias("width"), F.sum(F.length("path") + 2 * F.length("header") + 64).alias("bytes"),
                     F.array_distinct(F.flatten(F.collect_set("names"))).alias("names")).first()
    if size["width"] is None:
        return spark.createDataFrame([], "path string, ts timestamp"), bad_files
    small = F.broadcast(heads) if size["bytes"] <= HEADER_BYTES else heads
    rows = text.join(small, "path").where((F.col("value") != F.col("header")) & (F.trim("value") != ""))
    cells = F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(size["width"]))))
    rows = rows.select("path", "names", cells.alias("cells")).select("path", "names", F.array(
        *(F.col(f"cells.c{i}") for i in range(size["width"]))).alias("cells"))

    def bound(dst: str) -> F.Column | None:
        """The cell under the header's first name for ``dst``."""
        known = [n for n, d in HEADER_NAMES.items() if d == dst and n in size["names"]]
        places = [F.nullif(F.array_position("names", n), F.lit(0)) for n in known]
        return F.get("cells", (F.coalesce(*places) - 1).cast("int")) if places else None

    def typed(dst: str, cell: F.Column) -> F.Column:
        if dst == "ts":
            return parse_ts(cell)
        if dst == "ticker":
            return cell
        number = cell.try_cast("double")
        return number.cast("bigint") if dst == "volume" else number
    columns = {d: bound(d) for d in dict.fromkeys(HEADER_NAMES.values())}
    bars = rows.select("path", *(typed(d, c).alias(d) for d, c in columns.items() if c is not None))
    # identity from the path: key=value directories (as Spark writes them)
    # or the per-ticker file layout <class>/<interval>/<stem>.csv
    ident = []
    for i, k in enumerate(("asset_class", "interval", "ticker"), start=1):
        hive = F.url_decode(F.regexp_extract("path", f"/{k}=([^/]+)/", 1))
        ident.append(F.coalesce(F.nullif(hive, F.lit("")), F.regexp_extract("path", _FILE_LAYOUT, i)))
    bars = bars.select(ident[0].alias("asset_class"), ident[1].alias("interval"),
                       ident[2].alias("stem"), "*")
    bad_rows = bars.where(F.col("ts").isNull()).select("path", F.lit("bad time").alias("reason"))
    return bars.where(F.col("ts").isNotNull()).drop("path"), bad_files.unionByName(
        bad_rows.groupBy("path", "reason").agg(F.count(F.lit(1)).alias("rows")), allowMissingColumns=True)


def csv_frame(bars: DataFrame) -> DataFrame:
    """S10 formatting: ISO UTC time with offset, prices with 10 decimals,
    integer volume; identity columns kept for the partitioned layout."""
    def price(c):
        return F.when(F.col(c).isNotNull(), F.format_string(PRICE_FORMAT, F.col(c)))
    cols = [F.date_format("ts", TS_FORMAT).alias("Datetime")]
    for src, dst in (("open", "Open"), ("high", "High"), ("low", "Low"), ("close", "Close"),
                     ("adj_close", "Adj Close")):
        if src in bars.columns:
            cols.append(price(src).alias(dst))
    cols.append(F.col("volume").cast("string").alias("Volume"))
    for src, dst in (("dividends", "Dividends"), ("stock_splits", "Stock Splits")):
        if src in bars.columns:
            cols.append(price(src).alias(dst))
    return bars.select("asset_class", "interval", F.col("ticker").alias("Ticker"), *cols)


def write_bar_csv(bars: DataFrame, root: str, files_per_interval: int | None = None) -> None:
    """S10 + S11: CSV under ``asset_class=/interval=``; rows range-partitioned
    by (ticker, ts) so each file holds whole, time-ordered series."""
    out = csv_frame(bars.repartitionByRange(*([files_per_interval] if files_per_interval else []),
                                            "asset_class", "interval", "ticker", "ts")
                    .sortWithinPartitions("asset_class", "interval", "ticker", "ts"))
    out.write.mode("overwrite").partitionBy("asset_class", "interval").option("header", True).csv(root)


def read_store_csv(spark: SparkSession, root: str) -> DataFrame:
    """Read back :func:`write_bar_csv` output (partition discovery for the
    class / interval columns; every value read as text, then typed)."""
    raw = read_partitioned(spark, root, "csv", header="true", inferSchema="false")
    return raw.select(
        "asset_class", "interval", F.col("Ticker").alias("ticker"), parse_ts(F.col("Datetime")).alias("ts"),
        *[F.col(f"`{h}`").try_cast("double").alias(d) for h, d in
          (("Open", "open"), ("High", "high"), ("Low", "low"), ("Close", "close"), ("Adj Close", "adj_close"),
           ("Dividends", "dividends"), ("Stock Splits", "stock_splits"))
          if h in raw.columns],
        F.col("Volume").try_cast("bigint").alias("volume"))


def write_store(bars: DataFrame, root: str, mode: str = "overwrite", partitions: int | None = None) -> None:
    """Parquet store partitioned by asset_class / interval, files range
    partitioned and sorted by (ticker, ts): partition pruning on class and
    interval, row-group min/max pruning on ticker and ts. A task sorts one range;
    ``partitions`` sets their number, else adaptive execution joins ranges up to
    its advisory size."""
    (bars.repartitionByRange(*([partitions] if partitions else []), "asset_class", "interval", "ticker", "ts")
     .sortWithinPartitions("asset_class", "interval", "ticker", "ts")
     .write.mode(mode).partitionBy("asset_class", "interval").parquet(root))


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The bars of :func:`write_store`, interval and asset class as text."""
    return read_partitioned(spark, root)


def read_retained(spark: SparkSession, root: str, as_of) -> DataFrame:
    """P6 on a stored table: the bars within retention, as one filtered read per
    distinct cutoff (intervals of one cutoff together) plus the intervals kept
    for good. Each read prunes its partitions, and ``ts >= cutoff`` reaches the
    Parquet scan - in one predicate over all intervals it would not."""
    from barforge.operators.bars import retention_cutoffs
    by_cutoff: dict = {}
    for interval, cutoff in retention_cutoffs(as_of).items():
        by_cutoff.setdefault(cutoff, []).append(interval)
    store = read_store(spark, root)
    limited = [i for own in by_cutoff.values() for i in own]
    parts = [store.where(~F.col("interval").isin(*limited) | F.col("interval").isNull())]
    parts += [store.where(F.col("interval").isin(*own) & (F.col("ts") >= F.lit(cutoff))) for cutoff, own in by_cutoff.items()]
    return reduce(DataFrame.unionByName, parts)


def file_tree(paths: DataFrame, col: str = "path") -> DataFrame:
    """A snapshot tree as rows: path, name, depth, asset_class, interval
    (class and interval only at depth >= 3), control flag."""
    parts = F.split(F.col(col), "/")
    depth = F.size(parts)
    return paths.select(
        F.col(col).alias("path"), F.element_at(parts, -1).alias("name"), depth.alias("depth"),
        F.when(depth >= 3, parts.getItem(0)).alias("asset_class"),
        F.when(depth >= 3, parts.getItem(1)).alias("interval"),
        F.element_at(parts, -1).isin(*CONTROL_FILES).alias("control"))


def manifest(tree: DataFrame, dataset: str, version: int) -> DataFrame:
    """Per-interval file counts of a snapshot version (the pull state)."""
    return (tree.where(~F.col("control") & (F.col("depth") >= 3))
            .groupBy("interval").agg(F.count(F.lit(1)).alias("n_files"))
            .select(F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), "interval", "n_files"))


def resolve_stems(bars: DataFrame, universe: DataFrame):
    """Q11: a file stem is not a ticker (``^GSPC`` and ``GSPC`` share a stem).
    Map stems back to tickers by joining on the file-safe form within the
    asset class. Returns (bars with ``ticker``, collisions): stems claimed by
    more than one ticker are reported and their rows left unresolved (ticker
    null) rather than guessed; stems with no universe ticker keep the stem."""
    from barforge.functions.symbols import safe_filename
    u = universe.select("asset_class", "ticker", safe_filename(F.col("ticker")).alias("stem")).distinct()
    claims = u.groupBy("asset_class", "stem").agg(F.count(F.lit(1)).alias("n"),
                                                  F.sort_array(F.collect_set("ticker")).alias("tickers"))
    unique = claims.where(F.col("n") == 1).select("asset_class", "stem", F.col("tickers")[0].alias("_t"))
    out = (bars.join(unique, ["asset_class", "stem"], "left")
           .join(claims.where(F.col("n") > 1).select("asset_class", "stem", F.lit(True).alias("_clash")),
                 ["asset_class", "stem"], "left")
           .withColumn("ticker", F.when(F.col("_clash"), F.lit(None).cast("string"))
                       .otherwise(F.coalesce("_t", "stem")))
           .drop("_t", "_clash"))
    return out, claims.where(F.col("n") > 1).drop("n")


def scan_tree(spark: SparkSession, root: str) -> DataFrame:
    """A6 input: every file under ``root`` as a relative path, from the
    binaryFile source with only the ``path`` column selected (file contents
    are not read), then :func:`file_tree`."""
    base = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
             .select("path"))
    rel = F.regexp_extract("path", r"^(?:file:)?" + base.replace(".", r"\.") + r"/(.*)$", 1)
    return file_tree(files.select(rel.alias("path")))
