"""CSV files, every column text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from ..sinks import files

# Cell texts that mean "no value".
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_DAMAGED = "_damaged_line"
_PACKED = r"\.(gz|gzip|bz2|xz|zst|zstd|lz4|snappy|deflate)$"


_HEADERS_ONE_BY_ONE = 16


def _fields(width: int) -> T.StructType:
    return T.StructType([*[T.StructField(f"c{i}", T.StringType()) for i in range(width)], T.StructField(_DAMAGED, T.StringType())])


def _parsing(options: dict) -> dict:
    return {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _DAMAGED}


def _cells(lines: DataFrame, header: list[str], options: dict, null_words) -> DataFrame:
    """Named cells of parsed lines (c0, c1, ..., the damaged line): lines with too many fields go, words for no value are null."""
    q = re.escape(options["quote"])
    unquoted = F.regexp_replace(_DAMAGED, f"{q}[^{q}]*{q}", "")
    n_fields = F.size(F.split(unquoted, r"\Q" + options["sep"] + r"\E"))
    kept = lines.where(F.col(_DAMAGED).isNull() | (n_fields <= len(header)))
    return kept.select(*[F.when(~F.col(f"c{i}").isin(*null_words), F.col(f"c{i}")).alias(name) for i, name in enumerate(header)])


def _read_alike(spark, paths: list[str], header: list[str], options: dict, null_words) -> DataFrame:
    """Files of one header, columns in its order."""
    lines = spark.read.schema(_fields(len(header))).options(**_parsing(options), enforceSchema="true").csv(paths)
    return _cells(lines, header, options, null_words)


def _numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, id, value): the lines of files; ``id`` rises within a block of a file, in which one task reads."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(files.plain_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")


def _headers(spark: SparkSession, paths: list[str], options: dict) -> dict[tuple[str, ...], list[str]]:
    """Files by their trimmed header; () for those without a line. Of many files the first lines are read in one scan."""
    reader = spark.read.options(**options | {"multiLine": "false"})  # reads no more than the header
    by_header: dict[tuple[str, ...], list[str]] = {}
    if len(paths) <= _HEADERS_ONE_BY_ONE:
        for path in paths:
            by_header.setdefault(tuple(n.strip() for n in reader.csv(path).columns), []).append(path)
        return by_header
    lines = _numbered_lines(spark, paths).where((F.col("block") == 0) & (F.trim(F.regexp_replace("value", "\r$", "")) != ""))
    first = lines.groupBy("file").agg(F.min_by("value", "id").alias("line"))
    alike = first.groupBy("line").agg(F.collect_list("file").alias("files")).select("files").collect()  # the paths, which are known here
    named = {re.sub("^([A-Za-z0-9]+):/+", r"\1:/", p): p for p in paths}
    for row in alike:
        some = sorted(named.pop(f) for f in row["files"])
        by_header.setdefault(tuple(n.strip() for n in reader.csv(some[0]).columns), []).extend(some)
    if named:
        by_header.setdefault((), []).extend(named.values())
    # In the order of their first files, as if they had been read one by one.
    return {h: sorted(f) for h, f in sorted(by_header.items(), key=lambda x: min(x[1]))}


def _records(lines: DataFrame, quote: str, sep: str) -> DataFrame:
    """(file, block, id, value, inside, open, record, stray) of the lines of files with line breaks in quotes.

    A line begins inside quotes if the number of quotes before it in its file is odd: the sum
    over the blocks before, and over the lines before in its block. ``record`` counts the
    lines of a block that begin a record. ``stray``: a quote stands where no field begins or
    ends, so that the number of quotes says nothing.
    """
    q, rest = re.escape(quote), f"[^{re.escape(quote)}{re.escape(sep)}\r]"
    n_quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    counted = lines.withColumn("quotes", n_quotes)
    blocks = counted.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("file").alias("_file"), F.col("block").alias("_block"), F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("file", "block").orderBy("id")
    before = F.coalesce(F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counted.withColumn("_inner", before).join(blocks, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    placed = placed.withColumn("inside", (F.col("_before") + F.col("_inner")) % 2 == 1)
    placed = placed.withColumn("open", (F.col("_before") + F.col("_inner") + F.col("quotes")) % 2 == 1)
    # Empty lines outside quotes are no records.
    placed = placed.where(F.col("inside") | ~F.col("value").isin("", "\r"))
    placed = placed.withColumn("record", F.sum((~F.col("inside")).cast("long")).over(within))
    closed = F.concat(F.when(F.col("inside"), quote).otherwise(""), "value", F.when(F.col("open"), quote).otherwise(""))
    fields = F.regexp_replace(closed, f"{q}[^{q}]*{q}", quote)  # a quoted field is a run of quotes
    stray = fields.rlike(f"{rest}{q}|{q}{rest}")
    return placed.select("file", "block", "id", "value", "inside", "open", "record", stray.alias("stray"))


def _joined_records(marked: DataFrame) -> DataFrame:
    """(file, block, record, text): whole records. Only lines of records with several lines are shuffled."""
    whole = marked.where("not inside and not open").select("file", "block", "record", F.col("value").alias("text"))
    parts = marked.where("inside or open")
    # A block that begins inside quotes goes on with the last record of the last block that began one.
    last = marked.groupBy("file", "block").agg(F.max("record").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.last(F.when(F.col("n") > 0, F.struct(F.col("block").alias("block"), F.col("n").alias("record"))), ignorenulls=True).over(earlier)
    last = last.select(F.col("file").alias("_file"), F.col("block").alias("_block"), begun.alias("_begun"))
    parts = parts.join(last, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    mine = F.when(F.col("record") > 0, F.struct("block", "record")).otherwise(F.col("_begun"))
    parts = parts.select("file", mine.alias("mine"), F.struct("block", "id", "value").alias("line"))
    joined = parts.groupBy("file", "mine").agg(F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["value"]), "\n").alias("text"))
    return whole.unionByName(joined.select("file", "mine.block", "mine.record", "text"))


def _read_quoted(spark, paths: list[str], header: list[str], options: dict, null_words) -> DataFrame:
    """Large files that may have line breaks in quotes, read by as many tasks as they have splits.

    Files whose lines all have an even number of quotes have none: their lines are records.
    In the others lines are joined by counting quotes. Files in which a quote stands inside
    a field, where only a parser that starts at the top can tell, are read by a task each.
    """
    quote, sep = options["quote"], options["sep"]
    q, rest = re.escape(quote), f"[^{re.escape(quote)}{re.escape(sep)}\r]"
    named = {re.sub("^([A-Za-z0-9]+):/+", r"\1:/", p): p for p in paths}
    lines = _numbered_lines(spark, paths)
    odd = (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))) % 2 == 1
    found = lines.groupBy("file").agg(F.max(odd).alias("odd"), F.count_if(odd).alias("n"), F.max(F.col("value").rlike(f"{rest}{q}{rest}|^\r*[^\n]*\r[^\n]")).alias("stray"))
    kinds = {r["file"]: "whole" if r["stray"] or r["n"] % 2 else "joined" if r["odd"] else "lines" for r in found.collect()}
    by_kind: dict[str, list[str]] = {}
    for file, kind in kinds.items():
        by_kind.setdefault(kind, []).append(file)
    parts = []
    if by_kind.get("joined"):
        mine = [named[f] for f in by_kind["joined"]]
        path = scratch_dir(spark, "csv-lines")
        _records(_numbered_lines(spark, mine), quote, sep).write.parquet(path)
        marked = spark.read.parquet(path)
        strange = {r["file"] for r in marked.where("stray").select("file").distinct().collect()}
        by_kind.setdefault("whole", []).extend(strange)
        records = _joined_records(marked.where(~F.col("file").isin(*strange)) if strange else marked)
        # The first record of a file is its header; how its first line ends, all do, also inside quotes.
        begins = F.min(F.when(F.col("record") > 0, F.struct("block", "record")))
        ends = F.min_by(F.col("value").endswith("\r"), F.struct("block", "id"))
        first = marked.groupBy("file").agg(begins.alias("head"), ends.alias("returns"))
        records = records.join(first.withColumnRenamed("file", "_file"), F.col("file") == F.col("_file"))
        records = records.where((F.col("block") != F.col("head.block")) | (F.col("record") != F.col("head.record")))
        text = F.regexp_replace("text", "\r$", "")
        text = F.when(F.col("returns"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
        parsed = F.from_csv(text, _fields(len(header)).simpleString()[7:-1].replace(":", " "), _parsing(options))
        parts.append(_cells(records.select(parsed.alias("c")).select("c.*"), header, options, null_words))
    if by_kind.get("lines"):
        parts.append(_read_alike(spark, [named[f] for f in by_kind["lines"]], header, options | {"multiLine": "false"}, null_words))
    if by_kind.get("whole"):
        parts.append(_read_alike(spark, [named[f] for f in by_kind["whole"]], header, options, null_words))
    return reduce(DataFrame.unionByName, parts)


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    quote: str = '"',
    null_words: tuple[str, ...] = NULL_WORDS,
    multi_line: bool = True,
    split_bytes: int | None = None,
) -> DataFrame:
    """Trimmed header names; lines with too many fields are left out, short ones filled with null.

    Each file of a folder has its own header; columns are matched by name, and a file with
    other names is an error. ``multi_line`` allows line breaks inside quotes. A file of more
    than ``split_bytes`` (what Spark reads in a task, if not given) is then still read by many
    tasks, see ``_read_quoted``; files that cannot be split, as compressed ones, by one each.
    """
    options = {"header": "true", "sep": sep, "quote": quote, "escape": quote, "multiLine": str(multi_line).lower()}
    sizes = files.file_sizes(spark, path)
    by_header = _headers(spark, sorted(sizes), options)
    if not by_header:
        raise FileNotFoundError(f"no file in {path}")
    by_header = {h: f for h, f in by_header.items() if h} or by_header  # empty files have no header
    names = next(iter(by_header))
    for header, found in by_header.items():
        if sorted(header) != sorted(names):
            raise ValueError(f"{found[0]} has columns {list(header)}, others have {list(names)}")
    most = split_bytes or spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    parts = []
    for header, found in by_header.items():
        large = [f for f in found if multi_line and sizes[f] > most and not re.search(_PACKED, f)]
        small = [f for f in found if f not in set(large)]
        if small:
            parts.append(_read_alike(spark, small, list(header), options, null_words))
        if large:
            parts.append(_read_quoted(spark, large, list(header), options, null_words))
    return reduce(DataFrame.unionByName, parts)


def stream_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    quote: str = '"',
    null_words: tuple[str, ...] = NULL_WORDS,
    multi_line: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Files of a folder as they arrive, under the same rules for lines and words as ``read_csv``.

    The columns are those of the files that are there when the stream starts, and of one
    order; every file has a header. ``files_per_trigger`` bounds a micro-batch.
    """
    options = {"header": "true", "sep": sep, "quote": quote, "escape": quote, "multiLine": str(multi_line).lower()}
    by_header = [h for h in _headers(spark, sorted(files.file_sizes(spark, path)), options) if h]
    if len(by_header) != 1:
        raise ValueError(f"files of {path} have {len(by_header)} headers, a stream needs one")
    limit = {"maxFilesPerTrigger": str(files_per_trigger)} if files_per_trigger else {}
    (header,) = by_header
    lines = spark.readStream.schema(_fields(len(header))).options(**_parsing(options), **limit, enforceSchema="true").csv(path)
    return _cells(lines, list(header), options, null_words)
