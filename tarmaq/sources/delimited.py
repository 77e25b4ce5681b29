"""Delimited text files that open with a preamble line, kept as text with their provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tarmaq.functions.typing import named

SOURCE_FILE = "_arquivo_origem"
INGESTED_AT = "_ingerido_em"

#: The raw text of a line that is no row of its table, and why.
REJECTED_LINE = "_linha_rejeitada"
REASON = "_motivo_rejeicao"

NO_QUOTES = "\u0000"
_NO_SEPARATOR = "\u0001"


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``line`` of every file without its first one, the preamble; ``file`` and where it lies."""
    whole_line = T.StructType([T.StructField("line", T.StringType())])
    lines = spark.read.schema(whole_line).csv(
        path, sep=_NO_SEPARATOR, quote=NO_QUOTES, encoding=encoding, header=True,
        enforceSchema=True)
    return lines.select(
        "line", F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``name`` of every file; contents are not read."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select(F.col("path").alias("file"), F.col("_metadata.file_name").alias("name"))


def header_of(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8",
              quote: str = '"') -> list[str]:
    """The column names on the second line of the first file, for inspection or a schema.

    One file name and one line reach the driver, whatever the size of the file set.
    """
    first = _files(spark, path).agg(F.min("file")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no file in {path}")
    line = _lines(spark, first, encoding).agg(F.min_by("line", "place")).first()[0]
    if line is None:
        raise ValueError(f"{first} has no header line after its preamble")
    names = line.lstrip("\ufeff").split(sep)
    return [name.strip(quote) if quote != NO_QUOTES else name for name in names]


def require_headers(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";",
                    encoding: str = "UTF-8", quote: str = '"', told: int = 20) -> None:
    """Refuse files whose line after the preamble is not exactly the expected header.

    A renamed, swapped, missing or extra column, a second preamble and a file without a header
    would all load as data or shift it. The lines are counted per file where they lie; the driver
    gets the names of the first ``told`` bad files, and none if all is well.
    """
    expected = sep.join(columns)
    plain = F.col("line") if quote == NO_QUOTES else F.translate("line", quote, "")
    is_header = F.coalesce(F.rtrim(F.ltrim(plain, F.lit("\ufeff")), F.lit("\r"))
                           == F.lit(expected), F.lit(False))
    found = _lines(spark, path, encoding).groupBy("file").agg(
        F.min_by(is_header, "place").alias("opens"))
    bad = _files(spark, path).join(found.where("opens").select("file"), "file", "left_anti")
    names = [row["name"] for row in bad.orderBy("name").limit(told).collect()]
    if names:
        raise ValueError(f"header {expected!r} expected as the second line of {', '.join(names)}")


def write_delimited(df: DataFrame, path: str, file: Column, preamble: str, sep: str = ";",
                    columns: Sequence[str] | None = None, encoding: str = "UTF-8",
                    line: Column | None = None) -> None:
    """Write ``columns`` (all by default) as text files with a preamble and a header line, one
    folder per ``file``.

    Values are written as they are, so they must hold no separator or line end; ``line`` replaces
    them by a text of its own, for lines as damaged as those of others. Rows of a file meet in one
    task, as a file has one writer; lines keep no order but the first two.
    """
    value = line if line is not None else F.concat_ws(sep, *[F.coalesce(named(c).cast("string"), F.lit(""))
                               for c in columns or df.columns])
    body = df.select(file.alias("file"), F.lit(2).alias("rank"), value.alias("value"))
    opening = body.select("file").distinct().select("file", F.inline(F.array(
        F.struct(F.lit(0).alias("rank"), F.lit(preamble).alias("value")),
        F.struct(F.lit(1).alias("rank"), F.lit(sep.join(columns or df.columns)).alias("value")))))
    lines = opening.unionByName(body).repartition("file").sortWithinPartitions("file", "rank")
    if encoding != "UTF-8":  # the text writer stores bytes as they are
        lines = lines.withColumn("value", F.encode("value", encoding).cast("string"))
    lines.select("file", "value").write.partitionBy("file").text(path)


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   sep: str = ";", encoding: str = "UTF-8", quote: str = '"',
                   escape: str | None = None,
                   reader: DataFrameReader | DataStreamReader | None = None) -> DataFrame:
    """All-string rows of every file under ``path``, one preamble line and one header each.

    ``header`` drops the first line of each file, which is the preamble, in whichever
    split it falls. The header line that is left equals the column names and is filtered,
    so files stay splittable and nothing is skipped by position on the driver; see
    :func:`require_headers` for files that may differ. Pass ``spark.readStream`` as ``reader`` to
    follow a folder.
    """
    if columns is None:
        columns = header_of(spark, path, sep, encoding, quote)
    reader = _reader(reader or spark.read, columns, sep, encoding, quote, escape)
    return reader.schema(_texts(columns)).csv(path).where(~_is_header(columns))


def _texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _is_header(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [named(c).eqNullSafe(F.lit(c)) for c in columns])


def _reader(reader: DataFrameReader | DataStreamReader, columns: Sequence[str], sep: str,
            encoding: str, quote: str,
            escape: str | None) -> DataFrameReader | DataStreamReader:
    options = {"sep": sep, "header": "true", "enforceSchema": "true", "encoding": encoding,
               "quote": quote, "mode": "PERMISSIVE"}
    return reader.options(**options, **({} if escape is None else {"escape": escape}))


def read_marked(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";",
                encoding: str = "UTF-8", quote: str = '"', escape: str | None = None,
                reader: DataFrameReader | DataStreamReader | None = None) -> DataFrame:
    """:func:`read_delimited` with every line told good or bad, in the same scan.

    Lines are read whole and parsed with the same options. A bad line keeps its text in
    ``REJECTED_LINE`` and NULL in its columns; ``REASON`` is ``unbalanced quotes`` where a field
    opens with a quotation mark that does not close it, else ``too few fields`` or
    ``too many fields``, and NULL for good lines. No line is dropped but preamble and header.
    """
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": REJECTED_LINE}
    options |= {} if escape is None else {"escape": escape}
    whole = _reader(reader or spark.read, ["line"], _NO_SEPARATOR, encoding, NO_QUOTES, None)
    lines = whole.option("columnNameOfCorruptRecord", "whole").schema(
        _texts(["line", "whole"])).csv(path)
    line = F.coalesce("whole", "line")
    parsed = lines.select(
        line.alias(REJECTED_LINE), F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.from_csv(line, _texts([*columns, REJECTED_LINE]).toDDL(), options).alias("row"))
    mark, part, other = _literal(quote), _literal(sep), f"[^{_literal(quote)}]"
    skipped = "" if escape in (None, quote) else f"|{_literal(escape)}."
    plain, opened = F.col(REJECTED_LINE), F.lit(False)
    if quote != NO_QUOTES:  # without the fields that are quoted well; most lines have none
        has_mark = plain.contains(quote)
        plain = F.when(has_mark, F.regexp_replace(
            plain, f"(^|{part}){mark}(?:{mark}{mark}{skipped}|{other})*{mark}(?={part}|$)",
            "$1")).otherwise(plain)
        opened = has_mark & plain.rlike(f"(^|{part}){mark}")
    fields = F.size(F.split(plain, part, -1))
    reason = (F.when(opened, "unbalanced quotes").when(fields < len(columns), "too few fields")
              .when(fields > len(columns), "too many fields")
              .when(F.col("row")[REJECTED_LINE].isNotNull(), "unreadable"))
    told = parsed.withColumn(REASON, reason)
    good = F.col(REASON).isNull()
    values = {c: F.when(good, F.col("row").getField(c)) for c in columns}
    return told.select(
        *[value.alias(c) for c, value in values.items()], SOURCE_FILE, REASON,
        F.when(~good, F.col(REJECTED_LINE)).alias(REJECTED_LINE)).where(
        ~(_is_header(columns) & good))


def _literal(text: str) -> str:
    return "".join(f"\\x{ord(c):02x}" for c in text)


def accepted(marked: DataFrame) -> DataFrame:
    """The good rows, without the marks."""
    return marked.where(F.col(REASON).isNull()).drop(REJECTED_LINE, REASON)


def rejects(marked: DataFrame) -> DataFrame:
    """The lines that are no rows: text, reason, and whatever columns were added to all lines."""
    return marked.where(F.col(REASON).isNotNull())


def with_line_counts(marked: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``marked`` unchanged; whichever action runs it first counts ``lines`` and ``rejects``.

    So a load learns in the write of its good rows whether it has rejects to write at all.
    """
    watch = Observation(name)
    return marked.observe(watch, F.count("*").alias("lines"),
                          F.count_if(F.col(REASON).isNotNull()).alias("rejects")), watch


def with_source_file(df: DataFrame, name: str | None = None) -> DataFrame:
    """Add the file each row came from: its own, or a given name."""
    origin = F.col("_metadata.file_name") if name is None else F.lit(name)
    return df.withColumn(SOURCE_FILE, origin)


def with_ingest_time(df: DataFrame) -> DataFrame:
    """Add the load time: one value for all rows of a load."""
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep and rename the listed source columns, in order."""
    return df.select(*[named(source).alias(target) for source, target in names.items()])
