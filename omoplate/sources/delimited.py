"""Delimited text ingest (S1-S4, S7, S8) and parquet I/O."""

from __future__ import annotations

import itertools
import re
import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omoplate.functions.dates import parse_datetime, try_parse_datetime
from omoplate.functions.text import ID_COLUMN_MARKERS, matches_id_format
from omoplate.sources.records import Dialect, can_read, header, read_records

# Reader option names of the configuration files and the Spark
# CSV option each becomes.
OPTION_NAMES = {"sep": "sep", "delimiter": "sep", "encoding": "encoding", "quotechar": "quote",
                "escapechar": "escape", "comment": "comment", "multiline": "multiLine"}
# Options that change nothing in a read where every column is text and is pruned by use.
NEUTRAL_OPTIONS = ("dtype", "nrows", "usecols", "low_memory", "engine", "decimal", "thousands", "keep_default_na",
                   "na_values", "on_bad_lines", "skiprows")
# Spellings that count as missing unless keep_default_na is off.
NA_SPELLINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
SURPLUS = "_surplus_field"
# Python codec aliases Spark does not know by that name.
ENCODING_ALIASES = {"latin9": "ISO-8859-15", "latin-9": "ISO-8859-15", "latin1": "ISO-8859-1",
                    "latin-1": "ISO-8859-1", "utf8": "UTF-8", "utf-8": "UTF-8", "cp1252": "windows-1252"}
# Words whose presence in a header marks a date column.
DATE_WORDS = ("fecha", "fec", "inicio", "fin", "f_")


def spark_csv_options(options: Mapping) -> dict[str, str]:
    """Spark options; quotes are doubled inside quoted fields unless an escape character is given."""
    out = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"'}
    for key, value in options.items():
        if key == "header":
            out["header"] = "true" if value in (0, True, "infer") else "false"
            continue
        if key in NEUTRAL_OPTIONS:
            continue
        if key not in OPTION_NAMES:
            raise ValueError(f"no Spark equivalent of the read option {key!r}")
        if key == "encoding":
            value = ENCODING_ALIASES.get(str(value).lower(), value)
        out[OPTION_NAMES[key]] = str(value).lower() if isinstance(value, bool) else str(value)
    return out


# Charsets Spark's CSV reader accepts without the legacy Java charset switch.
STANDARD_CHARSETS = {"iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8"}


def _latin1_differences(encoding: str) -> tuple[str, str]:
    """Characters of Latin-1 and what their bytes mean in another single-byte encoding."""
    pairs = []
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:  # the byte has no meaning there
            continue
        if len(c) != 1:
            raise ValueError(f"{encoding} is not a single-byte encoding")
        if c != chr(b):
            pairs.append((chr(b), c))
    if len(pairs) == 0 and bytes(range(128)).decode(encoding) != bytes(range(128)).decode("ascii"):
        raise ValueError(f"{encoding} does not extend ASCII")
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _missing_values(options: Mapping) -> list[str]:
    own = options.get("na_values") or []
    own = [own] if isinstance(own, str) else [str(v) for v in own]
    return own + (list(NA_SPELLINGS) if options.get("keep_default_na", True) else [])


def _as_missing(names: Sequence[str], values: Sequence[Column], options: Mapping, fault: Column, text: Column) -> list[Column]:
    """The columns with the spellings of missing values nulled; a fault, unless rows are left out for it, raises
    in every column, so that no projection prunes the check away."""
    missing, cols = _missing_values(options), []
    for name, value in zip(names, values):
        value = F.when(~value.isin(missing), value)
        if options.get("on_bad_lines", "error") == "error":
            value = F.when(fault, F.raise_error(text).cast("string")).otherwise(value)
        cols.append(value.alias(name))
    return cols


def column_names(header: Sequence[str]) -> list[str]:
    """Names of a header: an empty one is called after its place, a repeated one gets a number behind it."""
    out: list[str] = []
    for i, name in enumerate(header):
        name = name or f"Unnamed: {i}"
        n, own = 0, name
        while own in out:
            n += 1
            own = f"{name}.{n}"
        out.append(own)
    return out


def _dialect(options: Mapping) -> Dialect | None:
    """How records are cut, or None where only Spark's reader can: wide encodings, comments, long separators."""
    opts = spark_csv_options(options)
    skip = options.get("skiprows") or 0
    if not isinstance(skip, int):
        raise ValueError("skiprows must be a number of lines")
    sep, quote = opts.get("sep", ","), opts["quote"]
    sep = {"\\t": "\t"}.get(sep, sep)
    escape = opts["escape"] if opts["escape"] != quote else None
    encoding = opts.get("encoding", "utf-8")
    if "comment" in opts or not can_read(encoding, sep, quote, escape):
        if skip:
            raise ValueError("skiprows cannot be combined with comments, wide encodings or long separators")
        return None
    return Dialect(sep, quote, escape, encoding, skip)


def _read_records(spark: SparkSession, path: str, options: Mapping, dialect: Dialect) -> tuple[DataFrame, list[str], Column, Column]:
    """Records, column names, which are at fault, and why."""
    first = header(spark, path, dialect)
    titled = spark_csv_options(options)["header"] == "true"
    names = column_names(first) if titled else [f"_c{i}" for i in range(len(first))]
    found = read_records(spark, path, dialect)
    if titled:
        found = found.filter("kind <> 'header'")
    n = F.size("fields")
    why = F.when(F.col("kind") == "open", F.lit("no closing quote")).when(
        n > len(names), F.concat(n.cast("string"), F.lit(f" fields instead of {len(names)}")))
    return found, names, F.coalesce(why.isNotNull(), F.lit(False)), why


def rejected_records(spark: SparkSession, path: str, options: Mapping | None = None) -> DataFrame:
    """The records that ``read_delimited`` leaves out with ``on_bad_lines`` of ``skip`` or ``warn``, and
    fails on otherwise: ``file`` (its name), ``line`` (of the file, from 1), ``reason``, ``fields``."""
    options = options or {}
    dialect = _dialect(options)
    if dialect is None:
        raise ValueError("rejects need records that can be cut line by line (no comments, wide encodings or long separators)")
    found, _, fault, why = _read_records(spark, path, options, dialect)
    return found.filter(fault).select(F.regexp_extract("file", "[^/]*$", 0).alias("file"), "line", why.alias("reason"), "fields")


def read_delimited(spark: SparkSession, path: str, options: Mapping | None = None, strict: bool = False) -> DataFrame:
    """S1 (read): every column as text.

    Quoted fields may hold line breaks; files are still read split by split
    (``sources.records``), and ``multiline`` is accepted and changes nothing.
    A record with more fields than the header, or whose quote is not closed
    before the file ends, fails the job when it is read; with
    ``on_bad_lines`` of ``skip`` or ``warn`` it is left out and
    ``rejected_records`` has it. Missing fields at the end are null, and so
    are the spellings of ``na_values`` and, unless ``keep_default_na`` is
    off, of ``NA_SPELLINGS``. ``skiprows`` lines at the start of each file
    are passed over; they must lie in its first split. Blank lines are no
    records. Repeated header names are numbered (``id``, ``id.1``). A
    carriage return alone is no line break: it fails the job outside quotes.
    ``strict`` makes rows with too few fields fail too.

    Comments, UTF-16, UTF-32 and separators of several characters are left
    to Spark's reader, which takes line breaks in quotes only with
    ``multiline``, and then a file as one task. There, and with ``strict``,
    single-byte encodings other than Latin-1 are read as it, and the
    characters that differ are then replaced.
    """
    options = options or {}
    dialect = None if strict else _dialect(options)
    if dialect is not None:
        found, names, fault, why = _read_records(spark, path, options, dialect)
        if options.get("on_bad_lines") in ("skip", "warn"):
            found = found.filter(~fault)
        text = F.concat(F.col("file"), F.lit(", line "), F.col("line").cast("string"), F.lit(": "), why, F.lit(": "),
                        F.substring(F.coalesce(F.array_join("fields", dialect.sep), F.lit("")), 1, 200))
        return found.select(*_as_missing(names, [F.get("fields", F.lit(i)) for i in range(len(names))], options, fault, text))
    opts = spark_csv_options(options)
    read_as, meant = "", ""
    if opts.get("encoding", "utf-8").lower() not in STANDARD_CHARSETS:
        read_as, meant = _latin1_differences(opts["encoding"])
        opts["encoding"] = "ISO-8859-1"
    letters = str.maketrans(read_as, meant)
    head = T.StructType([T.StructField(f.name.translate(letters), T.StringType())
                         for f in spark.read.options(**opts).csv(path).schema.fields])
    if strict:
        opts["mode"] = "FAILFAST"
        rows = spark.read.options(**opts).schema(head).csv(path)
        return rows.select(*(F.translate(F.col(f"`{c}`"), read_as, meant).alias(c) if read_as else F.col(f"`{c}`")
                             for c in rows.columns))
    wide = T.StructType([*head.fields, T.StructField(SURPLUS, T.StringType())])
    rows = spark.read.options(**opts).schema(wide).csv(path)
    if read_as:
        rows = rows.select(*(F.translate(F.col(f"`{c}`"), read_as, meant).alias(c) for c in rows.columns))
    surplus = F.col(SURPLUS).isNotNull()
    if options.get("on_bad_lines") in ("skip", "warn"):
        rows = rows.filter(~surplus)
    names = [c for c in rows.columns if c != SURPLUS]
    text = F.concat(F.lit("row with more fields than the header, the first of them: "), F.col(SURPLUS))
    return rows.select(*_as_missing(names, [F.col(f"`{c}`") for c in names], options, surplus, text))


def parse_dates(df: DataFrame, formats: Mapping[str, str | Mapping]) -> DataFrame:
    """D1/D2 on configured columns: ``{column: format}`` or
    ``{column: {"format": fmt, "errors": "raise"|"coerce"}}``."""
    cols = {}
    for column, spec in formats.items():
        fmt, errors = (spec, "raise") if isinstance(spec, str) else (spec["format"], spec.get("errors", "raise"))
        cols[column] = parse_datetime(column, fmt, errors)
    return df.withColumns(cols) if cols else df


def settle_dates(df: DataFrame, formats: Mapping[str, str | Mapping]) -> dict[str, dict]:
    """D2, the automatic retry: a column with a value that its format does not parse is coerced.

    One aggregate over all rows decides. Returns ``{column: {"format", "errors"}}``.
    """
    specs = {c: ({"format": s, "errors": "raise"} if isinstance(s, str) else {"errors": "raise", **s})
             for c, s in formats.items()}
    strict = [c for c, s in specs.items() if s["errors"] != "coerce"]
    if not strict:
        return specs
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & try_parse_datetime(c, specs[c]["format"]).isNull()).alias(f"b{i}")
                   for i, c in enumerate(strict)]).collect()[0]
    return {c: ({**s, "errors": "coerce"} if c in strict and bad[f"b{strict.index(c)}"] else s) for c, s in specs.items()}


def write_parquet(df: DataFrame, path: str) -> None:
    """One directory per table, replaced on every run."""
    df.write.mode("overwrite").parquet(path)


def ingest_files(spark: SparkSession, files: Mapping[str, str], params: Mapping,
                        out_dir: str | None = None) -> dict[str, DataFrame]:
    """Per file, read with its own options, parse its date columns (those
    with values that do not parse are coerced), and (when ``out_dir`` is
    given) write one parquet table per file, and beside it, with
    ``on_bad_lines: warn``, the records left out.

    ``params[name] = {"read": {...}, "dates": {column: format | spec}}``.
    """
    out = {}
    for name, path in files.items():
        cfg = params.get(name, {})
        df = read_delimited(spark, path, cfg.get("read"))
        df = parse_dates(df, settle_dates(df, cfg.get("dates", {})))
        if out_dir:
            target = f"{out_dir.rstrip('/')}/{name}"
            write_parquet(df, target)
            df = spark.read.parquet(target)
            if (cfg.get("read") or {}).get("on_bad_lines") == "warn":
                write_parquet(rejected_records(spark, path, cfg["read"]), f"{target}_rejected")
                n = spark.read.parquet(f"{target}_rejected").count()
                if n:
                    warnings.warn(f"{n} records of {path} were left out, see {target}_rejected", stacklevel=2)
        out[name] = df
    return out


# Error conditions of a read that meets malformed rows.
MALFORMED = ("FAILED_READ_FILE", "MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD")

# -- S2 -----------------------------------------------------------------------

def check_id_column(df: DataFrame) -> None:
    """The first column is the person id (name and format)."""
    first = df.columns[0]
    if not any(m in first.upper() for m in ID_COLUMN_MARKERS):
        raise AssertionError(f"the first column, {first}, is not named like a person id")
    if df.filter(~matches_id_format(first)).limit(1).count():
        raise AssertionError(f"{first} has values that are no person ids")


def probe_read_options(spark: SparkSession, path: str, candidates: Mapping[str, Sequence],
                       defaults: Mapping | None = None, checks: Iterable[Callable[[DataFrame], None]] = (),
                       n_rows: int = 100) -> dict:
    """The first option combination that reads the first ``n_rows``
    rows cleanly, yields more than one column and passes every check.
    Raises ``AssertionError`` when none does."""
    defaults = dict(defaults or {})
    keys = list(candidates)
    tried = []
    for combo in itertools.product(*[candidates[k] for k in keys]):
        opts = {**dict(zip(keys, combo)), **defaults}
        tried.append(opts)
        try:
            sample = read_delimited(spark, path, opts, strict=True).limit(n_rows)
            sample = spark.createDataFrame(sample.collect(), sample.schema)  # n_rows rows, by contract
            if len(sample.columns) <= 1:
                raise AssertionError("the separator leaves a single column")
            for check in checks:
                check(sample)
            return opts
        except (AssertionError, ValueError):
            continue
        except PySparkException as exc:  # a malformed read under FAILFAST
            if (exc.getCondition() or "").split(".")[0] not in MALFORMED:
                raise
    raise AssertionError(f"no combination of options reads {path}: {tried}")


# -- S3 -----------------------------------------------------------------------

def find_date_columns(columns: Sequence[str], words: Sequence[str] = DATE_WORDS) -> list[str]:
    """S3: header names containing any of ``words`` (case-insensitive), in
    header order."""
    pats = [re.compile(re.escape(w), re.IGNORECASE) for w in words]
    return [c for c in columns if any(p.search(c) for p in pats)]


# -- S4 -----------------------------------------------------------------------

def probe_date_formats(df: DataFrame, columns: Sequence[str], formats: Sequence[str],
                       n_rows: int | None = None) -> tuple[dict, dict]:
    """Per column, the first format that parses every value; if none
    does, the first format in coercing mode.

    One aggregate over all rows (or, if asked for, the first ``n_rows``)
    counts, for every (column, format), the non-null values that fail to
    parse. Returns
    ``({column: {"format", "errors"}}, {column: {"format", "errors",
    "nulls"}})`` - the second lists the columns that need coercion and how
    many of the values end up null.
    """
    if not columns or not formats:
        return {c: None for c in columns}, {}
    sample = df.select(*columns) if n_rows is None else df.select(*columns).limit(n_rows)
    aggs = []
    for i, c in enumerate(columns):
        for j, fmt in enumerate(formats):
            bad = F.col(c).isNotNull() & try_parse_datetime(c, fmt).isNull()
            aggs.append(F.count_if(bad).alias(f"b{i}_{j}"))
            aggs.append(F.count_if(try_parse_datetime(c, fmt).isNull()).alias(f"n{i}_{j}"))
    row = sample.agg(*aggs).collect()[0]
    chosen, coerced = {}, {}
    for i, c in enumerate(columns):
        ok = [j for j in range(len(formats)) if row[f"b{i}_{j}"] == 0]
        if ok:
            chosen[c] = {"format": formats[ok[0]], "errors": "raise"}
        else:
            chosen[c] = {"format": formats[0], "errors": "coerce"}
            coerced[c] = {"format": formats[0], "errors": "coerce", "nulls": row[f"n{i}_0"]}
    return chosen, coerced


# -- S7 / S8 / S9 -------------------------------------------------------------

def read_vocabulary(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, date_format: str = "yyyyMMdd",
                    order_column: str | None = None) -> DataFrame:
    """A vocabulary file: tab-separated, header, no quoting (the quote
    character is set to backspace so quotes inside names survive).

    ``order_column`` adds each row's place: file by path, block of the file,
    row of the block. Lookups that take it as their order column let the
    last row of a repeated key win, over any number of files and splits.
    """
    rows = (spark.read.schema(schema).option("sep", "\t").option("quote", "\u0008")
            .option("header", True).option("dateFormat", date_format).csv(path if isinstance(path, str) else list(path)))
    if order_column is None:
        return rows
    # a task reads a block from front to back, so its growing number orders the block's rows
    return rows.withColumn(order_column, F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def write_report(df: DataFrame, path: str) -> None:
    """A CSV report with header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def literal_rows(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """A small table from literal rows (missing keys -> null)."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
