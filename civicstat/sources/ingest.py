"""CSV ingest with validation, quarantine and a quality report.

One projection parses every raw text column and collects the names of the
rules a row breaks in an ``array<string>`` column ``reasons``. Clean rows
(no reason), quarantined rows (with their source file) and the per-dataset
report are three views of that one classified frame, so the CSV is read
once per run.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.functions.scalar import is_nonneg, nonneg, number, parse_date, pincode, title_case
from civicstat.schemas import METRIC_PATTERN

STRING_COLUMNS = ("state", "district")
SAMPLE_PER_RULE = 5  # rejected rows kept per (file, rule) in the sample log


CORRUPT = "_corrupt_record"


def plain_path(path: str) -> str:
    """A file's path as readers take it: Spark's columns and lists have it
    URL-encoded, and local ones with one or three slashes."""
    return re.sub("^file:/+", "file:/", unquote(path))


def list_files(spark: SparkSession, paths) -> list[str]:
    """All files under the paths, sorted."""
    paths = list(paths) if isinstance(paths, (list, tuple)) else [paths]
    return sorted(map(plain_path, spark.read.format("text").load(paths).inputFiles()))


def survey_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """One row per file that has a line: source_file, header (its first line)
    and quoted_breaks, whether a quoted field may span lines.

    All files are looked at in one job, large ones in several tasks. A field
    that spans lines leaves an odd number of quotes in the line where it opens;
    lines with an escaped quote are taken for such ones too, to be safe.
    """
    lines = spark.read.text(files).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    tricky = (quotes % 2 == 1) | F.col("value").contains('\\"')
    return lines.groupBy("source_file").agg(F.min_by("value", F.struct("block", "nth")).alias("header"),
                                            F.max(tricky).alias("quoted_breaks"))


def column_names(header: str) -> tuple[str, ...]:
    """The names in a header line; an empty one is called by its position, a
    repeated one gets its position appended."""
    names = next(csv.reader([header.lstrip("\ufeff")]), [])
    often = Counter(n.lower() for n in names)
    return tuple(f"_c{i}" if not n else f"{n}{i}" if often[n.lower()] > 1 else n for i, n in enumerate(names))


def file_groups(spark: SparkSession, files: list[str]) -> dict[tuple[tuple[str, ...], bool], list[str]]:
    """The files by their column names and by whether fields may span lines.
    The driver gets a line of each file. Empty files are in no group."""
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for r in sorted(survey_files(spark, files).collect(), key=lambda r: r["source_file"]):
        file = plain_path(r["source_file"])
        # a header that may itself span lines is left to the CSV reader
        open_header = r["quoted_breaks"] and (r["header"].count('"') % 2 or '\\"' in r["header"])
        names = (tuple(spark.read.option("header", True).option("multiLine", True).csv(file).columns)
                 if open_header else column_names(r["header"]))
        groups.setdefault((names, r["quoted_breaks"]), []).append(file)
    return groups


def unreadable(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """Files that cannot be read to their end, with the reason: the list is
    halved until the broken files are alone, so a few among many take few jobs."""
    try:
        spark.read.text(files).agg(F.count(F.lit(1))).collect()
        return {}
    except Exception as e:  # noqa: BLE001 - whatever the reader finds wrong with the file
        if len(files) == 1:
            return {files[0]: f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"}
    half = len(files) // 2
    return unreadable(spark, files[:half]) | unreadable(spark, files[half:])


def read_raw_csv(spark: SparkSession, paths, salvage: bool = False) -> DataFrame:
    """Header CSV files, every column as text, with the source file
    and the offset of the block that a row was read from.

    Each file is read by its own header: files are grouped by header and the
    groups are joined by column name, a missing column is NULL. Large files are
    split among tasks; only files in which a quoted field spans lines are read
    whole by one task each. A row with more fields than its header keeps its
    text in ``_corrupt_record`` and is rejected later. An unreadable file fails
    the read (``run_etl`` sets such files aside); with ``salvage`` the lines
    before the break are read, each as a row. Without a file that has a header: no row, no column.
    """
    files = list_files(spark, paths)
    parts = []
    if salvage:  # not even their first lines may be read without care
        names = {f: c for f in files if (c := _salvaged_header(spark, f))}
        groups = {}
        for f, c in names.items():
            groups.setdefault((c, False), []).append(f)
    else:
        groups = file_groups(spark, files) if files else {}
    for (columns, whole), own in groups.items():
        kinds = T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField(CORRUPT, T.StringType())])
        part = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", whole)
                .option("enforceSchema", True).option("ignoreCorruptFiles", salvage)
                .option("columnNameOfCorruptRecord", CORRUPT).schema(kinds).csv(own))
        # a row with fewer fields than the header is only short: its last fields are NULL
        long = F.when(F.col(f"`{columns[-1]}`").isNotNull(), F.col(CORRUPT)) if columns else F.col(CORRUPT)
        parts.append(part.withColumn(CORRUPT, long).withColumns({
            "source_file": F.col("_metadata.file_path"), "source_block": F.col("_metadata.file_block_start")}))
    if not parts:
        return spark.createDataFrame([], f"{CORRUPT} string, source_file string, source_block long")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _salvaged_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    first = spark.read.option("ignoreCorruptFiles", True).text(file).limit(1).collect()
    return column_names(first[0]["value"]) if first else ()


def metric_columns(columns, dataset: str) -> list[str]:
    """Metric columns found by name pattern, as in the reference ETL."""
    pat = METRIC_PATTERN[dataset]
    return [c for c in columns if pat in c and not c.startswith("source_") and c != CORRUPT]


def rule_names(columns, dataset: str) -> list[str]:
    out = ["malformed_row"] if CORRUPT in columns else []
    if "date" in columns:
        out.append("invalid_date")
    if "pincode" in columns:
        out.append("invalid_pincode")
    out += [f"invalid_numeric_{c}" for c in metric_columns(columns, dataset)]
    return out


def classify(raw: DataFrame, dataset: str) -> DataFrame:
    """Q1 projection: parsed columns + ``reasons`` (empty array = valid).

    Rules: date must parse as day-month-year (F1); a non-empty pincode must
    be six digits before any '.' (F3; empty stays NULL and valid, D6);
    metrics must be finite and ≥ 0 (F4). State and district are trimmed
    and title-cased (F2) but never reject a row (P5).
    """
    cols = raw.columns
    metrics = metric_columns(cols, dataset)
    # every text is parsed once, in a step of its own: the rules and the output
    # both read its result, so the optimizer keeps the steps apart
    parse = {"date": parse_date, "pincode": pincode, **{c: title_case for c in STRING_COLUMNS}, **{m: number for m in metrics}}
    parsed = {c: F.col(f"_p_{c}") for c in parse if c in cols}
    raw = raw.withColumns({f"_p_{c}": parse[c](c) for c in parsed})
    out: list[Column] = []
    checks: list[Column] = []
    if CORRUPT in cols:
        checks.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_row")))
    if "date" in cols:
        out.append(parsed["date"].alias("date"))
        checks.append(F.when(parsed["date"].isNull(), F.lit("invalid_date")))
    for c in STRING_COLUMNS:
        if c in cols:
            out.append(parsed[c].alias(c))
    if "pincode" in cols:
        out.append(parsed["pincode"].alias("pincode"))
        checks.append(F.when(F.col("pincode").isNotNull() & parsed["pincode"].isNull(), F.lit("invalid_pincode")))
    for m in metrics:
        out.append(nonneg(parsed[m]).alias(m))
        checks.append(F.when(~is_nonneg(parsed[m]), F.lit(f"invalid_numeric_{m}")))
    # array_except drops the NULL entries without a lambda (stays in codegen);
    # ``valid`` is the same test as an empty array, cheap enough to filter on
    no_reason = F.array(F.lit(None).cast("string"))
    reasons = F.array_except(F.array(*checks), no_reason) if checks else F.array().cast("array<string>")
    valid = F.coalesce(*checks).isNull() if checks else F.lit(True)
    raw_struct = F.struct(*[F.col(c) for c in cols if not c.startswith("source_") and c != CORRUPT])
    extra = [F.col(c) for c in ("source_file", "source_block") if c in cols]
    return raw.select(*out, reasons.alias("reasons"), valid.alias("valid"), raw_struct.alias("raw"), *extra)


def clean_rows(classified: DataFrame) -> DataFrame:
    """P5: rows that break no rule, parsed columns only (S4 content)."""
    drop = [c for c in ("reasons", "valid", "raw", "source_file", "source_block") if c in classified.columns]
    return classified.filter(F.col("valid")).drop(*drop)


def quarantine_rows(classified: DataFrame) -> DataFrame:
    """Every rejected row with its raw text, reasons and file."""
    keep = ["raw", "reasons"] + [c for c in ("source_file", "source_block") if c in classified.columns]
    return classified.filter(~F.col("valid")).select(*keep)


def quarantine_sample(quarantine: DataFrame, per_rule: int = SAMPLE_PER_RULE) -> DataFrame:
    """The reference's error log: the first few rejects per (file, rule)."""
    from pyspark.sql import Window
    exploded = quarantine.select("*", F.explode("reasons").alias("rule"))
    order = [F.col("source_block")] if "source_block" in quarantine.columns else []
    w = Window.partitionBy("source_file", "rule").orderBy(*order, F.monotonically_increasing_id())
    return exploded.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_rule).drop("_rn")


def quality_report(classified: DataFrame, dataset: str, rules: list[str]) -> DataFrame:
    """One row: dataset, total_rows, valid_rows, errors map (counts > 0).

    A row counts under every rule it breaks.
    """
    counts = [F.count_if(F.array_contains("reasons", r)).alias(r) for r in rules]
    agg = classified.agg(F.count(F.lit(1)).alias("total_rows"),
                         F.count_if(F.col("valid")).alias("valid_rows"), *counts)
    if rules:
        m = F.map_from_arrays(F.array(*[F.lit(r) for r in rules]), F.array(*[F.col(r) for r in rules]))
        errors = F.map_filter(m, lambda k, v: v > 0)
    else:
        errors = F.create_map().cast("map<string,bigint>")
    return agg.select(F.lit(dataset).alias("dataset"), "total_rows", "valid_rows", errors.alias("errors"))


def errors_text(errors: Column) -> Column:
    """Map → 'rule=count;…' sorted by rule, for flat exports and comparisons."""
    entries = F.array_sort(F.map_entries(errors))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")


def stage_files(spark: SparkSession, dataset: str, files: list[str], staged: str,
                salvage: bool = False) -> tuple[DataFrame | None, list[str], dict[str, str]]:
    """Reads the files once and writes their classified rows to ``staged``:
    (the rows read back, the rules, the unreadable files with the reason).

    The check of single files runs only if the read fails. Without a readable
    row the first is None.
    """
    own, bad = list(files), {}
    while own:
        try:
            raw = read_raw_csv(spark, own)
            classify(raw, dataset).write.mode("overwrite").partitionBy("valid").parquet(staged)
            break
        except Exception:  # noqa: BLE001 - raised again unless a file is to blame
            found = unreadable(spark, own)
            if not found:
                raise
            bad |= found
            own = [f for f in own if f not in found]
    rules = rule_names(raw.columns, dataset) if own else []
    kinds = classify(raw, dataset).schema if own else None
    if bad and salvage:
        rest = read_raw_csv(spark, sorted(bad), salvage=True)
        if rest.columns[:1] != [CORRUPT]:
            extra = classify(rest, dataset)
            extra.write.mode("append" if own else "overwrite").partitionBy("valid").parquet(staged)
            rules = list(dict.fromkeys([*rules, *rule_names(rest.columns, dataset)]))
            kinds = extra.schema if kinds is None else kinds
    if kinds is None:
        return None, rules, bad
    back = spark.read.option("mergeSchema", bool(bad and salvage)).parquet(staged)
    return back.withColumn("valid", F.col("valid").cast("boolean")), rules, bad


def run_etl(spark: SparkSession, files: dict[str, list[str]], out_dir: str, salvage: bool = False) -> DataFrame:
    """L1: for each dataset read its files once, write the classified rows,
    and from those the clean Parquet, the quarantine Parquet and the report
    (JSON); returns the report rows.

    A file that cannot be read to its end is named, with the reason, in
    ``failed_files`` of the report and left out as a whole; with ``salvage``
    its rows before the break count.
    """
    reports = []
    for dataset, paths in files.items():
        classified, rules, bad = stage_files(spark, dataset, list_files(spark, paths), f"{out_dir}/{dataset}_classified.parquet", salvage)
        failed = F.lit(None) if not bad else F.create_map(*[F.lit(x) for kv in sorted(bad.items()) for x in kv])
        failed = failed.cast("map<string,string>").alias("failed_files")
        if classified is not None:
            clean_rows(classified).write.mode("overwrite").parquet(f"{out_dir}/{dataset}_clean.parquet")
            quarantine_rows(classified).write.mode("overwrite").parquet(f"{out_dir}/{dataset}_quarantine.parquet")
            rep = quality_report(classified, dataset, rules)
        else:
            rep = spark.range(1).select(F.lit(dataset).alias("dataset"), F.lit(0).cast("long").alias("total_rows"),
                                        F.lit(0).cast("long").alias("valid_rows"),
                                        F.create_map().cast("map<string,bigint>").alias("errors"))
        rep = rep.select("*", failed)
        reports.append(spark.createDataFrame(rep.collect(), rep.schema))  # one row per dataset
    report = reduce(DataFrame.unionByName, reports)
    report.coalesce(1).write.mode("overwrite").json(f"{out_dir}/validation_report")
    return report


def raw_text_view(df: DataFrame, date_format: str = "dd-MM-yyyy") -> DataFrame:
    """Render a typed fact as the raw text the ETL reads (all columns string)."""
    return df.select(*[(F.date_format(c, date_format) if c == "date" else F.col(c).cast("string")).alias(c)
                       for c in df.columns])
