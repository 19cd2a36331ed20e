"""Data-quality checks over the raw table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.operators.slicing import quantiles
from watchfold.session import keep


def _missing(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    null = F.col(name).isNull()
    return null | F.isnan(name) if isinstance(kind, (T.DoubleType, T.FloatType)) else null


def _per_column(df: DataFrame, names: list[str], aggs: dict[str, callable]) -> DataFrame:
    """One pass over the table, result turned into one row per column."""
    one = df.agg(
        *[
            F.struct(F.lit(c).alias("column_name"), *[f(c).alias(n) for n, f in aggs.items()]).alias(f"_{i}")
            for i, c in enumerate(names)
        ]
    )
    return one.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(names))])).alias("r")).select("r.*")


def column_types(df: DataFrame) -> DataFrame:
    """Declared type and non-null count of every column."""
    out = _per_column(df, df.columns, {"non_null": lambda c: F.count_if(~_missing(df, c))})
    kinds = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    return out.withColumn("dtype", kinds[F.col("column_name")]).select("column_name", "dtype", "non_null")


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values: count, share in percent, severity."""
    out = _per_column(
        df, df.columns, {"missing": lambda c: F.count_if(_missing(df, c)), "total": lambda c: F.count(F.lit(1))}
    ).where(F.col("missing") > 0)
    pct = F.col("missing") * 100.0 / F.col("total")
    severity = (
        F.when(pct >= cfg.MISSING_ERROR_PCT, "ERROR").when(pct >= cfg.MISSING_WARNING_PCT, "WARNING").otherwise("INFO")
    )
    return out.select("column_name", "missing", pct.alias("missing_pct"), severity.alias("severity"))


def _fingerprint(df: DataFrame, names: list[str], seed: int) -> Column:
    """A hash of the row that tells missing values by their place and equal zeros not apart."""
    kinds = dict(df.dtypes)
    cells = [F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c) for c in names]
    return F.xxhash64(F.lit(seed), *[x for c, v in zip(names, cells) for x in (F.col(c).isNull(), v)])


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Copies beyond the first of fully equal rows (or of the given columns).

    Counted by a 128-bit fingerprint, so that two numbers a row are shuffled; only rows
    whose fingerprint occurs again are compared in full.
    """
    names = columns or df.columns
    marked = df.select(*names, _fingerprint(df, names, 1).alias("_a"), _fingerprint(df, names, 2).alias("_b"))
    again = marked.groupBy("_a", "_b").count().where("count > 1").select("_a", "_b")
    groups = marked.join(again, ["_a", "_b"], "left_semi").groupBy(*names).count()
    out = groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"))
    n = F.col("duplicates")
    severity = F.when(n == 0, "PASS").when(n <= cfg.MAX_DUPLICATE_ROWS, "INFO").otherwise("ERROR")
    return out.withColumn("severity", severity)


def unparseable(df: DataFrame, text_col: str, fmt: str | None = None) -> DataFrame:
    """Values that are present but are not timestamps."""
    parsed = F.try_to_timestamp(F.col(text_col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(text_col))
    return df.agg(
        F.count_if(parsed.isNull() & F.col(text_col).isNotNull()).alias("unparseable"),
        F.count(text_col).alias("present"),
    )


def time_span(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")).withColumn(
        "days", F.timestamp_diff("DAY", F.col("first_ts"), F.col("last_ts"))
    )


def future_events(df: DataFrame, as_of: Column, ts: str = "event_ts") -> DataFrame:
    return df.agg(F.count_if(F.col(ts) > as_of).alias("future_events"))


def unexpected_values(df: DataFrame, expected: dict[str, list[str]] | None = None) -> DataFrame:
    """Values outside the expected domain, per column."""
    expected = expected or cfg.EXPECTED_VALUES
    present = [c for c in expected if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in present])
    actual = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    known = df.sparkSession.createDataFrame(
        [(c, v) for c in present for v in expected[c]], "column_name string, value string"
    )
    # The expected domains are a fixed list.
    return actual.join(F.broadcast(known), ["column_name", "value"], "left_anti")


def cardinality(df: DataFrame, columns: list[str] | None = None, sample: int = cfg.SAMPLE_VALUES) -> DataFrame:
    """Distinct values per column and the first few in order of appearance."""
    names = [c for c in (columns or cfg.CATEGORICAL_COLUMNS) if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names])
    seen = (
        df.select("event_id", F.explode(pairs).alias("p"))
        .where(F.col("p.value").isNotNull())
        .groupBy("p.column_name", "p.value")
        .agg(F.min("event_id").alias("first_seen"))
    )
    counts = seen.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    order = Window.partitionBy("column_name").orderBy("first_seen", "value")
    firsts = (
        seen.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= sample)
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "value"))).alias("_s"))
        .select("column_name", F.array_join(F.transform("_s", lambda s: s["value"]), ", ").alias("sample_values"))
    )
    return counts.join(firsts, "column_name")


def negatives(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Negative values where none should be; text is coerced, junk ignored."""
    names = [c for c in (columns or cfg.NON_NEGATIVE_COLUMNS) if c in df.columns]
    number = lambda c: F.col(c).try_cast("double")
    return _per_column(
        df,
        names,
        {
            "negatives": lambda c: F.count_if(number(c) < 0),
            "lowest": lambda c: F.min(F.when(number(c) < 0, number(c))),
        },
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != "event_id"]


def _numeric_long(df: DataFrame) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in numeric_columns(df)]
    )
    return df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull())


def five_numbers(df: DataFrame, approx: bool = False, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> DataFrame:
    """Minimum, quartiles and maximum of every numeric column."""
    long = _numeric_long(df)
    quarts = quantiles(
        long, ["column_name"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, approx, rows_per_slice
    )
    ends = long.groupBy("column_name").agg(F.min("value").alias("lowest"), F.max("value").alias("highest"))
    return ends.join(quarts, "column_name").select("column_name", "lowest", "q1", "median", "q3", "highest")


def iqr_outliers(df: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Rows outside the whiskers of their column; one pass, the fences of the few columns written into the plan."""
    summary = summary if summary is not None else keep(five_numbers(df), "five-numbers")
    counts = []
    for r in summary.collect():
        reach = (r["q3"] - r["q1"]) * cfg.IQR_FACTOR
        x = F.col(r["column_name"]).cast("double")
        out = F.count_if((x < F.lit(r["q1"] - reach)) | (x > F.lit(r["q3"] + reach)))
        counts.append(F.struct(F.lit(r["column_name"]).alias("column_name"), out.alias("outliers")))
    if not counts:
        return df.sparkSession.createDataFrame([], "column_name string, outliers long")
    return df.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def label_mismatches(df: DataFrame) -> DataFrame:
    normal, kind = F.col("label") == "Normal", F.col("anomaly_type")
    out = df.agg(
        F.count_if(normal & (kind != "Normal")).alias("normal_with_attack"),
        F.count_if((F.col("label") == "Anomaly") & (kind == "Normal")).alias("anomaly_without_attack"),
    )
    bad = F.col("normal_with_attack") + F.col("anomaly_without_attack") > 0
    return out.withColumn("severity", F.when(bad, "ERROR").otherwise("PASS"))


def class_distributions(df: DataFrame) -> DataFrame:
    """Count and share of every label and of every anomaly type, in one pass."""
    sets = df.groupingSets([["label"], ["anomaly_type"]], "label", "anomaly_type").agg(
        F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n")
    )
    by_label = F.col("_g") == 1
    named = sets.select(
        F.when(by_label, "label").otherwise("anomaly_type").alias("column_name"),
        F.when(by_label, F.col("label")).otherwise(F.col("anomaly_type")).alias("value"),
        "n",
    )
    # A handful of classes per column by now.
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("column_name"))
    return named.withColumn("pct", share)


def entity_coverage(df: DataFrame) -> DataFrame:
    """Distinct entities and events per entity type, and in total."""
    out = df.rollup("entity_type").agg(
        F.grouping("entity_type").alias("_total"),
        F.countDistinct("entity_id").alias("entities"),
        F.count(F.lit(1)).alias("events"),
    )
    kind = F.when(F.col("_total") == 1, F.lit("(all)")).otherwise(F.col("entity_type"))
    ratio = F.col("events") / F.nullif(F.col("entities"), F.lit(0))
    return out.select(kind.alias("entity_type"), "entities", "events", ratio.alias("events_per_entity"))


def invariants(df: DataFrame) -> DataFrame:
    """The facts a usable table satisfies, as one row of booleans."""
    share = F.count_if(F.col("label") == "Anomaly") / F.nullif(F.count(F.lit(1)), F.lit(0))
    attacks = F.countDistinct(F.when(F.col("anomaly_type") != "Normal", F.col("anomaly_type")))
    filled = reduce(lambda a, b: a & b, [F.count(c) > 0 for c in df.columns])
    return df.agg(
        (F.count(F.lit(1)) > 0).alias("has_rows"),
        ((share >= 0.01) & (share <= 0.05)).alias("anomaly_share_ok"),
        filled.alias("no_empty_column"),
        (attacks == len(cfg.ATTACK_TYPES)).alias("all_attacks_present"),
    )


#: Rows with a severity are findings, one per check; the others are the details below them.
FINDINGS = "position int, section string, severity string, subject string, metric string, value double, detail string"


def _whole_table(df: DataFrame, as_of: Column) -> DataFrame:
    """Every check that is a plain aggregate of the table, in one pass (one row)."""
    normal, kind = F.col("label") == "Normal", F.col("anomaly_type")
    number = {c: F.col(c).try_cast("double") for c in cfg.NON_NEGATIVE_COLUMNS if c in df.columns}
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.array(
            *[
                F.struct(F.lit(c).alias("subject"), F.count_if(_missing(df, c)).alias("missing"))
                for c in df.columns
            ]
        ).alias("columns"),
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("subject"), F.count_if(x < 0).alias("n"), F.min(F.when(x < 0, x)).cast("string").alias("lowest")
                )
                for c, x in number.items()
            ]
        ).alias("negatives"),
        F.count_if(sc.parse_ts("event_ts").isNull() & F.col("event_ts").isNotNull()).alias("unparsed"),
        F.min("event_ts").cast("string").alias("first_ts"),
        F.max("event_ts").cast("string").alias("last_ts"),
        F.timestamp_diff("DAY", F.min("event_ts"), F.max("event_ts")).alias("days"),
        F.count_if(F.col("event_ts") > as_of).alias("future"),
        F.count_if(normal & (kind != "Normal")).alias("bad_normal"),
        F.count_if((F.col("label") == "Anomaly") & (kind == "Normal")).alias("bad_anomaly"),
    )


def _value_counts(df: DataFrame) -> DataFrame:
    """(column_name, value, n, first_seen) of the categorical columns, in one pass."""
    names = [c for c in dict.fromkeys(cfg.CATEGORICAL_COLUMNS + list(cfg.EXPECTED_VALUES)) if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names])
    long = df.select("event_id", F.explode(pairs).alias("p")).select("event_id", "p.*").where(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_seen"))


def findings(df: DataFrame, as_of: Column, rows_per_slice: int = cfg.ROWS_PER_SLICE) -> DataFrame:
    """All checks as one table, in report order: a finding with a severity per check, then its details.

    From five passes over the table: plain aggregates, value counts, duplicates,
    quartiles, outliers with coverage.
    """
    spark: SparkSession = df.sparkSession
    one = keep(_whole_table(df, as_of), "quality-row")
    values = keep(_value_counts(df), "quality-values")
    five = keep(five_numbers(df, rows_per_slice=rows_per_slice), "five-numbers")
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)

    def rows(section: int, name: str, table: DataFrame, subject, metric, value, severity=None, detail=None) -> DataFrame:
        return table.select(
            F.lit(section).alias("position"),
            F.lit(name).alias("section"),
            as_col(severity).cast("string").alias("severity"),
            as_col(subject).alias("subject"),
            as_col(metric).alias("metric"),
            as_col(value).cast("double").alias("value"),
            as_col(detail).cast("string").alias("detail"),
        )

    def unless(n: Column, level: str = "WARNING") -> Column:
        return F.when(n > 0, level).otherwise("PASS")

    n = F.count(F.lit(1)).alias("n")
    kinds = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    columns = one.select("total", F.explode("columns").alias("c")).select("total", "c.*")
    miss = columns.where(F.col("missing") > 0).withColumn("pct", F.col("missing") * 100.0 / F.col("total"))
    grade = (
        F.when(F.col("pct") >= cfg.MISSING_ERROR_PCT, "ERROR")
        .when(F.col("pct") >= cfg.MISSING_WARNING_PCT, "WARNING")
        .otherwise("INFO")
    )
    present = [c for c in cfg.EXPECTED_VALUES if c in df.columns]
    fixed = F.broadcast(  # a fixed list
        spark.createDataFrame([(c, v) for c in present for v in cfg.EXPECTED_VALUES[c]], "column_name string, value string")
    )
    odd = values.where(F.col("column_name").isin(*present)).join(fixed, ["column_name", "value"], "left_anti")
    checked = spark.createDataFrame([(c,) for c in present], "column_name string")
    checked = checked.join(odd.groupBy("column_name").agg(n), "column_name", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    spread = values.where(F.col("column_name").isin(*cfg.CATEGORICAL_COLUMNS))
    nth = F.row_number().over(Window.partitionBy("column_name").orderBy("first_seen", "value"))
    some = spread.withColumn("rank", nth).where(F.col("rank") <= cfg.SAMPLE_VALUES).groupBy("column_name")
    some = some.agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("s"))
    spread = spread.groupBy("column_name").agg(n).join(some, "column_name")
    sample = F.array_join(F.transform("s", lambda x: x["value"]), ", ")
    classes = values.where(F.col("column_name").isin("label", "anomaly_type"))
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("column_name"))
    classes = classes.withColumn("pct", share)
    negative = one.select(F.explode("negatives").alias("c")).select("c.*")
    mismatched = F.col("bad_normal") + F.col("bad_anomaly")
    named = F.concat_ws("=", "column_name", "value")
    numbers = five.join(iqr_outliers(df, five), "column_name")
    figures = ["lowest", "q1", "median", "q3", "highest", "outliers"]
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in figures])
    numbers = numbers.select("column_name", F.explode(cells).alias("c")).select("column_name", "c.*")
    covered = keep(entity_coverage(df), "coverage")
    total = F.col("entity_type") == "(all)"
    parts = [
        rows(1, "Schema", columns.agg(n), "table", "columns", F.col("n"), "INFO"),
        rows(1, "Schema", columns, F.col("subject"), "non_null", F.col("total") - F.col("missing"), None, kinds[F.col("subject")]),
        rows(2, "Missing values", miss.agg(n), "table", "columns", F.col("n"), unless(F.col("n"))),
        rows(2, "Missing values", miss, F.col("subject"), "missing_pct", F.col("pct"), None, F.concat_ws(" ", "missing", grade)),
        rows(3, "Duplicates", duplicate_rows(df), "table", "duplicates", F.col("duplicates"), F.col("severity")),
        rows(4, "Timestamps", one, "event_ts", "unparsed", F.col("unparsed"), unless(F.col("unparsed"), "ERROR")),
        rows(4, "Timestamps", one, "event_ts", "days", F.col("days"), "INFO", F.concat_ws(" -> ", "first_ts", "last_ts")),
        rows(4, "Timestamps", one.where("future > 0"), "event_ts", "future_events", F.col("future"), "INFO"),
        rows(5, "Categories", checked, F.col("column_name"), "unexpected", F.col("n"), unless(F.col("n"))),
        rows(5, "Categories", odd, named, "unexpected", F.col("n")),
        rows(5, "Categories", spread.agg(n), "table", "columns", F.col("n"), "INFO"),
        rows(5, "Categories", spread, F.col("column_name"), "distinct", F.col("n"), None, sample),
        rows(6, "Ranges", negative, F.col("subject"), "negatives", F.col("n"), unless(F.col("n")), F.col("lowest")),
        rows(6, "Ranges", five.agg(n), "table", "columns", F.col("n"), "INFO"),
        rows(6, "Ranges", numbers, F.col("column_name"), F.col("metric"), F.col("x")),
        rows(7, "Labels", one, "label", "mismatches", mismatched, unless(mismatched, "ERROR")),
        rows(7, "Labels", classes.agg(n), "table", "classes", F.col("n"), "INFO"),
        rows(7, "Labels", classes, named, "events", F.col("n"), None, F.format_string("%.2f %%", "pct")),
        rows(8, "Entities", covered.where(total), "table", "entities", F.col("entities"), "INFO"),
        rows(8, "Entities", covered.where(~total), F.col("entity_type"), "entities", F.col("entities"), None,
             F.format_string("%d events, %.1f each", "events", "events_per_entity")),
    ]
    empty = spark.createDataFrame([], FINDINGS)
    return reduce(lambda a, b: a.unionByName(b), parts, empty)


def severity_counts(found: DataFrame) -> DataFrame:
    """How many checks ended with each severity."""
    return found.where(F.col("severity").isNotNull()).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def report_lines(found: DataFrame) -> DataFrame:
    """Markdown lines of the report in order; the findings are few."""
    heads = found.groupBy("position", "section").agg(F.count(F.lit(1)).alias("n")).select(
        "position", F.lit(0).alias("sub"), F.lit("").alias("subject"), F.lit("").alias("metric"),
        F.concat(F.lit("## "), F.col("section")).alias("line"),
    )
    mark = F.coalesce(F.concat(F.lit("- ["), F.col("severity"), F.lit("]")), F.lit("  -"))
    what = F.format_string("%s %s: %s = %.4f", mark, "subject", "metric", "value")
    more = F.coalesce(F.concat(F.lit(" ("), F.col("detail"), F.lit(")")), F.lit(""))
    body = found.select(
        "position", F.when(F.col("severity").isNotNull(), 1).otherwise(2).alias("sub"), "subject", "metric",
        F.concat(what, more).alias("line"),
    )
    counts = severity_counts(found).select(
        F.lit(0).alias("position"), F.lit(1).alias("sub"), F.col("severity").alias("subject"),
        F.lit("n").alias("metric"), F.format_string("%s: %d", "severity", "n").alias("line"),
    )
    return counts.unionByName(heads).unionByName(body).orderBy("position", "sub", "subject", "metric")
