"""Encoders and scaler: fitted on one table, replayed on any other."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchfold import settings as cfg
from watchfold.functions import scalars as sc
from watchfold.session import keep

TARGETS = ["label", "anomaly_type"]


@dataclass(frozen=True)
class Encoder:
    """Fitted state, as tables.

    ``codes``: (column_name, value, code), the sorted values of the label and
    one-hot columns.  ``scaler``: (column_name, mean, std).
    """

    codes: DataFrame
    scaler: DataFrame

    def save(self, path: str) -> None:
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        self.scaler.write.mode("overwrite").parquet(f"{path}/scaler")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Encoder":
        return Encoder(spark.read.parquet(f"{path}/codes"), spark.read.parquet(f"{path}/scaler"))

    def sizes(self) -> dict[str, int]:
        """Number of values per encoded column."""
        return {r["column_name"]: r["count"] for r in self.codes.groupBy("column_name").count().collect()}

    def categories(self, columns: list[str] | None = None) -> dict[str, list[str]]:
        """Sorted values per encoded column, for tables that have a column per value."""
        codes = self.codes if columns is None else self.codes.where(F.col("column_name").isin(*columns))
        out: dict[str, list[str]] = {}
        for r in codes.orderBy("column_name", "code").collect():
            out.setdefault(r["column_name"], []).append(r["value"])
        return out

    def scales(self) -> dict[str, tuple[float, float]]:
        # One row per scaled column.
        return {r["column_name"]: (r["mean"], r["std"]) for r in self.scaler.collect()}


def prepare(df: DataFrame) -> DataFrame:
    """Default browser, clamped sessions, filled numbers, calendar parts."""
    out = sc.fill_numeric(sc.clamp_sessions(sc.clean_browser(df)))
    return out.withColumns(
        {"is_weekend": sc.is_weekend(), "month": F.month("event_ts"), "day_of_month": F.dayofmonth("event_ts")}
    )


def ordinal(column: str) -> Column:
    """Position in the configured order; unknown values get -1."""
    levels = cfg.ORDINAL_LEVELS[column]
    table = F.create_map(*[F.lit(x) for i, v in enumerate(levels) for x in (v, float(i))])
    return F.coalesce(table[F.col(column)], F.lit(-1.0))


def as_text(column: str) -> Column:
    """Text form in which categories are fitted; booleans read True / False."""
    return F.initcap(F.col(column).cast("string"))


def _text(df: DataFrame, column: str) -> Column:
    return as_text(column) if dict(df.dtypes)[column] == "boolean" else F.col(column).cast("string")


def fit_codes(df: DataFrame) -> DataFrame:
    """Sorted distinct values per label and one-hot column, coded from 0."""
    names = [c for c in cfg.LABEL_COLUMNS + cfg.ONEHOT_COLUMNS if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _text(df, c).alias("value")) for c in names])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    # Distinct values only.
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy("value")) - 1
    return values.withColumn("code", rank)


def fit_scaler(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean and population spread per scaled column, one pass."""
    names = [c for c in (columns or cfg.SCALE_COLUMNS) if c in df.columns]
    items = [
        F.struct(F.lit(c).alias("column_name"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"))
        for c in names
    ]
    return df.agg(F.array(*items).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def fit_encoder(df: DataFrame) -> Encoder:
    ready = prepare(df)
    with ThreadPoolExecutor(1) as pool:
        scaler = pool.submit(lambda: keep(fit_scaler(ready), "scaler"))
        return Encoder(keep(fit_codes(ready), "codes"), scaler.result())


def label_code(df: DataFrame, column: str, values: list[str]) -> Column:
    if not values:
        return F.lit(-1)
    table = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)])
    return F.coalesce(table[_text(df, column)], F.lit(-1))


def dummies(column: str, values: list[str]) -> dict[str, Column]:
    """0/1 columns, the first value in sort order left out; missing -> all 0."""
    hit = F.col(column)
    return {f"{column}_{v}": F.coalesce((hit == v).cast("int"), F.lit(0)) for v in values[1:]}


def scaled(column: str, mean: float, std: float) -> Column:
    return (F.col(column).cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)


def _numbers(ready: DataFrame, encoder: Encoder, label: Callable[[str], Column]) -> dict[str, Column]:
    """The features that are not dummies, in their order; ``label`` gives the code of a label column."""
    out: dict[str, Column] = {}
    known = set(ready.columns)
    for c in cfg.ORDINAL_LEVELS:
        if c in known:
            out[c] = ordinal(c)
    for c in cfg.LABEL_COLUMNS:
        if c in known:
            out[c] = label(c)
    for c in cfg.CALENDAR_COLUMNS:
        out[c] = F.col(c)
    for c, (mean, std) in sorted(encoder.scales().items(), key=lambda s: cfg.SCALE_COLUMNS.index(s[0])):
        out[c] = sc.finite(scaled(c, mean, std)) if c in known else F.lit(0.0)
    return out


def _matrix_columns(ready: DataFrame, encoder: Encoder) -> dict[str, Column]:
    """Feature name -> expression over a prepared table."""
    cats = encoder.categories()
    out = _numbers(ready, encoder, lambda c: label_code(ready, c, cats.get(c, [])))
    for c in cfg.ONEHOT_COLUMNS:
        if c in ready.columns:
            out |= dummies(c, cats.get(c, []))
    return {n: x.cast("double") for n, x in out.items()}


def apply_encoder(df: DataFrame, encoder: Encoder) -> DataFrame:
    """The model matrix: event_id, numeric features, targets. One projection."""
    ready = prepare(df)
    keys = [c for c in ("event_id", "entity_id") if c in df.columns]
    targets = [c for c in TARGETS if c in df.columns]
    features = [x.alias(n) for n, x in _matrix_columns(ready, encoder).items()]
    return ready.select(*keys, *features, *targets)


def _with_codes(ready: DataFrame, encoder: Encoder) -> tuple[DataFrame, dict[str, Column], dict[str, int]]:
    """The table, the code of each label and one-hot column (null: unknown) and the number of its values.

    The values of a column with few are written into the plan; a larger vocabulary is
    joined, by broadcast or by shuffle as its size asks for.
    """
    sizes = encoder.sizes()
    columns = [c for c in cfg.LABEL_COLUMNS + cfg.ONEHOT_COLUMNS if c in ready.columns]
    few = encoder.categories([c for c in columns if sizes.get(c, 0) <= cfg.LITERAL_VALUES])
    codes: dict[str, Column] = {}
    for c in columns:
        if sizes.get(c, 0) <= cfg.LITERAL_VALUES:
            pairs = [F.lit(x) for i, v in enumerate(few.get(c, [])) for x in (v, i)]
            codes[c] = F.create_map(*pairs)[_text(ready, c)] if pairs else F.lit(None).cast("int")
            continue
        values = encoder.codes.where(F.col("column_name") == c).select(
            F.col("value").alias(f"_value_{c}"), F.col("code").alias(f"_code_{c}")
        )
        ready = ready.join(values, _text(ready, c) == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
        codes[c] = F.col(f"_code_{c}")
    return ready, codes, {c: sizes.get(c, 0) for c in columns}


def encode_beside(df: DataFrame, encoder: Encoder, column: str = "features") -> DataFrame:
    """The rows as they are plus their features as sorted (index, value) pairs, zeros left out.

    The indices are those of ``feature_table``; no column is made per value, so a
    vocabulary may have any size. Models run on the same rows: nothing has to be joined
    back by key.
    """
    kept = F.struct(*[F.col(c) for c in df.columns])
    ready, codes, sizes = _with_codes(prepare(df.withColumn("_row", kept)), encoder)
    numbers = _numbers(ready, encoder, lambda c: F.coalesce(codes[c], F.lit(-1)))
    pairs = [(F.lit(i), x.cast("double")) for i, x in enumerate(numbers.values())]
    at = len(numbers)
    for c in cfg.ONEHOT_COLUMNS:
        if c in sizes:
            # The first value in sort order has no dummy.
            pairs.append((F.when(codes[c] > 0, codes[c] + F.lit(at - 1)), F.lit(1.0)))
            at += max(sizes[c] - 1, 0)
    # Marked and removed, not filtered: a lambda would have everything below it interpreted row by row.
    none = F.struct(F.lit(-1).alias("at"), F.lit(0.0).alias("x"))
    cells = F.array(*[F.when(i.isNotNull() & (x != 0), F.struct(i.cast("int").alias("at"), x.alias("x"))).otherwise(none) for i, x in pairs])
    cells = F.array_remove(cells, none)
    return ready.select("_row", cells.alias("_cells")).select(
        "_row.*", F.struct(F.col("_cells.at").alias("at"), F.col("_cells.x").alias("x")).alias(column)
    )


def apply_sparse(df: DataFrame, encoder: Encoder) -> DataFrame:
    """The model matrix with one vector column: event_id, entity_id, features as (index, value) pairs, targets."""
    keys = [c for c in ("event_id", "entity_id") if c in df.columns]
    return encode_beside(df, encoder).select(*keys, "features", *[c for c in TARGETS if c in df.columns])


def feature_table(encoder: Encoder, columns: list[str]) -> DataFrame:
    """(index, feature) of the vectors made of a table with the given columns."""
    spark = encoder.codes.sparkSession
    known = set(columns)
    names = [c for c in [*cfg.ORDINAL_LEVELS, *cfg.LABEL_COLUMNS] if c in known] + list(cfg.CALENDAR_COLUMNS)
    names += sorted(encoder.scales(), key=cfg.SCALE_COLUMNS.index)
    out = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "index int, feature string")
    sizes, at, starts = encoder.sizes(), len(names), []
    for c in cfg.ONEHOT_COLUMNS:
        if c in known:
            starts.append((c, at))
            at += max(sizes.get(c, 0) - 1, 0)
    first = F.broadcast(spark.createDataFrame(starts, "column_name string, first int"))
    dummies = encoder.codes.where(F.col("code") > 0).join(first, "column_name")
    return out.unionByName(
        dummies.select(
            (F.col("first") + F.col("code") - 1).cast("int").alias("index"),
            F.concat_ws("_", "column_name", "value").alias("feature"),
        )
    )


def feature_list(encoder: Encoder, columns: list[str]) -> list[str]:
    """The names in the order of the indices; one per feature of the model."""
    return [r["feature"] for r in feature_table(encoder, columns).orderBy("index").collect()]


def feature_names(matrix: DataFrame) -> list[str]:
    return [c for c in matrix.columns if c not in ("event_id", "entity_id", *TARGETS)]


def align(df: DataFrame, expected: list[str]) -> DataFrame:
    """Exactly the columns a model expects, in its order; missing ones are 0."""
    known = set(df.columns)
    keys = [c for c in ("event_id", "entity_id", *TARGETS) if c in known]
    cols = [(sc.finite(F.col(c)) if c in known else F.lit(0.0)).alias(c) for c in expected]
    return df.select(*keys, *cols)


def with_vector(matrix: DataFrame, names: list[str], column: str = "features") -> DataFrame:
    """Key, targets and the features as one array of doubles."""
    keys = [c for c in ("event_id", "entity_id", *TARGETS) if c in matrix.columns]
    return matrix.select(*keys, F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias(column))


def sparse_dummies(df: DataFrame, encoder: Encoder) -> DataFrame:
    """The non-zero dummies as rows (event_id, feature), for large vocabularies.

    Same categories and same left-out first value as the column form; the codes
    are joined, so their number is not limited.
    """
    ready = prepare(df)
    names = [c for c in cfg.ONEHOT_COLUMNS if c in ready.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _text(ready, c).alias("value")) for c in names])
    long = ready.select("event_id", F.explode(pairs).alias("p")).select("event_id", "p.*")
    kept = encoder.codes.where(F.col("code") > 0).select("column_name", "value")
    return long.join(kept, ["column_name", "value"]).select(
        "event_id", F.concat_ws("_", "column_name", "value").alias("feature")
    )
