"""Leakage-safe features, the forward label and the column dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import NON_FEATURES, TRACKER_METRICS, PanelParams
from panelkit.functions.calendar import at_month_offset
from panelkit.functions.numbers import flag, pct_change, ratio
from panelkit.operators.contracts import require_documented
from panelkit.operators.tidy import low_volume_flag


@dataclass(frozen=True)
class Feature:
    """A made column; its expression and its dictionary entry come from the same fields.

    ``kind``: growth (against an earlier month), shift (difference to an earlier month),
    ahead (growth until a later month), quotient (of two columns) or season.
    """

    name: str
    kind: str
    source: str
    months: int = 0
    by: str = ""

    def column(self) -> Column:
        now = F.col(self.source)
        if self.kind == "quotient":
            return ratio(self.source, self.by)
        if self.kind == "season":
            return F.month(self.source).cast("bigint")
        if self.kind == "ahead":
            return pct_change(at_month_offset(self.source, self.months), now)
        before = at_month_offset(self.source, -self.months)
        return pct_change(now, before) if self.kind == "growth" else now - before

    def formula(self) -> str:
        there = {
            "growth": "{s}[t] / {s}[t-{m}] - 1",
            "shift": "{s}[t] - {s}[t-{m}]",
            "ahead": "{s}[t+{m}] / {s}[t] - 1",
            "quotient": "{s}[t] / {b}[t]",
            "season": "calendar number of {s}[t]",
        }
        return there[self.kind].format(s=self.source, m=self.months, b=self.by)

    def meaning(self) -> str:
        what = words(self.source)
        there = {
            "growth": "relative growth of {w} in {m} months",
            "shift": "movement of {w} in {m} months",
            "ahead": "label: growth of {w} in the coming {m} months; unknown for the last months",
            "quotient": "{w} for each unit of {b}",
            "season": "place in the year",
        }
        return there[self.kind].format(w=what, m=self.months, b=words(self.by))


def words(name: str) -> str:
    return name.replace("_", " ")


def feature_list(params: PanelParams = PanelParams()) -> list[Feature]:
    """The made columns in table order."""
    out = [
        Feature(f"{prefix}_mom_{k}m", "growth", source, k)
        for source, prefix in (("median_sale_price", "price"), ("zhvi", "zhvi"))
        for k in params.momentum_lags
    ]
    out.append(Feature("listings_to_sales", "quotient", "new_listings", by="homes_sold"))
    out.append(Feature("inventory_chg_3m", "growth", "inventory", 3))
    out += [Feature(name, "shift", s, 3) for s, name in params.macro_deltas.items() if s in params.macro_series]
    out.append(Feature("month_of_year", "season", "month"))
    out.append(Feature("target", "ahead", "median_sale_price", params.label_horizon_months))
    return out


def build_features(panel: DataFrame, params: PanelParams = PanelParams()) -> DataFrame:
    """Panel in, modelling table out; every feature looks back, only the label ahead.

    All offsets sit in one select, so the plan has a single exchange on zip, a
    single sort and a single window operator however many lags are configured.
    """
    made = {f.name: f.column() for f in feature_list(params)}
    return panel.withColumns(made).withColumn("target_outlier", flag(outlier(params)))


def outlier(params: PanelParams) -> Column:
    return F.abs("target") > params.target_outlier_threshold


def feature_columns(features: DataFrame) -> list[str]:
    """Numeric columns that are not a key, label, flag or split."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [n for n, t in features.dtypes if t in numeric and n not in NON_FEATURES]


def column_dictionary(params: PanelParams = PanelParams()) -> dict[str, tuple[str, str]]:
    """column -> (meaning, formula) for every column of the feature table.

    Made columns are described by their own definition, published ones by the source
    that lists them, and conditions by their expression.
    """
    published = {"tracker": TRACKER_METRICS, "index": ("zhvi",), "national series": params.macro_series}
    entries = {c: (f"{words(c)}, from the {source}", "as published") for source, own in published.items() for c in own}
    entries |= {c: (f"{what} of the panel's key", "as published, normalised") for c, what in (("zip", "place"), ("month", "time"))}
    entries |= {f.name: (f.meaning(), f.formula()) for f in feature_list(params)}
    conditions = {"low_volume": low_volume_flag(params.low_volume_threshold), "target_outlier": outlier(params)}
    entries |= {c: ("mark of rows that stay in the table but not in fits", expression_text(e)) for c, e in conditions.items()}
    return entries | {"split": ("part of the time line a row belongs to", "from the months that have a label")}


def expression_text(condition: Column) -> str:
    """A condition as Spark prints it."""
    return str(condition).removeprefix("Column<'").removesuffix("'>")


def document(features: DataFrame, params: PanelParams = PanelParams()) -> DataFrame:
    """Put the dictionary entry of each column into its field comment."""
    entries = column_dictionary(params)
    require_documented(features, entries)
    return features.select(
        *[
            F.col(c).alias(c, metadata={"comment": entries[c][0], "formula": entries[c][1]})
            for c in features.columns
        ]
    )


def dictionary_table(spark: SparkSession, features: DataFrame) -> DataFrame:
    """(column, type, comment, formula) read back from a documented schema."""
    rows = [
        (f.name, f.dataType.simpleString(), f.metadata.get("comment"), f.metadata.get("formula"))
        for f in features.schema.fields
    ]
    return spark.createDataFrame(
        rows, "column_name string, data_type string, comment string, formula string"
    )


def lookahead_differences(
    original: DataFrame,
    corrupted: DataFrame,
    cutoff,
    ignore: Sequence[str] = ("target", "target_outlier"),
) -> DataFrame:
    """Feature rows up to ``cutoff`` that change when later months are corrupted.

    An empty result is the proof that no feature looks ahead.
    """
    keep = [c for c in original.columns if c not in ignore]
    before = original.filter(F.col("month") <= F.lit(cutoff)).select(*keep)
    after = corrupted.filter(F.col("month") <= F.lit(cutoff)).select(*keep)
    return before.exceptAll(after).unionByName(after.exceptAll(before))
