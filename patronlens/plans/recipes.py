"""Feature recipes: every step is learned on training rows and can be applied to any rows.

What a step learns (levels, limits, means) is a few numbers per column. A recipe is the list of its steps, each a name and
learned values, so it can be saved, loaded elsewhere and applied: one chain of projections over the data, without a join.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import encoding, impute, outliers, profile
from ..operators.binning import cut
from ..operators.quantiles import exact_quantiles, group_quantiles

#: What a step does with its learned values: name -> (rows, values) -> rows.
APPLY: dict[str, Callable[[DataFrame, dict], DataFrame]] = {}


def step(apply: Callable[[DataFrame, dict], DataFrame]) -> Callable[[DataFrame, dict], DataFrame]:
    APPLY[apply.__name__] = apply
    return apply


def _capped(c: str, up: float) -> Column:
    return F.when(F.col(c) > up, F.lit(up)).otherwise(F.col(c).cast("double"))


def _chosen(text: Column, made: dict) -> Column:
    """The value that ``text`` is mapped to; NULL for a text that is not known."""
    return F.create_map(*[F.lit(x) for pair in made.items() for x in pair])[text] if made else F.lit(None)


@step
def cap(df: DataFrame, limits: dict) -> DataFrame:
    return df.withColumns({c: _capped(c, up) for c, up in limits.items()})


@step
def fill(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in values.items()})


@step
def fill_by_group(df: DataFrame, learned: dict) -> DataFrame:
    c = learned["column"]
    return df.withColumn(c, F.coalesce(F.col(c).cast("double"), _chosen(F.col(learned["group"]), learned["values"])))


@step
def label_codes(df: DataFrame, codes: dict) -> DataFrame:
    """Position among the sorted levels; unseen and missing give NULL."""
    return df.withColumns({c: _chosen(F.col(c).cast("string"), {v: i for i, v in enumerate(levels)}) for c, levels in codes.items() if levels})


@step
def rare(df: DataFrame, common: dict) -> DataFrame:
    return encoding.rare_encode(df, list(common), 0.0, common)


@step
def one_hot(df: DataFrame, learned: dict) -> DataFrame:
    return encoding.one_hot(df, list(learned["levels"]), learned["levels"], learned["drop_first"])


@step
def minmax(df: DataFrame, limits: dict) -> DataFrame:
    made = {c: (F.col(c) - F.lit(lo)) / F.lit(hi - lo) if hi > lo else F.when(F.col(c).isNotNull(), 0.0) for c, (lo, hi) in limits.items()}
    return df.withColumns(made)


@step
def zero_to_null(df: DataFrame, learned: dict) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in learned["columns"]})


@step
def dropped(df: DataFrame, learned: dict) -> DataFrame:
    return df.drop(*learned["columns"])


@step
def complete_rows(df: DataFrame, learned: dict) -> DataFrame:
    return df.na.drop("any")


class Recipe:
    """Steps in order; ``train`` is the training table as the steps so far leave it, and all that they learn from."""

    def __init__(self, train: DataFrame | None = None, steps: Sequence[tuple[str, dict]] = ()):
        self.train = train
        self.steps: list[tuple[str, dict]] = list(steps)

    def add(self, name: str, learned: dict | None = None) -> "Recipe":
        """A step of ``APPLY`` with what it has learned."""
        self.steps.append((name, learned or {}))
        self.train = APPLY[name](self.train, learned or {})
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        for name, learned in self.steps:
            df = APPLY[name](df, learned)
        return df

    def save(self, spark: SparkSession, path: str) -> None:
        """One line of text in a folder that Spark writes, so any shared storage will do."""
        spark.createDataFrame([(json.dumps(self.steps),)], "value string").coalesce(1).write.text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Recipe":
        return Recipe(steps=[(name, learned) for name, learned in json.loads(spark.read.text(path).first()[0])])

    # --- learned steps ---------------------------------------------------------------------------

    def cap(self, cols: Sequence[str]) -> "Recipe":
        limits = {r.column_name: r.up_limit for r in outliers.outlier_limits(self.train, cols).collect()} if cols else {}
        return self.add("cap", {c: up for c, up in limits.items() if up is not None})

    def fill(self, values: dict[str, float | str | None]) -> "Recipe":
        return self.add("fill", {c: v for c, v in values.items() if v is not None})

    def fill_means(self, cols: Sequence[str]) -> "Recipe":
        row = self.train.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return self.fill(row.asDict())

    def fill_medians(self, cols: Sequence[str]) -> "Recipe":
        if not cols:
            return self
        medians = {r.column_name: r.q[0] for r in exact_quantiles(self.train, cols, [0.5]).collect()}
        return self.fill(medians)

    def fill_group_medians(self, column: str, group: str) -> "Recipe":
        """The median of each group of the training rows; a group without one leaves its rows as they are."""
        named = self.train.where(F.col(group).isNotNull())
        medians = group_quantiles(named, [group], column, {"_median": 0.5}).where("_median IS NOT NULL")
        return self.add("fill_by_group", {"column": column, "group": group, "values": {r[group]: r["_median"] for r in medians.collect()}})

    def fill_modes(self, cols: Sequence[str]) -> "Recipe":
        if not cols:
            return self
        row = impute.mode_row(self.train, cols).first()
        return self.fill({c: row[f"mode_{c}"] for c in cols})

    def label_encode(self, cols: Sequence[str]) -> "Recipe":
        """For columns of few levels; `encoding.label_encode` joins the codes of many."""
        return self.add("label_codes", encoding.category_levels(self.train, cols)) if cols else self

    def rare_encode(self, cols: Sequence[str], ratio: float = 0.01) -> "Recipe":
        return self.add("rare", encoding.common_levels(self.train, cols, ratio)) if cols else self

    def one_hot(self, cols: Sequence[str], drop_first: bool = False) -> "Recipe":
        return self.add("one_hot", {"levels": encoding.category_levels(self.train, cols), "drop_first": drop_first}) if cols else self

    def minmax(self, cols: Sequence[str]) -> "Recipe":
        if not cols:
            return self
        row = self.train.agg(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in cols], *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols]
        ).first()
        return self.add("minmax", {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols if row[f"lo_{c}"] is not None})


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


# --- passengers ----------------------------------------------------------------------------------


def age_band(age: Column) -> Column:
    return F.when(age < 18, "young").when(age < 56, "mature").when(age >= 56, "senior")


def sex_band(sex: Column, age: Column) -> Column:
    """young up to 21, mature between 21 and 50, senior above 50; age 50 has no band."""
    band = F.when(age <= 21, "young").when(age < 50, "mature").when(age > 50, "senior")
    return F.when(sex.isin("male", "female"), F.concat(band, sex))


def passenger_columns(df: DataFrame) -> DataFrame:
    """New columns from name, cabin and family; names in upper case; raw text columns dropped."""
    relatives = F.col("SibSp") + F.col("Parch")
    made = df.withColumns(
        {
            "NEW_CABIN_BOOL": C.null_flag("Cabin"),
            "NEW_NAME_COUNT": F.length("Name"),
            "NEW_NAME_WORD_COUNT": C.word_count("Name"),
            "NEW_NAME_DR": C.words_starting_with("Name", "Dr"),
            "NEW_TITLE": C.extracted("Name", r" ([A-Za-z]+)\."),
            "NEW_FAMILY_SIZE": relatives + 1,
            "NEW_ALONE": F.when(relatives > 0, "NO").when(relatives == 0, "YES"),
        }
    )
    return upper_names(made.drop("Ticket", "Name", "Cabin"))


@step
def passenger_text(df: DataFrame, learned: dict) -> DataFrame:
    return passenger_columns(df)


@step
def passenger_ages(df: DataFrame, learned: dict) -> DataFrame:
    age = F.col("AGE")
    return df.withColumns({"NEW_AGE_PCLASS": age * F.col("PCLASS"), "NEW_AGE_CAT": age_band(age), "NEW_SEX_CAT": sex_band(F.col("SEX"), age)})


def passenger_recipe(train: DataFrame, target: str = "SURVIVED", key: str = "PASSENGERID") -> Recipe:
    recipe = Recipe(train).add("passenger_text").fill_group_medians("AGE", "NEW_TITLE").add("passenger_ages")
    recipe.fill_modes(profile.columns_by_levels(recipe.train, 1, 10, "text"))
    numbers = profile.columns_by_levels(recipe.train, 21, None, "numeric")
    recipe.cap([c for c in numbers if c != key])
    recipe.label_encode(profile.columns_by_levels(recipe.train, 2, 2, "text"))
    recipe.rare_encode(profile.text_columns(recipe.train), 0.01)
    recipe.one_hot([c for c in profile.columns_by_levels(recipe.train, 3, 10) if c not in (target, key)])
    return recipe


# --- patients ------------------------------------------------------------------------------------

ZERO_IS_MISSING = ["Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI"]


def patient_bands(df: DataFrame) -> DataFrame:
    bmi, bp, glucose, age = (F.col(c) for c in ("BMI", "BloodPressure", "Glucose", "Age"))
    return df.withColumns(
        {
            "NEW_BMI": C.last_match(
                [(bmi <= 18.5, "Underweight"), ((bmi > 18) & (bmi <= 24.9), "Normal weight"), ((bmi > 24.9) & (bmi <= 29.9), "Overweight"), (bmi > 29.9, "Obesity")]
            ),
            "NEW_BP": C.last_match(
                [(bp < 80, "Normal"), ((bp >= 80) & (bp <= 89), "High Blood Pressure 1"), (bp > 89, "High Blood Pressure 2")]
            ),
            "NEW_GLUCOSE": cut(glucose, [float("-inf"), 115, 180, float("inf")], ["Excellent", "Good", "Action Suggested"]),
            "NEW_AGE": cut(age, [float("-inf"), 24, 40, 60, float("inf")], ["Young", "Adult", "Mature", "Senior"]),
        }
    )


@step
def patient_groups(df: DataFrame, learned: dict) -> DataFrame:
    return patient_bands(df)


def patient_recipe(train: DataFrame, target: str = "Outcome", key: str | None = None) -> Recipe:
    kept = (target, key)
    recipe = Recipe(train).add("zero_to_null", {"columns": ZERO_IS_MISSING})
    recipe.fill_means(["Glucose", "BloodPressure"]).fill_medians(["SkinThickness", "Insulin", "BMI"])
    recipe.cap([c for c in recipe.train.columns if c not in kept]).add("patient_groups")
    recipe.label_encode(profile.text_columns(recipe.train))
    recipe.one_hot([c for c in profile.columns_by_levels(recipe.train, 3, 10) if c not in kept])
    return recipe.minmax([c for c in recipe.train.columns if c not in kept])


# --- players -------------------------------------------------------------------------------------

RATIOS = {
    "Ratio_CAtBat": ("AtBat", "CAtBat"),
    "Ratio_CHits": ("Hits", "CHits"),
    "Ratio_CHmRun": ("HmRun", "CHmRun"),
    "Ratio_Cruns": ("Runs", "CRuns"),
    "Ratio_CRBI": ("RBI", "CRBI"),
    "Ratio_CWalks": ("Walks", "CWalks"),
    "CAtBat_average": ("CAtBat", "Years"),
    "CHits_average": ("CHits", "Years"),
    "CHmRun_average": ("CHmRun", "Years"),
    "CRun_average": ("CRuns", "Years"),
    "CRBI_average": ("CRBI", "Years"),
    "CWalks_average": ("CWalks", "Years"),
}


def player_columns(df: DataFrame) -> DataFrame:
    years = F.col("Years")
    return df.withColumns(
        {
            "Experience": F.when(years < 5, "inexperienced").when(years < 10, "experienced").when(years >= 10, "senior"),
            "General Performance": F.col("PutOuts") + F.col("Assists") - F.col("Errors"),
            **{new: C.ratio(a, b) for new, (a, b) in RATIOS.items()},
        }
    )


def performance_band(years: Column, general: Column, mean_years: Column, mean_general: Column) -> Column:
    """Better than average: Reasonable with long careers, Good with short ones; Bad: short and below average."""
    return (
        F.when((years > mean_years) & (general > mean_general), "Reasonable")
        .when((years < mean_years) & (general > mean_general), "Good")
        .when((years < mean_years) & (general < mean_general), "Bad")
    )


@step
def player_sums(df: DataFrame, learned: dict) -> DataFrame:
    return player_columns(df)


@step
def player_performance(df: DataFrame, means: dict) -> DataFrame:
    band = performance_band(F.col("Years"), F.col("General Performance"), F.lit(means["years"]), F.lit(means["general"]))
    return upper_names(df.withColumn("PERFORMANCE", band))


def player_recipe(train: DataFrame, target: str = "SALARY", key: str | None = None) -> Recipe:
    recipe = Recipe(train).add("player_sums")
    means = recipe.train.agg(F.avg("Years").alias("years"), F.avg("General Performance").alias("general")).first()
    recipe.add("player_performance", means.asDict())
    text = profile.text_columns(recipe.train)
    distinct = profile.distinct_up_to(recipe.train, text, 2)
    recipe.label_encode([c for c in text if distinct[c] == 2])
    kept = {target, key}
    recipe.one_hot([c for c in profile.columns_by_levels(recipe.train, 3, 10) if c not in kept])
    numbers = profile.numeric_columns(recipe.train)
    distinct = profile.distinct_up_to(recipe.train, numbers, 20)
    recipe.minmax([c for c in numbers if distinct[c] is None and c not in kept])
    return recipe.add("complete_rows")


# --- houses --------------------------------------------------------------------------------------

# Ordinal codes of quality grades and foundation types, and the columns treated specially.
QUALITY = {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1}
FOUNDATION = {"Wood": 1, "Stone": 2, "Slab": 4, "BrkTil": 16, "CBlock": 160, "PConc": 320}
ABSENT_MEANS_NONE = [
    "BsmtFinType1", "BsmtFinType2", "MasVnrType", "Alley", "PoolQC", "MiscFeature", "Fence", "FireplaceQu",
    "GarageType", "GarageFinish", "GarageCond", "BsmtCond", "BsmtExposure",
]
NEARLY_CONSTANT = ["PoolQC", "MiscFeature", "Street", "Utilities", "LandSlope"]
KEPT_AS_NUMBERS = [
    "GrLivArea_cat", "1stFlrSF_cat", "Total_bath", "ExterQual", "GarageQual", "BsmtQual", "HeatingQC", "Yearbuilt_cat",
]


def house_columns(df: DataFrame) -> DataFrame:
    """Sums, products and ordinal codes; columns the table does not have are skipped."""
    c = F.col
    df = df.withColumns(
        {
            "TotalSF": c("GrLivArea") + c("TotalBsmtSF") + c("1stFlrSF") + c("2ndFlrSF"),
            "Restoration_interval": c("YearRemodAdd") - c("YearBuilt"),
            "OutArea": c("OpenPorchSF") + c("PoolArea") + c("WoodDeckSF") + c("GarageArea"),
            "OverallMultp": c("OverallCond") * c("OverallQual"),
            "Total_bath": c("FullBath") + c("HalfBath") * 0.5,
            "ExterQual": C.mapped("ExterQual", QUALITY),
            "HeatingQC": C.mapped("HeatingQC", QUALITY),
            "GarageQual": F.coalesce(C.mapped("GarageQual", QUALITY), F.lit(0)),
            "BsmtQual": F.coalesce(C.mapped("BsmtQual", QUALITY), F.lit(0)),
            "Foundation_types": C.mapped("Foundation", FOUNDATION),
        }
    )
    return df.na.fill("0", [name for name in ABSENT_MEANS_NONE if name in df.columns])


@step
def house_sums(df: DataFrame, thirds: dict) -> DataFrame:
    names = {"1stFlrSF": "1stFlrSF_cat", "GrLivArea": "GrLivArea_cat", "YearBuilt": "Yearbuilt_cat"}
    bands = {names[src]: cut(F.col(src).cast("double"), [float("-inf"), *edges, float("inf")], [1, 2, 3]) for src, edges in thirds.items()}
    return house_columns(df.withColumns(bands))


def house_recipe(houses: DataFrame, target: str = "SalePrice", key: str = "Id", car_th: int = 20) -> Recipe:
    """Learned on all houses, with and without a price; the price itself is never used."""
    recipe = Recipe(houses)
    sources = ["1stFlrSF", "GrLivArea", "YearBuilt"]
    recipe.add("house_sums", {r.column_name: list(r.q) for r in exact_quantiles(houses, sources, [1 / 3, 2 / 3]).collect()})
    roles = profile.column_roles(recipe.train, car_th=car_th)
    recipe.rare_encode(profile.text_columns(recipe.train), 0.01)
    gone = [c for c in NEARLY_CONSTANT if c in recipe.train.columns]
    recipe.add("dropped", {"columns": gone})
    coded = [c for c in roles.categorical + roles.cardinal if c not in {*gone, *KEPT_AS_NUMBERS, target, key}]
    recipe.one_hot(coded, drop_first=True)
    numbers = [c for c in profile.numeric_columns(recipe.train) if c != target]
    recipe.fill_medians(profile.missing_columns(recipe.train, numbers))
    return recipe.cap([c for c in roles.numeric if c not in (target, key)])


def split_by_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a known target, and rows without one (target column dropped)."""
    return df.where(F.col(target).isNotNull()), df.where(F.col(target).isNull()).drop(target)
