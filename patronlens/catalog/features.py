"""Feature recipes and tree models.

The tables below give the columns of a passenger, patient, player or house list;
every value follows from the given tables and every row of them is used.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import models, recipes
from ..session import materialise
from ..sources.retail import table
from .registry import query

# --- the four tables, as SQL both engines understand ---------------------------------------------

PASSENGERS = """
SELECT c_custkey AS PassengerId,
       CASE WHEN (c_acctbal > 4000) <> (c_nationkey > 20) THEN 1 ELSE 0 END AS Survived,
       CASE WHEN c_acctbal > 7000 THEN 1 WHEN c_acctbal > 3000 THEN 2 ELSE 3 END AS Pclass,
       concat(c_name, ', ', CASE c_mktsegment WHEN 'BUILDING' THEN 'Mr' WHEN 'AUTOMOBILE' THEN 'Mrs' WHEN 'MACHINERY' THEN 'Miss'
              WHEN 'HOUSEHOLD' THEN 'Master' ELSE 'Dr' END, '. ', n_name) AS Name,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'female' ELSE 'male' END AS Sex,
       CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 125) END AS Age,
       c_nationkey % 4 AS SibSp, c_custkey % 3 AS Parch, c_name AS Ticket,
       CASE WHEN c_acctbal > 6000 THEN concat('C', n_name) END AS Cabin, coalesce(spent, 0) / 1000 AS Fare, r_name AS Embarked
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
     LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS spent FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey"""

PATIENTS = """
SELECT c_custkey AS Id, n AS Pregnancies, CASE WHEN c_nationkey = 3 THEN 0 ELSE round(s / n / 1500) END AS Glucose,
       CASE WHEN c_nationkey = 0 THEN 0 ELSE 50 + 2 * c_nationkey END AS BloodPressure,
       CASE WHEN c_acctbal < 0 THEN 0 ELSE floor(c_acctbal / 150) END AS SkinThickness,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE n * 12 END AS Insulin,
       CASE WHEN c_acctbal BETWEEN 0 AND 300 THEN 0 ELSE 15 + (c_acctbal + 1000) / 350 END AS BMI,
       (c_acctbal + 1000) / 5000 AS DiabetesPedigreeFunction, 21 + c_custkey % 60 AS Age,
       CASE WHEN s / n > 240000 OR c_acctbal > 8000 THEN 1 ELSE 0 END AS Outcome
FROM {customer} JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey"""

PLAYERS = """
SELECT p_partkey AS Id, n AS AtBat, q AS Hits, d AS HmRun, x AS Runs, n + d AS RBI, n + x AS Walks, 1 + p_size % 20 AS Years,
       n * (1 + p_size % 20) AS CAtBat, q * 3 AS CHits, d * (p_size % 7) AS CHmRun, x * 5 + n AS CRuns, n * 4 + d AS CRBI, n * 3 + x AS CWalks,
       p_size AS PutOuts, q % 50 AS Assists, d AS Errors,
       CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'A' ELSE 'N' END AS League, CASE WHEN p_size > 25 THEN 'E' ELSE 'W' END AS Division,
       CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'A' ELSE 'N' END AS NewLeague,
       CASE WHEN p_brand <> 'Brand#7' THEN q * 2.0 + p_size * 10 END AS Salary
FROM {part} JOIN (SELECT l_partkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q, count(CASE WHEN l_discount > 0.05 THEN 1 END) AS d,
                       count(CASE WHEN l_tax > 0.04 THEN 1 END) AS x FROM {lineitem} GROUP BY l_partkey) l ON l_partkey = p_partkey"""

HOUSES = """
SELECT o_orderkey AS Id, floor(l_qty) AS GrLivArea, floor(o_totalprice / 400) AS `1stFlrSF`, CASE WHEN c_acctbal > 5000 THEN floor(c_acctbal / 10) ELSE 0 END AS `2ndFlrSF`,
       CASE WHEN o_orderstatus = 'P' AND c_nationkey = 1 THEN NULL ELSE floor(l_ext / 500) END AS TotalBsmtSF,
       1900 + o_custkey % 100 AS YearBuilt, 1900 + o_custkey % 100 + c_nationkey AS YearRemodAdd, n_lines * 10 AS OpenPorchSF,
       0 AS PoolArea, c_nationkey * 12 AS WoodDeckSF, CASE WHEN c_nationkey = 9 THEN NULL ELSE n_lines * 100 END AS GarageArea,
       1 + c_nationkey % 9 AS OverallCond, 1 + o_custkey % 10 AS OverallQual, 1 + n_lines % 3 AS FullBath, n_lines % 2 AS HalfBath,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Ex' WHEN '2-HIGH' THEN 'Gd' WHEN '3-MEDIUM' THEN 'TA' WHEN '5-LOW' THEN 'Fa' ELSE 'Po' END AS ExterQual,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Gd' WHEN '2-HIGH' THEN 'Ex' ELSE 'TA' END AS HeatingQC,
       CASE WHEN o_orderstatus = 'O' THEN 'TA' WHEN o_orderstatus = 'F' THEN 'Gd' END AS GarageQual, CASE WHEN c_acctbal > 0 THEN 'TA' END AS BsmtQual,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Wood' WHEN 'AUTOMOBILE' THEN 'Stone' WHEN 'MACHINERY' THEN 'Slab' WHEN 'HOUSEHOLD' THEN 'BrkTil' ELSE 'PConc' END AS Foundation,
       n_name AS Neighborhood, CASE WHEN c_acctbal > 9000 THEN 'Grvl' END AS Alley, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS GarageType,
       'Pave' AS Street, 'AllPub' AS Utilities, CASE WHEN o_custkey % 211 = 0 THEN 'Sev' ELSE 'Gtl' END AS LandSlope,
       CASE WHEN o_orderstatus = 'P' THEN 'C (all)' WHEN c_nationkey = 24 AND n_lines = 6 THEN 'RH' ELSE 'RL' END AS MSZoning,
       CASE WHEN o_orderstatus <> 'O' OR c_nationkey > 3 THEN o_totalprice + l_qty * 100 END AS SalePrice
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
     JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS l_qty, sum(l_extendedprice) AS l_ext FROM {lineitem} GROUP BY l_orderkey) l ON l_orderkey = o_orderkey"""


_TABLES = ("customer", "nation", "region", "orders", "lineitem", "part")


def plain(sql: str) -> str:
    """The definition with plain table names and standard quotes."""
    return sql.format(**{name: name for name in _TABLES}).replace("`", '"')


def derive(spark, d, sql: str):
    """Run one of the table definitions over the given files and keep the result."""
    used = {name: table(spark, d, name) for name in _TABLES if f"{{{name}}}" in sql}
    out = spark.sql(sql, **used)
    whole = [f.name for f in out.schema if f.dataType.typeName() == "decimal"]
    return materialise(out.withColumns({c: F.col(c).cast("double") for c in whole}))


def _cap(c: str, source: str) -> str:
    q = lambda p: f"(SELECT quantile_cont({c}, {p}) FROM {source})"
    up = f"({q(0.99)} + 1.5 * ({q(0.99)} - {q(0.01)}))"
    return f"CASE WHEN {c} > {up} THEN {up} ELSE {c} END"


@query(
    "o10_passenger_features",
    "PASSENGERID:long, AGE:double, FARE:double6, NEW_AGE_PCLASS:double, SEX:int, NEW_ALONE:int, NEW_CABIN_BOOL:int, NEW_FAMILY_SIZE_1:int, NEW_NAME_WORD_COUNT:int, "
    "NEW_TITLE_Dr:int, NEW_TITLE_Mr:int, NEW_AGE_CAT_young:int, NEW_AGE_CAT_senior:int, NEW_SEX_CAT_maturemale:int, NEW_SEX_CAT_youngfemale:int, PCLASS_1:int, EMBARKED_ASIA:int",
    f"""WITH p AS ({plain(PASSENGERS)}), t AS (SELECT *, regexp_extract(Name, ' ([A-Za-z]+)\\.', 1) AS title FROM p),
        m AS (SELECT title, quantile_cont(Age, 0.5) AS med FROM t GROUP BY 1),
        f AS (SELECT t.* REPLACE (coalesce(Age, med) AS Age) FROM t JOIN m USING (title)),
        g AS (SELECT *, Age * Pclass AS age_pclass, CASE WHEN Age < 18 THEN 'young' WHEN Age < 56 THEN 'mature' ELSE 'senior' END AS age_cat,
                     CASE WHEN Age <= 21 THEN 'young' || Sex WHEN Age < 50 THEN 'mature' || Sex WHEN Age > 50 THEN 'senior' || Sex END AS sex_cat FROM f),
        h AS (SELECT * REPLACE (coalesce(sex_cat, (SELECT sex_cat FROM g WHERE sex_cat IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS sex_cat) FROM g)
        SELECT PassengerId AS "PASSENGERID", {_cap('Age', 'h')} AS "AGE", {_cap('Fare', 'h')} AS "FARE", {_cap('age_pclass', 'h')} AS "NEW_AGE_PCLASS",
               CASE Sex WHEN 'female' THEN 0 ELSE 1 END AS "SEX", CASE WHEN SibSp + Parch > 0 THEN 0 ELSE 1 END AS "NEW_ALONE",
               CASE WHEN Cabin IS NULL THEN 1 ELSE 0 END AS "NEW_CABIN_BOOL", (SibSp + Parch = 0)::INT AS "NEW_FAMILY_SIZE_1", len(string_split(Name, ' ')) AS "NEW_NAME_WORD_COUNT",
               (title = 'Dr')::INT AS "NEW_TITLE_Dr", (title = 'Mr')::INT AS "NEW_TITLE_Mr", (age_cat = 'young')::INT AS "NEW_AGE_CAT_young", (age_cat = 'senior')::INT AS "NEW_AGE_CAT_senior",
               (sex_cat = 'maturemale')::INT AS "NEW_SEX_CAT_maturemale", (sex_cat = 'youngfemale')::INT AS "NEW_SEX_CAT_youngfemale",
               (Pclass = 1)::INT AS "PCLASS_1", (Embarked = 'ASIA')::INT AS "EMBARKED_ASIA" FROM h""",
)
def o10(spark, d):
    return _passengers(spark, d)


def _passengers(spark, d):
    recipe = recipes.passenger_recipe(derive(spark, d, PASSENGERS))
    return recipe.train


def _scaled(c: str, source: str) -> str:
    return f"({c} - (SELECT min({c}) FROM {source})) / (SELECT max({c}) - min({c}) FROM {source})"


@query(
    "o11_patient_features",
    "Id:long, Glucose:double8, BloodPressure:double8, SkinThickness:double8, Insulin:double8, BMI:double8, Pregnancies:double8, NEW_AGE_3:double, NEW_AGE_0:double, "
    "NEW_BMI_0:double, NEW_BMI_1:double, NEW_GLUCOSE_0:double, Outcome:int",
    f"""WITH p AS ({plain(PATIENTS)}),
        z AS (SELECT * REPLACE (nullif(Glucose, 0) AS Glucose, nullif(BloodPressure, 0) AS BloodPressure, nullif(SkinThickness, 0) AS SkinThickness, nullif(Insulin, 0) AS Insulin, nullif(BMI, 0) AS BMI) FROM p),
        f AS (SELECT * REPLACE (coalesce(Glucose, (SELECT avg(Glucose) FROM z)) AS Glucose, coalesce(BloodPressure, (SELECT avg(BloodPressure) FROM z)) AS BloodPressure,
              coalesce(SkinThickness, (SELECT quantile_cont(SkinThickness, 0.5) FROM z)) AS SkinThickness, coalesce(Insulin, (SELECT quantile_cont(Insulin, 0.5) FROM z)) AS Insulin,
              coalesce(BMI, (SELECT quantile_cont(BMI, 0.5) FROM z)) AS BMI) FROM z),
        c AS (SELECT * REPLACE ({', '.join(f"{_cap(c, 'f')} AS {c}" for c in ('Glucose', 'BloodPressure', 'SkinThickness', 'Insulin', 'BMI', 'Pregnancies', 'Age'))}) FROM f)
        SELECT Id, {', '.join(f"{_scaled(c, 'c')} AS {c}" for c in ('Glucose', 'BloodPressure', 'SkinThickness', 'Insulin', 'BMI', 'Pregnancies'))},
               (Age <= 24)::INT AS "NEW_AGE_3", (Age > 24 AND Age <= 40)::INT AS "NEW_AGE_0", (BMI > 18 AND BMI <= 24.9)::INT AS "NEW_BMI_0", (BMI > 29.9)::INT AS "NEW_BMI_1",
               (Glucose > 180)::INT AS "NEW_GLUCOSE_0", Outcome FROM c""",
)
def o11(spark, d):
    return _patients(spark, d)


def _patients(spark, d):
    return recipes.patient_recipe(derive(spark, d, PATIENTS), key="Id").train


@query(
    "o12_player_features",
    "ID:long, SALARY:double, LEAGUE:int, DIVISION:int, ATBAT:double8, RATIO_CATBAT:double8, CHITS_AVERAGE:double8, EXPERIENCE_senior:int, PERFORMANCE_Good:int",
    f"""WITH p AS ({plain(PLAYERS)}), f AS (SELECT *, PutOuts + Assists - Errors AS gp, AtBat / nullif(CAtBat, 0) AS r1, CHits / nullif(Years, 0) AS a1 FROM p),
        b AS (SELECT *, (SELECT avg(Years) FROM f) AS my, (SELECT avg(gp) FROM f) AS mg FROM f),
        s AS (SELECT Id AS "ID", Salary AS "SALARY", CASE League WHEN 'A' THEN 0 ELSE 1 END AS "LEAGUE", CASE Division WHEN 'E' THEN 0 ELSE 1 END AS "DIVISION",
               {_scaled('AtBat', 'f')} AS "ATBAT", r1 AS "RATIO_CATBAT", {_scaled('a1', 'f')} AS "CHITS_AVERAGE",
               (Years >= 10)::INT AS "EXPERIENCE_senior", coalesce((Years < my AND gp > mg), false)::INT AS "PERFORMANCE_Good", FROM b)
        SELECT * FROM s WHERE "SALARY" IS NOT NULL""",
)
def o12(spark, d):
    return _players(spark, d)


def _players(spark, d):
    return recipes.player_recipe(derive(spark, d, PLAYERS), key="ID").train


@query(
    "o13_house_features",
    "Id:long, GrLivArea:double, TotalBsmtSF:double, GarageArea:double, TotalSF:double2, Restoration_interval:double, OverallMultp:double, ExterQual:int, GarageQual:int, "
    "Total_bath:double, 1stFlrSF_cat:int, Yearbuilt_cat:int, Foundation_types_16:int, SalePrice:double2, Alley_Grvl:int, MSZoning_RL:int",
    f"""WITH h AS ({plain(HOUSES)}),
        f AS (SELECT *, GrLivArea + TotalBsmtSF + "1stFlrSF" + "2ndFlrSF" AS TotalSF, (YearRemodAdd - YearBuilt)::DOUBLE AS Restoration_interval, OverallCond * OverallQual AS OverallMultp, FullBath + HalfBath * 0.5 AS Total_bath FROM h),
        g AS (SELECT * REPLACE (coalesce(TotalBsmtSF, (SELECT quantile_cont(TotalBsmtSF, 0.5) FROM f)) AS TotalBsmtSF, coalesce(GarageArea, (SELECT quantile_cont(GarageArea, 0.5) FROM f)) AS GarageArea,
              coalesce(TotalSF, (SELECT quantile_cont(TotalSF, 0.5) FROM f)) AS TotalSF) FROM f)
        SELECT Id, {', '.join(f"{_cap(c, 'g')} AS {c}" for c in ('GrLivArea', 'TotalBsmtSF', 'GarageArea', 'TotalSF', 'Restoration_interval', 'OverallMultp'))},
               CASE ExterQual WHEN 'Ex' THEN 5 WHEN 'Gd' THEN 4 WHEN 'TA' THEN 3 WHEN 'Fa' THEN 2 ELSE 1 END AS ExterQual,
               CASE GarageQual WHEN 'Gd' THEN 4 WHEN 'TA' THEN 3 ELSE 0 END AS GarageQual, Total_bath,
               CASE WHEN "1stFlrSF" <= (SELECT quantile_cont("1stFlrSF", 1 / 3) FROM h) THEN 1 WHEN "1stFlrSF" <= (SELECT quantile_cont("1stFlrSF", 2 / 3) FROM h) THEN 2 ELSE 3 END AS "1stFlrSF_cat",
               CASE WHEN YearBuilt <= (SELECT quantile_cont(YearBuilt, 1 / 3) FROM h) THEN 1 WHEN YearBuilt <= (SELECT quantile_cont(YearBuilt, 2 / 3) FROM h) THEN 2 ELSE 3 END AS "Yearbuilt_cat",
               (Foundation = 'BrkTil')::INT AS "Foundation_types_16", SalePrice,
               (Alley IS NOT NULL)::INT AS "Alley_Grvl", (MSZoning = 'RL')::INT AS "MSZoning_RL" FROM g""",
)
def o13(spark, d):
    return _houses(spark, d)


def _houses(spark, d):
    return recipes.house_recipe(derive(spark, d, HOUSES)).train


@query("i16_threshold_bands", "Id:long, NEW_BMI:str, NEW_BP:str, NEW_GLUCOSE:str, NEW_AGE:str",
       f"""WITH p AS ({plain(PATIENTS)}) SELECT Id, CASE WHEN BMI > 29.9 THEN 'Obesity' WHEN BMI > 24.9 THEN 'Overweight' WHEN BMI > 18 THEN 'Normal weight' ELSE 'Underweight' END AS NEW_BMI,
           CASE WHEN BloodPressure > 89 THEN 'High Blood Pressure 2' WHEN BloodPressure >= 80 THEN 'High Blood Pressure 1' ELSE 'Normal' END AS NEW_BP,
           CASE WHEN Glucose <= 115 THEN 'Excellent' WHEN Glucose <= 180 THEN 'Good' ELSE 'Action Suggested' END AS NEW_GLUCOSE,
           CASE WHEN Age <= 24 THEN 'Young' WHEN Age <= 40 THEN 'Adult' WHEN Age <= 60 THEN 'Mature' ELSE 'Senior' END AS NEW_AGE FROM p""")
def i16(spark, d):
    return recipes.patient_bands(derive(spark, d, PATIENTS))


@query("i17_performance_bands", "Id:long, Experience:str, band:str",
       f"""WITH p AS ({plain(PLAYERS)}), m AS (SELECT avg(Years) AS y, avg(PutOuts + Assists - Errors) AS g FROM p)
           SELECT Id, CASE WHEN Years < 5 THEN 'inexperienced' WHEN Years < 10 THEN 'experienced' ELSE 'senior' END AS Experience,
                  CASE WHEN Years > y AND PutOuts + Assists - Errors > g THEN 'Reasonable' WHEN Years < y AND PutOuts + Assists - Errors > g THEN 'Good'
                       WHEN Years < y AND PutOuts + Assists - Errors < g THEN 'Bad' END AS band FROM p, m""")
def i17(spark, d):
    players = recipes.player_columns(derive(spark, d, PLAYERS))
    means = players.agg(F.avg("Years").alias("y"), F.avg("General Performance").alias("g"))
    band = recipes.performance_band(F.col("Years"), F.col("General Performance"), F.col("y"), F.col("g"))
    return players.crossJoin(F.broadcast(means)).withColumn("band", band)


@query("i18_age_and_sex_bands", "PassengerId:long, alone:str, age_band:str, sex_band:str",
       f"""WITH p AS ({plain(PASSENGERS)}) SELECT PassengerId, CASE WHEN SibSp + Parch > 0 THEN 'NO' ELSE 'YES' END AS alone,
           CASE WHEN Age < 18 THEN 'young' WHEN Age < 56 THEN 'mature' WHEN Age >= 56 THEN 'senior' END AS age_band,
           CASE WHEN Age <= 21 THEN 'young' || Sex WHEN Age < 50 THEN 'mature' || Sex WHEN Age > 50 THEN 'senior' || Sex END AS sex_band FROM p""")
def i18(spark, d):
    people = derive(spark, d, PASSENGERS)
    alone = F.when(F.col("SibSp") + F.col("Parch") > 0, "NO").otherwise("YES")
    return people.select(
        "PassengerId", alone.alias("alone"), recipes.age_band(F.col("Age")).alias("age_band"), recipes.sex_band(F.col("Sex"), F.col("Age")).alias("sex_band")
    )


@query("i19_house_sums", "Id:long, TotalSF:double2, OutArea:double2, OverallMultp:double2, Total_bath:double2",
       f"""WITH h AS ({plain(HOUSES)}) SELECT Id, GrLivArea + TotalBsmtSF + "1stFlrSF" + "2ndFlrSF" AS TotalSF, OpenPorchSF + PoolArea + WoodDeckSF + GarageArea AS OutArea,
           OverallCond * OverallQual AS OverallMultp, FullBath + HalfBath * 0.5 AS Total_bath FROM h""")
def i19(spark, d):
    return recipes.house_columns(derive(spark, d, HOUSES))


# --- models --------------------------------------------------------------------------------------


def _passenger_split(spark, d):
    """Train and test rows, both prepared by what was learned on the train rows alone."""
    train, test = models.holdout(derive(spark, d, PASSENGERS), "PassengerId", 0.30)
    recipe = recipes.passenger_recipe(train)
    ready = materialise(recipe.train.na.fill(0))
    features = models.feature_names(ready, ["SURVIVED", "PASSENGERID"])
    return models.evenly(ready, features), recipe(test).na.fill(0), features


def _house_split(spark, d):
    ready = materialise(_houses(spark, d))
    known, unknown = recipes.split_by_target(ready, "SalePrice")
    known = known.withColumn("LogPrice", F.log1p("SalePrice"))
    features = models.feature_names(known, ["SalePrice", "LogPrice", "Id"])
    train, test = models.holdout(known, "Id", 0.25, 32)
    return models.evenly(train, features), test, unknown, features


@query("o01_holdout_split", "n_train:long, n_test:long, n_shared:long")
def o01(spark, d):
    train, test = models.holdout(table(spark, d, "customer"), "c_custkey", 0.30)
    shared = train.join(test, "c_custkey", "left_semi").agg(F.count(F.lit(1)).alias("n_shared"))
    return train.agg(F.count(F.lit(1)).alias("n_train")).crossJoin(test.agg(F.count(F.lit(1)).alias("n_test"))).crossJoin(shared)


@query("o02_decision_tree", "class:double, precision:double, recall:double, f1:double, support:long, accuracy:double, auc:double")
def o02(spark, d):
    train, test = models.holdout(derive(spark, d, PATIENTS), "Id", 0.30)
    recipe = recipes.patient_recipe(train, key="Id")
    ready = materialise(recipe.train.na.fill(0))
    features = models.feature_names(ready, ["Outcome", "Id"])
    model = models.decision_tree("Outcome", features).fit(models.evenly(ready, features))
    scored = materialise_scores(model.transform(recipe(test).na.fill(0)), "Outcome")
    return models.classification_report(scored, "Outcome").withColumn("auc", F.lit(models.roc_auc(scored, "Outcome", "score")))


@query("o03_random_forest", "class:double, precision:double, recall:double, f1:double, support:long, accuracy:double, auc:double")
def o03(spark, d):
    train, test, features = _passenger_split(spark, d)
    scored = materialise_scores(models.random_forest("SURVIVED", features).fit(train).transform(test))
    return models.classification_report(scored, "SURVIVED").withColumn("auc", F.lit(models.roc_auc(scored, "SURVIVED", "score")))


def materialise_scores(predicted, label="SURVIVED"):
    """Keep label, prediction and the probability of class 1; read by several measures."""
    from pyspark.ml.functions import vector_to_array

    return materialise(predicted.select(label, "prediction", vector_to_array("probability")[1].alias("score")))


@query("o04_boosted_trees", "n:long, rmse:double")
def o04(spark, d):
    train, test, _, features = _house_split(spark, d)
    return models.rmse(models.boosted_trees("LogPrice", features, rounds=10, max_depth=4).fit(train).transform(test), "LogPrice")


@query("o05_grid_search", "rank:int, params:str, score:double")
def o05(spark, d):
    train, _, features = _passenger_split(spark, d)
    pipeline = models.random_forest("SURVIVED", features, trees=10, max_depth=5)
    found = models.grid_search(pipeline, {"maxDepth": [3, 5], "minInstancesPerNode": [1, 8]}, train, "SURVIVED", "accuracy", folds=3)
    return models.search_table(spark, found)


@query(
    "o06_classification_report",
    "class:double, precision:double8, recall:double8, f1:double8, support:long, accuracy:double8",
    """WITH p AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END AS y, CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0 END AS p FROM lineitem),
       c AS (SELECT unnest([0.0, 1.0]) AS class), k AS (SELECT class, count(*) FILTER (WHERE y = class AND p = class) AS hit, count(*) FILTER (WHERE p = class) AS called,
         count(*) FILTER (WHERE y = class) AS support FROM c, p GROUP BY class)
       SELECT class, hit / called AS precision, hit / support AS recall, 2.0 * hit / (called + support) AS f1, support, (SELECT avg((y = p)::INT) FROM p) AS accuracy FROM k""",
)
def o06(spark, d):
    called = table(spark, d, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("y"), F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("prediction")
    )
    return models.classification_report(called, "y")


@query(
    "o06_roc_auc",
    "auc:double8",
    """WITH p AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity AS s FROM lineitem), v AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM p GROUP BY 1),
       c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg AS below FROM v) SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM c""",
)
def o06_auc(spark, d):
    called = table(spark, d, "lineitem").select(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("y"), F.col("l_quantity").alias("s"))
    return spark.createDataFrame([(models.roc_auc(called, "y", "s"),)], "auc double")


@query("o07_rmse", "n:long, rmse:double4", "SELECT count(*) AS n, sqrt(avg(pow(l_extendedprice - 2100 * l_quantity, 2))) AS rmse FROM lineitem")
def o07(spark, d):
    guessed = table(spark, d, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 2100).alias("prediction"))
    return models.rmse(guessed, "l_extendedprice")


@query("o08_feature_importance", "feature:str, importance:double")
def o08(spark, d):
    train, _, features = _passenger_split(spark, d)
    model = models.random_forest("SURVIVED", features).fit(train)
    return models.importance(spark, model, features)


@query("o09_scored_houses", "Id:long, SalePrice:double2")
def o09(spark, d):
    train, _, unknown, features = _house_split(spark, d)
    model = models.boosted_trees("LogPrice", features, rounds=10, max_depth=4).fit(train)
    return models.score_log_target(model, unknown, "Id", "SalePrice")


@query("i20_column_lists", "position:int, column_name:str",
       """SELECT unnest([0, 1, 2]) AS position, unnest(['p_name', 'p_brand', 'p_type']) AS column_name FROM (SELECT count(*) AS n FROM part) WHERE n > 0""")
def i20(spark, d):
    part = table(spark, d, "part")
    names = [c for c in part.columns if c not in ("p_partkey", "p_size", "p_retailprice")]
    counted = part.agg(*[F.count(c).alias(c) for c in names])
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(c).alias("n")) for i, c in enumerate(names)])
    return counted.select(F.explode(cells).alias("c")).select("c.*").where(F.col("n") > 0)
