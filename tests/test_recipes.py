"""Recipes learn from training rows alone, are saved, loaded and applied to other rows."""

import pytest
from pyspark.sql import functions as F

from patronlens.plans import models, recipes


def passengers(spark, n, shift=0):
    rows = []
    for i in range(n):
        k = i + shift
        title = ["Mr", "Mrs", "Miss", "Dr"][k % 4]
        rows.append((k, k % 2, 1 + k % 3, f"Name{k}, {title}. X Y", "male" if k % 3 else "female", None if k % 7 == 0 else float(k % 70), k % 3, k % 2, f"T{k}", 5.0 + (k % 90) * (100 if k % 50 == 49 else 1), None if k % 4 else "C1", ["S", "C", "Q"][k % 3]))
    return spark.createDataFrame(rows, "PassengerId long, Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int, Ticket string, Fare double, Cabin string, Embarked string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_recipe_is_saved_loaded_and_applied_to_other_rows(spark, tmp_path):
    train, test = passengers(spark, 300), passengers(spark, 80, 1000)
    recipe = recipes.passenger_recipe(train)
    recipe.save(spark, str(tmp_path / "recipe"))
    loaded = recipes.Recipe.load(spark, str(tmp_path / "recipe"))
    assert [name for name, _ in loaded.steps] == [name for name, _ in recipe.steps]
    out = loaded(test)
    assert out.columns == recipe.train.columns
    assert rows(out) == rows(recipe(test)) and rows(loaded(train)) == rows(recipe.train)


def test_test_rows_change_nothing_that_is_learned(spark):
    train = passengers(spark, 300)
    odd = passengers(spark, 20, 5000).withColumns({"Fare": F.lit(1e9), "Embarked": F.lit("never seen"), "Name": F.lit("A, Lord. B"), "Age": F.lit(None).cast("double")})
    recipe = recipes.passenger_recipe(train)
    learned = dict(recipe.steps)
    out = recipe(odd).collect()
    assert {r.FARE for r in out} == {learned["cap"]["FARE"]}
    assert {r.AGE for r in out} == {None}, "a title without training rows has no median"
    assert not any(c for c in recipe.train.columns if "never" in c or "Lord" in c)
    assert recipes.passenger_recipe(train).steps == recipe.steps


def test_steps_on_nulls_unseen_and_constant_columns(spark):
    train = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), (None, None, 5.0)], "x string, y double, z double")
    recipe = recipes.Recipe(train).fill_medians(["y"]).label_encode(["x"]).minmax(["y", "z"])
    other = spark.createDataFrame([("c", 5.0, 7.0), ("b", None, None)], "x string, y double, z double")
    assert rows(recipe(other)) == sorted([(None, 2.0, 0.0), (1, 0.5, None)], key=repr)
    assert rows(recipe.train) == sorted([(0, 0.0, 0.0), (1, 1.0, 0.0), (None, 0.5, 0.0)], key=repr)


@pytest.mark.parametrize("name", sorted(recipes.APPLY))
def test_every_step_is_known_by_its_name(name):
    assert recipes.APPLY[name].__name__ == name


def test_training_rows_are_dealt_by_the_size_of_their_vectors(spark, monkeypatch):
    """Many alike columns are a small file; a fit reads them as vectors, so their size sets the partitions."""
    wide = spark.range(0, 4000, 1, 2).select("id", *[(F.col("id") % 3).alias(f"c{i}") for i in range(10)])
    features = [f"c{i}" for i in range(10)]
    assert models.evenly(wide, features) is wide
    monkeypatch.setattr(models, "FIT_BYTES", 16_000)
    dealt = models.evenly(wide, features)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) * 80 <= 1.5 * 16_000 and rows(dealt) == rows(wide)
