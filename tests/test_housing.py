"""The housing fixture: absence and median imputation, quality map, log target, engineered
columns; the assertions of the reference's own test, on the library's operators."""
from __future__ import annotations

import math

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from tessera.functions.rules import ordinal_map
from tessera.operators import cleaning as cl
from tessera.operators.quantiles import exact_median

# Quality grades from worst to best.
QUALITY = {"None": 0, "NA": 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
NONE_COLS = ["Alley", "PoolQC", "FireplaceQu"]
ZERO_COLS = ["MasVnrArea", "TotalBsmtSF"]


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1, 65.0, "CollgCr", None, None, None, 196.0, 856.0, 7, 1710, 856, 854, "Gd", 2003, 2008, 208500.0),
            (2, 80.0, "Veenker", None, None, "TA", 0.0, 1262.0, 6, 1262, 1262, 0, "TA", 1976, 2007, 181500.0),
            (3, None, "CollgCr", None, None, "TA", None, 920.0, 7, 1786, 920, 866, "Gd", 2001, 2008, 223500.0),
            (4, 70.0, "Crawfor", None, None, "Gd", 0.0, None, 7, 1717, 961, 756, "TA", 1915, 2006, 140000.0),
            (5, 85.0, "NoRidge", "Pave", "Ex", "TA", 350.0, 1145.0, 8, 2198, 1145, 1053, "Ex", 2000, 2008, 250000.0)]
    return spark.createDataFrame(rows, "Id long, LotFrontage double, Neighborhood string, Alley string, PoolQC string, FireplaceQu string, "
                                       "MasVnrArea double, TotalBsmtSF double, OverallQual int, GrLivArea int, FirstFlr int, SecondFlr int, "
                                       "ExterQual string, YearBuilt int, YrSold int, SalePrice double")


def preprocess(train):
    test = train.drop("SalePrice").withColumn("Id", F.col("Id") + 1000)
    both = train.drop("SalePrice").withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))
    both = cl.fill_absent(both, NONE_COLS, ZERO_COLS)
    both = cl.group_median_fill(both, "LotFrontage", ["Neighborhood"])
    both = cl.fallback_fill(both, exclude=["Id", "is_train"])
    return train.select("Id", F.log1p("SalePrice").alias("y")), both, test


def test_quality_map():
    for k in ("Po", "Fa", "TA", "Gd", "Ex", "None", "NA"):
        assert k in QUALITY
    assert QUALITY["Ex"] > QUALITY["TA"] > QUALITY["Po"]


def test_target_counts_and_no_nulls(train):
    y, both, test = preprocess(train)
    price = {r.Id: r.SalePrice for r in train.collect()}
    assert {r.Id: pytest.approx(r.y) for r in y.collect()} == {i: math.log1p(p) for i, p in price.items()}
    assert both.where("is_train").count() == 5 and both.where("not is_train").count() == test.select("Id").distinct().count() == 5
    nulls = both.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in both.columns]).first().asDict()
    assert not any(nulls.values())
    assert both.where("Id = 3").first().LotFrontage == 65.0


def test_absences(train):
    _, both, _ = preprocess(train)
    row = both.where("Id = 1").first()
    assert row.Alley == row.PoolQC == row.FireplaceQu == "None"
    assert both.where("Id = 3").first().MasVnrArea == 0 and both.where("Id = 4").first().TotalBsmtSF == 0


def test_engineered_columns(train):
    _, both, _ = preprocess(train)
    qual = ordinal_map("ExterQual", QUALITY)
    out = both.withColumns({"TotalSF": F.col("TotalBsmtSF") + F.col("FirstFlr") + F.col("SecondFlr"),
                            "HouseAge": F.col("YrSold") - F.col("YearBuilt"), "QualArea": F.col("OverallQual") * F.col("GrLivArea"),
                            "QualTotalSF": F.col("OverallQual") * (F.col("TotalBsmtSF") + F.col("FirstFlr") + F.col("SecondFlr")),
                            "ExterQualRank": qual})
    price = exact_median(train, "SalePrice", ["Neighborhood"], "NeighborhoodPrice")
    vec = VectorAssembler(inputCols=["NeighborhoodPrice"], outputCol="raw").transform(price)
    vec = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(vec).transform(vec)
    cluster = KMeans(k=2, seed=1).fit(vec).transform(vec).select("Neighborhood", "NeighborhoodPrice", F.col("prediction").alias("NeighborhoodCluster"))
    rows = {r.Id: r for r in out.join(cluster, "Neighborhood", "left").collect()}
    assert rows[1].TotalSF == 856 + 856 + 854 and rows[1].HouseAge == 5 and rows[1].QualArea == 7 * 1710
    assert rows[1].QualTotalSF == 7 * rows[1].TotalSF and rows[5].ExterQualRank == 5
    assert rows[1].NeighborhoodPrice == rows[1003].NeighborhoodPrice == 216000.0
    assert {r.NeighborhoodCluster for r in rows.values()} == {0, 1}
