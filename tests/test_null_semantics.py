"""Hand-made frames for the null and order rules."""

import math

from pyspark.sql import functions as F

from cohortwatch.functions.codes import (flag_equal, flag_not_equal, group_codes, ordinal_encode,
                                         ordinal_lookup, py_float)
from cohortwatch.operators import clean as C
from cohortwatch.operators import features as FE


def test_not_equal_keeps_nulls(spark):  # N1
    df = spark.createDataFrame([("Male",), ("Unknown/Invalid",), (None,)], "g string")
    assert C.not_equal_filter_keep_null(df, "g", "Unknown/Invalid").count() == 2


def test_anti_filter_keeps_nulls(spark):  # N2
    df = spark.createDataFrame([(11,), (1,), (None,)], "c int")
    out = sorted((r.c is None, r.c) for r in C.anti_filter_keep_null(df, "c", [11, 13]).collect())
    assert out == [(False, 1), (True, None)]


def test_flags_on_null(spark):  # N3, N4
    df = spark.createDataFrame([("NO",), ("<30",), (None,)], "r string")
    got = [r.f for r in df.select(flag_not_equal("r", "NO").alias("f")).collect()]
    assert got == [0, 1, 1]
    got = [r.f for r in df.select(flag_equal("r", "NO").alias("f")).collect()]
    assert got == [1, 0, 0]


def test_shares_ignore_nulls(spark):  # N5
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    shares = {r.s: r.share_pct for r in FE.category_shares(df, "s").collect()}
    assert math.isclose(shares["a"], 200 / 3) and None not in shares


def test_rare_bucket_null_is_other(spark):  # N6
    df = spark.createDataFrame([("a",)] * 98 + [("b",), (None,)], "s string")
    out = FE.rare_bucket(df, "s", "g", 2.0)
    got = sorted((r.s is None, r.g) for r in out.distinct().collect())
    assert got == [(False, "Other"), (False, "a"), (True, "Other")]


def test_unmapped_band_is_null(spark):  # N7
    df = spark.createDataFrame([("[0-10)",), ("[90-100)",), ("[100-110)",), (None,)], "a string")
    assert [r.o for r in df.select(ordinal_lookup("a").alias("o")).collect()] == [0, 9, None, None]


def test_placeholder_whole_cell_only(spark):  # N8
    df = spark.createDataFrame([("?",), ("a?",), ("?b",)], "s string")
    assert [r.s for r in C.placeholder_to_null(df).collect()] == [None, "a?", "?b"]


def test_code_groups_edges(spark):  # N10, N11, N12
    codes = ["459", "459.5", "785", "250", "250.99", "251", "V45", "E880", "12d", " 428 ", "nan", "inf",
             None, "1_40", "v45", "140.0"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r.g for r in df.select(group_codes("c").alias("g")).collect()]
    assert got == ["Circulatory", "Other", "Circulatory", "Diabetes", "Diabetes", "Other", "Other", "Other",
                   "Other", "Circulatory", "Other", "Other", "Missing", "Neoplasms", "Other", "Neoplasms"]


def test_py_float_rules(spark):  # N11
    df = spark.createDataFrame([("12d",), ("1e3",), (" 7 ",), ("-.5",), ("x",)], "c string")
    assert [r.v for r in df.select(py_float(F.col("c")).alias("v")).collect()] == [None, 1000.0, 7.0, -0.5, None]


def test_first_per_key_null_keys_and_order(spark):  # N13
    rows = [(3, 1, "c"), (1, 1, "a"), (2, None, "x"), (5, None, "y"), (None, 1, "z")]
    df = spark.createDataFrame(rows, "id int, k int, v string")
    got = sorted((r.k is None, r.k, r.v) for r in C.first_per_key(df, "k", "id").collect())
    assert got == [(False, 1, "a"), (True, None, "x")]


def test_describe_sample_std_and_quartiles(spark):  # N14
    from cohortwatch.operators.profile import describe
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    r = describe(df, ["x"], exact=True).first()
    assert math.isclose(r["std"], 1.2909944487358056) and r["q25"] == 1.75 and r["q75"] == 3.25


def test_ordinal_unseen_and_null(spark):  # F06
    df = spark.createDataFrame([("Female",), ("Male",), ("UNKNOWN",), (None,)], "g string")
    got = [r.o for r in df.select(ordinal_encode("g", {"Female": 0, "Male": 1}).alias("o")).collect()]
    assert got == [0, 1, -1, -1]


def test_all_null_column_coerced(spark):  # N15
    from cohortwatch.operators.encode import TransformSpec, apply_spec
    spec = TransformSpec(["a"], {"a": 2.5}, ["g"], {"g": "F"}, "g", {"F": 0, "M": 1}, {}, ["a", "g"])
    df = spark.createDataFrame([(1,), (2,)], "k int")  # neither feature column present
    got = [(r.a, r.g) for r in apply_spec(df, spec).collect()]
    assert got == [(2.5, 0), (2.5, 0)]


def test_csv_na_tokens(spark):  # N9, A01
    import os

    from pyspark.sql import types as T

    from cohortwatch.session import shared_path
    from cohortwatch.sources.io import read_csv
    folder = shared_path(spark, "test-csv")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("k,s,x\n1,NA,1.5\n2,null,\n3,n/a,NaN\n4,ok,2\n")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    got = sorted((r.k, r.s, r.x) for r in read_csv(spark, folder, schema).collect())
    assert got == [(1, None, 1.5), (2, None, None), (3, None, None), (4, "ok", 2.0)]


def test_scenario_name_from_file_stem(spark):  # A03
    import os

    from pyspark.sql import types as T

    from cohortwatch.session import shared_path
    from cohortwatch.sources.io import read_scenario_files
    folder = shared_path(spark, "test-scenarios")
    os.makedirs(folder, exist_ok=True)
    for name, rows in (("dist_shift", 2), ("column_swap", 3)):
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write("v\n" + "".join(f"{i}\n" for i in range(rows)))
    df = read_scenario_files(spark, folder, T.StructType([T.StructField("v", T.IntegerType())]))
    got = {r.scenario: r.n for r in df.groupBy("scenario").count().withColumnRenamed("count", "n").collect()}
    assert got == {"dist_shift": 2, "column_swap": 3}
