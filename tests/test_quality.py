import pytest
from pyspark.sql import functions as F

from lakestrata.operators import project, quality, synth
from lakestrata.operators.aggregate import class_shares
from lakestrata.sources.checked import checked_refresh
from lakestrata.sources.tables import current_version
from tests.conftest import SMALL

RULES = {"positive": "v > 0", "known": "v IS NOT NULL"}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None), (4, 0.0)], "id int, v double").repartition(3)


WANT = {"positive": (1, 3, 1), "known": (3, 1, 0)}


def as_dict(report):
    return {r["rule"]: (r["met"], r["unmet"], r["unknown"]) for r in report.collect()}


def test_report_counts_null_as_unmet(df):
    assert as_dict(quality.expectation_report(df, RULES)) == WANT


def test_observed_report_needs_no_second_scan(spark, df, tmp_path):
    watched, observation = quality.observe_rules(df, RULES)
    watched.write.parquet(f"{tmp_path}/t")
    assert as_dict(quality.observed_report(spark, observation, RULES)) == WANT
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4  # rows are kept


def test_report_of_nothing(df):
    assert as_dict(quality.expectation_report(df.limit(0), RULES)) == {"positive": (0, 0, 0), "known": (0, 0, 0)}


def test_drop_and_fail(df):
    assert [r["id"] for r in quality.drop_unmet(df, RULES).collect()] == [1]
    with pytest.raises(quality.ExpectationError, match="known: 1 rows; positive: 3 rows"):
        quality.fail_unmet(quality.expectation_report(df, RULES))
    quality.fail_unmet(quality.expectation_report(df.filter("v > 0"), RULES))


def test_checked_refresh(spark, df, tmp_path):
    root = f"{tmp_path}/t"
    assert as_dict(checked_refresh(df, root, RULES)) == WANT
    assert current_version(spark, root).count() == 4
    assert as_dict(checked_refresh(df, root, RULES, unmet="drop")) == WANT
    assert [r["id"] for r in current_version(spark, root).collect()] == [1]
    with pytest.raises(quality.ExpectationError):
        checked_refresh(df, root, RULES, unmet="fail")
    assert [r["id"] for r in current_version(spark, root).collect()] == [1]  # nothing was published
    checked_refresh(df.filter("id = 1").withColumn("id", F.lit(7)), root, RULES, unmet="fail")
    assert [r["id"] for r in current_version(spark, root).collect()] == [7]
    with pytest.raises(ValueError):
        checked_refresh(df, root, RULES, unmet="ignore")


def test_date_rule_against_text(spark):
    dates = spark.createDataFrame([("2008-12-31",), ("2009-01-01",)], "d string").select(F.to_date("d").alias("d"))
    assert as_dict(quality.expectation_report(dates, {"adult": "d < '2009-01-01'"})) == {"adult": (1, 1, 0)}


def test_keys_and_references(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (-3,)], "k long")
    right = spark.createDataFrame([(1,), (2,), (5,)], "k long")
    assert tuple(quality.key_check(left, "k").first()) == (4, 3, 3, False, False)
    assert tuple(quality.key_check(right, "k").first()) == (3, 3, 3, True, True)
    assert tuple(quality.reference_check(left, right, "k", "k").first()) == (1, 1)
    assert tuple(quality.reference_check(left.limit(0), right, "k", "k").first()) == (0, 0)
    assert tuple(quality.one_to_one_check(left, right, "k", "k").first()) == (0, 0, 4, 3, 1, 1, 1)
    assert tuple(quality.one_to_one_check(left.union(left.select(F.lit(None).cast("long"))), right, "k", "k").first()) == (4, 0, 4, 3, 1, 1, 1)


def test_violations_count_unknown(df):
    out = quality.violations(df, {"v": F.col("v") >= 0, "id": F.col("id") > 0})
    assert [tuple(r) for r in out.orderBy("check").collect()] == [("id", 0, True), ("v", 2, False)]


def test_words_and_formats(spark):
    df = spark.createDataFrame([("the RED fox",), ("tired",), ("c++ code",), (None,)], "t string")
    assert df.filter(quality.contains_word("t", ["red"])).count() == 1
    ids = spark.createDataFrame([("CATM00000001",), ("CATM0000001",), ("xCATM00000001",)], "i string")
    assert ids.filter(quality.has_format("i", "[A-Z]{4}[0-9]{8}")).count() == 1


def test_schema_census(spark):
    schema = spark.read.parquet(f"{SMALL}/lineitem.parquet").schema
    assert quality.schema_census(schema) == {
        "columns": 11, "bigint": 3, "double": 4, "int": 1, "string": 2, "timestamp_ntz": 1,
    }
    assert quality.missing_columns(schema, ["l_tax", "nope"]) == ["nope"]


def test_class_shares(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [(None,)], "c string")
    out = {r["class"]: (r["rows"], r["share"], r["met"]) for r in class_shares(df, "c", {"a": 60.0, "b": 36.0, "z": 1.0}, 5.0).collect()}
    assert out == {"a": (6, 60.0, True), "b": (3, 30.0, False), "z": (0, 0.0, True)}


def test_leading_columns(spark):
    df = spark.createDataFrame([("1", "2", "3", "4", "5")], ["col_a", "col_b", "col_c", "col_d", "col_e"])
    assert project.lead_columns(df, ["col_d", "col_b"]).columns == ["col_d", "col_b", "col_a", "col_c", "col_e"]
    assert project.lead_columns(df, []).columns == df.columns
    with pytest.raises(ValueError, match="col_z"):
        project.lead_columns(df, ["col_a", "col_z"])


def test_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b.c` int")
    mapping = {"b.c": "second", "x": "never", "a": "first"}
    assert project.rename_project(df, mapping).columns == ["second", "first"]
    assert project.skipped_names(df, mapping) == ["x"]
    with pytest.raises(ValueError, match="x"):
        project.rename_project(df, mapping, strict=True)
    assert project.drop_present(df, ["a", "zzz"]).columns == ["b.c"]


# --- synthetic tables ---------------------------------------------------------------------------


def mutate(df, share=0.2, new=0.006, salt="s"):
    return synth.mutate_snapshot(
        df, "id", share, [{"v": F.lit("m")}, {"w": F.concat("v", F.lit("!"))}], new,
        lambda k: {"v": F.lit("n"), "w": F.concat(F.lit("n"), k)}, salt,
    )


@pytest.mark.parametrize("parts", [1, 7])
def test_mutation_is_exact_and_repeatable(spark, parts):
    df = spark.range(1, 1001).select("id", F.lit("o").alias("v"), F.lit("o").alias("w")).repartition(parts)
    out = {r["id"]: (r["v"], r["w"]) for r in mutate(df).collect()}
    changed = {i for i, r in out.items() if r == ("m", "m!")}
    assert len(changed) == 200 and sorted(set(out) - set(range(1, 1001))) == list(range(1001, 1007))
    assert all(out[i] == ("o", "o") for i in range(1, 1001) if i not in changed)
    again = {r["id"] for r in mutate(df.repartition(3)).filter("v = 'm'").collect()}
    assert again == changed
    other = {r["id"] for r in mutate(df, salt="t").filter("v = 'm'").collect()}
    assert other != changed


def test_mutation_needs_every_column(spark):
    df = spark.range(1, 11).select("id", F.lit("o").alias("v"))
    with pytest.raises(ValueError, match="does not make v"):
        synth.mutate_snapshot(df, "id", 0.5, [], 0.5, lambda k: {}, "s")


def test_draw_parent_covers_and_exists(spark):
    parents = spark.createDataFrame([(10,), (20,), (30,), (30,)], "p long")
    rows = synth.draw_parent(spark.range(300), "id", parents, "p", "s").groupBy("p").count().collect()
    assert sorted(r["p"] for r in rows) == [10, 20, 30] and sum(r["count"] for r in rows) == 300
    with pytest.raises(ValueError):
        synth.draw_parent(spark.range(3), "id", parents.limit(0), "p", "s")


def test_one_per_parent_is_dense(spark):
    rows = synth.one_per_parent(spark.createDataFrame([(7,), (3,), (7,), (9,)], "p long"), "p").collect()
    assert sorted(map(tuple, rows)) == [(3, 1), (7, 2), (9, 3)]


def test_argument_checks():
    synth.require_text(path="x"), synth.require_positive(n=1), synth.require_share(p=1.0)
    synth.require_range("amount", 1, 2), synth.require_date(day="2026-01-31")
    for bad in (
        lambda: synth.require_text(path=" "), lambda: synth.require_positive(n=0), lambda: synth.require_positive(n=True),
        lambda: synth.require_share(p=0), lambda: synth.require_share(p=1.1), lambda: synth.require_range("a", 2, 2),
        lambda: synth.require_date(day="2026-1-1"), lambda: synth.require_date(day="2026-02-30"),
    ):
        with pytest.raises(ValueError):
            bad()
