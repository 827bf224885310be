import pytest
from pyspark.sql import functions as F

from tallyloom.operators import (
    aggregates, binning, columns, dictionary, factors, flags, joins, kpi, profile, quantiles, reshape, rows as row_ops, split,
)

from .conftest import rows


def test_missing_keys_match_in_lookup(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    assert rows(joins.left_lookup(left, right)) == [(1, "a", 10), (2, None, 20)]
    named = right.withColumnRenamed("k", "other")
    assert joins.left_lookup(left, named, {"k": "other"}).columns == ["id", "k", "v"]


def test_share_within_handles_missing_groups_and_zero_totals(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), ("z", 0)], "k string, n int")
    got = rows(aggregates.share_within(df, ["k"]).select("k", "n", "share"))
    assert got == [("a", 1, 0.25), ("a", 3, 0.75), ("z", 0, None), (None, 5, 1.0)]
    total = aggregates.share_within(df).agg(F.sum("share")).first()[0]
    assert total == pytest.approx(1)


def test_range_by_keeps_label_columns(spark):
    df = spark.createDataFrame([(4, 90), (4, 62), (6, 110)], "cyl int, hp int")
    assert rows(aggregates.range_by(df, ["cyl"], "hp")) == [(4, 62, 90, "hp", "test"), (6, 110, 110, "hp", "test")]


def test_kpi_counts_and_flags(spark):
    df = spark.createDataFrame([("s", "Yes")] * 2 + [("s", "No")] * 8 + [("h", "No")] * 5 + [("r", "Yes")] + [("r", "No")] * 19, "d string, o string")
    got = {r.d: (r.n, r.share, r.above_baseline, round(r.cost, 2)) for r in kpi.outcome_kpi(df, ["d"], "o", "Yes").collect()}
    assert got == {"s": (2, 0.2, "Yes", 156966.67), "r": (1, 0.05, "No", 78483.33)}


def test_labelled_bars(spark):
    df = spark.createDataFrame([("a", "x", 1500.5), ("b", "y", 250.0)], "d string, r string, cost double")
    got = rows(kpi.labelled_bars(df, ["d", "r"], "cost").select("name", "value_text", "bar"))
    assert got == [("a: x", "$1,500", 2), ("b: y", "$250", 1)]
    small = rows(kpi.labelled_bars(df, [], "cost", "K", reverse=True).select("name", "value_text", "bar"))
    assert small == [("a", "$1.50K", 1), ("b", "$0.25K", 2)]
    kept = rows(kpi.labelled_bars(df, [], "cost", reorder=False, reverse=True).select("name", "bar"))
    assert kept == [("a", 2), ("b", 1)]


def test_price_bins_put_borders_low(spark):
    df = spark.createDataFrame([(2.77,), (2.78,), (4.05,), (4.06,)], "p double")
    got = [r[0] for r in df.select(binning.bin_by(F.col("p"), binning.PRICE_BORDERS, binning.PRICE_LABELS)).collect()]
    assert got == ["low", "medium", "medium", "high"]


@pytest.mark.parametrize("rows_per_task", [10**9, 25])
def test_quantiles_two_ways(spark, rows_per_task):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("k"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.hash("id"), F.lit(37))).alias("v"),
        (F.col("id") * 1.5).alias("w"),
    )
    probs = [0.0, 0.1, 0.33, 0.5, 0.66, 1.0]
    got = rows(quantiles.quantiles(df, ["v", "w"], probs, ["k"], rows_per_task=rows_per_task))
    pdf = df.toPandas()
    want = []
    for k, g in pdf.groupby("k"):
        for c in ("v", "w"):
            want += [(k, c, p, g[c].astype(float).quantile(p)) for p in probs]
    want.sort(key=str)
    got.sort(key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_carry_down_and_dictionary(spark):
    sheet = spark.createDataFrame(
        [(1, "Education", "1 'Below College'"), (2, None, "2 'College'"), (3, None, None), (4, "JobLevel", "1 'Junior'"), (5, None, "oops")],
        "position int, name string, entry string",
    )
    book = dictionary.parse_dictionary(sheet, "name", "entry", "position")
    assert [tuple(r) for r in book.orderBy("position").collect()] == [
        ("Education", 1.0, "Below College", 1), ("Education", 2.0, "College", 2), ("JobLevel", 1.0, "Junior", 4), ("JobLevel", None, None, 5),
    ]
    people = spark.createDataFrame([(7, 2, 1.0, "x"), (8, 9, None, "y")], "id int, Education int, JobLevel double, Age string")
    out = dictionary.readable(people, book)
    assert out.columns == ["Age", "Education", "JobLevel", "id"]
    assert rows(out) == [("x", "College", "Junior", 7), ("y", None, None, 8)]
    levels = dictionary.readable_levels(out, book)
    assert [r.level for r in levels["Education"].orderBy("code").collect()] == ["Below College", "College"]


def test_levels(spark):
    df = spark.createDataFrame([(1, "b", 5.0), (2, "a", 1.0), (3, "b", 7.0), (4, "c", 2.0), (5, None, 9.0)], "id int, k string, v double")

    def order(levels):
        return [r.level for r in levels.orderBy("code").collect()]

    assert order(factors.levels_sorted(df, "k")) == ["a", "b", "c"]
    assert order(factors.levels_first_seen(df, "k", "id")) == ["b", "a", "c"]
    assert order(factors.levels_by(df, "k", "v", "median")) == ["a", "c", "b"]
    assert order(factors.levels_by(df, "k", "v", "max", descending=True)) == ["b", "c", "a"]
    assert order(factors.relevel(factors.levels_sorted(df, "k"), ["c", "b"])) == ["c", "b", "a"]
    assert order(factors.reverse(factors.levels_sorted(df, "k"))) == ["c", "b", "a"]
    coded = factors.codes(df, "k", factors.levels_sorted(df, "k"))
    assert [r.k for r in coded.orderBy("id").collect()] == [2, 1, 2, 3, None]
    with pytest.raises(ValueError):
        factors.level_lists(df, ["k"], limit=2)


def test_widen_fills_absent_cells_only(spark):
    df = spark.createDataFrame([("u", "a", 1.0), ("u", "b", None), ("v", "a", 2.0)], "u string, i string, v double")
    assert rows(reshape.widen(df, ["u"], "i", "v", ["a", "b"], fill=0.0)) == [("u", 1.0, None), ("v", 2.0, 0.0)]


def test_user_item_vectors(spark):
    df = spark.createDataFrame([("u", "a", 1.0), ("u", "c", 2.0), ("u", "c", 3.0), ("v", "b", 4.0)], "u string, i string, v double")
    vectors, width = reshape.user_item_vectors(df, "u", "i", "v")
    assert width == 3
    assert {r.u: list(r.features.toArray()) for r in vectors.collect()} == {"u": [1, 0, 5], "v": [0, 4, 0]}


def test_fill_everything_writes_text_into_text(spark):
    df = spark.createDataFrame([(None, None), (1, "x")], "a int, b string")
    assert rows(row_ops.fill_everything(df)) == [(-1, "-1"), (1, "x")]


def test_row_positions(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 7.0)], "id int, v double")
    assert row_ops.row_at(df, [F.desc("v")], 2).first().id == 3
    assert row_ops.top(df, [F.desc("v")], 1).first().id == 2
    filled = row_ops.carry_down(spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "p int, k string"), "k", ["p"])
    assert [r.k for r in filled.orderBy("p").collect()] == ["a", "a", "b", "b"]


def test_cardinality_counts_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (2, None)], "a int, b double")
    assert rows(profile.cardinality(df)) == [("a", 2), ("b", 2)]


def test_constant_columns_give_no_correlation_or_skewness(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (4.0, 5.0, 9.0)], "a double, b double, c double")
    got = {(r.x, r.y): r.correlation for r in profile.correlation_matrix(df).collect()}
    assert got["a", "b"] is None and got["b", "b"] is None
    assert got["a", "a"] == pytest.approx(1) and got["a", "c"] == got["c", "a"]
    assert {r.key: r.skewness is None for r in profile.skewness_table(df).collect()} == {"a": False, "b": True, "c": False}


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 1.0), (4.0, 8.0)], "a double, b double")
    got = {(r.x, r.y): r.correlation for r in profile.correlation_matrix(df).collect()}
    assert got["a", "b"] == pytest.approx(1)


def test_correlation_with_target_codes_text(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "k string, y double")
    row = profile.correlation_labels(profile.correlation_with(df, "y")).first()
    assert (row.feature, row.label, row.direction) == ("k", 1.0, "Positive")


def test_wide_aggregates_are_chunked(spark, monkeypatch):
    monkeypatch.setattr(profile, "MAX_EXPRESSIONS", 3)
    df = spark.range(5).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(8)])
    row = profile.one_pass(df, {f"c{i}": F.sum(f"c{i}") for i in range(8)}).first()
    assert list(row) == [10 * i for i in range(8)]


def test_histogram_covers_all_rows(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"), F.lit(3.0).alias("same"), F.when(F.col("id") > 50, "b").otherwise("a").alias("t"))
    got = profile.histogram(df, bins=10)
    assert {r.key: r.n for r in got.groupBy("key").agg(F.sum("n").alias("n")).collect()} == {"x": 101, "same": 101, "t": 101}
    last = got.filter("key = 'x' and bin = 9").first()
    assert (last.n, last.lower, last.upper) == (11, 90.0, 100.0)


def test_column_choices(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "b")], ["id", "Job Role", "JobLevel", "other-name"])
    assert columns.containing(df, "job") == ["Job Role", "JobLevel"]
    assert columns.between(df, "Job Role", "JobLevel") == ["Job Role", "JobLevel"]
    assert columns.safe_names(df).columns == ["id", "Job_Role", "JobLevel", "other_name"]
    assert columns.excluding(df, ["id"]) == ["Job Role", "JobLevel", "other-name"]
    assert profile.themed(df, ["id"], ["job"]).columns == ["id", "Job Role", "JobLevel"]
    with pytest.raises(ValueError):
        columns.rename(df, {"nope": "x"})
    with pytest.raises(ValueError):
        columns.rename_by_pattern(spark.createDataFrame([(1, 2)], ["a b", "a-b"]), "[ -]", "_")


def test_component_flags(spark):
    df = spark.createDataFrame(
        [("m", "Shimano Dura-Ace R9100", None, 3.0), ("n", "SRAM XO1 Eagle", "Shimano Nexus", None)],
        ["model", "Rear Derailleur", "Shift Lever", "weight"],
    )
    out = {r.model: r.asDict() for r in flags.component_flags(df).collect()}
    assert len(flags.DERAILLEUR_RULES) == 22 and len(flags.SHIFTER_RULES) == 2
    assert out["m"]["shimano dura-ace"] == 1 and out["m"]["SRAM x01"] == 0 and out["m"]["weight"] == 3.0
    assert out["n"]["SRAM x01"] == 1 and out["n"]["shimano nexus"] == 1 and out["n"]["weight"] == 0.0


def test_splits(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    parts = split.split(split.split(df, "k", 0.7), "k", 0.5, salt=1, name="second")
    n = {(r.split, r.second): r["count"] for r in parts.groupBy("split", "second").count().collect()}
    assert n["train", "train"] == pytest.approx(7000, rel=0.05) and n["test", "test"] == pytest.approx(3000, rel=0.07)
    sizes = [r["count"] for r in split.folds(df, "k", 5, salt=9).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 1.08 * min(sizes)
    crossed = split.folds(split.parts(df, "k", 0.7)[0], "k", 5, salt=9).groupBy("fold").count().collect()
    assert len(crossed) == 5 and min(r["count"] for r in crossed) > 2500
    exact = split.split_exact(df, "k", 0.75)
    assert exact.filter("split = 'train'").count() == 15000
    huge = spark.range(3).select((F.col("id") + 2**62).alias("k"))
    assert split.split(huge, "k", 0.5).count() == 3


def test_stratified_split_with_a_hot_stratum(spark):
    df = spark.range(900).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("s"))
    plain = split.split_exact(df, "k", 0.8, by=["s"])
    sliced = split.split_exact(df, "k", 0.8, by=["s"], rows_per_task=50)
    assert rows(plain) == rows(sliced)
    counts = {r.s: r.n for r in plain.filter("split = 'train'").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert counts["hot"] == 480
    assert split.strata_coverage(plain, "s").filter("not in_both").count() == 0


@pytest.mark.parametrize("by", [[], ["g"]])
def test_wide_correlations_equal_built_in_ones(spark, monkeypatch, by):
    df = spark.range(500).repartition(5).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, "g").alias("g"),
        *[F.when(F.pmod(F.hash("id", F.lit(i)), F.lit(9)) > 0, F.pmod(F.hash("id", F.lit(i)), F.lit(100)) + 1e6 + F.col("id") * i).alias(f"c{i}") for i in range(5)],
        F.lit(7).alias("same"),
    )
    names = [f"c{i}" for i in range(5)] + ["same"]
    plain = {tuple(r)[:-1]: r.correlation for r in profile.correlation_matrix(df, names, by).collect()}
    monkeypatch.setattr(profile, "MAX_EXPRESSIONS", 3)
    wide = {tuple(r)[:-1]: r.correlation for r in profile.correlation_matrix(df, names, by).collect()}
    assert plain.keys() == wide.keys() and len(plain) == 36 * (3 if by else 1)
    for k, v in plain.items():
        assert wide[k] == (pytest.approx(v, abs=1e-9) if v is not None else None), k
