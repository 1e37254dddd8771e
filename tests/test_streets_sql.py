"""Street spellings against all pairs; SQL functions against the DataFrame form."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from adlens.functions import sql as S
from adlens.functions import text as X
from adlens.operators import streets
from adlens.plans import adhoc as Z


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def names(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aābcē ") for _ in range(rng.randint(0, 14))) for _ in range(25)] + ["", "a", "b", "ab", "ba", "abc", "Brīvības iela", "aaaaaaa"]
    out = set(base)
    for s in base:
        for _ in range(3):
            t = list(s)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(t) + 1)
                rng.choice([lambda: t.insert(at, rng.choice("abē")), lambda: t and t.pop(min(at, len(t) - 1)),
                            lambda: t and t.__setitem__(min(at, len(t) - 1), rng.choice("aāb"))])()
            out.add("".join(t))
    return sorted(out)


@pytest.mark.parametrize("edits", [1, 2])
def test_pairs_equal_all_pairs(spark, edits):
    known = names(edits)
    df = spark.createDataFrame([(n,) for n in known + known[:5] + [None]], "name string")
    want = sorted((a, b) for a, b in itertools.combinations(known, 2) if distance(a, b) <= edits)
    got = sorted(tuple(sorted((r["a"], r["b"]))) for r in streets.similar_pairs(df, "name", edits).collect())
    assert got == sorted(tuple(sorted(p)) for p in want) and len(want) > 50


def test_one_name_per_group(spark):
    # a chain far longer than any fixed number of rounds would cover, a frequent spelling, a lone name
    chain = ["z" + "a" * i for i in range(1, 41)]
    rows = [(n,) for n in chain] + [("Brivibas",)] * 2 + [("Brīvibas",)] + [("Brīvības",)] * 3 + [("Ozolu",), (None,)]
    got = {r["name"]: (r["canonical"], r["n"]) for r in streets.canonical_names(spark.createDataFrame(rows, "s string"), "s").collect()}
    assert {got[n] for n in chain} == {("za", 1)}
    assert got["Brivibas"] == ("Brīvības", 2) and got["Brīvibas"] == ("Brīvības", 1) and got["Ozolu"] == ("Ozolu", 1)
    assert len(got) == 44
    assert streets.canonical_names(spark.createDataFrame([], "s string"), "s").count() == 0


VALUES = ["1 200 000 € (1 216.67 €/m²)", "1\u00a0200\u202f000 € (1\u202f216.67 €/m²)", "57 000 €", "", "50 m²", "33.5", "3/9/lifts", "1.00/3", "Ģertrūdes iel.9", "pr. 4", "Kr. blv.2", "01.07.2021",
          "2021.07.01", "31.02.2024", "https://ss.lv/msg/lv/real-estate/flats/r/c/abc.html", "https://x/y", "Istabas:>3", "Price:>5 €", "it's \\d", None]


def test_sql_functions_equal_the_columns(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string").withColumn("d", X.parse_source_date("v")).withColumn("n", F.length("v").cast("bigint") * 12345)
    pairs = {
        "strip_tokens(v)": X.strip_tokens("v"), "parse_size(v)": X.parse_size("v"), "parse_price(v)": X.parse_price_total("v"),
        "parse_sqm_price(v)": X.parse_price_per_sqm("v"), "normalise_street(v)": X.normalise_street("v"), "expand_street(v)": X.normalise_street("v", "expand"),
        "url_hash(v)": X.url_hash("v"), "url_path_part(v, 7)": X.url_path_part("v", 7), "apt_floor(v)": X.apt_floor("v"), "house_floors(v)": X.house_floors("v"),
        "has_lift(v)": X.has_lift("v"), "rotate_date(v)": X.rotate_date("v"), "parse_source_date(v)": X.parse_source_date("v"),
        "parse_stored_date(v)": X.parse_stored_date("v"), "format_source_date(d)": X.format_source_date("d"),
        "days_listed(DATE '2024-01-01', d)": X.days_listed("2024-01-01", "d"), "month_key(d)": X.month_key("d"), "month_start(d)": X.month_start("d"),
        "thousands(n)": X.thousands("n")}
    assert {p.split("(")[0] for p in pairs} == set(S.definitions())
    text = "SELECT v, " + ", ".join(f"{call} AS c{i}" for i, call in enumerate(pairs)) + " FROM words"
    got = Z.run_sql(spark, text, {"words": df}, with_functions=True)
    want = df.select("v", *[c.alias(f"c{i}") for i, c in enumerate(pairs.values())])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_parameters_are_values_not_text(spark):
    df = spark.createDataFrame([("a' OR '1'='1",), ("b",)], "v string")
    got = Z.run_sql(spark, "SELECT v FROM words WHERE v = :x", {"words": df}, {"x": "a' OR '1'='1"})
    assert [r["v"] for r in got.collect()] == ["a' OR '1'='1"]
    for bad in ("CREATE TEMPORARY FUNCTION f(x INT) RETURNS INT RETURN x", "DROP TEMPORARY FUNCTION parse_size"):
        with pytest.raises(Z.NotAQuery):
            Z.run_sql(spark, bad, with_functions=True)
