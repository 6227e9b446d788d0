from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions import geo, prices, registry, text


def values(spark, schema, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_interval_edges(spark):
    data = [
        (2, 46.55), (2, 46.56), (2, 97.0), (2, 96.99), (999, 35.0), (999, 110.0), (999, 35.01), (2, None), (178, 10.5),
    ]
    df = prices.with_limits(spark.createDataFrame(data, "product_id BIGINT, price DOUBLE"))
    price, lo, hi = F.col("price"), F.col("lo"), F.col("hi")
    got = {
        (r.product_id, r.price): (r.bad, r.good)
        for r in df.select(
            "product_id", "price", prices.fails_open(price, lo, hi).alias("bad"),
            prices.passes_closed(price, lo, hi).alias("good"),
        ).collect()
    }
    assert got == {
        (2, 46.55): (True, True),
        (2, 46.56): (False, True),
        (2, 97.0): (True, True),
        (2, 96.99): (False, True),
        (999, 35.0): (True, True),
        (999, 110.0): (True, True),
        (999, 35.01): (False, True),
        (2, None): (False, False),
        (178, 10.5): (False, True),
    }


def test_limits_can_be_given(spark):
    df = spark.createDataFrame([(1,), (2,)], "product_id BIGINT")
    assert sorted(map(tuple, prices.with_limits(df, {}, (1.0, 2.0)).collect())) == [(1, 1.0, 2.0), (2, 1.0, 2.0)]
    assert sorted(map(tuple, prices.with_limits(df, {2: (5.0, 6.0)}).collect())) == [(1, 35.0, 110.0), (2, 5.0, 6.0)]


def test_nan_price_becomes_null(spark):
    data = [(float("nan"),), (1.5,), (None,)]
    assert values(spark, "p DOUBLE", data, prices.clean_price(F.col("p"))) == [(None,), (1.5,), (None,)]


def test_flag(spark):
    assert values(spark, "f STRING", [("t",), ("f",), (None,), ("x",)], prices.shown_flag(F.col("f"))) == [
        ("t",), ("f",), ("f",), ("f",),
    ]


def test_rank_and_group(spark):
    data = [("api_gpn",), ("api_azsgo",), ("nobody",), (None,)]
    assert values(spark, "s STRING", data, prices.source_rank(F.col("s"))) == [(1,), (None,), (None,), (None,)]
    with pytest.raises(Exception, match="without a rank: api_azsgo"):
        values(spark, "s STRING", data[:2], prices.source_rank(F.col("s"), strict=True))
    got = values(spark, "p BIGINT", [(204,), (176,), (41,), (173,), (184,)], prices.equivalence_group(F.col("p")))
    assert [g for (g,) in got] == [176, 176, 4, 4, None]


def test_source_class(spark):
    data = [("api_benzuber",), ("api_ppr",), ("manual_app",)]
    assert values(spark, "s STRING", data, prices.source_class(F.col("s"))) == [(1,), (2,), (0,)]


def test_gps(spark):
    data = [("55.1, 37.2",), ("55.1",), ("",), (None,), ("a,b",), ("1, 2, 3",)]
    got = values(spark, "g STRING", data, text.gps_part(F.col("g"), 1), text.gps_part(F.col("g"), -1))
    assert got == [("55.1", "37.2"), ("55.1", "55.1"), ("", ""), (None, None), ("a", "b"), ("1", "3")]
    numbers = [("1.5",), ("nan",), ("Infinity",), ("x",), ("",), (None,)]
    assert values(spark, "g STRING", numbers, text.number_or_null(F.col("g"))) == [(1.5,)] + [(None,)] * 5


ADDRESS = "road_number STRING, road_km DOUBLE, side STRING, city STRING, locality STRING, street STRING, building STRING"


@pytest.mark.parametrize(
    ("parts", "expected"),
    [
        ((None,) * 7, ""),
        (("", None, "", "", "", "", ""), ""),
        ((None, None, None, "City", None, None, None), "City"),
        (("M-1", 12.4, "Нет_данных", "City", "", "Main st", None), "M-1, 12 км, City, Main st"),
        (("M-1", 12.6, "Левая", None, "Village", None, "5"), "M-1, 13 км, Левая, Village, 5"),
    ],
)
def test_address(spark, parts, expected):
    line = text.address_text(*(F.col(c.split()[0]) for c in ADDRESS.split(", ")))
    assert values(spark, ADDRESS, [parts], text.drop_last_comma(line)) == [(expected,)]


def test_only_the_last_comma_goes(spark):
    data = [("a,,",), ("a,\n",), (",",), ("a,b",), (None,)]
    got = values(spark, "a STRING", data, text.drop_last_comma(F.col("a")))
    assert got == [("a,",), ("a,\n",), ("",), ("a,b",), (None,)]


def test_station_class(spark):
    data = [("АЗС",), ("КриоАЗС",), ("МАЗК",), ("other",), (None,)]
    assert [c for (c,) in values(spark, "t STRING", data, text.station_class(F.col("t")))] == [1, 2, 3, 0, 0]


def test_epoch_text(spark):
    cases = {
        "1600000000000": "2020-09-13 12:26:40",
        "999": "",
        "-999": "",
        "-1500": "1969-12-31 23:59:59",
        "0": "0",
        "": "",
        "abc123": "",
        "253402300799999": "9999-12-31 23:59:59",
        "253402300800000": "",
    }
    data = [(k,) for k in cases]
    assert [v for (v,) in values(spark, "m STRING", data, registry.epoch_text(F.col("m")))] == list(cases.values())
    assert values(spark, "m STRING", [(None,)], registry.epoch_text(F.col("m"))) == [(None,)]


def test_json_paths(spark):
    data = [
        ('[{"value":"x","data":{"phones":null,"emails":[{"v":1}]}}]',), ("[]",), (None,), ("no json",),
    ]
    df = spark.createDataFrame(data, "payload STRING").select(F.try_parse_json("payload").alias("r"))
    paths = ("$[0].value", "$[0].data.phones", "$[0].data.emails", "$[0].data.phones.deeper")
    got = [tuple(r) for r in df.select(*(registry.path_or_default(F.col("r"), p) for p in paths)).collect()]
    assert got == [("x", None, '[{"v":1}]', ""), ("",) * 4, ("",) * 4, ("",) * 4]


def test_director(spark):
    data = [
        ("INDIVIDUAL", "S", "N", "P", ""), ("INDIVIDUAL", "S", "", "P", ""), ("INDIVIDUAL", "S", "N", "", ""),
        ("INDIVIDUAL", "S", None, "P", ""), ("LEGAL", "", "", "", "Boss"), ("OTHER", "S", "N", "P", "Boss"),
        (None, "S", "N", "P", "Boss"),
    ]
    name = registry.director_name(*(F.col(c) for c in "ksnpm"))
    got = [v for (v,) in values(spark, "k STRING, s STRING, n STRING, p STRING, m STRING", data, name)]
    assert got == ["S N P", "S  P", "S N", "S  P", "Boss", "", ""]


def test_codes(spark):
    codes = refdata.LEGAL_FORMS
    null = registry.translate_code(F.col("c"), codes, "null")
    assert values(spark, "c STRING", [("LEGAL",), ("",), ("X",), (None,)], null) == [("ЮЛ",), (None,), (None,), (None,)]
    strict = registry.translate_code(F.col("c"), codes)
    assert values(spark, "c STRING", [("INDIVIDUAL",), ("",)], strict) == [("ИП",), (None,)]
    for bad in ("X", None):
        with pytest.raises(Exception, match="unknown code"):
            values(spark, "c STRING", [(bad,)], strict)
    with pytest.raises(ValueError, match="mode"):
        registry.translate_code(F.col("c"), codes, "other")


def test_haversine_known_distances(spark):
    data = [(0.0, 0.0, 0.0, 180.0), (0.0, 179.5, 0.0, -179.5), (90.0, 0.0, 90.0, 77.0), (10.0, 20.0, 10.0, 20.0)]
    km = geo.haversine_km(*(F.col(c) for c in "abcd"))
    got = [v for (v,) in values(spark, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE", data, km)]
    assert got == pytest.approx([20015.086796, 111.194927, 0.0, 0.0], abs=1e-6)


def test_morton_interleaves(spark):
    top = 1.0 - 2.0**-21
    data = [(-1.0, -1.0, -1.0), (top, -1.0, -1.0), (-1.0, top, -1.0), (-1.0, -1.0, top), (1.0, 1.0, 1.0)]
    got = [v for (v,) in values(spark, "x DOUBLE, y DOUBLE, z DOUBLE", data, geo.morton(*map(F.col, "xyz")))]
    every_third = sum(1 << (3 * i) for i in range(21))
    assert got == [0, every_third, every_third << 1, every_third << 2, (1 << 63) - 1]
