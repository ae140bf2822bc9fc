"""Fixed values and edge cases of column functions."""

import datetime as dt

import pytest
import xxhash
from pyspark.sql import functions as F

from sightline.functions import jsons, keys, nested, rules, text, times


def values(spark, column, items, ddl):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {ddl}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x")), "i").collect()]


def test_fingerprint(spark):
    urls = ["http://a.b.mp4", None, "", "a", "a.b", "a.b.c.d", "é.ü.ß"]

    def expected(url):
        if url is None:
            return None
        parts = url.split(".")
        key = f"{parts[0]}.{parts[1] if len(parts) > 1 else ''}.{parts[-1]}"
        n = xxhash.xxh64(key.encode(), seed=42).intdigest()
        return n - (1 << 64) if n >= 1 << 63 else n

    got = values(spark, keys.url_fingerprint, urls, "string")
    assert got == [expected(u) for u in urls]
    assert got[0] == -1667716348415877597


def test_md5_key(spark):
    got = values(spark, lambda x: keys.product_key(x, "2"), [1, None], "bigint")
    assert got == ["C20AD4D76FE97759AA27A0C99BFF6710", None]


def test_host(spark):
    urls = ["HTTPS://WWW.Ex\nample.com:80/x", None, "no-scheme.org/a", "http://wwwXa.com", ":/"]
    assert values(spark, text.url_host, urls, "string") == [
        "example.com", " ", "no-scheme.org", "a.com", "",
    ]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2026-07-01T05:41:39.000+0000", dt.datetime(2026, 7, 1, 5, 41, 39)),
        ("2026-07-01T05:41:39+02:00", dt.datetime(2026, 7, 1, 3, 41, 39)),
        ("2026-07-01 05:41:39", dt.datetime(2026, 7, 1, 5, 41, 39)),
        ("05:41:39", None),
        ("garbage", None),
        (None, None),
    ],
)
def test_capture(spark, given, expected):
    assert values(spark, lambda x: F.to_utc_timestamp(times.parse_capture(x), "UTC"), [given], "string") == [
        expected
    ]


def test_seconds(spark):
    assert values(spark, text.whole_seconds, [2500, 0, None, 1499, -2500], "int") == [
        3, 0, None, 1, -3,
    ]


def test_json_objects(spark):
    x = F.col("x")
    df = spark.createDataFrame([('{"a":1,"b":{"c":[1]}}',), (None,), ("broken",)], "x string")
    merged = jsons.merge_objects(x, F.lit('{"a":"new","d":null}'))
    rows = [r[0] for r in df.select(merged).collect()]
    assert rows[0] == '{"b":{"c":[1]},"a":"new","d":null}'
    assert rows[1] == rows[2] == '{"a":"new","d":null}'
    kept = df.limit(1).select(jsons.object_keep_null({"k": F.lit(None), "n": F.lit(5)})).first()[0]
    assert kept == '{"k":null,"n":"5"}'
    dropped = df.limit(1).select(jsons.object_drop_null({"k": F.lit(None).cast("int"), "n": F.lit(5)}))
    assert dropped.first()[0] == '{"n":5}'


def test_chain_skips_incomplete_elements(spark):
    chain = '[{"id":2,"index":2,"roleId":1},{"id":5,"index":1},{"id":9,"index":0,"roleId":3}]'
    assert values(spark, nested.chain_with_roles, [chain, None, "[]"], "string") == [
        "9(3),2(1)", None, "",
    ]
    assert values(spark, nested.chain_path, [chain], "string") == ["9.3|2.1"]


def test_video_guard_keeps_unknown_type(spark):
    guard = lambda mime: rules.passes_video_guard(F.lit("ctv video"), mime)
    assert values(spark, guard, ["image/gif", "video/mp4", None], "string") == [False, True, True]


def test_custom_attributes(spark):
    from sightline.plans.sync import payload, reshape_attributes

    given = '[{"fKey":1,"respValue":"r","unit":""},{"fKey":2,"gKey":9,"selectedOptValue":[1],"respValue":"x","unit":"cm"}]'
    (got,) = values(spark, reshape_attributes, [given], "string")
    assert got == (
        '[{"fKey":1,"selectedOptValue":"r","subfKey":null,"respValue":null,"unit":null},'
        '{"fKey":2,"selectedOptValue":[1],"subfKey":null,"respValue":"x","unit":"cm"}]'
    )
    ml = '{"creative_details":{"has_no_audio":true,"transcription_en":"","transcription_original":"o"}}'
    merged = values(spark, lambda x: payload(F.lit('{"z":1}'), x, F.lit("")), [ml, None], "string")
    assert merged == [
        '{"z":1,"has_no_audio":true,"transcription":"o"}',
        '{"z":1,"has_no_audio":false,"transcription":null}',
    ]
