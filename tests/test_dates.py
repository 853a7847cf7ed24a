import pytest
from pyspark.sql import functions as F

from newslake.functions import dates
from newslake.schema import NO_DATE

CASES = [
    ("D1", "2024-01-02T03:04:05+07:00", "2024-01-01 20:04:05"),
    ("D1", "2024-01-02T03:04:05-0330", "2024-01-02 06:34:05"),
    ("D1", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
    ("D1", "2024-01-02T03:04:05", None),
    ("D1", "2023-02-30T03:04:05Z", None),
    ("D2", "2024-01-02T03:04:05+07:00", "2024-01-02 03:04:05"),
    ("D2", "2024-01-02T03:04:05", None),
    ("D3", "2024-01-02T03:04:05-05:00", "2024-01-02 08:04:05"),
    ("D3", "2024-01-02", "2024-01-02 00:00:00"),
    ("D3", "2024", None),
    ("D4", "2024-01-02T03:04:05-05:00", "2024-01-02 03:04:05"),
    ("D4", "2024-01-02T03:04:05.250-05:00", "2024-01-02 03:04:05"),
    ("D4", "2024-01-02", "2024-01-02 00:00:00"),
    ("D5", "2024-01-02T03:04:05.123Z", "2024-01-02 03:04:05"),
    ("D5", "2024-01-02T03:04:05Z", None),
    ("D6", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
    ("D7", "2024-01-02T03:04:05", "2024-01-02 03:04:05"),
    ("D8", "Published Jan 2, 2024, 3:04 p.m. UTC", "2024-01-02 15:04:00"),
    ("D8", "Jan 2, 2024, 3:04 a.m.", "2024-01-02 03:04:00"),
    ("D9", "Jan. 2, 2024 3:04 pm UTC", "2024-01-02 15:04:00"),
    ("D9", "Published Jan. 2, 2024 at 3:04 PM UTC", "2024-01-02 15:04:00"),
    ("D10", "Jan 2, 2024 15:04 UTC", "2024-01-02 15:04:00"),
    ("D10", "Jan 2, 2024 15:04 PST", None),
    ("D11a", "Jan 02, 2024", "2024-01-02 00:00:00"),
    ("D11b", "January 2, 2024", "2024-01-02 00:00:00"),
    ("D11b", "Jan 2, 2024", None),
    ("D11c", "· 1/2/24", "2024-01-02 00:00:00"),
    ("D11c", "1/2/68", "2068-01-02 00:00:00"),
    ("D11c", "1/2/69", "1969-01-02 00:00:00"),
    ("D12", "Jan 2, 2024 - 15:04", "2024-01-02 15:04:00"),
    ("D13", "Jan 2, 2024, 3:04PM EST • 4 min", "2024-01-02 20:04:00"),
    ("D13", "Jan 2, 2024, 3:04PM EDT", "2024-01-02 19:04:00"),
    ("D13", "Jan 2, 2024, 3:04PM UTC", "2024-01-02 15:04:00"),
    ("D13", "Jan 2, 2024, 3:04PM PST", NO_DATE),
    ("D13", "garbage", NO_DATE),
    ("D14", "2024-01-02", "2024-01-02 00:00:00"),
    ("D14", None, "None 00:00:00"),
    ("D15", "1704164645", "2024-01-02 03:04:05"),
] + [(n, "garbage", None) for n in dates.NOTATIONS if n not in ("D13", "D14")]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, notation, raw) for i, (notation, raw, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, notation string, raw string")
    for policy in ("wall", "utc"):
        df = df.withColumn(policy, dates.parse_by_notation(F.col("raw"), F.col("notation"), tz_policy=policy))
    return {row.i: row for row in df.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_notation(parsed, i):
    assert parsed[i].wall == CASES[i][2], CASES[i]


def test_tz_policy_utc_converts_ignored_offsets(parsed):
    by_case = {CASES[i][:2]: row.utc for i, row in parsed.items()}
    assert by_case["D2", "2024-01-02T03:04:05+07:00"] == "2024-01-01 20:04:05"
    assert by_case["D4", "2024-01-02T03:04:05-05:00"] == "2024-01-02 08:04:05"


def test_unknown_policy():
    with pytest.raises(ValueError):
        dates.parse_published_at(None, "D1", "local")


def test_publish_date(spark):
    cases = [
        ("2024-01-01 00:00:00", 1704067200), ("2024-1-1 0:0:5", 1704067205), (NO_DATE, None), ("bad", None),
        ("None 00:00:00", None), (None, None), ("2024-02-30 00:00:00", None), ("2024-01-01 00:00:00 ", None),
        ("1970-01-01  00:00:00", 0), ("1969-12-31 23:59:59", -1),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, p string")
    got = {r.i: r.out for r in df.select("i", dates.finalize_published_at(F.col("p")).alias("out")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1] for c in cases]
