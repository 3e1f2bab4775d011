"""Golden cases of the normalizer and scalar functions."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tessella.functions import glyphs, scalars
from tessella.operators.posts import archive_rows, last_wins, normalize, text_policy
from tessella.schemas import RAW_EVENT

RECEIVED = dt.datetime(2025, 1, 15, 12, 0, 0)
EPOCH = dt.datetime(1970, 1, 1)


def us(t):
    return int((t - EPOCH) / dt.timedelta(microseconds=1))


def iso(t):
    return t.isoformat() + "Z"


def run(spark, text="x", langs=None, created=iso(RECEIVED - dt.timedelta(seconds=5)), rkey="not-a-tid"):
    df = spark.createDataFrame([("did:a", rkey, text, langs, created, us(RECEIVED), None)], RAW_EVENT)
    return normalize(df).first()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("hello 😀 world", ["😀"]),
        ("I ❤ you", ["❤️"]),
        ("I ❤️ you", ["❤️"]),
        ("ok \U0001f44d\U0001f3fd", ["\U0001f44d\U0001f3fd"]),
        ("\U0001f468‍\U0001f469‍\U0001f467‍\U0001f466", ["\U0001f468‍\U0001f469‍\U0001f467‍\U0001f466"]),
        ("😀 and 😀", ["😀", "😀"]),
        ("just words :) <3 and 123 # *", []),
        ("flag \U0001f1e9\U0001f1ea", ["\U0001f1e9\U0001f1ea"]),
    ],
)
def test_emojis(spark, text, want):
    row = run(spark, text)
    assert row.emojis == want and row.anomalies == []


def test_cap(spark):
    row = run(spark, "😀" * 310)
    assert len(row.emojis) == 300 and row.anomalies == ["emoji-truncated"]


@pytest.mark.parametrize(("langs", "want"), [(None, ["unknown"]), ([], ["unknown"]), (["", "  "], ["unknown"]), (["en", " en ", "", "ja"], ["en", "ja"]), ([" de"], ["de"])])
def test_langs(spark, langs, want):
    assert run(spark, langs=langs).langs == want


def tid(spark, t):
    return spark.range(1).select(scalars.tid_of(F.lit(us(t)).cast("long"), 3).alias("t")).first().t


def test_created_at(spark):
    valid = RECEIVED - dt.timedelta(seconds=60)
    row = run(spark, created=iso(valid))
    assert row.created_at == valid and row.anomalies == []
    earlier = RECEIVED - dt.timedelta(seconds=30)
    for created in ("garbage", None):
        row = run(spark, created=created, rkey=tid(spark, earlier))
        assert row.created_at == earlier and row.anomalies == ["createdat-tid-fallback"]
    row = run(spark, created="garbage")
    assert row.created_at == RECEIVED and row.anomalies == ["createdat-receive-fallback"]
    slack = dt.timedelta(hours=48)
    assert run(spark, created=iso(RECEIVED + slack + dt.timedelta(seconds=60))).created_at == RECEIVED
    assert run(spark, created=iso(RECEIVED + slack - dt.timedelta(seconds=60))).anomalies == []
    assert run(spark, created="garbage", rkey=tid(spark, RECEIVED + dt.timedelta(days=10))).created_at == RECEIVED


def test_code_points(spark):
    row = spark.createDataFrame([("❤️", "1f44d 1f3fd")], "g string, p string").select(glyphs.code_points(F.col("g")).alias("p"), glyphs.from_code_points(F.col("p")).alias("g")).first()
    assert row.p == "2764 fe0f" and row.g == "\U0001f44d\U0001f3fd"


def test_digest_vector(spark):
    rows = spark.createDataFrame([("abc123",)], "k string")
    assert rows.agg(scalars.digest(F.col("k")).alias("d")).first().d == "83c870ca523da16c"
    two = spark.createDataFrame([("a",), ("b",)], "k string")
    assert two.agg(scalars.digest(F.col("k")).alias("d")).first() == two.orderBy(F.desc("k")).agg(scalars.digest(F.col("k")).alias("d")).first()


def test_ratio(spark):
    rows = spark.createDataFrame([(420050497, 2280932032), (0, 0)], "a long, b long")
    assert [r.r for r in rows.select(scalars.ratio(F.col("a"), F.col("b")).alias("r")).collect()] == ["0.1842", "N/A"]


def test_hosts_and_errors(spark):
    rows = spark.createDataFrame([("https://Pds.Example:443/x", "https://a.b:8443", "http://H.c:80", "nope")], "a string, b string, c string, d string")
    got = rows.select(*[scalars.canonical_host(F.col(c)).alias(c) for c in "abcd"]).first()
    assert tuple(got) == ("pds.example", "a.b:8443", "http://h.c", None)
    kinds = spark.createDataFrame([("x ENOTFOUND y",), ("http 451 no",), ("http 4510",), ("stalled: silent",), ("EAI_AGAIN",)], "m string")
    assert [r.k for r in kinds.select(scalars.deadness(F.col("m")).alias("k")).collect()] == ["dns", "legal", None, "stall", None]


def test_small_scalars(spark):
    row = spark.range(1).select(
        scalars.human_bytes(F.lit(1536).cast("long")).alias("b"), scalars.human_duration(F.lit(3700)).alias("d"), scalars.eta_hours(F.lit(120), F.lit(2)).alias("e"),
        scalars.flag_of(F.lit("DE")).alias("f"), scalars.flag_of(F.lit("xx")).alias("w"), scalars.strings_of_json(F.lit('["a"]')).alias("j"), scalars.strings_of_json(F.lit("{bad")).alias("n"),
        scalars.retry_delay(F.lit(10), 60, 3600).alias("r"), scalars.http_outcome(F.lit(400), F.lit("RepoNotFound")).alias("o"),
    ).first()
    assert (row.b, row.d, row.e, row.j, row.n, row.r, row.o) == ("1.5 KiB", "1h 1m", 1.0, ["a"], [], 3600.0, "failed")
    assert row.f == "\U0001f1e9\U0001f1ea" and row.w.startswith("\U0001f3f3")


def test_policy_archive_and_last_wins(spark):
    df = spark.createDataFrame([("a", "1", 1, "old"), ("a", "1", 2, "new"), ("b", "1", 1, "b")], "did string, rkey string, v long, t string")
    once = last_wins(df, ["did", "rkey"], "v")
    assert sorted(r.t for r in once.collect()) == ["b", "new"]
    assert sorted(map(tuple, last_wins(once, ["did", "rkey"], "v").collect())) == sorted(map(tuple, once.collect()))
    posts = normalize(spark.createDataFrame([("d", "r", "no glyph", None, None, us(RECEIVED), {"reply": "{}"})], RAW_EVENT))
    assert text_policy(posts).first().text == "" and text_policy(posts, "all").first().text == "no glyph"
    assert archive_rows(posts).first().reply is None


PLAIN = r"[\x{1F1E6}-\x{1F1FF}]{2}|[0-9#*]\x{FE0F}?\x{20E3}|\x{1F3F4}[\x{E0020}-\x{E007E}]+\x{E007F}|%s(?:\x{200D}%s)*"


def test_quick_looks_change_no_match(spark):
    """The pattern takes what it takes without its looks ahead: every emoji alone, and parts of emoji in any order."""
    every = glyphs._class([(0xA9, 0xA9), (0xAE, 0xAE), *[r for r in glyphs._ranges("Emoji") if r[0] > 0xFF]])
    one = rf"[{every}](?:[\x{{1F3FB}}-\x{{1F3FF}}]|\x{{FE0F}}|\x{{FE0E}})?"
    alone = "a".join(chr(c) for a, b in glyphs._ranges("Emoji") if a > 0xFF or a in (0xA9, 0xAE) for c in range(a, b + 1))
    parts, pick = "1#x é\xa9\u203c\u20e3\ufe0f\ufe0e\u200d\u2764\u3042\u4e00\U0001f1e9\U0001f1ea\U0001f3fd\U0001f3f4\U000e0067\U000e007f\U0001f469\U0001faf0", random.Random(4)
    rows = spark.createDataFrame([(alone,), *[("".join(pick.choices(parts, k=60)),) for _ in range(300)]], "t string")
    both = rows.select(glyphs.extract_emojis(F.col("t")).alias("quick"), F.regexp_extract_all("t", F.lit(PLAIN % (one, one)), 0).alias("plain")).collect()
    assert len(both[0].quick) > 1000 and all(r.quick == r.plain for r in both)


def test_plain_words_are_passed_over(spark):
    """Text without an emoji takes a part of the time that the set of all emoji takes."""
    rows, took = spark.range(1).select(F.repeat(F.lit("plain words, "), 160_000).alias("t")), {}
    for name, pattern in {"warm-up": glyphs.emoji_pattern(), "quick": glyphs.emoji_pattern(), "set": f"[{glyphs._class(glyphs._ranges('Emoji'))}]"}.items():
        begun = time.monotonic()
        assert rows.select(F.size(F.regexp_extract_all("t", F.lit(pattern), 0)).alias("n")).agg(F.sum("n")).first()[0] == 0
        took[name] = time.monotonic() - begun
    assert took["quick"] < took["set"] / 2, took
