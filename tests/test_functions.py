"""Golden rows for the column functions (edge cases from FIXTURES.md)."""

import base64
import random
import zlib

import pytest
from pyspark.sql import functions as F

from applens.functions import codes, dates, payload, querystring as qs, tokens
from applens.functions.text import blank_to_space, first_nonblank_id, is_not_blank, java_split
from conftest import rows


def one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("value,expected", [
    ("a;b;;", ["a", "b"]), (";;", []), ("", [""]), (None, None), ("a;;b", ["a", "", "b"]),
    (";a", ["", "a"]), ("a;\n", ["a", "\n"]),
])
def test_java_split(spark, value, expected):
    assert one(spark, java_split("s", ";"), value) == expected


def test_blank_rules(spark):
    df = spark.createDataFrame([(" ",), ("",), (None,), ("\t",), ("x",)], "s string")
    got = rows(df.select(is_not_blank("s"), blank_to_space("s")))
    assert got == [(False, " "), (False, " "), (False, " "), (False, " "), (True, "x")]


def test_first_nonblank_id(spark):
    df = spark.createDataFrame(
        [(" ", "", "c"), (None, " ", "c"), (" ", " ", " "), ("a", "b", "c"), (None, None, None)],
        "a string, b string, c string")
    assert [r[0] for r in rows(df.select(first_nonblank_id("a", "b", "c")))] == ["", "c", None, "a", None]


def test_url_decode_gbk(spark):
    cases = [("model=%C4%E3%BA%C3+x", "model=你好 x"), ("a%26b", "a&b"), ("%2B", "+"),
             ("bad%zz", None), ("trail%4", None), ("plain", "plain")]
    df = spark.createDataFrame(cases, "s string, e string")
    for got, exp in rows(df.select(qs.url_decode("s", "GBK"), "e")):
        assert got == exp


def test_query_string_map_and_values(spark):
    cases = ["XX=&YY=c", "XX", "a=b=c", "k=1&k=2", "a=1&&b=2", "model=x&", "k=1&j=0&k="]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in rows(df.select(qs.qs_map("s")))]
    assert got == [{"XX": "", "YY": "c"}, {"XX": ""}, {"a": "b"}, {"k": "2"}, {"a": "1", "b": "2"}, {"model": "x"},
                   {"j": "0", "k": ""}]
    assert [r[0] for r in rows(df.select(qs.qs_value("s", "k")))] == ["", "", "", "2", "", "", ""]
    assert rows(df.select(qs.qs_invalid("s")))[0][0] is False

def test_noise_filter(spark):
    df = spark.createDataFrame([("ECONOMY ERR", "OR#5"), ("A", "B"), ("", "B"), ("x adb", "y"),
                                ("WARN", "ING"), ("M", " ")], "m string, b string")
    assert [r[0] for r in rows(df.select(qs.is_noise("m", "b")))] == [True, False, True, True, True, True]


def test_epoch_helpers(spark):
    df = spark.createDataFrame([("1600000000.250",), ("12a",), ("",), ("-5.0",), ("123\n",)], "s string")
    ms = dates.parse_sec_millis("s")
    got = rows(df.select(ms, dates.format_epoch_ms(ms), dates.date_route(ms)))
    assert got[0] == (1600000000250, "2020-09-13 12:26:40", "2020/09/13/")
    assert got[1] == (None, None, None) and got[2] == (None, None, None) and got[4][0] is None
    assert got[3][0] == -50
    shanghai = one(spark, dates.format_epoch_ms(F.lit(1600000000250), zone="Asia/Shanghai"), "x")
    assert shanghai == "2020-09-13 20:26:40"


def test_month_helpers(spark):
    df = spark.createDataFrame([("201612",), ("202402",), ("201713",), ("2017",)], "m string")
    got = rows(df.select(dates.add_month("m"), F.size(dates.month_days("m"))))
    assert got == [("201701", 31), ("202403", 29), (None, None), (None, None)]


@pytest.mark.parametrize("apps,pt,expected", [
    ("com.a.b.AB12CD34", "1", "AB12CD34,com.a.b"),
    ("com.a.12ab;com.b.123456789", "1", "000012ab,com.a;123456789,com.b"),
    ("com.demo_lab.f3.store_A1B2C3D4.5e6f7a8b.1", "2", "5e6f7a8b,com.demo_lab.f3.store"),
    ("com.q.AB12CD34", "2", "AB12CD34,com.q"),
    ("com.d&Demo Service.00000000.1a2b3c4d.0;com.i&i 工具.00000000.9f8e7d6c.0;", "3",
     "1a2b3c4d,com.d,Demo Service;9f8e7d6c,com.i,i 工具"),
    ("x.y.abc", "7", "00000abc,x.y"),
    ("x.y.abc", None, "00000abc,x.y"),
    ("com.a.1;broken;com.b.2", "1", "00000001,com.a"),
    ("broken;com.b.2", "1", ""),
    ("noamp.1.2.3", "3", ""),
    ("com.x_1", "2", "00000x_1,com"),
    ("com.x.1", "2", ""),
])
def test_app_tokens(spark, apps, pt, expected):
    df = spark.createDataFrame([(apps, pt)], "a string, p string")
    assert df.select(tokens.format_app_list(tokens.parse_app_list("a", "p"))).first()[0] == expected


def test_app_tokens_null_list(spark):
    df = spark.createDataFrame([(None, "1")], "a string, p string")
    assert df.select(tokens.parse_app_list("a", "p")).first()[0] is None


@pytest.mark.parametrize("crc,expected", [("12ab", "000012ab"), ("AB12CD34", "AB12CD34"),
                                          ("123456789", "123456789"), ("", "00000000")])
def test_crc_pad(spark, crc, expected):
    assert one(spark, tokens.crc_pad("s"), crc) == expected


def test_geo(spark):
    df = spark.createDataFrame([(125298329043863230,), (None,), (0,), (12529832904386323,)], "g bigint")
    got = rows(df.select(codes.geo_longitude("g"), codes.geo_latitude("g")))
    assert got == [(125.298329, 43.86323), (0.0, 0.0), (0.0, 0.0), (12.529832, 904.386323)]


def _java_hash(s):
    h = 0
    for ch in s:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_java_hash(spark):
    words = ["hello", "", "com.example.app", "工具", "a" * 40, "Zz9-_."]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    assert [r[0] for r in rows(df.select(codes.java_string_hash("s")))] == [_java_hash(w) for w in words]


def _py_obfuscate(text):
    plain = "".join("n" + format(ord(c), "x") for c in text)
    w = max(len(plain) % 7, 3)
    return "".join(plain[i:i + w][::-1] for i in range(0, len(plain), w))


def test_deobfuscate_round_trip(spark):
    texts = ["com.a.b;com.c", "x", "a" * 50, "包名.应用;x", "12,34;56"]
    df = spark.createDataFrame([(t, _py_obfuscate(t.replace(".", "@").replace(";", "*"))) for t in texts],
                               "t string, o string")
    for t, a in rows(df.select("t", codes.deobfuscate("o"))):
        assert a == t


def test_fixture_encoder_agrees_with_the_tests_own(spark):
    from applens.sources.derived import hide_text
    texts = ["com.a.b;com.c", "x", "a" * 50, "包名😀", "12,34;56\u0001", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    utf16 = lambda t: [int.from_bytes(t.encode("utf-16-be")[i:i + 2], "big") for i in range(0, 2 * len(t.encode("utf-16-be")) // 2, 2)]
    for t, h, back in rows(df.select("t", hide_text("t"), codes.deobfuscate(hide_text("t")))):
        plain = "".join(f"n{u:x}" for u in utf16(t))
        w = max(len(plain) % 7, 3)
        assert h == "".join(plain[i:i + w][::-1] for i in range(0, len(plain), w))
        assert back == (t or None)


def test_lone_surrogates_do_not_abort(spark):
    def hide(units):
        w = max(len(units) % 7, 3)
        return "".join(units[i:i + w][::-1] for i in range(0, len(units), w))
    cases = [("nd800", "\ufffd"), ("n61ndc00n62", "a\ufffdb"), ("nd83dnde00", "😀"), ("nd83dnd83dnde00n63", "\ufffd😀c")]
    df = spark.createDataFrame([(hide(u), e) for u, e in cases], "o string, e string")
    for got, want in rows(df.select(codes.deobfuscate("o"), "e")):
        assert got == want


def test_split_keeps_control_characters(spark):
    from applens.functions.text import java_split
    df = spark.createDataFrame([("a;\u0002;b;;",), (";;",), ("",), (None,), ("\u0002",)], "s string")
    assert [r[0] for r in rows(df.select(java_split("s", ";")))] == [["a", "\u0002", "b"], [], [""], None, ["\u0002"]]


def test_times_that_are_no_dates_become_null(spark):
    cases = [("9223372036854775.807", None), ("1600000000.250", "2020/09/13/"), ("-62135596800.000", None), ("253402300799.999", None),
             ("-9223372036854775.808", None)]
    df = spark.createDataFrame(cases, "s string, e string")
    for got, want in rows(df.select(dates.date_route(dates.parse_sec_millis("s"), "Asia/Shanghai"), "e")):
        assert got == want
    late = spark.createDataFrame([(2 ** 62,), (1_600_000_000_250,)], "ms long")
    assert [r[0] for r in rows(late.select(dates.date_route("ms")))] == [None, "2020/09/13/"]


def test_base64_of_both_alphabets(spark):
    texts = [f"body {i} " * i for i in range(40)]
    sent = [(payload.encode_payload(t).replace("*", "/").replace("+", "-").replace("/", "_"),) for t in texts]
    df = spark.createDataFrame(sent, "p string").coalesce(1)
    assert [r[0] for r in rows(df.select(payload.unzip_payload("p")))] == texts


def test_java_hash_beyond_the_basic_plane(spark):
    df = spark.createDataFrame([("😀",), ("a😀b",)], "s string")
    def h(t):
        v = 0
        raw = t.encode("utf-16-be")
        for i in range(0, len(raw), 2):
            v = (v * 31 + raw[i] * 256 + raw[i + 1]) % 2 ** 32
        return v - 2 ** 32 if v >= 2 ** 31 else v
    assert [r[0] for r in rows(df.select(codes.java_string_hash("s")))] == [h("😀"), h("a😀b")]


def test_long_app_lists_stay_linear(spark):
    import time
    from applens.functions import tokens
    lists = [(";".join(f"com.app{i}.{i:x}" for i in range(1000)),)] * 300 + [("com.a.1;broken;com.b.2",), ("broken",), (None,), ("com.a.1;;",)]
    df = spark.createDataFrame(lists, "s string").repartition(4).cache()
    df.count()
    plain = df.select(F.transform(F.split("s", ";"), lambda t: tokens.parse_app_token(t, F.lit("1"))).alias("p"))
    full = df.select(tokens.parse_app_list("s", F.lit("1")).alias("p"))
    took = []
    for d in (plain, full, plain, full):
        t = time.perf_counter()
        d.write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - t)
    assert took[3] < 4 * took[2] + 1
    got = {r["s"]: r["p"] for r in df.select("s", tokens.parse_app_list("s", F.lit("1")).alias("p")).collect()}
    assert len(got[lists[0][0]]) == 1000 and [e["pkg"] for e in got["com.a.1;broken;com.b.2"]] == ["com.a"]
    assert got["broken"] == [] and got[None] is None and len(got["com.a.1;;"]) == 1


def test_deobfuscate_bad_and_blank(spark):
    df = spark.createDataFrame([("  ",), (None,), (_py_obfuscate("ab") + "nzz",)], "o string")
    assert [r[0] for r in rows(df.select(codes.deobfuscate("o")))] == [None, None, None]


def test_payload_round_trip_and_errors(spark):
    body = "111111111111111-222222222222222&acme&x1|com.x&0badf00d&1,2;"
    enc = payload.encode_payload(body)
    raw = base64.b64decode(enc.replace("*", "/"))
    assert raw[:4] == b"PK\x03\x04" and b"PK\x01\x02" not in raw   # no central directory
    damaged = base64.b64encode(raw[:40]).decode()      # stream cut before its last block
    df = spark.createDataFrame([(enc,), ("bm90IGEgemlw",), (None,), (damaged,), (enc.rstrip("="),)], "p string")
    got = [r[0] for r in rows(df.select(payload.payload_text("p")))]
    assert got[0] == body and got[1] == "" and got[2] is None and got[3] is None and got[4] == body


def test_unzip_large_entry(spark):
    text = ";".join(f"com.app{i}&{i:08x}&{1600000000000 + i}" for i in range(5000))
    assert one(spark, payload.payload_text("s"), payload.encode_payload(text)) == text
    assert zlib.crc32(b"") == 0


def _unzipped_by_hand(text):
    """What a payload holds, read byte by byte."""
    if text is None:
        return None
    clean = "".join(c for c in text.translate(str.maketrans("*-_", "/+/")) if c.isascii() and (c.isalnum() or c in "+/"))
    clean = clean[:-1] if len(clean) % 4 == 1 else clean
    data = base64.b64decode(clean + "=" * (-len(clean) % 4))
    if len(data) < 30 or data[:4] != b"PK\x03\x04":
        return ""
    number = lambda at, width: int.from_bytes(data[at:at + width], "little")
    start = 30 + number(26, 2) + number(28, 2)
    if number(8, 2) == 0:
        return data[start:start + number(18, 4)].decode("utf-8", errors="replace")
    inflater = zlib.decompressobj(-15)
    try:
        body = inflater.decompress(data[start:]) + inflater.flush()
    except zlib.error:
        return None
    return body.decode("utf-8", errors="replace") if inflater.eof else None


def test_payloads_of_all_kinds_against_reading_them_by_hand(spark):
    rng = random.Random(5)
    sent = [None, "", "=", "A", "AB", "ABC", "PK", base64.b64encode(b"PK\x03\x04" + bytes(26)).decode()]
    for i in range(400):
        text = "".join(rng.choice("ab;&|é漢😀 ") for _ in range(rng.randrange(60)))
        raw = bytearray(payload.zip_entry_without_directory(text, "name" * rng.randrange(3)))
        if i % 5 == 0:                                    # stored, of its own size or another
            body = text.encode() if i % 2 else bytes(rng.randrange(256) for _ in range(20))
            raw = bytearray(raw[:30] + body + b"tail")
            raw[8:10], raw[18:22], raw[26:30] = b"\0\0", rng.choice([0, 5, len(body), 2 ** 32 - 1]).to_bytes(4, "little"), bytes(4)
        for _ in range(rng.choice([0, 0, 1, 4])):         # damaged here and there
            raw[rng.randrange(len(raw))] = rng.randrange(256)
        line = base64.b64encode(bytes(raw[:rng.choice([len(raw), len(raw), 29, 40, len(raw) - 3])])).decode()
        line = line.replace("/", rng.choice("*/_")).replace("+", rng.choice("+-"))
        at = rng.randrange(len(line) + 1)
        sent.append(rng.choice([line, line.rstrip("="), line[:at] + rng.choice(["\n", " ", "é", "%"]) + line[at:], line[:-1]]))
    df = spark.createDataFrame([(i, p) for i, p in enumerate(sent)], "i int, p string").repartition(3)
    got = dict(rows(df.select("i", payload.payload_text("p"))))
    want = [_unzipped_by_hand(p) for p in sent]
    assert got == dict(enumerate(want))
    assert sum(w is None for w in want) > 20 and sum(bool(w) for w in want) > 100
