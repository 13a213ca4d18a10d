"""Property tests: many generated cases per Spark job."""

import base64

from hypothesis import HealthCheck, given, settings, strategies as st

from applens.sources.derived import hide_text
from applens.functions import codes, payload
from applens.functions.text import java_split

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def _java_split(s, d):
    """String.split semantics for a literal delimiter (test model)."""
    if s == "":
        return [""]
    parts = s.split(d)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab;", max_size=8), min_size=50, max_size=50))
def test_java_split_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(java_split("s", ";")).collect()]
    assert got == [_java_split(v, ";") for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0xD7FF,
                                               blacklist_characters="@#$*%"),
                        min_size=1, max_size=60), min_size=30, max_size=30))
def test_obfuscation_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hidden = df.select("t", hide_text("t").alias("h"))
    for t, b in hidden.select("t", codes.deobfuscate("h")).collect():
        assert b == (t if t.strip() or t else None)


@SETTINGS
@given(st.lists(st.text(max_size=300), min_size=20, max_size=20))
def test_payload_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    enc = df.select("t", payload.encode_payload_col("t").alias("p"))
    got = enc.select("t", payload.payload_text("p").alias("b")).collect()
    for t, b in got:
        assert b == t


def test_payload_has_no_central_directory():
    raw = base64.b64decode(payload.encode_payload("x" * 1000).replace("*", "/"))
    assert raw.startswith(b"PK\x03\x04") and b"PK\x05\x06" not in raw
