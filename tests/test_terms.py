from urllib.parse import quote

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ldspark.functions import encode_part, ntriples_line, resolve_iri


def one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "x STRING")
    return df.select(expr(F.col("x"))).first()[0]


def test_encoding_follows_rfc_3986(spark):
    assert one(spark, encode_part, "a b/c") == "a%20b%2Fc"
    assert one(spark, encode_part, "1+1*2~x") == "1%2B1%2A2~x"
    assert one(spark, encode_part, "é😀") == "%C3%A9%F0%9F%98%80"
    assert one(spark, encode_part, None) is None


def test_absolute_subjects_keep_their_base(spark):
    def resolve(c):
        return resolve_iri(c, "http://b.example/")

    assert one(spark, resolve, "https://x.example/1") == "https://x.example/1"
    assert one(spark, resolve, "urn:x:1") == "urn:x:1"
    assert one(spark, resolve, "x/1") == "http://b.example/x/1"


def test_ntriples_escapes(spark):
    df = spark.createDataFrame(
        [
            ("u:1", "u:p", 'a"b\\c\nd\te\r 😀', "literal"),
            ("u:1", "u:p", "u:a b<c>", "iri"),
            ("u:1", "u:t", "u:C", "type"),
        ],
        "s STRING, p STRING, o STRING, kind STRING",
    )
    lines = [r[0] for r in df.select(ntriples_line(*[F.col(c) for c in df.columns])).collect()]
    assert lines == [
        '<u:1> <u:p> "a\\"b\\\\c\\nd\\te\\r 😀" .',
        "<u:1> <u:p> <u:a\\u0020b\\u003Cc\\u003E> .",
        "<u:1> <u:t> <u:C> .",
    ]


texts = st.lists(
    st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=20),
    min_size=30,
    max_size=60,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_any_text_is_encoded_like_the_standard_library_does(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x STRING")
    got = [r[0] for r in df.select(encode_part(F.col("x"))).collect()]
    assert got == [quote(v, safe="") for v in values]
