"""Column expressions against plain Python on generated and hand-picked values."""

import json
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from packetlens.functions import address, envelope, info, numbers
from packetlens.functions.packet import parse_packets
from packetlens.functions.text import WHITESPACE, strip, tokens
from packetlens.operators import names

FEW = settings(max_examples=15, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def evaluate(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).strip() == ""}


@FEW
@given(st.lists(st.text(alphabet="ab .\t\n\xa0　", max_size=8), min_size=1, max_size=30))
def test_strip(spark, texts):
    assert evaluate(spark, texts, strip) == [t.strip() for t in texts]


WORDS = st.sampled_from(
    ["Standard", "query", "response", "CNAME", "NS", "A", "0x1a2b", "", "www.a.b.com", "com.",
     "localhost", "<Root>", "a..b", ".", "Inverse", "DNS", "MCNAME", "NSX"]
)
TEXTS = st.lists(st.lists(WORDS, min_size=1, max_size=9).map(" ".join), min_size=1, max_size=40)


def last_labels(text):
    labels = text.split(" ")[-1].strip().split(".")
    return ".".join(labels[-2:])


def records(text):
    words = text.split(" ")
    return [(w, n) for w, n in zip(words, words[1:]) if w in ("CNAME", "NS")]


@FEW
@given(TEXTS)
def test_domain(spark, texts):
    got = evaluate(spark, texts, lambda x: info.query_domain(tokens(x)))
    assert got == [last_labels(t) for t in texts]


@FEW
@given(TEXTS)
def test_records(spark, texts):
    texts = [f"Standard query response {t}" for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, info string")
    got = [(r.i, r.type, r.request_response) for r in names.name_records(df, "i").collect()]
    want = [(i, *r) for i, t in enumerate(texts) for r in records(t.strip())]
    assert sorted(got) == sorted(want)


@FEW
@given(TEXTS)
def test_words(spark, texts):
    assert evaluate(spark, texts, info.verb) == [t.split(" ")[0] for t in texts]
    assert evaluate(spark, texts, info.two_words) == [" ".join(t.split(" ")[:2]) for t in texts]


def test_direction(spark):
    cases = {
        "Standard query 0x1 A x": True,
        "Standard query response 0x1": False,
        "Inverse query 0x1": True,
        "DNS Stateful operations (DSO) response": False,
        "DNS Stateful operations (DSO) 0x1": True,
        "Standard query": None,
        "DNS a b c": None,
        "Dynamic update 0x1": None,
        "Malformed": None,
        "": None,
    }
    assert evaluate(spark, cases, lambda x: info.is_query(tokens(x))) == list(cases.values())


def test_category_takes_the_first_match(spark):
    cases = {
        "google.com": "search",
        "amazonaws.com": "tech",
        "amazon.com": "e-commerce",
        "googlecloud.com": "search",
        "fbcdn.net": "cdn",
        "akamai.net": "cdn",
        "example.org": "other",
        "": "other",
    }
    assert evaluate(spark, cases, info.category) == list(cases.values())


def octets(a):
    return [int(o) for o in a.split(".")]


def test_address_order(spark):
    rng = random.Random(7)
    v4 = [".".join(str(rng.choice([0, 1, 2, 9, 10, 99, 100, 255])) for _ in range(4))
          for _ in range(200)]
    pairs = list(zip(v4, v4[1:]))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = df.orderBy("i").select(address.precedes(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [octets(a) < octets(b) for a, b in pairs]
    other = spark.createDataFrame([("fe80::1", "fe80::2"), ("10.0.0.1", "fe80::1")], "a string, b string")
    assert [r[0] for r in other.select(address.precedes(F.col("a"), F.col("b"))).collect()] == [True, True]


@FEW
@given(st.lists(st.tuples(st.integers(0, 10**7), st.integers(1, 2000)), min_size=1, max_size=60))
def test_two_decimals(spark, fractions):
    values = [a / b for a, b in fractions] + [2.675, 0.125, 0.375, 1234567.005]
    got = evaluate(spark, values, numbers.two_decimals, "double")
    assert got == [float(f"{v:.2f}") for v in values]


def test_envelopes(spark):
    lines = ["1.1.1.1,2.2.2.2,DNS,60,Standard query", 'a,b,MDNS,1,"x, ""QM"" y"', "", "tab\there é"]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(lines)], "i int, m string").orderBy("i")
    archived = [r[0] for r in df.select(envelope.to_archive(F.col("m"))).collect()]
    assert [json.loads(a) for a in archived] == [{"message": m} for m in lines]
    assert evaluate(spark, archived, envelope.archive_message) == lines
    assert evaluate(spark, archived, envelope.sliced_message) == [a[12:-2] for a in archived]
    streamed = [r[0] for r in df.select(envelope.to_stream(F.col("m"))).collect()]
    assert evaluate(spark, streamed, envelope.stream_message) == lines
    assert evaluate(spark, ["no json", "{}"], envelope.archive_message) == [None, None]


def test_parse_keeps_going_on_bad_lines(spark):
    cases = {
        "1.1.1.1,2.2.2.2,DNS,60,Malformed": ("1.1.1.1", "2.2.2.2", "DNS", 60, "Malformed"),
        "1.1.1.1,2.2.2.2,DNS,abc,x": ("1.1.1.1", "2.2.2.2", "DNS", None, "x"),
        "1.1.1.1,2.2.2.2": ("1.1.1.1", "2.2.2.2", None, None, None),
        "": ("", None, None, None, None),
        " 1.1.1.1,2.2.2.2,DNS, 60 ,a b\t ": ("1.1.1.1", "2.2.2.2", "DNS", 60, "a b"),
        '1.1.1.1,2.2.2.2,MDNS,70,"a, ""QM"" b"': ("1.1.1.1", "2.2.2.2", "MDNS", 70, '"a'),
    }
    df = spark.createDataFrame([(i, m) for i, m in enumerate(cases)], "i int, message string")
    rows = parse_packets(df).orderBy("i").collect()
    assert [(r.src, r.dst, r.protocol, r.length, r.info) for r in rows] == list(cases.values())
