"""Character references against the standard library's decoding."""

import html
import os
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from boardtide.functions import text
from boardtide.functions.entities import unescape

SF = "/root/testdata/sf0.01"


def same(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescape("t").alias("u")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.u == (None if r.t is None else html.unescape(r.t)), r.t


def test_names_and_numbers(spark):
    texts = [None, "", "&", "&&", "a & b", "&amp;lt;", "&notit; &notin; &not &no", "&ampx;&AMP&Amp;", "&lt=1;", "&#", "&#;",
             "&#x;", "&#xg", "&unknown; &amp", "&" + "a" * 40 + ";", "&CounterClockwiseContourIntegral;", "&#0;&#00065&#x000041;",
             "&#99999999999999999999;&#xFFFFFFFFFFFF;&#1114111;&#1114112;", "&acE;&NotEqualTilde;", "&#65;&#x1F600;&#65279;x",
             "&amp;#65;", "x&#128;&#x9f;&#129;&#13;", "&ltx &gt", "&é; &lt;é"]
    texts += [f"&#{n};" for n in [*range(0, 300), 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF,
                                   0x1FFFE, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000]]
    texts += [f"a&{n}b" for n in html5]
    same(spark, texts)


def test_random_texts(spark):
    rng = random.Random(8)
    names = sorted(html5)
    bits = ["&", "#", "x", "X", ";", " ", "<", "1", "65", "0", "f", "amp", "lt", "not", "\t", "é"]
    same(spark, ["".join("&" + rng.choice(names)[:rng.randint(1, 9)] if rng.random() < 0.3 else rng.choice(bits)
                         for _ in range(rng.randint(1, 14))) for _ in range(4000)])


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the generic tables")
def test_whole_pages_without_python(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("html", unescape("html").alias("u"))
    for r in pages.collect():
        assert r.u == (None if r.html is None else html.unescape(r.html))
    plan = pages.select(text.tag_text("html"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "from_json" not in plan
    assert spark.range(1).select(text.tag_text(F.lit("<p>a &amp;  b</p>")).alias("t")).first().t == "a & b"
