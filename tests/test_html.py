"""Selection of elements: nested, void, unclosed, quoted in any way."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assayframe.functions import html
from assayframe.functions.html import Rule

PAGE = """<!doctype html><html><body class=page><!-- <div class="card">no</div> -->
<div id='a' class="card big">one <div class=card>two <b>three</b></div> four<br>five</div>
<DIV data-x="1 > 0" class='x card' >six &amp; seven<img src=i.png alt='a "b"'/> </DIV>
<ul><li>l1<li>l2 <ul><li>inner</ul><li>l3</ul><p>p1<p>p2<div>p ends</div>
<script>document.write("<div class='card'>no</div>")</script><style>.card{}</style>
<table><tr><td>c1<td>c2<tr><td><table><tr><td>deep</table></table></span>
<div class="card">open <i>to the end"""


@pytest.mark.parametrize(("rule", "want"), [
    (Rule("div", "class", "card"), ["one two three four five", "two three", "six & seven", "open to the end"]),
    (Rule("div", "class", "card", within=Rule("div", "id", "a")), ["two three"]),
    (Rule(attribute="data-x"), ["six & seven"]),
    (Rule("li"), ["l1", "l2 inner", "inner", "l3"]),
    (Rule("p"), ["p1", "p2"]),
    (Rule("td"), ["c1", "c2", "deep", "deep"]),
    (Rule("img", "alt", 'a "b"'), [""]),
    (Rule("b", within=Rule("div", "class", "card", within=Rule("div"))), ["three"]),
    (Rule("span"), []),
    (Rule("div", "class", "car"), []),
])
def test_rules(rule, want):
    assert [" ".join(x["text"].split()) for x in html.elements_of(PAGE.replace("four<br>five", "four <br>five"), rule)] == want


def test_in_spark(spark):
    df = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<a href=x>l</a><a>m</a><a HREF='y'>")], "i int, h string")
    got = {r.i: (r.l, r.n) for r in df.select("i", html.attribute(F.col("h"), Rule("a"), "href").alias("l"), F.size(html.elements(F.col("h"), Rule("div"))).alias("n")).collect()}
    assert got[4] == (["x", "y"], 0) and got[2] == ([], 0) and got[3][0] is None and got[1][1] == 5


def test_deep_nesting():
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert [x["text"] for x in html.elements_of(deep, Rule("b"))] == []


def test_only_whole_references_are_references():
    page = "<a href='/x?a=1&copy=2&amp;b=3'>cut &amp;&amp; &amp</a><a>&lt;i&gt; &#65;&#x42; &notit; &nosuch; R&D &amp;lt; &</a>"
    got = html.elements_of(page, Rule("a"))
    assert [x["text"] for x in got] == ["cut && &amp", "<i> AB &notit; &nosuch; R&D &lt; &"]
    assert got[0]["attributes"] == {"href": "/x?a=1&copy=2&b=3"}
