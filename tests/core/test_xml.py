"""Values of XML texts by path: equal to those of each text parsed alone; texts with the same tags are parsed once."""

import xml.etree.ElementTree as ET

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landweave.functions import xml as X
from landweave.plans import queries as Q
from landweave.plans import stores as _stores  # noqa: F401
from landweave.plans import workflows as _workflows  # noqa: F401

PATHS = ["g/a", "g/p[@at='UL']/@x", "g/p[@at='LR']/@x", "b/c[@name='r']/f"]
PLAIN = '<s><g><a>{}</a><p at="UL" x="{}"/><p at="LR" x="{}"/></g><b><c name="q"><f>n</f></c><c name="r"><f>{}</f></c></b></s>'
ODD = [
    PLAIN.format(1, 2, 3, "f.tif"), PLAIN.format(" 1 ", " 2", "", ""), PLAIN.format("\n", "2\n3", "é", "ü "), PLAIN.format("a&amp;b", "&lt;", "&#65;", "&quot;"), PLAIN.format("a&b", 1, 1, 1),
    PLAIN.format("a<!-- c -->b", 1, 1, "<![CDATA[x<y]]>"), PLAIN.format("]]>", 1, 1, 1), PLAIN.format("a>b", "c>d", 1, 1), PLAIN.format("\x01", 1, 1, 1), PLAIN.format(1, "a<b", 1, 1), PLAIN.format(1, '2" x="3', 1, 1),
    PLAIN.format(1, '2" x = "3', 1, 1), PLAIN.format(1, 2, 3, 4).replace("at=\"UL\" x=", "at=\"UL\" x = "), PLAIN.format(1, 2, 3, 4).replace('at="UL" x="2"', "at='UL' y=' x=\"9\"' x='2'"), PLAIN.format(1, 2, 3, 4).replace("<a>", "<a/><a>"),
    '<?xml version="1.0" encoding="ISO-8859-1"?>\n' + PLAIN.format(1, 2, 3, 4) + "\n", '<?xml version="1.0"?>x' + PLAIN.format(1, 2, 3, 4), PLAIN.format(1, 2, 3, 4) + "x", PLAIN.format(1, 2, 3, 4) + "<s/>", " " + PLAIN.format(1, 2, 3, 4),
    PLAIN.format(1, 2, 3, 4).replace("<s>", '<n:s xmlns:n="u" xmlns="v">').replace("</s>", "</n:s>"), PLAIN.format(1, 2, 3, 4).replace("s>", "n:s>"), PLAIN.format(1, 2, 3, 4).replace("</a>", "</A>"), PLAIN.format(1, 2, 3, 4)[:-1], PLAIN.format(1, 2, 3, 4)[:-4],
    "<s/>", "<s>", "", " ", "x", "<", ">", "<>", "<s></s>", "<!DOCTYPE s [<!ENTITY e 'v'>]>" + PLAIN.format("&e;", 2, 3, 4), "<s><g><a>1</a></g><g><a>2</a><p at='UL'/></g></s>", "<s><g><a><i>1</i></a><p/><p at=\"UL\"/></g></s>\r\n",
]


def alone(text):
    try:
        root = ET.fromstring(text.decode("utf-8", "replace"))
    except ET.ParseError:
        return None
    out = []
    for path in PATHS:
        path, _, attribute = path.partition("/@")
        e = root.find("/".join("{*}" + s for s in path.split("/")))
        value = None if e is None else e.get(attribute) if attribute else e.text or ""
        out.append(value and value.strip(" \t\r\n"))
    return out


def test_values_are_those_of_each_text_alone():
    texts = [t.encode() for t in ODD] + [PLAIN.format("\xff", 1, 2, 3).encode("latin-1"), b"<s>\x00</s>"]
    want = [alone(t) for t in texts]
    assert sum(w is None for w in want) > 10 and sum(w is not None for w in want) > 15
    for order in (slice(None), slice(None, None, -1)):  # whichever of texts with the same tags is parsed
        given = [t for t in texts[order] for _ in (0, 1)] + [None]
        columns, whole = X._values(pa.array(given, pa.binary()).slice(1), PATHS)
        rows = [list(r) if w else None for r, w in zip(zip(*[c.to_pylist() for c in columns]), whole)]
        assert rows == [w for w in want[order] for _ in (0, 1)][1:] + [None]
    columns, whole = X._values(pa.array([], pa.string()), PATHS)
    assert [len(c) for c in columns] == [0] * len(PATHS) and len(whole) == 0


def test_texts_with_the_same_tags_are_parsed_once(monkeypatch):
    parsed, root = [], X._root
    monkeypatch.setattr(X, "_root", lambda text: parsed.append(text) or root(text))
    texts = [PLAIN.format(i, -i, i / 2, f"f{i}.tif") for i in range(1000)]
    columns, whole = X._values(pa.array(texts), PATHS)
    assert whole.all() and len(parsed) == 1
    assert list(zip(*[c.to_pylist() for c in columns])) == [(str(i), str(-i), str(i / 2), f"f{i}.tif") for i in range(1000)]


def test_values_in_spark(spark):
    df = spark.createDataFrame([(1, PLAIN.format(1, 2, 3, 4)), (2, "<s"), (3, None)], "id int, content string")
    rows = {r.id: r.v for r in df.select("id", X.xml_values(F.col("content"), dict(zip("abcd", PATHS))).alias("v")).collect()}
    assert tuple(rows[1]) == ("1", "2", "3", "4") and rows[2] is None and rows[3] is None


@pytest.mark.parametrize("name", ["scene_metadata", "scene_metadata_s2"])
def test_scenes_are_sorted_once_and_not_parsed_one_by_one(spark, name):
    plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    plan += Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [folder") == 1 and "from_xml" not in plan and plan.count("pythonUDF0") > 0
