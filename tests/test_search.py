"""Search through the trigram index against the plain scan, and what it leaves unread."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grantlens.plans import search
from grantlens.plans.filtered import Filters, search_count, search_page
from grantlens.star import Star
from star_rows import rows

WINDOW = Filters(2000, 2004)
NEEDLES = ["needle", "NEEDLE", "nee_le", "ne%le", "%", "", "e", "100%", "100% pure", "é漢", "\\", "a\\b", "x%zzz", "\U0001F600 smile", "no such thing"]


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(7)
    words = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(40)]
    special = ["a needle here", "Needle", "100% pure", "É漢 a", "a\\b", "nee-le", "ne very le", "\U0001F600 smile", "İstanbul", None, "", "ab"]
    out = []
    for k in range(400):
        abstract = " ".join(draw.choices(words, k=30)) if k % 40 else special[k // 40]
        out.append((f"p{k}", draw.choice([None, "A title", special[k % 12] if k % 37 == 0 else "plain"]), abstract, draw.choice([2000, 2001, 2004, 1999, None])))
    return spark.createDataFrame(out, "patent_id string, title string, abstract string, year int").withColumn(
        "filing_date", F.make_date("year", F.lit(1), F.lit(2)))


@pytest.fixture(scope="module")
def index(texts, tmp_path_factory):
    return search.build_index(texts, str(tmp_path_factory.mktemp("index")), slice_bytes=1500)


@pytest.mark.parametrize("literal", [False, True])
def test_index_and_scan_agree(spark, texts, index, literal):
    star = Star(texts, None, None, None, None)
    for needle in NEEDLES:
        counts = [search_count(star, needle, WINDOW, literal, i).first()[0] for i in (None, index)]
        assert counts[0] == counts[1], needle
    pages = [rows(search_page(star, "needle", WINDOW, 5, 0, literal, i)) for i in (None, index)]
    assert pages[0] == pages[1] and pages[0]


def test_runs(spark):
    df = spark.createDataFrame([("ABCD",), ("ab",), ("",), (None,), ("x\U0001F600yz",), ("aaaa",)], "t string")
    assert [r[0] for r in df.select(search.runs_of(F.col("t"))).collect()] == [
        ["abc", "bcd"], [], [], None, ["x\U0001F600y", "\U0001F600yz"], ["aaa"]]
    assert search.needle_runs("AB_cde%fghi") == ["cde", "fgh", "ghi"]
    assert search.needle_runs("ab%c", literal=True) == ["ab%", "b%c"]


def _read(df):
    """Rows that left the scan of the texts."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, seen = [plan], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and "abstract" in node.schema().simpleString():
            seen.append(node.metrics().apply("numOutputRows").value())
        children = node.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    return sum(seen)


def test_folders_of_other_slices_are_not_read(texts, index):
    window = F.col("year").between(2000, 2004)
    inside = texts.filter(window).count()
    assert _read(index.hits("e", window)) == inside
    assert 0 < _read(index.hits("needle", window)) < inside / 4
    assert _read(index.hits("no such thing", window)) == 0


def test_no_texts(spark, texts, tmp_path):
    empty = search.build_index(texts.limit(0), str(tmp_path))
    assert empty.slices == 0 and empty.hits("needle", F.lit(True)).count() == 0


def test_runs_of_many_texts_at_once_are_the_runs_of_each(spark, texts, tmp_path, monkeypatch):
    """No expression walks through the characters of a text; runs neither cross texts nor get lost where a text is cut."""
    built = search.build_index(texts, str(tmp_path), slice_bytes=1500)
    held = F.concat_ws("\n", "title", "abstract")
    want = built.texts.select(F.explode(search.runs_of(held)).alias("run"), "year", "slice").distinct()
    assert rows(spark.read.schema(search.RUNS).parquet(f"{tmp_path}/runs")) == rows(want)
    monkeypatch.setattr(search, "_MANY_SIGNS", 4)
    batch = pa.RecordBatch.from_pydict({"year": [2000, 2000, None, None], "slice": [0, 0, 1, 1], "held": ["abcdefghijkl", "xy\U0001F600z", "ab", "klmno"]})
    got = [tuple(r.values()) for b in search._slice_runs(iter([batch])) for r in b.to_pylist()]
    assert set(got) == {(t[k:k + 3], y, p) for y, p, t in zip(*batch.to_pydict().values()) for k in range(len(t) - 2)}


def test_building_explodes_no_characters(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "runs_of", lambda text: pytest.fail("a text is taken apart by an expression"))
    search.build_index(texts.limit(20), str(tmp_path))
