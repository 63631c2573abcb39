import hashlib
import json

import pytest
from pyspark.sql import functions as F

from star_rows import rows
from grantlens.plans.clean import clean_star
from grantlens.schemas import CLEAN, RAW
from grantlens.sources import delimited, integrity, synthetic, warehouse
from grantlens.sources.paths import listing
from grantlens.streaming.incremental import load_new_files

HEADER = "location_id\tdisambig_country\n"


def test_null_tokens_quotes_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "l.tsv"
    path.write_text(HEADER + '007\tNULL\n"a ""b"""\tnull\nNil\t\n x \t US \n', encoding="utf-8")
    got = delimited.scan(spark, str(path), RAW["locations"])
    assert got.columns == RAW["locations"].names
    assert rows(got.select("location_id", "disambig_country")) == sorted(
        [("007", None), ('a "b"', None), ("Nil", None), (" x ", " US ")], key=repr
    )


def test_malformed_row_stops_the_job_even_when_one_column_is_read(spark, tmp_path):
    path = tmp_path / "l.tsv"
    path.write_text(HEADER + "a\tUS\textra\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED"):
        delimited.scan(spark, str(path), RAW["locations"]).select("location_id").collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "l.tsv"
    path.write_text(HEADER + '"a\nb"\tUS\n', encoding="utf-8")
    got = delimited.scan(spark, str(path), RAW["locations"], multiline=True)
    assert got.first()["location_id"] == "a\nb"


def test_csv_has_header_iso_dates_and_keeps_blanks(spark, tmp_path):
    df = spark.sql("SELECT ' a ' AS x, DATE '2020-01-05' AS d, 'q\"uote' AS q, CAST(NULL AS STRING) AS n")
    delimited.write_csv(df, str(tmp_path / "out"), files=1)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text(encoding="utf-8") == 'x,d,q,n\n a ,2020-01-05,"q""uote",\n'


def test_star_roundtrip_prunes_years(spark, small_star, tmp_path):
    counts = warehouse.write_star(small_star, str(tmp_path))
    assert counts == {
        "patents": 7, "inventors": 4, "companies": 3, "links": 8, "cpc": 7,
    }
    stored = warehouse.read_star(spark, str(tmp_path))
    assert rows(stored.links) == rows(small_star.links)
    assert rows(stored.activity.select("patent_id", "year")) == rows(
        small_star.activity.select("patent_id", "year")
    )
    plan = stored.activity.filter("year >= 2003")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "Join" not in plan
    # a second build replaces the first
    assert warehouse.write_star(small_star, str(tmp_path))["links"] == 8
    assert warehouse.read_star(spark, str(tmp_path)).links.count() == 8


def test_parquet_wins_over_csv_and_short_csv_rows_are_padded(spark, small_star, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "clean_inventors.csv").write_text("inventor_id,name,country\nz,Zed\n", encoding="utf-8")
    assert rows(warehouse.read_clean_table(spark, folder, "inventors")) == [("z", "Zed", None)]
    warehouse.write_counted(small_star.inventors, f"{folder}/inventors")
    assert warehouse.read_clean_table(spark, folder, "inventors").count() == 4
    star = warehouse.read_star(spark, folder)
    assert star.companies.count() == 0 and star.companies.columns == CLEAN["companies"].names


def test_saved_table_has_statistics(spark, small_star):
    warehouse.save_table(small_star.companies, "companies_stats")
    described = spark.sql("DESCRIBE EXTENDED companies_stats").filter("col_name = 'Statistics'")
    assert "3 rows" in described.first()["data_type"]
    spark.sql("DROP TABLE companies_stats")


def test_checksums_and_audit(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    for name, content in {"a.bin": b"x" * 3_000_000, "b.bin": b"1", "c.bin": b"123"}.items():
        (data / name).write_bytes(content)
    found = integrity.checksums(listing(spark, str(data))).cache()
    sums = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in found.collect()}
    assert sums["a.bin"] == (3_000_000, hashlib.sha256(b"x" * 3_000_000).hexdigest())
    assert sums["b.bin"] == (1, hashlib.sha256(b"1").hexdigest())
    where = data.as_uri().replace("file:///", "file:/")
    manifest = {"files": {
        f"{where}/a.bin": {"bytes": 3_000_000, "sha256": sums["a.bin"][1]},
        f"{where}/c.bin": {"bytes": 3, "sha256": "other"},
        f"{where}/d.bin": {"bytes": 1, "sha256": "gone"},
    }}
    (tmp_path / "manifest.json").write_text(json.dumps(manifest), encoding="utf-8")
    listed = integrity.read_manifest(spark, str(tmp_path / "manifest.json"))
    got = integrity.audit(listed, found.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/")))
    assert {r.path[-5:]: r.status for r in got.collect()} == {
        "a.bin": "ok", "c.bin": "mismatch", "d.bin": "missing"
    }


def test_format_choice(spark):
    names = ["parquet/a", "csv/b", "warehouse/c"]
    manifest = spark.createDataFrame([(n, 1, "s") for n in names], integrity.MANIFEST)
    chosen = lambda kind: [r[0] for r in rows(integrity.choose_format(manifest, kind).select("path"))]
    assert chosen("parquet") == ["parquet/a"]
    assert chosen("both") == ["csv/b", "parquet/a"]
    assert chosen("all") == sorted(names)


def test_load_record(spark, tmp_path):
    record = str(tmp_path / "record")
    found = spark.createDataFrame([("a", 1, "s"), ("b", 2, "s"), ("c", 3, "s")], integrity.MANIFEST)
    assert integrity.pending(found, integrity.read_load_record(spark, record)).count() == 3
    integrity.record_loaded(found.filter("path = 'a'"), record)
    integrity.record_loaded(spark.createDataFrame([("b", 99, "s")], integrity.MANIFEST), record)
    (tmp_path / "record" / "broken.json").write_text("{not json\n", encoding="utf-8")
    recorded = integrity.read_load_record(spark, record)
    left = integrity.pending(found, recorded)
    assert [r[0] for r in rows(left.select("path"))] == ["b", "c"]  # b has another size
    assert integrity.pending(found, recorded, force=True).count() == 3


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()
    schema = RAW["cpc"]
    line = lambda k: "\t".join([f"p{k}", "1", "A", "A01", "NULL", "g", "t"])
    header = "\t".join(schema.names)
    (tmp_path / "in" / "one.tsv").write_text(f"{header}\n{line(1)}\n{line(2)}\n", encoding="utf-8")
    load_new_files(spark, source, schema, target, mark)
    load_new_files(spark, source, schema, target, mark)
    assert spark.read.parquet(target).count() == 2
    (tmp_path / "in" / "two.tsv").write_text(f"{header}\n{line(3)}\n", encoding="utf-8")
    load_new_files(spark, source, schema, target, mark)
    got = spark.read.parquet(target)
    assert rows(got.select("patent_id", "cpc_subclass")) == [("p1", None), ("p2", None), ("p3", None)]


def test_synthetic_tables_clean_up(spark):
    raw = synthetic.raw_tables(spark, 0.4)
    star = clean_star(raw)
    assert star.patents.count() == 2000
    years = star.patents.agg(F.min("year"), F.max("year"), F.count_if(F.col("year").isNull())).first()
    assert years[0] >= 2010 and years[1] <= 2025 and 0 < years[2] < 40
    per_patent = star.links.select("patent_id", "inventor_id").distinct().groupBy("patent_id").count()
    assert per_patent.agg(F.max("count")).first()[0] <= 5
    assert star.links.filter("company_id IS NULL").count() > 0
    top = star.inventors.groupBy("country").count().orderBy(F.desc("count")).first()
    assert top["country"] == "US"


def test_files_of_different_column_order(spark, tmp_path):
    """Each file is read by its own header, whatever the other files of the folder say."""
    (tmp_path / "a.tsv").write_text("location_id\tdisambig_country\nL1\tUS\n", encoding="utf-8")
    (tmp_path / "b.tsv").write_text("disambig_country\tlocation_id\nDE\tL2\n", encoding="utf-8")
    (tmp_path / "c.tsv").write_text("location_id\nL3\n", encoding="utf-8")
    found = delimited.scan(spark, str(tmp_path), RAW["locations"])
    assert rows(found.select("location_id", "disambig_country")) == sorted(
        [("L1", "US"), ("L2", "DE"), ("L3", None)], key=repr)


def test_empty_files_are_listed(spark, tmp_path):
    (tmp_path / "none.txt").write_text("", encoding="utf-8")
    (tmp_path / "some.txt").write_text("abc", encoding="utf-8")
    found = {r["path"].rsplit("/", 1)[-1]: r["bytes"] for r in listing(spark, str(tmp_path), "*.txt").collect()}
    assert found == {"none.txt": 0, "some.txt": 3}


def test_digest_trees_of_blocks(spark, tmp_path):
    sizes = {"a": 0, "b": 1, "c": 1000, "d": 1001, "e": 5432}
    for name, size in sizes.items():
        (tmp_path / name).write_bytes(bytes(k * 7 % 251 for k in range(size)))
    files = listing(spark, str(tmp_path), "[a-e]")
    found = {r["path"].rsplit("/", 1)[-1]: r["tree_sha256"] for r in integrity.tree_checksums(files, block_bytes=1000).collect()}
    for name, size in sizes.items():
        raw = (tmp_path / name).read_bytes()
        blocks = [raw[k:k + 1000] for k in range(0, max(size, 1), 1000)]
        assert found[name] == hashlib.sha256(b"".join(hashlib.sha256(b).digest() for b in blocks)).hexdigest(), name
