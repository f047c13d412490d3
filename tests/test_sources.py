import pytest
from pyspark.sql import functions as F, types as T

from marquee.contracts import CLEAN, RAW, SOURCE_ORDER, Column, Table
from marquee.sources.csv import read_raw
from marquee.sources import tables

MAIN = RAW["movies_main"]
HEADER = "id,title,release_date,budget,revenue\n"


def write(folder, **files):
    for name, content in files.items():
        (folder / f"{name}.csv").write_text(content, encoding="utf-8")
    return str(folder)


def read(spark, path, **options):
    return [tuple(r) for r in read_raw(spark, path, MAIN, **options).orderBy(*SOURCE_ORDER).select(*MAIN.names).collect()]


def test_quotes_newlines_blanks_and_tokens(spark, tmp_path):
    path = write(tmp_path, a=HEADER + '1,"He said ""hi"", ok",1/5/1999,0,0\n\n2,"two\nlines",NA,"",None\n   \n3, NA ,x\n')
    assert read(spark, path) == [
        ("1", 'He said "hi", ok', "1/5/1999", "0", "0"),
        ("2", "two\nlines", None, None, None),
        ("3", " NA ", "x", None, None),
    ]
    assert read(spark, path, na_tokens=())[1][2] == "NA"
    assert read_raw(spark, path, MAIN).count() == 3


@pytest.mark.parametrize("line", ["1,a,b,c,d,e", "1,a,b,c,d,", '1,"a,b",b,c,d,"x,y"'])
def test_too_many_fields_fail(spark, tmp_path, line):
    path = write(tmp_path, a=HEADER + line + "\n")
    with pytest.raises(Exception, match="expected 5 fields"):
        read_raw(spark, path, MAIN).count()


def test_header_order_and_mismatch(spark, tmp_path):
    good = tmp_path / "good"; good.mkdir()
    path = write(good, a="title,id,release_date,revenue,budget\nt,1,d,r,b\n")
    assert read(spark, path) == [("1", "t", "d", "b", "r")]
    bad = tmp_path / "bad"; bad.mkdir()
    with pytest.raises(ValueError, match="does not match"):
        read(spark, write(bad, a="id,name,release_date,budget,revenue\n1,t,d,b,r\n"))
    mixed = tmp_path / "mixed"; mixed.mkdir()
    with pytest.raises(Exception):
        read(spark, write(mixed, a=HEADER + "1,t,d,b,r\n", b="title,id,release_date,budget,revenue\nt,1,d,b,r\n"))


def test_row_order_over_files(spark, tmp_path):
    path = write(tmp_path, a=HEADER + "1,a,,,\n2,a,,,\n", b=HEADER + "".join(f"{i},b,,,\n" for i in range(3, 200)))
    assert [int(r[0]) for r in read(spark, path)] == list(range(1, 200))
    assert [int(r[0]) for r in read(spark, path, multi_line=False)] == list(range(1, 200))


def movies(spark, **changes):
    row = {"movie_id": 1, "movie_title": "t", "release_date": None, "budget": 1.5, "revenue": None, **changes}
    return spark.createDataFrame(
        [tuple(row.values())], "movie_id long, movie_title string, release_date date, budget double, revenue double"
    )


def test_overwrite_gives_the_same_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(movies(spark), path, CLEAN["movies"]) == 1
    assert tables.write_table(movies(spark), path, CLEAN["movies"]) == 1
    stored = tables.read_table(spark, path)
    assert stored.count() == 1 and [f.dataType for f in stored.schema] == [c.type for c in CLEAN["movies"].columns]
    assert tables.table_columns(spark, path) == CLEAN["movies"].names
    with pytest.raises(Exception):
        stored.withColumn("movie_id", F.lit(2)).write.mode("overwrite").parquet(path)


def test_empty_result_is_refused(spark, tmp_path):
    with pytest.raises(tables.EmptyResult):
        tables.write_table(movies(spark).where("movie_id = 2"), str(tmp_path / "t"), CLEAN["movies"])
    assert tables.write_table(movies(spark).where("movie_id = 2"), str(tmp_path / "t"), CLEAN["movies"], True) == 0


def test_empty_or_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(movies(spark), path, CLEAN["movies"])
    with pytest.raises(tables.EmptyResult):
        tables.write_table(movies(spark).where("movie_id = 2"), path, CLEAN["movies"])
    with pytest.raises(Exception):
        tables.write_table(movies(spark, movie_id=None), path, CLEAN["movies"])
    assert tables.read_table(spark, path).count() == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("change", [{"movie_title": "x" * 501}, {"budget": 12345678901234.0}, {"movie_id": None}])
def test_values_that_do_not_fit_fail(spark, change, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="cannot store"):
            tables.storage_cast(movies(spark, **change), CLEAN["movies"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_conform_renames_and_adds(spark):
    old = spark.createDataFrame([("France", 1, "FR")], "country_name string, movie_id long, iso_country_code string")
    got = tables.conform(old, CLEAN["producing_countries"]).first()
    assert tuple(got) == (1, "FR", "France", None, None, False)
    renamed = tables.conform(movies(spark).withColumnRenamed("movie_title", "title"), CLEAN["movies"])
    assert renamed.columns == CLEAN["movies"].names


def test_verify_count(spark):
    assert tables.verify_count(spark.range(3), spark.range(3)) == 3
    with pytest.raises(tables.CountMismatch):
        tables.verify_count(spark.range(3), spark.range(2))


def test_first_rows(spark):
    assert tables.first_rows(spark.range(5000)).count() == 1000
    assert tables.first_rows(spark.range(3)).count() == 3


def test_declared_table_has_comments(spark):
    tables.declare_table(spark, "clean_test", CLEAN["movies"])
    tables.declare_table(spark, "clean_test", CLEAN["movies"])
    columns = {c.name: c.description for c in spark.catalog.listColumns("clean_test.movies")}
    assert columns["movie_title"] == "Trimmed title"
    wider = Table("movies", (*CLEAN["movies"].columns, Column("note", T.StringType())))
    tables.declare_table(spark, "clean_test", wider)
    assert "note" not in spark.table("clean_test.movies").columns
    tables.declare_table(spark, "clean_test", wider, recreate=True)
    assert "note" in spark.table("clean_test.movies").columns
    spark.sql("DROP DATABASE clean_test CASCADE")


def test_published_pointer(spark, tmp_path):
    tables.publish(spark, str(tmp_path), "first")
    tables.publish(spark, str(tmp_path), "second")
    assert tables.published(spark, str(tmp_path)) == "second"
    # A publication that broke off is no publication.
    (tmp_path / "_published" / "00000003").mkdir()
    assert tables.published(spark, str(tmp_path)) == "second"
    assert tables.published_runs(spark, str(tmp_path)) == {"first", "second"}


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        tables.published(spark, str(tmp_path))
