import duckdb
import pytest

from tracewright.llm import license_scan

MIT, GPL = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["GPL-3.0"]
FILES = [
    (1, "/a/LICENSE", f"Some project\n\n{GPL}\n" + "long text follows here " * 40),
    (2, "/a/b/one", "plain prose that names no terms at all"),
    (3, "/a/b/c/two", f"prose\nmore prose\n{MIT.upper()}"),
    (4, "/a/b/c/d/three", "prose"),
    (5, "/a/b/c/d", MIT),
    (6, "/z/four", None),
    (7, None, ""),
    (8, None, MIT),
    (9, "five", "mit mit mit license"),
    (10, "/a/bb/six", "notes under the sun"),
    (11, "/a/b/c/d/e/seven", "x " * 20000),
    (12, "/q/eight", f"{MIT}\n{GPL}"),
    (12, "/q/eight", f"{MIT}\n{GPL}"),
    (None, "/q/nine", MIT),
    (14, "/q/ten", "tied"),
]


@pytest.fixture(scope="module")
def files(spark):
    rows = [(*f, "clash", 1) for f in FILES]
    return spark.createDataFrame(rows, "file_id int, path string, text string, license string, tf int")


def test_own_and_inherited(files):
    rows = license_scan.scanned(files).collect()
    assert len(rows) == len(FILES)
    found = {r.file_id: (r.license, r.origin, r.from_dir) for r in rows if r.path != "/q/nine"}
    assert found[1] == ("GPL-3.0", "header", None)
    assert found[2] == ("MIT", "directory", "/a/b") or found[2] == ("GPL-3.0", "directory", "/a")
    assert found[3] == ("MIT", "header", None)
    assert found[4] == ("MIT", "directory", "/a/b/c") and found[11] == found[4]
    assert found[6] == (None, None, None) and found[7] == (None, None, None)
    assert found[8] == ("MIT", "header", None) and found[10] == ("GPL-3.0", "directory", "/a")
    assert license_scan.scanned(files.limit(0)).count() == 0


def test_same_as_sql(files):
    connection = duckdb.connect()
    table = files.toPandas().astype({"file_id": "Int64"})
    connection.register("t", table)
    sql = license_scan.scan_sql("SELECT file_id AS id, path, text FROM t WHERE file_id IS NOT NULL")
    known = connection.sql(sql).fetchall()
    rows = license_scan.scanned(files.where("file_id is not null")).select(
        "file_id", "path", "license", "cosine", "origin", "from_dir").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, known))


def test_needed_words_keep_all_that_can_match():
    vectors = {"t": {"a": 0.8, "b": 0.5, "c": 0.33}}
    assert license_scan.needed_words(vectors, 0.7) == ["a"]
    assert license_scan.needed_words(vectors, 0.5) == ["a", "b"]
