import pytest
from conftest import rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.sources import blobs as B
from stargrain.sources import registry
from stargrain.sources.csvlines import csv_fields
from stargrain.sources.tables import Layers, TableResolver, documented
from stargrain.sources.typed import RESCUED, parsed, pick, rejects, rescue
from stargrain.streaming import ingest_csv, ingest_feeds, ingest_files, profile_csv, profiles, schema_drift, stored_schema

SCHEMA = "repository_id bigint, path string, type string, is_deleted boolean, version int, content string"


def blob(spark, *rows):
    return spark.createDataFrame([(1, p, t, d, v, c) for p, t, d, v, c in rows], SCHEMA)


def test_tombstones_are_three_valued(spark):
    df = blob(spark, ("a", "blob", None, 1, "x"), ("b", "blob", False, 1, "x"), ("c", "blob", True, 1, "x"), ("d", "tree", None, 1, "x"))
    assert rows_of(B.live_blobs(df).select("path")) == [("a",), ("b",)]


def test_parse_line_ends_blank_lines_and_quotes(spark):
    df = blob(spark, ("a", "blob", None, 1, 'id,name\r\n1,"x, y"\r\n\r\n2,z\r\n'))
    got = B.parse_csv_blobs(df)
    assert got.columns == ["id", "name", "_source_repository_id", "_source_path", "_ingested_at"]
    assert rows_of(got.select("id", "name", "_source_path")) == [("1", "x, y", "a"), ("2", "z", "a")]


def test_header_with_quoted_comma_keeps_its_width(spark):
    df = blob(spark, ("a", "blob", None, 1, '"id, no",name\n1,x'))
    assert B.parse_csv_blobs(df, lineage=False).columns == ["id, no", "name"]


def test_short_and_long_rows_are_kept(spark):
    df = blob(spark, ("a", "blob", None, 1, "a,b,c\n1,2\n1,2,3,4"))
    assert rows_of(B.parse_csv_blobs(df, lineage=False)) == [("1", "2", "3"), ("1", "2", None)]


@pytest.mark.parametrize(
    "rows",
    [[], [("f.csv", "blob", True, 1, "a\n1")], [("f.csv", "blob", None, 1, None)], [("f.csv", "blob", None, 1, "a\n")], [("f.csv", "blob", None, 1, "")]],
)
def test_missing_file_gives_an_empty_table_with_the_declared_schema(spark, rows):
    got = B.blob_table(spark, blob(spark, *rows), 1, "f.csv", "version", "a STRING")
    assert got.columns[0] == "a" and got.count() == 0


def test_newest_version_wins(spark):
    df = blob(spark, ("f", "blob", None, 1, "a\nold"), ("f", "blob", None, 3, "a\nnew"), ("f", "blob", True, 4, "a\ngone"))
    assert rows_of(B.blob_table(spark, df, 1, "f", "version", "a STRING").select("a")) == [("new",)]


def test_registry_counts_and_paths():
    assert {s: len(e["tables"]) for s, e in registry.SOURCES.items()} == {"analysis": 21, "relational": 11, "historical": 27}
    assert registry.file_path("historical", "hist_goals") == "data-csv/goals.csv"
    assert registry.file_path("analysis", "teams") == "data/csv/teams.csv"
    assert registry.file_path("relational", "teams") == "teams.csv"


def test_one_source_at_a_time(spark):
    rows = [
        (1, "teams.csv", "blob", None, 1, "team_id,team_name\n1,x"),
        (2, "data/csv/teams.csv", "blob", None, 1, "team_name\ny"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    repositories = {"relational": 1, "analysis": 2, "historical": 3}
    rel = registry.blob_tables(spark, df, repositories, "relational", "version")
    ana = registry.blob_tables(spark, df, repositories, "analysis", "version")
    assert rows_of(rel["teams"].select("team_id", "team_name")) == [("1", "x")]
    assert rows_of(ana["teams"].select("team_name")) == [("y",)]
    # A file that has not arrived keeps its declared columns.
    assert rel["venues"].columns == ["venue_id", "stadium_name", "city", "country", "capacity"]
    assert rel["venues"].count() == 0
    with pytest.raises(ValueError):
        registry.blob_tables(spark, df, repositories, "nothing", "version")


def test_typed_projection_never_fails(frame):
    df = frame("a string, b string, c string", ("1", "2024-02-30", "true"), ("x", "2024-02-28", "maybe"), (None, None, None))
    spec = {"n": "a int", "d": "b date", "f": "c boolean", "raw": "a"}
    got = pick(df, **spec)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "date", "boolean", "string"]
    assert [r.n for r in got.collect()] == [1, None, None]
    assert rows_of(rejects(df, **spec)) == [("d", 2, 1), ("f", 2, 1), ("n", 2, 1)]


def test_rescue_column(frame):
    df = frame("m map<string,string>", ({"a": "1", "z": "new"},), ({"a": "x"},), ({"a": "2"},))
    got = df.select(*rescue(F.col("m"), [("a", "int"), ("b", "string")]))
    assert rows_of(got) == [(1, None, '{"z":"new"}'), (2, None, None), (None, None, '{"a":"x"}')]


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_csv_stream_takes_each_file_once_and_rescues(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    schema = [("id", "int"), ("name", "string")]
    write(landing, "1.csv", 'id,name\n1,"a, b"\n2,c\n')
    for _ in range(2):
        ingest_csv(spark, str(landing), schema, out, state)
    assert spark.read.parquet(out).count() == 2
    # New column order, an unknown column, a bad value, a long row, a row that looks like the header.
    write(landing, "2.csv", "name,extra,id\nd,e,x\nf,,4,more\nname,extra,id\n")
    ingest_csv(spark, str(landing), schema, out, state)
    got = spark.read.parquet(out)
    assert rows_of(got.select("id", "name", RESCUED)) == sorted(
        [(1, "a, b", None), (2, "c", None), (None, "d", '{"extra":"e","id":"x"}'),
         (4, "f", '{"_extra3":"more"}'), (None, "name", '{"extra":"extra","id":"id"}')], key=repr
    )
    assert got.where("_source_file like '%2.csv'").count() == 3
    assert got.where(F.col("_ingested_at").isNull()).count() == 0


def test_native_stream_and_stored_schema(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write(landing, "1.csv", "id,v\n1,0.5\n")
    schema = stored_schema(spark, str(landing), "csv", f"{state}/schema")
    assert schema.simpleString() == "struct<id:int,v:double>"
    write(landing, "2.csv", "id,v\nx,y\n")
    assert stored_schema(spark, str(landing), "csv", f"{state}/schema") == schema
    ingest_files(spark, str(landing), "csv", schema, out, f"{state}/c")
    ingest_files(spark, str(landing), "csv", schema, out, f"{state}/c")
    got = spark.read.parquet(out).select("id", "v", RESCUED)
    assert rows_of(got) == [(1, 0.5, None), (None, None, "x,y")]


def test_native_stream_refuses_other_headers(spark, tmp_path):
    write(tmp_path / "in", "1.csv", "other,v\n1,0.5\n")
    with pytest.raises(StreamingQueryException):
        ingest_files(spark, str(tmp_path / "in"), "csv", "id int, v double", str(tmp_path / "out"), str(tmp_path / "c"))


def test_feeds_by_source(spark, tmp_path):
    write(tmp_path / "in" / "pre_match_prediction", "1.csv", "home_code,model_home_pct\nmex,88.00\n")
    args = (spark, registry.FILE_FEEDS, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert ingest_feeds(*args, source="predictions") == ["predictions.pre_match_prediction"]
    got = spark.read.parquet(str(tmp_path / "out" / "predictions" / "pre_match_prediction"))
    assert rows_of(got.select("home_code", "model_home_pct")) == [("mex", 88.0)]
    with pytest.raises(ValueError):
        ingest_feeds(*args, source="nothing")


def test_layers_store_and_read_back(spark, frame, tmp_path):
    calls = []

    def one(L):
        calls.append("one")
        return documented(frame("a int", (1,)), {"a": "A number."})

    plans = {"silver": {"one": one, "two": lambda L: L.silver("one").withColumn("b", F.lit(2))}}
    layers = Layers(lambda s, t: None, plans, TableResolver(spark, root=str(tmp_path / "store"), prefix="x_"))
    layers.materialise("silver")
    assert rows_of(layers.silver("two")) == [(1, 2)]
    assert calls == ["one"]
    assert (tmp_path / "store" / "x_silver" / "one").exists()
    assert layers.silver("one").schema["a"].metadata["comment"] == "A number."


def test_bucketed_catalog_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    store = TableResolver(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    for name in ("left_t", "right_t"):
        store.write(spark.range(100).withColumnRenamed("id", "k"), "gold", name, "It's a test.", buckets=(4, "k"))
    joined = store.read("gold", "left_t").join(store.read("gold", "right_t"), "k")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    joined.collect()
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gold.left_t").collect()}
    assert properties["quality"] == "gold"
    assert spark.catalog.getTable("gold.left_t").description == "It's a test."


def test_each_file_is_read_by_its_own_header(spark):
    df = blob(
        spark, ("a", "blob", None, 1, "x,y\n1,2"), ("b", "blob", None, 1, " y ,x\n20,10"), ("c", "blob", None, 1, "x,y,z,x\n5,6,7,8,9")
    )
    got = B.parse_csv_blobs(df, "x INT, y INT", lineage=False, rescued=True)
    assert sorted(tuple(r) for r in got.select("x", "y").collect()) == [(1, 2), (5, 6), (10, 20)]
    assert [r[0] for r in got.where("x = 5").select(RESCUED).collect()] == ['{"z":"7","_extra3":"8","_extra4":"9"}']
    assert got.where(F.col(RESCUED).isNull()).count() == 2
    assert B.parse_csv_blobs(df, lineage=False).columns == ["x", "y", "z"]


def test_csv_fields(spark):
    lines = ['a,"x, y",c', ",b,", '"he said ""hi""",2', '"q \\"z\\"",1', '""', '"open,b', '"ab"cd,e']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = [r.f for r in df.orderBy("i").select(csv_fields(F.col("line")).alias("f")).collect()]
    assert got == [["a", "x, y", "c"], [None, "b", None], ['he said "hi"', "2"], ['q "z"', "1"], [""], ['"open', "b"], ['"ab"cd', "e"]]


def test_every_registered_table_exists(spark):
    df = spark.createDataFrame([(2, "data/csv/teams.csv", "blob", None, 1, "team_name\ny")], SCHEMA)
    repositories = {"relational": 1, "analysis": 2, "historical": 3}
    for source, entry in registry.SOURCES.items():
        tables = registry.blob_tables(spark, df, repositories, source, "version")
        assert sorted(tables) == sorted(entry["tables"])
        assert sum(t.count() for t in tables.values()) == (source == "analysis")


def test_repeated_header_names_do_not_stop_a_stream(spark, tmp_path):
    write(tmp_path / "in", "1.csv", "id,name,id\n1,a,2\n")
    args = (spark, str(tmp_path / "in"), [("id", "int"), ("name", "string")], str(tmp_path / "out"), str(tmp_path / "state"))
    ingest_csv(*args)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(got.select("id", "name", RESCUED)) == [(1, "a", '{"_extra2":"2"}')]


def test_json_keeps_unknown_fields(spark, tmp_path):
    write(tmp_path / "in", "1.json", '{"x":1,"new":"kept"}\n{"x":"bad"}\nno json\n{"x":2}\n')
    ingest_files(spark, str(tmp_path / "in"), "json", "x int", str(tmp_path / "out"), str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(got.select("x", RESCUED)) == sorted(
        [(1, '{"new":"kept"}'), (None, '{"x":"bad"}'), (None, "no json"), (2, None)], key=repr
    )


def test_schema_comes_from_all_files_by_name(spark, tmp_path):
    for i in range(30):
        write(tmp_path / "in", f"{i:02d}.csv", "id,v\n1,2\n" if i % 2 else "v,id\n3,4\n")
    write(tmp_path / "in", "99.csv", "w,v,id\nx,0.5,7\n")
    schema = stored_schema(spark, str(tmp_path / "in"), "csv", str(tmp_path / "state"))
    assert {f.name: f.dataType.simpleString() for f in schema} == {"id": "int", "v": "double", "w": "string"}


def test_schema_of_an_empty_folder_and_after_a_broken_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert stored_schema(spark, str(tmp_path / "in"), "csv", str(tmp_path / "state")).fields == []
    (tmp_path / "state").mkdir(exist_ok=True)  # what a run leaves that dies before it writes
    write(tmp_path / "in", "1.csv", "id\n1\n")
    assert stored_schema(spark, str(tmp_path / "in"), "csv", str(tmp_path / "state")).simpleString() == "struct<id:int>"


ODD_TEXTS = [
    None, "", " ", "1", " 7 ", "\t-8\n", "+5", "-", "+", "1.0", "1.", ".5", ".", "1e5", "1E-3", "1d", "2.5F", "0x1p3", "0x", "nan", "NaN", "-nan", "inf", "+Infinity",
    "-INF", "infinit", "99999999999", "-2147483648", "9223372036854775808", "1 2", "1_0", "\u0661", "true", " TRUE ", "t", "Y", "yes", "no", "0", "F", "false ", "tru",
    "1995-01-01", "2024-02-30", "x" * 50, "1\x7f", "\x001", "1\u00a0", "--1", "1e", "e5", "1.2.3", "1e400", "-0", "0.0", "1L",
]


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "float", "boolean", "date", "timestamp_ntz", "string"])
def test_parsed_equals_a_plain_cast(frame, kind):
    df = frame("s string", *[(s,) for s in ODD_TEXTS])
    got = df.select("s", parsed(F.col("s"), kind).cast("string").alias("a"), F.col("s").try_cast(kind).cast("string").alias("b")).collect()
    assert [(r.s, r.a) for r in got] == [(r.s, r.b) for r in got]


def test_profiles_add_up_over_files_and_runs(spark, tmp_path):
    landing, kept = tmp_path / "in", str(tmp_path / "profiles")
    landing.mkdir()
    assert profile_csv(spark, str(landing), kept) is None
    (landing / "a.csv").write_text("id,v,\n1,2,x\n2,,y\n")
    (landing / "c.csv").write_text("w,id\n2024-01-01,3\n")
    types = lambda df: {r.name: (r.type, r.n) for r in profiles.column_types(df).collect()}
    assert types(profile_csv(spark, str(landing), kept)) == {"id": ("int", 3), "v": ("int", 1), "w": ("date", 1)}
    # A file that is known is not read again, whatever has become of it.
    (landing / "a.csv").unlink()
    (landing / "b.csv").write_text("v,id\n1.5,\nx,9\n")
    found = profile_csv(spark, str(landing), kept)
    assert types(found) == {"id": ("int", 4), "v": ("string", 3), "w": ("date", 1)}
    assert sorted({r.file.rsplit("/", 1)[1] for r in found.collect()}) == ["a.csv", "b.csv", "c.csv"]
    assert profiles.schema_of(found).simpleString() == "struct<id:int,v:string,w:date>"
    assert {
        (r.name, r.stored_type, r.found_type, r.first_file.rsplit("/", 1)[1])
        for r in profiles.drift(found, T.StructType.fromDDL("id int, v int")).collect()
    } == {("v", "int", "string", "b.csv"), ("w", None, "date", "c.csv")}


def test_drift_of_a_feed(spark, tmp_path):
    landing, state = tmp_path / "in", str(tmp_path / "state")
    landing.mkdir()
    (landing / "a.csv").write_text("id\n1\n")
    assert stored_schema(spark, str(landing), "csv", state).simpleString() == "struct<id:int>"
    assert schema_drift(spark, str(landing), state).collect() == []
    (landing / "b.csv").write_text("id\nx\n")
    assert [(r.name, r.stored_type, r.found_type) for r in schema_drift(spark, str(landing), state).collect()] == [("id", "int", "string")]
    assert stored_schema(spark, str(landing), "csv", state).simpleString() == "struct<id:int>"


def test_a_path_store_keeps_comment_and_tag_and_survives_a_broken_write(spark, frame, tmp_path):
    store = TableResolver(spark, root=str(tmp_path))
    store.write(frame("a int", (1,)), "gold", "t", "It's \"one\".")
    store.write(store.read("gold", "t").unionAll(frame("a int", (2,))), "gold", "t", "two")
    assert rows_of(store.read("gold", "t")) == [(1,), (2,)]
    assert store.described("gold", "t") == {"comment": "two", "quality": "gold"}
    bad = frame("a int", (3,)).select(F.raise_error(F.lit("stop")).cast("int").alias("a"))
    with pytest.raises(Exception, match="stop"):
        store.write(bad, "gold", "t", "three")
    assert rows_of(store.read("gold", "t")) == [(1,), (2,)] and store.described("gold", "t")["comment"] == "two"
    store.write(frame("a int", (4,)), "gold", "t")
    assert rows_of(store.read("gold", "t")) == [(4,)] and store.described("gold", "t")["comment"] == ""


def test_registered_tables_lose_no_cell(spark):
    df = spark.createDataFrame([(1, "teams.csv", "blob", None, 1, "team_id,team_name,team_id\n1,x,2,more\n3,y,,")], SCHEMA)
    teams = registry.blob_tables(spark, df, {"relational": 1}, "relational", "version")["teams"]
    assert rows_of(teams.select("team_id", "team_name", RESCUED)) == [("1", "x", '{"_extra2":"2","_extra3":"more"}'), ("3", "y", None)]
