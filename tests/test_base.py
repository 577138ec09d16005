import ast
import logging

import pytest
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from brindle.functions import lower_columns
from brindle.operators import bounded, column_list, preview, row_count, schema_report
from brindle.plans import credentials
from brindle.plans.config import load_settings, parse_env
from brindle.plans.job import main, run
from brindle.plans.queries import ORACLE_SQL, QUERIES
from brindle.sources import qualified_name, read_table, warehouse_spec

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("region", "nation", "part", "lineitem", "orders", "events", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_lower_keeps_order_nulls_and_case_rules(spark, caplog):
    df = spark.createDataFrame([(1, "AbC", 2), (2, None, 3), (3, "", 4)], "a int, SRC string, z int")
    assert [tuple(r) for r in lower_columns(df, ["SRC"]).collect()] == [(1, "abc", 2), (2, None, 3), (3, "", 4)]
    other = df.withColumnRenamed("SRC", "Src")
    with caplog.at_level(logging.WARNING):
        assert lower_columns(other, ["SRC"]).collect() == other.collect()
    assert "a, Src, z" in caplog.text
    assert lower_columns(other, ["SRC"], match="insensitive").columns == ["a", "Src", "z"]
    with pytest.raises(KeyError):
        lower_columns(other, ["SRC"], on_missing="error")


def test_lower_refuses_what_it_cannot_do(spark):
    with pytest.raises(ValueError):
        lower_columns(spark.createDataFrame([("a", "b")], "SRC string, src string"), ["SRC"])
    for kind in ("array<int>", "map<string,int>", "struct<x:int>"):
        with pytest.raises(TypeError):
            lower_columns(spark.createDataFrame([], T._parse_datatype_string(f"SRC {kind}")), ["SRC"])


@pytest.mark.parametrize("value,want", [("1", "1"), ("cast(1.5 as decimal(10,2))", "1.50"), ("true", "true"), ("1.5E10D", "1.5e10"), ("date'2024-01-02'", "2024-01-02"), ("X'4142'", "ab"), ("'ΑΣ'", "ας"), ("'ÀÉ'", "àé")])
def test_lower_of_scalars(spark, value, want):
    assert lower_columns(spark.sql(f"SELECT {value} AS SRC"), ["SRC"]).first()[0] == want


def test_bounds(spark):
    df = spark.range(51)
    assert row_count(bounded(df, order_by=["id"])).first()[0] == 50
    assert [r[0] for r in preview(bounded(df, order_by=["id"]), order_by=["id"]).collect()] == list(range(20))
    assert row_count(df.limit(0)).first()[0] == 0


def test_reports_count_in_one_scan(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(1, None, [1]), (2, "", None), (None, "x", None)], "a int, b string, c array<int>").coalesce(1)
    df = df.mapInArrow(counted, df.schema).withColumnRenamed("c", "c.d")
    assert [tuple(r) for r in schema_report(df).collect()] == [(0, "a", "int", 3, 1), (1, "b", "string", 3, 1), (2, "c.d", "array<int>", 3, 2)]
    assert seen.value == 3
    assert [tuple(r) for r in column_list(df).collect()] == [("a, b, c.d", 3)]
    assert [r.null_count for r in schema_report(df.select("a", "a").limit(0)).collect()] == [0, 0]
    assert schema_report(df.select()).count() == 0


def test_job(spark, capsys):
    got = run(spark.createDataFrame([(1, "AB")], "id int, SRC string"), order_by=["id"])
    assert [tuple(r) for r in got.collect()] == [(1, "ab")]
    said = capsys.readouterr().out
    assert "rows: 1" in said and said.index("as read") < said.index("SRC in lower case") < said.index("SRC alone")
    assert run(spark.range(3), order_by=["id"]).count() == 3


def test_job_scans_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(40).coalesce(1).selectExpr("cast(id as string) as SRC").mapInArrow(counted, "SRC string")
    assert run(df, order_by=["SRC"]).count() == 40 and seen.value == 40


def test_job_tells_its_target(spark, capsys):
    main(["--parquet", f"{SF}/nation.parquet", "--column", "n_name", "--order-by", "n_nationkey"])
    said = capsys.readouterr().out
    assert f"reading {SF}/nation.parquet" in said and "n_name alone" in said


def warehouse():
    """A class of its own, which travels to workers whole."""

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def read(self, partition):
            query = self.options["query"]
            most = int(query.rpartition(" LIMIT ")[2]) if " LIMIT " in query else 60
            yield from ((i, f"Row {i}", repr(sorted(self.options.items()))) for i in range(min(most, 60)))

    class Warehouse(DataSource):
        """Stands in for the warehouse's connector: 60 rows, of which the query's limit is kept; options come as rows."""

        @classmethod
        def name(cls):
            return "net.snowflake.spark.snowflake"

        def schema(self):
            return "N int, SRC string, options string"

        def reader(self, schema):
            return Reader(dict(self.options))

    return Warehouse


def test_warehouse_read_end_to_end(spark, tmp_path, monkeypatch, capsys):
    """From settings and a key file through the reader to the lower-cased previews, with the limit in the source."""
    key = tmp_path / "key"
    key.write_text(pem("PRIVATE KEY"))
    for k, v in {**BASE, "SNOWFLAKE_KEY_PATH": str(key), "SNOWFLAKE_ROLE": "r"}.items():
        monkeypatch.setenv(k, v)
    spark.dataSource.register(warehouse())
    main(["--order-by", "N"])
    said = capsys.readouterr().out
    assert "reading database.schema.table at account.snowflakecomputing.com" in said and "rows: 50" in said
    assert "Row 0" in said and "row 19" in said and "row 20" not in said and "null_count" in said
    options = {"sfURL": "account.snowflakecomputing.com", "sfRole": "r", "pem_private_key": pem("PRIVATE KEY"), "k": "v"}
    for limit, n in ((50, 50), (None, 60)):
        spec = warehouse_spec(options, "d", "s", "t", limit)
        rows = read_table(spark, spec).collect()
        assert len(rows) == n
        seen = dict(ast.literal_eval(rows[0].options))
        assert {k.lower(): v for k, v in seen.items()} == {k.lower(): v for k, v in spec.options.items()}


def test_names_and_query_text():
    assert qualified_name("a", "B_1", "c$") == "a.B_1.c$"
    with pytest.raises(ValueError):
        qualified_name("a", "b; drop", "c")
    assert warehouse_spec({}, "d", "s", "t", 50).options["query"] == "SELECT * FROM d.s.t LIMIT 50"


BASE = {f"SNOWFLAKE_{k}": k.lower() for k in ("ACCOUNT", "USER", "DATABASE", "SCHEMA", "WAREHOUSE", "TABLE")}


def test_settings(tmp_path):
    s = load_settings(BASE)
    assert s.url == "account.snowflakecomputing.com" and "sfRole" not in s.reader_options({})
    s = load_settings({**BASE, "SNOWFLAKE_URL": "u", "SNOWFLAKE_ROLE": "r"})
    assert s.reader_options({"k": "v"}) == {"sfURL": "u", "sfUser": "user", "sfDatabase": "database", "sfSchema": "schema", "sfWarehouse": "warehouse", "k": "v", "sfRole": "r"}
    with pytest.raises(ValueError, match="SNOWFLAKE_ACCOUNT.*SNOWFLAKE_TABLE"):
        load_settings({**BASE, "SNOWFLAKE_ACCOUNT": "", "SNOWFLAKE_TABLE": ""})
    f = tmp_path / "env"
    f.write_text("# c\n   \nexport SNOWFLAKE_ROLE='from file' # x\nSNOWFLAKE_USER=filed\n")
    s = load_settings({**BASE, "ENV_FILE": str(f)})
    assert (s.get("ROLE"), s.get("USER")) == ("from file", "user")
    assert parse_env("A = 1 # x\nB=\nC=\"a # b\"") == {"A": "1", "B": "", "C": "a # b"}
    with pytest.raises(ValueError):
        parse_env("nonsense")


def pem(kind):
    return f"-----BEGIN {kind}-----\nmade up\n-----END {kind}-----"


def test_keys(tmp_path, caplog):
    f = tmp_path / "k"

    def options(text, passphrase=None):
        f.write_bytes(text if isinstance(text, bytes) else text.encode())
        return credentials.key_options(str(f), passphrase)

    assert options(pem("PRIVATE KEY") + "\r\n \n") == {"pem_private_key": pem("PRIVATE KEY")}
    assert options(pem("PRIVATE KEY").replace("\n", "\r"))["pem_private_key"] == pem("PRIVATE KEY")
    assert options(pem("ENCRYPTED PRIVATE KEY"), "p")["pem_private_key_passphrase"] == "p"
    for text in (pem("ENCRYPTED PRIVATE KEY"), pem("RSA PRIVATE KEY"), "random", "-----BEGIN X"):
        with pytest.raises(ValueError):
            options(text)
    assert "\xff" in options(pem("PRIVATE KEY").replace("made", "\xff").encode("latin-1"))["pem_private_key"]
    with caplog.at_level(logging.INFO):
        options(pem("EC PRIVATE KEY"))
        options(pem("ENCRYPTED PRIVATE KEY"), "secret words")
    assert "without encryption" in caplog.text and "using an encrypted key" in caplog.text
    assert "made up" not in caplog.text and "secret words" not in caplog.text
    with pytest.raises(FileNotFoundError):
        credentials.key_options(str(tmp_path / "none"))
    with pytest.raises(OSError):
        credentials.key_options(str(tmp_path))
    with pytest.raises(ValueError):
        credentials.key_options("")
