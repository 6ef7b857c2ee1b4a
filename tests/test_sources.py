import pytest
from pyspark.sql import functions as F

from orderlake.contracts import NULL_TOKENS, ContractError
from orderlake.sources import readers, sinks, staging

from rows import HEADER, LINES, PRODUCTS, orders_csv


def test_orders_are_typed_and_positioned(spark, tmp_path):
    (tmp_path / "o.csv").write_text(orders_csv())
    df = readers.read_orders(spark, str(tmp_path / "o.csv"))
    rows = df.orderBy("pos").collect()
    assert [r.order_id for r in rows] == [line[:2] for line in LINES]
    assert rows[0].product_name == 'Screen 24"'
    assert dict(df.dtypes)["quantity"] == "bigint" and dict(df.dtypes)["total_harga"] == "double"
    assert rows[4].total_harga is None and rows[6].customer_email is None
    assert rows[10].customer_email == "none"


def test_columns_bind_by_name_and_extras_pass(spark, tmp_path):
    names = HEADER.split(",")[::-1] + ["note"]
    values = dict(zip(HEADER.split(","), "B1,P1,Desk,Home,2,5.0,2024-01-01,Solo,web,pending,x".split(",")))
    values["note"] = "hi"
    (tmp_path / "o.csv").write_text(",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n")
    row = readers.read_orders(spark, str(tmp_path / "o.csv")).first()
    assert (row.order_id, row.quantity, row.total_harga, row.note) == ("B1", 2, 5.0, "hi")


def test_missing_column_is_named(spark, tmp_path):
    (tmp_path / "o.csv").write_text(HEADER.replace(",kota", "") + "\n")
    with pytest.raises(ContractError, match="kota"):
        readers.read_orders(spark, str(tmp_path / "o.csv"))


def test_missing_file(spark, tmp_path):
    with pytest.raises(ContractError, match="nowhere"):
        readers.read_orders(spark, str(tmp_path / "nowhere.csv"))


def test_files_with_other_headers_fail_instead_of_shifting(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        readers.read_csv(spark, str(tmp_path)).collect()


def test_null_tokens_match_whole_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text("i,v\n" + "".join(f'{i},"{t}"\n' for i, t in enumerate(NULL_TOKENS)))
    assert {r.v for r in readers.read_csv(spark, str(tmp_path / "t.csv")).collect()} == {None}
    (tmp_path / "k.csv").write_text("v\n NA \nna\nNone of it\n")
    kept = [r.v for r in readers.read_csv(spark, str(tmp_path / "k.csv")).orderBy("pos").collect()]
    assert kept == [" NA ", "na", "None of it"]


def test_numbers(spark, tmp_path):
    (tmp_path / "n.csv").write_text("q,p\n3,1\n3.0,2.5\n2.5,-1e3\nmany,x\n,NaN\n9007199254740993,0\n")
    df = readers.read_csv(spark, str(tmp_path / "n.csv"), numbers={"q": "bigint", "p": "double"})
    rows = [(r.q, r.p) for r in df.orderBy("pos").collect()]
    assert rows == [
        (3, 1.0), (3, 2.5), (None, -1000.0), (None, None), (None, None), (9007199254740993, 0.0),
    ]


def test_position_follows_files_whatever_their_size(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n0\n1\n")
    (tmp_path / "b.csv").write_text("v\n" + "".join(f"{i}\n" for i in range(2, 5000)))
    df = readers.read_csv(spark, str(tmp_path), numbers={"v": "bigint"})
    assert [r.v for r in df.orderBy("pos").collect()] == list(range(5000))


def test_position_over_splits_of_one_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n" + "".join(f"{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8192)
    try:
        df = readers.read_csv(spark, str(tmp_path / "a.csv"), numbers={"v": "bigint"})
        assert df.rdd.getNumPartitions() > 4
        assert [r.v for r in df.orderBy("pos").collect()] == list(range(20000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n"x\ny",1\nz,2\n')
    df = readers.read_csv(spark, str(tmp_path / "m.csv"), multi_line=True)
    assert [r.a for r in df.orderBy("pos").collect()] == ["x\ny", "z"]


def test_parquet_position(spark, tmp_path):
    spark.range(0, 1000, 1, 4).write.parquet(str(tmp_path / "p"))
    df = readers.read_parquet(spark, str(tmp_path / "p"), ["id"])
    assert [r.id for r in df.orderBy("pos").collect()] == list(range(1000))
    with pytest.raises(ContractError, match="nope"):
        readers.read_parquet(spark, str(tmp_path / "p"), ["nope"])


def test_size_is_observed_in_passing(spark, tmp_path):
    df, size = staging.stage_counted(spark.range(7).selectExpr("id", "id > 4 AS _high"), "sized", high=F.count_if("_high"))
    assert df.columns == ["id"] and df.count() == 7 and size == {"rows": 7, "columns": 2, "high": 2}


def test_staging_uses_the_session_folder(spark):
    assert staging.staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(3), "three")
    assert all(spark.conf.get("spark.checkpoint.dir") in path for path in staged.inputFiles())
    assert staged.count() == 3


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "p.csv").write_text(PRODUCTS)
    df = spark.sql(
        """SELECT 'a "b", c' AS t, 15000000D AS d, 1.5D AS f, CAST(NULL AS DOUBLE) AS n,
           TIMESTAMP_NTZ '2024-07-15 10:00:00' AS ts, 1 AS pos"""
    )
    for _ in range(2):
        sinks.write_csv(df, str(tmp_path / "out"), single_file=True)
    part = next((tmp_path / "out").glob("part-*.csv"))
    assert part.read_text() == 't,d,f,n,ts\n"a ""b"", c",15000000.0,1.5,,2024-07-15 10:00:00\n'
    back = readers.read_csv(spark, str(tmp_path / "out"), numbers={"d": "double"}).first()
    assert (back.t, back.d, back.n) == ('a "b", c', 15000000.0, None)


def test_tables_are_replaced_together(spark, monkeypatch):
    def both(n):
        return {"replaced": spark.range(n), "counted": spark.range(1).select(F.lit(n).alias("n"))}

    def read():
        return spark.table("replaced").count(), spark.table("counted").first().n

    spark.range(9).write.mode("overwrite").saveAsTable("default.replaced")
    for n in (1, 3, 5):
        sinks.replace_tables(both(n))
        assert read() == (n, n)
    assert len(spark.sql("SHOW PARTITIONS replaced__versions").collect()) == 2
    begun = spark.table("replaced")
    sinks.replace_tables(both(6))
    assert begun.count() in (5, 6) and read() == (6, 6)

    write, done = sinks.append_version, []

    def failing(df, name, version):
        if done:
            raise OSError("disk")
        done.append(write(df, name, version))

    monkeypatch.setattr(sinks, "append_version", failing)
    with pytest.raises(OSError):
        sinks.replace_tables(both(7))
    assert read() == (6, 6)
    monkeypatch.undo()
    sinks.replace_tables(both(8))
    assert read() == (8, 8) and len(spark.sql("SHOW PARTITIONS replaced__versions").collect()) == 2


def test_two_publishers_of_one_run(spark, tmp_path):
    from orderlake.contracts import PublishConflict

    root = str(tmp_path / "lake")
    sinks.publish({"a": spark.range(1)}, root, "r0")
    first, second, other = (sinks.Attempt(spark, root, name) for name in ("r1", "r1", "r2"))
    for n, now in enumerate((first, second, other)):
        now.write("a", spark.range(n + 2))
    second.commit()
    with pytest.raises(PublishConflict, match="r1"):
        first.commit()
    other.commit()
    assert sinks.published_runs(spark, root) == ["r0", "r1", "r2"]
    assert sinks.published(spark, root, "a", every_run=True).count() == 1 + 3 + 4
    # A later rerun that has seen the run replaces it.
    sinks.publish({"a": spark.range(7)}, root, "r1")
    assert sinks.published(spark, root, "a", every_run=True).count() == 1 + 7 + 4
    left, right = (sinks.Attempt(spark, root, name) for name in ("r5", "r6"))
    left.commit(["batch"])
    with pytest.raises(PublishConflict):
        right.commit(["batch"])


def test_vacuum_removes_replaced_attempts(spark, tmp_path):
    from datetime import timedelta

    root = str(tmp_path / "lake")
    for n in range(4):
        sinks.publish({"a": spark.range(n + 1)}, root, "r1", batches=[f"b{n}"])
    reader = sinks.published(spark, root, "a")
    assert sinks.vacuum(spark, root) == [] and reader.count() == 4
    sinks.publish({"a": spark.range(9)}, root, "r2")
    now = timedelta(seconds=-60)
    assert len(sinks.vacuum(spark, root, now)) == 3
    files = len(list((tmp_path / "lake" / "published").glob("*.json")))
    assert sinks.vacuum(spark, root, now) == []
    assert len(list((tmp_path / "lake" / "published").glob("*.json"))) < files
    assert reader.count() == 4 and sinks.published(spark, root, "a", every_run=True).count() == 13
    assert sinks.published_runs(spark, root) == ["r1", "r2"]
    assert sinks.published_batches(spark, root) == {"b0", "b1", "b2", "b3"}
    sinks.publish({"a": spark.range(2)}, root, "r3")
    assert sinks.published(spark, root, "a", every_run=True).count() == 15


def test_failed_publish_leaves_the_previous_run(spark, tmp_path):
    root = str(tmp_path / "lake")
    sinks.publish({"a": spark.range(2), "b": spark.range(1)}, root, "r1")
    bad = spark.range(1).selectExpr("raise_error('boom') AS id")
    with pytest.raises(Exception, match="boom"):
        sinks.publish({"a": spark.range(5), "b": bad}, root, "r2")
    assert sinks.published(spark, root, "a").count() == 2
    sinks.publish({"a": spark.range(5)}, root, "r3")
    assert sinks.published(spark, root, "a").count() == 5
    assert sinks.published(spark, root, "a", every_run=True).count() == 7
    with pytest.raises(ContractError):
        sinks.published(spark, root, "c")


def test_hot_month_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(0, 60000, 1, 8).selectExpr(
        "IF(id % 10 = 0, concat('2024-0', id % 9 + 1), '2024-05') AS order_month",
        "TIMESTAMP_NTZ '2024-05-01' + make_dt_interval(0, 0, 0, id % 977) AS tanggal_order",
        "sha2(CAST(id AS string), 256) AS order_id",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        sinks.by_month(df).parquet(str(tmp_path / "m"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(str(tmp_path / "m"))
    assert back.count() == 60000
    hot = list((tmp_path / "m" / "order_month=2024-05").glob("*.parquet"))
    months = [m for m in (tmp_path / "m").glob("order_month=*") if not m.name.endswith("-05")]
    # A month that shares a hash partition with the hot one is split with it.
    files = [len(list(m.glob("*.parquet"))) for m in months]
    assert len(hot) > 4 and sorted(files)[len(files) // 2] == 1
    for part in hot[:2]:
        times = [r.tanggal_order for r in spark.read.parquet(str(part)).collect()]
        assert times == sorted(times)


def test_uneven_rows(spark, tmp_path):
    (tmp_path / "u.csv").write_text('a,b,c\n1,2\n\n7,"8, ""x"" 9"\n7,8,9\n')
    df = readers.read_csv(spark, str(tmp_path / "u.csv"))
    rows = df.orderBy("pos").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [("1", "2", None), ("7", '8, "x" 9', None), ("7", "8", "9")]
    assert df.count() == 3 and [r.c for r in df.select("c").collect()] == [None, None, "9"]


@pytest.mark.parametrize("text", ["a,b\n1,2\n3,4,5\n", 'a,b\n1,2\n"x\ny",3\n', 'a,b\n1,2\n3,"x\ny"\n'])
def test_rows_that_cannot_be_read_whole_fail(spark, tmp_path, text):
    (tmp_path / "u.csv").write_text(text)
    df = readers.read_csv(spark, str(tmp_path / "u.csv"))
    for read in (df, df.select("b")):
        with pytest.raises(Exception, match="ContractError"):
            read.collect()
    with pytest.raises(Exception, match="ContractError"):
        df.count()


def test_staged_folders_go_with_their_run(spark):
    from pathlib import Path

    def folders():
        return {p.name for p in Path(staging.staging_root(spark).removeprefix("file:")).glob("of-a-run-*")}

    with staging.staged_run(spark):
        assert staging.stage(spark.range(3), "of-a-run").count() == 3 and folders()
    assert not folders()
    with pytest.raises(ValueError), staging.staged_run(spark):
        staging.stage(spark.range(3), "of-a-run")
        raise ValueError
    assert not folders()


def test_rerun_of_a_published_run(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = spark.range(3).selectExpr("'2024-01' AS order_month", "id", "TIMESTAMP_NTZ '2024-01-01' AS tanggal_order", "'o' AS order_id")
    sinks.publish({"a": first, "b": spark.range(1)}, root, "r1", monthly=("a",))
    bad = spark.range(1).selectExpr("raise_error('boom') AS id")
    with pytest.raises(Exception, match="boom"):
        sinks.publish({"a": first.limit(1), "b": bad}, root, "r1", monthly=("a",))
    found = sinks.published(spark, root, "a")
    assert found.count() == 3 and found.columns == first.columns
    sinks.publish({"a": first.limit(2)}, root, "r1", monthly=("a",))
    assert sinks.published(spark, root, "a", every_run=True).count() == 2
    assert sinks.published_runs(spark, root) == ["r1"]


def test_java_number_suffixes_are_no_numbers(spark):
    from pyspark.sql import functions as F
    from orderlake.sources.readers import number

    texts = ["5d", "5f", "5.D", "0x1p3", "5", " 5.0 ", "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    read = [r[0] for r in df.select(number(F.col("t"), "double")).collect()]
    assert read == [None, None, None, None, 5.0, 5.0, 1000.0]
