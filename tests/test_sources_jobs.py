import os
import time
from collections import Counter
from contextlib import contextmanager

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalogue import jobs
from riskbook.plans.property_jobs import enrich_loan_book_job, merge_property_risk_job
from riskbook.plans.regulatory_jobs import property_report_job
from riskbook.sources import publish, readers, schemas

DAY = "20230427"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_schema_sizes():
    assert len(schemas.PROPERTY) == 13 and len(schemas.ENERGY_RATING) == 4 and len(schemas.FLOOD_INDEX) == 42
    assert len(schemas.LOAN_BOOK) == 17 and len(schemas.ENRICHED_LOAN_BOOK) == 73
    assert len(set(schemas.ENRICHED_LOAN_BOOK.fieldNames())) == 73


def energy_file(path, lines):
    path.write_text("ecad_id,ber_rating,ber_rating_kwh,co2_emission\n" + "".join(line + "\n" for line in lines))
    return str(path)


def test_land_csv_sorts_out_bad_lines(spark, tmp_path):
    lines = ["1,A1,20.5,3", "2,B2", "3,C1,100,4,extra", "x,D1,5,5", "5,E1,bad,6", "6,,,", '7,"F",300,1']
    source = energy_file(tmp_path / "energy.csv", lines)
    valid, rejects = readers.land_csv(spark, source, schemas.ENERGY_RATING, str(tmp_path / "staged"))
    assert valid.columns == schemas.ENERGY_RATING.fieldNames()
    assert rows(valid) == Counter([(1, "A1", 20.5, 3.0), (6, None, None, None), (7, "F", 300.0, 1.0)])
    # The rows that a query sees do not depend on the columns it asks for.
    assert valid.select("ecad_id").count() == 3 and valid.count() + rejects.count() == len(lines)
    assert {r[0] for r in rejects.select(schemas.CORRUPT).collect()} == set(lines[1:5])

    base = str(tmp_path / "rejected")
    assert publish.write_rejects(rejects, base, DAY, "energy_rating")
    assert not publish.write_rejects(rejects.limit(0), base, DAY, "ecad")
    # Rejects of an earlier run go when a mended file has none.
    assert publish.write_rejects(rejects, base, DAY, "mended")
    assert not publish.write_rejects(rejects.limit(0), base, DAY, "mended")
    assert os.listdir(f"{base}/dt={DAY}") == ["source=energy_rating"]
    summary = publish.reject_summary({"energy_rating": rejects, "ecad": rejects.limit(0)})
    assert rows(summary) == Counter([("energy_rating", 4), ("ecad", 0)])


def test_header_in_another_order_is_an_error(spark, tmp_path):
    path = tmp_path / "energy.csv"
    path.write_text("ecad_id,ber_rating,co2_emission,ber_rating_kwh\n1,A1,20.5,3\n")
    with pytest.raises(Exception, match="header"):
        readers.land_csv(spark, str(path), schemas.ENERGY_RATING, str(tmp_path / "staged"))


def test_header_only_file(spark, tmp_path):
    source = energy_file(tmp_path / "energy.csv", [])
    valid, rejects = readers.land_csv(spark, source, schemas.ENERGY_RATING, str(tmp_path / "staged"))
    assert valid.count() == 0 and rejects.count() == 0


def test_published_days(spark, tmp_path):
    base = str(tmp_path / "book")
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, base)
    for day, n in (("20230426", 3), ("20230428", 5), ("20230427", 4)):
        publish.publish(spark.range(n), base, day)
    publish.publish(spark.range(2), base, "20230426")
    assert publish.published_days(spark, base) == ["20230426", "20230427", "20230428"]
    assert publish.read_published(spark, base).count() == 5
    assert rows(publish.read_published(spark, base, "20230426")) == Counter([(0, "20230426"), (1, "20230426")])
    with pytest.raises(ValueError):
        publish.publish(spark.range(1), base, "2023-04-26")


def test_all_part_files_are_read(spark, tmp_path):
    base = str(tmp_path / "parts")
    publish.publish(spark.range(100).repartition(7), base, DAY, "csv", max_records_per_file=5)
    parts = [f for f in os.listdir(f"{base}/dt={DAY}") if f.startswith("part-")]
    assert len(parts) >= 20
    assert publish.read_published(spark, base, DAY, fmt="csv").count() == 100
    publish.publish(spark.range(100).repartition(7), base, DAY, "csv", single_file=True)
    assert len([f for f in os.listdir(f"{base}/dt={DAY}") if f.startswith("part-")]) == 1


def test_text_columns(spark):
    df = spark.createDataFrame(
        [("1", " N/A ", "10"), ("2", "NODATA!", "x"), ("3", "Good ", ""), ("4", "", "1e2")], "id string, t string, n string"
    )
    plain = readers.blank_to_null(df, ["t"])
    assert rows(plain.select("t")) == Counter([(" N/A ",), ("NODATA!",), ("Good ",), (None,)])
    spellings = readers.MISSING_SPELLINGS + readers.NO_DATA_SPELLINGS
    trimmed = readers.blank_to_null(df, spellings=spellings, trim=True)
    numbers = spark.createDataFrame(
        [("67",), ("67.0",), ("6.7e1",), ("45.5",), ("",), ("x",), ("148000000000.0",), ("9223372036854775807",)], "u string"
    )
    types = {"u": "bigint"}
    assert rows(readers.typed_columns(numbers, types)) == Counter(
        {(67,): 3, (None,): 3, (148000000000,): 1, (9223372036854775807,): 1}
    )
    assert rows(readers.lost_values(readers.blank_to_null(numbers), types)) == Counter([("u", 7, 2)])
    assert readers.lost_values(numbers, {"absent": "int"}).count() == 0
    clean = readers.typed_columns(trimmed, {"ID": "int", "n": "double", "absent": "int"})
    assert rows(clean) == Counter([(1, None, 10.0), (2, None, None), (3, "Good", None), (4, None, 100.0)])
    typed = readers.typed_columns(df, {"id": "int"})
    assert typed.schema["id"].dataType.simpleString() == "int"


def test_scratch_path(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (publish.scratch_path(spark, "t") for _ in range(2))
    assert first.startswith(shared) and first != second


def csv_file(path, schema, records):
    names = schema.fieldNames()
    lines = [",".join(names)] + [",".join(str(r.get(n, "")) for n in names) for r in records]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_property_jobs(spark, tmp_path):
    root = str(tmp_path)
    properties = csv_file(tmp_path / "p.csv", schemas.PROPERTY, [
        {"ecad_id": 1, "building_id": 10, "address_line_1": "1 High St"},
        {"ecad_id": 2, "building_id": 10, "address_line_1": "2 High St"},
        {"ecad_id": "bad", "building_id": 10},
    ])
    energy = csv_file(tmp_path / "e.csv", schemas.ENERGY_RATING, [
        {"ecad_id": 1, "ber_rating": "A2", "ber_rating_kwh": 100}, {"ecad_id": 2, "ber_rating": "G", "ber_rating_kwh": 600},
    ])
    flood = csv_file(tmp_path / "f.csv", schemas.FLOOD_INDEX, [{"ecad_id": 10, "floodability_index_ud": "green"}])
    loans = csv_file(tmp_path / "l.csv", schemas.LOAN_BOOK, [
        {"ecad_id": 1, "Asset_id": 7, "Initial_Borrow_Capital": 1000.5, "Rate/Margin": 0.02},
        {"ecad_id": 99, "Asset_id": 8, "Initial_Borrow_Capital": 5},
    ])
    merged_rows = merge_property_risk_job(
        spark, properties, energy, flood, f"{root}/merged", f"{root}/rejected", f"{root}/staged", DAY
    )
    assert merged_rows == 2
    assert os.listdir(f"{root}/rejected/dt={DAY}") == ["source=ecad"]
    enriched_rows = enrich_loan_book_job(
        spark, f"{root}/merged", loans, f"{root}/enriched", f"{root}/enriched_csv", f"{root}/rejected",
        f"{root}/staged", DAY,
    )
    assert enriched_rows == 2
    book = publish.read_published(spark, f"{root}/enriched_csv", DAY, "csv", schemas.ENRICHED_LOAN_BOOK)
    assert len(book.columns) == 74
    assert rows(book.select("ecad_id", "Asset_id", "Initial_Borrow_Capital")) == Counter([(1, 7, 1000.5), (2, None, None)])
    property_report_job(spark, f"{root}/enriched", f"{root}/reports", DAY)
    matrix = publish.read_published(spark, f"{root}/reports/pillar3_matrix", DAY, "csv")
    first = matrix.where(F.col("row_no") == 1).first()
    assert (first["total"], first["label_a"], first["band_le_100"], first["label_g"]) == ("1000.5", "1000.5", "1000.5", None)

    with_loans = merge_property_risk_job(
        spark, properties, energy, flood, f"{root}/merged4", f"{root}/rejected", f"{root}/staged", DAY, loans_csv=loans
    )
    assert with_loans == 1


def test_reports_of_an_empty_day(spark, tmp_path):
    book = spark.createDataFrame([], schemas.ENRICHED_LOAN_BOOK)
    publish.publish(book, f"{tmp_path}/enriched", DAY)
    property_report_job(spark, f"{tmp_path}/enriched", f"{tmp_path}/reports")
    assert publish.read_published(spark, f"{tmp_path}/reports/pillar3_matrix", DAY, "csv").count() == 10


def test_inner_merge_compares_numbers(spark, tmp_path):
    from riskbook.plans.portfolio_jobs import portfolio_merge_job

    def portfolio_file(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    latlong = portfolio_file("l.csv", ["ID,UPRN,EASTING,NORTHING,LATITUDE,LONGITUDE", "7,1,0,0,51.5,-2.5", "8,1,0,0,52,-2"])
    portfolio = portfolio_file("p.csv", ["ID,UPRN,EASTING", "007,100,5", " 8,100,6", "x,300,7"])
    for scores, ids in ((["7,1,9", "8,1,9"], {"007", " 8"}), (["7,1,9", "x,1,9"], set())):
        path = portfolio_file("s.csv", ["ID,UPRN,SCORE", *scores])
        out = f"{tmp_path}/{len(ids)}"
        assert portfolio_merge_job(spark, portfolio, path, latlong, f"{out}/m", f"{out}/s", DAY) == len(ids)
        got = publish.read_published(spark, f"{out}/m/parquet").select("id").collect()
        assert {r["id"] for r in got} == ids


def test_golden_duplicates(spark):
    """The shape of a known pair of lists: 26 property numbers twice and 3 three times, 61 ids behind them."""
    from riskbook.operators.quality import duplicate_keys, duplicate_members, duplicate_report

    uprns = [u for u in range(26) for _ in range(2)] + [u for u in range(26, 29) for _ in range(3)] + list(range(29, 60))
    df = spark.createDataFrame([(i, u) for i, u in enumerate(uprns)], "id int, uprn int")
    assert Counter(r["count"] for r in duplicate_keys(df, ["uprn"]).collect()) == {2: 26, 3: 3}
    members = duplicate_members(df)
    assert members.count() == 61
    assert Counter(Counter(r["uprn"] for r in members.collect()).values()) == {2: 26, 3: 3}
    assert Counter(r["key"] for r in duplicate_report(df).collect()) == {"uprn": 29}


def test_command_line(spark, tmp_path, capsys):
    from riskbook.__main__ import main

    def portfolio_file(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    files = {
        "portfolio": portfolio_file("p.csv", ["ID,UPRN,EASTING", "1,100,5", "2,100,6", ",300,7"]),
        "risk-scores": portfolio_file("s.csv", ["ID,UPRN,SCORE", "1,100,9"]),
        "latlong": portfolio_file("l.csv", ["ID,UPRN,EASTING,NORTHING,LATITUDE,LONGITUDE", "1,100,0,0,51.5,-2.5", "2,100,0,0,52,-2"]),
    }
    arguments = ["--merged", f"{tmp_path}/m", "--staged", f"{tmp_path}/s", "--run-date", DAY]
    for name, path in files.items():
        arguments += [f"--{name}-csv", path]
    main(["convert-portfolio", "--reports", f"{tmp_path}/r", *arguments])
    assert "2 rows written" in capsys.readouterr().out
    merged = publish.read_published(spark, f"{tmp_path}/m/csv", DAY, "csv")
    assert merged.columns == ["id", "uprn", "easting", "score", "latitude", "longitude", "dt"]
    assert rows(merged.select("id", "score", "latitude")) == Counter([("1", "9", "51.5"), ("2", None, "52")])
    ids = publish.read_published(spark, f"{tmp_path}/r/duplicate_uprn_ids", DAY, "csv").drop("dt")
    assert rows(ids) == Counter([("100", "2", "1"), ("100", "2", "2")])
    with pytest.raises(SystemExit):
        main(["convert-portfolio", "--run-date", DAY])


def test_published_texts_are_compressed(spark, tmp_path):
    wide = spark.range(20_000).selectExpr("id", *[f"CAST(id % 7 AS string) AS a_long_column_name_{i}" for i in range(20)])
    for fmt in ("csv", "json"):
        base = str(tmp_path / fmt)
        publish.publish(wide, base, DAY, fmt)
        parts = [f"{base}/dt={DAY}/{f}" for f in os.listdir(f"{base}/dt={DAY}") if f.startswith("part-")]
        assert all(f.endswith(f".{fmt}.gz") for f in parts)
        plain = sum(len(line) for line in spark.read.text(f"{base}/dt={DAY}").toPandas()["value"])
        assert sum(map(os.path.getsize, parts)) * 4 < plain
        again = publish.read_published(spark, base, DAY, fmt, wide.schema).drop("dt")
        assert again.exceptAll(wide).isEmpty() and again.count() == 20_000


def shuffle_files(spark):
    """Names of the files that shuffles of the session hold on this machine's disk."""
    files, names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator(), set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_with_their_write(spark, tmp_path):
    """Otherwise those of all writes of a job lie side by side until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    session, before = spark.conf.get(name), shuffle_files(spark)
    moved = spark.range(20_000).selectExpr("id % 97 AS k", "id").repartition(5, "k")
    for fmt in ("parquet", "csv", "json"):
        publish.publish(moved, f"{tmp_path}/{fmt}", DAY, fmt)
    left = shuffle_files(spark) - before
    for _ in range(50):  # files are removed beside the session's work
        if not left:
            break
        time.sleep(0.1)
        left &= shuffle_files(spark)
    assert not left and spark.conf.get(name) == session
    for fmt in ("parquet", "csv", "json"):
        assert publish.read_published(spark, f"{tmp_path}/{fmt}", DAY, fmt).count() == 20_000


def test_published_tables_are_small(spark, tmp_path):
    """A portfolio's texts and numbers, four rows of an id each, as the merge leaves them."""
    df = spark.range(0, 40_000, 1, 2).selectExpr("id div 4 AS id", *[f"CAST(xxhash64(id div 4) % 100000 + {i} AS string) AS column_{i}" for i in range(20)])

    def size(folder):
        return sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("part-"))

    publish.publish(df, f"{tmp_path}/parquet", DAY)
    df.write.parquet(f"{tmp_path}/snappy", compression="snappy")
    assert size(f"{tmp_path}/parquet/dt={DAY}") < 0.9 * size(f"{tmp_path}/snappy")
    publish.publish(df, f"{tmp_path}/json", DAY, "json")
    df.write.option("zlib.compress.level", "BEST_SPEED").json(f"{tmp_path}/fast", compression="gzip")
    assert size(f"{tmp_path}/json/dt={DAY}") < 0.8 * size(f"{tmp_path}/fast")
    assert publish.read_published(spark, f"{tmp_path}/parquet", DAY).drop("dt").exceptAll(df).isEmpty()

    codec = "spark.sql.parquet.compression.codec"
    spark.conf.set(codec, "gzip")
    try:
        publish.publish(df.limit(10), f"{tmp_path}/named", DAY)
    finally:
        spark.conf.unset(codec)
    assert any(f.endswith(".gz.parquet") for f in os.listdir(f"{tmp_path}/named/dt={DAY}"))


def test_columns_of_many_values_have_no_dictionary(spark, tmp_path):
    """Values that a merge repeats lie close together; columns of few values keep their dictionary."""
    rows_of_ids = spark.range(0, 200_000, 1, 2).selectExpr(
        "id div 4 AS id",
        "CAST(id % 5 AS string) AS few",
        *[f"CAST(xxhash64(id div 4) % 50000 + {i} AS string) AS many_{i}" for i in range(6)],
        *[f"CAST(xxhash64(id div 4) % 50000 + {i} AS double) AS number_{i}" for i in range(6)],
    )
    publish.publish(rows_of_ids, f"{tmp_path}/t", DAY)
    rows_of_ids.write.parquet(f"{tmp_path}/plain", compression="zstd")

    def parts(folder):
        return [f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("part-")]

    published = parts(f"{tmp_path}/t/dt={DAY}")
    assert sum(map(os.path.getsize, published)) < 0.75 * sum(map(os.path.getsize, parts(f"{tmp_path}/plain")))
    group = pq.ParquetFile(published[0]).metadata.row_group(0)
    encodings = {group.column(k).path_in_schema: "".join(group.column(k).encodings) for k in range(group.num_columns)}
    assert "DICTIONARY" in encodings["few"] and "DICTIONARY" not in encodings["many_0"] + encodings["number_0"]
    assert publish.read_published(spark, f"{tmp_path}/t", DAY).drop("dt").exceptAll(rows_of_ids).isEmpty()


def test_conversion_query_leaves_no_used_files(spark, tmp_path):
    """The files made for the job and its staged rows are gone before layers are made; what it publishes stays."""
    few = spark.range(1, 6)
    few.selectExpr(
        "id AS o_orderkey", "id % 2 AS o_custkey", "1.5D AS o_totalprice", "'HIGH' AS o_orderpriority", "'O' AS o_orderstatus"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    few.selectExpr(
        "id AS l_orderkey", "id AS l_suppkey", "9.5D AS l_extendedprice", "1 AS l_linenumber", "0.5D AS l_discount",
        "'A' AS l_returnflag", "3.0D AS l_quantity",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    few.selectExpr("id AS doc_id", "id AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    root = jobs._converted(spark, str(tmp_path))
    assert publish.names_below(spark, root) == ["merged", "reports"]
    assert publish.names_below(spark, f"{root}/merged") == ["csv", "json", "parquet"]
    counts = {fmt: publish.read_published(spark, f"{root}/merged/{fmt}", jobs.DAY, fmt).count() for fmt in ("csv", "json", "parquet")}
    assert counts == {"csv": 5, "json": 5, "parquet": 5}


def test_wide_rows_are_written_step_by_step(spark, tmp_path, monkeypatch):
    """One generated method over many columns is too large to be compiled; narrow rows keep theirs, and so does the session."""
    limit, seen = "spark.sql.codegen.maxFields", []
    before = spark.conf.get(limit, None)

    def plan(columns: int) -> str:
        df = spark.range(3).selectExpr(*[f"id + {k} AS c{k}" for k in range(columns)])
        return df._jdf.queryExecution().executedPlan().toString()

    with publish.wide_rows(spark):
        assert "*(1) Project" not in plan(30)
        assert "*(1) Project" in plan(3)
    assert "*(1) Project" in plan(30)

    spark.conf.set(limit, "7")
    try:
        with pytest.raises(InterruptedError), publish.wide_rows(spark):
            assert spark.conf.get(limit) == "7"
            raise InterruptedError
        assert spark.conf.get(limit) == "7"
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)

    @contextmanager
    def recorded(session):
        seen.append(session)
        yield

    monkeypatch.setattr(publish, "wide_rows", recorded)
    monkeypatch.setattr(readers, "wide_rows", recorded)
    publish.publish(spark.range(3), f"{tmp_path}/t", DAY)
    spark.range(3).selectExpr("cast(id AS int) AS ecad_id", "'A1' AS ber_rating", "1.0D AS ber_rating_kwh", "2.0D AS co2_emission").write.option(
        "header", True
    ).csv(f"{tmp_path}/in")
    valid, rejected = readers.land_csv(spark, f"{tmp_path}/in", schemas.ENERGY_RATING, f"{tmp_path}/staged")
    assert (valid.count(), rejected.count(), len(seen)) == (3, 0, 2)


def test_a_write_has_several_tasks_per_core(spark, tmp_path):
    """Files are not packed to as many parts as cores; the session's settings are as before."""
    spark.range(0, 64, 1, 64).write.parquet(str(tmp_path / "in"))
    publish.publish(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "out"), DAY)
    assert len(list(tmp_path.glob("out/*/part-*"))) >= 2 * spark.sparkContext.defaultParallelism
    assert spark.read.parquet(str(tmp_path / "out")).count() == 64
    for name in ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum"):
        assert spark.conf.get(name, None) is None
