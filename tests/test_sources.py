from __future__ import annotations

import re
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import SF_TINY
from pyspark.sql import functions as F

from ledgerlens import schema
from ledgerlens.plans import quality
from ledgerlens.sources import catalog, derived, files, ordering, pattern_text, warehouse
from ledgerlens.sources.format_benchmark import compare_formats

HEADER = "Timestamp,From Bank,Account,To Bank,Account,Received,Cur,Paid,Cur,Format,Flag"


def transfer_line(i, account="A", flag="0"):
    return f"2022/09/{1 + i % 28:02d} 00:{i % 60:02d},{i % 5},{account},7,B{i},1.5,Euro,2.25,Yen,Cash,{flag}"


@pytest.fixture
def small_splits(spark):
    """Cut files into many splits, as a large file would be."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(key) for key in keys]
    spark.conf.set(keys[0], "300")
    spark.conf.set(keys[1], "1")
    yield
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


@pytest.fixture(params=["broadcast", "shuffle"])
def join_way(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(ordering, "BROADCAST_BYTES", 0)


def test_transfers_are_numbered_in_file_order(spark, tmp_path, small_splits, join_way):
    # The larger file comes second by name; Spark reads large files first.
    (tmp_path / "a.csv").write_text("\n".join([HEADER] + [transfer_line(i) for i in range(40)]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEADER] + [transfer_line(i) for i in range(40, 200)]) + "\n")
    raw = files.read_transfers(spark, str(tmp_path))
    assert raw.rdd.getNumPartitions() > 4
    loaded, rejected = warehouse.load_transfers(raw)
    assert rejected is None
    got = {r.txn_id: r.to_account for r in loaded.collect()}
    assert got == {i + 1: f"B{i}" for i in range(200)}
    row = loaded.where("txn_id = 1").first()
    assert row.amount_received == Decimal("1.5000") and row.amount_paid == Decimal("2.2500")
    assert str(row.ts) == "2022-09-01 00:00:00"


def test_constraints(spark, tmp_path):
    lines = [transfer_line(0), transfer_line(1, account=""), transfer_line(2, flag="2")]
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    raw = files.read_transfers(spark, str(tmp_path))
    valid, rejected = warehouse.load_transfers(raw, strict=False)
    assert [r.txn_id for r in valid.collect()] == [1]
    assert {r.reason for r in rejected.collect()} == {
        "from_account is null", "is_laundering is not 0 or 1"
    }
    strict, _ = warehouse.load_transfers(raw)
    with pytest.raises(Exception, match="constraint"):
        strict.collect()


def test_malformed_number_fails_fast(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + transfer_line(0).replace("2.25", "x") + "\n")
    with pytest.raises(Exception):
        files.read_transfers(spark, str(tmp_path)).collect()


def test_pattern_rows_and_accounts(spark, tmp_path):
    (tmp_path / "p.csv").write_text("g,t," + HEADER + "\n3,STACK," + transfer_line(0, flag="1") + "\n")
    loaded, _ = warehouse.load_pattern_rows(files.read_pattern_rows(spark, str(tmp_path / "p.csv")))
    row = loaded.first()
    assert loaded.columns == schema.LAUNDERING_PATTERNS.names
    assert (row.pattern_id, row.pattern_group, row.pattern_type, row.is_laundering) == (1, 3, "STACK", 1)
    (tmp_path / "a.csv").write_text("Bank Name,Bank ID,Account Number,Entity ID,Entity Name\nN,5,A,E,X\n")
    assert files.read_accounts(spark, str(tmp_path / "a.csv")).first().bank_id == 5


BEGIN = re.compile(r"^BEGIN\s+LAUNDERING\s+ATTEMPT\s*-\s*(.+?)\s*$", re.I)


def blocks_by_definition(text):
    rows, rejects, group, kind = [], 0, 0, None
    for line in text.splitlines():
        if not line.strip():
            continue
        opened = BEGIN.match(line)
        if opened:
            group, kind = group + 1, opened.group(1).strip().upper()
        elif re.match(r"^END\s+LAUNDERING\s+ATTEMPT", line, re.I):
            kind = None
        elif kind is not None:
            if len(line.split(",")) == 11:
                rows.append((group, kind, *line.split(",")))
            else:
                rejects += 1
    return rows, rejects, group


def scheme_text(blocks):
    lines = ["stray,line", transfer_line(0)]
    for i in range(blocks):
        lines.append(f"BEGIN LAUNDERING ATTEMPT - fan-in: Max {i}  " if i % 3 else f"begin laundering attempt -Cycle {i}")
        lines += [transfer_line(i * 100 + j, flag="1") for j in range(1 + 7 * (i % 4))]
        lines += ["", "   ", "a,b,c,d,e,f,g,h,i,j", "a,b,c,d,e,f,g,h,i,j,k,l", ",,,,,,,,,,"]
        if i % 5:
            lines.append("END LAUNDERING ATTEMPT - x")
            lines.append(transfer_line(i))
    return "\n".join(lines) + "\n"


def test_scheme_text_over_many_splits(spark, tmp_path, small_splits, join_way):
    text = scheme_text(25)
    path = tmp_path / "schemes.txt"
    path.write_text(text)
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
    parsed = pattern_text.parse_scheme_text(spark, str(path))
    rows, rejects, groups = blocks_by_definition(text)
    assert sorted(tuple(r) for r in parsed.rows.collect()) == sorted(rows)
    assert parsed.rejects.count() == rejects
    assert {r.reason for r in parsed.rejects.collect()} == {"fields: 10", "fields: 12"}
    assert tuple(parsed.summary.first()) == (groups, len(rows))
    numbered = ordering.number_kept_rows(parsed.placed, "n").orderBy("n").drop("n").collect()
    assert [tuple(r) for r in numbered] == rows


def test_open_block_ends_with_its_file(spark, tmp_path):
    (tmp_path / "1.txt").write_text("BEGIN LAUNDERING ATTEMPT - STACK\n" + transfer_line(1) + "\n")
    (tmp_path / "2.txt").write_text(transfer_line(2) + "\nBEGIN LAUNDERING ATTEMPT - CYCLE\n" + transfer_line(3) + "\n")
    parsed = pattern_text.parse_scheme_text(spark, str(tmp_path))
    assert sorted((r.pattern_group, r.pattern_type, r.to_account) for r in parsed.rows.collect()) == [
        (1, "STACK", "B1"), (2, "CYCLE", "B3")
    ]
    typed = pattern_text.typed_scheme_rows(parsed, files.RAW_TIMESTAMP)
    assert typed.columns == schema.LAUNDERING_PATTERNS.names
    assert [(r.pattern_id, r.to_account) for r in typed.orderBy("pattern_id").collect()] == [
        (1, "B1"), (2, "B3")
    ]
    assert typed.where("ts is null or amount_paid <> 2.25").isEmpty()


def test_open_block_goes_on_in_the_next_file(spark, tmp_path):
    (tmp_path / "1.txt").write_text("BEGIN LAUNDERING ATTEMPT - STACK\n" + transfer_line(1) + "\n")
    (tmp_path / "2.txt").write_text(transfer_line(2) + "\nEND LAUNDERING ATTEMPT\n" + transfer_line(3) + "\n")
    parsed = pattern_text.parse_scheme_text(spark, str(tmp_path), blocks_span_files=True)
    assert sorted((r.pattern_group, r.pattern_type, r.to_account) for r in parsed.rows.collect()) == [
        (1, "STACK", "B1"), (1, "STACK", "B2")
    ]


def test_one_scheme_with_most_rows(spark, tmp_path):
    schemes = derived.laundering_patterns(spark, "/root/testdata/sf0.01").withColumn(
        "pattern_group", F.when(F.col("pattern_id") % 3 == 0, F.col("pattern_group")).otherwise(F.lit(7))
    ).withColumn("pattern_type", F.lit("STACK"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    derived.write_scheme_text(schemes, str(tmp_path / "t"), "yyyy/MM/dd HH:mm:ss")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parsed = pattern_text.parse_scheme_text(spark, str(tmp_path / "t"), blocks_span_files=True)
    sizes = schemes.groupBy("pattern_group").count().orderBy("pattern_group").collect()
    got = parsed.rows.groupBy("pattern_group").count().orderBy("pattern_group").collect()
    assert [r["count"] for r in got] == [r["count"] for r in sizes]


def test_scheme_text_without_blocks(spark, tmp_path):
    (tmp_path / "x.txt").write_text("nothing,here\n")
    parsed = pattern_text.parse_scheme_text(spark, str(tmp_path))
    assert parsed.rows.isEmpty() and tuple(parsed.summary.first()) == (0, 0)


def raw_millis(spark):
    day = 1_661_990_400_000  # 2022-09-01 00:00 UTC
    rows = [(i, day + i * 43_200_000 - 10_800_000, 1, "A", 2, "B", "1.5", "Euro", "2.5", "Yen", "Wire", 1)
            for i in range(8)]
    return spark.createDataFrame(
        rows,
        "txn_id bigint, timestamp bigint, from_bank int, from_account string, to_bank int, "
        "to_account string, amount_received string, receiving_currency string, amount_paid string, "
        "payment_currency string, payment_format string, is_laundering smallint",
    )


def test_warehouse_load_shifts_and_cuts(spark):
    loaded = warehouse.warehouse_transactions(raw_millis(spark), until="2022-09-02", shift_millis=10_800_000)
    rows = loaded.orderBy("txn_id").collect()
    assert loaded.columns == schema.TRANSACTIONS.names
    assert [str(r.ts) for r in rows] == [
        "2022-09-01 00:00:00", "2022-09-01 12:00:00", "2022-09-02 00:00:00", "2022-09-02 12:00:00"
    ]
    assert {str(r.txn_date) for r in rows} == {"2022-09-01", "2022-09-02"}
    assert dict(loaded.dtypes)["amount_paid"] == "decimal(20,4)"


def test_pattern_warehouse_load(spark):
    raw = raw_millis(spark).withColumnRenamed("txn_id", "pattern_id").withColumns(
        {"pattern_group": F.lit(1), "pattern_type": F.lit("STACK")}
    )
    loaded = warehouse.warehouse_patterns(raw, shift_millis=10_800_000)
    assert loaded.columns == schema.LAUNDERING_PATTERNS.names
    assert dict(loaded.dtypes)["is_laundering"] == "int"
    assert str(loaded.orderBy("pattern_id").first().ts) == "2022-09-01 00:00:00"
    assert loaded.count() == 8


def test_sketched_checks_are_close(spark):
    ledger = derived.transactions(spark, SF_TINY)
    schemes = derived.laundering_patterns(spark, SF_TINY)
    exact = {r.check_name: r.value for r in quality.sanity_checks(ledger, schemes).collect()}
    sketch = {r.check_name: r.value for r in quality.sanity_checks(ledger, schemes, approximate=True).collect()}
    assert exact.keys() == sketch.keys()
    assert exact["transactions row count"] == sketch["transactions row count"]
    assert abs(int(exact["transactions partition count"]) - int(sketch["transactions partition count"])) <= 3


def test_partitioned_files_reload_only_their_days(spark, tmp_path):
    path = str(tmp_path / "ledger")
    loaded = warehouse.warehouse_transactions(raw_millis(spark), shift_millis=10_800_000)
    warehouse.save_ledger_files(loaded, path)
    warehouse.save_ledger_files(loaded.where("txn_date = '2022-09-01'").limit(1), path)
    counts = {str(r.txn_date): r["count"] for r in spark.read.parquet(path).groupBy("txn_date").count().collect()}
    assert counts["2022-09-01"] == 1 and counts["2022-09-02"] == 2
    pruned = warehouse.active_window(spark.read.parquet(path), "2022-09-02")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date", plan)


def test_bucketed_table_joins_without_exchange(spark):
    ledger = warehouse.with_date(derived.transactions(spark, SF_TINY), until="2024-01-28")
    warehouse.save_ledger(ledger, "ledger_bucketed", buckets=4)
    stored = catalog.read_table(spark, "ledger_bucketed")
    assert stored.count() == ledger.count()
    plan = stored.groupBy("from_bank").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    described = {r.column_name: r.data_type for r in catalog.describe_schema(spark, "ledger_bucketed").collect()}
    assert described["txn_date"] == "DATE (partition)" and described["from_bank"] == "INT"


def test_catalog_round_trips(spark, tmp_path):
    catalog.create_database(spark, "lens", str(tmp_path / "db"))
    frame = spark.createDataFrame([(1, 0, 0.25, 9.5, "Euro, or so")], schema.SCORED)
    assert catalog.save_result(frame, "q1", "lens") == "lens.q1_results"
    catalog.save_result(frame, "q1", "lens")
    assert spark.table("lens.q1_results").count() == 1
    files.write_parquet(frame, str(tmp_path / "pq"))
    catalog.register_parquet(spark, "lens.outside", str(tmp_path / "pq"))
    assert catalog.read_table(spark, "lens.outside").collect() == frame.collect()
    files.write_csv(frame, str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
    catalog.register_csv(spark, "lens.scores", str(tmp_path / "csv"), schema.SCORED)
    assert spark.table("lens.scores").collect() == frame.collect()
    assert files.read_scored(spark, str(tmp_path / "csv")).collect() == frame.collect()
    assert files.read_parquet(spark, str(tmp_path / "pq")).count() == 1
    with pytest.raises(ValueError):
        catalog.register_parquet(spark, "lens.bad", "relative/path")


def test_probe_counts_files_and_bytes(spark, tmp_path):
    path = tmp_path / "out"
    spark.range(100).repartition(3).write.parquet(str(path))
    written = list(path.glob("part-*"))
    probe = files.probe_output(spark, str(path))
    assert probe["files"] == len(written) == 3
    assert probe["bytes"] == sum(f.stat().st_size for f in written)
    assert probe["location"].endswith(str(path))


def test_format_benchmark_records_every_pair(spark, tmp_path):
    frame = derived.transactions(spark, SF_TINY)
    got = {(r.format, r.codec): r for r in compare_formats(frame, str(tmp_path)).collect()}
    assert {"parquet", "orc", "json", "csv"} <= {kind for kind, _ in got}
    assert got[("parquet", "bzip2")].status == "codec_unsupported"
    for row in got.values():
        if row.status == "ok":
            assert row.size_bytes > 0 and row.write_seconds > 0 and row.read_seconds > 0
    assert got[("parquet", "snappy")].status == got[("csv", "gzip")].status == "ok"
    assert got[("orc", "gzip")].effective_codec == "zlib"


def test_fines(spark, tmp_path):
    path = tmp_path / "fines.csv"
    path.write_text(
        "institution,year,fine,authority,note\nB,2012,1.9,X,\nA,2010,0.16,Y,n\n"
    )
    rows = files.fines_by_size(files.read_fines(spark, str(path))).collect()
    assert [row.institution for row in rows] == ["A", "B"]
    assert rows[-1].fine_usd_billion == 1.9 and rows[0].year == 2010


def test_avro_is_optional(spark, tmp_path):
    if files.avro_available(spark):
        spark.range(3).write.format("avro").save(str(tmp_path / "avro"))
        assert files.read_avro(spark, str(tmp_path / "avro")).count() == 3
    else:
        with pytest.raises(Exception):
            files.read_avro(spark, str(tmp_path)).count()


def test_guards_and_samples(spark):
    empty = spark.createDataFrame([], "label int, k int")
    with pytest.raises(ValueError):
        quality.require_rows(empty, "ledger")
    with pytest.raises(ValueError):
        quality.require_positives(spark.createDataFrame([(0, 1)], "label int, k int"))
    frame = spark.createDataFrame([(0, k) for k in range(9)], "label int, k int")
    assert [r.k for r in quality.sample_rows_by_key(frame, "k").collect()] == [0, 1, 2, 3, 4]
    assert quality.class_balance(empty).first().positive_pct == 0.0
    got = quality.cardinalities(frame, ["label", "k"]).collect()
    assert {(r.column_name, r.n_distinct) for r in got} == {("label", 1), ("k", 9)}


def test_derived_ledger_facts(spark):
    ledger = derived.transactions(spark, "/root/testdata/sf0.01")
    row = ledger.agg(
        F.count("*").alias("n"), F.sum("is_laundering").alias("flagged"),
        F.count_if(F.col("from_bank") == F.col("to_bank")).alias("intra"),
        F.count_distinct("txn_date").alias("days"),
    ).first()
    assert tuple(row) == (10000, 416, 2811, 30)


def test_volume_ledger_runs(spark):
    assert derived.volume_transactions(spark, SF_TINY).groupBy("from_bank").count().count() > 1
