from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from payrisk.plans import silver
from payrisk.plans.features import feature_rows
from payrisk.schemas import FEATURE_TABLE
from payrisk.session import setting
from payrisk.sinks import compaction, exports, tables, upsert
from payrisk.sources.tables import read_csv


def now():
    return F.lit("2024-01-02 03:04:05.678").cast("timestamp")



def test_export_is_repeatable_and_replaces_only_its_partitions(spark, event, tmp_path):
    path = str(tmp_path / "gold")
    day_1 = [{"payment_id": f"A{i}", "event_time": f"2024-03-01T00:0{i}:30"} for i in range(3)]
    day_2 = [{"payment_id": "B", "event_time": "2024-03-02T10:00:00"}, {"event_time": None}, {"event_time": "?"}]
    rows = event(*day_1, *day_2)
    for _ in range(2):
        exports.export_by_time(rows, path, "minute")
    exports.export_by_time(event({"payment_id": "B2", "event_time": "2024-03-02T10:00:59"}), path, "minute")
    stored = exports.read_export(spark, path, rows.schema, "minute")
    counts = exports.partition_counts(stored, "minute").collect()
    assert {(r["month"], r["day"], r["hour"], r["minute"], r["n_rows"]) for r in counts} == {
        ("03", "01", "00", "00", 1), ("03", "01", "00", "01", 1), ("03", "01", "00", "02", 1),
        ("03", "02", "10", "00", 1),
    }
    assert stored.filter("day = '02'").first()["payment_id"] == "B2"
    assert len(list(Path(path).rglob("*.json"))) == 4


def test_a_day_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 6).selectExpr(
        "if(id % 10 = 0, '2024-01-02T00:00:00', '2024-01-01T00:00:00') AS event_time", "uuid() AS payment_id"
    )
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k"):
        exports.export_by_time(rows, str(tmp_path / "e"), "day")
    files = {p.name: len(list(p.rglob("*.json"))) for p in (tmp_path / "e").rglob("day=*")}
    assert files["day=01"] > 1
    assert exports.read_export(spark, str(tmp_path / "e"), rows.schema, "day").count() == 60_000


def test_export_by_day_as_parquet(spark, event, tmp_path):
    rows = silver.silver(event({}, {"event_time": "2024-01-02T00:00:00"}))
    exports.export_by_time(rows, str(tmp_path / "s"), "day", "parquet")
    back = exports.read_export(spark, str(tmp_path / "s"), rows.schema, "day", "parquet")
    assert back.select(rows.columns).exceptAll(rows).count() == 0 and back.count() == 2
    with pytest.raises(ValueError):
        exports.export_by_time(rows, str(tmp_path / "t"), "week")


def test_feature_rows_defaults(spark):
    rows = spark.createDataFrame(
        [("P", "C", None, "declined", None, "2024-01-01T00:00:00.9", None), (None, None, 1.0, None, 0.25, None, "D")],
        "payment_id string, customer_id string, amount double, status string, declined_ratio_1h double, "
        "event_time string, device_id string",
    )
    table = feature_rows(rows, now())
    assert table.schema.simpleString() == FEATURE_TABLE.simpleString()
    first, second = sorted(table.collect(), key=lambda r: r["user_id"])
    assert (first["amount"], first["is_fraud"], first["risk_score"], first["country"]) == (0.0, 1, 0.0, "unknown")
    assert str(first["event_time"]) == "2024-01-01 00:00:00"
    assert second["transaction_id"].startswith("gen-") and len(second["transaction_id"]) == 4 + 64 + 2
    assert str(second["event_time"]) == "2024-01-02 03:04:05"
    assert (second["user_id"], second["device_type"], second["is_fraud"]) == ("unknown", "D", 0)
    again = feature_rows(rows, now()).filter("transaction_id like 'gen-%'").collect()
    assert again == [second]


def test_identical_rows_without_id_are_all_kept(event):
    rows = event({"payment_id": None}, {"payment_id": None}, {"payment_id": None, "amount": 1.0}, {})
    ids = [r["transaction_id"] for r in feature_rows(rows, now()).collect()]
    assert len(ids) == len(set(ids)) == 4 and sum(i.startswith("gen-") for i in ids) == 3
    batch = upsert.as_one_batch(feature_rows(rows, now()))
    assert batch.count() == 4


def test_typed_times_keep_their_microseconds(spark, event, tmp_path):
    rows = silver.typed(event({"event_time": "2024-01-01T00:02:22.387114"}))
    exports.export_by_time(rows, str(tmp_path / "e"), "minute")
    back = exports.read_export(spark, str(tmp_path / "e"), rows.schema, "minute").select(rows.columns)
    assert back.collect() == rows.collect()
    assert "2024-01-01T00:02:22.387114Z" in tables.as_messages(rows).first()["value"]


@pytest.mark.parametrize(
    "text", ["", " x ", None, "a\nb", "a\\nb", "\\", "\\N", '"q", \r\n', "\\\\n", "tab\t"]
)
def test_csv_gives_text_back(spark, tmp_path, text):
    rows = spark.createDataFrame([(1, text), (2, "other")], "i int, t string")
    tables.write_csv(rows, str(tmp_path / "c"))
    back = read_csv(spark, str(tmp_path / "c"), rows.schema)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_a_failed_refresh_leaves_the_old_table(spark):
    tables.replace_table(spark.range(3), "refreshed")
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, "refreshed")
    assert spark.read.table("refreshed").count() == 3
    assert tables.replace_table(spark.read.table("refreshed").limit(2), "refreshed").count() == 2


@pytest.fixture
def tables_for_upsert(event):
    target = feature_rows(silver.silver(event({"payment_id": "A"}, {"payment_id": "B"})), now())
    source = feature_rows(
        silver.silver(
            event(
                {"payment_id": "B", "amount": 99.0, "country": "FR", "status": "declined"},
                {"payment_id": "C", "status": "declined"},
            )
        ),
        now(),
    )
    return target, source


def test_upsert_changes_amount_and_country_only(tables_for_upsert):
    target, source = tables_for_upsert
    once = upsert.upserted(target, source)
    got = {r["transaction_id"]: (r["amount"], r["country"], r["is_fraud"]) for r in once.collect()}
    assert got == {"A": (10.0, "ES", 0), "B": (99.0, "FR", 0), "C": (10.0, "ES", 1)}
    twice = upsert.upserted(once, source)
    assert twice.exceptAll(once).count() == 0 and once.exceptAll(twice).count() == 0


def test_upsert_of_all_columns_and_of_nulls(tables_for_upsert):
    target, source = tables_for_upsert
    full = upsert.upserted(target, source, update_columns=["amount", "country", "is_fraud"])
    assert full.filter("transaction_id = 'B'").first()["is_fraud"] == 1
    nulled = source.withColumn("country", F.lit(None).cast("string"))
    assert upsert.upserted(target, nulled).filter("transaction_id = 'B'").first()["country"] is None
    with pytest.raises(ValueError):
        upsert.upserted(target, source.drop("country"))


def test_batch_with_repeated_keys_acts_like_single_upserts(spark):
    rows = spark.createDataFrame(
        [("K", "first", 1.0, 1), ("K", "second", 2.0, 2), ("K", "third", 3.0, 3), ("L", "x", 9.0, 1)],
        "k string, label string, amount double, seq int",
    )
    got = upsert.as_one_batch(rows, "k", ["amount"], "seq").select("k", "label", "amount")
    assert {tuple(r) for r in got.collect()} == {("K", "first", 3.0), ("L", "x", 9.0)}


def test_upsert_of_a_stored_table(spark, tables_for_upsert, tmp_path):
    target, source = tables_for_upsert
    target.write.parquet(str(tmp_path / "v1"))
    result = upsert.write_upsert(spark, str(tmp_path / "v1"), source, str(tmp_path / "v2"))
    assert result.count() == 3 and spark.read.parquet(str(tmp_path / "v1")).count() == 2


def test_statements(spark):
    merge = upsert.merge_statement("cat.ns.t", "s", FEATURE_TABLE.names)
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(merge).toString()
    assert "MergeIntoTable" in plan and "t.amount" in merge and "t.is_fraud" not in merge
    mysql = upsert.mysql_upsert_statement("fraud_features", "staging", FEATURE_TABLE.names)
    assert mysql.endswith("ON DUPLICATE KEY UPDATE amount = VALUES(amount), country = VALUES(country)")
    assert compaction.rewrite_statement("cat", "ns.t", 1024).startswith("CALL cat.system.rewrite_data_files(")


def test_compaction_keeps_rows_and_merges_files(spark, event, tmp_path):
    rows = event(*[{"country": c} for c in "ABC" for _ in range(40)])
    rows.repartition(40).write.parquet(str(tmp_path / "small"))
    files = lambda p: len(list(Path(p).rglob("*.parquet")))
    assert files(tmp_path / "small") == 40
    merged = compaction.compact(spark, str(tmp_path / "small"), str(tmp_path / "merged"))
    assert files(tmp_path / "merged") == 1
    assert merged.exceptAll(rows).count() == 0 and merged.count() == 120
    size = compaction.folder_bytes(spark, str(tmp_path / "small"))
    compaction.compact(spark, str(tmp_path / "small"), str(tmp_path / "three"), -(-size // 3))
    assert files(tmp_path / "three") == 3

    rows.repartition(10).write.partitionBy("country").parquet(str(tmp_path / "parts"))
    by_part = compaction.compact(
        spark, str(tmp_path / "parts"), str(tmp_path / "parts2"), partition_columns=["country"]
    )
    assert files(tmp_path / "parts2") == 3 and by_part.count() == 120


def test_table_ddl_and_replacement(spark, event):
    tables.create_namespace(spark, "payments_ns")
    name = "payments_ns.alerts"
    for amount in (1.0, 2.0):
        stored = tables.replace_table(event({"amount": amount}), name)
    assert [r["amount"] for r in stored.collect()] == [2.0]
    tables.create_table(spark, "payments_ns.features", FEATURE_TABLE)
    tables.create_table(spark, "payments_ns.features", FEATURE_TABLE)
    assert spark.read.table("payments_ns.features").schema == FEATURE_TABLE
    for table in (name, "payments_ns.features"):
        tables.drop_table(spark, table)
        tables.drop_table(spark, table)
        assert not spark.catalog.tableExists(table)


def test_results_and_row_counts(spark, event, tmp_path):
    rows, seen = tables.counted(event({}, {}), "rows seen")
    tables.write_results({"a": rows}, str(tmp_path))
    assert seen.get["rows"] == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "a")).count() == 2
    tables.write_results({"a": rows}, str(tmp_path / "p"), "parquet")
    assert spark.read.parquet(str(tmp_path / "p" / "a")).count() == 2


def test_scratch_folder_rules(spark, monkeypatch):
    from payrisk import session

    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(shared)

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster())


# Compaction in place.


@pytest.mark.parametrize("seed", [1, 2])
def test_first_fit_decreasing(seed):
    pick = random.Random(seed)
    sizes = [pick.randrange(1, 60) for _ in range(137)]
    bins = compaction.pack(sizes, 100)
    plain: list[int] = []
    for size in sorted(sizes, reverse=True):
        at = next((i for i, used in enumerate(plain) if used + size <= 100), len(plain))
        plain[at:] = [size + (plain[at] if at < len(plain) else 0), *plain[at + 1 :]]
    filled = [sum(s for s, b in zip(sizes, bins) if b == at) for at in range(max(bins) + 1)]
    assert filled == plain
    assert compaction.pack([], 10) == [] and compaction.pack([10], 10) == [0]


def _small_and_large(spark, path):
    rows = spark.range(0, 30_000, 1, 6).selectExpr("id", "uuid() as noise", "if(id < 20000, 'a', 'b=c d') as part")
    rows.filter("id % 3 = 0").repartition(1).write.partitionBy("part").parquet(path)
    rows.filter("id % 3 > 0").repartition(30, "id").write.mode("append").partitionBy("part").parquet(path)
    return {p: (p.stat().st_size, p.stat().st_mtime_ns) for p in Path(path).rglob("*.parquet")}


def test_small_files_are_merged_and_large_ones_left(spark, tmp_path):
    path = tmp_path / "id=3" / "t"  # not a partition of the table
    before = _small_and_large(spark, str(path))
    rows = set(map(tuple, spark.read.parquet(str(path)).collect()))
    target = 200_000
    placed = compaction.compact_small_files(spark, str(path), target)
    after = {p: (p.stat().st_size, p.stat().st_mtime_ns) for p in path.rglob("*.parquet")}
    large = {p: s for p, s in before.items() if s[0] >= target / 2}
    assert large and large.items() <= after.items()
    new = {p: s for p, s in after.items() if p not in before}
    assert len(new) == placed and len(after) < len(before) / 3
    assert all(size <= target for size, _ in new.values())
    assert set(map(tuple, spark.read.parquet(str(path)).collect())) == rows
    assert {p.parent.name for p in after} == {p.parent.name for p in before}
    # What is left are files that fit nowhere; nothing is to be done again.
    assert compaction.compact_small_files(spark, str(path), target) <= placed
    assert not list(path.glob("_compact-*"))


def test_a_compaction_that_was_cut_off_is_finished(spark, tmp_path, monkeypatch):
    path = tmp_path / "t"
    _small_and_large(spark, str(path))
    rows = sorted(map(tuple, spark.read.parquet(str(path)).collect()))
    rename, moved = compaction._rename, []

    def once(*files):
        if moved:
            raise OSError("cut off")
        moved.append(files)
        return rename(*files)

    monkeypatch.setattr(compaction, "_rename", once)
    with pytest.raises(OSError, match="cut off"):
        compaction.compact_small_files(spark, str(path), 200_000)
    monkeypatch.setattr(compaction, "_rename", rename)
    assert compaction.finish_compaction(spark, str(path)) > 0
    assert sorted(map(tuple, spark.read.parquet(str(path)).collect())) == rows
    # One that had not written all its files is dropped.
    (path / "_compact-begun" / "new").mkdir(parents=True)
    assert compaction.finish_compaction(spark, str(path)) == 0
    assert not list(path.glob("_compact-*"))


def test_small_files_are_found_by_metadata(spark, tmp_path):
    from tests.test_plans import plan_of

    rows = spark.range(100).withColumn("text", F.col("id").cast("string"))
    rows.repartition(5).write.parquet(str(tmp_path / "t"))
    plan = plan_of(compaction.small_file_groups(spark, str(tmp_path / "t")))
    assert "ReadSchema: struct<>" in plan and "file_size" in plan
    assert compaction.compact_small_files(spark, str(tmp_path / "t"), 10) == 0


# Versioned tables.


def test_readers_meet_old_or_new_rows_at_every_step(spark, monkeypatch):
    tables.replace_table(spark.range(3), "versioned")
    open_reader = spark.read.table("versioned")
    seen, sql = [], type(spark).sql

    def watched(self, text, *a, **k):
        seen.append((text.split()[0], sql(self, "SELECT count(*) FROM versioned").first()[0]))
        result = sql(self, text, *a, **k)
        seen.append((text.split()[0], sql(self, "SELECT count(*) FROM versioned").first()[0]))
        return result

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", watched)
        tables.replace_table(spark.range(5), "versioned")
    counts = [n for _, n in seen]
    assert counts == sorted(counts) and set(counts) == {3, 5} and "CREATE" in dict(seen)
    assert open_reader.count() == 3  # a reader that had begun
    for n in (7, 9):
        tables.replace_table(spark.range(n), "versioned")
        assert len(tables.versions(spark, "versioned")) == 2
    tables.drop_table(spark, "versioned")
    assert tables.versions(spark, "versioned") == [] and not spark.catalog.tableExists("versioned")


def test_a_plain_table_becomes_versioned(spark):
    spark.range(2).write.saveAsTable("plain_once")
    assert tables.replace_table(spark.read.table("plain_once").limit(1), "plain_once").count() == 1
    tables.drop_table(spark, "plain_once")


def test_partitions_of_a_refreshed_table_prune(spark):
    from payrisk.plans import gold
    from tests.test_plans import plan_of

    rows = spark.range(96).selectExpr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id) AS event_time", "id")
    stored = tables.replace_table(gold.with_day(rows), "by_day", partition_by=[gold.EVENT_DAY])
    sliced = gold.time_slice(stored, "2024-01-02 20:00:00", "2024-01-03 02:00:00")
    assert sorted(r["id"] for r in sliced.collect()) == list(range(44, 50))
    plan = plan_of(sliced)
    assert "PartitionFilters: [isnotnull(event_day" in plan and "event_day#" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(event_time" in plan
    tables.drop_table(spark, "by_day")
