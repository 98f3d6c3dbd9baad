from __future__ import annotations

import gzip
import json
import random
from datetime import datetime
from decimal import Decimal

import pyarrow as pa
import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from ampflow.plans import stage, warehouse
from ampflow.sources import domain, raw, records, seeds
from ampflow.sources.tables import save_table, versions_of
from ampflow.functions.measures import percent
from ampflow.streaming import alerts, monitoring
from ampflow.streaming.landing import Landing, load_new_files, loaded, quarantined
from ampflow.streaming.merge import MergeTarget, merge_new_files, newest_per_key

RECORDS = [
    {"charger_id": "c1", "city": "Bern", "location": {"lat": 46.9, "lon": 7.4}, "installed_at": "2024-01-02T03:04:05Z"},
    {"charger_id": "c2", "city": None, "location": None, "installed_at": "later"},
]


def test_outer_array_and_lines_and_gzip(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps(RECORDS, indent=1))
    with gzip.open(tmp_path / "lines.json.gz", "wt") as file:
        file.write("\n".join(map(json.dumps, RECORDS)))
    schema = raw.RAW_SCHEMAS["chargers"]
    array = raw.flatten_location(raw.scan_json(spark, f"{tmp_path}/array.json", schema, outer_array=True))
    lines = raw.flatten_location(raw.scan_json(spark, f"{tmp_path}/lines.json.gz", schema))
    assert values(array) == values(lines)
    assert array.where("_corrupt_record IS NOT NULL").count() == 0
    assert values(array, "charger_id", "latitude", "longitude") == [("c1", 46.9, 7.4), ("c2", None, None)]


def test_variant_landing_and_stage_parsing(spark, run, tmp_path):
    (tmp_path / "c.json").write_text("\n".join([*map(json.dumps, RECORDS), '{"charger_id": "c3", ']))
    (tmp_path / "a.json").write_text(json.dumps(RECORDS))
    landed = raw.land_variant(spark, f"{tmp_path}/c.json", run.stamp())
    assert landed.count() == 3
    assert landed.where("raw_data IS NULL").first()["_bad_line"].startswith('{"charger_id": "c3"')
    parsed = stage.stg_chargers(landed.where("raw_data IS NOT NULL"), run)
    assert values(parsed, "charger_id", "city", "latitude", "installed_at", "_source_file") == [
        ("c1", "Bern", 46.9, datetime(2024, 1, 2, 3, 4, 5), "c.json"),
        ("c2", None, None, None, "c.json"),
    ]
    array = raw.land_variant_array(spark, f"{tmp_path}/a.json", run.stamp())
    columns = ("charger_id", "city", "latitude", "longitude", "installed_at")
    assert values(stage.stg_chargers(array, run), *columns) == values(parsed, *columns)


def test_stage_parsing_of_bad_values(spark, run):
    rows = [
        ('{"session_id": "s1", "kWh_consumed": 12.34567, "start_time": "2025-01-01T00:00:00", "end_time": null}',),
        ('{"session_id": "s2", "kWh_consumed": "n/a", "start_time": "2025-13-01"}',),
        ('{"session_id": "s3", "kWh_consumed": 1e9}',),
    ]
    df = spark.createDataFrame(rows, "j string").select(
        F.parse_json("j").alias("raw_data"), run.stamp().alias("_loaded_at"), F.lit("f").alias("_source_file")
    )
    got = values(stage.stg_transactions(df, run), "session_id", "kwh_consumed", "start_time", "end_time")
    assert got == [
        ("s1", Decimal("12.3457"), datetime(2025, 1, 1), None),
        ("s2", None, None, None),
        ("s3", None, None, None),
    ]


def test_seed(spark, tmp_path):
    assert seeds.city_map(spark).count() == 16
    assert {r['city'] for r in seeds.place_cities(spark).collect()} <= {r['place'] for r in seeds.places(spark).collect()}
    path = str(seeds.DATA / "city_name_mapping.csv")
    typed = seeds.read_seed(spark, path, "city_name_raw string, city_name_standardized string")
    assert values(typed) == values(seeds.city_map(spark))


def test_landing_loads_each_file_once(spark, run, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    landing = Landing(str(source), raw.RAW_SCHEMAS["payments"], str(tmp_path / "out"), str(tmp_path / "progress"))
    good = '{"payment_id": "p%d", "session_id": "s", "user_id": "u", "amount": 1.5, "currency": "CHF"}\n'
    (source / "one.json").write_text(good % 1 + "{broken\n" + good % 2)
    load_new_files(spark, landing, run.stamp())
    load_new_files(spark, landing, run.stamp())
    assert values(loaded(spark, landing), "payment_id", "_source_file") == [("p1", "one.json"), ("p2", "one.json")]
    (source / "two.json").write_text(good % 3)
    load_new_files(spark, landing, run.stamp())
    assert values(loaded(spark, landing), "payment_id") == [("p1",), ("p2",), ("p3",)]
    assert values(quarantined(spark, landing), "bad_line", "_source_file") == [("{broken", "one.json")]


def test_landing_takes_a_backlog_in_batches(spark, run, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text('{"payment_id": "p%d"}\n' % i)
    landing = Landing(
        str(source), raw.RAW_SCHEMAS["payments"], str(tmp_path / "out"), str(tmp_path / "progress"), files_per_batch=1
    )
    load_new_files(spark, landing, run.stamp())
    assert values(loaded(spark, landing), "payment_id") == [("p0",), ("p1",), ("p2",)]
    assert len(list((tmp_path / "progress" / "commits").glob("[0-9]*"))) == 3


def test_landing_of_array_files(spark, run, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    landing = Landing(
        str(source), raw.RAW_SCHEMAS["chargers"], str(tmp_path / "out"), str(tmp_path / "progress"), outer_array=True
    )
    (source / "ok.json").write_text(json.dumps(RECORDS))
    (source / "bad.json").write_text('[{"charger_id": "c9",')
    load_new_files(spark, landing, run.stamp())
    assert values(loaded(spark, landing), "charger_id", "location.lat") == [("c1", 46.9), ("c2", None)]
    assert values(quarantined(spark, landing), "_source_file") == [("bad.json",)]


def test_lines_with_repeated_keys_or_bad_bytes_are_set_aside(spark, run, tmp_path):
    (tmp_path / "l.json").write_bytes(b'{"a": 1, "a": 2}\n{"a": "\xff\xfe"}\n{"a": 3}\n\n')
    landed = raw.land_variant(spark, f"{tmp_path}/l.json", run.stamp())
    assert landed.count() == 3
    assert landed.where("raw_data IS NULL AND _bad_line IS NOT NULL").count() == 2


ARRAYS = [
    (b"", []),
    (b" [ ] ", []),
    (b'[{"a": 1}, {"b": [1, {"c": "]},"}]}]', [b'{"a": 1}', b'{"b": [1, {"c": "]},"}]}']),
    (b'[{"a": 1}, {"b": 2}', [b'{"a": 1}', b'{"b": 2}']),
    (b'[{"a": 1}, {"b": "cut', [b'{"a": 1}', b'{"b": "cut']),
    (b'[{"a": 1},', [b'{"a": 1}', b""]),
    (b'[{"a": 1}] tail', [b'{"a": 1}', b"tail"]),
    (b'\xef\xbb\xbf[{"q": "\\\\\\""}]', [b'{"q": "\\\\\\""}']),
    (b'{"x": 9}', [b'{"x": 9}']),
    (b"[1, , 2]", [b"1", b"", b"2"]),
]


@pytest.mark.parametrize(("content", "pieces"), ARRAYS)
def test_splitting_arrays(content, pieces):
    found = list(records.elements(content))
    assert [piece for piece, _ in found] == pieces
    assert [placed for _, placed in found] == [piece not in (b"tail", b'{"x": 9}') for piece in pieces]


FAULTS = [b'{"x": 1}', b'{"x": 2, "x": 3}', b'{"x": "zz"}', b'{"x": "\xff"}', b"7", b"{broken"]


def test_all_paths_agree_on_good_and_bad(spark, run, tmp_path):
    for name, content in (("lines", b"\n".join(FAULTS)), ("arrays", b"[" + b",".join(FAULTS[:-1]) + b", {broken")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.json").write_bytes(content)
        outer = name == "arrays"
        landed = raw.land_variant(spark, f"{tmp_path}/{name}", run.stamp(), outer_array=outer)
        good, bad = raw.good_and_bad(landed)
        assert (good.count(), bad.count()) == (2, 4)
        scanned = raw.scan_json(spark, f"{tmp_path}/{name}", "x int", outer_array=outer)
        assert values(scanned.where("_corrupt_record IS NULL"), "x") == [(1,), (None,)]
        landing = Landing(f"{tmp_path}/{name}", "x int", f"{tmp_path}/out-{name}", f"{tmp_path}/at-{name}", outer_array=outer)
        load_new_files(spark, landing, run.stamp())
        assert values(loaded(spark, landing), "x") == [(1,), (None,)]
        texts = {r[0] for r in quarantined(spark, landing).select("bad_line").collect()}
        assert texts == {r["_bad_line"] for r in bad.collect()} == {r["_corrupt_record"] for r in scanned.collect()} - {None}


SCHEMA = "session_id string, kwh int, _loaded_at timestamp_ntz, transaction_month date"


def test_merging_in_batches_equals_one_refresh(spark, tmp_path):
    t = lambda hour: datetime(2025, 1, 1, hour)
    may, june = datetime(2025, 5, 1).date(), datetime(2025, 6, 1).date()
    batches = [
        [("a", 1, t(1), may), ("b", 1, t(1), may), ("c", 1, t(1), june), ("n", 1, t(1), None)],
        [("a", 2, t(3), may), ("a", 3, t(2), may), ("b", 9, t(2), june)],  # update twice, move to another month
        [("a", 0, t(1), may), ("c", 1, t(1), june), ("d", 5, t(1), june), ("d", 5, t(1), june)],  # late and repeated
        [("n", 4, t(5), june)],  # leaves its partition empty
    ]
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    target = MergeTarget(str(tmp_path / "table"), SCHEMA)
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(source)
        merge_new_files(spark, source, target, progress)
    every = frames[0]
    for frame in frames[1:]:
        every = every.unionByName(frame)
    expected = values(newest_per_key(every, "session_id", "_loaded_at"))
    assert values(target.read(spark)) == expected
    assert [r[:2] for r in expected] == [("a", 2), ("b", 9), ("c", 1), ("d", 5), ("n", 4)]
    merge_new_files(spark, source, target, progress)
    assert values(target.read(spark)) == expected
    target.merge(frames[1])
    assert values(target.read(spark)) == expected
    assert "__HIVE_DEFAULT_PARTITION__" not in target.state(spark).data


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    may, june = datetime(2025, 5, 1).date(), datetime(2025, 6, 1).date()
    target = MergeTarget(str(tmp_path / "table"), SCHEMA)
    target.merge(spark.createDataFrame([("a", 1, datetime(2025, 1, 1), may), ("b", 1, datetime(2025, 1, 1), june)], SCHEMA))
    before = target.state(spark)
    later = spark.createDataFrame([("b", 2, datetime(2025, 1, 2), june)], SCHEMA)
    news, known = target.news(later, before)
    assert [r["_place"] for r in news.collect()] == ["2025-06-01"]
    assert len({f.split("_bucket=")[1].split("/")[0] for f in known.inputFiles()}) == 1
    assert all("transaction_month=2025-06-01" in f for f in target.rows(spark, before, ["2025-06-01"]).inputFiles())
    target.merge(later)
    after = target.state(spark)
    assert after.data["2025-05-01"] == before.data["2025-05-01"] and after.data["2025-06-01"] != before.data["2025-06-01"]
    assert values(target.read(spark), "session_id", "kwh") == [("a", 1), ("b", 2)]
    assert values(target.read(spark, before.number), "session_id", "kwh") == [("a", 1), ("b", 1)]
    pruned = plan_of(target.read(spark).where("transaction_month = DATE'2025-06-01'"))
    assert "PartitionFilters: [isnotnull(transaction_month" in pruned
    target.merge(spark.createDataFrame([("b", 1, datetime(2025, 1, 1), june)], SCHEMA))  # late: no partition is read or written
    assert target.state(spark) == after


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    may, june = datetime(2025, 5, 1).date(), datetime(2025, 6, 1).date()
    target = MergeTarget(str(tmp_path / "table"), SCHEMA)
    target.merge(spark.createDataFrame([("a", 1, datetime(2025, 1, 1), may), (None, 7, datetime(2025, 1, 1), june)], SCHEMA), 0, "s")
    moved = spark.createDataFrame([("a", 2, datetime(2025, 1, 2), june), (None, 8, datetime(2025, 1, 2), june)], SCHEMA)
    publish = MergeTarget._publish
    monkeypatch.setattr(MergeTarget, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        target.merge(moved, 1, "s")
    monkeypatch.setattr(MergeTarget, "_publish", publish)
    assert values(target.read(spark), "session_id", "kwh") == [("a", 1), (None, 7)]
    target.merge(moved, 1, "s")
    target.merge(moved.withColumn("kwh", F.lit(99)), 1, "s")  # that batch is merged
    assert values(target.read(spark), "session_id", "kwh") == [("a", 2), (None, 8)]
    with pytest.raises(RuntimeError, match="another merge"):
        target._publish(spark, target.state(spark))
    target.merge(spark.createDataFrame([("c", 1, datetime(2025, 1, 1), may)], SCHEMA))
    target.expire(spark, keep=1)
    assert target.versions(spark) == [2] and len(list((tmp_path / "table" / "data").iterdir())) == 2
    assert values(target.read(spark), "session_id", "kwh") == [("a", 2), ("c", 1), (None, 8)]


def test_partitions_with_signs_in_their_names(spark, tmp_path):
    schema = "session_id string, kwh int, _loaded_at timestamp_ntz, transaction_month string"
    target = MergeTarget(str(tmp_path / "table"), schema)
    at = datetime(2025, 1, 1)
    target.merge(spark.createDataFrame([("a", 1, at, "x/y: z"), ("b", 1, at, "100%25"), ("c", 1, at, None)], schema))
    target.merge(spark.createDataFrame([("a", 2, at, "q=r"), ("b", 2, at, "100%25")], schema))
    assert values(target.read(spark), "session_id", "kwh", "transaction_month") == [("a", 2, "q=r"), ("b", 2, "100%25"), ("c", 1, None)]
    target.expire(spark, keep=1)
    assert target.read(spark).count() == 3


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1, 0, 0),)], "t timestamp_ntz")
    got = monitoring.source_freshness(
        {"a": (df, "t"), "none": (df.where("false"), "t")}, datetime(2025, 1, 2, 0, 1)
    )
    assert values(got, "source_name", "age_minutes", "status") == [("a", 1441, "warn"), ("none", None, "error")]
    assert monitoring.source_freshness({"a": (df, "t")}, datetime(2025, 1, 2)).first()["status"] == "pass"
    assert monitoring.source_freshness({"a": (df, "t")}, datetime(2025, 1, 3, 0, 1)).first()["status"] == "error"


@pytest.fixture(scope="module")
def refreshed(spark):
    small = "/root/testdata/sf0.001"
    stage_tables = {
        "stg_users": domain.users(spark, small),
        "stg_chargers": domain.chargers(spark, small),
        "stg_transactions": domain.transactions(spark, small),
        "stg_payments": domain.payments(spark, small),
    }
    return warehouse.refresh(spark, stage_tables, warehouse.TEST_RUN, buckets=4)


def test_refresh_builds_every_layer(spark, refreshed):
    assert {t.name for t in spark.catalog.listTables("semantic")} >= {
        "dim_dates", "dim_users", "dim_chargers", "dim_cities", "fact_transactions", "fact_daily_metrics",
        "fact_charger_performance",
    }
    assert refreshed["dim_dates"].count() == 4017
    assert spark.table("semantic.fact_transactions").count() == 1500
    assert spark.table("semantic.fact_daily_metrics").count() == 2497


def test_refresh_keeps_its_bounds(spark, refreshed):
    saved = spark.table("curated.payment_bounds").first()
    row = spark.table("curated.cur_payments").first()
    assert saved["amount_upper_bound"] == row["_outlier_upper_bound"]
    assert spark.table("curated.cur_payments").where("is_outlier_amount").count() == 20


def test_bucketed_session_join_does_not_shuffle(spark, refreshed):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table("curated.cur_transactions").join(spark.table("curated.cur_payments"), "session_id", "left")
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partitioned_table_prunes(spark, tmp_path):
    df = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 2)], "d string, n int").withColumn(
        "transaction_date", F.to_date("d")
    )
    table = save_table(df, "scratch", "dated", partition_by=["transaction_date"])
    plan = plan_of(table.where("transaction_date = DATE '2025-01-02'").select("n"))
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def test_refresh_with_dated_facts(spark, refreshed):
    """One month of sessions; the dated facts are pruned by day and equal the undated ones."""
    small = "/root/testdata/sf0.001"
    month = domain.transactions(spark, small).where("start_time < TIMESTAMP_NTZ '1995-02-01 00:00:00'")
    stage_tables = {
        "stg_users": domain.users(spark, small),
        "stg_chargers": domain.chargers(spark, small),
        "stg_transactions": month,
        "stg_payments": domain.payments(spark, small),
    }
    plain = warehouse.refresh(spark, stage_tables, warehouse.TEST_RUN)
    expected = {n: values(plain[n], *sorted(plain[n].columns)) for n in ("fact_transactions", "fact_daily_metrics")}
    dated = warehouse.refresh(spark, stage_tables, warehouse.TEST_RUN, partition_facts=True)
    assert len(expected["fact_transactions"]) == month.count() > 0
    assert {n: values(dated[n], *sorted(dated[n].columns)) for n in expected} == expected
    plan = plan_of(dated["fact_transactions"].where("transaction_date = DATE '1995-01-03'").select("session_id"))
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def array_texts():
    rng = random.Random(3)
    strings = ['"a,b"', '"\\\\"', '"\\",["', '"]}"', '"é🙂"', '""', '"x\\\\\\"y,"', '"' + "long, " * 60 + '"']

    def value(deep):
        kind = rng.random()
        if deep and kind < 0.3:
            return "[" + ", ".join(value(deep - 1) for _ in range(rng.randint(0, 4))) + "]"
        if deep and kind < 0.6:
            return "{" + ",".join(f"{rng.choice(strings)}: {value(deep - 1)}" for _ in range(rng.randint(0, 4))) + "}"
        return rng.choice([*strings, "1", "null", "-2.5e3"])

    def array(n):
        return "[" + rng.choice([",", ", ", ",\n", " ,"]).join(value(3) for _ in range(n)) + "]"

    texts = [array(rng.randint(0, 60)) for _ in range(40)]
    texts += [t[: rng.randint(1, len(t))] for t in texts[:25]]  # cut off anywhere
    texts += ["﻿" + texts[0], " \n" + texts[1], texts[2] + "\n", "[1,2,]", "[,]", "[1,,2]", "[1,2,", "[", "", "   ", "[ ]"]
    return texts + ["﻿[1, 2,", '["' + "no end, " * 90, "[" + "[1," * 50 + "2" + "]" * 51, '{"x": [1, 2]}', "not, an, array", "[1], [2, 3], 4"]


def test_blocks_of_an_array_file_give_the_elements_of_the_whole(spark, tmp_path):
    """The reader is mocked by cuts after commas; each block is worked on alone."""
    rng = random.Random(1)
    for text in array_texts():
        content = text.encode()
        pieces = content.removeprefix(records._BOM).split(b",")
        if len(pieces) > 1 and not pieces[-1]:
            pieces.pop()  # the reader drops a separator at the end
        want = list(records.elements(content))
        for _ in range(4):
            cuts = sorted(rng.sample(range(1, len(pieces)), min(len(pieces) - 1, rng.randint(0, 6))))
            groups = [pieces[a:b] for a, b in zip([0, *cuts], [*cuts, len(pieces)], strict=True)]
            starts = [0, *[7 * (i + 1) for i in range(len(groups) - 1)]]
            rows = [
                {records.VALUE: p, "path": "p", records.FILE: "f", "block": s, "size": len(content)}
                for s, g in zip(starts, groups, strict=True) for p in g
            ]
            batches = [pa.RecordBatch.from_pylist(rows[i : i + 3]) for i in range(0, len(rows), 3)]
            entry = {}
            if len(groups) > 1:
                sums = pa.Table.from_batches(records._summaries(iter(batches)))
                entry = {r["block"]: r for r in records._entries(sums).to_pylist()}
            nothing = dict.fromkeys(("ended", "open", "depth", "last", "trailing"))
            rows = [r | {k: entry.get(r["block"], nothing)[k] for k in nothing} for r in rows]
            schema = pa.RecordBatch.from_pylist(rows).schema
            batches = [pa.RecordBatch.from_pylist(rows[i : i + 3], schema=schema) for i in range(0, len(rows), 3)]
            parts = [r for b in records._split_blocks(iter(batches)) for r in b.to_pylist()]
            got = [(r[records.VALUE], r[records.PLACED]) for r in parts if r["kind"] == records.WHOLE]
            left = sorted((r for r in parts if r["kind"] != records.WHOLE), key=lambda r: (r["block"], r["kind"]))
            if left:
                for b in records._put_together(iter([pa.RecordBatch.from_pylist([r]) for r in left])):
                    got += [(r[records.VALUE], True) for r in b.to_pylist()]
            inside = sorted(v for v, placed in got if placed)
            assert inside == sorted(v for v, placed in want if placed), (text, cuts)
            outside = [b"".join(v.split()) for v, placed in got if not placed]
            assert b"".join(outside).replace(b",", b"") == b"".join(b"".join(v.split()) for v, p in want if not p).replace(b",", b""), text


def test_array_files_are_split_once_for_all_readers(spark, run, tmp_path):
    (tmp_path / "one.json").write_text('[{"charger_id": "a"}, 5, {"charger_id": "b"}]')
    landed = raw.land_variant_array(spark, str(tmp_path), run.stamp())
    good, bad = raw.good_and_bad(landed)
    assert "_split_blocks" not in plan_of(good) + plan_of(bad)
    assert (good.count(), [r[0] for r in bad.select("_bad_line").collect()]) == (2, ["5"])


def test_one_array_file_is_read_by_many_tasks(spark, run, tmp_path):
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    rows = [{"charger_id": f"c{i}", "city": 'A "b", [c]' if i % 7 else "x" * 9000, "location": {"lat": i, "lon": 1}} for i in range(900)]
    (tmp_path / "big").mkdir()
    content = json.dumps(rows, ensure_ascii=False)
    (tmp_path / "big" / "one.json").write_text(content)
    (tmp_path / "big" / "cut.json").write_text("﻿" + content[:50_001])
    (tmp_path / "big" / "small.json").write_text('[{"charger_id": "s"}, 5,]')
    (tmp_path / "big" / "packed.json.gz").write_bytes(gzip.compress(content.encode()))
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        landed = raw.land_variant_array(spark, str(tmp_path / "big"), run.stamp())
        good, bad = raw.good_and_bad(landed)
        found = good.groupBy("_source_file").count().collect()
        records_of = {f: [r for r in records.elements((tmp_path / "big" / f).read_bytes())] for f in ("one.json", "cut.json")}
        assert dict(found) == {"one.json": 900, "cut.json": len(records_of["cut.json"]) - 1, "small.json": 1, "packed.json.gz": 900}
        assert sorted(r._bad_line[:9] for r in bad.collect()) == sorted(["5", "", records_of["cut.json"][-1][0].decode()[:9]])
        ids = good.where("_source_file = 'one.json'").selectExpr("variant_get(raw_data, '$.charger_id', 'string') AS c", "variant_get(raw_data, '$.city', 'string') AS city")
        assert {tuple(r) for r in ids.collect()} == {(r["charger_id"], r["city"]) for r in rows}
        blocks = spark.read.option("lineSep", ",").text(str(tmp_path / "big" / "one.json")).rdd.getNumPartitions()
        assert blocks > 50
    finally:
        for name in names:
            spark.conf.unset(name)


def test_seed_lines_are_typed_and_checked(spark):
    lines = ["# a comment", "name,size,since", '"a, b",3,2024-01-02', ",,", ""]
    typed = seeds.typed_lines(spark, lines, "name string, size int, since date")
    assert values(typed) == [("a, b", 3, datetime(2024, 1, 2).date()), (None, None, None)]
    with pytest.raises(ValueError, match="header"):
        seeds.typed_lines(spark, lines, "name string, other int, since date")
    with pytest.raises(Exception, match="x"):
        seeds.typed_lines(spark, ["n", "x"], "n int").collect()


def test_a_refresh_shows_the_old_rows_or_the_new_ones(spark):
    first = save_table(spark.range(3).toDF("n"), "versions", "t")
    reader = spark.table("versions.t")
    lost = spark.range(5).select(F.raise_error(F.lit("lost")).cast("bigint").alias("n"))
    with pytest.raises(Exception, match="lost"):
        save_table(lost, "versions", "t")
    assert spark.table("versions.t").count() == 3
    second = save_table(spark.range(7).toDF("n"), "versions", "t")
    assert (second.count(), spark.table("versions.t").count()) == (7, 7)
    assert reader.count() == first.count() == 3  # begun before the switch
    save_table(spark.range(9).selectExpr("id AS n", "id % 2 AS p"), "versions", "t", partition_by=["p"])
    assert spark.table("versions.t").count() == 9 and len(versions_of(spark, "versions", "t")) <= 2
    spark.sql("CREATE TABLE versions.plain USING parquet AS SELECT 1 AS n")
    assert save_table(spark.range(2).toDF("n"), "versions", "plain").count() == 2


DAYS = "day date, ok boolean"


def test_alerts_while_sessions_arrive(spark, tmp_path):
    may, june = datetime(2025, 5, 1).date(), datetime(2025, 6, 1).date()
    loads = [
        [(may, True)] * 3 + [(june, False), (None, False)],  # June is below
        [(may, False)] * 3 + [(june, True)],  # May goes below, June reaches 50 %
        [(may, None)] + [(june, True)] * 3,  # May falls on, June is above
    ]
    source, log, progress = (str(tmp_path / n) for n in ("in", "log", "progress"))
    for load in loads:
        spark.createDataFrame(load, DAYS).repartition(2).write.mode("append").parquet(source)
        alerts.alert_on_new_sessions(spark, source, DAYS, "day", "ok", 60.0, log, progress)
    alerts.alert_on_new_sessions(spark, source, DAYS, "day", "ok", 60.0, log, progress)
    events = spark.read.parquet(log)
    want = [(june, 1, 0, 0.0, "raised"), (june, 2, 1, 50.0, "held"), (june, 5, 4, 80.0, "cleared")]
    want += [(may, 6, 3, 50.0, "raised"), (may, 7, 3, 42.86, "held")]
    assert values(events) == sorted(want, key=repr)
    assert values(alerts.open_alerts(spark, log)) == [(may, 7, 3, 42.86)]


def test_shares_are_rounded_as_in_the_daily_fact(spark):
    pairs = [(v, t) for t in range(1, 130) for v in range(t + 1)]
    df = spark.createDataFrame(pairs, "v bigint, t bigint")
    assert all(alerts.percent_of(r.v, r.t) == r.p for r in df.select("v", "t", percent(F.col("v"), F.col("t")).alias("p")).collect())
